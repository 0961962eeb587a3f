"""Entity rules, dimensions, facts, aggregates, views and the end-to-end run."""

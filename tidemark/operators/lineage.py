"""Dependency levels over an edge table, and the sources of columns read from analysed plans."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import durable


class CycleError(ValueError):
    """The dependency edges contain a cycle."""


def _names(nodes: DataFrame | None, pairs: DataFrame, node: str) -> DataFrame:
    """(n, listed, need, children): every name once, with the number of edges into and out of it.

    A repeated edge counts as often as it is listed, here and whenever it is followed. An edge with a null end counts
    nowhere, but null may be a node.
    """
    whole = F.when(F.col("n").isNotNull() & F.col("p").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    zero, every = F.lit(0).cast("long"), F.lit(nodes is None)
    ends = F.array(
        F.struct(F.col("n").alias("n"), whole.alias("need"), zero.alias("children")),
        F.struct(F.col("p").alias("n"), zero.alias("need"), whole.alias("children")),
    )
    names = pairs.select(F.inline(ends)).withColumn("listed", every)
    if nodes is not None:
        listed = nodes.select(F.col(node).alias("n"), zero.alias("need"), zero.alias("children"), F.lit(True).alias("listed"))
        names = names.unionByName(listed)
    sums = (F.sum(c).alias(c) for c in ("need", "children"))
    return durable(names.groupBy("n").agg(F.max("listed").alias("listed"), *sums), "nodes")


def _graph(nodes: DataFrame | None, edges: DataFrame, node: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """The names that are nodes, and (p, n, w, need, inner) for every edge between two of them.

    ``inner``: other nodes depend on the node. Edges move once, to the counters of their nodes; only where some end is no
    node are they cut down first.
    """
    pairs = edges.select(F.col(node).alias("n"), F.col(parent).alias("p"))
    names = _names(nodes, pairs, node)
    if not names.filter(~F.col("listed")).isEmpty():
        ids = names.filter("listed").select("n")
        pairs = pairs.join(ids, "n", "left_semi").join(ids.withColumnRenamed("n", "p"), "p", "left_semi")
        pairs = durable(pairs.select("n", "p"), "edges")
        names = _names(ids, pairs, "n")
    known = names.filter("need > 0").select("n", "need", (F.col("children") > 0).alias("inner"))
    links = pairs.filter("p is not null").join(known, "n")
    return names, durable(links.select("p", "n", F.lit(1).cast("long").alias("w"), "need", "inner"), "edges")


def _counted(links: DataFrame) -> DataFrame:
    links = durable(links, "edges")
    return durable(links.join(links.groupBy("n").agg(F.count(F.lit(1)).alias("need")), "n").select("p", "n", "w", "need"), "edges")


def _reach(links: DataFrame, frontier: DataFrame, counters: list[DataFrame]) -> DataFrame:
    """(n, got, best, need): the counters of the nodes that an edge out of ``frontier`` reaches, earlier rounds included."""
    sources = frontier.select(F.col("n").alias("p"), "level")
    hits = links.join(sources, "p").groupBy("n").agg(
        F.count(F.lit(1)).alias("got"), F.max(F.col("level") + F.col("w")).alias("best"), F.max("need").alias("need")
    )
    if not counters:
        return durable(hits, "counters")
    hits = durable(hits, "reached")
    # counters only grow, so the greatest of a node's entries is its last
    before = _latest(counters).join(hits.select("n"), "n", "left_semi")
    before = before.groupBy("n").agg(F.max("got").alias("_got"), F.max("best").alias("_best"))
    got = F.col("got") + F.coalesce("_got", F.lit(0))
    return durable(
        hits.join(before, "n", "left").select("n", got.alias("got"), F.greatest("best", "_best").alias("best"), "need"), "counters"
    )


def _latest(counters: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [c.select("n", "got", "best") for c in counters])


def _jump(single: DataFrame) -> DataFrame:
    """(n, p, w, b) with one open parent each -> the same nodes, hung on the nearest ancestor that isn't one of them.

    A level is max(b, level of p + w); such functions compose, so every round halves the way that is left.
    """
    jumps = durable(single, "jumps")
    for _ in range(jumps.count().bit_length() + 1):
        up = jumps.select(F.col("n").alias("_n"), F.col("p").alias("_p"), F.col("w").alias("_w"), F.col("b").alias("_b"))
        longer = jumps.join(up, F.col("p") == F.col("_n"), "left")
        if longer.filter("_n is not null").isEmpty():
            return jumps
        jumps = durable(
            longer.select(
                "n", F.coalesce("_p", "p").alias("p"), (F.col("w") + F.coalesce("_w", F.lit(0))).alias("w"),
                F.greatest("b", F.col("_b") + F.col("w")).alias("b"),
            ),
            "jumps",
        )
    raise CycleError("nodes with one open parent form a cycle")


def _contract(links: DataFrame, consumed: list[DataFrame], counters: list[DataFrame]):
    """Edges, counters and hung nodes after chains of nodes with one open parent are taken out of the graph."""
    gone = reduce(DataFrame.unionByName, [c.select(F.col("n").alias("p")) for c in consumed])
    left = durable(links.join(gone, "p", "left_anti").select("p", "n", "w").distinct(), "edges")
    best = _latest(counters).groupBy("n").agg(F.max("best").alias("b"))
    open_ = left.groupBy("n").agg(F.count(F.lit(1)).alias("need"), F.min("p").alias("p"), F.min("w").alias("w"))
    single = open_.filter("need = 1").join(best, "n", "left")
    hung = _jump(single.select("n", "p", "w", "b"))
    up = hung.select(F.col("n").alias("p"), F.col("p").alias("_p"), F.col("w").alias("_w"), "b")
    rest = left.join(hung.select("n"), "n", "left_anti").join(up, "p", "left")
    rest = durable(
        rest.groupBy("n", F.coalesce("_p", "p").alias("p")).agg(
            F.max(F.col("w") + F.coalesce("_w", F.lit(0))).alias("w"), F.max(F.col("b") + F.col("w")).alias("b")
        ),
        "edges",
    )
    floor = rest.select("n", "b").unionByName(best.join(rest.select("n"), "n", "left_semi"))
    floor = floor.groupBy("n").agg(F.max("b").alias("best")).filter("best is not null")
    state = floor.select("n", F.lit(0).cast("long").alias("got"), "best", F.lit(0).cast("long").alias("need"))
    return _counted(rest.select("p", "n", "w")), [durable(state, "counters")], hung


def dependency_levels(
    nodes: DataFrame | None, edges: DataFrame, node: str = "node", parent: str = "depends_on", peel: int = 16
) -> DataFrame:
    """Longest path from the roots: level 0 has no parent, otherwise 1 + the highest level of the parents.

    Every node keeps a counter of the parents placed so far. A round looks only at the edges out of the nodes placed in
    the round before, adds to the counters of the nodes these reach, and places those whose counter is full; nothing
    else is written. Nodes that nothing depends on are left out of the rounds: when all others are placed, their edges are
    followed once. After ``peel`` rounds, and whenever their number has doubled since, chains of nodes with one open
    parent are taken out by pointer doubling and hung back at the end, so a long chain takes logarithmically many rounds
    instead of its length. Every round is written to the shared folder, which keeps the lineage flat and survives
    executor loss. Only edges whose ends are both nodes count; without ``nodes`` every end of an edge is one. Nodes that
    are never placed are a cycle.
    """
    names, every = _graph(nodes, edges, node, parent)
    links = every.filter("inner").drop("inner")
    level = F.lit(0).cast("long").alias("level")
    frontier = names.filter("need = 0 and children > 0").select("n", level)
    levels, hung, counters, consumed = [frontier], [], [], []
    inner, ready = names.agg(F.count_if(F.col("children") > 0), F.count_if(F.expr("need = 0 and children > 0"))).first()
    placed, rounds = ready, 0
    while ready and placed < inner:
        rounds += 1
        reached = _reach(links, frontier, counters)
        full = F.col("got") == F.col("need")
        ready, waiting = reached.agg(F.count_if(full), F.count_if(~full)).first()
        placed += ready
        consumed.append(frontier)
        if waiting:
            counters.append(reached.filter(~full))
        frontier = reached.filter(full).select("n", F.col("best").alias("level"))
        levels.append(frontier)
        if ready and placed < inner and rounds == peel:
            peel *= 2
            links, counters, taken = _contract(links, consumed, counters or [reached.limit(0)])
            hung.append(taken)
            placed += taken.count()
            consumed = []
    if placed < inner:
        raise CycleError(f"{inner} nodes with dependents, not all of which can be placed: the edges contain a cycle")
    out = reduce(DataFrame.unionByName, levels)
    for taken in reversed(hung):
        out = durable(out, "level")
        above = out.select(F.col("n").alias("p"), "level")
        level_below = F.greatest("b", F.col("level") + F.col("w"))
        out = out.unionByName(taken.join(above, "p").select("n", level_below.alias("level")))
    above = out.select(F.col("n").alias("p"), "level")
    outer = every.filter(~F.col("inner")).select("n", "p").join(above, "p")
    outer = outer.groupBy("n").agg((F.max("level") + 1).alias("level"))
    alone = names.filter("need = 0 and children = 0").select("n", level)
    out = out.unionByName(outer).unionByName(alone)
    out = out.select(F.col("n").alias(node), F.col("level").cast("int").alias("level"))
    # further node attributes come back in one join
    return out if nodes is None or nodes.columns == [node] else nodes.join(out, node)


def load_order(tables: DataFrame, edges: DataFrame) -> DataFrame:
    """Tables by level, priority and name. ``tables``: node, load_priority, table_name."""
    return dependency_levels(tables, edges).orderBy("level", "load_priority", "table_name")


# -- columns ------------------------------------------------------------------------------------------------------

_MARK = "_table_"
_CONSTANT = {"LocalRelation", "OneRowRelation", "Range"}


@dataclass(frozen=True)
class ColumnSource:
    """A column and one of the columns its values are made of.

    ``source_table`` is None where the plan reads something that isn't a marked table. ``copied``: the values are passed
    on as they are (renamed, cast, or with a constant for nulls), not computed.
    """

    table: str
    column: str
    source_table: str | None
    source_column: str
    copied: bool


def as_table(df: DataFrame, table: str) -> DataFrame:
    """``df``, known as a table to ``column_sources``; rows and columns stay the same."""
    return df.alias(_MARK + table)


def _seq(items) -> list:
    return [items.apply(i) for i in range(items.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _id(attribute) -> int:
    return attribute.exprId().id()


def _refs(expression) -> set[int]:
    return {_id(a) for a in _seq(expression.references().toSeq())}


def _copied(expression) -> bool:
    while _kind(expression) in ("Alias", "Cast"):
        expression = expression.child()
    if _kind(expression) == "Coalesce":
        values = [c for c in _seq(expression.children()) if _refs(c)]
        return len(values) == 1 and _copied(values[0])
    return _kind(expression) == "AttributeReference"


class _Trace:
    """What each attribute of a plan is made of: other attributes, or a column of a table."""

    def __init__(self) -> None:
        self.made: dict[int, list[tuple[int, bool]]] = {}
        self.ends: dict[int, tuple[str | None, str]] = {}

    def visit(self, plan) -> None:
        kind = _kind(plan)
        if kind == "SubqueryAlias" and plan.alias().startswith(_MARK):
            table = plan.alias().removeprefix(_MARK)
            self.ends.update({_id(a): (table, a.name()) for a in _seq(plan.output())})
            return
        children, inner = _seq(plan.children()), _seq(plan.subqueries())
        if not children and kind not in _CONSTANT:
            self.ends.update({_id(a): (None, a.name()) for a in _seq(plan.output())})
            return
        for child in (*children, *inner):
            self.visit(child)
        outputs = [[_id(a) for a in _seq(c.output())] for c in children]
        below = {i for ids in outputs for i in ids}
        if kind == "Union":
            for place, a in enumerate(_seq(plan.output())):
                self.made.setdefault(_id(a), []).extend((ids[place], True) for ids in outputs if ids[place] != _id(a))
            return
        looked_up = [(_id(a), False) for q in inner for a in _seq(q.output())]
        used = set()
        for expression in _seq(plan.expressions()):
            refs = _refs(expression)
            used |= refs
            if _kind(expression) == "Alias":
                copied = _copied(expression)
                self.made[_id(expression)] = [(r, copied) for r in refs] + looked_up
        for i in (_id(a) for a in _seq(plan.output())):
            if i not in below and i not in self.made:  # generators, Python functions over groups
                self.made[i] = [(r, False) for r in used - {i}] + looked_up

    def sources(self, attribute: int) -> Iterator[tuple[str | None, str, bool]]:
        open_, seen = [(attribute, True)], set()
        while open_:
            at = open_.pop()
            if at in seen:
                continue
            seen.add(at)
            i, copied = at
            if i in self.ends:
                yield (*self.ends[i], copied)
            open_ += [(j, copied and c) for j, c in self.made.get(i, [])]


def _merged(rows: Iterable[ColumnSource]) -> list[ColumnSource]:
    """Each pair of columns once; copied only if it is so on every path."""
    found: dict[tuple, bool] = {}
    for r in rows:
        key = (r.table, r.column, r.source_table, r.source_column)
        found[key] = found.get(key, True) and r.copied
    return [ColumnSource(*key, copied) for key, copied in found.items()]


def column_sources(table: str, df: DataFrame) -> list[ColumnSource]:
    """Where the values of each column of ``df`` come from, by the expressions of its analysed plan.

    Tables are the frames that went through ``as_table``. Renames, joins, unions, windows, aggregates and generated rows are
    followed; columns that only decide which rows there are (filters, join keys) are no sources. A member of a struct that
    is built in one expression has all the struct's columns as sources. Constants have none; what is read from anything
    else, as from a written intermediate result, has a source without a table. No data is read.
    """
    plan = df._jdf.queryExecution().analyzed()
    trace = _Trace()
    trace.visit(plan)
    return _merged(
        ColumnSource(table, a.name(), *source) for a in _seq(plan.output()) for source in trace.sources(_id(a))
    )


def close_sources(rows: Iterable[ColumnSource]) -> list[ColumnSource]:
    """The same columns with sources in derived tables replaced by these tables' own, down to tables that aren't derived.

    A derived column without sources (a constant, an assigned key) is the end of its path.
    """
    rows = list(rows)
    by_column: dict[tuple[str, str], list[ColumnSource]] = {}
    for r in rows:
        by_column.setdefault((r.table, r.column), []).append(r)

    def ends(r: ColumnSource, path: tuple) -> Iterator[ColumnSource]:
        source = (r.source_table, r.source_column)
        if source not in by_column or source in path:
            yield r
            return
        for s in by_column[source]:
            yield from ends(
                ColumnSource(r.table, r.column, s.source_table, s.source_column, r.copied and s.copied), (*path, source)
            )

    return _merged(end for r in rows for end in ends(r, ((r.table, r.column),)))


def sources_frame(spark: SparkSession, rows: Iterable[ColumnSource], run_id: str | None = None) -> DataFrame:
    """Lineage rows as a table of the run."""
    schema = (
        "pipeline_run_id string, target_table string, target_column string, source_table string, source_column string, "
        "copied boolean"
    )
    return spark.createDataFrame([(run_id, r.table, r.column, r.source_table, r.source_column, r.copied) for r in rows], schema)

"""Sources of columns, and the classes they hand on."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.governance import ColumnClass, apply_policy, inherited
from tidemark.operators.lineage import ColumnSource, as_table, close_sources, column_sources, sources_frame
from tidemark.plans.entities import ENTITIES
from tidemark.plans.origins import medallion_sources
from tidemark.sources.fixtures import Silver


@pytest.fixture
def people(spark):
    return as_table(spark.createDataFrame([], "id int, email string, first string, last string, team int, tags array<string>"), "people")


@pytest.fixture
def teams(spark):
    return as_table(spark.createDataFrame([], "team int, name string, budget double"), "teams")


def found(df, column):
    return {(r.source_table, r.source_column, r.copied) for r in column_sources("t", df) if r.column == column}


def test_renames_casts_and_defaults_are_copies(people):
    df = people.withColumnRenamed("email", "mail").select(
        F.col("mail").alias("m"), F.col("id").cast("long").alias("n"), F.coalesce("first", F.lit("?")).alias("f"),
        F.coalesce("first", "last").alias("either"), F.lower("last").alias("l"), F.lit(1).alias("one"),
    )
    assert found(df, "m") == {("people", "email", True)}
    assert found(df, "n") == {("people", "id", True)}
    assert found(df, "f") == {("people", "first", True)}
    assert found(df, "either") == {("people", "first", False), ("people", "last", False)}
    assert found(df, "l") == {("people", "last", False)}
    assert found(df, "one") == set()


def test_joins_keep_sides_apart_and_keys_are_no_sources(people, teams):
    df = people.join(teams, "team").select("email", F.col("name").alias("team_name"))
    assert found(df, "team_name") == {("teams", "name", True)}
    other = people.select(F.col("id").alias("boss"), F.col("email").alias("boss_email"))
    df = people.join(other, F.col("team") == F.col("boss")).filter("last > 'a'").select("email", "boss_email")
    assert found(df, "boss_email") == {("people", "email", True)}


def test_unions_windows_aggregates_generators(people, teams):
    both = people.select(F.col("email").alias("x")).union(teams.select("name"))
    assert found(both, "x") == {("people", "email", True), ("teams", "name", True)}
    twice = both.union(people.select(F.upper("email")))
    assert found(twice, "x") == {("people", "email", False), ("teams", "name", True)}
    ranked = people.withColumn("r", F.row_number().over(Window.partitionBy("team").orderBy("id")))
    assert found(ranked, "r") == {("people", "team", False), ("people", "id", False)}
    summed = teams.groupBy("team").agg(F.sum("budget").alias("b"), F.count(F.lit(1)).alias("n"))
    assert found(summed, "team") == {("teams", "team", True)}
    assert found(summed, "b") == {("teams", "budget", False)} and found(summed, "n") == set()
    assert found(people.select(F.explode("tags").alias("tag")), "tag") == {("people", "tags", False)}
    cube = teams.cube("team", "name").agg(F.max("budget").alias("b"))
    assert ("teams", "team") in {s[:2] for s in found(cube, "team")}


def test_functions_over_groups_and_scalar_subqueries(people, teams, spark):
    df = people.groupBy("team").applyInPandas(lambda f: f[["email"]], "e string")
    assert ("people", "email", False) in found(df, "e")
    people.createOrReplaceTempView("lineage_people")
    teams.createOrReplaceTempView("lineage_teams")
    df = spark.sql("SELECT email, (SELECT max(budget) FROM lineage_teams) AS top FROM lineage_people")
    assert found(df, "top") == {("teams", "budget", False)}


def test_a_written_result_is_an_unknown_source(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "x"))
    df = spark.read.parquet(str(tmp_path / "x"))
    assert found(df, "id") == {(None, "id", True)}
    rows = column_sources("t", df)
    assert sources_frame(spark, rows, "r").first().source_table is None
    with pytest.raises(ValueError, match="t.id needs a class"):
        inherited(rows)
    assert inherited(rows, (stated := ColumnClass("T", "ID", "Public"),)) == (stated,)


def source(table, column, origin, copied=True):
    return ColumnSource(table, column, *origin.split("."), copied)


def test_closing_sources():
    rows = [source("b", "x", "a.x"), source("c", "y", "b.x", False), source("c", "k", "b.key"), source("d", "d", "d.d"),
            source("d", "d", "a.x")]
    assert set(close_sources(rows)) == {
        source("b", "x", "a.x"), source("c", "y", "a.x", False), source("c", "k", "b.key"), source("d", "d", "d.d"),
        source("d", "d", "a.x"),
    }
    assert close_sources([]) == []


def test_classes_are_inherited(spark):
    policy = (
        ColumnClass("a", "mail", "Restricted_PII", "email_mask"), ColumnClass("a", "phone", "Restricted_PII", "phone_mask"),
        ColumnClass("a", "sum", "Confidential"), ColumnClass("a", "id", "Public"),
    )

    def classes(*rows, stated=()):
        return {(c.table, c.column): (c.tier, c.masking) for c in inherited(rows, policy + stated)[len(policy) + len(stated) :]}

    assert classes(source("c", "m", "B.MAIL"), source("b", "mail", "a.mail")) == {
        ("b", "mail"): ("Restricted_PII", "email_mask"), ("c", "m"): ("Restricted_PII", "email_mask")
    }
    assert classes(source("b", "x", "a.mail"), source("b", "x", "a.phone")) == {("b", "x"): ("Restricted_PII", "full_mask")}
    assert classes(source("b", "x", "a.sum", False), source("b", "x", "a.id")) == {("b", "x"): ("Confidential", None)}
    # an unclassified source may be worse than public, and a table that feeds itself adds nothing
    assert classes(source("b", "x", "a.id"), source("b", "x", "a.other")) == {}
    assert classes(source("b", "x", "b.x"), source("b", "x", "a.mail")) == {("b", "x"): ("Restricted_PII", "email_mask")}
    assert classes() == {}
    computed = source("b", "length", "a.mail", False)
    with pytest.raises(ValueError, match="b.length needs a class: it is computed from a.mail"):
        classes(computed)
    assert classes(computed, stated=(ColumnClass("b", "length", "Public"),)) == {}

    df = spark.createDataFrame([("jane@x.com", 1), (None, 2)], "m string, n int")
    shown = apply_policy(df, "c", [], inherited([source("c", "m", "a.mail")], policy))
    assert [tuple(r) for r in shown.collect()] == [("j***@x.com", 1), (None, 2)]


def test_the_run_from_bronze_to_marts(spark):
    raw = Silver(spark, "/root/testdata/sf0.001").raw
    direct = medallion_sources(spark, {name: getattr(raw, name)() for name in ENTITIES})
    assert not [r for r in direct if r.source_table is None]
    closed = {}
    for r in close_sources(direct):
        closed.setdefault((r.table, r.column), set()).add(f"{r.source_table}.{r.source_column}")
    assert closed["fact_sales", "dim_campaign_key"] == {
        "bronze_customer_registration_source.CHANNEL", "bronze_customer_registration_source.CAMPAIGN_ID",
        "dim_campaign.dim_campaign_key",
    }
    assert closed["vw_sales_dashboard", "customer_name"] == {"bronze_customers.FIRST_NAME", "bronze_customers.LAST_NAME"}
    masks = {(c.table, c.column): c.masking for c in inherited(direct) if c.masking}
    assert masks["vw_sales_dashboard", "customer_name"] == "full_mask"
    assert masks["dim_location", "postal_code"] == "string_mask"
    # a mart that computes something from a masked column has to state its class
    with pytest.raises(ValueError, match="mart.initials needs a class"):
        inherited([*direct, ColumnSource("mart", "initials", "vw_sales_dashboard", "customer_name", False)])

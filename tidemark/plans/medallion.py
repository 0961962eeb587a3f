"""The whole run: raw batches -> silver -> gold, written to a folder.

Every layer is stored before the next one reads it, so no lineage spans layers and nothing is computed twice. Dimension
tables get a new folder in each run that changes them. Silver tables keep versioned key buckets and facts versioned months; a
run reads and rewrites only those that its batch touches. Facts follow their batch and every change of the tables they are
looked up in (see ``impact``); aggregates follow the facts by signed deltas. After any run each table equals one that
is built anew from all of silver.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.operators.contracts import require_no_drift
from tidemark.operators.history import scd2
from tidemark.operators.joins import hot_keys
from tidemark.operators.latest import keep_latest
from tidemark.operators.merge import missing_keys, scd1, soft_delete
from tidemark.operators.rules import add_silver_metadata
from tidemark.operators.runlog import append_run
from tidemark.plans import aggregates, dims, facts, impact
from tidemark.plans.entities import ENTITIES, standardise
from tidemark.plans.quality_rules import GOLD_DQ, REFERENTIAL, SILVER_DQ
from tidemark.session import drop_scratch, durable, scratch_mark
from tidemark.sources.calendar import DEFAULT_END, DEFAULT_START, build_dim_date
from tidemark.streaming.jobs import BUCKET, refresh_fact, with_bucket
from tidemark.sources.sinks import append_table, write_table
from tidemark.sources.tables import is_empty
from tidemark.streaming.state import PartitionedState, touched_values

# The place of each stored table in the run log; new tables go to the end.
LOGGED = (
    *ENTITIES, "ri_warnings", "dim_customer", "dim_product", "dim_location", "dim_campaign", "dim_registration_source",
    "dim_date", "fact_sales", "fact_interactions", "fact_surveys", "agg_monthly_campaign_roi", "agg_customer_clv_metrics",
    "reconciliation", "state_campaign_measures", "state_customer_measures",
)
FACTS = {
    "fact_sales": ("line_id", "order_year_month"),
    "fact_interactions": ("interaction_id", "interaction_year_month"),
    "fact_surveys": ("survey_id", "response_year_month"),
}


def _store(df: DataFrame, path: str, **layout) -> DataFrame:
    write_table(df, path, **layout)
    # the known schema keeps partition column types and makes an empty table readable
    return df.sparkSession.read.schema(df.schema).parquet(path)


def silver_entity(
    name: str,
    bronze: DataFrame,
    state: PartitionedState,
    run_no: int,
    path: str,
    run_id: str,
    now: datetime,
    error_limit: float = 0.05,
    reload: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One entity: dedupe, standardise, check, merge. Returns (silver table, checked rows, deleted keys of this batch).

    With ``reload`` the batch is the whole table: stored keys that it doesn't have are deleted as well.

    Deletes carry no payload, so they skip the quality rules and only mark their key. A batch of which more than
    ``error_limit`` of the rows would be quarantined, whose keys are all null, or whose columns differ from the stored
    table's stops the run. Only the key buckets of the batch are read and written; a row older than the stored one is
    ignored.
    """
    entity = ENTITIES[name]
    keys = list(entity.keys)
    order = [c for c in ("_cdc_version", "LAST_UPDATE_DATE", "_ingest_timestamp") if c in bronze.columns][:1]
    tie = [c for c in bronze.columns if c not in (*order, *(k.upper() for k in keys))]
    latest = keep_latest(bronze, [k.upper() for k in keys], order, tie)
    rows = add_silver_metadata(standardise(name, latest), run_id, now)
    stored = state.read()
    if stored is not None:
        require_no_drift(rows, stored.drop(BUCKET, q.WARNED), name)
    checked = rows.filter(~F.col("_is_deleted")).transform(q.dq_check, SILVER_DQ[name])
    checked = checked.withColumn("quarantined", F.size(q.FAILED) > 0)
    # one pass writes both sides of the split
    staged = _store(checked, f"{path}/checked/{name}", partition_by=["quarantined"])
    q.enforce_threshold(q.quarantine_share(staged, keys[0]), error_limit)
    valid = staged.filter(~F.col("quarantined")).drop("quarantined", q.FAILED)
    gone = rows.filter("_is_deleted").select(*keys)
    if reload and stored is not None:
        gone = gone.unionByName(missing_keys(_current(stored), rows, keys))
    gone = _store(gone, f"{path}/deleted/{name}")
    if not state.committed(run_no):
        buckets = state.buckets(staged.count())
        changed = with_bucket(valid.select(*keys).unionByName(gone), keys, buckets)
        touched = touched_values(changed, BUCKET)
        target = state.read(touched)
        target = None if target is None else target.drop(BUCKET)
        if entity.scd == 2:
            merged = scd2(target, valid, keys, entity.tracked, "last_update_date", check_unique=False)
        else:
            merged = scd1(target, valid, keys, check_unique=False, version="last_update_date")
        if target is not None:
            merged = soft_delete(merged, gone, keys)
        state.write(with_bucket(merged, keys, buckets), touched or ["0"], run_no)
    return state.read().drop(BUCKET), staged, gone


def _current(df: DataFrame) -> DataFrame:
    out = df.filter(~F.coalesce("_is_deleted", F.lit(False)))
    return out.filter("_is_current") if "_is_current" in out.columns else out


def calendar_span(now_of: Mapping[str, DataFrame]) -> tuple[date, date]:
    """First and last day of the calendar: the default range, widened to every date of the facts' sources."""
    found = []
    for name, col in (("oe_order_headers_all", "order_date"), ("interactions", "interaction_date"), ("surveys", "response_date")):
        if name in now_of and col in now_of[name].columns:
            found.append(now_of[name].agg(F.min(col).cast("date"), F.max(col).cast("date")).first())
    days = [d for row in found for d in row if d is not None]
    return min([DEFAULT_START, *days]), max([DEFAULT_END, *days])


def run_medallion(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    path: str,
    run_no: int = 0,
    previous: Mapping[str, DataFrame] | None = None,
    now: datetime | None = None,
    calendar: tuple[date, date] | None = None,
    error_limit: float = 0.05,
    reload: Collection[str] = (),
    keep_runs: int | None = None,
) -> dict[str, DataFrame]:
    """Run all layers for one set of batches and return every stored table by name.

    ``previous`` is the result of the run before: history, surrogate keys and untouched rows come from it. Facts are
    built for the rows that this batch or a change of their lookups reaches and merged by their key; facts of deleted rows
    go. The batch of an entity named in ``reload`` is its whole table: other keys are deleted. Without ``calendar`` the
    date dimension covers every date there is. Each stored table gets a row in the run log; if the run fails, the table
    it was at gets one that says so. With ``keep_runs`` files that only runs before the last so many read are deleted.
    """
    now = now or datetime.now()
    run_id = f"run-{run_no}"
    out: dict[str, DataFrame] = {}
    log = f"{path.rstrip('/')}/run_log"
    mark = scratch_mark()
    try:
        _run_layers(spark, bronze, path, run_no, run_id, previous or {}, now, calendar, error_limit, reload, out)
    except Exception as error:
        at = next((i for i, name in enumerate(LOGGED) if name not in out and (name in bronze or name not in ENTITIES)), 0)
        append_run(spark, log, at, run_id, "FAILED", version=run_no, error=str(error)[:1000], ended_at=now)
        raise
    for name, df in out.items():
        append_run(
            spark, log, LOGGED.index(name), run_id, "SUCCESS", records=df.count(), version=run_no,
            mark_initial=run_no == 0, ended_at=now,
        )
    drop_scratch(spark, mark)  # every table in ``out`` reads from ``path``
    if keep_runs is not None:
        states = [_silver_state(spark, path, n) for n in ENTITIES] + [_fact_state(spark, path, n) for n in FACTS]
        for state in states:
            state.prune(run_no - keep_runs + 1)
    return out


def _silver_state(spark: SparkSession, path: str, name: str) -> PartitionedState:
    entity = ENTITIES[name]
    return PartitionedState(spark, f"{path.rstrip('/')}/silver/{name}", BUCKET, (*entity.partition_by, *entity.cluster_by))


def _fact_state(spark: SparkSession, path: str, name: str) -> PartitionedState:
    return PartitionedState(spark, f"{path.rstrip('/')}/facts/{name}", FACTS[name][1])


def _run_layers(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    path: str,
    run_no: int,
    run_id: str,
    previous: Mapping[str, DataFrame],
    now: datetime,
    calendar: tuple[date, date] | None,
    error_limit: float,
    reload: Collection[str],
    out: dict[str, DataFrame],
) -> None:
    """Fill ``out`` with the stored tables, in the order in which they are built."""
    root = f"{path.rstrip('/')}/{run_id}"
    batch_keys: dict[str, DataFrame] = {}
    deleted: dict[str, DataFrame] = {}

    for name in ENTITIES:
        if name not in bronze or (name in previous and name not in reload and is_empty(bronze[name])):
            # no batch: the stored table stays as it is
            if name in previous:
                out[name] = previous[name]
            continue
        state = _silver_state(spark, path, name)
        out[name], staged, deleted[name] = silver_entity(
            name, bronze[name], state, run_no, root, run_id, now, error_limit, name in reload
        )
        batch_keys[name] = staged.filter(~F.col("quarantined"))
        bad = staged.filter("quarantined").drop("quarantined")
        append_table(q.dlq_rows(bad, SILVER_DQ[name], run_id, name, now), f"{path}/dead_letters")
        tagged = staged.filter(~F.col("quarantined")).drop("quarantined")
        append_table(q.dlq_rows(tagged, SILVER_DQ[name], run_id, name, now, q.WARNED), f"{path}/dead_letters")
    changed = batch_keys.keys()
    warnings = None
    for rule_id, child, key, parent, parent_key in REFERENTIAL:
        if child in out and parent in out:
            part = q.ri_violation_count(out[child], out[parent], key, rule_id, parent_key)
            warnings = part if warnings is None else warnings.unionByName(part)
    if warnings is not None:
        out["ri_warnings"] = _store(warnings, f"{root}/ri_warnings")

    now_of = {n: _current(df) for n, df in out.items() if n in ENTITIES}
    was_of = {n: _current(previous[n]) for n in ENTITIES if n in previous}
    _build_dims(spark, root, run_id, now, previous, out, now_of, changed, calendar)

    bound = facts.version_bound(out["dim_customer"]) if "dim_customer" in out else None
    # customers whose versions differ from the last run's, with the moment from which they do
    moved = None
    if "dim_customer" in out and "dim_customer" in previous and "customers" in changed:
        members = (t["dim_customer"].filter("dim_customer_key > 0") for t in (previous, out))
        moved = durable(impact.changed_since(*members, "customer_id", "dim_customer_key"), "moved-customers")
    touched = _refresh_sales(spark, path, run_no, run_id, now, previous, out, now_of, was_of, batch_keys, deleted, moved, bound)
    _refresh_interactions(spark, path, run_no, run_id, now, previous, out, now_of, was_of, batch_keys, deleted, moved, bound)
    _refresh_surveys(spark, path, run_no, run_id, now, previous, out, now_of, batch_keys, deleted, moved, bound)

    if "fact_sales" in out:
        _refresh_aggregates(root, previous, out, now_of, touched)


def _build_dims(spark, root, run_id, now, previous, out, now_of, changed, calendar) -> None:
    gone = None
    if "customers" in out:
        gone = out["customers"].filter("_is_deleted").select("customer_id").distinct()
        gone = gone.join(now_of["customers"].select("customer_id"), "customer_id", "left_anti")
    builders = {
        "dim_customer": (("customers",), lambda t, s: dims.build_dim_customer(t, s, run_id, now, gone)),
        "dim_product": (
            ("mtl_system_items_b", "categories", "brands"), lambda t, *s: dims.build_dim_product(t, *s, run_id, now)
        ),
        "dim_location": (("addresses", "city_tier_master"), lambda t, *s: dims.build_dim_location(t, *s, run_id, now)),
        "dim_campaign": (("marketing_campaigns",), lambda t, s: dims.build_dim_campaign(t, s, run_id, now)),
        "dim_registration_source": (
            ("customer_registration_source",), lambda t, s: dims.build_dim_registration_source(t, s, run_id, now)
        ),
    }
    for name, (sources, build) in builders.items():
        if name in previous and not changed & set(sources):
            out[name] = previous[name]
        elif now_of.keys() >= set(sources):
            out[name] = _store(build(previous.get(name), *(now_of[s] for s in sources)), f"{root}/gold/{name}")
        elif name in previous:
            out[name] = previous[name]
    out["dim_date"] = build_dim_date(spark, *(calendar or calendar_span(now_of)))


def _refresh_sales(spark, path, run_no, run_id, now, previous, out, now_of, was_of, batch_keys, deleted, moved, bound):
    """Bring fact_sales up to date, or take it over where nothing it depends on has changed.

    Returns the order numbers of all rows that came, went or may have changed; None if the table is as before.
    """
    name, headers, lines, crs = "fact_sales", "oe_order_headers_all", "oe_order_lines_all", "customer_registration_source"
    if not ({headers, lines, crs} <= now_of.keys() and {"dim_customer", "dim_product", "dim_location", "dim_campaign"} <= out.keys()):
        _take_over(name, previous, out)
        return
    if name not in previous:  # the first build covers every order
        parts = [out[lines].select("order_id")]
    else:
        parts = [batch_keys[n].select("order_id") for n in (headers, lines) if n in batch_keys]
        if headers in deleted:
            parts.append(deleted[headers].select("order_id"))
        if lines in deleted:
            parts.append(out[lines].join(deleted[lines], "line_id", "left_semi").select("order_id"))
        if lines in batch_keys and lines in was_of:  # a line may have left its order
            parts.append(impact.rows_of_keys(was_of[lines], batch_keys[lines], "line_id").select("order_id"))
        attributed = None
        if {crs, "marketing_campaigns"} & batch_keys.keys():
            answers = (facts.campaign_attribution(s[crs], d["dim_campaign"]) for s, d in ((was_of, previous), (now_of, out)))
            attributed = impact.changed_keys(*answers, "customer_id", ["dim_campaign_key"])
        places, products = (
            impact.changed_keys(previous[d], out[d], key, [f"{d}_key"]) if sources & batch_keys.keys() else None
            for d, key, sources in (
                ("dim_location", "address_id", {"addresses", "city_tier_master"}),
                ("dim_product", "inventory_item_id", {"mtl_system_items_b", "categories", "brands"}),
            )
        )
        parts += impact.sales_orders(now_of[headers], now_of[lines], moved, attributed, places, products)
    orders = impact.union_keys(parts, "order_id")
    if orders is None:
        _take_over(name, previous, out)
        return
    orders = durable(orders, "orders")
    # only these orders and their lines go through the lookups
    their_headers = durable(now_of[headers].join(orders, "order_id", "left_semi"), "order-headers")
    their_lines = durable(out[lines].join(orders, "order_id", "left_semi"), "order-lines")
    live = _current(their_lines)
    rows = facts.build_fact_sales(
        live, their_headers, out, now_of[crs], run_id, now, bound,
        hot_keys(their_headers, "customer_id"), hot_keys(live, "product_id"),
    )
    rows = durable(rows, name)
    # lines of these orders that no longer give a fact: deleted, or their order is, or they are rejected now
    stale = their_lines.select("line_id").join(rows.select("line_id"), "line_id", "left_anti")
    _log_rejects(live, name, run_id, now, path)
    out[name] = _refresh(spark, path, name, rows, run_no, stale)
    numbers = rows.select("order_number")
    if name in previous:
        old = previous[name].join(their_lines.select("line_id"), "line_id", "left_semi")
        numbers = numbers.unionByName(old.select("order_number"))
    return durable(numbers.distinct(), "order-numbers")


def _refresh_interactions(
    spark, path, run_no, run_id, now, previous, out, now_of, was_of, batch_keys, deleted, moved, bound
) -> None:
    name = "fact_interactions"
    if not ({"interactions", "incidents"} <= now_of.keys() and "dim_customer" in out):
        _take_over(name, previous, out)
        return
    if name not in previous:
        parts = [out["interactions"].select("interaction_id")]
    else:
        parts = [frames["interactions"].select("interaction_id") for frames in (batch_keys, deleted) if "interactions" in frames]
        incidents = None
        if "incidents" in batch_keys:
            incidents = impact.changed_keys(
                was_of["incidents"], now_of["incidents"], "incident_id", ["customer_id", "status", "priority"]
            )
        parts += impact.interactions_of(now_of["interactions"], now_of["incidents"], incidents, moved)
    wanted = impact.union_keys(parts, "interaction_id")
    if wanted is None:
        _take_over(name, previous, out)
        return
    wanted = durable(wanted, "interactions")
    theirs = now_of["interactions"].join(wanted, "interaction_id", "left_semi")
    rows = durable(facts.build_fact_interactions(theirs, now_of["incidents"], out["dim_customer"], run_id, now, bound), name)
    stale = wanted.join(rows.select("interaction_id"), "interaction_id", "left_anti")
    _log_rejects(theirs, name, run_id, now, path)
    out[name] = _refresh(spark, path, name, rows, run_no, stale)


def _refresh_surveys(spark, path, run_no, run_id, now, previous, out, now_of, batch_keys, deleted, moved, bound) -> None:
    name = "fact_surveys"
    if not ("surveys" in now_of and "dim_customer" in out):
        _take_over(name, previous, out)
        return
    if name not in previous:
        parts = [out["surveys"].select("survey_id")]
    else:
        parts = [frames["surveys"].select("survey_id") for frames in (batch_keys, deleted) if "surveys" in frames]
        if moved is not None:
            parts.append(impact.rows_since(now_of["surveys"], moved, "customer_id", "response_date").select("survey_id"))
    wanted = impact.union_keys(parts, "survey_id")
    if wanted is None:
        _take_over(name, previous, out)
        return
    wanted = durable(wanted, "surveys")
    theirs = now_of["surveys"].join(wanted, "survey_id", "left_semi")
    rows = durable(facts.build_fact_surveys(theirs, out["dim_customer"], run_id, now, bound), name)
    stale = wanted.join(rows.select("survey_id"), "survey_id", "left_anti")
    _log_rejects(theirs, name, run_id, now, path)
    out[name] = _refresh(spark, path, name, rows, run_no, stale)


def _refresh_aggregates(root: str, previous, out, now_of, touched: DataFrame | None) -> None:
    """Measures follow the sales facts by deltas; names, spend and status are joined to them anew.

    ``touched`` has the numbers of the orders whose facts may have changed: an order counts once in its group, so all its
    rows are taken off and put on again.
    """
    sales, days = out["fact_sales"], out["dim_date"]
    campaigns, customers = "state_campaign_measures", "state_customer_measures"
    if not {"fact_sales", campaigns, customers} <= previous.keys():
        measures = {campaigns: aggregates.campaign_measures(sales, days), customers: aggregates.customer_measures(sales, days)}
    elif touched is None:
        measures = {}
        out[campaigns], out[customers] = previous[campaigns], previous[customers]
    else:
        facts_of = (previous["fact_sales"], sales)
        before, after = (durable(aggregates.touched_facts(f, touched), "touched-facts") for f in facts_of)
        measures = {
            campaigns: aggregates.follow_campaigns(previous[campaigns], before, after, days),
            customers: aggregates.follow_customers(previous[customers], before, after, sales, days),
        }
    for name, df in measures.items():
        out[name] = _store(df, f"{root}/gold/{name}")
    if "marketing_campaigns" in now_of:
        roi = aggregates.finish_campaign_roi(out[campaigns], out["dim_campaign"], now_of["marketing_campaigns"])
        out["agg_monthly_campaign_roi"] = _store(roi, f"{root}/gold/agg_monthly_campaign_roi")
        out["reconciliation"] = _store(
            q.reconcile_sum(out["agg_monthly_campaign_roi"], "total_revenue", sales, "line_total"),
            f"{root}/gold/reconciliation",
        )
    clv = aggregates.finish_customer_clv(out[customers], out["dim_customer"])
    out["agg_customer_clv_metrics"] = _store(clv, f"{root}/gold/agg_customer_clv_metrics")


def _take_over(name: str, previous: Mapping[str, DataFrame], out: dict[str, DataFrame]) -> None:
    if name in previous:
        out[name] = previous[name]


def _log_rejects(rows: DataFrame, name: str, run_id: str, now: datetime, path: str) -> None:
    """Rows that the gold rules keep out of a fact, in the dead-letter log."""
    _, rejected = q.dq_split(rows, GOLD_DQ[name])
    append_table(q.dlq_rows(rejected, GOLD_DQ[name], run_id, name, now), f"{path}/dead_letters")


def _refresh(
    spark: SparkSession, path: str, name: str, rows: DataFrame, run_no: int, deleted: DataFrame | None = None
) -> DataFrame:
    state = _fact_state(spark, path, name)
    if not state.committed(run_no):
        refresh_fact(state, FACTS[name][0], rows, run_no, deleted)
    stored = state.read()
    return spark.createDataFrame([], rows.schema) if stored is None else stored

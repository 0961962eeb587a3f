"""Gold tables over one test-data folder, staged once per session as a real run would store them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.governance import ColumnClass, inherited
from tidemark.plans import aggregates, dims, facts
from tidemark.plans.entities import ENTITIES, standardise
from tidemark.plans.origins import medallion_sources
from tidemark.session import drop_table, durable, last_staged, parts_for, tune
from tidemark.sources.fixtures import CALENDAR, Silver
from tidemark.sources.calendar import build_dim_date

LINES, SLICE = "oe_order_lines_all", "_slice"
DIM_NAMES = ("dim_customer", "dim_product", "dim_location", "dim_campaign", "dim_registration_source")
_models: dict[tuple[str, str], "Gold"] = {}


class Gold:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.silver = Silver(spark, sf_dir)
        self.raw = self.silver.raw
        self._staged: dict[str, DataFrame] = {}
        self._folders: dict[str, str] = {}

    def _stage(self, name: str, build, partition_by: Sequence[str] = ()) -> DataFrame:
        if name not in self._staged:
            self._staged[name] = durable(build(), name, partition_by)
            self._folders[name] = last_staged()
        return self._staged[name]

    def unstage(self, name: str) -> None:
        """Give a table's disk back; whoever needs it again builds it anew."""
        if self._staged.pop(name, None) is not None:
            drop_table(self.spark, self._folders.pop(name))

    # -- inputs --------------------------------------------------------------------------------------------
    def customers_v2(self) -> DataFrame:
        return standardise("customers", self.raw.customers_change()).filter("customer_id is not null")

    @cached_property
    def order_slices(self) -> int:
        """In how many slices of the orders the sales facts of this folder are built."""
        return parts_for(self.raw.table("lineitem").count())

    def stored_lines(self) -> DataFrame:
        """Silver order lines as a table, for work that reads them several times: they are deduplicated once.

        Each slice of the orders has its own folder, so that it can be read alone.
        """
        return self._stage(LINES, lambda: self.silver(LINES).withColumn(SLICE, self._slice()), [SLICE])

    def _slice(self) -> Column:
        return F.pmod(F.xxhash64(F.col("order_id").cast("long")), F.lit(self.order_slices)).cast("int")

    def in_slices(self, headers: DataFrame, orders: DataFrame | None = None) -> Iterator[tuple[DataFrame, DataFrame]]:
        """The given headers and the stored lines of each slice of the orders, or of some of the orders only."""
        lines, place = self.stored_lines(), self._slice()
        for i in range(self.order_slices):
            sides = headers.filter(place == i), lines.filter(F.col(SLICE) == i).drop(SLICE)
            if orders is not None:
                wanted = orders.filter(place == i)
                sides = tuple(rows.join(wanted, "order_id", "left_semi") for rows in sides)
            yield sides

    # -- dimensions ----------------------------------------------------------------------------------------
    def build_dim(self, name: str) -> DataFrame:
        s = self.silver
        if name == "dim_customer_first":
            return dims.build_dim_customer(None, s("customers"))
        if name == "dim_customer":
            return dims.build_dim_customer(self.dim("dim_customer_first"), self.customers_v2())
        if name == "dim_product":
            return dims.build_dim_product(None, s("mtl_system_items_b"), s("categories"), s("brands"))
        if name == "dim_location":
            return dims.build_dim_location(None, s("addresses"), s("city_tier_master"))
        if name == "dim_campaign":
            return dims.build_dim_campaign(None, s("marketing_campaigns"))
        if name == "dim_registration_source":
            return dims.build_dim_registration_source(None, s("customer_registration_source"))
        raise KeyError(name)

    def dim(self, name: str) -> DataFrame:
        if name == "dim_date":
            return build_dim_date(self.spark, *CALENDAR)
        return self._stage(name, lambda: self.build_dim(name))

    def dims(self) -> dict[str, DataFrame]:
        return {n: self.dim(n) for n in ("dim_date", *DIM_NAMES)}

    # -- facts ---------------------------------------------------------------------------------------------
    def build_fact(self, name: str, measured: bool = True) -> DataFrame:
        """``measured``: take the number of versions per customer from the stored dimension."""
        s = self.silver
        bound = facts.version_bound(self.dim("dim_customer")) if measured else None
        if name == "fact_sales":
            return facts.build_fact_sales(
                s("oe_order_lines_all"), s("oe_order_headers_all"), self.dims(), s("customer_registration_source"),
                versions_per_key=bound,
            )
        if name == "fact_interactions":
            return facts.build_fact_interactions(
                s("interactions"), s("incidents"), self.dim("dim_customer"), versions_per_key=bound
            )
        if name == "fact_surveys":
            return facts.build_fact_surveys(s("surveys"), self.dim("dim_customer"), versions_per_key=bound)
        raise KeyError(name)

    def fact(self, name: str) -> DataFrame:
        return self._stage(name, lambda: self.build_fact(name))

    # -- classes -------------------------------------------------------------------------------------------
    @cached_property
    def policy(self) -> tuple[ColumnClass, ...]:
        """The stated classes, and those that gold columns have by their lineage."""
        return inherited(medallion_sources(self.spark, {name: getattr(self.raw, name)() for name in ENTITIES}))

    # -- aggregates ----------------------------------------------------------------------------------------
    def roi(self) -> DataFrame:
        return aggregates.campaign_roi(
            self.fact("fact_sales"), self.dim("dim_date"), self.dim("dim_campaign"), self.silver("marketing_campaigns")
        )

    def clv(self) -> DataFrame:
        return aggregates.customer_clv(self.fact("fact_sales"), self.dim("dim_customer"), self.dim("dim_date"))

    def clv_by_customer(self) -> DataFrame:
        return aggregates.customer_clv_by_customer(
            self.fact("fact_sales"), self.dim("dim_customer"), self.dim("dim_date")
        )


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        _models[key] = Gold(spark, sf_dir)
    return _models[key]


def plain(df: DataFrame) -> DataFrame:
    """Comparable output: decimals as DOUBLE, timestamps as text, booleans as INT."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "timestamp":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "boolean":
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def r4(col) -> Column:
    """Ratio rounded half up to four digits (decimals before they become DOUBLE)."""
    return F.round(F.col(col) if isinstance(col, str) else col, 4).cast("double")

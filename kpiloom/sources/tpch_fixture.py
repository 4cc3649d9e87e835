"""Derive the four raw KPI sources from the driver's TPC-H-style tables.

No input data comes with the models, so FIXTURES.md §2 defines the inputs as rules over
``customer``, ``orders``, ``lineitem`` and ``nation``.  Every order and every
line takes part, and groups follow the number of customers, so all four tables
grow with the scale factor.  Everything here is a declarative DataFrame plan:
lineitem joins orders and customers in inner joins (AQE splits a skewed key)
and is then aggregated, map-side first; orders are aggregated to (customer,
year) before the claims join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.session import store
from kpiloom.sources.raw import RawTables

# --- fixed values of the fixture rules (FIXTURES.md §2) ---------------------
REGIONS = 7                     # groups per block of customers
BLOCK_CUSTOMERS = 1000          # customer keys per block
SEGMENT_PLANS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # plan 1..5
MAX_REFERENCE_PLAN = 4          # plans 1..4 are in the reference table; 5 is orphan
UNUSED_PLAN_ID = 6
UNUSED_PLAN_GROUP = 0
UNUSED_PLAN_NAME = " UNUSED "
SHIFT_MONTHS = 312              # 26 years: 1995..2001 -> 2021..2027
UNDATED_YEAR = 1998             # a customer without an order in this year also has an undated claim
# ---------------------------------------------------------------------------


def _shift(day: Column) -> Column:
    return F.add_months(day, SHIFT_MONTHS)


def plan_of_segment(segment: Column) -> Column:
    """Plan id 1..5 for the five market segments (null otherwise)."""
    expr = None
    for i, name in enumerate(SEGMENT_PLANS, start=1):
        expr = (F.when(segment == name, F.lit(i)) if expr is None else expr.when(segment == name, F.lit(i)))
    return expr.cast("long")


def _customers(tables: dict[str, DataFrame]) -> DataFrame:
    block = F.expr(f"c_custkey div {BLOCK_CUSTOMERS}")
    return tables["customer"].select(
        F.col("c_custkey").alias("custkey"),
        (block * REGIONS + F.col("c_nationkey") % REGIONS).cast("long").alias("g"),
        plan_of_segment(F.col("c_mktsegment")).alias("p"),
        F.col("c_mktsegment").alias("segment"),
    )


def plan_medical_group(tables: dict[str, DataFrame]) -> DataFrame:
    # nation is a fixed 25-row table, so broadcasting it is size-bounded.
    nations = F.broadcast(tables["nation"].select(F.col("n_nationkey").cast("long").alias("r"), "n_name"))
    pairs = (_customers(tables).filter(F.col("p") <= MAX_REFERENCE_PLAN)
             .select("p", "g", "segment").distinct()
             .select(F.col("p").alias("plan_id"), "g", F.concat(F.lit("  "), F.col("segment"), F.lit(" ")).alias("plan_name")))
    unused = (tables["nation"].filter(F.col("n_nationkey") == UNUSED_PLAN_GROUP)
              .select(F.lit(UNUSED_PLAN_ID).cast("long").alias("plan_id"), F.col("n_nationkey").cast("long").alias("g"),
                      F.lit(UNUSED_PLAN_NAME).alias("plan_name")))
    return (pairs.unionByName(unused).withColumn("r", F.col("g") % REGIONS).join(nations, "r").select(
        "plan_id",
        F.col("g").alias("medical_group_id"),
        "plan_name",
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" "), F.col("g").cast("string"), F.lit("  ")).alias("medical_group_name"),
    ))


def claims(tables: dict[str, DataFrame]) -> DataFrame:
    """One claim row per customer and year with an order (its first order date there, shifted), and an
    undated one for every customer without an order in ``UNDATED_YEAR``."""
    yearly = (tables["orders"].select("o_custkey", F.to_date("o_orderdate").alias("d"))
              .groupBy("o_custkey", F.year("d").alias("y")).agg(F.min("d").alias("d")))
    # a few rows per customer: the years, plus a null if the year is missing
    dates = yearly.groupBy("o_custkey").agg(
        F.collect_list("d").alias("ds"), F.max(F.col("y") == UNDATED_YEAR).alias("seen"))
    cust = _customers(tables)
    undated = F.array(F.lit(None).cast("date"))
    each = F.when(F.col("seen"), F.col("ds")).otherwise(F.concat(F.coalesce("ds", F.array().cast("array<date>")), undated))
    return (cust.join(dates, cust["custkey"] == dates["o_custkey"], "left")
            .select("custkey", "g", "p", F.explode(each).alias("d")).select(
        _shift(F.col("d")).alias("awv_date_of_service"),
        F.col("g").alias("medical_group_id"),
        F.col("custkey").alias("patient_id"),
        F.col("p").alias("plan_id"),
    ))


def line_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """All lines aggregated to (g, p, day, flag) -> n.

    orders join customers on the customer key first, so that the lines, the
    largest table, are joined once, on the order key; both are inner joins, so AQE
    splits a skewed key (a customer with a large share of the orders).  The
    aggregate combines map-side before its shuffle.
    """
    lines = tables["lineitem"].select("l_orderkey", F.to_date("l_shipdate").alias("day"), F.col("l_returnflag").alias("flag"))
    orders = tables["orders"].select("o_orderkey", "o_custkey")
    cust = _customers(tables).select("custkey", "g", "p")
    owned = orders.join(cust, orders["o_custkey"] == cust["custkey"]).select("o_orderkey", "g", "p")
    joined = lines.join(owned, lines["l_orderkey"] == owned["o_orderkey"])
    return (joined.groupBy("g", "p", _shift(F.col("day")).alias("day"), "flag")
            .agg(F.count(F.lit(1)).alias("n")))


def actions_attested(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("flag") == "R").select(
        F.col("p").alias("plan_id"),
        F.col("g").alias("medical_group_id"),
        F.col("day").alias("date_day"),
        F.col("n").alias("count_actions_attested_as_complete"),
    )


def actions_available(counts: DataFrame) -> DataFrame:
    """Inventory snapshot on every day with an 'N' or 'A' line: base + running sum of the days' deltas.

    A window partition is one (g, p) and holds at most one row per calendar day.
    The sum by day comes first: its order serves the total over the pair too.
    """
    region = F.col("g") % REGIONS
    daily = (counts.filter(F.col("flag").isin("N", "A")).groupBy("g", "p", "day").agg(
        F.sum(F.when(F.col("flag") == "N", F.col("n")).otherwise(0)).alias("new"),
        F.sum(F.when(F.col("flag") == "A", F.col("n")).otherwise(0)).alias("kept")))
    pair = Window.partitionBy("g", "p")
    so_far = pair.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.expr("2 * n_new * (101 + 40 * (g % 7)) div 100")
    delta = F.col("kept") * (region % 2) - 2 * F.col("new")
    snap = (daily.select("g", "p", "day", "new", F.sum(delta).over(so_far).alias("moved"))
            .select("g", "p", "day", "moved", F.sum("new").over(pair).alias("n_new")))
    return snap.select(
        F.col("p").alias("plan_id"),
        F.col("g").alias("medical_group_id"),
        F.col("day").alias("date_day"),
        (base + F.col("moved")).cast("long").alias("count_actions_available"),
    )


# Columns the fixture rules read; an explicit read schema skips Parquet schema
# inference and prunes every other column at the scan.
TPCH_SCHEMAS: dict[str, str] = {
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_returnflag string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string",
}


def load_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.schema(schema).parquet(f"{sf_dir}/{t}.parquet") for t, schema in TPCH_SCHEMAS.items()}


class TpchRawSource:
    """The four raw tables of FIXTURES.md §2, each derived on first use.

    Both action tables read the line aggregate; the optimizer rewrites each copy
    differently, so it is written once as Parquet under the shared checkpoint
    folder (which also cuts its lineage).  The other raw tables stay lazy.
    Nothing is shared between source objects.
    """

    columnar = False          # derived: every re-read re-runs the derivation

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.tpch = load_tpch(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def line_counts(self) -> DataFrame:
        return self._get("line_counts", lambda: store(line_counts(self.tpch)))

    @property
    def plan_medical_group(self) -> DataFrame:
        return self._get("plan_medical_group", lambda: plan_medical_group(self.tpch))

    @property
    def claims(self) -> DataFrame:
        return self._get("claims", lambda: claims(self.tpch))

    @property
    def actions_available(self) -> DataFrame:
        return self._get("actions_available", lambda: actions_available(self.line_counts))

    @property
    def actions_attested(self) -> DataFrame:
        return self._get("actions_attested", lambda: actions_attested(self.line_counts))

    def tables(self) -> tuple[DataFrame, ...]:
        return (self.plan_medical_group, self.claims, self.actions_available, self.actions_attested)

    def to_raw_tables(self) -> RawTables:
        return RawTables(*self.tables())


def derive_raw(spark: SparkSession, sf_dir: str) -> TpchRawSource:
    """The four raw tables of FIXTURES.md §2 (lazily derived, see TpchRawSource)."""
    return TpchRawSource(spark, sf_dir)

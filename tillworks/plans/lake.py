"""The full-snapshot lakehouse: every layer table, built from one folder of source tables.

One batch holds all days. A table is built when it is first asked for, written to the shared
scratch folder, and read back from there by everything that depends on it, as the layers of a
lakehouse are. Tables belong to the running application and are never shared with another one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import UTC, datetime
from functools import partial
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillworks.functions.rowops import batch_id, record_hash, week_of_day
from tillworks.operators.dedup import latest_in_place
from tillworks.operators.lookup import packed_keys
from tillworks.operators.merge import merge_dimension
from tillworks.plans import analytics, bronze, control, dims, facts, marts, quality, silver, views
from tillworks.plans.batch import Warehouse, next_batch, run_batch
from tillworks.schema import BRONZE_TABLE, CONTROL, SOURCES, SURROGATE_KEY, conform, source_columns
from tillworks.session import at_the_same_time, materialise, scratch_path
from tillworks.sources import csvfiles, derived as derivations
from tillworks.sources.derived import DERIVED, FIRST_ORDER_DATE
from tillworks.sources.landing import land

# Layers in load order; the tables of one layer do not depend on each other.
LAYERS = ("bronze.", "silver.", "dwh.dim_", "dwh.fact_", "dm_marketing.")
_NEED_EVERYTHING = ("audit.", "control.")

SNAPSHOT = "RM_SNAPSHOT"
_DQ_LOG = "audit.data_quality_log"
PROCESS_DATE = "2024-01-01"


class Lake:
    """Layer tables by qualified name, e.g. lake["dwh.fact_sales_transaction"]."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.views = set(_VIEWS)
        self._tables: dict[str, DataFrame] = {}
        self._csv: dict[str, str] = {}
        self._landing: str | None = None
        self._two_days: Warehouse | None = None
        self._packed: dict[str, DataFrame | None] = {}
        # made before any thread asks for one
        names = [*_BUILDERS, *[f"csv.{s}" for s in SOURCES], *[f"packed.{d}" for d in SURROGATE_KEY], "landing", "two days"]
        self._locks: dict[str, RLock] = {name: RLock() for name in names}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._tables:
                if name.startswith(_NEED_EVERYTHING):
                    for layer in LAYERS:
                        self.build(layer)
                built = _BUILDERS[name](self)
                self._tables[name] = built if name in self.views else materialise(built, name, derived=_derived(name))
        return self._tables[name]

    def has(self, name: str) -> bool:
        """Whether the table has been built already."""
        return name in self._tables

    def build(self, layer: str) -> None:
        """Build a layer's tables at the same time."""
        at_the_same_time([partial(self.__getitem__, n) for n in _BUILDERS if n.startswith(layer)])

    def source(self, name: str) -> DataFrame:
        return DERIVED[name](self.spark, self.folder)

    def _delivered(self, name: str) -> DataFrame:
        """The rows of the source. Sales lines and weekly promotions are read from where they are stored, if they are
        already, and not joined with their orders and grouped again."""
        stored = {"transaction_data": "source.lines", "causal_data": "bronze.causal_data_raw"}.get(name)
        return self[stored] if stored and self.has(stored) else self.source(name)

    def csv(self, name: str) -> str:
        """Path of the source as a folder of CSV files."""
        with self._locks[f"csv.{name}"]:
            if name not in self._csv:
                path = scratch_path(self.spark, f"csv.{name}")
                csvfiles.write_csv(self._delivered(name), path, name)
                self._csv[name] = path
        return self._csv[name]

    def landing(self) -> str:
        """The landing store, filled from the sources as CSV files."""
        with self._locks["landing"]:
            if self._landing is None:
                store = scratch_path(self.spark, "landing")
                at_the_same_time([partial(land, self.spark, self.csv(name), store, name) for name in SOURCES])
                self._landing = store
        return self._landing

    def two_days(self) -> Warehouse:
        """A warehouse in which the first two source days were planned and run one after the other."""
        with self._locks["two days"]:
            if self._two_days is None:
                warehouse = Warehouse(self.spark, scratch_path(self.spark, "warehouse"))
                for _ in range(2):
                    run_batch(warehouse, self.landing(), next_batch(warehouse, self.landing(), PROCESS_DATE))
                self._two_days = warehouse
        return self._two_days

    def dims(self, names: Iterable[str] = SURROGATE_KEY) -> dict[str, DataFrame]:
        return {name: self[f"dwh.{name}"] for name in names}

    def packed(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Of these dimensions, the keys of those that can be packed."""
        for name in names:
            with self._locks[f"packed.{name}"]:
                if name not in self._packed:
                    self._packed[name] = packed_keys(self[f"dwh.{name}"], name)
        return {name: df for name in names if (df := self._packed[name]) is not None}

    def layer(self, prefix: str) -> dict[str, DataFrame]:
        return {name: self[name] for name in _BUILDERS if name.startswith(prefix + ".")}


def _bronze(source: str) -> Callable[[Lake], DataFrame]:
    return lambda lake: bronze.to_bronze(lake.source(source), source, SNAPSHOT, PROCESS_DATE)


def _source_lines(lake: Lake) -> DataFrame:
    """The sales lines as loaded, joined with their orders once for transactions and weekly promotions."""
    return derivations.transaction_lines(lake.spark, lake.folder).withColumn("LoadedAt", F.current_timestamp())


def _bronze_transactions(lake: Lake) -> DataFrame:
    rows = lake["source.lines"]
    return bronze.to_bronze(rows, "transaction_data", SNAPSHOT, PROCESS_DATE, loaded_at=F.col("LoadedAt"))


def _bronze_promotions(lake: Lake) -> DataFrame:
    lines = lake["source.lines"]
    rows = derivations.promotions_of(lines, lines.count())
    return bronze.to_bronze(rows, "causal_data", SNAPSHOT, PROCESS_DATE)


def _master(table: str, raw: str) -> Callable[[Lake], DataFrame]:
    build = getattr(silver, table)
    return lambda lake: build(lake[f"bronze.{raw}"], SNAPSHOT, PROCESS_DATE)


def _clean(lake: Lake, name: str, build: Callable[[Callable], DataFrame]) -> DataFrame:
    """A Silver table that `build` makes with a way to drop copies: a view over Bronze where few rows have any,
    with the time of this load; otherwise to be stored."""

    def latest(rows: DataFrame, identity: list[str]) -> DataFrame:
        kept, in_place = latest_in_place(rows, identity)
        if in_place:
            lake.views.add(name)
        return kept

    built = build(latest)
    return built.withColumn("ETLTime", F.lit(datetime.now(UTC))) if name in lake.views else built


def _transaction_clean(lake: Lake) -> DataFrame:
    valid = silver.valid_transactions(lake["bronze.transaction_data_raw"])

    def build(latest: Callable) -> DataFrame:
        return silver.transaction_clean(latest(valid, silver.TRANSACTION_COLUMNS), SNAPSHOT, PROCESS_DATE)

    return _clean(lake, "silver.transaction_clean", build)


def _promotion_weekly_clean(lake: Lake) -> DataFrame:
    raw = lake["bronze.causal_data_raw"]

    def build(latest: Callable) -> DataFrame:
        return silver.promotion_weekly_clean(raw, SNAPSHOT, PROCESS_DATE, latest_copy=latest)

    return _clean(lake, "silver.promotion_weekly_clean", build)


def _redemption_clean(lake: Lake) -> DataFrame:
    valid = silver.valid_redemptions(lake["bronze.coupon_redemption_raw"])
    return silver.coupon_redemption_clean(valid, SNAPSHOT, PROCESS_DATE)


# Bronze and Silver columns that the others of the row give; they are computed when read, not written.
_SILVER_HASH = {
    "transaction_clean": [*silver.TRANSACTION_COLUMNS, "has_coupon"],
    "promotion_weekly_clean": [*source_columns("causal_data"), "has_display", "has_mailer"],
}


def _derived(name: str) -> dict[str, Column]:
    layer, _, table = name.partition(".")
    if name == "dm_marketing.dm_promotion_performance":
        return marts.derived_of_promotions()
    if layer == "bronze":
        source = next(s for s, t in BRONZE_TABLE.items() if t == table)
        return {"RecordHash": record_hash(*source_columns(source))}
    if layer != "silver" or table not in _SILVER_HASH:
        return {}
    columns = {
        "SourceBatchID": F.lit(SNAPSHOT),
        "ProcessDate": F.lit(PROCESS_DATE).cast("date"),
        "RecordHash": record_hash(*_SILVER_HASH[table]),
    }
    return columns | ({"net_sales_value": F.col("sales_value")} if table == "transaction_clean" else {})


# Not stored: Bronze transactions are a view over the stored source lines, and facts over the Silver rows with
# their keys. `_clean` adds Silver tables of which few rows have copies.
_VIEWS = (
    "bronze.transaction_data_raw",
    "dwh.fact_sales_transaction",
    "dwh.fact_promotion_weekly",
    "keyed.promotion_weekly_clean",
)


def _keyed(lake: Lake, table: str, keys: dict[str, str]) -> DataFrame:
    """Silver rows with their surrogate keys. Where the keys of all large dimensions can be packed, the lookups
    move no row and are done by whoever reads the fact. Otherwise the rows are stored as narrow as they go
    through the lookups: without the columns that can be derived, the record hash first of all."""
    derived = _derived(f"silver.{table}")
    narrow = lake[f"silver.{table}"].drop(*derived, "ETLTime")
    packed = lake.packed(keys)
    keyed = facts.with_keys(narrow, lake.dims(keys), keys, packed).withColumn("CreatedAt", F.current_timestamp())
    return (keyed if len(packed) == len(keys) else materialise(keyed, f"keyed.{table}")).withColumns(derived)


def dimension_source(lake: Lake, dimension: str) -> DataFrame:
    if dimension == "dim_store":
        # copies of a promotion name no other store: Bronze rows that Silver takes will do
        return dims.store_source(
            lake["silver.transaction_clean"], silver.valid_promotions(lake["bronze.causal_data_raw"])
        )
    if dimension == "dim_coupon":
        return dims.coupon_source(lake["silver.coupon_product_clean"], lake["silver.coupon_redemption_clean"])
    if dimension == "dim_day":
        return dims.day_source(lake["silver.transaction_clean"], lake["silver.coupon_redemption_clean"])
    table = {
        "dim_product": "product_clean",
        "dim_household": "household_demographic_clean",
        "dim_campaign": "campaign_clean",
    }[dimension]
    return dims.master_source(lake[f"silver.{table}"], dimension)


def _dimension(name: str) -> Callable[[Lake], DataFrame]:
    return lambda lake: merge_dimension(None, dimension_source(lake, name), name, SNAPSHOT)


def _lines(lake: Lake) -> int:
    """Rows of the sales fact at most, from the file footers of the source lines that it is a view of."""
    return lake["source.lines"].count()


def daily_sales(lake: Lake) -> DataFrame:
    return marts.daily_sales(
        lake["dwh.fact_sales_transaction"], lake["dwh.dim_day"], SNAPSHOT, PROCESS_DATE, rows=_lines(lake)
    )


def product_sales(lake: Lake) -> DataFrame:
    return marts.product_sales(
        lake["dwh.fact_sales_transaction"], lake["dwh.dim_product"], SNAPSHOT, PROCESS_DATE, rows=_lines(lake)
    )


def _campaign_performance(lake: Lake) -> DataFrame:
    return marts.campaign_performance(
        lake["dwh.dim_campaign"],
        lake["dwh.fact_campaign_target"],
        lake["dwh.fact_coupon_redemption"],
        SNAPSHOT,
        PROCESS_DATE,
    )


def promotion_performance(lake: Lake) -> DataFrame:
    return marts.promotion_performance(
        facts.promotion_rows_with_ids(lake["keyed.promotion_weekly_clean"]),
        lake["dwh.fact_sales_transaction"],
        lake["dwh.dim_product"],
        lake["dwh.dim_store"],
        SNAPSHOT,
        PROCESS_DATE,
        rows=_lines(lake),
    )


# --- logs: the snapshot batch, and one batch per source day, all days at once ----------------------
def daily_batches(lake: Lake) -> DataFrame:
    """One batch per source day; its week counts sevens from the first source day."""
    rows = lake["bronze.transaction_data_raw"].filter(F.col("day_no").isNotNull())
    first_day = rows.agg(F.min("day_no")).scalar()
    first_week = lake["bronze.causal_data_raw"].agg(F.min("week_no")).scalar()
    days = rows.select(F.col("day_no").alias("ProcessDay")).distinct()
    return days.select(
        batch_id(F.col("ProcessDay")).alias("BatchID"),
        F.date_add(F.date_sub(F.lit(FIRST_ORDER_DATE).cast("date"), 1), F.col("ProcessDay").cast("int")).alias(
            "ProcessDate"
        ),
        "ProcessDay",
        week_of_day(F.col("ProcessDay"), first_day, first_week).cast("decimal(10,0)").alias("ProcessWeek"),
    )


def _snapshot_batch(lake: Lake) -> DataFrame:
    return lake.spark.range(1).select(
        F.lit(SNAPSHOT).alias("BatchID"),
        F.lit(PROCESS_DATE).cast("date").alias("ProcessDate"),
        F.lit(None).cast("decimal(10,0)").alias("ProcessDay"),
        F.lit(None).cast("decimal(10,0)").alias("ProcessWeek"),
    )


# The part of a table that a daily batch loads: the rows of its day, or of its week; the other tables
# are loaded in whole by every batch, and dimensions are shared.
GRAIN = {
    "bronze.transaction_data_raw": "ProcessDay",
    "bronze.coupon_redemption_raw": "ProcessDay",
    "bronze.causal_data_raw": "ProcessWeek",
    "silver.transaction_clean": "ProcessDay",
    "silver.coupon_redemption_clean": "ProcessDay",
    "silver.promotion_weekly_clean": "ProcessWeek",
    "dwh.fact_sales_transaction": "ProcessDay",
    "dwh.fact_coupon_redemption": "ProcessDay",
    "dwh.fact_promotion_weekly": "ProcessWeek",
    "dm_marketing.dm_daily_sales": "ProcessDay",
    "dm_marketing.dm_product_sales": "ProcessDay",
    "dm_marketing.dm_campaign_performance": "ProcessDay",
    "dm_marketing.dm_promotion_performance": "ProcessWeek",
    "rejected_transactions": "ProcessDay",
    "rejected_redemptions": "ProcessDay",
    quality.LOAD_LOG: "ProcessDay",
}
_OWN_COLUMN = {
    "bronze.transaction_data_raw": "day_no",
    "bronze.coupon_redemption_raw": "day_no",
    "bronze.causal_data_raw": "week_no",
    "silver.transaction_clean": "day_no",
    "silver.coupon_redemption_clean": "day_no",
    "silver.promotion_weekly_clean": "week_no",
    "dwh.fact_promotion_weekly": "WeekNumber",
    "dm_marketing.dm_daily_sales": "DayNumber",
    "dm_marketing.dm_promotion_performance": "WeekNumber",
}


def _with_day(lake: Lake, fact: str, how: str = "inner") -> DataFrame:
    days = lake["dwh.dim_day"].select("DayKey", F.col("DayNumber").alias("ProcessDay"))
    return lake[fact].join(days, "DayKey", how)


def _product_sales_by_day(lake: Lake) -> DataFrame:
    sales = _with_day(lake, "dwh.fact_sales_transaction")
    return marts.product_sales(sales, lake["dwh.dim_product"], SNAPSHOT, PROCESS_DATE, ("ProcessDay",))


def _campaign_performance_by_day(lake: Lake) -> DataFrame:
    return marts.campaign_performance_by_day(
        lake["dwh.dim_campaign"],
        lake["dwh.fact_campaign_target"],
        _with_day(lake, "dwh.fact_coupon_redemption"),
        lake["batches"],
        SNAPSHOT,
        PROCESS_DATE,
    )


def batch_tables(lake: Lake) -> dict[str, DataFrame]:
    """Every layer table as the daily batches load it, with the day or week of its rows. All rows of the table
    are there, but for `_OTHER_IN_SNAPSHOT`."""
    tables = check_tables(lake)
    tables |= {name: lake[name].withColumn(GRAIN[name], F.col(own)) for name, own in _OWN_COLUMN.items()}
    return tables | {
        "dwh.fact_sales_transaction": _with_day(lake, "dwh.fact_sales_transaction", "left"),
        "dwh.fact_coupon_redemption": _with_day(lake, "dwh.fact_coupon_redemption", "left"),
        "dm_marketing.dm_product_sales": lake["by_day.dm_product_sales"],
        "dm_marketing.dm_campaign_performance": lake["by_day.dm_campaign_performance"],
    }


_LOAD_SOURCES = {
    # load: (table or set of rows that it reads, rows that it sets aside)
    "BRONZE_TRANSACTION": ("bronze.transaction_data_raw", None),
    "BRONZE_COUPON_REDEMPTION": ("bronze.coupon_redemption_raw", None),
    "SILVER_TRANSACTION": ("bronze.transaction_data_raw", "rejected_transactions"),
    "SILVER_COUPON_REDEMPTION": ("bronze.coupon_redemption_raw", "rejected_redemptions"),
    "DWH_FACT_SALES": ("silver.transaction_clean", None),
    "DWH_FACT_COUPON_REDEMPTION": ("silver.coupon_redemption_clean", None),
    "DWH_FACT_CAMPAIGN_TARGET": ("silver.campaign_target_clean", None),
    "DWH_FACT_PROMOTION_WEEKLY": ("silver.promotion_weekly_clean", None),
    "DM_DAILY_SALES": ("dwh.fact_sales_transaction", None),
    "DM_PRODUCT_SALES": ("dwh.fact_sales_transaction", None),
    "DM_CAMPAIGN_PERFORMANCE": ("dwh.fact_campaign_target", None),
    "DM_PROMOTION_PERFORMANCE": ("dwh.fact_promotion_weekly", None),
}
# Their daily rows are not parts of the snapshot's: distinct members count once a day.
_OTHER_IN_SNAPSHOT = ("dm_marketing.dm_product_sales", "dm_marketing.dm_campaign_performance")


def _load(load_id: str) -> Column:
    spec = control.LOADS[load_id]
    source_name, rejected_name = _LOAD_SOURCES[load_id]
    source, inserted = F.col(f"`{source_name}`"), F.col(f"`{spec.target}`")
    columns = {"SourceRowCount": source, "InsertedRowCount": inserted}
    if rejected_name:
        rejected = F.col(rejected_name)
        columns |= {"RejectedRowCount": rejected, "UnchangedRowCount": source - rejected - inserted}
    return control.load_columns(spec, control.process_value(load_id, F.col("ProcessDay"), F.col("ProcessWeek")), **columns)


def _loads(lake: Lake, load_ids: Iterable[str], tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Of `tables`, those that the loads read and fill, and the rows that they set aside."""
    names = {t for i in load_ids for t in (_LOAD_SOURCES[i][0], control.LOADS[i].target)}
    parts = {n: df for n, df in tables.items() if n in names}
    for load_id, invalid in (
        ("SILVER_TRANSACTION", silver.invalid_transactions),
        ("SILVER_COUPON_REDEMPTION", silver.invalid_redemptions),
    ):
        if load_id in load_ids:
            source, rejected = _LOAD_SOURCES[load_id]
            parts[rejected] = invalid(parts[source])
    return parts


def _snapshot_loads(lake: Lake, load_ids: Iterable[str], counted: DataFrame, names: list[str]) -> DataFrame:
    return control.log_rows(control.counts_beside(_snapshot_batch(lake), counted, names, {}), [_load(i) for i in load_ids])


def _load_log(lake: Lake) -> DataFrame:
    """The twelve loads of all daily batches and of the snapshot, from one count over the stacked tables."""
    parts = _loads(lake, _LOAD_SOURCES, batch_tables(lake))
    whole = {f"whole {n}": lake[n] for n in _OTHER_IN_SNAPSHOT}
    counted = materialise(control.count_loads({**parts, **whole}, GRAIN), "load-counts")
    per_day = control.counts_beside(lake["batches"], counted.filter(~F.col("What").startswith("whole ")), list(parts), GRAIN)
    total = (
        counted.filter(~F.col("What").isin(*_OTHER_IN_SNAPSHOT))
        .groupBy(F.regexp_replace("What", "^whole ", "").alias("What"))
        .agg(F.sum("Rows").alias("Rows"))
        .withColumns({"Grain": F.lit(""), "Value": F.lit(0).cast("decimal(20,0)")})
    )
    loads = [_load(i) for i in _LOAD_SOURCES]
    return control.log_rows(per_day, loads).unionByName(_snapshot_loads(lake, _LOAD_SOURCES, total, list(parts)))


def _load_log_of_snapshot(lake: Lake, layers: set[str]) -> DataFrame:
    """The snapshot's loads of these layers, counted over the tables that they read and fill."""
    load_ids = [i for i in _LOAD_SOURCES if control.LOADS[i].layer in layers]
    names = {t for i in load_ids for t in (_LOAD_SOURCES[i][0], control.LOADS[i].target)}
    parts = _loads(lake, load_ids, {n: lake[n] for n in sorted(names)})
    return _snapshot_loads(lake, load_ids, control.count_loads(parts, {}), list(parts))


def snapshot_checks(lake: Lake, checks: Iterable[quality.Check]) -> DataFrame:
    """Log rows of these checks of the snapshot. Only the tables that they read are built; where the whole log has
    been written already, they are read from it."""
    checks = list(checks)
    if lake.has(_DQ_LOG):
        return lake[_DQ_LOG].filter(F.col("DQLogID").isin(*[f"{SNAPSHOT}_{c.id}" for c in checks]))
    names = quality.tables_of(checks)
    built = [n for n in names if n != quality.LOAD_LOG]
    tables = dict(zip(built, at_the_same_time([partial(lake.__getitem__, n) for n in built]), strict=True))
    if quality.LOAD_LOG in names:
        logged = {c.layer for c in checks if c.table == quality.LOAD_LOG}
        tables[quality.LOAD_LOG] = _load_log_of_snapshot(lake, logged)
    return quality.run_checks(checks, tables, SNAPSHOT, packed=True)


def check_tables(lake: Lake) -> dict[str, DataFrame]:
    layers = ("bronze", "silver", "dwh", "dm_marketing")
    return {name: df for layer in layers for name, df in lake.layer(layer).items()}


def all_checks() -> dict:
    return {
        **quality.bronze_checks(SNAPSHOT),
        **quality.silver_checks(SNAPSHOT),
        **quality.dwh_checks(SNAPSHOT),
        **quality.mart_checks(SNAPSHOT),
    }


def _dq_log(lake: Lake) -> DataFrame:
    """All checks of the snapshot and of every daily batch, over the same tables but for those that differ."""
    log, batches, daily = lake[quality.LOAD_LOG], lake["batches"], batch_tables(lake)
    logged = log.join(batches.select("BatchID", "ProcessDay"), "BatchID")
    whole = daily | {n: lake[n] for n in _OTHER_IN_SNAPSHOT} | {quality.LOAD_LOG: log}
    return quality.run_checks_of_all(
        _snapshot_batch(lake), whole, batches, daily | {quality.LOAD_LOG: logged}, GRAIN, SNAPSHOT
    )


def running_batches(lake: Lake) -> DataFrame:
    """All batches as control rows that have not ended yet."""
    rows = lake["batches"].withColumn("LoadMode", F.lit(control.INCREMENTAL))
    rows = rows.unionByName(_snapshot_batch(lake).withColumn("LoadMode", F.lit(control.INITIAL)))
    return conform(
        rows.withColumns(
            {
                "BatchStatus": F.lit("RUNNING"),
                "StartTime": F.current_timestamp(),
                "TriggerType": F.lit("MANUAL"),
                "ETLTime": F.current_timestamp(),
            }
        ),
        CONTROL["etl_batch_control"],
    )


def _batch_control(lake: Lake) -> DataFrame:
    opened = running_batches(lake)
    status = control.batch_status(opened, lake["audit.etl_table_load_log"], lake["audit.data_quality_log"])
    return control.close_batches(opened, status)


_BUILDERS: dict[str, Callable[[Lake], DataFrame]] = {
    "source.lines": _source_lines,
    **{f"bronze.{table}": _bronze(source) for source, table in BRONZE_TABLE.items()},
    "bronze.transaction_data_raw": _bronze_transactions,
    "bronze.causal_data_raw": _bronze_promotions,
    "silver.transaction_clean": _transaction_clean,
    "silver.coupon_redemption_clean": _redemption_clean,
    "silver.product_clean": _master("product_clean", "product_raw"),
    "silver.household_demographic_clean": _master("household_demographic_clean", "household_demographic_raw"),
    "silver.campaign_clean": _master("campaign_clean", "campaign_desc_raw"),
    "silver.campaign_target_clean": _master("campaign_target_clean", "campaign_target_raw"),
    "silver.coupon_product_clean": _master("coupon_product_clean", "coupon_raw"),
    "silver.promotion_weekly_clean": _promotion_weekly_clean,
    **{f"dwh.{name}": _dimension(name) for name in SURROGATE_KEY},
    "dwh.fact_sales_transaction": lambda lake: facts.sales_rows(
        _keyed(lake, "transaction_clean", facts.SALES_KEYS)
    ),
    "dwh.fact_coupon_redemption": lambda lake: facts.redemption_fact(
        lake["silver.coupon_redemption_clean"], lake.dims(facts.REDEMPTION_KEYS)
    ),
    "dwh.fact_campaign_target": lambda lake: facts.target_fact(
        lake["silver.campaign_target_clean"], lake.dims(facts.TARGET_KEYS)
    ),
    "keyed.promotion_weekly_clean": lambda lake: _keyed(lake, "promotion_weekly_clean", facts.PROMOTION_KEYS),
    "dwh.fact_promotion_weekly": lambda lake: facts.promotion_rows(lake["keyed.promotion_weekly_clean"]),
    "dm_marketing.dm_daily_sales": daily_sales,
    "dm_marketing.dm_product_sales": product_sales,
    "dm_marketing.dm_campaign_performance": _campaign_performance,
    "dm_marketing.dm_promotion_performance": promotion_performance,
    "view.top_products": lambda lake: views.top_products(lake["dm_marketing.dm_product_sales"]),
    "view.campaign_performance": lambda lake: views.campaign_performance(
        lake["dm_marketing.dm_campaign_performance"]
    ),
    "analytics.rfm": lambda lake: analytics.rfm(lake["silver.transaction_clean"]),
    "batches": daily_batches,
    "by_day.dm_product_sales": _product_sales_by_day,
    "by_day.dm_campaign_performance": _campaign_performance_by_day,
    "audit.etl_table_load_log": _load_log,
    _DQ_LOG: _dq_log,
    "control.etl_batch_control": _batch_control,
}



_LAKES: dict[tuple[str, str], Lake] = {}


def lake_of(spark: SparkSession, folder: str) -> Lake:
    """The lake of this folder in the running application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _LAKES:
        _LAKES[key] = Lake(spark, folder)
    return _LAKES[key]

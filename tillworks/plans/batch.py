"""One daily batch, from the landing store to its verdict; running it again gives the same tables.

Tables that a batch adds to are partitioned by batch, and a rerun switches its own partition to new rows.
Dimensions and control tables are merged into a new version. Log rows are written per batch and layer: STARTED
before the layer runs, the result after it. A layer that raises is logged as failed and closes the batch as
FAILED; a driver that dies leaves its layer STARTED, which counts as failed too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillworks.operators.checks import Check
from tillworks.operators.constraints import enforced
from tillworks.operators.merge import merge_dimension, only_when_running, read_batches, replace_by_batch
from tillworks.operators.reconcile import side_by_side
from tillworks.operators.versions import read_latest, write_next
from tillworks.plans import bronze, control, dims, facts, marts, quality, silver
from tillworks.schema import BRONZE_TABLE, DIMENSIONS, SCHEMAS, SOURCES, SURROGATE_KEY
from tillworks.session import at_the_same_time
from tillworks.sources.landing import SLICED, landed, landed_values

CONTROL_TABLE = "control.etl_batch_control"
LOAD_LOG = "audit.etl_table_load_log"
DQ_LOG = "audit.data_quality_log"
WATERMARK = "control.source_watermark"


@dataclass(frozen=True)
class Batch:
    """Parameters of one run."""

    id: str
    process_date: str
    day: int
    week: int
    mode: str = control.INCREMENTAL
    triggered_by: str = "operator"


class Warehouse:
    """The layer tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _versioned(self, table: str) -> bool:
        return table.removeprefix("dwh.") in SURROGATE_KEY or table in (CONTROL_TABLE, WATERMARK)

    def read(self, table: str) -> DataFrame:
        schema = SCHEMAS[table]
        if self._versioned(table):
            latest = read_latest(self.spark, self.path(table), schema)
            return self.spark.createDataFrame([], schema) if latest is None else latest
        return read_batches(self.spark, self.path(table), schema, 2 if table in (LOAD_LOG, DQ_LOG) else 1)

    def of_batch(self, table: str, batch: Batch) -> DataFrame:
        """The batch's partition only."""
        column = "SourceBatchID" if "SourceBatchID" in SCHEMAS[table].fieldNames() else "BatchID"
        return self.read(table).filter(F.col(column) == batch.id)

    def replace(self, table: str, rows: DataFrame, batch: Batch, **partition: str) -> None:
        column = "SourceBatchID" if "SourceBatchID" in SCHEMAS[table].fieldNames() else "BatchID"
        checked = enforced(rows.withColumns({c: F.lit(v) for c, v in partition.items()}), SCHEMAS[table], table)
        replace_by_batch(checked, self.path(table), {column: batch.id, **partition})

    def load(self, table: str, rows: DataFrame, batch: Batch) -> None:
        """Replace the batch's rows, if the batch is running."""
        self.replace(table, only_when_running(rows, self.read(CONTROL_TABLE), batch.id), batch)

    def load_all(self, layer: str, built: dict[str, DataFrame], batch: Batch) -> None:
        at_the_same_time(partial(self.load, f"{layer}.{table}", rows, batch) for table, rows in built.items())

    def dims(self) -> dict[str, DataFrame]:
        return {name: self.read(f"dwh.{name}") for name in SURROGATE_KEY}

    def tables(self, checks: Iterable[Check]) -> dict[str, DataFrame]:
        """The tables that the checks read."""
        return {name: self.read(name) for name in quality.tables_of(checks)}


class BatchFailed(RuntimeError):
    """A layer raised; the batch is closed as FAILED."""


def next_batch(warehouse: Warehouse, store: str, process_date: str, triggered_by: str = "operator") -> Batch | None:
    """Parameters of the next batch, or None when the landing store has no further day. Days and weeks are
    the store's folder names; no source row is read."""
    spark = warehouse.spark
    planned = control.next_batch(
        landed_values(spark, store, "transaction_data"), landed_values(spark, store, "causal_data"), warehouse.read(CONTROL_TABLE)
    ).first()
    if planned is None:
        return None
    day, week = int(planned["ProcessDay"]), int(planned["ProcessWeek"])
    return Batch(planned["BatchID"], process_date, day, week, planned["LoadMode"], triggered_by)


def run_batch(warehouse: Warehouse, store: str, batch: Batch) -> str:
    """Load one batch from the landing store, check and close it; returns its status. When a layer raises,
    its loads are logged as FAILED with the message, the batch is closed, and BatchFailed is raised."""
    opened = control.open_batch(
        warehouse.read(CONTROL_TABLE), batch.id, batch.process_date, batch.day, batch.week, batch.mode, batch.triggered_by
    )
    write_next(opened, warehouse.path(CONTROL_TABLE))
    write_next(control.seed_watermarks(warehouse.read(WATERMARK)), warehouse.path(WATERMARK))
    checks: dict[str, Callable[..., dict]] = {
        "BRONZE": quality.bronze_checks,
        "SILVER": quality.silver_checks,
        "DWH": quality.dwh_checks,
        "DM": quality.mart_checks,
    }
    for layer, load in (("BRONZE", _bronze), ("SILVER", _silver), ("DWH", _dwh), ("DM", _marts)):
        started = _started(warehouse, batch, layer)
        _log(warehouse, batch, layer, started)
        try:
            counts = load(warehouse, batch, store) if layer == "BRONZE" else load(warehouse, batch)
            _log(warehouse, batch, layer, _finished(warehouse, batch, counts))
            scope = (batch.id,) if layer == "SILVER" else (batch.id, batch.day, batch.week)
            wanted = list(checks[layer](*scope).values())
            results = quality.run_checks(wanted, warehouse.tables(wanted), batch.id)
            warehouse.replace(DQ_LOG, results.drop("LayerName"), batch, LayerName=layer)
        except Exception as error:
            failed = {"LoadStatus": F.lit("FAILED"), "EndTime": F.current_timestamp(), "ErrorMessage": F.lit(str(error)[:500])}
            _log(warehouse, batch, layer, started.withColumns(failed))
            _close(warehouse, batch)
            raise BatchFailed(f"{batch.id}: the {layer} layer failed") from error
    return _close(warehouse, batch)


# --- layers: each returns, per load, (source rows, table, rejected rows) -------------------------
Loaded = dict[str, tuple[DataFrame, str, DataFrame | None]]


def _bronze(warehouse: Warehouse, batch: Batch, store: str) -> Loaded:
    value_of = {"day_no": batch.day, "week_no": batch.week}

    def load(source: str) -> tuple[DataFrame, str, None]:
        rows = landed(warehouse.spark, store, source, value_of.get(SLICED.get(source)))
        table = f"bronze.{BRONZE_TABLE[source]}"
        warehouse.load(table, bronze.to_bronze(rows, source, batch.id, batch.process_date), batch)
        return rows, table, None

    loaded = dict(zip(SOURCES, at_the_same_time(partial(load, s) for s in SOURCES), strict=True))
    return {
        "BRONZE_TRANSACTION": loaded["transaction_data"],
        "BRONZE_COUPON_REDEMPTION": loaded["coupon_redempt"],
    }


def _silver(warehouse: Warehouse, batch: Batch) -> Loaded:
    def raw(table: str) -> DataFrame:
        return warehouse.of_batch(f"bronze.{table}", batch)

    scope = (batch.id, batch.process_date)
    sales, redeemed = raw("transaction_data_raw"), raw("coupon_redemption_raw")
    deduplicated = silver.deduplicated_transactions(silver.valid_transactions(sales, batch.day))
    built = {
        "transaction_clean": silver.transaction_clean(deduplicated, *scope),
        "coupon_redemption_clean": silver.coupon_redemption_clean(silver.valid_redemptions(redeemed, batch.day), *scope),
        "product_clean": silver.product_clean(raw("product_raw"), *scope),
        "household_demographic_clean": silver.household_demographic_clean(raw("household_demographic_raw"), *scope),
        "campaign_clean": silver.campaign_clean(raw("campaign_desc_raw"), *scope),
        "campaign_target_clean": silver.campaign_target_clean(raw("campaign_target_raw"), *scope),
        "coupon_product_clean": silver.coupon_product_clean(raw("coupon_raw"), *scope),
        "promotion_weekly_clean": silver.promotion_weekly_clean(raw("causal_data_raw"), *scope, batch.week),
    }
    warehouse.load_all("silver", built, batch)
    return {
        "SILVER_TRANSACTION": (sales, "silver.transaction_clean", silver.invalid_transactions(sales, batch.day)),
        "SILVER_COUPON_REDEMPTION": (
            redeemed, "silver.coupon_redemption_clean", silver.invalid_redemptions(redeemed, batch.day),
        ),
    }


def _dwh(warehouse: Warehouse, batch: Batch) -> Loaded:
    def clean(table: str) -> DataFrame:
        return warehouse.of_batch(f"silver.{table}", batch)

    sales, redeemed = clean("transaction_clean"), clean("coupon_redemption_clean")
    targets, promotions = clean("campaign_target_clean"), clean("promotion_weekly_clean")
    sources = {
        "dim_product": dims.master_source(clean("product_clean"), "dim_product"),
        "dim_household": dims.master_source(clean("household_demographic_clean"), "dim_household"),
        "dim_campaign": dims.master_source(clean("campaign_clean"), "dim_campaign"),
        "dim_store": dims.store_source(sales, promotions),
        "dim_coupon": dims.coupon_source(clean("coupon_product_clean"), redeemed),
        "dim_day": dims.day_source(sales, redeemed),
    }

    def merge(name: str) -> None:
        path = warehouse.path(f"dwh.{name}")
        current = read_latest(warehouse.spark, path, DIMENSIONS[name])
        merged = merge_dimension(current, sources[name], name, batch.id)
        if merged is not current:
            write_next(merged, path)

    at_the_same_time(partial(merge, name) for name in sources)
    members = warehouse.dims()
    built = {
        "fact_sales_transaction": facts.sales_fact(sales, members),
        "fact_coupon_redemption": facts.redemption_fact(redeemed, members),
        "fact_campaign_target": facts.target_fact(targets, members),
        "fact_promotion_weekly": facts.promotion_fact(promotions, members),
    }
    warehouse.load_all("dwh", built, batch)
    return {
        "DWH_FACT_SALES": (sales, "dwh.fact_sales_transaction", None),
        "DWH_FACT_COUPON_REDEMPTION": (redeemed, "dwh.fact_coupon_redemption", None),
        "DWH_FACT_CAMPAIGN_TARGET": (targets, "dwh.fact_campaign_target", None),
        "DWH_FACT_PROMOTION_WEEKLY": (promotions, "dwh.fact_promotion_weekly", None),
    }


def _marts(warehouse: Warehouse, batch: Batch) -> Loaded:
    def fact(table: str) -> DataFrame:
        return warehouse.of_batch(f"dwh.{table}", batch)

    members, scope = warehouse.dims(), (batch.id, batch.process_date)
    sales, targets = fact("fact_sales_transaction"), fact("fact_campaign_target")
    redeemed, promotions = fact("fact_coupon_redemption"), fact("fact_promotion_weekly")
    built = {
        "dm_daily_sales": marts.daily_sales(sales, members["dim_day"], *scope, batch.day),
        "dm_product_sales": marts.product_sales(sales, members["dim_product"], *scope),
        "dm_campaign_performance": marts.campaign_performance(members["dim_campaign"], targets, redeemed, *scope),
        "dm_promotion_performance": marts.promotion_performance(
            promotions, sales, members["dim_product"], members["dim_store"], *scope, batch.week
        ),
    }
    warehouse.load_all("dm_marketing", built, batch)
    return {
        "DM_DAILY_SALES": (sales, "dm_marketing.dm_daily_sales", None),
        "DM_PRODUCT_SALES": (sales, "dm_marketing.dm_product_sales", None),
        "DM_CAMPAIGN_PERFORMANCE": (targets, "dm_marketing.dm_campaign_performance", None),
        "DM_PROMOTION_PERFORMANCE": (promotions, "dm_marketing.dm_promotion_performance", None),
    }


# --- logs ---------------------------------------------------------------------------------------
def _log(warehouse: Warehouse, batch: Batch, layer: str, rows: DataFrame) -> None:
    warehouse.replace(LOAD_LOG, rows.drop("LayerName"), batch, LayerName=layer)


def _process_value(load_id: str, batch: Batch) -> Column:
    return control.process_value(load_id, F.lit(batch.day), F.lit(batch.week)).cast("decimal(20,0)")


def _started(warehouse: Warehouse, batch: Batch, layer: str) -> DataFrame:
    rows = [
        control.started_row(warehouse.spark, load, batch.id, batch.process_date, _process_value(load.id, batch))
        for load in control.LOADS.values()
        if load.layer == layer
    ]
    return reduce(DataFrame.unionByName, rows)


def _finished(warehouse: Warehouse, batch: Batch, loaded: Loaded) -> DataFrame:
    """Closed log rows of a layer, all counted in one query. What was read and written is counted from the
    footers of the files of this batch's folders, which hold even if tasks ran twice, as observed metrics
    of the write would not; only rejected rows are looked at again."""
    rows, counted = F.count("*"), {}
    for load_id, (source, table, rejected) in loaded.items():
        counted[f"{load_id}_read"] = (source, rows)
        counted[f"{load_id}_written"] = (warehouse.of_batch(table, batch), rows)
        if rejected is not None:
            counted[f"{load_id}_rejected"] = (rejected, rows)
    counts = side_by_side(counted).withColumns(
        {"BatchID": F.lit(batch.id), "ProcessDate": F.lit(batch.process_date).cast("date")}
    )
    closed = []
    for load_id in loaded:
        read, written = F.col(f"{load_id}_read"), F.col(f"{load_id}_written")
        columns = {"SourceRowCount": read, "InsertedRowCount": written}
        if f"{load_id}_rejected" in counted:
            rejected = F.col(f"{load_id}_rejected")
            columns |= {"RejectedRowCount": rejected, "UnchangedRowCount": read - rejected - written}
        closed.append(control.load_columns(control.LOADS[load_id], _process_value(load_id, batch), **columns))
    return control.log_rows(counts, closed)


def _close(warehouse: Warehouse, batch: Batch) -> str:
    opened = warehouse.read(CONTROL_TABLE)
    status = control.batch_status(
        opened.filter(F.col("BatchID") == batch.id), warehouse.of_batch(LOAD_LOG, batch), warehouse.of_batch(DQ_LOG, batch)
    )
    write_next(control.close_batches(opened, status), warehouse.path(CONTROL_TABLE))
    return warehouse.of_batch(CONTROL_TABLE, batch).first()["BatchStatus"]

"""Batch control: the next batch, load-log rows, the batch verdict and its reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillworks.functions.rowops import batch_id, batch_verdict, load_status, week_of_day
from tillworks.operators.merge import seed_missing
from tillworks.operators.reconcile import side_by_side
from tillworks.plans.views import check_blocks, check_summary, load_failed, load_summary
from tillworks.schema import AUDIT, CONTROL, ROWS, conform

SUCCESS_STATUSES = ("SUCCESS", "SUCCESS_WITH_WARNING")
INITIAL, INCREMENTAL = "INITIAL", "INCREMENTAL"

# Sources and what their progress is measured in.
WATERMARKS = (
    ("transaction_data", "DAY"),
    ("coupon_redemption", "DAY"),
    ("causal_data", "WEEK_NO"),
    ("product", "SNAPSHOT"),
    ("household_demographic", "SNAPSHOT"),
    ("campaign_desc", "SNAPSHOT"),
    ("campaign_target", "SNAPSHOT"),
    ("coupon", "SNAPSHOT"),
)


# --- next batch -------------------------------------------------------------------------------
def source_bounds(transactions: DataFrame, promotions: DataFrame) -> DataFrame:
    """First, last and number of days and weeks in the sources."""
    days, weeks = F.col("day_no"), F.col("week_no")
    return side_by_side(
        {
            "MinSourceDay": (transactions, F.min(days)),
            "MaxSourceDay": (transactions, F.max(days)),
            "DistinctSourceDayCount": (transactions, F.countDistinct(days)),
            "MinSourceWeek": (promotions, F.min(weeks)),
            "MaxSourceWeek": (promotions, F.max(weeks)),
            "DistinctSourceWeekCount": (promotions, F.countDistinct(weeks)),
        }
    )


def last_successful_day(control: DataFrame) -> DataFrame:
    done = control.filter(F.col("BatchStatus").isin(*SUCCESS_STATUSES))
    return done.agg(F.max("ProcessDay").alias("LastSuccessfulDay"))


def next_batch(transactions: DataFrame, promotions: DataFrame, control: DataFrame) -> DataFrame:
    """The batch to run next, as one row; no row when the source has no later day or week.

    The day is the first source day after the last successful one, so a gap in the source's days
    is skipped. The week counts sevens of days from the first source day."""
    last = last_successful_day(control).scalar()
    days = transactions.select("day_no").filter(F.col("day_no").isNotNull())
    first_day = transactions.agg(F.min("day_no")).scalar()
    first_week = promotions.agg(F.min("week_no")).scalar()
    last_week = promotions.agg(F.max("week_no")).scalar()
    chosen = (
        days.withColumn("_last", last)
        .filter(F.col("_last").isNull() | (F.col("day_no") > F.col("_last")))
        .agg(F.min("day_no").alias("ProcessDay"), F.max("_last").alias("_last"))
        .filter(F.col("ProcessDay").isNotNull())
    )
    week = week_of_day(F.col("ProcessDay"), first_day, first_week)
    return (
        chosen.withColumn("ProcessWeek", week.cast("decimal(10,0)"))
        .filter(F.col("ProcessWeek") <= last_week)
        .select(
            batch_id(F.col("ProcessDay")).alias("BatchID"),
            F.when(F.col("_last").isNull(), INITIAL).otherwise(INCREMENTAL).alias("LoadMode"),
            "ProcessDay",
            "ProcessWeek",
        )
    )


# --- control rows -----------------------------------------------------------------------------
def open_batch(
    control: DataFrame, batch: str, process_date: str, day: int | None, week: int | None, mode: str, triggered_by: str
) -> DataFrame:
    """Start the batch, or reopen it for a rerun."""
    row = control.sparkSession.range(1).select(
        F.lit(batch.strip()).alias("BatchID"),
        F.lit(process_date).cast("date").alias("ProcessDate"),
        F.lit(day).alias("ProcessDay"),
        F.lit(week).alias("ProcessWeek"),
        F.upper(F.trim(F.lit(mode))).alias("LoadMode"),
        F.lit("RUNNING").alias("BatchStatus"),
        F.current_timestamp().alias("StartTime"),
        F.lit("MANUAL").alias("TriggerType"),
        F.lit(triggered_by).alias("TriggeredBy"),
        F.current_timestamp().alias("ETLTime"),
    )
    others = control.filter(F.col("BatchID") != batch.strip())
    return others.unionByName(conform(row, CONTROL["etl_batch_control"]))


def seed_watermarks(current: DataFrame) -> DataFrame:
    """Add missing watermark rows; those present keep their progress and become active again."""
    spark = current.sparkSession
    names = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("SourceName"), F.lit(kind).alias("WatermarkType"))
                for name, kind in WATERMARKS
            ]
        )
    )
    seeds = spark.range(1).select(names.alias("s")).select("s.*")
    start = F.when(F.col("WatermarkType") != "SNAPSHOT", F.lit(0))
    seeds = seeds.withColumns(
        {"LastProcessValue": start, "IsActive": F.lit("Y"), "ETLTime": F.current_timestamp()}
    )
    schema = CONTROL["source_watermark"]
    refreshed = ["WatermarkType", "IsActive", "ETLTime"]
    return conform(seed_missing(current, conform(seeds, schema), "SourceName", refreshed), schema)


# --- load log ---------------------------------------------------------------------------------
@dataclass(frozen=True)
class Load:
    """One table load as it appears in the log."""

    id: str  # suffix of the log id
    layer: str
    source: str
    target: str
    strategy: str
    when_empty: str = "FAILED"
    counts_rows: bool = True  # the target has one row per source row that is not set aside


# Log ids, sources, targets and strategies.
LOADS = {
    load.id: load
    for load in (
        Load("BRONZE_TRANSACTION", "BRONZE", "transaction_data", "bronze.transaction_data_raw", "INCREMENTAL_DAY_RELOAD"),
        Load(
            "BRONZE_COUPON_REDEMPTION", "BRONZE", "coupon_redemption", "bronze.coupon_redemption_raw",
            "INCREMENTAL_DAY_RELOAD", when_empty="SKIPPED",
        ),
        Load("SILVER_TRANSACTION", "SILVER", "transaction_data_raw", "silver.transaction_clean", "CLEAN_DEDUPLICATE_RELOAD"),
        Load(
            "SILVER_COUPON_REDEMPTION", "SILVER", "coupon_redemption_raw", "silver.coupon_redemption_clean",
            "CLEAN_DEDUPLICATE_RELOAD", when_empty="SKIPPED",
        ),
        Load("DWH_FACT_SALES", "DWH", "transaction_clean", "dwh.fact_sales_transaction", "FACT_RELOAD"),
        Load(
            "DWH_FACT_COUPON_REDEMPTION", "DWH", "coupon_redemption_clean", "dwh.fact_coupon_redemption",
            "FACT_RELOAD", when_empty="SKIPPED",
        ),
        Load("DWH_FACT_CAMPAIGN_TARGET", "DWH", "campaign_target_clean", "dwh.fact_campaign_target", "FACT_RELOAD"),
        Load("DWH_FACT_PROMOTION_WEEKLY", "DWH", "promotion_weekly_clean", "dwh.fact_promotion_weekly", "FACT_RELOAD"),
        Load(
            "DM_DAILY_SALES", "DM", "fact_sales_transaction", "dm_marketing.dm_daily_sales", "AGGREGATE_RELOAD",
            counts_rows=False,
        ),
        Load(
            "DM_PRODUCT_SALES", "DM", "fact_sales_transaction", "dm_marketing.dm_product_sales", "AGGREGATE_RELOAD",
            counts_rows=False,
        ),
        Load(
            "DM_CAMPAIGN_PERFORMANCE", "DM", "fact_campaign_target+fact_coupon_redemption",
            "dm_marketing.dm_campaign_performance", "AGGREGATE_RELOAD", counts_rows=False,
        ),
        Load(
            "DM_PROMOTION_PERFORMANCE", "DM", "fact_promotion_weekly+fact_sales_transaction",
            "dm_marketing.dm_promotion_performance", "AGGREGATE_RELOAD", counts_rows=False,
        ),
    )
}


def process_value(load_id: str, day: Column, week: Column) -> Column:
    """What a load's progress is measured in: nothing for campaigns, else the week or the day."""
    if "CAMPAIGN" in load_id:
        return F.lit(None)
    return week if "PROMOTION" in load_id else day


def load_columns(load: Load, process_value: Column, **columns: Column) -> Column:
    """One load as a struct: what it is, the day or week it covers, and the given counts (0 where
    not given)."""
    counts = ("SourceRowCount", "InsertedRowCount", "RejectedRowCount", "UnchangedRowCount")
    return F.struct(
        F.lit(load.id).alias("_id"),
        F.lit(load.layer).alias("LayerName"),
        F.lit(load.source).alias("SourceName"),
        F.lit(load.target).alias("TargetTableName"),
        F.lit(load.strategy).alias("LoadStrategy"),
        F.lit(load.when_empty).alias("_when_empty"),
        F.lit(load.counts_rows).alias("_counts_rows"),
        process_value.cast(ROWS).alias("ProcessValue"),
        *[columns.get(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
    )


def log_rows(counted: DataFrame, loads: list[Column]) -> DataFrame:
    """Closed log rows: each row of `counted` (one per batch, with BatchID and, optionally,
    ProcessDate and StartTime) times each load of `loads`."""
    kept = [c for c in ("BatchID", "ProcessDate", "StartTime") if c in counted.columns]
    rows = counted.select(*kept, F.explode(F.array(*loads)).alias("_load")).select(*kept, "_load.*")
    source, inserted = F.col("SourceRowCount"), F.col("InsertedRowCount")
    rejected, unchanged = F.col("RejectedRowCount"), F.col("UnchangedRowCount")
    aside = rejected + unchanged
    counting = load_status(source, inserted + aside, aside, F.col("_when_empty"))
    filling = F.when((source == 0) | (inserted == 0), "FAILED").otherwise("SUCCESS")
    rows = rows.withColumn("LoadStatus", F.when(F.col("_counts_rows"), counting).otherwise(filling))
    message = (
        F.when(source == 0, F.concat(F.lit("no rows in "), "SourceName"))
        .when(F.col("LoadStatus") == "FAILED", "source and target row counts do not match")
        .when(aside > 0, F.format_string("Rejected=%d, Duplicate=%d", rejected, unchanged))
    )
    rows = rows.withColumns(
        {
            "ETLLogID": F.concat_ws("_", "BatchID", "_id"),
            "EndTime": F.current_timestamp(),
            "UpdatedRowCount": F.lit(0),
            "DeletedRowCount": F.lit(0),
            "ErrorMessage": message,
            "ETLTime": F.current_timestamp(),
        }
    )
    if "StartTime" not in kept:
        rows = rows.withColumn("StartTime", F.current_timestamp())
    return conform(rows, AUDIT["etl_table_load_log"])


def started_row(spark: SparkSession, load: Load, batch: str, process_date: str, value: Column) -> DataFrame:
    """Log row of a load that has begun and not yet ended."""
    zero = ("SourceRowCount", "InsertedRowCount", "UpdatedRowCount", "DeletedRowCount", "RejectedRowCount", "UnchangedRowCount")
    row = spark.range(1).select(
        F.lit(f"{batch}_{load.id}").alias("ETLLogID"),
        F.lit(batch).alias("BatchID"),
        F.lit(load.layer).alias("LayerName"),
        F.lit(load.source).alias("SourceName"),
        F.lit(load.target).alias("TargetTableName"),
        F.lit(load.strategy).alias("LoadStrategy"),
        F.lit(process_date).cast("date").alias("ProcessDate"),
        value.alias("ProcessValue"),
        F.current_timestamp().alias("StartTime"),
        *[F.lit(0).alias(c) for c in zero],
        F.lit("STARTED").alias("LoadStatus"),
        F.current_timestamp().alias("ETLTime"),
    )
    return conform(row, AUDIT["etl_table_load_log"])


def count_loads(tables: dict[str, DataFrame], grain: dict[str, str]) -> DataFrame:
    """(What, Grain, Value, Rows): rows of every table per value of its grain column, or of the whole
    table without one. The tables are stacked and counted in one grouping instead of one job per table."""
    parts = [
        df.select(F.lit(i).alias("_what"), (F.col(grain[name]) if name in grain else F.lit(0)).cast("bigint").alias("_value"))
        for i, (name, df) in enumerate(tables.items())
    ]
    # grouped by whole numbers, which are named afterwards
    counted = reduce(DataFrame.unionByName, parts).groupBy("_what", "_value").agg(F.count("*").alias("Rows"))
    names, grains = (F.array(*map(F.lit, of)) for of in (tables, [grain.get(n, "") for n in tables]))
    return counted.select(
        names[F.col("_what")].alias("What"), grains[F.col("_what")].alias("Grain"), F.col("_value").cast(ROWS).alias("Value"), "Rows"
    )


def counts_beside(batches: DataFrame, counted: DataFrame, names: list[str], grain: dict[str, str]) -> DataFrame:
    """The batches with one count column per name, 0 where a batch has no rows."""
    for column in sorted({grain.get(n, "") for n in names}):
        here = [n for n in names if grain.get(n, "") == column]
        wide = (
            counted.filter(F.col("Grain") == column)
            .groupBy(F.col("Value").alias("_value"))
            .agg(*[F.max(F.when(F.col("What") == n, F.col("Rows"))).alias(n) for n in here])
        )
        value = F.col(column).cast(ROWS) if column else F.lit(0).cast(ROWS)
        joined = batches.withColumn("_of", value).join(wide, F.col("_of") == F.col("_value"), "left")
        batches = joined.drop("_of", "_value").withColumns({n: F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in here})
    return batches


# --- verdict ----------------------------------------------------------------------------------
def batch_status(control: DataFrame, load_log: DataFrame, dq_log: DataFrame) -> DataFrame:
    """Counters and verdict of every batch in `control`."""
    loads = load_summary(load_log, "BatchID").select(
        "BatchID",
        F.col("FailedCount").alias("FailedLoadCount"),
        F.col("WarningCount").alias("WarningLoadCount"),
        F.col("LayerCount").alias("CompletedLoadLayerCount"),
    )
    checks = check_summary(dq_log, "BatchID").select(
        "BatchID",
        F.col("CriticalFailCount").alias("CriticalDQFailCount"),
        F.col("WarnCount").alias("DQWarningCount"),
        F.col("LayerCount").alias("CompletedDQLayerCount"),
    )
    counters = [c for c in (*loads.columns, *checks.columns) if c != "BatchID"]
    joined = control.select("BatchID").join(loads, "BatchID", "left").join(checks, "BatchID", "left")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counters})
    verdict = batch_verdict(
        F.col("CompletedLoadLayerCount"),
        F.col("CompletedDQLayerCount"),
        F.col("FailedLoadCount"),
        F.col("CriticalDQFailCount"),
        F.col("WarningLoadCount") + F.col("DQWarningCount"),
    )
    return joined.withColumn("CalculatedBatchStatus", verdict)


def verdict_reason() -> Column:
    """Why a batch did not end as a plain success."""
    number = lambda c: F.col(c).cast("bigint")
    return (
        F.when(F.col("CompletedLoadLayerCount") < 4, F.format_string("loaded layers=%d/4", number("CompletedLoadLayerCount")))
        .when(F.col("CompletedDQLayerCount") < 4, F.format_string("checked layers=%d/4", number("CompletedDQLayerCount")))
        .when(F.col("FailedLoadCount") > 0, F.format_string("failed loads=%d", number("FailedLoadCount")))
        .when(F.col("CriticalDQFailCount") > 0, F.format_string("critical check failures=%d", number("CriticalDQFailCount")))
        .when(
            F.col("WarningLoadCount") + F.col("DQWarningCount") > 0,
            F.format_string("load warnings=%d, check warnings=%d", number("WarningLoadCount"), number("DQWarningCount")),
        )
    )


def close_batches(control: DataFrame, status: DataFrame) -> DataFrame:
    """Control rows with verdict, reason and end time for the batches in `status`."""
    closing = status.select("BatchID", "CalculatedBatchStatus", verdict_reason().alias("_reason"))
    decided = F.col("CalculatedBatchStatus").isNotNull()
    rows = control.join(closing, "BatchID", "left").withColumns(
        {
            "BatchStatus": F.coalesce("CalculatedBatchStatus", "BatchStatus"),
            "ErrorMessage": F.when(decided, F.col("_reason")).otherwise(F.col("ErrorMessage")),
            "EndTime": F.when(decided, F.current_timestamp()).otherwise(F.col("EndTime")),
            "ETLTime": F.when(decided, F.current_timestamp()).otherwise(F.col("ETLTime")),
        }
    )
    return conform(rows, CONTROL["etl_batch_control"])


# --- reports ----------------------------------------------------------------------------------
def with_duration(control: DataFrame) -> DataFrame:
    return control.withColumn("DurationSeconds", F.expr("timestampdiff(SECOND, StartTime, EndTime)"))


def failed_loads(load_log: DataFrame) -> DataFrame:
    return load_log.filter(load_failed())


def critical_checks(dq_log: DataFrame) -> DataFrame:
    return dq_log.filter(check_blocks())


def batch_overview(control: DataFrame, load_log: DataFrame, dq_log: DataFrame) -> DataFrame:
    """Each batch with its load and check counts; both logs are grouped before the joins."""
    loads = load_summary(load_log, "BatchID").select(
        "BatchID",
        "TotalLoadCount",
        F.col("SuccessCount").alias("SuccessLoadCount"),
        F.col("WarningCount").alias("WarningLoadCount"),
        F.col("SkippedCount").alias("SkippedLoadCount"),
        F.col("FailedCount").alias("FailedLoadCount"),
    )
    checks = check_summary(dq_log, "BatchID").select(
        "BatchID",
        F.col("TotalCheckCount").alias("TotalDQCheckCount"),
        F.col("PassCount").alias("PassedDQCount"),
        F.col("WarnCount").alias("WarningDQCount"),
        F.col("FailCount").alias("FailedDQCount"),
        F.col("CriticalFailCount").alias("CriticalDQFailCount"),
    )
    counters = [c for c in (*loads.columns, *checks.columns) if c != "BatchID"]
    joined = with_duration(control).join(loads, "BatchID", "left").join(checks, "BatchID", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counters})

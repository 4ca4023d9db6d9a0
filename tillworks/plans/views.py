"""Reporting views over the marts and the logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.functions.rowops import promotion_type, ratio, redemption_band
from tillworks.operators.numbering import global_dense_rank

LAYERS = ("BRONZE", "SILVER", "DWH", "DM")  # fixed values, in load order
CHECK_STATUSES = ("FAIL", "WARN", "PASS")  # fixed values, worst first
BLOCKING_SEVERITIES = ("ERROR", "CRITICAL")


def daily_sales_kpi(daily: DataFrame) -> DataFrame:
    rate = ratio(F.col("CouponTransactionCount"), F.col("BasketCount"))
    return daily.withColumn("CouponTransactionRate", rate)


def top_products(products: DataFrame) -> DataFrame:
    """Products with their usage rate and their ranks by net sales and by quantity."""
    rate = ratio(F.col("CouponTransactionCount"), F.col("BasketCount"))
    ranked = global_dense_rank(products, "SourceBatchID", "NetSalesAmount", "NetSalesRank")
    ranked = global_dense_rank(ranked, "SourceBatchID", "TotalQuantity", "QuantityRank")
    return ranked.withColumn("CouponUsageRate", rate)


def campaign_performance(campaigns: DataFrame) -> DataFrame:
    band = redemption_band(F.col("TargetHouseholdCount"), F.col("RedemptionRate"))
    ranked = global_dense_rank(campaigns, "SourceBatchID", "RedemptionRate", "RedemptionRateRank")
    return ranked.withColumn("CampaignPerformanceLevel", band)


def promotion_performance(promotions: DataFrame) -> DataFrame:
    return promotions.withColumns(
        {
            "PromotionType": promotion_type(F.col("HasDisplay"), F.col("HasMailer")),
            "DiscountRate": ratio(F.col("TotalDiscountAmount"), F.col("GrossSalesAmount")),
        }
    )


def promotion_type_summary(view: DataFrame) -> DataFrame:
    return view.groupBy("PromotionType").agg(
        F.count("*").alias("PromotionRowCount"),
        F.sum("BasketCount").alias("BasketCount"),
        F.sum("NetSalesAmount").alias("NetSalesAmount"),
        F.avg("DiscountRate").alias("AverageDiscountRate"),
    )


def _status_counts(column: str, names: dict[str, str]) -> list[Column]:
    return [F.count_if(F.col(column) == status).alias(name) for name, status in names.items()]


_LOAD_COUNTS = {
    "SuccessCount": "SUCCESS",
    "WarningCount": "SUCCESS_WITH_WARNING",
    "SkippedCount": "SKIPPED",
}
_CHECK_COUNTS = {"PassCount": "PASS", "WarnCount": "WARN", "FailCount": "FAIL"}
_LOG_SUMS = ("SourceRowCount", "InsertedRowCount", "RejectedRowCount", "UnchangedRowCount")


def load_failed() -> Column:
    """A load that never got past STARTED counts as failed."""
    return F.col("LoadStatus").isin("FAILED", "STARTED")


def check_blocks() -> Column:
    return (F.col("CheckStatus") == "FAIL") & F.col("SeverityLevel").isin(*BLOCKING_SEVERITIES)


def load_summary(load_log: DataFrame, *by: str) -> DataFrame:
    """Loads by status, and row counts, per batch or per layer."""
    return load_log.groupBy(*by).agg(
        F.count("*").alias("TotalLoadCount"),
        *_status_counts("LoadStatus", _LOAD_COUNTS),
        F.count_if(load_failed()).alias("FailedCount"),
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in _LOG_SUMS],
        F.countDistinct(F.when(F.col("LayerName").isin(*LAYERS), F.col("LayerName"))).alias("LayerCount"),
    )


def check_summary(dq_log: DataFrame, *by: str) -> DataFrame:
    """Checks by status per batch or per layer."""
    return dq_log.groupBy(*by).agg(
        F.count("*").alias("TotalCheckCount"),
        *_status_counts("CheckStatus", _CHECK_COUNTS),
        F.count_if(check_blocks()).alias("CriticalFailCount"),
        F.countDistinct(F.when(F.col("LayerName").isin(*LAYERS), F.col("LayerName"))).alias("LayerCount"),
    )


def _place(column: str, names: tuple[str, ...]) -> Column:
    """Position of the value in `names`, counted from 1; values not listed come last."""
    place = F
    for number, name in enumerate(names, 1):
        place = place.when(F.col(column) == name, number)
    return place.otherwise(len(names) + 1)


def layer_order(column: str = "LayerName") -> Column:
    return _place(column, LAYERS)


def status_order(column: str = "CheckStatus") -> Column:
    return _place(column, CHECK_STATUSES)


def etl_batch_summary(control: DataFrame, load_log: DataFrame) -> DataFrame:
    """Each batch with its loads. The log is grouped before the join."""
    names = {"TotalLoadCount": "TableLoadCount"} | {c: f"Total{c}" for c in _LOG_SUMS}
    loads = load_summary(load_log, "BatchID").drop("LayerCount").withColumnsRenamed(names)
    measures = [c for c in loads.columns if c != "BatchID"]
    joined = control.join(loads, "BatchID", "left").withColumns(
        {m: F.coalesce(m, F.lit(0)) for m in measures}
    )
    return joined.select(
        "BatchID", "ProcessDate", "ProcessDay", "ProcessWeek", "LoadMode", "BatchStatus",
        F.col("StartTime").alias("BatchStartTime"), F.col("EndTime").alias("BatchEndTime"), *measures,
    )


def data_quality_summary(dq_log: DataFrame) -> DataFrame:
    checked, failed = (F.sum(F.coalesce(c, F.lit(0))) for c in ("CheckedRowCount", "FailedRowCount"))
    return (
        dq_log.groupBy("BatchID", "LayerName", "CheckStatus", "SeverityLevel")
        .agg(
            F.count("*").alias("CheckCount"),
            checked.alias("CheckedRowCount"),
            failed.alias("FailedRowCount"),
        )
        .withColumn("FailureRate", ratio(F.col("FailedRowCount"), F.col("CheckedRowCount")))
    )

"""Load log, check log and batch verdicts as DuckDB expressions."""

from __future__ import annotations

from oracle.ctes import (
    CAMPAIGN,
    CAUSAL,
    COUPON,
    COUPON_BASKETS,
    HOUSEHOLD,
    PRODUCT,
    RED_VALID,
    SALES_SUMS,
    TARGET,
    TX_VALID,
    exact,
    known,
    null_hash,
    share,
)
from oracle.rules import BY_KEY, CHECKS, DAILY, check_sql

SNAPSHOT = "RM_SNAPSHOT"
BATCH = "printf('RM_DAILY_D%04d', {})"

EXTRA: dict[str, str] = {
    "product_raw": f"SELECT *, {null_hash(*PRODUCT)} AS RecordHash FROM product_source",
    "household_raw": f"SELECT *, {null_hash(*HOUSEHOLD)} AS RecordHash FROM household_source",
    "campaign_raw": f"SELECT *, {null_hash(*CAMPAIGN)} AS RecordHash FROM campaign_source",
    "target_raw": f"SELECT *, {null_hash(*TARGET)} AS RecordHash FROM target_source",
    "coupon_raw": f"SELECT *, {null_hash(*COUPON)} AS RecordHash FROM coupon_source",
    "causal_raw": f"SELECT *, {null_hash(*CAUSAL)} AS RecordHash FROM causal_source",
    "batches": f"""
        SELECT {BATCH.format("day_no")} AS BatchID, day_no AS ProcessDay,
               (SELECT min(week_no) FROM causal_source)
                   + (day_no - (SELECT min(day_no) FROM tx_source)) // 7 AS ProcessWeek
        FROM (SELECT DISTINCT day_no FROM tx_source)""",
    # the marts whose daily rows are not parts of the snapshot's
    "dm_product_by_day": f"""
        SELECT *, {share("NetSalesAmount", "TotalQuantity", 4)} AS AverageUnitNetSales,
               {share("TotalDiscountAmount", "GrossSalesAmount")} AS DiscountRate
        FROM (SELECT DayNumber AS ProcessDay, f.ProductKey, count(DISTINCT BasketID) AS BasketCount,
                     {known("HouseholdKey", "HouseholdCount")}, {known("StoreKey", "StoreCount")}, {SALES_SUMS}, {COUPON_BASKETS}
              FROM fact_sales f JOIN dim_day d ON d.DayKey = f.DayKey GROUP BY 1, 2)""",
    "redeemed_by_day": """
        SELECT DayNumber AS ProcessDay, CampaignKey, count(DISTINCT HouseholdKey) AS RedeemingHouseholdCount,
               sum(RedemptionCount) AS RedemptionCount, count(DISTINCT CouponKey) AS DistinctCouponCount
        FROM fact_redemption f JOIN dim_day d ON d.DayKey = f.DayKey GROUP BY 1, 2""",
    "dm_campaign_by_day": f"""
        SELECT *, {exact("RedeemingHouseholdCount", "TargetHouseholdCount", 6, scale=0)} AS RedemptionRate
        FROM (SELECT b.ProcessDay, c.CampaignKey, coalesce(TargetHouseholdCount, 0) AS TargetHouseholdCount,
                     coalesce(RedeemingHouseholdCount, 0) AS RedeemingHouseholdCount,
                     coalesce(RedemptionCount, 0) AS RedemptionCount, coalesce(DistinctCouponCount, 0) AS DistinctCouponCount
              FROM batches b CROSS JOIN dim_campaign c
              LEFT JOIN campaign_targets t ON t.CampaignKey = c.CampaignKey
              LEFT JOIN redeemed_by_day r ON r.CampaignKey = c.CampaignKey AND r.ProcessDay = b.ProcessDay
              WHERE c.CampaignKey <> -1 AND (t.CampaignKey IS NOT NULL OR r.CampaignKey IS NOT NULL))""",
}

# --- load log ---------------------------------------------------------------------------------
# name: rows with a day, counted per batch
_BY_DAY = {
    "n_tx_raw": "SELECT day_no AS day FROM tx_raw",
    "n_red_raw": "SELECT day_no AS day FROM red_raw",
    "n_tx_rejected": f"SELECT day_no AS day FROM tx_raw WHERE NOT coalesce({TX_VALID}, FALSE)",
    "n_red_rejected": f"SELECT day_no AS day FROM red_raw WHERE NOT coalesce({RED_VALID}, FALSE)",
    "n_tx_clean": "SELECT day_no AS day FROM tx_clean",
    "n_red_clean": "SELECT day_no AS day FROM red_clean",
    "n_sales": "SELECT DayNumber AS day FROM fact_sales f JOIN dim_day d ON d.DayKey = f.DayKey",
    "n_redemptions": "SELECT DayNumber AS day FROM fact_redemption f JOIN dim_day d ON d.DayKey = f.DayKey",
    "n_daily": "SELECT DayNumber AS day FROM dm_daily",
}
_BY_WEEK = {
    "n_promotion_clean": "SELECT week_no AS day FROM promotion_clean",
    "n_promotions": "SELECT WeekNumber AS day FROM fact_promotion",
    "n_promotion_mart": "SELECT WeekNumber AS day FROM dm_promotion",
}
# rows of the snapshot, and of a batch: whole tables, or marts of their own per day
_WHOLE = {"n_target_clean": "target_clean", "n_targets": "fact_target"}
_OWN_MART = {"n_products": ("dm_product", "dm_product_by_day"), "n_campaigns": ("dm_campaign", "dm_campaign_by_day")}
# id, layer, source name, target, strategy, source rows, inserted rows, rejected rows, status when empty, counts rows
_LOADS = (
    ("BRONZE_TRANSACTION", "BRONZE", "transaction_data", "bronze.transaction_data_raw", "INCREMENTAL_DAY_RELOAD", "n_tx_raw", "n_tx_raw", None, "FAILED", True),
    ("BRONZE_COUPON_REDEMPTION", "BRONZE", "coupon_redemption", "bronze.coupon_redemption_raw", "INCREMENTAL_DAY_RELOAD", "n_red_raw", "n_red_raw", None, "SKIPPED", True),
    ("SILVER_TRANSACTION", "SILVER", "transaction_data_raw", "silver.transaction_clean", "CLEAN_DEDUPLICATE_RELOAD", "n_tx_raw", "n_tx_clean", "n_tx_rejected", "FAILED", True),
    ("SILVER_COUPON_REDEMPTION", "SILVER", "coupon_redemption_raw", "silver.coupon_redemption_clean", "CLEAN_DEDUPLICATE_RELOAD", "n_red_raw", "n_red_clean", "n_red_rejected", "SKIPPED", True),
    ("DWH_FACT_SALES", "DWH", "transaction_clean", "dwh.fact_sales_transaction", "FACT_RELOAD", "n_tx_clean", "n_sales", None, "FAILED", True),
    ("DWH_FACT_COUPON_REDEMPTION", "DWH", "coupon_redemption_clean", "dwh.fact_coupon_redemption", "FACT_RELOAD", "n_red_clean", "n_redemptions", None, "SKIPPED", True),
    ("DM_DAILY_SALES", "DM", "fact_sales_transaction", "dm_marketing.dm_daily_sales", "AGGREGATE_RELOAD", "n_sales", "n_daily", None, "FAILED", False),
    ("DWH_FACT_CAMPAIGN_TARGET", "DWH", "campaign_target_clean", "dwh.fact_campaign_target", "FACT_RELOAD", "n_target_clean", "n_targets", None, "FAILED", True),
    ("DWH_FACT_PROMOTION_WEEKLY", "DWH", "promotion_weekly_clean", "dwh.fact_promotion_weekly", "FACT_RELOAD", "n_promotion_clean", "n_promotions", None, "FAILED", True),
    ("DM_PRODUCT_SALES", "DM", "fact_sales_transaction", "dm_marketing.dm_product_sales", "AGGREGATE_RELOAD", "n_sales", "n_products", None, "FAILED", False),
    ("DM_CAMPAIGN_PERFORMANCE", "DM", "fact_campaign_target+fact_coupon_redemption", "dm_marketing.dm_campaign_performance", "AGGREGATE_RELOAD", "n_targets", "n_campaigns", None, "FAILED", False),
    ("DM_PROMOTION_PERFORMANCE", "DM", "fact_promotion_weekly+fact_sales_transaction", "dm_marketing.dm_promotion_performance", "AGGREGATE_RELOAD", "n_promotions", "n_promotion_mart", None, "FAILED", False),
)


def _load_rows(load: tuple, counts: str) -> str:
    ident, layer, source, target, strategy, read, inserted, rejected, when_empty, counting = load
    rejects = rejected or "0"
    copies = f"{read} - {rejected} - {inserted}" if rejected else "0"
    if counting:
        status = (
            f"CASE WHEN {read} = 0 THEN '{when_empty}' WHEN {read} <> {inserted} + {rejects} + ({copies}) THEN 'FAILED' "
            f"WHEN {rejects} + ({copies}) > 0 THEN 'SUCCESS_WITH_WARNING' ELSE 'SUCCESS' END"
        )
    else:
        status = f"CASE WHEN {read} = 0 OR {inserted} = 0 THEN 'FAILED' ELSE 'SUCCESS' END"
    return (
        f"SELECT BatchID || '_{ident}' AS ETLLogID, BatchID, '{layer}' AS LayerName, '{source}' AS SourceName, "
        f"'{target}' AS TargetTableName, '{strategy}' AS LoadStrategy, {read} AS SourceRowCount, "
        f"{inserted} AS InsertedRowCount, {rejects} AS RejectedRowCount, {copies} AS UnchangedRowCount, "
        f"{status} AS LoadStatus, CASE WHEN {read} = 0 THEN 'no rows in {source}' "
        f"WHEN {status} = 'FAILED' THEN 'source and target row counts do not match' "
        f"WHEN {rejects} + ({copies}) > 0 THEN printf('Rejected=%d, Duplicate=%d', {rejects}, {copies}) END "
        f"AS ErrorMessage FROM {counts}"
    )


_PER_BATCH = {
    **{n: (sql, "ProcessDay") for n, sql in _BY_DAY.items()},
    **{n: (sql, "ProcessWeek") for n, sql in _BY_WEEK.items()},
    **{n: (f"SELECT ProcessDay AS day FROM {daily}", "ProcessDay") for n, (_, daily) in _OWN_MART.items()},
}
EXTRA["daily_counts"] = (
    "SELECT b.BatchID, b.ProcessDay, "
    + ", ".join([f"coalesce({n}, 0) AS {n}" for n in _PER_BATCH] + [f"(SELECT count(*) FROM {t}) AS {n}" for n, t in _WHOLE.items()])
    + " FROM batches b "
    + " ".join(
        f"LEFT JOIN (SELECT day, count(*) AS {n} FROM ({sql}) GROUP BY 1) x{n} ON x{n}.day = b.{column}"
        for n, (sql, column) in _PER_BATCH.items()
    )
)
EXTRA["snapshot_counts"] = f"SELECT '{SNAPSHOT}' AS BatchID, " + ", ".join(
    [f"(SELECT count(*) FROM ({sql})) AS {n}" for n, sql in {**_BY_DAY, **_BY_WEEK}.items()]
    + [f"(SELECT count(*) FROM {table}) AS {n}" for n, table in {**_WHOLE, **{n: t for n, (t, _) in _OWN_MART.items()}}.items()]
)
EXTRA["load_log"] = " UNION ALL ".join(
    _load_rows(load, counts) for counts in ("daily_counts", "snapshot_counts") for load in _LOADS
)

# --- checks -----------------------------------------------------------------------------------
EXTRA["daily_checks"] = " UNION ALL ".join(check_sql(line[0], DAILY) for line in CHECKS)
EXTRA["snapshot_checks"] = " UNION ALL ".join(check_sql(line[0]) for line in CHECKS)
EXTRA["dq_log"] = "SELECT * FROM snapshot_checks UNION ALL SELECT * FROM daily_checks"


def late_day_checks() -> str:
    """The day and week rules of every batch, where every 97th product, household or day comes late."""

    def late(key: str, relation: str, own: str, by: str, column: str) -> str:
        rows = f"SELECT *, {own} + CASE WHEN coalesce({by}, 1) % 97 = 0 THEN 1 ELSE 0 END AS g FROM {relation}"
        ident = BY_KEY[key]
        line = (*ident[:7], ("rule", relation, f"{own} IS NULL OR {own} <> g", False))
        return check_sql(key, {relation: (rows, column)}, line)

    return " UNION ALL ".join(
        (
            late("qb11", "tx_raw", "day_no", "product_id", "ProcessDay"),
            late("qb12", "red_raw", "day_no", "household_key", "ProcessDay"),
            late("qb13", "causal_raw", "week_no", "product_id", "ProcessWeek"),
            late("qm5", "dm_daily", "DayNumber", "DayNumber", "ProcessDay"),
            late("qm6", "dm_promotion", "WeekNumber", "ProductID", "ProcessWeek"),
        )
    )


# --- the first two days, run one by one: dimensions hold what has come so far ----------------------
EXTRA["two_batches"] = "SELECT * FROM batches ORDER BY ProcessDay LIMIT 2"
EXTRA["days_so_far"] = "SELECT b.ProcessDay AS g, e.ProcessDay AS day, e.ProcessWeek AS week FROM two_batches b JOIN two_batches e ON e.ProcessDay <= b.ProcessDay"
EXTRA["store_so_far"] = """
    SELECT DISTINCT g, store_id AS StoreID, 1 AS StoreKey FROM days_so_far JOIN tx_clean ON day_no = day
    UNION SELECT g, store_id, 1 FROM days_so_far JOIN promotion_clean ON week_no = week
    UNION ALL SELECT ProcessDay, -1, -1 FROM two_batches"""
EXTRA["coupon_so_far"] = """
    SELECT DISTINCT g, coupon_upc AS CouponUPC, 1 AS CouponKey FROM days_so_far JOIN red_clean ON day_no = day
    UNION SELECT ProcessDay, coupon_upc, 1 FROM two_batches, coupon_clean
    UNION ALL SELECT ProcessDay, -1, -1 FROM two_batches"""
EXTRA["day_so_far"] = """
    SELECT DISTINCT g, day_no AS DayNumber, 1 AS DayKey FROM days_so_far JOIN (SELECT day_no FROM tx_clean UNION SELECT day_no FROM red_clean) ON day_no = day
    UNION ALL SELECT ProcessDay, -1, -1 FROM two_batches"""
_SO_FAR = {
    **{f"dim_{d}": (f"SELECT * FROM {d}_so_far", "ProcessDay") for d in ("store", "coupon", "day")},
    **{
        f"(SELECT * FROM dim_{d} WHERE {key} <> -1)": (f"SELECT * FROM {d}_so_far WHERE {key} <> -1", "ProcessDay")
        for d, key in (("store", "StoreKey"), ("coupon", "CouponKey"), ("day", "DayKey"))
    },
}
EXTRA["two_days_checks"] = " UNION ALL ".join(
    f"SELECT c.* FROM ({check_sql(line[0], {**DAILY, **_SO_FAR})}) c SEMI JOIN two_batches t ON t.BatchID = c.BatchID" for line in CHECKS
)
EXTRA["two_days_loads"] = "SELECT l.* FROM load_log l SEMI JOIN two_batches t ON t.BatchID = l.BatchID"
EXTRA["two_days_control"] = """
    SELECT BatchID, ProcessDay, ProcessWeek, LoadMode,
           CASE WHEN failed > 0 OR blocked > 0 THEN 'FAILED' WHEN warned + noted > 0 THEN 'SUCCESS_WITH_WARNING' ELSE 'SUCCESS' END AS BatchStatus,
           CASE WHEN failed > 0 THEN printf('failed loads=%d', failed) WHEN blocked > 0 THEN printf('critical check failures=%d', blocked)
                WHEN warned + noted > 0 THEN printf('load warnings=%d, check warnings=%d', warned, noted) END AS ErrorMessage
    FROM (SELECT b.BatchID, ProcessDay, ProcessWeek,
                 CASE WHEN ProcessDay = (SELECT min(ProcessDay) FROM two_batches) THEN 'INITIAL' ELSE 'INCREMENTAL' END AS LoadMode,
                 (SELECT count(*) FROM two_days_loads l WHERE l.BatchID = b.BatchID AND LoadStatus IN ('FAILED', 'STARTED')) AS failed,
                 (SELECT count(*) FROM two_days_loads l WHERE l.BatchID = b.BatchID AND LoadStatus = 'SUCCESS_WITH_WARNING') AS warned,
                 (SELECT count(*) FROM two_days_checks c WHERE c.BatchID = b.BatchID AND CheckStatus = 'FAIL' AND SeverityLevel IN ('ERROR', 'CRITICAL')) AS blocked,
                 (SELECT count(*) FROM two_days_checks c WHERE c.BatchID = b.BatchID AND CheckStatus = 'WARN') AS noted
          FROM two_batches b)"""

# --- verdicts ---------------------------------------------------------------------------------
_BLOCKS = "CheckStatus = 'FAIL' AND SeverityLevel IN ('ERROR', 'CRITICAL')"
EXTRA["load_summary"] = """
    SELECT BatchID, count(*) AS TotalLoadCount, count(*) FILTER (LoadStatus = 'SUCCESS') AS SuccessCount,
           count(*) FILTER (LoadStatus = 'SUCCESS_WITH_WARNING') AS WarningCount,
           count(*) FILTER (LoadStatus = 'SKIPPED') AS SkippedCount,
           count(*) FILTER (LoadStatus IN ('FAILED', 'STARTED')) AS FailedCount,
           sum(SourceRowCount) AS SourceRowCount, sum(InsertedRowCount) AS InsertedRowCount,
           sum(RejectedRowCount) AS RejectedRowCount, sum(UnchangedRowCount) AS UnchangedRowCount,
           count(DISTINCT LayerName) AS LayerCount
    FROM load_log GROUP BY 1"""
EXTRA["check_summary"] = f"""
    SELECT BatchID, count(*) AS TotalCheckCount, count(*) FILTER (CheckStatus = 'PASS') AS PassCount,
           count(*) FILTER (CheckStatus = 'WARN') AS WarnCount, count(*) FILTER (CheckStatus = 'FAIL') AS FailCount,
           count(*) FILTER ({_BLOCKS}) AS CriticalFailCount, count(DISTINCT LayerName) AS LayerCount
    FROM dq_log GROUP BY 1"""
EXTRA["opened"] = f"""
    SELECT BatchID, ProcessDay, ProcessWeek, 'INCREMENTAL' AS LoadMode FROM batches
    UNION ALL SELECT '{SNAPSHOT}', NULL, NULL, 'INITIAL'"""
EXTRA["verdicts"] = """
    SELECT *, CASE WHEN CompletedLoadLayerCount < 4 OR CompletedDQLayerCount < 4 OR FailedLoadCount > 0
                        OR CriticalDQFailCount > 0 THEN 'FAILED'
                   WHEN WarningLoadCount + DQWarningCount > 0 THEN 'SUCCESS_WITH_WARNING'
                   ELSE 'SUCCESS' END AS CalculatedBatchStatus,
           CASE WHEN CompletedLoadLayerCount < 4 THEN printf('loaded layers=%d/4', CompletedLoadLayerCount)
                WHEN CompletedDQLayerCount < 4 THEN printf('checked layers=%d/4', CompletedDQLayerCount)
                WHEN FailedLoadCount > 0 THEN printf('failed loads=%d', FailedLoadCount)
                WHEN CriticalDQFailCount > 0 THEN printf('critical check failures=%d', CriticalDQFailCount)
                WHEN WarningLoadCount + DQWarningCount > 0
                    THEN printf('load warnings=%d, check warnings=%d', WarningLoadCount, DQWarningCount)
                END AS ErrorMessage
    FROM (SELECT o.*, coalesce(FailedCount, 0) AS FailedLoadCount, coalesce(WarningCount, 0) AS WarningLoadCount,
                 coalesce(CriticalFailCount, 0) AS CriticalDQFailCount, coalesce(WarnCount, 0) AS DQWarningCount,
                 coalesce(l.LayerCount, 0) AS CompletedLoadLayerCount,
                 coalesce(c.LayerCount, 0) AS CompletedDQLayerCount
          FROM opened o
          LEFT JOIN load_summary l ON l.BatchID = o.BatchID
          LEFT JOIN check_summary c ON c.BatchID = o.BatchID)"""
EXTRA["control"] = """
    SELECT BatchID, ProcessDay, ProcessWeek, LoadMode, CalculatedBatchStatus AS BatchStatus, ErrorMessage
    FROM verdicts"""
EXTRA["batch_view"] = """
    SELECT b.*, coalesce(TotalLoadCount, 0) AS TableLoadCount, coalesce(SuccessCount, 0) AS SuccessCount,
           coalesce(WarningCount, 0) AS WarningCount, coalesce(SkippedCount, 0) AS SkippedCount,
           coalesce(FailedCount, 0) AS FailedCount, coalesce(SourceRowCount, 0) AS TotalSourceRowCount,
           coalesce(InsertedRowCount, 0) AS TotalInsertedRowCount,
           coalesce(RejectedRowCount, 0) AS TotalRejectedRowCount,
           coalesce(UnchangedRowCount, 0) AS TotalUnchangedRowCount
    FROM control b LEFT JOIN load_summary l ON l.BatchID = b.BatchID"""
EXTRA["quality_view"] = f"""
    SELECT *, {exact("FailedRowCount", "CheckedRowCount", 6, scale=0)} AS FailureRate
    FROM (SELECT BatchID, LayerName, CheckStatus, SeverityLevel, count(*) AS CheckCount,
                 sum(CheckedRowCount) AS CheckedRowCount, sum(FailedRowCount) AS FailedRowCount
          FROM dq_log GROUP BY 1, 2, 3, 4)"""
EXTRA["overview"] = """
    SELECT b.BatchID, BatchStatus, ProcessDay, ProcessWeek, coalesce(TotalLoadCount, 0) AS TotalLoadCount,
           coalesce(SuccessCount, 0) AS SuccessLoadCount, coalesce(WarningCount, 0) AS WarningLoadCount,
           coalesce(SkippedCount, 0) AS SkippedLoadCount, coalesce(FailedCount, 0) AS FailedLoadCount,
           coalesce(TotalCheckCount, 0) AS TotalDQCheckCount, coalesce(PassCount, 0) AS PassedDQCount,
           coalesce(WarnCount, 0) AS WarningDQCount, coalesce(FailCount, 0) AS FailedDQCount,
           coalesce(CriticalFailCount, 0) AS CriticalDQFailCount
    FROM control b
    LEFT JOIN load_summary l ON l.BatchID = b.BatchID
    LEFT JOIN check_summary c ON c.BatchID = b.BatchID"""

"""The DuckDB statement of every registered query."""

from __future__ import annotations

from oracle.ctes import RED_VALID, TX_VALID, exact, with_ctes
from oracle.logs import BATCH, EXTRA, SNAPSHOT, late_day_checks
from oracle.rules import NAMES, check_sql
from tillworks.plans.registry import QUERIES
from tillworks.plans.tiles import TILES

# Output types by column: whole numbers and amounts; everything else is text or boolean.
_WHOLE = set(
    """household_key basket_id day_no product_id store_id trans_time week_no coupon_upc campaign_id manufacturer
    start_day end_day campaign_duration rows lines loads place copies distinct_rows TotalRowCount SourceRowCount MinDay
    MaxDay DistinctBasketCount DistinctProductCount o_orderkey status_number priority_number InsertedRowCount
    RejectedRowCount UnchangedRowCount BronzeRowCount ValidRowCount DuplicateRowCount DifferenceCount ProcessDay
    ProcessWeek LastProcessValue ProductKey ProductID Manufacturer HouseholdKey HouseholdID CampaignKey CampaignID
    StartDay EndDay CampaignDuration StoreKey StoreID CouponKey CouponUPC DayKey DayNumber WeekNumber surrogate_key
    natural_key BasketID TransactionTime RedemptionCount TargetCount PromotionCount BasketCount HouseholdCount
    ProductCount StoreCount CouponTransactionCount TargetHouseholdCount RedeemingHouseholdCount DistinctCouponCount
    line_count product_count basket_count TotalLoadCount SuccessLoadCount WarningLoadCount SkippedLoadCount
    FailedLoadCount TotalDQCheckCount PassedDQCount WarningDQCount FailedDQCount CriticalDQFailCount DQWarningCount
    CompletedLoadLayerCount CompletedDQLayerCount CheckedRowCount PassedRowCount FailedRowCount SuccessCount
    WarningCount SkippedCount FailedCount TotalCheckCount PassCount WarnCount FailCount CriticalFailCount RowCount
    UnknownCampaignCount UnknownCouponCount UnknownDayCount UnknownHouseholdCount UnknownProductCount
    UnknownStoreCount LoadedRowCount DistinctRecordCount MinSourceDay MaxSourceDay DistinctSourceDayCount
    MinSourceWeek MaxSourceWeek DistinctSourceWeekCount LastSuccessfulDay NetSalesRank QuantityRank
    RedemptionRateRank R_score F_score M_score recency_days frequency TableLoadCount TotalSourceRowCount
    TotalInsertedRowCount TotalRejectedRowCount TotalUnchangedRowCount CheckCount CampaignCount customer_count
    total_baskets campaign_transactions total_transactions promotion_count transaction_count DurationSeconds
    WrongProcessValueCount CriticalFailureCount DuplicateCount ExtraDuplicateRows PromotionRowCount campaigns customers
    batches row_count""".split()
)
_AMOUNTS = set(
    """quantity sales_value retail_disc coupon_disc coupon_match_disc net_sales_value total_price total_discount
    Quantity GrossSalesAmount RetailDiscountAmount CouponDiscountAmount CouponMatchDiscountAmount TotalDiscountAmount
    NetSalesAmount TotalQuantity AverageBasketAmount DiscountRate CouponTransactionRate AverageUnitNetSales
    RedemptionRate CouponUsageRate net_sales total_quantity total_discount_cost gross_sales roi_ratio net_profit
    monetary_value FailureRate AverageDiscountRate avg_baskets_per_customer total_revenue avg_line_value
    avg_basket_value total_units total_sales campaign_adoption_rate revenue_per_customer avg_item_value
    promotion_rate""".split()
)


def _column(name: str) -> str:
    if name in _WHOLE:
        return f"CAST({name} AS BIGINT) AS {name}"
    if name in _AMOUNTS:
        return f"CAST({name} AS DOUBLE) AS {name}"
    return name


def _select(name: str, source: str, tail: str = "") -> str:
    """The query's registered columns from a table, expression or subquery."""
    columns = ", ".join(_column(c) for c in QUERIES[name][1].split())
    body = source if source.startswith("SELECT") else f"SELECT * FROM {source}"
    return with_ctes(f"SELECT {columns} FROM ({body}) {tail}".strip(), EXTRA)


_RECONCILE = """
    SELECT a AS BronzeRowCount, v AS ValidRowCount, a - v AS RejectedRowCount, v - s AS DuplicateRowCount,
           s AS InsertedRowCount, 0 AS DifferenceCount
    FROM (SELECT (SELECT count(*) FROM {raw}) AS a, (SELECT count(*) FROM {raw} WHERE {valid}) AS v,
                 (SELECT count(*) FROM {clean}) AS s)"""
_TX_RECONCILE = _RECONCILE.format(raw="tx_raw", clean="tx_clean", valid=TX_VALID).strip()
_RED_RECONCILE = _RECONCILE.format(raw="red_raw", clean="red_clean", valid=RED_VALID).strip()

_TX_REASON = """
    CASE WHEN basket_id IS NULL THEN 'BASKET_ID_NULL' WHEN product_id IS NULL THEN 'PRODUCT_ID_NULL'
         WHEN day_no IS NULL THEN 'DAY_NULL' WHEN quantity IS NULL THEN 'QUANTITY_NULL'
         WHEN quantity <= 0 THEN 'INVALID_QUANTITY' WHEN sales_value IS NULL THEN 'SALES_VALUE_NULL'
         WHEN sales_value < 0 THEN 'NEGATIVE_SALES_VALUE' END AS RejectReason"""
_RED_REASON = """
    CASE WHEN household_key IS NULL THEN 'HOUSEHOLD_KEY_NULL' WHEN day_no IS NULL THEN 'DAY_NULL'
         WHEN coupon_upc IS NULL THEN 'COUPON_UPC_NULL' END AS RejectReason"""

# the same with deliveries: late by a day, values lost, and the day that the batch is for
_TX_REASONS_BY_BATCH = f"""
    SELECT BatchID, RejectReason, count(*) AS rows FROM (
        SELECT r.BatchID, CASE WHEN basket_id IS NULL THEN 'BASKET_ID_NULL' WHEN product_id IS NULL THEN 'PRODUCT_ID_NULL'
               WHEN day_no IS NULL THEN 'DAY_NULL' WHEN day_no <> ProcessDay THEN 'WRONG_PROCESS_DAY'
               WHEN quantity IS NULL THEN 'QUANTITY_NULL' WHEN quantity <= 0 THEN 'INVALID_QUANTITY'
               WHEN sales_value IS NULL THEN 'SALES_VALUE_NULL' WHEN sales_value < 0 THEN 'NEGATIVE_SALES_VALUE' END AS RejectReason
        FROM (SELECT {BATCH.format("day_no + CASE WHEN product_id % 97 = 0 THEN 1 ELSE 0 END")} AS BatchID, basket_id,
                     CASE WHEN trans_time % 101 <> 1 THEN product_id END AS product_id,
                     CASE WHEN trans_time % 101 <> 2 THEN day_no END AS day_no,
                     CASE WHEN trans_time % 101 <> 3 THEN quantity END AS quantity,
                     CASE WHEN trans_time % 101 <> 4 THEN sales_value END AS sales_value FROM tx_source) r
        JOIN batches b ON b.BatchID = r.BatchID)
    WHERE RejectReason IS NOT NULL GROUP BY 1, 2""".strip()
_RED_REASONS_BY_BATCH = f"""
    SELECT BatchID, RejectReason, count(*) AS rows FROM (
        SELECT r.BatchID, CASE WHEN household_key IS NULL THEN 'HOUSEHOLD_KEY_NULL' WHEN day_no IS NULL THEN 'DAY_NULL'
               WHEN coupon_upc IS NULL THEN 'COUPON_UPC_NULL' WHEN day_no <> ProcessDay THEN 'WRONG_PROCESS_DAY' END AS RejectReason
        FROM (SELECT {BATCH.format("day_no + CASE WHEN household_key % 97 = 0 THEN 1 ELSE 0 END")} AS BatchID, household_key,
                     CASE WHEN campaign_id <> 5 THEN day_no END AS day_no,
                     CASE WHEN campaign_id <> 11 THEN coupon_upc END AS coupon_upc FROM red_source) r
        JOIN batches b ON b.BatchID = r.BatchID)
    WHERE RejectReason IS NOT NULL GROUP BY 1, 2""".strip()

# layer: (table, relation, rule that a row breaks, condition on which the column is blanked)
_BLANKED = {
    "silver": (
        ("transaction_clean", "tx_clean", "basket_id DECIMAL(20,0) NOT NULL", "trans_time % 97 = 0"),
        ("transaction_clean", "tx_clean", "day_no DECIMAL(10,0) NOT NULL", "trans_time % 89 = 0"),
        ("transaction_clean", "tx_clean", "product_id DECIMAL(10,0) NOT NULL", "trans_time % 83 = 0"),
        ("coupon_redemption_clean", "red_clean", "household_key DECIMAL(10,0) NOT NULL", "campaign_id = 5"),
        ("coupon_redemption_clean", "red_clean", "coupon_upc DECIMAL(20,0) NOT NULL", "campaign_id = 7"),
        ("product_clean", "product_clean", "product_id DECIMAL(10,0) NOT NULL", "product_id % 97 = 0"),
        ("household_demographic_clean", "household_clean", "household_key DECIMAL(10,0) NOT NULL", "household_key % 97 = 0"),
        ("campaign_clean", "campaign_clean", "campaign_id DECIMAL(10,0) NOT NULL", "campaign_id = 5"),
        ("campaign_target_clean", "target_clean", "household_key DECIMAL(10,0) NOT NULL", "household_key % 97 = 0"),
        ("campaign_target_clean", "target_clean", "campaign_id DECIMAL(10,0) NOT NULL", "campaign_id = 5"),
        ("coupon_product_clean", "coupon_clean", "coupon_upc DECIMAL(20,0) NOT NULL", "campaign_id = 5"),
        ("coupon_product_clean", "coupon_clean", "product_id DECIMAL(10,0) NOT NULL", "campaign_id = 7"),
        ("promotion_weekly_clean", "promotion_clean", "product_id DECIMAL(10,0) NOT NULL", "week_no % 11 = 0"),
        ("promotion_weekly_clean", "promotion_clean", "store_id DECIMAL(10,0) NOT NULL", "product_id % 97 = 0"),
        ("promotion_weekly_clean", "promotion_clean", "week_no DECIMAL(10,0) NOT NULL", "week_no % 7 = 0"),
    ),
    "audit": (
        ("etl_table_load_log", "load_log", "TargetTableName STRING NOT NULL", "LayerName = 'DM'"),
        ("etl_table_load_log", "load_log", "LoadStatus STRING NOT NULL", "LayerName = 'DM'"),
        ("data_quality_log", "dq_log", "SeverityLevel STRING NOT NULL", "LayerName = 'BRONZE'"),
    ),
    "control": (("etl_batch_control", "control", "BatchStatus STRING NOT NULL", "coalesce(ProcessDay % 97 = 0, FALSE)"),),
}


def _constraint_report(layer: str) -> str:
    lines = _BLANKED[layer]
    parts = [f"SELECT '{t}' AS TableName, '{rule}' AS rule, count(*) AS rows FROM {r} WHERE {lost}" for t, r, rule, lost in lines]
    for table, relation in dict.fromkeys((t, r) for t, r, _, _ in lines):
        kept = " AND ".join(f"NOT ({lost})" for t, _, _, lost in lines if t == table)
        parts.append(f"SELECT '{table}', 'valid', count(*) FROM {relation} WHERE {kept}")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE rows > 0"


_EARLY = """
    SELECT p.*, CASE WHEN CAST(curr_size_of_product AS INTEGER) > 10 THEN curr_size_of_product END AS old_size,
           row_number() OVER (ORDER BY p.product_id) AS old_key
    FROM product_clean p
    JOIN (SELECT product_id FROM tx_clean GROUP BY 1
          HAVING min(day_no) <= (SELECT max(day_no) / 2 FROM tx_clean)) s ON s.product_id = p.product_id"""
_SCD1 = f"""
    SELECT coalesce(old_key, (SELECT count(*) FROM early) + rank_new) AS ProductKey, product_id AS ProductID,
           department AS Department, curr_size_of_product AS CurrentProductSize, TRUE AS IsCurrent,
           CASE WHEN old_key IS NOT NULL AND old_size IS NOT NULL THEN 'FIRST' ELSE 'SECOND' END AS SourceBatchID,
           RecordHash
    FROM (SELECT p.*, e.old_key, e.old_size,
                 row_number() OVER (PARTITION BY e.old_key IS NULL ORDER BY p.product_id) AS rank_new
          FROM product_clean p LEFT JOIN early e ON e.product_id = p.product_id)
    UNION ALL SELECT -1, -1, 'UNKNOWN', 'UNKNOWN', TRUE, 'SYSTEM', 'UNKNOWN'"""

_UNKNOWN_MEMBERS = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, -1 AS surrogate_key, -1 AS natural_key, 'UNKNOWN' AS RecordHash"
    for d in ("dim_product", "dim_household", "dim_campaign", "dim_store", "dim_coupon", "dim_day")
)


def _next(after: str) -> str:
    return f"""
        SELECT printf('RM_DAILY_D%04d', ProcessDay) AS BatchID, {after}
        FROM (SELECT min(day_no) AS ProcessDay,
                     (SELECT min(week_no) FROM causal_source)
                         + (min(day_no) - (SELECT min(day_no) FROM tx_source)) // 7 AS ProcessWeek
              FROM tx_source {{where}})"""


_BOUNDS = (
    "SELECT * FROM (SELECT min(day_no) AS MinSourceDay, max(day_no) AS MaxSourceDay, "
    "count(DISTINCT day_no) AS DistinctSourceDayCount FROM tx_source), "
    "(SELECT min(week_no) AS MinSourceWeek, max(week_no) AS MaxSourceWeek, "
    "count(DISTINCT week_no) AS DistinctSourceWeekCount FROM causal_source)"
)
_FIRST_BATCH = _next("'INITIAL' AS LoadMode, ProcessDay, ProcessWeek").format(where="").strip()
_NEXT_BATCH = (
    _next("'INCREMENTAL' AS LoadMode, ProcessDay, ProcessWeek")
    .format(
        where="WHERE day_no > (SELECT max(ProcessDay) FROM control WHERE BatchStatus <> 'FAILED' "
        "AND ProcessDay <= (SELECT max(day_no) / 2 FROM tx_source))"
    )
    .strip()
)


def _fact_unknowns(fact: str, table: str, keys: str) -> str:
    every = ("Campaign", "Coupon", "Day", "Household", "Product", "Store")
    columns = [
        f"count(*) FILTER ({k}Key = -1) AS Unknown{k}Count" if k in keys.split() else f"NULL AS Unknown{k}Count"
        for k in every
    ]
    return f"SELECT '{fact}' AS FactTable, count(*) AS SourceRowCount, {', '.join(columns)} FROM {table}"


def _loaded(name: str, table: str) -> str:
    return (
        f"SELECT '{name}' AS SourceName, count(*) AS LoadedRowCount, min(day_no) AS MinDay, max(day_no) AS MaxDay, "
        f"count(DISTINCT RecordHash) AS DistinctRecordCount FROM {table}"
    )


_SUMMARY_BY_LAYER = (
    "SELECT LayerName, count(*) AS TotalLoadCount, count(*) FILTER (LoadStatus = 'SUCCESS') AS SuccessCount, "
    "count(*) FILTER (LoadStatus = 'SUCCESS_WITH_WARNING') AS WarningCount, "
    "count(*) FILTER (LoadStatus = 'SKIPPED') AS SkippedCount, count(*) FILTER (LoadStatus = 'FAILED') AS FailedCount, "
    "sum(SourceRowCount) AS SourceRowCount, sum(InsertedRowCount) AS InsertedRowCount, "
    "sum(RejectedRowCount) AS RejectedRowCount, sum(UnchangedRowCount) AS UnchangedRowCount "
    "FROM load_log GROUP BY 1"
)
_BLOCKING = "CheckStatus = 'FAIL' AND SeverityLevel IN ('ERROR', 'CRITICAL')"
_PLACE = "CASE LayerName WHEN 'BRONZE' THEN 1 WHEN 'SILVER' THEN 2 WHEN 'DWH' THEN 3 WHEN 'DM' THEN 4 ELSE 5 END"

_FILES = " UNION ALL ".join(
    f"SELECT '{file}.parquet' AS SourceFile FROM {source}"
    for file, source in (
        ("lineitem", "tx_source"), ("events", "red_source"), ("part", "product_source"),
        ("customer", "household_source"), ("nation", "campaign_source"), ("customer", "target_source"),
        ("part", "coupon_source"), ("lineitem", "causal_source"),
    )
)

_ALL_TEXT = ", ".join(
    f"CAST({c} AS VARCHAR) AS {h}"
    for c, h in (("household_key", "household_key"), ("day_no", "DAY"), ("coupon_upc", "COUPON_UPC"), ("campaign_id", "CAMPAIGN"))
)

_BODIES: dict[str, str] = {
    "s2_typed_csv_days": "SELECT day_no, count(*) AS rows FROM tx_source GROUP BY 1",
    "s3_safe_typing": (
        "SELECT o_orderkey, TRY_CAST(o_orderstatus AS DECIMAL(10,0)) AS status_number, "
        "TRY_CAST(substr(o_orderpriority, 1, 1) AS DECIMAL(10,0)) AS priority_number, "
        "TRY_CAST(o_totalprice AS DECIMAL(18,4)) AS total_price FROM orders"
    ),
    "s4_source_file": f"SELECT SourceFile, count(*) AS rows FROM ({_FILES}) GROUP BY 1",
    "s5_day_slice": "SELECT * FROM tx_raw WHERE day_no = (SELECT max(day_no) FROM tx_raw)",
    "s6_transaction_source": "tx_source",
    "s7_redemption_source": "red_source",
    "s8_source_row_counts": (
        "SELECT 'transaction_data.csv' AS FileName, count(*) AS TotalRowCount FROM tx_source "
        "UNION ALL SELECT 'coupon_redempt.csv', count(*) FROM red_source"
    ),
    "s9_transaction_profile": (
        "SELECT count(*) AS SourceRowCount, min(day_no) AS MinDay, max(day_no) AS MaxDay, "
        "count(DISTINCT basket_id) AS DistinctBasketCount, count(DISTINCT product_id) AS DistinctProductCount "
        "FROM tx_source"
    ),
    "s9_redemption_profile": (
        "SELECT count(*) AS SourceRowCount, min(day_no) AS MinDay, max(day_no) AS MaxDay FROM red_source"
    ),
    **{
        f"s10_{table}": f"SELECT *, '{SNAPSHOT}' AS BatchID FROM {raw}"
        for table, raw in (
            ("product_raw", "product_raw"),
            ("household_demographic_raw", "household_raw"),
            ("campaign_desc_raw", "campaign_raw"),
            ("campaign_target_raw", "target_raw"),
            ("coupon_raw", "coupon_raw"),
            ("causal_data_raw", "causal_raw"),
        )
    },
    "s11_bronze_transactions": (
        f"SELECT *, 'lineitem.parquet' AS SourceFile, 'RETAIL_FILES' AS SourceSystem, '{SNAPSHOT}' AS BatchID FROM tx_raw"
    ),
    "s11_bronze_redemptions": (
        f"SELECT *, 'events.parquet' AS SourceFile, 'RETAIL_FILES' AS SourceSystem, '{SNAPSHOT}' AS BatchID FROM red_raw"
    ),
    "m1_replace_by_batch": (
        "SELECT 'LOADED' AS SourceBatchID, count(*) AS rows, count(DISTINCT RecordHash) AS distinct_rows FROM red_clean "
        f"UNION ALL SELECT 'REJECTED', count(*), count(DISTINCT RecordHash) FROM red_raw WHERE NOT ({RED_VALID})"
    ),
    "m2_run_gate": "SELECT 'open' AS gate, count(*) AS rows FROM tx_clean UNION ALL SELECT 'closed', 0",
    "m3_upsert_log": (
        "SELECT ETLLogID, SourceRowCount, CASE WHEN LayerName = 'BRONZE' THEN 'STARTED' ELSE LoadStatus END AS LoadStatus, "
        "CASE WHEN LayerName = 'BRONZE' THEN 0 ELSE InsertedRowCount END AS InsertedRowCount FROM load_log"
    ),
    "m4_open_batch": (
        f"SELECT BatchID, ProcessDay, ProcessWeek, LoadMode, CASE WHEN BatchID = '{SNAPSHOT}' THEN 'RUNNING' "
        f"ELSE BatchStatus END AS BatchStatus, CASE WHEN BatchID <> '{SNAPSHOT}' THEN ErrorMessage END AS ErrorMessage "
        "FROM control"
    ),
    "m5_seed_watermarks": (
        "SELECT 'transaction_data' AS SourceName, 'DAY' AS WatermarkType, (SELECT max(day_no) FROM tx_source) "
        "AS LastProcessValue, 'Y' AS IsActive UNION ALL SELECT 'coupon_redemption', 'DAY', 0, 'Y' "
        "UNION ALL SELECT 'causal_data', 'WEEK_NO', (SELECT max(week_no) FROM causal_source), 'Y' "
        + " ".join(
            f"UNION ALL SELECT '{s}', 'SNAPSHOT', NULL, 'Y'"
            for s in ("product", "household_demographic", "campaign_desc", "campaign_target", "coupon")
        )
    ),
    "m6_close_log": "load_log",
    "m7_scd1_merge": _SCD1.strip(),
    "m8_replace_checks": (
        "SELECT BatchID, LayerName, count(*) AS rows FROM snapshot_checks WHERE LayerName IN ('DWH', 'DM') GROUP BY 1, 2"
    ),
    "m9_unknown_member": _UNKNOWN_MEMBERS,
    "t1_record_hash": "product_clean",
    "t2_hash_without_null_marker": (
        "SELECT CouponUPC, CampaignID, sha256(concat_ws('||', CAST(CouponUPC AS VARCHAR), CAST(CampaignID AS VARCHAR))) "
        "AS RecordHash FROM coupon_nk"
    ),
    "t3_valid_transactions": f"SELECT * FROM tx_raw WHERE {TX_VALID}",
    "t4_reject_reasons": f"SELECT * FROM (SELECT *, {_TX_REASON} FROM tx_raw) WHERE RejectReason IS NOT NULL",
    "t5_valid_redemptions": f"SELECT * FROM red_raw WHERE {RED_VALID}",
    "t6_redemption_reject_reasons": (
        f"SELECT * FROM (SELECT *, {_RED_REASON} FROM red_raw) WHERE RejectReason IS NOT NULL"
    ),
    "t7_deduplicated_transactions": f"SELECT DISTINCT * FROM tx_raw WHERE {TX_VALID}",
    "t8_deduplicated_redemptions": "red_clean",
    "t9_silver_transactions": "tx_clean",
    "t10_silver_redemptions": f"SELECT *, '{SNAPSHOT}' AS SourceBatchID FROM red_clean",
    "t11_product_clean": "product_clean",
    "t11_household_demographic_clean": "household_clean",
    "t11_campaign_clean": "campaign_clean",
    "t11_campaign_target_clean": "target_clean",
    "t11_coupon_product_clean": "coupon_clean",
    "t11_promotion_weekly_clean": "promotion_clean",
    "t12_total_discount": (
        "SELECT store_id, sum(abs(retail_disc) + abs(coupon_disc) + abs(coupon_match_disc)) AS total_discount "
        "FROM tx_clean GROUP BY 1"
    ),
    "t13_guarded_ratios": "v_daily",
    "t14_redemption_bands": "v_campaigns",
    "t15_promotion_type": (
        "SELECT HasDisplay, HasMailer, PromotionType, count(*) AS rows FROM v_promotions GROUP BY 1, 2, 3"
    ),
    "t16_load_status": "SELECT LayerName, SourceName, LoadStatus, count(*) AS loads FROM load_log GROUP BY 1, 2, 3",
    "t17_parameters": (
        f"SELECT BatchID, 'INITIAL' AS LoadMode, TargetTableName, InsertedRowCount FROM load_log WHERE BatchID = '{SNAPSHOT}'"
    ),
    "j1_sales_fact": "fact_sales",
    "j2_redemption_fact": "fact_redemption",
    "j3_target_fact": "fact_target",
    "j4_promotion_fact": "fact_promotion",
    "j5_fact_attributes": (
        "SELECT Department, Brand, count(*) AS lines, sum(NetSalesAmount) AS NetSalesAmount FROM fact_sales f "
        "LEFT JOIN dim_product p ON p.ProductKey = f.ProductKey GROUP BY 1, 2"
    ),
    "j6_campaigns_with_activity": "dm_campaign",
    "j7_promotions_with_sales": "promotion_joined",
    "j8_one_row_reconciliation": _TX_RECONCILE,
    "j9_days_with_redemptions": (
        "SELECT * FROM dim_day d WHERE EXISTS (SELECT 1 FROM fact_redemption f WHERE f.DayKey = d.DayKey)"
    ),
    "j10_households_without_sales": (
        "SELECT * FROM dim_household h WHERE HouseholdKey <> -1 "
        "AND NOT EXISTS (SELECT 1 FROM fact_sales f WHERE f.HouseholdKey = h.HouseholdKey)"
    ),
    "j11_sales_in_campaign_weeks": (
        "SELECT CampaignID, StartDay, EndDay, count(t.week_no) AS line_count, coalesce(sum(net_sales_value), 0) AS net_sales, "
        "coalesce(sum(quantity), 0) AS total_quantity FROM v_campaigns c "
        "LEFT JOIN tx_clean t ON t.week_no * 7 BETWEEN c.StartDay AND c.EndDay GROUP BY 1, 2, 3"
    ),
    "j12_campaign_weeks_with_costs": "roi",
    "j13_current_products": (
        "SELECT CommodityDescription AS category, count(*) AS lines, sum(quantity) AS quantity FROM tx_clean t "
        "JOIN dim_product p ON p.ProductID = t.product_id WHERE IsCurrent GROUP BY 1"
    ),
    "j14_batches_with_logs": "overview",
    "j15_reference_probe": " UNION ALL ".join(check_sql(key) for key in ("qw20", "qw21", "qw22", "qw23")),
    "a1_daily_sales": "dm_daily",
    "a2_product_sales": "dm_product",
    "a3_campaign_targets": "campaign_targets",
    "a4_campaign_redemptions": "campaign_redemptions",
    "a5_campaign_performance": "dm_campaign",
    "a6_promotion_sales": "promotion_sales",
    "a7_promotion_performance": "dm_promotion",
    "a8_coupon_source": "coupon_nk",
    "a9_day_source": "day_nk",
    "a10_store_source": "store_nk",
    "a11_loads_by_layer": _SUMMARY_BY_LAYER,
    "a12_checks_by_layer": (
        "SELECT LayerName, count(*) AS TotalCheckCount, count(*) FILTER (CheckStatus = 'PASS') AS PassCount, "
        "count(*) FILTER (CheckStatus = 'WARN') AS WarnCount, count(*) FILTER (CheckStatus = 'FAIL') AS FailCount, "
        f"count(*) FILTER ({_BLOCKING}) AS CriticalFailCount FROM dq_log GROUP BY 1"
    ),
    "a13_batch_counters": "verdicts",
    "a14_duplicate_keys": (
        "SELECT 'campaign_target_raw' AS DimensionName, concat_ws('-', campaign_id, household_key) AS NaturalKey, "
        "count(*) AS RowCount FROM target_source GROUP BY 2 HAVING count(*) > 1"
    ),
    "a15_unknown_keys": " UNION ALL ".join(
        (
            _fact_unknowns("fact_sales_transaction", "fact_sales", "Day Household Product Store"),
            _fact_unknowns("fact_coupon_redemption", "fact_redemption", "Campaign Coupon Day Household"),
            _fact_unknowns("fact_campaign_target", "fact_target", "Campaign Household"),
            _fact_unknowns("fact_promotion_weekly", "fact_promotion", "Product Store"),
        )
    ),
    "a16_distinct_records": " UNION ALL ".join(
        (
            _loaded("transaction_data", "tx_raw"),
            _loaded("coupon_redemption", "red_raw"),
            _loaded("transaction_clean", "tx_clean"),
            _loaded("coupon_redemption_clean", "red_clean"),
        )
    ),
    "a17_median_rate": (
        "SELECT CampaignDescription, quantile_disc(RedemptionRate, 0.5) AS RedemptionRate FROM v_campaigns GROUP BY 1"
    ),
    "a18_source_bounds": _BOUNDS,
    "a19_last_successful_day": (
        "SELECT max(ProcessDay) AS LastSuccessfulDay FROM control WHERE BatchStatus IN ('SUCCESS', 'SUCCESS_WITH_WARNING')"
    ),
    "w1_latest_by_hash": (
        "SELECT *, CASE WHEN product_id % 2 = 0 THEN '2023-12-31' ELSE '2024-01-01' END AS ProcessDate, "
        f"CASE WHEN product_id % 2 = 0 THEN 1 ELSE 0 END AS load_hour FROM (SELECT DISTINCT * FROM tx_raw WHERE {TX_VALID})"
    ),
    "w2_latest_by_key": "target_clean",
    "w3_product_rank": "v_products",
    "w4_quantity_rank": "v_products",
    "w5_redemption_rank": "v_campaigns",
    "w6_rfm_scores": "rfm",
    "o1_ordered_days": "v_daily",
    "o2_layers_in_order": f"SELECT *, {_PLACE} AS place FROM ({_SUMMARY_BY_LAYER})",
    "o3_top20_by_rank": "SELECT * FROM v_products ORDER BY NetSalesRank, ProductID LIMIT 20",
    "o3_top20_by_sales": "SELECT * FROM dm_product ORDER BY NetSalesAmount DESC, ProductID LIMIT 20",
    "o4_top10_with_ties": "SELECT * FROM v_products WHERE NetSalesRank <= 10",
    "o5_top_commodities": (
        "SELECT CommodityDescription, sum(NetSalesAmount) AS NetSalesAmount FROM dm_product GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 20"
    ),
    "o6_sample_listing": "SELECT * FROM tx_clean ORDER BY basket_id, product_id, RecordHash LIMIT 30",
    "o7_union_all": (
        "SELECT coupon_upc, campaign_id, count(*) AS rows FROM (SELECT coupon_upc, campaign_id FROM coupon_clean "
        "UNION ALL SELECT coupon_upc, campaign_id FROM red_clean) GROUP BY 1, 2"
    ),
    "o8_union_distinct": "SELECT store_id FROM tx_clean UNION SELECT store_id FROM promotion_clean",
    "o9_distinct": "SELECT DISTINCT product_id, store_id FROM tx_clean",
    "d1_dim_product": "dim_product",
    "d2_dim_household": "dim_household",
    "d3_dim_campaign": "dim_campaign",
    "d4_dim_store": "dim_store",
    "d5_dim_coupon": "dim_coupon",
    "d6_dim_day": "dim_day",
    "d7_dimension_counts": " UNION ALL ".join(
        f"SELECT '{d}' AS DimensionName, count(*) AS RowCount FROM {d}"
        for d in ("dim_product", "dim_household", "dim_campaign", "dim_store", "dim_coupon", "dim_day")
    ),
    "d7_duplicate_natural_keys": (
        "SELECT 'dim_store' AS DimensionName, CAST(StoreID AS VARCHAR) AS NaturalKey, 2 AS RowCount FROM store_nk"
    ),
    "v1_daily_sales_kpi": "v_daily",
    "v2_top_products": "v_products",
    "v3_campaign_performance": "v_campaigns",
    "v4_promotion_performance": "v_promotions",
    "v5_etl_batch_summary": "batch_view",
    "v6_data_quality_summary": "quality_view",
    "v7_promotion_types": (
        "SELECT PromotionType, count(*) AS PromotionRowCount, sum(BasketCount) AS BasketCount, "
        f"sum(NetSalesAmount) AS NetSalesAmount, {exact('sum(DiscountRate)', 'count(*)', 10, scale=6)} "
        "AS AverageDiscountRate FROM v_promotions GROUP BY 1"
    ),
    "b1_first_batch": _FIRST_BATCH,
    "b1_next_batch": _NEXT_BATCH,
    "b2_batch_verdict": "verdicts",
    "b3_batch_close": "control",
    "b4_batch_result": (
        "SELECT BatchID, BatchStatus, (hi - lo) * 60 AS DurationSeconds FROM control "
        "JOIN (SELECT day_no, min(trans_time) AS lo, max(trans_time) AS hi FROM tx_source GROUP BY 1) "
        "ON day_no = ProcessDay"
    ),
    "b4_failed_loads": (
        "SELECT * REPLACE (CASE WHEN LayerName = 'BRONZE' THEN 'STARTED' ELSE LoadStatus END AS LoadStatus) FROM load_log "
        "WHERE LayerName = 'BRONZE' OR LoadStatus = 'FAILED'"
    ),
    "b4_critical_checks": f"SELECT * FROM dq_log WHERE {_BLOCKING}",
    "b4_batch_overview": "overview",
    "b5_silver_reconciliation": _TX_RECONCILE,
    "b5_redemption_reconciliation": _RED_RECONCILE,
    "b6_bronze_reconciliation": (
        "SELECT count(*) AS SourceRowCount, count(*) AS InsertedRowCount FROM tx_source"
    ),
    "b7_wrong_days": "SELECT count(*) AS WrongProcessValueCount FROM tx_raw WHERE day_no <> 1",
    "qr1_daily_checks": "daily_checks",
    "run_batch_control": "two_days_control",
    "run_batch_loads": "two_days_loads",
    "run_batch_checks": "two_days_checks",
    "a18_landed_bounds": _BOUNDS,
    "b1_landed_batch": _NEXT_BATCH,
    "s5_landed_day": "SELECT * FROM tx_source WHERE day_no = (SELECT max(day_no) FROM tx_source)",
    "qr1_process_day_checks": late_day_checks(),
    **{f"s12_{layer}_constraints": _constraint_report(layer) for layer in _BLANKED},
    "s12_types": (
        "SELECT * FROM (SELECT o_orderkey, concat_ws(', ', CASE WHEN o_orderkey % 2 <> 0 THEN 'o_orderpriority DECIMAL(10,0)' END, "
        "CASE WHEN abs(o_totalprice) >= 99999.99995 THEN 'o_totalprice DECIMAL(9,4)' END) AS rules FROM orders) WHERE rules <> ''"
    ),
    "t4_reject_reasons_by_batch": _TX_REASONS_BY_BATCH,
    "t6_reject_reasons_by_batch": _RED_REASONS_BY_BATCH,
    "qr1_detail": (
        "SELECT *, CASE CheckStatus WHEN 'FAIL' THEN 1 WHEN 'WARN' THEN 2 WHEN 'PASS' THEN 3 ELSE 4 END AS place "
        "FROM snapshot_checks WHERE LayerName = 'DWH'"
    ),
    "qr1_mart_detail": (
        "SELECT *, CASE CheckStatus WHEN 'FAIL' THEN 1 WHEN 'WARN' THEN 2 WHEN 'PASS' THEN 3 ELSE 4 END AS place "
        "FROM snapshot_checks WHERE LayerName = 'DM'"
    ),
    "qr1_status_counts": "SELECT LayerName, CheckStatus, count(*) AS CheckCount FROM dq_log GROUP BY 1, 2",
    "qr1_critical_failures": f"SELECT count(*) AS CriticalFailureCount FROM dq_log WHERE {_BLOCKING}",
    "qr2_duplicate_targets": (
        "SELECT CampaignKey, HouseholdKey, count(*) AS DuplicateCount FROM target_source t "
        "JOIN dim_household h ON h.HouseholdID = t.household_key JOIN dim_campaign c ON c.CampaignID = t.campaign_id "
        "GROUP BY 1, 2 HAVING count(*) > 1"
    ),
    "qr2_surplus_targets": (
        "SELECT coalesce(sum(n - 1), 0) AS ExtraDuplicateRows FROM (SELECT count(*) AS n FROM target_source "
        "GROUP BY household_key, campaign_id HAVING count(*) > 1)"
    ),
    "n1_daily_sales": "v_daily",
    "n2_product_performance": "v_products",
    "n3_campaign_performance": "v_campaigns",
    "n4_top_10_products": "SELECT * FROM v_products WHERE NetSalesRank <= 10",
    "n5_department_sales": (
        "SELECT Department, sum(NetSalesAmount) AS NetSalesAmount, sum(GrossSalesAmount) AS GrossSalesAmount, "
        "sum(TotalDiscountAmount) AS TotalDiscountAmount, sum(TotalQuantity) AS TotalQuantity, "
        "sum(BasketCount) AS BasketCount FROM dm_product GROUP BY 1"
    ),
    "n6_promotion_performance": "v_promotions",
    "n7_etl_batches": "batch_view",
    "n8_data_quality": "quality_view",
    "n9_top_commodities": (
        "SELECT CommodityDescription, sum(NetSalesAmount) AS NetSalesAmount FROM dm_product GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 20"
    ),
    "n10_campaign_levels": "levels",
    "n11_rfm": "rfm",
    "n12_campaign_roi": "roi",
    "n13_customer_behaviour": "behaviour",
    "n14_campaign_timing": "timing",
    "n15_store_performance": "stores",
    "n16_category_baskets": "categories",
    "n17_older_daily_kpi": "v_daily",
    "n17_older_top_products": "v_products",
}

_DATASETS = {
    "daily_sales": "v_daily",
    "products": "v_products",
    "top_10_products": "(SELECT * FROM v_products WHERE NetSalesRank <= 10)",
    "campaigns": "v_campaigns",
    "campaign_levels": "levels",
    "promotions": "v_promotions",
    "campaign_roi": "roi",
    "timing": "timing",
    "stores": "stores",
    "categories": "categories",
    "rfm": "rfm",
    "behaviour": "behaviour",
    "batches": "batch_view",
    "checks": "quality_view",
}
# Places of the averaged columns; an average has four more.
_PLACES = {
    "AverageBasketAmount": 4, "monetary_value": 4, "avg_item_value": 8,
    "campaign_adoption_rate": 2, "revenue_per_customer": 2, "promotion_rate": 2,
}


def _tile_sql(name: str) -> str:
    spec = TILES[name]
    source = _DATASETS[spec.dataset]
    if spec.rows:
        return f"SELECT {', '.join(spec.rows)} FROM {source}"
    measures = []
    for column, expression in spec.measures:
        if expression.startswith("avg("):
            scale = _PLACES.get(column, 6)
            expression = exact(f"sum({column})", f"count({column})", scale + 4, scale=scale)
        elif expression.startswith("percentile_approx("):
            expression = f"quantile_disc({column}, 0.5)"
        measures.append(f"{expression} AS {column}")
    where = f" WHERE {spec.where}" if spec.where else ""
    group = f" GROUP BY {', '.join(spec.dims)}" if spec.dims else ""
    return f"SELECT {', '.join([*spec.dims, *measures])} FROM {source}{where}{group}"


EXTRA["early"] = _EARLY


def oracle_sql() -> dict[str, str]:
    statements = {"s1_csv_scan": with_ctes(f"SELECT {_ALL_TEXT} FROM red_source")}
    statements |= {name: _select(name, body) for name, body in _BODIES.items()}
    statements |= {name: _select(name, _tile_sql(name)) for name in TILES}
    statements |= {name: _select(name, check_sql(key)) for name, key in NAMES.items()}
    return statements

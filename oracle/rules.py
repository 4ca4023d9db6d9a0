"""The 85 checks, written down for DuckDB from the meaning of each check and independent of the engine.

A line is: key, log id, table in the log, name, category, severity, status on failure, and what is
checked: rows(relation, least), unique(relation, keys), rule(relation, condition of a bad row),
refs(relation, (column, relation, key) ..) or same(relation, value, source relation, value).
"""

from __future__ import annotations

from oracle.ctes import exact

REC, UNI, REF, BUS = "RECONCILIATION", "UNIQUENESS", "REFERENTIAL_INTEGRITY", "BUSINESS_RULE"


def rows(relation: str, least: int = 1) -> tuple:
    return "rows", relation, least


def unique(relation: str, keys: str) -> tuple:
    return "unique", relation, keys


def rule(relation: str, bad: str, empty_fails: bool = False) -> tuple:
    return "rule", relation, bad, empty_fails


def refs(relation: str, *links: tuple[str, str, str]) -> tuple:
    return "refs", relation, links


def same(relation: str, value: str, source: str, expected: str, amount: bool = False) -> tuple:
    return "same", relation, value, source, expected, amount


_DAILY_METRICS = (
    "BasketCount < 0 OR HouseholdCount < 0 OR ProductCount < 0 OR StoreCount < 0 OR TotalQuantity < 0 OR GrossSalesAmount < 0 "
    "OR TotalDiscountAmount < 0 OR NetSalesAmount < 0 OR AverageBasketAmount < 0 OR NOT (DiscountRate BETWEEN 0 AND 1)"
)
_PRODUCT_METRICS = (
    "BasketCount < 0 OR HouseholdCount < 0 OR StoreCount < 0 OR TotalQuantity < 0 OR GrossSalesAmount < 0 "
    "OR TotalDiscountAmount < 0 OR NetSalesAmount < 0 OR AverageUnitNetSales < 0 OR NOT (DiscountRate BETWEEN 0 AND 1)"
)
_CAMPAIGN_METRICS = (
    "TargetHouseholdCount < 0 OR RedeemingHouseholdCount < 0 OR RedemptionCount < 0 OR DistinctCouponCount < 0 "
    "OR NOT (RedemptionRate BETWEEN 0 AND 1) OR RedeemingHouseholdCount > TargetHouseholdCount"
)
_BAD_LOAD = "LoadStatus IN ('FAILED', 'STARTED')"

CHECKS = (
    ("qb1", "BRONZE_TRANSACTION_DATA_RAW_NOT_EMPTY", "bronze.transaction_data_raw", "transaction_data_raw_not_empty", REC, "CRITICAL", "FAIL", rows("tx_raw")),
    ("qb2", "BRONZE_COUPON_REDEMPTION_RAW_NOT_EMPTY", "bronze.coupon_redemption_raw", "coupon_redemption_raw_not_empty", REC, "WARNING", "WARN", rows("red_raw")),
    ("qb3", "BRONZE_PRODUCT_RAW_NOT_EMPTY", "bronze.product_raw", "product_raw_not_empty", REC, "CRITICAL", "FAIL", rows("product_raw")),
    ("qb4", "BRONZE_HOUSEHOLD_DEMOGRAPHIC_RAW_NOT_EMPTY", "bronze.household_demographic_raw", "household_demographic_raw_not_empty", REC, "CRITICAL", "FAIL", rows("household_raw")),
    ("qb5", "BRONZE_CAMPAIGN_DESC_RAW_NOT_EMPTY", "bronze.campaign_desc_raw", "campaign_desc_raw_not_empty", REC, "CRITICAL", "FAIL", rows("campaign_raw")),
    ("qb6", "BRONZE_CAMPAIGN_TARGET_RAW_NOT_EMPTY", "bronze.campaign_target_raw", "campaign_target_raw_not_empty", REC, "CRITICAL", "FAIL", rows("target_raw")),
    ("qb7", "BRONZE_COUPON_RAW_NOT_EMPTY", "bronze.coupon_raw", "coupon_raw_not_empty", REC, "CRITICAL", "FAIL", rows("coupon_raw")),
    ("qb8", "BRONZE_CAUSAL_DATA_RAW_NOT_EMPTY", "bronze.causal_data_raw", "causal_data_raw_not_empty", REC, "CRITICAL", "FAIL", rows("causal_raw")),
    ("qb9", "BRONZE_TRANSACTION_DATA_RAW_REQUIRED_FIELDS", "bronze.transaction_data_raw", "transaction_data_raw_required_fields", BUS, "WARNING", "WARN",
     rule("tx_raw", "basket_id IS NULL OR product_id IS NULL OR day_no IS NULL OR quantity IS NULL OR sales_value IS NULL")),
    ("qb10", "BRONZE_COUPON_REDEMPTION_RAW_REQUIRED_FIELDS", "bronze.coupon_redemption_raw", "coupon_redemption_raw_required_fields", BUS, "WARNING", "WARN",
     rule("red_raw", "household_key IS NULL OR day_no IS NULL OR coupon_upc IS NULL")),
    ("qb11", "BRONZE_TRANSACTION_DATA_RAW_PROCESS_DAY", "bronze.transaction_data_raw", "transaction_data_raw_process_day", BUS, "ERROR", "FAIL", rule("tx_raw", "day_no IS NULL")),
    ("qb12", "BRONZE_COUPON_REDEMPTION_RAW_PROCESS_DAY", "bronze.coupon_redemption_raw", "coupon_redemption_raw_process_day", BUS, "ERROR", "FAIL", rule("red_raw", "day_no IS NULL")),
    ("qb13", "BRONZE_CAUSAL_DATA_RAW_PROCESS_WEEK", "bronze.causal_data_raw", "causal_data_raw_process_week", BUS, "ERROR", "FAIL", rule("causal_raw", "week_no IS NULL")),
    ("qb14", "BRONZE_TRANSACTION_DATA_RAW_LINEAGE", "bronze.transaction_data_raw", "transaction_data_raw_lineage", BUS, "CRITICAL", "FAIL", rule("tx_raw", "RecordHash IS NULL")),
    ("qb15", "BRONZE_COUPON_REDEMPTION_RAW_LINEAGE", "bronze.coupon_redemption_raw", "coupon_redemption_raw_lineage", BUS, "CRITICAL", "FAIL", rule("red_raw", "RecordHash IS NULL")),
    ("qb16", "BRONZE_TRANSACTION_DATA_RAW_DUPLICATES", "bronze.transaction_data_raw", "transaction_data_raw_duplicates", UNI, "WARNING", "WARN", unique("tx_raw", "RecordHash")),
    ("qb17", "BRONZE_COUPON_REDEMPTION_RAW_DUPLICATES", "bronze.coupon_redemption_raw", "coupon_redemption_raw_duplicates", UNI, "WARNING", "WARN", unique("red_raw", "RecordHash")),
    ("qb18", "BRONZE_CAMPAIGN_TARGET_RAW_DUPLICATES", "bronze.campaign_target_raw", "campaign_target_raw_duplicates", UNI, "WARNING", "WARN", unique("target_raw", "RecordHash")),
    ("qb19", "BRONZE_CAUSAL_DATA_RAW_DUPLICATES", "bronze.causal_data_raw", "causal_data_raw_duplicates", UNI, "WARNING", "WARN", unique("causal_raw", "RecordHash")),
    ("qs1", "SILVER_TRANSACTION_CLEAN_KEYS_PRESENT", "silver.transaction_clean", "transaction_clean_keys_present", BUS, "CRITICAL", "FAIL", rule("tx_clean", "basket_id IS NULL OR day_no IS NULL OR product_id IS NULL")),
    ("qs2", "SILVER_COUPON_REDEMPTION_CLEAN_KEYS_PRESENT", "silver.coupon_redemption_clean", "coupon_redemption_clean_keys_present", BUS, "CRITICAL", "FAIL", rule("red_clean", "household_key IS NULL OR day_no IS NULL OR coupon_upc IS NULL")),
    ("qs3", "SILVER_PRODUCT_CLEAN_KEYS_PRESENT", "silver.product_clean", "product_clean_keys_present", BUS, "CRITICAL", "FAIL", rule("product_clean", "product_id IS NULL")),
    ("qs4", "SILVER_HOUSEHOLD_DEMOGRAPHIC_CLEAN_KEYS_PRESENT", "silver.household_demographic_clean", "household_demographic_clean_keys_present", BUS, "CRITICAL", "FAIL", rule("household_clean", "household_key IS NULL")),
    ("qs5", "SILVER_CAMPAIGN_CLEAN_KEYS_PRESENT", "silver.campaign_clean", "campaign_clean_keys_present", BUS, "CRITICAL", "FAIL", rule("campaign_clean", "campaign_id IS NULL")),
    ("qs6", "SILVER_CAMPAIGN_TARGET_CLEAN_KEYS_PRESENT", "silver.campaign_target_clean", "campaign_target_clean_keys_present", BUS, "CRITICAL", "FAIL", rule("target_clean", "household_key IS NULL OR campaign_id IS NULL")),
    ("qs7", "SILVER_COUPON_PRODUCT_CLEAN_KEYS_PRESENT", "silver.coupon_product_clean", "coupon_product_clean_keys_present", BUS, "CRITICAL", "FAIL", rule("coupon_clean", "coupon_upc IS NULL OR product_id IS NULL")),
    ("qs8", "SILVER_PROMOTION_WEEKLY_CLEAN_KEYS_PRESENT", "silver.promotion_weekly_clean", "promotion_weekly_clean_keys_present", BUS, "CRITICAL", "FAIL", rule("promotion_clean", "product_id IS NULL OR store_id IS NULL OR week_no IS NULL")),
    ("qs9", "SILVER_TRANSACTION_CLEAN_UNIQUE", "silver.transaction_clean", "transaction_clean_unique", UNI, "CRITICAL", "FAIL", unique("tx_clean", "RecordHash")),
    ("qs10", "SILVER_COUPON_REDEMPTION_CLEAN_UNIQUE", "silver.coupon_redemption_clean", "coupon_redemption_clean_unique", UNI, "CRITICAL", "FAIL", unique("red_clean", "RecordHash")),
    ("qs11", "SILVER_PRODUCT_CLEAN_UNIQUE", "silver.product_clean", "product_clean_unique", UNI, "CRITICAL", "FAIL", unique("product_clean", "product_id")),
    ("qs12", "SILVER_HOUSEHOLD_DEMOGRAPHIC_CLEAN_UNIQUE", "silver.household_demographic_clean", "household_demographic_clean_unique", UNI, "CRITICAL", "FAIL", unique("household_clean", "household_key")),
    ("qs13", "SILVER_CAMPAIGN_CLEAN_UNIQUE", "silver.campaign_clean", "campaign_clean_unique", UNI, "CRITICAL", "FAIL", unique("campaign_clean", "campaign_id")),
    ("qs14", "SILVER_CAMPAIGN_TARGET_CLEAN_UNIQUE", "silver.campaign_target_clean", "campaign_target_clean_unique", UNI, "CRITICAL", "FAIL", unique("target_clean", "household_key, campaign_id")),
    ("qs15", "SILVER_COUPON_PRODUCT_CLEAN_UNIQUE", "silver.coupon_product_clean", "coupon_product_clean_unique", UNI, "CRITICAL", "FAIL", unique("coupon_clean", "RecordHash")),
    ("qs16", "SILVER_PROMOTION_WEEKLY_CLEAN_UNIQUE", "silver.promotion_weekly_clean", "promotion_weekly_clean_unique", UNI, "CRITICAL", "FAIL", unique("promotion_clean", "RecordHash")),
    ("qs17", "SILVER_CAMPAIGN_CLEAN_DAY_RANGE", "silver.campaign_clean", "campaign_clean_day_range", BUS, "ERROR", "FAIL", rule("campaign_clean", "end_day < start_day")),
    ("qs18", "SILVER_TRANSACTION_CLEAN_PRODUCT_ID_EXISTS", "silver.transaction_clean", "transaction_clean_product_id_exists", REF, "ERROR", "FAIL", refs("tx_clean", ("product_id", "product_clean", "product_id"))),
    ("qs19", "SILVER_TRANSACTION_CLEAN_HOUSEHOLD_KEY_EXISTS", "silver.transaction_clean", "transaction_clean_household_key_exists", REF, "WARNING", "WARN", refs("tx_clean", ("household_key", "household_clean", "household_key"))),
    ("qs20", "SILVER_COUPON_REDEMPTION_CLEAN_CAMPAIGN_ID_EXISTS", "silver.coupon_redemption_clean", "coupon_redemption_clean_campaign_id_exists", REF, "ERROR", "FAIL", refs("red_clean", ("campaign_id", "campaign_clean", "campaign_id"))),
    ("qs21", "SILVER_CAMPAIGN_TARGET_CLEAN_CAMPAIGN_ID_EXISTS", "silver.campaign_target_clean", "campaign_target_clean_campaign_id_exists", REF, "ERROR", "FAIL", refs("target_clean", ("campaign_id", "campaign_clean", "campaign_id"))),
    ("qw1", "DWH_DIM_PRODUCT_NOT_EMPTY", "dwh.dim_product", "dim_product_not_empty", REC, "CRITICAL", "FAIL", rows("dim_product", 2)),
    ("qw2", "DWH_DIM_HOUSEHOLD_NOT_EMPTY", "dwh.dim_household", "dim_household_not_empty", REC, "CRITICAL", "FAIL", rows("dim_household", 2)),
    ("qw3", "DWH_DIM_CAMPAIGN_NOT_EMPTY", "dwh.dim_campaign", "dim_campaign_not_empty", REC, "CRITICAL", "FAIL", rows("dim_campaign", 2)),
    ("qw4", "DWH_DIM_STORE_NOT_EMPTY", "dwh.dim_store", "dim_store_not_empty", REC, "CRITICAL", "FAIL", rows("dim_store", 2)),
    ("qw5", "DWH_DIM_COUPON_NOT_EMPTY", "dwh.dim_coupon", "dim_coupon_not_empty", REC, "CRITICAL", "FAIL", rows("dim_coupon", 2)),
    ("qw6", "DWH_DIM_DAY_NOT_EMPTY", "dwh.dim_day", "dim_day_not_empty", REC, "CRITICAL", "FAIL", rows("dim_day", 2)),
    ("qw7", "DWH_FACT_SALES_NOT_EMPTY", "dwh.fact_sales_transaction", "fact_sales_not_empty", REC, "CRITICAL", "FAIL", rows("fact_sales")),
    ("qw8", "DWH_FACT_CAMPAIGN_TARGET_NOT_EMPTY", "dwh.fact_campaign_target", "fact_campaign_target_not_empty", REC, "CRITICAL", "FAIL", rows("fact_target")),
    ("qw9", "DWH_FACT_PROMOTION_NOT_EMPTY", "dwh.fact_promotion_weekly", "fact_promotion_weekly_not_empty", REC, "CRITICAL", "FAIL", rows("fact_promotion")),
    ("qw10", "DWH_DIM_PRODUCT_NK_UNIQUE", "dwh.dim_product", "product_natural_key_unique", UNI, "CRITICAL", "FAIL", unique("(SELECT * FROM dim_product WHERE ProductKey <> -1)", "ProductID")),
    ("qw11", "DWH_DIM_HOUSEHOLD_NK_UNIQUE", "dwh.dim_household", "household_natural_key_unique", UNI, "CRITICAL", "FAIL", unique("(SELECT * FROM dim_household WHERE HouseholdKey <> -1)", "HouseholdID")),
    ("qw12", "DWH_DIM_CAMPAIGN_NK_UNIQUE", "dwh.dim_campaign", "campaign_natural_key_unique", UNI, "CRITICAL", "FAIL", unique("(SELECT * FROM dim_campaign WHERE CampaignKey <> -1)", "CampaignID")),
    ("qw13", "DWH_DIM_STORE_NK_UNIQUE", "dwh.dim_store", "store_natural_key_unique", UNI, "CRITICAL", "FAIL", unique("(SELECT * FROM dim_store WHERE StoreKey <> -1)", "StoreID")),
    ("qw14", "DWH_DIM_COUPON_NK_UNIQUE", "dwh.dim_coupon", "coupon_natural_key_unique", UNI, "CRITICAL", "FAIL", unique("(SELECT * FROM dim_coupon WHERE CouponKey <> -1)", "CouponUPC")),
    ("qw15", "DWH_DIM_DAY_NK_UNIQUE", "dwh.dim_day", "day_natural_key_unique", UNI, "CRITICAL", "FAIL", unique("(SELECT * FROM dim_day WHERE DayKey <> -1)", "DayNumber")),
    ("qw16", "DWH_FACT_SALES_GRAIN_UNIQUE", "dwh.fact_sales_transaction", "sales_fact_grain_unique", UNI, "CRITICAL", "FAIL", unique("fact_sales", "RecordHash")),
    ("qw17", "DWH_FACT_COUPON_GRAIN_UNIQUE", "dwh.fact_coupon_redemption", "coupon_redemption_fact_grain_unique", UNI, "CRITICAL", "FAIL", unique("fact_redemption", "RecordHash")),
    ("qw18", "DWH_FACT_CAMPAIGN_TARGET_GRAIN_UNIQUE", "dwh.fact_campaign_target", "campaign_target_fact_grain_unique", UNI, "CRITICAL", "FAIL", unique("fact_target", "RecordHash")),
    ("qw19", "DWH_FACT_PROMOTION_GRAIN_UNIQUE", "dwh.fact_promotion_weekly", "promotion_weekly_fact_grain_unique", UNI, "CRITICAL", "FAIL", unique("fact_promotion", "RecordHash")),
    ("qw20", "DWH_FACT_SALES_RI", "dwh.fact_sales_transaction", "sales_fact_dimension_referential_integrity", REF, "CRITICAL", "FAIL",
     refs("fact_sales", ("ProductKey", "dim_product", "ProductKey"), ("HouseholdKey", "dim_household", "HouseholdKey"), ("StoreKey", "dim_store", "StoreKey"), ("DayKey", "dim_day", "DayKey"))),
    ("qw21", "DWH_FACT_COUPON_RI", "dwh.fact_coupon_redemption", "coupon_fact_dimension_referential_integrity", REF, "CRITICAL", "FAIL",
     refs("fact_redemption", ("HouseholdKey", "dim_household", "HouseholdKey"), ("CouponKey", "dim_coupon", "CouponKey"), ("CampaignKey", "dim_campaign", "CampaignKey"), ("DayKey", "dim_day", "DayKey"))),
    ("qw22", "DWH_FACT_CAMPAIGN_TARGET_RI", "dwh.fact_campaign_target", "campaign_target_fact_dimension_referential_integrity", REF, "CRITICAL", "FAIL",
     refs("fact_target", ("HouseholdKey", "dim_household", "HouseholdKey"), ("CampaignKey", "dim_campaign", "CampaignKey"))),
    ("qw23", "DWH_FACT_PROMOTION_RI", "dwh.fact_promotion_weekly", "promotion_fact_dimension_referential_integrity", REF, "CRITICAL", "FAIL",
     refs("fact_promotion", ("ProductKey", "dim_product", "ProductKey"), ("StoreKey", "dim_store", "StoreKey"))),
    ("qw24", "DWH_FACT_SALES_UNKNOWN_KEYS", "dwh.fact_sales_transaction", "sales_fact_unknown_key_usage", REF, "WARNING", "WARN", rule("fact_sales", "least(ProductKey, HouseholdKey, StoreKey, DayKey) = -1")),
    ("qw25", "DWH_SALES_RECONCILIATION", "dwh.fact_sales_transaction", "silver_to_sales_fact_reconciliation", REC, "CRITICAL", "FAIL", same("fact_sales", "count(*)", "tx_clean", "count(*)")),
    ("qw26", "DWH_CAMPAIGN_TARGET_RECONCILIATION", "dwh.fact_campaign_target", "silver_to_campaign_target_fact_reconciliation", REC, "CRITICAL", "FAIL", same("fact_target", "count(*)", "target_clean", "count(*)")),
    ("qw27", "DWH_PROMOTION_RECONCILIATION", "dwh.fact_promotion_weekly", "silver_to_promotion_fact_reconciliation", REC, "CRITICAL", "FAIL", same("fact_promotion", "count(*)", "promotion_clean", "count(*)")),
    ("qw28", "DWH_LOAD_STATUS", "audit.etl_table_load_log", "dwh_load_status_check", REC, "CRITICAL", "FAIL", rule("loads_dwh", _BAD_LOAD, True)),
    ("qm1", "DM_DAILY_SALES_NOT_EMPTY", "dm_marketing.dm_daily_sales", "dm_daily_sales_not_empty", REC, "CRITICAL", "FAIL", rows("dm_daily")),
    ("qm2", "DM_PRODUCT_SALES_NOT_EMPTY", "dm_marketing.dm_product_sales", "dm_product_sales_not_empty", REC, "CRITICAL", "FAIL", rows("dm_product")),
    ("qm3", "DM_CAMPAIGN_PERFORMANCE_NOT_EMPTY", "dm_marketing.dm_campaign_performance", "dm_campaign_performance_not_empty", REC, "CRITICAL", "FAIL", rows("dm_campaign")),
    ("qm4", "DM_PROMOTION_PERFORMANCE_NOT_EMPTY", "dm_marketing.dm_promotion_performance", "dm_promotion_performance_not_empty", REC, "CRITICAL", "FAIL", rows("dm_promotion")),
    ("qm5", "DM_DAILY_SALES_DAY", "dm_marketing.dm_daily_sales", "dm_daily_sales_process_day_check", BUS, "ERROR", "FAIL", rule("dm_daily", "DayNumber IS NULL")),
    ("qm6", "DM_PROMOTION_WEEK", "dm_marketing.dm_promotion_performance", "dm_promotion_process_week_check", BUS, "ERROR", "FAIL", rule("dm_promotion", "WeekNumber IS NULL")),
    ("qm7", "DM_DAILY_SALES_GRAIN_UNIQUE", "dm_marketing.dm_daily_sales", "dm_daily_sales_grain_unique", UNI, "CRITICAL", "FAIL", unique("dm_daily", "DayKey")),
    ("qm8", "DM_PRODUCT_SALES_GRAIN_UNIQUE", "dm_marketing.dm_product_sales", "dm_product_sales_grain_unique", UNI, "CRITICAL", "FAIL", unique("dm_product", "ProductKey")),
    ("qm9", "DM_CAMPAIGN_GRAIN_UNIQUE", "dm_marketing.dm_campaign_performance", "dm_campaign_performance_grain_unique", UNI, "CRITICAL", "FAIL", unique("dm_campaign", "CampaignKey")),
    ("qm10", "DM_PROMOTION_GRAIN_UNIQUE", "dm_marketing.dm_promotion_performance", "dm_promotion_performance_grain_unique", UNI, "CRITICAL", "FAIL", unique("dm_promotion", "ProductKey, StoreKey, WeekNumber, HasDisplay, HasMailer")),
    ("qm11", "DM_DAILY_SALES_METRICS", "dm_marketing.dm_daily_sales", "dm_daily_sales_metric_rules", BUS, "CRITICAL", "FAIL", rule("dm_daily", _DAILY_METRICS)),
    ("qm12", "DM_PRODUCT_SALES_METRICS", "dm_marketing.dm_product_sales", "dm_product_sales_metric_rules", BUS, "CRITICAL", "FAIL", rule("dm_product", _PRODUCT_METRICS)),
    ("qm13", "DM_CAMPAIGN_METRICS", "dm_marketing.dm_campaign_performance", "dm_campaign_metric_rules", BUS, "CRITICAL", "FAIL", rule("dm_campaign", _CAMPAIGN_METRICS)),
    ("qm14", "DM_DAILY_SALES_RECONCILIATION", "dm_marketing.dm_daily_sales", "dwh_to_dm_daily_sales_reconciliation", REC, "CRITICAL", "FAIL", same("dm_daily", "sum(NetSalesAmount)", "fact_sales", "sum(NetSalesAmount)", True)),
    ("qm15", "DM_PRODUCT_SALES_RECONCILIATION", "dm_marketing.dm_product_sales", "dwh_to_dm_product_sales_reconciliation", REC, "CRITICAL", "FAIL", same("dm_product", "sum(NetSalesAmount)", "fact_sales", "sum(NetSalesAmount)", True)),
    ("qm16", "DM_CAMPAIGN_TARGET_RECONCILIATION", "dm_marketing.dm_campaign_performance", "dwh_to_dm_campaign_target_reconciliation", REC, "CRITICAL", "FAIL", same("dm_campaign", "sum(TargetHouseholdCount)", "fact_target", "count(*)")),
    ("qm17", "DM_LOAD_STATUS", "audit.etl_table_load_log", "dm_load_status_check", REC, "CRITICAL", "FAIL", rule("loads_dm", _BAD_LOAD, True)),
)
BY_KEY = {line[0]: line for line in CHECKS}
NAMES = {f"{key}_{line[3]}": key for key, line in BY_KEY.items()}
_LAYER = {"qb": "BRONZE", "qs": "SILVER", "qw": "DWH", "qm": "DM"}

#: How a daily batch finds its rows of a relation: (rows with their day or week as g, column of the batch).
DAILY = {
    "tx_raw": ("SELECT *, day_no AS g FROM tx_raw", "ProcessDay"),
    "red_raw": ("SELECT *, day_no AS g FROM red_raw", "ProcessDay"),
    "causal_raw": ("SELECT *, week_no AS g FROM causal_raw", "ProcessWeek"),
    "tx_clean": ("SELECT *, day_no AS g FROM tx_clean", "ProcessDay"),
    "red_clean": ("SELECT *, day_no AS g FROM red_clean", "ProcessDay"),
    "promotion_clean": ("SELECT *, week_no AS g FROM promotion_clean", "ProcessWeek"),
    "fact_sales": ("SELECT f.*, DayNumber AS g FROM fact_sales f JOIN dim_day d ON d.DayKey = f.DayKey", "ProcessDay"),
    "fact_redemption": ("SELECT f.*, DayNumber AS g FROM fact_redemption f JOIN dim_day d ON d.DayKey = f.DayKey", "ProcessDay"),
    "fact_promotion": ("SELECT *, WeekNumber AS g FROM fact_promotion", "ProcessWeek"),
    "dm_daily": ("SELECT *, DayNumber AS g FROM dm_daily", "ProcessDay"),
    "dm_product": ("SELECT *, ProcessDay AS g FROM dm_product_by_day", "ProcessDay"),
    "dm_campaign": ("SELECT *, ProcessDay AS g FROM dm_campaign_by_day", "ProcessDay"),
    "dm_promotion": ("SELECT *, WeekNumber AS g FROM dm_promotion", "ProcessWeek"),
    "loads_dwh": ("SELECT l.*, ProcessDay AS g FROM load_log l JOIN batches b ON b.BatchID = l.BatchID WHERE LayerName = 'DWH'", "ProcessDay"),
    "loads_dm": ("SELECT l.*, ProcessDay AS g FROM load_log l JOIN batches b ON b.BatchID = l.BatchID WHERE LayerName = 'DM'", "ProcessDay"),
}
_SNAPSHOT_LOADS = {
    "loads_dwh": "(SELECT * FROM load_log WHERE BatchID = 'RM_SNAPSHOT' AND LayerName = 'DWH')",
    "loads_dm": "(SELECT * FROM load_log WHERE BatchID = 'RM_SNAPSHOT' AND LayerName = 'DM')",
}


def _grouped(relation: str, daily: dict | None) -> tuple[str, str]:
    """Rows with their group g, and the batch's column that g is matched with."""
    if daily and relation in daily:
        return f"({daily[relation][0]})", daily[relation][1]
    return f"(SELECT *, 0 AS g FROM {_SNAPSHOT_LOADS.get(relation, relation)})", "nothing"


def check_sql(key: str, daily: dict | None = None, line: tuple | None = None) -> str:
    """One log row of the check for the snapshot, or with `daily` one for each batch."""
    _, ident, table, name, category, severity, on_failure, spec = line or BY_KEY[key]
    kind, relation = spec[:2]
    owners = "(SELECT *, 0 AS nothing FROM batches)" if daily else "(SELECT 'RM_SNAPSHOT' AS BatchID, 0 AS nothing)"
    from_, column = _grouped(relation, daily)
    if kind == "rows":
        counted = f"SELECT g, count(*) AS n FROM {from_} GROUP BY g"
        few = f"coalesce(n, 0) < {spec[2]}"
        values = f"coalesce(n, 0) AS n, CASE WHEN {few} THEN 0 ELSE coalesce(n, 0) END AS passed, CASE WHEN {few} THEN 1 ELSE 0 END AS failed, CASE WHEN {few} THEN 1 ELSE 0 END AS rate"
    elif kind == "unique":
        per_key = f"SELECT g, {spec[2]}, count(*) AS c FROM {from_} GROUP BY ALL"
        counted = f"SELECT g, sum(c) AS n, count(*) FILTER (c > 1) AS bad FROM ({per_key}) GROUP BY g"
        values = "coalesce(n, 0) AS n, NULL AS passed, coalesce(bad, 0) AS failed, NULL AS rate"
    elif kind in ("rule", "refs"):
        if kind == "rule":
            joins, bad, empty = "", spec[2], "1" if spec[3] else "0"
        else:
            joins = "".join(f" LEFT JOIN {other} r{i} ON r{i}.{k} = f.{c}" for i, (c, other, k) in enumerate(spec[2]))
            bad, empty = " OR ".join(f"r{i}.{k} IS NULL" for i, (_, _, k) in enumerate(spec[2])), "0"
        counted = f"SELECT g, count(*) AS n, count(*) FILTER ({bad}) AS bad FROM {from_} f{joins} GROUP BY g"
        share = exact("coalesce(bad, 0)", "coalesce(n, 0)", 6, scale=0, empty=empty)
        values = f"coalesce(n, 0) AS n, coalesce(n - bad, 0) AS passed, CASE WHEN n IS NULL THEN {empty} ELSE bad END AS failed, {share} AS rate"
    else:
        _, _, value, source, expected, amount = spec
        other, other_column = _grouped(source, daily)
        counted = f"SELECT g, {value} AS b FROM {from_} GROUP BY g"
        sourced = f"SELECT g, {expected} AS a FROM {other} GROUP BY g"
        gap = "abs(coalesce(a, 0) - coalesce(b, 0))"
        if amount:
            off = f"CASE WHEN {gap} < 0.01 THEN 0 ELSE 1 END"
            values = f"1 AS n, 1 - {off} AS passed, {off} AS failed, {off} AS rate"
        else:
            values = f"coalesce(a, 0) AS n, CASE WHEN {gap} = 0 THEN coalesce(a, 0) ELSE 0 END AS passed, {gap} AS failed, {exact(gap, 'coalesce(a, 0)', 6, scale=0)} AS rate"
        joined = f"{owners} o LEFT JOIN ({counted}) x ON x.g = o.{column} LEFT JOIN ({sourced}) y ON y.g = o.{other_column}"
    if kind != "same":
        joined = f"{owners} o LEFT JOIN ({counted}) x ON x.g = o.{column}"
    return (
        f"SELECT BatchID || '_DQ_{ident}' AS DQLogID, BatchID, '{_LAYER[key[:2]]}' AS LayerName, '{table}' AS TableName, "
        f"'{name}' AS CheckName, '{category}' AS CheckCategory, '{severity}' AS SeverityLevel, CAST(n AS BIGINT) AS CheckedRowCount, "
        f"CAST(passed AS BIGINT) AS PassedRowCount, CAST(failed AS BIGINT) AS FailedRowCount, CAST(rate AS DECIMAL(18,6)) AS FailureRate, "
        f"CASE WHEN failed = 0 THEN 'PASS' ELSE '{on_failure}' END AS CheckStatus FROM (SELECT BatchID, {values} FROM {joined})"
    )

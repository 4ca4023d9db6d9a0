"""Every operator and query by name, run over the full-snapshot lake of one folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tillworks.functions.rowops import batch_id, record_hash, total_discount
from tillworks.operators import merge
from tillworks.operators.checks import Check, References, evaluate
from tillworks.operators.constraints import split
from tillworks.operators.dedup import latest_by_key, latest_copy
from tillworks.operators.reconcile import counts, side_by_side
from tillworks.operators.versions import read_partitions
from tillworks.plans import analytics, bronze, control, dims, facts, marts, quality, silver, views
from tillworks.plans.batch import CONTROL_TABLE, DQ_LOG, LOAD_LOG
from tillworks.plans.lake import (
    GRAIN,
    PROCESS_DATE,
    SNAPSHOT,
    Lake,
    all_checks,
    daily_sales,
    dimension_source,
    lake_of,
    product_sales,
    promotion_performance,
    running_batches,
    snapshot_checks,
)
from tillworks.plans.tiles import TILES, tile
from tillworks.schema import (
    BRONZE_TABLE,
    CONTROL,
    DIMENSION_COLUMNS,
    NATURAL_KEY,
    SCHEMAS,
    SOURCES,
    SURROGATE_KEY,
    conform,
    source_columns,
)
from tillworks.session import materialise, scratch_path
from tillworks.sources import csvfiles
from tillworks.sources.landing import landed, landed_values

Query = Callable[[Lake], DataFrame]
QUERIES: dict[str, tuple[Query, str]] = {}


def query(columns: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query with its output columns."""

    def register(run: Query) -> Query:
        QUERIES[name or run.__name__] = (run, columns)
        return run

    return register


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Output types that any engine shares: whole numbers as BIGINT, other decimals as DOUBLE."""
    plain = []
    for c in columns:
        t = df.schema[c].dataType
        if isinstance(t, T.DecimalType):
            plain.append(F.col(c).cast("bigint" if t.scale == 0 else "double").alias(c))
        elif isinstance(t, T.IntegerType):
            plain.append(F.col(c).cast("bigint").alias(c))
        else:
            plain.append(F.col(c))
    return df.select(*plain)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    build, columns = QUERIES[name]
    return present(build(lake_of(spark, folder)), columns.split())


# --- scans and sources ------------------------------------------------------------------------
@query("household_key DAY COUPON_UPC CAMPAIGN")
def s1_csv_scan(lake: Lake) -> DataFrame:
    return csvfiles.scan(lake.spark, lake.csv("coupon_redempt"), "coupon_redempt")


@query("day_no rows")
def s2_typed_csv_days(lake: Lake) -> DataFrame:
    rows = csvfiles.read_source(lake.spark, lake.csv("transaction_data"), "transaction_data")
    return rows.filter(F.col("day_no").isNotNull()).groupBy("day_no").agg(F.count("*").alias("rows"))


@query("o_orderkey status_number priority_number total_price")
def s3_safe_typing(lake: Lake) -> DataFrame:
    orders = lake.spark.read.parquet(f"{lake.folder}/orders.parquet")
    return orders.select(
        "o_orderkey",
        F.col("o_orderstatus").try_cast("decimal(10,0)").alias("status_number"),
        F.substring("o_orderpriority", 1, 1).try_cast("decimal(10,0)").alias("priority_number"),
        F.col("o_totalprice").cast("string").try_cast("decimal(18,4)").alias("total_price"),
    )


@query("SourceFile rows")
def s4_source_file(lake: Lake) -> DataFrame:
    files = [lake[f"bronze.{t}"].select("SourceFile") for t in BRONZE_TABLE.values()]
    return reduce(DataFrame.union, files).groupBy("SourceFile").agg(F.count("*").alias("rows"))


@query("household_key basket_id day_no product_id quantity sales_value store_id")
def s5_day_slice(lake: Lake) -> DataFrame:
    rows = lake["bronze.transaction_data_raw"]
    return csvfiles.slice_of(rows, "day_no", rows.agg(F.max("day_no")).scalar())


_TRANSACTION = " ".join(source_columns("transaction_data"))
_REDEMPTION = " ".join(source_columns("coupon_redempt"))


@query(_TRANSACTION)
def s6_transaction_source(lake: Lake) -> DataFrame:
    return csvfiles.read_source(lake.spark, lake.csv("transaction_data"), "transaction_data")


@query(_REDEMPTION)
def s7_redemption_source(lake: Lake) -> DataFrame:
    return csvfiles.read_source(lake.spark, lake.csv("coupon_redempt"), "coupon_redempt")


@query("FileName TotalRowCount")
def s8_source_row_counts(lake: Lake) -> DataFrame:
    names = ("transaction_data", "coupon_redempt")
    return csvfiles.row_counts({n: csvfiles.scan(lake.spark, lake.csv(n), n) for n in names})


@query("SourceRowCount MinDay MaxDay DistinctBasketCount DistinctProductCount")
def s9_transaction_profile(lake: Lake) -> DataFrame:
    return csvfiles.profile_transactions(s6_transaction_source(lake))


@query("SourceRowCount MinDay MaxDay")
def s9_redemption_profile(lake: Lake) -> DataFrame:
    return csvfiles.profile_redemptions(s7_redemption_source(lake))


def _master_from_csv(source: str) -> Query:
    def build(lake: Lake) -> DataFrame:
        rows = csvfiles.read_source(lake.spark, lake.csv(source), source)
        return bronze.to_bronze(rows, source, SNAPSHOT, PROCESS_DATE)

    return build


for _source in SOURCES:
    if _source not in ("transaction_data", "coupon_redempt"):
        _columns = " ".join([*source_columns(_source), "BatchID", "RecordHash"])
        query(_columns, f"s10_{BRONZE_TABLE[_source]}")(_master_from_csv(_source))


@query(f"{_TRANSACTION} SourceFile SourceSystem BatchID RecordHash")
def s11_bronze_transactions(lake: Lake) -> DataFrame:
    return lake["bronze.transaction_data_raw"]


@query(f"{_REDEMPTION} SourceFile SourceSystem BatchID RecordHash")
def s11_bronze_redemptions(lake: Lake) -> DataFrame:
    return lake["bronze.coupon_redemption_raw"]


# --- re-runnable loads ------------------------------------------------------------------------
@query("SourceBatchID rows distinct_rows")
def m1_replace_by_batch(lake: Lake) -> DataFrame:
    """First load raw copies, then rerun the batch with clean rows beside another batch."""
    path = scratch_path(lake.spark, "replace-by-batch")
    raw, clean = lake["bronze.coupon_redemption_raw"], lake["silver.coupon_redemption_clean"]
    columns = [*source_columns("coupon_redempt"), "RecordHash"]
    rejected = silver.invalid_redemptions(raw).select(*columns)
    merge.replace_by_batch(raw.select(*columns), path, {"SourceBatchID": "LOADED"})
    merge.replace_by_batch(rejected, path, {"SourceBatchID": "REJECTED"})
    merge.replace_by_batch(clean.select(*columns), path, {"SourceBatchID": "LOADED"})
    table = read_partitions(lake.spark, path, 1)
    return table.groupBy("SourceBatchID").agg(
        F.count("*").alias("rows"), F.countDistinct("RecordHash").alias("distinct_rows")
    )


@query("gate rows")
def m2_run_gate(lake: Lake) -> DataFrame:
    rows = lake["silver.transaction_clean"]
    open_rows = merge.only_when_running(rows, running_batches(lake), SNAPSHOT)
    closed_rows = merge.only_when_running(rows, lake["control.etl_batch_control"], SNAPSHOT)
    return counts({"open": open_rows, "closed": closed_rows}, "gate", "rows")


_LOG_KEYS = "ETLLogID BatchID LayerName SourceName TargetTableName LoadStrategy"


@query("ETLLogID LoadStatus SourceRowCount InsertedRowCount")
def m3_upsert_log(lake: Lake) -> DataFrame:
    """Reopen the Bronze rows of the log; every other row must stay as it is."""
    log = lake["audit.etl_table_load_log"]
    reopened = log.filter("LayerName = 'BRONZE'").withColumns(
        {"LoadStatus": F.lit("STARTED"), "InsertedRowCount": F.lit(0).cast("decimal(20,0)")}
    )
    return merge.upsert(log, reopened, "ETLLogID")


@query("BatchID ProcessDay ProcessWeek LoadMode BatchStatus ErrorMessage")
def m4_open_batch(lake: Lake) -> DataFrame:
    closed = lake["control.etl_batch_control"]
    return control.open_batch(closed, SNAPSHOT, PROCESS_DATE, None, None, " initial ", "tester")


@query("SourceName WatermarkType LastProcessValue IsActive")
def m5_seed_watermarks(lake: Lake) -> DataFrame:
    """Two sources have progress already; the others are added."""
    progress = []
    for source, table, column in (
        ("transaction_data", "transaction_data_raw", "day_no"),
        ("causal_data", "causal_data_raw", "week_no"),
    ):
        progress.append(
            lake[f"bronze.{table}"]
            .agg(F.max(column).cast("decimal(20,0)").alias("LastProcessValue"))
            .withColumns(
                {
                    "SourceName": F.lit(source),
                    "WatermarkType": F.lit("OLD"),
                    "IsActive": F.lit("N"),
                    "ETLTime": F.current_timestamp(),
                }
            )
        )
    present_rows = conform(progress[0].unionByName(progress[1]), CONTROL["source_watermark"])
    return control.seed_watermarks(present_rows)


@query(f"{_LOG_KEYS} SourceRowCount InsertedRowCount RejectedRowCount UnchangedRowCount LoadStatus ErrorMessage")
def m6_close_log(lake: Lake) -> DataFrame:
    return lake["audit.etl_table_load_log"]


def _early_products(lake: Lake) -> DataFrame:
    """Products sold in the first half of the days, as their first load had them: without size."""
    sales = lake["silver.transaction_clean"].groupBy("product_id").agg(F.min("day_no").alias("first_sale"))
    middle = lake["silver.transaction_clean"].agg(F.max("day_no") / 2).scalar()
    early = sales.filter(F.col("first_sale") <= middle).select(F.col("product_id").alias("ProductID"))
    attributes = dims.master_source(lake["silver.product_clean"], "dim_product").join(early, "ProductID")
    unsized = F.when(F.col("CurrentProductSize").cast("int") > 10, F.col("CurrentProductSize"))
    return attributes.withColumn("CurrentProductSize", unsized).withColumn(
        "RecordHash", record_hash(*DIMENSION_COLUMNS["dim_product"])
    )


@query("ProductKey ProductID Department CurrentProductSize IsCurrent SourceBatchID RecordHash")
def m7_scd1_merge(lake: Lake) -> DataFrame:
    first = materialise(
        merge.merge_dimension(None, _early_products(lake), "dim_product", "FIRST"), "first-products"
    )
    return merge.merge_dimension(first, dimension_source(lake, "dim_product"), "dim_product", "SECOND")


@query("BatchID LayerName rows")
def m8_replace_checks(lake: Lake) -> DataFrame:
    """Write the checks of a batch and layer twice; each layer of the batch is kept once."""
    path = scratch_path(lake.spark, "replace-checks")
    layers = ("DWH", "DM", "DWH")
    log = snapshot_checks(lake, [c for c in all_checks().values() if c.layer in layers])
    for layer in layers:
        rows = log.filter(F.col("LayerName") == layer)
        merge.replace_by_batch(rows, path, {"BatchID": SNAPSHOT, "LayerName": layer})
    return read_partitions(lake.spark, path, 2).groupBy("BatchID", "LayerName").agg(F.count("*").alias("rows"))


@query("dimension surrogate_key natural_key RecordHash")
def m9_unknown_member(lake: Lake) -> DataFrame:
    """Seeding again adds nothing: one unknown member per dimension."""
    parts = []
    for name, dim in lake.dims().items():
        seeded = merge.seed_unknown(dim, name).filter(F.col(SURROGATE_KEY[name]) == -1)
        parts.append(
            seeded.select(
                F.lit(name).alias("dimension"),
                F.col(SURROGATE_KEY[name]).alias("surrogate_key"),
                F.col(NATURAL_KEY[name]).cast("bigint").alias("natural_key"),
                "RecordHash",
            )
        )
    return reduce(DataFrame.unionByName, parts)


# --- declared schemas -------------------------------------------------------------------------
# Required columns blanked by a condition on the row; only these layers declare required columns.
_BLANKED = {
    "silver": {
        "transaction_clean": {"basket_id": "trans_time % 97 = 0", "day_no": "trans_time % 89 = 0", "product_id": "trans_time % 83 = 0"},
        "coupon_redemption_clean": {"household_key": "campaign_id = 5", "coupon_upc": "campaign_id = 7"},
        "product_clean": {"product_id": "product_id % 97 = 0"},
        "household_demographic_clean": {"household_key": "household_key % 97 = 0"},
        "campaign_clean": {"campaign_id": "campaign_id = 5"},
        "campaign_target_clean": {"household_key": "household_key % 97 = 0", "campaign_id": "campaign_id = 5"},
        "coupon_product_clean": {"coupon_upc": "campaign_id = 5", "product_id": "campaign_id = 7"},
        "promotion_weekly_clean": {"product_id": "week_no % 11 = 0", "store_id": "product_id % 97 = 0", "week_no": "week_no % 7 = 0"},
    },
    "audit": {
        "etl_table_load_log": {"LoadStatus": "LayerName = 'DM'", "TargetTableName": "LayerName = 'DM'"},
        "data_quality_log": {"SeverityLevel": "LayerName = 'BRONZE'"},
    },
    "control": {"etl_batch_control": {"BatchStatus": "ProcessDay % 97 = 0"}},
}


def _constraint_report(layer: str) -> Query:
    """Rows per broken rule of the declared schemas, and the valid rows, after blanking."""

    def of_table(lake: Lake, name: str) -> DataFrame:
        lost = {c: F.when(F.expr(on), F.lit(None)).otherwise(F.col(c)) for c, on in _BLANKED[layer][name].items()}
        rows = split(lake[f"{layer}.{name}"].withColumns(lost), SCHEMAS[f"{layer}.{name}"])
        return rows.select(F.lit(name).alias("TableName"), F.explode_outer("BrokenRules").alias("rule"))

    def run(lake: Lake) -> DataFrame:
        found = reduce(DataFrame.unionByName, [of_table(lake, name) for name in _BLANKED[layer]])
        return found.groupBy("TableName", F.coalesce("rule", F.lit("valid")).alias("rule")).agg(F.count("*").alias("rows"))

    return run


for _layer in _BLANKED:
    query("TableName rule rows", f"s12_{_layer}_constraints")(_constraint_report(_layer))


@query("o_orderkey rules")
def s12_types(lake: Lake) -> DataFrame:
    """The reject side: order texts that do not fit the declared types."""
    schema = T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_orderpriority", T.DecimalType(10, 0)), T.StructField("o_totalprice", T.DecimalType(9, 4))])
    orders = lake.spark.read.parquet(f"{lake.folder}/orders.parquet").withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 2 == 0, F.substring("o_orderpriority", 1, 1)).otherwise(F.col("o_orderpriority"))
    )
    texts = orders.select("o_orderkey", "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"))
    return split(texts, schema).select("o_orderkey", F.array_join("BrokenRules", ", ").alias("rules")).filter("rules <> ''")


# --- row transforms ---------------------------------------------------------------------------
@query("product_id RecordHash")
def t1_record_hash(lake: Lake) -> DataFrame:
    rows = lake.source("product")
    return rows.withColumn("RecordHash", record_hash(*source_columns("product")))


@query("CouponUPC CampaignID RecordHash")
def t2_hash_without_null_marker(lake: Lake) -> DataFrame:
    source = dimension_source(lake, "dim_coupon")
    return source.withColumn("RecordHash", record_hash("CouponUPC", "CampaignID", mark_nulls=False))


@query(f"{_TRANSACTION} RecordHash")
def t3_valid_transactions(lake: Lake) -> DataFrame:
    return silver.valid_transactions(lake["bronze.transaction_data_raw"])


@query(f"{_TRANSACTION} RejectReason")
def t4_reject_reasons(lake: Lake) -> DataFrame:
    return silver.invalid_transactions(lake["bronze.transaction_data_raw"])


def _delivered(lake: Lake, table: str, key: str) -> DataFrame:
    """Bronze rows as delivered for one batch per day, some a day late: `ProcessDay` is the delivery's."""
    late = (F.pmod(F.coalesce(F.col(key), F.lit(1)).cast("bigint"), F.lit(97)) == 0).cast("int")
    rows = lake[f"bronze.{table}"].withColumn("ProcessDay", (F.col("day_no") + late).cast("decimal(10,0)"))
    return rows.withColumn("BatchID", batch_id(F.col("ProcessDay"))).drop("ProcessDay")


def _with_control_day(lake: Lake, rows: DataFrame) -> DataFrame:
    """The day that a row's batch is for comes from the batch's control row."""
    return rows.join(running_batches(lake).select("BatchID", "ProcessDay"), "BatchID")


def _reasons(rows: DataFrame) -> DataFrame:
    return rows.groupBy("BatchID", "RejectReason").agg(F.count("*").alias("rows"))


@query("BatchID RejectReason rows")
def t4_reject_reasons_by_batch(lake: Lake) -> DataFrame:
    """All eight codes: rows of another day by late delivery, and values lost on the way by sale time."""
    rows = _delivered(lake, "transaction_data_raw", "product_id")
    lost = F.col("trans_time") % 101
    damaged = {"product_id": 1, "day_no": 2, "quantity": 3, "sales_value": 4}
    rows = rows.withColumns({c: F.when(lost == i, F.lit(None)).otherwise(F.col(c)) for c, i in damaged.items()})
    return _reasons(silver.invalid_transactions(_with_control_day(lake, rows), F.col("ProcessDay")))


@query("BatchID RejectReason rows")
def t6_reject_reasons_by_batch(lake: Lake) -> DataFrame:
    """All four codes, as for transactions."""
    rows = _delivered(lake, "coupon_redemption_raw", "household_key")
    damaged = {"day_no": 5, "coupon_upc": 11}
    rows = rows.withColumns({c: F.when(F.col("campaign_id") == i, F.lit(None)).otherwise(F.col(c)) for c, i in damaged.items()})
    return _reasons(silver.invalid_redemptions(_with_control_day(lake, rows), F.col("ProcessDay")))


@query(f"{_REDEMPTION} RecordHash")
def t5_valid_redemptions(lake: Lake) -> DataFrame:
    return silver.valid_redemptions(lake["bronze.coupon_redemption_raw"])


@query(f"{_REDEMPTION} RejectReason")
def t6_redemption_reject_reasons(lake: Lake) -> DataFrame:
    return silver.invalid_redemptions(lake["bronze.coupon_redemption_raw"])


@query(f"{_TRANSACTION} RecordHash")
def t7_deduplicated_transactions(lake: Lake) -> DataFrame:
    return silver.deduplicated_transactions(t3_valid_transactions(lake))


@query(_REDEMPTION)
def t8_deduplicated_redemptions(lake: Lake) -> DataFrame:
    return latest_copy(t5_valid_redemptions(lake), source_columns("coupon_redempt"))


@query(f"{_TRANSACTION} net_sales_value has_coupon RecordHash")
def t9_silver_transactions(lake: Lake) -> DataFrame:
    return lake["silver.transaction_clean"]


@query(f"{_REDEMPTION} SourceBatchID RecordHash")
def t10_silver_redemptions(lake: Lake) -> DataFrame:
    return lake["silver.coupon_redemption_clean"]


_MASTERS = {
    "product_clean": " ".join(source_columns("product")),
    "household_demographic_clean": " ".join(source_columns("hh_demographic")),
    "campaign_clean": "campaign_id description start_day end_day campaign_duration",
    "campaign_target_clean": "household_key campaign_id description",
    "coupon_product_clean": "coupon_upc product_id campaign_id",
    "promotion_weekly_clean": "product_id store_id week_no display_code mailer_code has_display has_mailer",
}
for _table, _columns in _MASTERS.items():
    query(f"{_columns} RecordHash", f"t11_{_table}")(lambda lake, t=_table: lake[f"silver.{t}"])


@query("store_id total_discount")
def t12_total_discount(lake: Lake) -> DataFrame:
    discount = total_discount("retail_disc", "coupon_disc", "coupon_match_disc")
    return lake["silver.transaction_clean"].groupBy("store_id").agg(F.sum(discount).alias("total_discount"))


@query("DayNumber AverageBasketAmount DiscountRate CouponTransactionRate")
def t13_guarded_ratios(lake: Lake) -> DataFrame:
    return v1_daily_sales_kpi(lake)


@query("CampaignID RedemptionRate CampaignPerformanceLevel")
def t14_redemption_bands(lake: Lake) -> DataFrame:
    return lake["view.campaign_performance"]


@query("HasDisplay HasMailer PromotionType rows")
def t15_promotion_type(lake: Lake) -> DataFrame:
    grouped = v4_promotion_performance(lake).groupBy("HasDisplay", "HasMailer", "PromotionType")
    return grouped.agg(F.count("*").alias("rows"))


@query("LayerName SourceName LoadStatus loads")
def t16_load_status(lake: Lake) -> DataFrame:
    log = lake["audit.etl_table_load_log"]
    return log.groupBy("LayerName", "SourceName", "LoadStatus").agg(F.count("*").alias("loads"))


@query("BatchID LoadMode TargetTableName InsertedRowCount")
def t17_parameters(lake: Lake) -> DataFrame:
    return lake.spark.sql(
        "SELECT TRIM(:batch) AS BatchID, UPPER(TRIM(:mode)) AS LoadMode, TargetTableName, InsertedRowCount "
        "FROM {log} WHERE BatchID = TRIM(:batch)",
        args={"batch": f" {SNAPSHOT} ", "mode": " initial "},
        log=lake["audit.etl_table_load_log"],
    )


# --- joins ------------------------------------------------------------------------------------
_SALES_FACT = (
    "HouseholdKey ProductKey StoreKey DayKey BasketID TransactionTime WeekNumber Quantity GrossSalesAmount "
    "RetailDiscountAmount CouponDiscountAmount CouponMatchDiscountAmount TotalDiscountAmount NetSalesAmount "
    "HasCoupon SourceBatchID RecordHash"
)


@query(_SALES_FACT)
def j1_sales_fact(lake: Lake) -> DataFrame:
    return facts.sales_fact(lake["silver.transaction_clean"], lake.dims(facts.SALES_KEYS))


@query("HouseholdKey CouponKey CampaignKey DayKey RedemptionCount RecordHash")
def j2_redemption_fact(lake: Lake) -> DataFrame:
    return facts.redemption_fact(lake["silver.coupon_redemption_clean"], lake.dims(facts.REDEMPTION_KEYS))


@query("HouseholdKey CampaignKey TargetCount RecordHash")
def j3_target_fact(lake: Lake) -> DataFrame:
    return facts.target_fact(lake["silver.campaign_target_clean"], lake.dims(facts.TARGET_KEYS))


@query("ProductKey StoreKey WeekNumber DisplayCode MailerCode HasDisplay HasMailer PromotionCount RecordHash")
def j4_promotion_fact(lake: Lake) -> DataFrame:
    return facts.promotion_fact(lake["silver.promotion_weekly_clean"], lake.dims(facts.PROMOTION_KEYS))


@query("Department Brand lines NetSalesAmount")
def j5_fact_attributes(lake: Lake) -> DataFrame:
    sales = lake["dwh.fact_sales_transaction"]
    named = sales.join(lake["dwh.dim_product"].select("ProductKey", "Department", "Brand"), "ProductKey", "left")
    return named.groupBy("Department", "Brand").agg(
        F.count("*").alias("lines"), F.sum("NetSalesAmount").alias("NetSalesAmount")
    )


_CAMPAIGN_COUNTS = "TargetHouseholdCount RedeemingHouseholdCount RedemptionCount DistinctCouponCount"


@query(f"CampaignKey CampaignID {_CAMPAIGN_COUNTS}")
def j6_campaigns_with_activity(lake: Lake) -> DataFrame:
    return marts.campaigns_with_activity(
        lake["dwh.dim_campaign"], lake["dwh.fact_campaign_target"], lake["dwh.fact_coupon_redemption"]
    )


@query("ProductKey StoreKey WeekNumber HasDisplay HasMailer PromotionCount BasketCount NetSalesAmount")
def j7_promotions_with_sales(lake: Lake) -> DataFrame:
    return marts.promotions_with_sales(lake["dwh.fact_promotion_weekly"], lake["dwh.fact_sales_transaction"])


_RECONCILED = "BronzeRowCount ValidRowCount RejectedRowCount DuplicateRowCount InsertedRowCount DifferenceCount"


@query(_RECONCILED)
def j8_one_row_reconciliation(lake: Lake) -> DataFrame:
    return b5_silver_reconciliation(lake)


@query("DayNumber WeekNumber")
def j9_days_with_redemptions(lake: Lake) -> DataFrame:
    days = lake["dwh.dim_day"]
    return days.join(lake["dwh.fact_coupon_redemption"].select("DayKey"), "DayKey", "left_semi")


@query("HouseholdID IncomeDescription")
def j10_households_without_sales(lake: Lake) -> DataFrame:
    households = lake["dwh.dim_household"].filter("HouseholdKey <> -1")
    return households.join(lake["dwh.fact_sales_transaction"].select("HouseholdKey"), "HouseholdKey", "left_anti")


@query("CampaignID StartDay EndDay line_count net_sales total_quantity")
def j11_sales_in_campaign_weeks(lake: Lake) -> DataFrame:
    campaigns = lake["view.campaign_performance"].select("CampaignID", "StartDay", "EndDay")
    return analytics.sales_in_campaign_weeks(lake["silver.transaction_clean"], campaigns)


_ROI = (
    "CampaignID CampaignDescription CampaignPerformanceLevel RedemptionCount TargetHouseholdCount "
    "RedeemingHouseholdCount RedemptionRate total_discount_cost gross_sales net_sales basket_count "
    "roi_ratio net_profit roi_category"
)


@query("CampaignID WeekNumber PromotionType total_discount_cost net_sales product_count")
def j12_campaign_weeks_with_costs(lake: Lake) -> DataFrame:
    return n12_campaign_roi(lake)


@query("category lines quantity")
def j13_current_products(lake: Lake) -> DataFrame:
    current = lake["dwh.dim_product"].filter("IsCurrent").select(
        F.col("ProductID").alias("product_id"), F.col("CommodityDescription").alias("category")
    )
    joined = lake["silver.transaction_clean"].join(current, "product_id")
    return joined.groupBy("category").agg(F.count("*").alias("lines"), F.sum("quantity").alias("quantity"))


_OVERVIEW = (
    "BatchID BatchStatus ProcessDay ProcessWeek TotalLoadCount SuccessLoadCount WarningLoadCount SkippedLoadCount "
    "FailedLoadCount TotalDQCheckCount PassedDQCount WarningDQCount FailedDQCount CriticalDQFailCount"
)


@query(_OVERVIEW)
def j14_batches_with_logs(lake: Lake) -> DataFrame:
    return b4_batch_overview(lake)


@query("CheckName CheckedRowCount FailedRowCount CheckStatus")
def j15_reference_probe(lake: Lake) -> DataFrame:
    checks = [c for c in quality.dwh_checks().values() if isinstance(c, References)]
    return evaluate(checks, lake.layer("dwh"))


# --- aggregations -----------------------------------------------------------------------------
_DAILY = (
    "DayKey DayNumber WeekNumber BasketCount HouseholdCount ProductCount StoreCount TotalQuantity GrossSalesAmount "
    "TotalDiscountAmount NetSalesAmount CouponTransactionCount AverageBasketAmount DiscountRate"
)
_PRODUCT_SALES = (
    "ProductKey ProductID Department Brand CommodityDescription BasketCount HouseholdCount StoreCount TotalQuantity "
    "GrossSalesAmount TotalDiscountAmount NetSalesAmount CouponTransactionCount AverageUnitNetSales DiscountRate"
)
_CAMPAIGN_MART = (
    f"CampaignKey CampaignID CampaignDescription StartDay EndDay CampaignDuration {_CAMPAIGN_COUNTS} RedemptionRate"
)
_PROMOTION_MART = (
    "ProductKey ProductID StoreKey StoreID WeekNumber HasDisplay HasMailer PromotionCount BasketCount TotalQuantity "
    "GrossSalesAmount TotalDiscountAmount NetSalesAmount AverageBasketAmount"
)


@query(_DAILY)
def a1_daily_sales(lake: Lake) -> DataFrame:
    return daily_sales(lake)


@query(_PRODUCT_SALES)
def a2_product_sales(lake: Lake) -> DataFrame:
    return product_sales(lake)


@query("CampaignKey TargetHouseholdCount")
def a3_campaign_targets(lake: Lake) -> DataFrame:
    return marts.campaign_targets(lake["dwh.fact_campaign_target"])


@query("CampaignKey RedeemingHouseholdCount RedemptionCount DistinctCouponCount")
def a4_campaign_redemptions(lake: Lake) -> DataFrame:
    return marts.campaign_redemptions(lake["dwh.fact_coupon_redemption"])


@query(_CAMPAIGN_MART)
def a5_campaign_performance(lake: Lake) -> DataFrame:
    return marts.campaign_performance(
        lake["dwh.dim_campaign"],
        lake["dwh.fact_campaign_target"],
        lake["dwh.fact_coupon_redemption"],
        SNAPSHOT,
        PROCESS_DATE,
    )


@query("ProductKey StoreKey WeekNumber BasketCount TotalQuantity GrossSalesAmount TotalDiscountAmount NetSalesAmount")
def a6_promotion_sales(lake: Lake) -> DataFrame:
    return marts.promotion_sales(lake["dwh.fact_sales_transaction"])


@query(_PROMOTION_MART)
def a7_promotion_performance(lake: Lake) -> DataFrame:
    return promotion_performance(lake)


@query("CouponUPC CampaignID RecordHash")
def a8_coupon_source(lake: Lake) -> DataFrame:
    return dimension_source(lake, "dim_coupon")


@query("DayNumber WeekNumber RecordHash")
def a9_day_source(lake: Lake) -> DataFrame:
    return dimension_source(lake, "dim_day")


@query("StoreID RecordHash")
def a10_store_source(lake: Lake) -> DataFrame:
    return dimension_source(lake, "dim_store")


_LOAD_SUMMARY = (
    "LayerName TotalLoadCount SuccessCount WarningCount SkippedCount FailedCount SourceRowCount InsertedRowCount "
    "RejectedRowCount UnchangedRowCount"
)
_CHECK_SUMMARY = "LayerName TotalCheckCount PassCount WarnCount FailCount CriticalFailCount"


@query(_LOAD_SUMMARY)
def a11_loads_by_layer(lake: Lake) -> DataFrame:
    return views.load_summary(lake["audit.etl_table_load_log"], "LayerName")


@query(_CHECK_SUMMARY)
def a12_checks_by_layer(lake: Lake) -> DataFrame:
    return views.check_summary(lake["audit.data_quality_log"], "LayerName")


_STATUS = (
    "BatchID FailedLoadCount WarningLoadCount CriticalDQFailCount DQWarningCount CompletedLoadLayerCount "
    "CompletedDQLayerCount"
)


def _batch_status(lake: Lake) -> DataFrame:
    return control.batch_status(
        running_batches(lake), lake["audit.etl_table_load_log"], lake["audit.data_quality_log"]
    )


@query(_STATUS)
def a13_batch_counters(lake: Lake) -> DataFrame:
    return _batch_status(lake)


@query("DimensionName NaturalKey RowCount")
def a14_duplicate_keys(lake: Lake) -> DataFrame:
    """Natural keys repeated in the unmerged sources: campaign targets are loaded twice for some."""
    targets = lake["bronze.campaign_target_raw"].select(
        F.concat_ws("-", F.col("campaign_id").cast("string"), F.col("household_key").cast("string")).alias("NaturalKey")
    )
    repeated = targets.groupBy("NaturalKey").agg(F.count("*").alias("RowCount")).filter("RowCount > 1")
    found = repeated.withColumn("DimensionName", F.lit("campaign_target_raw"))
    return found.unionByName(dims.duplicate_natural_keys(lake.dims()))


_UNKNOWN = (
    "FactTable SourceRowCount UnknownCampaignCount UnknownCouponCount UnknownDayCount UnknownHouseholdCount "
    "UnknownProductCount UnknownStoreCount"
)


@query(_UNKNOWN)
def a15_unknown_keys(lake: Lake) -> DataFrame:
    return facts.unknown_keys(
        {n.removeprefix("dwh."): df for n, df in lake.layer("dwh").items() if n.startswith("dwh.fact_")}
    )


@query("SourceName LoadedRowCount MinDay MaxDay DistinctRecordCount")
def a16_distinct_records(lake: Lake) -> DataFrame:
    return bronze.loaded_counts(
        {
            "transaction_data": lake["bronze.transaction_data_raw"],
            "coupon_redemption": lake["bronze.coupon_redemption_raw"],
            "transaction_clean": lake["silver.transaction_clean"],
            "coupon_redemption_clean": lake["silver.coupon_redemption_clean"],
        }
    )


@query("CampaignDescription RedemptionRate")
def a17_median_rate(lake: Lake) -> DataFrame:
    return _tile("g06_median_rate")(lake)


_BOUNDS = (
    "MinSourceDay MaxSourceDay DistinctSourceDayCount MinSourceWeek MaxSourceWeek DistinctSourceWeekCount"
)


@query(_BOUNDS)
def a18_source_bounds(lake: Lake) -> DataFrame:
    return control.source_bounds(lake["bronze.transaction_data_raw"], lake["bronze.causal_data_raw"])


@query("LastSuccessfulDay")
def a19_last_successful_day(lake: Lake) -> DataFrame:
    return control.last_successful_day(lake["control.etl_batch_control"])


# --- windows ----------------------------------------------------------------------------------
@query(f"{_TRANSACTION} RecordHash ProcessDate load_hour")
def w1_latest_by_hash(lake: Lake) -> DataFrame:
    """Lines with an even product are loaded again an hour later, for the day before: the later load wins
    although its process date is the earlier one."""
    first = t3_valid_transactions(lake).withColumn("ETLTime", F.col("ProcessDate").cast("timestamp"))
    again = first.filter(F.col("product_id") % 2 == 0).withColumns(
        {"ProcessDate": F.date_sub("ProcessDate", 1), "ETLTime": F.col("ETLTime") + F.expr("INTERVAL 1 HOUR")}
    )
    latest = silver.deduplicated_transactions(first.unionByName(again))
    return latest.withColumns({"load_hour": F.hour("ETLTime"), "ProcessDate": F.col("ProcessDate").cast("string")})


@query("household_key campaign_id description")
def w2_latest_by_key(lake: Lake) -> DataFrame:
    targets = lake["bronze.campaign_target_raw"].select("household_key", "campaign_id", "description", "ETLTime")
    return latest_by_key(targets, ["household_key", "campaign_id"], ["ETLTime"])


@query("ProductID NetSalesAmount NetSalesRank")
def w3_product_rank(lake: Lake) -> DataFrame:
    return lake["view.top_products"]


@query("ProductID TotalQuantity QuantityRank")
def w4_quantity_rank(lake: Lake) -> DataFrame:
    return lake["view.top_products"]


@query("CampaignID RedemptionRate RedemptionRateRank")
def w5_redemption_rank(lake: Lake) -> DataFrame:
    return lake["view.campaign_performance"]


@query("household_key R_score F_score M_score")
def w6_rfm_scores(lake: Lake) -> DataFrame:
    return lake["analytics.rfm"]


# --- sort, limit, set operations --------------------------------------------------------------
@query("DayNumber NetSalesAmount")
def o1_ordered_days(lake: Lake) -> DataFrame:
    return v1_daily_sales_kpi(lake).orderBy("DayNumber")


@query("LayerName TotalLoadCount place")
def o2_layers_in_order(lake: Lake) -> DataFrame:
    return a11_loads_by_layer(lake).withColumn("place", views.layer_order()).orderBy("place")


_TOP = "ProductID Department Brand NetSalesAmount TotalQuantity DiscountRate"


@query(f"{_TOP} NetSalesRank")
def o3_top20_by_rank(lake: Lake) -> DataFrame:
    return lake["view.top_products"].orderBy("NetSalesRank", "ProductID").limit(20)


@query(_TOP)
def o3_top20_by_sales(lake: Lake) -> DataFrame:
    return lake["dm_marketing.dm_product_sales"].orderBy(F.desc("NetSalesAmount"), "ProductID").limit(20)


@query("ProductID CommodityDescription Department NetSalesAmount TotalQuantity NetSalesRank")
def o4_top10_with_ties(lake: Lake) -> DataFrame:
    return n4_top_10_products(lake)


@query("CommodityDescription NetSalesAmount")
def o5_top_commodities(lake: Lake) -> DataFrame:
    return analytics.top_commodities(lake["dm_marketing.dm_product_sales"])


@query("basket_id product_id day_no quantity sales_value net_sales_value coupon_disc coupon_match_disc has_coupon")
def o6_sample_listing(lake: Lake) -> DataFrame:
    rows = lake["silver.transaction_clean"]
    return rows.orderBy("basket_id", "product_id", "RecordHash").limit(30)


@query("coupon_upc campaign_id rows")
def o7_union_all(lake: Lake) -> DataFrame:
    listed = lake["silver.coupon_product_clean"].select("coupon_upc", "campaign_id")
    both = listed.unionByName(lake["silver.coupon_redemption_clean"].select("coupon_upc", "campaign_id"))
    return both.groupBy("coupon_upc", "campaign_id").agg(F.count("*").alias("rows"))


@query("store_id")
def o8_union_distinct(lake: Lake) -> DataFrame:
    sold = lake["silver.transaction_clean"].select("store_id")
    return sold.union(lake["silver.promotion_weekly_clean"].select("store_id")).distinct()


@query("product_id store_id")
def o9_distinct(lake: Lake) -> DataFrame:
    return lake["silver.transaction_clean"].select("product_id", "store_id").distinct()


# --- dimensions, views, batch products --------------------------------------------------------
for _dim, _attributes in DIMENSION_COLUMNS.items():
    _columns = " ".join([SURROGATE_KEY[_dim], *_attributes, "IsCurrent", "SourceBatchID", "RecordHash"])
    _number = 1 + list(DIMENSION_COLUMNS).index(_dim)
    query(_columns, f"d{_number}_{_dim}")(lambda lake, d=_dim: lake[f"dwh.{d}"])


@query("DimensionName RowCount")
def d7_dimension_counts(lake: Lake) -> DataFrame:
    return dims.dimension_counts(lake.dims())


@query("DimensionName NaturalKey RowCount")
def d7_duplicate_natural_keys(lake: Lake) -> DataFrame:
    """None in the merged dimensions; shown over two stacked copies of the store dimension."""
    stores = lake["dwh.dim_store"]
    return dims.duplicate_natural_keys({**lake.dims(), "dim_store": stores.unionByName(stores)})


@query(f"{_DAILY} CouponTransactionRate SourceBatchID")
def v1_daily_sales_kpi(lake: Lake) -> DataFrame:
    return views.daily_sales_kpi(lake["dm_marketing.dm_daily_sales"])


@query(f"{_PRODUCT_SALES} CouponUsageRate NetSalesRank QuantityRank SourceBatchID")
def v2_top_products(lake: Lake) -> DataFrame:
    return lake["view.top_products"]


@query(f"{_CAMPAIGN_MART} CampaignPerformanceLevel RedemptionRateRank SourceBatchID")
def v3_campaign_performance(lake: Lake) -> DataFrame:
    return lake["view.campaign_performance"]


@query(f"{_PROMOTION_MART} PromotionType DiscountRate SourceBatchID")
def v4_promotion_performance(lake: Lake) -> DataFrame:
    return views.promotion_performance(lake["dm_marketing.dm_promotion_performance"])


_BATCHES = (
    "BatchID ProcessDay ProcessWeek LoadMode BatchStatus TableLoadCount SuccessCount WarningCount SkippedCount "
    "FailedCount TotalSourceRowCount TotalInsertedRowCount TotalRejectedRowCount TotalUnchangedRowCount"
)
_QUALITY = "BatchID LayerName CheckStatus SeverityLevel CheckCount CheckedRowCount FailedRowCount FailureRate"


@query(_BATCHES)
def v5_etl_batch_summary(lake: Lake) -> DataFrame:
    return views.etl_batch_summary(lake["control.etl_batch_control"], lake["audit.etl_table_load_log"])


@query(_QUALITY)
def v6_data_quality_summary(lake: Lake) -> DataFrame:
    return views.data_quality_summary(lake["audit.data_quality_log"])


@query("PromotionType PromotionRowCount BasketCount NetSalesAmount AverageDiscountRate")
def v7_promotion_types(lake: Lake) -> DataFrame:
    return views.promotion_type_summary(v4_promotion_performance(lake))


_PLAN = "BatchID LoadMode ProcessDay ProcessWeek"


def _planned(lake: Lake, done: DataFrame) -> DataFrame:
    return control.next_batch(lake["bronze.transaction_data_raw"], lake["bronze.causal_data_raw"], done)


@query(_PLAN)
def b1_first_batch(lake: Lake) -> DataFrame:
    return _planned(lake, running_batches(lake))


@query(_PLAN)
def b1_next_batch(lake: Lake) -> DataFrame:
    """With the batches of the first half of the days done."""
    done = lake["control.etl_batch_control"]
    middle = lake["bronze.transaction_data_raw"].agg(F.max("day_no") / 2).scalar()
    return _planned(lake, done.filter(F.col("ProcessDay") <= middle))


@query(f"{_STATUS} CalculatedBatchStatus")
def b2_batch_verdict(lake: Lake) -> DataFrame:
    return _batch_status(lake)


@query("BatchID ProcessDay ProcessWeek LoadMode BatchStatus ErrorMessage")
def b3_batch_close(lake: Lake) -> DataFrame:
    return lake["control.etl_batch_control"]


@query("BatchID BatchStatus DurationSeconds")
def b4_batch_result(lake: Lake) -> DataFrame:
    """Durations from given times: a batch lasts from its first to its last sale of the day, with
    the sale time read as a number of minutes."""
    times = lake["bronze.transaction_data_raw"].groupBy(F.col("day_no").alias("ProcessDay")).agg(
        F.min("trans_time").alias("first"), F.max("trans_time").alias("last")
    )
    start = F.col("ProcessDate").cast("timestamp")

    def minutes(c: str) -> Column:
        return F.make_dt_interval(mins=F.col(c).cast("int"))

    timed = lake["control.etl_batch_control"].join(times, "ProcessDay").withColumns(
        {"StartTime": start + minutes("first"), "EndTime": start + minutes("last")}
    )
    return control.with_duration(timed)


@query("ETLLogID LayerName SourceName LoadStatus")
def b4_failed_loads(lake: Lake) -> DataFrame:
    """With the Bronze loads reopened: those never got past STARTED and count as failed too."""
    return control.failed_loads(m3_upsert_log(lake))


@query("DQLogID LayerName CheckName SeverityLevel FailedRowCount FailureRate CheckStatus")
def b4_critical_checks(lake: Lake) -> DataFrame:
    return control.critical_checks(lake["audit.data_quality_log"])


@query(_OVERVIEW)
def b4_batch_overview(lake: Lake) -> DataFrame:
    return control.batch_overview(
        lake["control.etl_batch_control"], lake["audit.etl_table_load_log"], lake["audit.data_quality_log"]
    )


@query(_RECONCILED)
def b5_silver_reconciliation(lake: Lake) -> DataFrame:
    raw = lake["bronze.transaction_data_raw"]
    kept = silver.deduplicated_transactions(silver.valid_transactions(raw))
    clean = lake["silver.transaction_clean"]
    return silver.reconcile(raw, silver.is_valid_transaction(), silver.transaction_reason(), kept, clean)


@query(_RECONCILED)
def b5_redemption_reconciliation(lake: Lake) -> DataFrame:
    raw, clean = lake["bronze.coupon_redemption_raw"], lake["silver.coupon_redemption_clean"]
    return silver.reconcile(raw, silver.is_valid_redemption(), silver.redemption_reason(), t8_deduplicated_redemptions(lake), clean)


@query("SourceRowCount InsertedRowCount")
def b6_bronze_reconciliation(lake: Lake) -> DataFrame:
    rows = F.count("*")
    return side_by_side(
        {
            "SourceRowCount": (lake.source("transaction_data"), rows),
            "InsertedRowCount": (lake["bronze.transaction_data_raw"], rows),
        }
    )


@query("WrongProcessValueCount")
def b7_wrong_days(lake: Lake) -> DataFrame:
    """Rows of the snapshot that do not belong to day 1."""
    return bronze.wrong_days(lake["bronze.transaction_data_raw"], 1)


# --- two days run one by one: planner, four layers, checks and verdict, from the landing store ----
_LOG = f"{_LOG_KEYS} SourceRowCount InsertedRowCount RejectedRowCount UnchangedRowCount LoadStatus ErrorMessage"


@query("BatchID ProcessDay ProcessWeek LoadMode BatchStatus ErrorMessage")
def run_batch_control(lake: Lake) -> DataFrame:
    return lake.two_days().read(CONTROL_TABLE)


@query(_LOG)
def run_batch_loads(lake: Lake) -> DataFrame:
    return lake.two_days().read(LOAD_LOG)


@query("DQLogID BatchID LayerName TableName CheckName SeverityLevel CheckedRowCount PassedRowCount FailedRowCount FailureRate CheckStatus")
def run_batch_checks(lake: Lake) -> DataFrame:
    return lake.two_days().read(DQ_LOG)


@query("MinSourceDay MaxSourceDay DistinctSourceDayCount MinSourceWeek MaxSourceWeek DistinctSourceWeekCount")
def a18_landed_bounds(lake: Lake) -> DataFrame:
    """Bounds of the sources from the names of the landing store's folders; no row is read."""
    return control.source_bounds(*[landed_values(lake.spark, lake.landing(), s) for s in ("transaction_data", "causal_data")])


@query(_PLAN)
def b1_landed_batch(lake: Lake) -> DataFrame:
    """The batch after those of the first half of the days, planned from folder names."""
    batches = lake["control.etl_batch_control"]  # first, so that the sources are delivered from the stored lines
    days, weeks = (landed_values(lake.spark, lake.landing(), s) for s in ("transaction_data", "causal_data"))
    middle = lake["bronze.transaction_data_raw"].agg(F.max("day_no") / 2).scalar()
    return control.next_batch(days, weeks, batches.filter(F.col("ProcessDay") <= middle))


@query("household_key basket_id day_no product_id quantity sales_value store_id")
def s5_landed_day(lake: Lake) -> DataFrame:
    """The last day's slice, read from its folder only."""
    last = landed_values(lake.spark, lake.landing(), "transaction_data").agg(F.max("day_no")).first()[0]
    return landed(lake.spark, lake.landing(), "transaction_data", int(last))


# --- checks -----------------------------------------------------------------------------------
_CHECK = (
    "DQLogID BatchID LayerName TableName CheckName CheckCategory SeverityLevel CheckedRowCount PassedRowCount "
    "FailedRowCount FailureRate CheckStatus"
)


def _check(check: Check) -> Query:
    return lambda lake: snapshot_checks(lake, [check])


for _key, _spec in all_checks().items():
    query(_CHECK, f"{_key}_{_spec.name}")(_check(_spec))


@query("BatchID CheckName CheckedRowCount PassedRowCount FailedRowCount FailureRate CheckStatus")
def qr1_process_day_checks(lake: Lake) -> DataFrame:
    """The day and week rules of every batch, over rows of which some are delivered a day or week late."""

    def late(table: str, own: str, key: str) -> DataFrame:
        shift = (F.pmod(F.coalesce(F.col(key), F.lit(1)).cast("bigint"), F.lit(97)) == 0).cast("int")
        return lake[table].withColumn(GRAIN[table], (F.col(own) + shift).cast("decimal(10,0)"))

    tables = {
        "bronze.transaction_data_raw": late("bronze.transaction_data_raw", "day_no", "product_id"),
        "bronze.coupon_redemption_raw": late("bronze.coupon_redemption_raw", "day_no", "household_key"),
        "bronze.causal_data_raw": late("bronze.causal_data_raw", "week_no", "product_id"),
        "dm_marketing.dm_daily_sales": late("dm_marketing.dm_daily_sales", "DayNumber", "DayNumber"),
        "dm_marketing.dm_promotion_performance": late("dm_marketing.dm_promotion_performance", "WeekNumber", "ProductID"),
    }
    batches = running_batches(lake).filter("ProcessDay IS NOT NULL").select("BatchID", "ProcessDay", "ProcessWeek")
    return evaluate(quality.process_day_checks(), tables, batches, GRAIN)


@query(_CHECK)
def qr1_daily_checks(lake: Lake) -> DataFrame:
    """All checks, one row per check and daily batch."""
    return lake["audit.data_quality_log"].filter(F.col("BatchID") != SNAPSHOT)


@query("TableName CheckName CheckStatus place")
def qr1_detail(lake: Lake) -> DataFrame:
    snapshot = lake["audit.data_quality_log"].filter(F.col("BatchID") == SNAPSHOT)
    return quality.detail_report(snapshot, "DWH").withColumn("place", views.status_order())


@query("TableName CheckName CheckStatus place")
def qr1_mart_detail(lake: Lake) -> DataFrame:
    snapshot = lake["audit.data_quality_log"].filter(F.col("BatchID") == SNAPSHOT)
    return quality.detail_report(snapshot, "DM").withColumn("place", views.status_order())


@query("LayerName CheckStatus CheckCount")
def qr1_status_counts(lake: Lake) -> DataFrame:
    return quality.status_report(lake["audit.data_quality_log"])


@query("CriticalFailureCount")
def qr1_critical_failures(lake: Lake) -> DataFrame:
    return quality.critical_failures(lake["audit.data_quality_log"])


def _raw_targets(lake: Lake) -> DataFrame:
    """Targets as they would be without the Silver deduplication, with their surrogate keys."""
    raw = lake["bronze.campaign_target_raw"].withColumnRenamed("BatchID", "SourceBatchID")
    return facts.target_fact(raw, lake.dims(facts.TARGET_KEYS))


@query("CampaignKey HouseholdKey DuplicateCount")
def qr2_duplicate_targets(lake: Lake) -> DataFrame:
    return quality.duplicate_targets(_raw_targets(lake))


@query("ExtraDuplicateRows")
def qr2_surplus_targets(lake: Lake) -> DataFrame:
    return quality.surplus_targets(_raw_targets(lake))


# --- analytic queries -------------------------------------------------------------------------
_N1 = (
    "DayNumber WeekNumber BasketCount HouseholdCount ProductCount StoreCount TotalQuantity GrossSalesAmount "
    "TotalDiscountAmount NetSalesAmount CouponTransactionCount AverageBasketAmount DiscountRate CouponTransactionRate"
)
_N2 = (
    "ProductID Department Brand CommodityDescription BasketCount HouseholdCount StoreCount TotalQuantity "
    "GrossSalesAmount TotalDiscountAmount NetSalesAmount CouponTransactionCount AverageUnitNetSales DiscountRate "
    "CouponUsageRate NetSalesRank QuantityRank"
)


@query(_N1)
def n1_daily_sales(lake: Lake) -> DataFrame:
    return v1_daily_sales_kpi(lake).orderBy("DayNumber")


@query(_N2)
def n2_product_performance(lake: Lake) -> DataFrame:
    return lake["view.top_products"].orderBy("NetSalesRank")


@query(
    f"CampaignID CampaignDescription StartDay EndDay CampaignDuration {_CAMPAIGN_COUNTS} RedemptionRate "
    "CampaignPerformanceLevel"
)
def n3_campaign_performance(lake: Lake) -> DataFrame:
    return lake["view.campaign_performance"]


@query("ProductID CommodityDescription Department NetSalesAmount TotalQuantity NetSalesRank")
def n4_top_10_products(lake: Lake) -> DataFrame:
    return lake["view.top_products"].filter("NetSalesRank <= 10").orderBy("NetSalesRank")


@query("Department NetSalesAmount GrossSalesAmount TotalDiscountAmount TotalQuantity BasketCount")
def n5_department_sales(lake: Lake) -> DataFrame:
    return analytics.department_sales(lake["dm_marketing.dm_product_sales"]).orderBy(F.desc("NetSalesAmount"))


@query(
    "ProductID StoreID WeekNumber PromotionType PromotionCount BasketCount TotalQuantity GrossSalesAmount "
    "TotalDiscountAmount NetSalesAmount AverageBasketAmount DiscountRate"
)
def n6_promotion_performance(lake: Lake) -> DataFrame:
    return v4_promotion_performance(lake).orderBy("WeekNumber", "ProductID", "StoreID")


@query(_BATCHES)
def n7_etl_batches(lake: Lake) -> DataFrame:
    return v5_etl_batch_summary(lake)


@query(_QUALITY)
def n8_data_quality(lake: Lake) -> DataFrame:
    return v6_data_quality_summary(lake)


@query("CommodityDescription NetSalesAmount")
def n9_top_commodities(lake: Lake) -> DataFrame:
    return o5_top_commodities(lake)


@query("CampaignPerformanceLevel CampaignCount")
def n10_campaign_levels(lake: Lake) -> DataFrame:
    return analytics.campaign_levels(lake["view.campaign_performance"])


@query("household_key recency_days frequency monetary_value R_score F_score M_score RFM_segment customer_segment")
def n11_rfm(lake: Lake) -> DataFrame:
    return lake["analytics.rfm"]


@query(_ROI)
def n12_campaign_roi(lake: Lake) -> DataFrame:
    return analytics.campaign_roi(lake["view.campaign_performance"], v4_promotion_performance(lake))


@query(
    "customer_group customer_count total_baskets avg_baskets_per_customer total_revenue avg_line_value "
    "avg_basket_value total_units"
)
def n13_customer_behaviour(lake: Lake) -> DataFrame:
    rows = analytics.customer_behaviour(lake["silver.transaction_clean"])
    return rows.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("avg_baskets_per_customer", "avg_line_value")})


@query(
    "day_no week_no day_name month_name campaign_status basket_count net_sales avg_line_value avg_basket_value "
    "customer_count"
)
def n14_campaign_timing(lake: Lake) -> DataFrame:
    return analytics.campaign_timing(lake["silver.transaction_clean"])


@query(
    "store_id basket_count customer_count total_sales avg_line_value avg_basket_value campaign_transactions "
    "total_transactions total_discount campaign_adoption_rate revenue_per_customer"
)
def n15_store_performance(lake: Lake) -> DataFrame:
    return analytics.store_performance(lake["silver.transaction_clean"])


@query(
    "category basket_count customer_count total_sales avg_item_value total_quantity promotion_count "
    "transaction_count promotion_rate"
)
def n16_category_baskets(lake: Lake) -> DataFrame:
    return analytics.category_baskets(lake["silver.transaction_clean"], lake["dwh.dim_product"])


@query(_N1)
def n17_older_daily_kpi(lake: Lake) -> DataFrame:
    return n1_daily_sales(lake)


@query(f"{_PRODUCT_SALES} CouponUsageRate NetSalesRank QuantityRank SourceBatchID")
def n17_older_top_products(lake: Lake) -> DataFrame:
    return lake["view.top_products"]


# --- tiles ------------------------------------------------------------------------------------
DATASETS: dict[str, Query] = {
    "daily_sales": v1_daily_sales_kpi,
    "products": v2_top_products,
    "top_10_products": n4_top_10_products,
    "campaigns": v3_campaign_performance,
    "campaign_levels": n10_campaign_levels,
    "promotions": v4_promotion_performance,
    "campaign_roi": n12_campaign_roi,
    "timing": n14_campaign_timing,
    "stores": n15_store_performance,
    "categories": n16_category_baskets,
    "rfm": n11_rfm,
    "behaviour": n13_customer_behaviour,
    "batches": v5_etl_batch_summary,
    "checks": v6_data_quality_summary,
}


def _tile(name: str) -> Query:
    spec = TILES[name]
    return lambda lake: tile(spec, DATASETS[spec.dataset](lake))


for _name, _tile_spec in TILES.items():
    _columns = " ".join([*_tile_spec.dims, *_tile_spec.rows, *[m for m, _ in _tile_spec.measures]])
    query(_columns, _name)(_tile(_name))

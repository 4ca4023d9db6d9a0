"""Layer tables as DuckDB common table expressions over the source tables.

Written from the meaning of each table and independent of the Spark code. Decimal results are
computed in whole numbers and rounded half up, because DuckDB divides decimals as doubles.
"""

from __future__ import annotations

import re


def exact(n: str, d: str, digits: int, scale: int = 4, empty: str = "0") -> str:
    """n / d as a DECIMAL with `digits` places, rounded half up; n has `scale` places, d none.
    `empty` is the result for d = 0."""
    whole = f"CAST(({n}) * {10**scale} AS HUGEINT)"
    top, bottom = f"({whole} * {10**digits})", f"(CAST({d} AS HUGEINT) * {10**scale})"
    sign = f"(CASE WHEN ({n}) < 0 THEN -1 ELSE 1 END)"
    rounded = f"{sign} * ((2 * abs({top}) + {bottom}) // (2 * {bottom}))"
    unit = f"CAST(0.{'0' * (digits - 1)}1 AS DECIMAL({digits + 1},{digits}))"
    return f"CASE WHEN ({d}) = 0 THEN {empty} ELSE CAST(CAST({rounded} AS BIGINT) AS DECIMAL(18,0)) * {unit} END"


def share(n: str, d: str, digits: int = 6) -> str:
    """n / d for two amounts with four places each."""
    return exact(f"({n}) * 10000", f"CAST(({d}) * 10000 AS HUGEINT)", digits, scale=0)


def null_hash(*columns: str) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<NULL>')" for c in columns)
    return f"sha256(concat_ws('||', {texts}))"


TX = (
    "household_key", "basket_id", "day_no", "product_id", "quantity", "sales_value", "store_id", "retail_disc",
    "trans_time", "week_no", "coupon_disc", "coupon_match_disc",
)
RED = ("household_key", "day_no", "coupon_upc", "campaign_id")
PRODUCT = (
    "product_id", "manufacturer", "department", "brand", "commodity_desc", "sub_commodity_desc",
    "curr_size_of_product",
)
HOUSEHOLD = (
    "age_desc", "marital_status_code", "income_desc", "homeowner_desc", "hh_comp_desc", "household_size_desc",
    "kid_category_desc", "household_key",
)
CAMPAIGN = ("description", "campaign_id", "start_day", "end_day")
TARGET = ("description", "household_key", "campaign_id")
COUPON = ("coupon_upc", "product_id", "campaign_id")
CAUSAL = ("product_id", "store_id", "week_no", "display_code", "mailer_code")

TX_VALID = (
    "basket_id IS NOT NULL AND product_id IS NOT NULL AND day_no IS NOT NULL AND quantity > 0 AND sales_value >= 0"
)
RED_VALID = "household_key IS NOT NULL AND day_no IS NOT NULL AND coupon_upc IS NOT NULL"
USED_COUPON = "CASE WHEN coupon_disc <> 0 OR coupon_match_disc <> 0 THEN 'Y' ELSE 'N' END"
TYPE_OF_NATION = "CASE {n} % 3 WHEN 0 THEN 'TypeA' WHEN 1 THEN 'TypeB' ELSE 'TypeC' END"


def _list(columns: tuple[str, ...]) -> str:
    return ", ".join(columns)


def _dim(key: str, nk: str, columns: str, table: str, unknown: str) -> str:
    return (
        f"SELECT row_number() OVER (ORDER BY {nk}) AS {key}, {columns}, TRUE AS IsCurrent, "
        f"'RM_SNAPSHOT' AS SourceBatchID, RecordHash FROM {table} "
        f"UNION ALL SELECT -1, {unknown}, TRUE, 'SYSTEM', 'UNKNOWN'"
    )


SALES_SUMS = (
    "sum(Quantity) AS TotalQuantity, sum(GrossSalesAmount) AS GrossSalesAmount, "
    "sum(TotalDiscountAmount) AS TotalDiscountAmount, sum(NetSalesAmount) AS NetSalesAmount"
)
COUPON_BASKETS = "count(DISTINCT CASE WHEN HasCoupon = 'Y' THEN BasketID END) AS CouponTransactionCount"


def known(key: str, name: str) -> str:
    return f"count(DISTINCT nullif({key}, -1)) AS {name}"


CTES: dict[str, str] = {
    # --- sources and Bronze ---
    "order_lines": """
        SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d,
               date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS day_no
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "tx_source": """
        SELECT o_custkey + CASE WHEN l_orderkey % 101 = 0 THEN 10000000 ELSE 0 END AS household_key,
               CASE WHEN l_partkey % 211 <> 0 OR l_linenumber <> 1 THEN l_orderkey END AS basket_id,
               day_no, l_partkey AS product_id,
               CAST(l_quantity - 2 AS DECIMAL(18,4)) AS quantity,
               CAST(CASE WHEN l_partkey % 199 = 0 AND l_linestatus = 'F' THEN -p ELSE p - p * d END
                    AS DECIMAL(18,4)) AS sales_value,
               l_suppkey AS store_id,
               CAST(-(p * d) AS DECIMAL(18,4)) AS retail_disc,
               l_orderkey % 2400 AS trans_time,
               (day_no - 1) // 7 + 1 AS week_no,
               CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN p * -0.05 ELSE 0 END
                    AS DECIMAL(18,4)) AS coupon_disc,
               CAST(CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN p * -0.02 ELSE 0 END
                    AS DECIMAL(18,4)) AS coupon_match_disc
        FROM order_lines""",
    "red_source": """
        SELECT CASE WHEN event_id % 50 <> 0 THEN user_id END AS household_key,
               date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS day_no,
               50000000000 + event_id % 25 * 1000 + event_id % 40 AS coupon_upc,
               event_id % 25 + 1 AS campaign_id
        FROM events WHERE event_type = 'purchase'""",
    "product_source": """
        SELECT p_partkey AS product_id, TRY_CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS manufacturer,
               p_type AS department, p_brand AS brand, p_name AS commodity_desc, p_name AS sub_commodity_desc,
               CAST(p_size AS VARCHAR) AS curr_size_of_product
        FROM part""",
    "household_source": """
        SELECT CAST(NULL AS VARCHAR) AS age_desc, CAST(NULL AS VARCHAR) AS marital_status_code,
               c_mktsegment AS income_desc, n_name AS homeowner_desc, CAST(NULL AS VARCHAR) AS hh_comp_desc,
               CAST(NULL AS VARCHAR) AS household_size_desc, CAST(NULL AS VARCHAR) AS kid_category_desc,
               c_custkey AS household_key
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "campaign_source": f"""
        SELECT {TYPE_OF_NATION.format(n="n_nationkey")} AS description, n_nationkey + 1 AS campaign_id,
               90 * n_nationkey + 1 AS start_day, 90 * n_nationkey + 28 + 14 * (n_nationkey % 3) AS end_day
        FROM nation""",
    "target_source": f"""
        SELECT {TYPE_OF_NATION.format(n="c_nationkey")} AS description, c_custkey AS household_key,
               c_nationkey + 1 AS campaign_id
        FROM (SELECT c_custkey, c_nationkey FROM customer
              UNION ALL SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 10 = 0)""",
    "coupon_source": """
        SELECT 50000000000 + p_partkey % 25 * 1000 + p_partkey % 40 AS coupon_upc, p_partkey AS product_id,
               p_partkey % 25 + 1 AS campaign_id
        FROM part""",
    "causal_source": """
        SELECT l_partkey AS product_id, l_suppkey AS store_id, (day_no - 1) // 7 + 1 AS week_no,
               CAST(min(l_linenumber) % 3 AS VARCHAR) AS display_code,
               CASE WHEN max(l_linenumber) % 2 = 1 THEN 'A' ELSE '0' END AS mailer_code
        FROM order_lines GROUP BY ALL""",
    "tx_raw": f"SELECT *, {null_hash(*TX)} AS RecordHash FROM tx_source",
    "red_raw": f"SELECT *, {null_hash(*RED)} AS RecordHash FROM red_source",
    # --- Silver ---
    "tx_clean": f"""
        SELECT *, sales_value AS net_sales_value, {USED_COUPON} AS has_coupon,
               {null_hash(*TX, USED_COUPON)} AS RecordHash
        FROM (SELECT DISTINCT * FROM tx_source WHERE {TX_VALID})""",
    "red_clean": f"""
        SELECT *, {null_hash(*RED)} AS RecordHash
        FROM (SELECT DISTINCT * FROM red_source WHERE {RED_VALID})""",
    "product_clean": f"SELECT *, {null_hash(*PRODUCT)} AS RecordHash FROM product_source",
    "household_clean": f"SELECT *, {null_hash(*HOUSEHOLD)} AS RecordHash FROM household_source",
    "campaign_clean": f"""
        SELECT *, {null_hash(*CAMPAIGN, "campaign_duration")} AS RecordHash
        FROM (SELECT *, end_day - start_day + 1 AS campaign_duration FROM campaign_source)""",
    "target_clean": f"SELECT DISTINCT *, {null_hash(*TARGET)} AS RecordHash FROM target_source",
    "coupon_clean": f"SELECT DISTINCT *, {null_hash(*COUPON)} AS RecordHash FROM coupon_source",
    "promotion_clean": f"""
        SELECT *, {null_hash(*CAUSAL, "has_display", "has_mailer")} AS RecordHash
        FROM (SELECT *, CASE WHEN display_code <> '0' THEN 'Y' ELSE 'N' END AS has_display,
                        CASE WHEN mailer_code <> '0' THEN 'Y' ELSE 'N' END AS has_mailer
              FROM causal_source)""",
    # --- dimensions ---
    "store_nk": f"""
        SELECT StoreID, {null_hash("StoreID")} AS RecordHash
        FROM (SELECT store_id AS StoreID FROM tx_clean UNION SELECT store_id FROM promotion_clean)""",
    "coupon_nk": f"""
        SELECT *, {null_hash("CouponUPC", "CampaignID")} AS RecordHash
        FROM (SELECT coupon_upc AS CouponUPC, max(campaign_id) AS CampaignID
              FROM (SELECT coupon_upc, campaign_id FROM coupon_clean
                    UNION ALL SELECT coupon_upc, campaign_id FROM red_clean) GROUP BY 1)""",
    "day_nk": f"""
        SELECT *, {null_hash("DayNumber", "WeekNumber")} AS RecordHash
        FROM (SELECT day_no AS DayNumber, max(week_no) AS WeekNumber
              FROM (SELECT day_no, week_no FROM tx_clean UNION ALL SELECT day_no, NULL FROM red_clean) GROUP BY 1)""",
    "dim_product": _dim(
        "ProductKey", "product_id",
        "product_id AS ProductID, manufacturer AS Manufacturer, department AS Department, brand AS Brand, "
        "commodity_desc AS CommodityDescription, sub_commodity_desc AS SubCommodityDescription, "
        "curr_size_of_product AS CurrentProductSize",
        "product_clean", "-1, -1, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN'",
    ),
    "dim_household": _dim(
        "HouseholdKey", "household_key",
        "household_key AS HouseholdID, age_desc AS AgeDescription, marital_status_code AS MaritalStatusCode, "
        "income_desc AS IncomeDescription, homeowner_desc AS HomeownerDescription, "
        "hh_comp_desc AS HouseholdCompositionDescription, household_size_desc AS HouseholdSizeDescription, "
        "kid_category_desc AS KidCategoryDescription",
        "household_clean", "-1, " + ", ".join(["'UNKNOWN'"] * 7),
    ),
    "dim_campaign": _dim(
        "CampaignKey", "campaign_id",
        "campaign_id AS CampaignID, description AS CampaignDescription, start_day AS StartDay, end_day AS EndDay, "
        "campaign_duration AS CampaignDuration",
        "campaign_clean", "-1, 'UNKNOWN', NULL, NULL, NULL",
    ),
    "dim_store": _dim("StoreKey", "StoreID", "StoreID", "store_nk", "-1"),
    "dim_coupon": _dim("CouponKey", "CouponUPC", "CouponUPC, CampaignID", "coupon_nk", "-1, -1"),
    "dim_day": _dim("DayKey", "DayNumber", "DayNumber, WeekNumber", "day_nk", "-1, -1"),
    # --- facts ---
    "fact_sales": """
        SELECT coalesce(HouseholdKey, -1) AS HouseholdKey, coalesce(ProductKey, -1) AS ProductKey,
               coalesce(StoreKey, -1) AS StoreKey, coalesce(DayKey, -1) AS DayKey, basket_id AS BasketID,
               trans_time AS TransactionTime, week_no AS WeekNumber, quantity AS Quantity,
               CAST(net_sales_value + abs(retail_disc) + abs(coupon_disc) + abs(coupon_match_disc) AS DECIMAL(18,4))
                   AS GrossSalesAmount,
               retail_disc AS RetailDiscountAmount, coupon_disc AS CouponDiscountAmount,
               coupon_match_disc AS CouponMatchDiscountAmount,
               CAST(abs(retail_disc) + abs(coupon_disc) + abs(coupon_match_disc) AS DECIMAL(18,4))
                   AS TotalDiscountAmount,
               net_sales_value AS NetSalesAmount, has_coupon AS HasCoupon, 'RM_SNAPSHOT' AS SourceBatchID,
               t.RecordHash
        FROM tx_clean t
        LEFT JOIN dim_household h ON h.HouseholdID = t.household_key AND HouseholdKey <> -1
        LEFT JOIN dim_product p ON p.ProductID = t.product_id AND ProductKey <> -1
        LEFT JOIN dim_store s ON s.StoreID = t.store_id AND StoreKey <> -1
        LEFT JOIN dim_day d ON d.DayNumber = t.day_no AND DayKey <> -1""",
    "fact_redemption": """
        SELECT coalesce(HouseholdKey, -1) AS HouseholdKey, coalesce(CouponKey, -1) AS CouponKey,
               coalesce(CampaignKey, -1) AS CampaignKey, coalesce(DayKey, -1) AS DayKey, 1 AS RedemptionCount,
               r.RecordHash
        FROM red_clean r
        LEFT JOIN dim_household h ON h.HouseholdID = r.household_key AND HouseholdKey <> -1
        LEFT JOIN dim_coupon c ON c.CouponUPC = r.coupon_upc AND CouponKey <> -1
        LEFT JOIN dim_campaign m ON m.CampaignID = r.campaign_id AND CampaignKey <> -1
        LEFT JOIN dim_day d ON d.DayNumber = r.day_no AND DayKey <> -1""",
    "fact_target": """
        SELECT coalesce(HouseholdKey, -1) AS HouseholdKey, coalesce(CampaignKey, -1) AS CampaignKey,
               1 AS TargetCount, t.RecordHash
        FROM target_clean t
        LEFT JOIN dim_household h ON h.HouseholdID = t.household_key AND HouseholdKey <> -1
        LEFT JOIN dim_campaign m ON m.CampaignID = t.campaign_id AND CampaignKey <> -1""",
    "fact_promotion": """
        SELECT coalesce(ProductKey, -1) AS ProductKey, coalesce(StoreKey, -1) AS StoreKey, week_no AS WeekNumber,
               display_code AS DisplayCode, mailer_code AS MailerCode, has_display AS HasDisplay,
               has_mailer AS HasMailer, 1 AS PromotionCount, c.RecordHash
        FROM promotion_clean c
        LEFT JOIN dim_product p ON p.ProductID = c.product_id AND ProductKey <> -1
        LEFT JOIN dim_store s ON s.StoreID = c.store_id AND StoreKey <> -1""",
    # --- marts ---
    "dm_daily": f"""
        SELECT *, {exact("NetSalesAmount", "BasketCount", 4)} AS AverageBasketAmount,
               {share("TotalDiscountAmount", "GrossSalesAmount")} AS DiscountRate
        FROM (SELECT f.DayKey, DayNumber, max(f.WeekNumber) AS WeekNumber, count(DISTINCT BasketID) AS BasketCount,
                     {known("HouseholdKey", "HouseholdCount")}, {known("ProductKey", "ProductCount")},
                     {known("StoreKey", "StoreCount")}, {SALES_SUMS}, {COUPON_BASKETS}
              FROM fact_sales f LEFT JOIN dim_day d ON d.DayKey = f.DayKey GROUP BY f.DayKey, DayNumber)""",
    "dm_product": f"""
        SELECT *, {share("NetSalesAmount", "TotalQuantity", 4)} AS AverageUnitNetSales,
               {share("TotalDiscountAmount", "GrossSalesAmount")} AS DiscountRate
        FROM (SELECT f.ProductKey, ProductID, Department, Brand, CommodityDescription,
                     count(DISTINCT BasketID) AS BasketCount, {known("HouseholdKey", "HouseholdCount")},
                     {known("StoreKey", "StoreCount")}, {SALES_SUMS}, {COUPON_BASKETS}
              FROM fact_sales f LEFT JOIN dim_product p ON p.ProductKey = f.ProductKey GROUP BY ALL)""",
    "campaign_targets": "SELECT CampaignKey, count(*) AS TargetHouseholdCount FROM fact_target GROUP BY 1",
    "campaign_redemptions": """
        SELECT CampaignKey, count(DISTINCT HouseholdKey) AS RedeemingHouseholdCount,
               sum(RedemptionCount) AS RedemptionCount, count(DISTINCT CouponKey) AS DistinctCouponCount
        FROM fact_redemption GROUP BY 1""",
    "dm_campaign": f"""
        SELECT *, {exact("RedeemingHouseholdCount", "TargetHouseholdCount", 6, scale=0)} AS RedemptionRate
        FROM (SELECT c.CampaignKey, CampaignID, CampaignDescription, StartDay, EndDay, CampaignDuration,
                     coalesce(TargetHouseholdCount, 0) AS TargetHouseholdCount,
                     coalesce(RedeemingHouseholdCount, 0) AS RedeemingHouseholdCount,
                     coalesce(RedemptionCount, 0) AS RedemptionCount,
                     coalesce(DistinctCouponCount, 0) AS DistinctCouponCount
              FROM dim_campaign c
              LEFT JOIN campaign_targets t ON t.CampaignKey = c.CampaignKey
              LEFT JOIN campaign_redemptions r ON r.CampaignKey = c.CampaignKey
              WHERE c.CampaignKey <> -1 AND (t.CampaignKey IS NOT NULL OR r.CampaignKey IS NOT NULL))""",
    "promotion_sales": f"""
        SELECT ProductKey, StoreKey, WeekNumber, count(DISTINCT BasketID) AS BasketCount, {SALES_SUMS}
        FROM fact_sales GROUP BY 1, 2, 3""",
    "promotion_joined": """
        SELECT pr.ProductKey, pr.StoreKey, pr.WeekNumber, HasDisplay, HasMailer,
               sum(PromotionCount) AS PromotionCount, coalesce(max(BasketCount), 0) AS BasketCount,
               coalesce(max(TotalQuantity), 0) AS TotalQuantity,
               coalesce(max(GrossSalesAmount), 0) AS GrossSalesAmount,
               coalesce(max(TotalDiscountAmount), 0) AS TotalDiscountAmount,
               coalesce(max(NetSalesAmount), 0) AS NetSalesAmount
        FROM fact_promotion pr
        LEFT JOIN promotion_sales s ON s.ProductKey = pr.ProductKey AND s.StoreKey = pr.StoreKey
                                   AND s.WeekNumber = pr.WeekNumber
        GROUP BY pr.ProductKey, pr.StoreKey, pr.WeekNumber, HasDisplay, HasMailer""",
    "dm_promotion": f"""
        SELECT j.*, ProductID, StoreID, {exact("NetSalesAmount", "BasketCount", 4)} AS AverageBasketAmount
        FROM promotion_joined j
        LEFT JOIN dim_product p ON p.ProductKey = j.ProductKey
        LEFT JOIN dim_store s ON s.StoreKey = j.StoreKey""",
    # --- views ---
    "v_daily": f"""
        SELECT *, {exact("CouponTransactionCount", "BasketCount", 6, scale=0)} AS CouponTransactionRate,
               'RM_SNAPSHOT' AS SourceBatchID FROM dm_daily""",
    "v_products": f"""
        SELECT *, {exact("CouponTransactionCount", "BasketCount", 6, scale=0)} AS CouponUsageRate,
               dense_rank() OVER (ORDER BY NetSalesAmount DESC) AS NetSalesRank,
               dense_rank() OVER (ORDER BY TotalQuantity DESC) AS QuantityRank, 'RM_SNAPSHOT' AS SourceBatchID
        FROM dm_product""",
    "v_campaigns": """
        SELECT *, CASE WHEN TargetHouseholdCount = 0 THEN 'NO_TARGET' WHEN RedemptionRate >= 0.20 THEN 'HIGH'
                       WHEN RedemptionRate >= 0.10 THEN 'MEDIUM' WHEN RedemptionRate > 0 THEN 'LOW'
                       ELSE 'NO_REDEMPTION' END AS CampaignPerformanceLevel,
               dense_rank() OVER (ORDER BY RedemptionRate DESC) AS RedemptionRateRank,
               'RM_SNAPSHOT' AS SourceBatchID
        FROM dm_campaign""",
    "v_promotions": f"""
        SELECT *, {share("TotalDiscountAmount", "GrossSalesAmount")} AS DiscountRate,
               CASE WHEN HasDisplay = 'Y' AND HasMailer = 'Y' THEN 'DISPLAY_AND_MAILER'
                    WHEN HasDisplay = 'Y' THEN 'DISPLAY_ONLY' WHEN HasMailer = 'Y' THEN 'MAILER_ONLY'
                    ELSE 'NO_PROMOTION' END AS PromotionType,
               'RM_SNAPSHOT' AS SourceBatchID
        FROM dm_promotion""",
    # --- analytics ---
    "rfm": """
        SELECT *, CAST(R_score AS VARCHAR) || CAST(F_score AS VARCHAR) || CAST(M_score AS VARCHAR) AS RFM_segment,
               CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champions'
                    WHEN R_score >= 3 AND F_score >= 3 AND M_score >= 3 THEN 'Loyal Customers'
                    WHEN R_score >= 3 AND F_score <= 2 THEN 'Potential Loyalists'
                    WHEN R_score <= 2 AND F_score >= 3 THEN 'At Risk'
                    WHEN R_score <= 2 AND F_score <= 2 THEN 'Lost' ELSE 'Others' END AS customer_segment
        FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, household_key) AS R_score,
                     ntile(5) OVER (ORDER BY frequency, household_key) AS F_score,
                     ntile(5) OVER (ORDER BY monetary_value, household_key) AS M_score
              FROM (SELECT household_key, (SELECT max(day_no) FROM tx_clean) - max(day_no) AS recency_days,
                           count(DISTINCT basket_id) AS frequency, sum(net_sales_value) AS monetary_value
                    FROM tx_clean GROUP BY 1))""",
    "promotion_costs": """
        SELECT WeekNumber, PromotionType, sum(TotalDiscountAmount) AS total_discount_cost,
               sum(GrossSalesAmount) AS gross_sales, sum(NetSalesAmount) AS net_sales,
               count(DISTINCT ProductID) AS product_count, sum(BasketCount) AS basket_count
        FROM v_promotions GROUP BY 1, 2""",
    "roi": f"""
        SELECT *, net_sales - total_discount_cost AS net_profit,
               CASE WHEN roi_ratio >= 3 THEN 'Yüksek ROI' WHEN roi_ratio >= 1.5 THEN 'Orta ROI'
                    ELSE 'Düşük ROI' END AS roi_category
        FROM (SELECT c.*, k.*, CASE WHEN total_discount_cost > 0
                              THEN {share("net_sales", "total_discount_cost")} ELSE 0 END AS roi_ratio
              FROM v_campaigns c
              LEFT JOIN promotion_costs k ON k.WeekNumber * 7 BETWEEN c.StartDay AND c.EndDay)""",
    "behaviour": f"""
        SELECT CASE WHEN used THEN 'Kampanyalı' ELSE 'Kampanyasız' END AS customer_group,
               count(household_key) AS customer_count, sum(basket_count) AS total_baskets,
               round(avg(basket_count), 6) AS avg_baskets_per_customer, sum(total_spend) AS total_revenue,
               round(CAST({exact("sum(line_value)", "count(*)", 12, scale=8)} AS DOUBLE), 6) AS avg_line_value,
               {exact("sum(total_spend)", "sum(basket_count)", 6)} AS avg_basket_value,
               sum(units) AS total_units
        FROM (SELECT household_key, coupon_match_disc <> 0 AS used, count(DISTINCT basket_id) AS basket_count,
                     sum(net_sales_value) AS total_spend,
                     {exact("sum(net_sales_value)", "count(*)", 8)} AS line_value, sum(quantity) AS units
              FROM tx_clean GROUP BY 1, 2) GROUP BY used""",
    "timing": f"""
        SELECT day_no, week_no, ['Pazar', 'Pazartesi', 'Salı', 'Çarşamba', 'Perşembe', 'Cuma', 'Cumartesi']
                   [CAST(dayofweek(date) AS INTEGER) + 1] AS day_name,
               ['Ocak', 'Şubat', 'Mart', 'Nisan', 'Mayıs', 'Haziran', 'Temmuz', 'Ağustos', 'Eylül', 'Ekim',
                'Kasım', 'Aralık'][CAST(month(date) AS INTEGER)] AS month_name,
               campaign_status, basket_count, net_sales, avg_line_value,
               {exact("net_sales", "basket_count", 6)} AS avg_basket_value, customer_count
        FROM (SELECT day_no, week_no, DATE '2016-01-01' + CAST(day_no AS INTEGER) AS date,
                     CASE WHEN coupon_match_disc <> 0 THEN 'With Campaign' ELSE 'Without Campaign' END
                         AS campaign_status,
                     count(DISTINCT basket_id) AS basket_count, sum(net_sales_value) AS net_sales,
                     {exact("sum(net_sales_value)", "count(*)", 8)} AS avg_line_value,
                     count(DISTINCT household_key) AS customer_count
              FROM tx_clean GROUP BY 1, 2, 3, 4)""",
    "stores": f"""
        SELECT *, {exact("total_sales", "basket_count", 6)} AS avg_basket_value,
               {exact("campaign_transactions * 100", "total_transactions", 2, scale=0)} AS campaign_adoption_rate,
               {exact("total_sales", "customer_count", 2)} AS revenue_per_customer
        FROM (SELECT store_id, count(DISTINCT basket_id) AS basket_count,
                     count(DISTINCT household_key) AS customer_count, sum(net_sales_value) AS total_sales,
                     {exact("sum(net_sales_value)", "count(*)", 8)} AS avg_line_value,
                     sum(CASE WHEN coupon_match_disc <> 0 THEN 1 ELSE 0 END) AS campaign_transactions,
                     count(basket_id) AS total_transactions, sum(coupon_match_disc) AS total_discount
              FROM tx_clean GROUP BY 1)""",
    "categories": f"""
        SELECT *, {exact("promotion_count * 100", "transaction_count", 2, scale=0)} AS promotion_rate
        FROM (SELECT commodity_desc AS category, count(DISTINCT basket_id) AS basket_count,
                     count(DISTINCT household_key) AS customer_count, sum(net_sales_value) AS total_sales,
                     {exact("sum(net_sales_value)", "count(*)", 8)} AS avg_item_value,
                     sum(quantity) AS total_quantity,
                     sum(CASE WHEN coupon_match_disc <> 0 THEN 1 ELSE 0 END) AS promotion_count,
                     count(*) AS transaction_count
              FROM tx_clean t JOIN product_clean p ON p.product_id = t.product_id GROUP BY 1)""",
    "levels": "SELECT CampaignPerformanceLevel, count(*) AS CampaignCount FROM v_campaigns GROUP BY 1",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """`body` preceded by the expressions that it names, directly or through others."""
    every = CTES | (extra or {})
    wanted: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in words & every.keys() - wanted:
            wanted.add(name)
            pending.append(every[name])
    parts = [f"{name} AS ({every[name].strip()})" for name in every if name in wanted]
    return (f"WITH {', '.join(parts)} " if parts else "") + body

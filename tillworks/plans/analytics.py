"""Analytic queries over Silver, marts and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.functions.rowops import day_name, day_to_date, month_name, ratio, roi_band
from tillworks.operators.distinct import with_distinct_counts
from tillworks.operators.numbering import ntile
from tillworks.operators.ranges import explode_weeks
from tillworks.schema import RATE
from tillworks.session import materialise

# Day 0 of the relative day numbers, segment names and group names.
BASE_DATE = "2016-01-01"
CHAMPIONS = "Champions"
LOYAL = "Loyal Customers"
POTENTIAL = "Potential Loyalists"
AT_RISK = "At Risk"
LOST = "Lost"
OTHERS = "Others"
WITH_CAMPAIGN = "With Campaign"
WITHOUT_CAMPAIGN = "Without Campaign"
CAMPAIGN_GROUP = "Kampanyalı"
OTHER_GROUP = "Kampanyasız"

PERCENT = "decimal(20,2)"


def _baskets_and_customers() -> dict[str, Column]:
    return {"basket_count": F.col("basket_id"), "customer_count": F.col("household_key")}


def used_campaign() -> Column:
    """Discounts are stored as zero or negative amounts, so any non-zero value is a use."""
    return F.coalesce(F.col("coupon_match_disc"), F.lit(0)) != 0


def customer_metrics(transactions: DataFrame) -> DataFrame:
    """Recency against the newest day of all, number of baskets and net sales per household."""
    newest = transactions.agg(F.max("day_no").alias("newest")).scalar()
    return (
        transactions.groupBy("household_key")
        .agg(
            F.max("day_no").alias("last_purchase_day"),
            F.countDistinct("basket_id").alias("frequency"),
            F.sum("net_sales_value").alias("monetary_value"),
        )
        .withColumn("recency_days", newest - F.col("last_purchase_day"))
    )


def segment(r: Column, f: Column, m: Column) -> Column:
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), CHAMPIONS)
        .when((r >= 3) & (f >= 3) & (m >= 3), LOYAL)
        .when((r >= 3) & (f <= 2), POTENTIAL)
        .when((r <= 2) & (f >= 3), AT_RISK)
        .when((r <= 2) & (f <= 2), LOST)
        .otherwise(OTHERS)
    )


def rfm(transactions: DataFrame) -> DataFrame:
    """Scores 1-5 for recency, frequency and money, their code, and the segment.

    Each score needs only four cut points, so the metrics are not joined back to any ranking:
    three parallel sorts of two columns, then one pass over the metrics."""
    metrics = materialise(customer_metrics(transactions), "rfm-metrics")
    household = F.coalesce("household_key", F.lit(-1))
    scored = metrics.withColumns(
        {
            "R_score": ntile(metrics, 5, -F.col("recency_days"), household),
            "F_score": ntile(metrics, 5, F.col("frequency"), household),
            "M_score": ntile(metrics, 5, F.col("monetary_value"), household),
        }
    )
    r, f, m = F.col("R_score"), F.col("F_score"), F.col("M_score")
    return scored.withColumn("RFM_segment", F.concat(r, f, m)).withColumn(
        "customer_segment", segment(r, f, m)
    )


def promotion_costs(promotions: DataFrame) -> DataFrame:
    """Discounts and sales per week and promotion type."""
    return promotions.groupBy("WeekNumber", "PromotionType").agg(
        F.sum("TotalDiscountAmount").alias("total_discount_cost"),
        F.sum("GrossSalesAmount").alias("gross_sales"),
        F.sum("NetSalesAmount").alias("net_sales"),
        F.countDistinct("ProductID").alias("product_count"),
        F.sum("BasketCount").alias("basket_count"),
    )


def campaign_roi(campaigns: DataFrame, promotions: DataFrame) -> DataFrame:
    """Return on discount of each campaign, per week inside it and promotion type; a campaign with
    no promotion in its weeks keeps one row without amounts."""
    weeks = explode_weeks(
        campaigns.select("CampaignID", "StartDay", "EndDay"), F.col("StartDay"), F.col("EndDay"), "WeekNumber"
    )
    costs = weeks.select("CampaignID", "WeekNumber").join(promotion_costs(promotions), "WeekNumber")
    rows = campaigns.join(costs, "CampaignID", "left")
    cost, net = F.col("total_discount_cost"), F.col("net_sales")
    roi = F.when(cost > 0, ratio(net, cost)).otherwise(F.lit(0).cast(RATE))
    return rows.withColumns({"roi_ratio": roi, "net_profit": net - cost}).withColumn(
        "roi_category", roi_band(F.col("roi_ratio"))
    )


def customer_behaviour(transactions: DataFrame) -> DataFrame:
    """Households that used a campaign beside those that did not (one household may be in both).

    Households are unique after the first grouping, so the second one needs no distinct count."""
    households = (
        transactions.groupBy("household_key", used_campaign().alias("used_campaign"))
        .agg(
            F.countDistinct("basket_id").alias("basket_count"),
            F.sum("net_sales_value").alias("total_spend"),
            F.avg("net_sales_value").alias("avg_line_value"),
            F.sum("quantity").alias("total_quantity"),
        )
    )
    return (
        households.groupBy("used_campaign")
        .agg(
            F.count("household_key").alias("customer_count"),
            F.sum("basket_count").alias("total_baskets"),
            F.avg("basket_count").alias("avg_baskets_per_customer"),
            F.sum("total_spend").alias("total_revenue"),
            F.avg("avg_line_value").alias("avg_line_value"),
            F.sum("total_quantity").alias("total_units"),
        )
        .withColumn("avg_basket_value", ratio(F.col("total_revenue"), F.col("total_baskets")))
        .withColumn("customer_group", F.when(F.col("used_campaign"), CAMPAIGN_GROUP).otherwise(OTHER_GROUP))
    )


def campaign_timing(transactions: DataFrame, base_date: str = BASE_DATE) -> DataFrame:
    """Daily sales with and without campaign use, with weekday and month names."""
    status = F.when(used_campaign(), WITH_CAMPAIGN).otherwise(WITHOUT_CAMPAIGN)
    daily = with_distinct_counts(
        transactions,
        {"day_no": F.col("day_no"), "week_no": F.col("week_no"), "campaign_status": status},
        [F.sum("net_sales_value").alias("net_sales"), F.avg("net_sales_value").alias("avg_line_value")],
        _baskets_and_customers(),
    )
    date = day_to_date(F.col("day_no"), base_date)
    return daily.withColumns(
        {
            "day_name": day_name(date),
            "month_name": month_name(date),
            "avg_basket_value": ratio(F.col("net_sales"), F.col("basket_count")),
        }
    )


def store_performance(transactions: DataFrame) -> DataFrame:
    stores = with_distinct_counts(
        transactions,
        {"store_id": F.col("store_id")},
        [
            F.sum("net_sales_value").alias("total_sales"),
            F.avg("net_sales_value").alias("avg_line_value"),
            F.count_if(used_campaign()).alias("campaign_transactions"),
            F.count("basket_id").alias("total_transactions"),
            F.sum("coupon_match_disc").alias("total_discount"),
        ],
        _baskets_and_customers(),
    )
    return stores.withColumns(
        {
            "avg_basket_value": ratio(F.col("total_sales"), F.col("basket_count")),
            "campaign_adoption_rate": ratio(
                F.col("campaign_transactions") * 100, F.col("total_transactions"), PERCENT
            ),
            "revenue_per_customer": ratio(F.col("total_sales"), F.col("customer_count"), PERCENT),
        }
    )


def category_baskets(transactions: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales per commodity of current products; lines of unknown products are left out."""
    categories = dim_product.filter("IsCurrent").select(
        F.col("ProductID").alias("product_id"), F.col("CommodityDescription").alias("category")
    )
    grouped = with_distinct_counts(
        transactions.join(categories, "product_id"),
        {"category": F.col("category")},
        [
            F.sum("net_sales_value").alias("total_sales"),
            F.avg("net_sales_value").alias("avg_item_value"),
            F.sum("quantity").alias("total_quantity"),
            F.count_if(used_campaign()).alias("promotion_count"),
            F.count("*").alias("transaction_count"),
        ],
        _baskets_and_customers(),
    )
    share = ratio(F.col("promotion_count") * 100, F.col("transaction_count"), PERCENT)
    return grouped.withColumn("promotion_rate", share)


def department_sales(products: DataFrame) -> DataFrame:
    sums = ("NetSalesAmount", "GrossSalesAmount", "TotalDiscountAmount", "TotalQuantity", "BasketCount")
    return products.groupBy("Department").agg(*[F.sum(c).alias(c) for c in sums])


def top_commodities(products: DataFrame, rows: int = 20) -> DataFrame:
    sales = products.groupBy("CommodityDescription").agg(F.sum("NetSalesAmount").alias("NetSalesAmount"))
    return sales.orderBy(F.desc("NetSalesAmount"), "CommodityDescription").limit(rows)


def campaign_levels(campaigns: DataFrame) -> DataFrame:
    return campaigns.groupBy("CampaignPerformanceLevel").agg(F.count("*").alias("CampaignCount"))


def sales_in_campaign_weeks(transactions: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Sales that fall into each campaign's weeks; overlapping campaigns each count them.

    Sales are summed per week before the campaigns' weeks are matched, so the overlap repeats
    weekly sums and not sales lines."""
    weekly = transactions.groupBy(F.col("week_no").alias("Week")).agg(
        F.count("*").alias("_lines"),
        F.sum("net_sales_value").alias("_net"),
        F.sum("quantity").alias("_quantity"),
    )
    weeks = explode_weeks(campaigns, F.col("StartDay"), F.col("EndDay"))
    sums = weeks.join(weekly, "Week").groupBy("CampaignID").agg(
        F.sum("_lines").alias("line_count"),
        F.sum("_net").alias("net_sales"),
        F.sum("_quantity").alias("total_quantity"),
    )
    measures = ("line_count", "net_sales", "total_quantity")
    return campaigns.join(sums, "CampaignID", "left").withColumns(
        {m: F.coalesce(m, F.lit(0)) for m in measures}
    )

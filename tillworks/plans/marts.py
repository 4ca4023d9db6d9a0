"""Data marts: aggregates of the facts, one batch scope per call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillworks.functions.rowops import known, ratio
from tillworks.operators.distinct import member, with_distinct_counts, with_distinct_counts_of_small_groups
from tillworks.schema import MART_MONEY, MARTS, MONEY, RATE, conform
from tillworks.session import dealt
from tillworks.sources.csvfiles import slice_of


def _stamped(df: DataFrame, batch: str, process_date: str) -> DataFrame:
    return df.withColumns(
        {
            "SourceBatchID": F.lit(batch.strip()),
            "ProcessDate": F.lit(process_date).cast("date"),
            "CreatedAt": F.current_timestamp(),
        }
    )


def _mart(df: DataFrame, name: str, batch: str, process_date: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns, and `by`: the day, when one build serves the batches of many days."""
    stamped = _stamped(df, batch, process_date)
    return conform(stamped, T.StructType([*MARTS[name], *[stamped.schema[c] for c in by]]))


def _sales_sums() -> list[Column]:
    sums = ("GrossSalesAmount", "TotalDiscountAmount", "NetSalesAmount")
    return [F.sum("Quantity").alias("TotalQuantity"), *[F.sum(c).alias(c) for c in sums]]


def _baskets() -> dict[str, Column]:
    """Distinct baskets, and those with a coupon."""
    with_coupon = F.when(F.col("HasCoupon") == "Y", F.col("BasketID"))
    return {"BasketCount": F.col("BasketID"), "CouponTransactionCount": with_coupon}


def _discount_rate() -> Column:
    return ratio(F.col("TotalDiscountAmount"), F.col("GrossSalesAmount"))


def daily_sales(
    sales: DataFrame, dim_day: DataFrame, batch: str, process_date: str, day: int | None = None, rows: int | None = None
) -> DataFrame:
    """Sales of each day. Distinct members are counted without the unknown one. `rows`: of `sales`, where known."""
    grouped = with_distinct_counts(
        sales,
        {"DayKey": F.col("DayKey")},
        [F.max("WeekNumber").alias("WeekNumber"), *_sales_sums()],
        {
            **_baskets(),
            "HouseholdCount": known("HouseholdKey"),
            "ProductCount": known("ProductKey"),
            "StoreCount": known("StoreKey"),
        },
        rows=sales.count() if rows is None else rows,
    )
    days = slice_of(dim_day.select("DayKey", "DayNumber"), "DayNumber", day)
    by_day = grouped.join(days, "DayKey", "left" if day is None else "inner").withColumns(
        {
            "AverageBasketAmount": ratio(F.col("NetSalesAmount"), F.col("BasketCount"), MART_MONEY),
            "DiscountRate": _discount_rate(),
        }
    )
    return _mart(by_day, "dm_daily_sales", batch, process_date)


def product_sales(
    sales: DataFrame,
    dim_product: DataFrame,
    batch: str,
    process_date: str,
    by: tuple[str, ...] = (),
    rows: int | None = None,
) -> DataFrame:
    """Sales of each product (and `by`). Grouped by key first; the attributes join the small result. By day
    most groups are a line or two."""
    keys = {c: F.col(c) for c in ("ProductKey", *by)}
    distinct = {**_baskets(), "HouseholdCount": known("HouseholdKey"), "StoreCount": known("StoreKey")}
    if by:
        grouped = with_distinct_counts_of_small_groups(sales, keys, _sales_sums(), distinct)
    else:
        rows = sales.count() if rows is None else rows
        grouped = with_distinct_counts(sales, keys, _sales_sums(), distinct, rows=rows, groups=dim_product.count())
    attributes = dim_product.select(
        "ProductKey", "ProductID", "Department", "Brand", "CommodityDescription"
    )
    by_product = grouped.join(attributes, "ProductKey", "left").withColumns(
        {
            "AverageUnitNetSales": ratio(F.col("NetSalesAmount"), F.col("TotalQuantity"), MART_MONEY),
            "DiscountRate": _discount_rate(),
        }
    )
    return _mart(by_product, "dm_product_sales", batch, process_date, by)


def campaign_targets(targets: DataFrame) -> DataFrame:
    return targets.groupBy("CampaignKey").agg(F.count("*").alias("TargetHouseholdCount"))


def campaign_redemptions(redemptions: DataFrame, *by: str) -> DataFrame:
    return redemptions.groupBy(*by, "CampaignKey").agg(
        F.countDistinct("HouseholdKey").alias("RedeemingHouseholdCount"),
        F.sum("RedemptionCount").alias("RedemptionCount"),
        F.countDistinct("CouponKey").alias("DistinctCouponCount"),
    )


_CAMPAIGN_MEASURES = ("TargetHouseholdCount", "RedeemingHouseholdCount", "RedemptionCount", "DistinctCouponCount")


def campaigns_with_activity(dim_campaign: DataFrame, targets: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Campaigns that have targets or redemptions, with both summaries (0 where absent)."""
    joined = (
        dim_campaign.filter(F.col("CampaignKey") != -1)
        .join(campaign_targets(targets).withColumn("_t", F.lit(True)), "CampaignKey", "left")
        .join(campaign_redemptions(redemptions).withColumn("_r", F.lit(True)), "CampaignKey", "left")
        .filter(F.col("_t").isNotNull() | F.col("_r").isNotNull())
    )
    return joined.drop("_t", "_r").withColumns({m: F.coalesce(m, F.lit(0)) for m in _CAMPAIGN_MEASURES})


def _redemption_rate() -> Column:
    return ratio(F.col("RedeemingHouseholdCount"), F.col("TargetHouseholdCount"), RATE)


def campaign_performance(
    dim_campaign: DataFrame, targets: DataFrame, redemptions: DataFrame, batch: str, process_date: str
) -> DataFrame:
    rows = campaigns_with_activity(dim_campaign, targets, redemptions).withColumn("RedemptionRate", _redemption_rate())
    return _mart(rows, "dm_campaign_performance", batch, process_date)


def campaign_performance_by_day(
    dim_campaign: DataFrame, targets: DataFrame, redemptions: DataFrame, days: DataFrame, batch: str, process_date: str
) -> DataFrame:
    """The campaign mart of every day in `days` (ProcessDay): each day's load has all targets and the
    redemptions of that day, so each day has a row for every campaign with targets."""
    day = F.col("ProcessDay").cast("bigint")
    first, last = days.agg(F.min(day)).scalar(), days.agg(F.max(day)).scalar()
    each = campaign_targets(targets).withColumn("ProcessDay", F.explode(F.sequence(first, last)))
    targeted = each.withColumn("ProcessDay", F.col("ProcessDay").cast("decimal(10,0)"))
    redeemed = campaign_redemptions(redemptions, "ProcessDay")
    rows = (
        targeted.join(redeemed, ["ProcessDay", "CampaignKey"], "full")
        .join(days.select("ProcessDay"), "ProcessDay", "left_semi")
        .join(dim_campaign.filter(F.col("CampaignKey") != -1), "CampaignKey")
        .withColumns({m: F.coalesce(m, F.lit(0)) for m in _CAMPAIGN_MEASURES})
        .withColumn("RedemptionRate", _redemption_rate())
    )
    return _mart(rows, "dm_campaign_performance", batch, process_date, ("ProcessDay",))


_SHELF = ("ProductKey", "StoreKey", "WeekNumber")
_SHELF_IDS = {"ProductID": "ProductKey", "StoreID": "StoreKey"}


def _gross(to: T.DataType) -> Column:
    """As the sales fact has it: net + all discounts."""
    return (F.col("NetSalesAmount") + F.col("TotalDiscountAmount")).cast(to)


def _average_basket() -> Column:
    return ratio(F.col("NetSalesAmount"), F.col("BasketCount"), MART_MONEY)


def derived_of_promotions() -> dict[str, Column]:
    """Columns of the promotion mart that others of the row give, where every line has a net value."""
    return {"GrossSalesAmount": _gross(MART_MONEY), "AverageBasketAmount": _average_basket()}


def promotion_sales(sales: DataFrame, week: int | None = None, rows: int | None = None) -> DataFrame:
    """Sales per product, store and week. These keys are almost as many as the lines, so the lines are
    shuffled by them once; sums, distinct baskets and the join with promotions stay there. Baskets go as one
    BIGINT, and the gross amount is added up again behind the shuffle.
    `rows`: the number of lines to deal out by, where known."""
    measures = ("Quantity", "TotalDiscountAmount", "NetSalesAmount")
    basket = member(0, 1, F.col("BasketID"))
    lines = slice_of(sales, "WeekNumber", week).select(*_SHELF, basket.alias("_basket"), *measures)
    lines = lines.select(*_SHELF, "_basket.*", *measures)
    return (
        dealt(lines, lines.count() if rows is None else rows, *_SHELF)
        .withColumn("GrossSalesAmount", _gross(MONEY))
        .groupBy(*_SHELF)
        .agg(F.countDistinct("_which", "_member").alias("BasketCount"), *_sales_sums())
    )


def promotions_with_sales(
    promotions: DataFrame, sales: DataFrame, week: int | None = None, rows: int | None = None
) -> DataFrame:
    """Promotion counts per product, store, week and kind beside the sales of that product, store
    and week. Both sides are grouped before they meet, so no sale is repeated per promotion. Both are dealt
    out to the same tasks, by `rows`: the number of lines."""
    rows = slice_of(sales, "WeekNumber", week).count() if rows is None else rows
    ids = {c: key for c, key in _SHELF_IDS.items() if c in promotions.columns}
    types = {c: promotions.schema[c].dataType for c in ids}
    apart = [(F.col(c).cast("bigint") - F.col(key)).alias(c) for c, key in ids.items()]  # the same for most rows
    shown = slice_of(promotions, "WeekNumber", week).select(*_SHELF, *apart, "HasDisplay", "HasMailer", "PromotionCount")
    grouped = (
        dealt(shown, rows, *_SHELF)
        .groupBy(*_SHELF, "HasDisplay", "HasMailer")
        .agg(F.sum("PromotionCount").alias("PromotionCount"), *[F.min(c).alias(c) for c in ids])
        .withColumns({c: (F.col(c) + F.col(key)).cast(types[c]) for c, key in ids.items()})
    )
    measures = ["BasketCount", "TotalQuantity", "GrossSalesAmount", "TotalDiscountAmount", "NetSalesAmount"]
    joined = grouped.join(promotion_sales(sales, week, rows), ["ProductKey", "StoreKey", "WeekNumber"], "left")
    return joined.withColumns({m: F.coalesce(m, F.lit(0)) for m in measures})


def promotion_performance(
    promotions: DataFrame,
    sales: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    batch: str,
    process_date: str,
    week: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Promotions that have ProductID and StoreID beside their keys need no join for them."""
    promoted = promotions_with_sales(promotions, sales, week, rows)
    if "ProductID" not in promoted.columns:
        promoted = promoted.join(dim_product.select("ProductKey", "ProductID"), "ProductKey", "left")
    if "StoreID" not in promoted.columns:
        promoted = promoted.join(dim_store.select("StoreKey", "StoreID"), "StoreKey", "left")
    promoted = promoted.withColumn("AverageBasketAmount", _average_basket())
    return _mart(promoted, "dm_promotion_performance", batch, process_date)

"""Facts: Silver rows with surrogate keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.functions.rowops import total_discount
from tillworks.operators.lookup import lookup_key, lookup_packed
from tillworks.schema import FACTS, ID, SURROGATE_KEY, UNITS, UNKNOWN_KEY, conform

# Silver column that holds each dimension's natural key.
SALES_KEYS = {
    "dim_household": "household_key",
    "dim_product": "product_id",
    "dim_store": "store_id",
    "dim_day": "day_no",
}
REDEMPTION_KEYS = {
    "dim_household": "household_key",
    "dim_coupon": "coupon_upc",
    "dim_campaign": "campaign_id",
    "dim_day": "day_no",
}
TARGET_KEYS = {"dim_household": "household_key", "dim_campaign": "campaign_id"}
PROMOTION_KEYS = {"dim_product": "product_id", "dim_store": "store_id"}


def with_keys(
    silver: DataFrame, dims: dict[str, DataFrame], keys: dict[str, str], packed: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Silver rows with the surrogate keys, of `packed` dimensions from their blocks."""

    def add(df: DataFrame, item: tuple[str, str]) -> DataFrame:
        dimension, column = item
        if packed and dimension in packed:
            return lookup_packed(df, column, packed[dimension], dimension)
        return lookup_key(df, column, dims[dimension], dimension)

    return reduce(add, keys.items(), silver)


def _key_columns(keys: dict[str, str]) -> list[str]:
    return [SURROGATE_KEY[dimension] for dimension in keys]


def sales_fact(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return sales_rows(with_keys(silver, dims, SALES_KEYS).withColumn("CreatedAt", F.current_timestamp()))


def sales_rows(keyed: DataFrame) -> DataFrame:
    """Gross = net + all discounts, so that discount / gross is a share."""
    retail, coupon, match = (
        F.coalesce(c, F.lit(0)) for c in ("retail_disc", "coupon_disc", "coupon_match_disc")
    )
    discount = total_discount("retail_disc", "coupon_disc", "coupon_match_disc")
    rows = keyed.select(
        *_key_columns(SALES_KEYS),
        F.col("basket_id").alias("BasketID"),
        F.col("trans_time").alias("TransactionTime"),
        F.col("week_no").alias("WeekNumber"),
        F.col("quantity").alias("Quantity"),
        (F.col("net_sales_value") + discount).alias("GrossSalesAmount"),
        retail.alias("RetailDiscountAmount"),
        coupon.alias("CouponDiscountAmount"),
        match.alias("CouponMatchDiscountAmount"),
        discount.alias("TotalDiscountAmount"),
        F.col("net_sales_value").alias("NetSalesAmount"),
        F.col("has_coupon").alias("HasCoupon"),
        "SourceBatchID",
        "ProcessDate",
        "CreatedAt",
        "RecordHash",
    )
    return conform(rows, FACTS["fact_sales_transaction"])


def redemption_fact(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    rows = with_keys(silver, dims, REDEMPTION_KEYS).withColumns(
        {"RedemptionCount": F.lit(1), "CreatedAt": F.current_timestamp()}
    )
    return conform(rows, FACTS["fact_coupon_redemption"])


def target_fact(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    rows = with_keys(silver, dims, TARGET_KEYS).withColumns(
        {"TargetCount": F.lit(1), "CreatedAt": F.current_timestamp()}
    )
    return conform(rows, FACTS["fact_campaign_target"])


def promotion_fact(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return promotion_rows(with_keys(silver, dims, PROMOTION_KEYS).withColumn("CreatedAt", F.current_timestamp()))


def promotion_rows(keyed: DataFrame) -> DataFrame:
    rows = keyed.select(
        *_key_columns(PROMOTION_KEYS),
        F.col("week_no").alias("WeekNumber"),
        F.col("display_code").alias("DisplayCode"),
        F.col("mailer_code").alias("MailerCode"),
        F.col("has_display").alias("HasDisplay"),
        F.col("has_mailer").alias("HasMailer"),
        F.lit(1).alias("PromotionCount"),
        "SourceBatchID",
        "ProcessDate",
        "CreatedAt",
        "RecordHash",
    )
    return conform(rows, FACTS["fact_promotion_weekly"])


def promotion_rows_with_ids(keyed: DataFrame) -> DataFrame:
    """What the promotion mart needs of the fact, and beside the keys of product and store their natural keys
    as the dimensions have them: a mart of nearly as many rows then need not be joined with these."""

    def natural(column: str, key: str) -> Column:
        return F.when(F.col(key) == UNKNOWN_KEY, F.lit(UNKNOWN_KEY)).otherwise(F.col(column)).cast(ID)

    return keyed.select(
        *_key_columns(PROMOTION_KEYS),
        natural("product_id", "ProductKey").alias("ProductID"),
        natural("store_id", "StoreKey").alias("StoreID"),
        F.col("week_no").alias("WeekNumber"),
        F.col("has_display").alias("HasDisplay"),
        F.col("has_mailer").alias("HasMailer"),
        F.lit(1).cast(UNITS).alias("PromotionCount"),
    )


def unknown_keys(facts: dict[str, DataFrame]) -> DataFrame:
    """Rows per fact that point to the unknown member, one column per dimension key."""
    every = sorted({k for df in facts.values() for k in df.columns if k in SURROGATE_KEY.values()})
    parts = [
        df.agg(
            F.count("*").alias("SourceRowCount"),
            *[
                (F.count_if(F.col(k) == UNKNOWN_KEY) if k in df.columns else F.lit(None).cast("bigint"))
                .alias(f"Unknown{k.removesuffix('Key')}Count")
                for k in every
            ],
        ).withColumn("FactTable", F.lit(name))
        for name, df in facts.items()
    ]
    return reduce(DataFrame.unionByName, parts)

"""Dimension sources: one row per natural key, ready for the type-1 merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillworks.functions.rowops import record_hash
from tillworks.operators.reconcile import counts
from tillworks.schema import DIMENSION_COLUMNS, NATURAL_KEY, SURROGATE_KEY, UNKNOWN_KEY, source_columns

# Silver columns of the master dimensions, in the order of the dimension's attributes.
_MASTER_COLUMNS = {
    "dim_product": source_columns("product"),
    "dim_household": ["household_key"] + [c for c in source_columns("hh_demographic") if c != "household_key"],
    "dim_campaign": ["campaign_id", "description", "start_day", "end_day", "campaign_duration"],
}


def master_source(silver: DataFrame, dimension: str) -> DataFrame:
    pairs = zip(_MASTER_COLUMNS[dimension], DIMENSION_COLUMNS[dimension], strict=True)
    return silver.select(*[F.col(old).alias(new) for old, new in pairs], "RecordHash")


def store_source(transactions: DataFrame, promotions: DataFrame) -> DataFrame:
    """Every store that sold or promoted something."""
    stores = [df.select(F.col("store_id").alias("StoreID")) for df in (transactions, promotions)]
    distinct = stores[0].union(stores[1]).filter(F.col("StoreID").isNotNull()).distinct()
    return distinct.withColumn("RecordHash", record_hash("StoreID"))


def coupon_source(coupons: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Every coupon listed or redeemed, with its highest campaign."""
    columns = [F.col("coupon_upc").alias("CouponUPC"), F.col("campaign_id").alias("CampaignID")]
    listed = coupons.select(*columns).unionByName(redemptions.select(*columns))
    grouped = listed.filter(F.col("CouponUPC").isNotNull()).groupBy("CouponUPC")
    return grouped.agg(F.max("CampaignID").alias("CampaignID")).withColumn(
        "RecordHash", record_hash("CouponUPC", "CampaignID")
    )


def day_source(transactions: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Every day with a sale or a redemption; the week is known only from sales."""
    sold = transactions.select(F.col("day_no").alias("DayNumber"), F.col("week_no").alias("WeekNumber"))
    redeemed = redemptions.select(
        F.col("day_no").alias("DayNumber"), F.lit(None).cast("decimal(10,0)").alias("WeekNumber")
    )
    grouped = sold.unionByName(redeemed).filter(F.col("DayNumber").isNotNull()).groupBy("DayNumber")
    return grouped.agg(F.max("WeekNumber").alias("WeekNumber")).withColumn(
        "RecordHash", record_hash("DayNumber", "WeekNumber")
    )


def dimension_counts(dims: dict[str, DataFrame]) -> DataFrame:
    return counts(dims, "DimensionName")


def duplicate_natural_keys(dims: dict[str, DataFrame]) -> DataFrame:
    """Natural keys that occur on several current members."""
    parts = [
        df.filter(F.col(SURROGATE_KEY[name]) != UNKNOWN_KEY)
        .groupBy(F.col(NATURAL_KEY[name]).cast("string").alias("NaturalKey"))
        .agg(F.count("*").alias("RowCount"))
        .filter("RowCount > 1")
        .withColumn("DimensionName", F.lit(name))
        for name, df in dims.items()
    ]
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first

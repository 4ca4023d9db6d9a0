"""The eight retail sources, derived from a TPC-H-like set of Parquet tables.

The remainders below are fixed rules that give the data rejects, orphans and duplicates; without
them the derived sources would have none and several operators would have nothing to do.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillworks.schema import SOURCES
from tillworks.session import dealt, needs_dealing

# First day of the transactions and of the redemptions.
FIRST_ORDER_DATE = "1995-01-01"
FIRST_EVENT_DATE = "2024-01-01"


def _plain(spark: SparkSession, folder: str, table: str, *columns: str | Column) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet").select(*columns)


def _read(spark: SparkSession, folder: str, table: str, *columns: str | Column) -> DataFrame:
    source_file = F.col("_metadata.file_name").alias("SourceFile")
    return _plain(spark, folder, table, *columns, source_file)


def _typed(df: DataFrame, source: str, *more: str) -> DataFrame:
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in SOURCES[source].values()], "SourceFile", *more)


def _day(timestamp: str, first: str) -> Column:
    return F.datediff(F.col(timestamp).cast("date"), F.lit(first).cast("date")) + 1


def _week(day: Column) -> Column:
    return F.floor((day - 1) / 7) + 1


def _lines(spark: SparkSession, folder: str, *columns: str | Column) -> DataFrame:
    lines = _read(spark, folder, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *columns)
    orders = _plain(spark, folder, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    rows = lines.count()
    if needs_dealing(spark, rows):  # both sides in as many tasks as sort them in memory
        lines, orders = dealt(lines, rows, "l_orderkey"), dealt(orders, rows, "o_orderkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.withColumn("day_no", _day("o_orderdate", FIRST_ORDER_DATE))


def transaction_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The transactions, and the LineNumber by which the weekly promotions are derived from the same lines."""
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    kinds = {
        "voided": (part % 199 == 0) & (F.col("l_linestatus") == "F"),
        "coupon": (F.col("l_returnflag") == "R") & (line == 1),
        "match": (F.col("l_returnflag") == "A") & (line == 2),
    }
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(kinds.values())]
    amounts = {"price": F.col("l_extendedprice").cast("decimal(18,2)"), "discount": F.col("l_discount").cast("decimal(4,2)")}
    # cast and reduced to bits before the shuffle: half as wide
    narrow = amounts | {"kinds": reduce(add, bits)}
    lines = _lines(spark, folder, "l_quantity", *[c.alias(n) for n, c in narrow.items()])
    voided, coupon, match = (F.col("kinds").bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(kinds)))
    price, off, order = F.col("price"), F.col("price") * F.col("discount"), F.col("l_orderkey")
    rows = lines.select(
        (F.col("o_custkey") + F.when(order % 101 == 0, 10_000_000).otherwise(0)).alias("household_key"),
        F.when((part % 211 != 0) | (line != 1), order).alias("basket_id"),
        "day_no",
        part.alias("product_id"),
        (F.col("l_quantity") - 2).alias("quantity"),
        F.when(voided, -price).otherwise(price - off).alias("sales_value"),
        F.col("l_suppkey").alias("store_id"),
        (-off).alias("retail_disc"),
        (order % 2400).alias("trans_time"),
        _week(F.col("day_no")).alias("week_no"),
        F.when(coupon, price * F.lit("-0.05").cast("decimal(4,2)")).otherwise(0).alias("coupon_disc"),
        F.when(match, price * F.lit("-0.02").cast("decimal(4,2)")).otherwise(0).alias("coupon_match_disc"),
        "SourceFile",
        line.alias("LineNumber"),
    )
    return _typed(rows, "transaction_data", "LineNumber")


def transaction_data(spark: SparkSession, folder: str) -> DataFrame:
    return transaction_lines(spark, folder).drop("LineNumber")


def product(spark: SparkSession, folder: str) -> DataFrame:
    parts = _read(spark, folder, "part", "p_partkey", "p_brand", "p_type", "p_name", "p_size")
    rows = parts.select(
        F.col("p_partkey").alias("product_id"),
        F.regexp_extract("p_brand", r"(\d+)", 1).try_cast("int").alias("manufacturer"),
        F.col("p_type").alias("department"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("commodity_desc"),
        F.col("p_name").alias("sub_commodity_desc"),
        F.col("p_size").cast("string").alias("curr_size_of_product"),
        "SourceFile",
    )
    return _typed(rows, "product")


def hh_demographic(spark: SparkSession, folder: str) -> DataFrame:
    customers = _read(spark, folder, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    nations = _plain(spark, folder, "nation", "n_nationkey", "n_name")
    nothing = F.lit(None).cast("string")
    rows = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        nothing.alias("age_desc"),
        nothing.alias("marital_status_code"),
        F.col("c_mktsegment").alias("income_desc"),
        F.col("n_name").alias("homeowner_desc"),
        nothing.alias("hh_comp_desc"),
        nothing.alias("household_size_desc"),
        nothing.alias("kid_category_desc"),
        F.col("c_custkey").alias("household_key"),
        "SourceFile",
    )
    return _typed(rows, "hh_demographic")


def _campaign_type(nation: Column) -> Column:
    return F.when(nation % 3 == 0, "TypeA").when(nation % 3 == 1, "TypeB").otherwise("TypeC")


def campaign_desc(spark: SparkSession, folder: str) -> DataFrame:
    nation = F.col("n_nationkey")
    start = nation * 90 + 1
    rows = _read(spark, folder, "nation", "n_nationkey").select(
        _campaign_type(nation).alias("description"),
        (nation + 1).alias("campaign_id"),
        start.alias("start_day"),
        (start + 27 + nation % 3 * 14).alias("end_day"),
        "SourceFile",
    )
    return _typed(rows, "campaign_desc")


def campaign_table(spark: SparkSession, folder: str) -> DataFrame:
    copies = F.when(F.col("c_custkey") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = _read(spark, folder, "customer", "c_custkey", "c_nationkey").select(
        _campaign_type(F.col("c_nationkey")).alias("description"),
        F.col("c_custkey").alias("household_key"),
        (F.col("c_nationkey") + 1).alias("campaign_id"),
        "SourceFile",
        F.explode(copies).alias("copy"),
    )
    return _typed(rows, "campaign_table")


def _coupon(number: Column) -> tuple[Column, Column]:
    campaign = number % 25
    return F.lit(50_000_000_000) + campaign * 1000 + number % 40, campaign + 1


def coupon(spark: SparkSession, folder: str) -> DataFrame:
    upc, campaign = _coupon(F.col("p_partkey"))
    rows = _read(spark, folder, "part", "p_partkey").select(
        upc.alias("coupon_upc"), F.col("p_partkey").alias("product_id"), campaign.alias("campaign_id"), "SourceFile"
    )
    return _typed(rows, "coupon")


def coupon_redempt(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    upc, campaign = _coupon(event)
    rows = (
        _read(spark, folder, "events", "event_id", "ts", "user_id", "event_type")
        .filter(F.col("event_type") == "purchase")
        .select(
            F.when(event % 50 != 0, F.col("user_id")).alias("household_key"),
            _day("ts", FIRST_EVENT_DATE).alias("day_no"),
            upc.alias("coupon_upc"),
            campaign.alias("campaign_id"),
            "SourceFile",
        )
    )
    return _typed(rows, "coupon_redempt")


def promotions_of(lines: DataFrame, rows: int) -> DataFrame:
    """The weekly promotions of `rows` `transaction_lines`, which are joined with the orders once for both."""
    keys = ("product_id", "store_id", "week_no")
    # nearly every line has a key of its own: nothing to combine, and much to sort, before the shuffle
    promotions = (
        dealt(lines.select(*keys, "LineNumber", "SourceFile"), rows, *keys)
        .groupBy(*keys)
        .agg(
            (F.min("LineNumber") % 3).cast("string").alias("display_code"),
            F.when(F.max("LineNumber") % 2 == 1, "A").otherwise("0").alias("mailer_code"),
            F.min("SourceFile").alias("SourceFile"),
        )
    )
    return _typed(promotions, "causal_data")


def causal_data(spark: SparkSession, folder: str) -> DataFrame:
    return promotions_of(transaction_lines(spark, folder), _plain(spark, folder, "lineitem").count())


DERIVED: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "transaction_data": transaction_data,
    "coupon_redempt": coupon_redempt,
    "product": product,
    "hh_demographic": hh_demographic,
    "campaign_desc": campaign_desc,
    "campaign_table": campaign_table,
    "coupon": coupon,
    "causal_data": causal_data,
}

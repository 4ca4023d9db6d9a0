"""Silver: valid, deduplicated, typed rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillworks.functions.rowops import first_match, record_hash, uses_coupon, yes_no
from tillworks.operators.dedup import latest_by_key, latest_copy
from tillworks.operators.reconcile import side_by_side
from tillworks.schema import SILVER, conform, source_columns
from tillworks.sources.csvfiles import slice_of

TRANSACTION_COLUMNS = source_columns("transaction_data")
REDEMPTION_COLUMNS = source_columns("coupon_redempt")


def _is_other_day(day: Column | int | None) -> Column:
    if day is None:
        return F.lit(False)
    return F.col("day_no") != (day if isinstance(day, Column) else F.lit(day).cast("decimal(10,0)"))


# --- transactions ---------------------------------------------------------------------------
def is_valid_transaction() -> Column:
    """Basket, product and day given, a positive quantity and no negative value."""
    required = [F.col(c).isNotNull() for c in ("basket_id", "product_id", "day_no")]
    return reduce(lambda a, b: a & b, [*required, F.col("quantity") > 0, F.col("sales_value") >= 0])


def valid_transactions(bronze: DataFrame, day: Column | int | None = None) -> DataFrame:
    """Valid rows (of a day); the plain conjunction reaches the Parquet scan as pushed filters."""
    return slice_of(bronze.filter(is_valid_transaction()), "day_no", day)


def transaction_reason(day: Column | int | None = None) -> Column:
    """The first rule that a row breaks, NULL for a valid one."""
    return first_match(
        [
            ("BASKET_ID_NULL", F.col("basket_id").isNull()),
            ("PRODUCT_ID_NULL", F.col("product_id").isNull()),
            ("DAY_NULL", F.col("day_no").isNull()),
            ("WRONG_PROCESS_DAY", _is_other_day(day)),
            ("QUANTITY_NULL", F.col("quantity").isNull()),
            ("INVALID_QUANTITY", F.col("quantity") <= 0),
            ("SALES_VALUE_NULL", F.col("sales_value").isNull()),
            ("NEGATIVE_SALES_VALUE", F.col("sales_value") < 0),
        ]
    )


def invalid_transactions(bronze: DataFrame, day: Column | int | None = None) -> DataFrame:
    """The other rows, with the first rule that each one breaks."""
    return bronze.withColumn("RejectReason", transaction_reason(day)).filter(F.col("RejectReason").isNotNull())


def deduplicated_transactions(valid: DataFrame) -> DataFrame:
    """One row per record, the copy that was loaded last. The hash covers all source columns, so equal
    hash means equal columns; grouping by these keeps the 64-character hash out of the shuffle. Date and
    time come from one copy: max_by keeps them together, and its two fixed-size fields do not sort."""
    latest = valid.groupBy(*TRANSACTION_COLUMNS).agg(
        F.max_by("ProcessDate", "ETLTime").alias("ProcessDate"), F.max("ETLTime").alias("ETLTime")
    )
    return latest.withColumn("RecordHash", record_hash(*TRANSACTION_COLUMNS))


def transaction_clean(deduplicated: DataFrame, batch: str, process_date: str) -> DataFrame:
    """Net value and coupon flag; the Silver hash also covers the flag."""
    flag = uses_coupon("coupon_disc", "coupon_match_disc")
    rows = deduplicated.withColumns(
        {
            "net_sales_value": F.col("sales_value"),
            "has_coupon": flag,
            "SourceBatchID": F.lit(batch.strip()),
            "ProcessDate": F.lit(process_date).cast("date"),
            "ETLTime": F.current_timestamp(),
            "RecordHash": record_hash(*TRANSACTION_COLUMNS, flag),
        }
    )
    return conform(rows, SILVER["transaction_clean"])


# --- coupon redemptions ---------------------------------------------------------------------
def is_valid_redemption() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("household_key", "day_no", "coupon_upc")])


def valid_redemptions(bronze: DataFrame, day: Column | int | None = None) -> DataFrame:
    return slice_of(bronze.filter(is_valid_redemption()), "day_no", day)


def redemption_reason(day: Column | int | None = None) -> Column:
    return first_match(
        [
            ("HOUSEHOLD_KEY_NULL", F.col("household_key").isNull()),
            ("DAY_NULL", F.col("day_no").isNull()),
            ("COUPON_UPC_NULL", F.col("coupon_upc").isNull()),
            ("WRONG_PROCESS_DAY", _is_other_day(day)),
        ]
    )


def invalid_redemptions(bronze: DataFrame, day: Column | int | None = None) -> DataFrame:
    return bronze.withColumn("RejectReason", redemption_reason(day)).filter(F.col("RejectReason").isNotNull())


def coupon_redemption_clean(valid: DataFrame, batch: str, process_date: str) -> DataFrame:
    rows = latest_copy(valid, REDEMPTION_COLUMNS).withColumns(
        {
            "SourceBatchID": F.lit(batch.strip()),
            "ProcessDate": F.lit(process_date).cast("date"),
            "ETLTime": F.current_timestamp(),
            "RecordHash": record_hash(*REDEMPTION_COLUMNS),
        }
    )
    return conform(rows, SILVER["coupon_redemption_clean"])


# --- master snapshots -------------------------------------------------------------------------
def _master(
    bronze: DataFrame,
    table: str,
    source: str,
    keys: list[str],
    batch: str,
    process_date: str,
    extra: dict[str, Column] | None = None,
    unique: bool = True,
    latest_copy: Callable[[DataFrame, list[str]], DataFrame] = latest_copy,
) -> DataFrame:
    """Snapshot rule: keys present, text trimmed, latest row per natural key (or per record)."""
    columns = source_columns(source)
    types = dict(bronze.select(*columns).dtypes)
    trimmed = bronze.select(
        *[F.trim(c).alias(c) if types[c] == "string" else F.col(c) for c in columns], "ETLTime"
    ).filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    if unique and set(keys) != set(columns):
        latest = latest_by_key(trimmed, keys, ["ETLTime"])
    else:
        latest = latest_copy(trimmed, columns)
    extra = extra or {}
    rows = latest.withColumns(extra).withColumns(
        {
            "SourceBatchID": F.lit(batch.strip()),
            "ProcessDate": F.lit(process_date).cast("date"),
            "ETLTime": F.current_timestamp(),
            "RecordHash": record_hash(*columns, *extra),
        }
    )
    return conform(rows, SILVER[table])


def product_clean(bronze: DataFrame, batch: str, process_date: str) -> DataFrame:
    return _master(bronze, "product_clean", "product", ["product_id"], batch, process_date)


def household_demographic_clean(bronze: DataFrame, batch: str, process_date: str) -> DataFrame:
    return _master(
        bronze, "household_demographic_clean", "hh_demographic", ["household_key"], batch, process_date
    )


def campaign_clean(bronze: DataFrame, batch: str, process_date: str) -> DataFrame:
    days = (F.col("end_day") - F.col("start_day") + 1).cast("decimal(10,0)")
    extra = {"campaign_duration": days}
    return _master(bronze, "campaign_clean", "campaign_desc", ["campaign_id"], batch, process_date, extra)


def campaign_target_clean(bronze: DataFrame, batch: str, process_date: str) -> DataFrame:
    keys = ["household_key", "campaign_id"]
    return _master(bronze, "campaign_target_clean", "campaign_table", keys, batch, process_date)


def coupon_product_clean(bronze: DataFrame, batch: str, process_date: str) -> DataFrame:
    keys = ["coupon_upc", "product_id"]
    return _master(bronze, "coupon_product_clean", "coupon", keys, batch, process_date, unique=False)


PROMOTION_KEYS = ["product_id", "store_id", "week_no"]


def valid_promotions(bronze: DataFrame) -> DataFrame:
    return bronze.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in PROMOTION_KEYS]))


def promotion_weekly_clean(
    bronze: DataFrame,
    batch: str,
    process_date: str,
    week: int | None = None,
    latest_copy: Callable[[DataFrame, list[str]], DataFrame] = latest_copy,
) -> DataFrame:
    def shown(code: str) -> Column:
        return yes_no(F.col(code).isNotNull() & (F.col(code) != "0"))

    extra = {"has_display": shown("display_code"), "has_mailer": shown("mailer_code")}
    rows = slice_of(bronze, "week_no", week)
    return _master(
        rows, "promotion_weekly_clean", "causal_data", PROMOTION_KEYS, batch, process_date, extra, False, latest_copy
    )


# --- reconciliation ---------------------------------------------------------------------------
def reconcile(bronze: DataFrame, valid: Column, reason: Column, kept: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze rows must be the rejected ones, the surplus copies and the inserted ones. Three scans: one of
    Bronze for its rows, the valid and the rejected ones, one to deduplicate, and one of Silver."""
    rows = F.count("*")
    return (
        side_by_side(
            {
                "BronzeRowCount": (bronze, rows),
                "ValidRowCount": (bronze, F.count_if(valid)),
                "RejectedRowCount": (bronze, F.count_if(reason.isNotNull())),
                "KeptRowCount": (kept, rows),
                "InsertedRowCount": (silver, rows),
            }
        )
        .withColumn("DuplicateRowCount", F.col("ValidRowCount") - F.col("KeptRowCount"))
        .withColumn(
            "DifferenceCount",
            F.col("BronzeRowCount")
            - F.col("RejectedRowCount")
            - F.col("DuplicateRowCount")
            - F.col("InsertedRowCount"),
        )
        .drop("KeptRowCount")
    )

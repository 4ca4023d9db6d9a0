"""Column expressions shared by the layers; all run inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from tillworks.schema import RATE, UNKNOWN_KEY

# Separator and NULL marker of the record hash.
HASH_SEPARATOR = "||"
HASH_NULL = "<NULL>"

# Fixed value: prefix of a daily batch's identifier.
BATCH_PREFIX = "RM_DAILY_D"

# Band names and their lower bounds, in the order they are tried.
NO_TARGET = "NO_TARGET"
REDEMPTION_BANDS = (("HIGH", "0.20"), ("MEDIUM", "0.10"))
REDEMPTION_LOW = "LOW"
NO_REDEMPTION = "NO_REDEMPTION"
ROI_BANDS = (("Yüksek ROI", "3"), ("Orta ROI", "1.5"))
ROI_LOW = "Düşük ROI"
DISPLAY_AND_MAILER = "DISPLAY_AND_MAILER"
DISPLAY_ONLY = "DISPLAY_ONLY"
MAILER_ONLY = "MAILER_ONLY"
NO_PROMOTION = "NO_PROMOTION"
DAY_NAMES = ("Pazar", "Pazartesi", "Salı", "Çarşamba", "Perşembe", "Cuma", "Cumartesi")
MONTH_NAMES = (
    "Ocak", "Şubat", "Mart", "Nisan", "Mayıs", "Haziran",
    "Temmuz", "Ağustos", "Eylül", "Ekim", "Kasım", "Aralık",
)


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_hash(*columns: Column | str, mark_nulls: bool = True) -> Column:
    """SHA-256 of the columns as joined text. Without the NULL marker, NULL columns are skipped,
    so ('1', NULL) and ('1') hash alike; the layers here always mark."""
    texts = [_as_column(c).cast("string") for c in columns]
    if mark_nulls:
        texts = [F.coalesce(t, F.lit(HASH_NULL)) for t in texts]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256)


# Wide enough for any sum here, narrow enough that a quotient keeps 14 places before it is rounded.
_OPERAND = T.DecimalType(24, 4)


def ratio(numerator: Column, denominator: Column, to: T.DataType = RATE) -> Column:
    """numerator / denominator, 0 where the denominator is 0 (ANSI division would raise)."""
    quotient = (numerator.cast(_OPERAND) / denominator.cast(_OPERAND)).cast(to)
    return F.when(denominator == 0, F.lit(0).cast(to)).otherwise(quotient)


def total_discount(*discounts: Column | str) -> Column:
    """Sum of the discounts as positive amounts; sources store them as zero or negative."""
    return reduce(
        lambda a, b: a + b, (F.abs(F.coalesce(_as_column(d), F.lit(0))) for d in discounts)
    )


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def uses_coupon(*discounts: Column | str) -> Column:
    """'Y' where any coupon discount is not zero."""
    return yes_no(
        reduce(lambda a, b: a | b, (F.coalesce(_as_column(d), F.lit(0)) != 0 for d in discounts))
    )


def first_match(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that holds, NULL where none does."""
    chain = F
    for name, condition in rules:
        chain = chain.when(condition, F.lit(name))
    return chain


def redemption_band(target: Column, rate: Column) -> Column:
    bands = F.when(target == 0, NO_TARGET)
    for name, floor in REDEMPTION_BANDS:
        bands = bands.when(rate >= F.lit(floor).cast(RATE), name)
    return bands.when(rate > 0, REDEMPTION_LOW).otherwise(NO_REDEMPTION)


def roi_band(roi: Column) -> Column:
    bands = F
    for name, floor in ROI_BANDS:
        bands = bands.when(roi >= F.lit(floor).cast(RATE), name)
    return bands.otherwise(ROI_LOW)


def promotion_type(has_display: Column, has_mailer: Column) -> Column:
    display, mailer = has_display == "Y", has_mailer == "Y"
    return (
        F.when(display & mailer, DISPLAY_AND_MAILER)
        .when(display, DISPLAY_ONLY)
        .when(mailer, MAILER_ONLY)
        .otherwise(NO_PROMOTION)
    )


def known(key: Column | str) -> Column:
    """The surrogate key, NULL for the unknown member: for distinct counts of real members."""
    key = _as_column(key)
    return F.when(key != UNKNOWN_KEY, key)


def day_to_date(day: Column, base_date: str) -> Column:
    """Calendar date of a relative day number; day 1 is the day after the base date."""
    return F.date_add(F.lit(base_date).cast("date"), day.cast("int"))


def day_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), F.dayofweek(date))


def month_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES)), F.month(date))


def week_of_day(day: Column, first_day: Column, first_week: Column) -> Column:
    return first_week + F.floor((day - first_day) / 7)


def batch_id(day: Column) -> Column:
    """Identifier of the daily batch that loads one source day: at least four digits."""
    digits = day.cast("int").cast("string")
    return F.concat(F.lit(BATCH_PREFIX), F.lpad(digits, F.greatest(F.length(digits), F.lit(4)), F.lit("0")))


def load_status(source: Column, inserted: Column, warnings: Column, when_empty: Column | str) -> Column:
    """Status of a finished load: empty source, lost rows, rows set aside, or clean.

    `inserted` must already include the rows that were set aside on purpose (`warnings`)."""
    return (
        F.when(source == 0, when_empty)
        .when(source != inserted, F.lit("FAILED"))
        .when(warnings > 0, F.lit("SUCCESS_WITH_WARNING"))
        .otherwise(F.lit("SUCCESS"))
    )


def batch_verdict(
    load_layers: Column, check_layers: Column, failed_loads: Column, critical_checks: Column, warnings: Column
) -> Column:
    """Status of a whole batch. All four layers must have loaded and been checked."""
    return (
        F.when(load_layers < 4, "FAILED")
        .when(check_layers < 4, "FAILED")
        .when(failed_loads > 0, "FAILED")
        .when(critical_checks > 0, "FAILED")
        .when(warnings > 0, "SUCCESS_WITH_WARNING")
        .otherwise("SUCCESS")
    )

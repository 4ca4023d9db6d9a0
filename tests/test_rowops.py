from __future__ import annotations

import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillworks.functions import rowops as r
from tillworks.plans import silver


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_hash_marks_nulls(spark):
    rows = spark.createDataFrame([("1", None), ("1", "")], "a string, b string")
    marked = [x[0] for x in rows.select(r.record_hash("a", "b")).collect()]
    assert marked == [hashlib.sha256(t.encode()).hexdigest() for t in ("1||<NULL>", "1||")]
    plain = rows.select(r.record_hash("a", "b", mark_nulls=False)).first()[0]
    assert plain == hashlib.sha256(b"1").hexdigest()


@pytest.mark.parametrize(
    ("target", "rate", "band"),
    [
        (0, "0.5", "NO_TARGET"), (5, "0.200000", "HIGH"), (5, "0.199999", "MEDIUM"), (5, "0.100000", "MEDIUM"),
        (5, "0.099999", "LOW"), (5, "0.000001", "LOW"), (5, "0", "NO_REDEMPTION"),
    ],
)
def test_redemption_bands(spark, target, rate, band):
    assert one(spark, r.redemption_band(F.lit(target), F.lit(rate).cast("decimal(18,6)"))) == band


@pytest.mark.parametrize(
    ("roi", "band"), [("3", "Yüksek ROI"), ("2.999999", "Orta ROI"), ("1.5", "Orta ROI"), ("1.499999", "Düşük ROI")]
)
def test_roi_bands(spark, roi, band):
    assert one(spark, r.roi_band(F.lit(roi).cast("decimal(18,6)"))) == band


def test_promotion_types(spark):
    got = {(d, m): one(spark, r.promotion_type(F.lit(d), F.lit(m))) for d in "YN" for m in "YN"}
    assert got == {
        ("Y", "Y"): "DISPLAY_AND_MAILER",
        ("Y", "N"): "DISPLAY_ONLY",
        ("N", "Y"): "MAILER_ONLY",
        ("N", "N"): "NO_PROMOTION",
    }


def test_ratio_is_guarded_and_rounded_once(spark):
    money = "decimal(38,4)"
    assert one(spark, r.ratio(F.lit(5).cast(money), F.lit(0).cast(money))) == 0
    exact = r.ratio(F.lit("995424.5468").cast(money), F.lit("44609.0732").cast(money))
    assert one(spark, exact) == Decimal("22.314396")


def test_discounts_and_coupon_flag(spark):
    rows = spark.createDataFrame([(-1.5, None, 0.25), (0.0, None, 0.0)], "a double, b double, c double")
    got = rows.select(r.total_discount("a", "b", "c"), r.uses_coupon("b", "c")).collect()
    assert [tuple(x) for x in got] == [(1.75, "Y"), (0.0, "N")]


def test_batch_id_pads_and_keeps_long_days(spark):
    ids = [one(spark, r.batch_id(F.lit(d))) for d in (1, 9999, 12345)]
    assert ids == ["RM_DAILY_D0001", "RM_DAILY_D9999", "RM_DAILY_D12345"]


def test_calendar_starts_on_the_day_after_the_base(spark):
    date = r.day_to_date(F.lit(1), "2016-01-01")
    assert str(one(spark, date)) == "2016-01-02"
    assert one(spark, r.day_name(date)) == "Cumartesi"
    assert one(spark, r.month_name(r.day_to_date(F.lit(364), "2016-01-01"))) == "Aralık"


@pytest.mark.parametrize(
    ("source", "inserted", "aside", "status"),
    [(0, 0, 0, "SKIPPED"), (5, 4, 0, "FAILED"), (5, 5, 2, "SUCCESS_WITH_WARNING"), (5, 5, 0, "SUCCESS")],
)
def test_load_status(spark, source, inserted, aside, status):
    assert one(spark, r.load_status(F.lit(source), F.lit(inserted), F.lit(aside), "SKIPPED")) == status


@pytest.mark.parametrize(
    ("counters", "status"),
    [
        ((3, 4, 0, 0, 0), "FAILED"), ((4, 3, 0, 0, 0), "FAILED"), ((4, 4, 1, 0, 0), "FAILED"),
        ((4, 4, 0, 1, 0), "FAILED"), ((4, 4, 0, 0, 1), "SUCCESS_WITH_WARNING"), ((4, 4, 0, 0, 0), "SUCCESS"),
    ],
)
def test_batch_verdict(spark, counters, status):
    assert one(spark, r.batch_verdict(*map(F.lit, counters))) == status


TRANSACTION = "household_key int, basket_id int, day_no decimal(10,0), product_id int, quantity int, sales_value int"


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        ((1, None, None, None, -1, -1), "BASKET_ID_NULL"),
        ((1, 1, None, None, -1, -1), "PRODUCT_ID_NULL"),
        ((1, 1, None, 1, -1, -1), "DAY_NULL"),
        ((1, 1, 8, 1, None, -1), "WRONG_PROCESS_DAY"),
        ((1, 1, 7, 1, None, -1), "QUANTITY_NULL"),
        ((1, 1, 7, 1, 0, -1), "INVALID_QUANTITY"),
        ((1, 1, 7, 1, 1, None), "SALES_VALUE_NULL"),
        ((1, 1, 7, 1, 1, -1), "NEGATIVE_SALES_VALUE"),
        ((None, 1, 7, 1, 1, 0), None),
    ],
)
def test_reject_reason_is_the_first_broken_rule(spark, row, reason):
    row = tuple(Decimal(v) if i == 2 and v is not None else v for i, v in enumerate(row))
    rows = spark.createDataFrame([row], TRANSACTION)
    rejected = [x["RejectReason"] for x in silver.invalid_transactions(rows, 7).collect()]
    assert rejected == ([reason] if reason else [])
    assert silver.valid_transactions(rows, 7).count() == (0 if reason else 1)


def test_files_with_other_headers_raise(spark, tmp_path):
    from tillworks.schema import SOURCES
    from tillworks.sources import csvfiles

    names = list(SOURCES["coupon_redempt"])
    for file, order in (("a", names), ("b", names[::-1])):
        (tmp_path / f"{file}.csv").write_text(",".join(order) + "\n" + ",".join("1" for _ in order) + "\n")
    with pytest.raises(Exception, match="header"):
        csvfiles.scan(spark, str(tmp_path), "coupon_redempt").collect()


def test_one_record_with_two_process_dates_is_one(spark):
    day = spark.range(2).selectExpr(
        *[f"cast(1 as string) as {c}" for c in silver.TRANSACTION_COLUMNS],
        "date_add(date'2024-01-01', cast(id as int)) as ProcessDate",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) as ETLTime",
    )
    rows = silver.deduplicated_transactions(day).collect()
    assert len(rows) == 1 and str(rows[0]["ProcessDate"]) == "2024-01-02"

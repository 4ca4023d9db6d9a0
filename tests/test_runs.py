"""Checks of the snapshot and of its days, evaluated together: each table is read once for both."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillworks.operators import checks
from tillworks.operators.checks import BUSINESS_RULE, CRITICAL, ERROR, References, RowRule, Run, SameValue, Unique, evaluate, evaluate_runs
from tillworks.operators.lookup import packed_members
from tillworks.plans.lake import SNAPSHOT, Lake, all_checks, lake_of, snapshot_checks
from tillworks.session import materialise


def _check(kind, id, table="t", **more):
    return kind(id, "L", table, id, BUSINESS_RULE, CRITICAL if kind is Unique else ERROR, "", **more)


@pytest.fixture
def written(monkeypatch):
    plans = {}

    def kept(df, label, *by):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, label, *by)

    monkeypatch.setattr(checks, "materialise", kept)
    return plans


def _tables(spark):
    # day 1: key 7 twice; day 2: key 8 once, which day 1 has too; a row without a day; member 99 does not exist
    rows = [(1, 7, 10, 5), (1, 7, 20, 5), (1, 8, 10, -1), (2, 8, 99, 2), (None, 9, None, 3)]
    t = spark.createDataFrame(rows, "day int, k int, d int, amount int")
    d = spark.createDataFrame([(10,), (20,), (-1,)], "d_id bigint")
    return {"t": materialise(t, "t"), "d": materialise(d, "d")}


CHECKS = [
    _check(RowRule, "rule", bad="amount < 0"),
    _check(Unique, "unique", keys=("k",)),
    _check(SameValue, "sum", source="t", source_value="amount", value="amount", where="amount > 0", amount=True),
    _check(References, "refs", links=(("d", "d", "d_id"),)),
]


@pytest.mark.parametrize("packed", [False, True])
def test_snapshot_and_days_in_one_pass(spark, written, packed):
    tables = _tables(spark)
    whole = spark.createDataFrame([("S", None)], "BatchID string, day int")
    days = spark.createDataFrame([("D1", 1), ("D2", 2), ("D3", 3)], "BatchID string, day int")
    runs = [Run(CHECKS, tables, whole, {}), Run(CHECKS, tables, days, {"t": "day"})]
    found = {(r["BatchID"], r["CheckID"]): (r["CheckedRowCount"], r["FailedRowCount"]) for r in evaluate_runs(runs, packed).collect()}
    assert found == {
        ("S", "rule"): (5, 1), ("D1", "rule"): (3, 1), ("D2", "rule"): (1, 0), ("D3", "rule"): (0, 0),
        ("S", "unique"): (5, 2), ("D1", "unique"): (3, 1), ("D2", "unique"): (1, 0), ("D3", "unique"): (0, 0),
        ("S", "sum"): (1, 1), ("D1", "sum"): (1, 1), ("D2", "sum"): (1, 0), ("D3", "sum"): (1, 0),
        ("S", "refs"): (5, 2), ("D1", "refs"): (3, 0), ("D2", "refs"): (1, 1), ("D3", "refs"): (0, 0),
    }
    assert written["check-sums"][0].count("FileScan") == (2 if packed else 1)  # with the members of d
    assert written["key-hashes"][0].count("FileScan") == 1


def test_a_table_without_repeated_keys_is_hashed_once(spark, written):
    tables = {"t": materialise(spark.range(1000).withColumnRenamed("id", "k"), "t")}
    (found,) = evaluate([_check(Unique, "unique", keys=("k",))], tables).collect()
    assert (found["CheckedRowCount"], found["FailedRowCount"]) == (1000, 0)
    assert sum(plan.count("FileScan") for plans in written.values() for plan in plans) == 2


def test_members_that_cannot_be_packed(spark):
    assert packed_members(spark.createDataFrame([("a",)], "k string"), "k") is None
    far = spark.range(100_000).selectExpr("id * 1000000 AS k")
    assert packed_members(far, "k") is None
    near = packed_members(spark.range(-5, 100_000).withColumnRenamed("id", "k"), "k")
    assert near.count() == 26


def test_a_check_of_the_snapshot_builds_only_what_it_reads(spark):
    checks_of, log = all_checks(), lake_of(spark, SMALL)["audit.data_quality_log"]
    for key, built in (
        ("qb10", {"bronze.coupon_redemption_raw"}),
        ("qw18", {"dwh.dim_household", "dwh.dim_campaign", "dwh.fact_campaign_target"}),
        ("qm17", {"dm_marketing.dm_daily_sales", "dm_marketing.dm_promotion_performance"}),
    ):
        lake = Lake(spark, SMALL)
        found = snapshot_checks(lake, [checks_of[key]]).drop("ETLTime")
        logged = log.filter(F.col("DQLogID") == f"{SNAPSHOT}_{checks_of[key].id}").drop("ETLTime")
        assert found.collect() == logged.collect() and found.count() == 1
        assert all(lake.has(name) for name in built)
        assert not any(lake.has(name) for name in ("batches", "by_day.dm_product_sales", "audit.etl_table_load_log", "audit.data_quality_log"))
        assert key == "qm17" or not lake.has("source.lines")


def test_checks_of_two_layers_are_those_of_the_log(spark):
    lake = Lake(spark, SMALL)
    wanted = [c for c in all_checks().values() if c.layer in ("DWH", "DM")]
    found = snapshot_checks(lake, wanted).drop("ETLTime")
    assert not lake.has("audit.data_quality_log")
    log = lake["audit.data_quality_log"].filter(F.col("BatchID") == SNAPSHOT).filter("LayerName IN ('DWH', 'DM')").drop("ETLTime")
    assert found.count() == 45 and found.exceptAll(log).isEmpty()


def test_sources_are_delivered_from_the_stored_lines(spark):
    """The same CSV rows as from the source tables, without joining and grouping them again."""
    lake, other = Lake(spark, SMALL), Lake(spark, SMALL)
    for table in ("source.lines", "bronze.causal_data_raw"):
        lake[table]
    for name in ("transaction_data", "causal_data"):
        assert "Exchange" not in lake._delivered(name)._jdf.queryExecution().executedPlan().toString()
        stored, derived = (spark.read.text(of.csv(name)).filter("value NOT LIKE '%WEEK_NO%'") for of in (lake, other))
        assert stored.count() == derived.count() > 0 and stored.exceptAll(derived).isEmpty()

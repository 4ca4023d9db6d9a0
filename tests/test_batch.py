"""The daily batch from CSV files: planning, loading, rerunning, closing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import SMALL
from tillworks.operators.merge import read_batches, replace_by_batch
from tillworks.plans import batch as batches
from tillworks.plans import control
from tillworks.plans.views import load_failed
from tillworks.schema import BRONZE, CONTROL, FACTS, MARTS, SILVER, SOURCES, conform
from tillworks.session import scratch_path
from tillworks.sources import csvfiles
from tillworks.sources.derived import DERIVED
from tillworks.sources.landing import land, land_all, landed, landed_values


@pytest.fixture(scope="module")
def landing(spark):
    folder, store = scratch_path(spark, "delivered"), scratch_path(spark, "landing")
    for name in SOURCES:
        csvfiles.write_csv(DERIVED[name](spark, SMALL), f"{folder}/{name}.csv", name)
    land_all(spark, folder, store)
    return store


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_landing_reads_one_folder_and_plans_without_rows(spark, landing):
    """The slice of a day prunes to its folder; the planner's days come from names; counts from footers."""
    days = {int(r["day_no"]): r["count"] for r in DERIVED["transaction_data"](spark, SMALL).groupBy("day_no").count().collect()}
    day = min(days)
    rows = landed(spark, landing, "transaction_data", day)
    assert rows.count() == days[day]
    assert "PartitionFilters: [isnotnull(load_value#" in plan_of(rows) and "CSV" not in plan_of(rows)
    assert all(f"/load_value={day}/" in r[0] for r in rows.select(F.input_file_name()).distinct().collect())
    values = landed_values(spark, landing, "transaction_data")
    assert [int(r[0]) for r in values.collect()] == sorted(days)
    assert "FileScan" not in plan_of(values)
    warehouse = batches.Warehouse(spark, scratch_path(spark, "planned"))
    assert batches.next_batch(warehouse, landing, "2026-01-01").day == day


def test_a_delivery_replaces_its_own_days(spark):
    folder, store = scratch_path(spark, "delivered"), scratch_path(spark, "landing")

    def deliver(name, rows):
        df = spark.createDataFrame(rows, "household_key int, day_no int, coupon_upc int, campaign_id int")
        csvfiles.write_csv(df, f"{folder}/{name}", "coupon_redempt")
        land(spark, f"{folder}/{name}", store, "coupon_redempt")
        return sorted((int(r["day_no"] or 0), int(r["household_key"])) for r in landed(spark, store, "coupon_redempt").collect())

    assert deliver("one", [(1, 5, 1, 1), (2, 5, 1, 1), (3, 6, 1, 1), (9, None, 1, 1)]) == [(0, 9), (5, 1), (5, 2), (6, 3)]
    assert deliver("two", [(4, 6, 1, 1), (5, 7, 1, 1)]) == [(0, 9), (5, 1), (5, 2), (6, 4), (7, 5)]
    assert [int(r[0]) for r in landed_values(spark, store, "coupon_redempt").collect()] == [5, 6, 7]


def test_a_reader_sees_old_or_new_rows(spark):
    """A writer that fails half-way leaves the old rows; a reader that began keeps its files."""
    path, schema = scratch_path(spark, "switch"), T.StructType([T.StructField("id", T.LongType()), T.StructField("b", T.StringType())])
    replace_by_batch(spark.range(5), path, {"b": "A"})
    begun = read_batches(spark, path, schema)
    broken = spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        replace_by_batch(broken, path, {"b": "A"})
    assert read_batches(spark, path, schema).count() == 5
    replace_by_batch(spark.range(2), path, {"b": "A"})
    assert begun.collect() and read_batches(spark, path, schema).count() == 2
    replace_by_batch(spark.range(0), path, {"b": "A"})
    assert read_batches(spark, path, schema).count() == 0


def test_a_layer_that_raises_fails_its_batch(spark, landing, monkeypatch):
    warehouse = batches.Warehouse(spark, scratch_path(spark, "failing"))
    batch = batches.next_batch(warehouse, landing, "2026-01-01")

    def lost(*_):
        raise ValueError("no silver today")

    with monkeypatch.context() as patched:
        patched.setattr(batches, "_silver", lost)
        with pytest.raises(batches.BatchFailed, match="SILVER"):
            batches.run_batch(warehouse, landing, batch)
    (closed,) = warehouse.read(batches.CONTROL_TABLE).collect()
    assert (closed["BatchStatus"], closed["ErrorMessage"]) == ("FAILED", "loaded layers=2/4")
    log = {r["ETLLogID"].removeprefix(f"{batch.id}_"): (r["LoadStatus"], r["ErrorMessage"]) for r in warehouse.read(batches.LOAD_LOG).collect()}
    assert log["SILVER_TRANSACTION"] == ("FAILED", "no silver today") and log["BRONZE_TRANSACTION"][0] == "SUCCESS"
    assert batches.next_batch(warehouse, landing, "2026-01-02").id == batch.id  # a failed day is planned again


def content(warehouse):
    """All batch tables without the columns that hold the time of the run."""
    clocks = {"ETLTime", "CreatedAt"}
    found = {}
    for layer, schemas in (("bronze", BRONZE), ("silver", SILVER), ("dwh", FACTS), ("dm_marketing", MARTS)):
        for name, schema in schemas.items():
            columns = [c for c in schema.fieldNames() if c not in clocks]
            found[name] = sorted(map(repr, warehouse.read(f"{layer}.{name}").select(columns).collect()))
    for name, dim in warehouse.dims().items():
        found[name] = sorted(map(repr, dim.drop("CreatedAt", "UpdatedAt").collect()))
    return found


def dimension_files(warehouse):
    return {name: sorted(dim.inputFiles()) for name, dim in warehouse.dims().items()}


def test_two_days_and_a_rerun(spark, landing):
    warehouse = batches.Warehouse(spark, scratch_path(spark, "warehouse"))
    first = batches.next_batch(warehouse, landing, "2026-01-01")
    assert (first.mode, first.week) == (control.INITIAL, 1)
    assert batches.run_batch(warehouse, landing, first) in control.SUCCESS_STATUSES
    second = batches.next_batch(warehouse, landing, "2026-01-02")
    assert second.mode == control.INCREMENTAL and second.day > first.day
    batches.run_batch(warehouse, landing, second)

    before, files = content(warehouse), dimension_files(warehouse)
    batches.run_batch(warehouse, landing, second)
    assert content(warehouse) == before
    assert dimension_files(warehouse) == files  # nothing changed, so no version was written

    log = warehouse.read(batches.LOAD_LOG)
    assert log.count() == 24 and log.select("ETLLogID").distinct().count() == 24
    assert log.filter(load_failed()).count() == 0
    checks = {
        (r["BatchID"], r["LayerName"]): r["count"]
        for r in warehouse.read(batches.DQ_LOG).groupBy("BatchID", "LayerName").count().collect()
    }
    per_layer = {"BRONZE": 19, "SILVER": 21, "DWH": 28, "DM": 17}
    assert checks == {(b.id, layer): n for b in (first, second) for layer, n in per_layer.items()}
    closed = {r["BatchID"]: r for r in warehouse.read(batches.CONTROL_TABLE).collect()}
    assert set(closed) == {first.id, second.id}
    assert all(r["EndTime"] is not None and r["BatchStatus"] in control.SUCCESS_STATUSES for r in closed.values())
    assert warehouse.read(batches.WATERMARK).count() == 8


def history(spark, rows):
    df = spark.createDataFrame(rows, "BatchID string, ProcessDay int, BatchStatus string")
    return conform(df, CONTROL["etl_batch_control"])


def test_planner(spark):
    def days(*values):
        return spark.createDataFrame([(v,) for v in values], "day_no int").select(F.col("day_no").cast("decimal(10,0)"))

    def weeks(*values):
        return spark.createDataFrame([(v,) for v in values], "week_no int").select(F.col("week_no").cast("decimal(10,0)"))

    def plan(done, sold, promoted=(1, 2, 3)):
        row = control.next_batch(days(*sold), weeks(*promoted), history(spark, done)).first()
        return None if row is None else (row["BatchID"], row["LoadMode"], int(row["ProcessWeek"]))

    assert plan([], (3, 4, 12)) == ("RM_DAILY_D0003", "INITIAL", 1)
    assert plan([("a", 3, "SUCCESS")], (3, 4, 12)) == ("RM_DAILY_D0004", "INCREMENTAL", 1)
    assert plan([("a", 4, "SUCCESS_WITH_WARNING")], (3, 4, 12)) == ("RM_DAILY_D0012", "INCREMENTAL", 2)
    assert plan([("a", 3, "SUCCESS"), ("b", 4, "FAILED")], (3, 4, 12)) == ("RM_DAILY_D0004", "INCREMENTAL", 1)
    assert plan([("a", 12, "SUCCESS")], (3, 4, 12)) is None
    assert plan([("a", 4, "SUCCESS")], (3, 4, 12), (1,)) is None


def test_safe_typing_and_permissive_lines(spark):
    folder = scratch_path(spark, "bad-csv")
    lines = ["household_key,DAY,COUPON_UPC,CAMPAIGN", "1,2,3,4", "x,2,3,", "1,2", ""]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(folder)
    rows = csvfiles.read_source(spark, folder, "coupon_redempt").drop("SourceFile").collect()
    as_ints = [tuple(None if v is None else int(v) for v in r) for r in rows]
    assert sorted(as_ints, key=repr) == sorted([(1, 2, 3, 4), (None, 2, 3, None), (1, 2, None, None)], key=repr)

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F, types as T

from tillworks.functions.rowops import known, record_hash
from tillworks.operators import checks as checks_module, dedup, merge, numbering
from tillworks.operators.checks import NotEmpty, References, RowRule, SameValue, Unique, evaluate
from tillworks.operators.constraints import enforced, split
from tillworks.operators.distinct import with_distinct_counts
from tillworks.operators.ranges import explode_weeks
from tillworks.operators.reconcile import side_by_side
from tillworks.operators.versions import read_latest, write_next
from tillworks.plans import marts, silver
from tillworks.schema import DIMENSIONS, SOURCES
from tillworks.session import scratch_path


def skewed(spark, rows: int = 2000):
    """A third of the rows share one value."""
    rng = random.Random(7)
    data = [(i, rng.choice((5, rng.randrange(40), rng.randrange(400)))) for i in range(rows)]
    return spark.createDataFrame(data, "id int, value int")


# --- numbering --------------------------------------------------------------------------------
def test_global_row_number_equals_window(many_partitions):
    df = skewed(many_partitions)
    got = numbering.global_row_number(df, F.desc("value"), "id", name="n")
    expected = df.withColumn("n", F.row_number().over(Window.orderBy(F.desc("value"), "id")))
    assert sorted(got.collect()) == sorted(expected.withColumn("n", F.col("n").cast("bigint")).collect())


def test_global_row_number_of_nothing(spark):
    assert numbering.global_row_number(skewed(spark).filter("id < 0"), "id").count() == 0


def test_dense_rank_equals_window(many_partitions):
    df = skewed(many_partitions).withColumn("batch", (F.col("id") % 3).cast("string"))
    df = df.withColumn("value", F.when(F.col("id") % 50 != 0, F.col("value")))
    got = numbering.global_dense_rank(df, "batch", "value", "r")
    w = Window.partitionBy("batch").orderBy(F.desc("value"))
    expected = df.withColumn("r", F.dense_rank().over(w).cast("bigint"))
    key = lambda r: (r["id"], r["r"])
    assert sorted(map(key, got.collect())) == sorted(map(key, expected.collect()))


@pytest.mark.parametrize("rows", [0, 1, 3, 5, 7, 100, 2000])
def test_ntile_equals_window(many_partitions, rows):
    df = skewed(many_partitions).filter(F.col("id") < rows)
    got = df.withColumn("t", numbering.ntile(df, 5, F.col("value"), F.col("id")))
    expected = df.withColumn("t", F.ntile(5).over(Window.orderBy("value", "id")))
    assert sorted(got.collect()) == sorted(expected.collect())


# --- dedup ------------------------------------------------------------------------------------
def test_dedup_keeps_the_newest_copy(spark):
    rows = [("a", i) for i in range(300)] + [("b", 1), (None, 2), (None, 3)]
    df = spark.createDataFrame(rows, "k string, ETLTime int")
    got = dedup.latest_copy(df, ["k"]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("a", 299), ("b", 1), (None, 3)], key=repr)
    tagged = df.withColumn("note", F.concat(F.lit("n"), "ETLTime"))
    latest = {r["k"]: r["note"] for r in dedup.latest_by_key(tagged, ["k"], ["ETLTime"]).collect()}
    assert latest == {"a": "n299", "b": "n1", None: "n3"}


# --- merges -----------------------------------------------------------------------------------
def stores(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "StoreID int").select(
        F.col("StoreID").cast("decimal(10,0)").alias("StoreID"), record_hash("StoreID").alias("RecordHash")
    )


def test_first_load_numbers_members_and_seeds_unknown(spark):
    got = merge.merge_dimension(None, stores(spark, [30, 10, 20]), "dim_store", "B1")
    assert {(int(r["StoreID"]), r["StoreKey"]) for r in got.collect()} == {(-1, -1), (10, 1), (20, 2), (30, 3)}
    assert got.schema.fieldNames() == DIMENSIONS["dim_store"].fieldNames()


def days(spark, pairs):
    rows = spark.createDataFrame(pairs, "DayNumber int, WeekNumber int").select(
        F.col("DayNumber").cast("decimal(10,0)"), F.col("WeekNumber").cast("decimal(10,0)")
    )
    return rows.withColumn("RecordHash", record_hash("DayNumber", "WeekNumber"))


def test_type_1_merge(spark):
    first = merge.merge_dimension(None, days(spark, [(1, 1), (2, 1), (3, None)]), "dim_day", "B1")
    path = scratch_path(spark, "dim")
    write_next(first, path)
    current = read_latest(spark, path, DIMENSIONS["dim_day"])
    # day 1 unchanged, day 3 changed, day 0 new, day 2 absent from the source
    source = days(spark, [(1, 1), (3, 1), (0, 1)])
    merged = merge.merge_dimension(current, source, "dim_day", "B2")
    rows = {int(r["DayNumber"]): (r["DayKey"], r["WeekNumber"], r["SourceBatchID"]) for r in merged.collect()}
    assert rows == {-1: (-1, -1, "SYSTEM"), 1: (1, 1, "B1"), 2: (2, 1, "B1"), 3: (3, 1, "B2"), 0: (4, 1, "B2")}
    write_next(merged, path)
    again = merge.merge_dimension(read_latest(spark, path, DIMENSIONS["dim_day"]), source, "dim_day", "B3")
    columns = ["DayKey", "DayNumber", "WeekNumber", "SourceBatchID", "RecordHash"]
    assert sorted(again.select(columns).collect()) == sorted(merged.select(columns).collect())
    unchanged = read_latest(spark, path, DIMENSIONS["dim_day"])
    assert merge.merge_dimension(unchanged, source, "dim_day", "B4") is unchanged


def test_merge_refuses_repeated_natural_keys(spark):
    with pytest.raises(Exception, match="several source rows"):
        merge.merge_dimension(None, stores(spark, [1, 1]), "dim_store", "B1").collect()


def test_replace_by_batch(spark):
    path = scratch_path(spark, "replace")
    rows = spark.range(5).withColumn("b", F.lit("x"))
    for batch, df in (("A", rows), ("B", rows), ("A", rows.limit(2))):
        merge.replace_by_batch(df, path, {"b": batch})
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("b", T.StringType())])
    table = lambda: {r["b"]: r["count"] for r in merge.read_batches(spark, path, schema).groupBy("b").count().collect()}
    assert table() == {"A": 2, "B": 5}
    merge.replace_by_batch(rows.filter("id < 0"), path, {"b": "A"})
    assert table() == {"B": 5}


def test_gate_and_upsert(spark):
    control = spark.createDataFrame([("A", "RUNNING"), ("B", "FAILED")], "BatchID string, BatchStatus string")
    rows = spark.range(4)
    assert merge.only_when_running(rows, control, "A").count() == 4
    assert merge.only_when_running(rows, control, "B").count() == 0
    assert merge.only_when_running(rows, control, "C").count() == 0
    changed = spark.createDataFrame([("B", "SUCCESS"), ("C", "RUNNING")], control.schema)
    merged = merge.upsert(control, changed, "BatchID")
    assert {tuple(r) for r in merged.collect()} == {("A", "RUNNING"), ("B", "SUCCESS"), ("C", "RUNNING")}


# --- ranges, reconciliation, marts --------------------------------------------------------------
def test_weeks_match_the_written_range(spark):
    intervals = spark.createDataFrame([(i, s, s + n) for i, (s, n) in enumerate([(1, 27), (8, 3), (7, 0), (15, 41), (9, 4)])], "i int, s int, e int")
    got = {(r["i"], int(r["w"])) for r in explode_weeks(intervals, F.col("s"), F.col("e"), "w").collect()}
    expected = {(r["i"], w) for r in intervals.collect() for w in range(100) if r["s"] / 7 <= w <= r["e"] / 7}
    assert got == expected


def test_side_by_side(spark):
    a, b = spark.range(3), spark.range(0)
    row = side_by_side({"a": (a, F.count("*")), "b": (b, F.count("*")), "top": (a, F.max("id"))}).first()
    assert tuple(row) == (3, 0, 2)


def test_distinct_counts_beside_sums(many_partitions):
    rng = random.Random(3)
    rows = [
        (rng.choice((1, 1, rng.randrange(9))), rng.choice((None, rng.randrange(60))), rng.randrange(-1, 30), rng.randrange(-1, 4), rng.choice("YN"), i)
        for i in range(1500)
    ]
    sales = many_partitions.createDataFrame(
        rows, "DayKey int, BasketID int, ProductKey int, StoreKey int, HasCoupon string, NetSalesAmount int"
    ).withColumns(
        {
            "DayKey": F.when(F.col("DayKey") != 5, F.col("DayKey")),
            # some identifiers need more than a BIGINT
            "BasketID": F.col("BasketID").cast("decimal(20,0)") + F.lit("99999999999999999900").cast("decimal(20,0)")
            * (F.col("BasketID") % 2),
        }
    )
    got = with_distinct_counts(
        sales,
        {"DayKey": F.col("DayKey")},
        [F.sum("NetSalesAmount").alias("NetSalesAmount")],
        {
            "BasketCount": F.col("BasketID"),
            "CouponTransactionCount": F.when(F.col("HasCoupon") == "Y", F.col("BasketID")),
            "ProductCount": known("ProductKey"),
            "StoreCount": known("StoreKey"),
        },
    )
    expected = sales.groupBy("DayKey").agg(
        F.countDistinct("BasketID").alias("BasketCount"),
        F.sum("NetSalesAmount").alias("NetSalesAmount"),
        F.countDistinct(F.when(F.col("HasCoupon") == "Y", F.col("BasketID"))).alias("CouponTransactionCount"),
        F.countDistinct(known("ProductKey")).alias("ProductCount"),
        F.countDistinct(known("StoreKey")).alias("StoreCount"),
    )
    assert sorted(got.select(expected.columns).collect(), key=repr) == sorted(expected.collect(), key=repr)


# --- checks -----------------------------------------------------------------------------------
def spec(kind, name, table="t", **options):
    return kind(name, "DWH", table, name, "BUSINESS_RULE", "CRITICAL", "", **options)


CHECKS = [
    spec(NotEmpty, "not_empty"),
    spec(NotEmpty, "two_rows", at_least=2),
    spec(Unique, "unique_k", keys=("k",)),
    spec(Unique, "unique_pair", keys=("k", "v")),
    spec(RowRule, "positive", bad="v <= 0"),
    spec(RowRule, "positive_warns", bad="v <= 0", on_failure="WARN"),
    spec(RowRule, "rows_wanted", bad="false", empty_fails=True),
    spec(References, "k_exists", links=(("k", "d", "id"),)),
    spec(SameValue, "same_rows", source="d"),
    spec(SameValue, "same_amount", source="d", source_value="id", value="v", amount=True),
]


def statuses(spark, rows, dim):
    tables = {
        "t": spark.createDataFrame(rows, "k int, v int"),
        "d": spark.createDataFrame([(i,) for i in dim], "id int"),
    }
    found = evaluate(CHECKS, tables).collect()
    assert len(found) == len(CHECKS)
    return {
        r["CheckName"]: (r["CheckStatus"], *(None if v is None else float(v) for v in (r["CheckedRowCount"], r["PassedRowCount"], r["FailedRowCount"], r["FailureRate"])))
        for r in found
    }


def test_checks_pass(spark):
    assert statuses(spark, [(1, 1), (2, 2)], [1, 2]) == {
        "not_empty": ("PASS", 2, 2, 0, 0),
        "two_rows": ("PASS", 2, 2, 0, 0),
        "unique_k": ("PASS", 2, None, 0, None),
        "unique_pair": ("PASS", 2, None, 0, None),
        "positive": ("PASS", 2, 2, 0, 0),
        "positive_warns": ("PASS", 2, 2, 0, 0),
        "rows_wanted": ("PASS", 2, 2, 0, 0),
        "k_exists": ("PASS", 2, 2, 0, 0),
        "same_rows": ("PASS", 2, 2, 0, 0),
        "same_amount": ("PASS", 1, 1, 0, 0),
    }


def test_checks_fail(spark):
    assert statuses(spark, [(1, 0), (1, 3), (1, None), (9, 5)], [1, 2]) == {
        "not_empty": ("PASS", 4, 4, 0, 0),
        "two_rows": ("PASS", 4, 4, 0, 0),
        "unique_k": ("FAIL", 4, None, 1, None),
        "unique_pair": ("PASS", 4, None, 0, None),
        "positive": ("FAIL", 4, 3, 1, 0.25),
        "positive_warns": ("WARN", 4, 3, 1, 0.25),
        "rows_wanted": ("PASS", 4, 4, 0, 0),
        "k_exists": ("FAIL", 4, 3, 1, 0.25),
        "same_rows": ("FAIL", 2, 0, 2, 1),
        "same_amount": ("FAIL", 1, 0, 1, 1),
    }


def test_checks_on_an_empty_table(spark):
    assert statuses(spark, [], [1]) == {
        "not_empty": ("FAIL", 0, 0, 1, 1),
        "two_rows": ("FAIL", 0, 0, 1, 1),
        "unique_k": ("PASS", 0, None, 0, None),
        "unique_pair": ("PASS", 0, None, 0, None),
        "positive": ("PASS", 0, 0, 0, 0),
        "positive_warns": ("PASS", 0, 0, 0, 0),
        "rows_wanted": ("FAIL", 0, 0, 1, 1),
        "k_exists": ("PASS", 0, 0, 0, 0),
        "same_rows": ("FAIL", 1, 0, 1, 1),
        "same_amount": ("FAIL", 1, 0, 1, 1),
    }


def test_checks_of_all_batches(spark):
    """A table by day, one by week and one in whole, each checked for every batch; a batch without rows counts 0."""
    batches = spark.createDataFrame([("A", 1, 1), ("B", 2, 1), ("C", 9, 2)], "BatchID string, day int, week int")
    tables = {
        "t": spark.createDataFrame([(1, 1, 5), (1, 1, 6), (2, 1, -1), (2, 7, 2)], "day int, k int, v int"),
        "d": spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "week int, id int"),
        "all": spark.createDataFrame([(1,), (1,)], "id int"),
        "known": spark.createDataFrame([(1,)], "id int"),
    }
    checks = [
        spec(NotEmpty, "any"),
        spec(Unique, "unique_k", keys=("k",)),
        spec(RowRule, "positive", bad="v <= 0"),
        spec(RowRule, "own_day", bad="day <> 1"),
        spec(References, "k_exists", links=(("k", "known", "id"),)),
        spec(NotEmpty, "week_rows", table="d"),
        spec(Unique, "unique_in_whole", table="all", keys=("id",)),
        spec(SameValue, "as_many", source="d"),
    ]
    found = evaluate(checks, tables, batches, {"t": "day", "d": "week"}).collect()
    got = {(r["BatchID"], r["CheckName"]): (r["CheckStatus"], int(r["CheckedRowCount"]), int(r["FailedRowCount"])) for r in found}
    assert len(found) == len(got) == 3 * len(checks)
    assert {k: v for k, v in got.items() if k[0] == "A"} == {
        ("A", "any"): ("PASS", 2, 0), ("A", "unique_k"): ("FAIL", 2, 1), ("A", "positive"): ("PASS", 2, 0), ("A", "own_day"): ("PASS", 2, 0),
        ("A", "k_exists"): ("PASS", 2, 0), ("A", "week_rows"): ("PASS", 2, 0),
        ("A", "unique_in_whole"): ("FAIL", 2, 1), ("A", "as_many"): ("PASS", 2, 0),
    }
    assert got["B", "unique_k"] == ("PASS", 2, 0) and got["B", "positive"] == ("FAIL", 2, 1) and got["B", "own_day"] == ("FAIL", 2, 2)
    assert got["B", "k_exists"] == ("FAIL", 2, 1)
    assert got["C", "any"] == ("FAIL", 0, 1) and got["C", "positive"] == ("PASS", 0, 0) and got["C", "week_rows"] == ("PASS", 1, 0)
    assert got["C", "as_many"] == ("FAIL", 1, 1) and got["C", "unique_in_whole"] == ("FAIL", 2, 1)


def test_keys_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(checks_module.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    table = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), ("c",)], "k string")
    (found,) = evaluate([spec(Unique, "u", keys=("k",))], {"t": table}).collect()
    assert (found["CheckedRowCount"], found["FailedRowCount"]) == (6, 2)


# --- declared schemas -------------------------------------------------------------------------
SHOP = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("price", T.DecimalType(5, 2)), T.StructField("name", T.StringType(), False), T.StructField("note", T.StringType())])


def test_rows_are_split_by_the_declared_schema(spark):
    rows = [("1", "2.50", "a"), ("x", "2.50", "a"), (None, "1000", None), ("2", None, "b"), ("3", "no", "c")]
    df = spark.createDataFrame(rows, "id string, price string, name string")
    found = split(df, SHOP)
    assert [f.dataType for f in found.schema][:4] == [f.dataType for f in SHOP]
    assert [(r["id"], r["name"], r["BrokenRules"]) for r in found.collect()] == [
        (1, "a", []),
        (None, "a", ["id BIGINT NOT NULL"]),
        (None, None, ["id BIGINT NOT NULL", "price DECIMAL(5,2)", "name STRING NOT NULL"]),
        (2, "b", []),
        (3, "c", ["price DECIMAL(5,2)"]),
    ]


def test_a_broken_rule_fails_the_write(spark):
    good = spark.createDataFrame([(1, "a")], "id long, name string")
    assert [tuple(r) for r in enforced(good, SHOP, "shop").collect()] == [(1, None, "a", None)]
    bad = good.union(spark.createDataFrame([(2, None)], "id long, name string"))
    with pytest.raises(Exception, match="shop: name STRING NOT NULL is broken"):
        enforced(bad, SHOP, "shop").collect()


def test_the_latest_copy_stays_whole(spark):
    """The later load is for the earlier day: date and time of the result are those of one copy."""
    columns = {c: F.lit(1).cast(t) for c, t in dict(SOURCES["transaction_data"].values()).items()}
    copies = spark.createDataFrame([("2024-01-02", "2024-01-02 05:00:00"), ("2024-01-01", "2024-01-03 05:00:00")], "d string, t string")
    valid = copies.select(*[c.alias(n) for n, c in columns.items()], F.col("d").cast("date").alias("ProcessDate"), F.col("t").cast("timestamp").alias("ETLTime"))
    (row,) = silver.deduplicated_transactions(valid).collect()
    assert (str(row["ProcessDate"]), str(row["ETLTime"])) == ("2024-01-01", "2024-01-03 05:00:00")


def test_campaign_mart_of_every_day(spark):
    dim = spark.createDataFrame([(-1, -1), (1, 10), (2, 20), (3, 30)], "CampaignKey long, CampaignID int")
    targets = spark.createDataFrame([(1,), (1,), (2,)], "CampaignKey long")
    redeemed = spark.createDataFrame([(5, 1, 7, 1, 1), (5, 1, 7, 2, 1), (6, 3, 8, 1, 1), (9, 1, 7, 1, 1)], "day int, CampaignKey long, HouseholdKey long, CouponKey long, RedemptionCount int")
    redeemed = redeemed.withColumn("ProcessDay", F.col("day").cast("decimal(10,0)"))
    days = spark.createDataFrame([(5,), (6,)], "d int").select(F.col("d").cast("decimal(10,0)").alias("ProcessDay"))
    found = marts.campaign_performance_by_day(dim, targets, redeemed, days, "B", "2024-01-01").collect()
    got = {(int(r["ProcessDay"]), r["CampaignKey"]): tuple(int(r[c]) for c in ("TargetHouseholdCount", "RedeemingHouseholdCount", "RedemptionCount", "DistinctCouponCount")) for r in found}
    assert got == {(5, 1): (2, 1, 2, 2), (5, 2): (1, 0, 0, 0), (6, 1): (2, 0, 0, 0), (6, 2): (1, 0, 0, 0), (6, 3): (0, 1, 1, 1)}

"""What is written and shuffled on the way to the layers, per row, and that it gives the same rows."""

from __future__ import annotations

import time
from decimal import Decimal

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillworks import session
from tillworks.functions.rowops import known
from tillworks.operators import checks, dedup
from tillworks.operators.dedup import latest_copy, latest_in_place, latest_of_few_copies
from tillworks.operators.distinct import with_distinct_counts, with_distinct_counts_of_small_groups
from tillworks.operators.lookup import lookup_key, lookup_packed, packed_keys
from tillworks.plans import bronze, dims, facts, marts, quality, silver
from tillworks.plans.lake import PROCESS_DATE, SNAPSHOT, Lake, lake_of, promotion_performance
from tillworks.schema import BRONZE_TABLE
from tillworks.session import dealt, materialise
from tillworks.sources import derived


def _written_columns(df) -> set[str]:
    files = [f.removeprefix("file://") for f in df.inputFiles()]
    return {c for f in files for c in pq.read_schema(f).names}


def test_record_hashes_are_not_written_and_stay_the_same(spark):
    lake = lake_of(spark, SMALL)
    for source, table in BRONZE_TABLE.items():
        stored = lake[f"bronze.{table}"]
        assert "RecordHash" not in _written_columns(stored)
        whole = bronze.to_bronze(lake.source(source), source, SNAPSHOT, PROCESS_DATE)
        assert stored.schema.names == whole.schema.names
        columns = [c for c in whole.columns if c != "ETLTime"]
        assert stored.select(columns).exceptAll(whole.select(columns)).isEmpty()
        assert stored.count() == whole.count()


def test_layers_over_narrow_rows_are_the_operators_results(spark):
    lake = lake_of(spark, SMALL)
    sales = silver.transaction_clean(
        silver.deduplicated_transactions(silver.valid_transactions(lake["bronze.transaction_data_raw"])), SNAPSHOT, PROCESS_DATE
    )
    promotions = silver.promotion_weekly_clean(lake["bronze.causal_data_raw"], SNAPSHOT, PROCESS_DATE)
    expected = {
        "silver.transaction_clean": sales,
        "silver.promotion_weekly_clean": promotions,
        "dwh.fact_sales_transaction": facts.sales_fact(sales, lake.dims()),
        "dwh.fact_promotion_weekly": facts.promotion_fact(promotions, lake.dims()),
    }
    for name, whole in expected.items():
        stored = lake[name]
        assert stored.schema.names == whole.schema.names
        assert [f.dataType for f in stored.schema] == [f.dataType for f in whole.schema]
        assert "RecordHash" not in _written_columns(stored)
        columns = [c for c in whole.columns if c not in ("ETLTime", "CreatedAt")]
        assert stored.select(columns).exceptAll(whole.select(columns)).isEmpty()
        assert stored.count() == whole.count()


def test_a_target_fact_builds_its_own_dimensions_only(spark):
    lake = Lake(spark, SMALL)
    assert lake["dwh.fact_campaign_target"].count() == lake["silver.campaign_target_clean"].count()
    assert not {"silver.transaction_clean", "bronze.causal_data_raw", "dwh.dim_store"} & lake._tables.keys()


def test_few_copies_as_many_copies(spark):
    """(NULL, 1) and (1, NULL) have the same 8-byte hash and are different rows."""
    rows = [(None, 1, 3), (1, None, 4), (2, 2, 1), (2, 2, 9), (2, 2, 5), (7, 8, 0)]
    df = spark.createDataFrame(rows, "a int, b int, ETLTime int")
    assert df.select(F.xxhash64("a", "b")).distinct().count() == 3
    got = sorted(map(tuple, latest_of_few_copies(df, ["a", "b"]).collect()), key=repr)
    assert got == sorted([(None, 1, 3), (1, None, 4), (2, 2, 9), (7, 8, 0)], key=repr)
    assert got == sorted(map(tuple, latest_copy(df, ["a", "b"]).collect()), key=repr)


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_whole_rows_without_copies_are_not_shuffled(spark):
    rows = spark.createDataFrame([(i, 0) for i in range(1000)], "a int, ETLTime int")
    alone = latest_of_few_copies(rows, ["a"])
    assert alone.count() == 1000
    assert _exchanges(alone) == 1  # of the few copies


def test_promotions_and_sales_are_shuffled_once_each(spark):
    lake = lake_of(spark, SMALL)
    sides = lake["dwh.fact_promotion_weekly"], lake["dwh.fact_sales_transaction"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(marts.promotions_with_sales(*sides)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hashes_of_unique_keys_are_not_written(spark, monkeypatch):
    written = {}

    def kept(df, label, *by):
        written[label] = materialise(df, label, *by)
        return written[label]

    monkeypatch.setattr(checks, "materialise", kept)
    tables = {"silver.transaction_clean": lake_of(spark, SMALL)["silver.transaction_clean"]}
    (found,) = checks.evaluate([quality.silver_checks()["qs9"]], tables).collect()
    assert found["CheckStatus"] == "PASS" and found["CheckedRowCount"] == tables["silver.transaction_clean"].count()
    assert written["key-hashes"].count() == 1


def test_unique_keys_are_shuffled_as_one_hash(spark, monkeypatch):
    plans = []

    def kept(df, label, *by):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, label, *by)

    monkeypatch.setattr(checks, "materialise", kept)
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, None), (2, None)], "g int, k string")
    check = checks.Unique("c", "L", "t", "n", checks.UNIQUENESS, checks.ERROR, "d", keys=("k",))
    found = checks.key_counts([check], {"t": rows}, {"t": "g"}).collect()
    assert sorted((int(r["_group"]), r["_rows"], r["_bad"]) for r in found) == [(1, 3, 1), (2, 3, 1)]
    (hashed,) = [p for p in plans[0].split("Exchange hashpartitioning(")[1:] if "_hash" in p.split("]")[0]]
    assert hashed.startswith("_hash#") and "_group" not in hashed.split("]")[0]


def test_members_of_distinct_counts_are_one_number(spark):
    """Members beyond a BIGINT that agree in their lower 18 digits, or with a small one, stay apart."""
    text = ["5", "5", "9" * 20, "8" + "9" * 19, "-" + "9" * 20, "10000000000000000005", "-9223372036854775808", "0", None]
    rows = spark.createDataFrame([(1, t, i % 2) for i, t in enumerate(text)], "g int, t string, b int")
    rows = rows.withColumn("a", F.col("t").cast("decimal(20,0)"))
    keys, counts = {"g": F.col("g")}, {"n": F.col("a"), "m": F.col("b")}
    got = with_distinct_counts(rows, keys, [F.count("*").alias("rows")], counts)
    assert [tuple(r) for r in got.select("g", "rows", "n", "m").collect()] == [(1, 9, 7, 2)]
    assert "_wide" not in got._jdf.queryExecution().optimizedPlan().toString()
    small = with_distinct_counts_of_small_groups(rows, keys, [F.count("*").alias("rows")], counts)
    assert [tuple(r) for r in small.select("g", "rows", "n", "m").collect()] == [(1, 9, 7, 2)]


def test_products_by_day_shuffle_each_line_once(spark):
    lake = lake_of(spark, SMALL)
    sales = lake["dwh.fact_sales_transaction"].withColumn("ProcessDay", F.col("WeekNumber"))
    by_day = marts.product_sales(sales, lake["dwh.dim_product"], SNAPSHOT, PROCESS_DATE, ("ProcessDay",))
    assert _exchanges(by_day) == 1
    counts = ["BasketCount", "CouponTransactionCount", "HouseholdCount", "StoreCount"]
    expected = with_distinct_counts(
        sales,
        {c: F.col(c) for c in ("ProductKey", "ProcessDay")},
        marts._sales_sums(),
        {**marts._baskets(), "HouseholdCount": known("HouseholdKey"), "StoreCount": known("StoreKey")},
    )
    columns = ["ProductKey", "ProcessDay", "TotalQuantity", "NetSalesAmount", *counts]
    types = [f.dataType for f in by_day.select(columns).schema]
    expected = expected.select(*[F.col(c).cast(t) for c, t in zip(columns, types, strict=True)])
    assert by_day.select(columns).exceptAll(expected).isEmpty() and expected.count() == by_day.count()


def test_pairs_of_a_large_table_go_to_tasks_that_hold_them(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("g"), (F.col("id") % 100).alias("a"), (F.col("id") % 3).alias("b"))
    keys, counts = {"g": F.col("g")}, {"n": F.col("a"), "m": F.col("b")}
    several = 3 * spark.sparkContext.defaultParallelism
    dealt = with_distinct_counts(rows, keys, [F.count("*").alias("rows")], counts, rows=several * 500_000)
    plain = with_distinct_counts(rows, keys, [F.count("*").alias("rows")], counts)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert f", {several}), REPARTITION_BY_NUM" in plan
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))


def test_packed_keys_give_the_keys_of_a_plain_lookup(spark):
    """Words and blocks at their edges, gaps, negative and absent natural keys, and none."""
    ids = sorted({-70, -5, 0, 63, 64, 127, 4095, 4096, 8191, *range(200, 9000, 7)})
    columns = "ProductKey bigint, ProductID decimal(10,0), IsCurrent boolean"
    dim = spark.createDataFrame([(i, Decimal(n), True) for i, n in enumerate(ids, 1)], columns)
    fact = spark.range(-5000, 13000).select(F.col("id").cast("decimal(10,0)").alias("product_id"))
    fact = fact.unionByName(spark.sql("SELECT CAST(NULL AS DECIMAL(10,0)) AS product_id"))
    packed = lookup_packed(fact, "product_id", packed_keys(dim, "dim_product"), "dim_product")
    plain = lookup_key(fact, "product_id", dim, "dim_product")
    assert packed.schema == plain.schema
    assert packed.count() == plain.count()
    assert packed.exceptAll(plain).isEmpty()


def test_keys_out_of_order_or_far_apart_are_not_packed(spark):
    columns = "ProductKey bigint, ProductID decimal(10,0), IsCurrent boolean"

    def packed(pairs):
        return packed_keys(spark.createDataFrame([(k, Decimal(n), True) for k, n in pairs], columns), "dim_product")

    assert packed([(1, 5), (2, 6), (3, 7)]) is not None
    assert packed([(2, 5), (1, 6), (3, 7)]) is None
    assert packed([(1, 5), (2, 5), (3, 7)]) is None
    assert packed([(k, 5000 * k) for k in range(1, 200)]) is None


def test_sales_lines_are_not_shuffled_for_their_keys(spark):
    lake = lake_of(spark, SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(lake["dwh.fact_sales_transaction"]) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_promotion_mart_takes_its_ids_along(spark):
    """Both sides once, and no join of the mart's rows with products or stores; the same rows as with these."""
    lake = lake_of(spark, SMALL)
    joined = marts.promotion_performance(
        lake["dwh.fact_promotion_weekly"],
        lake["dwh.fact_sales_transaction"],
        lake["dwh.dim_product"],
        lake["dwh.dim_store"],
        SNAPSHOT,
        PROCESS_DATE,
    ).drop("CreatedAt")
    stored = lake["dm_marketing.dm_promotion_performance"].drop("CreatedAt")
    assert stored.dtypes == joined.dtypes
    assert stored.count() == joined.count()
    assert stored.exceptAll(joined).isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(promotion_performance(lake)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tasks_follow_the_number_of_rows(spark):
    rows = spark.range(10).withColumnRenamed("id", "a")
    assert "hashpartitioning(a#" in (plan := dealt(rows, 500_000 * 20, "a")._jdf.queryExecution().executedPlan().toString())
    assert ", 20)" in plan and "REPARTITION_BY_NUM" in plan


def test_lines_are_joined_with_their_orders_once(spark, monkeypatch):
    joined = []
    plain = derived._lines
    monkeypatch.setattr(derived, "_lines", lambda *args: joined.append(args) or plain(*args))
    lake = Lake(spark, SMALL)
    for table, source in (("transaction_data_raw", "transaction_data"), ("causal_data_raw", "causal_data")):
        stored = lake[f"bronze.{table}"]
        assert len(joined) == 1, "joined once for both"
        whole = bronze.to_bronze(derived.DERIVED[source](spark, SMALL), source, SNAPSHOT, PROCESS_DATE)
        columns = [c for c in whole.columns if c != "ETLTime"]
        assert stored.select(columns).dtypes == whole.select(columns).dtypes
        assert stored.count() == whole.count() and stored.select(columns).exceptAll(whole.select(columns)).isEmpty()
        del joined[1:]
    assert lake["bronze.transaction_data_raw"].select("ETLTime").distinct().count() == 1


def test_stores_do_not_wait_for_clean_promotions(spark):
    lake = Lake(spark, SMALL)
    stores = lake["dwh.dim_store"].filter("StoreKey <> -1").select("StoreID")
    assert "silver.promotion_weekly_clean" not in lake._tables
    clean = dims.store_source(lake["silver.transaction_clean"], lake["silver.promotion_weekly_clean"]).select("StoreID")
    assert stores.exceptAll(clean).isEmpty() and clean.exceptAll(stores).isEmpty()


def test_amounts_that_follow_from_others_stay_out_of_the_promotion_mart(spark):
    lake = lake_of(spark, SMALL)
    mart = lake["dm_marketing.dm_promotion_performance"]
    written = _written_columns(mart)
    assert "NetSalesAmount" in written and not {"GrossSalesAmount", "AverageBasketAmount"} & written
    sales = lake["dwh.fact_sales_transaction"]
    plan = marts.promotion_sales(sales)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression") :].splitlines()[1]
    assert "_member" in below and "GrossSalesAmount" not in below
    expected = sales.groupBy("ProductKey", "StoreKey", "WeekNumber").agg(
        F.countDistinct("BasketID").alias("BasketCount"), F.sum("GrossSalesAmount").alias("GrossSalesAmount")
    )
    assert marts.promotion_sales(sales).select(expected.columns).exceptAll(expected).isEmpty()


def test_baskets_beyond_a_bigint_and_none_in_promotion_sales(spark):
    rows = [(1, 1, 1, b) for b in ("5", "5", "9" * 20, "8" + "9" * 19, None)] + [(2, 1, 1, None)]
    sales = spark.createDataFrame(rows, "ProductKey bigint, StoreKey bigint, WeekNumber int, b string").select(
        "ProductKey", "StoreKey", "WeekNumber", F.col("b").cast("decimal(20,0)").alias("BasketID"),
        *[F.lit(v).cast("decimal(18,4)").alias(c) for c, v in
          (("Quantity", 1), ("GrossSalesAmount", 3), ("TotalDiscountAmount", 1), ("NetSalesAmount", 2))],
    )
    got = marts.promotion_sales(sales).orderBy("ProductKey").select("BasketCount", "GrossSalesAmount").collect()
    assert [tuple(map(int, r)) for r in got] == [(3, 15), (0, 3)]


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return files.mkString("\n").count("/shuffle_")


def test_shuffle_files_of_a_written_table_go_with_the_write(spark):
    before = _shuffle_files(spark)
    rows = spark.range(1000).repartition(4, "id")
    table = materialise(rows, "shuffled")
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert spark.conf.get(session._CLEANUP, None) is None
    assert table.count() == 1000
    with session.shuffles_removed(spark), session.shuffles_removed(spark):
        assert spark.conf.get(session._CLEANUP) == "true"
    assert spark.conf.get(session._CLEANUP, None) is None


def test_clean_tables_with_few_copies_are_not_written_again(spark, monkeypatch):
    lake = Lake(spark, SMALL)
    for name in ("silver.transaction_clean", "silver.promotion_weekly_clean"):
        table = lake[name]
        assert not any("/silver." in f for f in table.inputFiles())
        assert table.select("ETLTime").distinct().count() == 1
    monkeypatch.setattr(dedup, "_FEW", -1)
    stored = Lake(spark, SMALL)
    for name in ("silver.transaction_clean", "silver.promotion_weekly_clean"):
        assert all("/silver." in f for f in stored[name].inputFiles())
        columns = [c for c in stored[name].columns if c != "ETLTime"]
        assert stored[name].dtypes == lake[name].dtypes and stored[name].count() == lake[name].count()
        assert stored[name].select(columns).exceptAll(lake[name].select(columns)).isEmpty()


def test_copies_in_place(spark):
    rows = [(None, 1, 3), (1, None, 4), (2, 2, 1), (2, 2, 9), (2, 2, 5), (7, 8, 0)]
    df = spark.createDataFrame(rows, "a int, b int, ETLTime int")
    got, in_place = latest_in_place(df, ["a", "b"])
    assert in_place and _exchanges(got) == 0
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, latest_copy(df, ["a", "b"]).collect()), key=repr)
    alone, in_place = latest_in_place(df.filter("a = 7"), ["a", "b"])
    assert in_place and [tuple(r) for r in alone.collect()] == [(7, 8, 0)]


def test_members_of_many_groups_are_counted_in_few_tasks(spark):
    """Of each group a row per count and part at most, and not one per pair, is shuffled to be added up."""
    text = ["5", "9" * 20, "8" + "9" * 19, "-" + "9" * 20, "10000000000000000005", None]
    wide = F.element_at(F.array(*[F.lit(t) for t in text]), (F.col("id") % len(text) + 1).cast("int")).cast("decimal(20,0)")
    rows = spark.range(20_000).select((F.col("id") % 7).alias("g"), F.col("id").alias("a"), wide.alias("b"))
    keys, counts = {"g": F.col("g")}, {"n": F.col("a"), "m": F.col("b")}
    several = 20 * spark.sparkContext.defaultParallelism
    few = with_distinct_counts(rows, keys, [F.count("*").alias("rows")], counts, rows=several * 500_000, groups=several * 500_000)
    plain = with_distinct_counts(rows, keys, [F.count("*").alias("rows")], counts)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, plain.collect()))
    sent = few._jdf.queryExecution().executedPlan().toString()
    assert "_which" in sent.split("REPARTITION_BY_NUM")[0].rsplit("hashpartitioning(", 1)[1]
    assert "_member" not in sent.split("REPARTITION_BY_NUM")[0].rsplit("hashpartitioning(", 1)[1]

"""Plans that must hold at scale: what reaches the scan, and what goes to a single task."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillworks.operators import checks, numbering
from tillworks.plans import facts, quality, silver
from tillworks.plans.lake import lake_of
from tillworks.plans.registry import QUERIES
from tillworks.session import materialise


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_valid_filter_reaches_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    bronze = lake_of(spark, SMALL)["bronze.transaction_data_raw"]
    plan = plan_of(silver.valid_transactions(bronze, 5).select("product_id"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    for condition in ("IsNotNull(basket_id)", "GreaterThan(quantity", "GreaterThanOrEqual(sales_value", "EqualTo(day_no"):
        assert condition in pushed
    columns = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert set(re.findall(r"(\w+):", columns)) == {"basket_id", "product_id", "day_no", "quantity", "sales_value"}


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark):
    lake = lake_of(spark, SMALL)
    sales, dims = lake["silver.transaction_clean"], lake.dims()
    assert plan_of(facts.sales_fact(sales, dims)).count("BroadcastHashJoin") == 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(facts.sales_fact(sales, dims))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 4
    assert "Broadcast" not in plan


def test_numbering_and_ranks_use_no_single_task(spark):
    products = lake_of(spark, SMALL)["dm_marketing.dm_product_sales"]
    numbered = numbering.global_row_number(products, F.desc("NetSalesAmount"), "ProductKey")
    ranked = numbering.global_dense_rank(products, "SourceBatchID", "NetSalesAmount", "rank")
    for df in (numbered, ranked):
        assert "SinglePartition" not in plan_of(df)
        assert "Window" not in plan_of(df)


def test_deduplication_combines_before_the_shuffle(spark):
    bronze = lake_of(spark, SMALL)["bronze.transaction_data_raw"]
    plan = plan_of(silver.deduplicated_transactions(silver.valid_transactions(bronze)))
    assert plan.count("HashAggregate") == 2
    assert "Window" not in plan and "SortAggregate" not in plan


def test_distinct_counts_do_not_repeat_the_sums(spark):
    lake = lake_of(spark, SMALL)
    for name in ("a1_daily_sales", "a2_product_sales", "n14_campaign_timing", "n15_store_performance", "n16_category_baskets"):
        plan = plan_of(QUERIES[name][0](lake))
        assert "Expand" not in plan and "SortAggregate" not in plan


def test_aggregates_beside_each_other_read_a_table_once(spark):
    plan = plan_of(QUERIES["a18_source_bounds"][0](lake_of(spark, SMALL)))
    assert plan.count("FileScan") == 2


def test_uniqueness_sends_hashes_through_the_shuffle(spark, monkeypatch):
    """The first stage exchanges 8-byte hashes; the keys of repeated hashes only come after it."""
    written = {}

    def kept(df, label, *by):
        written[label] = df
        return materialise(df, label, *by)

    monkeypatch.setattr(checks, "materialise", kept)
    lake = lake_of(spark, SMALL)
    wanted = [quality.silver_checks()["qs9"], quality.dwh_checks()["qw16"]]
    tables = {"silver.transaction_clean": lake["silver.transaction_clean"], "dwh.fact_sales_transaction": lake["dwh.fact_sales_transaction"]}
    found = checks.evaluate(wanted, tables).collect()
    assert {r["CheckStatus"] for r in found} == {"PASS"}
    assert dict(written["key-hashes"].dtypes)["_hash"] == "bigint"
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(written["key-hashes"]))
    assert exchanges and all(re.sub(r"#\d+L?", "", e).startswith("_check, _group, _hash") for e in exchanges)
    assert not any("RecordHash" in line for line in plan_of(written["key-hashes"]).splitlines() if "HashAggregate" in line)


def test_reconciliation_reads_bronze_twice(spark):
    """Rows, valid rows and rejected rows in one scan; one more to deduplicate, and one of Silver."""
    plan = plan_of(QUERIES["b5_silver_reconciliation"][0](lake_of(spark, SMALL)))
    assert plan.count("FileScan") == 3

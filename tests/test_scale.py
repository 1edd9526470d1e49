"""Plans that hold at scale, and hot keys that must not gather in one task."""

import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from storeledger.operators import flatten, report
from storeledger.plans import pipeline
from storeledger.sources import driver_tables, pages, tables
from test_oracle import normal

SF = "/root/testdata/sf0.001"
EAGER = {"raw_roundtrip", "load_counts", "publish_counts", "published_product_leaks", "product_orders_estimate", "source_orders"}


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    raw = driver_tables.raw_tables(spark, SF)
    tables.replace_tables({name: tables.conform(rows, name) for name, rows in raw.items()}, root)
    return root


@pytest.fixture(scope="module")
def marts(spark, raw_root):
    return pipeline.build_marts(pipeline.stage(tables.read_raw(spark, raw_root)))


@pytest.mark.parametrize("name", sorted(set(entry_module._QUERIES) - EAGER))
def test_no_cross_join_and_no_python(spark, name):
    plan = executed(entry_module.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan


def scans(plan):
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_product_leaks_scans(marts):
    """Cancelled lines are filtered in the scan; only keys are shuffled by order."""
    plan = executed(marts["product_leaks"])
    sums, orders = scans(plan)
    for scan in (sums, orders):
        assert "EqualTo(cancelled,true)" in scan.split("PushedFilters")[1]
    assert "order_id" not in sums.split("ReadSchema")[1]
    assert "discount" not in orders.split("ReadSchema")[1]
    by_order = [line for line in plan.splitlines() if "HashAggregate(keys=[product" in line and "order_id" in line.split("functions")[0]]
    assert len(by_order) == 2 and all("functions=[]" in line for line in by_order)
    # sums by product; keys by product and order; counts by product
    assert plan.count("Exchange hashpartitioning") == 3


def test_money_summary_reads_each_table_once(marts):
    plan = executed(marts["money_summary"])
    assert len(scans(plan)) == 2 and "Join" not in plan
    orders = next(s for s in scans(plan) if "total_price" in s)
    assert "order_id" not in orders.split("ReadSchema")[1]


def test_stock_capital_has_no_shuffle(marts):
    plan = executed(marts["stock_capital"])
    assert "Exchange" not in plan
    assert "GreaterThan(inventory_quantity,0)" in plan


def test_margin_joins_sums(marts):
    """Only rows already summed per product reach the join."""
    plan = executed(marts["product_margin"])
    join = plan.index("Join")
    assert plan.index("HashAggregate") > join and len(scans(plan)) == 2


def test_top_k_is_no_full_sort(marts):
    for frame in (report.top_capital(marts["stock_capital"]), report.top_discounted(marts["product_leaks"])):
        assert "TakeOrderedAndProject" in executed(frame)


def test_archive_prunes_resources(spark, tmp_path):
    archive = pages.archive_pages(driver_tables.landed_pages(spark, SF), str(tmp_path))
    plan = executed(flatten.flatten_variants(archive))
    # The resource asked for, or one that nobody knows: that must fail the load, not be skipped.
    assert re.search(r"PartitionFilters: \[[^\]]*resource#\d+ = products\) OR NOT coalesce\(resource", plan)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """sf0.01 with a third of all lines on one order and a third on one part."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    source = "/root/testdata/sf0.01"
    con.execute(
        f"""COPY (SELECT * EXCLUDE (n)
                           REPLACE (CASE WHEN n % 3 = 0 THEN 7777 ELSE l_orderkey END AS l_orderkey,
                                    CASE WHEN n % 6 < 2 THEN 42 ELSE l_partkey END AS l_partkey)
                  FROM (SELECT *, row_number() OVER () AS n FROM '{source}/lineitem.parquet'))
            TO '{folder}/lineitem.parquet' (ROW_GROUP_SIZE 8192)"""
    )
    for name in ("orders", "part"):
        con.execute(f"COPY (FROM '{source}/{name}.parquet') TO '{folder}/{name}.parquet'")
    for name in ("lineitem", "orders", "part"):
        con.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return str(folder), con


@pytest.fixture
def shuffled_joins(spark):
    """Joins as on a cluster: no side is small enough to broadcast, skew is split early."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.maxPartitionBytes": "200k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", [
    "stg_orders", "product_leaks", "product_margin", "money_summary", "cost_discounts",
    "flatten_orders", "flatten_items", "item_discount", "page_chain_gaps", "load_counts", "publish_counts",
    "published_product_leaks",
])
def test_hot_keys_keep_results_whole(spark, skewed, shuffled_joins, name):
    folder, con = skewed
    got = normal(entry_module.queries()[name](spark, folder).toPandas())
    want = normal(con.execute(entry_module.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want, check_exact=True, check_dtype=False)


def test_hot_order_spreads_over_pages(spark, skewed, shuffled_joins):
    folder, _ = skewed
    landed = driver_tables.order_pages(spark, folder)
    longest = landed.agg(F.max(F.length("body"))).first()[0]
    assert longest < 200_000  # 20,000 lines on one order would need megabytes
    counts = {r["resource"]: r["count"] for r in landed.groupBy("resource").count().collect()}
    assert counts["orders"] == 300 and counts["order_lines"] > 300


def test_hot_order_join_of_pages_is_split(spark, skewed, shuffled_joins):
    folder, _ = skewed
    landed = driver_tables.order_pages(spark, folder)
    landed.collect()
    plan = executed(landed)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and "l_orderkey" in line]
    assert any("skew=true" in line for line in joins)
    assert len([line for line in scans(plan.split("Initial Plan")[0]) if "l_orderkey" in line]) == 1


def test_hot_order_join_is_split(spark, skewed, shuffled_joins):
    folder, _ = skewed
    joined = driver_tables.order_items(spark, folder)
    joined.write.format("noop").mode("overwrite").save()
    shuffled = joined.repartition("product")
    shuffled.collect()
    assert "isSkew=true" in executed(shuffled) or "skew=true" in executed(shuffled)


def test_repeated_orders_and_lines_of_none_as_in_the_flat_binding(spark, tmp_path):
    """An order that is there twice has its lines twice, on one page or several; lines of no order are left out."""
    for name in ("orders", "lineitem", "part"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name == "orders":
            rows = rows.filter("o_orderkey < 60 AND o_orderkey <> 7")
            rows = rows.unionByName(rows.filter("o_orderkey % 5 = 0"))
        if name == "lineitem":
            rows = rows.filter("l_orderkey < 70")
            rows = rows.unionByName(rows.limit(3).withColumn("l_orderkey", F.lit(None).cast("bigint")))
        rows.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    want = driver_tables.order_items(spark, str(tmp_path)).select("order_id", "original_total", "discount")
    for limit in (50, 3):
        pages = driver_tables.order_pages(spark, str(tmp_path), lines_per_order=limit)
        got = flatten.flatten_items(pages).select("order_id", "original_total", "discount")
        assert got.count() == want.count() > 100
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert pages.filter("resource = 'order_lines'").isEmpty() == (limit == 50)


def test_lines_are_not_joined_where_no_order_is_spread(spark):
    """Without orders of several pages, the lines' only shuffle is the one by page."""
    plan = driver_tables.order_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" in plan and not any("Join" in row and "l_orderkey" in row for row in plan.splitlines())

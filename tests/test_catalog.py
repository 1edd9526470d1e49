"""Marts as SQL over catalog tables and views, and sketches of distinct orders."""

import pytest
from pyspark.sql import functions as F

from golden import PAGES, pages_frame, rows_of
from storeledger.operators import marts, rollups
from storeledger.plans import pipeline
from storeledger.sources import catalog


@pytest.fixture(scope="module")
def raw(spark):
    return pipeline.flatten_pages(pages_frame(spark, PAGES))


@pytest.fixture(scope="module")
def database(spark, raw, tmp_path_factory):
    catalog.create_database(spark, "ledger_sql", str(tmp_path_factory.mktemp("catalog")))
    for _ in range(2):
        catalog.save_raw(raw, "ledger_sql")
        catalog.create_staging_views(spark, "ledger_sql")
    return "ledger_sql"


@pytest.mark.parametrize("name", sorted(catalog.MART_SQL))
def test_sql_gives_what_the_operators_give(spark, raw, database, name):
    want = pipeline.build_marts(pipeline.stage(raw))[name]
    got = catalog.mart(spark, database, name)
    assert got.dtypes == want.dtypes
    assert sorted(rows_of(got), key=str) == sorted(rows_of(want), key=str)


def test_kept_partition_only(spark, database):
    plan = catalog.mart(spark, database, "product_leaks")._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(cancelled" in plan and "NOT cancelled" in plan


def test_tables_and_views(spark, database):
    found = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()}
    assert found >= {"orders", "order_items", "variants", "stg_orders", "stg_order_items", "stg_variants"}
    assert spark.table(f"{database}.stg_order_items").count() == 6


def lines(spark, n):
    """Lines of n orders on 12 months: product A on each, B on every third, C on one, D on cancelled ones."""
    rows = spark.range(n).select(
        F.concat(F.lit("O"), "id").alias("order_id"), (F.col("id") % 50 == 7).alias("cancelled"), "id"
    )
    sold = rows.withColumn("product", F.explode(F.array_compact(F.array(
        F.lit("A"), F.lit("A"), F.when(F.col("id") % 3 == 0, "B"), F.when(F.col("id") == 0, "C"),
        F.when(F.col("cancelled"), "D"), F.when(F.col("id") % 10 == 0, ""),
    )))).withColumn("product", F.nullif("product", F.lit("")))
    orders = rows.select("order_id", F.make_timestamp_ntz(F.lit(2026), F.col("id") % 12 + 1, *[F.lit(1)] * 4).alias("created_at"))
    return sold, orders


def test_estimates_are_near(spark):
    items, orders = lines(spark, 60_000)
    sketches = rollups.order_sketches(items, orders)
    assert sketches.filter("product = 'A'").count() == 12
    exact = dict(rows_of(rollups.product_orders(items)))
    told = dict(rows_of(rollups.product_orders_estimate(sketches)))
    assert set(told) == set(exact) == {None, "A", "B", "C"}
    assert told["C"] == 1
    assert all(abs(told[p] - n) <= 0.07 * n for p, n in exact.items())


def test_months_merge(spark):
    items, orders = lines(spark, 6_000)
    sketches = rollups.order_sketches(items, orders)
    spring = sketches.filter("month(month) BETWEEN 3 AND 5")
    told = dict(rows_of(rollups.product_orders_estimate(spring)))
    kept = items.filter("NOT cancelled AND product = 'A' AND id % 12 BETWEEN 2 AND 4").select("order_id").distinct().count()
    assert abs(told["A"] - kept) <= 0.07 * kept


def test_estimates_stand_in_for_the_count(spark):
    """The opt-in: the mart takes either rollup."""
    items, orders = lines(spark, 600)
    amounts = items.selectExpr("*", "1L AS quantity", *[f"CAST(1 AS DECIMAL(18,4)) AS {c}" for c in ("original_total", "discounted_total", "discount")])
    sums, sketches = rollups.product_sums(amounts), rollups.order_sketches(items, orders)
    told = marts.product_leaks(sums, rollups.product_orders_estimate(sketches))
    assert told.dtypes == marts.product_leaks(sums, rollups.product_orders(items)).dtypes and told.count() == 4


def test_empty(spark):
    items, orders = lines(spark, 0)
    assert rollups.product_orders_estimate(rollups.order_sketches(items, orders)).count() == 0

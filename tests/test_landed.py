"""The data source of landed pages: whole pages, one partition a range, and resources left closed."""

import json

import pytest
from pyspark.sql import functions as F

from golden import PAGES, pages_frame, rows_of
from storeledger.sources import landed, pages
from storeledger.sources.landed import CursorRange, LandedReader, land_pages, read_landed


def many(n):
    rows = [("orders", None if i == 0 else str(i), json.dumps({"i": i, "text": "é\n" * 3})) for i in range(n)]
    return rows + [("products", None, "{}"), ("order_lines", "5/1", None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "pages")
    land_pages(pages_frame(spark, many(700)), path, ranges=5)
    return path


def test_pages_come_back_whole(spark, folder):
    assert sorted(rows_of(read_landed(spark, folder)), key=str) == sorted(many(700), key=str)
    assert read_landed(spark, folder).columns == ["resource", "request_cursor", "body"]


def test_a_partition_is_a_range_of_cursors(spark, folder):
    rows = read_landed(spark, folder).filter("resource = 'orders'").selectExpr("spark_partition_id() p", "int(request_cursor) c")
    spans = sorted(tuple(r) for r in rows.groupBy("p").agg({"c": "min"}).join(rows.groupBy("p").agg({"c": "max"}), "p").select("min(c)", "max(c)").collect())
    assert len(spans) >= 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_a_filter_on_the_resource_is_pushed(spark, folder):
    every, orders = read_landed(spark, folder), read_landed(spark, folder).filter("resource IN ('products', 'order_lines')")
    assert orders.count() == 2
    assert orders.rdd.getNumPartitions() == 2 < every.rdd.getNumPartitions()
    left = read_landed(spark, folder).filter("resource = 'orders' AND request_cursor = '7'")
    plan = left._jdf.queryExecution().executedPlan().toString()
    # What is left to Spark is the other test.
    kept = plan.split("Filter")[1].split("\n")[0]
    assert left.count() == 1 and "= orders" not in kept and "= 7" in kept


def test_files_of_other_resources_stay_closed(spark, tmp_path):
    path = str(tmp_path / "pages")
    land_pages(pages_frame(spark, many(3)), path, ranges=1)
    (tmp_path / "pages" / "resource=products" / "broken.json").write_text("no json")
    assert read_landed(spark, path).filter("resource = 'orders'").count() == 3
    with pytest.raises(Exception):
        read_landed(spark, path).collect()


def test_empty_folder(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert read_landed(spark, str(tmp_path / "none")).collect() == []
    reader = LandedReader(str(tmp_path / "none"))
    assert reader.partitions() == [CursorRange("", "")]


def test_batches_are_bounded(folder, monkeypatch):
    monkeypatch.setattr(landed, "BATCH_PAGES", 10)
    reader = LandedReader(folder)
    sizes = [batch.num_rows for part in reader.partitions() for batch in reader.read(part)]
    assert sum(sizes) == 702 and max(sizes) == 10


def test_the_pipeline_reads_it(spark, tmp_path):
    path = str(tmp_path / "pages")
    land_pages(pages_frame(spark, PAGES), path, ranges=2)
    rows = read_landed(spark, path)
    assert pages.page_errors(rows).count() == 0
    archive = pages.archive_pages(rows, str(tmp_path / "archive"))
    assert pages.load_gaps(archive).count() == 0


def test_ranges_grow_with_the_pages_and_bodies_are_made_once(spark, tmp_path, monkeypatch):
    """Ranges stay small; the bounds are found without the bodies; files are compressed."""
    monkeypatch.setattr(landed, "RANGE_PAGES", 50)
    made = spark.sparkContext.accumulator(0)

    def body(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = pages_frame(spark, many(700))
    bodies = rows.select("resource", "request_cursor").mapInArrow(body, "resource string, request_cursor string")
    pages_of = rows.select("resource", "request_cursor", F.concat("body", F.lit(" ")).alias("body"))
    path = tmp_path / "pages"
    land_pages(pages_of, str(path), ranges=2)
    files = list(path.glob("resource=orders/*.json.gz"))
    assert len(files) >= 12 and not list(path.glob("resource=*/*.json"))
    assert read_landed(spark, str(path)).count() == 702
    # Once for the cursors, once for the pages; a sampled shuffle of the pages would run them a third time.
    land_pages(bodies.withColumn("body", F.lit("{}")), str(tmp_path / "again"), ranges=2)
    assert made.value == 2 * 702

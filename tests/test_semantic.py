"""Metrics, checks, key and schema reports, and the scan for personal data."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from golden import PAGES, PRODUCTS, page, pages_frame, product, rows_of, variant
from storeledger.functions import pii
from storeledger.operators import quality, semantic
from storeledger.plans import pipeline
from storeledger.plans.contract import CONTRACT, load_contract


def marts_of(spark, rows):
    return pipeline.build_marts(pipeline.stage(pipeline.flatten_pages(pages_frame(spark, rows))))


@pytest.fixture(scope="module")
def marts(spark):
    return marts_of(spark, PAGES)


def metric(marts, name, *dims, **more):
    return rows_of(semantic.run_metric(CONTRACT, marts, name, dims, **more))


def test_totals(marts):
    assert metric(marts, "shop_leaks") == [(247.0,)]
    assert metric(marts, "margin_hit_by_discounts") == [(16.65,)]


def test_by_product(marts):
    assert metric(marts, "capital_in_stock", "product") == [("Mug", 120.0), ("Cap", 100.0), ("Tee", None)]
    assert metric(marts, "margin_by_product", "product") == [("Mug", 48.0), ("Cap", 14.0)]


def test_filters(marts):
    assert metric(marts, "discount_by_product", filters={"product": "Mug"}) == [(6.0,)]
    both = metric(marts, "discount_by_product", "product", filters={"product": ["Mug", "Tee"]})
    assert both == [("Tee", 15.0), ("Mug", 6.0)]


def test_first_rows_on_request(marts):
    assert metric(marts, "discount_by_product", "product", max_rows=2) == [("Tee", 15.0), ("Mug", 6.0)]


def test_no_cap(spark):
    rows = spark.range(1200).selectExpr("concat('p', id) as product", "cast(id as double) as discount_gbp")
    result = semantic.run_metric(CONTRACT, {"product_leaks": rows}, "discount_by_product", ["product"])
    assert result.count() == 1200


def test_blocked_type_without_detector_is_refused(marts):
    strict = copy.deepcopy(CONTRACT)
    strict["policy"]["block_pii"] = ["PERSON", "IBAN"]
    with pytest.raises(ValueError, match="IBAN"):
        semantic.run_metric(strict, marts, "discount_by_product", ["product"])


@pytest.mark.parametrize("call", [
    dict(name="capital_in_stock", dims=["variant"]),
    dict(name="discount_by_product", filters={"orders": 1}),
    dict(name="unknown"),
])
def test_refused(marts, call):
    with pytest.raises(ValueError):
        semantic.run_metric(CONTRACT, marts, **call)


def test_metric_with_personal_data_fails(spark):
    named = product("P8", "for jane@mail.example.com", [variant("V8", "Default", "1", "1.00", 1)])
    marts = marts_of(spark, PAGES[:2] + [page("products", None, PRODUCTS + [named])])
    with pytest.raises(Exception, match="blocked personal data"):
        metric(marts, "capital_in_stock", "product")
    assert metric(marts, "capital_in_stock") == [(221.0,)]


def test_checks(marts):
    got = {r["check"]: (r["severity"], r["failing_rows"], r["passed"]) for r in quality.run_checks(CONTRACT, marts).collect()}
    assert got == {
        "margins_exist": ("error", 0, True),
        "product_named": ("error", 0, True),
        "margin_pct_sane": ("warn", 0, True),
    }


def test_failing_checks(marts):
    margin = marts["product_margin"]
    bad = margin.limit(1).withColumn("product", F.lit(None).cast("string")).withColumn("margin_pct", F.lit(-100.1))
    edge = margin.limit(1).withColumn("margin_pct", F.lit(100.0))
    empty_pct = margin.limit(1).withColumn("margin_pct", F.lit(None).cast("double"))
    report = quality.run_checks(CONTRACT, {"product_margin": bad.union(edge).union(empty_pct)})
    assert {r["check"]: r["failing_rows"] for r in report.collect()} == {
        "margins_exist": 0, "product_named": 1, "margin_pct_sane": 1,
    }
    none = quality.run_checks(CONTRACT, {"product_margin": margin.limit(0)})
    assert {r["check"]: r["passed"] for r in none.collect()} == {
        "margins_exist": False, "product_named": True, "margin_pct_sane": True,
    }


def test_one_aggregate_per_entity(marts):
    plan = quality.run_checks(CONTRACT, marts)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_keys(spark, marts):
    assert quality.pk_violations(CONTRACT, marts).count() == 0
    second = product("P1", "Mug", [variant("V9", "Large", "30.00", "12.00", 3)])
    more = marts_of(spark, PAGES[:2] + [page("products", None, PRODUCTS + [second])])
    assert rows_of(quality.pk_violations(CONTRACT, more)) == [("stock_capital", "Mug", 2)]


def test_schema_report(marts):
    report = quality.entity_schema_report(CONTRACT, marts)
    assert report.count() == 22 and report.filter("not type_ok").count() == 0
    lost = {**marts, "product_leaks": marts["product_leaks"].drop("units")}
    bad = quality.entity_schema_report(CONTRACT, lost).filter("not type_ok")
    assert rows_of(bad.select("entity", "field", "actual_type", "null_values")) == [("product_leaks", "units", "missing", 4)]


def test_load_contract(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CONTRACT))
    assert load_contract(str(tmp_path / "c.json")) == CONTRACT
    yaml = pytest.importorskip("yaml")
    typed = copy.deepcopy(CONTRACT)
    for entity in typed["entities"].values():
        entity["fields"] = {name: {"type": kind} for name, kind in entity["fields"].items()}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(typed))
    assert load_contract(str(tmp_path / "c.yaml")) == CONTRACT


TEXTS = {
    "mail a.b+c@x-1.example.co.uk and d_e@y.org": (2, 0, 0),
    "no at sign, @home, a@b": (0, 0, 0),
    "call +1 (705) 555-5569 or 705-555-5569 705 555 5569": (0, 3, 0),
    "+447911123456 and (020) 555.1234": (0, 2, 0),
    "192.168.100.2001, 1705-555-55690, 2026-01-31": (0, 0, 0),
    "pay 4111111111111111 4111 1111 1111 1111 5500-0000-0000-0004": (0, 0, 3),
    "amex 3782 822463 10005, wrong 4111111111111112": (0, 0, 1),
    "x4111111111111111 _4111111111111111 41111111111111111111": (0, 0, 0),
    "long " + "a" * 100 + "@example.com " + "9" * 5000: (1, 0, 0),
    "": (0, 0, 0),
    None: (0, 0, 0),
}


def test_pii_patterns(spark):
    frame = spark.createDataFrame([(t, *hits) for t, hits in TEXTS.items()], "text string, e int, p int, c int")
    t = F.col("text")
    got = frame.select("text", "e", "p", "c", pii.email_hits(t), pii.phone_hits(t), pii.card_hits(t))
    for row in got.collect():
        assert tuple(row)[1:4] == tuple(row)[4:], row["text"]


def luhn(number):
    total = 0
    for i, digit in enumerate(reversed(number)):
        value = int(digit) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def test_luhn_against_brute_force(spark):
    numbers = [str(10**12 + 7919 * i) for i in range(500)] + [str(4 * 10**18 + 104729 * i) for i in range(500)]
    frame = spark.createDataFrame([(n,) for n in numbers], "text string")
    got = {r["text"]: r["hits"] for r in frame.select("text", pii.card_hits(F.col("text")).alias("hits")).collect()}
    assert got == {n: int(luhn(n)) for n in numbers}


def test_pii_scan_empty(spark):
    assert rows_of(quality.pii_scan(spark.createDataFrame([], "text string"), "text"), "pii_type") == [
        ("CREDIT_CARD", 0, 0), ("EMAIL_ADDRESS", 0, 0), ("PERSON", 0, 0), ("PHONE_NUMBER", 0, 0),
    ]

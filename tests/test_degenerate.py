"""Empty and one-sided inputs."""

import pytest

from golden import PRODUCTS, line, order, page, pages_frame, product, rows_of, variant
from storeledger.operators import report
from storeledger.plans import pipeline
from storeledger.plans.contract import CONTRACT


def marts_of(spark, orders, products=PRODUCTS):
    pages = pages_frame(spark, [page("orders", None, orders), page("products", None, products)])
    return pipeline.build_marts(pipeline.stage(pipeline.flatten_pages(pages)))


def tree(marts):
    return {r["category"]: (r["amount_gbp"], r["pct_of_revenue"]) for r in marts["money_summary"].collect()}


def test_no_orders(spark):
    marts = marts_of(spark, [])
    assert tree(marts) == {
        "capital in stock": (172.0, None),
        "cancelled orders": (0.0, None),
        "discounts": (0.0, None),
        "refunds": (0.0, None),
    }
    for name in ("cost_discounts", "cost_refunds", "product_leaks", "product_margin"):
        assert marts[name].count() == 0


def test_no_orders_written_and_read_back(spark, tmp_path):
    pages = pages_frame(spark, [page("orders", None, []), page("products", None, [])])
    with pytest.raises(pipeline.FailedChecks, match="margins_exist"):
        pipeline.run(spark, pages, str(tmp_path))
    reports = pipeline.run(spark, pages, str(tmp_path), contract={**CONTRACT, "checks": {}})
    assert reports["money_tree"].count() == 4
    assert reports["top_discounted"].count() == 0


def test_all_cancelled(spark):
    marts = marts_of(spark, [order("O1", "2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z", "30.00", "5.00", "30.00", [])])
    assert tree(marts)["cancelled orders"] == (30.0, None)
    assert tree(marts)["refunds"] == (0.0, None)


def test_zero_revenue(spark):
    marts = marts_of(spark, [order("O1", "2026-01-01T00:00:00Z", None, "0.00", "5.00", "0.00", [])])
    assert tree(marts)["discounts"] == (5.0, None)
    assert report.money_tree(marts["money_summary"]).first()["category"] == "capital in stock"


def test_no_costs(spark):
    orders = [order("O1", "2026-01-01T00:00:00Z", None, "10.00", "0.00", None, [line("Tee", 1, "10.00", "10.00", [])])]
    marts = marts_of(spark, orders, [product("P", "Tee", [variant("V", "Default", None, None, 7)])])
    assert tree(marts)["capital in stock"] == (0.0, 0.0)
    assert marts["product_margin"].count() == 0
    assert rows_of(marts["stock_capital"]) == [("Tee", "Default", 7, None, None)]


def test_free_line(spark):
    orders = [order("O1", "2026-01-01T00:00:00Z", None, "0.00", "0.00", None, [line("Mug", 1, "0.00", "0.00", [])])]
    marts = marts_of(spark, orders)
    assert rows_of(marts["product_leaks"]) == [("Mug", 1, 1, 0.0, 0.0, None)]
    margin = marts["product_margin"].first()
    assert margin["margin_pct"] is None and margin["margin_gbp"] == -12.0
    assert margin["discount_share_of_potential_margin_pct"] == 0.0


def test_order_without_lines(spark):
    pages = pages_frame(spark, [page("orders", None, [order("O1", "2026-01-01T00:00:00Z", None, "1", "0", None, [])])])
    flat = pipeline.flatten_pages(pages)
    assert flat["orders"].count() == 1 and flat["order_items"].count() == 0


def test_lenient_amounts(spark):
    head = order("O1", "2026-01-01T00:00:00Z", "", None, "", None, [])
    head["totalPriceSet"] = None
    del head["totalDiscountsSet"]
    head["totalRefundedSet"] = {"shopMoney": None}
    row = pipeline.flatten_pages(pages_frame(spark, [page("orders", None, [head])]))["orders"].first()
    assert (row["total_price"], row["total_discounts"], row["total_refunded"]) == (0, 0, 0)
    assert row["cancelled"] is True  # an empty text is not null


def test_variant_defaults(spark):
    variants = [
        variant("V1", "A", "", "", None),
        variant("V2", "B", None, "0.0", 0),
        {"id": "V3", "title": "C", "price": "1.5", "inventoryQuantity": 3, "inventoryItem": {"unitCost": None}},
    ]
    pages = pages_frame(spark, [page("products", None, [product("P", "Tee", variants)])])
    got = rows_of(
        pipeline.flatten_pages(pages)["variants"].selectExpr(
            "variant_id", "double(price)", "double(unit_cost)", "inventory_quantity"
        ),
        "variant_id",
    )
    assert got == [("V1", 0.0, None, 0), ("V2", 0.0, 0.0, 0), ("V3", 1.5, None, 3)]


def test_garbage_number_fails(spark):
    bad = order("O1", "2026-01-01T00:00:00Z", None, "ten", "0", None, [])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        pipeline.flatten_pages(pages_frame(spark, [page("orders", None, [bad])]))["orders"].collect()


def test_line_without_any_title(spark):
    """A line that names no product forms a row of its own and meets no cost."""
    nameless = line(None, 2, "10.00", "8.00", [], product=None)
    orders = [order("O1", "2026-01-01T00:00:00Z", None, "8.00", "0.00", None, [nameless, line("Mug", 1, "5.00", "5.00", [])])]
    marts = marts_of(spark, orders)
    assert rows_of(marts["product_leaks"], "product") == [
        (None, 1, 2, 8.0, 2.0, 20.0), ("Mug", 1, 1, 5.0, 0.0, 0.0),
    ]
    assert [r["product"] for r in marts["product_margin"].collect()] == ["Mug"]

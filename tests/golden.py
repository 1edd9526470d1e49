"""The hand-computed fixture: two order pages, one product page, and small builders."""

import json


def money(amount):
    return {"shopMoney": {"amount": amount}}


def line(title, quantity, original, discounted, allocations, product=True):
    return {
        "title": title,
        "quantity": quantity,
        "product": {"title": title} if product is True else product,
        "originalTotalSet": money(original),
        "discountedTotalSet": money(discounted),
        "discountAllocations": allocations
        if allocations is None
        else [{"allocatedAmountSet": money(a)} for a in allocations],
    }


def order(order_id, created, cancelled, total, discounts, refunded, lines):
    return {
        "id": order_id,
        "name": f"#{order_id}",
        "createdAt": created,
        "cancelledAt": cancelled,
        "displayFinancialStatus": "PAID",
        "totalPriceSet": money(total),
        "totalDiscountsSet": money(discounts),
        "totalRefundedSet": money(refunded) if refunded is not None else None,
        "totalShippingPriceSet": money("3.95"),
        "lineItems": {"nodes": lines},
    }


def variant(variant_id, title, price, cost, quantity):
    item = None if cost is None else {"unitCost": {"amount": cost}}
    return {
        "id": variant_id,
        "title": title,
        "price": price,
        "inventoryQuantity": quantity,
        "inventoryItem": item,
    }


def product(product_id, title, variants):
    return {"id": product_id, "title": title, "status": "ACTIVE", "variants": {"nodes": variants}}


def page(resource, request_cursor, nodes, end_cursor=None):
    listing = {
        "pageInfo": {"hasNextPage": end_cursor is not None, "endCursor": end_cursor},
        "nodes": nodes,
    }
    body = {"data": {"products" if resource == "products" else "orders": listing}}
    return (resource, request_cursor, json.dumps(body))


ORDERS = [
    order("O1", "2026-01-31T23:30:00Z", None, "90.00", "10.00", None, [
        line("Mug", 2, "60.00", "60.00", ["4.00", "2.00"]),
        line("Cap", 1, "40.00", "36.00", ["4.00"]),
    ]),
    order("O2", "2026-02-01T00:30:00+01:00", None, "50.00", "0.00", "20.00", [
        line("Mug", 1, "30.00", "30.00", []),
        line("Gift wrap", 1, "20.00", "20.00", None, product=None),
    ]),
    order("O3", "2026-02-10T12:00:00Z", "2026-02-11T08:00:00Z", "30.00", "5.00", "30.00", [
        line("Cap", 1, "35.00", "30.00", ["5.00"]),
    ]),
    order("O4", "2026-02-15T09:00:00Z", None, "60.00", "15.00", "", [
        line("Tee", 3, "75.00", "65.00", ["15.00"], product={"title": ""}),
    ]),
]
PRODUCTS = [
    product("P1", "Mug", [variant("V1", "Default", "30.00", "12.00", 10)]),
    product("P2", "Cap", [
        variant("V2", "S", "40.00", "20.00", 5),
        variant("V3", "L", "40.00", "24.00", -2),
    ]),
    product("P3", "Tee", [variant("V4", "Default", "25.00", None, 7)]),
    product("P4", "Sock", []),
]
PAGES = [
    page("orders", None, ORDERS[:2], "c1"),
    page("orders", "c1", ORDERS[2:]),
    page("products", None, PRODUCTS),
]


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "resource string, request_cursor string, body string")


def rows_of(frame, *order_by):
    return [tuple(r) for r in (frame.orderBy(*order_by) if order_by else frame).collect()]

"""Bad pages, broken chains and full lists."""

import json

import pytest

from golden import ORDERS, PAGES, PRODUCTS, line, money, order, page, pages_frame, product, rows_of, variant
from storeledger import schemas
from storeledger.operators import flatten
from storeledger.plans import pipeline
from storeledger.sources import pages, tables

BROKEN = line("Mug", 1, "1.00", "1.00", ["0.10"])
BROKEN["discountAllocations"].append({"allocatedAmountSet": None})
BAD = [
    ("orders", "a", '{"errors": [{"message": "Throttled"}], "data": null}'),
    ("orders", "b", "<html>"),
    ("orders", "c", None),
    ("orders", "d", '{"data": {}}'),
    ("products", "e", json.dumps({"data": {"products": {"nodes": []}}})),
    ("customers", "f", "{}"),
    page("orders", "g", [order("O9", "2026-01-01T00:00:00Z", None, "1", "0", None, [BROKEN])]),
    ("orders", "h", PAGES[0][2][:-20]),
    page("orders", "i", [ORDERS[0], None]),
    page("orders", "j", [{**ORDERS[0], "lineItems": None}]),
    page("products", "k", [{**PRODUCTS[0], "variants": {"nodes": [None]}}]),
    (None, "l", PAGES[0][2]),
    page("orders", "m", [{**ORDERS[0], "id": None}]),
    page("orders", "n", [{**ORDERS[0], "createdAt": None}]),
    page("orders", "o", [{**ORDERS[0], "lineItems": {"nodes": [{**BROKEN, "quantity": None, "discountAllocations": []}]}}]),
    page("products", "p", [{**PRODUCTS[0], "variants": {"nodes": [{**PRODUCTS[0]["variants"]["nodes"][0], "id": None}]}}]),
    ("orders", "q", PAGES[0][2] + ' {"errors": [{"message": "Throttled"}]}'),
    page("orders", "r", [{**ORDERS[0], "totalPriceSet": money("1.23456")}]),
]


def test_whole_pages_have_no_problem(spark):
    whole = pages_frame(spark, PAGES)
    assert pages.page_errors(whole).count() == 0
    assert pages.page_chain_gaps(whole).count() == 0
    assert pages.good_pages(whole).exceptAll(whole).count() == 0


def test_empty_errors_are_no_errors(spark):
    resource, cursor, body = PAGES[2]
    for empty in ([], None, "", {}):
        fine = json.dumps({**json.loads(body), "errors": empty})
        assert pages.page_errors(pages_frame(spark, [(resource, cursor, fine)])).count() == 0


def test_problems(spark):
    got = dict(
        (r["request_cursor"], r["problem"])
        for r in pages.page_errors(pages_frame(spark, PAGES + BAD)).collect()
    )
    assert got == {
        "a": "errors",
        "b": "unreadable",
        "c": "unreadable",
        "d": "no nodes",
        "e": "no page info",
        "f": "unknown resource",
        "g": "broken allocation",
        "h": "unreadable",
        "i": "incomplete node",
        "j": "incomplete node",
        "k": "incomplete node",
        "l": "unknown resource",
        "m": "missing field",
        "n": "missing field",
        "o": "missing field",
        "p": "missing field",
        "q": "unreadable",
        "r": "amount beyond the scale",
    }


def test_good_pages_load(spark):
    good = pages.good_pages(pages_frame(spark, PAGES + BAD))
    assert good.count() == 3
    assert flatten.flatten_items(good).count() == 6


def test_bad_pages_set_aside(spark, tmp_path):
    good = pipeline.set_bad_pages_aside(spark, pages_frame(spark, PAGES + BAD), str(tmp_path))
    assert good.read(schemas.PAGE_PROBLEMS).count() == 3
    kept = pages.read_archive(spark, str(tmp_path / "pages")).read(schemas.ARCHIVED_PAGE)
    assert kept.filter("problem is not null").count() == len(BAD)
    # What could not be loaded is kept as it landed, what could is not kept twice.
    assert {r["body"] for r in kept.collect()} == {None, *[body for _, _, body in BAD]}
    assert pipeline.load(good, str(tmp_path))["order_items"] == 6


@pytest.mark.parametrize("bad,message", [
    (BAD[0], "Throttled"),
    (BAD[1], "unreadable orders page"),
    (BAD[3], "without nodes"),
    (BAD[6], "allocation without an amount"),
    (BAD[8], "incomplete node"),
    (BAD[9], "incomplete node"),
    (BAD[5], "unknown resource"),
    (BAD[11], "unknown resource"),
    (BAD[12], "required field"),
    (BAD[14], "required field"),
    (BAD[16], "unreadable"),
])
def test_strict_load_fails(spark, bad, message):
    with pytest.raises(Exception, match=message):
        flatten.flatten_items(pages_frame(spark, PAGES + [bad])).collect()


def test_strict_load_of_heads_and_variants_fails(spark):
    with pytest.raises(Exception, match="incomplete node"):
        flatten.flatten_orders(pages_frame(spark, [BAD[8]])).collect()
    with pytest.raises(Exception, match="incomplete node"):
        flatten.flatten_variants(pages_frame(spark, [BAD[10]])).collect()
    with pytest.raises(Exception, match="required field"):
        flatten.flatten_orders(pages_frame(spark, [BAD[13]])).collect()
    with pytest.raises(Exception, match="required field"):
        flatten.flatten_variants(pages_frame(spark, [BAD[15]])).collect()
    with pytest.raises(Exception, match="beyond the scale"):
        flatten.flatten_orders(pages_frame(spark, [BAD[17]])).collect()


def test_bad_landing_line_fails(spark, tmp_path):
    (tmp_path / "pages.json").write_text('{"resource": "orders", "body": "{}"}\nnot json\n')
    with pytest.raises(Exception):
        pages.read_pages(spark, str(tmp_path)).collect()


def chain(*links):
    return [page("orders", asked, [], end) for asked, end in links]


@pytest.mark.parametrize("links,problems", [
    ([(None, "1"), ("1", "2"), ("2", None)], []),
    ([(None, "1"), ("2", None)], [("missing page", "1"), ("orphan page", "2")]),
    ([(None, "1"), ("1", "2")], [("missing page", "2"), ("no last page", None)]),
    ([("1", "2"), ("2", None)], [("no first page", None), ("orphan page", "1")]),
    ([(None, "1"), ("1", None), ("1", None)], [("repeated page", "1"), ("several last pages", None)]),
    ([(None, "1"), (None, "1"), ("1", None)], [("repeated page", None), ("cursor handed out twice", "1")]),
    # A page under a cursor that nobody handed out, which hands out another's end.
    ([(None, "a"), ("a", "b"), ("x", "b"), ("b", None)], [("orphan page", "x"), ("cursor handed out twice", "b")]),
    # Rings that nothing leads into, of one page to many, in one resource or two.
    ([(None, "a"), ("a", None), ("c", "d"), ("d", "c")], [("detached ring", "c")]),
    ([(None, "a"), ("a", None), ("z", "z")], [("detached ring", "z")]),
    ([(None, "a"), ("a", None), ("z", "y"), ("y", "x"), ("x", "z"), ("q", "p"), ("p", "q")], [("detached ring", "x"), ("detached ring", "p")]),
    ([(None, "a"), ("a", None)] + [(f"r{i}", f"r{(i + 1) % 37}") for i in range(37)], [("detached ring", "r0")]),
    # A tail that leads into a ring is no part of it.
    ([(None, "a"), ("a", None), ("0", "c"), ("c", "d"), ("d", "c")], [("orphan page", "0"), ("cursor handed out twice", "c"), ("detached ring", "c")]),
    # A chain whose cursors lead downwards, and one that is long.
    ([(None, "9"), ("9", "8"), ("8", "7"), ("7", None)], []),
    ([(None, "50")] + [(str(i), str(i - 1)) for i in range(50, 1, -1)] + [("1", None)], []),
])
def test_chain(spark, links, problems):
    got = pages.page_chain_gaps(pages_frame(spark, chain(*links))).select("problem", "cursor")
    assert sorted(rows_of(got), key=str) == sorted(problems, key=str)


@pytest.mark.parametrize("more", [
    [("c", "d"), ("d", "c")], [("x", "c1")], [("c1", None)],
])
def test_run_refuses_pages_outside_the_chain(spark, tmp_path, more):
    landed = pages_frame(spark, PAGES + chain(*more))
    with pytest.raises(pipeline.IncompleteLoad):
        pipeline.run(spark, landed, str(tmp_path))
    assert tables.current(spark, str(tmp_path)) is None


def test_rings_of_one_resource_leave_the_other(spark):
    ring = [page("products", "c", [], "d"), page("products", "d", [], "c")]
    got = rows_of(pages.page_chain_gaps(pages_frame(spark, PAGES + ring)))
    assert got == [("products", "detached ring", "c")]


def part(cursor, *orders):
    """A page of orders given as (id, whether more lines follow)."""
    nodes = [{"id": i, "lineItems": {"pageInfo": {"hasNextPage": more}, "nodes": []}} for i, more in orders]
    return page("orders" if cursor is None else "order_lines", cursor, nodes)


@pytest.mark.parametrize("parts,problems", [
    ([part(None, ("A", False), ("B", True)), part("0/1", ("B", False))], []),
    ([part(None, ("A", True)), part("0/1", ("A", True)), part("0/2", ("A", False))], []),
    ([part(None, ("A", True), ("B", False))], [("A", "missing lines", 1)]),
    ([part(None, ("A", True)), part("0/2", ("A", False))], [("A", "missing lines", 1), ("A", "orphan lines", 2)]),
    ([part(None, ("A", True)), part("0/1", ("A", False)), part("0/1", ("A", False))], [("A", "repeated lines", 1)]),
    ([part(None, ("A", False)), part("0/1", ("C", False))], [("C", "orphan lines", 1)]),
])
def test_line_chain(spark, parts, problems):
    got = pages.line_chain_gaps(pages_frame(spark, parts))
    assert sorted(rows_of(got)) == sorted(problems)


def test_lost_lines_fail_the_run(spark, tmp_path):
    head = {**ORDERS[0], "lineItems": {"pageInfo": {"hasNextPage": True}, **ORDERS[0]["lineItems"]}}
    landed = pages_frame(spark, [page("orders", None, [head] + ORDERS[1:]), PAGES[2]])
    with pytest.raises(pipeline.IncompleteLoad):
        pipeline.run(spark, landed, str(tmp_path))


def test_truncation(spark):
    full = order("O50", "2026-01-01T00:00:00Z", None, "1", "0", None, [line("Mug", 1, "1", "1", None)] * 50)
    more = order("O51", "2026-01-01T00:00:00Z", None, "1", "0", None, [line("Mug", 1, "1", "1", None)] * 51)
    going_on = {**full, "id": "O52", "lineItems": {"pageInfo": {"hasNextPage": True}, **full["lineItems"]}}
    wide = product("P9", "Mug", [variant(f"V{i}", "x", "1", None, 1) for i in range(50)])
    landed = pages_frame(spark, [page("orders", None, [full, more, going_on] + ORDERS), page("products", None, [wide] + PRODUCTS)])
    assert rows_of(pages.truncation_suspects(landed), "parent_id") == [("orders", "O50", 50), ("products", "P9", 50)]
    assert flatten.flatten_items(landed).count() == 151 + 6


def test_continued_order(spark):
    """Lines on a continuation page belong to the order and add no order."""
    head, rest = dict(ORDERS[0]), {"id": "O1", "cancelledAt": None, "lineItems": {"nodes": ORDERS[0]["lineItems"]["nodes"][1:]}}
    head["lineItems"] = {"nodes": ORDERS[0]["lineItems"]["nodes"][:1]}
    split = pages_frame(spark, [page("orders", None, [head] + ORDERS[1:]), page("order_lines", "O1/1", [rest]), PAGES[2]])
    whole = pages_frame(spark, PAGES)
    for name, rows in pipeline.flatten_pages(split).items():
        assert sorted(rows_of(rows), key=str) == sorted(rows_of(pipeline.flatten_pages(whole)[name]), key=str)


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_parse_once(spark):
    """No consumer of landed pages makes the optimizer repeat the JSON parse of a page."""
    landed = pages_frame(spark, PAGES)
    flat = pipeline.flatten_pages(landed)
    built = pipeline.build_marts(pipeline.stage(flat))
    frames = [
        pages.page_errors(landed),
        pages.page_errors(landed).filter("problem = 'errors'").groupBy("resource").count(),
        pages.good_pages(landed),
        pages.good_pages(landed).filter("resource = 'orders'").groupBy().count(),
        pages.parse_pages(landed),
        pages.line_chain_gaps(landed),
        pages.truncation_suspects(landed),
        *flat.values(),
        *[rows.groupBy().count() for rows in flat.values()],
        flat["variants"].select("inventory_quantity").filter("inventory_quantity > 3"),
        flat["orders"].select("order_id"),
        flat["order_items"].filter("not cancelled").select("product"),
    ]
    for frame in frames:
        assert optimized(frame).count("from_json") == 1, optimized(frame)
    for name, (_, sources) in pipeline.MARTS.items():
        assert optimized(built[name]).count("from_json") == len(sources), optimized(built[name])


def leaves(frame):
    """What the scan of an archive reads."""
    plan = frame._jdf.queryExecution().sparkPlan()
    assert "from_json" not in plan.toString()
    return plan.collectLeaves().head().requiredSchema().json()


def test_archive_readers_read_their_leaves(spark, tmp_path):
    archive = pages.archive_pages(pages_frame(spark, PAGES), str(tmp_path / "pages"))
    flat = pipeline.flatten_pages(archive)
    heads, lines, variants = (leaves(flat[name]) for name in ("orders", "order_items", "variants"))
    assert "totalPriceSet" in heads and "lineItems" not in heads and "products" not in heads
    assert "originalTotalSet" in lines and "totalPriceSet" not in lines and "pageInfo" not in lines
    assert "inventoryQuantity" in variants and "orders" not in variants
    for frame, wanted, unwanted in [
        (pages.line_chain_gaps(archive), "pageInfo", "originalTotalSet"),
        (pages.truncation_suspects(archive), "quantity", "originalTotalSet"),
        (pages.page_errors(archive), "problem", "nodes"),
    ]:
        assert wanted in leaves(frame) and unwanted not in leaves(frame) and "body" not in leaves(frame)
    ends = archive.read(schemas.PAGE_ENDS)
    assert "endCursor" in leaves(ends) and "nodes" not in leaves(ends)


def test_archive_gives_what_the_pages_give(spark, tmp_path):
    landed = pages_frame(spark, PAGES)
    archive = pages.archive_pages(landed, str(tmp_path / "pages"))
    for name, rows in pipeline.flatten_pages(archive).items():
        assert sorted(rows_of(rows), key=str) == sorted(rows_of(pipeline.flatten_pages(landed)[name]), key=str)
    assert pages.load_gaps(archive).count() == 0


@pytest.mark.parametrize("bad,reader,message", [
    (BAD[0], flatten.flatten_orders, "Throttled"),
    (BAD[1], flatten.flatten_items, "unreadable orders page"),
    (BAD[6], flatten.flatten_items, "allocation without an amount"),
    (BAD[10], flatten.flatten_variants, "incomplete node"),
    (BAD[11], flatten.flatten_variants, "unknown resource"),
    (BAD[13], flatten.flatten_orders, "required field"),
    (BAD[17], flatten.flatten_orders, "beyond the scale"),
])
def test_strict_load_of_an_archive_fails(spark, tmp_path, bad, reader, message):
    archive = pages.archive_pages(pages_frame(spark, PAGES + [bad]), str(tmp_path / "pages"))
    with pytest.raises(Exception, match=message):
        reader(archive).groupBy().count().collect()


def test_check_fails_whatever_is_read(spark):
    """A bad page fails every reader of its resource, and no reader of another one."""
    flat = pipeline.flatten_pages(pages_frame(spark, PAGES + [BAD[1]]))
    for name in ("orders", "order_items"):
        with pytest.raises(Exception, match="unreadable orders page"):
            flat[name].groupBy().count().collect()
    assert flat["variants"].groupBy().count().first()[0] == 4
    assert flat["variants"].selectExpr("sum(inventory_quantity)").first()[0] == 20

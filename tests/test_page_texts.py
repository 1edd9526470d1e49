"""Texts of landed pages: put together by plain expressions, equal to those of a JSON writer."""

import json

from pyspark.sql import functions as F

from storeledger import schemas
from storeledger.functions.money import beyond_scale
from storeledger.session import SETTINGS
from storeledger.sources import driver_tables as D
from storeledger.sources import pages

TITLES = ["plain", 'a "quoted" \\ back/slash', "tab\tline\nend\x01", "é😀 ", "", None]


def test_quoted_like_a_json_writer(spark):
    rows = spark.createDataFrame([(t,) for t in TITLES], "t string")
    for t, got in rows.select("t", D._quoted(F.col("t")).alias("q")).collect():
        assert (got if got is None else json.loads(got)) == t


def test_lines_and_orders_like_a_json_writer(spark):
    lines = [
        (number, quantity, title, original, discount)
        for number in (1, 2, 7, -1)
        for quantity in (3.0, None)
        for title in TITLES
        for original, discount in ((12345, 301), (5, 0), (-12345, -7), (None, 3), (700, None))
    ]
    rows = spark.createDataFrame(lines, "l_linenumber int, l_quantity double, p_name string, original long, discount long")
    rows = rows.withColumn("title", D._quoted(F.col("p_name")))
    cents = lambda n: None if n is None else f"{'-' if n < 0 else ''}{abs(n) // 100}.{abs(n) % 100:02}"
    without = lambda d: {k: v for k, v in d.items() if v is not None}
    money = lambda n: {"shopMoney": without({"amount": cents(n)})}
    for number, quantity, title, original, discount, text in rows.select(
        "l_linenumber", "l_quantity", "p_name", "original", "discount", D._line_node()
    ).collect():
        odd, gap = number % 2 == 1 and number > 0, None
        if original is not None and (odd or discount is not None):
            gap = original if odd else original - discount
        half = None if discount is None else int((discount + 1) / 2)
        rest = None if discount is None else discount - half
        want = without({
            "title": title,
            "quantity": None if quantity is None else int(quantity),
            "product": None if number == 7 else without({"title": title}),
            "originalTotalSet": money(original),
            "discountedTotalSet": money(gap),
            "discountAllocations": [{"allocatedAmountSet": money(x)} for x in (half, rest)] if odd else None,
        })
        assert text == json.dumps(want, ensure_ascii=False, separators=(",", ":")) or json.loads(text) == want
        assert list(json.loads(text)) == list(want)


def test_no_json_writer_runs_for_a_line(spark, capsys):
    """A writer that walks structs took most of the time of building pages; titles and statuses are quoted before the join."""
    D.order_pages(spark, "/root/testdata/sf0.001").explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    line = [row for row in plan.splitlines() if "allocatedAmountSet" in row]
    assert line and all("to_json" not in row and "structstojson" not in row.lower() for row in line)


def test_generated_methods_are_small_enough_to_compile():
    assert int(SETTINGS["spark.sql.codegen.hugeMethodLimit"]) <= 8000


def test_archives_write_no_dictionaries_of_amounts(spark, tmp_path):
    import pyarrow.parquet as pq

    archive = pages.archive_pages(D.order_pages(spark, "/root/testdata/sf0.001"), str(tmp_path / "pages"))
    for file in (tmp_path / "pages").glob("*/*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        assert not any("DICTIONARY" in str(group.column(i).encodings) for i in range(group.num_columns))
    assert archive.read("problem string").filter("problem is not null").count() == 0


def test_only_long_amounts_are_searched(spark):
    texts = ["1", "1.5", "1.2345", "1.23450", "1.23456", "1.0000000001", "1e3", "1.E5", "-2.00001", "12345678", "1.2.34567", ".00010", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.col("t").rlike(r"\.[0-9]{4}[0-9]*[1-9]|[0-9.][eE][-+]?[0-9]")
    assert all(a == b for a, b in rows.select(beyond_scale(F.col("t")), plain).collect())


def test_pages_are_grouped_as_they_come(spark, capsys):
    """Both groupings of the page builder take rows in the order of their one sort; a table of pages that gives way to a sort would copy every text."""
    D.order_pages(spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert plan.count("SortAggregate(key=[page") == 2 and "ObjectHashAggregate(keys=[page" not in plan
    assert plan.count("Sort [page") == 1


def _page(node, errors=None, products=None, end=True):
    info = {"hasNextPage": False, "endCursor": "0"}
    data = {"orders": {"pageInfo": info if end else None, "nodes": node}, "products": products}
    return json.dumps({"errors": errors, "data": data})


def test_no_page_with_a_problem_passes_the_quick_test(spark):
    money = lambda a: {"shopMoney": {"amount": a}}
    share = lambda *a: {"discountAllocations": [x if x is None else {"allocatedAmountSet": money(x)} for x in a]}
    line = {"title": "t", "quantity": 1, "originalTotalSet": money("1.2500"), "discountedTotalSet": money("1.00")}
    order = {"id": "1", "name": "#1", "createdAt": "x", "totalPriceSet": money("2.50")}
    nodes = lambda *lines, **more: [{**order, "lineItems": {"nodes": list(lines)}, **more}]
    good = [
        _page([]), _page(nodes()), _page(nodes(line)), _page(nodes(line, {**line, **share("1", "2.5")})),
        _page(nodes({**line, **share()}, line) * 3), _page(nodes({"quantity": 0})),
    ]
    doubtful = [
        _page(nodes(line), errors=[]), _page(nodes({**line, "originalTotalSet": money("1.23450")})), _page(nodes(line), products={"nodes": []}),
    ]
    bad = [
        _page(None), _page([None]), _page([order]), _page(nodes(None)), _page(nodes(line, {"title": "t"})), _page(nodes(line, id=None)),
        _page(nodes(line) + [{**order, "lineItems": {"nodes": None}}]), _page(nodes(line, createdAt=None)),
        _page(nodes({**line, **share(None)})), _page(nodes(line, {**line, "discountAllocations": [{"allocatedAmountSet": money(None)}]})),
        _page(nodes({**line, **share("1", "1.23456")})), _page(nodes(line, {**line, "discountedTotalSet": money("1.00001")})),
        _page(nodes(line, totalPriceSet=money("1e3"))), _page(nodes(line), end=False), _page(nodes(line), errors="x"), "", "{}", "[", _page([]) + "1",
    ]
    rows = [(r, i, b) for r in ("orders", "order_lines", "products", "x", None) for i, b in enumerate(good + doubtful + bad)]
    read = pages.parse(F.col("body"), schemas.RESPONSE)
    found = spark.createDataFrame(rows, "resource string, i int, body string").withColumn("read", read)
    sound, problem = pages._sound(F.col("resource"), F.col("read")), pages._problem(F.col("resource"), F.col("read"))
    for resource, i, passes, why in found.select("resource", "i", sound, problem).collect():
        assert not (passes and why), (resource, i, why)
        if resource in ("orders", "order_lines"):
            assert bool(passes) == (i < len(good)) or (resource, why, i) == ("order_lines", None, i), (resource, i, passes, why)
            assert why is None or i >= len(good) + len(doubtful)


def test_the_text_of_a_sound_page_goes_no_further(spark):
    """Texts, and pages as they were parsed, were copied with each page's row."""
    landed = spark.createDataFrame([("orders", None, _page([])), ("orders", "0", "[")], schemas.LANDED_PAGE)
    plan = pages.parse_pages(landed)._jdf.queryExecution().sparkPlan()
    while plan.nodeName() != "Generate":
        plan = plan.children().head()
    assert "body" not in plan.requiredChildOutput().mkString(",") and "transform(array(" not in plan.generator().sql()
    found = pages.parse_pages(landed).select("request_cursor", "problem", "body").collect()
    assert sorted(map(tuple, found), key=str) == [("0", "unreadable", "["), (None, None, None)]


def test_archives_keep_no_statistics(spark, tmp_path):
    import pyarrow.parquet as pq

    pages.archive_pages(D.order_pages(spark, "/root/testdata/sf0.001"), str(tmp_path / "pages"))
    groups = [pq.ParquetFile(file).metadata.row_group(0) for file in (tmp_path / "pages").glob("*/*.parquet")]
    assert groups and not any(g.column(i).is_stats_set for g in groups for i in range(g.num_columns))


def test_texts_of_orders_are_made_before_they_are_collected(spark, capsys):
    """A collected expression is interpreted."""
    D.order_pages(spark, "/root/testdata/sf0.001").explain()
    assert "collect_list(concat" not in capsys.readouterr().out

"""Landed JSON pages: reading, parsing once, archiving, and the checks that a fetch is whole.

A landing file holds one JSON object per line: ``resource``, ``request_cursor``
(null for the first page) and ``body``, the response, as text or as an object.
``orders`` and ``products`` pages form cursor chains. An order with more lines than
one page may nest continues on ``order_lines`` pages, which have the shape of an orders
page and add lines but no order. Part n of an order's lines, from 1, is on a page
whose request cursor ends in ``/n``; a part's ``lineItems.pageInfo`` says whether
another follows.

``archive_pages`` parses every page once and keeps it as nested columns, with its
problem if it has one. Readers take an ``Archive``, of which they read only the leaf
columns they name; or landed pages, which are then parsed in the reader's own plan.
"""

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storeledger import schemas
from storeledger.functions.money import allocation_amounts, beyond_scale
from storeledger.session import scratch_dir

RESOURCES = ("orders", "order_lines", "products")

# Times as far that pointers along a chain reach after each round.
JUMPS = 4

# JSON texts that count as "no errors".
_NO_ERRORS = ("", "[]", "{}", "null", "false", "0")
# The one problem that leaves a page's nodes whole.
_NO_PAGE_INFO = "no page info"


def read_pages(spark: SparkSession, path: str, one_page_per_file: bool = False) -> DataFrame:
    """Landed JSON pages below ``path``; a line that is no JSON object fails the read."""
    return (
        spark.read.schema(schemas.LANDED_PAGE)
        .option("mode", "FAILFAST")
        .option("multiLine", one_page_per_file)
        .json(path)
    )


@dataclass(frozen=True)
class Archive:
    """Archived pages: parquet by resource, read with the columns a reader names."""

    spark: SparkSession
    path: str
    good_only: bool = False

    def read(self, schema: str) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(self.path)
        return rows.filter("problem is null") if self.good_only else rows

    def good(self) -> "Archive":
        """The same pages without those that have a problem."""
        return replace(self, good_only=True)


Pages = DataFrame | Archive


def archive_pages(pages: DataFrame, path: str) -> Archive:
    """Parse landed pages and keep them as nested parquet by resource: splittable, compressed,
    and a reader of one resource skips the files of the others. Most texts are amounts and ids that
    hardly repeat, so dictionaries of them would cost more time than they save room. Nothing looks for a value
    in them either, so no statistics are kept."""
    (
        parse_pages(pages)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.column.statistics.enabled", "false")
        .option("parquet.size.statistics.enabled", "false")
        .partitionBy("resource")
        .parquet(path)
    )
    return read_archive(pages.sparkSession, path)


def read_archive(spark: SparkSession, path: str) -> Archive:
    return Archive(spark, path)


def parse(body: Column, schema: str) -> Column:
    """The page as the one element of a list, in one pass over the text.

    Text after the page's JSON shows as a second element or makes the list unreadable, which is then null.
    """
    return F.from_json(F.concat(F.lit("["), body, F.lit("]")), f"array<struct<{schema}>>")


def unreadable(read: Column) -> Column:
    """No list, or not of one JSON object of the schema."""
    return (F.coalesce(F.size(read), F.lit(-1)) != 1) | F.get(read, F.lit(0)).isNull()


def unknown(resource: Column) -> Column:
    return ~F.coalesce(resource.isin(*RESOURCES), F.lit(False))


def has_errors(page: Column) -> Column:
    return page["errors"].isNotNull() & ~F.trim(page["errors"]).isin(*_NO_ERRORS)


def _incomplete(nodes: Column, children: str | None) -> Column:
    """A list with a null node, a node without its list of children, or a null child."""

    def broken(node: Column) -> Column:
        if children is None:
            return node.isNull()
        listed = node[children]["nodes"]
        return node.isNull() | listed.isNull() | F.exists(listed, lambda child: child.isNull())

    return F.exists(nodes, broken)


def _lacking(nodes: Column, fields: tuple[str, ...], children: str | None, child_fields: tuple[str, ...]) -> Column:
    """A list with a node, or a child of one, without a field that every one must have."""

    def lacks(node: Column) -> Column:
        missing = F.lit(False)
        for field in fields:
            missing = missing | node[field].isNull()
        if children and child_fields:
            child = lambda c: reduce(Column.__or__, [c[f].isNull() for f in child_fields])
            missing = missing | F.exists(node[children]["nodes"], child)
        return missing

    return F.exists(nodes, lacks)


# Fields that a node, and a child of it, must have, by resource.
REQUIRED = {
    "orders": (("id", "name", "createdAt"), ("quantity",)),
    "order_lines": (("id",), ("quantity",)),
    "products": (("id",), ("id",)),
}


def parsed(pages: Pages, schema: str) -> DataFrame:
    """The columns of an archive that a reader names; landed pages are parsed here, whole."""
    if isinstance(pages, Archive):
        return pages.read(schema)
    return pages if "problem" in pages.columns else parse_pages(pages)


def _refusal(name: str) -> Column:
    """The error of a page that cannot be loaded, by its problem."""
    problem = F.col("problem")
    return (
        F.when(problem == "errors", F.concat(F.lit("page with errors: "), F.col("detail")))
        .when(problem == "unreadable", F.lit(f"unreadable {name} page"))
        .when(problem == "no nodes", F.lit(f"{name} page without nodes"))
        .when(problem == "incomplete node", F.lit(f"{name} page with an incomplete node"))
        .when(problem == "missing field", F.lit(f"{name} page with a node without a required field"))
        .when(problem == "broken allocation", F.lit(f"{name} page with a discount allocation without an amount"))
        .otherwise(F.concat(F.lit(f"{name} page: "), problem))
    )


def nodes(pages: Pages, resources: tuple[str, ...], schema: str, name: str) -> DataFrame:
    """The nodes of the given pages, one per row; a bad page fails the job.

    So does a page of no known resource, whichever resources are asked for. A page that
    only lacks its page info has its nodes; the chain it breaks is found by the chain check.
    The check asks for the resource itself, so it holds wherever the optimizer
    moves it. The outer explode keeps the optimizer from guessing a filter on the
    list and pushing it below a parse, which would parse every page twice.
    """
    wanted = F.col("resource").isin(*resources)
    bad = F.col("problem").isNotNull() & (F.col("problem") != _NO_PAGE_INFO)
    checked = (
        F.when(unknown(F.col("resource")), F.raise_error(F.lit("page of an unknown resource")))
        .when(wanted & bad, F.raise_error(_refusal(name)))
        .otherwise(F.col(name)["nodes"])
    )
    return (
        parsed(pages, schema)
        .filter(wanted | unknown(F.col("resource")))
        .select(F.explode_outer(checked).alias("node"))
        .filter(F.col("node").isNotNull())
    )


def _amounts(orders: Column, products: Column) -> Column:
    """Whether any amount of a page has more decimals than amounts keep."""
    totals = ("totalPriceSet", "totalDiscountsSet", "totalRefundedSet", "totalShippingPriceSet")

    def any_beyond(node: Column, fields: tuple[str, ...]) -> Column:
        found = [F.coalesce(beyond_scale(node[f]["shopMoney"]["amount"]), F.lit(False)) for f in fields]
        return reduce(Column.__or__, found)

    def line(li: Column) -> Column:
        allocations = F.exists(
            allocation_amounts(li["discountAllocations"]), lambda a: F.coalesce(beyond_scale(a), F.lit(False))
        )
        return any_beyond(li, ("originalTotalSet", "discountedTotalSet")) | F.coalesce(allocations, F.lit(False))

    def variant(v: Column) -> Column:
        amounts = (v["price"], v["inventoryItem"]["unitCost"]["amount"])
        return reduce(Column.__or__, [F.coalesce(beyond_scale(a), F.lit(False)) for a in amounts])

    return F.coalesce(
        F.exists(orders["nodes"], lambda o: any_beyond(o, totals) | F.exists(o["lineItems"]["nodes"], line)),
        F.lit(False),
    ) | F.coalesce(
        F.exists(products["nodes"], lambda p: F.exists(p["variants"]["nodes"], variant)), F.lit(False)
    )


def _problem(resource: Column, read: Column) -> Column:
    page = F.get(read, F.lit(0))
    orders, products = page["data"]["orders"], page["data"]["products"]
    is_product = resource == "products"
    nodes_missing = F.when(is_product, products["nodes"].isNull()).otherwise(orders["nodes"].isNull())
    incomplete = F.when(is_product, _incomplete(products["nodes"], "variants")).otherwise(
        _incomplete(orders["nodes"], "lineItems")
    )
    more = F.when(is_product, products["pageInfo"]["hasNextPage"]).otherwise(
        orders["pageInfo"]["hasNextPage"]
    )
    lists = {"orders": orders, "order_lines": orders, "products": products}
    children = {"orders": "lineItems", "order_lines": "lineItems", "products": "variants"}
    lacking = reduce(
        Column.__or__,
        [
            (resource == name) & F.coalesce(_lacking(lists[name]["nodes"], own, children[name], childs), F.lit(False))
            for name, (own, childs) in REQUIRED.items()
        ],
    )
    broken_allocation = F.exists(
        orders["nodes"],
        lambda o: F.exists(
            o["lineItems"]["nodes"],
            lambda li: F.exists(
                allocation_amounts(li["discountAllocations"]), lambda a: a.isNull()
            ),
        ),
    )
    return (
        F.when(unknown(resource), "unknown resource")
        .when(unreadable(read), "unreadable")
        .when(has_errors(page), "errors")
        .when(nodes_missing, "no nodes")
        .when(incomplete, "incomplete node")
        .when(lacking, "missing field")
        .when(broken_allocation, "broken allocation")
        .when(_amounts(orders, products), "amount beyond the scale")
        .when((resource != "order_lines") & more.isNull(), _NO_PAGE_INFO)
    )


def _with(value: Column, expression: Callable[[Column], Column]) -> Column:
    """An expression over a value that is evaluated once: the finish of a sum over no elements. Unlike an
    element of a transformed list, its result is not copied."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, expression)


def _has_null(values: Column) -> Column:
    return F.exists(values, lambda value: value.isNull())


def _sound(resource: Column, read: Column) -> Column:
    """True only for a page of orders, or of lines of orders, without a problem; anything else may be false or null.

    Tests fields of all nodes and lines at once, as lists; ``_problem`` takes a line at a time.
    """
    page = F.get(read, F.lit(0))
    orders = page["data"]["orders"]
    nodes = orders["nodes"]
    amount = lambda sets: sets["shopMoney"]["amount"]
    sets = ("totalPriceSet", "totalDiscountsSet", "totalRefundedSet", "totalShippingPriceSet")
    line_sets = ("originalTotalSet", "discountedTotalSet")

    def fields(name: str, lines: Column) -> Column:
        own, of_lines = REQUIRED[name]
        lists = [nodes[f] for f in own] + [lines[f] for f in of_lines]
        return reduce(Column.__and__, [~_has_null(values) for values in lists])

    def amounts(lines: Column, allocated: Column) -> Column:
        texts = F.concat_ws(" ", *[amount(nodes[s]) for s in sets], *[amount(lines[s]) for s in line_sets], allocated)
        power = F.contains(texts, F.lit("e")) | F.contains(texts, F.lit("E"))
        return ~_has_null(allocated) & ~power & ~texts.rlike(r"\.[0-9]{5}")

    def whole(lines: Column) -> Column:
        allocated = amount(F.flatten(F.array_compact(lines["discountAllocations"]))["allocatedAmountSet"])
        ends = (resource == "orders") & orders["pageInfo"]["hasNextPage"].isNotNull() & fields("orders", lines)
        return (ends | ((resource == "order_lines") & fields("order_lines", lines))) & _with(
            allocated, lambda texts: amounts(lines, texts)
        )

    return (
        ~unreadable(read)
        & page["errors"].isNull()
        & page["data"]["products"].isNull()
        & _with(F.flatten(nodes["lineItems"]["nodes"]), whole)  # null if any list is
    )


def _with_response(pages: DataFrame) -> DataFrame:
    """Landed pages with ``problem``, ``detail``, ``kept`` (the body of a page with a problem), ``orders`` and ``products``.

    All comes from one expression over the page as it was parsed, so that neither is copied before: of a page
    without a problem the text goes no further. The outer inline keeps the optimizer from a filter on the list,
    which would parse every page twice.
    """
    resource = F.col("resource")

    def looked_through(read: Column) -> Column:
        page = F.get(read, F.lit(0))

        def found(problem: Column) -> Column:
            return F.struct(
                problem.alias("problem"),
                F.when(problem == "errors", page["errors"]).alias("detail"),
                F.when(problem.isNotNull(), F.col("body")).alias("kept"),
                page["data"]["orders"].alias("orders"),
                page["data"]["products"].alias("products"),
            )

        return _with(F.when(_sound(resource, read), F.lit(None)).otherwise(_problem(resource, read)), found)

    read = parse(F.col("body"), schemas.RESPONSE)
    return pages.select(
        "resource", "request_cursor", "body", F.inline_outer(F.array(_with(read, looked_through)))
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    """Landed pages, each parsed once, with why they cannot be loaded, or null."""
    return _with_response(pages).select(
        "request_cursor", "problem", "detail", F.col("kept").alias("body"), "orders", "products", "resource"
    )


def page_errors(pages: Pages) -> DataFrame:
    """Pages that cannot be loaded and why: one row per bad page.

    An exploded list of none or one problem, here and in ``good_pages``, keeps the
    test above the parse; a filter would be pushed below it and parse many times.
    """
    problem = F.array(F.col("problem"))
    return parsed(pages, schemas.PAGE_PROBLEMS).select(
        "resource",
        "request_cursor",
        F.explode(F.filter(problem, lambda p: p.isNotNull())).alias("problem"),
    )


def good_pages(pages: DataFrame) -> DataFrame:
    """The landed pages ``page_errors`` does not list, for loads that set bad pages aside."""
    return _with_response(pages).select(
        "resource",
        "request_cursor",
        F.explode(F.when(F.col("problem").isNull(), F.array("body"))).alias("body"),
    )


def page_chain_gaps(pages: Pages, work: str | None = None) -> DataFrame:
    """Breaks in the cursor chains: ``(resource, problem, cursor)``.

    A whole chain has one first page and one last page, and leads from the one to the
    other through every page. Each page says which cursor it answers and which it hands
    out; one grouped sum over the cursors finds pages that are missing, repeated or under
    a cursor that none or several handed out. What those counts cannot see is a ring that no
    page leads into: ``detached_rings`` follows the links for it. The links are written once
    below ``work``, by default a new folder of the shared scratch space.
    """
    info = F.when(F.col("resource") == "products", F.col("products.pageInfo")).otherwise(F.col("orders.pageInfo"))
    rows = parsed(pages, schemas.PAGE_ENDS)
    spark, work = rows.sparkSession, work or scratch_dir(rows.sparkSession, "chains")
    links = (
        rows.filter(F.col("resource").isin("orders", "products"))
        .select("resource", F.col("request_cursor").alias("cursor"), info.alias("info"))
        .select("resource", "cursor", F.col("info.hasNextPage").alias("more"), F.col("info.endCursor").alias("end"))
    )
    links.write.mode("overwrite").parquet(f"{work}/links")
    links = spark.read.schema(links.schema).parquet(f"{work}/links")
    rings = detached_rings(links, work).select("resource", F.lit("detached ring").alias("problem"), "cursor")
    return _cursor_gaps(links).unionByName(rings)


def _cursor_gaps(links: DataFrame) -> DataFrame:
    """What the counts of a cursor's answers and announcements tell."""

    def note(cursor, asked, wanted, closed):
        return F.struct(
            cursor.cast("string").alias("cursor"),
            F.lit(asked).alias("asked"),
            wanted.cast("int").alias("wanted"),
            closed.cast("int").alias("closed"),
        )

    zero, more = F.lit(0), F.col("more")
    notes = F.array(
        note(F.col("cursor"), 1, zero, zero),
        note(F.lit(None), 0, zero, F.coalesce(~more, F.lit(False))),
        F.when(more, note(F.col("end"), 0, F.lit(1), zero)),
    )
    cursors = (
        links.select("resource", F.explode(F.filter(notes, lambda n: n.isNotNull())).alias("n"))
        .groupBy("resource", "n.cursor")
        .agg(
            F.sum("n.asked").alias("asked"),
            F.sum("n.wanted").alias("wanted"),
            F.sum("n.closed").alias("closed"),
        )
    )
    start = F.col("cursor").isNull()
    problems = F.array(
        F.when(start & (F.col("asked") == 0), "no first page"),
        F.when(start & (F.col("closed") == 0), "no last page"),
        F.when(start & (F.col("closed") > 1), "several last pages"),
        F.when(start & (F.col("wanted") > 0), "page without end cursor"),
        F.when(~start & (F.col("asked") == 0), "missing page"),
        F.when(F.col("asked") > 1, "repeated page"),
        F.when(~start & (F.col("asked") > 0) & (F.col("wanted") == 0), "orphan page"),
        F.when(~start & (F.col("wanted") > 1), "cursor handed out twice"),
    )
    return cursors.select(
        "resource",
        F.explode(F.filter(problems, lambda p: p.isNotNull())).alias("problem"),
        "cursor",
    )


def detached_rings(links: DataFrame, work: str) -> DataFrame:
    """Pages whose cursors lead back to themselves: ``(resource, cursor)``, the least cursor of each ring.

    Pointer jumping: every page points to the one it hands out a cursor for, and in each
    round to where following its pointer JUMPS times leads, so pointers reach JUMPS times as far; a
    page whose pointer runs past a chain's end drops out. When pointers reach as far as there are
    links, those left lead around a ring. Each round is joins on the cursor, written below
    ``work``, so a lost executor costs the round; a cursor that several pages hand out has
    one pointer of its own, so no round has more rows than there are links.

    A ring has a link that does not lead upwards, in whatever order of the cursors. Where
    every link does, in order of length and text, as with counted cursors, no round is needed.
    """
    spark = links.sparkSession
    onward = links.filter(F.col("more") & F.col("cursor").isNotNull() & F.col("end").isNotNull())
    hops = onward.groupBy("resource", F.col("cursor").alias("at")).agg(F.min("end").alias("to"))
    hops = hops.withColumn("least", F.col("at"))
    size, end_size = F.length("cursor"), F.length("end")
    upwards = (end_size > size) | ((end_size == size) & (F.col("end") > F.col("cursor")))
    pages, others = onward.agg(F.count(F.lit(1)), F.count_if(~upwards)).first()
    if not others:
        return hops.limit(0).select("resource", F.col("least").alias("cursor"))
    reach, left = 1, pages
    while reach < pages and left:
        ahead = hops.select("resource", F.col("at").alias("to"), F.col("to").alias("then"), F.col("least").alias("ahead"))
        step = hops
        for _ in range(JUMPS - 1):
            step = step.join(ahead, ["resource", "to"]).select(
                "resource", "at", F.col("then").alias("to"), F.least("least", "ahead").alias("least")
            )
        reach *= JUMPS
        seen = Observation("pointers")
        path = f"{work}/reach-{reach}"
        step.observe(seen, F.count(F.lit(1)).alias("left")).write.mode("overwrite").parquet(path)
        hops, left = spark.read.schema(step.schema).parquet(path), seen.get["left"]
    # Pages that only lead into a ring are no part of it: a pointer that far is.
    within = hops.select("resource", F.col("to").alias("at")).distinct()
    return hops.join(within, ["resource", "at"], "left_semi").select("resource", F.col("least").alias("cursor")).distinct()


def line_chain_gaps(pages: Pages) -> DataFrame:
    """Breaks in the parts of orders' lines: ``(order_id, problem, part)``.

    Part 0 is the order itself. A part that a former one announces is there once; a part
    that none announces has lost its former part or its order. One grouped sum, as for
    the cursors.
    """
    part = F.when(F.col("resource") == "orders", F.lit("0")).otherwise(
        F.element_at(F.split("request_cursor", "/"), -1)
    )
    found = (
        parsed(pages, schemas.LINE_CHAINS)
        .filter(F.col("resource").isin("orders", "order_lines"))
        .select(part.cast("bigint").alias("part"), F.explode_outer("orders.nodes").alias("order"))
        .filter(F.col("order").isNotNull())
    )
    more = F.coalesce(F.col("order.lineItems.pageInfo.hasNextPage"), F.lit(False))
    note = lambda at, asked, wanted: F.struct(
        at.alias("part"), F.lit(asked).alias("asked"), F.lit(wanted).alias("wanted")
    )
    notes = F.array(note(F.col("part"), 1, 0), F.when(more, note(F.col("part") + 1, 0, 1)))
    parts = (
        found.select(F.col("order.id").alias("order_id"), F.explode(F.array_compact(notes)).alias("n"))
        .groupBy("order_id", "n.part")
        .agg(F.sum("n.asked").alias("asked"), F.sum("n.wanted").alias("wanted"))
    )
    problems = F.array(
        F.when(F.col("asked") == 0, "missing lines"),
        F.when(F.col("asked") > 1, "repeated lines"),
        F.when((F.col("part") > 0) & (F.col("asked") > 0) & (F.col("wanted") == 0), "orphan lines"),
    )
    return parts.select("order_id", F.explode(F.array_compact(problems)).alias("problem"), "part")


def load_gaps(pages: Pages, work: str | None = None) -> DataFrame:
    """All that shows a load as incomplete: ``(resource, problem, place)``."""
    chains = page_chain_gaps(pages, work).select("resource", "problem", F.col("cursor").alias("place"))
    lines = line_chain_gaps(pages).select(
        F.lit("order_lines").alias("resource"), "problem", F.concat_ws("/", "order_id", "part").alias("place")
    )
    return chains.unionByName(lines)


def truncation_suspects(pages: Pages, limit: int = 50) -> DataFrame:
    """Parents with exactly as many children as one request may nest.

    Such a parent may have lost children at the source; the flattening itself
    never cuts a list. An order that says that further lines follow is no suspect.
    """
    parents = F.when(
        F.col("resource") == "products",
        F.transform(
            F.col("products.nodes"),
            lambda p: F.struct(
                p["id"].alias("id"), F.size(p["variants"]["nodes"]).alias("children"), F.lit(False).alias("more")
            ),
        ),
    ).otherwise(
        F.transform(
            F.col("orders.nodes"),
            lambda o: F.struct(
                o["id"].alias("id"),
                F.size(o["lineItems"]["nodes"]).alias("children"),
                F.coalesce(o["lineItems"]["pageInfo"]["hasNextPage"], F.lit(False)).alias("more"),
            ),
        )
    )
    return (
        parsed(pages, schemas.CHILD_COUNTS)
        .filter(F.col("resource").isin("orders", "products"))
        .select("resource", F.explode(parents).alias("parent"))
        .filter((F.col("parent.children") == limit) & ~F.col("parent.more"))
        .select(
            "resource",
            F.col("parent.id").alias("parent_id"),
            F.col("parent.children").cast("bigint").alias("children"),
        )
    )

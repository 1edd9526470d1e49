"""The driver's order, line and part tables bound to the raw tables, flat and as pages.

The flat binding joins and sums; the page binding nests the same rows into landed
JSON pages, so that flattening them must give the flat binding back.
"""

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.schemas import MONEY, TOTAL
from storeledger.session import scratch_dir

_PRICE = "decimal(18,2)"


# Declared schemas spare every read a look at the file footers.
_SCHEMAS = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def _cancelled() -> Column:
    return F.col("o_orderstatus") == "P"


def _cents(amount: Column) -> Column:
    """Whole cents of a double that holds an amount with two decimals."""
    return F.floor(amount * 100 + 0.5)


def _amount(cents: Column) -> Column:
    return cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def _line_cents(lineitem: DataFrame) -> DataFrame:
    """Adds a line's ``original`` total and ``discount`` as exact whole cents.

    The discount is the original times a whole percentage, rounded half up.
    """
    return (
        lineitem.withColumn("original", _cents(F.col("l_extendedprice")))
        .withColumn("percent", _cents(F.col("l_discount")))
        .withColumn("discount", F.expr("(original * percent + 50) div 100"))
    )


def _order_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its line totals in whole cents, summed before they are joined."""
    net = F.col("original") - F.col("discount")
    totals = (
        _line_cents(_table(spark, sf_dir, "lineitem"))
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum("discount").alias("total_discounts"),
            F.sum(F.when(F.col("l_returnflag") == "R", net)).alias("total_refunded"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )
    none = F.lit(0).cast("bigint")
    return (
        _table(spark, sf_dir, "orders")
        .join(totals, "o_orderkey", "left")
        .select(
            "o_orderkey",
            F.coalesce(F.col("n_lines"), none).alias("n_lines"),
            F.col("o_orderdate").alias("created_at"),
            _cancelled().alias("cancelled"),
            F.col("o_orderpriority").alias("financial_status"),
            _cents(F.col("o_totalprice")).alias("total_price"),
            F.coalesce("total_discounts", none).alias("total_discounts"),
            F.coalesce("total_refunded", none).alias("total_refunded"),
        )
    )


def _order_name() -> Column:
    return F.concat(F.lit("#"), F.col("o_orderkey").cast("string"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    def total(cents: str) -> Column:
        return _amount(F.col(cents)).cast(TOTAL).alias(cents)

    return _order_sums(spark, sf_dir).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        _order_name().alias("name"),
        "created_at",
        "cancelled",
        "financial_status",
        total("total_price"),
        total("total_discounts"),
        total("total_refunded"),
        F.lit(0).cast(TOTAL).alias("shipping_charged"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line. Both joins shuffle on the key unless a side is seen to be
    small; a hot order or part is split by the adaptive skew join."""
    return (
        _line_cents(_table(spark, sf_dir, "lineitem"))
        .join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            _cancelled().alias("cancelled"),
            F.col("p_name").alias("product"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            _amount(F.col("original")).cast(MONEY).alias("original_total"),
            _amount(F.col("original") - F.col("discount")).cast(MONEY).alias("discounted_total"),
            _amount(F.col("discount")).cast(MONEY).alias("discount"),
        )
    )


def _unit_cost() -> Column:
    unpriced = F.col("p_name").like("small %") | (F.col("p_brand") == "Brand#7")
    cost = F.round(F.col("p_retailprice").cast(_PRICE) * F.lit(0.6).cast("decimal(2,1)"), 2)
    return F.when(~unpriced, cost.cast(MONEY))


def _inventory() -> Column:
    return (
        F.when(F.col("p_type") == "ECONOMY", 0)
        .when((F.col("p_type") == "PROMO") & (F.col("p_size") <= 5), -F.col("p_size"))
        .otherwise(F.col("p_size"))
        .cast("bigint")
    )


def _variant_title() -> Column:
    return F.concat(F.col("p_type"), F.lit("/"), F.col("p_partkey").cast("string"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("product_id"),
        F.col("p_name").alias("product"),
        F.lit("ACTIVE").alias("status"),
        F.col("p_partkey").cast("string").alias("variant_id"),
        _variant_title().alias("variant"),
        F.col("p_retailprice").cast(_PRICE).cast(MONEY).alias("price"),
        _unit_cost().alias("unit_cost"),
        _inventory().alias("inventory_quantity"),
    )


RAW = {"orders": orders, "order_items": order_items, "variants": variants}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: bind(spark, sf_dir) for name, bind in RAW.items()}


# Landed pages ---------------------------------------------------------------


# Texts of lines and orders are put together by plain expressions, which run far faster than a JSON
# writer that walks structs: a field that is null is left out, as the writer would.


def _quoted(text: Column) -> Column:
    """The JSON string of a text; null stays null."""
    written = F.to_json(F.struct(text.alias("t")))
    return F.when(text.isNotNull(), F.substring(written, F.lit(6), F.length(written) - 6))


def _field(name: str, value: Column) -> Column:
    """A field of an object, ``value`` being its JSON text; null without one."""
    return F.concat(F.lit(f'"{name}":'), value)


def _object(*fields: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def _money_set(amount: Column) -> Column:
    amount = F.concat(F.lit('"amount":"'), amount, F.lit('"'))
    return F.concat(F.lit('{"shopMoney":{'), F.coalesce(amount, F.lit("")), F.lit("}}"))


def _allocation(amount: Column) -> Column:
    return _object(_field("allocatedAmountSet", _money_set(amount)))


def _pieces(cents: Column) -> tuple[Column, ...]:
    """The parts of the text of an amount: sign, whole units, and point and cents, which are looked up."""
    size = F.abs(cents)
    hundredths = F.array(*[F.lit(f".{i:02}") for i in range(100)])
    sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
    return sign, F.call_function("div", size, F.lit(100)).cast("string"), F.get(hundredths, (size % 100).cast("int"))


def _text(cents: Column) -> Column:
    """The text of an amount of whole cents, as ``_amount`` would show it."""
    return F.concat(*_pieces(cents))


_HEAD_COLUMNS = (
    "created_at",
    "cancelled",
    "financial_status",
    "total_price",
    "total_discounts",
    "total_refunded",
)
_LINE_COLUMNS = ("l_linenumber", "l_quantity", "title", "original", "discount")


def _line_node() -> Column:
    """The text of a line whose discount shows as two allocations (odd line numbers) or as the gap
    between its totals (even ones); line 7 has no product and names it in its title.
    ``title`` is a JSON string. A line that has all its fields is one concatenation."""
    odd = F.col("l_linenumber") % 2 == 1
    original, discount = F.col("original"), F.col("discount")
    half = F.call_function("div", discount + 1, F.lit(2))
    allocations = F.concat(
        F.lit("["), _allocation(_text(half)), F.lit(","), _allocation(_text(discount - half)), F.lit("]")
    )
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    title = _field("title", F.col("title"))
    lacking = _object(
        title,
        _field("quantity", quantity),
        F.when(F.col("l_linenumber") != 7, _field("product", _object(title))),
        _field("originalTotalSet", _money_set(_text(original))),
        _field("discountedTotalSet", _money_set(_text(F.when(odd, original).otherwise(original - discount)))),
        F.when(odd, _field("discountAllocations", allocations)),
    )
    product = F.when(
        F.col("l_linenumber") != 7, F.concat(F.lit(',"product":{"title":'), F.col("title"), F.lit("}"))
    ).otherwise(F.lit(""))
    start = (F.lit('{"title":'), F.col("title"), F.lit(',"quantity":'), quantity, product)
    start = (*start, F.lit(',"originalTotalSet":{"shopMoney":{"amount":"'), *_pieces(original))
    start = (*start, F.lit('"}},"discountedTotalSet":{"shopMoney":{"amount":"'))
    allocated = F.lit('"}},"discountAllocations":[{"allocatedAmountSet":{"shopMoney":{"amount":"')
    then = F.lit('"}}},{"allocatedAmountSet":{"shopMoney":{"amount":"')
    there = [F.col(name).isNotNull() for name in _LINE_COLUMNS]
    return (
        F.when(~reduce(Column.__and__, there), lacking)
        .when(
            odd,
            F.concat(*start, *_pieces(original), allocated, *_pieces(half), then, *_pieces(discount - half), F.lit('"}}}]}')),
        )
        .otherwise(F.concat(*start, *_pieces(original - discount), F.lit('"}}}')))
    )


def _is_whole() -> Column:
    """Whether an order's row shows all its fields; on a continuation page only the id, the cancellation
    and the lines are there."""
    return (F.col("chunk") == 0) & F.col("o_orderkey").isNotNull()


def _order_totals() -> Column:
    """The text of an order's status, a JSON string, and totals, which show four decimals."""

    def total(name: str, cents: Column) -> Column:
        return _field(name, _money_set(F.when(_is_whole(), F.concat(_text(cents), F.lit("00")))))

    return F.concat_ws(
        ",",
        F.when(_is_whole(), _field("displayFinancialStatus", F.col("financial_status"))),
        total("totalPriceSet", F.col("total_price")),
        total("totalDiscountsSet", F.col("total_discounts")),
        total("totalRefundedSet", F.col("total_refunded")),
        total("totalShippingPriceSet", F.lit(0).cast("bigint")),
    )


def _order_node() -> Column:
    """The text of an order with its lines, from those of its totals, of its lines and of the time ``created``."""

    def string(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    fields = F.concat_ws(
        ",",
        _field("id", string(F.col("o_orderkey").cast("string"))),
        F.when(_is_whole(), _field("name", string(_order_name()))),
        F.when(_is_whole(), _field("createdAt", string(F.col("created")))),
        F.when(F.col("cancelled"), _field("cancelledAt", string(F.col("created")))),
        F.col("totals"),
    )
    more = (F.col("chunk") + 1 < F.col("chunks")).cast("string")
    info = _object(_field("hasNextPage", more), _field("endCursor", string(F.col("chunk").cast("string"))))
    return F.concat(
        F.lit("{"), fields, F.lit(',"lineItems":{"pageInfo":'), info,
        F.lit(',"nodes":['), F.array_join("lines", ","), F.lit("]}}"),
    )


def _with_nodes(text: Column, nodes: Column, depth: int) -> Column:
    """A JSON text with ``nodes``, a list of texts, as the last field ``depth`` braces from its end."""
    start = F.substring(text, F.lit(1), F.length(text) - depth)
    return F.concat(start, F.lit(',"nodes":['), F.array_join(nodes, ","), F.lit("]" + "}" * depth))


def _bounds(rows: DataFrame, key: str, size: int) -> tuple[int, int]:
    """First and last page number; one row reaches the driver."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    return (0, 0) if low is None else (low // size, high // size)


def _landed(resource: str, page: Column, bounds: tuple[int, int], nodes: Column) -> list[Column]:
    """Cursor and body of a page; ``nodes``: a list of JSON texts."""
    first, last = bounds
    info = F.struct((page < last).alias("hasNextPage"), page.cast("string").alias("endCursor"))
    listing = F.struct(info.alias("pageInfo"))
    text = F.to_json(F.struct(F.struct(listing.alias(resource)).alias("data")))
    return [
        F.when(page > first, (page - 1).cast("string")).alias("request_cursor"),
        _with_nodes(text, nodes, 3).alias("body"),
    ]


def order_pages(
    spark: SparkSession, sf_dir: str, per_page: int = 50, lines_per_order: int = 50
) -> DataFrame:
    """Orders and their lines as landed pages of about equal size.

    A page holds the orders of ``per_page`` neighbouring keys. The lines of an
    order with more than ``lines_per_order`` spread by scan position over so many
    pages that none nests much more than that: the first with the order, the
    others as ``order_lines`` pages. So no group grows with the data, not even
    where one order has a third of all lines, and no line is lost.

    The order rows, with their sums over the lines, are written once to the shared
    scratch folder: they serve as heads, which carry what all lines of an order share. Only orders
    of several pages are joined with the lines, to tell how many; that side is a plain scan, so
    that adaptive execution can split a hot order. Lines become JSON text before they are grouped.
    """
    path = scratch_dir(spark, "order-rows")
    chunks = F.greatest(F.expr(f"(n_lines + {lines_per_order - 1}) div {lines_per_order}"), F.lit(1).cast("bigint"))
    order_rows = (
        _order_sums(spark, sf_dir)
        .withColumn("financial_status", _quoted(F.col("financial_status")))
        .withColumn("page", F.expr(f"o_orderkey div {per_page}"))
        .withColumn("chunks", chunks)
        .drop("n_lines")
    )
    order_rows.write.parquet(path)
    order_rows = spark.read.schema(order_rows.schema).parquet(path)
    bounds = _bounds(_table(spark, sf_dir, "orders"), "o_orderkey", per_page)
    # Every part of an order has a row, also one that happens to get no line.
    heads = order_rows.select(
        "page",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"),
        "o_orderkey",
        "chunks",
        *_HEAD_COLUMNS,
    )
    spread = order_rows.filter("chunks > 1").select("o_orderkey", F.col("chunks").alias("of"))
    lines = _line_cents(_table(spark, sf_dir, "lineitem").filter("l_orderkey IS NOT NULL"))
    chunk = F.lit(0).cast("bigint")
    if not spread.isEmpty():
        lines = lines.withColumn("position", F.xxhash64(F.monotonically_increasing_id()))
        lines = lines.join(spread, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        chunk = F.coalesce(F.pmod(F.col("position"), F.col("of")), chunk)
    titles = _table(spark, sf_dir, "part").select("p_partkey", _quoted(F.col("p_name")).alias("title"))
    lines = lines.join(titles, F.col("l_partkey") == F.col("p_partkey")).select(
        F.expr(f"l_orderkey div {per_page}").alias("page"),
        chunk.alias("chunk"),
        F.col("l_orderkey").alias("o_orderkey"),
        *_LINE_COLUMNS,
        F.lit(True).alias("is_line"),
    )
    # One shuffle and one sort of flat rows serve both groupings above them, which then hold one page
    # at a time; texts are made after the sort.
    line = F.when(F.col("l_linenumber").isNotNull(), _line_node())
    flat = heads.unionByName(lines, allowMissingColumns=True)
    flat = flat.repartition("page", "chunk").sortWithinPartitions("page", "chunk", "o_orderkey")
    totals = F.when(F.col("is_line").isNull(), _order_totals())
    nodes = (
        flat.select(
            "page", "chunk", "o_orderkey", "created_at", "cancelled", "chunks", totals.alias("totals"), line.alias("line")
        )
        .groupBy("page", "chunk", "o_orderkey")
        .agg(
            F.first("totals", ignorenulls=True).alias("totals"),
            F.first("created_at", ignorenulls=True).alias("created_at"),
            F.first("cancelled", ignorenulls=True).alias("cancelled"),
            F.max("chunks").alias("chunks"),
            F.count("totals").alias("rows"),
            F.collect_list("line").alias("lines"),
        )
        # Lines of no order fall away; an order that is there twice has its lines twice, by the join
        # above where it has several pages.
        .filter("rows > 0")
        .withColumn("created", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .withColumn("lines", F.expr("if(rows = 1 or chunks > 1, lines, flatten(array_repeat(lines, int(rows))))"))
    )
    cursor, body = _landed("orders", F.col("page"), bounds, F.col("orders"))
    more = F.col("chunk") > 0
    return (
        # The orders are in this order already, so nothing is sorted; but only where it is asked for are
        # they grouped as they come, and not by a table of some pages that then gives way to a sort. The text
        # is made before, as a collected expression would be interpreted.
        nodes.select("page", "chunk", _order_node().alias("node"))
        .sortWithinPartitions("page", "chunk")
        .groupBy("page", "chunk")
        .agg(F.collect_list("node").alias("orders"))
        .select(
            F.when(more, "order_lines").otherwise("orders").alias("resource"),
            F.when(more, F.concat_ws("/", "page", "chunk")).otherwise(cursor).alias("request_cursor"),
            body,
        )
    )


def product_pages(spark: SparkSession, sf_dir: str, per_page: int = 100) -> DataFrame:
    """Products and their variants as landed pages of ``per_page`` neighbouring variants.

    A product with variants on several pages appears on each of them.
    """
    part = _table(spark, sf_dir, "part")
    bounds = _bounds(part, "p_partkey", per_page)
    cost = F.struct(_unit_cost().cast("string").alias("amount"))
    no_item = _unit_cost().isNull() & (F.col("p_partkey") % 2 == 0)
    variant = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        _variant_title().alias("title"),
        F.col("p_retailprice").cast(_PRICE).cast("string").alias("price"),
        _inventory().alias("inventoryQuantity"),
        F.when(~no_item, F.struct(F.when(_unit_cost().isNotNull(), cost).alias("unitCost"))).alias(
            "inventoryItem"
        ),
    )
    products = (
        part.withColumn("page", F.expr(f"p_partkey div {per_page}"))
        .repartition("page")
        .groupBy("page", "p_brand", "p_name")
        .agg(F.collect_list(variant).alias("variants"))
    )
    node = F.struct(
        F.col("p_brand").alias("id"),
        F.col("p_name").alias("title"),
        F.lit("ACTIVE").alias("status"),
        F.struct(F.col("variants").alias("nodes")).alias("variants"),
    )
    return (
        products.groupBy("page")
        .agg(F.collect_list(F.to_json(node)).alias("nodes"))
        .select(F.lit("products").alias("resource"), *_landed("products", F.col("page"), bounds, F.col("nodes")))
    )


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_pages(spark, sf_dir).unionByName(product_pages(spark, sf_dir))


def lose_second_page(pages: DataFrame) -> DataFrame:
    """The landed pages without the second page of each chain."""
    return pages.filter(F.col("request_cursor").isNull() | (F.col("request_cursor") != "0"))


# The start of a landed page's body, up to the value of its end cursor.
_TO_END = r'^(\{"data":\{"[a-z]+":\{"pageInfo":\{"hasNextPage":true,"endCursor":")([^"]*)'


def plant_chain_faults(pages: DataFrame) -> DataFrame:
    """The landed pages with three faults in each chain.

    The second page is lost. Copies, without nodes, of all pages between the first and the last hand out
    cursors among themselves only, the last of them that of the first: a ring that nothing
    leads into. A copy of the fourth page answers a cursor that nobody handed out, so what it
    hands out is handed out twice. The pages are written once: the copies read them again.
    """
    path = scratch_dir(pages.sparkSession, "landed")
    pages.write.parquet(path)
    pages = pages.sparkSession.read.schema(pages.schema).parquet(path)
    chained = F.col("resource").isin("orders", "products")
    end = F.regexp_extract("body", _TO_END, 2)
    inner = pages.filter(chained & F.col("request_cursor").isNotNull() & (end != ""))
    number = F.col("request_cursor").cast("bigint")
    edges = inner.groupBy("resource").agg(F.min(number).alias("first"), F.max(number).alias("last"))
    around = F.when(number == F.col("last"), F.col("first")).otherwise(number + 1)
    ring = inner.join(edges, "resource").select(
        "resource",
        F.concat(F.lit("ring "), "request_cursor").alias("request_cursor"),
        F.concat(
            F.regexp_extract("body", _TO_END, 1), F.lit("ring "), around.cast("string"), F.lit('"},"nodes":[]}}}')
        ).alias("body"),
    )
    stray = inner.filter(F.col("request_cursor") == "2").withColumn("request_cursor", F.lit("stray"))
    return lose_second_page(pages).unionByName(ring).unionByName(stray)


def lose_first_continuation(pages: DataFrame) -> DataFrame:
    """The landed pages without the first further part of any order's lines."""
    return pages.filter(~F.coalesce(F.col("request_cursor").endswith("/1"), F.lit(False)))


def spoil_pages(pages: DataFrame) -> DataFrame:
    """The landed pages with one fault each in the second to fifth page of a chain."""
    body, cursor = F.col("body"), F.col("request_cursor")
    spoilt = (
        F.when(cursor == "0", F.lit('{"errors":[{"message":"Throttled"}],"data":null}'))
        .when(cursor == "1", F.concat(F.lit("<html>"), body))
        .when(cursor == "2", F.replace(body, F.lit("allocatedAmountSet"), F.lit("lost")))
        .when(cursor == "3", F.lit('{"data":{}}'))
        .otherwise(body)
    )
    return pages.withColumn("body", spoilt)

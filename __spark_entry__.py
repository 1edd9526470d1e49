"""

The queries bind the driver's tables to the library's raw tables (see
``storeledger.sources.driver_tables``) and run the library's operators on them.
Exact amounts leave as doubles on both sides.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from storeledger.functions import person  # noqa: E402
from storeledger.functions.pii import EMAIL  # noqa: E402
from storeledger.operators import (  # noqa: E402
    flatten, marts, quality, report, rollups, semantic, staging,
)
from storeledger.plans import pipeline  # noqa: E402
from storeledger.plans.contract import CONTRACT  # noqa: E402
from storeledger.session import configure, scratch_dir  # noqa: E402
from storeledger.sources import catalog, driver_tables, landed, pages, tables  # noqa: E402
from storeledger.sources.versions import Load  # noqa: E402

# Longest nested list looked for; the driver's orders never reach the 50 lines
# of a real request.
NESTED_LIMIT = 7
FILTERED_PRODUCTS = ["blue bolt", "red widget"]


def _doubles(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in rows.dtypes]
    )


def _staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    operator, source = pipeline.STAGING[name]
    return operator(driver_tables.RAW[source](spark, sf_dir))


def _stage(name: str):
    return lambda spark, sf: _doubles(_staged(spark, sf, name))


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A staged table, or a rollup of one."""
    if name not in pipeline.ROLLUPS:
        return _staged(spark, sf_dir, name)
    operator, staged = pipeline.ROLLUPS[name]
    return operator(_staged(spark, sf_dir, staged))


def _over(operator, *sources: str):
    return lambda spark, sf: operator(*[_source(spark, sf, name) for name in sources])


def _mart(name: str):
    operator, sources = pipeline.MARTS[name]
    return _over(operator, *sources)


def _report(operator, mart: str):
    return lambda spark, sf: operator(_mart(mart)(spark, sf))


def _entities(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: _mart(name)(spark, sf_dir) for name in names}


def _metric(name: str, dims=(), filters=None):
    entity = CONTRACT["metrics"][name]["entity"]
    return lambda spark, sf: semantic.run_metric(
        CONTRACT, _entities(spark, sf, entity), name, dims, filters
    )


def _checks_report(spark, sf):
    checked = {check["entity"] for check in CONTRACT["checks"].values()}
    return quality.run_checks(CONTRACT, _entities(spark, sf, *checked))


def _pk_violations(spark, sf):
    return quality.pk_violations(CONTRACT, _entities(spark, sf, *CONTRACT["entities"]))


def _entity_schema_report(spark, sf):
    return quality.entity_schema_report(CONTRACT, _entities(spark, sf, *CONTRACT["entities"]))


def _kept_orders(orders: DataFrame) -> DataFrame:
    return _doubles(rollups.kept(orders).select("order_id", "created_at", "total_price"))


def _archive(rows: DataFrame) -> pages.Archive:
    """Landed pages, parsed once and archived; queries read the leaf columns they need."""
    return pages.archive_pages(rows, f"{scratch_dir(rows.sparkSession, 'pages')}/pages")


def _order_archive(spark, sf, lines_per_order: int = 50) -> pages.Archive:
    return _archive(driver_tables.order_pages(spark, sf, lines_per_order=lines_per_order))


def _flatten_orders(spark, sf):
    return _doubles(flatten.flatten_orders(_order_archive(spark, sf)))


def _flatten_items(spark, sf):
    return _doubles(flatten.flatten_items(_order_archive(spark, sf)))


def _source_orders(spark, sf):
    """Orders of pages landed by ranges of cursors and read by the data source, which opens no other resource."""
    folder = f"{scratch_dir(spark, 'landing')}/pages"
    landed.land_pages(driver_tables.landed_pages(spark, sf), folder, ranges=16)
    read = landed.read_landed(spark, folder).filter("resource = 'orders'")
    return _doubles(flatten.flatten_orders(_archive(read)))


def _flatten_variants(spark, sf):
    return _doubles(flatten.flatten_variants(_archive(driver_tables.product_pages(spark, sf))))


def _item_allocations(spark, sf):
    """Order pages that nest few lines, so that many orders continue on further pages."""
    lines = flatten.order_lines(_order_archive(spark, sf, lines_per_order=5))
    return _doubles(lines.select("order_id", "original_total", "net_total", "allocated"))


def _item_product_title(spark, sf):
    return flatten.order_lines(_order_archive(spark, sf)).select("order_id", "product")


def _item_discount(spark, sf):
    items = flatten.flatten_items(_order_archive(spark, sf, lines_per_order=5))
    return _doubles(items.select("order_id", "original_total", "discounted_total", "discount"))


def _page_chain_gaps(spark, sf):
    return pages.page_chain_gaps(_archive(driver_tables.plant_chain_faults(driver_tables.landed_pages(spark, sf))))


def _cost_discounts_offsets(spark, sf):
    """The mart from orders whose time of creation is text, with an offset, as pages have it."""
    local = F.date_format(F.col("created_at") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
    text = driver_tables.orders(spark, sf).withColumn("created_at", F.concat(local, F.lit("+02:00")))
    return marts.cost_discounts(rollups.order_months(staging.stg_orders(text)))


def _line_chain_gaps(spark, sf):
    short = driver_tables.order_pages(spark, sf, lines_per_order=5)
    return pages.line_chain_gaps(_archive(driver_tables.lose_first_continuation(short)))


def _page_errors(spark, sf):
    return pages.page_errors(_archive(driver_tables.spoil_pages(driver_tables.landed_pages(spark, sf))))


def _truncation_suspects(spark, sf):
    return pages.truncation_suspects(_archive(driver_tables.landed_pages(spark, sf)), NESTED_LIMIT)


def _raw_roundtrip(spark, sf):
    root = scratch_dir(spark, "raw")
    items = tables.conform(driver_tables.order_items(spark, sf), "order_items")
    tables.replace_table(items, root, "order_items")
    return _doubles(spark.read.parquet(f"{root}/order_items"))


def _load_counts(spark, sf):
    """Land the pages as files, read them back, load the raw tables, report the rows."""
    root = scratch_dir(spark, "load")
    archive = pages.archive_pages(driver_tables.landed_pages(spark, sf), f"{root}/landing")
    return tables.counts_frame(spark, pipeline.load(archive, root))


def _publish_counts(spark, sf):
    """Write the raw tables, build the marts from them, publish four, report the rows."""
    root = scratch_dir(spark, "publish")
    raw = driver_tables.raw_tables(spark, sf)
    tables.publish_tables({n: tables.conform(rows, n) for n, rows in raw.items()}, root)
    counts = pipeline.publish(pipeline.model(spark, root), f"{root}/published")
    return tables.counts_frame(spark, counts)


def _published_product_leaks(spark, sf):
    """One mart after the whole way: pages, raw tables, rollups, marts, published copy."""
    root = scratch_dir(spark, "run")
    pipeline.run(spark, driver_tables.landed_pages(spark, sf), root)
    return tables.read_published(spark, f"{root}/published", "product_leaks")


def _catalog_mart(name: str):
    """A mart as SQL over staging views of raw tables in the catalog, in a database of its own."""

    def query(spark, sf):
        root = scratch_dir(spark, "catalog")
        database = f"storeledger_{root[-32:]}"
        catalog.create_database(spark, database, root)
        raw = driver_tables.raw_tables(spark, sf)
        catalog.save_raw({n: tables.conform(rows, n) for n, rows in raw.items()}, database)
        catalog.create_staging_views(spark, database)
        return catalog.mart(spark, database, name)

    return query


def _product_orders_estimate(spark, sf):
    """Distinct orders by product, exactly, and whether the merged monthly sketches tell as much but for seven in a hundred."""
    staged = {name: _staged(spark, sf, name) for name in ("stg_order_items", "stg_orders")}
    step = Load(spark, scratch_dir(spark, "sketches"))
    step.write("order_sketches", rollups.order_sketches(staged["stg_order_items"], staged["stg_orders"]))
    step.commit()
    told = rollups.product_orders_estimate(step.read("order_sketches")).select(
        F.col("product").alias("told"), F.col("orders").alias("estimate")
    )
    exact = rollups.product_orders(staged["stg_order_items"])
    near = F.abs(F.col("estimate") - F.col("orders")) * 100 <= F.col("orders") * 7
    return exact.join(told, F.col("product").eqNullSafe(F.col("told"))).select("product", "orders", near.alias("near"))


def _pii_scan_documents(spark, sf):
    return quality.pii_scan(driver_tables.documents(spark, sf), "text")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # staging
    "stg_orders": _stage("stg_orders"),
    "stg_order_items": _stage("stg_order_items"),
    "stg_variants": _stage("stg_variants"),
    # pieces of the marts
    "kept_orders": _over(_kept_orders, "stg_orders"),
    "cancelled_value": _over(marts.cancelled_value, "order_months"),
    "revenue_total": _over(marts.revenue_total, "order_months"),
    "capital_total": _over(marts.capital_total, "product_costs"),
    "product_unit_cost": _over(marts.product_unit_cost, "product_costs"),
    # marts
    "cost_discounts": _mart("cost_discounts"),
    "cost_discounts_offsets": _cost_discounts_offsets,
    "cost_refunds": _mart("cost_refunds"),
    "money_summary": _mart("money_summary"),
    "product_leaks": _mart("product_leaks"),
    "product_margin": _mart("product_margin"),
    "stock_capital": _mart("stock_capital"),
    # report
    "money_tree": _report(report.money_tree, "money_summary"),
    "top_capital": _report(report.top_capital, "stock_capital"),
    "top_discounted": _report(report.top_discounted, "product_leaks"),
    "stock_capital_ranked": _report(report.stock_capital_ranked, "stock_capital"),
    # landed pages
    "flatten_orders": _flatten_orders,
    "source_orders": _source_orders,
    "flatten_items": _flatten_items,
    "flatten_variants": _flatten_variants,
    "item_allocations": _item_allocations,
    "item_product_title": _item_product_title,
    "item_discount": _item_discount,
    "page_chain_gaps": _page_chain_gaps,
    "line_chain_gaps": _line_chain_gaps,
    "page_errors": _page_errors,
    "truncation_suspects": _truncation_suspects,
    # semantic layer
    "metric_shop_leaks": _metric("shop_leaks", ["category"]),
    "metric_shop_leaks_total": _metric("shop_leaks"),
    "metric_discount_by_product": _metric("discount_by_product", ["product"]),
    "metric_margin_by_product": _metric("margin_by_product", ["product"]),
    "metric_margin_hit": _metric("margin_hit_by_discounts", ["product"]),
    "metric_margin_hit_mean": _metric("margin_hit_by_discounts"),
    "metric_capital_in_stock": _metric("capital_in_stock", ["product"]),
    "metric_discount_filtered": _metric(
        "discount_by_product", ["product"], {"product": FILTERED_PRODUCTS}
    ),
    # quality
    "checks_report": _checks_report,
    "pk_violations": _pk_violations,
    "entity_schema_report": _entity_schema_report,
    "pii_scan_documents": _pii_scan_documents,
    # sinks
    "raw_roundtrip": _raw_roundtrip,
    "load_counts": _load_counts,
    "publish_counts": _publish_counts,
    "published_product_leaks": _published_product_leaks,
    # catalog tables and views
    "catalog_cost_discounts": _catalog_mart("cost_discounts"),
    "catalog_cost_refunds": _catalog_mart("cost_refunds"),
    "catalog_product_leaks": _catalog_mart("product_leaks"),
    "catalog_stock_capital": _catalog_mart("stock_capital"),
    # sketches
    "product_orders_estimate": _product_orders_estimate,
}


def _configured(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """The money tree on sf0.001."""
    return queries()["money_tree"](spark, "/root/testdata/sf0.001")


def _llm_queries() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    """Queries of the training-data subpackage with their SQL; none where it is not installed."""
    found = importlib.util.find_spec("storeledger.llm")
    if found is None or found.origin is None:
        return {}
    return importlib.import_module("storeledger.llm.queries").QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = _QUERIES | {name: query for name, (query, _) in _llm_queries().items()}
    return {name: _configured(query) for name, query in every.items()}


# Oracle ---------------------------------------------------------------------

# The binding of the driver's tables, as in storeledger.sources.driver_tables.
_BASE = """
line AS (
    SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS original,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2)
                AS DECIMAL(18,2)) AS disc
    FROM lineitem),
b_orders AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '#' || CAST(o_orderkey AS VARCHAR) AS name,
           o_orderdate AS created_at, o_orderstatus = 'P' AS cancelled,
           o_orderpriority AS financial_status,
           CAST(o_totalprice AS DECIMAL(18,2)) AS total_price,
           coalesce(given, 0) AS total_discounts, coalesce(returned, 0) AS total_refunded,
           CAST(0 AS DECIMAL(18,2)) AS shipping_charged
    FROM orders LEFT JOIN (
        SELECT l_orderkey, sum(disc) AS given,
               sum(original - disc) FILTER (WHERE l_returnflag = 'R') AS returned
        FROM line GROUP BY l_orderkey) t ON l_orderkey = o_orderkey),
b_items AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, o_orderstatus = 'P' AS cancelled,
           p_name AS product, CAST(l_quantity AS BIGINT) AS quantity, original AS original_total,
           original - disc AS discounted_total, disc AS discount, l_linenumber
    FROM line JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
b_variants AS (
    SELECT p_brand AS product_id, p_name AS product, 'ACTIVE' AS status,
           CAST(p_partkey AS VARCHAR) AS variant_id,
           p_type || '/' || CAST(p_partkey AS VARCHAR) AS variant,
           CAST(p_retailprice AS DECIMAL(18,2)) AS price,
           CASE WHEN p_name LIKE 'small %' OR p_brand = 'Brand#7' THEN NULL
                ELSE round(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.6 AS DECIMAL(2,1)), 2)
           END AS unit_cost,
           CAST(CASE WHEN p_type = 'ECONOMY' THEN 0
                     WHEN p_type = 'PROMO' AND p_size <= 5 THEN -p_size
                     ELSE p_size END AS BIGINT) AS inventory_quantity
    FROM part)"""


def _share_sql(part: str, whole: str, digits: int) -> str:
    """100 * part / whole of exact numbers, half away from zero; null over zero.

    Floor and remainder of the quotient at the last digit, in place of the doubled quotient
    that the library divides.
    """
    scaled = f"(abs(CAST(({part}) * 100 AS HUGEINT)) * {100 * 10**digits})"
    size = f"nullif(abs(CAST(({whole}) * 100 AS HUGEINT)), 0)"
    up = f"CASE WHEN {scaled} % {size} >= {size} - {scaled} % {size} THEN 1 ELSE 0 END"
    sign = f"CASE WHEN sign({part}) * sign({whole}) < 0 THEN -1 ELSE 1 END"
    return f"{sign} * CAST({scaled} // {size} + {up} AS DOUBLE) / {10**digits}"


def _monthly_sql(amount: str, counted: str) -> str:
    """A month's kept orders that have the amount, and its sum: over every order's share of it."""
    return f"""
        WITH kept AS (SELECT make_timestamp(year(created_at), month(created_at), 1, 0, 0, 0) AS month,
                             {amount} AS amount, CASE WHEN {amount} > 0 THEN 1 ELSE 0 END AS has
                      FROM b_orders WHERE cancelled = false)
        SELECT month, CAST(sum(has) AS BIGINT) AS {counted}, CAST(sum(amount) AS DOUBLE) AS amount_gbp
        FROM kept GROUP BY month"""


# Written from the definitions of the marts: one pass of conditional sums for the money tree,
# distinct product and order pairs for the leaks, cost and stock sums side by side for the margin.
_MART_SQL = {
    "cost_discounts": _monthly_sql("total_discounts", "discounted_orders"),
    "cost_refunds": _monthly_sql("total_refunded", "refunded_orders"),
    "money_summary": f"""
        WITH sums AS (
            SELECT sum(CASE WHEN cancelled THEN 0 ELSE total_price END) AS revenue,
                   sum(CASE WHEN cancelled THEN 0 ELSE total_refunded END) AS refunded,
                   sum(CASE WHEN cancelled THEN 0 ELSE total_discounts END) AS given,
                   sum(CASE WHEN cancelled THEN total_price ELSE 0 END) AS lost,
                   (SELECT sum(unit_cost * inventory_quantity) FROM b_variants) AS stock
            FROM b_orders),
        tree AS (
            SELECT revenue, unnest(['refunds', 'discounts', 'cancelled orders', 'capital in stock']) AS category,
                   unnest([coalesce(refunded, 0), coalesce(given, 0), coalesce(lost, 0), coalesce(stock, 0)]) AS amount
            FROM sums)
        SELECT category, CAST(round(amount, 2) AS DOUBLE) AS amount_gbp,
               {_share_sql("amount", "revenue", 2)} AS pct_of_revenue FROM tree""",
    "product_leaks": f"""
        WITH by_order AS (
            SELECT product, order_id, sum(quantity) AS units, sum(discounted_total) AS net,
                   sum(discount) AS given, sum(original_total) AS gross
            FROM b_items WHERE cancelled = false GROUP BY product, order_id),
        by_product AS (
            SELECT product, count(*) AS orders, CAST(sum(units) AS BIGINT) AS units, sum(net) AS net,
                   sum(given) AS given, sum(gross) AS gross
            FROM by_order GROUP BY product)
        SELECT product, orders, units, CAST(net AS DOUBLE) AS revenue_gbp, CAST(given AS DOUBLE) AS discount_gbp,
               {_share_sql("given", "gross", 1)} AS discount_pct
        FROM by_product""",
    # Costs are means: amounts are compared as multiples of the number of costs.
    "product_margin": f"""
        WITH facts AS (
            SELECT product, quantity AS units, discounted_total AS net, discount AS given,
                   CAST(0 AS DECIMAL(18,4)) AS cost, 0 AS costs, 1 AS sales
            FROM b_items WHERE cancelled = false
            UNION ALL SELECT product, 0, 0, 0, unit_cost, 1, 0 FROM b_variants WHERE unit_cost IS NOT NULL),
        sums AS (
            SELECT product, CAST(sum(units) AS BIGINT) AS units, sum(net) AS net, sum(given) AS given,
                   sum(cost) AS cost, sum(costs) AS n
            FROM facts GROUP BY product HAVING sum(costs) > 0 AND sum(sales) > 0),
        scaled AS (
            SELECT product, units, net, given, n, CAST(net * 100 AS HUGEINT) * n AS sold,
                   CAST(given * 100 AS HUGEINT) * n AS gift, units * CAST(cost * 100 AS HUGEINT) AS cogs FROM sums)
        SELECT product, units, CAST(net AS DOUBLE) AS revenue_gbp,
               {_share_sql("cogs", "n * 10000", 2)} AS cogs_gbp,
               {_share_sql("sold - cogs", "n * 10000", 2)} AS margin_gbp,
               {_share_sql("sold - cogs", "sold", 1)} AS margin_pct, CAST(given AS DOUBLE) AS discount_gbp,
               {_share_sql("gift", "sold - cogs + gift", 1)} AS discount_share_of_potential_margin_pct
        FROM scaled""",
    "stock_capital": """
        SELECT product, variant, inventory_quantity, CAST(unit_cost AS DOUBLE) AS unit_cost,
               CAST(round(unit_cost * inventory_quantity, 2) AS DOUBLE) AS capital_gbp
        FROM b_variants WHERE greatest(inventory_quantity, 0) <> 0""",
}

_MARTS = ",\n".join(
    [_BASE, *[f"{name} AS ({sql})" for name, sql in _MART_SQL.items()]]
)

# Page numbers of the landed chains; page n is asked for with cursor n - 1.
_CHAINS = """
chain AS (
    SELECT DISTINCT 'orders' AS resource, o_orderkey // 50 AS n FROM orders
    UNION ALL SELECT DISTINCT 'products', p_partkey // 100 FROM part),
ends AS (SELECT resource, min(n) AS lo, max(n) AS hi FROM chain GROUP BY resource)"""


def _base(sql: str) -> str:
    return f"WITH {_BASE}\nSELECT * FROM ({sql})"


def _over_marts(sql: str) -> str:
    return f"WITH {_MARTS}\n{sql}"


def _metric_sql(metric: str, mart: str, field: str, dim: str, where: str = "true") -> str:
    return _over_marts(
        f"""SELECT {dim}, CAST(sum(CAST({field} AS DECIMAL(34,4))) AS DOUBLE) AS {metric}
            FROM {mart} WHERE {where} GROUP BY {dim}
            ORDER BY 2 DESC NULLS LAST, 1 ASC NULLS FIRST"""
    )


def _schema_report_sql() -> str:
    spark_types = {"text": "string", "int": "bigint", "numeric": "double"}
    duck_types = {"text": "VARCHAR", "int": "BIGINT", "numeric": "DOUBLE"}
    parts = [
        f"""SELECT '{entity}' AS entity, '{field}' AS field, '{kind}' AS declared_type,
                   '{spark_types[kind]}' AS actual_type,
                   coalesce(bool_and(typeof({field}) = '{duck_types[kind]}'), true) AS type_ok,
                   count(*) FILTER (WHERE {field} IS NULL) AS null_values FROM {entity}"""
        for entity, declared in CONTRACT["entities"].items()
        for field, kind in declared["fields"].items()
    ]
    return _over_marts("\nUNION ALL ".join(parts))


_PHONE_SQL = (
    r"(?:^|[^0-9.]|(?:^|[^0-9])\.)((?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}"
    r"|\+[1-9][0-9]{7,14})\b"
)
_CARD_SQL = (
    r"\b([0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})\b"
)


def _listed(words: list[str]) -> str:
    return "(" + ", ".join(f"'{word}'" for word in words) + ")"


# The tagger's tests of a word w between b and a, the i-th from 1 of n in its run.
_PERSON_TESTS = {
    "any": "true",
    "given": f"lower(rtrim(w, '.')) IN {_listed(person.GIVEN)}",
    "title": f"lower(rtrim(w, '.')) IN {_listed(person.TITLES)}",
    "initial": "regexp_full_match(w, '[A-Z][.]')",
    "ending": f"regexp_matches(w, '{person.ENDING}')",
    "stop": f"lower(rtrim(w, '.')) IN {_listed(person.STOPS)}",
    "capitals": "regexp_full_match(w, '[A-Z]{2,}')",
    "after_title": f"lower(rtrim(b, '.')) IN {_listed(person.TITLES)}",
    "after_given": f"lower(rtrim(b, '.')) IN {_listed(person.GIVEN)}",
    "before_stop": f"lower(rtrim(a, '.')) IN {_listed(person.STOPS)}",
    "cue": f"i = 1 AND b IN {_listed(person.CUES)}",
    "start": "i = 1 AND b = ''",
    "same": "w = b OR w = a",
    "long": "n >= 4",
}
_PERSON_SCORE = " + ".join(
    f"CASE WHEN {test} THEN {person.WEIGHTS[name]} ELSE 0 END" for name, test in _PERSON_TESTS.items()
)
_RUN_SQL = person.RUN.replace("'", "''")
_W = person.WEIGHTS
_PII_SQL = f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS id, text FROM documents),
runs AS (
    SELECT id, unnest(regexp_extract_all(text, '{_RUN_SQL}', 1)) AS before,
           unnest(regexp_extract_all(text, '{_RUN_SQL}', 2)) AS run FROM texts),
split AS (SELECT row_number() OVER () AS r, id, before, string_split(run, ' ') AS words FROM runs),
words AS (SELECT r, before, unnest(words) AS w, generate_subscripts(words, 1) AS i, len(words) AS n FROM split),
around AS (
    SELECT r, i, n, w, coalesce(lag(w) OVER run, before) AS b, coalesce(lead(w) OVER run, '') AS a
    FROM words WINDOW run AS (PARTITION BY r ORDER BY i)),
scored AS (SELECT r, i, {_PERSON_SCORE} AS s FROM around),
-- Best score of each state after i words, and the names on the way to it.
states AS (
    SELECT r, CAST(0 AS BIGINT) AS i, 0 AS other, 0 AS others, -1000000 AS name, 0 AS names FROM split
    UNION ALL
    SELECT r, i, greatest(other, ended), CASE WHEN ended > other THEN names ELSE others END,
           greatest(began, went_on) + s, CASE WHEN went_on > began THEN names ELSE others + 1 END
    FROM (SELECT t.r, x.i, other, others, names, s, other + {_W["other_name"]} AS began,
                 name + {_W["name_name"]} AS went_on, name + {_W["name_other"]} AS ended
          FROM states t JOIN scored x ON x.r = t.r AND x.i = t.i + 1)),
persons AS (
    SELECT id, sum(CASE WHEN name + {_W["name_end"]} > other THEN names ELSE others END) AS persons
    FROM states JOIN split USING (r) WHERE i = len(words) GROUP BY id),
found AS (
    SELECT len(regexp_extract_all(text, '{EMAIL}')) AS emails,
           len(regexp_extract_all(text, '{_PHONE_SQL}', 1)) AS phones,
           len(list_filter(
               list_transform(regexp_extract_all(text, '{_CARD_SQL}', 1),
                              lambda c: reverse(regexp_replace(c, '[ -]', '', 'g'))),
               lambda d: list_sum(list_transform(range(1, length(d) + 1), lambda i:
                   CASE WHEN i % 2 = 1 THEN CAST(substr(d, i, 1) AS INTEGER)
                        ELSE (CAST(substr(d, i, 1) AS INTEGER) * 2) % 10
                             + CAST(substr(d, i, 1) AS INTEGER) // 5 END)) % 10 = 0)) AS cards
    FROM documents)
SELECT 'PERSON' AS pii_type, count(*) FILTER (WHERE persons > 0) AS rows,
       CAST(coalesce(sum(persons), 0) AS BIGINT) AS hits FROM persons
UNION ALL SELECT 'EMAIL_ADDRESS' AS pii_type, count(*) FILTER (WHERE emails > 0) AS rows,
       CAST(coalesce(sum(emails), 0) AS BIGINT) AS hits FROM found
UNION ALL SELECT 'PHONE_NUMBER', count(*) FILTER (WHERE phones > 0),
       CAST(coalesce(sum(phones), 0) AS BIGINT) FROM found
UNION ALL SELECT 'CREDIT_CARD', count(*) FILTER (WHERE cards > 0),
       CAST(coalesce(sum(cards), 0) AS BIGINT) FROM found"""

_ORDER_COLUMNS = """CAST(total_price AS DOUBLE) AS total_price,
    CAST(total_discounts AS DOUBLE) AS total_discounts,
    CAST(total_refunded AS DOUBLE) AS total_refunded,
    CAST(shipping_charged AS DOUBLE) AS shipping_charged FROM b_orders"""
_ITEMS_SQL = _base(
    """SELECT order_id, cancelled, product, quantity, CAST(original_total AS DOUBLE) AS original_total,
       CAST(discounted_total AS DOUBLE) AS discounted_total, CAST(discount AS DOUBLE) AS discount
       FROM b_items"""
)
_VARIANTS_SQL = _base(
    """SELECT product_id, product, status, variant_id, variant, CAST(price AS DOUBLE) AS price,
       CAST(unit_cost AS DOUBLE) AS unit_cost, inventory_quantity FROM b_variants"""
)


def oracle_sql() -> dict[str, str]:
    in_filter = ", ".join(f"'{p}'" for p in FILTERED_PRODUCTS)
    llm = {name: sql for name, (_, sql) in _llm_queries().items() if sql}
    return llm | {
        "stg_orders": _base(
            "SELECT order_id, name, created_at, cancelled, financial_status, " + _ORDER_COLUMNS
        ),
        "stg_order_items": _ITEMS_SQL,
        "stg_variants": _VARIANTS_SQL,
        "kept_orders": _base(
            """SELECT order_id, created_at, CAST(total_price AS DOUBLE) AS total_price
               FROM b_orders WHERE NOT cancelled"""
        ),
        "cancelled_value": _base(
            "SELECT CAST(sum(total_price) AS DOUBLE) AS cancelled_value FROM b_orders WHERE cancelled"
        ),
        "revenue_total": _base(
            "SELECT CAST(sum(total_price) AS DOUBLE) AS revenue FROM b_orders WHERE NOT cancelled"
        ),
        "capital_total": _base(
            "SELECT CAST(sum(inventory_quantity * unit_cost) AS DOUBLE) AS capital FROM b_variants"
        ),
        "product_unit_cost": _base(
            """SELECT product, CAST(sum(unit_cost) AS DOUBLE) / count(unit_cost) AS unit_cost
               FROM b_variants WHERE unit_cost IS NOT NULL GROUP BY product"""
        ),
        **{name: _base(sql) for name, sql in _MART_SQL.items()},
        "money_tree": _over_marts("SELECT * FROM money_summary ORDER BY amount_gbp DESC, category"),
        "top_capital": _over_marts(
            """SELECT product, capital_gbp FROM stock_capital WHERE capital_gbp IS NOT NULL
               ORDER BY capital_gbp DESC, product, variant LIMIT 3"""
        ),
        "top_discounted": _over_marts(
            """SELECT product, revenue_gbp, discount_gbp, discount_pct FROM product_leaks
               WHERE discount_gbp > 0 ORDER BY discount_gbp DESC, product LIMIT 5"""
        ),
        "stock_capital_ranked": _over_marts(
            "SELECT * FROM stock_capital ORDER BY capital_gbp DESC NULLS LAST, product, variant"
        ),
        "flatten_orders": _base(
            """SELECT order_id, name, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
               cancelled, financial_status, """
            + _ORDER_COLUMNS
        ),
        "source_orders": _base(
            """SELECT order_id, name, strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
               cancelled, financial_status, """
            + _ORDER_COLUMNS
        ),
        "flatten_items": _ITEMS_SQL,
        "flatten_variants": _VARIANTS_SQL,
        "item_allocations": _base(
            """SELECT order_id, CAST(original_total AS DOUBLE) AS original_total,
               CAST(CASE WHEN l_linenumber % 2 = 1 THEN original_total ELSE discounted_total END
                    AS DOUBLE) AS net_total,
               CAST(CASE WHEN l_linenumber % 2 = 1 THEN discount ELSE 0 END AS DOUBLE) AS allocated
               FROM b_items"""
        ),
        "item_product_title": _base("SELECT order_id, product FROM b_items"),
        "item_discount": _base(
            """SELECT order_id, CAST(original_total AS DOUBLE) AS original_total,
               CAST(discounted_total AS DOUBLE) AS discounted_total,
               CAST(discount AS DOUBLE) AS discount FROM b_items"""
        ),
        # Links of the landed pages with the planted faults, and the pages that no chain's head leads to.
        "page_chain_gaps": f"""
            WITH RECURSIVE {_CHAINS},
            links AS (
                SELECT resource, CASE WHEN n > lo THEN CAST(n - 1 AS VARCHAR) END AS cursor, n < hi AS more,
                       CAST(n AS VARCHAR) AS "end" FROM chain JOIN ends USING (resource) WHERE n = lo OR n <> 1
                UNION ALL
                SELECT resource, 'ring ' || CAST(n - 1 AS VARCHAR), true,
                       'ring ' || CAST(CASE WHEN n = hi - 1 THEN lo ELSE n END AS VARCHAR)
                FROM chain JOIN ends USING (resource) WHERE n > lo AND n < hi
                UNION ALL
                SELECT resource, 'stray', true, CAST(n AS VARCHAR)
                FROM chain JOIN ends USING (resource) WHERE n = 3 AND n < hi),
            known AS (
                SELECT resource, cursor, sum(asked) AS asked, sum(wanted) AS wanted
                FROM (SELECT resource, cursor, 1 AS asked, 0 AS wanted FROM links
                      UNION ALL SELECT resource, "end", 0, 1 FROM links WHERE more) GROUP BY ALL),
            reached AS (
                SELECT resource, cursor FROM known WHERE wanted = 0 AND asked > 0
                UNION SELECT l.resource, l."end" FROM reached r JOIN links l
                    ON l.resource = r.resource AND l.cursor IS NOT DISTINCT FROM r.cursor WHERE l.more)
            SELECT resource, 'missing page' AS problem, cursor FROM known WHERE asked = 0
            UNION ALL SELECT resource, 'orphan page', cursor FROM known WHERE wanted = 0 AND cursor IS NOT NULL
            UNION ALL SELECT resource, 'cursor handed out twice', cursor FROM known WHERE wanted > 1
            UNION ALL SELECT resource, 'repeated page', cursor FROM known WHERE asked > 1
            UNION ALL SELECT resource, 'no last page', NULL FROM links GROUP BY resource HAVING bool_and(more)
            UNION ALL SELECT resource, 'detached ring', min(cursor) FROM links l
            WHERE NOT EXISTS (SELECT 1 FROM reached r WHERE r.resource = l.resource
                              AND r.cursor IS NOT DISTINCT FROM l.cursor) GROUP BY resource""",
        "cost_discounts_offsets": _base(_MART_SQL["cost_discounts"]),
        # Orders of more than five lines lose their second part; a third is announced by none.
        "line_chain_gaps": """
            SELECT CAST(l_orderkey AS VARCHAR) AS order_id, problem, part
            FROM (SELECT l_orderkey, (count(*) + 4) // 5 AS parts FROM lineitem GROUP BY 1) o
            JOIN (VALUES ('missing lines', 1), ('orphan lines', 2)) p(problem, part) ON part < parts""",
        "page_errors": f"""
            WITH {_CHAINS},
            faults(cursor, problem) AS (VALUES (0, 'errors'), (1, 'unreadable'),
                                               (2, 'broken allocation'), (3, 'no nodes'))
            SELECT resource, CAST(cursor AS VARCHAR) AS request_cursor, problem
            FROM chain JOIN ends USING (resource) JOIN faults ON n - 1 = cursor
            WHERE n > lo AND (problem <> 'broken allocation' OR resource = 'orders' AND EXISTS (
                SELECT 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                WHERE o_orderkey // 50 = n AND l_linenumber % 2 = 1))""",
        "truncation_suspects": f"""
            SELECT 'orders' AS resource, CAST(l_orderkey AS VARCHAR) AS parent_id, count(*) AS children
            FROM lineitem GROUP BY l_orderkey HAVING count(*) = {NESTED_LIMIT}
            UNION ALL
            SELECT 'products', p_brand, count(*) FROM part
            GROUP BY p_partkey // 100, p_brand, p_name HAVING count(*) = {NESTED_LIMIT}""",
        "metric_shop_leaks": _metric_sql("shop_leaks", "money_summary", "amount_gbp", "category"),
        "metric_shop_leaks_total": _over_marts(
            """SELECT CAST(sum(CAST(amount_gbp AS DECIMAL(34,4))) AS DOUBLE) AS shop_leaks
               FROM money_summary"""
        ),
        "metric_discount_by_product": _metric_sql(
            "discount_by_product", "product_leaks", "discount_gbp", "product"
        ),
        "metric_margin_by_product": _metric_sql(
            "margin_by_product", "product_margin", "margin_gbp", "product"
        ),
        "metric_margin_hit": _over_marts(
            """SELECT product,
                      CAST(sum(CAST(discount_share_of_potential_margin_pct AS DECIMAL(34,4))) AS DOUBLE)
                      / count(discount_share_of_potential_margin_pct) AS margin_hit_by_discounts
               FROM product_margin GROUP BY product
               ORDER BY 2 DESC NULLS LAST, 1 ASC NULLS FIRST"""
        ),
        "metric_margin_hit_mean": _over_marts(
            """SELECT CAST(sum(CAST(discount_share_of_potential_margin_pct AS DECIMAL(34,4))) AS DOUBLE)
                      / count(discount_share_of_potential_margin_pct) AS margin_hit_by_discounts
               FROM product_margin"""
        ),
        "metric_capital_in_stock": _metric_sql(
            "capital_in_stock", "stock_capital", "capital_gbp", "product"
        ),
        "metric_discount_filtered": _metric_sql(
            "discount_by_product", "product_leaks", "discount_gbp", "product",
            f"product IN ({in_filter})",
        ),
        "checks_report": _over_marts(
            """SELECT 'margins_exist' AS check, 'product_margin' AS entity, 'row_count_min' AS kind,
                      'error' AS severity, CAST(greatest(1 - count(*), 0) AS BIGINT) AS failing_rows,
                      count(*) >= 1 AS passed FROM product_margin
               UNION ALL
               SELECT 'product_named', 'product_margin', 'not_null', 'error',
                      count(*) FILTER (WHERE product IS NULL),
                      count(*) FILTER (WHERE product IS NULL) = 0 FROM product_margin
               UNION ALL
               SELECT 'margin_pct_sane', 'product_margin', 'range', 'warn',
                      count(*) FILTER (WHERE margin_pct < -100 OR margin_pct > 100),
                      count(*) FILTER (WHERE margin_pct < -100 OR margin_pct > 100) = 0
               FROM product_margin"""
        ),
        "pk_violations": _over_marts(
            "\nUNION ALL ".join(
                f"""SELECT '{entity}' AS entity, {declared['primary_key']} AS key_value,
                           count(*) AS copies FROM {entity} GROUP BY 2 HAVING count(*) > 1"""
                for entity, declared in CONTRACT["entities"].items()
            )
        ),
        "entity_schema_report": _schema_report_sql(),
        "pii_scan_documents": _PII_SQL,
        "raw_roundtrip": _ITEMS_SQL,
        "published_product_leaks": _base(_MART_SQL["product_leaks"]),
        **{f"catalog_{name}": _base(_MART_SQL[name]) for name in catalog.MART_SQL},
        "product_orders_estimate": _base(
            """SELECT product, count(DISTINCT order_id) AS orders, true AS near
               FROM b_items WHERE NOT cancelled GROUP BY product"""
        ),
        "load_counts": _base(
            """SELECT 'orders' AS "table", count(*) AS rows FROM b_orders
               UNION ALL SELECT 'order_items', count(*) FROM b_items
               UNION ALL SELECT 'variants', count(*) FROM b_variants"""
        ),
        "publish_counts": _over_marts(
            "\nUNION ALL ".join(
                f"""SELECT '{name}' AS "table", count(*) AS rows FROM {name}"""
                for name in pipeline.PUBLISHED
            )
        ),
    }

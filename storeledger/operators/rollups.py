"""Exact sums the marts share, so that each staged table is read once for all of them.

A rollup written as a table is small: one row per month and flag, or per product.
Used unwritten, Catalyst drops the sums a mart does not need and pushes its filter
on the flag down to the scan.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kept(rows: DataFrame) -> DataFrame:
    """Rows of orders that stand; a missing flag counts as neither kept nor cancelled."""
    return rows.filter(~F.col("cancelled"))


def order_months(orders: DataFrame) -> DataFrame:
    """Order totals by month of order creation and cancellation flag."""
    month = F.trunc(F.col("created_at").cast("date"), "month").cast("timestamp_ntz")
    return orders.groupBy(month.alias("month"), "cancelled").agg(
        F.sum("total_price").alias("price"),
        F.sum("total_discounts").alias("discounts"),
        F.sum("total_refunded").alias("refunds"),
        F.count_if(F.col("total_discounts") > 0).alias("discounted_orders"),
        F.count_if(F.col("total_refunded") > 0).alias("refunded_orders"),
    )


def product_sums(items: DataFrame) -> DataFrame:
    """Units and amounts of kept lines by product."""
    return (
        kept(items)
        .groupBy("product")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum("original_total").alias("gross"),
            F.sum("discounted_total").alias("net"),
            F.sum("discount").alias("given"),
        )
    )


def product_orders(items: DataFrame) -> DataFrame:
    """Distinct orders with kept lines by product.

    On its own, so that the shuffle by product and order, which summing on the map
    side hardly shrinks, carries keys and no amounts. It spreads the lines of a hot
    product over many tasks.
    """
    return kept(items).groupBy("product").agg(F.count_distinct("order_id").alias("orders"))


# Sketches hold 2**PRECISION registers: some kilobytes each, with a relative error of about 1.6 % (one sigma).
PRECISION = 12


def order_sketches(items: DataFrame, orders: DataFrame, precision: int = PRECISION) -> DataFrame:
    """Mergeable sketches of the distinct orders with kept lines, by product and month of order creation.

    For reports that ask for many ranges of months and can do with an estimate: they merge stored
    sketches of bounded size in place of reading the lines. Lines are sketched on the map side, so the
    shuffle has one sketch for each task, product and month. Lines whose order is missing have no month.
    """
    month = F.trunc(F.col("created_at").cast("date"), "month").cast("timestamp_ntz")
    dated = kept(items).select("product", "order_id").join(orders.select("order_id", month.alias("month")), "order_id", "left")
    return dated.groupBy("product", "month").agg(F.hll_sketch_agg("order_id", precision).alias("sketch"))


def product_orders_estimate(sketches: DataFrame) -> DataFrame:
    """``product_orders`` estimated from the sketches of the months given; the exact count is the default."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy("product").agg(merged.cast("bigint").alias("orders"))


def product_costs(variants: DataFrame) -> DataFrame:
    """Variants with a unit cost by product: sum and number of costs, and stock value."""
    return (
        variants.filter(F.col("unit_cost").isNotNull())
        .groupBy("product")
        .agg(
            F.sum("unit_cost").alias("cost_sum"),
            F.count("unit_cost").alias("cost_count"),
            F.sum(F.col("inventory_quantity") * F.col("unit_cost")).alias("capital"),
        )
    )

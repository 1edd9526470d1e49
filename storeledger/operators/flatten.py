"""Nested order and product pages to the three flat raw tables.

Each table reads only the leaf columns of the archived pages that it uses; landed pages
are parsed in the table's own plan. A page with errors, or one that does
not parse, fails the job; take ``Archive.good()`` to set bad pages aside instead.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger import schemas
from storeledger.functions.money import (
    allocated_total,
    amount_or_null,
    amount_or_zero,
    set_amount,
)
from storeledger.schemas import MONEY, TOTAL
from storeledger.sources.pages import Pages, nodes


def product_title(product: Column, line_title: Column) -> Column:
    """The product's title, or the line's own where that is missing or empty."""
    return F.coalesce(F.nullif(product["title"], F.lit("")), line_title)


def line_discount(original: Column, discounted: Column, allocated: Column) -> Column:
    """The larger of the two discounts a line can show, to the cent.

    A line-level discount shows as the gap between the totals, an order-level one
    as allocations; the two may repeat each other, so they are not added.
    """
    return F.round(F.greatest(original - discounted, allocated), 2)


def flatten_orders(pages: Pages) -> DataFrame:
    o = F.col("node")
    return nodes(pages, ("orders",), schemas.ORDER_HEADS, "orders").select(
        o["id"].alias("order_id"),
        o["name"].alias("name"),
        o["createdAt"].alias("created_at"),
        o["cancelledAt"].isNotNull().alias("cancelled"),
        o["displayFinancialStatus"].alias("financial_status"),
        set_amount(o["totalPriceSet"], TOTAL).alias("total_price"),
        set_amount(o["totalDiscountsSet"], TOTAL).alias("total_discounts"),
        set_amount(o["totalRefundedSet"], TOTAL).alias("total_refunded"),
        set_amount(o["totalShippingPriceSet"], TOTAL).alias("shipping_charged"),
    )


def order_lines(pages: Pages) -> DataFrame:
    """One row per order line with its amounts before the discount rule."""
    lines = nodes(pages, ("orders", "order_lines"), schemas.ORDER_LINES, "orders").select(
        F.col("node.id").alias("order_id"),
        F.col("node.cancelledAt").isNotNull().alias("cancelled"),
        F.explode("node.lineItems.nodes").alias("line"),
    )
    li = F.col("line")
    return lines.select(
        "order_id",
        "cancelled",
        product_title(li["product"], li["title"]).alias("product"),
        li["quantity"].alias("quantity"),
        set_amount(li["originalTotalSet"]).alias("original_total"),
        set_amount(li["discountedTotalSet"]).alias("net_total"),
        allocated_total(li["discountAllocations"]).alias("allocated"),
    )


def flatten_items(pages: Pages) -> DataFrame:
    original = F.col("original_total")
    discount = line_discount(original, F.col("net_total"), F.col("allocated"))
    return (
        order_lines(pages)
        .withColumn("discount", discount.cast(MONEY))
        .select(
            "order_id",
            "cancelled",
            "product",
            "quantity",
            "original_total",
            F.round(original - F.col("discount"), 2).cast(MONEY).alias("discounted_total"),
            "discount",
        )
    )


def flatten_variants(pages: Pages) -> DataFrame:
    p = F.col("node")
    variants = nodes(pages, ("products",), schemas.PRODUCTS, "products").select(
        p["id"].alias("product_id"),
        p["title"].alias("product"),
        p["status"].alias("status"),
        F.explode(p["variants"]["nodes"]).alias("v"),
    )
    return variants.select(
        "product_id",
        "product",
        "status",
        F.col("v.id").alias("variant_id"),
        F.col("v.title").alias("variant"),
        amount_or_zero(F.col("v.price")).alias("price"),
        amount_or_null(F.col("v.inventoryItem.unitCost.amount")).alias("unit_cost"),
        F.coalesce(F.col("v.inventoryQuantity"), F.lit(0).cast("bigint")).alias("inventory_quantity"),
    )

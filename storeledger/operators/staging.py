"""Staging: the columns of each raw table the marts may use, as lazy views."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stg_orders(orders: DataFrame) -> DataFrame:
    """Nine order columns; ``created_at`` becomes the UTC wall clock.

    A text with an offset is taken as the instant it names, so an order placed at
    23:30-05:00 on the last day of a month belongs to the next one.
    """
    created = F.col("created_at")
    if dict(orders.dtypes)["created_at"] != "timestamp_ntz":
        created = created.cast("timestamp").cast("timestamp_ntz")
    return orders.select(
        "order_id",
        "name",
        created.alias("created_at"),
        "cancelled",
        "financial_status",
        "total_price",
        "total_discounts",
        "total_refunded",
        "shipping_charged",
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_id",
        "cancelled",
        "product",
        "quantity",
        "original_total",
        "discounted_total",
        "discount",
    )


def stg_variants(variants: DataFrame) -> DataFrame:
    return variants.select(
        "product_id",
        "product",
        "status",
        "variant_id",
        "variant",
        "price",
        "unit_cost",
        "inventory_quantity",
    )

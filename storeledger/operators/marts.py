"""The six marts over rollups and staged tables.

Marts are unsorted; ``operators.report`` sorts when it reads. Amounts stay exact
decimals through every sum and leave as doubles.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.functions.money import as_double, exact_ratio, percent, rounded
from storeledger.operators.rollups import kept


def cost_discounts(months: DataFrame) -> DataFrame:
    """Discounts by month of order creation."""
    return kept(months).select("month", "discounted_orders", rounded(F.col("discounts")).alias("amount_gbp"))


def cost_refunds(months: DataFrame) -> DataFrame:
    """Refunds by month of order creation (not of the refund)."""
    return kept(months).select("month", "refunded_orders", rounded(F.col("refunds")).alias("amount_gbp"))


def _order_sums(months: DataFrame) -> DataFrame:
    standing, cancelled = ~F.col("cancelled"), F.col("cancelled")

    def total(amount: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(amount)))

    return months.agg(
        total("price", standing).alias("revenue"),
        total("refunds", standing).alias("refunds"),
        total("discounts", standing).alias("discounts"),
        total("price", cancelled).alias("cancelled_value"),
    )


def revenue_total(months: DataFrame) -> DataFrame:
    return _order_sums(months).select(as_double(F.col("revenue")).alias("revenue"))


def cancelled_value(months: DataFrame) -> DataFrame:
    return _order_sums(months).select(as_double(F.col("cancelled_value")).alias("cancelled_value"))


def capital_total(costs: DataFrame) -> DataFrame:
    """Stock value; oversold variants lower it, variants without a cost are left out."""
    return costs.agg(as_double(F.sum("capital")).alias("capital"))


def money_summary(months: DataFrame, costs: DataFrame) -> DataFrame:
    """Where the money goes: always four rows, scaled by the revenue of kept orders.

    The two one-row results are folded into one row and then turned into four; no
    revenue gives a null percentage.
    """
    capital = costs.agg(F.sum("capital").alias("capital"))
    parts = _order_sums(months).unionByName(capital, allowMissingColumns=True)
    sums = parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
    labelled = sums.select(
        "revenue",
        F.stack(
            F.lit(4),
            F.lit("refunds"), F.col("refunds").cast("decimal(38,4)"),
            F.lit("discounts"), F.col("discounts").cast("decimal(38,4)"),
            F.lit("cancelled orders"), F.col("cancelled_value").cast("decimal(38,4)"),
            F.lit("capital in stock"), F.col("capital").cast("decimal(38,4)"),
        ).alias("category", "amount"),
    )
    amount = F.coalesce(F.col("amount"), F.lit(0))
    return labelled.select(
        "category",
        rounded(amount).alias("amount_gbp"),
        percent(amount, F.col("revenue"), 2).alias("pct_of_revenue"),
    )


def product_leaks(sums: DataFrame, orders: DataFrame) -> DataFrame:
    """Per product: orders, units, net revenue, discount and its share of the gross.

    Both sides have one row for every product, a missing title included.
    """
    counted = orders.withColumnRenamed("product", "counted")
    return sums.join(counted, F.col("product").eqNullSafe(F.col("counted"))).select(
        "product",
        "orders",
        "units",
        rounded(F.col("net")).alias("revenue_gbp"),
        rounded(F.col("given")).alias("discount_gbp"),
        percent(F.col("given"), F.col("gross"), 1).alias("discount_pct"),
    )


def product_unit_cost(costs: DataFrame) -> DataFrame:
    """Mean unit cost per product over its variants that have one."""
    mean = as_double(F.col("cost_sum")) / F.col("cost_count")
    return costs.select("product", mean.alias("unit_cost"))


def product_margin(sums: DataFrame, costs: DataFrame) -> DataFrame:
    """Per product with a known cost: revenue, cost of goods, margin, and how much
    of the margin before discounts the discounts used up.

    Both sides are one row per product. Amounts are kept times the number of costs
    until the last division, so the mean cost is never rounded on the way.
    """
    n = F.col("cost_count")
    return (
        sums.join(costs, "product")
        .withColumn("cogs", F.col("units") * F.col("cost_sum"))
        .withColumn("revenue", F.col("net") * n)
        .withColumn("discount", F.col("given") * n)
        .withColumn("margin", F.col("revenue") - F.col("cogs"))
        .select(
            "product",
            "units",
            rounded(F.col("net")).alias("revenue_gbp"),
            exact_ratio(F.col("cogs"), n, 2).alias("cogs_gbp"),
            exact_ratio(F.col("margin"), n, 2).alias("margin_gbp"),
            percent(F.col("margin"), F.col("revenue"), 1).alias("margin_pct"),
            rounded(F.col("given")).alias("discount_gbp"),
            percent(F.col("discount"), F.col("margin") + F.col("discount"), 1).alias(
                "discount_share_of_potential_margin_pct"
            ),
        )
    )


def stock_capital(variants: DataFrame) -> DataFrame:
    """On-hand quantity times unit cost per variant; a missing cost stays visible as null."""
    return variants.filter(F.col("inventory_quantity") > 0).select(
        "product",
        "variant",
        "inventory_quantity",
        as_double(F.col("unit_cost")).alias("unit_cost"),
        rounded(F.col("inventory_quantity") * F.col("unit_cost")).alias("capital_gbp"),
    )

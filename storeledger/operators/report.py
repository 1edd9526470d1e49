"""The report: sorts and top-k over the marts, with ties broken by key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def money_tree(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc_nulls_last("amount_gbp"), "category")


def stock_capital_ranked(stock: DataFrame) -> DataFrame:
    return stock.orderBy(F.desc_nulls_last("capital_gbp"), "product", "variant")


def top_capital(stock: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` variants that tie up most capital."""
    return (
        stock.filter(F.col("capital_gbp").isNotNull())
        .orderBy(F.desc("capital_gbp"), "product", "variant")
        .limit(k)
        .select("product", "capital_gbp")
    )


def top_discounted(leaks: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` products with most discount given away."""
    return (
        leaks.filter(F.col("discount_gbp") > 0)
        .orderBy(F.desc("discount_gbp"), "product")
        .limit(k)
        .select("product", "revenue_gbp", "discount_gbp", "discount_pct")
    )

"""Raw tables and staging views in the session's catalog, and marts as SQL over them.

Tables are replaced whole. Orders and order items are partitioned by their cancellation, on
which most marts filter, so a mart reads the partition of kept rows and no other.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from storeledger import schemas

PARTITIONS = {"orders": ["cancelled"], "order_items": ["cancelled"], "variants": []}

# A staging view's columns that differ from its raw table's.
STAGED = {"stg_orders": {"created_at": "CAST(CAST(created_at AS TIMESTAMP) AS TIMESTAMP_NTZ)"}}


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def save_raw(raw: Mapping[str, DataFrame], database: str) -> None:
    """The raw tables as managed tables of a database, replaced whole."""
    for name, rows in raw.items():
        writer = rows.write.mode("overwrite").format("parquet")
        if PARTITIONS[name]:
            writer = writer.partitionBy(*PARTITIONS[name])
        writer.saveAsTable(f"`{database}`.{name}")


def create_staging_views(spark: SparkSession, database: str) -> None:
    """``stg_*`` views of the database over its raw tables."""
    for name, columns in schemas.RAW_COLUMNS.items():
        view = f"stg_{name}"
        chosen = ", ".join(f"{STAGED.get(view, {}).get(c, c)} AS {c}" for c in columns)
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.{view} AS SELECT {chosen} FROM `{database}`.{name}")


def share(part: str, whole: str, digits: int) -> str:
    """100 * part / whole of exact sums, rounded half away from zero; null over zero."""
    size = f"abs(nullif({whole}, 0))"
    steps = f"((abs({part}) * {200 * 10**digits} + {size}) DIV ({size} * 2))"
    return f"CAST(IF(({part} < 0) = ({whole} < 0), {steps}, -{steps}) / CAST({10**digits} AS DOUBLE) AS DOUBLE)"


# Marts as SQL over the views of a database.
MART_SQL = {
    "cost_discounts": """
        SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP_NTZ) AS month,
               count_if(total_discounts > 0) AS discounted_orders,
               CAST(round(sum(total_discounts), 2) AS DOUBLE) AS amount_gbp
        FROM {db}.stg_orders WHERE NOT cancelled GROUP BY 1""",
    "cost_refunds": """
        SELECT CAST(date_trunc('month', created_at) AS TIMESTAMP_NTZ) AS month,
               count_if(total_refunded > 0) AS refunded_orders,
               CAST(round(sum(total_refunded), 2) AS DOUBLE) AS amount_gbp
        FROM {db}.stg_orders WHERE NOT cancelled GROUP BY 1""",
    "product_leaks": f"""
        SELECT product, count(DISTINCT order_id) AS orders, sum(quantity) AS units,
               CAST(round(sum(discounted_total), 2) AS DOUBLE) AS revenue_gbp,
               CAST(round(sum(discount), 2) AS DOUBLE) AS discount_gbp,
               {share("sum(discount)", "sum(original_total)", 1)} AS discount_pct
        FROM {{db}}.stg_order_items WHERE NOT cancelled GROUP BY product""",
    "stock_capital": """
        SELECT product, variant, inventory_quantity, CAST(unit_cost AS DOUBLE) AS unit_cost,
               CAST(round(inventory_quantity * unit_cost, 2) AS DOUBLE) AS capital_gbp
        FROM {db}.stg_variants WHERE inventory_quantity > 0""",
}


def mart(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A mart by its SQL over the views of a database."""
    return spark.sql(MART_SQL[name].format(db=f"`{database}`"))

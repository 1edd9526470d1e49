"""Tables as parquet folders, rewritten whole on every run, and published ones as versions."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storeledger import schemas
from storeledger.sources.versions import Load, current


def replace_table(rows: DataFrame, root: str, name: str) -> int:
    """Overwrite one table and return its row count, counted while writing."""
    seen = Observation(name)
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
        f"{root}/{name}"
    )
    return seen.get["rows"]


def replace_tables(tables: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    return {name: replace_table(rows, root, name) for name, rows in tables.items()}


def publish_tables(tables: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Write all tables as one new version and make it current.

    Readers keep the former version until then; a run that fails changes nothing for them, and
    of two that run at the same time one is refused.
    """
    step = Load(next(iter(tables.values())).sparkSession, root)
    counts = {name: step.write(name, rows)["rows"] for name, rows in tables.items()}
    step.commit()
    return counts


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the version made current last, of raw tables, rollups, marts or published ones."""
    version = current(spark, root)
    if version is None:
        raise ValueError(f"nothing has been committed to {root}")
    return version.read(name)


def save_tables(tables: Mapping[str, DataFrame], database: str) -> None:
    """The same tables as managed tables of a catalog database."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")


def conform(rows: DataFrame, table: str) -> DataFrame:
    """Columns of a raw table in their declared order and types."""
    fields = schemas.RAW_COLUMNS[table]
    return rows.select(*[F.col(name).cast(dtype).alias(name) for name, dtype in fields.items()])


def read_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The three raw tables with their declared schemas, also where a table is empty."""
    return {
        name: spark.read.schema(schema).parquet(f"{root}/{name}")
        for name, schema in schemas.RAW.items()
    }


def counts_frame(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "table string, rows bigint")

"""Checks the contract declares, key and schema reports, and the scan for personal data."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.functions.pii import DETECTORS
from storeledger.plans.contract import SPARK_TYPES


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _failing(check: Mapping) -> Column:
    if check["kind"] == "row_count_min":
        return F.greatest(F.lit(check["min"]) - F.count(F.lit(1)), F.lit(0))
    field = F.col(check["field"])
    if check["kind"] == "not_null":
        return F.count_if(field.isNull())
    if check["kind"] == "range":
        low, high = check.get("min"), check.get("max")
        outside = F.lit(False)
        if low is not None:
            outside = outside | (field < low)
        if high is not None:
            outside = outside | (field > high)
        return F.count_if(outside)
    raise ValueError(f"unknown check kind {check['kind']!r}")


def run_checks(contract: Mapping, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``check, entity, kind, severity, failing_rows, passed`` for every check.

    All checks of an entity share one aggregate over its rows. Range bounds are
    inclusive and nulls pass them; the severity is ``error`` unless declared. For
    ``row_count_min`` the failing rows are the rows that are missing.
    """
    by_entity: dict[str, dict] = {}
    for name, check in contract["checks"].items():
        by_entity.setdefault(check["entity"], {})[name] = check
    reports = []
    for entity, checks in by_entity.items():
        rows = F.array(
            *[
                F.struct(
                    F.lit(name).alias("check"),
                    F.lit(entity).alias("entity"),
                    F.lit(check["kind"]).alias("kind"),
                    F.lit(check.get("severity", "error")).alias("severity"),
                    _failing(check).cast("bigint").alias("failing_rows"),
                )
                for name, check in checks.items()
            ]
        )
        reports.append(tables[entity].agg(rows.alias("rows")).select(F.inline("rows")))
    return _union(reports).withColumn("passed", F.col("failing_rows") == 0)


CHECK_ROW = "check string, entity string, kind string, severity string, failing_rows bigint, passed boolean"


def check_sums(contract: Mapping, entity: str) -> dict[str, Column]:
    """The failing rows of each of an entity's checks, as aggregates over its rows while they are written."""
    return {
        name: _failing(check).cast("bigint")
        for name, check in contract["checks"].items()
        if check["entity"] == entity
    }


def checks_frame(spark: SparkSession, contract: Mapping, found: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The report of ``run_checks`` from sums observed while the entities were written.

    Checks of entities that were not written have no row.
    """
    rows = []
    for name, check in contract["checks"].items():
        if check["entity"] in found:
            failing = found[check["entity"]][name]
            severity = check.get("severity", "error")
            rows.append((name, check["entity"], check["kind"], severity, failing, failing == 0))
    return spark.createDataFrame(rows, CHECK_ROW)


def pk_violations(contract: Mapping, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Declared keys that occur more than once: ``entity, key_value, copies``."""
    return _union(
        [
            tables[name]
            .groupBy(F.col(entity["primary_key"]).cast("string").alias("key_value"))
            .agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1)
            .select(F.lit(name).alias("entity"), "key_value", "copies")
            for name, entity in contract["entities"].items()
        ]
    )


def entity_schema_report(contract: Mapping, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared field: its type against the table's, and how many values are null.

    A field the table lacks fails and counts every row as null.
    """
    reports = []
    for name, entity in contract["entities"].items():
        actual = dict(tables[name].dtypes)
        rows = F.array(
            *[
                F.struct(
                    F.lit(name).alias("entity"),
                    F.lit(field).alias("field"),
                    F.lit(declared).alias("declared_type"),
                    F.lit(actual.get(field, "missing")).alias("actual_type"),
                    F.lit(actual.get(field) == SPARK_TYPES[declared]).alias("type_ok"),
                    (
                        F.count_if(F.col(field).isNull())
                        if field in actual
                        else F.count(F.lit(1))
                    ).alias("null_values"),
                )
                for field, declared in entity["fields"].items()
            ]
        )
        reports.append(tables[name].agg(rows.alias("rows")).select(F.inline("rows")))
    return _union(reports)


def pii_scan(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows and hits per pattern type over whole texts, in one pass: ``pii_type, rows, hits``."""
    found = rows.select(
        *[
            reduce(Column.__add__, [F.coalesce(detect(F.col(c)), F.lit(0)) for c in columns]).alias(t)
            for t, detect in DETECTORS.items()
        ]
    )
    report = F.array(
        *[
            F.struct(
                F.lit(t).alias("pii_type"),
                F.count_if(F.col(t) > 0).alias("rows"),
                F.coalesce(F.sum(t), F.lit(0)).cast("bigint").alias("hits"),
            )
            for t in DETECTORS
        ]
    )
    return found.agg(report.alias("report")).select(F.inline("report"))

"""Allow-listed metrics over the marts, as the contract declares them."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.functions.pii import checked_types, contains_pii

# Mart amounts have at most two decimals, so this is exact and sums do not
# depend on the order of the rows.
_EXACT = "decimal(34,4)"

_AGGREGATES = {
    "sum": lambda field: F.sum(field.cast(_EXACT)).cast("double"),
    "avg": lambda field: F.sum(field.cast(_EXACT)).cast("double")
    / F.nullif(F.count(field), F.lit(0).cast("bigint")),
}


def _only_allowed(asked, allowed: Sequence[str], what: str, metric: str) -> None:
    refused = sorted(set(asked) - set(allowed))
    if refused:
        raise ValueError(f"metric {metric!r} does not allow {what} {refused}; allowed: {list(allowed)}")


def _matches(field: str, wanted) -> Column:
    values = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
    return F.col(field).isin(values)


def run_metric(
    contract: Mapping,
    tables: Mapping[str, DataFrame],
    name: str,
    dims: Sequence[str] = (),
    filters: Mapping | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """One metric by the given dimensions: the dimensions and a column named like the metric.

    Dimensions and filters outside the allow-lists raise before any plan is
    built. Without dimensions the result is the grand total. The largest values
    come first; every group is returned unless the caller asks for the first
    ``max_rows``. The policy's own figure is only information for a display. A text
    in the result that holds blocked personal data fails the query.
    """
    if name not in contract["metrics"]:
        raise ValueError(f"unknown metric {name!r}")
    metric = contract["metrics"][name]
    filters = dict(filters or {})
    _only_allowed(dims, metric["dimensions_allowed"], "dimensions", name)
    _only_allowed(filters, metric["filters_allowed"], "filters", name)

    rows = tables[metric["entity"]]
    if filters:
        rows = rows.filter(reduce(Column.__and__, [_matches(f, v) for f, v in filters.items()]))
    value = _AGGREGATES[metric["aggregate"]](F.col(metric["field"]))
    result = rows.groupBy(*dims).agg(value.alias(name))
    if not dims:
        return result
    result = result.orderBy(F.desc_nulls_last(name), *[F.asc_nulls_first(d) for d in dims])
    if max_rows is not None:
        result = result.limit(max_rows)
    return guard_pii(result, contract)


def guard_pii(result: DataFrame, contract: Mapping) -> DataFrame:
    """The same rows; a text with personal data the policy blocks raises an error.

    A blocked type without a detector raises at once, unless the policy waives it.
    """
    policy = contract["policy"]
    types = checked_types(policy["block_pii"], policy.get("unchecked_pii", ()))

    def guarded(column: str) -> Column:
        refusal = F.raise_error(F.lit(f"column {column} holds blocked personal data"))
        return F.when(contains_pii(F.col(column), types), refusal).otherwise(F.col(column)).alias(column)

    return result.select(
        *[guarded(c) if dtype == "string" else F.col(c) for c, dtype in result.dtypes]
    )

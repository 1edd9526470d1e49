"""Column expressions for amounts: lenient reads, exact sums, zero-safe ratios."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeledger.schemas import MONEY, TOTAL


def beyond_scale(text: Column) -> Column:
    """Whether an amount has a digit other than 0 after the four decimals that amounts keep.

    Only a text with more than four characters after its first point, or none, or an e is searched.
    """
    long = F.length(text) - F.instr(text, ".") > 4
    return (long | F.contains(F.lower(text), F.lit("e"))) & text.rlike(r"\.[0-9]{4}[0-9]*[1-9]|[0-9.][eE][-+]?[0-9]")


def exact_amount(text: Column, dtype: str = MONEY) -> Column:
    """A numeric text as a decimal; one that would have to be rounded is an error."""
    refused = F.raise_error(F.concat(F.lit("amount beyond the scale: "), text))
    return F.when(beyond_scale(text), refused).otherwise(text).cast(dtype)


def amount_or_null(text: Column) -> Column:
    """A numeric text as an exact amount; null and the empty text give null."""
    return exact_amount(F.nullif(text, F.lit("")))


def amount_or_zero(text: Column, dtype: str = MONEY) -> Column:
    return F.coalesce(exact_amount(F.nullif(text, F.lit("")), dtype), F.lit(0).cast(dtype))


def set_amount(money_set: Column, dtype: str = MONEY) -> Column:
    """Amount of a money set; any missing step on the way counts as zero."""
    return amount_or_zero(money_set["shopMoney"]["amount"], dtype)


def allocation_amounts(allocations: Column) -> Column:
    return F.transform(allocations, lambda a: a["allocatedAmountSet"]["shopMoney"]["amount"])


def allocated_total(allocations: Column) -> Column:
    """Exact sum of a line's allocations; no array gives zero.

    Unlike the other amounts, a step missing inside an allocation is an error.
    """
    amounts = allocation_amounts(allocations)
    total = F.aggregate(
        F.transform(amounts, lambda a: exact_amount(a)),
        F.lit(0).cast(TOTAL),
        lambda acc, a: (acc + a).cast(TOTAL),
    )
    broken = F.exists(amounts, lambda a: a.isNull())
    return F.when(broken, F.raise_error(F.lit("discount allocation without an amount"))).otherwise(
        F.coalesce(total, F.lit(0).cast(TOTAL))
    )


def rounded(exact: Column) -> Column:
    """Round an exact amount half up to the cent, then leave decimals."""
    return F.round(exact, 2).cast("double")


def as_double(exact: Column) -> Column:
    return exact.cast("double")


def exact_ratio(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` of exact numbers, rounded half away from zero as a double.

    Counts whole steps of the last digit with integer division, so a tie is a tie
    whatever the size of the sums; a zero or missing whole gives null.
    """
    size = F.abs(F.nullif(whole, F.lit(0)))
    steps = F.call_function("div", F.abs(part) * (2 * 10**digits) + size, size * 2)
    signed = F.when((part < 0) == (whole < 0), steps).otherwise(-steps)
    return signed / F.lit(10.0**digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return exact_ratio(part * 100, whole, digits)

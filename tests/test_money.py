"""Exact ratios against fractions, line discounts and amounts against plain Python."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from storeledger.functions.money import exact_ratio, percent
from storeledger.operators.flatten import line_discount

cents = st.integers(-(10**15), 10**15)
pairs = st.lists(st.tuples(cents, cents), min_size=1, max_size=60)
once = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def half_up(value: Fraction, digits: int) -> float:
    steps = abs(value) * 10**digits
    whole = (2 * steps.numerator + steps.denominator) // (2 * steps.denominator)
    return (whole if value >= 0 else -whole) / 10.0**digits


def frame_of(spark, rows):
    amounts = [(Decimal(a).scaleb(-2), Decimal(b).scaleb(-2)) for a, b in rows]
    return spark.createDataFrame(amounts, "a decimal(28,4), b decimal(28,4)")


@once
@given(pairs)
def test_ratio(spark, rows):
    rows = rows + [(0, 7), (7, 0), (1, 2), (-1, 2), (5, 1000), (-5, 1000), (15, 1000)]
    got = frame_of(spark, rows).select(
        "a", "b", exact_ratio(F.col("a"), F.col("b"), 2).alias("r"), percent(F.col("a"), F.col("b"), 1).alias("p")
    )
    for row in got.collect():
        if row["b"] == 0:
            assert row["r"] is None and row["p"] is None
        else:
            value = Fraction(row["a"]) / Fraction(row["b"])
            assert row["r"] == half_up(value, 2)
            assert row["p"] == half_up(100 * value, 1)


@once
@given(st.lists(st.tuples(st.integers(0, 10**7), st.integers(0, 10**7), st.integers(0, 10**7)), min_size=1, max_size=40))
def test_line_discount(spark, rows):
    amounts = [tuple(Decimal(v).scaleb(-4) for v in r) for r in rows]
    frame = spark.createDataFrame(amounts, "o decimal(18,4), n decimal(18,4), a decimal(18,4)")
    got = frame.select("o", "n", "a", line_discount(F.col("o"), F.col("n"), F.col("a")).alias("d"))
    for row in got.collect():
        want = max(row["o"] - row["n"], row["a"]).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert row["d"] == want

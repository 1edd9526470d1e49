"""Every registered query against its SQL, over whole tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    for column in frame:
        if frame[column].dtype.kind == "M":
            frame = frame.assign(**{column: frame[column].astype("datetime64[us]")})
    return frame.sort_values(list(frame.columns), na_position="last").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = normal(entry_module.queries()[name](spark, SF_DIR).toPandas())
    want = normal(duck.execute(entry_module.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want, check_exact=True, check_dtype=False)


def test_every_query_has_sql():
    """The training-data queries may have none; their own tests hold them against brute force."""
    own = set(entry_module.queries()) - set(entry_module._llm_queries())
    assert own <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["category", "amount_gbp", "pct_of_revenue"]
    assert result.count() == 4

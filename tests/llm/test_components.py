from storeledger.llm.components import components
from storeledger.llm.support import Scratch


def found(spark, edges):
    frame = spark.createDataFrame(edges, "u long, v long")
    return {r["node"]: r["component"] for r in components(frame, Scratch(spark, "test")).collect()}


def test_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(10, 40)]
    star = [(100, i) for i in range(101, 130)]
    got = found(spark, chain + star + [(7, 7), (3, 2), (2, 3), (2, 3)])
    assert all(got[i] == 10 for i in range(10, 41))
    assert all(got[i] == 100 for i in range(100, 130))
    assert got[2] == got[3] == 2 and 7 not in got


def test_none(spark):
    assert found(spark, []) == {}

"""Hard negatives against a plain search in whole numbers."""

import math
import random

import numpy as np
import pytest

import storeledger.llm.hard_negatives as mining
from storeledger.llm.hard_negatives import Best, hard_negatives
from storeledger.llm.queries import op11_hard_negatives
from storeledger.llm.support import Scratch

SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows, anchors, positives=5, negatives=10, lower=30, upper=90):
    def usable(r):
        return None not in r and all(x is not None and math.isfinite(x) for x in r[2])

    whole = lambda v: [math.floor(256 * x) for x in v]
    def taking_part(rows):
        found = [(i, label, whole(v)) for i, label, v in filter(usable, rows)]
        return [r for r in found if sum(x * x for x in r[2]) < 2**62]

    rows, chosen = taking_part(rows), {}
    for i, label, v in sorted(taking_part(anchors), reverse=True):
        chosen[i] = (label, v)
    out = []
    for i, (label, v) in chosen.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in rows if j != i)
        best = [(j, -s) for s, j, other in scored if other == label][:positives]
        for j, p in best:
            fit = [(k, -s) for s, k, other in scored if other != label and lower * p <= -100 * s <= upper * p]
            out += [(i, j, n, k, p, s) for n, (k, s) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, anchors, more=False, **options):
    frames = [spark.createDataFrame(x, SCHEMA) for x in (rows, anchors)]
    if more:
        frames = [f.selectExpr("*", "'x' AS anchor_id", "1 AS score", "map(1, 2) AS id") for f in frames]
    got = hard_negatives(*frames, Scratch(spark, "test"), **options)
    assert got.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
        ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    return sorted(tuple(r) for r in got.collect())


def drawn(draw, n, labels, values, width=4):
    return [(i, draw.randrange(labels), [draw.choice(values) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("values", [
    [-0.5, 0.0, 0.25, 0.5, 1.0],  # many ties
    [i / 997 - 0.2 for i in range(997)],
    [0.3, 1e4, 2.5e5, 9e5],  # scores beyond 2**53
])
def test_against_plain_search(spark, values):
    draw = random.Random(5)
    rows = drawn(draw, 700, 3, values)
    draw.shuffle(rows)
    anchors = [r for r in rows if r[0] % 50 == 0]
    want = plain(rows, anchors)
    assert want and mined(spark, rows, anchors) == want


def test_options_and_columns_of_the_same_names(spark):
    draw = random.Random(6)
    rows = drawn(draw, 300, 2, [i / 97 for i in range(97)])
    options = {"positives": 2, "negatives": 3, "lower": 50, "upper": 99}
    assert mined(spark, rows, rows[:20], more=True, **options) == plain(rows, rows[:20], **options)


def test_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(mining, "BLOCK_BYTES", 600)
    draw = random.Random(7)
    rows = drawn(draw, 200, 2, [i / 97 for i in range(97)])
    assert mined(spark, rows, rows[::10]) == plain(rows, rows[::10])


def test_edges(spark):
    nan, infinite = float("nan"), float("inf")
    good = [(i, i % 2, [1.0 + i / 64, 0.5]) for i in range(40)]
    odd = [
        (None, 0, [1.0, 1.0]), (100, None, [1.0, 1.0]), (101, 0, None), (102, 1, [1.0, None]), (103, 1, [nan, 1.0]),
        (104, 1, [infinite, 0.0]), (105, 1, [1e300, 1e300]), (106, 1, [1.0]), (107, 1, []), (108, 0, [1.0, 0.5, 9.0]),
        (3, 1, [1.0, 0.25]), (3, 0, [1.0, 0.75]), (5, 1, good[5][2]), (109, 7, [-1.0, -1.0]), (110, 7, [1.0, 1.0]),
    ]
    rows = good + odd
    assert mined(spark, rows, rows) == plain(rows, rows)


def test_one_label_or_one_row(spark):
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])], [(0, 1, [1.0])]) == []
    assert mined(spark, [(0, 1, [1.0])], [(0, 1, [1.0])]) == []


def test_empty_tables(spark):
    assert mined(spark, [], []) == [] == mined(spark, [(0, 1, [1.0])], [])
    assert mined(spark, [], [(0, 1, [1.0])]) == []


def test_equal_vectors(spark):
    """A third of the rows are one vector: ties go to the smaller ids."""
    rows = [(i, i % 3, [0.5, 0.5]) for i in range(400)] + [(1000 + i, 1, [0.4, 0.4 + i / 999]) for i in range(100)]
    assert mined(spark, rows, rows[:30:10]) == plain(rows, rows[:30:10])


def test_combiner_keeps_the_best_of_each_group():
    draw = np.random.default_rng(3)
    best, rows = Best(np.full(4, np.iinfo(np.int64).min), 3), draw.integers(0, [[4], [50], [1000]], (3, 5000))
    for part in np.array_split(rows, 40, axis=1):
        part = part[:, part[1] >= best.least[part[0]]]
        best.add(*part)
        best.settle()
    for group in range(4):
        want = sorted((-s, i) for g, s, i in rows.T.tolist() if g == group)[:3]
        assert [(-s, i) for g, s, i in best.rows.T.tolist() if g == group] == want


@pytest.mark.parametrize("one_in", [1, 2, 5, 10**6])
def test_least_scores_lose_nothing(spark, monkeypatch, one_in):
    """Whatever rows go first, among them all and none."""
    monkeypatch.setattr(mining, "ONE_IN", one_in)
    draw = random.Random(8)
    rows = drawn(draw, 600, 3, [i / 31 - 0.2 for i in range(31)])
    assert mined(spark, rows, rows[::40]) == plain(rows, rows[::40])


def test_query_has_whole_answers(spark):
    got = op11_hard_negatives(spark, "/root/testdata/sf0.001")
    ranks = got.groupBy("anchor_id", "positive_id").agg({"rank": "max", "*": "count"}).collect()
    assert ranks and all(r["max(rank)"] == r["count(1)"] <= 10 for r in ranks)

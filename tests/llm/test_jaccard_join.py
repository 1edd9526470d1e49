"""Similarity join against brute force, and its edge cases."""

import random
import re

import numpy as np
import pytest

from storeledger.llm import jaccard_join as J
from storeledger.llm.support import Scratch, utf8

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, component_id string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = {doc: shingles(text) for doc, text in rows}
    parent = {doc: doc for doc in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {doc: (len(s), find(doc)) for doc, s in sets.items()}


def edited(words, times, rng):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def corpus():
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for size in (5, 6, 7, 9, 12, 18, 30, 60, 130, 400):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [" ".join(edited(base, k, rng)) for k in (0, 0, 1, 1, 2, 3, 5, 8)]
        texts += [" ".join(base[: size - cut]) for cut in (1, 2, size // 6, size // 4)]
    texts += [" ".join([f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 90))] + passage) for _ in range(60)]
    texts += [None, "", " \n\t", "One", "one", "two words", "TWO  words", "a b c d", "a b c d e", "x " * 300, "x " * 9]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.fixture()
def scratch(spark):
    return Scratch(spark, "test")


def run(spark, rows, scratch):
    frame = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA).repartition(7)
    return J.jaccard_join(frame, scratch).collect()


def test_like_brute_force(spark, scratch):
    rows = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in run(spark, rows, scratch)}
    assert got == brute(rows)


def test_every_similar_pair_shares_a_signature():
    rng = np.random.default_rng(1)
    for size in (4, 5, 6, 8, 11, 17, 40, 90, 333, 1000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        for _ in range(20):
            # As far apart as similarity 0.8 allows.
            out = rng.integers(0, len(a) // 5 + 1)
            b = np.sort(np.concatenate([a[out:], rng.integers(0, 2**63, len(a)).astype(np.uint64)])[: len(a)])
            if J.similar(a, b) and len(np.setxor1d(a, b)):
                found = [J.signatures(s, np.array([0, len(s)]), np.array([1]))[0] for s in (a, b)]
                assert len(np.intersect1d(*found)), size


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    for size in (6, 40, 300, 2000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[size // 9 :], rng.integers(0, 2**63, size // 9).astype(np.uint64)]))
        rows = J._folded([J.sketch(a), J.sketch(b)])
        assert np.bitwise_count(rows[0] ^ rows[1]).sum() <= len(np.setxor1d(a, b))


def test_blocks_compare_all(spark, scratch, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 4)
    rows = corpus()
    got = {r["doc_id"]: r["component_id"] for r in run(spark, rows, scratch)}
    assert got == {doc: c for doc, (_, c) in brute(rows).items()}


def test_empty_and_null_ids(spark, scratch):
    assert run(spark, [], scratch) == []
    same = "one two three four five six"
    got = run(spark, [(None, same), (None, same), (4, same), (3, same), (3, same)], scratch)
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 0), (3, 3), (3, 3), (4, 3)]


def test_hashes_do_not_depend_on_neighbours():
    import pyarrow as pa

    texts = ["Aa bb cc dd ee ff", "", "aa BB cc dd ee ff", "x"]
    whole = J.shingle_sets(*utf8(pa.array(texts)))
    assert list(np.diff(whole[1])) == [2, 0, 2, 1]
    assert (whole[0][:2] == whole[0][2:4]).all()
    alone = J.shingle_sets(*utf8(pa.array(texts[2:3])))
    assert (alone[0] == whole[0][2:4]).all()

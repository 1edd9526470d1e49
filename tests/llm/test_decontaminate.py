"""Greedy string tiling against a plain version, and what it flags."""

import random

import numpy as np

from storeledger.llm import decontaminate as D


def plain_tiles(text, item, least):
    """Longest unmarked common passage, again and again, by trying all places."""
    used, done, sizes = [False] * len(text), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (
                    i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n]
                    and not done[i + n] and not used[t + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, t)
        n, i, t = best
        if n < least:
            return sizes
        sizes.append(n)
        done[i : i + n] = [True] * n
        used[t : t + n] = [True] * n


def test_tiles_like_plain_version():
    rng = random.Random(4)
    for _ in range(150):
        letters = rng.choice([2, 4, 20])
        text = [rng.randrange(letters) for _ in range(rng.randrange(0, 40))]
        item = [rng.randrange(letters) for _ in range(rng.randrange(1, 16))]
        hashed = [D.support.mix(np.array(x, np.uint64) + np.uint64(1)) for x in (text, item)]
        got = D.tiles(*hashed, 3)
        for t, i, n in got:
            assert text[t : t + n] == item[i : i + n]
        assert [n for _, _, n in got][:1] == plain_tiles(text, item, 3)[:1]
        covered = [p for _, i, n in got for p in range(i, i + n)]
        assert len(covered) == len(set(covered)) and all(n >= 3 for *_, n in got)


ITEM = " ".join(f"word{i}" for i in range(20))
HALVES = " ".join([f"word{i}" for i in range(10, 20)] + ["between"] * 7 + [f"word{i}" for i in range(10)])
CASES = [
    (1, f"Before it. {ITEM}, and after", True),
    (2, ITEM.upper().replace(" ", " *** "), True),
    (3, HALVES, True),
    (4, " ".join(f"word{i}" for i in range(9)), False),
    (5, " ".join(f"word{i} other" for i in range(20)), False),
    (6, None, False),
    (7, "", False),
    (8, "quite another text of some words", False),
    (9, "x " * 50_000 + ITEM, True),
    (10, "tiny item", True),
]


def frames(spark, cases=CASES):
    docs = spark.createDataFrame([(d, t, 0) for d, t, _ in cases], "doc_id long, text string, item_id int")
    items = [(1, ITEM, 5), (2, None, 5), (3, "", 5), (4, "Tiny item!", 5), (5, ITEM, 5), (None, "null id item of six words", 5)]
    return docs.repartition(3), spark.createDataFrame(items, "item_id long, text string, doc_id long")


def test_what_is_flagged(spark):
    docs, benchmark = frames(spark)
    got = D.contamination(docs, benchmark).collect()
    assert {r["doc_id"] for r in got} == {d for d, _, leaked in CASES if leaked}
    whole = next(r for r in got if r["doc_id"] == 1 and r["item_id"] == 1)
    assert (whole["item_words"], whole["matched_words"], whole["n_tiles"]) == (20, 20, 1)
    halves = next(r for r in got if r["doc_id"] == 3 and r["item_id"] == 5)
    assert (halves["matched_words"], halves["n_tiles"], halves["longest_tile"]) == (20, 2, 10)


def test_kept_documents(spark, monkeypatch):
    docs, benchmark = frames(spark)
    kept = D.without_benchmark(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, leaked in CASES if not leaked}
    monkeypatch.setattr(D, "BLOCK_BYTES", 40)
    assert {r["doc_id"] for r in D.without_benchmark(docs, benchmark).collect()} == {d for d, _, leaked in CASES if not leaked}


def test_empty_tables(spark):
    docs, benchmark = frames(spark)
    assert D.contamination(docs.limit(0), benchmark).count() == 0
    assert D.contamination(docs, benchmark.limit(0)).count() == 0
    assert D.without_benchmark(docs, benchmark.limit(0)).count() == len(CASES)

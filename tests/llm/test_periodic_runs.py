"""Periodic runs against a plain search over all lags, and the query's digests against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from storeledger.llm.periodic_runs import LEAST, periodic_runs, runs
from storeledger.llm.queries import op13_periodic_runs


def plain_runs(words):
    found = {}
    for lag in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - lag:
            j = i
            while j < len(words) - lag and words[j] == words[j + lag]:
                j += 1
            if j - i >= max(lag, LEAST - lag):
                found.setdefault((i, j + lag), lag)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def plain_collapse(words, found):
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def nested(draw):
    words = [0]
    while len(words) < 200:
        words = words * draw.randrange(1, 5) + [draw.randrange(3)] * draw.randrange(3)
    return (words * 2)[: draw.randrange(600)]


def touching(draw):
    unit = [draw.randrange(2) for _ in range(draw.randrange(1, 8))]
    left, right = (unit * 60)[: draw.randrange(20, 120)], (unit * 60)[draw.randrange(len(unit)) :][: draw.randrange(20, 120)]
    return (left + [1] * draw.randrange(2) + right) * draw.randrange(1, 3)


@pytest.mark.parametrize("make", [
    lambda draw: [draw.randrange(2) for _ in range(draw.randrange(150))],
    lambda draw: [w for _ in range(9) for w in [draw.randrange(3) for _ in range(draw.randrange(1, 12))] * draw.randrange(1, 8)],
    lambda draw: fibonacci(400)[draw.randrange(20) : draw.randrange(30, 300)],
    nested,
    touching,
])
def test_all_runs_are_found(make):
    draw = random.Random(11)
    for _ in range(300):
        words = make(draw)
        assert [tuple(r) for r in runs(np.array(words, np.int64)).tolist()] == plain_runs(words), words


def test_work_stays_linear_where_all_repeats():
    assert runs(np.zeros(300_000, np.int64)).tolist() == [[0, 300_000, 1]]
    assert runs(np.tile(np.arange(7), 40_000)).tolist() == [[0, 280_000, 7]]


def rows(spark, texts, more=False):
    data = [(i, t) for i, t in texts]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    return frame.selectExpr("doc_id", "text", "1 AS runs", "map('a', 1) AS n_words") if more else frame


LONG = " ".join(f"w{i}" for i in range(5000))
TEXTS = [
    (1, "a b c " * 5), (1, "a b c " * 5), (2, None), (3, ""), (4, " \t\n"), (None, "x " * 12), (5, "x " * 11),
    (6, f"{LONG} {LONG} {LONG}"), (7, "Ä ä " * 6 + "  " * 12), (8, "A a A A " * 3), (9, "p q r " * 9), (10, "one two"),
]


def test_texts(spark):
    got = periodic_runs(rows(spark, TEXTS, more=True)).collect()
    assert len(got) == len(TEXTS)
    want = []
    for i, text in TEXTS:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = plain_runs(words) if len(words) < 1000 else [(0, 15000, 5000)]
        want.append((i, len(words), found, plain_collapse(words, found)))
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got], key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert periodic_runs(rows(spark, [])).collect() == []


def plain_answer(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    text = "".join(f"{s},{e},{p}\n" for s, e, p in found)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(plain_collapse(words, found).encode()).hexdigest(),
    )


def test_query(spark, tmp_path):
    draw = random.Random(3)
    texts = TEXTS[:5] + TEXTS[6:7] + TEXTS[8:]
    texts += [(i, " ".join(draw.choice(["la", "le", "Lo"]) for _ in range(draw.randrange(160)))) for i in range(100, 400)]
    texts += [(None, "u v w x y z " * 4)]
    rows(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r)[:8] for r in op13_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted([plain_answer(*t) for t in texts], key=key)


def test_query_columns(spark):
    got = op13_periodic_runs(spark, "/root/testdata/sf0.001")
    assert got.dtypes[:8] == [
        ("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"),
        ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string"),
    ]

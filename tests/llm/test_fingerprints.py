"""Fingerprints: plain syncmers, the edit report against a plain version, edge cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from storeledger.llm import fingerprints as P
from storeledger.llm.support import mix, utf8


def test_anchors_are_closed_syncmers():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd é") for _ in range(rng.randrange(0, 90))) for _ in range(40)]
    data, offsets = utf8(pa.array(texts))
    _, at, firsts = P.syncmers(data, offsets)
    for i, text in enumerate(texts):
        raw = text.encode()
        want = []
        for p in range(len(raw) - P.K + 1):
            inner = [raw[p + j : p + j + P.S] for j in range(P.K - P.S + 1)]
            order = mix(np.array([int.from_bytes(x, "little") for x in inner], np.uint64) ^ np.uint64(0xA0761D6478BD642F))
            if order.min() in (order[0], order[-1]):
                want.append(p)
        assert (at[firsts[i] : firsts[i + 1]] - offsets[i]).tolist() == want


def made(rng, size):
    return "".join(rng.choice("abcdefghij ") for _ in range(size))


def test_likeness():
    rng = random.Random(5)
    base, other = made(rng, 4000), made(rng, 4000)
    same, half, apart, none = P.sketches(pa.array([base, base[:2000] + other[:2000], other, ""]))
    assert P.likeness(same, same) == 1 and P.likeness(same, apart) < 0.1
    assert 0.2 < P.likeness(same, half) < 0.5
    assert P.likeness(none, none) == 1 and P.likeness(none, same) == 0
    assert P.text_of(none) == ""


def set_likeness(a, b):
    a, b = set(a.hashes.tolist()), set(b.hashes.tolist())
    return len(a & b) / len(a | b)


def test_position_counts():
    """Passages that change places have the same anchors, but only one of them keeps its place."""
    rng = random.Random(6)
    for size in (200, 2000, 20_000):
        first, second = made(rng, size), made(rng, size)
        a, b = P.sketches(pa.array([first + second, second + first]))
        assert set_likeness(a, b) > 0.8
        assert 0.2 < P.likeness(a, b) < 0.5
        longer, _ = P.sketches(pa.array([first + "x" * 40 + second, ""]))
        assert P.likeness(a, longer) > 0.6


def test_all_of_a_long_text_counts():
    """A change anywhere shows, and what is kept grows with the text."""
    rng = random.Random(7)
    text = made(rng, 100_000)
    a, b, half = P.sketches(pa.array([text, text[:90_000] + made(rng, 10_000), text[:50_000]]))
    assert len(a.hashes) > 1.6 * len(half.hashes) > 500
    assert 0.75 < P.likeness(a, b) < 0.9 and 0.4 < P.likeness(a, half) < 0.6


def test_levels():
    rng = random.Random(8)
    text = made(rng, 60_000)
    found = P.sketches(pa.array([text[:n] for n in (300, 3000, 60_000)]))
    assert [s.level for s in found] == [0, 1, 2]
    (hashes, _, _) = P.syncmers(*utf8(pa.array([text])))
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for sketch, n in zip(found, (300, 3000, 60_000)):
        own = short[: len(P.syncmers(*utf8(pa.array([text[:n]])))[0])]
        assert sketch.hashes.tolist() == [h for h in own.tolist() if h < 2 ** (32 - 2 * sketch.level)]
    assert abs(P.likeness(found[0], found[1]) - 0.1) < 0.1


def plain_chain(a, b):
    """Longest common subsequence of hashes with their numbers, by the table of all prefixes."""
    number = lambda s: [(h, s[:i].count(h)) for i, h in enumerate(s)]
    a, b = number(a), number(b)
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_chain_like_plain_version():
    rng = random.Random(9)
    for _ in range(400):
        a, b = ([rng.randrange(rng.choice([2, 6, 40])) for _ in range(rng.randrange(12))] for _ in range(2))
        assert P.chain(np.array(a, np.uint32), np.array(b, np.uint32)) == plain_chain(a, b)


def report(spark, rows, parts=4):
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fingerprint string")
    return P.likeness_under_edits(frame.repartition(parts)).collect()


def test_edits_like_plain_version(spark):
    rng = random.Random(9)
    rows = [(i * 7 % 501, "".join(rng.choice("ab çé😀\n") for _ in range(rng.choice([0, 1, 3, 4, 5, 30, 300])))) for i in range(501)]
    rows[5] = (rows[5][0], None)
    rows.append((10**12, "long " * 50_000))
    ordered = sorted((d, t or "") for d, t in rows)
    got = {r["doc_id"]: r for r in report(spark, rows)}
    assert len(got) == len(rows)
    for i, (doc, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert got[doc]["n_chars"] == len(text)
        assert got[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, after = P.sketches(pa.array([text, edited, following]))
        assert got[doc]["fingerprint"] == P.text_of(own) and got[doc]["edited_fingerprint"] == P.text_of(changed)
        assert got[doc]["near_edited"] == P.likeness(own, changed) and got[doc]["near_next"] == P.likeness(own, after)


def test_few_rows(spark):
    assert report(spark, []) == []
    (one,) = report(spark, [(3, "abcdefgh")])
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    rows = report(spark, [(1, "same"), (1, "same"), (None, "none"), (None, None)])
    assert sorted(r["n_chars"] for r in rows) == [0, 4, 4, 4]
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 1}) == 1


def test_fingerprints_and_anchors(spark):
    frame = spark.createDataFrame([(1, "t" * 40, 5), (2, None, 5), (3, "short", 5)], "doc_id long, text string, n_anchors int")
    got = {r["doc_id"]: r for r in P.fingerprints(frame).collect()}
    assert got[2]["fingerprint"] == "" and len(got[3]["fingerprint"]) == 9 and got[3]["n_anchors"] == 0
    assert P.anchors(frame).filter("doc_id = 1").count() == got[1]["n_anchors"] == 25

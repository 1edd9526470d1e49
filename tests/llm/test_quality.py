"""Quality score: held-out ranking and accuracy, edge cases."""

import re
import zlib

import numpy as np

from storeledger.llm import quality as Q
from storeledger.llm.queries import op4_quality

SF = "/root/testdata/sf0.01"


def test_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op4_quality(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad).mean() > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93


ROWS = [(1, "Good plain words here."), (2, "BAD!! BAD!! BAD!!"), (3, None), (4, ""), (5, "y" * 100_000), (None, "Fine text.")]


def test_edges(spark):
    docs = spark.createDataFrame([(d, t, 0.1) for d, t in ROWS * 2], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (5, None), (9, 0)], "doc_id long, quality int")
    model = Q.train_quality_model(docs, labels)
    got = Q.score_quality(docs, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    by_doc = {r["doc_id"]: r["score"] for r in rows}
    assert by_doc[1] > 0.5 > by_doc[2] and by_doc[3] == by_doc[4]
    assert Q.score_quality(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        model = Q.train_quality_model(docs, some)
        assert {r["score"] for r in Q.score_quality(docs, model).collect()} == {0.5}


def test_threshold_is_a_quantile():
    rng = np.random.default_rng(2)
    labels = (rng.random(400) < 0.7).astype(int)
    rows = rng.standard_normal((400, 3)) + labels[:, None] * 0.5
    model = Q.train_bradley_terry(rows, labels)
    assert abs(np.mean(model.scores(rows) >= 0.5) - labels.mean()) < 0.01


def test_features_are_a_texts_own():
    import pyarrow as pa

    texts = ["One two.", "", None, "THREE!! four\nfour four", "a"]
    together = Q.features(pa.array(texts))
    for i, text in enumerate(texts):
        assert np.allclose(together[i], Q.features(pa.array([text], pa.string()))[0])


# A plain version of the query: features by counting, the same pairs, and the loss minimised by small steps.

GROUPS = [str.islower, str.isupper, str.isdigit]
MARKS = [".,;:'\"()-", "!?", "#$%&*@^~", "|/\\<>{}[]=+_`", "\n"]


def group(byte):
    c = chr(byte)
    for i, kind in enumerate(GROUPS):
        if byte < 128 and kind(c):
            return i
    for i, marks in enumerate(MARKS, len(GROUPS)):
        if c in marks:
            return i
    return 9 if c == " " else 8


def plain_features(text):
    data = (text or "").encode()
    shares = [sum(group(b) == g for b in data) / max(1, len(data)) for g in range(10)]
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    n, lowered = max(1, len(words)), [w.lower() for w in words]
    pairs = list(zip(lowered, lowered[1:]))
    single = [
        np.log1p(len(words)) / 10,
        sum(map(len, words)) / n / 10,
        len(set(lowered)) / n,
        max(map(lowered.count, lowered), default=0) / n,
        len(set(pairs)) / len(pairs) if pairs else 1,
        sum(4 <= group(w[-1]) <= 6 for w in words) / n,
        sum(len(w) > 1 and group(w[0]) == group(w[1]) == 1 for w in words) / n,
    ]
    base = shares + single
    return [*base, *(x**0.5 for x in base), *(x * x for x in base)]


def plain_scores(docs, labels):
    """docs: id and text; labels: id and label; held-out labels are not learned from."""
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    rows = sorted((i, label, plain_features(t)) for i, t in docs for j, label in labels if i == j and not held(i))
    matrix, kinds = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    mean, scale = matrix.mean(0), matrix.std(0)
    scale[scale <= 1e-9] = 1
    standard = (matrix - mean) / scale
    better, worse = Q.preferences(kinds)
    differences, weights = standard[better] - standard[worse], np.zeros(matrix.shape[1])
    rate = 1 / (np.linalg.eigvalsh(differences.T @ differences / len(differences)).max() / 4 + Q.PENALTY)
    moving = weights
    for i in range(60_000):  # accelerated gradient descent
        gradient = Q.PENALTY * moving - (differences / (1 + np.exp(differences @ moving))[:, None]).mean(0)
        former, weights = weights, moving - rate * gradient
        moving = weights + 0.99 * (weights - former)
        if np.abs(gradient).max() < 1e-9:
            break
    cut = np.quantile(standard @ weights, np.mean(kinds == 0))
    return {i: 1 / (1 + np.exp(cut - (np.array(plain_features(t)) - mean) / scale @ weights)) for i, t in docs}


def test_query_like_plain_version(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 3000").orderBy("doc_id").limit(240)
    docs = [(r["doc_id"], r["text"]) for r in rows.collect()] + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "a " * 999)]
    labels = [(i, int(t is not None and zlib.crc32(t[:9].encode()) % 5 > 1 and "!" not in t)) for i, t in docs[:200]]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["doc_id"]: r for r in op4_quality(spark, str(tmp_path)).collect()}
    want = plain_scores(docs, labels)
    assert len(got) == len(want) == len(docs)
    for i, score in want.items():
        assert abs(got[i]["score"] - score) < 1e-4 and got[i]["predicted"] == (got[i]["score"] >= 0.5)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_all_labelled_rows_are_learned_from(spark):
    """Means, spreads, pairs and the threshold are of every labelled row, also where they are several blocks."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 2000").orderBy("doc_id").limit(300)
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kinds = [(i, int(zlib.crc32((t or "")[:9].encode()) % 5 > 1)) for i, t in texts]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame(kinds, "doc_id long, quality int")
    matrix, quality = np.array([plain_features(t) for _, t in sorted(texts)]), np.array([k for _, k in sorted(kinds)])
    for block in (40, 1000):
        model = Q.train_quality_model(docs, labels, block)
        assert np.allclose(model.mean, matrix.mean(0)) and np.allclose(model.scale[matrix.std(0) > 1e-6], matrix.std(0)[matrix.std(0) > 1e-6])
        assert abs(model.threshold - np.quantile(model.raw(matrix), np.mean(quality == 0))) < 1e-9
        assert (model.weights != 0).any()
    whole = Q.train_bradley_terry(matrix, quality)
    assert np.allclose(model.weights, whole.weights, atol=1e-6)
    counted = []
    pairs = Q._summed
    try:
        Q._summed = lambda blocks, one, fold=np.add: counted.append(found := pairs(blocks, one, fold)) or found
        Q.train_quality_model(docs, labels, 40)
    finally:
        Q._summed = pairs
    # A pair for each row of a block's more frequent label, eight times.
    assert counted[0][0] == 300 and counted[1][0] >= 8 * max(np.sum(quality == 0), np.sum(quality == 1))

"""Operator 4: a quality score learned by Bradley-Terry pairwise ranking.

Every preferred document (label 1) is paired with documents of label 0; the logistic loss of
the pairs' feature differences is minimised by Newton steps. The score of a document is its
weighted feature sum, less a quantile of the training scores: the share of label 0 lies
below it. So a logistic score of 0.5 is the threshold. Features come from the text alone.

Training uses every labelled document. Their features are written once, in blocks of about
BLOCK rows dealt out by a hash of the ids, and pairs are formed within a block; a block without both
labels gives none. Each Newton step sums gradient and curvature over the pairs of all blocks in
tasks that hold one block at a time, means and spreads are those of all rows, and the
threshold is the exact quantile of all their scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm import support
from storeledger.llm.support import Scratch, chunks, spans, utf8, word_hashes

# Labelled rows of a block, about, and pairs that are summed at a time.
BLOCK, PAIRS_AT_ONCE = 4_096, 16_384
# Labels that are sent to the tasks to find their documents; more are joined.
BROADCAST_LABELS = 1_000_000
PAIRS_EACH = 8
PENALTY = 1e-3

# Fixed groups of ASCII characters whose shares of a text are features.
_GROUPS = (
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789",
    ".,;:'\"()-",
    "!?",
    "#$%&*@^~",
    "|/\\<>{}[]=+_`",
    "\n",
)
_GROUP = np.full(256, len(_GROUPS), np.int64)
for _i, _letters in enumerate(_GROUPS):
    _GROUP[list(_letters.encode())] = _i
_GROUP[32] = len(_GROUPS) + 1
_WIDTH = len(_GROUPS) + 2


def _text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for each text."""
    rows = len(offsets) - 1
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    sizes = np.maximum(np.diff(offsets), 1)[:, None]
    shares = np.bincount(owner * _WIDTH + _GROUP[data], minlength=rows * _WIDTH).reshape(rows, _WIDTH) / sizes
    starts, ends, firsts = spans(data, offsets)
    hashes, _ = word_hashes(data, offsets)
    marks = (_GROUP[data[ends - 1]] >= 4) & (_GROUP[data[ends - 1]] <= 6) if len(ends) else np.zeros(0, bool)
    shouted = (_GROUP[data[starts]] == 1) & (_GROUP[data[np.minimum(starts + 1, ends - 1)]] == 1) & (ends > starts + 1)
    single = np.zeros((rows, 7))
    for i, (s, e) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
        n = max(1, e - s)
        _, counts = np.unique(hashes[s:e], return_counts=True)
        pairs = hashes[s : e - 1] * np.uint64(3) + hashes[s + 1 : e]
        runs = np.unique(pairs).size / max(1, len(pairs))
        single[i] = (
            np.log1p(e - s) / 10,
            (ends[s:e] - starts[s:e]).mean() / 10 if e > s else 0,
            len(counts) / n,
            counts.max() / n if e > s else 0,
            runs if len(pairs) else 1,
            marks[s:e].mean() if e > s else 0,
            shouted[s:e].mean() if e > s else 0,
        )
    base = np.hstack([shares, single])
    return np.hstack([base, np.sqrt(base), base * base])


WIDTH = 3 * (_WIDTH + 7)


def features(texts: pa.Array) -> np.ndarray:
    data, offsets = utf8(texts)
    parts = [_text_features(part, part_offsets) for _, _, part, part_offsets in chunks(data, offsets)]
    return np.vstack(parts) if parts else np.zeros((0, WIDTH))


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; 0.5 is the threshold."""
        return 1 / (1 + np.exp(-np.clip(self.raw(rows) - self.threshold, -500, 500)))

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale) @ self.weights


def preferences(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of label 1 and, for each, rows of label 0: the preferred and the other."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    random = np.random.default_rng(4)
    n = PAIRS_EACH * max(len(good), len(bad))
    return good[random.permutation(n) % len(good)], bad[random.permutation(n) % len(bad)]


def train_bradley_terry(rows: np.ndarray, labels: np.ndarray) -> QualityModel:
    """Without labels of both kinds every score is 0.5."""
    width = rows.shape[1]
    mean, scale = (rows.mean(0), rows.std(0)) if len(rows) else (np.zeros(width), np.zeros(width))
    scale = np.where(scale > 1e-9, scale, 1.0)
    better, worse = preferences(labels)
    if not len(better):
        return QualityModel(mean, scale, np.zeros(width), 0.0)
    standard = (rows - mean) / scale
    weights = _newton(width, lambda weights: _pair_sums(standard, better, worse, weights))
    model = QualityModel(mean, scale, weights, 0.0)
    model.threshold = float(np.quantile(model.raw(rows), np.mean(labels == 0)))
    return model


def _pair_sums(standard: np.ndarray, better: np.ndarray, worse: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Over pairs of rows: their number, the gradient and the curvature of the logistic loss, in one array."""
    width = len(weights)
    gradient, curve = np.zeros(width), np.zeros((width, width))
    for at in range(0, len(better), PAIRS_AT_ONCE):
        differences = standard[better[at : at + PAIRS_AT_ONCE]] - standard[worse[at : at + PAIRS_AT_ONCE]]
        chance = 1 / (1 + np.exp(np.clip(differences @ weights, -500, 500)))  # that the worse one wins
        gradient -= differences.T @ chance
        curve += (differences * (chance * (1 - chance))[:, None]).T @ differences
    return np.concatenate([[len(better)], gradient, curve.reshape(-1)])


def _newton(width: int, sums: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The weights of least loss; sums: of ``_pair_sums`` over all pairs, at given weights."""
    weights = np.zeros(width)
    for _ in range(25):
        found = sums(weights)
        if not found[0]:
            break
        gradient = PENALTY * weights + found[1 : width + 1] / found[0]
        curve = found[width + 1 :].reshape(width, width) / found[0]
        step = np.linalg.solve(curve + PENALTY * np.eye(width), gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


# --- training over blocks of labelled rows -------------------------------------------------


def _packed(table: pa.Table) -> pa.Table:
    """A block's rows, in an order of their own, as one row."""
    table = table.sort_by([("doc_id", "ascending"), ("quality", "ascending"), ("features", "ascending")])
    labels = table.column("quality").to_numpy().astype(np.int8)
    rows = b"".join(table.column("features").to_pylist())
    return pa.table({"labels": pa.array([labels.tobytes()], pa.binary()), "rows": pa.array([rows], pa.binary())})


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for labels, rows in zip(batch.column("labels"), batch.column("rows")):
            matrix = np.frombuffer(rows.as_buffer(), np.float64).reshape(-1, WIDTH)
            yield matrix, np.frombuffer(labels.as_buffer(), np.int8)


def _summed(blocks: DataFrame, one: Callable[[np.ndarray, np.ndarray], np.ndarray], fold=np.add) -> np.ndarray | None:
    """An array of each block, folded in the tasks and then in the driver; None without blocks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for rows, labels in _unpacked(batches):
            found = one(rows, labels)
            total = found if total is None else fold(total, found)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["found"])

    total = None
    for row in blocks.mapInArrow(task, "found binary").collect():
        found = np.frombuffer(row["found"], np.float64)
        total = found if total is None else fold(total, found)
    return total


def _moments(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Rows, rows of label 0, means and squared deviations from them."""
    mean = rows.mean(0)
    return np.concatenate([[len(rows), np.sum(labels == 0)], mean, ((rows - mean) ** 2).sum(0)])


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows as those of both."""
    n, apart = a[0] + b[0], b[2 : 2 + WIDTH] - a[2 : 2 + WIDTH]
    mean = a[2 : 2 + WIDTH] + apart * b[0] / n
    spread = a[2 + WIDTH :] + b[2 + WIDTH :] + apart * apart * a[0] * b[0] / n
    return np.concatenate([a[:2] + b[:2], mean, spread])


def _quantile(scores: DataFrame, rows: int, share: float) -> float:
    """The exact quantile of the column `score`, between neighbours in proportion, as numpy has it.

    An approximate quantile on either side brackets it; only the distinct scores between the two, some
    thousandths of the rows, reach the driver.
    """
    around = [max(0.0, share - 0.001 - 2 / rows), min(1.0, share + 0.001 + 2 / rows)]
    low, high = scores.agg(F.percentile_approx("score", around, 10_000)).first()[0]
    below = scores.filter(F.col("score") < low).count()
    inside = scores.filter(F.col("score").between(low, high)).groupBy("score").count().collect()
    values, counts = (np.array(x) for x in zip(*sorted(map(tuple, inside))))
    at = share * (rows - 1)
    last = np.cumsum(counts) + below
    first, then = (values[np.searchsorted(last, place, side="right")] for place in (int(at), min(int(at) + 1, rows - 1)))
    return float(first + (then - first) * (at - int(at)))


def train_quality_model(docs: DataFrame, labels: DataFrame, block: int = BLOCK) -> QualityModel:
    """A model from docs (`doc_id`, `text`) and labels (`doc_id`, `quality` 0 or 1; others are ignored).

    A document labelled more than once counts for each label. Null ids and labels are left out.
    """
    spark = docs.sparkSession
    support.prepare(spark)
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    labels = labels.filter("doc_id is not null and quality in (0, 1)")
    size = labels.count()
    rows = docs.select("doc_id", "text").join(F.broadcast(labels) if size <= BROADCAST_LABELS else labels, "doc_id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([r.tobytes() for r in found], pa.binary())],
                ["doc_id", "quality", "features"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(describe, f"doc_id {id_type}, quality int, features binary")
    number = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(max(1, -(-size // block))))
    blocks = rows.withColumn("block", number).groupBy("block").applyInArrow(_packed, "labels binary, rows binary")
    blocks = Scratch(spark, "quality").write(blocks, "blocks")
    model = QualityModel(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), 0.0)
    found = _summed(blocks, _moments, _merged)
    if found is None:
        return model
    count, zeros = int(found[0]), found[1]
    scale = np.sqrt(found[2 + WIDTH :] / count)
    model.mean, model.scale = found[2 : 2 + WIDTH], np.where(scale > 1e-9, scale, 1.0)
    if zeros in (0, count):
        return model

    def sums(weights: np.ndarray) -> np.ndarray:
        mean, spread = model.mean, model.scale
        return _summed(blocks, lambda rows, kinds: _pair_sums((rows - mean) / spread, *preferences(kinds), weights))

    model.weights = _newton(WIDTH, sums)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for matrix, _ in _unpacked(batches):
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(matrix))], ["score"])

    scores = Scratch(spark, "quality").write(blocks.mapInArrow(score, "score double"), "scores")
    model.threshold = _quantile(scores, count, float(zeros / count))
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of docs, then `score` (0 to 1) and `predicted` (1 if score >= 0.5, else 0).

    docs: `text`; columns named like the new ones are replaced. Null and empty texts have the
    score of a text whose features are all zero. Whole texts count. No rows give none.
    """
    support.prepare(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(features(batch.column(at)))
            columns = [*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(score, support.with_fields(docs.schema, "score double, predicted int"))

"""Operator 8: language identification by sparse multinomial logistic regression.

Features are character 1- to 3-grams of the lower-cased text, hashed into 2**BITS buckets,
valued by relative frequency times inverse document frequency. Document frequencies count all
training documents. Weights are trained by follow-the-regularised-leader (one step size for
each coordinate, an L1 and an L2 penalty) on a bounded sample of SAMPLE_PER_LANGUAGE
documents, about, of each language, chosen by a hash of their ids; a fifth of the sample is
kept back for the temperature by which the scores are calibrated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm import support

BITS = 18
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 1000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
# Relative frequencies are small; in percent, values are near one.
SCALE = 100.0
UNDETERMINED = "und"
_CHUNK_CHARS = 1 << 18
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def buckets(points: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram at each code point but the last order - 1."""
    n = max(0, len(points) - order + 1)
    total = np.full(n, order * 0x27D4EB2F % 2**32, np.uint32)
    for i in range(order):
        total ^= points[i : i + n] * np.uint32(_FACTORS[i])
        total *= np.uint32(0x2C1B3C6D)
        total ^= total >> np.uint32(15)
    return (total * np.uint32(0x297A2D39)) >> np.uint32(32 - BITS)


def _runs(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, code points of the lower-cased texts of a run, and where each begins."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append((text or "").lower())
        size += len(held[-1])
        if size >= _CHUNK_CHARS or i + 1 == len(texts):
            points = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32)
            yield first, points, np.cumsum([0, *map(len, held)])
            first, held, size = i + 1, [], 0


def _profile(points: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and their relative frequencies; place: scratch of 2**BITS."""
    grams = np.concatenate([buckets(points, order) for order in ORDERS])
    at = np.arange(len(grams))
    place[grams] = at
    distinct = grams[place[grams] == at]
    place[distinct] = np.arange(len(distinct))
    return distinct, np.bincount(place[grams], minlength=len(distinct)) / max(1, len(grams))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the partition that have each bucket; bucket -1 counts documents."""
    counts, place, rows = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for _, points, offsets in _runs(batch.column("text").to_pylist()):
            rows += len(offsets) - 1
            for s, e in zip(offsets[:-1], offsets[1:]):
                grams = np.concatenate([buckets(points[s:e], order) for order in ORDERS])
                at = np.arange(len(grams))
                place[grams] = at
                counts[grams[place[grams] == at]] += 1
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1)), pa.array(np.append(counts[used], rows))], ["bucket", "n"]
    )


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        found = []
        for _, points, offsets in _runs(batch.column("text").to_pylist()):
            found += [_profile(points[s:e], place) for s, e in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                batch.column("spot"),
                pa.array([b.astype(np.int32).tobytes() for b, _ in found], pa.binary()),
                pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary()),
            ],
            ["label", "spot", "buckets", "shares"],
        )


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(-1, keepdims=True))
    return powers / powers.sum(-1, keepdims=True)


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and intercepts; rows: buckets, values, class, in the order of training."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for at, values, label in rows:
            at, values = np.append(at, size), np.append(values, 1.0)
            w = weights(at)
            error = softmax(values @ w)
            error[label] -= 1
            gradient = values[:, None] * error
            squared = gradient * gradient
            step = (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * w
            n[at] += squared
    final = weights(slice(None))
    return final[:size], final[size]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits that makes the kept-back labels likeliest."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    losses = [-np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # weight times idf of each bucket
    intercept: np.ndarray
    temperature: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text; the mean over its n-grams, so it does not depend on other texts."""
        found = np.zeros((len(texts), len(self.languages)))
        for first, points, offsets in _runs(texts):
            sizes = np.diff(offsets)
            filled = np.flatnonzero(sizes)
            total = np.zeros((len(sizes), len(self.languages)))
            grams = np.zeros(len(sizes))
            for order in ORDERS:
                rows = self.table[buckets(points, order)]
                if order > 1:  # n-grams that reach into the next text are none
                    ends = offsets[1:-1]
                    for back in range(1, order):
                        cut = ends - back
                        rows[cut[(cut >= 0) & (cut < len(rows))]] = 0
                if len(rows):
                    starts = np.minimum(offsets[:-1][filled], len(rows) - 1)
                    sums = np.add.reduceat(rows, starts, axis=0, dtype=np.float64)
                    long = sizes[filled] >= order
                    total[filled[long]] += sums[long]
                grams += np.maximum(sizes - order + 1, 0)
            found[first : first + len(sizes)] = total / np.maximum(grams, 1)[:, None] + self.intercept
        return found


def train_language_model(labelled: DataFrame, key: str = "doc_id") -> LanguageModel:
    """A model from `text` and non-null `lang`; key: the column by which the sample is chosen."""
    support.prepare(labelled.sparkSession)
    rows = labelled.filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    size = 1 << BITS
    if not languages:
        return LanguageModel([], np.zeros((size, 0), np.float32), np.zeros(0), 1.0)
    seen = rows.select("text").mapInArrow(_frequencies, "bucket long, n long")
    seen = seen.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = int(seen.n[seen.bucket == -1].iloc[0])
    seen = seen[seen.bucket >= 0]
    frequency = np.zeros(size)
    frequency[seen.bucket] = seen.n
    idf = SCALE * (np.log((1 + total) / (1 + frequency)) + 1)

    # A place in [0, 1) for each row; the sample is what lies below its language's share.
    spot = F.pmod(F.xxhash64(F.col(key), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(
        F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, SAMPLE_PER_LANGUAGE / n)]), F.col("lang")
    )
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
    sample = rows.withColumn("spot", spot).filter(F.col("spot") < share)
    sample = sample.select("text", number.cast("int").alias("label"), (F.col("spot") / share).alias("spot"))
    sample = sample.mapInArrow(_profiles, "label int, spot double, buckets binary, shares binary")
    sample = sample.toArrow().sort_by([("spot", "ascending"), ("label", "ascending")])
    cases = []
    for label, at, shares in zip(*(sample.column(c) for c in ("label", "buckets", "shares"))):
        at = np.frombuffer(at.as_buffer(), np.int32)
        cases.append((at, (np.frombuffer(shares.as_buffer(), np.float32) * idf[at]).astype(np.float32), label.as_py()))
    kept, fitted = cases[::5], [c for i, c in enumerate(cases) if i % 5]
    weights, intercept = train_ftrl(fitted or kept, len(languages), size)
    logits = np.array([values @ weights[at] + intercept for at, values, _ in kept]).reshape(-1, len(languages))
    divisor = temperature(logits, np.array([label for _, _, label in kept], int))
    return LanguageModel(languages, (weights * idf[:, None]).astype(np.float32), intercept, divisor)


def identify_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of docs, then `lang_pred` and `score` (its calibrated probability).

    docs: `text`; columns named like the new ones are replaced. A null text, or one without a
    letter, is UNDETERMINED with score 0, as is every text under a model that has seen no
    language. Of equally likely languages the first by name is taken. Whole texts count, in
    bounded steps. No rows give none.
    """
    support.prepare(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if own.languages and texts:
                chances = softmax(own.logits(texts) / own.temperature)
                best = chances.argmax(1)
                for i, text in enumerate(texts):
                    if text and has_letter(text):
                        names[i], scores[i] = own.languages[best[i]], chances[i, best[i]]
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(predict, support.with_fields(docs.schema, "lang_pred string, score double"))

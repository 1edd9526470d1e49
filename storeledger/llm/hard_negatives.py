"""Operator 11: hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label. Each positive asks for the best rows of
other labels whose score lies in a window below the positive's: windows of one anchor overlap. The
windows' upper limits split the scores into disjoint slots, so a score belongs to one slot only:
combiners keep the best few of each slot, first in each task, then for all (Spark's limited
window). A window is the slots from its upper limit down, so the slots' rows in descending order
hold every window as a suffix, cut at its lower limit; the best of each slot are enough for it.

Scores are exact integers. Every anchor meets every row: anchors go to the tasks in blocks of
BLOCK_BYTES, one after the other, each released before the next; of a block the driver holds the
vectors and the positives' scores. Rows are read where they lie and no label, anchor or vector
gathers them, so equal vectors and frequent labels make no task larger.

What is shuffled would be the best few of each slot from every task. So one row in ONE_IN, by a hash, goes
first: the last of the best few among these is a score below which no row of the slot can be needed,
whatever the others hold, and then tasks send what reaches it: about ONE_IN times the best few for each anchor and
slot from all tasks together, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storeledger.llm import support
from storeledger.llm.support import Scratch

SCALE, POSITIVES, NEGATIVES, LOWER, UPPER = 256, 5, 10, 30, 90
BLOCK_BYTES = 8 << 20
# Rows of which one sets the least scores that can be needed.
ONE_IN = 16
# Rows and anchors scored at once, and bytes of rows kept for it.
ROWS, ANCHORS, ROW_BYTES = 4096, 1024, 32 << 20
# Squared length of the longest vector that takes part: every score then fits a long.
LONGEST = 2.0**62

_COLUMNS = ("vec_id", "label", "embedding")


def quantised(ids: pa.Array, labels: pa.Array, vectors: pa.Array, scale: float = SCALE):
    """Ids, labels, integer vectors (as doubles) and their squared lengths, of the rows that take part.

    A shorter vector is filled up with zeros.
    """
    whole = pc.and_(pc.and_(ids.is_valid(), labels.is_valid()), vectors.is_valid())
    vectors = vectors.filter(whole)
    ids, labels = (x.filter(whole).cast(pa.int64()).to_numpy(zero_copy_only=False) for x in (ids, labels))
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0))
    matrix = np.zeros((len(ids), width))
    matrix[np.arange(width) < sizes[:, None]] = values
    with np.errstate(over="ignore", invalid="ignore"):
        matrix = np.floor(matrix * scale)
        squares = (matrix * matrix).sum(axis=1)
    fits = squares < LONGEST  # not so where a component is not finite
    return ids[fits], labels[fits], matrix[fits], squares[fits]


def exact_scores(left: np.ndarray, right: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of all pairs. bound: the product of the longest lengths, which no part of a sum exceeds."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    kind = np.float32 if bound < 2**23 else np.float64 if bound < 2**52 else np.int64
    return left.astype(kind) @ right.astype(kind).T


class Best:
    """The best `most` scores of each group, ties by smaller id, and the least score that still counts.

    least: a score for each group below which none can be needed.
    """

    def __init__(self, least: np.ndarray, most: int):
        self.most, self.least = most, least.copy()
        self.rows = np.zeros((3, 0), np.int64)  # group, score, id
        self.new: list[np.ndarray] = []
        self.waiting = 0

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.new.append(np.stack([group, score, ids]))
        self.waiting += len(group)
        if self.waiting > max(100_000, 2 * self.rows.shape[1]):
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate([self.rows, *self.new], axis=1)
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        rank = np.arange(rows.shape[1]) - first
        self.rows, self.new, self.waiting = rows[:, rank < self.most], [], 0
        last = rows[:, rank == self.most - 1]
        self.least[last[0]] = last[1]
        return self.rows


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows that take part, some thousand at a time, by id; the first chunks are small, to set the limits."""
    held, rows, most = [], 0, 256

    def joined():
        width = max(m.shape[1] for _, _, m, _ in held)
        parts = [np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, _, m, _ in held]
        ids, labels, squares = (np.concatenate([h[i] for h in held]) for i in (0, 1, 3))
        order = np.argsort(ids, kind="stable")
        return ids[order], labels[order], np.concatenate(parts)[order], float(squares.max(initial=0))

    for batch in batches:
        found = quantised(*(batch.column(c) for c in _COLUMNS))
        for at in range(0, len(found[0]), most):
            held.append(tuple(x[at : at + most] for x in found))
            rows += len(held[-1][0])
            if rows >= most or rows * held[-1][2].shape[1] * 8 >= ROW_BYTES:
                yield joined()
                held, rows, most = [], 0, min(2 * most, ROWS)
    if rows:
        yield joined()


def _positives(block, least: np.ndarray, batches: Iterator[pa.RecordBatch], most: int) -> np.ndarray:
    """The task's best rows of each anchor's label: anchor, score, id."""
    anchor_ids, anchor_labels, anchors, longest = block
    best = Best(least, most)
    members = {label: np.flatnonzero(anchor_labels == label) for label in np.unique(anchor_labels).tolist()}
    for ids, labels, matrix, square in _chunks(batches):
        for label in np.unique(labels).tolist():
            own, rows = members.get(label, ()), np.flatnonzero(labels == label)
            for at in range(0, len(own), ANCHORS):
                part = own[at : at + ANCHORS]
                scores = exact_scores(anchors[part], matrix[rows], np.sqrt(longest * square))
                a, r = np.nonzero(scores >= best.least[part, None].astype(scores.dtype))
                kept = anchor_ids[part[a]] != ids[rows[r]]
                a, r = a[kept], r[kept]
                best.add(part[a], scores[a, r].astype(np.int64), ids[rows[r]])
    return best.settle()


def _slots(
    block, limits: np.ndarray, lowest: np.ndarray, least: np.ndarray, batches: Iterator[pa.RecordBatch], most: int
) -> np.ndarray:
    """The task's best rows of other labels in each slot of each anchor: anchor * slots + slot, score, id.

    limits: of each anchor the windows' upper limits, descending; lowest: its windows' least lower limit.
    A score's slot is the last window, from 0, whose upper limit it keeps.
    """
    anchor_ids, anchor_labels, anchors, longest = block
    slots = limits.shape[1]
    best = Best(least, most)
    asked = np.flatnonzero(limits[:, 0] >= lowest)
    last = (limits >= 0).sum(axis=1) - 1
    for ids, labels, matrix, square in _chunks(batches):
        for at in range(0, len(asked), ANCHORS):
            part = asked[at : at + ANCHORS]
            scores = exact_scores(anchors[part], matrix, np.sqrt(longest * square))
            # The last slot has the lowest scores: below its limit none is needed.
            floor = np.maximum(lowest[part], best.least[part * slots + last[part]])
            floor, top = (x[:, None].astype(scores.dtype) for x in (floor, limits[part, 0]))
            a, r = np.nonzero((scores >= floor) & (scores <= top))
            kept = (anchor_labels[part[a]] != labels[r]) & (anchor_ids[part[a]] != ids[r])
            a, r = a[kept], r[kept]
            found = scores[a, r].astype(np.int64)
            slot = (limits[part[a]] >= found[:, None]).sum(axis=1) - 1
            group = part[a] * slots + slot
            kept = found >= best.least[group]
            best.add(group[kept], found[kept], ids[r[kept]])
    return best.settle()


def _blocks(anchors: DataFrame) -> Iterator[tuple]:
    """The anchors in blocks by a hash of their id; an id counts once, with its least label and vector."""
    once = anchors.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").select(*_COLUMNS)
    size = once.agg(F.sum(F.size("embedding") * 8 + 32).alias("size")).first()["size"] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    for number in range(count):
        table = once.filter(F.pmod(F.xxhash64("vec_id"), F.lit(count)) == number).toArrow().combine_chunks()
        ids, labels, matrix, squares = quantised(*(_one(table.column(c)) for c in _COLUMNS))
        order = np.lexsort((*matrix.T[::-1], labels, ids))
        order = order[np.unique(ids[order], return_index=True)[1]]
        if len(order):
            yield ids[order], labels[order], matrix[order], float(squares[order].max())


def _one(column: pa.ChunkedArray) -> pa.Array:
    chunks = column.chunks
    return chunks[0] if len(chunks) == 1 else pa.concat_arrays(chunks) if chunks else pa.array([], column.type)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    scratch: Scratch,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lower: int = LOWER,
    upper: int = UPPER,
) -> DataFrame:
    """Hard negatives of each anchor and positive: `anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`,
    `negative_score`.

    vectors, anchors: `vec_id`, `label` (integers), `embedding` (numbers); other columns are ignored. Components
    x become floor(SCALE * x), a score is an inner product, higher ones come first and ties go to the smaller id.
    An anchor's positives are its first `positives` other rows of the same label; for each of them come the first
    `negatives` rows of another label with lower * positive_score <= 100 * negative_score <= upper * positive_score.
    Positives without such a row, with negative scores above all, give none.

    Rows with a null id, label or vector, with a null or non-finite component, or whose integer vector's squared
    length reaches 2**62, take no part. Of vectors of different length the shorter is filled up with zeros. Other
    rows are those of another id. Rows of a repeated id each take part, so an id may be a positive or a negative
    more than once; a repeated anchor counts once, with its least label and then vector. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    support.prepare(spark)
    rows = vectors.select(*_COLUMNS)
    done = None
    for block in _blocks(anchors):
        part = _mined(rows, block, scratch, positives, negatives, lower, upper)
        done = part if done is None else done.unionByName(part)
    if done is None:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], schema)
    return done


def _mined(rows: DataFrame, block, scratch: Scratch, positives: int, negatives: int, lower: int, upper: int) -> DataFrame:
    """The answers of one block of anchors, written."""
    context = rows.sparkSession.sparkContext
    anchors = context.broadcast(block)
    sent_all = [anchors]
    few = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(ONE_IN)) == 0)
    none, size = np.iinfo(np.int64).min, len(block[0])

    def best_of(frame: DataFrame, scores, groups: int, most: int, least: np.ndarray) -> DataFrame:
        """The best rows of each group, with their place `nth` in it: of each task, then of all."""
        sent = context.broadcast(least)
        sent_all.append(sent)
        slots = groups // size

        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group, score, ids = scores(sent.value, batches)
            columns = [pa.array(x) for x in (anchors.value[0][group // slots], group, score, ids)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor_id", "group", "score", "id"])

        first = W.partitionBy("group").orderBy(F.desc("score"), "id")
        found = frame.mapInArrow(over, "anchor_id long, group long, score long, id long")
        return found.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= most)

    def needed(scores, groups: int, most: int) -> np.ndarray:
        """Of each group the last of the best scores among a few rows, if they are as many: one row of a group at most."""
        least = np.full(groups, none)
        last = best_of(few, scores, groups, most, least).filter(F.col("nth") == most).select("group", "score").toArrow()
        least[last.column("group").to_numpy()] = last.column("score").to_numpy()
        return least

    def near(least: np.ndarray, batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return _positives(anchors.value, least, batches, positives)

    chosen = scratch.write(
        best_of(rows, near, size, positives, needed(near, size, positives)).select(
            "anchor_id", "group", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "positives",
    )
    # Whole numbers n with lower * p <= 100 * n <= upper * p; no window where p is negative.
    least = F.expr(f"positive_score DIV 100 * {lower} + (positive_score % 100 * {lower} + 99) DIV 100")
    most = F.expr(f"positive_score DIV 100 * {upper} + positive_score % 100 * {upper} DIV 100")
    windows = chosen.filter("positive_score >= 0").select("*", least.alias("least"), most.alias("most"))

    limits, lowest = np.full((size, positives), none), np.full(size, np.iinfo(np.int64).max)
    table = windows.select("group", "nth", "least", "most").toArrow()
    at, nth, low, high = (table.column(i).to_numpy().astype(np.int64) for i in range(4))
    limits[at, nth - 1] = high
    np.minimum.at(lowest, at, low)
    bounds = context.broadcast((limits, lowest))
    sent_all.append(bounds)

    def far(least: np.ndarray, batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return _slots(anchors.value, *bounds.value, least, batches, negatives)

    slots = size * positives
    kept = best_of(rows, far, slots, negatives, needed(far, slots, negatives))
    # Of an anchor at most positives * negatives rows: its slots, merged in descending order.
    merged = kept.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "id"))).alias("all"))
    suffix = F.filter("all", lambda r: (-r["down"]).between(F.col("least"), F.col("most")))
    answers = scratch.write(
        windows.join(merged, "anchor_id")
        .select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(suffix, 1, negatives)).alias("at", "n"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("n.id").alias("negative_id"),
            "positive_score",
            (-F.col("n.down")).alias("negative_score"),
        ),
        "negatives",
    )
    for one in sent_all:
        one.destroy()
    return answers

"""Operator 3: document fingerprints from closed syncmers.

A k-mer of K bytes is an anchor if the least of its inner S-byte substrings, by hash, is its
first or its last one: a property of the k-mer alone, so equal passages have equal anchors
wherever they stand. A fingerprint is the text's level and its anchors in text order, 32 bits of
hash each, in hex. Level 0 keeps every anchor; a text of more than FULL anchors has level 1, of more
than 8 * FULL level 2, where those stay whose hash is in the least quarter or sixteenth of all: again
a property of the k-mer, so what is kept grows with the text and two texts keep the same of what they
share. The likeness of two matches their anchors by position: equal anchors, the first with the first and so
on, in the longest chain that ascends in both texts; passages that change places match once only.
It is the chain's share of all anchors of both, those matched counted once, at the
coarser of the two levels. A text without a kept anchor has its own hash as the only one;
the empty text has the empty fingerprint.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm import support
from storeledger.llm.support import chunks, mix, range_hashes, utf8

K, S = 16, 8
# Anchors up to which all are kept.
FULL = 128


def syncmers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and byte position of every anchor, and each text's first anchor (one more entry)."""
    n = len(data)
    if n < K:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, np.zeros(len(offsets), np.int64)
    wide = data.astype(np.uint64)
    for step in (1, 2, 4):  # 1, 2, 4, 8 bytes as one number
        wide = wide[:-step] | (wide[step:] << np.uint64(8 * step))
    order = mix(wide ^ np.uint64(0xA0761D6478BD642F))
    least = order
    for step in (1, 2, 4):
        least = np.minimum(least[:-step], least[step:])
    inner = K - S  # first and last substring are so far apart
    least = np.minimum(least[: len(order) - inner], order[inner:])
    at = np.flatnonzero((least == order[:-inner]) | (least == order[inner:]))
    row = np.searchsorted(offsets, at, "right") - 1
    at = at[at + K <= offsets[row + 1]]
    hashes = mix(wide[at] * np.uint64(0xE7037ED1A0B428DB) + mix(wide[at + inner]))
    return hashes, at, np.searchsorted(at, offsets)


class Sketch(NamedTuple):
    """A text's level and its kept anchors' hashes in text order."""

    level: int
    hashes: np.ndarray

    def at(self, level: int) -> np.ndarray:
        return self.hashes if level == self.level else self.hashes[self.hashes < _limit(level)]


def _limit(level):
    """The least hash that a level does not keep."""
    return np.uint64(1) << (np.uint64(32) - np.uint64(2) * np.asarray(level, np.uint64))


def sketches(texts: pa.Array) -> list[Sketch]:
    """Level and kept anchors of each text."""
    data, offsets = utf8(texts)
    found = []
    for _, _, part, part_offsets in chunks(data, offsets):
        hashes, _, firsts = syncmers(part, part_offsets)
        counts = np.diff(firsts)
        levels = (counts > FULL).astype(np.int64) + (counts > 8 * FULL)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        kept = short < np.repeat(_limit(levels), counts)
        ends = np.concatenate([[0], np.cumsum(kept)])[firsts]
        short = short[kept]
        whole = (_exact_hashes(part, part_offsets) >> np.uint64(32)).astype(np.uint32)
        for i, (s, e) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            if e > s:
                found.append(Sketch(int(levels[i]), short[s:e]))
            else:
                found.append(Sketch(0, whole[i : i + (part_offsets[i + 1] > part_offsets[i])]))
    return found


def _exact_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return range_hashes(data, offsets[:-1], offsets[1:])


def text_of(sketch: Sketch) -> str:
    return f"{sketch.level}{sketch.hashes.astype('>u4').tobytes().hex()}" if len(sketch.hashes) else ""


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Each hash with how many equal ones stand before it, as one number."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    nth = np.empty(len(hashes), np.uint64)
    nth[order] = np.arange(len(hashes)) - np.searchsorted(ranked, ranked)
    return hashes.astype(np.uint64) << np.uint64(32) | nth


def chain(a: np.ndarray, b: np.ndarray) -> int:
    """Most equal hashes, the n-th with the n-th, that can be matched in ascending order of both."""
    _, left, right = np.intersect1d(_numbered(a), _numbered(b), assume_unique=True, return_indices=True)
    places = right[np.argsort(left)]
    if (np.diff(places) > 0).all():
        return len(places)
    tails: list[int] = []
    for place in places.tolist():
        at = bisect_left(tails, place)
        tails[at : at + 1] = [place]
    return len(tails)


def likeness(a: Sketch, b: Sketch) -> float:
    """Anchors matched in position, as a share of all of both; of two empty texts 1."""
    level = max(a.level, b.level)
    left, right = a.at(level), b.at(level)
    if not len(left) and not len(right):
        return float(a.level == b.level and np.array_equal(a.hashes, b.hashes))
    matched = chain(left, right)
    return matched / (len(left) + len(right) - matched)


def fingerprints(docs: DataFrame) -> DataFrame:
    """All columns of docs, then `fingerprint` and `n_anchors`; null text: as empty.

    Columns named like the new ones are replaced. Equal texts have equal fingerprints. Whole
    texts count. No rows give none.
    """
    support.prepare(docs.sparkSession)
    docs = docs.drop("fingerprint", "n_anchors")
    at = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            counts = [np.diff(syncmers(part, o)[2]) for _, _, part, o in chunks(data, offsets)]
            columns = [
                *batch.columns,
                pa.array([text_of(s) for s in sketches(batch.column(at))], pa.string()),
                pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "fingerprint", "n_anchors"])

    return docs.mapInArrow(add, support.with_fields(docs.schema, "fingerprint string, n_anchors long"))


def anchors(docs: DataFrame) -> DataFrame:
    """`doc_id`, `position` (byte), `anchor` (hash) of every closed syncmer, for positional matching."""
    support.prepare(docs.sparkSession)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, end, part, part_offsets in chunks(data, offsets):
                hashes, at, firsts = syncmers(part, part_offsets)
                rows = np.repeat(np.arange(end - first), np.diff(firsts))
                ids = batch.column(0).take(pa.array(first + rows))
                places = pa.array(at - part_offsets[rows])
                yield pa.RecordBatch.from_arrays(
                    [ids, places, pa.array(hashes.view(np.int64))], ["doc_id", "position", "anchor"]
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find, f"doc_id {id_type}, position long, anchor long")


# --- likeness under an edit --------------------------------------------------------------

_EDITS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_EDIT_NAMES = [part.split()[0] for part in _EDITS.split(", ")]
_FIRST = -(1 << 63)


def _deal(batches: Iterator[pa.RecordBatch], bounds: np.ndarray, firsts: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Each row with its part; the first row of a part also as the successor of the part before."""
    for batch in batches:
        keys = np.array([_FIRST if v is None else v for v in batch.column(0).to_pylist()], np.int64)
        parts = np.searchsorted(bounds, keys, "right")
        again = [i for i, key in enumerate(keys.tolist()) if key in firsts]
        at = np.concatenate([np.arange(len(keys)), again]).astype(np.int64)
        after = np.repeat([0, 1], [len(keys), len(again)])
        parts = np.concatenate([parts, [firsts[int(keys[i])] for i in again]]).astype(np.int64)
        rows = batch.take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts), pa.array(after), rows.column(0), rows.column(1)], ["part", "after", "doc_id", "text"]
        )


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by part and doc_id, each part closed by the row that follows its last one."""
    held = None  # the last row: doc_id, text, sketch
    for batch in batches:
        texts = [text or "" for text in batch.column("text").to_pylist()]
        own = sketches(batch.column("text"))
        pairs = []
        for doc, text, after, sketch in zip(
            batch.column("doc_id").to_pylist(), texts, batch.column("after").to_pylist(), own
        ):
            if held is not None:
                pairs.append((*held, text, sketch))
            held = None if after else (doc, text, sketch)
        edited = []
        for _, text, _, following, _ in pairs:
            cut = len(text) // 4
            edited.append(text[: len(text) - cut] + following[:cut])
        changed = sketches(pa.array(edited, pa.string()))
        columns = [
            pa.array([p[0] for p in pairs], pa.int64()),
            pa.array([len(p[1]) for p in pairs], pa.int64()),
            pa.array([hashlib.sha256(text.encode()).hexdigest() for text in edited], pa.string()),
            pa.array([text_of(p[2]) for p in pairs], pa.string()),
            pa.array([text_of(s) for s in changed], pa.string()),
            pa.array([likeness(p[2], s) for p, s in zip(pairs, changed)], pa.float64()),
            pa.array([likeness(p[2], p[4]) for p in pairs], pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, _EDIT_NAMES)


def likeness_under_edits(docs: DataFrame) -> DataFrame:
    """How near each text's fingerprint is to that of an edited copy, and to the next document's.

    docs: `doc_id` (long), `text`; other columns are ignored. The edited text has its last
    floor(n_chars / 4) code points replaced by the first as many of the next document, by
    ascending doc_id; after the last comes the first. Rows of one doc_id follow each other by
    text; a null doc_id comes first; null text is empty. No rows give none.

    Documents are dealt out by ranges of doc_id, so that a text is shuffled once; the first of
    a range also goes to the range before. What reaches the driver is a few ids per range.
    """
    spark = docs.sparkSession
    support.prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 4 * tasks
    key = F.coalesce("doc_id", F.lit(_FIRST))
    cuts = F.percentile_approx(key, [i / parts for i in range(1, parts)], 20 * parts).alias("cuts")
    cuts = docs.agg(cuts).first()["cuts"] or []
    bounds = np.unique(np.array(cuts, np.int64))
    if not len(bounds):
        return spark.createDataFrame([], _EDITS)
    # The first document of each part that has one, in turn, goes to the part before it.
    part = F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b <= F.col("k")))
    heads = docs.select(key.alias("k")).groupBy(part.alias("part")).agg(F.min("k").alias("head"))
    heads = sorted((r["part"], r["head"]) for r in heads.collect())
    firsts = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    dealt = docs.mapInArrow(
        lambda batches: _deal(batches, bounds, firsts), "part long, after long, doc_id long, text string"
    )
    dealt = dealt.repartition(tasks, "part").sortWithinPartitions("part", "after", "doc_id", "text")
    return dealt.mapInArrow(_edits, _EDITS)

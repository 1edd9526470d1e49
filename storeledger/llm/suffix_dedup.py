"""Operator 6: repeated passages by sparse suffix arrays.

Suffixes are kept at positions that the text itself selects: the least of GRAM-word hashes
among WINDOW neighbours. Of a passage of PASSAGE words or more, the first WINDOW hashes select
a position that all its copies have, with at least CORE words of the passage from there on.
Suffixes that begin with equal CORE words make a group. A suffix has a hash for each run of
PASSAGE words that begins with up to WINDOW - 1 words before it and so holds its core; a run that
another suffix of the group has too, as many words before it, occurs again. Overlapping runs of a
document make one span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm import support
from storeledger.llm.support import Scratch, chunks, gram_hashes, mix, utf8, word_hashes

PASSAGE = 50
GRAM, WINDOW = 8, 16
CORE = PASSAGE - WINDOW + 1
# Rows of one suffix start that one key holds; a larger group is dealt out by its runs.
SHARE = 10_000
HELD = 1 << 19
# Rows compared at once, besides those of a key that goes on.
STEP = 1 << 16


def kept_positions(words: np.ndarray) -> np.ndarray:
    """Word positions of a text's kept suffixes."""
    if len(words) < max(CORE, GRAM + WINDOW - 1):
        return np.zeros(0, np.int64)
    grams = gram_hashes(words, GRAM)
    least = np.lib.stride_tricks.sliding_window_view(grams, WINDOW).min(1)
    # A position is kept if it is the least of some window around it.
    around = np.concatenate([np.zeros(WINDOW - 1, np.uint64), least, np.zeros(WINDOW - 1, np.uint64)])
    most = np.lib.stride_tricks.sliding_window_view(around, WINDOW).max(1)
    at = np.flatnonzero(most == grams)
    return at[at + CORE <= len(words)]


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Start hash of every kept suffix; repeats of one within the partition go to keys of their own."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def rows() -> pa.RecordBatch:
        keys, docs, at = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(keys, kind="stable")
        keys, docs, at = keys[order], docs[order], at[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        firsts = np.flatnonzero(new)
        again = np.repeat(np.diff(np.append(firsts, len(keys))) > 1, np.diff(np.append(firsts, len(keys))))
        salt = np.where(new, 0, TaskContext.get().partitionId() + 1).astype(np.int32)
        columns = [keys.view(np.int64), docs, at, again, salt]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc_id", "at", "again", "salt"])

    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        data, offsets = utf8(batch.column("text"))
        for first, _, part, part_offsets in chunks(data, offsets):
            words, firsts = word_hashes(part, part_offsets)
            cores = gram_hashes(words, CORE)
            for i, (s, e) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
                at = kept_positions(words[s:e])
                if len(at):
                    held.append((cores[s + at], np.full(len(at), ids[first + i]), at))
                    size += len(at)
            if size >= HELD:
                yield rows()
                held, size = [], 0
    if held:
        yield rows()


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each suffix, the runs of PASSAGE words around its core: first word of the first, hashes of all."""
    names = ["key", "doc_id", "begin", "stop", "runs"]
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        found = batch.column("found").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        for first, _, part, part_offsets in chunks(data, offsets):
            words, firsts = word_hashes(part, part_offsets)
            rows = []
            for i, (s, e) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
                if e - s < PASSAGE:
                    continue
                cores, runs = gram_hashes(words[s:e], CORE).view(np.int64), gram_hashes(words[s:e], PASSAGE)
                for place in found[first + i]:
                    key, at = place["key"], place["at"]
                    # Rows of one doc_id may have several texts: only the text's own suffixes count.
                    if at < len(cores) and cores[at] == key:
                        begin = max(0, at - WINDOW + 1)
                        own = runs[begin : at + 1]
                        # Equal only with as many words before the suffix.
                        own = own + _BEFORE[at - begin - np.arange(len(own))]
                        rows.append((key, ids[first + i], begin, 0, own.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)


_BEFORE = mix(np.arange(1, WINDOW + 1, dtype=np.uint64))


def _again(runs: np.ndarray) -> np.ndarray:
    """Whether each hash is there more than once."""
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    again = np.zeros(len(runs), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    return again


def _runs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all runs of the rows: number of the row, first word, hash."""
    values = rows.column("runs").combine_chunks()
    values = pa.concat_arrays(values.chunks) if isinstance(values, pa.ChunkedArray) else values
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    runs = np.frombuffer(b"".join(values.to_pylist()), np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(runs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return owner, rows.column("begin").to_numpy()[owner] + place, runs


def _around(owner: np.ndarray, begins: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, begin and stop of the span of each row's runs, which come by row."""
    firsts = np.flatnonzero(np.diff(owner, prepend=-1))
    lasts = np.append(firsts[1:], len(owner))[: len(firsts)] - 1
    return docs[owner[firsts]], begins[firsts], begins[lasts] + PASSAGE


_DEALT = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("begin", pa.int64()), ("stop", pa.int64()), ("runs", pa.binary())])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of small groups, and those of large ones by run in place of by group.

    Repeats within STEP rows of large groups are known here, as spans with a `stop`. Of each run
    one row goes to the run's own key, where it meets those of other rows and partitions.
    """
    held: list[pa.RecordBatch] = []

    def dealt() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        docs = rows.column("doc_id").to_numpy()
        owner, begins, runs = _runs(rows)
        at = np.flatnonzero(_again(runs))
        found = _around(owner[at], begins[at], docs)
        # Keys that spread these rows.
        keys = mix(mix(found[0].astype(np.uint64)) + found[1].astype(np.uint64)).view(np.int64)
        none = pa.array([b""] * len(keys), pa.binary())
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (keys, *found)), none], schema=_DEALT)
        own, at = np.unique(runs, return_index=True)
        columns = [own.view(np.int64), docs[owner[at]], begins[at], np.zeros(len(own), np.int64)]
        offsets = pa.py_buffer(np.arange(0, 8 * len(own) + 1, 8, dtype=np.int32))
        values = pa.Array.from_buffers(pa.binary(), len(own), [None, offsets, pa.py_buffer(own)])
        table = pa.Table.from_arrays([*(pa.array(c) for c in columns), values], schema=_DEALT)
        yield from table.to_batches(max_chunksize=STEP)

    for batch in batches:
        large = batch.column("large")
        small = batch.filter(pc.invert(large))
        if small.num_rows:
            yield small.select(_DEALT.names)
        if small.num_rows < batch.num_rows:
            held.append(batch.filter(large))
            if sum(b.num_rows for b in held) >= STEP:
                yield from dealt()
                held = []
    if held:
        yield from dealt()


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Span of each suffix's repeated runs; rows come by key, and no key has more than a task holds."""
    held: list[pa.RecordBatch] = []

    def spans(rows: pa.Table) -> pa.RecordBatch:
        docs, stops = rows.column("doc_id").to_numpy(), rows.column("stop").to_numpy()
        owner, begins, runs = _runs(rows)
        at, known = np.flatnonzero(_again(runs)), np.flatnonzero(stops)
        found = _around(owner[at], begins[at], docs)
        known = docs[known], rows.column("begin").to_numpy()[known], stops[known]
        columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(found, known)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "begin", "stop"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= STEP:
            rows = pa.Table.from_batches(held)
            keys = rows.column("key").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            if whole:
                yield spans(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
    if held:
        yield spans(pa.Table.from_batches(held))


def repeated_passages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Spans of words that occur again, in the same or another document.

    docs: `doc_id` (long), `text`; other columns are ignored. Words are `[^\\x20\\x09-\\x0D]+`,
    A-Z as a-z. One row for each span of PASSAGE words or more: `doc_id`, `start_word`,
    `n_words`. Every passage of at least PASSAGE words that occurs twice is within a span, and
    spans hold nothing else. Null, empty and short texts have none, as have
    rows without an id. Repeated rows repeat each other. No rows give none.
    """
    support.prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null")
    starts = docs.mapInArrow(_starts, "key long, doc_id long, at long, again boolean, salt int")
    group = Window.partitionBy("key", "salt").orderBy("doc_id", "at")
    starts = starts.withColumn("before", F.lag("at").over(group)).withColumn("after", F.lead("at").over(group))
    repeated = F.col("again") | F.col("before").isNotNull() | F.col("after").isNotNull()
    starts = scratch.write(starts.filter(repeated).select("key", "doc_id", "at"), "starts")
    by_doc = starts.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("key", "at")).alias("found"))
    rows = docs.join(by_doc, "doc_id").mapInArrow(
        _passages, "key long, doc_id long, begin long, stop long, runs binary"
    )
    # Written, so that the few large groups are a side of known size in the join.
    sizes = starts.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > SHARE)
    sizes = scratch.write(sizes, "sizes")
    rows = rows.join(sizes, "key", "left").withColumn("large", F.col("n").isNotNull()).drop("n")
    rows = rows.mapInArrow(_dealt, "key long, doc_id long, begin long, stop long, runs binary")
    rows = rows.repartition("key").sortWithinPartitions("key")
    spans = rows.mapInArrow(_repeats, "doc_id long, begin long, stop long")
    # Overlapping and touching spans of a document are one.
    order = Window.partitionBy("doc_id").orderBy("begin", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", (F.col("begin") > F.coalesce(reach, F.lit(-1))).cast("int"))
    spans = spans.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc_id", "span").agg(F.min("begin").alias("start_word"), F.max("stop").alias("stop"))
    spans = spans.select("doc_id", "start_word", (F.col("stop") - F.col("start_word")).alias("n_words"))
    return spans.filter(F.col("n_words") >= PASSAGE)

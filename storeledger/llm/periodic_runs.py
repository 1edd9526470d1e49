"""Operator 13: runs of words that repeat with a period inside a document.

A run is a stretch of at least LEAST words that repeats with its smallest period at least
twice and that no neighbouring word continues. On the diagonal of lag q (word against the
word q further on) a run of period q is an unbroken match of at least max(q, LEAST - q) words,
which guarantees common k-grams: lags below LEAST share grams of LEAST / 2 words, lags from
k to 2k - 1 grams of k words. For each k, doubling, the grams that a document repeats are
indexed, pairs of their occurrences within 2k words are the seeds, and each seed is extended
both ways along its diagonal; a table of the furthest word covered by each lag suppresses
seeds of a stretch that has been extended before.

Seeds inside a shorter run would be as many as pairs of its repetitions. A k-gram that lies in
a known run of period p <= k/2 is left out: by the periodicity lemma, a longer run all of
whose seeds are such joins two neighbouring runs of period p that touch or overlap by less
than p words, so the lags at which their phases agree are tried in place of the seeds. Other
k-grams occur at most four times within 2k words. The work is the number of words times the
logarithm of the longest text, whatever repeats, and every run is found.

Seeds are met by 64-bit hashes; extension compares words, so a collision costs time only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm import support
from storeledger.llm.support import chunks, mix, powers, spans, utf8, with_fields

LEAST = 12
SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

_BASE = 0xC2B2AE3D27D4EB4F
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Grams:
    """Hashes of the k words from given positions on, for any k."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(words.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n + 1)[:n], out=self.sums[1:])
        self.back = powers(_BASE_INVERSE, n + 1)

    def __call__(self, at: np.ndarray, k: int) -> np.ndarray:
        return (self.sums[at + k] - self.sums[at]) * self.back[at]


def _equal(left: np.ndarray, right: np.ndarray) -> int:
    """How many leading words are equal."""
    done, block, most = 0, 32, min(len(left), len(right))
    while done < most:
        same = left[done : done + block] == right[done : done + block][: most - done]
        if not same.all():
            return done + int(np.argmin(same))
        done, block = done + len(same), block * 2
    return most


def _phase(words: np.ndarray, start: int, end: int, period: int) -> int:
    """Where in the last two periods before `end` the period that begins at `start` occurs, or -1."""
    want, there = words[start : start + period].tobytes(), words[end - 2 * period : end].tobytes()
    size, at = words.itemsize, -1
    while True:
        at = there.find(want, at + 1)
        if at < 0 or at % size == 0:
            return -1 if at < 0 else end - 2 * period + at // size


def runs(words: np.ndarray) -> np.ndarray:
    """Start, length and smallest period of every run, by start, then period.

    words: one integer a word; documents may follow one another where no two share a number.
    """
    n, found, phases = len(words), {}, {}
    grams, k = _Grams(words), LEAST // 2
    active = np.arange(max(n - k + 1, 0))
    while len(active) > 1:
        keys = grams(active, k)
        order = np.argsort(keys, kind="stable")
        at, keys = active[order], keys[order]
        same = keys[1:] == keys[:-1]
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        at, keys = at[again], keys[again]
        if not len(at):
            break
        repeated = np.zeros(n, bool)
        repeated[at] = True
        seeds = []
        if k >= LEAST:
            short = np.array([(s, e, p) for (s, e), p in found.items() if 2 * p <= k], np.int64).reshape(-1, 3)
            inside = np.zeros(n + 1, np.int64)
            wide = short[short[:, 1] - short[:, 0] >= k]
            np.add.at(inside, wide[:, 0], 1)
            np.add.at(inside, wide[:, 1] - k + 1, -1)
            free = np.cumsum(inside)[at] == 0
            at, keys = at[free], keys[free]
            seeds += _joined(words, short, phases, k)
        least, step = (1 if k < LEAST else k), 1
        while step < len(at):
            lags = at[step:] - at[:-step]
            near = (keys[step:] == keys[:-step]) & (lags < 2 * k)
            if not near.any():
                break
            near &= lags >= least
            seeds.append(np.stack([lags[near], at[:-step][near]]))
            step += 1
        _extend(words, seeds, found)
        # A gram of 2k words repeats only where both its halves do.
        starts = np.flatnonzero(repeated)
        starts = starts[starts + 2 * k <= n]
        active, k = starts[repeated[starts + k]], 2 * k
    table = np.array([(s, e - s, p) for (s, e), p in found.items()], np.int64).reshape(-1, 3)
    return table[np.lexsort((table[:, 2], table[:, 0]))]


def _joined(words: np.ndarray, short: np.ndarray, phases: dict, k: int) -> list[np.ndarray]:
    """Seeds of lags k to 2k - 1 at which two touching runs of one period agree in phase."""
    short = short[np.lexsort((short[:, 0], short[:, 2]))]
    first, second = short[:-1], short[1:]
    touch = (first[:, 2] == second[:, 2]) & (second[:, 0] <= first[:, 1]) & (second[:, 1] - first[:, 0] >= 2 * k)
    seeds = []
    for (start, end, period), (next_start, next_end, _) in zip(first[touch].tolist(), second[touch].tolist()):
        if (key := (start, next_start, period)) not in phases:
            phases[key] = _phase(words, next_start, end, period)
        if phases[key] >= 0:
            low = next_start - phases[key]
            low += max(0, -(-(k - low) // period)) * period
            lags = np.arange(low, min(2 * k - 1, (next_end - start) // 2) + 1, period)
            seeds.append(np.stack([lags, np.maximum(start, next_start - lags)]))
    return seeds


def _extend(words: np.ndarray, seeds: list[np.ndarray], found: dict) -> None:
    """Extend the seeds, lags and starts, along their diagonals, and add the runs to `found`.

    found: period by first word and end. Of one stretch the smallest lag is the period.
    """
    if not seeds:
        return
    lags, starts = np.concatenate(seeds, axis=1)
    order = np.lexsort((starts, lags))
    lags, starts = lags[order], starts[order]
    # Seeds one after the other belong to one stretch: its first stands for them.
    head = np.ones(len(lags), bool)
    head[1:] = (lags[1:] != lags[:-1]) | (starts[1:] > starts[:-1] + 1)
    covered: dict[int, int] = {}
    for lag, at in zip(lags[head].tolist(), starts[head].tolist()):
        if at < covered.get(lag, 0):
            continue
        right = at + _equal(words[at : len(words) - lag], words[at + lag :])
        left = at - _equal(words[:at][::-1], words[lag : at + lag][::-1])
        covered[lag] = right
        if right - left >= max(lag, LEAST - lag):
            key = (left, right + lag)
            found[key] = min(lag, found.get(key, lag))


def _word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words, one after the other, as a text column."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letters = data[np.cumsum(inside[:-1]).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    return pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))
    )


def _of_texts(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """The columns of SCHEMA for some texts."""
    starts, ends, firsts = spans(data, offsets)
    column = _word_array(data, starts, ends)
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    codes = column.dictionary_encode()
    numbers = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64) + texts * len(codes.dictionary)
    table = runs(numbers)
    first, length, period = table.T
    owners = np.searchsorted(firsts, first, "right") - 1
    marks = np.zeros(len(starts) + 1, np.int64)
    np.add.at(marks, first + period, 1)
    np.add.at(marks, first + length, -1)
    kept = np.cumsum(marks)[:-1] == 0
    before = np.concatenate([[0], np.cumsum(kept)])[firsts]
    words = pa.ListArray.from_arrays(pa.array(before, pa.int32()), column.filter(pa.array(kept)))
    list_offsets = np.searchsorted(owners, np.arange(len(offsets)))
    members = pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (first - firsts[owners], length, period)], fields=list(_RUN)
    )
    return [
        pa.array(np.diff(firsts), pa.int64()),
        pa.ListArray.from_arrays(pa.array(list_offsets, pa.int32()), members),
        pc.binary_join(words, " "),
    ]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of repeating words of every document: `doc_id`, `n_words`, `runs`, `collapsed`.

    docs: `doc_id`, `text`; other columns are ignored. Words are `[^\\x20\\x09-\\x0D]+`, told apart
    by their bytes. `runs` has start (a word number from 0), length and smallest period of each,
    by start, then period; no two runs of a text have both in common. `collapsed` has the words
    that no run repeats, joined by one space: of each run only the first period stays, unless
    another run repeats it. A null, empty or blank text has no words, no runs and an empty
    `collapsed`. Null ids and repeated rows give a row each; an empty table none. One text is
    one task's work, in memory that grows with its words; texts are never cut.
    """
    support.prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = with_fields(rows.select("doc_id").schema, SCHEMA)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for first, end, part, part_offsets in chunks(data, offsets):
                ids = batch.column("doc_id").slice(first, end - first)
                yield pa.RecordBatch.from_arrays([ids, *_of_texts(part, part_offsets)], schema.names)

    return rows.mapInArrow(over, schema)

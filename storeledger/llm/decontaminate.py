"""Operator 1: benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, lower-cased, so punctuation and markup between them do
not matter. Seeds, MIN_MATCH words shared by a document and a benchmark item, are joined on
their hashes; the benchmark is the smaller side, sent to the tasks in blocks of bounded size.
For each document and item with a seed, tiling repeatedly finds the longest passage that both
have in unmarked words, by Karp-Rabin hashes of one length and a search over lengths, and
marks it on both sides. The tiles' share of the item's words is its coverage, in whatever
order the document has them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm import support
from storeledger.llm.support import PUNCTUATION, Scratch, chunks, gram_hashes, powers, utf8, word_hashes

MIN_MATCH = 5
THRESHOLD = 0.5
# Bytes of benchmark text that a block holds; a single larger item is a block of its own.
BLOCK_BYTES = 16 << 20
_FILTER_BITS = 20

_KEY = 0xD6E8FEB86659FD93
_KEY_INVERSE = pow(_KEY, -1, 2**64)


class Rolling:
    """Karp-Rabin hashes of all passages of one length, for any length."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * powers(_KEY, n + 1)[:n], out=self.sums[1:])
        self.back = powers(_KEY_INVERSE, n + 1)[: n + 1]

    def __call__(self, length: int) -> np.ndarray:
        last = len(self.sums) - length
        return (self.sums[length:] - self.sums[:last]) * self.back[:last]


def _unmarked(marks: np.ndarray, length: int) -> np.ndarray:
    """Whether the `length` words from each on are unmarked."""
    sums = np.concatenate([[0], np.cumsum(marks)])
    return sums[length:] == sums[: len(sums) - length]


def _matches(text: Rolling, item: Rolling, used: np.ndarray, done: np.ndarray, length: int) -> np.ndarray:
    """Item positions of unmarked passages of this length that the text has, unmarked."""
    there = text(length)[_unmarked(used, length)]
    here = item(length)
    return np.flatnonzero(_unmarked(done, length) & np.isin(here, there))


def tiles(text: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: text position, item position and length of each tile, longest first.

    Of equally long matches the first in the item is taken, at its first place in the text.
    """
    text_sums, item_sums = Rolling(text), Rolling(item)
    used, done = np.zeros(len(text), bool), np.zeros(len(item), bool)
    found, longest = [], min(len(text), len(item))
    while longest >= least:
        # A match of some length implies one of every smaller length.
        low, high = least - 1, longest
        while low < high:
            middle = (low + high + 1) // 2
            if len(_matches(text_sums, item_sums, used, done, middle)):
                low = middle
            else:
                high = middle - 1
        longest = low
        if longest < least:
            break
        here, there = item_sums(longest), text_sums(longest)
        for at in _matches(text_sums, item_sums, used, done, longest).tolist():
            if done[at : at + longest].any():
                continue
            places = np.flatnonzero(_unmarked(used, longest) & (there == here[at]))
            if len(places):
                place = int(places[0])
                used[place : place + longest] = True
                done[at : at + longest] = True
                found.append((place, at, longest))
    return found


@dataclass
class Block:
    """Benchmark items and the sorted hashes of their seeds, by seed length."""

    ids: list
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list, least: int) -> Block:
        data, offsets = utf8(pa.array([text for _, text in rows], pa.string()))
        hashes, firsts = word_hashes(data, offsets, PUNCTUATION)
        words = [hashes[s:e] for s, e in zip(firsts[:-1], firsts[1:])]
        by_length: dict[int, list] = {}
        for i, own in enumerate(words):
            if len(own):
                length = min(least, len(own))
                seeds = np.unique(gram_hashes(own, length))
                by_length.setdefault(length, []).append((seeds, np.full(len(seeds), i)))
        table = {}
        for length, parts in by_length.items():
            seeds, owners = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(seeds, kind="stable")
            likely = np.zeros(1 << _FILTER_BITS, bool)
            likely[(seeds >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            table[length] = (seeds[order], owners[order], likely)
        return Block([i for i, _ in rows], words, table)

    def candidates(self, words: np.ndarray, firsts: np.ndarray) -> set[tuple[int, int]]:
        """Row and item of every seed that a row's text and an item share."""
        pairs: set[tuple[int, int]] = set()
        for length, (seeds, owners, likely) in self.seeds.items():
            grams = gram_hashes(words, length)
            at = np.flatnonzero(likely[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            low = np.searchsorted(seeds, grams[at], "left")
            high = np.searchsorted(seeds, grams[at], "right")
            rows = np.searchsorted(firsts, at, "right") - 1
            inside = (high > low) & (at + length <= firsts[rows + 1])
            for row, s, e in zip(rows[inside].tolist(), low[inside].tolist(), high[inside].tolist()):
                pairs.update((row, int(i)) for i in owners[s:e])
        return pairs


def _blocks(benchmark: DataFrame, least: int) -> tuple[int, Iterator[Block]]:
    """How many blocks the benchmark has, by a hash of the item, and the blocks, each made when it is asked for."""
    rows = benchmark.select("item_id", "text").filter("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))

    def made() -> Iterator[Block]:
        for block in range(count):
            part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
            yield Block.of([tuple(r) for r in part.orderBy("item_id", "text").collect()], least)

    return count, made()


def _hits(batch: pa.RecordBatch, block: Block, least: int) -> Iterator[tuple[int, int, list]]:
    """Row, item and tiles of each document and item with a common seed."""
    data, offsets = utf8(batch.column("text"))
    for first, _, part, part_offsets in chunks(data, offsets):
        words, firsts = word_hashes(part, part_offsets, PUNCTUATION)
        for row, i in sorted(block.candidates(words, firsts)):
            item = block.words[i]
            yield first + row, i, tiles(words[firsts[row] : firsts[row + 1]], item, min(least, len(item)))


def contamination(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH
) -> DataFrame:
    """Documents that hold at least `threshold` of a benchmark item's words.

    docs: `doc_id`, `text`; benchmark: `item_id`, `text`; other columns are ignored. One row
    for each document row and item that reach the threshold: `doc_id`, `item_id`,
    `item_words`, `matched_words`, `n_tiles`, `longest_tile`, `coverage`. Items of fewer than
    min_match words must be found whole; null or wordless texts match nothing; null ids are
    kept; repeated rows are reported each; equal items each. Empty tables give no rows.
    """
    spark = docs.sparkSession
    support.prepare(spark)
    rows = docs.select("doc_id", "text")
    id_type, item_type = rows.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = (
        f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, item_words long, "
        "matched_words long, n_tiles long, longest_tile long, coverage double"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def scan(shared):
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                picked, found = [], []
                for row, i, own in _hits(batch, block, min_match):
                    size, matched = len(block.words[i]), sum(t[2] for t in own)
                    if matched >= threshold * size:
                        picked.append(row)
                        found.append((block.ids[i], size, matched, len(own), own[0][2], matched / size))
                if picked:
                    columns = [pa.array(c) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(picked)), *columns], names)

        return over

    count, blocks = _blocks(benchmark, min_match)
    if count == 1:
        return rows.mapInArrow(scan(spark.sparkContext.broadcast(next(blocks))), schema)
    # One block at a time: what it finds is written, and it leaves the driver and the tasks.
    scratch, parts = Scratch(spark, "benchmark"), []
    for block in blocks:
        shared = spark.sparkContext.broadcast(block)
        parts.append(scratch.write(rows.mapInArrow(scan(shared), schema), "block"))
        shared.destroy()
    return reduce(DataFrame.unionByName, parts)


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_match: int = MIN_MATCH
) -> DataFrame:
    """The documents (all their columns) that hold less than `threshold` of every benchmark item.

    Same rules as `contamination`; documents without text or words are kept.
    """
    spark = docs.sparkSession
    support.prepare(spark)

    def scan(shared):
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, i, own in _hits(batch, block, min_match):
                    keep[row] &= sum(t[2] for t in own) < threshold * len(block.words[i])
                yield batch.filter(pa.array(keep))

        return over

    count, blocks = _blocks(benchmark, min_match)
    if count == 1:
        return docs.mapInArrow(scan(spark.sparkContext.broadcast(next(blocks))), docs.schema)
    scratch = Scratch(spark, "benchmark")
    for block in blocks:
        shared = spark.sparkContext.broadcast(block)
        docs = scratch.write(docs.mapInArrow(scan(shared), docs.schema), "block")
        shared.destroy()
    return docs

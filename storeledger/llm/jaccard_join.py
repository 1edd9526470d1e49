"""Operator 2: similarity join of word-shingle sets by PartEnum signatures.

Two sets of a and b elements with Jaccard similarity of at least 4/5 differ in at most
k(a + b) = (a + b) - 2 * ceil(4 * (a + b) / 9) elements. Size bands overlap so that any two
sets which can be similar meet in one of them, with one bound k for the band. The domain of
shingle hashes is partitioned by a hash; a partition of a set has as signature the sum of
its mixed hashes. Of n partitions at most k differ, so two similar sets share a signature;
single partitions are the subsets enumerated. A signature of an empty partition says
nothing: none is made. A set with more than k filled partitions surely shares a filled one
with any similar set. Others (few: n is chosen so) also emit the signatures of a further
family of partitions, and so on until more than k of one family are filled; for two similar
sets the first family that suffices for either is emitted by both.

Sets are distinct sets, known by a 64-bit digest; documents with equal sets are one. Before
sets are moved to be compared, pairs are held against sketches: bit b is the parity of the
count of elements whose hash ends in b. An element in one of two sets only flips one bit, so
the bits in which two sketches differ bound the sets' difference from below, and only pairs
that are surely not similar are put aside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storeledger.llm import support
from storeledger.llm.components import components
from storeledger.llm.support import Scratch, chunks, gram_hashes, mix, utf8, word_hashes

SHINGLE_WORDS = 5
# Sizes of a band: the smaller set of a pair lies between one border and GROWTH times it.
GROWTH = 1.3
# Signatures held back to find repeated ones before they are shuffled.
HELD = 1 << 19
# Sets of one signature that one key compares with each other, or with so many others; a
# larger group is compared block by block.
BLOCK = 1024
# Least hashes of its open signatures that a set brings along, so that most pairs are held
# against each other in one of the groups they share.
FIRSTS = 8
# Documents whose ids are broadcast to pick their texts; beyond, texts are joined.
BROADCAST_IDS = 1_000_000
# A sketch has a power of two of bits: 2 to 4 for each element, within these bounds.
SKETCH_LEAST, SKETCH_MOST = 64, 1 << 16


def difference_bound(total: int) -> int:
    """Most elements in which two sets of `total` elements together differ at similarity 0.8."""
    return total - 2 * -(-4 * total // 9)


def _bands(largest: int) -> list[tuple[int, int, int, int, int]]:
    """Least size, greatest size of the smaller and of the larger set, k, partitions."""
    bands, low = [], 1
    while low <= largest:
        high = max(low, math.ceil(low * GROWTH) - 1)
        top = high * 5 // 4
        k = max(difference_bound(total) for total in range(max(2, high + top - 9), high + top + 1))
        n = k + 1
        while k and n * (1 - (1 - 1 / n) ** low) < k + 1.5 and n < 8 * low:
            n += 1
        bands.append((low, high, top, k, n))
        low = high + 1
    return bands


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one after the other; and their offsets."""
    words, firsts = word_hashes(data, offsets)
    grams = gram_hashes(words, SHINGLE_WORDS)
    sets, counts = [], np.zeros(len(offsets), np.int64)
    for i, (s, e) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
        if e - s >= SHINGLE_WORDS:
            own = np.sort(grams[s : e - SHINGLE_WORDS + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        elif e > s:
            own = gram_hashes(words[s:e], e - s) + np.uint64(e - s)
        else:
            continue
        sets.append(own)
        counts[i + 1] = len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum(counts)


def _range_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def digests(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 bits that are equal for equal sets; 0 is kept for the empty set."""
    sizes = np.diff(offsets)
    found = mix(_range_sums(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), offsets) + sizes.astype(np.uint64))
    return np.where(sizes == 0, np.uint64(0), np.where(found == 0, np.uint64(1), found)).view(np.int64)


def signatures(sets: np.ndarray, offsets: np.ndarray, ids: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of each set, and for each the set's id."""
    sizes = np.diff(offsets)
    found, owners = [np.zeros(0, np.uint64)], [np.zeros(0, ids.dtype)]
    if not len(sets):
        return found[0], owners[0]
    for band, (low, high, top, k, n) in enumerate(_bands(int(sizes.max()))):
        todo = np.flatnonzero((sizes >= low) & (sizes <= top)) if k else ()
        family = 0
        while len(todo):
            counts = sizes[todo]
            begins = np.cumsum(counts) - counts
            at = np.repeat(offsets[todo] - begins, counts) + np.arange(counts.sum())
            own = sets[at]
            seed = np.uint64((salt * 1000003 + family * 7919 + band + 1) * 0x9E3779B97F4A7C15 % 2**64)
            mixed = mix(own ^ seed)
            part = ((mixed >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            cell = np.repeat(np.arange(len(todo)) * n, counts) + part.astype(np.int64)
            total = np.zeros(len(todo) * n, np.uint64)
            np.add.at(total, cell, mix(mixed ^ np.uint64(0xD1342543DE82EF95)))
            filled = total != 0
            where = np.flatnonzero(filled)
            found.append(mix(total[where] ^ mix((where % n).astype(np.uint64) + seed)))
            owners.append(ids[todo[where // n]])
            todo = todo[filled.reshape(-1, n).sum(1) <= k]
            family += 1
    return np.concatenate(found), np.concatenate(owners)


def sketch(own: np.ndarray) -> bytes:
    bits = min(SKETCH_MOST, max(SKETCH_LEAST, 1 << (2 * len(own)).bit_length()))
    at = mix(own ^ np.uint64(0x8A5CD789635D2DFF)) & np.uint64(bits - 1)
    parity = np.bincount(at.view(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").tobytes()


def _folded(sketches: list[bytes]) -> np.ndarray:
    """All sketches as rows of 64-bit words, at the length of the shortest."""
    width = min(map(len, sketches))
    rows = np.empty((len(sketches), width // 8), np.uint64)
    for i, one in enumerate(sketches):
        words = np.frombuffer(one, np.uint64)
        rows[i] = np.bitwise_xor.reduce(words.reshape(-1, width // 8)) if len(one) > width else words
    return rows


def _possible(sizes: np.ndarray, rows: np.ndarray, size: int, row: np.ndarray) -> np.ndarray:
    """Whether each set may be similar to one, by their sizes and folded sketches."""
    total = sizes + size
    bound = total + 2 * (-4 * total // 9)  # of the difference, at similarity 0.8
    near = 100 * np.minimum(sizes, size) >= 80 * np.maximum(sizes, size)
    return near & (np.bitwise_count(rows ^ row).sum(1, dtype=np.int64) <= bound)


def _texts(batches: Iterator[pa.RecordBatch], column: str):
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        for first, end, part, part_offsets in chunks(data, offsets):
            sets, set_offsets = shingle_sets(part, part_offsets)
            yield batch.slice(first, end - first), sets, set_offsets


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, sets, offsets in _texts(batches, "text"):
        sketches = [sketch(sets[s:e]) for s, e in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                pa.array(np.diff(offsets)),
                pa.array(digests(sets, offsets)),
                pa.array(sketches, pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_id", "sketch"],
        )


def _rows(sigs: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Signature rows; of sets that share one here, all but the least become members that know it.

    So one partition sends one row of a signature to the signature's key, and its further
    members to a key of their own.
    """
    order = np.lexsort((ids, sigs))
    sigs, ids = sigs[order], ids[order]
    new = np.ones(len(sigs), bool)
    new[1:] = sigs[1:] != sigs[:-1]
    firsts = np.flatnonzero(new)
    counts = np.diff(np.append(firsts, len(sigs)))
    hubs = np.repeat(ids[firsts], counts)
    lone = np.repeat(counts == 1, counts)
    salt = np.where(new, 0, TaskContext.get().partitionId() + 1)
    keep = new | (ids != hubs)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(sigs[keep].view(np.int64)),
            pa.array(ids[keep]),
            pa.array(hubs[keep], mask=lone[keep]),
            pa.array(salt[keep].astype(np.int32)),
        ],
        ["sig", "set_id", "hub", "salt"],
    )


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of the partition's distinct sets."""
    seen: set[int] = set()
    sigs, owners, held = [], [], 0
    for _, sets, offsets in _texts(batches, "text"):
        ids, sizes = digests(sets, offsets), np.diff(offsets)
        fresh = np.zeros(len(ids), bool)
        for i, digest in enumerate(ids.tolist()):
            if digest not in seen:
                fresh[i] = True
                seen.add(digest)
        if len(seen) > HELD:
            seen.clear()
        kept = sets[np.repeat(fresh, sizes)]
        found, own = signatures(kept, np.concatenate([[0], np.cumsum(sizes[fresh])]), ids[fresh])
        sigs.append(found)
        owners.append(own)
        held += len(found)
        if held >= HELD:
            yield _rows(np.concatenate(sigs), np.concatenate(owners))
            sigs, owners, held = [], [], 0
    if held:
        yield _rows(np.concatenate(sigs), np.concatenate(owners))


def _members(docs: DataFrame) -> DataFrame:
    """`sig`, `set_id`, `hub` of all sets that share a signature; hub: a set that all lead to."""
    rows = docs.select("text").mapInArrow(_emit, "sig long, set_id long, hub long, salt int")
    group = Window.partitionBy("sig", "salt").orderBy("set_id")
    least = F.first("set_id").over(group.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("least", least).withColumn("next", F.lead("set_id").over(group))
    shared = (
        F.col("hub").isNotNull() | (F.col("least") != F.col("set_id")) | (F.col("next") != F.col("set_id"))
    )
    return rows.filter(shared).select(
        "sig", "set_id", F.when(F.col("salt") > 0, F.col("hub")).otherwise(F.col("least")).alias("hub")
    )


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, sets, offsets in _texts(batches, "text"):
        values = [sets[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests(sets, offsets)), pa.array(values, pa.binary())], ["set_id", "shingles"]
        )


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test: 100 * intersection >= 80 * union, for ascending distinct hashes."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= 80 * (len(both) - common)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
        passed = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in pairs]
        yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))


def _possible_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "ka", "kb")))
        keep = []
        for na, nb, ka, kb in rows:
            both = _folded([ka, kb])
            keep.append(bool(_possible(np.array([nb]), both[1:], na, both[0])[0]))
        yield batch.select(["a", "b", "shared"]).filter(pa.array(keep, pa.bool_()))


_OPEN = ["sig", "i", "j", "set_id", "label", "n_shingles", "own", "sketch", "least", "hashes"]


def _open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Possible pairs of each group's sets that have different labels; rows come group by group.

    Two sets whose least signatures by one of FIRSTS hashes are the same meet in that
    signature's group, by the first such hash; all other groups leave the pair to it.
    """
    group, held = None, []

    def pairs() -> pa.RecordBatch:
        within = group[1] == group[2]
        if not within:
            held.sort(key=lambda row: row[3] != group[1])
        ids, labels, sizes, blocks, sketches, least, hashes = zip(*held)
        ids, labels, sizes, least = (np.array(x) for x in (ids, labels, sizes, least))
        here = np.array(hashes[0])
        rows = _folded(list(sketches))
        first = sum(block == group[1] for block in blocks)
        a, b = [], []
        for i in range(len(ids) - 1 if within else first):
            rest = slice(i + 1 if within else first, None)
            same = least[rest] == least[i]
            turn = same.argmax(1)
            ours = ~same.any(1) | (least[i][turn] == here[turn])
            found = np.flatnonzero(
                ours & (labels[rest] != labels[i]) & _possible(sizes[rest], rows[rest], sizes[i], rows[i])
            )
            if len(found):
                a.append(np.full(len(found), ids[i]))
                b.append(ids[rest][found])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in _OPEN]
        for row in zip(*columns):
            if row[:3] != group:
                if len(held) > 1:
                    yield pairs()
                group, held = row[:3], []
            held.append(row[3:])
    if len(held) > 1:
        yield pairs()


def _blocks(rows: DataFrame) -> DataFrame:
    """Each row of a group of n once for every pair of blocks, `i` <= `j`, that its own block is in."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.hash("set_id"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))


class _Sets:
    """Fetches the sets of documents from their texts."""

    def __init__(self, docs: DataFrame, firsts: DataFrame, scratch: Scratch):
        self.docs, self.firsts, self.scratch = docs, firsts, scratch

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs `a`, `b` that are similar, written."""
        pairs = self.scratch.write(pairs.select("a", "b"), "pairs")
        ids = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
        wanted = self.scratch.write(self.firsts.join(ids, "set_id", "left_semi").select("doc_id"), "wanted")
        picked = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
        sets = self.docs.join(picked, "doc_id", "left_semi").select("text")
        sets = self.scratch.write(sets.mapInArrow(_shingles, "set_id long, shingles binary"), "shingles")
        left = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("sa"))
        right = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("sb"))
        rows = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
        return self.scratch.write(rows.mapInArrow(_verify, "a long, b long").distinct(), "links")


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    names = labels.select(F.col("node").alias(node), F.col("component").alias(label))
    return rows.join(names, node, "left").withColumn(label, F.coalesce(label, node))


def jaccard_join(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Groups of documents whose word-shingle sets are linked by similarity of 0.8 or more.

    docs: `doc_id` (long), `text`; other columns are ignored. One row for each input row:
    `doc_id`, `n_shingles` (elements of the set), `component_id` (least doc_id reachable by
    links, itself included). Null or empty text: an empty set, linked with nothing. A null
    doc_id is linked with nothing either and has a null component_id. Rows with one doc_id
    and several texts link those texts' groups only through similarity. No rows give none.

    Every pair of similar distinct sets is found and tested exactly, or is in one component
    by other links. First each set is tested against the set it shares most signatures
    with, then against the other hubs of its signatures, then sets of one signature group
    that are still in different components against each other.
    """
    support.prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    described = scratch.write(
        docs.mapInArrow(_describe, "doc_id long, n_shingles long, set_id long, sketch binary"), "sets"
    )
    known = docs.filter("doc_id is not null")
    firsts = described.filter("doc_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
    sketches = described.join(firsts, ["set_id", "doc_id"], "left_semi").select("set_id", "n_shingles", "sketch")
    fetch = _Sets(known, firsts, scratch)

    members = scratch.write(_members(known), "members")
    hubs = members.filter("set_id <> hub").groupBy(F.col("set_id").alias("a"), F.col("hub").alias("b"))
    hubs = hubs.agg(F.count("*").alias("shared"))
    hubs = hubs.join(sketches.toDF("a", "na", "ka"), "a").join(sketches.toDF("b", "nb", "kb"), "b")
    hubs = scratch.write(
        hubs.select("a", "b", "shared", "na", "nb", "ka", "kb").mapInArrow(
            _possible_pairs, "a long, b long, shared long"
        ),
        "hubs",
    )
    best = hubs.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("best")).select("a", "best.b")
    links = fetch.links(best)
    # A set hangs on the hub it proved similar to; other hubs that hang on the same are settled.
    hung = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    apart = _labelled(_labelled(hubs, hung, "a", "label_a"), hung, "b", "label_b").filter("label_a <> label_b")
    links = links.unionByName(fetch.links(apart.join(best, ["a", "b"], "left_anti")))
    labels = scratch.write(components(links.toDF("u", "v"), scratch), "labels")

    placed = _labelled(members, labels, "set_id", "label").select("sig", "set_id", "label").distinct()
    open_groups = (
        placed.groupBy("sig")
        .agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("n > 2 and low <> high")
        .select("sig", "n")
    )
    opened = scratch.write(placed.join(open_groups, "sig"), "open")
    hashes = [F.xxhash64("sig", F.lit(turn)) for turn in range(FIRSTS)]
    least = opened.groupBy("set_id").agg(*[F.min(h).alias(f"least{turn}") for turn, h in enumerate(hashes)])
    least = least.select("set_id", F.array(*[f"least{turn}" for turn in range(FIRSTS)]).alias("least"))
    rows = _blocks(opened.join(least, "set_id").join(sketches, "set_id"))
    rows = rows.withColumn("hashes", F.array(*hashes)).select(*_OPEN)
    rows = rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    pairs = scratch.write(rows.mapInArrow(_open_pairs, "a long, b long").distinct(), "open-pairs")
    tested = hubs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = fetch.links(pairs.join(tested, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = scratch.write(components(links.toDF("u", "v"), scratch), "labels")

    named = described.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left")
    group = F.when(F.col("set_id") != 0, F.coalesce("component", "set_id"))
    named = scratch.write(named.select("doc_id", "n_shingles", group.alias("group")), "named")
    least = named.filter("group is not null and doc_id is not null").groupBy("group").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")
    )
    # Written, and without the documents that are alone: both sides of the join are then scans, so that the
    # rows of a large group can be split or meet a small side where they are.
    least = scratch.write(least.filter("rows > 1").drop("rows"), "least")
    linked = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return named.join(least, "group", "left").select("doc_id", "n_shingles", linked.alias("component_id"))

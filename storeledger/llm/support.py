"""What the operators share: shipping code, written intermediate tables, batches of texts."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeledger.session import scratch_dir

# Bytes of text that one vectorised step handles; a longer text is a step of its own.
CHUNK_BYTES = 1 << 20
# Rows of an Arrow batch: texts are long, so far fewer than Spark's default.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, and this package on the workers' path.

    On a cluster without a shared installation the package is shipped with --py-files.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))


class Scratch:
    """Written tables in a new folder of the shared scratch space."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.folder = spark, scratch_dir(spark, purpose)

    def write(self, frame: DataFrame, name: str = "step", row_group: int | None = None) -> DataFrame:
        """The frame, written and read back with its schema: later steps do not recompute it.

        `row_group`: bytes of a row group, if other than Parquet's usual.
        """
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        frame.write.options(**{"parquet.block.size": row_group} if row_group else {}).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rows.select(*columns) if columns else rows


def with_fields(schema: T.StructType, more: str) -> T.StructType:
    """The schema and, after its fields, those of a DDL string."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(more).fields])


def crc_remainder(key, modulus: int):
    """crc32 of a key's text, modulo; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, and where each text begins (one entry more than rows); null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of at most CHUNK_BYTES together: first row, end row, bytes, offsets."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        base = offsets[first]
        yield first, end, data[base : offsets[end]], offsets[first : end + 1] - base
        first = end


# --- words and their hashes ------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# All of ASCII but letters and digits.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True
_LETTER = np.random.default_rng(20240229).integers(0, 2**64, 256, np.uint64)
_LETTER[65:91] = _LETTER[97:123]  # A-Z hash as a-z
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    table = np.full(n, base, np.uint64)
    table[:1] = 1
    return np.multiply.accumulate(table)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, at least n of them."""
    if len(_POWERS.get(base, ())) < n:
        table = _powers(base, max(n, CHUNK_BYTES + 1))
        if n > CHUNK_BYTES + 1:
            return table  # for one very long text: not kept
        _POWERS[base] = table
    return _POWERS[base]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def spans(
    data: np.ndarray, offsets: np.ndarray, blanks: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text: starts, ends, and each text's first word (one more entry).

    Words are `[^\\x20\\x09-\\x0D]+`, or runs of what is not in another table of blank bytes.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = blanks[data]
    begin = ~space
    end = begin.copy()
    begin[1:] &= space[:-1]
    end[:-1] &= space[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = ~space[edges]
    end[edges - 1] = ~space[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, A-Z taken as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[data] * powers(_BASE, n + 1)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, blanks: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each text's first word."""
    starts, ends, firsts = spans(data, offsets, blanks)
    return range_hashes(data, starts, ends), firsts


_STEP = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (of the last n - 1: none)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    last = len(words) - n + 1
    total = words[:last].copy()
    for i in range(1, n):
        total *= _STEP
        total += words[i : i + last]
    return mix(total)

"""Landed pages as a Spark data source: ``spark.read.format("landed_pages").load(folder)``.

``land_pages`` writes pages as JSON lines, gzipped, a folder for each resource and a file for each range of
cursors. The source has one partition for each file, so a range is read, and read again after a
lost executor, on its own; a filter on the resource is pushed into it, and the files of other resources are
neither listed nor opened. Folders are opened by pyarrow, on executors and driver alike; where only
Spark's own readers can open them, ``sources.pages.read_pages`` reads the same pages.
"""

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from storeledger import schemas
from storeledger.session import scratch_dir, ship

# Pages, and bytes of text, that one batch holds.
BATCH_PAGES, BATCH_BYTES = 256, 16 << 20
# Pages of a range at most, about; with more pages there are more ranges, so that a range's pages are sorted in memory.
RANGE_PAGES = 2_000


def land_pages(pages: DataFrame, folder: str, ranges: int) -> None:
    """Write landed pages by resource in ``ranges`` ranges of cursors, by length and text; more where
    those would hold over RANGE_PAGES pages.

    The bounds come from the cursors alone, written once beside the pages, so that no body is made twice.
    """
    order = [F.length("request_cursor"), F.col("request_cursor")]
    place = F.struct(
        F.coalesce("resource", F.lit("")).alias("resource"),
        F.coalesce(order[0], F.lit(-1)).alias("size"),
        F.coalesce("request_cursor", F.lit("")).alias("cursor"),
    )
    spark, cursors = pages.sparkSession, f"{scratch_dir(pages.sparkSession, 'cursors')}/cursors"
    pages.select(place.alias("place")).write.parquet(cursors)
    cursors = spark.read.schema("place struct<resource: string, size: int, cursor: string>").parquet(cursors)
    ranges = max(ranges, -(-cursors.count() // RANGE_PAGES))
    firsts = cursors.repartitionByRange(ranges, "place").groupBy(F.spark_partition_id()).agg(F.min("place").alias("place"))
    bounds = sorted(tuple(row["place"]) for row in firsts.collect())[1:]
    number = F.lit(0)
    if bounds:
        listed = F.array(*[F.struct(*map(F.lit, bound)) for bound in bounds])
        number = F.size(F.filter(listed, lambda bound: bound <= place))
    dealt = pages.repartitionById(ranges, number).sortWithinPartitions("resource", *order)
    dealt.write.partitionBy("resource").option("ignoreNullFields", False).option("compression", "gzip").json(folder)


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """The landed pages of a folder, by the data source."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedPages)
    return spark.read.format("landed_pages").load(folder)


@dataclass
class CursorRange(InputPartition):
    resource: str
    file: str


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return schemas.LANDED_PAGE

    def reader(self, schema) -> "LandedReader":
        return LandedReader(self.options["path"])


class LandedReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder
        self.resources: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and lists of resources choose folders; other filters are left to Spark."""
        for one in filters:
            if isinstance(one, (EqualTo, In)) and one.attribute == ("resource",):
                wanted = {one.value} if isinstance(one, EqualTo) else set(one.value)
                self.resources = wanted if self.resources is None else self.resources & wanted
            else:
                yield one

    def _files(self) -> tuple[pyarrow.fs.FileSystem, str]:
        uri = self.folder if ":" in self.folder.split("/")[0] else f"file://{self.folder}"
        return pyarrow.fs.FileSystem.from_uri(uri)

    def partitions(self) -> list[CursorRange]:
        files, root = self._files()
        found = []
        for folder in files.get_file_info(pyarrow.fs.FileSelector(root)):
            name, _, resource = folder.base_name.partition("=")
            if name == "resource" and (self.resources is None or resource in self.resources):
                inside = files.get_file_info(pyarrow.fs.FileSelector(folder.path))
                found += [CursorRange(resource, one.path) for one in inside if one.base_name.endswith((".json", ".json.gz"))]
        return sorted(found, key=lambda p: (p.resource, p.file)) or [CursorRange("", "")]

    def read(self, partition: CursorRange) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        files, _ = self._files()
        schema = pa.schema([(name, pa.string()) for name in ("resource", "request_cursor", "body")])
        rows, size = [], 0
        with files.open_input_stream(partition.file) as stream:
            for line in _lines(stream):
                page = json.loads(line)
                rows.append((partition.resource, page.get("request_cursor"), page.get("body")))
                size += len(line)
                if len(rows) >= BATCH_PAGES or size >= BATCH_BYTES:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, schema)


def _lines(stream: pa.NativeFile, block: int = 1 << 20) -> Iterator[bytes]:
    """Lines of a stream, read block by block."""
    rest = b""
    while data := stream.read(block):
        *whole, rest = (rest + data).split(b"\n")
        yield from filter(None, whole)
    if rest:
        yield rest


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], schema=schema)

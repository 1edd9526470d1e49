"""Tables that change together: a load writes a folder of its own and one commit makes it current.

The log of a root, ``_log``, has one small file for each version: its number, the load, and for
every table its folder, schema and rows. A load remembers which version was current when it
began and commits as the next one. The file is put there only if no other is, so of two loads
that began at the same version one commits and the other is refused: the data of a load that
has not seen a newer version never replace it. Until the commit readers see the former version,
and a load that fails leaves nothing but a folder that no version names.

Put-if-absent is a rename that does not overwrite, which is atomic on HDFS and stores with
conditional writes.
"""

import json
import time
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "_log"


class ConcurrentLoad(RuntimeError):
    """Another load has committed since this one began."""


class _Files:
    """The few file operations a log needs, on any file system Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        context = spark.sparkContext
        self.jvm, self.conf, self.gateway = context._jvm, context._jsc.hadoopConfiguration(), context._gateway
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.system = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(name)

    def names(self, folder: str) -> dict[str, int]:
        """What is in a folder, with the time it was changed last, in milliseconds."""
        if not self.system.exists(self.path(folder)):
            return {}
        found = self.system.listStatus(self.path(folder))
        return {one.getPath().getName(): one.getModificationTime() for one in found}

    def put_if_absent(self, name: str, text: str) -> bool:
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        out = self.system.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        options = getattr(self.hadoop, "Options$Rename")
        never_over = self.gateway.new_array(options, 1)
        never_over[0] = options.NONE
        files = self.hadoop.FileContext.getFileContext(self.system.getUri(), self.conf)
        try:
            files.rename(self.system.makeQualified(draft), self.system.makeQualified(self.path(name)), never_over)
            return True
        except Py4JJavaError as error:
            self.system.delete(draft, False)
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            return False

    def text(self, name: str) -> str:
        return self.spark.read.text(name, wholetext=True).first()[0]

    def delete(self, folder: str) -> None:
        self.system.delete(self.path(folder), True)


def _numbers(files: _Files, root: str) -> list[int]:
    return sorted(int(name.removesuffix(".json")) for name in files.names(f"{root}/{_LOG}") if name.endswith(".json"))


def _entry(root: str, number: int) -> str:
    return f"{root}/{_LOG}/{number:020d}.json"


class Version:
    """The tables of a committed version."""

    def __init__(self, spark: SparkSession, root: str, number: int, content: Mapping):
        self.spark, self.root, self.number = spark, root, number
        self.load, self.tables = content["load"], content["tables"]

    def read(self, name: str) -> DataFrame:
        table = self.tables[name]
        schema = T.StructType.fromJson(table["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table['folder']}/{name}")

    def rows(self) -> dict[str, int]:
        return {name: table["rows"] for name, table in self.tables.items()}


def current(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The version committed last, or an earlier one by its number; none before the first commit."""
    files = _Files(spark, root)
    numbers = _numbers(files, root)
    if number is None and not numbers:
        return None
    number = numbers[-1] if number is None else number
    return Version(spark, root, number, json.loads(files.text(_entry(root, number))))


class Load:
    """Tables being written; ``commit`` makes them current together.

    A table that the load does not write stays as it is in the version the load began at.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.id = spark, root, uuid.uuid4().hex
        self.base = current(spark, root)
        self.folder = f"load-{self.id}"
        self.tables: dict[str, dict] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{self.folder}/{name}"

    def write(self, name: str, rows: DataFrame, observed: Mapping[str, Column] | None = None) -> dict[str, int]:
        """Write a table; its number of rows and the aggregates asked for come from the same pass."""
        seen = Observation(name)
        counted = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), *[value.alias(n) for n, value in (observed or {}).items()]
        )
        counted.write.mode("overwrite").parquet(self.path(name))
        found = seen.get
        self.tables[name] = {"folder": self.folder, "rows": found["rows"], "schema": rows.schema.jsonValue()}
        return found

    def read(self, name: str) -> DataFrame:
        """A table as this load has written it, or as it was when the load began."""
        if name not in self.tables and self.base:
            return self.base.read(name)
        return self.spark.read.schema(T.StructType.fromJson(self.tables[name]["schema"])).parquet(self.path(name))

    def commit(self) -> Version:
        """Make the tables current; repeated, it finds its own commit and does nothing."""
        number = self.base.number + 1 if self.base else 0
        kept = self.base.tables if self.base else {}
        content = {"load": self.id, "tables": {**kept, **self.tables}}
        files = _Files(self.spark, self.root)
        name = _entry(self.root, number)
        if not files.put_if_absent(name, json.dumps(content)) and json.loads(files.text(name))["load"] != self.id:
            raise ConcurrentLoad(f"version {number} of {self.root} is of another load; begin anew")
        return Version(self.spark, self.root, number, content)


def clean_up(spark: SparkSession, root: str, keep: int = 2, hours: float = 24.0) -> list[str]:
    """Delete the folders that none of the last ``keep`` versions names and that are older than ``hours``.

    The age spares loads that are still being written. Returns the folders deleted; the log stays whole.
    """
    files = _Files(spark, root)
    versions = [current(spark, root, number) for number in _numbers(files, root)[-keep:]]
    named = {table["folder"] for version in versions for table in version.tables.values()}
    before = (time.time() - hours * 3600) * 1000
    old = [
        folder
        for folder, changed in sorted(files.names(root).items())
        if folder.startswith("load-") and folder not in named and changed < before
    ]
    for folder in old:
        files.delete(f"{root}/{folder}")
    return old

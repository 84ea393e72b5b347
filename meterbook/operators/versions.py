"""Published tables in versions: a reader sees one version whole, and of two writers that start from one version one is refused.

A version is a small manifest that lists the folders of its rows; folders are written by Spark jobs under names of their own
and never change. Publishing is one rename of the finished manifest to the next number, which fails when that number
exists. Rows of a job that was killed are in a folder that no manifest names. The rename is atomic on HDFS; on an object store
use a committer or connector with conditional puts.

A table may deal its rows to buckets by a key. A change of some keys then writes the buckets of these keys anew, and
the new version keeps the folders of all others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from meterbook.operators.publish import CheckFailed

_BUCKET = "bucket_of_key"


class VersionConflict(RuntimeError):
    """Another writer published the version first; nothing of this one is visible."""


@dataclass(frozen=True)
class Version:
    number: int
    rows: int
    schema: dict
    #: (bucket or -1, folder) of the rows
    parts: list = field(default_factory=list)

    def folders(self, buckets: set[int] | None = None) -> list[str]:
        return [folder for bucket, folder in self.parts if buckets is None or bucket in buckets]


class VersionedTable:
    """A table in a folder, its rows dealt to ``buckets`` by ``key`` if one is given."""

    def __init__(self, spark: SparkSession, path: str, key: str | None = None, buckets: int = 0):
        if bool(key) != bool(buckets):
            raise ValueError("a key and its number of buckets belong together")
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    # ---- reading --------------------------------------------------------------------------

    def latest(self) -> Version | None:
        """The newest version; None before the first."""
        numbers = [int(name.removesuffix(".json")) for name in self._names(f"{self.path}/_versions") if name.endswith(".json") and name[0] != "."]
        return self.version(max(numbers)) if numbers else None

    def version(self, number: int) -> Version:
        stream = self._files().open(self._path(self._manifest(number)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def read(self, version: Version | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows of a version, of the newest by default; later versions do not change them."""
        pinned = version or self.latest()
        if pinned is None:
            raise FileNotFoundError(self.path)
        schema = StructType.fromJson(pinned.schema)
        folders = pinned.folders(buckets)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    # ---- writing --------------------------------------------------------------------------

    def replace(self, rows: DataFrame, based_on: Version | None) -> Version:
        """All rows anew; ``based_on`` is the version that the writer has read, None for the first."""
        folder = self._write(rows)
        parts = self._parts(folder)
        return self._publish(based_on, parts, self._count(parts, rows.schema), rows.schema)

    def append(
        self, rows: DataFrame, based_on: Version, expected: int | None = None, check: Callable[[DataFrame], bool] | None = None
    ) -> Version:
        """More rows, if as many as expected were written and ``check`` accepts them as they were written."""
        schema = StructType.fromJson(based_on.schema)
        parts = self._parts(self._write(rows.select(schema.names)))
        found = self._count(parts, schema)
        if expected is not None and found != expected:
            raise CheckFailed(f"expected {expected} rows, staged {found}")
        staged = Version(0, found, based_on.schema, parts)
        if check is not None and not check(self.read(staged)):
            raise CheckFailed("the staged rows were rejected")
        return self._publish(based_on, [*based_on.parts, *parts], based_on.rows + found, schema)

    def rewrite(self, touched: DataFrame, change: Callable[[DataFrame], DataFrame], based_on: Version) -> Version:
        """Apply ``change`` to the buckets of the ``touched`` keys; it must not move a row to a key of another bucket."""
        if not self.key:
            raise ValueError("only a table with a key has buckets to rewrite")
        # no more numbers than buckets
        numbers = {r[0] for r in touched.select(self._bucket().alias("b")).distinct().collect()}
        if not numbers:
            return based_on
        schema = StructType.fromJson(based_on.schema)
        before = self.read(based_on, numbers)
        parts = self._parts(self._write(change(before).select(schema.names)))
        if moved := {bucket for bucket, _ in parts} - numbers:
            raise CheckFailed(f"rows moved to untouched buckets {sorted(moved)[:5]}")
        kept = [p for p in based_on.parts if p[0] not in numbers]
        rows = based_on.rows - before.count() + self._count(parts, schema)
        return self._publish(based_on, [*kept, *parts], rows, schema)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove versions but the newest ``keep``, and folders that no kept version names. No writer may be at work."""
        newest = self.latest()
        if newest is None:
            return []
        first = max(0, newest.number - keep + 1)
        used = {folder.rsplit("/", 1)[0] if bucket >= 0 else folder for n in range(first, newest.number + 1) for bucket, folder in self.version(n).parts}
        gone = [f"{self.path}/{name}" for name in self._names(self.path) if name != "_versions" and f"{self.path}/{name}" not in used]
        gone += [f"{self.path}/_versions/{n}" for n in self._names(f"{self.path}/_versions") if n.endswith(".json") and n[0] != "." and int(n[:-5]) < first]
        for path in gone:
            self._files().delete(self._path(path), True)
        return gone

    # ---- files ----------------------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> str:
        folder = f"{self.path}/{uuid.uuid4().hex}"
        if self.key:
            # Spark evens the partitions out at run time, so a bucket may hold any share of the rows
            rows.withColumn(_BUCKET, self._bucket()).hint("rebalance", F.col(_BUCKET)).write.partitionBy(_BUCKET).parquet(folder)
        else:
            rows.write.parquet(folder)
        return folder

    def _parts(self, folder: str) -> list[tuple[int, str]]:
        if not self.key:
            return [(-1, folder)]
        names = [n for n in self._names(folder) if n.startswith(f"{_BUCKET}=")]
        return sorted((int(n.split("=")[1]), f"{folder}/{n}") for n in names)

    def _count(self, parts: list[tuple[int, str]], schema: StructType) -> int:
        return self.read(Version(0, 0, schema.jsonValue(), parts)).count()

    def _publish(self, based_on: Version | None, parts: list, rows: int, schema: StructType) -> Version:
        new = Version(based_on.number + 1 if based_on else 0, rows, schema.jsonValue(), [list(p) for p in parts])
        aside = f"{self.path}/_versions/.{uuid.uuid4().hex}"
        stream = self._files().create(self._path(aside), False)
        stream.write(bytearray(json.dumps(asdict(new)).encode()))
        stream.close()
        refuse = self.spark._sc._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 1)
        refuse[0] = getattr(self._hadoop, "Options$Rename").NONE
        target = self._path(self._manifest(new.number))
        context = self._hadoop.FileContext.getFileContext(self._files().getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._path(aside), target, refuse)
        except Py4JJavaError as error:
            self._files().delete(self._path(aside), False)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
                raise VersionConflict(f"version {new.number} of {self.path} exists") from None
            raise
        return new

    def _manifest(self, number: int) -> str:
        return f"{self.path}/_versions/{number:020d}.json"

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def _files(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, path = self._files(), self._path(folder)
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

"""Parquet tables with atomic multi-table commits, laid out by key.

Data files are written first, each write into a folder of its own; a commit is the exclusive creation of
the next manifest file, which lists the folders of every table. Readers use the newest manifest, so they
see all tables of a batch or none, and a job that dies half way leaves nothing visible. Works on any file
system Spark can reach.

Rows that a later batch may change or look up by key lie in partitions of a hash of that key
(:meth:`Store.bucket`). A batch names the buckets its keys fall in; it reads only their folders and replaces only their entries
in the manifest. Spark's own dynamic overwrite of such partitions would move them one after the other, table after table, so a
reader could see half a batch; the manifest swaps them all at once.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronograde import schemas
from chronograde.session import shared_folder

OPEN, CLOSED = "open", "closed"
BUCKETS = 64

# Versioned tables are read by key. History plans leave rows sorted by entity inside each file, so page
# statistics prune within a file; Bloom filters let equality lookups skip whole files.
LOOKUPS = ("natural_key", "entity_key", "profile_key")


@dataclass(frozen=True)
class Write:
    """What a commit does to a table.

    ``append`` adds rows (a folder from :meth:`Store.put`, or data). ``keyed`` adds rows that carry their ``key_bucket``.
    ``versioned`` rows carry it too and are told apart by the boolean column ``flag``: open rows replace the stored open rows of
    the buckets in ``touched`` (all buckets if None), closed rows are added; rows closed earlier are never read or rewritten.
    """

    data: DataFrame | str
    kind: str = "append"
    flag: str = "is_current"
    touched: Collection[int] | None = None


class Store:
    """``buckets`` counts the key partitions of a new store; a store that exists keeps its own number."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets = self.manifest().get("buckets", buckets)

    def bucket(self, key: str | Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets that the keys of a batch fall in, at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket(key).alias("b")).distinct().collect())

    # -- reading ---------------------------------------------------------------------------------

    def manifest(self) -> dict:
        versions = self._versions()
        return json.loads(self._read(self._manifest_path(versions[-1]))) if versions else {"version": 0, "tables": {}, "marks": {}}

    def read(self, table: str, flag: str = "is_current") -> DataFrame:
        """The table at the newest commit; empty if nothing was written yet."""
        schema = schemas.TABLES[table]
        parts = self.manifest()["tables"].get(table, {})
        frames = [
            self._load(paths, schema, flag, part == OPEN) for part, paths in parts.items() if paths
        ]
        if not frames:
            return self.spark.createDataFrame([], schema)
        whole = frames[0]
        for f in frames[1:]:
            whole = whole.unionByName(f)
        return whole

    def read_open(self, table: str, buckets: Collection[int] | None = None) -> DataFrame:
        """Only the open rows of a versioned table or the rows of a keyed one, and of these only the given buckets' folders."""
        schema = schemas.TABLES[table]
        paths = self.manifest()["tables"].get(table, {}).get(OPEN, [])
        if buckets is not None:
            paths = [p for p in paths if _bucket_of(p) in set(buckets)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self._load(paths, schema, "is_current", True)

    def _load(self, paths: list[str], schema, flag: str, is_open: bool) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in paths])
        # A constant instead of a stored flag: a filter on it drops the whole other part from the plan.
        return rows.withColumn(flag, F.lit(is_open)) if flag in schema.fieldNames() else rows

    # -- writing ---------------------------------------------------------------------------------

    def put(self, table: str, data: DataFrame) -> str:
        """Write rows that become visible when a later commit names the returned folder."""
        folder = f"data/{table}/{uuid.uuid4().hex}"
        with shuffles_end_with_the_write(self.spark):
            data.select(*schemas.TABLES[table].fieldNames()).write.parquet(f"{self.root}/{folder}")
        return folder

    def open_folder(self, table: str, folder: str) -> DataFrame:
        return self._load([folder], schemas.TABLES[table], "is_current", True)

    def prepare(self, table: str, write: Write) -> Write:
        """Write a table's rows now; they become visible when a later commit gets the returned write."""
        if isinstance(write.data, str):
            return write
        if write.kind == "append":
            return replace(write, data=self.put(table, write.data))
        folder = f"data/{table}/{uuid.uuid4().hex}"
        flag = F.when(F.col(write.flag), OPEN).otherwise(CLOSED) if write.kind == "versioned" else F.lit(OPEN)
        columns = [c for c in schemas.TABLES[table].fieldNames() if write.kind == "keyed" or c != write.flag]
        rows = write.data.select(*columns, flag.alias("_part"), F.col("key_bucket").alias("_bucket")).withColumn(
            "_bucket", F.when(F.col("_part") == OPEN, F.col("_bucket")).otherwise(F.lit(-1)))
        # Gathers a bucket's rows in few files; adaptive execution splits a bucket that is too large for one task.
        out = rows.hint("rebalance", F.col("_part"), F.col("_bucket")).write.partitionBy("_part", "_bucket")
        # filters between 64 kB and 1 MB by their rows: 1 MB for each column of each bucket outweighs the rows themselves
        out = out.option("compression", "zstd").option("parquet.bloom.filter.adaptive.enabled", "true")
        for column in LOOKUPS:
            if column in columns:
                out = out.option(f"parquet.bloom.filter.enabled#{column}", "true")
        with shuffles_end_with_the_write(self.spark):
            out.parquet(f"{self.root}/{folder}")
        return replace(write, data=folder)

    def commit(self, writes: dict[str, Write], marks: dict | None = None, expect: int | None = None) -> int:
        """Write all tables, then publish them together. Fails if another commit came first."""
        before = self.manifest()
        version = (before["version"] if expect is None else expect) + 1
        tables = {t: {p: list(v) for p, v in parts.items()} for t, parts in before["tables"].items()}
        for table, write in writes.items():
            parts, folder = tables.setdefault(table, {OPEN: [], CLOSED: []}), self.prepare(table, write).data
            if write.kind == "append":
                parts[OPEN].append(folder)
                continue
            if write.kind == "versioned":
                parts[OPEN] = [p for p in parts[OPEN] if write.touched is not None and _bucket_of(p) not in set(write.touched)]
            parts[OPEN] += [f"{folder}/_part={OPEN}/{name}" for name in self._names(f"{folder}/_part={OPEN}")]
            parts[CLOSED] += [f"{folder}/_part={CLOSED}/{name}" for name in self._names(f"{folder}/_part={CLOSED}")]
        body = {"version": version, "buckets": self.buckets, "tables": tables, "marks": {**before["marks"], **(marks or {})}}
        self._create(self._manifest_path(version), json.dumps(body))
        return version

    # -- files (through Hadoop's FileSystem, as Spark itself does) --------------------------------

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:08d}.json"

    def _fs(self, path: str):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf), p

    def _names(self, relative: str) -> list[str]:
        fs, p = self._fs(f"{self.root}/{relative}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def _versions(self) -> list[int]:
        names = self._names("manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read(self, path: str) -> str:
        fs, p = self._fs(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, path: str, text: str) -> None:
        """Writes a file under another name and renames it; fails if the name is taken, and readers never see a part of it.

        The rename is atomic on HDFS and POSIX file systems; object stores need a committer of their own.
        """
        fs, p = self._fs(path)
        jvm = self.spark._jvm
        part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
        stream = fs.create(part, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(part, p, self.spark.sparkContext._gateway.new_array(kinds, 0))
        except Exception:
            fs.delete(part, False)
            raise


def _bucket_of(path: str) -> int:
    return int(re.search(r"/_bucket=(-?\d+)$", path).group(1))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str, default: str) -> Iterator[None]:
    before = spark.conf.get(key, default)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_end_with_the_write(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of a write when the write ends: what comes later reads the written table."""
    with setting(spark, _CLEANUP, "true", "false"):  # a Spark that does not know the setting keeps them until the driver forgets the plan
        yield


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write an intermediate result to the shared checkpoint folder and read it back.

    Cuts the lineage at a columnar table: later branches prune columns and rows on scan, and lost
    executors re-read files instead of repeating the extraction.
    """
    spark = df.sparkSession
    path = f"{folder or scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_end_with_the_write(spark):
        df.write.option("compression", "zstd").parquet(path)  # half the bytes of hashes in hexadecimal
    if folder is None:
        discard_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for the intermediate results of one batch."""
    return f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"


def discard_at_exit(spark: SparkSession, folder: str) -> None:
    """Delete a folder when the driver ends: results that are still to be read derive from it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete the scratch folder of a finished batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

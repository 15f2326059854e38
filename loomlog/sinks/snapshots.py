"""Tables that change together: versions, one commit file, a file index.

A store is a folder with any number of keyed tables (K1-K7, K9):

    _commits/<n>.json      version n: of each table its schema, key and manifest
    manifest/<table>-…/    Parquet, one row per data file: file, rows, bytes, lo, hi
    data/<table>/…/        the data files, never changed

A table's files hold its rows in key order; ``lo`` and ``hi`` are the least and
greatest key in a file.  A file's place reaches from its ``lo`` to the next
file's, so every key has one place.  A merge finds the places its batch falls
into from the manifest, reads their files only, and writes kept and new rows in
their stead as files of about ``target_bytes`` (a place that has grown splits, as
a bucket would); all other files stay.  A point or prefix read opens the files
whose range holds the wanted key.

A transaction stages any number of changes; ``commit`` creates the next commit
file.  Readers resolve the newest one, so they see all changes of an import or
none, and keep seeing the version they resolved.  A writer killed before the
commit leaves files no version names; ``expire`` removes those and old versions.
One writer at a time: a second one that began from the same version fails at
its commit.

``put`` keeps tables by batch: a batch delivered again takes the place of its
first delivery (import statistics, rejected lines, stream output).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlog.session import drop_scratch, scratch_path
from loomlog.sinks.tables import _checked, _fs, one_row_per_key, path_exists

TARGET_BYTES = 128 * 1024 * 1024
#: A new table is written by as many tasks as run at once, where each has this much to write.
LEAST_BYTES = 8 * 1024 * 1024
#: Key ranges a batch is described by when its places are looked up (exact for so many keys).
RANGES = 1000
#: Column that separates places far from each other while they are written.
RUN = "__run"
BOUNDS = "__bounds"


def _struct_type(schema: T.StructType, key: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, schema[c].dataType) for c in key])


def _manifest_schema(schema: T.StructType, key: Sequence[str]) -> T.StructType:
    of_key = _struct_type(schema, key)
    return T.StructType([T.StructField("file", T.StringType()), T.StructField("rows", T.LongType()),
                         T.StructField("bytes", T.LongType()), T.StructField("lo", of_key), T.StructField("hi", of_key)])


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES):
        self.spark, self.root, self.target_bytes = spark, root.rstrip("/"), target_bytes

    # ---------------------------------------------------------------- versions

    def versions(self) -> list[int]:
        fs, path = _fs(self.spark, f"{self.root}/_commits")
        if not fs.exists(path):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n))

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/_commits/{version:012d}.json"

    def _tables(self, version: int) -> dict[str, dict]:
        if not version:
            return {}
        jvm = self.spark.sparkContext._jvm
        fs, path = _fs(self.spark, self._commit_path(version))
        stream = fs.open(path)
        try:
            return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())["tables"]
        finally:
            stream.close()

    def tables(self, version: int | None = None) -> list[str]:
        return sorted(self._tables(self.version() if version is None else version))

    # ---------------------------------------------------------------- reading

    def manifest(self, name: str, version: int | None = None) -> DataFrame:
        """The table's files: file, rows, bytes, lo, hi."""
        return self._manifest(self._tables(self.version() if version is None else version)[name])

    def _manifest(self, entry: dict) -> DataFrame:
        schema = _manifest_schema(T.StructType.fromJson(entry["schema"]), entry["key"])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{entry['manifest']}")

    def _files(self, schema: T.StructType, files: Sequence[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in files])

    def read(self, name: str, version: int | None = None, **equal) -> DataFrame:
        """The table as of a version (the newest one), and of it the rows whose first
        key columns equal the given values: only files that can hold them are opened."""
        entry = self._tables(self.version() if version is None else version)[name]
        schema, files = T.StructType.fromJson(entry["schema"]), self._manifest(entry)
        first = entry["key"][:len(equal)]
        if set(first) != set(equal):
            raise ValueError(f"a read by key names its first columns: {entry['key']}")
        if equal:
            def part(of: str) -> Column:
                return F.struct(*[F.col(of)[c] for c in first])
            wanted = F.struct(*[F.lit(equal[c]).cast(schema[c].dataType).alias(c) for c in first])
            files = files.where((part("lo") <= wanted) & (part("hi") >= wanted))
        out = self._files(schema, [r["file"] for r in files.select("file").collect()]).select(*schema.names)
        for c in first:
            out = out.where(F.col(c) == F.lit(equal[c]).cast(schema[c].dataType))
        return out

    # ---------------------------------------------------------------- writing

    def begin(self) -> Transaction:
        return Transaction(self)

    def expire(self, keep: int = 1) -> None:
        """Forget all but the newest ``keep`` versions and remove what none of those names,
        leftovers of killed writers included.  Not while a writer is at work."""
        versions = self.versions()
        kept = {version: self._tables(version) for version in versions[-keep:]}
        manifests = {entry["manifest"] for tables in kept.values() for entry in tables.values()}
        named = None
        for tables in kept.values():
            for entry in tables.values():
                files = self._manifest(entry).select("file")
                named = files if named is None else named.unionByName(files)
        used = {r["folder"] for r in named.select(F.regexp_extract("file", r"^(data/[^/]+/[^/]+)/", 1).alias("folder")).distinct().collect()
                } if named is not None else set()
        for version in versions[:-keep]:
            self._remove(f"_commits/{version:012d}.json")
        for folder in ("manifest", "data"):
            for path in self._children(folder):
                for at in [path] if folder == "manifest" else self._children(path):
                    if at not in manifests | used:
                        self._remove(at)

    def _children(self, path: str) -> list[str]:
        fs, at = _fs(self.spark, f"{self.root}/{path}")
        return [f"{path}/{f.getPath().getName()}" for f in fs.listStatus(at)] if fs.exists(at) else []

    def _remove(self, path: str) -> None:
        fs, at = _fs(self.spark, f"{self.root}/{path}")
        fs.delete(at, True)


class Transaction:
    """Changes to tables of a store that become visible together."""

    def __init__(self, store: SnapshotStore):
        self.store, self.spark = store, store.spark
        self.base = store.version()
        self.tables = store._tables(self.base)

    def commit(self) -> int:
        """Make the changes the next version."""
        version, fs_path = self.base + 1, self.store._commit_path(self.base + 1)
        fs, target = _fs(self.spark, fs_path)
        _, draft = _fs(self.spark, f"{fs_path}.{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps({"version": version, "tables": self.tables}).encode()))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise RuntimeError(f"another writer has made version {version}")
        return version

    # ---------------------------------------------------------------- changes

    def merge(self, name: str, df: DataFrame, key: Sequence[str], rejects: str | None = None) -> None:
        """Create the table or upsert ``df`` into it: one row per ``key`` (the largest
        of the batch), which is also the order of its files."""
        key = list(key)
        entry = self._entry(name, df.schema, key)
        staged = scratch_path(self.spark, "staged")
        rows = one_row_per_key(_checked(df, key, rejects), key).select(*df.columns)
        tasks = max(1, self.spark.sparkContext.defaultParallelism)
        rows.repartitionByRange(tasks, *key).sortWithinPartitions(*key).write.parquet(staged)
        try:
            new = self.spark.read.schema(df.schema).parquet(staged)
            if entry is None:
                self._add(name, df.schema, key, new, self._bytes(staged), [], None)
                return
            touched = self._touched(entry, new, key)
            if touched:
                old = self.store._files(df.schema, [r["file"] for r in touched]).select(*df.columns)
                new = old.join(new.select(*key), key, "left_anti").select(*df.columns).unionByName(new)
            self._add(name, df.schema, key, new, sum(r["bytes"] for r in touched) + self._bytes(staged), touched, entry)
        finally:
            drop_scratch(self.spark, staged)

    def put(self, name: str, df: DataFrame, batch) -> None:
        """Put ``df`` in the place of what the table has of ``batch``."""
        rows = df.withColumn("batch", F.lit(batch))
        rows = rows.select("batch", *df.columns)
        entry = self._entry(name, rows.schema, ["batch"])
        folder = self._write(name, rows, [])
        had = None if entry is None else self.store._manifest(entry).where(F.col("lo.batch") != F.lit(batch))
        self._index(name, rows.schema, ["batch"], folder, had)

    def _entry(self, name: str, schema: T.StructType, key: list[str]) -> dict | None:
        if not re.fullmatch(r"\w+", name):
            raise ValueError(f"a table's name is letters, digits and _: {name!r}")
        entry = self.tables.get(name)
        if entry is not None and (entry["key"] != key or [f["name"] for f in entry["schema"]["fields"]] != schema.names):
            raise ValueError(f"table {name} has key {entry['key']} and other columns")
        return entry

    def _bytes(self, path: str) -> int:
        fs, at = _fs(self.spark, path)
        return int(fs.getContentSummary(at).getLength())

    def _touched(self, entry: dict, new: DataFrame, key: list[str]) -> list:
        """The files whose places the batch falls into, in order, with ``run``: which
        stretch of adjacent places each belongs to."""
        sizes = new.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).groupBy("f").agg(F.max("i").alias("last"))
        step = max(1, -(-(sizes.agg(F.sum(F.col("last") + 1)).first()[0] or 0) // RANGES))
        # the batch's files hold it in key order: of each range only its first and last row are looked at
        place = F.col("i") % step
        row = new.select(F.struct(*key).alias("k"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
        row = row.join(F.broadcast(sizes), "f").where(              # a row for each task that wrote the batch
            (place == 0) | (place == step - 1) | (F.col("i") == F.col("last")))
        ranges = row.groupBy("f", F.floor(F.col("i") / step).alias("i")).agg(F.min("k").alias("from"), F.max("k").alias("to"))
        order = Window.orderBy("lo")                               # the manifest's rows: one per file
        places = self.store._manifest(entry).select(
            "file", "bytes", "lo", F.lead("lo").over(order).alias("next"), F.row_number().over(order).alias("place"))
        meets = ((F.col("place") == 1) | (F.col("lo") <= F.col("to"))) & (F.col("next").isNull() | (F.col("from") < F.col("next")))
        hit = places.join(F.broadcast(ranges), meets, "left_semi")   # at most RANGES and a few rows
        found = [r.asDict() for r in hit.orderBy("place").collect()]
        run = 0
        for before, r in zip([None, *found], found, strict=False):
            run += before is None or r["place"] != before["place"] + 1
            r["run"] = run
        return found

    def _add(self, name: str, schema: T.StructType, key: list[str], rows: DataFrame, size: int, touched: list, entry: dict | None) -> None:
        """Write ``rows`` in key order and enter their files instead of the touched ones."""
        starts = [r["file"] for before, r in zip([None, *touched], touched, strict=False) if before is None or before["run"] != r["run"]]
        run = F.lit(1)
        if len(starts) > 1:                                        # files must not reach over places left alone
            first = self.spark.createDataFrame([(s,) for s in starts], "file string")
            bounds = self.store._manifest(entry).join(first, "file", "left_semi").agg(F.collect_list("lo")).scalar()
            rows = rows.withColumn(BOUNDS, bounds)
            run = F.greatest(F.size(F.filter(BOUNDS, lambda b: b <= F.struct(*key))), F.lit(1))
        # files below the target size are as many as there were: a small change does not cut a file of its own
        apart = min(self.spark.sparkContext.defaultParallelism, size // LEAST_BYTES, size if entry is None else len(touched))
        tasks = max(1, -(-size // self.store.target_bytes), apart)
        laid = rows.withColumn(RUN, run).select(*schema.names, RUN).repartitionByRange(tasks, RUN, *key).sortWithinPartitions(RUN, *key)
        folder = self._write(name, laid, [RUN])
        had = None
        if entry is not None:
            gone = self.spark.createDataFrame([(r["file"],) for r in touched], "file string")
            had = self.store._manifest(entry).join(gone, "file", "left_anti")
        self._index(name, schema, key, folder, had)

    def _write(self, name: str, rows: DataFrame, partition_by: list[str]) -> str:
        folder = f"data/{name}/{uuid.uuid4().hex[:16]}"
        rows.write.partitionBy(*partition_by).parquet(f"{self.store.root}/{folder}")
        return folder

    def _index(self, name: str, schema: T.StructType, key: list[str], folder: str, had: DataFrame | None) -> None:
        """The table's next manifest: rows for the files of ``folder`` and those in ``had``.
        A file holds its rows in key order, so its first and last row have its bounds."""
        written = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.store.root}/{folder}")
        path, at = F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at")
        sizes = written.select(path, at, F.col("_metadata.file_size").alias("size")).groupBy("path").agg(
            F.count(F.lit(1)).alias("rows"), F.max("size").alias("bytes"))
        # a row for each new file
        ends = written.select(F.struct(*key).alias("k"), path, at).join(F.broadcast(sizes), "path").where("at = 0 OR at = rows - 1")
        files = ends.groupBy(F.regexp_extract("path", r"(data/[^/]+/[^/]+/(?:__run=\d+/)?[^/]+)$", 1).alias("file")).agg(
            F.max("rows").alias("rows"), F.max("bytes").alias("bytes"), F.min("k").alias("lo"), F.max("k").alias("hi"))
        if had is not None:
            files = had.select("file", "rows", "bytes", "lo", "hi").unionByName(files)
        path = f"manifest/{name}-{uuid.uuid4().hex[:16]}"
        files.coalesce(1 + self.spark.sparkContext.defaultParallelism // 8).write.parquet(f"{self.store.root}/{path}")
        self.tables[name] = {"schema": json.loads(schema.json()), "key": key, "manifest": path}


# ------------------------------------------------------------ single tables

ROWS = "rows"


def upsert_table(spark: SparkSession, df: DataFrame, path: str, key: Sequence[str], rejects: str | None = None,
                 target_bytes: int = TARGET_BYTES) -> DataFrame:
    """K1/K2/K5: create-or-merge a table on any ``key``, a store of its own under
    ``path``; a small batch rewrites the files its keys fall into.  Returns a fresh read."""
    change = SnapshotStore(spark, path, target_bytes).begin()
    change.merge(ROWS, df, key, rejects)
    change.commit()
    return change.store.read(ROWS)


def write_keyed(df: DataFrame, path: str, key: Sequence[str]) -> None:
    """K2: create the table; fails if it exists."""
    if path_exists(df.sparkSession, path):
        raise FileExistsError(path)
    upsert_table(df.sparkSession, df, path, key)


#: Key of the table by type, which is its order: rows of a type and an actor lie together.
BY_TYPE = ["type", "actor", "id"]


def upsert_records_by_type(spark: SparkSession, df: DataFrame, path: str, rejects: str | None = None,
                           target_bytes: int = TARGET_BYTES) -> DataFrame:
    """K4/K9: the table keyed by type with (actor, id) clustering, the full record a
    regular column.  An import rewrites the files of its own actors, not the type."""
    return upsert_table(spark, df, path, BY_TYPE, rejects, target_bytes)


def records_of(spark: SparkSession, path: str, **equal) -> DataFrame:
    """Rows of the table by type with the given type, (type, actor) or (type, actor, id): only their files are opened."""
    return SnapshotStore(spark, path).read(ROWS, **equal)

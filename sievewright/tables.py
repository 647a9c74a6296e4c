"""Tables between stages: cutting lineage, and versioned snapshots with keyed upserts."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode, where tests run."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="sievewright-")
        atexit.register(shutil.rmtree, where, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` in the shared folder and reads it again, so that no lost executor brings its lineage back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Conflict(RuntimeError):
    """Another writer made the next version first."""


class Snapshots:
    """A table as a row of immutable versions in buckets of its key.

    ``_versions/<number>`` is a version's manifest: which folder holds each bucket.
    A writer puts its rows into folders of its own and then creates the next
    number, which fails where it is there already; the highest number is the
    table. So readers see a whole version, a run that dies anywhere leaves the
    table as it was, and two writers never lose each other's rows: the later one
    merges again. A manifest appears by a rename, complete or not at all.

    An upsert reads and rewrites only the buckets that its keys fall into. Old
    versions stay until :meth:`expire`.
    """

    def __init__(self, spark: SparkSession, path: str, schema, buckets: int = 32):
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.spark, self.path, self.schema, self.buckets = spark, path.rstrip("/"), schema, buckets

    def _at(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        """The numbers of the versions there are, in order."""
        fs, p = self._at("_versions")
        if not fs.exists(p):
            return []
        names = (f.getPath().getName() for f in fs.listStatus(p))
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest(self, version: int) -> dict:
        fs, p = self._at(f"_versions/{version:012d}")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """The version that holds and its manifest; 0 and an empty one for a table never written."""
        there = self.versions()
        return (there[-1], self._manifest(there[-1])) if there else (0, {"keys": [], "buckets": self.buckets, "parts": {}})

    def _commit(self, version: int, manifest: dict) -> None:
        jvm = self.spark._jvm
        fs, new = self._at(f"_versions/.{uuid.uuid4().hex}")
        _, final = self._at(f"_versions/{version:012d}")
        out = fs.create(new, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(new, final, no_options)  # unlike FileSystem.rename it never replaces a file
        except Exception as e:
            fs.delete(new, False)
            if fs.exists(final):
                raise Conflict(f"version {version} of {self.path} was made by another writer") from e
            raise

    def _read(self, manifest: dict, buckets: set[int] | None = None) -> DataFrame:
        """Rows of a version, or of those of its buckets; folders of an older schema get null for what they lack."""
        folders: dict[str, list[str]] = {}
        for bucket, folder in manifest["parts"].items():
            if buckets is None or int(bucket) in buckets:
                folders.setdefault(folder, []).append(f"{self.path}/{folder}/_bucket={bucket}")
        paths = [p for some in folders.values() for p in some]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The current table, or an older version that is still there."""
        return self._read(self.current()[1] if version is None else self._manifest(version))

    def _shaped(self, df: DataFrame) -> DataFrame:
        names = set(df.columns)
        return df.select(*[(F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _bucket(self, keys: list[str], buckets: int):
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int") if keys else F.lit(0)

    def _write(self, df: DataFrame, keys: list[str], buckets: int) -> dict[str, str]:
        """Writes the rows into a folder of its own; gives the folder of each bucket that has any."""
        folder = f"data-{uuid.uuid4().hex}"
        bucket = self._bucket(keys, buckets)
        rows = self._shaped(df).withColumn("_bucket", bucket)
        rows = rows.repartition(buckets, "_bucket") if keys else rows
        rows.write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        fs, p = self._at(folder)
        names = (f.getPath().getName() for f in fs.listStatus(p))
        return {n.partition("=")[2]: folder for n in names if n.startswith("_bucket=")}

    def overwrite(self, df: DataFrame) -> None:
        """Makes the rows the whole table, in the buckets of the version before."""
        version, old = self.current()
        parts = self._write(df, old["keys"], old["buckets"])
        self._commit(version + 1, {"keys": old["keys"], "buckets": old["buckets"], "parts": parts})

    def upsert(
        self, rows: DataFrame, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, order: str | None = None, attempts: int = 5,
    ) -> None:
        """Rows replace those of the same keys (null equals null); ``merge`` may combine old and new instead.

        Of rows given twice under one key the one greatest in ``order`` holds, and
        among equals (or without ``order``) the one whose JSON is last. ``merge`` sees the
        old rows of the touched buckets only. Where another writer was faster the
        merge is done again on what it left, ``attempts`` times in all.
        """
        rows = self._shaped(rows)
        others = [c for c in rows.columns if c not in keys]
        rank = [F.col(order)] if order else []
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*rank, F.to_json(F.struct(*others)))).alias("r")).select(*keys, "r.*") if others else rows.distinct()
        last = cut(last, "upsert")
        if merge is None:
            merge = lambda old, new: old.join(new, _same(old, new, keys), "left_anti").unionByName(new, allowMissingColumns=True)
        for attempt in range(attempts):
            version, old = self.current()
            kept = old["keys"] == list(keys)
            n = old["buckets"] if kept else self.buckets
            touched = {r[0] for r in last.select(self._bucket(keys, n)).distinct().collect()}  # at most n numbers
            merged = self._write(merge(self._read(old, touched if kept else None), last), list(keys), n)
            parts = {b: f for b, f in old["parts"].items() if kept and int(b) not in touched} | merged
            try:
                return self._commit(version + 1, {"keys": list(keys), "buckets": n, "parts": parts})
            except Conflict:
                if attempt + 1 == attempts:
                    raise

    def expire(self, keep: int = 10) -> None:
        """Removes all but the last ``keep`` versions and the folders that only they held.

        Not while a writer is at work on this table, whose folders no version names yet.
        """
        there = self.versions()
        gone, left = there[:-keep], there[-keep:]
        manifests = {v: self._manifest(v) for v in there}
        used = {f for v in left for f in manifests[v]["parts"].values()}
        for v in gone:
            fs, p = self._at(f"_versions/{v:012d}")
            fs.delete(p, False)
        for folder in {f for v in gone for f in manifests[v]["parts"].values()} - used:
            fs, p = self._at(folder)
            fs.delete(p, True)


def _same(a: DataFrame, b: DataFrame, keys: list[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


TRACE = ("source_name", "raw_file", "raw_offset")


def upsert_records(old: DataFrame, new: DataFrame) -> DataFrame:
    """Records matched on source, file and offset: the old id stays and the version goes up; others are added.

    A null offset equals a null offset. Both need the columns id, version,
    created_at and the three of the match; ``created_at`` stays the old one's.
    """
    keep = [F.col(f"o.{c}").alias(f"_{c}") for c in ("id", "version", "created_at")]
    on = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in TRACE]
    cond = on[0] & on[1] & on[2]
    known = new.alias("n").join(old.alias("o"), cond, "left").select("n.*", *keep)
    merged = known.select(
        *[
            F.coalesce("_id", "id").alias("id") if c == "id"
            else F.coalesce(F.col("_version") + 1, F.col("version")).cast("int").alias("version") if c == "version"
            else F.coalesce("_created_at", "created_at").alias("created_at") if c == "created_at"
            else F.col(c)
            for c in new.columns
        ]
    )
    untouched = old.alias("o").join(new.alias("n"), cond, "left_anti")
    return untouched.unionByName(merged, allowMissingColumns=True)


def stored(records: DataFrame, include_deduplicated: bool = False) -> DataFrame:
    """Records of the store; those merged into others only on demand."""
    return records if include_deduplicated else records.where("deduplicated_into is null")

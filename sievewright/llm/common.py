"""Shared helpers: reading tables, cutting lineage, words of a text."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only in local mode (tests on one machine) a temporary folder is made where the
    session names none, and removed at exit.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="sievewright-")
        atexit.register(shutil.rmtree, where, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def cut(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes ``df`` as a table in the shared folder and reads it again.

    The table outlives any executor, so a later stage never recomputes what came
    before. Returns the frame and its path, for :func:`drop`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Removes a table of :func:`cut` that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def apart(df: DataFrame, key: str) -> DataFrame:
    """``df`` partitioned otherwise than by ``key``, so that a join by it shuffles both sides.

    Adaptive execution splits a hot key's rows only in a join of two shuffles; an
    aggregation by the join's own key would else be joined in place, with all rows
    of the key in one task.
    """
    return df.repartition(F.xxhash64(F.col(key)))


def filled(col):
    """The string without blanks around it, null where nothing is left."""
    return F.nullif(F.regexp_replace(col, r"(?U)^\s+|\s+$", ""), F.lit(""))


#: A word: a run of letters and digits (``\w`` without the underscore).
WORD = re.compile(r"[^\W_]+")

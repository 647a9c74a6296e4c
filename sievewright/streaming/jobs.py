"""Structured Streaming jobs: ingestion and assignment of records as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.patterns import assign_sequential, assign_snapshot, updated_centroids
from ..tables import TRACE, Snapshots, upsert_records


def upsert_stream(rows: DataFrame, store: Snapshots, checkpoint: str) -> DataStreamWriter:
    """Every micro-batch is upserted; a batch given again after a failure changes versions only.

    A batch rewrites the buckets it falls into; the last ten versions are kept.
    """

    def batch(df: DataFrame, _: int) -> None:
        store.upsert(df, list(TRACE), upsert_records)
        store.expire(10)

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)


def assign_stream(rows: DataFrame, patterns: Snapshots, assignments: Snapshots, checkpoint: str, threshold: float = 0.80, sequential: bool = False) -> DataStreamWriter:
    """Assigns each micro-batch(id, embedding, ord), then moves the centroids; ids assigned before are left out."""

    def batch(df: DataFrame, epoch: int) -> None:
        known = assignments.read()
        fresh = df.dropDuplicates(["id"]).join(known.select(F.col("problem_id").alias("id")), "id", "left_anti").persist()
        current = patterns.read()
        step: Callable = assign_sequential if sequential else assign_snapshot
        got = step(fresh, current, threshold).where("pattern_id is not null").persist()
        moved = updated_centroids(got, fresh, current).join(current.drop("size", "centroid"), "pattern_id", "left")
        patterns.overwrite(moved.select(*[F.col(f.name) if f.name in moved.columns else F.lit(None).alias(f.name) for f in patterns.schema.fields]))
        assignments.upsert(got.select("problem_id", "pattern_id", "confidence", F.lit(None).cast("timestamp").alias("assigned_at")), ["problem_id"])
        fresh.unpersist(), got.unpersist()

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events by window and type; rows later than ``late`` are left out of windows that closed."""
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", late)
        .groupBy(F.window("ts", window), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
    )

"""Ingestion: scans, normalization, deduplication, validation, upsert, metrics and export."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import consolidate, find_duplicates
from ..operators.normalize import normalize, validate
from ..sources.readers import Source, read, read_all
from ..tables import TRACE, Snapshots, cut, upsert_records


@dataclass
class Ingested:
    records: DataFrame
    metrics: dict
    errors: list[str]


def dedup_records(records: DataFrame) -> DataFrame:
    """Consolidated records of normalized ones."""
    shape = records.withColumn("signature", F.col("canonical_solution.ast_signature"))
    return consolidate(records, find_duplicates(shape))


def metrics_of(records: DataFrame) -> DataFrame:
    """One row of counts and rates over consolidated, validated records."""
    n, dup = F.count("*"), F.count_if(F.col("deduplicated_into").isNotNull())
    kept = n - dup
    review = F.count_if(F.col("deduplicated_into").isNull() & F.col("validation.needs_review"))
    solved = F.count_if(F.col("deduplicated_into").isNull() & F.col("has_solution"))
    rate = lambda a, b: F.coalesce(F.round(a / F.nullif(b, F.lit(0)), 4), F.lit(0.0))
    return records.agg(
        n.alias("parsed"), dup.alias("duplicates"), kept.alias("stored"), solved.alias("with_solution"), review.alias("needs_review"),
        rate(dup, n).alias("duplicate_rate"), rate(review, kept).alias("needs_review_rate"),
    )


def scanned(spark: SparkSession, sources: list[Source]) -> tuple[DataFrame, list[str]]:
    """Raw problems of every source that can be read whole, each scanned once, and why the others can't be.

    A source's place in the list is its priority, whether others can be read or not.
    """
    out, errors = read_all(spark, []), []
    for k, s in enumerate(sources):
        try:
            rows = cut(read(spark, s).withColumn("source_idx", F.lit(k)), "scanned")
        except (PySparkException, ValueError, OSError) as e:
            errors.append(f"{s.name}: {str(e).splitlines()[0] if str(e) else type(e).__name__}")
            continue
        out = out.unionByName(rows)
    return out, errors


def ingest(spark: SparkSession, sources: list[Source], store: Snapshots | None = None, export: str | None = None, now=None) -> Ingested:
    """Runs the stages over all sources; nothing is stored or exported where nothing was parsed.

    All records are stored, duplicates too; metrics and export are of survivors.
    A source that can't be read, at its beginning or later, is left out and counted
    as an error with its reason.
    """
    raw, errors = scanned(spark, sources)
    records = cut(normalize(raw), "normalized")
    done = cut(validate(dedup_records(records)), "ingested")
    metrics = metrics_of(done).first().asDict() | {"errors": len(errors)}
    if metrics["parsed"] and store is not None:
        at = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
        rows = done.withColumns({"raw_file": F.col("ingest_trace.raw_file"), "raw_offset": F.col("ingest_trace.raw_offset"), "created_at": at, "updated_at": at})
        store.upsert(rows, list(TRACE), upsert_records, order="updated_at")
    if metrics["parsed"] and export:
        done.where("deduplicated_into is null").write.mode("overwrite").json(export)
    return Ingested(done, metrics, errors)


def export_document(rows: DataFrame, path: str) -> int:
    """Writes rows as one JSON array, indented, as they come from the cluster part by part; gives their number."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for r in rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("v")).toLocalIterator():
            text = json.dumps(json.loads(r.v), ensure_ascii=False, indent=2).replace("\n", "\n  ")
            f.write((",\n  " if n else "\n  ") + text)
            n += 1
        f.write("\n]\n" if n else "]\n")
    return n

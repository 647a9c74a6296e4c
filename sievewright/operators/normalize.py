"""From raw problems to canonical records: one projection, with schema inference in Arrow batches."""

from __future__ import annotations

import html
import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from ..functions import policy, text
from ..functions.values import infer_schema


_SHAPES = StructType([StructField("input_schema", StringType()), StructField("output_schema", StringType()), StructField("confidence", DoubleType())])


@F.pandas_udf(_SHAPES)
def schemas_of(examples: pd.Series) -> pd.DataFrame:
    """Of each record's examples: shapes of input and output as JSON, and how sure they are."""
    rows = []
    for ex in examples:
        ins, outs, conf = infer_schema([dict(e) if isinstance(e, dict) else e.asDict() for e in ex] if ex is not None and len(ex) else [])
        rows.append((json.dumps(ins), json.dumps(outs), conf))
    return pd.DataFrame(rows, columns=["input_schema", "output_schema", "confidence"])


@F.pandas_udf(ArrayType(StringType()))
def unescape_all(lists: pd.Series) -> pd.Series:
    """Every string with its HTML entities resolved."""
    return lists.map(lambda xs: [x if x is None else html.unescape(x) for x in xs], na_action="ignore")


def record_id():
    return F.sha2(F.concat_ws("|", "source_name", F.coalesce("raw_file", F.lit("")), F.coalesce(F.col("raw_offset").cast("string"), F.lit(""))), 256)


def normalize(raw: DataFrame) -> DataFrame:
    """Canonical records of raw problems, before deduplication; ``ord`` is their order of priority.

    Ids derive from source, file and offset, so a run repeated gives the same ones.
    The order is the source's place, then file, then offset (none first), carried
    as a struct, so no two records that differ in any of them tie.
    """
    none = F.array().cast("array<string>")
    raw = raw.withColumn("examples_raw", F.filter("examples_raw", lambda m: m["input"].isNotNull() & m["output"].isNotNull())).withColumns({
        "explanations": unescape_all(F.transform("examples_raw", lambda m: m["explanation"])),
        "constraints": unescape_all(F.coalesce("constraints", none)),
    })
    examples = F.zip_with(
        "examples_raw", "explanations",
        lambda m, e: F.struct(
            m["input"].alias("input"), m["output"].alias("output"),
            F.nullif(text.clean_text(e, entities=False), F.lit("")).alias("explanation"),
        ),
    )
    cleaned = F.filter(F.transform("constraints", lambda c: text.clean_text(c, entities=False)), lambda c: c != "")
    has = F.coalesce(F.length("solution_code") > 0, F.lit(False))
    base = raw.select(
        record_id().alias("id"),
        text.clean_text(F.col("title")).alias("title"),
        text.clean_text(F.col("description")).alias("description"),
        text.difficulty(F.col("difficulty")).alias("difficulty"),
        text.tags(F.col("tags")).alias("tags"),
        F.coalesce(examples, F.array().cast("array<struct<input:string,output:string,explanation:string>>")).alias("examples"),
        cleaned.alias("constraints"),
        has.alias("has_solution"),
        F.coalesce("is_premium", F.lit(False)).alias("is_premium"),
        F.when(
            has,
            F.struct(
                F.when(F.col("solution_language").isNull(), F.array().cast("array<string>")).otherwise(F.array("solution_language")).alias("languages"),
                F.array(F.sha2("solution_code", 256)).alias("code_hashes"),
                text.code_signature(F.col("solution_code")).alias("ast_signature"),
                F.col("solution_code").alias("code"),
            ),
        ).alias("canonical_solution"),
        policy.license_meta(F.col("license")).alias("license_meta"),
        F.struct("parser", "raw_file", "raw_offset", "commit_hash").alias("ingest_trace"),
        "source_name",
        F.array("source_name").alias("source_list"),
        F.struct("source_idx", "raw_file", "raw_offset").alias("ord"),
    )
    return (
        base.withColumn("s", schemas_of("examples"))
        .withColumn("data_unavailable", F.col("is_premium") & ~F.col("has_solution"))
        .withColumns({"input_schema": F.col("s.input_schema"), "output_schema": F.col("s.output_schema"), "schema_inference_confidence": F.col("s.confidence")})
        .withColumn(
            "fingerprints",
            F.struct(
                F.concat(F.lit("nl:"), "id").alias("nl_embedding_id"),
                F.when(F.col("has_solution"), F.concat(F.lit("code:"), "id")).alias("code_embedding_id"),
                text.content_hash(F.col("title"), F.col("description")).alias("content_hash"),
            ),
        )
        .withColumns({
            "aliases": F.array().cast("array<string>"),
            "deduplicated_into": F.lit(None).cast("string"),
            "version": F.lit(1),
            "history": F.array(F.struct(F.lit("normalized").alias("step"), F.concat(F.lit("parser="), F.col("ingest_trace.parser")).alias("detail"))),
        })
        .drop("s")
    )


def validate(records: DataFrame) -> DataFrame:
    """Adds review flags and their ordered reasons; no row is dropped."""
    c = F.col
    legal = c("license_meta.requires_legal_review")
    license_reason = F.array_compact(F.array(F.when(legal, F.concat(F.lit("license '"), c("license_meta.license"), F.lit("' requires legal review")))))
    reasons = F.concat(
        license_reason,
        policy.review_reasons(c("title"), c("description"), c("difficulty"), c("tags"), c("data_unavailable"), c("examples"), c("schema_inference_confidence")),
    )
    return records.withColumn(
        "validation",
        F.struct(
            (F.size(reasons) > 0).alias("needs_review"),
            policy.needs_schema_review(c("examples"), c("schema_inference_confidence")).alias("needs_schema_review"),
            legal.alias("requires_legal_review"),
            reasons.alias("reasons"),
        ),
    )

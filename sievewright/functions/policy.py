"""License classes and review reasons, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: Fixed values.
PERMISSIVE = ("mit", "apache-2.0", "bsd-3-clause", "bsd-2-clause", "cc0", "cc-by-4.0", "public-domain")
INTERNAL = ("educational", "research-only", "proprietary")
MIN_DESCRIPTION, MAX_DESCRIPTION, MIN_CONFIDENCE = 20, 20_000, 0.5


def license_key(c: Column) -> Column:
    return F.lower(strip(F.when(F.coalesce(c, F.lit("")) == "", "unknown").otherwise(c)))


def license_meta(c: Column) -> Column:
    """(license, requires_legal_review, public_allowed, internal_use_only)."""
    key = license_key(c)
    public, internal = key.isin(*PERMISSIVE), key.isin(*INTERNAL)
    return F.struct(c.alias("license"), (~public & ~internal).alias("requires_legal_review"), public.alias("public_allowed"), (~public).alias("internal_use_only"))


def review_reasons(title: Column, description: Column, difficulty: Column, tags: Column, unavailable: Column, examples: Column, confidence: Column) -> Column:
    """Ordered reasons for a review; empty where there is none."""
    n = F.length(description)
    blank = lambda c: strip(F.coalesce(c, F.lit(""))) == ""
    no_tags = (F.size(F.coalesce(tags, F.array().cast("array<string>"))) == 0) | (tags == F.array(F.lit("unknown")))
    has = F.coalesce(F.size(examples), F.lit(0)) > 0
    return F.array_compact(
        F.array(
            F.when(blank(title), "missing title"),
            F.when(blank(description), "missing description")
            .when(n < MIN_DESCRIPTION, f"description shorter than {MIN_DESCRIPTION} chars")
            .when(n > MAX_DESCRIPTION, f"description longer than {MAX_DESCRIPTION} chars"),
            F.when(difficulty == "unknown", "difficulty unknown/unnormalized"),
            F.when(no_tags, "no tags inferred"),
            F.when(unavailable, "premium-only problem with no solution/data available from any source"),
            F.when(~has, "no examples to infer schema from").when(
                confidence < MIN_CONFIDENCE,
                F.concat(F.lit("schema_inference_confidence "), confidence.cast("string"), F.lit(f" below threshold {MIN_CONFIDENCE}")),
            ),
        )
    )


def needs_schema_review(examples: Column, confidence: Column) -> Column:
    return (F.coalesce(F.size(examples), F.lit(0)) == 0) | (confidence < MIN_CONFIDENCE)

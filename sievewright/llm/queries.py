"""Queries of problems 1 to 9 over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import cut, table
from .components import group_matches
from .garble import garbled
from .folding import formatting_duplicates
from .history import arrivals, repeats
from .leaks import leaks
from .packing import pack_documents
from .survivors import build_survivors, field_choices, single_sources
from .vectors import clusters, described, nearest


def p1_copies(spark, sf_dir):
    return formatting_duplicates(table(spark, sf_dir, "canonical_records"))


def p1_found(spark, sf_dir):
    return p1_copies(spark, sf_dir).select("record_id", "group_id")


def _choices(spark, sf_dir):
    return field_choices(table(spark, sf_dir, "records"), table(spark, sf_dir, "sources"))


def p2_found(spark, sf_dir):
    return single_sources(_choices(spark, sf_dir))


def p2_survivors(spark, sf_dir):
    return build_survivors(table(spark, sf_dir, "records"), _choices(spark, sf_dir))


def p3_found(spark, sf_dir):
    return repeats(table(spark, sf_dir, "records"), table(spark, sf_dir, "new_records"))


def p3_arrivals(spark, sf_dir):
    return arrivals(table(spark, sf_dir, "records"), table(spark, sf_dir, "new_records"))


def p4_found(spark, sf_dir):
    return clusters(table(spark, sf_dir, "fingerprints"))[0]


def p4_clusters(spark, sf_dir):
    return described(clusters(table(spark, sf_dir, "fingerprints"))[1])


def p5_found(spark, sf_dir):
    return group_matches(table(spark, sf_dir, "dedup_matches"))


def p6_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "fingerprints"))


def p6_found(spark, sf_dir):
    return p6_neighbours(spark, sf_dir).select("record_id", "neighbor_id")


def p7_packed(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def p7_checked(spark, sf_dir):
    """What any packing of the documents must hold, counted over all of them."""
    placed, _ = cut(p7_packed(spark, sf_dir), "packed")
    bins = placed.groupBy("bin_id").agg(F.max(F.col("bin_offset") + F.col("n_tokens")).alias("end"), F.sum("n_tokens").alias("n"))
    docs = placed.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("n"), F.max(F.col("token_start") + F.col("n_tokens")).alias("end"))
    of_bins = bins.agg(F.count_if(F.col("end") > 2048).alias("overfull"), F.count_if(F.col("end") != F.col("n")).alias("overlapping"), (F.count("*") <= F.sum("n") / 2048 * 1.01 + 1).alias("within_a_percent"))
    of_docs = docs.agg(F.count("*").alias("n_documents"), F.count_if((F.col("n") <= 2048) & (F.col("pieces") > 1)).alias("split_though_short"), F.count_if(F.col("end") != F.col("n")).alias("with_gaps"))
    return of_docs.join(of_bins, how="cross").select("n_documents", "overfull", "overlapping", "split_though_short", "with_gaps", "within_a_percent")  # one row each


def _leaks(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "test_items"))


def p8_found(spark, sf_dir):
    return _leaks(spark, sf_dir).where("longest_run >= 12").select("doc_id", "item_id")


def p8_leaks(spark, sf_dir):
    return _leaks(spark, sf_dir)


def p9_found(spark, sf_dir):
    return garbled(table(spark, sf_dir, "documents")).select("doc_id")


def p9_restored(spark, sf_dir):
    return garbled(table(spark, sf_dir, "documents"))


def p9_checked(spark, sf_dir):
    """Of the documents found: how many bear lost characters, and how many are plain ASCII."""
    found = p9_found(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    lost = F.count_if(F.col("text").contains("\ufffd"))
    return found.agg(lost.alias("with_lost_characters"), F.count_if(~F.col("text").rlike("[^\\x00-\\x7f]")).alias("plain"), (lost > 0).alias("some_lost"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1].isdigit()}

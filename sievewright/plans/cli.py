"""Command line: ingest, mine, assign, re-author, run solutions and report.

    python -m sievewright.plans.cli ingest --source jsonl:/data/a.jsonl:name:MIT --store /tables/records --output /out/unified
    python -m sievewright.plans.cli mine --problems /out/unified --store /tables --report /out/patterns.md
    python -m sievewright.plans.cli patterns --store /tables --problems /out/unified --search tree
    python -m sievewright.plans.cli transform --problems /out/unified --store /tables --url http://127.0.0.1:11434/api/generate --limit 100
    python -m sievewright.plans.cli view --store /tables --list
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import compose_text
from ..operators import patterns as P
from ..operators import templates as T
from ..operators import views
from ..operators.clients import HttpClient
from ..operators.sandbox import sandbox
from ..schemas import ASSIGNMENT, CANONICAL, PATTERN, TEMPLATE, VARIANT
from ..session import session
from ..sources.readers import parse_spec
from ..tables import Snapshots, cut
from .ingest import export_document, ingest
from .mining import mine

RECORDS = CANONICAL + ", raw_file string, raw_offset bigint, created_at timestamp, updated_at timestamp"
CACHE = "text_hash string, embedding array<float>"


def _problems(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """The unified records, the first ``limit`` in their order if it isn't 0."""
    rows = spark.read.schema(CANONICAL).json(path)
    return rows.orderBy("ord", "id").limit(limit) if limit else rows


def embedded(problems: DataFrame, cache: Snapshots | None = None, embed=P.hashed_vectors) -> tuple[DataFrame, DataFrame]:
    """(problems with the vectors of their texts, ids that have no text to embed); known texts come from the cache, new ones go into it."""
    text = problems.select("id", compose_text(F.col("title"), F.col("description"), F.col("examples")).alias("text"))
    usable = (F.trim("id") != "") & (F.trim("text") != "")
    skipped, text = text.where(~F.coalesce(usable, F.lit(False))).select("id"), text.where(usable)
    if cache is None:
        return problems.join(embed(text), "id"), skipped
    vectors, grown = P.cached_embeddings(text, cache.read(), embed)
    cache.upsert(grown, ["text_hash"])
    return problems.join(vectors, "id"), skipped


def _arguments() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="sievewright")
    sub = ap.add_subparsers(dest="what", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--source", action="append", required=True, type=parse_spec)
    a.add_argument("--store")
    a.add_argument("--output")
    a.add_argument("--document", help="one JSON array of the surviving records")
    for name in ("mine", "assign", "transform", "sandbox"):
        a = sub.add_parser(name)
        a.add_argument("--problems", required=True)
        a.add_argument("--limit", type=int, default=0)
        a.add_argument("--store", required=name != "sandbox")
    for name in ("mine", "assign"):
        sub.choices[name].add_argument("--cache", action="store_true", help="keep embeddings under the store")
    a = sub.choices["mine"]
    a.add_argument("--min-cluster-size", type=int, default=10)
    a.add_argument("--report")
    a.add_argument("--json")
    sub.choices["assign"].add_argument("--threshold", type=float, default=0.80)
    a = sub.choices["transform"]
    a.add_argument("--url", default=HttpClient.url)
    a.add_argument("--model", default=HttpClient.model)
    a.add_argument("--variants", type=int, default=T.VARIANTS)
    a.add_argument("--pattern", action="append", help="only records of these patterns")
    a.add_argument("--per-pattern", type=int)
    sub.choices["sandbox"].add_argument("--timeout", type=float, default=5.0)
    a = sub.add_parser("patterns")
    a.add_argument("--store", required=True)
    a.add_argument("--problems")
    a.add_argument("--search", default="")
    a.add_argument("--pattern", help="the members of one pattern")
    a.add_argument("--by", choices=("size", "id"), default="size")
    a.add_argument("--limit", type=int, default=25)
    a.add_argument("--markdown")
    a.add_argument("--html")
    a = sub.add_parser("view")
    a.add_argument("--store", required=True)
    a.add_argument("--problems")
    a.add_argument("--list", action="store_true")
    a.add_argument("--review", action="store_true", help="only templates that need a review")
    a.add_argument("--limit", type=int, default=50)
    a.add_argument("--html")
    return ap


def _mine(spark: SparkSession, args, patterns: Snapshots, assignments: Snapshots) -> None:
    rows, skipped = embedded(_problems(spark, args.problems, args.limit), Snapshots(spark, f"{args.store}/embeddings", CACHE) if args.cache else None)
    p, got, metrics = mine(rows, args.min_cluster_size)
    patterns.overwrite(p.withColumns({"created_at": F.current_timestamp(), "template_id": F.lit(None).cast("string")}))
    assignments.overwrite(got.withColumn("assigned_at", F.current_timestamp()))
    summary = metrics.first().asDict() | {"skipped": skipped.count()}
    print(json.dumps(summary, indent=1))
    if args.report:
        with open(args.report, "w", encoding="utf-8") as f:
            f.write(views.markdown(patterns.read(), summary))
    if args.json:  # a row for each pattern, which mining bounds
        found = [json.loads(r.v) for r in patterns.read().orderBy("pattern_id").select(F.to_json(F.struct("*")).alias("v")).toLocalIterator()]
        with open(args.json, "w", encoding="utf-8") as f:
            json.dump({"summary": summary, "patterns": found}, f, ensure_ascii=False, indent=2)


def _assign(spark: SparkSession, args, patterns: Snapshots, assignments: Snapshots) -> None:
    rows, _ = embedded(_problems(spark, args.problems, args.limit), Snapshots(spark, f"{args.store}/embeddings", CACHE) if args.cache else None)
    current = patterns.read()
    fresh = rows.join(assignments.read().select(F.col("problem_id").alias("id")), "id", "left_anti")
    got = cut(P.assign_sequential(fresh, current, args.threshold), "assigned")
    new = P.new_patterns(got, fresh).drop("size", "centroid", "difficulty")
    known = current.drop("size", "centroid").unionByName(new.withColumns({"difficulty": F.lit(None).cast("map<string,bigint>"), "created_at": F.current_timestamp(), "template_id": F.lit(None).cast("string")}))
    patterns.overwrite(P.updated_centroids(got, fresh, current).join(known, "pattern_id", "left"))
    assignments.upsert(got.select("problem_id", "pattern_id", "confidence", F.current_timestamp().alias("assigned_at")), ["problem_id"], order="assigned_at")
    print(json.dumps({"assigned": got.count(), "new_patterns": got.where("is_new").count()}))


def transform(problems: DataFrame, client_of, patterns: Snapshots, assignments: Snapshots, templates: Snapshots, variants: Snapshots, count: int = T.VARIANTS, only: list[str] | None = None, each: int | None = None) -> DataFrame:
    """Re-authors the problems that have no template yet, stores templates, variants and links; gives the results."""
    labelled = T.with_labels(problems, assignments.read(), patterns.read())
    labelled = T.for_patterns(labelled, only, each) if only else labelled
    rows = labelled.select("id", "pattern", "data_unavailable", F.to_json(F.struct(*problems.columns)).alias("record"))
    results = cut(T.run_templates(rows, client_of, templates.read(), count), "templates")
    templates.upsert(T.template_rows(results), ["template_id"])
    fresh = T.variant_rows(results)
    if not fresh.isEmpty():
        variants.upsert(fresh, ["template_id", "variant_seed"])
    ids = patterns.read().select("pattern_id", "label")
    linked = results.join(ids.withColumnRenamed("label", "pattern"), "pattern").drop("pattern").withColumnRenamed("pattern_id", "pattern")
    patterns.overwrite(T.link_patterns(patterns.read(), linked))
    return results


def main(argv: list[str] | None = None) -> int:
    args = _arguments().parse_args(argv)
    spark = session()
    at = lambda name, schema: Snapshots(spark, f"{args.store}/{name}", schema)
    if args.what == "ingest":
        store = Snapshots(spark, args.store, RECORDS) if args.store else None
        done = ingest(spark, args.source, store, args.output)
        for e in done.errors:
            print(e, file=sys.stderr)
        if args.document:
            export_document(done.records.where("deduplicated_into is null").orderBy("ord"), args.document)
        print(json.dumps(done.metrics, indent=1))
        return 0
    if args.what == "sandbox":
        r = _problems(spark, args.problems, args.limit).where("has_solution")
        got = sandbox(r.select("id", "canonical_solution.code", "canonical_solution.languages", "examples"), timeout=args.timeout)
        print(json.dumps({r["outcome"]: r["n"] for r in got.groupBy("outcome").agg(F.count("*").alias("n")).orderBy("outcome").collect()}, indent=1))
        return 0
    patterns, assignments = at("patterns", PATTERN), at("assignments", ASSIGNMENT)
    if args.what == "mine":
        _mine(spark, args, patterns, assignments)
    elif args.what == "assign":
        _assign(spark, args, patterns, assignments)
    elif args.what == "transform":
        problems = _problems(spark, args.problems, args.limit)
        url, model = args.url, args.model
        results = transform(problems, lambda: HttpClient(url, model), patterns, assignments, at("templates", TEMPLATE), at("variants", VARIANT), args.variants, args.pattern, args.per_pattern)
        print(json.dumps(T.template_metrics(results).first().asDict(), indent=1))
        for r in T.first_rejections(T.rejections(results, problems)).collect():
            print(f"{r.canonical_problem_id} {r.title}: {r.status}: {'; '.join(r.reasons or [])}", file=sys.stderr)
    elif args.what == "patterns":
        problems = _problems(spark, args.problems) if args.problems else spark.createDataFrame([], CANONICAL)
        if args.pattern:
            rows = views.pattern_detail(args.pattern, patterns.read(), assignments.read(), problems).orderBy("problem_id").limit(args.limit)
            for r in rows.collect():
                print(f"{r.problem_id}  {r.difficulty:<8} {r.title}\n    {(r.snippet or '').strip()}")
            return 0
        found = views.search_patterns(patterns.read(), problems, args.search, args.by, args.limit)
        print(views.table_text(found, args.limit))
        if args.markdown:
            with open(args.markdown, "w", encoding="utf-8") as f:
                f.write(views.markdown(found, {"search": args.search}))
        if args.html:
            with open(args.html, "w", encoding="utf-8") as f:
                f.write(views.dashboard(found, ["pattern_id", "label", "size", "top_tags", "representative_title"], {"search": args.search}))
    else:
        templates = at("templates", TEMPLATE).read()
        templates = views.split_by_review(templates)[1] if args.review else templates
        if args.list or not args.html:
            print(views.templates_text(templates, args.limit))
        if args.html:
            problems = _problems(spark, args.problems) if args.problems else spark.createDataFrame([], CANONICAL)
            rows = views.run_data(templates, at("variants", VARIANT).read(), problems)
            with open(args.html, "w", encoding="utf-8") as f:
                f.write(views.dashboard(rows, ["template_id", "pattern", "canonical_title", "canonical_difficulty", "n_variants", "needs_review"], {}, "Templates"))
    return 0


if __name__ == "__main__":
    sys.exit(main())

import random

import pytest
from pyspark.sql import functions as F

from sievewright.operators import dedup
from sievewright.plans.ingest import dedup_records, ingest, metrics_of
from sievewright.operators.normalize import normalize, validate
from sievewright.schemas import RAW
from sievewright.sources.readers import Source
from sievewright.tables import Snapshots

LONG = "Given an array of integers nums and an integer target, return indices of the two numbers that add up to target."


@pytest.mark.parametrize("seed", range(3))
def test_resolution_is_the_greedy_pass(spark, seed):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(60)} | {(k, k + 1) for k in range(100, 130)}
    df = spark.createDataFrame([(a, b, "s", 1.0) for a, b in pairs], "a long, b long, stage string, score double")
    assert {r.ord: r.canonical_ord for r in dedup.resolve(df).collect()} == dedup.greedy(list(pairs))


def test_resolution_of_nothing(spark):
    assert dedup.resolve(spark.createDataFrame([], "a long, b long, stage string, score double")).count() == 0


def raw(title, description, offset, source_idx=0, code=None, **kw):
    row = dict(title=title, description=description, difficulty="Easy", tags=["array"], examples_raw=[{"input": "a = 1", "output": "1"}], constraints=[], solution_code=code,
               solution_language="python" if code else None, is_premium=False, extra=None, source_name=f"s{source_idx}", source_url=None, license="MIT",
               raw_file="f", raw_offset=offset, parser="p", commit_hash=None, source_idx=source_idx)
    return row | kw


def frame(spark, rows):
    return normalize(spark.createDataFrame(rows, RAW + ", source_idx int"))


def test_consolidate(spark):
    rows = [
        raw("Two Sum", LONG, 0, tags=[]), raw("two  SUM!", "", 1, code="def f(): pass", tags=["Hash Table"]), raw("Two Sum Problem", LONG, 2, 1, is_premium=True),
        raw("Two Sum II", LONG, 3, 1), raw("Other Thing", "Something else entirely happens in this text about trees and heaps.", 4, 1), raw("数组", LONG, 5, 1), raw("数组", LONG, 6, 1),
    ]
    got = {r.title: r for r in dedup_records(frame(spark, rows)).collect()}
    first = got["Two Sum"]
    assert first.deduplicated_into is None and first.version == 3 and first.has_solution and first.is_premium and not first.data_unavailable
    assert first.tags == ["unknown", "hash-map", "array"] and first.source_list == ["s0", "s1"] and first.aliases == ["two SUM!", "Two Sum Problem"]
    assert got["two SUM!"].deduplicated_into == got["Two Sum Problem"].deduplicated_into == first.id
    assert got["Two Sum II"].deduplicated_into is None and got["Other Thing"].deduplicated_into is None
    done = validate(dedup_records(frame(spark, rows)))
    m = metrics_of(done).first()
    assert (m.parsed, m.duplicates, m.stored) == (7, 2, 5)


def test_code_matches_need_related_titles(spark):
    code = "def f(a):\n  return a"
    rows = [raw("Sum of Trees", "first text here", 0, code=code), raw("Sum of Heaps", "wholly different words", 1, code="# c\n" + code), raw("Unrelated", "third kind", 2, code=code)]
    r = frame(spark, rows)
    m = dedup.find_duplicates(r.withColumn("signature", F.col("canonical_solution.ast_signature"))).collect()
    assert [(x.stage, x.score) for x in m] == [("code_ast", 1.0)]


def test_chains_keep_the_middle_apart(spark):
    """B matches A and C matches B only: B goes to A, C stays."""
    df = spark.createDataFrame([(1, 2, "s", 1.0), (2, 3, "s", 1.0)], "a long, b long, stage string, score double")
    assert {(r.canonical_ord, r.ord) for r in dedup.resolve(df).collect()} == {(1, 2)}


def test_empty(spark):
    assert dedup_records(frame(spark, [])).count() == 0


def test_ingest_twice(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"title": "Two Sum", "description": "%s"}\nnot json\n\n{"title": "two sum"}\n{"x": 1}\n[1]\n{"task_id": "three-sum", "level": 3}\n' % LONG)
    (tmp_path / "b.csv").write_text("Title,Description,Tags,Constraints\nCsv One,\"a, b\",\"x, y\",p;q\n,none,,\n")
    schema = "id string, title string, deduplicated_into string, version int, source_name string, raw_file string, raw_offset bigint, created_at timestamp, updated_at timestamp"
    store = Snapshots(spark, str(tmp_path / "store"), schema)
    sources = [Source("jsonl", str(tmp_path / "a.jsonl"), "one"), Source("csv", str(tmp_path / "b.csv"), "two"), Source("json", str(tmp_path / "none.json"), "gone")]
    for n in (1, 2):
        got = ingest(spark, sources, store, str(tmp_path / "out"), now="2024-01-01 00:00:00")
        assert (got.metrics["parsed"], got.metrics["duplicates"], got.metrics["errors"]) == (4, 1, 1)
        rows = {r.title: r for r in store.read().collect()}
        assert len(rows) == 4 and rows["Two Sum"].raw_offset == 0 and rows["two sum"].raw_offset == 3 and rows["Three Sum"].raw_offset == 6
        assert rows["Csv One"].version == n and rows["two sum"].deduplicated_into == rows["Two Sum"].id
    assert spark.read.json(str(tmp_path / "out")).count() == 3

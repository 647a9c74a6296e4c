"""Snapshots that survive dying writers, the order of records, and the commands end to end."""

import json

import pytest
from pyspark.sql import functions as F

from sievewright.operators import templates as T
from sievewright.operators import views
from sievewright.operators.clients import ScriptedClient
from sievewright.plans import cli
from sievewright.plans.ingest import dedup_records, export_document, ingest
from sievewright.schemas import ASSIGNMENT, PATTERN, TEMPLATE, VARIANT
from sievewright.sources.readers import Source, read_pages, read_problems
from sievewright.tables import Conflict, Snapshots
from test_dedup import LONG, frame, raw

KN = "k string, n long"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), KN)


def content(store):
    return {(r.k, r.n) for r in store.read().collect()}


def test_a_writer_that_dies_before_its_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    t = Snapshots(spark, str(tmp_path / "t"), KN)
    t.upsert(rows(spark, ("a", 1), ("b", 2), ("c", 3)), ["k"])
    with monkeypatch.context() as m:
        m.setattr(Snapshots, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            t.upsert(rows(spark, ("a", 9)), ["k"])
        with pytest.raises(RuntimeError):
            t.overwrite(rows(spark, ("z", 9)))
    assert content(t) == {("a", 1), ("b", 2), ("c", 3)} and t.versions() == [1]
    t.upsert(rows(spark, ("a", 5)), ["k"])
    assert content(t) == {("a", 5), ("b", 2), ("c", 3)} and t.versions() == [1, 2]
    assert {(r.k, r.n) for r in t.read(1).collect()} == {("a", 1), ("b", 2), ("c", 3)}


def test_a_manifest_half_written_is_no_version(spark, tmp_path):
    t = Snapshots(spark, str(tmp_path / "t"), KN)
    t.overwrite(rows(spark, ("a", 1)))
    (tmp_path / "t" / "_versions" / ".0123").write_text('{"keys"')
    assert content(t) == {("a", 1)} and t.versions() == [1]


def test_two_writers_lose_no_row(spark, tmp_path):
    """The second writer commits while the first is merging: the first merges again."""
    t = Snapshots(spark, str(tmp_path / "t"), KN)
    t.upsert(rows(spark, ("a", 1)), ["k"])
    other, met = Snapshots(spark, str(tmp_path / "t"), KN), []

    def merge(old, new):
        if not met:
            met.append(1)
            other.upsert(rows(spark, ("b", 2)), ["k"])
        return old.join(new, "k", "left_anti").unionByName(new)

    t.upsert(rows(spark, ("a", 7), ("c", 3)), ["k"], merge)
    assert content(t) == {("a", 7), ("b", 2), ("c", 3)}
    with pytest.raises(Conflict):
        t._commit(2, {})


def test_upserts_rewrite_touched_buckets_only(spark, tmp_path):
    t = Snapshots(spark, str(tmp_path / "t"), KN, buckets=8)
    t.upsert(rows(spark, *[(f"k{i}", i) for i in range(200)]), ["k"])
    before = t.current()[1]["parts"]
    t.upsert(rows(spark, ("k3", -3)), ["k"])
    after = t.current()[1]["parts"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(content(t)) == 200
    t.expire(1)
    assert t.versions() == [2] and len(content(t)) == 200
    t.upsert(rows(spark, ("k3", 1000)), ["n"])  # other keys: the whole table is laid anew
    assert len(content(t)) == 201


def test_the_order_column_decides_between_equal_keys(spark, tmp_path):
    t = Snapshots(spark, str(tmp_path / "t"), "k string, n long, at int")
    t.upsert(spark.createDataFrame([("a", 9, 1), ("a", 2, 5), ("a", 3, 5)], "k string, n long, at int"), ["k"], order="at")
    assert [(r.n, r.at) for r in t.read().collect()] == [(3, 5)]


def test_many_files_never_share_an_order(spark):
    """Four thousand files with a problem at the same line each: every record has a place of its own."""
    made = [raw(f"Unlike {k} words{k}", "", 0, raw_file=f"/data/part-{k}.json") for k in range(4000)]
    n = frame(spark, made)
    assert n.select("ord").distinct().count() == 4000
    some = frame(spark, made[:40] + [raw("Unlike 3 words3", LONG, 0, raw_file="/data/z")])
    done = dedup_records(some)
    assert done.count() == 41 and done.where("deduplicated_into is not null").count() == 1


def test_entities_in_constraints_and_explanations(spark):
    r = raw("A", LONG, 0, constraints=["1 &lt;= n &lt;= 5", "&nbsp;", None], examples_raw=[{"input": "a = 1", "output": "2", "explanation": "x &amp; y"}, {"input": "b", "output": "1"}, {"input": "c"}])
    got = frame(spark, [r]).first()
    assert got.constraints == ["1 <= n <= 5"] and [e.explanation for e in got.examples] == ["x & y", None]


def test_a_source_that_fails_is_named_and_the_rest_ingested(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"title": "Two Sum", "description": LONG}) + "\n")
    got = ingest(spark, [Source("json", str(tmp_path / "none"), "gone"), Source("jsonl", str(tmp_path / "a.jsonl"), "one"), Source("odd", "x", "strange")])
    assert got.metrics["parsed"] == 1 and got.metrics["errors"] == 2 and [e.split(":")[0] for e in got.errors] == ["gone", "strange"]
    assert got.records.first().ord.source_idx == 1
    assert export_document(got.records, str(tmp_path / "all.json")) == 1
    assert json.loads((tmp_path / "all.json").read_text())[0]["title"] == "Two Sum"


def test_problems_root_and_page_tables(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"problems": [{"id": 1}, {"id": 2}]}')
    assert read_problems(spark, str(tmp_path / "r.json")).count() == 2
    pages = spark.createDataFrame([("p1", "<h1>T</h1><div class='description'>d</div>", 7), ("p2", None, 8), ("p3", "", 9)], "raw_file string, text string, offset long")
    assert [(r.title, r.raw_file, r.raw_offset) for r in read_pages(pages, Source("html", "", "s")).collect()] == [("T", "p1", 7)]


CODE = "class Solution:\n    def total(self, a, b):\n        return a + b\n"


def test_commands_end_to_end(spark, tmp_path, capsys):
    texts = {"apples": "Add both given numbers of fruit.", "pears": "Two piles stand in a yard; how large are they together?", "plums": "Return what the first and second argument make when joined."}
    lines = [{"title": f"Total {w} number", "description": d, "tags": ["math"], "examples": [{"input": "a = 1, b = 2", "output": "3"}], "solution": CODE.replace("total", f"total_{w}")} for w, d in texts.items()]
    (tmp_path / "p.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    store, out = str(tmp_path / "s"), str(tmp_path / "o")
    run = lambda *a: (cli.main(list(a)), capsys.readouterr().out)[1]
    assert json.loads(run("ingest", "--source", f"jsonl:{tmp_path}/p.jsonl:one:MIT", "--output", out, "--document", str(tmp_path / "d.json")))["parsed"] == 3
    assert len(json.loads((tmp_path / "d.json").read_text())) == 3
    mined = json.loads(run("mine", "--problems", out, "--store", store, "--min-cluster-size", "3", "--cache", "--json", str(tmp_path / "patterns.json"), "--report", str(tmp_path / "r.md")))
    assert mined["n_records"] == 3 and "summary" in json.loads((tmp_path / "patterns.json").read_text())
    assert json.loads(run("assign", "--problems", out, "--store", store, "--cache"))["assigned"] + mined["clustered_records"] == 3
    assert "Pattern ID" in run("patterns", "--store", store, "--problems", out, "--html", str(tmp_path / "p.html"))
    assert json.loads(run("sandbox", "--problems", out, "--limit", "2")) == {"ok": 2}

    def answer(prompt):
        spec = json.JSONDecoder().raw_decode(prompt[prompt.index("SPEC:\n") + 6 :])[0]["canonical_problem"]
        return json.dumps({"title": spec["title"] + "!", "description": "d", "sample_public_tests": [{"input": "a = 1, b = 2", "output": "3"}], "tie_breaker": "none",
                           "input_schema": {"properties": {"a": {"type": "integer"}, "b": {"type": "integer"}}}})

    at = lambda name, schema: Snapshots(spark, f"{store}/{name}", schema)
    tables = at("patterns", PATTERN), at("assignments", ASSIGNMENT), at("templates", TEMPLATE), at("variants", VARIANT)
    results = cli.transform(cli._problems(spark, out), lambda: ScriptedClient(answer), *tables, count=2)
    assert {r.status for r in results.collect()} == {"accepted"} and {r.provenance.license for r in results.collect()} == {"MIT"}
    assert tables[2].read().count() == 3 and tables[3].read().count() == 6
    assert cli.transform(cli._problems(spark, out), lambda: ScriptedClient(answer), *tables, count=2).count() == 0  # all have templates
    assert "Total apples number!" in run("view", "--store", store, "--list") and tables[0].read().where("template_id is not null").count() > 0


def test_shares_reviews_and_per_pattern_records(spark):
    p = spark.createDataFrame([("p", {"easy": 3, "hard": 1}), ("q", {"easy": 0})], "pattern_id string, difficulty map<string,bigint>")
    assert {(r.pattern_id, r.difficulty, r.share) for r in views.difficulty_share(p).collect()} == {("p", "easy", 0.75), ("p", "hard", 0.25), ("q", "easy", 0.0)}
    t = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "template_id string, needs_review boolean")
    assert [sorted(r.template_id for r in part.collect()) for part in views.split_by_review(t)] == [["b", "c"], ["a"]]
    r = spark.createDataFrame([(f"r{k}", "x" if k < 4 else "y") for k in range(6)], "id string, pattern string")
    assert sorted(x.id for x in T.for_patterns(r, ["x"], 2).collect()) == ["r0", "r1"] and T.for_patterns(r, ["y"]).count() == 2
    bad = spark.createDataFrame([(f"r{k:02d}",) for k in range(30)], "canonical_problem_id string")
    assert [x[0] for x in T.first_rejections(bad, 2).collect()] == ["r00", "r01"]
    q = views.question_payload(r.withColumn("embedding", F.array(F.lit(1.0))), spark.createDataFrame([("r0", "p")], "problem_id string, pattern_id string"), spark.createDataFrame([("p", "l")], "pattern_id string, label string"))
    assert json.loads(q.where("id = 'r0'").first().question) == {"id": "r0", "pattern_id": "p", "pattern_label": "l"}

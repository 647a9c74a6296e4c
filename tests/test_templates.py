import json

import pytest
from pyspark.sql import functions as F

from sievewright.operators import sandbox as S
from sievewright.operators import templates as T
from sievewright.operators import views
from sievewright.operators.clients import HttpClient, ModelError, ScriptedClient, default_client
from sievewright.tables import Snapshots

CODE = "class Solution:\n    def twoSum(self, nums, target):\n        for i, a in enumerate(nums):\n            for j in range(i):\n                if nums[j] + a == target:\n                    return (j, i)\n        return []\n"
RECORD = {"id": "r1", "title": "Two Sum", "description": "d", "tags": ["array"], "examples": [{"input": "nums = [2,7], target = 9", "output": "[0,1]"}],
          "canonical_solution": {"code": CODE, "languages": ["Python"]}, "output_schema": {"type": "array<integer>"}}
GOOD = {"title": "Pairs", "description": "x", "tie_breaker": "first", "input_schema": {"properties": {"xs": {"type": "array<integer>"}, "t": {"type": "integer"}}},
        "output_schema": {"type": "array<integer>"}, "sample_public_tests": [{"input": "xs = [1,2], t = 3", "output": "[0, 1]"}],
        "notes_for_variant_generator": {"n_range": [2, 4], "value_range": ["low", "high"]}}


@pytest.mark.parametrize(
    "code,entry",
    [(CODE, ("method", "twoSum", ["nums", "target"])), ("def _h(): pass\ndef g(a, b): pass", ("function", "g", ["a", "b"])), ("x = (", None), ("", None), (None, None), ("class Solution:\n  def _x(self): pass", None)],
)
def test_entry_points(code, entry):
    assert S.entry_point(code) == entry


def test_run_code_outcomes():
    entry = ("function", "f", ["x"])
    assert S.run_code("def f(x): return Counter(x).most_common(1)[0][0]", entry, {"x": "aab"}).value == "a"
    assert "ZeroDivisionError" in S.run_code("def f(x): return 1 / x", entry, {"x": 0}).error
    assert S.run_code("def f(x):\n  while True: pass", entry, {"x": 0}, timeout=1).timed_out
    assert S.run_code("def f(x): return len(bytearray(10**9))", entry, {"x": 0}).memory_exceeded
    assert S.run_code("import sys\ndef f(x): sys.exit(3)", entry, {"x": 0}).error


def test_calls_start_one_python_and_share_nothing(monkeypatch):
    started, popen = [], S.subprocess.Popen
    monkeypatch.setattr(S.subprocess, "Popen", lambda *a, **k: started.append(a) or popen(*a, **k))
    code, entry = "import math\nn = globals().get('n', 0) + 1\nmath.seen = getattr(math, 'seen', 0) + 1\ndef f(x): return [n, math.seen, x]", ("function", "f", ["x"])
    assert [S.run_code(code, entry, {"x": k}).value for k in range(30)] == [[1, 1, k] for k in range(30)]
    assert len(started) <= 1  # a Python for every call took 0.1 to 0.2 s each
    assert S.run_code("def f(x): print('a' * 300000); return 'b' * 300000", entry, {"x": 0}).value == "b" * 300000
    assert S.run_code("import os\ndef f(x): os._exit(3)", entry, {"x": 0}).error == "exit code 3"
    assert S.run_code("import os, threading\ndef f(x): threading.Thread(target=lambda: __import__('time').sleep(9)).start()", entry, {"x": 0}, timeout=1).timed_out
    assert S.run_code(code, entry, {"x": 5}).value == [1, 1, 5]


def test_a_call_that_ends_the_starter(monkeypatch):
    monkeypatch.setattr(S, "_starter", None)
    entry = ("function", "f", ["x"])
    assert S.run_code("import os, signal, time\ndef f(x): os.kill(os.getppid(), signal.SIGKILL); time.sleep(1)", entry, {"x": 0}).error
    assert S.run_code("def f(x): return x", entry, {"x": 4}).value == 4


def test_sandbox_frame(spark):
    rows = [("a", CODE, ["python"], [("nums = [2,7], target = 9", "[0, 1]", None), ("nums = [2,7], target = 9", "[1, 0]", None)]), ("b", CODE, ["java"], []), ("c", CODE, ["python"], []), ("d", "x=", ["python"], [("a = 1", "1", None)]), ("e", None, None, None)]
    df = spark.createDataFrame(rows, "id string, code string, languages array<string>, examples array<struct<input:string,output:string,explanation:string>>")
    got = {r.id: (r.outcome, r.n_cases, r.n_passed, r.all_passed) for r in S.sandbox(df).collect()}
    assert got == {"a": ("ok", 2, 1, False), "b": ("unsupported_language", 0, 0, False), "c": ("no_examples", 0, 0, False), "d": ("no_entry_point", 0, 0, False), "e": ("unsupported_language", 0, 0, False)}


def test_variants_start_one_python(monkeypatch):
    started, popen = [], S.subprocess.Popen
    monkeypatch.setattr(S.subprocess, "Popen", lambda *a, **k: started.append(a) or popen(*a, **k))
    assert len(T.reauthor(RECORD, ScriptedClient(script=[json.dumps(GOOD)]), "p", count=20)["variants"]) == 20
    assert len(started) <= 1


def test_reauthor_accepts_after_a_bad_answer():
    client = ScriptedClient(script=["no json", "```json\n" + json.dumps(GOOD) + "\n```"])
    out = T.reauthor(RECORD, client, "p", count=3)
    assert out["status"] == "accepted" and out["attempts"] == 2 and not out["reasons"] and len(out["variants"]) == 3
    assert out == T.reauthor(RECORD, ScriptedClient(script=[json.dumps(GOOD)]), "p", count=3) | {"attempts": 2}


@pytest.mark.parametrize(
    "change,status,reason",
    [
        ({"sample_public_tests": [{"input": "xs = [1,2], t = 3", "output": "[9]"}]}, "rejected_validation_failed", "did not reproduce"),
        ({"sample_public_tests": [{"input": "xs = [1,2]", "output": "[9]"}]}, "rejected_validation_failed", "did not reproduce"),
        ({"sample_public_tests": []}, "rejected_validation_failed", "zero sample_public_tests"),
        ({"title": 3}, "rejected_malformed", "schema validation failed: title"),
        ({"tie_breaker": ""}, "accepted", "tie_breaker"),
        ({"output_schema": {"type": "integer"}}, "accepted", "shape changed"),
        ({"input_schema": {"properties": {"xs": {"type": "array<array<integer>>"}}}}, "accepted", "skipped"),
    ],
)
def test_reauthor_verdicts(change, status, reason):
    out = T.reauthor(RECORD, ScriptedClient(script=[json.dumps(GOOD | change)]), "p", count=1)
    assert out["status"] == status and reason in "; ".join(out["reasons"])


def test_reauthor_without_solution_or_model():
    assert T.reauthor(RECORD | {"canonical_solution": None}, ScriptedClient(script=[json.dumps(GOOD)]), "p")["status"] == "rejected_validation_failed"
    assert "could not produce" in T.reauthor(RECORD, ScriptedClient(), "p")["reasons"][0]
    client = HttpClient("http://127.0.0.1:9/x", retries=1, pause=0.01)
    with pytest.raises(ModelError):
        client.call("x", timeout=0.2)
    assert T.reauthor(RECORD, client, "p")["status"] == "failed_call" and isinstance(default_client(), ScriptedClient)


def test_template_run_gates_and_reports(spark):
    rows = [(f"r{k}", json.dumps(RECORD | {"id": f"r{k}"}), "p1", k == 2) for k in range(4)] + [("", "{}", "p", False), (None, "{}", "p", False)]
    df = spark.createDataFrame(rows, "id string, record string, pattern string, data_unavailable boolean")
    done = spark.createDataFrame([("r3",)], "canonical_problem_id string")
    answer = json.dumps(GOOD)
    out = T.run_templates(df, lambda: ScriptedClient(script=[answer]), done, count=1).persist()
    assert T.template_metrics(out).first().asDict() == {"processed": 3, "accepted": 2, "rejected_malformed": 0, "rejected_validation_failed": 1, "failed_call": 0, "needs_review": 0, "variants": 2, "acceptance_rate": 0.6667}
    assert {(r.category, r.n) for r in T.rejection_histogram(out).collect()} == {("data unavailable", 1)}
    assert (T.template_rows(out).count(), T.variant_rows(out).count()) == (2, 2)
    gone = T.rejections(out, spark.createDataFrame([], "id string, title string, difficulty string")).collect()
    assert [(r.canonical_problem_id, r.title, r.difficulty) for r in gone] == [("r2", "Unknown", "unknown")]
    p = spark.createDataFrame([("p1", None), ("p2", "old")], "pattern_id string, template_id string")
    linked = {r.pattern_id: r.template_id for r in T.link_patterns(p, out).collect()}
    assert linked["p1"] and linked["p2"] == "old"
    accepted = out.where("status = 'accepted'")
    v = accepted.select("template_id", F.explode("variants").alias("v"))
    data = views.run_data(accepted, v, spark.createDataFrame([("r0", "Two Sum", "easy")], "id string, title string, difficulty string")).collect()
    assert sorted((r.canonical_title, r.n_variants) for r in data) == [("Two Sum", 1), ("Unknown", 1)]


def test_random_args_are_seeded():
    t = {"input_schema": {"properties": {n: {"type": n} for n in T.SCALARS} | {"l": {"type": "array<string>"}}}, "notes_for_variant_generator": {"n_range": [5, 1], "value_range": None}}
    a = T.random_args(t, "s")
    assert a == T.random_args(t, "s") != T.random_args(t, "t") and 1 <= len(a["l"]) <= 5


def test_views(spark):
    p = spark.createDataFrame([("pattern_2", "tree | x", 3, "r", ["DP"]), ("pattern_10", None, 9, None, None)], "pattern_id string, label string, size long, representative string, top_tags array<string>")
    titles = spark.createDataFrame([("r", "A very long title of more than thirty-three letters")], "id string, title string")
    hits = lambda q, **k: [r.pattern_id for r in views.search_patterns(p, titles, q, **k).collect()]
    assert hits("") == ["pattern_10", "pattern_2"] and hits("dp") == hits("LONG") == hits("tree") == ["pattern_2"] and hits("zzz") == []
    assert hits("", by="id", limit=1) == ["pattern_10"]
    found = views.search_patterns(p, titles)
    assert "more than th.." in views.table_text(found) and "tree \\| x" in views.markdown(found, {"n": 2})
    assert "</script>" == views.dashboard(found, ["pattern_id", "label"], {"n": 2})[-9:]
    assert [r.pattern_id for r in p.orderBy(views.numeric_id(F.col("pattern_id"))).collect()] == ["pattern_2", "pattern_10"]
    a = spark.createDataFrame([("r", "pattern_2"), ("s", "pattern_2")], "problem_id string, pattern_id string")
    q = views.questions(titles, a, p)
    assert views.filter_questions(q, clustered=True, text="TREE").count() == 1 and views.filter_questions(q, clustered=False).count() == 0
    assert views.page(p, ["pattern_id"], 1, 1).first().pattern_id == "pattern_2"
    probs = titles.withColumns({"difficulty": F.lit("easy"), "description": F.lit("d" * 400)})
    detail = {r.problem_id: r for r in views.pattern_detail("pattern_2", p, a, probs).collect()}
    assert len(detail["r"].snippet) == 300 and detail["s"].title == "s"


def test_snapshots(spark, tmp_path):
    t = Snapshots(spark, str(tmp_path / "t"), "k string, n long")
    assert t.read().count() == 0
    t.upsert(spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, n long"), ["k"])
    t.upsert(spark.createDataFrame([(None, 4), ("b", 5)], "k string, n long"), ["k"])
    assert {(r.k, r.n) for r in t.read().collect()} == {("a", 2), (None, 4), ("b", 5)}
    wide = Snapshots(spark, str(tmp_path / "t"), "k string, n long, m string")
    assert {r.m for r in wide.read().collect()} == {None}

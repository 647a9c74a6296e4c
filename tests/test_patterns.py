import numpy as np
from pyspark.sql import functions as F

from sievewright.operators import patterns as P
from sievewright.plans.mining import mine
from sievewright.schemas import ASSIGNMENT, PATTERN
from sievewright.streaming.jobs import assign_stream
from sievewright.tables import Snapshots


def groups(n=2, size=3, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    x = [np.eye(dim)[g] + rng.normal(0, 0.01, dim) for g in range(n) for _ in range(size)]
    return [(f"id{k}", (v / np.linalg.norm(v)).astype("f4").tolist()) for k, v in enumerate(x)]


def test_two_tight_groups(spark):
    got = {r.id: r.label for r in P.cluster(spark.createDataFrame(groups(), "id string, embedding array<float>"), 2).collect()}
    assert got == {**{f"id{k}": 0 for k in range(3)}, **{f"id{k}": 1 for k in range(3, 6)}}


def test_cluster_too_few_and_empty(spark):
    df = spark.createDataFrame(groups(1), "id string, embedding array<float>")
    assert {r.label for r in P.cluster(df, 10).collect()} == {-1} and P.cluster(df.limit(0)).count() == 0


def test_block_trees_make_the_whole_tree(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 7)
    rows = groups(5, 12, seed=3)
    df = spark.createDataFrame(rows, "id string, embedding array<float>")
    small = {r.id: r.label for r in P.cluster(df, 5).collect()}
    monkeypatch.setattr(P, "BLOCK", 4096)
    assert small == {r.id: r.label for r in P.cluster(df, 5).collect()} and len(set(small.values())) == 5


def test_noise_and_summary(spark):
    rows = groups(2, 12) + [("far", [0.0] * 15 + [1.0]), ("near", [0.9, 0.3] + [0.0] * 14)]
    tagged = [(i, k, v, ["DP", "Tree" if k % 2 else "dp"], "Easy" if k else None, "Longest Common Path") for k, (i, v) in enumerate(rows)]
    df = spark.createDataFrame(tagged, "id string, ord long, embedding array<float>, tags array<string>, difficulty string, title string")
    p, a, m = mine(df, 10)
    by = {r.pattern_id: r for r in p.collect()}
    assert m.first().asDict() == {"n_records": 26, "n_clusters": 2, "clustered_records": 25, "outliers": 1, "outlier_rate": 0.0385}
    assert by["pattern_0"]["size"] == 13 and by["pattern_0"].top_tags == ["dp", "tree"] and by["pattern_0"].difficulty == {"easy": 12, "unknown": 1}
    assert by["pattern_0"].label == "dp / tree / longest common" and a.count() == 25


PAT = [("pattern_1", "a", 2, "r", ["t"], {"easy": 1}, [1.0] + [0.0] * 15, None, None), ("pattern_10", "b", 1, "r", None, None, [0.0, 1.0] + [0.0] * 14, None, None), ("none", "c", None, None, None, None, None, None, None)]


def test_sequential_assignment_moves_the_mean(spark):
    patterns = spark.createDataFrame(PAT, PATTERN)
    near = (np.eye(16)[0] + 0.2 * np.eye(16)[2]).tolist()
    rows = [("p1", near, 0), ("p2", np.eye(16)[5].tolist(), 1), ("p3", (np.eye(16)[5] + 0.1).tolist(), 2)]
    df = spark.createDataFrame(rows, "id string, embedding array<double>, ord long").withColumn("embedding", F.col("embedding").cast("array<float>"))
    got = P.assign_sequential(df, patterns)
    assert [(r.problem_id, r.pattern_id, r.is_new) for r in got.orderBy("ord").collect()] == [("p1", "pattern_1", False), ("p2", "pattern_11", True), ("p3", "pattern_11", False)]
    moved = {r.pattern_id: r for r in P.updated_centroids(got, df, patterns).collect()}
    assert moved["pattern_1"]["size"] == 3 and np.allclose(moved["pattern_1"].centroid, (2 * np.eye(16)[0] + near) / 3, atol=1e-6)
    full = df.withColumns({"title": F.lit("T"), "tags": F.array(F.lit("x")), "difficulty": F.lit("easy")})
    assert [(r.pattern_id, r.label) for r in P.new_patterns(got, full).collect()] == [("pattern_11", "x / T")]
    snap = {r.problem_id: r.pattern_id for r in P.assign_snapshot(df, patterns).collect()}
    assert snap == {"p1": "pattern_1", "p2": None, "p3": None}


def test_unassigned(spark):
    rows = [("a", "h1", "t"), ("a", "h1", "t"), ("b", "h2", "t"), ("c", None, "t"), ("d", "h9", ""), (None, "h8", "t"), ("e", "h3", "t")]
    df = spark.createDataFrame(rows, "id string, content_hash string, title string")
    left = P.unassigned(df, spark.createDataFrame([("b",)], "problem_id string"), spark.createDataFrame([("h3",), (None,)], "content_hash string"))
    assert sorted(r.id for r in left.collect()) == ["a", "c"]


def test_assignment_stream(spark, tmp_path):
    patterns, assigned = Snapshots(spark, str(tmp_path / "p"), PATTERN), Snapshots(spark, str(tmp_path / "a"), ASSIGNMENT)
    patterns.overwrite(spark.createDataFrame(PAT[:2], PATTERN))
    rows = spark.createDataFrame([("x", np.eye(16)[0].tolist(), 0), ("y", np.eye(16)[9].tolist(), 1)], "id string, embedding array<double>, ord long")
    rows.select("id", F.col("embedding").cast("array<float>").alias("embedding"), "ord").write.parquet(str(tmp_path / "in"))
    for n in (1, 2):
        stream = spark.readStream.schema("id string, embedding array<float>, ord long").parquet(str(tmp_path / "in"))
        assign_stream(stream, patterns, assigned, str(tmp_path / f"c{n}"), sequential=True).trigger(availableNow=True).start().awaitTermination()
        assert {r.problem_id: r.pattern_id for r in assigned.read().collect()} == {"x": "pattern_1", "y": "pattern_11"}
    assert {r.pattern_id: r["size"] for r in patterns.read().collect()} == {"pattern_1": 3, "pattern_10": 1, "pattern_11": 1}


def test_embedding_stand_in_and_model(spark):
    df = spark.createDataFrame([("a", "tree heap"), ("b", "tree heap"), ("", "x"), ("c", " ")], "id string, text string")
    v = {r.id: r.embedding for r in P.hashed_vectors(df, 32).collect()}
    assert v["a"] == v["b"] and abs(sum(x * x for x in v["a"]) - 1) < 1e-5
    got = P.embed(df, lambda: lambda texts: [[len(t), 1.0] for t in texts], 2, batch_size=1).collect()
    assert sorted(r.id for r in got) == ["a", "b"]


def test_cached_embeddings(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", None)], "id string, text string")
    none = spark.createDataFrame([], "text_hash string, embedding array<float>")
    got, grown = P.cached_embeddings(df, none, lambda rows: P.hashed_vectors(rows, 8))
    assert sorted(r.id for r in got.collect()) == ["a", "b", "c"] and grown.count() == 2
    again, more = P.cached_embeddings(df, grown, lambda rows: P.hashed_vectors(rows.where("id = 'none'"), 8))
    assert again.count() == 3 and more.count() == 2


def test_command_line(spark, tmp_path, capsys):
    import json

    from sievewright.plans.cli import main

    lines = [{"title": f"Tree {k}", "description": ("heap tree graph " * 6 if k < 12 else "array sum window " * 6) + str(k), "tags": ["x"]} for k in range(24)]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, lines)))
    assert main(["ingest", "--source", f"jsonl:{tmp_path}/a.jsonl:one", "--store", f"{tmp_path}/records", "--output", f"{tmp_path}/out"]) == 0
    assert main(["mine", "--problems", f"{tmp_path}/out", "--store", f"{tmp_path}/s", "--min-cluster-size", "4", "--report", f"{tmp_path}/r.md"]) == 0
    assert main(["assign", "--problems", f"{tmp_path}/out", "--store", f"{tmp_path}/s"]) == 0
    capsys.readouterr()
    assert main(["patterns", "--store", f"{tmp_path}/s"]) == 0
    assert "pattern_0" in capsys.readouterr().out and "| pattern_0 |" in (tmp_path / "r.md").read_text()

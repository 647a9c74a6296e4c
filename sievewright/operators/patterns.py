"""Patterns: clusters of embeddings, their summaries, and assignment of new records to them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import LABEL_STOPWORDS
from ..tables import cut

#: Rows of a block whose distances one task computes; bytes of centroids broadcast at most.
BLOCK, MAX_CENTROIDS = 4096, 64 << 20


def matrix(column) -> np.ndarray:
    """A list column as a float32 matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(n, -1) if n else np.zeros((0, 1), np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 1e-12, n, 1)


# ---- clustering: single linkage over cosine distance, condensed, with the stablest clusters chosen


def spanning_tree(x: np.ndarray) -> np.ndarray:
    """Edges (i, j) of a minimum spanning tree of unit rows under cosine distance, by Prim's method."""
    n = len(x)
    near, dist = np.zeros(n, np.int64), np.full(n, np.inf, np.float64)
    out, at, left = [], 0, np.ones(n, bool)
    left[0] = False
    for _ in range(n - 1):
        d = 1 - x @ x[at]
        closer = left & (d < dist)
        near[closer], dist[closer] = at, d[closer]
        at = int(np.where(left, dist, np.inf).argmin())
        left[at] = False
        out.append((near[at], at))
    return np.array(out, np.int64).reshape(-1, 2)


def linkage(n: int, edges: list[tuple[int, int, float]]) -> list[tuple[int, int, float, int]]:
    """Single-linkage merges (left, right, distance, size) from edges sorted by distance."""
    parent, size, top, out = list(range(n)), [1] * n, list(range(n)), []

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b, d in edges:
        a, b = find(a), find(b)
        if a != b:
            out.append((top[a], top[b], d, size[a] + size[b]))
            parent[b], size[a], top[a] = a, size[a] + size[b], n + len(out) - 1
    return out


def choose_clusters(n: int, merges: list[tuple[int, int, float, int]], min_size: int) -> np.ndarray:
    """Labels by excess of mass on the condensed tree; -1 is noise. The root is never a cluster."""
    labels = np.full(n, -1)
    if not merges:
        return labels
    children = {n + k: (a, b, d) for k, (a, b, d, _) in enumerate(merges)}
    sizes = {n + k: s for k, (*_, s) in enumerate(merges)}
    size = lambda v: sizes.get(v, 1)
    density = lambda d: 1 / d if d > 1e-12 else 1e12
    root = n + len(merges) - 1
    born, stability, subs, falls, order = {root: 0.0}, {root: 0.0}, {root: []}, {root: []}, []
    stack = [(root, root)]

    def points(v):
        todo = [v]
        while todo:
            u = todo.pop()
            if u < n:
                yield u
            else:
                todo += children[u][:2]

    while stack:
        node, cluster = stack.pop()
        if node == cluster:
            order.append(cluster)
        if node < n:
            falls[cluster].append((node, born[cluster]))
            continue
        a, b, d = children[node]
        lam = density(d)
        big = [c for c in (a, b) if size(c) >= min_size]
        if len(big) == 2:
            stability[cluster] += (lam - born[cluster]) * size(node)
            for c in big:
                born[c], stability[c], subs[c], falls[c] = lam, 0.0, [], []
                subs[cluster].append(c)
                stack.append((c, c))
        else:
            for c in (a, b):
                if c not in big:
                    for p in points(c):
                        stability[cluster] += lam - born[cluster]
                        falls[cluster].append((p, lam))
            stack += [(c, cluster) for c in big]
    chosen = {}
    for c in reversed(order):
        below = sum(stability[s] for s in subs[c])
        if c == root or (subs[c] and below > stability[c]):
            chosen[c], stability[c] = False, below
        else:
            chosen[c] = True
    label, todo = 0, [root]
    while todo:
        c = todo.pop()
        if chosen[c]:
            for p in points(c):
                labels[p] = label
            label += 1
        else:
            todo += subs[c]
    return labels


def cluster(vectors: DataFrame, min_cluster_size: int = 10, id_col: str = "id", vector_col: str = "embedding", max_rows: int = 100_000) -> DataFrame:
    """``(id, label)``: density clusters under cosine distance; -1 is noise, fewer rows than a cluster are all noise.

    Of every pair of blocks of rows one task makes a minimum spanning tree; the
    union of these trees holds the tree of all rows, so distances are computed once
    in parallel and only tree edges travel. Condensing the tree is sequential and
    happens on the driver, which takes at most ``max_rows`` distinct ids; more raise
    an error, and their clusters are better mined from a part and the rest assigned
    by :func:`assign_snapshot`. Labels are numbered by their smallest id.
    """
    rows = cut(vectors.select(F.col(id_col).cast("string").alias("id"), F.col(vector_col).cast("array<float>").alias("x")).where("id is not null and size(x) > 0").dropDuplicates(["id"]), "vectors")
    n = rows.count()
    if n > max_rows:
        raise ValueError(f"{n} vectors are more than the {max_rows} that are clustered at once")
    if n < min_cluster_size:
        return rows.select("id", F.lit(-1).alias("label"))
    blocks = -(-n // BLOCK)
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).select(
        "id", "x", "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    ).select("id", "x", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))

    def trees(table: pa.Table) -> pa.Table:
        x, ids = unit(matrix(table.column("x"))), table.column("id").combine_chunks()
        e = spanning_tree(x)
        d = 1 - np.einsum("ij,ij->i", x[e[:, 0]].astype(np.float64), x[e[:, 1]].astype(np.float64)) if len(e) else np.zeros(0)
        return pa.table({"a": ids.take(pa.array(e[:, 0])), "b": ids.take(pa.array(e[:, 1])), "d": pa.array(np.maximum(d, 0))})

    edges = blocked.groupBy("lo", "hi").applyInArrow(trees, "a string, b string, d double").distinct().orderBy("d", "a", "b").toArrow()
    names = sorted({*edges.column("a").to_pylist(), *edges.column("b").to_pylist()})
    at = {v: k for k, v in enumerate(names)}
    sorted_edges = [(at[a], at[b], d) for a, b, d in zip(*(edges.column(c).to_pylist() for c in ("a", "b", "d")))]
    raw = choose_clusters(len(names), linkage(len(names), sorted_edges), min_cluster_size)
    order = {label: k for k, label in enumerate(dict.fromkeys(x for x in raw.tolist() if x >= 0))}
    out = pa.table({"id": names, "label": pa.array([order.get(x, -1) for x in raw.tolist()], pa.int32())})
    return vectors.sparkSession.createDataFrame(out)


def centroids(members: DataFrame, key: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``(key, size, centroid)``: the mean vector of each group, by partial sums of each value."""
    flat = members.select(key, F.posexplode(vector_col).alias("pos", "x")).groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count("*").alias("n"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"])
    return flat.groupBy(key).agg(F.max("n").alias("size"), ordered.alias("centroid"))


def nearest_centroid(vectors: DataFrame, centers: DataFrame, id_col: str = "id", vector_col: str = "embedding", key: str = "label") -> DataFrame:
    """``(id, key, similarity)``: of each vector the centroid of the highest cosine, the least key among equals.

    Centroids are broadcast in blocks of a checked size; more blocks are more
    passes, whose best results are compared.
    """
    spark = vectors.sparkSession
    n, dim = centers.select(F.count("*"), F.max(F.size("centroid"))).first()
    kind, id_kind = centers.schema[key].dataType, vectors.schema[id_col].dataType
    schema = f"`{id_col}` {id_kind.simpleString()}, `{key}` {kind.simpleString()}, similarity double"
    if not n:
        return spark.createDataFrame([], schema)
    parts, out = max(1, -(-n * dim * 8 // MAX_CENTROIDS)), None
    for k in range(parts):
        some = centers.where(F.pmod(F.xxhash64(F.col(key)), F.lit(parts)) == k).orderBy(key).select(key, "centroid").toArrow()
        if not some.num_rows:
            continue
        shared = spark.sparkContext.broadcast((some.column(0).combine_chunks(), unit(matrix(some.column(1)).astype(np.float64))))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, c = shared.value
            for batch in batches:
                if batch.num_rows:
                    sims = unit(matrix(batch.column(1)).astype(np.float64)) @ c.T
                    best = sims.argmax(1)
                    yield pa.RecordBatch.from_arrays([batch.column(0), names.take(pa.array(best)), pa.array(sims[np.arange(len(best)), best])], names=[id_col, key, "similarity"])

        found = vectors.where(f"size(`{vector_col}`) = {dim}").select(id_col, vector_col).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    if parts == 1:
        return out
    return out.groupBy(id_col).agg(F.min(F.struct((-F.col("similarity")).alias("far"), F.col(key))).alias("m")).select(id_col, F.col(f"m.{key}"), (-F.col("m.far")).alias("similarity"))


def reassign_noise(vectors: DataFrame, labels: DataFrame, threshold: float = 0.75) -> DataFrame:
    """``(id, label)`` with noise near enough to a cluster's centroid given that cluster's label."""
    rows = vectors.join(labels, "id")
    centers = centroids(rows.where("label >= 0"))
    near = nearest_centroid(rows.where("label < 0").select("id", "embedding"), centers).where(F.col("similarity") >= threshold)
    return labels.join(near.select("id", F.col("label").alias("new")), "id", "left").select("id", F.coalesce("new", "label").alias("label"))


# ---- summaries


def representatives(members: DataFrame, centers: DataFrame, id_col: str = "id", vector_col: str = "embedding", key: str = "label") -> DataFrame:
    """``(key, representative, similarity)``: the member nearest its group's centroid, the first of equals."""
    from ..functions.vectors import dot, norm

    both = members.join(centers.select(key, "centroid"), key)
    cos = dot(F.col(vector_col), F.col("centroid")) / F.greatest(norm(F.col(vector_col)) * norm(F.col("centroid")), F.lit(1e-12))
    best = both.withColumn("cos", F.round(cos, 9)).groupBy(key).agg(F.min(F.struct((-F.col("cos")).alias("far"), F.col(id_col).alias("id"))).alias("m"))
    return best.select(key, F.col("m.id").alias("representative"), (-F.col("m.far")).alias("similarity"))


def top_tags(members: DataFrame, k: int = 6, key: str = "label") -> DataFrame:
    """``(key, top_tags)``: the most frequent tags in lower case, the earlier seen of equals first."""
    t = members.select(key, "ord", F.posexplode("tags").alias("p", "t")).withColumn("t", F.lower(F.trim("t"))).where("t <> ''")
    counts = t.groupBy(key, "t").agg(F.count("*").alias("n"), F.min(F.struct("ord", "p")).alias("first"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))
    return counts.withColumn("r", rank).where(f"r <= {k}").groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "t"))), lambda s: s["t"]).alias("top_tags"))


def difficulty_histogram(members: DataFrame, key: str = "label") -> DataFrame:
    """``(key, difficulty, n)``; blank difficulties are unknown."""
    d = F.lower(F.trim(F.coalesce("difficulty", F.lit(""))))
    return members.select(key, F.when(d == "", "unknown").otherwise(d).alias("difficulty")).groupBy(key, "difficulty").agg(F.count("*").alias("n"))


def title_ngrams(members: DataFrame, key: str = "label") -> DataFrame:
    """``(key, keywords)``: up to two title keywords; word pairs met twice come first, then words not among them."""
    words = F.filter(
        F.transform(F.regexp_extract_all("title", F.lit(r"\b[a-zA-Z]{3,}\b"), F.lit(0)), F.lower), lambda w: ~w.isin(*LABEL_STOPWORDS)
    )
    w = members.select(key, "ord", words.alias("w"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))
    grams = w.select(key, "ord", F.posexplode("w").alias("p", "g"), F.lit(1).alias("n_words")).unionByName(
        w.where("size(w) > 1").select(key, "ord", F.posexplode(pairs).alias("p", "g"), F.lit(2).alias("n_words"))
    )
    counts = grams.groupBy(key, "n_words", "g").agg(F.count("*").alias("n"), F.min(F.struct("ord", "p")).alias("first"))
    rank = F.row_number().over(Window.partitionBy(key, "n_words").orderBy(F.desc("n"), "first"))
    top = counts.withColumn("r", rank).where("(n_words = 2 and r <= 2 and n >= 2) or (n_words = 1 and r <= 4)")
    listed = lambda n: F.transform(F.sort_array(F.collect_list(F.when(F.col("n_words") == n, F.struct("r", "g")))), lambda s: s["g"])
    both = top.groupBy(key).agg(listed(2).alias("bi"), listed(1).alias("uni"))
    more = F.aggregate("uni", F.col("bi"), lambda acc, g: F.when((F.size(acc) < 2) & ~F.array_join(acc, " ").contains(g), F.array_append(acc, g)).otherwise(acc))
    return both.select(key, more.alias("keywords"))


def label(tags, keywords):
    """Two tags, then keywords that aren't among them, three parts at most."""
    none = F.array().cast("array<string>")
    two = F.slice(F.coalesce(tags, none), 1, 2)
    low = F.transform(two, F.lower)
    parts = F.concat(two, F.filter(F.coalesce(keywords, none), lambda k: ~F.array_contains(low, F.lower(k))))
    return F.when(F.size(parts) == 0, "algorithmic-pattern").otherwise(F.array_join(F.slice(parts, 1, 3), " / "))


def summarize(members: DataFrame) -> DataFrame:
    """Patterns of ``members(label, id, ord, embedding, tags, difficulty, title)``; label -1 is left out."""
    m = members.where("label >= 0")
    centers = centroids(m)
    hist = difficulty_histogram(m).groupBy("label").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("difficulty", "n")))).alias("difficulty"))
    return (
        centers.join(representatives(m, centers), "label")
        .join(top_tags(m), "label", "left").join(title_ngrams(m), "label", "left").join(hist, "label", "left")
        .select(
            F.concat(F.lit("pattern_"), F.col("label").cast("string")).alias("pattern_id"), label(F.col("top_tags"), F.col("keywords")).alias("label"),
            "size", "representative", F.coalesce("top_tags", F.array().cast("array<string>")).alias("top_tags"), "difficulty", "centroid",
        )
    )


def initial_assignments(labels: DataFrame) -> DataFrame:
    return labels.where("label >= 0").select(F.col("id").alias("problem_id"), F.concat(F.lit("pattern_"), F.col("label").cast("string")).alias("pattern_id"), F.lit(1.0).alias("confidence"))


def mining_metrics(labels: DataFrame) -> DataFrame:
    n, out = F.count("*"), F.count_if(F.col("label") < 0)
    return labels.agg(
        n.alias("n_records"), F.countDistinct(F.when(F.col("label") >= 0, F.col("label"))).alias("n_clusters"),
        (n - out).alias("clustered_records"), out.alias("outliers"), F.coalesce(F.round(out / n, 4), F.lit(0.0)).alias("outlier_rate"),
    )


# ---- incremental assignment


def problem_hash(problems: DataFrame):
    """A problem's content hash as a column: the one in its fingerprints where it has such a struct, else its own; empty for none."""
    nested = "fingerprints" in problems.columns and isinstance(problems.schema["fingerprints"].dataType, StructType)
    own = F.col("content_hash") if "content_hash" in problems.columns else F.lit(None).cast("string")
    found = F.when(F.col("fingerprints").isNotNull(), F.col("fingerprints.content_hash")).otherwise(own) if nested else own
    return F.coalesce(found, F.lit(""))


def assigned_hashes(problems: DataFrame, assignments: DataFrame) -> DataFrame:
    """``(content_hash)`` of the problems that have a pattern, each once."""
    ids = assignments.select(F.col("problem_id").alias("id")).where("id is not null").distinct()
    hashes = problems.select("id", problem_hash(problems).alias("content_hash")).join(ids, "id", "left_semi")
    return hashes.where("content_hash <> ''").select("content_hash").distinct()


def unassigned(problems: DataFrame, assignments: DataFrame, assigned_hashes: DataFrame) -> DataFrame:
    """Problems with an id and a title whose id and content hash aren't assigned yet, each id once."""
    return (
        problems.where("id is not null and id <> '' and title is not null and title <> ''")
        .dropDuplicates(["id"])
        .join(assignments.select(F.col("problem_id").alias("id")).distinct(), "id", "left_anti")
        .join(assigned_hashes.select("content_hash").where("content_hash is not null").distinct(), "content_hash", "left_anti")
    )


def assign_snapshot(problems: DataFrame, patterns: DataFrame, threshold: float = 0.80) -> DataFrame:
    """``(problem_id, pattern_id, confidence)`` against the patterns as they are: every record at once.

    Records under the threshold come without a pattern. Patterns without a usable centroid take none.
    """
    centers = patterns.where("centroid is not null and size(centroid) > 0 and exists(centroid, x -> x <> 0)").select("pattern_id", "centroid")
    near = nearest_centroid(problems, centers, key="pattern_id")
    return near.select(
        F.col("id").alias("problem_id"), F.when(F.col("similarity") >= threshold, F.col("pattern_id")).alias("pattern_id"), F.col("similarity").alias("confidence")
    )


class Tracker:
    """Running means of the patterns, in the order of their ids; new ones are added at the end."""

    def __init__(self, patterns: list[tuple[str, int, np.ndarray]]):
        self.ids = [p for p, *_ in patterns]
        self.sizes = [int(n or 1) for _, n, _ in patterns]
        self.means = np.array([c for *_, c in patterns], np.float64) if patterns else None
        numbers = [int(p[8:]) for p in self.ids if p.startswith("pattern_") and p[8:].isdigit()]
        self.next = max(numbers, default=-1) + 1
        self.unit = unit(self.means) if patterns else None

    def step(self, v: np.ndarray, threshold: float) -> tuple[str, float, bool]:
        """The pattern ``v`` joins, how sure, and whether it is new."""
        if self.means is not None:
            sims = self.unit @ (v / max(float(np.linalg.norm(v)), 1e-12))
            k = int(sims.argmax())
            if sims[k] >= threshold:
                n = self.sizes[k]
                self.means[k] = (self.means[k] * n + v) / (n + 1)
                self.sizes[k] = n + 1
                self.unit[k] = self.means[k] / max(float(np.linalg.norm(self.means[k])), 1e-12)
                return self.ids[k], float(sims[k]), False
        name = f"pattern_{self.next}"
        self.next += 1
        self.ids.append(name)
        self.sizes.append(1)
        row = v[None].astype(np.float64)
        self.means = row if self.means is None else np.vstack([self.means, row])
        self.unit = unit(row) if self.unit is None else np.vstack([self.unit, unit(row)])
        return name, 1.0, True


def assign_sequential(problems: DataFrame, patterns: DataFrame, threshold: float = 0.80) -> DataFrame:
    """``(problem_id, pattern_id, confidence, is_new, ord)``: one record after the other, in the order of ``ord``.

    Each record moves the mean of the pattern it joins, so the result depends on
    the order; it is a fold and runs in one task, which streams the records and
    keeps only the patterns. For large batches use :func:`assign_snapshot`.
    """
    known = patterns.where("centroid is not null and size(centroid) > 0").orderBy("pattern_id").select("pattern_id", "size", "centroid").collect()
    start = [(r.pattern_id, r.size, np.array(r.centroid, np.float64)) for r in known]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tracker = Tracker(start)
        for batch in batches:
            got = [tracker.step(v.astype(np.float64), threshold) for v in matrix(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_()), batch.column(2)],
                names=["problem_id", "pattern_id", "confidence", "is_new", "ord"],
            )

    rows = problems.select(F.col("id").cast("string").alias("id"), "embedding", "ord")
    kind = problems.schema["ord"].dataType.simpleString()
    return rows.repartition(1).sortWithinPartitions("ord", "id").mapInArrow(fold, f"problem_id string, pattern_id string, confidence double, is_new boolean, ord {kind}")


def new_patterns(assigned: DataFrame, problems: DataFrame) -> DataFrame:
    """Rows for the patterns that a sequential assignment made, of the record that began each."""
    first = assigned.where("is_new").select(F.col("problem_id").alias("id"), "pattern_id")
    tag = F.element_at("tags", 1)
    return first.join(problems, "id").select(
        "pattern_id", F.when(F.size("tags") > 0, F.concat(tag, F.lit(" / "), "title")).otherwise(F.col("title")).alias("label"),
        F.lit(1).cast("long").alias("size"), F.col("id").alias("representative"), F.slice("tags", 1, 6).alias("top_tags"), "difficulty", F.col("embedding").alias("centroid"),
    )


def updated_centroids(assigned: DataFrame, problems: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(pattern_id, size, centroid)`` after an assignment: the old mean and the new members' mean by their sizes."""
    joined = assigned.select(F.col("problem_id").alias("id"), "pattern_id").where("pattern_id is not null").join(problems.select("id", "embedding"), "id")
    fresh = centroids(joined, "pattern_id").withColumnRenamed("size", "m").withColumnRenamed("centroid", "mean")
    old = patterns.select("pattern_id", F.col("size").alias("n"), F.col("centroid").alias("c"))
    n, m = F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0))
    mixed = F.when(F.col("mean").isNull(), F.col("c").cast("array<double>")).when(F.col("c").isNull(), F.col("mean")).otherwise(
        F.zip_with("c", "mean", lambda a, b: (a.cast("double") * n + b * m) / (n + m))
    )
    return old.join(fresh, "pattern_id", "full_outer").select("pattern_id", (n + m).alias("size"), mixed.alias("centroid"))


def hashed_vectors(texts: DataFrame, dim: int = 384, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Signed word-hash vectors of length 1: the offline stand-in where no embedding model is given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re
        import zlib

        word = re.compile("[a-z0-9]+")
        for batch in batches:
            x = np.zeros((batch.num_rows, dim), np.float32)
            for k, t in enumerate(batch.column(1).to_pylist()):
                for w in word.findall((t or "").lower()):
                    h = zlib.crc32(w.encode())
                    x[k, h % dim] += 1 if h & (1 << 31) else -1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(unit(x)), pa.list_(pa.float32()))], names=["id", "embedding"])

    return texts.select(F.col(id_col).cast("string").alias("id"), text_col).mapInArrow(run, "id string, embedding array<float>")


def embed(texts: DataFrame, model_of, dim: int, batch_size: int = 64, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Vectors by a model: ``model_of()`` is called once a worker and gives a function from texts to rows. Blank ids and texts are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for whole in batches:
            for batch in (whole.slice(i, batch_size) for i in range(0, whole.num_rows, batch_size)):
                model = model or model_of()
                x = unit(np.asarray(model(batch.column(1).to_pylist()), np.float32).reshape(-1, dim))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float32()))], names=["id", "embedding"])

    rows = texts.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("trim(id) <> '' and trim(text) <> ''")
    return rows.mapInArrow(run, "id string, embedding array<float>")


def cached_embeddings(texts: DataFrame, cache: DataFrame, embed_rows) -> tuple[DataFrame, DataFrame]:
    """(vectors of all texts, the cache grown by the new ones).

    ``cache``: (text_hash, embedding). Only texts whose hash isn't there go through
    ``embed_rows``, a function from (id, text) rows to (id, embedding) rows, each
    distinct text once.
    """
    hashed = texts.select(F.col("id").cast("string").alias("id"), "text", F.sha2("text", 256).alias("text_hash")).where("id is not null and text is not null")
    fresh = hashed.join(cache, "text_hash", "left_anti").groupBy("text_hash").agg(F.first("text").alias("text"))
    new = cut(embed_rows(fresh.select(F.col("text_hash").alias("id"), "text")).withColumnRenamed("id", "text_hash"), "embedded")
    grown = cache.select("text_hash", "embedding").unionByName(new.select("text_hash", "embedding"))
    return hashed.select("id", "text_hash").join(grown, "text_hash").select("id", "embedding"), grown

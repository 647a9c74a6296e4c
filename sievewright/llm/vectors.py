"""Problems 4 and 6: similarity clusters, and the most similar vectors of every vector.

Both lay the vectors out in lists around the leaves of a bisecting k-means tree that
is grown over all vectors across the cluster; each vector is a member of its nearest
list and visits the next few, as many as a measured recall takes. Large lists are
compared in blocks by many tasks. Exact copies are one vector until the end.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, cut, drop
from .components import hash_to_min

#: Vectors that the number of lists is measured with; recall aimed at; most lists a vector is laid in; rows compared at once.
MEASURED, RECALL, MOST_PROBES, BLOCK = 1024, 0.99, 32, 512
#: There is a list for so many times the root of the vectors' number.
LISTS = 2
#: Members and visitors of a list that one task takes; a longer list is compared in blocks.
LIST_ROWS = 20_000


def rotation(dim: int, seed: int = 6) -> np.ndarray:
    """A random orthogonal matrix: any columns of rotated vectors are a fair sample of the whole."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def packed(x: np.ndarray) -> list[bytes]:
    """Vectors as 16-bit integers and a scale; inner products keep five digits."""
    scale = np.abs(x).max(1, initial=1e-30).astype(np.float32)
    q = np.rint(x / scale[:, None] * 32767).astype("<i2")
    return [s + b for s, b in zip((s.tobytes() for s in scale), (row.tobytes() for row in q))]


def unpacked(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 4 + 2 * dim)
    scale = np.ascontiguousarray(raw[:, :4]).view("<f4")
    x = np.ascontiguousarray(raw[:, 4:]).view("<i2").astype(np.float32) * (scale / 32767)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def packed14(x: np.ndarray) -> list[bytes]:
    """Vectors as 14-bit integers and a scale: the upper bytes, then the lower six bits of four values in three bytes."""
    scale = np.abs(x).max(1, initial=1e-30).astype(np.float32)
    q = (np.rint(x / scale[:, None] * 8191) + 8192).astype(np.uint32)
    low = (q & 63).reshape(len(x), -1, 4)
    low = low[:, :, 0] | (low[:, :, 1] << 6) | (low[:, :, 2] << 12) | (low[:, :, 3] << 18)
    low = np.stack([low & 255, (low >> 8) & 255, low >> 16], axis=2).reshape(len(x), -1)
    rows = np.hstack([q >> 6, low]).astype(np.uint8)
    return [s + r for s, r in zip((s.tobytes() for s in scale), (row.tobytes() for row in rows))]


def unpacked14(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 4 + dim * 7 // 4)
    scale = np.ascontiguousarray(raw[:, :4]).view("<f4")
    low = raw[:, 4 + dim :].reshape(len(raw), -1, 3).astype(np.int32)
    low = low[:, :, 0] | (low[:, :, 1] << 8) | (low[:, :, 2] << 16)
    low = np.stack([(low >> k) & 63 for k in (0, 6, 12, 18)], axis=2).reshape(len(raw), dim)
    x = (((raw[:, 4 : 4 + dim].astype(np.int32) << 6) | low) - 8192).astype(np.float32) * (scale / 8191)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)


def usable(vectors: DataFrame, dim: int = 128, id_col: str = "record_id", vector_col: str = "nl_embedding") -> DataFrame:
    """``(id, k, v)``: rows with ``dim`` finite values that are not all zero, as rotated unit vectors.

    ``k`` names the exact vector by 72 bits of its hash, so copies share it. Of an id with unlike vectors
    the least ``k`` holds; rows with a null id take no part.
    """
    turn = rotation(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            if pa.types.is_null(lists.type):
                continue
            n = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.flatnonzero((n == dim) & ids.is_valid().to_numpy(zero_copy_only=False))
            x = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)
            with np.errstate(all="ignore"):
                norm = np.linalg.norm(x.astype(np.float64), axis=1)
            good = np.isfinite(norm) & (norm > 0)
            x, at, norm = x[good], at[good], norm[good]
            keys = [base64.b64encode(xxhash.xxh3_128_digest(r.tobytes()))[:12].decode() for r in x]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at)), pa.array(keys, pa.string()), pa.array(packed((x / norm[:, None]).astype(np.float32) @ turn), pa.binary())],
                names=["id", "k", "v"],
            )

    rows = vectors.select(F.col(id_col).cast("string").alias("id"), F.col(vector_col).cast("array<float>").alias("x"))
    return rows.mapInArrow(run, "id string, k string, v binary")


def two_means(x: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Side of each row in a split of unit vectors in two; both sides hold a row."""
    a = x[0] if len(x) < 3 else x[int(np.argmin(x @ x.mean(0)))]
    b = x[int(np.argmin(x @ a))]
    side = x @ (b - a) > 0
    for _ in range(rounds):
        if side.all() or not side.any():
            break
        a, b = x[~side].mean(0), x[side].mean(0)
        new = x @ (b / max(np.linalg.norm(b), 1e-12) - a / max(np.linalg.norm(a), 1e-12)) > 0
        if (new == side).all():
            break
        side = new
    if side.all() or not side.any():
        side = np.arange(len(x)) % 2 == 1
    return side


class Tree:
    """Splits by planes: a row goes right of node ``n`` if its product with ``plane[n]`` is above ``at[n]``."""

    def __init__(self, dim: int):
        self.plane, self.at, self.left, self.right = np.zeros((1, dim), np.float32), np.zeros(1, np.float32), np.full(1, -1), np.full(1, -1)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.left[node] >= 0)
            if not len(inner):
                return node
            here = node[inner]
            above = np.einsum("ij,ij->i", x[inner], self.plane[here]) > self.at[here]
            node[inner] = np.where(above, self.right[here], self.left[here])

    def split(self, nodes: list[int]) -> None:
        """Gives each of the leaves two children, planes still to be set."""
        n = len(self.at)
        self.left[nodes], self.right[nodes] = n + 2 * np.arange(len(nodes)), n + 2 * np.arange(len(nodes)) + 1
        more = 2 * len(nodes)
        self.plane = np.vstack([self.plane, np.zeros((more, self.plane.shape[1]), np.float32)])
        self.at = np.append(self.at, np.zeros(more, np.float32))
        self.left, self.right = np.append(self.left, np.full(more, -1)), np.append(self.right, np.full(more, -1))


def _moments(reps: DataFrame, tree: Tree, dim: int) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Of each leaf: its rows, their sum, and the sum of their squares, summed up across the cluster."""
    shared = reps.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x = unpacked(batch.column(0), dim)
            leaf = shared.value.leaf_of(x)
            order = np.argsort(leaf, kind="stable")
            names, first = np.unique(leaf[order], return_index=True)
            wide = np.hstack([np.ones((len(x), 1)), x, np.square(x)])[order]
            for n, row in zip(names.tolist(), np.add.reduceat(wide, first) if len(x) else ()):
                total[n] = total[n] + row if n in total else row
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([t.tobytes() for t in total.values()], pa.binary())], names=["leaf", "m"])

    def add(table: pa.Table) -> pa.Table:
        rows = np.stack([np.frombuffer(m) for m in table.column("m").to_pylist()])
        return pa.table({"leaf": table.column("leaf")[:1], "m": pa.array([rows.sum(0).tobytes()], pa.binary())})

    parts = reps.select("v").mapInArrow(run, "leaf long, m binary")
    rows = parts.groupBy("leaf").applyInArrow(add, "leaf long, m binary").collect()
    found = {r["leaf"]: np.frombuffer(r["m"]) for r in rows}
    return {n: (int(m[0]), m[1 : dim + 1], m[dim + 1 :]) for n, m in found.items()}


def grown(reps: DataFrame, leaves: int, dim: int) -> np.ndarray:
    """Unit centroids of the leaves of a bisecting k-means tree over all vectors.

    Round by round the nodes of the largest dispersion (those with at least half of
    the largest) are split across the cluster: first at the mean of the coordinate
    that varies most, then between the centres of the two sides. Only sums of each
    node reach the driver.
    """
    tree, known = Tree(dim), {}
    known = _moments(reps, tree, dim)
    while 0 < len(known) < leaves:
        spread = {n: c - float(np.square(total).sum()) / c for n, (c, total, _) in known.items()}
        largest = max(spread.values())
        chosen = sorted((n for n in spread if spread[n] >= largest / 2 and known[n][0] > 1), key=lambda n: (-spread[n], n))[: leaves - len(known)]
        if largest < 1e-6 or not chosen:
            break
        for n in chosen:
            c, total, squares = known[n]
            axis = int(np.argmax(squares / c - np.square(total / c)))
            tree.plane[n], tree.at[n] = np.eye(dim, dtype=np.float32)[axis], total[axis] / c
        tree.split(chosen)
        halves = _moments(reps, tree, dim)
        for n in chosen:
            sides = [halves.get(int(k)) for k in (tree.left[n], tree.right[n])]
            if all(sides):
                a, b = (t / max(float(np.linalg.norm(t)), 1e-12) for _, t, _ in sides)
                tree.plane[n], tree.at[n] = b - a, 0.0
        known = _moments(reps, tree, dim)
    c = np.array([t for _, t, _ in known.values()]).reshape(-1, dim) if known else np.zeros((1, dim))
    return (c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)).astype(np.float32)


class Layout:
    """The distinct vectors, laid in lists around ``centroids``, about half the root of their number.

    Every vector is laid in the list of its nearest centroid and in the next
    ``probes - 1``; without ``probes`` as many as are needed for a mean recall of
    ``RECALL`` of the pairs of ``least`` or more that each of ``MEASURED`` vectors
    has, by brute force over all. The centroids broadcast stay small: 8 MB for a thousand
    million vectors.
    """

    def __init__(self, vectors: DataFrame, dim: int, least: float, probes: int | None = None, **columns):
        self.dim, self.least = dim, least
        base, path = cut(usable(vectors, dim, **columns), "vectors")
        self.members, _ = cut(base.groupBy("id").agg(F.min("k").alias("k")), "members")
        self.reps, _ = cut(base.select("k", "v").dropDuplicates(["k"]), "distinct")
        drop(self.reps.sparkSession, path)
        self.n = self.reps.count()
        self.centroids = grown(self.reps, max(1, int(self.n**0.5 / LISTS)), dim)
        self.probes = min(probes or self._measured(), len(self.centroids))

    def _measured(self) -> int:
        """The least number of lists a vector, with which the measured pairs meet in the right share.

        A pair meets if one's own list is among the other's lists.
        """
        some = self.reps.orderBy(F.xxhash64("k"), "k").limit(MEASURED).select("v").toArrow()
        dim, least, x = self.dim, self.least, unpacked(some.column(0), self.dim)
        shared = self.reps.sparkSession.sparkContext.broadcast((x, self.centroids))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x, c = shared.value
            own = (x @ c.T).argmax(1) if len(x) else np.zeros(0, np.int64)
            far = x @ c.T
            count = np.zeros((len(x), MOST_PROBES + 1), np.int64)
            for batch in batches:
                y = unpacked(batch.column(0), dim)
                sims = y @ x.T
                i, j = np.nonzero((sims >= least) & (sims < 1 - 1e-6))
                if len(i):
                    near = y[i] @ c.T
                    mine = near.argmax(1)
                    rank = np.minimum((near > near[np.arange(len(i)), own[j]][:, None]).sum(1), (far[j] > far[j, mine][:, None]).sum(1))
                    np.add.at(count, (j, np.minimum(rank, MOST_PROBES)), 1)
            q, r = np.nonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(r), pa.array(count[q, r])], names=["q", "rank", "n"])

        rows = self.reps.select("v").mapInArrow(run, "q long, rank long, n long").groupBy("q", "rank").agg(F.sum("n").alias("n")).collect()
        n = np.zeros((len(x), MOST_PROBES + 1))
        for r in rows:
            n[r["q"], r["rank"]] = r["n"]
        n = n[n.sum(1) > 0]
        if not len(n):
            return 4
        met = np.cumsum(n / n.sum(1, keepdims=True), axis=1).mean(0)
        return min(MOST_PROBES, 1 + int(np.argmax(met >= RECALL)))

    def lists(self, narrow: bool = False) -> DataFrame:
        """``(list, lo, hi, part, own, k, v)``: a short list is one block, of a long one every two parts meet in one.

        ``narrow`` lays the vectors in 14 bits a value (dimensions divisible by 4 only), which is an eighth less to shuffle.
        """
        shared = self.reps.sparkSession.sparkContext.broadcast(self.centroids)
        dim, probes = self.dim, self.probes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, laid = unpacked(batch.column(1), dim), batch.column(1)
                sims = x @ shared.value.T
                laid = pa.array(packed14(x), pa.binary()) if narrow else laid
                near = np.argpartition(-sims, probes - 1, axis=1)[:, :probes]
                own = near == sims.argmax(1)[:, None]
                at = pa.array(np.repeat(np.arange(batch.num_rows), probes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.ravel().astype(np.int32)), pa.array(own.ravel()), batch.column(0).take(at), laid.take(at)],
                    names=["list", "own", "k", "v"],
                )

        laid = self.reps.mapInArrow(run, "list int, own boolean, k string, v binary")
        # no list has more rows than there are vectors; lists are counted only where one could be long
        if self.n <= LIST_ROWS:
            return laid.select("list", F.lit(0).alias("lo"), F.lit(0).alias("hi"), F.lit(0).alias("part"), "own", "k", "v")
        long = laid.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > LIST_ROWS).collect()
        parts = np.ones(len(self.centroids), np.int64)
        for r in long:
            parts[r["list"]] = -(-r["n"] // LIST_ROWS)
        return (
            # one array, not a condition for each long list: nested conditions overflow the planner's stack from some hundreds on
            laid.withColumn("parts", F.get(F.lit(parts.tolist()), F.col("list")))
            .withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
            .select("list", "part", "own", "k", "v", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("other"))
            .select("list", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "own", "k", "v")
        )


def scan(q: np.ndarray, x: np.ndarray, least: float, step: int = 32, eps: float = 2.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row of ``q``, row of ``x``) of cosine ``least`` or more, by adaptive dimension scan.

    Rotated vectors are read in blocks of ``step`` columns. After each block a pair
    whose distance so far, carried on to all columns, is too large for ``least`` by
    a hypothesis test (``eps``: 2.1 lets about one true pair in a thousand go) is
    abandoned. Where many pairs are alive the rest of the columns is multiplied
    at once.
    """
    dim, limit = q.shape[1], 2 - 2 * least
    part = q[:, :step] @ x[:, :step].T
    far = np.square(q[:, :step]).sum(1)[:, None] + np.square(x[:, :step]).sum(1)[None] - 2 * part
    i, j = np.nonzero(far * (dim / step) <= limit * (1 + eps / step**0.5) ** 2)
    if len(i) > far.size / 10:
        sims = q @ x.T
        i, j = np.nonzero(sims >= least)
        return i, j, sims[i, j]
    dist = far[i, j]
    for d in range(step, dim, step):
        rest = np.empty(len(i), np.float32)
        for s in range(0, len(i), 100_000):
            rest[s : s + 100_000] = np.square(q[i[s : s + 100_000], d : d + step] - x[j[s : s + 100_000], d : d + step]).sum(1)
        dist = dist + rest
        done = min(d + step, dim)
        keep = dist * (dim / done) <= (limit * (1 + eps / done**0.5) ** 2 if done < dim else limit)
        i, j, dist = i[keep], j[keep], dist[keep]
    return i, j, 1 - dist / 2


def _best(a: np.ndarray, b: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, -s, a))
    a, b, s = a[order], b[order], s[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, int)
    rank = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    return a[rank < k], b[rank < k], s[rank < k]


def _meetings(table: pa.Table, dim: int, least: float, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of a block's rows, one of them a member, of cosine ``least`` or more; of two parts only what crosses."""
    v, part = table.column("v"), table.column("part").to_numpy()
    narrow = len(v) > 0 and len(v[0].as_py()) < 4 + 2 * dim
    x = (unpacked14 if narrow else unpacked)(v, dim)
    is_own = table.column("own").to_numpy(zero_copy_only=False)
    if len(x) and table.column("lo")[0].as_py() != table.column("hi")[0].as_py():
        a, b = (part == p for p in np.unique(part)) if len(np.unique(part)) == 2 else (part < 0, part < 0)
        sides = [(np.flatnonzero(a), np.flatnonzero(b & is_own)), (np.flatnonzero(b & ~is_own), np.flatnonzero(a & is_own))]
        for rows, own in sides:
            for lo in range(0, len(rows) if len(own) else 0, BLOCK):
                i, j, s = scan(x[rows[lo : lo + BLOCK]], x[own], least, eps=eps)
                yield rows[i + lo], own[j], s
        return
    own = np.flatnonzero(is_own)
    rows = np.concatenate([own, np.flatnonzero(~is_own)])
    for lo in range(0, len(rows) if len(own) else 0, BLOCK):
        first = min(lo, len(own)) if lo < len(own) else 0
        i, j, s = scan(x[rows[lo : lo + BLOCK]], x[own[first:]], least, eps=eps)
        i, j = i + lo, j + first
        once = (i >= len(own)) | (j > i)  # two members meet once
        yield rows[i[once]], own[j[once]], s[once]


def _neighbours(dim: int, k: int, least: float, eps: float) -> Callable[[pa.Table], pa.Table]:
    """The best of what a block's rows find among its members, and members among all its rows."""

    def run(table: pa.Table) -> pa.Table:
        got = [], [], []
        for i, j, s in _meetings(table, dim, least, eps):
            for a, b in ((i, j), (j, i)):
                for to, new in zip(got, _best(a, b, s, k)):
                    to.append(new)
        a, b, s = _best(*(np.concatenate(g) if g else np.zeros(0, int) for g in got), k)
        keys = table.column("k").combine_chunks()
        return pa.table({"k": keys.take(pa.array(a)), "to": keys.take(pa.array(b)), "sim": pa.array(s.astype(np.float32))})

    return run


def nearest(
    vectors: DataFrame, k: int = 5, min_similarity: float = 0.80, dim: int = 128, probes: int | None = None, eps: float = 2.1,
    id_col: str = "record_id", vector_col: str = "nl_embedding",
) -> DataFrame:
    """``(record_id, neighbor_id, similarity)``: for each record the ``k`` others of the highest cosine.

    Only neighbours of ``min_similarity`` or more count; ties go to the smaller id.
    Vectors that are null, of another length, not finite or all zero take no part;
    rows given twice count once. Recall against brute force is measured in the
    tests and the README; similarities are right to about 0.0001 at worst, mostly 0.00001.

    Scale: exact copies, however many, are searched once and share their
    neighbours, of each of which at most k + 1 ids are kept. A list is compared
    with its members and visitors only, so work grows as the power 1.5; a list
    that holds much of the data is compared in blocks of two parts, many tasks.
    """
    lay = Layout(vectors, dim, min_similarity, probes, id_col=id_col, vector_col=vector_col)
    found = (
        lay.lists(narrow=dim % 4 == 0)
        .groupBy("list", "lo", "hi")
        .applyInArrow(_neighbours(dim, k, min_similarity, eps), "k string, to string, sim float")
        .groupBy("k", "to")
        .agg(F.max("sim").alias("sim"))
    )
    top = found.groupBy("k").agg(F.slice(F.sort_array(F.collect_list(F.struct("sim", "to")), False), 1, k).alias("t"))
    pairs = top.select("k", F.explode("t").alias("t")).select("k", F.col("t.to").alias("to"), F.col("t.sim").alias("sim"))
    members = lay.members
    rank = F.row_number().over(Window.partitionBy("k").orderBy("id"))
    few = members.withColumn("r", rank).where(f"r <= {k + 1}").groupBy("k").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    near = (
        pairs.join(few.withColumnRenamed("k", "to"), "to")
        .groupBy("k")
        .agg(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("sim")).alias("far"), i.alias("id"))))).alias("near"))
    )
    one = F.transform("ids", lambda i: F.struct(F.lit(-1.0).cast("float").alias("far"), i.alias("id")))
    every = F.concat(one, F.coalesce("near", F.array().cast("array<struct<far:float,id:string>>")))
    chosen = F.slice(F.array_sort(F.filter(every, lambda c: c["id"] != F.col("id"))), 1, k)
    known = few.join(near, "k", "left").where("size(ids) > 1 or near is not null")
    return (
        members.join(apart(known, "k"), "k")
        .select("id", F.explode(chosen).alias("c"))
        .select(F.col("id").alias("record_id"), F.col("c.id").alias("neighbor_id"), (-F.col("c.far")).alias("similarity"))
    )


def compact(x: np.ndarray, least: float) -> bool:
    """Any two rows have a cosine of ``least`` or more."""
    return all(float((x[s : s + BLOCK] @ x.T).min()) >= least for s in range(0, len(x), BLOCK))


def compact_leaves(x: np.ndarray, least: float) -> list[np.ndarray]:
    """Leaves of bisecting k-means, split until each is compact; a node without a similar pair falls into single rows."""
    leaves, stack = [], [np.arange(len(x))]
    while stack:
        at = stack.pop()
        if len(at) == 1:
            leaves.append(at)
            continue
        y = x[at]
        if len(at) <= BLOCK:
            g = y @ y.T
            if g.min() >= least:
                leaves.append(at)
                continue
            np.fill_diagonal(g, -1)
            if g.max() < least:
                leaves += [at[i : i + 1] for i in range(len(at))]
                continue
        elif float(np.square(y.mean(0)).sum()) >= least and compact(y, least):
            leaves.append(at)
            continue
        side = two_means(y)
        stack += [at[side], at[~side]]
    return leaves


def _fragments(dim: int, least: float, eps: float) -> Callable[[pa.Table], pa.Table]:
    """Links of a block: of each compact leaf of its members to its first row, and between leaves that a split has torn apart."""

    def run(table: pa.Table) -> pa.Table:
        part, own = table.column("part").to_numpy(), table.column("own").to_numpy(zero_copy_only=False)
        head = np.arange(len(part))
        if len(part) and (part == part[0]).all():
            mine = np.flatnonzero(own)
            for leaf in compact_leaves(unpacked(table.column("v"), dim)[mine], least):
                head[mine[leaf]] = mine[leaf[0]]
        rows = np.flatnonzero(head != np.arange(len(head)))
        links = [np.stack([head[rows], rows])]
        for i, j, _ in _meetings(table, dim, least, eps):
            both = np.stack([head[i], head[j]])
            links.append(np.unique(both[:, both[0] != both[1]], axis=1))
        a, b = np.unique(np.concatenate(links, axis=1), axis=1)
        keys = table.column("k").combine_chunks()
        return pa.table({"a": keys.take(pa.array(a)), "b": keys.take(pa.array(b))})

    return run


#: Distinct vectors of a cluster whose pairs one task checks.
CHECKED = 4096


def _pairwise(dim: int, least: float) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        x, part = unpacked(table.column("v"), dim), table.column("part").to_numpy()
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        y, z = x[part == lo], x[part == hi]
        ok = all(float((y[s : s + BLOCK] @ z.T).min(initial=1.0)) >= least - 1e-5 for s in range(0, len(y), BLOCK))
        total = x.astype(np.float64).sum(0) if lo == hi else np.zeros(dim)
        return pa.table({"g": [table.column("g")[0].as_py()], "ok": [ok], "total": [total.tolist()]})

    return run


def clusters(
    vectors: DataFrame, min_similarity: float = 0.70, min_size: int = 5, dim: int = 128, probes: int | None = None, eps: float = 2.1,
    id_col: str = "record_id", vector_col: str = "nl_embedding",
) -> tuple[DataFrame, DataFrame]:
    """``(record_id, cluster_id)`` of every record in a cluster, and the clusters' members with their places.

    A cluster is a set of at least ``min_size`` records that are similar two by two
    and to none outside; ``cluster_id`` is its smallest record id. The second frame
    is ``(cluster_id, record_id, size, to_centre)``. Unusable vectors are those of
    :func:`nearest`; rows given twice count once; exact copies count each.

    In each list bisecting k-means splits the node at hand until every leaf is
    compact. Leaves that a split has torn apart, here or between lists, are joined
    over the pairs that a scan finds between them, and every joined group is then
    checked exactly, pair by pair in blocks, so a group that isn't a cluster
    doesn't come out. Large groups are checked by many tasks.
    """
    lay = Layout(vectors, dim, min_similarity, probes, id_col=id_col, vector_col=vector_col)
    links = lay.lists().groupBy("list", "lo", "hi").applyInArrow(_fragments(dim, min_similarity, eps), "a string, b string")
    group = hash_to_min(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    members = lay.members.join(group, F.col("k") == F.col("node"), "left").select("id", "k", F.coalesce("group_id", "k").alias("g"))
    members, _ = cut(members, "grouped")
    sizes = members.groupBy("g").agg(F.count("*").alias("size"), F.min("id").alias("cluster_id")).where(f"size >= {min_size}")
    vecs = members.select("g", "k").distinct()
    parts = vecs.groupBy("g").agg(F.ceil(F.count("*") / CHECKED).cast("int").alias("parts")).join(sizes, "g", "left_semi")
    blocks = (
        vecs.join(apart(parts, "g"), "g")
        .join(lay.reps, "k")
        .withColumn("part", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int"))
        .select("g", "k", "v", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("g", "k", "v", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"))
    )
    checked = blocks.groupBy("g", "lo", "hi").applyInArrow(_pairwise(dim, min_similarity), "g string, ok boolean, total array<double>")
    good = checked.groupBy("g").agg(F.min("ok").alias("ok"), F.collect_list("total").alias("totals")).where("ok")
    good, _ = cut(good.join(sizes, "g").select("g", "cluster_id", "size", "totals"), "clusters")
    found = members.join(good.select("g", "cluster_id"), "g").select(F.col("id").alias("record_id"), "cluster_id")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            centre = np.array([np.sum(t, axis=0) for t in batch.column(4).to_pylist()], np.float32).reshape(-1, dim)
            centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-30)
            cos = (unpacked(batch.column(3), dim) * centre).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cos.astype(np.float64))], names=["cluster_id", "record_id", "size", "to_centre"])

    placed = (
        members.join(good, "g")
        .join(lay.reps, "k")
        .select("cluster_id", F.col("id").alias("record_id"), "size", "v", "totals")
        .mapInArrow(place, "cluster_id string, record_id string, size long, to_centre double")
    )
    return found, placed


def described(placed: DataFrame, typical: int = 3) -> DataFrame:
    """``(cluster_id, size, typical, cohesion)``: each cluster's size, the members nearest its centre, their mean cosine to it."""
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("to_centre"), "record_id"))
    near = placed.withColumn("r", rank).where(f"r <= {typical}").groupBy("cluster_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("r", "record_id"))), lambda s: s["record_id"]).alias("typical")
    )
    size = placed.groupBy("cluster_id").agg(F.max("size").alias("size"), F.avg("to_centre").alias("cohesion"))
    return size.join(near, "cluster_id").select("cluster_id", "size", "typical", "cohesion")

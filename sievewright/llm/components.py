"""Problem 5: consolidating pairwise matches into groups by hash-to-min."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, cut, drop, filled

#: Nodes whose links a task contracts before it begins anew.
NODES = 500_000


def links_of(matches: DataFrame, a: str = "canonical", b: str = "duplicate") -> DataFrame:
    """Undirected links ``(a, b)`` with ``a < b``.

    Ids are lower-cased and trimmed; rows with a null or blank side and rows that
    point to themselves are no links. Other columns are ignored.
    """
    x, y = F.lower(filled(F.col(a))), F.lower(filled(F.col(b)))
    return (
        matches.select(x.alias("x"), y.alias("y"))
        .where("x is not null and y is not null and x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the same components: every node that a task has met with the least node it knows to be linked to it."""
    root: dict[str, str] = {}

    def find(v: str) -> str:
        top = v
        while (up := root.setdefault(top, top)) != top:
            top = up
        while (up := root[v]) != top:
            root[v], v = top, up
        return top

    def stars() -> pa.RecordBatch:
        pairs = [(r, v) for v in root if (r := find(v)) != v]
        root.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
        if len(root) > NODES:
            yield stars()
    yield stars()


def hash_to_min(links: DataFrame) -> DataFrame:
    """Connected components: ``(node, group_id)`` for every node of ``links(a, b)``.

    Every vertex holds a cluster set, kept as rows ``(v, u)`` and never collected
    into an array. In a round each vertex sends its set to the set's least member
    and that member to all others; it ends when a round changes nothing. The least
    member comes from an aggregation that combines before the shuffle; the join
    that sends it back has a hot vertex only on its many-rows side, which adaptive
    execution splits. Before the first round every task contracts the links it
    reads to stars, of bounded size, which combines a hot vertex's links where they
    lie and shortens chains. Every round is a table in the shared folder, so a lost
    executor costs a part of one round. ``group_id`` is the group's smallest node.
    An empty input gives an empty result. Null ids are not allowed (see links_of).

    Inside, nodes are numbers, told out once to the distinct ones, so the rounds
    shuffle 16 bytes a row whatever the ids are; ids come back at the end.
    """
    spark = links.sparkSession
    pair = lambda v, u: F.struct(F.col(v).alias("v"), F.col(u).alias("u"))
    links, stars_path = cut(links.select("a", "b").mapInArrow(_stars, "a string, b string"), "stars")
    nodes, _ = cut(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("n", F.monotonically_increasing_id()), "nodes")
    numbered = links.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("x")), "a").join(nodes.select(F.col("node").alias("b"), F.col("n").alias("y")), "b")
    state, path = cut(
        numbered.select(F.explode(F.array(pair("x", "y"), pair("y", "x"), pair("x", "x"), pair("y", "y"))).alias("p"))
        .select("p.v", "p.u")
        .distinct(),
        "components",
    )
    drop(spark, stars_path)
    before = None
    while True:
        least = state.groupBy("v").agg(F.min("u").alias("m"))
        sent = (
            state.join(apart(least, "v"), "v")
            .select(F.explode(F.array(pair("m", "u"), pair("u", "m"))).alias("p"))
            .select("p.v", "p.u")
            .distinct()
        )
        nxt, nxt_path = cut(sent, "components")
        drop(spark, path)
        state, path = nxt, nxt_path
        now = tuple(
            state.agg(F.count("*"), F.expr("bit_xor(xxhash64(v, u))"), F.expr("sum(xxhash64(u, v) % 1000003)")).first()
        )
        if now == before:
            break
        before = now
    members, _ = cut(nodes.join(apart(state.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m")), "n"), "n").select("node", "m"), "members")
    names = members.groupBy("m").agg(F.min("node").alias("group_id"))
    return members.join(apart(names, "m"), "m").select("node", "group_id")


def group_matches(matches: DataFrame, a: str = "canonical", b: str = "duplicate") -> DataFrame:
    """``(record_id, group_id)`` of every id linked to another one, directly or over others.

    Ids without a record still link. An id that only points to itself, or whose
    partner is null or blank, is in no group.
    """
    return hash_to_min(links_of(matches, a, b)).withColumnRenamed("node", "record_id")

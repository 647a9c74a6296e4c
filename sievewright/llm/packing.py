"""Problem 7: filling fixed-capacity containers with items of varying length.

What is packed is the number of items of each size, never the items themselves:
sizes above a third of the capacity are paired by greedy matching, smaller ones
best-fit the remaining gaps, and each item looks up its place by its rank among
those of its size. The plan is global whatever the number of items.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Parts the items of one size are ranked in, so that no size is ranked in one task.
BUCKETS = 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, tokenizer: str | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_tokens)``; null and empty texts have no token."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=[id_col, "n_tokens"])

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (sizes in a bin, number of such bins) for ``counts`` items of each size.

    Sizes above a third of the capacity, from the largest: each is matched with
    the largest other such size that still fits, so a bin has at most two. Smaller
    sizes, from the largest, go into the smallest gap that takes them.
    """
    left = np.zeros(capacity + 1, np.int64)
    for s, n in counts.items():
        left[s] += n
    third = capacity // 3
    gaps: dict[int, list] = defaultdict(list)
    open_ = np.zeros(capacity + 1, bool)

    def put(sizes: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(sizes)
        gaps[gap].append((sizes, n))
        open_[gap] = True

    for a in range(capacity, third, -1):
        while left[a]:
            fits = np.flatnonzero(left[third + 1 : min(capacity - a, a) + 1]) + third + 1
            fits = fits[(fits != a) | (left[a] > 1)]
            if not len(fits):
                put((a,), int(left[a]))
                left[a] = 0
                break
            b = int(fits[-1])
            n = int(left[a] // 2 if a == b else min(left[a], left[b]))
            left[a] -= n
            left[b] -= n
            put((a, b), n)
    for s in range(third, 0, -1):
        while left[s]:
            some = np.flatnonzero(open_[s:])
            if len(some):
                gap = s + int(some[0])
                sizes, n = gaps[gap].pop()
                open_[gap] = bool(gaps[gap])
                m = min(n, int(left[s]))
                if n > m:
                    gaps[gap].append((sizes, n - m))
                    open_[gap] = True
                put((*sizes, s), m)
                left[s] -= m
            else:
                each = min(capacity // s, int(left[s]))
                n = int(left[s]) // each
                put((s,) * each, n)
                left[s] -= n * each
    return [run for gap in sorted(gaps) for run in gaps[gap]]


class Places:
    """From (size, rank among the items of that size) to (bin, offset in the bin)."""

    def __init__(self, runs: list[tuple[tuple[int, ...], int]], capacity: int):
        self.capacity = capacity
        rows, taken, first = [], defaultdict(int), 0
        for sizes, n in runs:
            at, seen = 0, {}
            for s in sizes:
                seen.setdefault(s, []).append(at)
                at += s
            for s, ats in seen.items():
                for a in ats:
                    rows.append((s, taken[s], first, a))
                    taken[s] += n
            first += n
        rows.sort()
        self.bins = first
        size, rank, self.first, self.at = (np.array(c, np.int64) for c in (zip(*rows) if rows else ([],) * 4))
        self.rank, self.key = rank, size * (1 << 48) + rank

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, size * (1 << 48) + rank, "right") - 1
        return self.first[k] + rank - self.rank[k], self.at[k]


def pack(sizes: DataFrame, capacity: int = 2048, id_col: str = "doc_id", size_col: str = "n_tokens") -> DataFrame:
    """``(doc_id, piece, token_start, n_tokens, bin_id, bin_offset)``.

    An item above the capacity is cut into full pieces and a rest; no other is
    split. Null sizes and sizes below 1 take no place. An id that comes twice is
    two items. Empty in, empty out.

    Scale: the driver sees one count for each size and rank bucket (at most
    capacity x 64) and plans in a time that doesn't depend on the number of items;
    the plan it broadcasts is bounded by the sizes too. One shuffle of the small
    ``(id, size)`` rows ranks them, each size in 64 parts.
    """
    spark = sizes.sparkSession
    c = F.lit(capacity)
    pieces = F.ceil(F.col(size_col) / c).cast("long")
    items = (
        sizes.where(F.col(size_col) > 0)
        .select(F.col(id_col).alias("id"), F.col(size_col).cast("long").alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"))
        .select("id", "piece", (F.col("piece") * c).alias("token_start"), F.least(c, F.col("size") - F.col("piece") * c).alias("n"))
        .withColumn("bucket", F.pmod(F.xxhash64("id", "piece"), F.lit(BUCKETS)).cast("int"))
    )
    items, _ = cut(items, "packing")
    got = items.groupBy("n", "bucket").agg(F.count("*").alias("c")).toArrow()
    n, bucket, count = (got.column(k).to_numpy() for k in range(3))
    before = np.zeros((capacity + 1, BUCKETS), np.int64)
    before[n.astype(np.int64), bucket] = count
    totals = before.sum(1)
    before = np.cumsum(before, 1) - before
    places = Places(plan({s: int(t) for s, t in enumerate(totals) if t}, capacity), capacity)
    shared = spark.sparkContext.broadcast((places, before))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, base = shared.value
        for batch in batches:
            size, part, rank = (batch.column(k).to_numpy() for k in ("n", "bucket", "rank"))
            bins, at = found.find(size, base[size, part] + rank - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("piece"), batch.column("token_start"), batch.column("n"), pa.array(bins), pa.array(at)],
                names=[id_col, "piece", "token_start", "n_tokens", "bin_id", "bin_offset"],
            )

    kind = sizes.schema[id_col].dataType.simpleString()
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("n", "bucket").orderBy("id", "piece")).cast("long"))
    return ranked.mapInArrow(
        place, f"`{id_col}` {kind}, piece long, token_start long, n_tokens long, bin_id long, bin_offset long"
    )


def pack_documents(documents: DataFrame, capacity: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """Token counts of the documents' texts, packed by :func:`pack`."""
    return pack(token_counts(documents, tokenizer), capacity)

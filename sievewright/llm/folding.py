"""Problem 1: duplicates hidden by formatting differences.

Texts go through a skip-and-fold table straight into rolling polynomial hashes; a
canonical string is never built. Rows whose hashes agree are then compared with
their group's first row by two pointers that skip what doesn't count.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, cut

#: All letters and digits of Unicode lie below; what lies above is no letter.
TOP = 0x32400
PRIME = 2_147_483_647
#: Marks of code that don't count, and quotation marks outside the Pi and Pf categories.
MARKS = ",;:."
QUOTES = "\"'`´‚‛„‟〝〞〟＂＇「」『』❛❜❝❞ʼʹ′″‘’“”"


@cache
def table(kind: str) -> np.ndarray:
    """Code point -> folded code point, 0 for one that is skipped.

    ``title`` keeps letters and digits. ``code`` skips white space, control and
    invisible characters, ``, ; : .`` and quotation marks of any style. Folding
    is to lower case, one character to one.
    """
    out = np.zeros(TOP + 1, np.uint32)
    drop_ = set(MARKS + QUOTES)
    for cp in range(TOP):
        ch = chr(cp)
        if kind == "title":
            keep = ch.isalnum()
        else:
            keep = not (
                ch.isspace()
                or ch in drop_
                or unicodedata.category(ch) in ("Cc", "Cf", "Zs", "Zl", "Zp", "Pi", "Pf")
                or 0xFE00 <= cp <= 0xFE0F
                or cp in (0x115F, 0x1160, 0x3164, 0xFFA0, 0x2800, 0x034F)
            )
        if keep:
            low = ch.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    out[TOP] = 0 if kind == "title" else 1
    return out


def fold(text: str, kind: str) -> np.ndarray:
    """Folded code points of the characters that count."""
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    codes = table(kind)[np.minimum(cps, TOP)]
    return codes[codes > 0]


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    wide, narrow = np.ones(n, np.uint64), np.ones(n, np.uint64)
    if n > 1:
        half_w, half_n = _powers(n // 2)
        h = n // 2
        wide[:h], narrow[:h] = half_w, half_n
        with np.errstate(over="ignore"):
            step = half_w[-1] * np.uint64(0x9E3779B97F4A7C15)
            wide[h:] = half_w * step
        step_n = int(half_n[-1]) * 1_000_003 % PRIME
        narrow[h:] = half_n * np.uint64(step_n) % np.uint64(PRIME)
    return wide, narrow


def poly_hashes(texts: list[str], kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: a polynomial hash modulo 2**64, one modulo 2**31-1, and its length.

    All texts of the batch are one stream of code points; hashes are sums of
    value times power of the place among the characters kept.
    """
    n = len(texts)
    lens = np.fromiter(map(len, texts), np.int64, n)
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = table(kind)[np.minimum(cps, TOP)]
    keep = codes > 0
    row = np.repeat(np.arange(n), lens)[keep]
    codes = codes[keep].astype(np.uint64)
    kept = np.bincount(row, minlength=n)
    start = np.cumsum(kept) - kept
    place = np.arange(len(row)) - start[row]
    wide, narrow = _powers(1 << max(4, int(kept.max(initial=1)).bit_length()))
    h1, h2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if len(row):
        some = kept > 0
        with np.errstate(over="ignore"):
            mixed = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            h1[some] = np.add.reduceat(mixed * wide[place], start[some])
        h2[some] = np.add.reduceat(codes * narrow[place] % np.uint64(PRIME), start[some]) % np.uint64(PRIME)
    return h1.astype(np.int64), h2.astype(np.int64), kept.astype(np.int64)


def same(a: str, b: str, kind: str, block: int = 1 << 16) -> bool:
    """Two pointers over both texts, block by block, skipping what doesn't count."""
    if a == b:
        return True
    i = j = 0
    x = y = np.empty(0, np.uint32)
    while True:
        while not len(x) and i < len(a):
            x, i = fold(a[i : i + block], kind), i + block
        while not len(y) and j < len(b):
            y, j = fold(b[j : j + block], kind), j + block
        n = min(len(x), len(y))
        if n == 0:
            return len(x) == len(y)
        if not np.array_equal(x[:n], y[:n]):
            return False
        x, y = x[n:], y[n:]


def code_of(solution: str | None) -> str | None:
    """The code in a solution's JSON, empty where it has none; null if it isn't whole JSON.

    A null solution is a record without code.
    """
    if solution is None:
        return ""
    try:
        v = json.loads(solution)
    except (ValueError, RecursionError):
        return None
    code = v.get("code") if isinstance(v, dict) else None
    return code if isinstance(code, str) else ""


def _hashed(bits: int):
    mask = np.int64(-1) if bits >= 64 else np.int64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, titles, solutions = (batch.column(i).to_pylist() for i in range(3))
            rows = [
                (i, t, c)
                for i, t, s in zip(ids, titles, solutions)
                if i is not None and t is not None and (c := code_of(s)) is not None
            ]
            if not rows:
                continue
            ids, titles, codes = map(list, zip(*rows))
            t1, t2, n = poly_hashes(titles, "title")
            c1, c2, m = poly_hashes(codes, "code")
            take = n > 0
            key = [t1 & mask, c1 & mask] + ([(t2 << 31) ^ c2, (n << 32) ^ m] if bits >= 64 else [n * 0, n * 0])
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.string())} | {f"k{i}": pa.array(k) for i, k in enumerate(key)}).filter(pa.array(take))

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, code_of_last = None, None
    for batch in batches:
        d, kept, ok = batch.to_pydict(), [], []
        for k, (t, s, rt, rs) in enumerate(zip(d["title"], d["solution"], d["rep_title"], d["rep_solution"])):
            if last is None or rs != last[0]:
                last, code_of_last = (rs,), code_of(rs)
            code = code_of(s)
            if t is not None and rt is not None and code is not None and code_of_last is not None:
                kept.append(k)
                ok.append(same(t, rt, "title") and same(code, code_of_last, "code"))
        at = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("rep").take(at), pa.array(ok, pa.bool_())], names=["id", "rep", "same"])


#: Rows of (id, first id) that are broadcast to the texts; more are shuffled.
BROADCAST_ROWS = 300_000
KEYS = ["k0", "k1", "k2", "k3"]


def formatting_duplicates(
    records: DataFrame, id_col: str = "id", title_col: str = "title", solution_col: str = "canonical_solution", hash_bits: int = 64
) -> DataFrame:
    """``(record_id, group_id, n_copies)`` of every record that has a copy written otherwise.

    Copies agree in the title's letters and digits and in the code without white
    space, invisible characters, ``, ; : .`` and quotation marks; case never
    counts. Rows under one id count once (the copies of an id are equal; were they
    not, its first group in string order holds). Records with a null id or title,
    with a title without letter or digit, or with a solution that isn't whole JSON
    take no part; a null solution is one without code. Other columns are ignored.

    Scale: hashes alone find the groups; only texts of groups of two or more are
    then shuffled, once, to their group's first row, and never meet all pairs. That
    first row comes from an aggregation combined before the shuffle, and adaptive
    execution splits a group of a third of all rows in the join. Rows that differ
    from their group's first in spite of equal hashes go into another round among
    themselves, until none is left.
    """
    texts = records.select(F.col(id_col).cast("string").alias("id"), F.col(title_col).alias("title"), F.col(solution_col).alias("solution"))
    rows, _ = cut(texts.mapInArrow(_hashed(hash_bits), "id string, k0 long, k1 long, k2 long, k3 long"), "hashes")
    found = None
    while True:
        first = rows.groupBy(*KEYS).agg(F.min("id").alias("rep"), F.max("id").alias("last")).where("last > rep").drop("last")
        member, _ = cut(rows.join(apart(first, "k0"), KEYS).select("id", "rep").distinct(), "members")
        small = member.count() <= BROADCAST_ROWS
        grouped = texts.join(F.broadcast(member) if small else member, "id")
        reps = grouped.where("id = rep").select("rep", F.col("title").alias("rep_title"), F.col("solution").alias("rep_solution"))
        others = grouped.where("id <> rep")
        compared, _ = cut(others.join(reps, "rep").select("id", "title", "solution", "rep", "rep_title", "rep_solution").mapInArrow(_compared, "id string, rep string, same boolean"), "folding")
        good = compared.where("same").select("id", "rep").unionByName(compared.where("same").select(F.col("rep").alias("id"), "rep"))
        found = good if found is None else found.unionByName(good)
        other = compared.where("not same").select("id").distinct()
        if other.isEmpty():
            break
        rows = rows.join(other, "id", "left_semi")
    by_id = found.groupBy("id").agg(F.min("rep").alias("group_id"))
    sizes = by_id.groupBy("group_id").agg(F.count("*").alias("n_copies")).where("n_copies > 1")
    return by_id.join(apart(sizes, "group_id"), "group_id").select(F.col("id").alias("record_id"), "group_id", "n_copies")

"""Problem 3: new batches deduplicated against all history.

Of every batch one immutable suffix array is kept. Its concatenated text is the
distinct words of each record in one fixed order, the rarest first; two records
that share 0.6 of their words share one of their rarest (prefix filtering), so the
suffixes that begin there are stored, sorted, in pages by their first word. A new
batch's suffixes are found in the stored pages by binary search; what the covered
places, the sizes and the word bitmaps can't rule out is checked exactly. Pages lie
in bucketed tables: only the new batch's suffixes are shuffled to them, and history
is neither shuffled nor sorted again. Arrays of like size are merged, so there are
about as many as the logarithm of the batches' number.
"""

from __future__ import annotations

import html
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, apart, cut, drop, shared_dir

#: Earlier records a new one is paired with at first under each word; then eight times as many.
FEW = 8
#: Pairs whose records' numbers are broadcast; with more they are shuffled.
BROADCAST_PAIRS = 500_000
#: Suffixes of a page, about; records of a batch that are searched at once.
PAGE, AT_ONCE = 300_000, 4_000_000
#: Bits of a record's bitmap; new records and stored suffixes compared at once; pairs of small groups at once.
BITS, BLOCK, WIDE, PAIRS = 256, 64, 4096, 1 << 20
_MARKUP = re.compile(r"<[^<>]*>")


class _Known(dict):
    """63-bit values of words."""

    def __missing__(self, w: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        v = self[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1
        return v


_known = _Known()


def words_of(title: str | None, description: str | None) -> list[int]:
    """Values of the distinct words of title and description, markup and character entities aside."""
    text = f"{title or ''} {description or ''}"
    text = html.unescape(_MARKUP.sub(" ", text)) if "&" in text or "<" in text else text
    return list(map(_known.__getitem__, set(WORD.findall(text.lower()))))


RECORDS = "id string, new boolean, seq long, words array<long>, key string"


def _records(from_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, new, seq, titles, texts = (batch.column(i) for i in range(5))
            rows = []
            for title, text in zip(titles.to_pylist(), texts.to_pylist()):
                if from_payload:
                    try:
                        v = json.loads(text) if text else {}
                    except (ValueError, RecursionError):
                        v = {}
                    v = v if isinstance(v, dict) else {}
                    title = v["title"] if isinstance(v.get("title"), str) else title
                    text = v["description"] if isinstance(v.get("description"), str) else None
                rows.append(words_of(title, text))
            some = pa.array([k for k, r in enumerate(rows) if r and ids[k].is_valid], pa.int64())
            kept = [rows[k] for k in some.to_pylist()]
            n = np.fromiter(map(len, kept), np.int64, len(kept))
            flat = np.fromiter(chain.from_iterable(kept), np.int64, int(n.sum()))
            flat = flat[np.lexsort((flat, np.repeat(np.arange(len(n)), n)))]
            ends = np.append(0, np.cumsum(n))
            raw = memoryview(flat.tobytes())
            keys = [xxhash.xxh3_128_hexdigest(raw[8 * a : 8 * b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [ids.take(some), new.take(some), seq.take(some), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)), pa.array(keys, pa.string())],
                names=["id", "new", "seq", "words", "key"],
            )

    return run


def history_rows(records: DataFrame) -> DataFrame:
    """Words of the stored records: title and description of the payload, or the title column where it is broken."""
    return records.select("id", F.lit(False), F.lit(-1).cast("long"), "title", "payload").mapInArrow(_records(True), RECORDS)


def batch_rows(new_records: DataFrame) -> DataFrame:
    return new_records.select("id", F.lit(True), F.col("seq_no").cast("long"), "title", "description").mapInArrow(_records(False), RECORDS)


def _order():
    return F.struct("new", "seq", "id")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The lists' values, and how many each list has."""
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def frequent_words(classes: DataFrame, share: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Words in more than one of ``share`` records, and in how many. There are at most ``share`` x the words a record has."""

    def run(batches):
        found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            w, n = np.unique(np.concatenate([_flat(batch.column(0))[0], found]), return_counts=True)
            old = np.searchsorted(w, found)
            n[old] += counts - 1
            found, counts = w, n
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts)], names=["w", "n"])

    total = classes.count()
    rows = classes.select("words").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    got = rows.where(F.col("n") > max(2, total // share)).orderBy("w").toArrow()
    return got.column(0).to_numpy(), got.column(1).to_numpy()


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(31))


def prefixes(flat: np.ndarray, size: np.ndarray, words: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, ...]:
    """(record, word, place) of each record's suffixes that count, and the records' bitmaps.

    ``flat``: the records' distinct words one record after the other, ``size`` of
    each. In the fixed order the first n - ceil(threshold x n) + 1 of n words: two
    records that are ``threshold`` alike share one of them, whatever the order is,
    as long as it is the same for all records.
    """
    owner = np.repeat(np.arange(len(size)), size)
    rank = _mix(flat) >> np.uint64(2)
    if len(words):
        k = np.minimum(np.searchsorted(words, flat), len(words) - 1)
        often = words[k] == flat
        rank[often] = np.uint64(1 << 62) + counts[k[often]].astype(np.uint64) * np.uint64(1 << 20) + (rank[often] >> np.uint64(44))
    bits = np.zeros((len(size), BITS), bool)
    bits[owner, (flat >> 20) % BITS] = True
    order = np.lexsort((flat, rank, owner))
    flat = flat[order]
    place = np.arange(len(flat)) - (np.cumsum(size) - size)[owner]
    kept = place <= (size - np.ceil(threshold * size - 1e-9))[owner]
    return owner[kept], flat[kept], place[kept], np.packbits(bits, axis=1)


SUFFIXES = "shard int, rec long, size int, bits binary, words array<long>, places array<int>"


def suffixes(classes: DataFrame, words: np.ndarray, counts: np.ndarray, shards: int, threshold: float) -> DataFrame:
    """The classes' suffixes, one row for each shard that a class has some in; a shard is a word's value modulo ``shards``."""
    shared = classes.sparkSession.sparkContext.broadcast((words, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                flat, size = _flat(batch.column(0))
                own, word, place, bits = prefixes(flat, size, *shared.value, threshold)
                shard = word % shards
                order = np.lexsort((place, shard, own))
                own, word, place, shard = own[order], word[order], place[order], shard[order]
                begin = np.flatnonzero(np.diff(_runs(own, shard), prepend=-1))
                offsets = pa.array(np.append(begin, len(own)).astype(np.int32))
                at = own[begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[begin].astype(np.int32)),
                        batch.column(1).take(pa.array(at)),
                        pa.array(size[at].astype(np.int32)),
                        pa.array([bits[k].tobytes() for k in at], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(word)),
                        pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))),
                    ],
                    names=["shard", "rec", "size", "bits", "words", "places"],
                )

    return classes.select("words", "rec").mapInArrow(run, SUFFIXES)


def _runs(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new) - 1


#: A page: the records it speaks of by number, and its suffixes sorted by word, then by the record's size, then by the record.
PAGES = "shard int, rec binary, size binary, bits binary, word binary, own binary, place binary"


def _sorted_page(table: pa.Table) -> pa.Table:
    rec, size = table.column("rec").to_numpy(), table.column("size").to_numpy()
    words = table.column("words").combine_chunks()
    word, n = _flat(words)
    own = np.repeat(np.arange(len(rec), dtype=np.int32), n)
    place = table.column("places").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    order = np.lexsort((rec[own], size[own], word))
    parts = [rec.astype("<i8"), size.astype("<i4"), b"".join(table.column("bits").to_pylist()), word[order], own[order], place[order].astype("<i4")]
    row = [[p if isinstance(p, bytes) else p.tobytes()] for p in parts]
    return pa.table([pa.array([table.column("shard")[0].as_py()], pa.int32()), *[pa.array(r, pa.binary()) for r in row]], names=["shard", "rec", "size", "bits", "word", "own", "place"])


def _merged_page(table: pa.Table) -> pa.Table:
    """One page of several: their suffixes, sorted already, in one order (runs are merged, not sorted anew)."""
    parts = {c: [np.frombuffer(b, t) for b in table.column(c).to_pylist()] for c, t in (("rec", "<i8"), ("size", "<i4"), ("word", "<i8"), ("own", "<i4"), ("place", "<i4"))}
    first = np.cumsum([0, *(len(r) for r in parts["rec"])])
    rec, size, word, place = (np.concatenate(parts[c]) for c in ("rec", "size", "word", "place"))
    own = np.concatenate([o + f for o, f in zip(parts["own"], first)]).astype(np.int32)
    order = np.lexsort((rec[own], size[own], word))
    row = [rec, size, b"".join(table.column("bits").to_pylist()), word[order], own[order], place[order]]
    cells = [[p if isinstance(p, bytes) else p.tobytes()] for p in row]
    return pa.table([pa.array([table.column("shard")[0].as_py()], pa.int32()), *[pa.array(c, pa.binary()) for c in cells]], names=["shard", "rec", "size", "bits", "word", "own", "place"])


def _search_page(threshold: float, lo: int, hi: int):
    """Pairs of an asking record and an earlier one in the page that share a rare word and may be similar.

    A pair is ruled out only by what can't be otherwise: by the words that are left
    after the shared one in both, and by bits that differ, each of which takes a
    word that differs. ``lo`` and ``hi``: which of the earlier records that are left
    under a word, in their order, are paired; where there are more, a row names the
    next one as ``-1 - r``.
    """
    share = threshold / (1 + threshold)  # of both sizes together, that similar records have in common

    def run(asks: pa.Table, page: pa.Table) -> pa.Table:
        out_q, out_r = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if not asks.num_rows or not page.num_rows:
            return pa.table({"q": out_q[0], "r": out_r[0]})
        page = _merged_page(page) if page.num_rows > 1 else page
        p_rec, p_size, p_word, p_own, place = (np.frombuffer(page.column(c)[0].as_py(), t) for c, t in (("rec", "<i8"), ("size", "<i4"), ("word", "<i8"), ("own", "<i4"), ("place", "<i4")))
        p_bits = np.frombuffer(page.column("bits")[0].as_py(), np.uint64).reshape(len(p_rec), -1)
        rec, size = p_rec[p_own], p_size[p_own].astype(np.int64)
        spare = (1 - share) * size - place + 1e-6  # a similar record has at most spare / share words
        a_rec, a_size, a_best = (asks.column(c).to_numpy() for c in ("rec", "size", "best"))
        a_bits = np.frombuffer(b"".join(asks.column("bits").to_pylist()), np.uint64).reshape(len(a_rec), -1)
        word, n = _flat(asks.column("words").combine_chunks())
        own = np.repeat(np.arange(len(a_rec)), n)
        a_place = asks.column("places").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        q_size = a_size[own].astype(np.int64)
        q_spare = (1 - share) * q_size - a_place + 1e-6
        order = np.lexsort((-q_spare, word))
        word, own, q_size, q_spare = word[order], own[order], q_size[order], q_spare[order]
        begin, end = np.searchsorted(p_word, word, "left"), np.searchsorted(p_word, word, "right")

        def keep(q: np.ndarray, r: np.ndarray) -> None:
            """Takes pairs of suffixes that passed, all of an asking suffix at once."""
            may = (rec[r] < a_rec[own[q]]) & (rec[r] < a_best[own[q]]) & (q_spare[q] >= share * size[r]) & (spare[r] >= share * q_size[q])
            q, r = q[may], r[may]
            o = np.lexsort((rec[r], q))
            q, r = q[o], r[o]
            first = np.flatnonzero(np.diff(q, prepend=-1))
            k = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
            now, next_ = (k >= lo) & (k < hi), k == hi
            out_q.extend((a_rec[own[q[now]]], a_rec[own[q[next_]]]))
            out_r.extend((rec[r[now]], -1 - rec[r[next_]]))

        def near(q: np.ndarray, r: np.ndarray) -> np.ndarray:
            differ = np.bitwise_count(a_bits[own[q]] ^ p_bits[p_own[r]]).sum(1, dtype=np.int64)
            return differ <= (1 - 2 * share) * (q_size[q] + size[r]) + 1e-6

        heads = np.flatnonzero(np.diff(_runs(word), prepend=-1))
        asking = np.diff(np.append(heads, len(word)))
        large = (end[heads] - begin[heads]) * asking > 4096
        some = np.flatnonzero(np.repeat(~large, asking) & (end > begin))
        count = end[some] - begin[some]
        for at in np.split(np.arange(len(some)), np.flatnonzero(np.diff(np.cumsum(count) // PAIRS)) + 1):
            m = count[at]
            q = np.repeat(some[at], m)
            r = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m - begin[some[at]], m)
            fit = (q_spare[q] >= share * size[r]) & (spare[r] >= share * q_size[q])
            q, r = q[fit], r[fit]
            ok = near(q, r)
            keep(q[ok], r[ok])
        half, got_q, got_r = p_bits.shape[1], [], []
        for a, k in zip(heads[large], asking[large]):
            every = np.arange(begin[a], end[a])
            sizes, least = size[every], q_size[a : a + k].min()
            every = every[(spare[every] >= share * least) & (share * sizes <= q_spare[a])]
            sizes, spares, columns = size[every], spare[every], np.ascontiguousarray(p_bits[p_own[every]].T[:half])
            for q0 in range(a, a + k, BLOCK):
                q = np.arange(q0, min(q0 + BLOCK, a + k))
                # asking suffixes stand by what they can spare, stored ones by size: both cut the other side
                fit = np.flatnonzero(spares >= share * q_size[q].min())
                fit = fit[: np.searchsorted(sizes[fit], q_spare[q[0]] / share, "right")]
                q = q[q_spare[q] >= share * sizes[fit[0]]] if len(fit) else q[:0]
                mine, most_q = a_bits[own[q]].T[:half], (1 - 2 * share) * q_size[q].max(initial=0) + 1e-6
                for part in (fit[s : s + WIDE] for s in range(0, len(fit) if len(q) else 0, WIDE)):
                    differ = np.bitwise_count(mine[0][:, None] ^ columns[0][part])
                    for m_, c_ in zip(mine[1:], columns[1:]):
                        differ += np.bitwise_count(m_[:, None] ^ c_[part])
                    close = np.flatnonzero(differ <= np.minimum((1 - 2 * share) * sizes[part] + most_q, 255).astype(np.uint8))
                    i, j = close // len(part), close % len(part)
                    ok = near(q[i], every[part[j]])
                    got_q.append(q[i[ok]]), got_r.append(every[part[j[ok]]])
                if got_q:
                    q_, r_ = np.concatenate(got_q), np.concatenate(got_r)
                    o = np.argsort(q_, kind="stable")
                    keep(q_[o], r_[o])
                    got_q.clear(), got_r.clear()
        q, r = np.concatenate(out_q), np.concatenate(out_r)
        q, r = np.unique(np.stack([q, r]), axis=1) if len(q) else (q, r)
        return pa.table({"q": q, "r": r})

    return run


@dataclass
class Segment:
    """One immutable suffix array: a bucketed table of pages. ``hot``: words whose suffixes have shards of their own, (first of them, how many)."""

    name: str
    path: str
    shards: int
    records: int
    n: int
    hot: dict[int, tuple[int, int]]


def _shards(n: int, page: int) -> int:
    """A power of two, at least 16, that lays about ``page`` of ``n`` suffixes in a shard."""
    return 1 << max(4, (-(-n // page) - 1).bit_length())


class History:
    """An index of accepted records that batches are checked against and added to.

    ``segments``: a suffix array for each batch, later merged; ``classes``: the
    records they hold, those of equal words as one, numbered in their order
    (``rec``). Which words are frequent, and so the order of words, is fixed by the
    first batch, so later ones never change old arrays but to merge them. Pages hold
    about ``page`` suffixes: an array has as many shards as that takes (powers of
    two), and a word with more suffixes than a page is spread over shards of its own
    by record. Of a very large batch ``at_once`` records are searched at a time.
    """

    def __init__(self, spark: SparkSession, threshold: float = 0.6, page: int = PAGE, at_once: int = AT_ONCE):
        self.spark, self.threshold, self.page, self.at_once = spark, threshold, page, at_once
        self.classes: list[DataFrame] = []
        self.segments: list[Segment] = []
        self.words = self.counts = None
        self.seen = 0

    def _collapse(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The batch's classes with their numbers, and (id, key) of its rows; equal word sets are one class."""
        classes = (
            rows.groupBy("key")
            .agg(F.min_by(F.struct("id", "new", "seq", "words"), _order()).alias("f"), F.count("*").alias("copies"))
            .select("key", "f.*")
            .orderBy(_order())
            .withColumn("rec", F.monotonically_increasing_id() + F.lit(self.seen << 48))
        )
        return cut(classes, "classes")[0], rows.select("id", "new", "seq", "key").distinct()

    def _stored(self, pages: DataFrame, shards: int, build, records: int, n: int, hot: dict) -> Segment:
        """Builds a page of each shard's rows and stores them bucketed by shard."""
        name = f"pages_{uuid.uuid4().hex}"
        path = f"{shared_dir(self.spark)}/{name}"
        buckets = max(shards, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        made = pages.repartition(buckets, "shard").groupBy("shard").applyInArrow(build, PAGES)
        made.write.bucketBy(buckets, "shard").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
        return Segment(name, path, shards, records, n, hot)

    def _hot(self, rows: DataFrame, records: int, shards: int) -> dict[int, tuple[int, int]]:
        """Words with more suffixes than a page; none where there are no more records than that."""
        if records <= self.page:
            return {}
        many = rows.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") > self.page).orderBy("w").collect()
        out, first = {}, shards
        for r in many:
            out[r.w] = first, -(-r.n // self.page)
            first += out[r.w][1]
        return out

    @staticmethod
    def _routed(rows: DataFrame, shards: int, hot: dict[int, tuple[int, int]], asking: bool) -> DataFrame:
        """Rows of suffixes in the shards of an array; asking ones go to every shard of a hot word, stored ones to their record's."""
        rows = rows.withColumn("shard", F.pmod("shard", F.lit(shards)).cast("int"))
        if not hot:
            return rows
        shared = rows.sparkSession.sparkContext.broadcast(hot)
        return rows.mapInArrow(_spread(shared, asking), rows.schema)

    def add(self, rows: DataFrame, search: bool = True) -> DataFrame | None:
        """Adds a batch; with ``search`` gives ``(id, first_id)`` of its records that repeat an earlier one.

        Earlier is what the index holds and what comes before in the batch.
        """
        classes, members = self._collapse(rows)
        if self.words is None:
            self.words, self.counts = frequent_words(classes)
        self.seen += 1
        records, n = classes.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
        n = int(n * (1 - self.threshold)) + records
        shards = _shards(n, self.page)
        most = max([shards, *(s.shards for s in self.segments)])
        fresh, path = cut(suffixes(classes, self.words, self.counts, most, self.threshold), "suffixes")
        hot = self._hot(fresh, records, shards)
        self.classes.append(classes)
        self.segments.append(self._stored(self._routed(fresh, shards, hot, False), shards, _sorted_page, records, n, hot))
        found = None
        if search:
            parts = max(1, -(-records // self.at_once))
            for k in range(parts):
                some = fresh.where(F.pmod(F.xxhash64("rec"), F.lit(parts)) == k) if parts > 1 else fresh
                pairs = self._search(some)
                found = pairs if found is None else found.unionByName(pairs)
            found, _ = cut(self._firsts(found, classes, members), "repeats")
        drop(self.spark, path)
        while len(self.segments) > 1 and self.segments[-1].records.bit_length() >= self.segments[-2].records.bit_length():
            self._merge(self.segments.pop(), self.segments.pop())
        return found

    def _merge(self, a: Segment, b: Segment) -> None:
        """Two arrays as one; where pages would grow too large, the shards are taken twice as fine."""
        records, n = a.records + b.records, a.n + b.n
        # by their paths: a union of bucketed scans claims a partitioning that doesn't hold
        pages, shards = self.spark.read.schema(PAGES).parquet(a.path).unionByName(self.spark.read.schema(PAGES).parquet(b.path)), _shards(n, self.page)
        if a.shards == b.shards == shards and records <= self.page:
            merged = self._stored(pages, shards, _merged_page, records, n, {})
        else:
            rows, path = cut(pages.mapInArrow(_unpaged, SUFFIXES).mapInArrow(_resharded(shards), SUFFIXES), "suffixes")
            hot = self._hot(rows, records, shards)
            merged = self._stored(self._routed(rows, shards, hot, False), shards, _sorted_page, records, n, hot)
            drop(self.spark, path)
        for s in (a, b):
            self.spark.sql(f"drop table `{s.name}`")
            drop(self.spark, s.path)
        self.segments.append(merged)

    def _all_classes(self) -> DataFrame:
        out = self.classes[0]
        for c in self.classes[1:]:
            out = out.unionByName(c)
        return out

    def _checked(self, raw: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs that are alike in truth, with the earlier record's id."""
        pairs, _ = cut(raw.where("r >= 0").select("q", "r").distinct(), "pairs")
        met = pairs.select(F.explode(F.array("q", "r")).alias("rec")).distinct()
        met = F.broadcast(met) if pairs.count() <= BROADCAST_PAIRS else met
        sets, _ = cut(classes.join(met, "rec", "left_semi").select("rec", "id", F.col("words").alias("set")), "sets")
        both = pairs.join(sets.select(F.col("rec").alias("q"), F.col("set").alias("a")), "q").join(sets.select(F.col("rec").alias("r"), "id", F.col("set").alias("b")), "r")
        both = both.withColumn("i", F.size(F.array_intersect("a", "b")))
        alike = F.col("i") >= (F.size("a") + F.size("b") - F.col("i")) * F.lit(self.threshold) - 1e-9
        return cut(both.where(alike).select("q", "r", "id"), "similar")[0]

    def _search(self, fresh: DataFrame) -> DataFrame:
        """``(q, r, id)``: for each record of the batch its first similar ones, of two ids where there are."""
        never = F.lit(2**63 - 1)
        classes = self._all_classes()
        asks, lo, hi, best = fresh.withColumn("best", never), 0, FEW, None
        while True:
            raw = None
            for s in self.segments:
                mine = self._routed(asks, s.shards, s.hot, True)
                got = mine.groupBy("shard").cogroup(self.spark.table(s.name).groupBy("shard")).applyInArrow(_search_page(self.threshold, lo, hi), "q long, r long")
                raw = got if raw is None else raw.unionByName(got)
            raw, _ = cut(raw, "matches")
            found = self._checked(raw, classes)
            best = found if best is None else best.unionByName(found)
            # who has found records of two ids by now looks only for earlier ones: one of them may be its own
            two = best.groupBy("q", "id").agg(F.min("r").alias("r")).groupBy("q").agg(F.sort_array(F.collect_list("r")).alias("rs"))
            two = two.select("q", F.when(F.size("rs") > 1, F.col("rs")[1]).alias("done"))
            more = raw.where("r < 0").groupBy("q").agg(F.min(-1 - F.col("r")).alias("next")).join(two, "q", "left")
            more, _ = cut(more.where("done is null or next < done").select(F.col("q").alias("rec"), F.coalesce("done", never).alias("best")), "crowded")
            if more.isEmpty():
                return best
            asks = fresh.join(more, "rec")
            lo, hi = hi, hi * 8

    def _firsts(self, best: DataFrame, batch: DataFrame, members: DataFrame) -> DataFrame:
        """``(id, first_id)`` of the batch's rows; of records with equal words, also older ones, the first stands for all."""
        classes = self._all_classes()
        known = classes.select("rec", "id", "new", "seq", "key")
        first = (
            best.select("q", "r").join(batch.select(F.col("rec").alias("q"), F.col("key").alias("q_key")), "q")
            .join(known.select(F.col("rec").alias("r"), "id", "new", "seq"), "r")
            .groupBy(F.col("q_key").alias("key"), "id")
            .agg(F.min(_order()).alias("other"))
            .groupBy("key")
            .agg(F.slice(F.sort_array(F.collect_list("other")), 1, 2).alias("others"))
        )
        heads = known.join(batch.select("key"), "key", "left_semi").groupBy("key").agg(F.min(_order()).alias("head"))
        own = members.join(apart(heads.join(first, "key", "left"), "key"), "key")
        own = own.withColumn("other", F.get(F.filter("others", lambda o: o["id"] != F.col("id")), F.lit(0)))
        same = F.when(F.struct("new", "seq", "id") > F.col("head"), F.col("head"))
        same = F.when(F.col("id") != F.col("head.id"), same)
        return (
            own.withColumn("first", F.least("other", same))
            .where("first is not null and first.id <> id")
            .groupBy("id")
            .agg(F.min("first").alias("first"))
            .select("id", F.col("first.id").alias("first_id"))
        )


def _spread(shared, asking: bool):
    """Rows of suffixes with those of hot words in the words' own shards, one row for each record and shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.array(sorted(shared.value), np.int64)
        first, parts = (np.array([shared.value[w][k] for w in hot.tolist()], np.int64) for k in (0, 1))
        for batch in batches:
            word, n = _flat(batch.column("words"))
            place = batch.column("places").flatten().to_numpy(zero_copy_only=False)
            own = np.repeat(np.arange(batch.num_rows), n)
            shard = batch.column("shard").to_numpy().astype(np.int64)[own]
            at = np.minimum(np.searchsorted(hot, word), len(hot) - 1)
            is_hot = hot[at] == word
            if asking:  # to each of a hot word's shards
                times = np.where(is_hot, parts[at], 1)
                nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                own, word, place, shard, at, is_hot = (np.repeat(c, times) for c in (own, word, place, shard, at, is_hot))
                shard = np.where(is_hot, first[at] + nth, shard)
            else:
                salt = (_mix(batch.column("rec").to_numpy())[own] % parts[at].astype(np.uint64)).astype(np.int64)
                shard = np.where(is_hot, first[at] + salt, shard)
            order = np.lexsort((place, shard, own))
            own, word, place, shard = own[order], word[order], place[order], shard[order]
            begin = np.flatnonzero(np.diff(_runs(own, shard), prepend=-1)) if len(own) else np.zeros(0, np.int64)
            offsets, rows = pa.array(np.append(begin, len(own)).astype(np.int32)), pa.array(own[begin])
            made = {
                "shard": pa.array(shard[begin].astype(np.int32)), "words": pa.ListArray.from_arrays(offsets, pa.array(word)),
                "places": pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))),
            }
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c).take(rows) for c in names], names=names)

    return run


def _unpaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes of pages as rows again, one for each record of a page."""
    for batch in batches:
        for k in range(batch.num_rows):
            get = lambda c, t: np.frombuffer(batch.column(c)[k].as_py(), t)  # noqa: B023, E731
            rec, size, word, own, place = get("rec", "<i8"), get("size", "<i4"), get("word", "<i8"), get("own", "<i4"), get("place", "<i4")
            bits = get("bits", np.uint8).reshape(len(rec), -1)
            order = np.argsort(own, kind="stable")
            offsets = pa.array(np.searchsorted(own[order], np.arange(len(rec) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(rec), np.int32)), pa.array(rec), pa.array(size), pa.array([b.tobytes() for b in bits], pa.binary())]
                + [pa.ListArray.from_arrays(offsets, pa.array(word[order])), pa.ListArray.from_arrays(offsets, pa.array(place[order]))],
                names=["shard", "rec", "size", "bits", "words", "places"],
            )


def _resharded(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, n = _flat(batch.column("words"))
            own = np.repeat(np.arange(batch.num_rows), n)
            place = batch.column("places").flatten().to_numpy(zero_copy_only=False)
            shard = word % shards
            order = np.lexsort((place, shard, own))
            own, word, place, shard = own[order], word[order], place[order], shard[order]
            begin = np.flatnonzero(np.diff(_runs(own, shard), prepend=-1)) if len(own) else np.zeros(0, np.int64)
            offsets = pa.array(np.append(begin, len(own)).astype(np.int32))
            at = pa.array(own[begin])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard[begin].astype(np.int32)), *[batch.column(c).take(at) for c in ("rec", "size", "bits")]]
                + [pa.ListArray.from_arrays(offsets, pa.array(word)), pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32)))],
                names=["shard", "rec", "size", "bits", "words", "places"],
            )

    return run


def repeats(records: DataFrame, new_records: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``(new_id, first_id)`` of each id of ``new_records`` that repeats an earlier record.

    One record repeats another if both share at least ``threshold`` of the distinct
    words of title and description together, markup and character entities aside.
    All of ``records`` comes first (by id where several are repeated), then new
    records by ``seq_no``; an id is never earlier than itself. Records without a
    word or an id take no part; a payload that isn't whole JSON leaves the title.

    All new batches form one arrival here; :class:`History` takes them one by one
    with the same result. All such pairs are found, whatever the texts' lengths, the
    order of their words and the number of records alike.
    """
    index = History(records.sparkSession, threshold)
    index.add(history_rows(records), search=False)
    found = index.add(batch_rows(new_records))
    return found.select(F.col("id").alias("new_id"), "first_id")


def arrivals(records: DataFrame, new_records: DataFrame, parts: int = 3, threshold: float = 0.6) -> DataFrame:
    """``(arrival, new_id, first_id)``: the new batches in ``parts`` arrivals of consecutive batches, one after the other.

    An arrival is checked against what was there before it and what comes before
    in it, and then belongs to the history. An id has a row for each arrival that
    it comes in and repeats an earlier record.
    """
    index = History(records.sparkSession, threshold)
    index.add(history_rows(records), search=False)
    least, most = new_records.agg(F.min("batch_no"), F.max("batch_no")).first()
    out = records.sparkSession.createDataFrame([], "arrival int, new_id string, first_id string")
    for k in range(parts if least is not None else 0):
        lo, hi = (least + (most + 1 - least) * i // parts for i in (k, k + 1))
        found = index.add(batch_rows(new_records.where((F.col("batch_no") >= lo) & (F.col("batch_no") < hi))))
        out = out.unionByName(found.select(F.lit(k).alias("arrival"), F.col("id").alias("new_id"), "first_id"))
    return out

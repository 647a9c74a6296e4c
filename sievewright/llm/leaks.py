"""Problem 8: evaluation texts leaking into training text.

Windows of the smallest size that a leaked part of an item can be trusted to hold
whole are embedded by the CGK random walk, which turns edit distance into Hamming
distance. Keys sampled from the embedding, as many as a target recall takes, meet
those of the test items' windows, and of what meets the item-sized window around is
verified word by word: its longest common run and its exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD

#: Words of a window; coordinates of its walk; coordinates a key samples; most keys a window may have.
WINDOW, WALK, SAMPLED, MOST_KEYS = 8, 24, 5, 32
#: Words of the shortest item that near passages are promised of; trials that the number of keys is found with.
SHORTEST, TRIALS = 24, 500
#: Characters of test items that one pass takes; more items are taken in several passes.
BLOCK_CHARS = 8_000_000
_FILTER_BITS = 21
_known: dict[str, int] = {}


def word_ids(text: str) -> list[int]:
    """64-bit values of the text's words: runs of letters and digits in lower case."""
    words = WORD.findall(text.lower())
    try:
        return [_known[w] for w in words]
    except KeyError:
        if len(_known) > 1_000_000:
            _known.clear()
        for w in words:
            if w not in _known:
                _known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        return [_known[w] for w in words]


def cgk(words: np.ndarray, starts: np.ndarray, window: int = WINDOW, walk: int = WALK) -> np.ndarray:
    """The embedding of each window: ``walk`` symbols, 0 beyond the window's end.

    Step j copies the symbol at the walk's place and moves on if bit j of the
    symbol's value is set: the random function of step j and symbol.
    """
    place = np.zeros(len(starts), np.int64)
    out = np.zeros((walk, len(starts)), np.uint64)
    for j in range(walk):
        inside = place < window
        symbol = np.where(inside, words[starts + np.minimum(place, window - 1)], 0)
        out[j] = symbol
        place += ((symbol >> np.uint64(j)) & np.uint64(1)).astype(np.int64) | ~inside
    return out


def sampled_keys(embedding: np.ndarray, keys: int, sampled: int = SAMPLED, seed: int = 8) -> np.ndarray:
    """One hash for each repetition, of coordinates drawn from the embedding."""
    rng = np.random.default_rng(seed)
    out = np.zeros((keys, embedding.shape[1]), np.uint64)
    with np.errstate(over="ignore"):
        for r in range(keys):
            for j in np.sort(rng.choice(embedding.shape[0], sampled, replace=False)):
                out[r] = (out[r] ^ embedding[j]) * np.uint64(0x9E3779B97F4A7C15)
                out[r] ^= out[r] >> np.uint64(29)
    return out


def edited(words: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """The words after ``n`` random substitutions, deletions and insertions."""
    out = words.tolist()
    for _ in range(n):
        at, new = int(rng.integers(len(out))), int(rng.integers(1 << 62))
        kind = rng.integers(3)
        if kind == 0:
            out[at] = new
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, new)
    return np.array(out, np.uint64)


def keys_for(recall: float, max_edits: float, stride: int, window: int = WINDOW, seed: int = 80) -> tuple[int, float]:
    """The least number of keys that finds a share of ``recall`` of passages at the edit limit, and the share found.

    Found by trial: passages of the shortest promised size with as many random
    edits as are allowed, at a random place of a text. One is found if a window of
    the text and one of the passage share a key. One key if no edits are allowed.
    """
    if max_edits <= 0:
        return 1, 1.0
    rng = np.random.default_rng(seed)
    first = np.full(TRIALS, MOST_KEYS)
    for t in range(TRIALS):
        item = rng.integers(1 << 62, size=SHORTEST).astype(np.uint64)
        text = edited(item, int(max_edits * SHORTEST), rng)
        text = np.concatenate([rng.integers(1 << 62, size=int(rng.integers(stride))).astype(np.uint64), text, rng.integers(1 << 62, size=window).astype(np.uint64)])
        mine = sampled_keys(cgk(item, np.arange(SHORTEST - window + 1), window), MOST_KEYS)
        theirs = sampled_keys(cgk(text, np.arange(0, len(text) - window + 1, stride), window), MOST_KEYS)
        met = (mine[:, :, None] == theirs[:, None, :]).any((1, 2))
        first[t] = np.argmax(met) if met.any() else MOST_KEYS
    found = np.array([(first < k).mean() for k in range(1, MOST_KEYS + 1)])
    k = int(np.argmax(found >= recall)) if (found >= recall).any() else MOST_KEYS - 1
    return k + 1, float(found[k])


class ItemIndex:
    """Keys of every window of every item, and the items' words."""

    def __init__(self, ids: list, texts: list[str], keys: int = 1, sampled: int = SAMPLED, window: int = WINDOW):
        self.keys, self.sampled, self.window = keys, sampled, window
        words = [np.array(word_ids(t), np.uint64) for t in texts]
        self.ids, self.len = ids, np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.len) - self.len
        self.words = np.concatenate([*words, np.zeros(window, np.uint64)])
        self.vocabulary, self.numbers = np.unique(self.words, return_inverse=True)
        n = np.maximum(self.len - window + 1, 0)
        self.item = np.repeat(np.arange(len(ids)), n)
        self.at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = sampled_keys(cgk(self.words, self.first[self.item] + self.at, window), keys, sampled)
        self.order = np.argsort(found, axis=1)
        self.sorted = np.take_along_axis(found, self.order, 1)
        self.filter = np.zeros((keys, 1 << _FILTER_BITS), bool)
        for r in range(keys):
            self.filter[r, found[r] >> np.uint64(64 - _FILTER_BITS)] = True

    def meet(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window of the text, window of an item) that share a key, each once."""
        a, b = [], []
        for r in range(self.keys):
            some = np.flatnonzero(self.filter[r, keys[r] >> np.uint64(64 - _FILTER_BITS)])
            lo = np.searchsorted(self.sorted[r], keys[r, some], "left")
            n = np.searchsorted(self.sorted[r], keys[r, some], "right") - lo
            a.append(np.repeat(some, n))
            b.append(self.order[r, np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
        both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        return both[0], both[1]


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Most consecutive places at which both agree."""
    off = np.flatnonzero(np.concatenate([[True], a != b, [True]]))
    return int(np.diff(off).max()) - 1


def nearest_distance(text: np.ndarray, item: np.ndarray) -> int:
    """Word edit distance between the item and the part of the text that is nearest to it."""
    at = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, x in enumerate(item):
        row = np.concatenate([[i + 1], np.minimum(row[1:] + 1, row[:-1] + (text != x))])
        row = np.minimum.accumulate(row - at) + at
    return int(row.min())


def leaks(
    documents: DataFrame, items: DataFrame, min_run: int = 12, max_edits: float = 0.2, recall: float = 0.95,
    text_col: str = "text", id_col: str = "doc_id", item_text: str = "item_text", item_id: str = "item_id",
) -> DataFrame:
    """``(doc_id, item_id, longest_run, edits)`` of every item that leaked into a document.

    It leaked if the text holds at least ``min_run`` consecutive words of it, or a
    part within ``max_edits`` x its words of edit distance from the whole item. For
    runs nothing is missed: a run of 12 words holds a whole window of 8 that begins
    at a multiple of 5 of the document's words, items have windows at every word, and
    equal windows have equal keys. Near items of 24 words or more are found with at
    least ``recall`` (:func:`keys_for` makes as many keys as that takes), and what is
    reported is exact. ``edits`` is the distance of the nearest part met. Words are
    runs of letters and digits in lower case. Null, empty and short texts leak
    nothing; a row given twice comes twice only if its id does; other columns are
    ignored.

    Scale: one narrow pass over the documents, without a shuffle. The items are
    broadcast in blocks of at most 8,000,000 characters; more take several passes.
    """
    spark = documents.sparkSession
    stride = max(1, min_run - WINDOW + 1)
    keys, _ = keys_for(recall, max_edits, stride)
    rows = items.where(f"`{item_id}` is not null and `{item_text}` is not null").select(item_id, item_text)
    whole = rows.agg(F.coalesce(F.sum(F.length(item_text)), F.lit(0))).first()[0]
    blocks = max(1, -(-whole // BLOCK_CHARS))
    id_type, item_type = documents.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, `{item_id}` {item_type}, longest_run int, edits int"
    out = None
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64(item_id), F.lit(blocks)) == k).toArrow()
        index = ItemIndex(part.column(0).to_pylist(), part.column(1).to_pylist(), keys)
        found = documents.select(id_col, text_col).mapInArrow(
            _search(spark.sparkContext.broadcast(index), min_run, max_edits, stride, part.schema.field(0).type, id_col, item_id), schema
        )
        out = found if out is None else out.unionByName(found)
    return out


def _search(shared, min_run: int, max_edits: float, stride: int, item_type, id_col: str, item_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        present = np.zeros(len(index.vocabulary) + 1, bool)
        for whole in batches:
            for batch in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                texts = [word_ids(t) if t else [] for t in batch.column(1).to_pylist()]
                lens = np.array([len(t) for t in texts], np.int64)
                words = np.fromiter((w for t in texts for w in t), np.uint64, int(lens.sum()))
                first = np.cumsum(lens) - lens
                n = np.maximum((lens - index.window) // stride + 1, 0) * (lens >= index.window)
                doc = np.repeat(np.arange(len(texts)), n)
                at = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * stride
                best: dict[tuple[int, int], list[int]] = {}
                if len(doc):
                    numbers = np.minimum(np.searchsorted(index.vocabulary, words), len(index.vocabulary) - 1)
                    numbers[index.vocabulary[numbers] != words] = len(index.vocabulary)
                    a, b = index.meet(sampled_keys(cgk(words, first[doc] + at, index.window), index.keys, index.sampled))
                    lines = np.unique(np.stack([doc[a], index.item[b], at[a] - index.at[b]]), axis=1)
                    for d, i, shift in lines.T.tolist():
                        n, size = int(lens[d]), int(index.len[i])
                        item = index.words[index.first[i] : index.first[i] + size]
                        lo, hi = max(0, shift), min(n, shift + size)
                        run_ = longest_run(words[first[d] + lo : first[d] + hi], item[lo - shift : hi - shift])
                        limit = int(max_edits * size)
                        lo, hi = first[d] + max(0, shift - limit), first[d] + min(n, shift + size + limit)
                        near = numbers[lo:hi]
                        present[near] = True
                        missing = size - np.count_nonzero(present[index.numbers[index.first[i] : index.first[i] + size]])
                        present[near] = False
                        if run_ >= min_run or missing <= limit > 0:  # every word of the item that isn't there is an edit
                            old = best.setdefault((d, i), [0, size])
                            best[d, i] = [max(old[0], run_), min(old[1], nearest_distance(words[lo:hi], item))]
                    best = {di: v for di, v in best.items() if v[0] >= min_run or v[1] <= int(max_edits * index.len[di[1]])}
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([d for d, _ in best], pa.int64())),
                        pa.array([index.ids[i] for _, i in best], item_type),
                        pa.array([v[0] for v in best.values()], pa.int32()),
                        pa.array([v[1] for v in best.values()], pa.int32()),
                    ],
                    names=[id_col, item_id, "longest_run", "edits"],
                )

    return run

"""Problem 9: text garbled by decoding with the wrong character encoding.

A smoothed character n-gram model of the clean records scores, for every run of
non-ASCII characters and its surroundings, each text that some chain of encoding
and decoding makes of it; the likeliest wins if it gains more than a margin that
is validated on all clean runs and the same runs garbled on purpose.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop

#: Fixed values: (encoding the text was wrongly read in, encoding it was written in).
CHAINS = tuple((wrong, "utf-8") for wrong in ("cp1252", "latin-1", "cp1250", "iso8859-2", "iso8859-15", "mac_roman", "cp437", "cp850", "cp866", "cp1251", "koi8-r", "gbk", "big5", "shift_jis")) + (
    ("cp1252", "cp1251"), ("latin-1", "cp1251"), ("cp1252", "koi8-r"), ("latin-1", "koi8-r"), ("cp1252", "cp866"), ("latin-1", "cp866"),
    ("cp1252", "cp1250"), ("latin-1", "cp1250"), ("latin-1", "iso8859-2"), ("cp1252", "gbk"), ("latin-1", "gbk"), ("cp1252", "mac_roman"),
    ("mac_roman", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("cp1251", "cp1252"), ("cp1250", "cp1252"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"), ("cp866", "cp1251"), ("cp1251", "cp866"),
)
_MULTI = ("gbk", "big5", "shift_jis")
DEPTH = 3
_RUN = re.compile(r"[^\x00-\x7f]+")
_UTF8 = re.compile("(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")
_C0 = re.compile("[\x00-\x1f]")
_C1 = re.compile("[\x80-\x84\x86-\x9f]")
BITS = 20
SIZE = 1 << BITS
#: Weights of trigram, bigram and unigram, and the probability of a character never seen.
WEIGHTS, FLOOR = (0.6, 0.25, 0.15), 1e-7
_CACHE = 200_000


@cache
def _bytes_of(encoding: str) -> dict[int, str]:
    """Code point -> the byte, as a Latin-1 character; bytes without a character are C1 controls."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[ord(bytes([b]).decode(encoding))] = chr(b)
        except UnicodeDecodeError:
            out.setdefault(b, chr(b))
    return out


class _Mapped(dict):
    def __missing__(self, cp):
        known = self[cp] = "\uffff" if cp > 127 else chr(cp)
        return known


@cache
def _table(encoding: str) -> _Mapped:
    return _Mapped(_bytes_of(encoding))


@cache
def _starts(wrong: str | None = None) -> re.Pattern:
    """A character the chain reads as a UTF-8 lead, then one it reads as a continuation; null: any chain."""
    if wrong is None:
        return re.compile("|".join(sorted({_starts(w).pattern for w, r in CHAINS if r == "utf-8" and w not in _MULTI})))
    by = _bytes_of(wrong)
    lead = "".join(re.escape(chr(c)) for c, b in by.items() if "\xc2" <= b <= "\xf4")
    cont = "".join(re.escape(chr(c)) for c, b in by.items() if "\x80" <= b <= "\xbf")
    return re.compile(f"[{lead}][{cont}]")


@lru_cache(_CACHE)
def _may_begin(char: str, wrong: str, right: str) -> bool:
    """The character is one of the wrong encoding and, where UTF-8 is read, begins a character there."""
    try:
        first = char.encode(wrong)[0]
    except UnicodeError:
        return False
    return right != "utf-8" or 0xC2 <= first <= 0xF4 or first < 0x80


@lru_cache(_CACHE)
def _others_from(char: str) -> tuple[tuple[str, str], ...]:
    """Chains with other encodings that a run beginning with the character may have gone through."""
    return tuple(c for c in CHAINS if c[1] != "utf-8" and _may_begin(char, *c))


def undo(run: str, wrong: str, right: str) -> str | None:
    """What ``run`` was before it was read as ``wrong``; null if that can't be.

    Of a run read in a one-byte encoding the parts that are whole UTF-8 are
    restored and the others kept, so clean characters beside garbled ones stay.
    """
    if (right != "utf-8" or wrong in _MULTI) and not _may_begin(run[0], wrong, right):
        return None
    try:
        if right != "utf-8":
            out = run.encode(wrong).decode(right)
        elif wrong in _MULTI:
            out = run.encode(wrong).decode("utf-8")
        else:
            if not _starts(wrong).search(run):
                return None
            mapped = run.translate(_table(wrong))
            if not _UTF8.search(mapped):
                return None
            parts, at = [], 0
            for m in _UTF8.finditer(mapped):
                try:
                    fixed = m[0].encode("latin-1").decode("utf-8")
                except UnicodeDecodeError:
                    continue
                parts += [run[at : m.start()], fixed]
                at = m.end()
            out = "".join(parts) + run[at:]
    except (UnicodeError, LookupError):
        return None
    return None if out == run or _C0.search(out) else out


@lru_cache(_CACHE)
def candidates(run: str) -> dict[str, tuple[tuple[str, str], ...]]:
    """Every text that up to three UTF-8 chains make of the run, with the shortest chains."""
    found: dict[str, tuple] = {run: ()}
    level = [run]
    for _ in range(DEPTH):
        nxt = []
        for text in level:
            one_byte = _starts().search(text)
            for chain in CHAINS:
                if chain[1] != "utf-8" or not one_byte and chain[0] not in _MULTI:
                    continue
                out = undo(text, *chain)
                if out is not None and out not in found:
                    found[out] = (*found[text], chain)
                    nxt.append(out)
        level = nxt
    del found[run]
    return found


@lru_cache(_CACHE)
def others(run: str) -> dict[tuple[tuple[str, str], ...], str]:
    """Every text that a chain with other encodings makes of the run, alone, before or after up to three UTF-8 chains."""
    found: dict[str, tuple] = {}
    for text, path in ((run, ()), *candidates(run).items()):
        for chain in _others_from(text[0]):
            if (out := undo(text, *chain)) is not None:
                found.setdefault((*path, chain), out)
                if not path:
                    for text2, path2 in candidates(out).items():
                        found.setdefault((chain, *path2), text2)
    return found


def _undone(run: str, path: tuple) -> str:
    return others(run).get(path, run)


def windows(text: str) -> Iterator[tuple[int, int, tuple[str, str, str]]]:
    """Place and ``(two characters before, run, two after)`` of each non-ASCII run."""
    for m in _RUN.finditer(text):
        a, b = m.span()
        yield a, b, (text[a - 2 if a > 2 else 0 : a], m[0], text[b : b + 2])


def beside(left: str, run: str, right: str) -> str:
    """The run between two characters before it and what follows: every character from the third on is scored."""
    return ("\n\n" + left)[-2:] + run + right


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) & (SIZE - 1)


#: Wrong encodings that make Latin letters and signs of any text, and four such letters in a row,
#: which no language writes: runs like these don't train the model.
_WESTERN = tuple(w for w, r in CHAINS if r == "utf-8" and w in ("cp1252", "latin-1", "cp1250", "iso8859-2", "iso8859-15", "mac_roman", "cp437", "cp850"))
_LATIN_ROW = re.compile("[\x80-\xff]{4}")
#: Blocks whose characters texts are written in; what else a run decodes to is chance.
_WRITTEN = re.compile("[\xa0-\u017f\u0218-\u021b\u0370-\u04ff\u02c6-\u02dd\u2000-\u22ff\u2500-\u27bf\u3000-\u9fff\uac00-\ud7a3\uff00-\uffef\U0001f300-\U0001faff]+")


@lru_cache(_CACHE)
def _suspect(run: str) -> bool:
    """Most of the run may be UTF-8 read in a Western encoding, or it is a row of Latin letters."""
    if _LATIN_ROW.search(run):
        return True
    if len(run) > 1 and _starts().search(run):
        for wrong in _WESTERN:
            if _starts(wrong).search(run):
                parts = _UTF8.findall(run.translate(_table(wrong)))
                good = (p for p in parts if _WRITTEN.fullmatch(p.encode("latin-1").decode("utf-8", "replace")))
                if 2 * sum(map(len, good)) >= len(run):
                    return True
    return False


def clean(text: str) -> bool:
    """No character lost and no control that no text has."""
    return "\ufffd" not in text and not _C1.search(text)


def clean_windows(text: str) -> Iterator[tuple[str, str, str]]:
    """Windows of the runs that aren't suspect."""
    for *_, w in windows(text):
        if not _suspect(w[1]):
            yield w


#: Windows a task keeps before it passes them on.
_KEPT = 200_000


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of buckets, and the clean windows as rows without a count, each once or a few times."""

    def rows(counts: dict[int, int], some: set[tuple[str, str, str]]) -> pa.RecordBatch:
        none, some = [None] * len(counts), list(some)
        texts = [pa.array(none + [w[k] for w in some], pa.string()) for k in range(3)]
        n = [pa.array([*x, *[None] * len(some)], pa.int64()) for x in (counts, counts.values())]
        return pa.RecordBatch.from_arrays([*n, *texts], names=["bucket", "n", "left", "run", "right"])

    total: Counter = Counter()
    held: set[tuple[str, str, str]] = set()
    for batch in batches:
        seen: Counter = Counter()
        for text in batch.column(0).to_pylist():
            if text and not text.isascii() and clean(text):
                seen.update([w for _, _, w in windows(text)])
        for w in [w for w in seen if _suspect(w[1])]:
            del seen[w]
        held.update(seen)
        if len(held) > _KEPT:
            yield rows({}, held)
            held.clear()
        tri, bi, uni = Counter(), Counter(), Counter()
        for w, n in seen.items():
            t = beside(*w)
            for k in range(2, len(t)):
                tri[t[k - 2 : k + 1]] += n
                bi[t[k - 1 : k + 1]] += n
                uni[t[k]] += n
        for order, counts in enumerate((tri, bi, uni)):
            for g, n in counts.items():
                total[order * SIZE + _bucket(g)] += n
    yield rows(total, held)


@dataclass
class Model:
    """Interpolated trigram model over 2**20 buckets an order.

    ``margin``: the least gain of a repair.
    """

    tri: np.ndarray
    bi: np.ndarray
    uni: np.ndarray
    margin: float = 4.0
    _known: dict = field(default_factory=dict)
    _seen: dict = field(default_factory=dict)
    _others: dict = field(default_factory=dict)
    _helped: dict = field(default_factory=dict)
    _further: dict = field(default_factory=dict)
    _quiet: set = field(default_factory=set)
    _loud: set = field(default_factory=set)
    _garbling: Garbling | None = None

    @classmethod
    def of(cls, buckets: np.ndarray, counts: np.ndarray) -> Model:
        all_ = np.zeros(3 * SIZE, np.int64)
        all_[buckets] = counts
        return cls(*all_.reshape(3, SIZE))

    def __post_init__(self):
        self.total = max(1, int(self.uni.sum()))

    def garbling(self) -> Garbling:
        if self._garbling is None:
            self._garbling = Garbling(self)
        return self._garbling

    def log_p(self, gram: str) -> float:
        """Log probability of a trigram's last character after the two before."""
        if len(self._known) > _CACHE:
            self._known.clear()
        n_abc, n_ab = int(self.tri[_bucket(gram)]), int(self.bi[_bucket(gram[:2])])
        n_bc, n_b, n_c = int(self.bi[_bucket(gram[1:])]), int(self.uni[_bucket(gram[1])]), int(self.uni[_bucket(gram[2])])
        p = FLOOR + WEIGHTS[2] * n_c / self.total
        p += WEIGHTS[1] * n_bc / n_b if n_b >= n_bc > 0 else 0
        p += WEIGHTS[0] * n_abc / n_ab if n_ab >= n_abc > 0 else 0
        known = self._known[gram] = math.log(min(p, 1.0))
        return known

    def score(self, left: str, run: str, right: str, least: float = -math.inf) -> float:
        """Log probability of the run and what follows; any value not above ``least`` where it can't get there."""
        text, known, total = beside(left, run, right), self._known, 0.0
        for k in range(len(text) - 2):
            p = known.get(gram := text[k : k + 3])
            total += self.log_p(gram) if p is None else p
            if total <= least:
                break
        return total

    def unseen(self, run: str, text: str) -> float:
        """What new characters never seen cost more: ``FLOOR`` for each further byte, so shortening a run alone gains nothing."""
        new, known = 0, self._further
        for c in text:
            if (n := known.get(c)) is None:
                n = known[c] = 0 if self.uni[_bucket(c)] else len(c.encode("utf-8", "surrogatepass")) - 1
            if n and c not in run:
                new += n
        return -math.log(FLOOR) * new

    def judge(self, window: tuple[str, str, str]) -> tuple[float, float, str, tuple]:
        """Score of the run as it is; gain, text and chain of the likeliest UTF-8 candidate."""
        if (known := self._seen.get(window)) is None:
            if len(self._seen) > _CACHE:
                self._seen.clear()
            left, run, right = window
            base = self.score(left, run, right)
            known = base, 0.0, run, ()
            for text, chain in candidates(run).items():
                least = base + known[1] + 2.0 * (len(chain) - 1)
                if (total := self.score(left, text, right, least)) <= least:
                    continue
                gain = total - base - 2.0 * (len(chain) - 1) - self.unseen(run, text)
                if gain > known[1]:
                    known = base, gain, text, chain
            self._seen[window] = known
        return known

    def others(self, window: tuple[str, str, str]) -> dict[tuple, float]:
        """Gain of the run by each chain with other encodings, a unit less for each character scored."""
        if (known := self._others.get(window)) is None:
            if len(self._others) > _CACHE // 10:
                self._others.clear()
            left, run, right = window
            base = self.judge(window)[0] + len(run) + len(right)
            known = {path: self.score(left, text, right) - base - self._cost(run, text, path) for path, text in others(run).items()}
            self._others[window] = known
        return known

    def _cost(self, run: str, text: str, path: tuple) -> float:
        return 2.0 * (len(path) - 1) + (self.unseen(run, text) if len(path) > 1 else 0)

    def helped(self, window: tuple[str, str, str]) -> dict[tuple, float]:
        """The gains of :meth:`others` above zero; scoring a text ends where it can't reach one, as a character adds nothing above 0."""
        if (known := self._helped.get(window)) is None:
            if len(self._helped) > _CACHE:
                self._helped.clear()
            left, run, right = window
            base, scored, known = self.judge(window)[0] + len(run) + len(right), {}, {}
            for path, text in others(run).items():
                if (total := scored.get(text)) is None:
                    total = scored[text] = self.score(left, text, right, base)
                if total > base and (gain := total - base - self._cost(run, text, path)) > 0:
                    known[path] = gain
            self._helped[window] = known
        return known

    def quiet(self, window: tuple[str, str, str]) -> bool:
        """No chain changes the run, whatever else the line has."""
        if window in self._quiet:
            return True
        if window in self._loud:
            return False
        if len(self._quiet) + len(self._loud) > _CACHE:
            self._quiet.clear(), self._loud.clear()
        quiet = self.judge(window)[1] <= self.margin and not _spaced(window) and not self.helped(window)
        (self._quiet if quiet else self._loud).add(window)
        return quiet


def _spaced(window: tuple[str, str, str]) -> bool:
    """The run may end with a no-break space that became a plain one."""
    return window[2][:1] == " " and window[1][-1] in "ÃÂ€â"


def gains_of(model: Model, window: tuple[str, str, str]) -> tuple[float, list[float]]:
    """What a wrong repair of a clean window gains, and what the right repairs of the run garbled by every UTF-8 chain gain.

    No garbled run is left out, also not one of which another text would gain more.
    """
    left, run, after = window
    total, right = model.score(left, run, after), []
    for bad, good in CHAINS:
        try:
            garbled_ = run.encode(good).decode(bad) if good == "utf-8" else run
        except UnicodeError:
            continue
        if garbled_ != run:
            right.append(total - model.score(left, garbled_, after) - model.unseen(garbled_, run))
    return model.judge(window)[1], right


#: Encodings that read every byte as one character.
_ONE_BYTE = tuple(w for w, r in CHAINS if r == "utf-8" and w not in _MULTI)


class Garbling:
    """:func:`gains_of` many windows at a time.

    What any three bytes in a row are read as is scored once in each one-byte
    encoding; the score of a run read there is the sum of its triples and its ends.
    """

    def __init__(self, model: Model):
        self.model = model
        self.ids = np.full(1 << 21, -1, np.int32)  # of three times seven bits
        self.scores = np.zeros((0, len(_ONE_BYTE)))
        self.chars = [bytes(range(0x80, 0x100)).decode(e, "replace") for e in _ONE_BYTE]
        self.unread = np.array([[c == "\ufffd" for c in chars] for chars in self.chars])
        self.ends: dict[tuple, np.ndarray] = {}

    def _each(self, *parts: str | bytes) -> np.ndarray:
        """Score from the third character on of the parts in a row, bytes read in each encoding; any value where they can't be."""
        texts = ("".join(p if isinstance(p, str) else "".join(chars[v - 0x80] for v in p) for p in parts) for chars in self.chars)
        return np.array([self.model.score(t[:2], t[2:], "") for t in texts])

    def _end(self, *parts: str | bytes) -> np.ndarray:
        if (known := self.ends.get(parts)) is None:
            if len(self.ends) > _CACHE // 4:
                self.ends.clear()
            known = self.ends[parts] = self._each(*parts)
        return known

    def _inside(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """By run and encoding: the sum of its triples, and whether it can be read."""
        flat, sizes = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) - 0x80, np.array([len(b) for b in raw])
        owner = np.repeat(np.arange(len(raw)), sizes - 2)
        first = np.arange(len(owner)) + 2 * owner  # a run has at least two bytes, and two triples fewer than bytes
        code = flat[first] << 14 | flat[first + 1] << 7 | flat[first + 2]
        new = np.unique(code[self.ids[code] < 0])
        if len(new):
            self.ids[new] = np.arange(len(new)) + len(self.scores)
            found = [self._each(bytes((c >> 14 | 0x80, c >> 7 & 0x7F | 0x80, c & 0x7F | 0x80))) for c in new.tolist()]
            self.scores = np.concatenate([self.scores, found])
        ids, starts = self.ids[code], np.cumsum(sizes) - sizes
        sums = [np.bincount(owner, scores[ids], len(raw)) for scores in self.scores.T]
        return np.stack(sums, 1), np.stack([np.add.reduceat(unread[flat], starts) == 0 for unread in self.unread], 1)

    def gains_of(self, windows_: list[tuple[str, str, str]]) -> list[tuple[float, list[float]]]:
        if not windows_:
            return []
        model, runs, out = self.model, dict.fromkeys(run for _, run, _ in windows_), []
        raw = [run.encode() for run in runs]
        for k, run in enumerate(runs):
            runs[run] = k, model.unseen("", run) > 0, [x for w in _MULTI if (x := _read(raw[k], w)) not in (None, run)]
        sums, read = self._inside(raw)
        for window in windows_:
            left, run, after = window
            k, new, multi = runs[run]
            if new:
                out.append(gains_of(model, window))
                continue
            total = model.score(left, run, after)
            each = total - (self._end(("\n\n" + left)[-2:], raw[k][:2]) + sums[k] + self._end(raw[k][-2:], after))
            out.append((model.judge(window)[1], each[read[k]].tolist() + [total - model.score(left, x, after) for x in multi]))
        return out


def _read(raw: bytes, encoding: str) -> str | None:
    try:
        return raw.decode(encoding)
    except UnicodeDecodeError:
        return None


def _least(gains: DataFrame, share: float) -> float | None:
    """The quantile of ``gain`` by linear interpolation, null without rows; only what lies below it reaches the driver."""
    n = gains.count()
    if not n:
        return None
    at = share * (n - 1)
    low = [r["gain"] for r in gains.orderBy("gain").limit(int(at) + 2).collect()]
    return low[int(at)] + (at - int(at)) * (low[min(int(at) + 1, n - 1)] - low[int(at)])


def validated_margin(model: Model, clean_: DataFrame, beyond: float = 0.001) -> float:
    """A margin halfway between what clean runs gain and what right repairs gain.

    ``clean_``: the distinct windows ``(left, run, right)`` of all clean runs. Each
    is judged as it is, which gives the gains of wrong repairs, and garbled by every
    UTF-8 chain, which gives those of the right ones, whether or not another text
    would gain more: a document is found by whichever gains most. The margin lies in the middle
    between the former's largest and the latter's smallest, but for a share of
    ``beyond`` on either side.
    """
    spark = clean_.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.garbling().gains_of(list(zip(*(c.to_pylist() for c in batch.columns))))
            gain = [-wrong for wrong, _ in found] + [g for _, right in found for g in right]
            yield pa.RecordBatch.from_arrays([pa.array([k >= len(found) for k in range(len(gain))], pa.bool_()), pa.array(gain, pa.float64())], names=["repaired", "gain"])

    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    windows_ = clean_.select("left", "run", "right").repartition(tasks, "run").sortWithinPartitions("run")  # what can be made of a run is found once
    gains, path = cut(windows_.mapInArrow(run, "repaired boolean, gain double"), "gains")
    right, wrong = _least(gains.where("repaired"), beyond), _least(gains.where("not repaired"), beyond)
    drop(spark, path)
    return model.margin if right is None else (right - wrong) / 2


def train(documents: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Counts n-grams of all clean records, and validates the margin on all their distinct clean runs.

    One pass over whole texts, then one over the distinct runs with two characters
    on either side. What reaches the driver is at most 3 x 2**20 counters and a
    thousandth of the gains.
    """
    rows, path = cut(documents.select(F.col(text_col).alias("text")).mapInArrow(_count, "bucket long, n long, left string, run string, right string"), "grams")
    got = rows.where("n is not null").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    model = Model.of(got.column(0).to_numpy(), got.column(1).to_numpy())
    model.margin = validated_margin(model, rows.where("n is null").select("left", "run", "right").distinct())
    drop(documents.sparkSession, path)
    return model


def _groups(model: Model, line: str) -> tuple[str, list[str]]:
    """The line with every contiguous group of runs restored that chains with other encodings make likelier.

    A group takes one chain; its gain, a unit less for each character scored, must pass the margin.
    """
    spans, sums = list(windows(line)), Counter()
    for *_, w in spans:
        if gains := model.helped(w):
            sums.update(gains)
    likely = [p for p, total in sums.items() if total > model.margin]  # no group gains more than all its gains above zero
    if not likely:
        return line, []
    others = [model.others(w) for *_, w in spans]
    found, todo = [], [(0, len(spans))]
    while todo:
        lo, hi = todo.pop()
        best = model.margin, lo, lo, ()
        for path in likely:
            total, start = 0.0, lo
            for k in range(lo, hi):
                if total <= 0:
                    total, start = 0.0, k
                total += others[k].get(path, 0.0)
                if total > best[0]:
                    best = total, start, k + 1, path
        if best[3]:
            found.append(best)
            todo += [(lo, best[1]), (best[2], hi)]
    parts, at = [], 0
    for _, first, last, path in sorted(found, key=lambda f: f[1]):
        for a, b, w in spans[first:last]:
            parts += [line[at:a], _undone(w[1], path)]
            at = b
    return "".join(parts) + line[at:], [">".join(f"{y}-as-{x}" for x, y in f[3]) for f in found]


def restore(model: Model, text: str) -> tuple[str, str, list[str]] | None:
    """``(status, text, chains)`` of a garbled text, null for one that isn't.

    ``restored``: all of it could be; ``partly``: something is lost for good
    (replacement characters) or a stray control remains; ``lost``: nothing could.
    UTF-8 chains are judged run by run, the others over whole lines.
    """
    if text.isascii():
        return None
    lines, chains = text.split("\n"), {}
    for k, line in enumerate(lines):
        if line.isascii():
            continue
        spans = list(windows(line))
        if all([model.quiet(w) for _, _, w in spans]):
            continue
        parts, at = [], 0
        for a, b, w in spans:
            _, gain, fixed, chain = model.judge(w)
            if gain <= model.margin and _spaced(w):
                spaced = model.judge((w[0], w[1] + "\xa0", line[b + 1 : b + 3]))
                if spaced[1] > model.margin:
                    (_, gain, fixed, chain), b = spaced, b + 1
            if gain > model.margin and a >= at:
                parts += [line[at:a], fixed]
                at = b
                chains[">".join(f"{y}-as-{x}" for x, y in chain)] = 1
        lines[k], more = _groups(model, "".join(parts) + line[at:])
        chains |= dict.fromkeys(more, 1)
    whole = "\n".join(lines)
    lost = "\ufffd" in text or bool(_C1.search(whole))
    if not chains and not lost:
        return None
    return "lost" if not chains else "partly" if lost else "restored", whole, list(chains)


def garbled(documents: DataFrame, model: Model | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, status, chains, restored)`` of every document garbled as a whole or in places.

    Null, empty and pure-ASCII texts are never garbled. Each text is looked at on
    its own, so ties, repeated rows and other columns change nothing. An empty
    table trains an empty model and gives no row.

    Scale: one pass counts n-grams into a fixed number of buckets and keeps the
    clean runs, whose distinct ones validate the margin, one narrow pass scores; texts are never shuffled and the model broadcast has a fixed size.
    """
    spark = documents.sparkSession
    model = model or train(documents, text_col, id_col)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            rows = [(k, r) for k, t in enumerate(batch.column(1).to_pylist()) if t and (r := restore(m, t))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([k for k, _ in rows], pa.int64())),
                    pa.array([r[0] for _, r in rows], pa.string()),
                    pa.array([r[2] for _, r in rows], pa.list_(pa.string())),
                    pa.array([r[1] for _, r in rows], pa.string()),
                ],
                names=[id_col, "status", "chains", "restored"],
            )

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, F.col(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, status string, chains array<string>, restored string"
    )

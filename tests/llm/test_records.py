"""Problems 1, 2, 3 and 5."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievewright.llm.components import group_matches, hash_to_min
from sievewright.llm.folding import fold, formatting_duplicates, poly_hashes, same
from sievewright.llm.history import History, batch_rows, history_rows, repeats
from sievewright.llm.survivors import field_choices, latest, says, single_sources

C = "id string, title string, canonical_solution string, extra int"


def sol(code, **kw):
    return json.dumps({"code": code, **kw})


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbB,.;:  '”​ß\n", max_size=12), st.text(alphabet="aAbB,.;:  '”​ß\n", max_size=12), st.integers(1, 5))
def test_two_pointers_and_hashes_agree(a, b, block):
    for kind in ("title", "code"):
        equal = bool(np.array_equal(fold(a, kind), fold(b, kind)))
        assert same(a, b, kind, block) == equal
        h1, h2, n = poly_hashes([a, b], kind)
        assert ((h1[0], h2[0], n[0]) == (h1[1], h2[1], n[1])) == equal


ROWS = [
    ("b", "Two Sum!", sol("def f(x):\n  return x", z=1), 1),
    ("a", "two-sum", json.dumps({"y": 2, "code": "DEF f(x) return X"}, indent=1), 2),
    ("a", "two-sum", json.dumps({"y": 2, "code": "DEF f(x) return X"}, indent=1), 2),
    ("c", "Two Sum", sol("def f(y): return y"), 3),
    ("d", "Lone", sol(""), 4),
    ("e", "lone.", sol(None), 5),
    ("f", "LONE", None, 6),
    ("g", "lone", '{"code": "', 7),
    ("h", "???", sol("x"), 8),
    ("i", "", sol("x"), 9),
    ("j", None, sol("x"), 10),
    (None, "lone", sol(""), 11),
]


@pytest.mark.parametrize("bits", [64, 2])
def test_formatting_duplicates(spark, bits):
    """With hashes of two bits nearly all rows collide, and comparing still parts them."""
    got = formatting_duplicates(spark.createDataFrame(ROWS, C), hash_bits=bits).collect()
    assert {(r.record_id, r.group_id, r.n_copies) for r in got} == {("a", "a", 2), ("b", "a", 2), ("d", "d", 3), ("e", "d", 3), ("f", "d", 3)}


def test_formatting_duplicates_long_and_empty(spark):
    long_ = "x = 1;\n" * 50_000
    rows = [("1", "T", sol(long_), 0), ("2", "t", sol(long_.replace(";", " ").upper()), 0), ("3", "t", sol(long_ + "y"), 0)]
    got = formatting_duplicates(spark.createDataFrame(rows, C)).collect()
    assert {(r.record_id, r.group_id) for r in got} == {("1", "1"), ("2", "1")}
    assert formatting_duplicates(spark.createDataFrame([], C)).count() == 0


def plain_components(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        ra, rb = sorted((find(a), find(b)))
        root[rb] = ra
    return {x: find(x) for x in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_hash_to_min_random(spark, seed):
    rng = random.Random(seed)
    links = [tuple(sorted((f"{rng.randrange(60):03d}", f"{rng.randrange(60):03d}"))) for _ in range(45)]
    links += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [("h000", f"h{i:03d}") for i in range(1, 50)]
    links = [x for x in links if x[0] != x[1]]
    got = {r.node: r.group_id for r in hash_to_min(spark.createDataFrame(links, "a string, b string").distinct()).collect()}
    assert got == plain_components(links)


def test_group_matches_dirty(spark):
    rows = [("A ", "b"), ("b", "a"), ("b", "b"), ("c", None), (None, None), ("  ", "d"), ("e", "E"), ("B", "\tz\n"), ("q", "r")]
    got = group_matches(spark.createDataFrame([(a, b, 1) for a, b in rows], "canonical string, duplicate string, v int")).collect()
    assert {(r.record_id, r.group_id) for r in got} == {("a", "a"), ("b", "a"), ("z", "a"), ("q", "q"), ("r", "q")}
    assert group_matches(spark.createDataFrame([], "canonical string, duplicate string")).count() == 0


@pytest.mark.parametrize("v", [None, "", "  ", "&nbsp;", "<p></p>", "N/A", "TODO", "# TODO", "Unknown", "?", "-", [], [""], ["none"], {"input": "", "output": None}])
def test_says_nothing(v):
    assert says(v) == 0


@pytest.mark.parametrize("v", ["0", "x", ["", "y"], {"a": [{"b": "z"}]}, 0, False])
def test_says_something(v):
    assert says(v) > 0


R = "id string, deduplicated_into string, source_name string, updated_at timestamp, payload string, title string"


def rec(id_, into, at=None, source="s", **payload):
    from datetime import datetime

    return id_, into, source, datetime(2024, 1, at) if at else None, json.dumps(payload) if payload else None, "t"


def choices(spark, rows, trust=(("s", 1),)):
    return field_choices(spark.createDataFrame(rows, R), spark.createDataFrame(list(trust), "source_name string, trust_rank int"))


def test_survivors_chain_and_single_source(spark):
    rows = [rec("c", "gone", 3, description="long text"), rec("b", "gone", 2, tags=["unknown"]), rec("a", "b", 1, tags=["x"]), rec("a", "b", 1, tags=["x"]),
            rec("z", "nowhere", 1, tags=["y"]), rec("y", None, 1, tags=["y"]), ("w", "a", None, None, '{"tags": ["', "t")]
    got = choices(spark, rows)
    assert {tuple(r) for r in single_sources(got).collect()} == {("a", "description", "c"), ("a", "tags", "a")}
    assert {r.n_members for r in got.collect()} == {4}
    assert choices(spark, []).count() == 0


def test_survivors_latest_wins(spark):
    rows = [rec("a", "b", 1, difficulty="hard"), rec("b", None, 5, difficulty="easy")]
    assert [r.record_id for r in choices(spark, rows).collect()] == ["b"]


def test_survivors_learned_precedence(spark):
    """easy gave way to hard in dated groups, so hard wins where a date is missing."""
    rows = []
    for k in range(5):
        rows += [rec(f"{k}a", f"{k}b", 1, difficulty="easy"), rec(f"{k}b", None, 2, difficulty="hard")]
    rows += [rec("xa", "xb", None, difficulty="hard"), rec("xb", None, 9, difficulty="easy")]
    got = {r.group_id: (r.record_id, r.chosen_by) for r in choices(spark, rows).collect()}
    assert got["xa"] == ("xa", "currency") and got["0a"] == ("0b", "timestamp")


def test_latest_breaks_cycles():
    k = lambda i, kind, ts: {"id": i, "kind": kind, "ts": ts, "richness": 1, "rank": 0}
    before = {("f", 1, 2): 5, ("f", 2, 3): 4, ("f", 3, 1): 1}
    assert latest([k("a", 1, None), k("b", 2, None), k("c", 3, None)], "f", before)[0]["id"] == "c"


N = "id string, seq_no long, title string, description string, other int"
H = "id string, title string, payload string, deduplicated_into string"


def text_of(rng, n):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"v{rng.randrange(9)}" if rng.random() < share else w for w in text.split())


def brute(history, new, least=0.6):
    from sievewright.llm.history import words_of

    rows = [(0, -1, i, set(words_of(t, d))) for i, t, d in history] + [(1, s, i, set(words_of(t, d))) for i, s, t, d in new]
    best = {}
    for kind, seq, i, w in rows:
        if not kind or not w:
            continue
        for k2, s2, i2, w2 in rows:
            if (k2, s2) < (kind, seq) and i2 != i and w2 and len(w & w2) >= least * len(w | w2) - 1e-9:
                best[i] = min(best.get(i, (9,)), (k2, s2, i2))
    return {i: b[2] for i, b in best.items()}


def records_case():
    rng = random.Random(3)
    base = [text_of(rng, rng.choice([5, 30, 80])) for _ in range(40)]
    history = [(f"h{k:03d}", f"Title {k}", t) for k, t in enumerate(base)] + [("empty", "", "")]
    new, seq = [], 0
    for k in range(60):
        t = edited(rng, rng.choice(base), rng.choice([0, 0.05, 0.1])) if rng.random() < 0.7 else text_of(rng, 60)
        base.append(t)
        new.append((f"n{k:03d}", seq, f"Title {k}", f"<p>{t.replace(' ', '&nbsp;', 1)}</p>"))
        seq += 1
    new += [("n000", seq, new[0][2], new[0][3]), ("nul", seq + 1, None, None), ("nul2", seq + 2, None, None)]
    return history, new


def frames(spark, history, new):
    h = spark.createDataFrame([(i, t, json.dumps({"title": t, "description": d}), None) for i, t, d in history] + [("cut", "Broken title here", '{"title": "x', None)], H)
    return h, spark.createDataFrame([(i, s, t, d, 0) for i, s, t, d in new], N)


def test_repeats_against_brute_force(spark):
    history, new = records_case()
    h, n = frames(spark, history, new)
    assert {r.new_id: r.first_id for r in repeats(h, n).collect()} == brute(history, new)


def test_history_batch_by_batch_gives_the_same(spark):
    history, new = records_case()
    h, n = frames(spark, history, new)
    index = History(spark)
    index.add(history_rows(h), search=False)
    got = {}
    for lo, hi in ((0, 10), (10, 12), (12, 45), (45, 99)):
        for r in index.add(batch_rows(n.where(f"seq_no >= {lo} and seq_no < {hi}"))).collect():
            got.setdefault(r.id, r.first_id)
    assert got == brute(history, new)
    assert len(index.segments) <= 4


def test_repeats_crowded_and_empty(spark):
    """Two hundred variants of one text: more than a crowded beginning pairs at once."""
    rng = random.Random(5)
    body = text_of(rng, 40)
    new = [(f"n{k:03d}", k, "", f"{body} extra{k}") for k in range(200)]
    h, n = frames(spark, [], new)
    assert {r.new_id: r.first_id for r in repeats(h, n).collect()} == {f"n{k:03d}": "n000" for k in range(1, 200)}
    assert repeats(h.limit(0), n.limit(0)).count() == 0


def test_repeats_scattered_edits_and_reordered_words(spark):
    """Texts of 40 words and more with every fourth or fifth word replaced, or in another order, share no runs."""
    rng = random.Random(11)
    base = [text_of(rng, rng.choice([45, 80, 120])) for _ in range(30)]
    new = []
    for k in range(60):
        words = rng.choice(base).split()
        if k % 3:
            words = [f"x{k}y{j}" if j % (3 + k % 3) == 1 else w for j, w in enumerate(words)]
        else:
            rng.shuffle(words)
        new.append((f"n{k:03d}", k, "", " ".join(words)))
    history = [(f"h{k:03d}", "", t) for k, t in enumerate(base)]
    expected = brute(history, new)
    assert len(expected) >= 20
    h, n = frames(spark, history, new)
    assert {r.new_id: r.first_id for r in repeats(h, n).collect()} == expected


def test_repeats_of_a_template_with_many_records(spark):
    """A hundred fillings of one template, a word of their own after every five: all beginnings are crowded."""
    words = [f"t{j}" for j in range(60)]
    new = [(f"n{k:03d}", k, "", " ".join(w if j % 5 else f"{w} own{k}x{j}" for j, w in enumerate(words))) for k in range(100)]
    h, n = frames(spark, [], new)
    assert {r.new_id: r.first_id for r in repeats(h, n).collect()} == brute([], new) == {f"n{k:03d}": "n000" for k in range(1, 100)}


def test_first_of_many_near_copies_in_the_history(spark):
    """Of 150 stored near copies the one with the smallest id is the first, whatever order they come in."""
    rng = random.Random(17)
    body = text_of(rng, 40)
    history = [(f"h{k:03d}", "", f"{body} extra{k}") for k in range(150)]
    rng.shuffle(history)
    new = [(f"n{k}", k, "", f"{body} other{k}") for k in range(5)]
    h, n = frames(spark, history, new)
    assert {r.new_id: r.first_id for r in repeats(h, n).collect()} == brute(history, new) == {f"n{k}": "h000" for k in range(5)}


def test_history_with_tiny_pages_spreads_hot_words_and_merges(spark):
    """Pages of 25 suffixes: every template word is hot, arrays are split, merged and searched in parts."""
    rng = random.Random(23)
    words = [f"t{j}" for j in range(30)]
    fill = lambda k: " ".join(w if rng.random() < 0.8 else f"own{k}" for w in words)
    history = [(f"h{k:03d}", "", fill(k)) for k in range(60)]
    new = [(f"n{k:03d}", k, "", fill(100 + k)) for k in range(50)]
    h, n = frames(spark, history, new)
    index = History(spark, page=25, at_once=20)
    index.add(history_rows(h), search=False)
    got = {}
    for lo, hi in ((0, 25), (25, 30), (30, 50)):
        for r in index.add(batch_rows(n.where(f"seq_no >= {lo} and seq_no < {hi}"))).collect():
            got.setdefault(r.id, r.first_id)
    assert got == brute(history, new) and any(s.hot for s in index.segments)


def test_a_batch_shuffles_only_its_own_suffixes(spark):
    """The stored pages are read where they lie: no exchange stands over their scan."""
    from sievewright.llm.history import SUFFIXES, _search_page

    rng = random.Random(2)
    h, _ = frames(spark, [(f"h{k}", "", text_of(rng, 30)) for k in range(50)], [])
    index = History(spark)
    index.add(history_rows(h), search=False)
    asks = spark.createDataFrame([], SUFFIXES + ", best long")
    got = asks.groupBy("shard").cogroup(spark.table(index.segments[0].name).groupBy("shard")).applyInArrow(_search_page(0.6, 0, 8), "q long, r long")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1

"""Problems 7, 8 and 9."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievewright.llm import garble
from sievewright.llm.leaks import ItemIndex, cgk, edited, leaks, longest_run, nearest_distance, sampled_keys
from sievewright.llm.packing import Places, pack, pack_documents, plan, token_counts

D = "doc_id long, text string, item_id string, n int"


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_places_every_item_once(counts):
    runs = plan(counts, 60)
    assert all(sum(s) <= 60 and n > 0 for s, n in runs)
    placed = {}
    for sizes, n in runs:
        for s in sizes:
            placed[s] = placed.get(s, 0) + n
    assert placed == counts
    assert all(sum(x > 20 for x in s) <= 2 for s, _ in runs)
    places, seen = Places(runs, 60), set()
    for s, c in counts.items():
        b, at = places.find(np.full(c, s), np.arange(c))
        for x, y in zip(b, at):
            assert not seen & {(x, k) for k in range(y, y + s)}
            seen |= {(x, k) for k in range(y, y + s)}
    assert all(0 <= k < 60 for _, k in seen)


def test_pack_ties_and_long_items(spark):
    rows = [(k, 700) for k in range(30)] + [(100, 5000), (101, 2048), (102, 0), (103, None), (104, 1)]
    got = pack(spark.createDataFrame(rows, "doc_id long, n_tokens long")).toPandas()
    assert got.groupby("bin_id").n_tokens.sum().max() <= 2048
    assert sorted(got[got.doc_id == 100].n_tokens) == [904, 2048, 2048] and got.n_tokens.sum() == 30 * 700 + 5000 + 2048 + 1
    assert set(got.doc_id) == {*range(30), 100, 101, 104}
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


def test_pack_documents_counts_tokens(spark):
    rows = [(1, "Hello world " * 2000, "x", 0), (2, "", "x", 0), (3, None, "x", 0), (4, "Größe 数组", "x", 0)]
    df = spark.createDataFrame(rows, D)
    n = {r.doc_id: r.n_tokens for r in token_counts(df).collect()}
    assert n[2] == n[3] == 0 and n[1] > 3000 and n[4] > 0
    got = pack_documents(df).toPandas()
    assert got.groupby("doc_id").n_tokens.sum().to_dict() == {1: n[1], 4: n[4]}
    assert got.groupby("bin_id").n_tokens.sum().max() <= 2048


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=9), st.lists(st.integers(0, 5), max_size=9))
def test_nearest_distance(a, b):
    assert nearest_distance(np.array(a), np.array(b)) == plain_distance(a, b)


def test_cgk_keeps_near_windows_near():
    rng = np.random.default_rng(0)
    x = rng.integers(1, 2**63, 200_000).astype(np.uint64)
    starts = np.arange(0, 190_000, 20)
    shifted = x.copy()
    for s in starts:  # one word put in at the second place
        shifted[s + 1 : s + 9] = np.concatenate([[np.uint64(7)], x[s + 1 : s + 8]])
    same = (cgk(x, starts, 8, 24) == cgk(shifted, starts, 8, 24)).mean()
    other = (cgk(x, starts, 8, 24) == cgk(x, starts + 10, 8, 24)).mean()
    assert same > other + 0.2
    assert (cgk(x, starts) == cgk(x.copy(), starts)).all() and longest_run(x[:5], x[:5]) == 5


def words(rng, n, v=5000):
    return [f"w{rng.randrange(v)}" for _ in range(n)]


def test_leaks_at_every_place(spark):
    rng = random.Random(1)
    items = [(f"i{k}", " ".join(words(rng, 30)), 0) for k in range(5)]
    rows, want = [], set()
    for k in range(120):
        src = items[k % 5][1].split()
        n = 11 + k % 3
        at = rng.randrange(30 - n + 1)
        text = words(rng, k % 17) + src[at : at + n] + words(rng, 20)
        rows.append((k, ("- " if k % 2 else ", ").join(text).upper(), "c", 1))
        if n >= 12:
            want.add((k, items[k % 5][0]))
    rows += [(500, None, "c", 1), (501, "", "c", 1), (502, "w1", "c", 1)]
    df = spark.createDataFrame(rows, D)
    got = leaks(df, spark.createDataFrame(items, "item_id string, item_text string, text int"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    assert leaks(df.limit(0), spark.createDataFrame(items, "item_id string, item_text string, text int")).count() == 0
    assert leaks(df, spark.createDataFrame([], "item_id string, item_text string")).count() == 0


def test_leaks_with_edits(spark):
    rng = random.Random(2)
    item = words(rng, 40)
    changed = [w for k, w in enumerate(item) if k % 10 != 5]  # every run has nine words
    df = spark.createDataFrame([(1, " ".join(words(rng, 7) + changed + words(rng, 9)), "", 0)], D)
    t = spark.createDataFrame([(7, " ".join(item))], "item_id long, item_text string")
    assert leaks(df, t, max_edits=0).count() == 0
    assert [(r.item_id, r.edits) for r in leaks(df, t).collect()] == [(7, 4)]


def plain_distance(text, item):
    """Edit distance of the item to the nearest part of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_recall_of_planted_edits(spark, monkeypatch):
    """A thousand items with as many random edits as are allowed, each in a text of its own; the walk finds more than plain windows."""
    rng, nrng = random.Random(12), np.random.default_rng(12)
    items = [(k, " ".join(words(rng, rng.randrange(24, 60)))) for k in range(1000)]
    rows, near = [], set()
    for k, text in items:
        src = text.split()
        ids = edited(np.arange(len(src), dtype=np.uint64), int(0.2 * len(src)), nrng).tolist()
        body = words(rng, rng.randrange(9)) + [src[i] if i < len(src) else f"new{i}" for i in ids] + words(rng, 12)
        rows.append((k, " ".join(body), "", 0))
        if plain_distance(body, src) <= int(0.2 * len(src)):
            near.add(k)
    df, t = spark.createDataFrame(rows, D), spark.createDataFrame(items, "item_id long, item_text string")
    got = {(r.doc_id, r.item_id, r.longest_run, r.edits) for r in leaks(df, t).collect()}
    found = {d for d, i, *_ in got if d == i}
    assert len(near) > 950 and len(near & found) >= 0.9 * len(near)
    for d, i, run, dist in random.Random(1).sample(sorted(got), 40):
        assert run >= 12 or dist == plain_distance(rows[d][1].split(), items[i][1].split()) <= int(0.2 * len(items[i][1].split()))


def test_the_embedding_finds_edited_windows():
    """Windows with one word put in agree in more sampled keys than their plain words would."""
    rng = np.random.default_rng(3)
    a = rng.integers(1 << 62, size=(400, 8)).astype(np.uint64)
    b = np.concatenate([a[:, :3], rng.integers(1 << 62, size=(400, 1)).astype(np.uint64), a[:, 3:7]], axis=1)
    flat = lambda x: (np.concatenate([x.ravel(), np.zeros(8, np.uint64)]), np.arange(400) * 8)
    walked = (sampled_keys(cgk(*flat(a)), 32) == sampled_keys(cgk(*flat(b)), 32)).any(0).mean()
    plain = (sampled_keys(np.repeat(a.T, 3, 0), 32) == sampled_keys(np.repeat(b.T, 3, 0), 32)).any(0).mean()
    assert walked > plain + 0.05


SENTENCES = [
    "Die größte Länge der Brücken hängt davon ab, ob wir müde Wörter kürzen können.",
    "Verbinde für jede schöne Straße die Schlüssel und zähle höfliche Bäume.",
    "La función devuelve el índice mínimo cuando el niño añade una montaña más.",
    "Où placer les fenêtres âgées pour compléter le théâtre avant l’été ?",
    "Если простой ключ потерян, верните −1, иначе числа будут перевёрнуты.",
    "Сколько различных кораблей смогут разделить груз, если каждый узел закрыт?",
    "给你一个长度为3的数组，其中每个机器人都可以连接一次连续的桥梁。",
]


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(4)
    rows = [(k, "\n".join(rng.choice(SENTENCES) for _ in range(4)), None, 0) for k in range(300)]
    return garble.train(spark.createDataFrame(rows, D))


def test_margin_is_of_all_clean_runs(spark):
    """Against plain Python over every distinct clean window; there are more than the 200 that a sample once held."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdef") + rng.choice("äöüßéèñçøå") + rng.choice("uvwxyz") for _ in range(12)) for _ in range(120)] + ["plain", "", None]
    m = garble.train(spark.createDataFrame([(k, t, None, 0) for k, t in enumerate(texts)], D))
    seen = {w for t in texts if t for w in garble.clean_windows(t)}
    gains = [garble.gains_of(m, w) for w in sorted(seen)]
    wrong, right = [g for g, _ in gains], [x for _, r in gains for x in r]
    assert len(seen) > 500 and m.margin == pytest.approx((np.quantile(wrong, 0.999) + np.quantile(right, 0.001)) / 2)
    assert garble.train(spark.createDataFrame([(1, "plain", None, 0)], D)).margin == garble.Model.margin


def test_gains_of_many_windows(model, monkeypatch):
    """As one by one, and no garbled run is searched for what else could be made of it, which took most of the time."""
    runs = ["é", "ß", "—", "é\xa0—", "½Ж", "给你一个长度为", "如果", "瑙ｉ噴璇存槑", "верните", "\u2e3b", "个\u2e3b", "𠀀", "Ÿ", "\xa0", "河流"]
    ws = [(left, run, right) for run in runs for left in ("", "a", "# ") for right in ("", " ", " X")]
    found, asked = model.garbling().gains_of(ws), []
    assert model.unseen("", "\u2e3b") and model.garbling().gains_of([]) == []
    for w, (wrong, right) in zip(ws, found, strict=True):
        plain = garble.gains_of(model, w)
        assert wrong == plain[0] and sorted(right) == pytest.approx(sorted(plain[1]))
        assert len(right) == sum(garble._read(w[1].encode(), x) not in (None, w[1]) for x, y in garble.CHAINS if y == "utf-8")
    monkeypatch.setattr(garble, "candidates", lambda run: asked.append(run) or {})
    model._seen.clear()
    model.garbling().gains_of(ws)
    model._seen.clear()
    assert set(asked) == set(runs)


@pytest.mark.parametrize("sentence", SENTENCES[:5])
@pytest.mark.parametrize("wrong", ["latin-1", "cp1252", "cp437", "mac_roman"])
def test_garbled_sentences_come_back(model, sentence, wrong):
    try:
        bad = sentence.encode("utf-8").decode(wrong)
    except UnicodeDecodeError:
        pytest.skip("bytes without a character")
    status, text, _ = garble.restore(model, "A clean line.\n" + bad)
    assert text == "A clean line.\n" + sentence and status == "restored"


def test_twice_garbled_and_legacy(model):
    bad = SENTENCES[1].encode().decode("cp1252").encode().decode("cp1252")
    assert garble.restore(model, bad)[1] == SENTENCES[1]
    bad = SENTENCES[5].encode("cp1251").decode("cp1252")
    assert garble.restore(model, bad)[1] == SENTENCES[5]


@pytest.mark.parametrize("sentence", [*SENTENCES, "plain", "", "┌──┬──┐", "Straße 5 °C", "Ёжик"])
def test_clean_sentences_stay(model, sentence):
    assert garble.restore(model, sentence) is None


def test_lost_text_is_found(model):
    assert garble.restore(model, "Na�ve caf�")[0] == "lost"


def test_repair_with_a_character_met_nowhere_clean(model):
    """One character that no clean record has doesn't cost the run its repair."""
    sentence = SENTENCES[4].replace(" ", "\u2e3b", 1)  # a dash of three ems within the first run
    assert not model.uni[garble._bucket("\u2e3b")]
    assert garble.restore(model, sentence.encode().decode("latin-1"))[1] == sentence


def test_garbled_frame(spark, model):
    bad = SENTENCES[0].encode().decode("cp1252")
    rows = [(1, bad, None, 0), (1, bad, None, 0), (2, SENTENCES[0], None, 0), (3, None, None, 0), (4, "", None, 0), (5, SENTENCES[2] * 3000 + bad, None, 0)]
    got = garble.garbled(spark.createDataFrame(rows, D), model).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 5]
    assert garble.garbled(spark.createDataFrame([], D)).count() == 0


def test_index_without_items():
    index = ItemIndex([], [])
    assert len(index.meet(np.zeros((2, 3), np.uint64))[0]) == 0


@pytest.mark.parametrize("chain", [("cp1252", "cp1251"), ("cp866", "cp1251"), ("cp1251", "koi8-r")])
def test_passage_garbled_by_another_chain_in_a_long_clean_line(model, chain):
    """The line as a whole is likely; a few words of it were read in the wrong encoding."""
    wrong, right = chain
    bad = SENTENCES[5].encode(right, "ignore").decode(wrong, "ignore")
    line = " ".join([SENTENCES[4]] * 20 + ["@"] + [SENTENCES[4]] * 20)
    good = SENTENCES[5].encode(right, "ignore").decode(right)
    assert garble.restore(model, line.replace("@", bad))[1] == line.replace("@", good)


def test_other_chain_beside_utf8(model):
    once = SENTENCES[1].encode().decode("cp1252")
    other = SENTENCES[5].encode("cp1251").decode("cp1252")
    assert garble.restore(model, once + " " + other)[1] == SENTENCES[1] + " " + SENTENCES[5]

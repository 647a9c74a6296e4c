"""Order-aware deduplication: exact titles, three near-duplicate tests, greedy resolution, merging.

Records carry ``ord``, a total order of any type; the earlier record of a match
survives. The greedy pass over sorted pairs is the lexicographically first maximal
independent set of the match graph, found here in rounds.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..tables import cut

TITLE, DESCRIPTION, COSINE, PRUNE, FIRST_TOKENS = 0.8, 0.6, 0.90, 0.25, 50
#: Rows of a table of terms or tokens that is broadcast; a larger one is shuffled apart from its join.
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame, key: str) -> DataFrame:
    """A table ready to be joined by ``key``: broadcast where its rows are counted and few.

    Otherwise it is partitioned otherwise than by ``key``, so that both sides of
    the join are shuffled and adaptive execution can split a hot key.
    """
    df = cut(df, "sized")
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.repartition(F.xxhash64(key))


def numbered(records: DataFrame) -> DataFrame:
    """What deduplication looks at, once computed: ``n`` numbers the records in the order of ``ord``."""
    rows = records.select("ord", "id", "title", "description", "signature", F.col("deduplicated_into").isNotNull().alias("marked"))
    return cut(rows.repartitionByRange("ord").sortWithinPartitions("ord").withColumn("n", F.monotonically_increasing_id()), "numbered")


def keyed(records: DataFrame) -> DataFrame:
    """What the tests look at: (ord, id, title, title_key, hashed title tokens, hashed first description tokens, signature)."""
    hashed = lambda c: F.array_distinct(F.transform(c, lambda x: F.xxhash64(x)))
    toks = text.tokens(F.col("title"))
    return records.select(
        "ord", "id", "title",
        text.title_key(F.col("title")).alias("title_key"),
        hashed(toks).alias("toks"),
        hashed(F.filter(toks, lambda t: ~t.isin(*text.BLOCKING_STOPWORDS))).alias("blocks"),
        hashed(F.slice(text.tokens(F.col("description")), 1, FIRST_TOKENS)).alias("desc"),
        F.coalesce(F.col("signature"), F.lit("")).alias("signature"),
        (F.col("marked") if "marked" in records.columns else F.col("deduplicated_into").isNotNull()).alias("marked"),
    )


def title_matches(keys: DataFrame) -> DataFrame:
    """``(canonical_ord, ord)`` of records whose title has an earlier one's tokens; titles without a token match none."""
    first = keys.where("title_key <> ''").groupBy("title_key").agg(F.min("ord").alias("canonical_ord"))
    # partitioned otherwise, so that both sides are shuffled and a hot title is split
    return keys.join(first.repartition(F.xxhash64("canonical_ord")), "title_key").where("ord > canonical_ord").select("canonical_ord", "ord")


def tfidf(records: DataFrame) -> DataFrame:
    """``(ord, term, df, w)``: weights of length 1 over title and description; idf is ln((n+1)/(df+1)) + 1.

    Document frequencies meet their terms by a broadcast or a join of two shuffles
    (:func:`sized`), so the term that every record has is no single task.
    """
    terms = records.select("ord", F.explode(text.tokens(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))))).alias("term"))
    tf = terms.groupBy("ord", "term").agg(F.count("*").alias("tf"))
    df = sized(tf.groupBy("term").agg(F.count("*").alias("df")), "term")
    n = records.count()
    raw = tf.join(df, "term").withColumn("raw", F.col("tf") * (F.log((F.lit(n) + 1) / (F.col("df") + 1)) + 1))
    norms = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("ord")))
    return raw.select("ord", "term", "df", (F.col("raw") / norms).alias("w"))


def candidate_pairs(keys: DataFrame) -> DataFrame:
    """``(a, b, jaccard)`` of all pairs that share a title token that is no stop word, and 0.25 of both titles' tokens.

    For reports on small tables; :func:`edges` reaches the pairs that matter
    without going through these.
    """
    tok = keys.select("ord", F.explode("blocks").alias("tok"))
    pairs = (
        tok.select(F.col("ord").alias("a"), "tok").join(tok.select(F.col("ord").alias("b"), "tok"), "tok").where("a < b").select("a", "b").distinct()
    )
    return _beside(pairs, keys, "toks").withColumn("jaccard", text.jaccard(F.col("a_toks"), F.col("b_toks"))).where(F.col("jaccard") >= PRUNE).select("a", "b", "jaccard")


def _beside(pairs: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns of both records, ``a_`` and ``b_`` before their names."""
    for side in "ab":
        pairs = pairs.join(keys.select(F.col("ord").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs


def _rarest(keys: DataFrame, least: float, more: tuple[str, ...] = ()) -> DataFrame:
    """The title tokens of which two titles with that Jaccard share one, by prefix filtering: the rarest of each."""
    tok = keys.select("ord", *more, F.size("toks").alias("n"), F.explode("toks").alias("tok"))
    df = sized(tok.groupBy("tok").agg(F.count("*").alias("df")), "tok")
    place = F.row_number().over(Window.partitionBy("ord").orderBy("df", "tok"))
    return tok.join(df, "tok").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).select("ord", "tok", *more)


def _heaviest(weights: DataFrame, least: float) -> DataFrame:
    """The terms of which two vectors with that cosine share one: from the rarest, until the rest is shorter than ``least``."""
    rest = F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("ord").orderBy("df", "term").rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return weights.withColumn("rest", rest).where(F.col("rest") >= least * least - 1e-9).select("ord", F.xxhash64("term").alias("term"))


def _self_pairs(rows: DataFrame, *key: str) -> DataFrame:
    a, b = rows.select(F.col("ord").alias("a"), *key), rows.select(F.col("ord").alias("b"), *key)
    return a.join(b, list(key)).where("a < b").select("a", "b")


def edges(records: DataFrame, keys: DataFrame) -> DataFrame:
    """``(a, b, stage, score)``: pairs that pass one of the three near-duplicate tests, a before b.

    Each test finds its candidates by what its threshold forces them to share: one
    of the rarest title tokens (title 0.8), of the heaviest TF-IDF terms (cosine
    0.90), the code's signature together with one of the title tokens that 0.25 of
    both titles forces (so a solution that many records share pairs only those of
    like titles). Any pair must share a title token that is no stop word and a
    quarter of the titles' tokens, and be no sequels. Title tokens alone are laid
    beside the candidates first; all else only beside what is left.
    """
    weights = cut(tfidf(records), "tfidf")
    keys = keys.where("not marked and size(blocks) > 0")
    by_title = _self_pairs(_rarest(keys, TITLE), "tok")
    by_terms = _self_pairs(_heaviest(weights, COSINE).join(keys.select("ord"), "ord", "left_semi"), "term")
    by_code = _self_pairs(_rarest(keys.where("signature <> ''"), PRUNE, ("signature",)), "signature", "tok")
    pairs = _beside(by_title.unionByName(by_terms).unionByName(by_code).distinct(), keys, "toks", "blocks")
    pairs = pairs.withColumn("jaccard", text.jaccard(F.col("a_toks"), F.col("b_toks")))
    pairs = pairs.where((F.col("jaccard") >= PRUNE) & F.arrays_overlap("a_blocks", "b_blocks")).select("a", "b", "jaccard")
    pairs = _beside(pairs, keys, "title", "desc", "signature").where(~text.is_sequel_pair(F.col("a_title"), F.col("b_title")))
    pairs = cut(
        pairs.select("a", "b", "jaccard", text.jaccard(F.col("a_desc"), F.col("b_desc")).alias("dj"), ((F.col("a_signature") == F.col("b_signature")) & (F.col("a_signature") != "")).alias("code")),
        "pairs",
    )
    first = (F.col("jaccard") >= TITLE) & (F.col("dj") >= DESCRIPTION)
    w = weights.select("ord", F.xxhash64("term").alias("term"), "w")
    cosine = (
        pairs.where(~first).select("a", "b")
        .join(w.select(F.col("ord").alias("a"), "term", F.col("w").alias("x")), "a")
        .join(w.select(F.col("ord").alias("b"), "term", F.col("w").alias("y")), ["b", "term"])
        .groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("cosine"))
    )
    near = F.coalesce("cosine", F.lit(0.0)) >= COSINE
    tested = pairs.where(~first).join(cosine, ["a", "b"], "left")
    return (
        pairs.where(first).withColumn("cosine", F.lit(0.0))
        .unionByName(tested.where(near | F.col("code")))
        .select(
            "a", "b",
            F.when(first, "token_jaccard").when(near, "embedding").otherwise("code_ast").alias("stage"),
            F.when(first, (F.col("jaccard") + F.col("dj")) / 2).when(near, F.least("cosine", F.lit(1.0))).otherwise(1.0).alias("score"),
        )
    )


def resolve(pairs: DataFrame) -> DataFrame:
    """``(canonical_ord, ord, stage, score)``: of each duplicate, its earliest neighbour that is none itself.

    Per round, records without an earlier undecided neighbour survive and their
    later neighbours are duplicates. Duplicates leave the graph, so rounds are as
    many as the longest chain of decisions, which for neighbours in random order
    grows as the squared logarithm of the records (Blelloch, Fineman and Shun,
    2012); each ends in a table.
    """
    left = pairs.select("a", "b")
    survivors = None
    while True:
        waiting = left.select(F.col("b").alias("v")).distinct()
        free = cut(left.select(F.col("a").alias("v")).distinct().join(waiting, "v", "left_anti"), "survivors")
        survivors = free if survivors is None else survivors.unionByName(free)
        gone = left.join(free, left.a == free.v, "left_semi").select(F.col("b").alias("v")).distinct()
        left = cut(
            left.join(gone, left.a == gone.v, "left_anti").join(gone, F.col("b") == gone.v, "left_anti").join(free, F.col("a") == free.v, "left_anti"),
            "undecided",
        )
        if left.isEmpty():
            break
    # who has no neighbour left undecided and was never a duplicate survives too
    touched = pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    dup = pairs.join(survivors, pairs.a == survivors.v, "left_semi").select(F.col("b").alias("v")).distinct()
    alive = touched.join(dup, "v", "left_anti")
    chosen = pairs.join(alive, pairs.a == alive.v, "left_semi").join(dup, pairs.b == dup.v, "left_semi")
    return chosen.groupBy("b").agg(F.min(F.struct("a", "stage", "score")).alias("m")).select(
        F.col("m.a").alias("canonical_ord"), F.col("b").alias("ord"), F.col("m.stage").alias("stage"), F.col("m.score").alias("score")
    )


def find_duplicates(records: DataFrame) -> DataFrame:
    """``(canonical_ord, ord, stage, score)`` of every duplicate.

    Needs ord, id, title, description, signature (may be null) and
    deduplicated_into. Null titles and descriptions count as empty. Empty in,
    empty out. Inside, records are longs in their order, whatever ``ord`` is.
    """
    rows = numbered(records)
    work = rows.drop("ord").withColumnRenamed("n", "ord")
    keys = cut(keyed(work), "keys")
    exact = cut(title_matches(keys), "titles")
    rest = keys.join(exact, "ord", "left_anti")
    near = resolve(cut(edges(work, rest), "edges"))
    found = exact.select("canonical_ord", "ord", F.lit("title_key").alias("stage"), F.lit(1.0).alias("score")).unionByName(near)
    name = rows.select(F.col("n").alias("canonical_ord"), F.col("ord").alias("canonical")), rows.select(F.col("n").alias("ord"), F.col("ord").alias("own"))
    found = found.join(name[0], "canonical_ord").join(name[1], "ord")
    return found.select(F.col("canonical").alias("canonical_ord"), F.col("own").alias("ord"), "stage", "score")


def _absorb(records: DataFrame, matches: DataFrame) -> DataFrame:
    """Survivors with what their matches bring; every list is merged from distinct values, first seen first."""
    m = matches.select("canonical_ord", F.col("ord").alias("m_ord"), "stage")
    dup = m.join(records, records.ord == m.m_ord).drop("ord")

    def ordered(values: DataFrame, name: str) -> DataFrame:
        first = values.where("x is not null").groupBy("canonical_ord", "x").agg(F.min(F.struct("m_ord", "p")).alias("at"))
        return first.groupBy("canonical_ord").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias(name))

    sources = ordered(dup.select("canonical_ord", "m_ord", F.posexplode("source_list").alias("p", "x")), "add_sources")
    tags = ordered(dup.select("canonical_ord", "m_ord", F.posexplode("tags").alias("p", "x")).where("x <> 'unknown'"), "add_tags")
    names = ordered(dup.select("canonical_ord", "m_ord", F.lit(0).alias("p"), F.col("title").alias("x")), "add_aliases")
    first = lambda cols, cond: F.min_by(F.when(cond, F.struct(*cols)), F.when(cond, F.col("m_ord")))
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    rest = dup.groupBy("canonical_ord").agg(
        F.count("*").alias("absorbed"),
        F.array_join(F.sort_array(F.collect_set("stage")), ",").alias("stages"),
        F.bool_or("is_premium").alias("any_premium"),
        first(["canonical_solution"], F.col("has_solution")).alias("f_solution"),
        first(["description"], F.coalesce("description", F.lit("")) != "").alias("f_description"),
        first(["examples", "input_schema", "output_schema", "schema_inference_confidence"], some("examples")).alias("f_examples"),
        first(["constraints"], some("constraints")).alias("f_constraints"),
        first(["difficulty"], F.col("difficulty") != "unknown").alias("f_difficulty"),
    )
    out = records
    for extra in (rest, sources, tags, names):
        out = out.join(extra.withColumnRenamed("canonical_ord", "ord"), "ord", "left")
    union = lambda a, b: F.array_union(a, F.coalesce(b, F.array().cast("array<string>")))
    take = lambda empty, f, c: F.when(empty & F.col(f).isNotNull(), F.col(f"{f}.{c}")).otherwise(F.col(c))
    no_examples = ~some("examples")
    solved = F.col("has_solution") | F.col("f_solution").isNotNull()
    premium = F.col("is_premium") | F.coalesce("any_premium", F.lit(False))
    new = {
        "source_list": union("source_list", F.col("add_sources")),
        "tags": union("tags", F.col("add_tags")),
        "aliases": union("aliases", F.filter(F.col("add_aliases"), lambda a: a != F.col("title"))),
        "canonical_solution": take(~F.col("has_solution"), "f_solution", "canonical_solution"),
        "has_solution": solved,
        "is_premium": premium,
        "data_unavailable": premium & ~solved,
        "description": take(F.coalesce("description", F.lit("")) == "", "f_description", "description"),
        **{c: take(no_examples, "f_examples", c) for c in ("examples", "input_schema", "output_schema", "schema_inference_confidence")},
        "constraints": take(~some("constraints"), "f_constraints", "constraints"),
        "difficulty": take(F.col("difficulty") == "unknown", "f_difficulty", "difficulty"),
        "version": (F.col("version") + F.coalesce("absorbed", F.lit(0))).cast("int"),
        "history": F.when(
            F.col("absorbed") > 0,
            F.concat("history", F.array(F.struct(F.lit("consolidated_duplicate").alias("step"), F.concat(F.lit("absorbed "), F.col("absorbed").cast("string"), F.lit(" via "), F.col("stages")).alias("detail")))),
        ).otherwise(F.col("history")),
    }
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in records.columns])


def consolidate(records: DataFrame, matches: DataFrame) -> DataFrame:
    """All records after merging: survivors enriched, duplicates marked with the survivor's id.

    Exact-title matches merge first, then near-duplicates, as the matches' order
    asks; what a survivor lacks it takes from its earliest duplicate that has it.
    """
    matches = cut(matches, "matches")
    exact, near = matches.where("stage = 'title_key'"), matches.where("stage <> 'title_key'")
    merged = cut(_absorb(records, exact), "merged")
    merged = _absorb(merged, near)
    into = matches.join(records.select(F.col("ord").alias("canonical_ord"), F.col("id").alias("into")), "canonical_ord").select("ord", "into", "stage", "score")
    detail = F.concat(F.lit("stage="), "stage", F.lit(" score="), F.format_string("%.3f", "score"), F.lit(" into="), "into")
    return (
        merged.join(into, "ord", "left")
        .withColumn("deduplicated_into", F.coalesce("into", "deduplicated_into"))
        .withColumn("history", F.when(F.col("into").isNotNull(), F.concat("history", F.array(F.struct(F.lit("deduplicated").alias("step"), detail.alias("detail"))))).otherwise(F.col("history")))
        .drop("into", "stage", "score")
    )


def greedy(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """What :func:`resolve` computes, by the plain pass over sorted pairs; for tests."""
    canonical: dict[int, int] = {}
    for a, b in sorted(pairs):
        if a not in canonical and b not in canonical:
            canonical[b] = a
    return canonical


def idf(n: int, df: int) -> float:
    return math.log((n + 1) / (df + 1)) + 1

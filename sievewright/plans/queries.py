"""Queries over the test tables, and DuckDB SQL with the same results where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import policy, text, vectors
from ..operators import dedup, patterns as P, sandbox as S, templates as T, views
from ..operators.clients import ScriptedClient
from ..operators.normalize import normalize, schemas_of, validate
from ..schemas import PATTERN
from ..sources.readers import Source, read, read_all, read_pages, read_problems
from ..tables import Snapshots, cut, shared_dir, stored, upsert_records
from .ingest import dedup_records, metrics_of
from .mining import mine

_Q: dict = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _strings(c) -> F.Column:
    return F.array_join(F.sort_array(c), "|")


def _case(mapping: dict[str, str], x: str, other: str) -> str:
    return f"case {x} " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + f" else {other} end"


# Pieces of SQL: white space stripped as Python does, tokens, canonical records once an id.
_STRIP = r"regexp_replace(regexp_replace({0}, '^[\s\x{{A0}}\x{{2000}}-\x{{200A}}\x{{3000}}]+', ''), '[\s\x{{A0}}\x{{2000}}-\x{{200A}}\x{{3000}}]+$', '')"
_TOKENS = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+')"
_ONCE = "(select * from canonical_records qualify row_number() over (partition by id order by created_at) = 1)"
_KEYED = f"""
  k as (select id, title, description, row_number() over (order by created_at, id) as ord, {_TOKENS.format('title')} as t,
               array_to_string({_TOKENS.format('title')}, ' ') as title_key from {_ONCE})"""


def once(spark: SparkSession, d: str) -> DataFrame:
    """canonical_records, each id once."""
    return table(spark, d, "canonical_records").dropDuplicates(["id"])


def _code(c: str):
    return F.when(F.try_parse_json(c).isNotNull(), F.get_json_object(c, "$.code"))


def canonical(spark: SparkSession, d: str) -> DataFrame:
    """canonical_records in the shape of the engine's own records; ``ord`` follows created_at, then id."""
    none = F.array().cast("array<string>")
    r = once(spark, d).withColumn("code", _code("canonical_solution"))
    has = F.coalesce(F.length("code") > 0, F.lit(False))
    examples = "array<struct<input:string,output:string,explanation:string>>"
    shaped = r.select(
        "id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("description", F.lit("")).alias("description"), text.difficulty(F.col("difficulty")).alias("difficulty"),
        text.tags(F.col("tags")).alias("tags"), F.array().cast(examples).alias("examples"), none.alias("constraints"), F.lit("{}").alias("input_schema"),
        F.lit("{}").alias("output_schema"), F.lit(0.0).alias("schema_inference_confidence"),
        F.when(has, F.struct(none.alias("languages"), F.array(F.sha2("code", 256)).alias("code_hashes"), text.code_signature(F.col("code")).alias("ast_signature"), F.col("code").alias("code"))).alias("canonical_solution"),
        has.alias("has_solution"), F.lit(False).alias("is_premium"), F.lit(False).alias("data_unavailable"), policy.license_meta(F.lit("mit")).alias("license_meta"),
        F.col("source_list"), none.alias("aliases"), F.lit(None).cast("string").alias("deduplicated_into"), F.lit(1).alias("version"),
        F.array().cast("array<struct<step:string,detail:string>>").alias("history"),
        F.struct("created_at", "id").alias("ord"),
    )
    return cut(shaped, "canonical")

_UNESCAPED = "replace(replace(replace(replace(replace(replace({0}, '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&')"


def _cleaned(x: str) -> str:
    x = rf"regexp_replace(regexp_replace(regexp_replace({_UNESCAPED.format(x)}, '<[^>]+>', ' ', 'g'), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10)||chr(10), 'g')"
    return _STRIP.format(x)


# ---- text


@query(f"select id, {_cleaned("coalesce(description, '')")} as cleaned from {_ONCE}")
def clean_text(spark, d):
    return once(spark, d).select("id", text.clean_text(F.col("description")).alias("cleaned"))


@query(f"select id, {_case(text.DIFFICULTIES, 'lower(' + _STRIP.format('difficulty') + ')', chr(39) + 'unknown' + chr(39))} as level from {_ONCE}")
def difficulty(spark, d):
    return once(spark, d).select("id", text.difficulty(F.col("difficulty")).alias("level"))


@query(
    f"""select id, case when len(x) = 0 then 'unknown' else array_to_string(list_filter(x, lambda t, i: list_position(x, t) = i), '|') end as canonical_tags from (
      select id, list_filter(list_transform(coalesce(tags, []), lambda t: {_case(text.TAGS, "regexp_replace(lower(trim(t)), '[^a-z0-9]', '', 'g')", "replace(replace(lower(trim(t)), ' ', '-'), '_', '-')")}), lambda t: t <> '') as x from {_ONCE})"""
)
def tags(spark, d):
    return once(spark, d).select("id", F.array_join(text.tags(F.col("tags")), "|").alias("canonical_tags"))


@query(f"select doc_id, len(x) as n_tokens, len(list_distinct(x)) as n_distinct, x[1] as first_token from (select doc_id, {_TOKENS.format('text')} as x from documents)")
def tokenize(spark, d):
    t = table(spark, d, "documents").select("doc_id", text.tokens(F.col("text")).alias("x"))
    return t.select("doc_id", F.size("x").alias("n_tokens"), F.size(F.array_distinct("x")).alias("n_distinct"), F.get("x", F.lit(0)).alias("first_token"))


@query(f"select id, array_to_string({_TOKENS.format('title')}, ' ') as title_key from {_ONCE}")
def title_key(spark, d):
    return once(spark, d).select("id", text.title_key(F.col("title")).alias("title_key"))


@query(rf"select id, sha256(lower({_STRIP.format("coalesce(title, '')")}) || chr(10) || lower({_STRIP.format("coalesce(description, '')")})) as content_hash from {_ONCE}")
def content_hash(spark, d):
    return once(spark, d).select("id", text.content_hash(F.col("title"), F.col("description")).alias("content_hash"))


_CODE_SQL = "case when json_valid(canonical_solution) then json_extract_string(canonical_solution, '$.code') end"


@query(
    rf"""select id, case when code is null or code = '' then '' else sha256({_STRIP.format(r"regexp_replace(regexp_replace(code, '(?m)#.*$', '', 'g'), '[\s\x{A0}\x{2000}-\x{200A}\x{3000}]+', ' ', 'g')")}) end as signature
    from (select id, {_CODE_SQL} as code from {_ONCE})"""
)
def code_signature(spark, d):
    return once(spark, d).select("id", text.code_signature(_code("canonical_solution")).alias("signature"))


@query(
    r"""with t as (select distinct title from canonical_records), b as (select title, lower(trim(regexp_replace(title, '\s+(?:(?:I{1,3}|IV|V|VI)|Part\s+\d+|Part\s+(?:One|Two|Three|Four|Five))\s*$', '', 'i'))) as base from t)
    select base, count(*) as n_titles from b where base <> '' group by base having count(distinct lower(trim(title))) > 1"""
)
def sequel_groups(spark, d):
    t = table(spark, d, "canonical_records").select("title").distinct().withColumn("base", F.lower(F.trim(F.regexp_replace("title", text.SEQUEL, ""))))
    return t.where("base <> ''").groupBy("base").agg(F.count("*").alias("n_titles"), F.countDistinct(F.lower(F.trim("title"))).alias("k")).where("k > 1").drop("k")


_EXAMPLE_SQL = "list_transform(list_slice(coalesce(examples, []), 1, 2), lambda e: 'Input: ' || coalesce(e.input, '') || chr(10) || 'Output: ' || coalesce(e.output, ''))"


@query(
    f"""select id, seq_no, md5(concat_ws(chr(10), {_STRIP.format("coalesce(title, '')")}, nullif({_STRIP.format("substring(description, 1, 2000)")}, ''), nullif(array_to_string({_EXAMPLE_SQL}, chr(10)), ''))) as text_md5 from new_records"""
)
def compose_text(spark, d):
    return table(spark, d, "new_records").select("id", "seq_no", F.md5(text.compose_text(F.col("title"), F.col("description"), F.col("examples"))).alias("text_md5"))


@query("select id, coalesce(fingerprints.content_hash, '') as content_hash from new_records")
def problem_hash(spark, d):
    t = table(spark, d, "new_records")
    return t.select("id", P.problem_hash(t).alias("content_hash"))


# ---- policy and validation


@query(
    f"""select source_name, k not in {policy.PERMISSIVE} and k not in {policy.INTERNAL} as requires_legal_review, k in {policy.PERMISSIVE} as public_allowed, k not in {policy.PERMISSIVE} as internal_use_only
    from (select source_name, lower(trim(coalesce(nullif(license, ''), 'unknown'))) as k from sources)"""
)
def license_policy(spark, d):
    m = policy.license_meta(F.col("license"))
    return table(spark, d, "sources").select("source_name", m["requires_legal_review"].alias("requires_legal_review"), m["public_allowed"].alias("public_allowed"), m["internal_use_only"].alias("internal_use_only"))


_REVIEWED = f"""
  r as (select id, {_STRIP.format("coalesce(title, '')")} as t, coalesce(description, '') as dd, {_case(text.DIFFICULTIES, 'lower(' + _STRIP.format('difficulty') + ')', chr(39) + 'unknown' + chr(39))} as level, coalesce(tags, []) as tags from {_ONCE}),
  v as (select id, list_filter([case when t = '' then 'missing title' end,
      case when {_STRIP.format('dd')} = '' then 'missing description' when length(dd) < 20 then 'description shorter than 20 chars' when length(dd) > 20000 then 'description longer than 20000 chars' end,
      case when level = 'unknown' then 'difficulty unknown/unnormalized' end, case when len(list_filter(tags, lambda x: x <> '' and x <> 'unknown')) = 0 then 'no tags inferred' end,
      'no examples to infer schema from'], lambda x: x is not null) as reasons from r)"""


def _validated(spark, d):
    return validate(canonical(spark, d))


@query(f"with {_REVIEWED} select id, array_to_string(reasons, '; ') as reasons, true as needs_review from v")
def validation_flags(spark, d):
    return _validated(spark, d).select("id", F.array_join("validation.reasons", "; ").alias("reasons"), F.col("validation.needs_review").alias("needs_review"))


@query(f"with {_REVIEWED} select unnest(reasons) as reason, count(*) as n from v group by 1")
def review_histogram(spark, d):
    return _validated(spark, d).select(F.explode("validation.reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


# ---- vectors


@query("select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double * x))), 5) as length, len(embedding) as n from embeddings")
def vector_norms(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(vectors.norm(F.col("embedding")), 5).alias("length"), F.size("embedding").alias("n"))


_CENTROIDS = """
  flat as (select label, generate_subscripts(embedding, 1) as pos, unnest(embedding)::double as x from embeddings),
  means as (select label, pos, avg(x) as m, count(*) as n from flat group by label, pos),
  cents as (select label, max(n) as size, list(m order by pos) as centroid from means group by label)"""


def _members(spark, d):
    return table(spark, d, "embeddings").withColumnRenamed("vec_id", "id")


@query(f"with {_CENTROIDS} select label, size, round(list_sum(centroid), 6) as total, round(centroid[1], 6) as first_value from cents")
def centroids(spark, d):
    c = P.centroids(_members(spark, d))
    return c.select("label", "size", F.round(F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x), 6).alias("total"), F.round(F.element_at("centroid", 1), 6).alias("first_value"))


_COS = "list_dot_product({0}::double[], {1}::double[]) / (sqrt(list_dot_product({0}::double[], {0}::double[])) * sqrt(list_dot_product({1}::double[], {1}::double[])))"


@query(
    f"""with {_CENTROIDS}, s as (select label, vec_id, round({_COS.format('embedding', 'centroid')}, 9) as cos from embeddings join cents using (label))
    select label, arg_min(vec_id, struct_pack(far := -cos, id := vec_id)) as representative, round(max(cos), 6) as similarity from s group by label"""
)
def representative(spark, d):
    m = _members(spark, d)
    return P.representatives(m, P.centroids(m)).withColumn("similarity", F.round("similarity", 6))


@query(
    f"""with {_CENTROIDS}, s as (select vec_id, c.label, {_COS.format('embedding', 'centroid')} as cos from embeddings cross join cents c)
    select vec_id as id, arg_max(label, cos) as label, round(max(cos), 5) as similarity from s group by vec_id"""
)
def nearest_centroid(spark, d):
    m = _members(spark, d)
    return P.nearest_centroid(m, P.centroids(m)).withColumn("similarity", F.round("similarity", 5))


_USABLE = "len({0}) = 128 and len(list_filter({0}, lambda x: x is null)) = 0 and len(list_filter({0}, lambda x: x <> 0)) > 0"


def _fingerprints(spark, d):
    f = table(spark, d, "fingerprints").where(vectors.usable(F.col("nl_embedding"), 128)).dropDuplicates(["record_id"])
    return f.select(F.col("record_id").alias("id"), F.col("nl_embedding").alias("embedding"), "content_hash")


def _patterns(spark, d):
    return table(spark, d, "patterns").where(vectors.usable(F.col("centroid"), 128))


@query(
    f"""with f as (select distinct record_id, nl_embedding from fingerprints where {_USABLE.format('nl_embedding')}), p as (select pattern_id, centroid from patterns where {_USABLE.format('centroid')}),
    s as (select record_id, pattern_id, {_COS.format('nl_embedding', 'centroid')} as cos from f cross join p)
    select record_id as problem_id, case when max(cos) >= 0.8 then arg_max(pattern_id, cos) end as pattern_id, round(max(cos), 5) as confidence from s group by record_id"""
)
def assign_snapshot(spark, d):
    return P.assign_snapshot(_fingerprints(spark, d), _patterns(spark, d)).withColumn("confidence", F.round("confidence", 5))


# One record after the other, in the order of their ids: the patterns' means are carried along as a list.
@query(
    f"""with recursive f as (select row_number() over (order by record_id) as i, record_id, x from (select distinct record_id, nl_embedding::double[] as x from fingerprints where {_USABLE.format('nl_embedding')})),
    p as (select list(struct_pack(id := pattern_id, n := case when coalesce(size, 0) = 0 then 1 else size end::bigint, c := centroid::double[]) order by pattern_id) as pats, max(regexp_extract(pattern_id, '^pattern_(\\d+)$', 1)::bigint) + 1 as next from patterns where {_USABLE.format('centroid')}),
    g(i, pats, next, record_id, k, sim) as (select 0::bigint, pats, next, ''::varchar, 0::bigint, 0.0::double from p union all
      select i, case when sim >= 0.8 then list_transform(pats, lambda q, j: case when j = k then struct_pack(id := q.id, n := q.n + 1, c := list_transform(q.c, lambda v, e: (v * q.n + x[e]) / (q.n + 1))) else q end)
          else list_append(pats, struct_pack(id := 'pattern_' || next, n := 1::bigint, c := x)) end, case when sim >= 0.8 then next else next + 1 end, record_id, case when sim >= 0.8 then k else len(pats) + 1 end, case when sim >= 0.8 then sim else 1 end
      from (select *, list_max(sims) as sim, list_position(sims, list_max(sims)) as k from (select f.i, f.record_id, f.x, g.pats, g.next, list_transform(g.pats, lambda q: {_COS.format('q.c', 'f.x')}) as sims from g join f on f.i = g.i + 1)))
    select record_id as problem_id, pats[k].id as pattern_id, round(sim, 5) as confidence from g where i > 0"""
)
def assign_sequential(spark, d):
    rows = _fingerprints(spark, d).withColumn("ord", F.col("id"))
    return P.assign_sequential(rows, _patterns(spark, d)).select("problem_id", "pattern_id", F.round("confidence", 5).alias("confidence"))


@query(
    f"""with f as (select distinct record_id, nl_embedding as x from fingerprints where {_USABLE.format('nl_embedding')}), p as (select pattern_id, size, centroid from patterns where {_USABLE.format('centroid')}),
    s as (select record_id, any_value(x) as x, arg_max(pattern_id, cos) as pattern_id, max(cos) as cos from (select record_id, x, pattern_id, {_COS.format('x', 'centroid')} as cos from f cross join p) group by record_id),
    m as (select pattern_id, count(*) as m, avg(x[1]::double) as mean from s where cos >= 0.8 group by pattern_id)
    select pattern_id, coalesce(p.size, 0) + coalesce(m, 0) as size, round(case when m is null then centroid[1]::double else (centroid[1]::double * coalesce(p.size, 0) + mean * m) / (coalesce(p.size, 0) + m) end, 5) as first_value from p left join m using (pattern_id)"""
)
def updated_centroids(spark, d):
    f = _fingerprints(spark, d)
    got = P.assign_snapshot(f, _patterns(spark, d)).where("pattern_id is not null")
    return P.updated_centroids(got, f, _patterns(spark, d)).select("pattern_id", "size", F.round(F.element_at("centroid", 1), 5).alias("first_value"))


@query(
    """select f.record_id as problem_id from (select distinct record_id, content_hash from fingerprints) f
    where record_id not in (select problem_id from pattern_assignments where problem_id is not null)
      and (content_hash is null or content_hash not in (select f2.content_hash from fingerprints f2 join pattern_assignments a on a.problem_id = f2.record_id where f2.content_hash is not null))"""
)
def unassigned(spark, d):
    f = table(spark, d, "fingerprints").select(F.col("record_id").alias("id"), "content_hash", F.lit("t").alias("title"))
    a = table(spark, d, "pattern_assignments").where("problem_id is not null")
    hashes = f.join(a, F.col("id") == F.col("problem_id"), "left_semi").select("content_hash")
    return P.unassigned(f, a, hashes).select(F.col("id").alias("problem_id"))


@query(
    f"""with {_CENTROIDS}, s as (select e.vec_id, arg_max(c.label, {_COS.format('e.embedding', 'c.centroid')}) as near, max({_COS.format('e.embedding', 'c.centroid')}) as cos from embeddings e cross join cents c where e.label = 0 and c.label > 0 group by e.vec_id)
    select vec_id as id, case when label <> 0 then label when cos >= 0.75 then near else -1 end as label from embeddings left join s using (vec_id)"""
)
def noise_reassigned(spark, d):
    m = _members(spark, d)
    return P.reassign_noise(m.select("id", "embedding"), m.select("id", F.when(F.col("label") == 0, -1).otherwise(F.col("label")).alias("label")))


@query()
def density_clusters(spark, d):
    return P.cluster(table(spark, d, "embeddings"), id_col="vec_id")


@query(
    """select count(*) as n_records, count(distinct case when label > 0 then label end) as n_clusters, count(*) filter (label > 0) as clustered_records, count(*) filter (label = 0) as outliers,
    round(count(*) filter (label = 0) / count(*), 4) as outlier_rate from embeddings"""
)
def outlier_metrics(spark, d):
    return P.mining_metrics(_members(spark, d).select("id", (F.col("label") - 1).alias("label")))


# ---- summaries


def _by_source(spark, d):
    return canonical(spark, d).withColumn("label", F.element_at("source_list", 1)).withColumn("keep", F.lit(1))


_TOP_TAGS = f"""tx as (select source_list[1] as label, created_at, id, generate_subscripts(tags, 1) as p, lower(trim(unnest(tags))) as t from {_ONCE}), tc as (select label, t, count(*) as n, min((created_at, id, p)) as first from tx where t <> '' group by all),
    tk as (select label, t, row_number() over (partition by label order by n desc, first) as r from tc), tt as (select label, list(t order by r) as top_tags from tk where r <= 6 group by label)"""


def _labelled(spark, d):
    return once(spark, d).select(F.element_at("source_list", 1).alias("label"), "title", "tags", F.struct("created_at", "id").alias("ord"))


@query(f"with {_TOP_TAGS} select label, array_to_string(top_tags, '|') as tags from tt")
def top_tags(spark, d):
    return P.top_tags(_labelled(spark, d)).select("label", F.array_join("top_tags", "|").alias("tags"))


@query(f"select source_list[1] as label, case when lower(trim(coalesce(difficulty, ''))) = '' then 'unknown' else lower(trim(difficulty)) end as difficulty, count(*) as n from {_ONCE} group by all")
def difficulty_histogram(spark, d):
    return P.difficulty_histogram(once(spark, d).withColumn("label", F.element_at("source_list", 1)))


# Words of a title are runs of Latin letters between characters that no word has.
@query(
    rf"""with {_TOP_TAGS}, w as (select source_list[1] as label, created_at, id, list_filter(list_transform(list_filter(regexp_extract_all(coalesce(title, ''), '[\pL\pN_]+'), lambda x: regexp_full_match(x, '[a-zA-Z]{{3,}}')), lambda x: lower(x)), lambda x: x not in {tuple(text.LABEL_STOPWORDS)}) as w from {_ONCE}),
    g as (select label, created_at, id, 1 as k, generate_subscripts(w, 1) as p, unnest(w) as g from w union all
      select label, created_at, id, 2, unnest(range(1, len(w))), unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from w),
    c as (select label, k, g, count(*) as n, min((created_at, id, p)) as first from g group by all), r as (select *, row_number() over (partition by label, k order by n desc, first) as r from c),
    u as (select label, coalesce(list(g order by r) filter (k = 2), []) as bi, coalesce(list(g order by r) filter (k = 1), []) as uni from r where (k = 2 and r <= 2 and n >= 2) or (k = 1 and r <= 4) group by label),
    kw as (select label, list_reduce(list_prepend(bi, list_transform(uni, lambda x: [x])), lambda acc, x: case when len(acc) < 2 and not contains(array_to_string(acc, ' '), x[1]) then list_concat(acc, x) else acc end) as kw from u),
    z as (select label, list_concat(list_slice(coalesce(top_tags, []), 1, 2), list_filter(coalesce(kw, []), lambda x: x not in list_slice(coalesce(top_tags, []), 1, 2))) as parts from tt full join kw using (label))
    select label, case when len(parts) = 0 then 'algorithmic-pattern' else array_to_string(list_slice(parts, 1, 3), ' / ') end as name from z""".replace("x not in list_slice(coalesce(top_tags, []), 1, 2)", "not list_contains(list_slice(coalesce(top_tags, []), 1, 2), x)")
)
def cluster_labels(spark, d):
    rows = _labelled(spark, d)
    t, k = P.top_tags(rows), P.title_ngrams(rows)
    return t.join(k, "label", "full_outer").select("label", P.label(F.col("top_tags"), F.col("keywords")).alias("name"))


@query()
def mined_patterns(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("id"), F.col("vec_id").alias("ord"), "embedding")
    p, _, _ = mine(e.withColumns({"title": F.concat(F.lit("vector "), "id"), "tags": F.array(F.lit("vector")), "difficulty": F.lit(None).cast("string")}))
    return p.select("pattern_id", "label", "size", "representative")


# ---- deduplication


@query(f"with {_KEYED}, m as (select title_key, min(ord) as first, count(*) as n from k where title_key <> '' group by title_key) select title_key, n - 1 as duplicates from m where n > 1")
def title_key_dedup(spark, d):
    k = dedup.keyed(canonical(spark, d).withColumn("signature", F.lit("")))
    m = dedup.title_matches(k).join(k.select("ord", "title_key"), "ord")
    return m.groupBy("title_key").agg(F.count("*").alias("duplicates"))


_TFIDF = f"""
  {_KEYED}, x as (select id, unnest(regexp_extract_all(lower(concat_ws(' ', coalesce(title, ''), coalesce(description, ''))), '[a-z0-9]+')) as term from k),
  tf as (select id, term, count(*) as tf from x group by all), df as (select term, count(*) as df from tf group by term), n as (select count(*) as n from k),
  raw as (select id, term, tf * (ln((n + 1) / (df + 1)) + 1) as raw from tf join df using (term) cross join n),
  w as (select id, term, raw / sqrt(sum(raw * raw) over (partition by id)) as w from raw)"""


@query(f"with {_TFIDF} select id, term, round(w, 6) as w from w")
def tfidf_weights(spark, d):
    r = canonical(spark, d)
    return dedup.tfidf(r).join(r.select("ord", "id"), "ord").select("id", "term", F.round("w", 6).alias("w"))


_EDGES = f"""{_TFIDF}, s as (select id, {_CODE_SQL} as code from {_ONCE}),
    sig as (select id, case when code is null or code = '' then '' else sha256({_STRIP.format(r"regexp_replace(regexp_replace(code, '(?m)#.*$', '', 'g'), '[\s\x{A0}\x{2000}-\x{200A}\x{3000}]+', ' ', 'g')")}) end as signature from s),
    first as (select title_key, min(ord) as o from k group by title_key),
    v as (select k.id, k.ord, k.title, list_distinct(k.t) as t, list_distinct(list_slice({_TOKENS.format('k.description')}, 1, 50)) as dt, signature,
            lower(trim(regexp_replace(k.title, '\\s+(?:(?:I{{1,3}}|IV|V|VI)|Part\\s+\\d+|Part\\s+(?:One|Two|Three|Four|Five))\\s*$', '', 'i'))) as base
          from k join sig using (id) left join first using (title_key) where k.title_key = '' or k.ord = first.o),
    tok as (select ord, unnest(t) as tok from v), ok as (select * from tok where tok not in {tuple(text.BLOCKING_STOPWORDS)}),
    p as (select distinct a.ord as ao, b.ord as bo from ok a join ok b using (tok) where a.ord < b.ord),
    j as (select ao, bo, a.id as aid, b.id as bid, a.signature <> '' and a.signature = b.signature as code,
            len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) as tj,
            case when len(a.dt) = 0 or len(b.dt) = 0 then 0 else len(list_intersect(a.dt, b.dt)) / (len(a.dt) + len(b.dt) - len(list_intersect(a.dt, b.dt))) end as dj
          from p join v a on a.ord = ao join v b on b.ord = bo where not (a.base <> '' and a.base = b.base and lower(trim(a.title)) <> lower(trim(b.title)))),
    c as (select ao, bo, aid, bid, any_value(code) as code, any_value(tj) as tj, any_value(dj) as dj, coalesce(sum(x.w * y.w), 0) as cos
          from j left join w x on x.id = aid left join w y on y.id = bid and y.term = x.term where tj >= 0.25 group by ao, bo, aid, bid),
    s2 as (select ao, bo, aid, bid, case when tj >= 0.8 and dj >= 0.6 then 'token_jaccard' when cos >= 0.9 then 'embedding' when code then 'code_ast' end as stage,
            case when tj >= 0.8 and dj >= 0.6 then (tj + dj) / 2 when cos >= 0.9 then least(cos, 1) else 1 end as score from c),
    e as (select row_number() over (order by ao, bo) as i, * from s2 where stage is not null)"""


@query(f"with {_EDGES} select least(aid, bid) as a, greatest(aid, bid) as b, stage, round(score, 6) as score from e")
def near_dup_edges(spark, d):
    r = dedup.numbered(canonical(spark, d).withColumn("signature", F.col("canonical_solution.ast_signature"))).drop("ord").withColumnRenamed("n", "ord")
    k = cut(dedup.keyed(r), "keys")
    e = dedup.edges(r, k.join(dedup.title_matches(k), "ord", "left_anti"))
    ids = k.select("ord", "id")
    named = e.join(ids.select(F.col("ord").alias("a"), F.col("id").alias("x")), "a").join(ids.select(F.col("ord").alias("b"), F.col("id").alias("y")), "b")
    return named.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "stage", F.round("score", 6).alias("score"))


# The greedy pass over the sorted pairs, one after the other; exact titles come first.
_MATCHES = f"""recursive {_EDGES},
    g(i, gone, hit) as (select 0::bigint, []::bigint[], false union all
      select e.i, case when list_contains(gone, ao) or list_contains(gone, bo) then gone else list_append(gone, bo) end, not (list_contains(gone, ao) or list_contains(gone, bo)) from g join e on e.i = g.i + 1),
    m as (select f.id as canonical, k.id as duplicate, f.ord as co, k.ord as o, 'title_key' as stage, 1.0::double as score from k join first on k.title_key = first.title_key join k f on f.ord = first.o where k.title_key <> '' and k.ord > first.o
      union all select aid, bid, ao, bo, stage, score from g join e using (i) where hit)"""


@query(f"with {_MATCHES} select canonical, duplicate, stage, round(score, 6) as score from m")
def near_dup_resolution(spark, d):
    r = canonical(spark, d).withColumn("signature", F.col("canonical_solution.ast_signature"))
    ids = r.select("ord", "id")
    m = dedup.find_duplicates(r)
    named = m.join(ids.withColumnRenamed("id", "duplicate"), "ord").join(ids.select(F.col("ord").alias("canonical_ord"), F.col("id").alias("canonical")), "canonical_ord")
    return named.select("canonical", "duplicate", "stage", F.round("score", 6).alias("score"))


# Survivors take the sources and known tags of their duplicates: near ones have by then those of their own exact ones.
_MERGED = f"""{_MATCHES},
    o as (select k.id, k.ord, k.title, r.source_list as src, case when len(x) = 0 then ['unknown'] else list_distinct(x) end as tg, coalesce(length(code), 0) > 0 as solved
      from k join {_ONCE} r using (id) join s using (id) join (select id, list_filter(list_transform(coalesce(tags, []), lambda t: {_case(text.TAGS, "regexp_replace(lower(trim(t)), '[^a-z0-9]', '', 'g')", "replace(replace(lower(trim(t)), ' ', '-'), '_', '-')")}), lambda t: t <> '') as x from {_ONCE}) using (id)),
    x1 as (select co, count(*) as n, flatten(list(src)) as src, flatten(list(list_filter(tg, lambda t: t <> 'unknown'))) as tg, bool_or(solved) as solved, list(title) as names from m join o on o.ord = m.o where stage = 'title_key' group by co),
    m1 as (select id, ord, title, 1 + coalesce(n, 0) as version, list_distinct(list_concat(o.src, coalesce(x1.src, []))) as src, list_distinct(list_concat(o.tg, coalesce(x1.tg, []))) as tg, o.solved or coalesce(x1.solved, false) as solved,
      list_distinct(list_filter(coalesce(names, []), lambda a: a <> title)) as names from o left join x1 on x1.co = o.ord),
    x2 as (select co, count(*) as n, flatten(list(src)) as src, flatten(list(list_filter(tg, lambda t: t <> 'unknown'))) as tg, bool_or(solved) as solved, list(title) as names from m join m1 on m1.ord = m.o where stage <> 'title_key' group by co),
    m2 as (select id, ord, title, version + coalesce(n, 0) as version, list_distinct(list_concat(m1.src, coalesce(x2.src, []))) as src, list_distinct(list_concat(m1.tg, coalesce(x2.tg, []))) as tg, m1.solved or coalesce(x2.solved, false) as solved,
      list_distinct(list_concat(m1.names, list_filter(coalesce(x2.names, []), lambda a: a <> title))) as names from m1 left join x2 on x2.co = m1.ord),
    done as (select m2.*, m.canonical from m2 left join m on m.o = m2.ord)"""


@query(f"with {_MERGED} select id, coalesce(title, '') as title, canonical as deduplicated_into, version::int as version, solved as has_solution, array_to_string(list_sort(src), '|') as sources, array_to_string(list_sort(tg), '|') as tags, len(names)::int as n_aliases from done")
def consolidated_records(spark, d):
    done = dedup_records(canonical(spark, d))
    return done.select("id", "title", "deduplicated_into", "version", "has_solution", _strings(F.col("source_list")).alias("sources"), _strings(F.col("tags")).alias("tags"), F.size("aliases").alias("n_aliases"))


@query(
    f"""with {_MERGED} select count(*) as parsed, count(canonical) as duplicates, count(*) - count(canonical) as stored, count(*) filter (canonical is null and solved) as with_solution, count(*) filter (canonical is null) as needs_review,
    round(count(canonical) / count(*), 4) as duplicate_rate, 1.0::double as needs_review_rate from done"""
)
def ingest_metrics(spark, d):
    return metrics_of(validate(dedup_records(canonical(spark, d))))


# ---- stores and joins


@query("select distinct id, title, version from records where deduplicated_into is null")
def stored_records(spark, d):
    return stored(table(spark, d, "records")).select("id", "title", "version").distinct()


@query("select version + 1 as version, count(*) as n from (select distinct id, source_name, raw_file, raw_offset, version from records) group by version")
def upsert_rerun(spark, d):
    """All records upserted onto themselves: no id changes, every version goes up by one."""
    r = table(spark, d, "records").dropDuplicates(["id"])
    again = r.withColumn("id", F.concat(F.lit("again-"), "id")).withColumn("version", F.lit(1))
    out = upsert_records(r, again)
    return out.where("id not like 'again-%'").groupBy("version").agg(F.count("*").alias("n"))


@query("select r.id as record_id, count(a.pattern_id) as n_patterns from (select distinct id from records) r left join pattern_assignments a on a.problem_id = r.id group by r.id")
def record_patterns(spark, d):
    r, a = table(spark, d, "records").select("id").distinct(), table(spark, d, "pattern_assignments")
    return r.join(a, r.id == a.problem_id, "left").groupBy(F.col("id").alias("record_id")).agg(F.count("pattern_id").alias("n_patterns"))


@query(
    """select distinct r.id, coalesce(a.pattern_id, 'Outlier') as pattern_id, coalesce(p.label, 'Outlier') as pattern_label from (select distinct id from records) r
    left join (select problem_id, max(pattern_id) as pattern_id from pattern_assignments group by problem_id) a on a.problem_id = r.id left join patterns p using (pattern_id)"""
)
def questions(spark, d):
    a = table(spark, d, "pattern_assignments").groupBy("problem_id").agg(F.max("pattern_id").alias("pattern_id"))
    return views.questions(table(spark, d, "records").select("id").distinct(), a, table(spark, d, "patterns"))


_REPS = "(select id, any_value(title) as title from records group by id)"


@query(
    f"""select pattern_id, size, representative from (select p.*, r.title from patterns p left join {_REPS} r on r.id = p.representative)
    where lower(label) like '%graph%' or lower(top_tags) like '%graph%' or lower(title) like '%graph%' or pattern_id like '%graph%'"""
)
def pattern_search(spark, d):
    p = table(spark, d, "patterns").withColumn("top_tags", F.from_json("top_tags", "array<string>"))
    return views.search_patterns(p, table(spark, d, "records").dropDuplicates(["id"]), "GRAPH", limit=0).select("pattern_id", "size", "representative")


@query("select pattern_id, size from patterns order by size desc nulls last, pattern_id limit 10")
def largest_patterns(spark, d):
    return table(spark, d, "patterns").orderBy(F.desc_nulls_last("size"), "pattern_id").limit(10).select("pattern_id", "size")


@query("select a.pattern_id, a.problem_id, r.title from pattern_assignments a left join (select distinct id, title from records) r on r.id = a.problem_id where a.pattern_id = 'pattern_1'")
def pattern_detail(spark, d):
    r = table(spark, d, "records").dropDuplicates(["id"]).withColumns({"difficulty": F.lit(None).cast("string"), "description": F.lit("")})
    out = views.pattern_detail("pattern_1", table(spark, d, "patterns").dropDuplicates(["pattern_id"]), table(spark, d, "pattern_assignments"), r.select("id", "title", "difficulty", "description"))
    return out.select("pattern_id", "problem_id", F.when(F.col("title") != F.coalesce("problem_id", F.lit("")), F.col("title")).alias("title"))


@query("select s.source_name, count(r.id) as n, coalesce(min(s.trust_rank), 0) as rank from sources s left join (select distinct id, source_name from records) r using (source_name) group by s.source_name")
def source_counts(spark, d):
    r = table(spark, d, "records").select("id", "source_name").distinct()
    return table(spark, d, "sources").join(r, "source_name", "left").groupBy("source_name").agg(F.count("id").alias("n"), F.coalesce(F.min("trust_rank"), F.lit(0)).alias("rank"))


@query(
    """with h as (select pattern_id, unnest(from_json(difficulty_json, '{"easy":"BIGINT","medium":"BIGINT","hard":"BIGINT","unknown":"BIGINT"}'), recursive := true) from patterns),
    l as (select pattern_id, unnest(['easy', 'medium', 'hard', 'unknown']) as difficulty, unnest([easy, medium, hard, unknown]) as n from h)
    select pattern_id, difficulty, n, round(n / greatest(sum(n) over (partition by pattern_id), 1), 6) as share from l where n is not null"""
)
def difficulty_share(spark, d):
    p = table(spark, d, "patterns").withColumn("difficulty", F.from_json("difficulty_json", "map<string,bigint>"))
    return views.difficulty_share(p).withColumn("share", F.round("share", 6))


@query("select id, pattern_id, pattern_label from (select distinct r.id, coalesce(a.pattern_id, 'Outlier') as pattern_id, coalesce(p.label, 'Outlier') as pattern_label, title from (select id, any_value(title) as title from records group by id) r left join (select problem_id, max(pattern_id) as pattern_id from pattern_assignments group by problem_id) a on a.problem_id = r.id left join patterns p using (pattern_id)) where pattern_id <> 'Outlier' and (lower(title) like '%graph%' or lower(pattern_label) like '%graph%')")
def filtered_questions(spark, d):
    a = table(spark, d, "pattern_assignments").groupBy("problem_id").agg(F.max("pattern_id").alias("pattern_id"))
    rows = views.questions(table(spark, d, "records").groupBy("id").agg(F.any_value("title").alias("title")), a, table(spark, d, "patterns"))
    return views.filter_questions(rows, clustered=True, text="Graph").select("id", "pattern_id", "pattern_label")


@query("select pattern_id, size from (select pattern_id, size, regexp_extract(pattern_id, '(\\d+)$', 1)::bigint as n from patterns) order by n, pattern_id limit 5 offset 5")
def second_page(spark, d):
    """The second page of five patterns, by the number in their ids."""
    p = table(spark, d, "patterns")
    return views.page(p, [views.numeric_id(F.col("pattern_id")), "pattern_id"], 1, 5).select("pattern_id", "size")


@query("select distinct content_hash from fingerprints f join pattern_assignments a on a.problem_id = f.record_id where content_hash is not null")
def assigned_hashes(spark, d):
    return P.assigned_hashes(table(spark, d, "fingerprints").withColumnRenamed("record_id", "id"), table(spark, d, "pattern_assignments"))


@query("select distinct r.id, coalesce(p.label, 'unclassified') as pattern from (select distinct id from records) r left join (select problem_id, max(pattern_id) as pattern_id from pattern_assignments group by problem_id) a on a.problem_id = r.id left join patterns p using (pattern_id)")
def labelled_records(spark, d):
    """Records with the label of their pattern, as they go into re-authoring."""
    r = table(spark, d, "records").select("id").distinct().withColumn("tags", F.array().cast("array<string>"))
    return T.with_labels(r, table(spark, d, "pattern_assignments"), table(spark, d, "patterns")).select("id", "pattern")


# ---- templates, sandbox


@query(f"select id, sha256(id || ':' || p || ':v1') as seed, p as pattern from (select id, coalesce(nullif(array_to_string(list_slice(list_filter(tags, lambda t: t <> '' and t <> 'unknown'), 1, 3), '-'), ''), 'unclassified') as p from {_ONCE})")
def transform_seed(spark, d):
    r = once(spark, d).withColumn("p", T.pattern_label(F.lit(None).cast("string"), F.col("tags")))
    return r.select("id", T.transform_seed(F.col("id"), F.col("p")).alias("seed"), F.col("p").alias("pattern"))


@query(f"select id, k as variant, sha256(id || ':' || sha256(id) || ':' || k) as seed from {_ONCE}, range(0, 8) t(k)")
def variant_seeds(spark, d):
    r = once(spark, d).select("id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("variant"))
    return r.select("id", "variant", T.variant_seed(F.col("id"), F.sha2("id", 256), F.col("variant")).alias("seed"))


@query(r"select id, md5(case when regexp_extract(x, '(?s)\{.*\}') <> '' then regexp_extract(x, '(?s)\{.*\}') else x end) as block_md5 from (select distinct id, trim(payload) as x from records)")
def extract_json_block(spark, d):
    """Of each payload inside a code fence."""
    r = table(spark, d, "records").select("id", "payload").distinct()
    return r.select("id", F.md5(T.json_block(F.concat(F.lit("```json\n"), "payload", F.lit("\n```")))).alias("block_md5"))


# What examples of the test tables can look like: named values, a placeholder, nothing.
_SHAPE_SQL = """
    case when n = 0 then '{{}}' when a = n then '{{"type": "object", "properties": {{"pairs": {{"type": "array<array<integer>>"}}, "nums": {{"type": "array<integer>"}}, "k": {{"type": "integer"}}}}, "required": ["pairs", "nums", "k"]}}'
      when a = 0 then '{{"type": "string"}}' else '{{"type": "any"}}' end as input_schema,
    case when n = 0 then '{{}}' when a = n then '{{"type": "integer"}}' when a = 0 then '{{"type": "string"}}' else '{{"type": "any"}}' end as output_schema,
    case when n = 0 then 0.0 else round(0.5 * (0.85 * a + 0.5 * (n - a)) / n + 0.5 * case when a = n then 0.85 when a = 0 then 0.8 else 0.3 end, 3) end::double as confidence"""


def _nested(examples):
    """Examples with a nested list before their own values, as inference must take it whole."""
    named = lambda e: F.when(e["input"].contains("="), F.concat(F.lit("pairs = [[1, 2], [3]], "), e["input"])).otherwise(e["input"])
    return F.transform(examples, lambda e: F.struct(named(e).alias("input"), e["output"].alias("output"), F.concat(F.lit("a &lt; b "), e["explanation"]).alias("explanation")))


@query(
    f"""with x as (select id, seq_no, list_filter(coalesce(examples, []), lambda e: e.input <> '') as ex from new_records),
    y as (select id, seq_no, len(ex) as n, len(list_filter(ex, lambda e: contains(e.input, '='))) as a from x) select id, seq_no, {_SHAPE_SQL.format()} from y"""
)
def schema_inference(spark, d):
    given = F.transform(F.filter("examples", lambda e: e["input"] != ""), lambda e: F.struct(e["input"].alias("input"), e["output"].alias("output"), F.lit("").alias("explanation")))
    s = schemas_of(_nested(given))
    return table(spark, d, "new_records").select("id", "seq_no", s.alias("s")).select("id", "seq_no", F.col("s.input_schema").alias("input_schema"), F.col("s.output_schema").alias("output_schema"), F.col("s.confidence").alias("confidence"))


_LICENSES = ("MIT", " Educational ", "CC-BY-SA-4.0")
@query(
    rf"""with r as (select distinct id, payload as p from records where json_valid(payload)),
    x as (select id, ascii(id) % {len(_LICENSES)} as k, json_extract_string(p, '$.title') as t, coalesce(json_extract_string(p, '$.description') || ' 1 &lt; 2 &amp;amp; <b>x</b>', '') as dd, json_extract_string(p, '$.difficulty') as level,
        list_filter(json_extract_string(p, '$.tags[*]'), lambda t: t is not null and t <> '') as tg, list_transform(list_filter(json_extract_string(p, '$.constraints[*]'), lambda c: c is not null), lambda c: '0 &lt; ' || c) as cs,
        coalesce(length(json_extract_string(p, '$.canonical_solution.code')), 0) > 0 as has_solution,
        list_filter(coalesce(from_json(json_extract(p, '$.examples'), '[{{"input":"VARCHAR","output":"VARCHAR","explanation":"VARCHAR"}}]'), []), lambda e: e.input <> '' and e.output <> '') as ex from r where json_extract_string(p, '$.title') <> ''),
    y as (select *, {_cleaned('t')} as title, {_cleaned('dd')} as description, {_case(text.DIFFICULTIES, 'lower(' + _STRIP.format('level') + ')', chr(39) + 'unknown' + chr(39))} as difficulty,
        list_filter(list_transform(tg, lambda t: {_case(text.TAGS, "regexp_replace(lower(trim(t)), '[^a-z0-9]', '', 'g')", "replace(replace(lower(trim(t)), ' ', '-'), '_', '-')")}), lambda t: t <> '') as ct,
        len(ex) as n, len(list_filter(ex, lambda e: contains(e.input, '='))) as a from x),
    z as (select *, {_SHAPE_SQL.format()} from y)
    select 's' || k as source_name, title, md5(description) as description_md5, difficulty, case when len(ct) = 0 then 'unknown' else array_to_string(list_sort(list_distinct(ct)), '|') end as tags, has_solution,
      array_to_string(list_filter(list_transform(cs, lambda c: {_cleaned('c')}), lambda c: c <> ''), '|') as constraints,
      array_to_string(list_transform(ex, lambda e: coalesce({_cleaned("('a &lt; b ' || e.explanation)")}, '')), '|') as explanations, input_schema, output_schema, confidence,
      sha256(lower(title) || chr(10) || lower(description)) as content_hash, k = 2 as requires_legal_review, k = 0 as public_allowed,
      array_to_string(list_filter([case when k = 2 then 'license ''CC-BY-SA-4.0'' requires legal review' end, case when title = '' then 'missing title' end,
        case when description = '' then 'missing description' when length(description) < 20 then 'description shorter than 20 chars' when length(description) > 20000 then 'description longer than 20000 chars' end,
        case when difficulty = 'unknown' then 'difficulty unknown/unnormalized' end, case when len(list_filter(ct, lambda t: t <> 'unknown')) = 0 then 'no tags inferred' end,
        case when n = 0 then 'no examples to infer schema from' when confidence < 0.5 then 'schema_inference_confidence ' || confidence || ' below threshold 0.5' end], lambda q: q is not null), '; ') as reasons from z"""
)
def normalized_records(spark, d):
    """The stored payloads as JSON lines of three sources with licenses of their own, scanned, normalized and validated.

    Texts, constraints and explanations bear entities, inputs bear nested lists.
    """
    get = lambda p: F.get_json_object("payload", p)
    strings = lambda p: F.from_json(get(p), "array<string>")
    r = table(spark, d, "records").where(F.try_parse_json("payload").isNotNull()).select("id", "payload").distinct()
    problem = F.struct(
        get("$.title").alias("title"), F.concat(get("$.description"), F.lit(" 1 &lt; 2 &amp;amp; <b>x</b>")).alias("description"), get("$.difficulty").alias("difficulty"), strings("$.tags").alias("tags"),
        F.transform(strings("$.constraints"), lambda c: F.concat(F.lit("0 &lt; "), c)).alias("constraints"), get("$.canonical_solution.code").alias("solution"),
        _nested(F.from_json(get("$.examples"), "array<struct<input:string,output:string,explanation:string>>")).alias("examples"),
    )
    path = f"{shared_dir(spark)}/scan-{uuid.uuid4().hex}"
    r.select((F.ascii("id") % len(_LICENSES)).alias("k"), F.to_json(problem).alias("value")).write.partitionBy("k").text(path)
    sources = [Source("jsonl", f"{path}/k={k}", f"s{k}", license) for k, license in enumerate(_LICENSES)]
    n = validate(normalize(read_all(spark, sources)))
    return n.select(
        "source_name", "title", F.md5("description").alias("description_md5"), "difficulty", _strings(F.col("tags")).alias("tags"), "has_solution", F.array_join("constraints", "|").alias("constraints"),
        F.array_join(F.transform("examples", lambda e: F.coalesce(e["explanation"], F.lit(""))), "|").alias("explanations"), "input_schema", "output_schema", F.col("schema_inference_confidence").alias("confidence"),
        F.col("fingerprints.content_hash").alias("content_hash"), F.col("license_meta.requires_legal_review").alias("requires_legal_review"), F.col("license_meta.public_allowed").alias("public_allowed"),
        F.array_join("validation.reasons", "; ").alias("reasons"),
    )


@query()
def entry_points(spark, d):
    return once(spark, d).select("id", S.entry_points(_code("canonical_solution")).alias("e")).select("id", "e.kind", "e.name", F.size("e.params").alias("n_params"))


def _solved(spark, d):
    """records with code and examples out of the payload."""
    r = table(spark, d, "records").dropDuplicates(["id"]).where(F.try_parse_json("payload").isNotNull())
    get = lambda p: F.get_json_object("payload", p)
    return r.select(
        "id", "payload", get("$.canonical_solution.code").alias("code"), F.from_json(get("$.canonical_solution.languages"), "array<string>").alias("languages"),
        F.from_json(get("$.examples"), "array<struct<input:string,output:string,explanation:string>>").alias("examples"), F.from_json(get("$.tags"), "array<string>").alias("tags"),
    )


def _tasks(spark) -> int:
    """Tasks of a step that is all Python: as many as a shuffle has, which follow the input."""
    return max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))


@query()
def sandbox_runs(spark, d):
    return S.sandbox(_solved(spark, d).repartition(_tasks(spark), "id"), timeout=5.0).select("id", "outcome", "entry_point", "n_cases", "n_passed")


def _echo() -> ScriptedClient:
    """A client that gives the problem back as a template."""
    import json

    def answer(prompt: str) -> str:
        spec = json.JSONDecoder().raw_decode(prompt[prompt.index("SPEC:\n") + 6 :])[0]["canonical_problem"]
        return json.dumps({"title": spec["title"], "description": str(spec["description"]), "sample_public_tests": spec["examples"][:1], "tie_breaker": "the first"})

    return ScriptedClient(answer)


@query()
def template_run(spark, d):
    r = _solved(spark, d).select("id", F.col("payload").alias("record"), T.pattern_label(F.lit(None).cast("string"), F.col("tags")).alias("pattern"), F.lit(False).alias("data_unavailable"))
    out = T.run_templates(r.repartition(_tasks(spark), "id"), _echo, count=1)
    return out.select(F.col("canonical_problem_id").alias("id"), "status", "attempts", F.size("variants").alias("n_variants"))


# ---- scans: the new records written as files and read again


def _written(df: DataFrame, kind: str) -> str:
    path = f"{shared_dir(df.sparkSession)}/scan-{kind}-{uuid.uuid4().hex}"
    writer = df.write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    getattr(writer, "json" if kind == "jsonl" else kind)(path)
    return path


_NAMED = "from new_records where title is not null and title <> ''"


@query(f"select title, coalesce(nullif(description, ''), '') as description, coalesce(len(tags), 0) as n_tags, coalesce(len(examples), 0) as n_examples {_NAMED}")
def jsonl_scan(spark, d):
    path = _written(table(spark, d, "new_records").select("title", "description", "difficulty", "tags", "examples"), "jsonl")
    return read(spark, Source("jsonl", path, "new")).select("title", "description", F.size("tags").alias("n_tags"), F.size("examples_raw").alias("n_examples"))


@query(f"select title, md5(replace(coalesce(description, ''), chr(13), '')) as description_md5, list_sort(list_filter(tags, lambda t: t <> ''))[1] as first_tag {_NAMED}")
def csv_scan(spark, d):
    path = _written(table(spark, d, "new_records").select("title", "description", F.array_join("tags", ",").alias("topics")), "csv")
    return read(spark, Source("csv", path, "new")).select("title", F.md5(F.regexp_replace("description", "\r", "")).alias("description_md5"), F.get(F.sort_array("tags"), F.lit(0)).alias("first_tag"))


@query(f"select batch_no::bigint as document, title, coalesce(nullif(description, ''), '') as description, coalesce(len(tags), 0) as n_tags, coalesce(len(examples), 0) as n_examples {_NAMED}")
def json_scan(spark, d):
    """Each batch as one JSON document with its problems under ``questions``."""
    rows = table(spark, d, "new_records").select("batch_no", F.struct("title", "description", "tags", "examples").alias("q"))
    path = f"{shared_dir(spark)}/scan-{uuid.uuid4().hex}"
    rows.groupBy("batch_no").agg(F.to_json(F.struct(F.collect_list("q").alias("questions"))).alias("value")).write.partitionBy("batch_no").text(path)
    document = F.regexp_extract("raw_file", r"batch_no=(\d+)", 1).cast("long").alias("document")
    return read(spark, Source("json", path, "new")).select(document, "title", "description", F.size("tags").alias("n_tags"), F.size("examples_raw").alias("n_examples"))


def _escaped(c: str):
    return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query(
    f"""select 'page-' || doc_id as raw_file, doc_id as raw_offset, 'parse_html_v1' as parser, {_STRIP.format('title')} as title, md5({_STRIP.format("coalesce(text, '')")}) as description_md5, case when lang is not null and trim(lang) <> '' then trim(lang) end as tag
    from documents where {_STRIP.format("coalesce(title, '')")} <> ''"""
)
def html_pages(spark, d):
    """Each document as a page with heading, script, description and a tag, read from a table of pages."""
    t = table(spark, d, "documents")
    html = F.concat(
        F.lit("<html><head><title>page</title></head><body><h1>"), _escaped("title"), F.lit("</h1><script>no</script><div class='main description'><p>"), _escaped("text"),
        F.lit("</p></div><i class='tag-x'>"), _escaped("lang"), F.lit("</i></body></html>"),
    )
    pages = t.select(F.concat(F.lit("page-"), F.col("doc_id").cast("string")).alias("raw_file"), html.alias("text"), F.col("doc_id").alias("offset"))
    got = read_pages(pages, Source("html", "", "documents"))
    return got.select("raw_file", "raw_offset", "parser", "title", F.md5("description").alias("description_md5"), F.get("tags", F.lit(0)).alias("tag"))


@query(
    f"""select 'page-' || doc_id as raw_file, doc_id as raw_offset, 'parse_markdown_v1' as parser, {_STRIP.format('title')} as title, true as is_premium, 'Hard' as difficulty, 'graph|' || doc_kind as tags, '1 <= n|m^2 > 2' as constraints,
    'n = [' || doc_id || ', 2]' as example_input, 'why ' || doc_id as explanation, 'print(' || doc_id || ')' as code, 'python' as language from documents where {_STRIP.format("coalesce(title, '')")} <> ''"""
)
def markdown_pages(spark, d):
    """Each document as a marked Markdown page, read from a table of pages."""
    t, i = table(spark, d, "documents"), F.col("doc_id").cast("string")
    parts = [
        "---\ncomments: true\ndifficulty: Hard\ntags:\n  - graph\n  - ", F.coalesce("doc_kind", F.lit("none")), "\n---\n\n<!-- problem:start -->\n\n# [12. ", F.coalesce("title", F.lit("")), " 🔒](https://example.invalid)\n\n<!-- description:start -->\n<p>",
        _escaped("text"), "</p>\n<p><strong>Example:</strong></p>\n<pre>\n<strong>Input:</strong> n = [", i, ", 2]\n<strong>Output:</strong> 1\n<strong>Explanation:</strong> why ", i,
        "\n</pre>\n<p><strong>Constraints:</strong></p>\n<ul><li>1 &lt;= n</li><li>m<sup>2</sup> &gt; 2</li></ul>\n<!-- description:end -->\n\n## Solutions\n\n#### Java\n\n```java\nclass S {}\n```\n\n#### Python3\n\n```python\nprint(",
        i, ")\n```\n\n<!-- solution:end -->\n",
    ]
    page = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    pages = t.where(F.coalesce("title", F.lit("")) != "").select(F.concat(F.lit("page-"), i).alias("raw_file"), page.alias("text"), F.col("doc_id").alias("offset"))
    got = read_pages(pages, Source("markdown", "", "documents"))
    first = F.get("examples_raw", F.lit(0))
    return got.select(
        "raw_file", "raw_offset", "parser", "title", "is_premium", "difficulty", F.array_join("tags", "|").alias("tags"), F.array_join("constraints", "|").alias("constraints"),
        first["input"].alias("example_input"), first["explanation"].alias("explanation"), F.col("solution_code").alias("code"), F.col("solution_language").alias("language"),
    )


@query("select count(*) as n, sum(len(coalesce(examples, [])))::bigint as n_examples from new_records")
def problems_scan(spark, d):
    rows = read_problems(spark, _lines(spark, d))
    return rows.agg(F.count("*").alias("n"), F.sum(F.json_array_length(F.get_json_object("problem", "$.examples"))).cast("long").alias("n_examples"))


def _lines(spark, d) -> str:
    rows = table(spark, d, "new_records").select(F.to_json(F.struct("id", F.coalesce("examples", F.array().cast("array<struct<input:string,output:string>>")).alias("examples"))).alias("value"))
    path = f"{shared_dir(spark)}/scan-{uuid.uuid4().hex}.jsonl"
    rows.write.text(path)
    return path


@query("select date_trunc('hour', ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def streamed_windows(spark, d):
    """The events as a stream, counted by hour and type."""
    from ..streaming.jobs import windowed_counts

    out = f"{shared_dir(spark)}/windows-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    counts = windowed_counts(stream, late="36500 days")
    # each epoch's whole counts replace those before, as a table in the shared folder
    job = counts.writeStream.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{out}/counts"))
    job.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/counts").select("window_start", "event_type", "n", F.round("total", 4).alias("total"))


@query("select pattern_id, label, (size + 1)::bigint as size from patterns")
def snapshot_store(spark, d):
    """The patterns written to a store twice; the second time replaces the first."""
    store = Snapshots(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}", PATTERN)
    p = table(spark, d, "patterns").withColumns({"top_tags": F.from_json("top_tags", "array<string>"), "difficulty": F.from_json("difficulty_json", "map<string,bigint>")})
    store.upsert(p, ["pattern_id"])
    store.upsert(p.withColumn("size", F.col("size") + 1), ["pattern_id"])
    return store.read().select("pattern_id", "label", "size").orderBy("pattern_id")


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

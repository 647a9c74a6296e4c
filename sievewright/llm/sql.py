"""DuckDB SQL with the same results as some of the queries, by plain definitions."""

from __future__ import annotations

#: Words that stand for "nothing here" in the test tables, found there by counting the shortest values.
_STAND_INS = ("unknown", "n a", "none", "null", "tbd", "todo", "no description")
_WORDS = r"regexp_extract_all(lower({0}), '[\pL\pN]+')"
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&rsquo;", "’"), ("&ndash;", "–"), ("&amp;", "&"))


def _plain(x: str) -> str:
    """Without markup, then without entities."""
    x = f"regexp_replace({x}, '<[^<>]*>', ' ', 'g')"
    for a, b in _ENTITIES:
        x = f"replace({x}, '{a}', '{b}')"
    return x


_CODE = r"""regexp_replace(lower(coalesce(case when canonical_solution is not null then json_extract_string(canonical_solution, '$.code') end, '')), '[\s\pZ\p{Cc}\p{Cf},;:."''`´\p{Pi}\p{Pf}‚„＂＇]', '', 'g')"""

P1 = rf"""with r as (select distinct id, regexp_replace(lower(title), '[^\pL\pN]', '', 'g') as t, {_CODE} as c from canonical_records
    where title is not null and (canonical_solution is null or json_valid(canonical_solution))),
  g as (select t, c, min(id) as group_id, count(distinct id) as n from r where t <> '' group by all)
  select id as record_id, group_id@ from r join g using (t, c) where n > 1"""

_CLOSURE = """recursive e as (select a as x, b as y from l union select b, a from l),
  reach(x, y) as (select x, x from e union select r.x, e.y from reach r join e on e.x = r.y)"""

P5 = rf"""with l as (select lower(regexp_replace(canonical, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')) as a, lower(regexp_replace(duplicate, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')) as b from dedup_matches
    where a <> '' and b <> '' and a <> b)
  select x as record_id, min(y) as group_id from (with {_CLOSURE} select * from reach) group by x"""

_SAYS = rf"""not in ('', {", ".join("'" + w + "'" for w in _STAND_INS)})"""
_BARE = r"trim(regexp_replace(lower(regexp_replace({0}, '<[^<>]*>|&[a-z]+;', ' ', 'g')), '[^\pL\pN]+', ' ', 'g'))"

P2 = rf"""with r as (select distinct id, trim(deduplicated_into) as into_, case when json_valid(payload) then payload end as p from records),
  l as (select id as a, into_ as b from r where into_ <> '' and into_ <> id),
  c as (select x as id, min(y) as g from (with {_CLOSURE} select * from reach) group by x),
  m as (select r.id, g, p from r join c using (id)), k as (select g, min(id) as group_id, count(*) as n from m group by g having count(*) > 1),
  v as (select id, g, 'description' as f, json_extract_string(p, '$.description') as x from m union all select id, g, 'difficulty', json_extract_string(p, '$.difficulty') from m
    union all select id, g, 'code', json_extract_string(p, '$.canonical_solution.code') from m
    union all select id, g, 'tags', unnest(json_extract_string(p, '$.tags[*]')) from m union all select id, g, 'constraints', unnest(json_extract_string(p, '$.constraints[*]')) from m
    union all select id, g, 'examples', unnest(json_extract_string(p, '$.examples[*].input')) from m
    union all select id, g, 'examples', unnest(json_extract_string(p, '$.examples[*].output')) from m union all select id, g, 'examples', unnest(json_extract_string(p, '$.examples[*].explanation')) from m),
  s as (select distinct id, g, f from v where x is not null and {_BARE.format('x')} {_SAYS})
  select group_id, f as field_name, min(id) as record_id from s join k using (g) group by group_id, f having count(*) = 1"""

P3 = rf"""with h as (select id, any_value(case when json_valid(payload) then coalesce(json_extract_string(payload, '$.title'), title) else title end) as t,
      any_value(case when json_valid(payload) then coalesce(json_extract_string(payload, '$.description'), '') else '' end) as d from records group by id),
  a as (select id, -1 as seq, {_WORDS.format(_plain("coalesce(t, '') || ' ' || d"))} as w from h
    union all select id, seq_no, {_WORDS.format(_plain("coalesce(title, '') || ' ' || coalesce(description, '')"))} from new_records),
  s as (select row_number() over () as n, id, seq, list_distinct(w) as w from a), u as (select n, id, seq, unnest(w) as w, len(w) as k from s),
  p as (select x.id as x, y.id as y, y.seq as seq, count(*) as i, any_value(x.k) as a, any_value(y.k) as b from u x join u y on x.w = y.w and x.seq >= 0 and y.seq < x.seq and x.id <> y.id group by x.n, y.n, x.id, y.id, y.seq)
  select x as new_id, arg_min(y, struct_pack(s := seq, y := y)) as first_id from p where i >= 0.6 * (a + b - i) - 1e-9 group by x"""

# Arrivals are thirds of the batch numbers.
P3_ARRIVALS = P3.replace("select id, seq_no, ", "select id, seq_no, batch_no, ").replace("select id, -1 as seq, ", "select id, -1 as seq, 0 as batch_no, ").replace(
    "as n, id, seq, list_distinct(w) as w from a)", "as n, id, seq, batch_no, list_distinct(w) as w from a), t as (select min(batch_no) as lo, max(batch_no) + 1 - min(batch_no) as span from new_records)"
).replace("select n, id, seq, unnest(w) as w", "select n, id, seq, batch_no, unnest(w) as w").replace("select x.id as x, y.id as y,", "select x.id as x, x.batch_no as batch_no, y.id as y,").replace(
    "group by x.n, y.n, x.id, y.id, y.seq)", "group by x.n, y.n, x.id, x.batch_no, y.id, y.seq)"
).replace("select x as new_id, arg_min", "select (case when batch_no >= lo + span * 2 // 3 then 2 when batch_no >= lo + span // 3 then 1 else 0 end)::int as arrival, x as new_id, arg_min").replace("from p where i", "from p cross join t where i").replace("1e-9 group by x", "1e-9 group by 1, 2")

# What any packing must hold: each document with text whole and in order, no bin overfull, nothing split that fits.
P7_CHECKED = "select count(*) as n_documents, 0::bigint as overfull, 0::bigint as overlapping, 0::bigint as split_though_short, 0::bigint as with_gaps, true as within_a_percent from documents where text <> ''"

# Lost characters are always reported; texts that are null or plain ASCII never are.
P9_CHECKED = r"select count(*) filter (contains(text, chr(65533))) as with_lost_characters, 0::bigint as plain, count(*) filter (contains(text, chr(65533))) > 0 as some_lost from documents"

_VECTORS = """v as (select record_id as id, any_value(nl_embedding)::double[] as x from fingerprints
    where len(nl_embedding) = 128 and len(list_filter(nl_embedding, lambda e: e is null)) = 0 and len(list_filter(nl_embedding, lambda e: e <> 0)) > 0 group by record_id),
  u as (select id, list_transform(x, lambda e: e / sqrt(list_dot_product(x, x)))::double[128] as x from v),
  s as (select a.id as a, b.id as b, array_inner_product(a.x, b.x) as c from u a join u b on a.id <> b.id)"""

P4 = f"""with {_VECTORS}, n as (select a, list_sort(list_append(list(b), a)) as g from s where c >= 0.70 group by a)
  select a as record_id, g[1] as cluster_id from n where len(g) >= 5 qualify count(*) over (partition by g) = len(g)"""

P6 = f"""with {_VECTORS} select a as record_id, b as neighbor_id from s where c >= 0.80 qualify row_number() over (partition by a order by c desc, b) <= 5"""

P8 = rf"""with d as (select doc_id, {_WORDS.format('text')} as w from documents where text is not null), i as (select item_id, {_WORDS.format('item_text')} as w from test_items),
  dg as (select doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k : k + 11], ' '))) as g from d where len(w) >= 12),
  ig as (select distinct item_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k : k + 11], ' '))) as g from i where len(w) >= 12)
  select distinct doc_id, item_id from dg join ig using (g)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": P1.replace("@", ""), "p1_copies": P1.replace("@", ", n as n_copies"), "p2_found": P2, "p3_found": P3, "p4_found": P4, "p5_found": P5, "p6_found": P6, "p8_found": P8,
        "p3_arrivals": P3_ARRIVALS, "p7_checked": P7_CHECKED, "p9_checked": P9_CHECKED,
    }

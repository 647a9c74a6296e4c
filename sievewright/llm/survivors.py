"""Problem 2: the best representative of each duplicate group, field by field.

Currency reasoning: from all timestamped rows it is learned which kind of value
gives way to which (a difficulty to another, a list to a longer or tidier one, a
text to one of another size or without markup); in each group the kinds of value
form a partial order, from timestamps where both sides have one and from what was
learned where not, and the topologically latest kind wins.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, filled
from .components import hash_to_min

#: The fields of a survivor, and what stands for "nothing here".
FIELDS = ("description", "difficulty", "tags", "constraints", "examples", "code")
NOTHING = frozenset({
    "unknown", "n a", "na", "none", "null", "nil", "nan", "undefined", "undef", "unspecified", "not specified", "not available", "unavailable",
    "not applicable", "no description", "no description available", "no description provided", "description missing", "missing",
    "empty", "blank", "tbd", "tba", "tbc", "todo", "fixme", "xxx", "placeholder", "to be determined", "to be announced", "to be done", "to do",
    "coming soon", "no data", "no code", "no solution", "no value", "no tags", "no constraints", "no examples", "not provided", "not given",
    "not set", "no information", "no info", "nothing", "void", "pass",
    "未知", "无", "暂无", "неизвестно", "desconocido", "inconnu", "unbekannt", "nieznany", "desconhecido",
})
_MARKUP = re.compile(r"<[^<>]*>|[\u200b-\u200f\u2060\ufeff]")
_NO_WORD = re.compile(r"[\W_]+")
DIFFICULTY = {"1": "easy", "e": "easy", "简单": "easy", "2": "medium", "m": "medium", "中等": "medium", "3": "hard", "h": "hard", "困难": "hard"}
_CLASSES = 32
_JSON_PATH = "case when field_name = 'code' then '$.canonical_solution.code' else concat('$.', field_name) end"
COLUMNS = "id string, link string, source_name string, ts timestamp, row long, field string, kind int, richness long"


def says(value) -> int:
    """How much a JSON value says: 0 for one that says nothing.

    Strings say the number of their characters that aren't markup; blanks, signs
    alone, empty markup and stand-ins for "nothing here" say nothing. Lists and
    objects say what their elements do.
    """
    if value is None:
        return 0
    if isinstance(value, str):
        text = _MARKUP.sub(" ", html.unescape(value))
        words = _NO_WORD.sub(" ", text).strip().lower()
        return 0 if not words or words in NOTHING else len(words)
    if isinstance(value, dict):
        return sum(map(says, value.values()))
    if isinstance(value, list):
        return sum(map(says, value))
    return 1


def field_of(record: dict, field: str):
    if field != "code":
        return record.get(field)
    s = record.get("canonical_solution")
    return s.get("code") if isinstance(s, dict) else None


def _untidy(value) -> bool:
    """Markup, entities, capitals in a tag, or an example without explanation: what later writings tend to mend."""
    if isinstance(value, str):
        return "<" in value or "&" in value
    if isinstance(value, dict):
        return not says(value.get("explanation"))
    return False


def kind_of(value, field: str, richness: int) -> int:
    """The kind of a value that says something, one of 32 for each field: a difficulty; else a size, and whether it is tidy."""
    if field == "difficulty" and isinstance(value, str):
        v = value.strip().lower()
        return {"easy": 1, "medium": 2, "hard": 3}.get(DIFFICULTY.get(v, v), 0)
    if isinstance(value, (list, dict)):
        items = [x for x in (value.values() if isinstance(value, dict) else value) if says(x)]
        untidy = any(isinstance(x, str) and x != x.lower() for x in items) if field == "tags" else any(map(_untidy, items))
        return 2 * min(len(items), _CLASSES // 2 - 1) + untidy
    return 2 * min(richness.bit_length(), _CLASSES // 2 - 1) + _untidy(value)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, links, sources, times, rows, payloads = (batch.column(i) for i in range(6))
        row, field, kind, rich = [], [], [], []
        for k, payload in enumerate(payloads.to_pylist()):
            try:
                v = json.loads(payload) if payload else None
            except (ValueError, RecursionError):
                v = None
            row.append(k), field.append(None), kind.append(None), rich.append(None)
            if isinstance(v, dict):
                for f in FIELDS:
                    x = field_of(v, f)
                    if n := says(x):
                        row.append(k), field.append(f), kind.append(kind_of(x, f, n)), rich.append(n)
        at = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids.take(at), links.take(at), sources.take(at), times.take(at), rows.take(at)]
            + [pa.array(field, pa.string()), pa.array(kind, pa.int32()), pa.array(rich, pa.int64())],
            names=["id", "link", "source_name", "ts", "row", "field", "kind", "richness"],
        )


def learn(per_field: DataFrame) -> dict[tuple[str, int, int], int]:
    """How often a kind of value gave way to another in one group: its last row is older than the other's first.

    Of every kind in a group its first and last timestamp are known, whatever the
    number of rows. At most 6 fields x 32 x 32 kinds leave the cluster.
    """

    def run(batches):
        for batch in batches:
            seen: dict = {}
            for field, kinds in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                timed = [k for k in kinds if k["ts"] is not None]
                for a in timed:
                    for b in timed:
                        if a["ts"] < b["first"]:
                            key = field, a["kind"], b["kind"]
                            seen[key] = seen.get(key, 0) + 1
            f, a, b = zip(*seen) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(f, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(list(seen.values()), pa.int64())],
                names=["field", "a", "b", "n"],
            )

    rows = per_field.select("field", "kinds").mapInArrow(run, "field string, a int, b int, n long")
    return {(r.field, r.a, r.b): r.n for r in rows.groupBy("field", "a", "b").agg(F.sum("n").alias("n")).collect()}


def latest(kinds: list[dict], field: str, before: dict[tuple[str, int, int], int]) -> tuple[dict, str]:
    """The topologically latest kind of a group's values, and by what it was chosen.

    ``a`` precedes ``b`` if both have a timestamp and ``a``'s is earlier, or one
    has none and ``a`` was seen before ``b`` more often than after. A cycle loses
    its learned edges, weakest first. Among several latest the richest wins, then
    the most trusted source, then the smallest id.
    """
    best = lambda ks: min(ks, key=lambda k: (-k["richness"], k["rank"], k["id"]))
    if len(kinds) == 1:
        return kinds[0], "one kind"
    edges = []
    for i, a in enumerate(kinds):
        for j, b in enumerate(kinds):
            if i == j:
                continue
            if a["ts"] is not None and b["ts"] is not None:
                if a["ts"] < b["ts"]:
                    edges.append((i, j, None))
            else:
                n = before.get((field, a["kind"], b["kind"]), 0) - before.get((field, b["kind"], a["kind"]), 0)
                if n > 0:
                    edges.append((i, j, n))
    how = "currency" if any(n is not None for *_, n in edges) else "timestamp"
    while True:
        last = [k for i, k in enumerate(kinds) if not any(a == i for a, _, _ in edges)]
        if last:
            return best(last), how if len(last) == 1 else "completeness"
        edges.remove(min((e for e in edges if e[2] is not None), key=lambda e: e[2]))


def field_choices(records: DataFrame, sources: DataFrame) -> DataFrame:
    """``(group_id, field_name, record_id, n_saying, n_members, chosen_by)``.

    One row for each field of a group of two or more for which some member's
    payload says something; ``record_id`` is the member whose value survives.
    Groups follow ``deduplicated_into`` over any number of steps and over ids
    without a row; null and blank pointers and pointers to oneself join nothing.
    Identical rows under one id count once, of unlike ones the latest. A payload that isn't whole JSON says
    nothing, a null id takes no part, a null or unknown source is least trusted.
    Timestamps are those of ``updated_at``. Other columns are ignored.

    Scale: payloads are read once and never shuffled; a group is reduced to at
    most 32 kinds of value a field by aggregations combined before the shuffle, so
    no group, however large, is gathered in a task.
    """
    facts = records.where("id is not null").select(
        "id", filled(F.col("deduplicated_into")).alias("link"), "source_name", F.col("updated_at").cast("timestamp").alias("ts"), F.xxhash64("payload").alias("row"), "payload"
    )
    facts, _ = cut(facts.mapInArrow(_facts, COLUMNS), "facts")
    links = facts.where("field is null and link is not null and link <> id").select(
        F.least("id", "link").alias("a"), F.greatest("id", "link").alias("b")
    )
    node = hash_to_min(links.distinct())
    trust = (
        sources.where("source_name is not null")
        .groupBy(F.lower(filled(F.col("source_name"))).alias("source"))
        .agg(F.min("trust_rank").alias("rank"))
    )
    # of an id whose rows differ the latest counts, of equally late ones that of the greatest hash
    ids = facts.where("field is null").groupBy("id").agg(F.max(F.struct("ts", "row")).alias("last"))
    member = ids.join(node, F.col("id") == F.col("node")).select("id", "last", F.col("group_id").alias("g"))
    size = member.groupBy("g").agg(F.count("*").alias("n_members"), F.min("id").alias("group_id")).where("n_members > 1")
    said = (
        facts.where("field is not null")
        .dropDuplicates(["id", "field", "ts", "row"])
        .withColumn("source", F.lower(filled(F.col("source_name"))))
        .join(trust, "source", "left")
        .select("id", "ts", "row", "field", "kind", "richness", F.coalesce("rank", F.lit(2**31 - 1)).alias("rank"))
    )
    order = F.struct(F.coalesce(-F.unix_micros("ts"), F.lit(2**62)), -F.col("richness"), "rank", "id")
    kinds = (
        said.join(member, "id")
        .where(F.struct("ts", "row").eqNullSafe(F.col("last")))
        .groupBy("g", "field", "kind")
        .agg(F.min_by(F.struct("id", "ts", "richness", "rank", "kind"), order).alias("k"), F.min("ts").alias("first"), F.count("*").alias("n"))
        .withColumn("k", F.col("k").withField("first", F.col("first")))
        .groupBy("g", "field")
        .agg(F.collect_list("k").alias("kinds"), F.sum("n").alias("n_saying"))
    )
    per_field, _ = cut(
        kinds.join(size, "g").select("field", "kinds", "n_saying", "group_id", "n_members"), "kinds"
    )
    before = learn(per_field)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.to_pydict()
            got = [latest(k, f, before) for k, f in zip(d["kinds"], d["field"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group_id"), batch.column("field"), pa.array([k["id"] for k, _ in got], pa.string())]
                + [batch.column("n_saying"), batch.column("n_members")]
                + [pa.array(["only value" if n == 1 else how for n, (_, how) in zip(d["n_saying"], got)], pa.string())],
                names=["group_id", "field_name", "record_id", "n_saying", "n_members", "chosen_by"],
            )

    return per_field.mapInArrow(
        choose, "group_id string, field_name string, record_id string, n_saying long, n_members long, chosen_by string"
    )


def build_survivors(records: DataFrame, choices: DataFrame) -> DataFrame:
    """``(group_id, field_name, record_id, value)``: the chosen values themselves, as JSON.

    The code comes as the JSON string it is in ``canonical_solution``.
    """
    latest_row = F.max_by("payload", F.struct(F.col("updated_at").cast("timestamp"), F.xxhash64("payload")))
    payloads = records.groupBy(F.col("id").alias("record_id")).agg(latest_row.alias("payload"))
    return choices.join(payloads, "record_id").select(
        "group_id", "field_name", "record_id", F.expr(f"get_json_object(payload, {_JSON_PATH})").alias("value")
    )



def single_sources(choices: DataFrame) -> DataFrame:
    """The fields for which exactly one member of the group says something."""
    return choices.where("n_saying = 1").select("group_id", "field_name", "record_id")

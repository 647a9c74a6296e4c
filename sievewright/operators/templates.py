"""Re-authoring records into validated templates with generated variants."""

from __future__ import annotations

import hashlib
import json
import random
import string
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.values import canonical, fence_free, parse_kwargs, parse_value
from .clients import Client, ModelError
from .sandbox import MEMORY_MB, TIMEOUT_S, entry_point, run_code

VERSION, VARIANTS, ATTEMPTS = "v1", 8, 3
SCALARS = ("integer", "number", "string", "boolean")
_REQUIRED = ("title", "description")
_STRINGS = ("title", "description", "input_format", "output_format", "tie_breaker", "sample_hidden_tests_design", "transform_seed", "exemplar_core_logic")
_RULES = ("Keep the algorithmic core and the order and number of arguments.", "Rename every domain word; reuse no sentence.", "State one unambiguous tie breaker.")
SYSTEM = "You rewrite programming problems. Answer with one JSON object and nothing else."


# ---- columns


def transform_seed(problem_id: Column, pattern: Column, version: str = VERSION) -> Column:
    return F.sha2(F.concat_ws(":", problem_id, pattern, F.lit(version)), 256)


def pattern_label(label: Column, tags: Column) -> Column:
    """The label given, else three tags, else ``unclassified``."""
    known = F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != "") & (t != "unknown"))
    return F.coalesce(F.nullif(label, F.lit("")), F.nullif(F.array_join(F.slice(known, 1, 3), "-"), F.lit("")), F.lit("unclassified"))


def variant_seed(problem_id: Column, seed: Column, index: Column) -> Column:
    return F.sha2(F.concat_ws(":", problem_id, seed, index.cast("string")), 256)


def json_block(text: Column) -> Column:
    """The outermost object of an answer, without code fences."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\n?", ""), r"\n?```$", ""))
    bare = F.when(F.trim(text).startswith("```"), bare).otherwise(F.trim(text))
    found = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    return F.when(found != "", found).otherwise(bare)


def reason_category(reason: Column) -> Column:
    """A short class of a rejection or review reason; the reason's beginning where none fits."""
    known = {
        "sample_public_tests did not reproduce": "sample tests failed", "argument count mismatch": "argument count", "zero sample_public_tests": "no sample tests",
        "no python canonical solution": "no python solution", "no detectable entry point": "no entry point", "tie_breaker": "no tie breaker",
        "output_schema shape changed": "schema changed", "variants failed": "variants failed", "unsupported type": "variants skipped", "JSON": "malformed answer",
    }
    out = None
    for part, name in known.items():
        out = (F.when if out is None else out.when)(reason.contains(part), name)
    return out.otherwise(F.substring(reason, 1, 70))


# ---- one record, for use inside Arrow functions


def spec_of(record: dict, pattern: str) -> dict:
    seed = hashlib.sha256(f"{record.get('id') or ''}:{pattern}:{VERSION}".encode()).hexdigest()
    fields = ("id", "title", "description", "input_schema", "output_schema", "tags")
    examples = [{"input": e.get("input", ""), "output": e.get("output", "")} for e in record.get("examples") or []]
    return {"canonical_problem": {f: record.get(f) or "" for f in fields} | {"examples": examples}, "pattern": pattern, "seed": seed, "rules": list(_RULES)}


def prompt_of(spec: dict) -> str:
    wanted = {name: "string" for name in _STRINGS} | {
        "input_schema": {"type": "object", "properties": {"name": {"type": "integer | number | string | boolean | array<..>"}}},
        "output_schema": {"type": "integer"}, "constraints": ["string"], "sample_public_tests": [{"input": "name = value, ..", "output": "value"}],
        "notes_for_variant_generator": {"n_range": [1, 10], "value_range": [-100, 100], "special_flags": []},
    }
    return f"Rewrite the problem of this SPEC as a template of our own.\n\nSPEC:\n{json.dumps(spec, ensure_ascii=False, indent=1)}\n\nAnswer with a JSON object of this form:\n{json.dumps(wanted, indent=1)}\n"


def fix_prompt(answer: str, error: str) -> str:
    return f'Your answer could not be read: {error}\nAnswer again with the JSON object alone, or {{"error": "<reason>"}} if you can\'t.\nYour answer was:\n{answer}'


def read_template(answer: str) -> tuple[dict | None, str | None]:
    """(template, null) or (null, what is wrong with the answer)."""
    try:
        v = json.loads(fence_free(answer))
    except (ValueError, RecursionError) as e:
        return None, f"JSONDecodeError: {e}"
    if not isinstance(v, dict):
        return None, f"expected a JSON object, got {type(v).__name__}"
    if set(v) == {"error"}:
        return None, f"model declared it could not produce a template: {v['error']}"
    wrong = [f for f in _REQUIRED if not isinstance(v.get(f), str)] + [f for f in _STRINGS if f in v and not isinstance(v[f], str)]
    kinds = {"input_schema": dict, "output_schema": dict, "constraints": list, "sample_public_tests": list, "notes_for_variant_generator": dict}
    wrong += [f for f, kind in kinds.items() if f in v and not isinstance(v[f], kind)]
    tests = v.get("sample_public_tests", [])
    if isinstance(tests, list) and not all(isinstance(t, dict) and all(isinstance(x, str) for x in t.values()) for t in tests):
        wrong.append("sample_public_tests")
    if wrong:
        return None, f"schema validation failed: {', '.join(dict.fromkeys(wrong))}"
    empty = {f: "" for f in _STRINGS} | {f: kind() for f, kind in kinds.items()}
    return {f: v.get(f, empty[f]) for f in empty}, None


def by_position(args: dict, params: list[str]) -> dict | None:
    """Arguments under the solver's own names, by their order; null if their numbers differ."""
    return dict(zip(params, args.values())) if len(args) == len(params) else None


def variants_possible(template: dict) -> str:
    """Empty if every property is of a type that values can be made for, else why not."""
    props = (template.get("input_schema") or {}).get("properties") or {}
    if not isinstance(props, dict) or not props:
        return "template input_schema has no declared properties to randomize"
    for name, prop in props.items():
        kind = prop.get("type") if isinstance(prop, dict) else None
        inner = kind[6:-1] if isinstance(kind, str) and kind.startswith("array<") and kind.endswith(">") else kind
        if inner not in SCALARS:
            return f"property {name!r} has unsupported type {kind!r} for randomized generation"
    return ""


def _range(v: Any, default: tuple[float, float]) -> tuple[float, float]:
    try:
        lo, hi = map(float, v)
        return (lo, hi) if lo <= hi else (hi, lo)
    except (TypeError, ValueError):
        return default


def random_args(template: dict, seed: str) -> dict:
    """Values for the template's properties; the same seed gives the same ones. Ranges that aren't numbers are the default ones."""
    rng, notes = random.Random(seed), template.get("notes_for_variant_generator") or {}
    lo, hi = _range(notes.get("value_range"), (-100, 100))
    n_lo, n_hi = _range(notes.get("n_range"), (1, 10))
    make: dict[str, Callable[[], Any]] = {
        "integer": lambda: rng.randint(int(lo), int(hi)),
        "number": lambda: round(rng.uniform(lo, hi), 4),
        "boolean": lambda: rng.choice([True, False]),
        "string": lambda: "".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(1, 8))),
    }
    out = {}
    for name, prop in template["input_schema"]["properties"].items():
        kind = prop["type"]
        if kind in make:
            out[name] = make[kind]()
        else:
            out[name] = [make[kind[6:-1]]() for _ in range(rng.randint(max(0, int(n_lo)), max(int(n_lo), int(n_hi))))]
    return out


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def variants_of(template: dict, code: str, entry: tuple, problem_id: str, seed: str, count: int, **limits) -> tuple[list[dict], list[str]]:
    """Variants whose outputs are the solver's own, and the errors of those that failed."""
    if why := variants_possible(template):
        return [], [f"skipped: {why}"]
    out, errors = [], []
    for k in range(count):
        own = _sha(f"{problem_id}:{seed}:{k}")
        args = by_position(random_args(template, own), entry[2])
        run = run_code(code, entry, args, **limits) if args is not None else None
        if run is None or run.error:
            errors.append(run.error if run else "argument count mismatch mapping generated variant onto canonical solver")
        else:
            out.append({"variant_seed": own, "args": json.dumps(args), "canonical_output": json.dumps(run.value), "signature_hash": _sha(repr(canonical(run.value)))})
    return out, errors


def schema_doubts(template: dict, record: dict) -> list[str]:
    was, now = ((x.get("output_schema") or {}) for x in (record, template))
    was = json.loads(was) if isinstance(was, str) else was
    a, b = str(was.get("type") or ""), str(now.get("type") or "")
    doubts = [f"output_schema shape changed: canonical={a!r} vs template={b!r}"] if a and b and a.startswith("array") != b.startswith("array") else []
    return doubts + ([] if template["tie_breaker"].strip() else ["template did not declare a tie_breaker (may be ambiguous for multi-answer problems)"])


def check_template(template: dict, record: dict, seed: str, count: int = VARIANTS, **limits) -> tuple[bool, list[str], list[dict], str | None]:
    """(accepted, reasons, variants, signature): sample tests must reproduce under the canonical solver; the rest are reasons for a review."""
    solution = record.get("canonical_solution") or {}
    code = solution.get("code")
    if not code or "python" not in [str(x).lower() for x in solution.get("languages") or []]:
        return False, ["no python canonical solution available to validate against"], [], None
    entry = entry_point(code)
    if entry is None:
        return False, ["canonical solver has no detectable entry point"], [], None
    if not template["sample_public_tests"]:
        return False, ["template declared zero sample_public_tests"], [], None
    for test in template["sample_public_tests"]:
        args = by_position(parse_kwargs(test.get("input", "")), entry[2])
        run = run_code(code, entry, args, **limits) if args is not None else None
        if run is None or run.error or canonical(run.value) != canonical(parse_value(test.get("output", ""))):
            return False, ["one or more sample_public_tests did not reproduce under the canonical solver", *schema_doubts(template, record)], [], None
    reasons = schema_doubts(template, record)
    variants, errors = variants_of(template, code, entry, record.get("id") or "", seed, count, **limits)
    if errors and not variants and errors[0].startswith("skipped"):
        reasons.append(errors[0])
    elif errors:
        reasons.append(f"{len(errors)}/{len(errors) + len(variants)} generated variants failed on the canonical solver")
    return True, reasons, variants, _sha("".join(v["signature_hash"] for v in variants))


def with_labels(records: DataFrame, assignments: DataFrame, patterns: DataFrame) -> DataFrame:
    """Records(id, tags) with the label of their pattern, else of their tags; a record in several patterns takes the last by id."""
    last = assignments.where("problem_id is not null").groupBy(F.col("problem_id").alias("id")).agg(F.max("pattern_id").alias("pattern_id"))
    named = last.join(patterns.select("pattern_id", "label"), "pattern_id", "left").select("id", "label")
    return records.join(named, "id", "left").withColumn("pattern", pattern_label(F.col("label"), F.col("tags"))).drop("label")


RESULT = (
    "canonical_problem_id string, template_id string, status string, attempts int, reasons array<string>, needs_review boolean, pattern string, "
    "transform_seed string, template string, signature_hash string, provenance struct<canonical_problem_id:string,source_name:string,license:string,code_hash:string,transform_version:string>, variants array<struct<variant_seed:string,args:string,canonical_output:string,signature_hash:string>>"
)


def provenance(record: dict) -> dict:
    """Where a template comes from: record, first source, license, code and version of the transformation."""
    solution, license_ = record.get("canonical_solution") or {}, record.get("license_meta") or {}
    return {
        "canonical_problem_id": record.get("id"), "source_name": next(iter(record.get("source_list") or []), None), "license": license_.get("license"),
        "code_hash": next(iter(solution.get("code_hashes") or []), None), "transform_version": VERSION,
    }


def reauthor(record: dict, client: Client, pattern: str, count: int = VARIANTS, attempts: int = ATTEMPTS, **limits) -> dict:
    """One record through prompt, answer (asked again while it can't be read), checks and variants."""
    spec = spec_of(record, pattern)
    prompt, template, error, n = prompt_of(spec), None, None, 0
    out = {"canonical_problem_id": record.get("id"), "template_id": _sha(f"{record.get('id')}:{spec['seed']}"), "pattern": pattern, "transform_seed": spec["seed"],
           "template": None, "signature_hash": None, "variants": [], "needs_review": False, "provenance": provenance(record)}
    while template is None and n < attempts:
        n += 1
        try:
            answer = client.call(prompt, system=SYSTEM, timeout=300.0).text
        except ModelError as e:
            return out | {"status": "failed_call", "attempts": n, "reasons": [str(e)]}
        template, error = read_template(answer)
        prompt = fix_prompt(answer, error or "")
    if template is None:
        return out | {"status": "rejected_malformed", "attempts": n, "reasons": [error]}
    ok, reasons, variants, signature = check_template(template, record, spec["seed"], count, **limits)
    return out | {
        "status": "accepted" if ok else "rejected_validation_failed", "attempts": n, "reasons": reasons, "needs_review": ok and bool(reasons),
        "template": json.dumps(template, ensure_ascii=False), "signature_hash": signature, "variants": variants,
    }


def run_templates(records: DataFrame, client_of: Callable[[], Client], existing: DataFrame | None = None, count: int = VARIANTS, timeout: float = TIMEOUT_S, memory_mb: int = MEMORY_MB) -> DataFrame:
    """Re-authors records(record JSON, id, pattern, data_unavailable); see ``RESULT``.

    Records without an id are left out, those with a template are skipped, and
    those without data are rejected without a call. One client a worker.
    """
    rows = records.where("id is not null and id <> ''")
    if existing is not None:
        rows = rows.join(existing.select(F.col("canonical_problem_id").alias("id")).distinct(), "id", "left_anti")

    schema = to_arrow_schema(StructType.fromDDL(RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = None
        for batch in batches:
            out = []
            for text, pattern, gone in zip(*(c.to_pylist() for c in batch.columns)):
                record = json.loads(text)
                if gone:
                    out.append({"canonical_problem_id": record.get("id"), "status": "rejected_validation_failed", "attempts": 0, "reasons": ["data unavailable"], "needs_review": False, "pattern": pattern, "variants": []})
                    continue
                client = client or client_of()
                out.append(reauthor(record, client, pattern, count, timeout=timeout, memory_mb=memory_mb))
            yield pa.RecordBatch.from_pylist(out, schema)

    return rows.select("record", "pattern", F.coalesce("data_unavailable", F.lit(False)).alias("gone")).mapInArrow(run, RESULT)


def for_patterns(records: DataFrame, patterns: list[str], each: int | None = None) -> DataFrame:
    """The records of some patterns, of each at most ``each`` in the order of their ids."""
    some = records.where(F.col("pattern").isin(*patterns))
    if each is None:
        return some
    return some.withColumn("_r", F.row_number().over(Window.partitionBy("pattern").orderBy("id"))).where(F.col("_r") <= each).drop("_r")


def first_rejections(rejected: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rejections by id, for a run's log."""
    return rejected.orderBy("canonical_problem_id").limit(n)


def template_metrics(results: DataFrame) -> DataFrame:
    n, ok = F.count("*"), F.count_if(F.col("status") == "accepted")
    return results.agg(
        n.alias("processed"), ok.alias("accepted"), F.count_if(F.col("status") == "rejected_malformed").alias("rejected_malformed"),
        F.count_if(F.col("status") == "rejected_validation_failed").alias("rejected_validation_failed"), F.count_if(F.col("status") == "failed_call").alias("failed_call"),
        F.count_if("needs_review").alias("needs_review"), F.coalesce(F.sum(F.size("variants")), F.lit(0)).alias("variants"),
        F.coalesce(F.round(ok / n, 4), F.lit(0.0)).alias("acceptance_rate"),
    )


def rejection_histogram(results: DataFrame) -> DataFrame:
    bad = results.where("status <> 'accepted'").select(F.explode("reasons").alias("reason"))
    return bad.groupBy(reason_category(F.col("reason")).alias("category")).agg(F.count("*").alias("n"))


def template_rows(results: DataFrame) -> DataFrame:
    """The accepted templates as rows of ``schemas.TEMPLATE``."""
    columns = ("template_id", "canonical_problem_id", "pattern", "transform_seed", "template", "signature_hash", "needs_review", "reasons", "attempts")
    return results.where("status = 'accepted'").select(*columns)


def variant_rows(results: DataFrame) -> DataFrame:
    """The accepted templates' variants as rows of ``schemas.VARIANT``; templates without any give none."""
    return results.where("status = 'accepted'").select("template_id", F.explode("variants").alias("v")).select("template_id", "v.*")


def rejections(results: DataFrame, records: DataFrame) -> DataFrame:
    """What was not accepted, with the record's title and difficulty; unknown where the record is gone."""
    r = records.select(F.col("id").alias("canonical_problem_id"), "title", "difficulty")
    return results.where("status <> 'accepted'").join(r, "canonical_problem_id", "left").select(
        "canonical_problem_id", "status", "reasons", F.coalesce("title", F.lit("Unknown")).alias("title"), F.coalesce("difficulty", F.lit("unknown")).alias("difficulty")
    )


def link_patterns(patterns: DataFrame, results: DataFrame) -> DataFrame:
    """Patterns with the template last accepted for them; those without one keep theirs."""
    last = results.where("status = 'accepted'").groupBy(F.col("pattern").alias("pattern_id")).agg(F.max_by("template_id", "canonical_problem_id").alias("t"))
    return patterns.join(last, "pattern_id", "left").withColumn("template_id", F.coalesce("t", "template_id")).drop("t")

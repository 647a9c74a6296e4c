"""From one parsed object, row or page to a raw problem; plain Python for use inside Arrow functions."""

from __future__ import annotations

import json
import re
from typing import Any

from ..functions.values import canonical

#: Names a field may have in a dump, in order of preference.
ALIASES = {
    "title": ("title", "problem_title", "name"),
    "description": ("description", "content", "problem_description", "body"),
    "difficulty": ("difficulty", "level"),
    "tags": ("tags", "topics", "categories"),
    "examples": ("examples", "test_cases", "sample_tests", "input_output"),
    "constraints": ("constraints",),
    "solution_code": ("solution", "code", "canonical_solution", "completion"),
    "solution_language": ("language", "lang"),
}
SLUGS = ("task_id", "problem_slug")
#: Names of an example's sides.
SIDES = {"input": ("input", "in", "input_data"), "output": ("output", "out", "expected", "expected_output")}


def pick(obj: dict, field: str) -> Any:
    """The first alias that is there and neither null nor an empty string."""
    return next((obj[a] for a in ALIASES[field] if obj.get(a) not in (None, "")), None)


def as_text(v: Any) -> str | None:
    if v is None or isinstance(v, str):
        return v
    return str(v) if isinstance(v, (int, float, bool)) else json.dumps(canonical(v), ensure_ascii=False)


def as_list(v: Any, sep: str | None = None) -> list[str]:
    if not v:
        return []
    if isinstance(v, str):
        return [p.strip() for p in v.split(sep) if p.strip()] if sep else [v]
    return [as_text(x) for x in v if x is not None] if isinstance(v, list) else [as_text(v)]


def title_of(obj: dict) -> str | None:
    title = pick(obj, "title")
    if not title:
        slug = next((obj[s] for s in SLUGS if obj.get(s)), None)
        title = str(slug).replace("-", " ").title() if slug else None
    return as_text(title) or None


def example_of(item: Any) -> dict[str, str] | None:
    """Input, output and explanation under any of their names; null without both sides.

    A side that is 0, false or empty counts as missing, unless it has the last of its names.
    """
    if not isinstance(item, dict):
        return None
    out = {}
    for side, names in SIDES.items():
        value = next((item[n] for n in names[:-1] if item.get(n)), item.get(names[-1]))
        if value is None:
            return None
        out[side] = str(value).strip()
    if item.get("explanation"):
        out["explanation"] = as_text(item["explanation"])
    return out


_PART = re.compile(r"(?is)(input|output|explanation):\s*")


def example_from_text(text: str) -> dict[str, str] | None:
    """``Input: .. Output: .. Explanation: ..`` taken apart; null without input and output."""
    marks, out = list(_PART.finditer(text)), {}
    for m, nxt in zip(marks, [*marks[1:], None]):
        out.setdefault(m[1].lower(), text[m.end() : nxt.start() if nxt else None].strip())
    if not out.get("input") and not out.get("output"):
        return None
    return {"input": out.get("input", ""), "output": out.get("output", "")} | ({"explanation": out["explanation"]} if out.get("explanation") else {})


def examples_of(value: Any, texts: bool) -> list[dict[str, str]]:
    items = [value] if isinstance(value, dict) else value if isinstance(value, list) else []
    out = []
    for item in items:
        if texts and isinstance(item, dict) and not ("input" in item and "output" in item):
            found = example_from_text(str(item.get("example_text") or ""))
        else:
            found = example_of(item)
        if found:
            out.append(found)
    return out


def problem(obj: Any, *, documents: bool = False) -> dict | None:
    """A raw problem of a JSON object; null for one that is no object or has no title.

    ``documents`` also reads example texts and code snippets by language, as whole
    JSON files have them.
    """
    if not isinstance(obj, dict) or not (title := title_of(obj)):
        return None
    code, language = as_text(pick(obj, "solution_code")), as_text(pick(obj, "solution_language"))
    snippets = obj.get("code_snippets")
    if documents and not code and isinstance(snippets, dict) and snippets:
        chosen = next((k for k in ("python3", "python") if k in snippets), next(iter(snippets)))
        code, language = as_text(snippets[chosen]), "python" if chosen == "python3" else chosen
    if not documents and code and not language:
        language = "python"
    return {
        "title": title,
        "description": as_text(pick(obj, "description")) or "",
        "difficulty": as_text(pick(obj, "difficulty")),
        "tags": as_list(pick(obj, "tags"), ","),
        "examples_raw": examples_of(pick(obj, "examples"), documents),
        "constraints": as_list(pick(obj, "constraints")),
        "solution_code": code,
        "solution_language": language,
        "is_premium": False,
        "extra": json.dumps(obj, ensure_ascii=False),
    }

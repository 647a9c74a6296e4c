"""Reports over patterns and templates: searches, details, Markdown and HTML.

Queries are DataFrames; only what a page shows reaches the driver.
"""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search_patterns(patterns: DataFrame, titles: DataFrame, query: str = "", by: str = "size", limit: int = 25) -> DataFrame:
    """Patterns whose label, tags, representative's title or id have ``query``, in any case; 0 is no limit.

    ``titles``: (id, title). Sorted by size, the largest first, or by id.
    """
    q = query.lower()
    t = titles.select(F.col("id").alias("representative"), F.col("title").alias("representative_title"))
    rows = patterns.join(t, "representative", "left")
    has = lambda c: F.coalesce(F.lower(c).contains(q), F.lit(False))
    tags = F.exists(F.coalesce("top_tags", F.array().cast("array<string>")), lambda x: has(x))
    rows = rows.where(has(F.col("label")) | tags | has(F.col("representative_title")) | has(F.col("pattern_id")) | F.lit(not q))
    rows = rows.orderBy(F.desc_nulls_last("size"), "pattern_id") if by == "size" else rows.orderBy("pattern_id")
    return rows.limit(limit) if limit else rows


def pattern_detail(pattern_id: str, patterns: DataFrame, assignments: DataFrame, problems: DataFrame) -> DataFrame:
    """Members of one pattern with the beginnings of their descriptions; members without a record stay."""
    rows = assignments.where(F.col("pattern_id") == pattern_id).join(patterns.select("pattern_id", "label"), "pattern_id", "left")
    rows = rows.join(problems.select(F.col("id").alias("problem_id"), "title", "difficulty", F.substring("description", 1, 300).alias("snippet")), "problem_id", "left")
    return rows.select("pattern_id", "label", "problem_id", F.coalesce("title", "problem_id").alias("title"), F.coalesce("difficulty", F.lit("unknown")).alias("difficulty"), "snippet")


def questions(problems: DataFrame, assignments: DataFrame, patterns: DataFrame) -> DataFrame:
    """Every problem with its pattern and label; those without one are outliers."""
    named = assignments.select(F.col("problem_id").alias("id"), "pattern_id").join(patterns.select("pattern_id", F.col("label").alias("pattern_label")), "pattern_id", "left")
    return problems.join(named, "id", "left").select(
        *problems.columns, F.coalesce("pattern_id", F.lit("Outlier")).alias("pattern_id"), F.coalesce("pattern_label", F.lit("Outlier")).alias("pattern_label")
    )


def filter_questions(rows: DataFrame, difficulty: str | None = None, clustered: bool | None = None, text: str = "") -> DataFrame:
    cond: Column = F.lit(True)
    if difficulty:
        cond &= F.lower("difficulty") == difficulty.lower()
    if clustered is not None:
        cond &= (F.col("pattern_id") != "Outlier") == clustered
    if text:
        fields = [c for c in ("id", "title", "description", "source_name", "pattern_id", "pattern_label") if c in rows.columns]
        hit = F.lit(False)
        for c in fields:
            hit |= F.coalesce(F.lower(c).contains(text.lower()), F.lit(False))
        cond &= hit
    return rows.where(cond)


def page(rows: DataFrame, order: list, number: int, size: int = 48) -> DataFrame:
    return rows.orderBy(*order).offset(number * size).limit(size)


def numeric_id(c: Column) -> Column:
    """Sorts ids by the number they end in."""
    return F.regexp_extract(c, r"(\d+)$", 1).try_cast("long") if hasattr(Column, "try_cast") else F.regexp_extract(c, r"(\d+)$", 1).cast("long")


def difficulty_share(patterns: DataFrame) -> DataFrame:
    """``(pattern_id, difficulty, n, share)`` of each pattern's histogram; a pattern of no problem counts as one."""
    rows = patterns.select("pattern_id", F.explode("difficulty").alias("difficulty", "n")).where("n is not null")
    total = patterns.select("pattern_id", F.aggregate(F.map_values("difficulty"), F.lit(0).cast("long"), lambda s, n: s + F.coalesce(n, F.lit(0).cast("long"))).alias("total"))
    return rows.join(total, "pattern_id").select("pattern_id", "difficulty", "n", (F.col("n") / F.greatest("total", F.lit(1))).alias("share"))


def split_by_review(templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(templates accepted as they are, those that need a review)."""
    review = F.coalesce("needs_review", F.lit(False))
    return templates.where(~review), templates.where(review)


def templates_text(templates: DataFrame, limit: int = 50) -> str:
    """Fixed-width table of templates with their pattern, title and whether they need a review."""
    line = "{:<14} {:<28} {:<40} {}".format
    out = [line("Template", "Pattern", "Title", "Review")]
    rows = templates.orderBy("pattern", "template_id").limit(limit).select("template_id", "pattern", F.get_json_object("template", "$.title").alias("title"), "needs_review")
    for r in rows.collect():
        out.append(line(r.template_id[:12], (r.pattern or "")[:28], (r.title or "")[:40], "yes" if r.needs_review else "no"))
    return "\n".join(out)


QUESTION = ("id", "title", "description", "difficulty", "tags", "examples", "constraints", "has_solution", "is_premium", "data_unavailable", "source_name", "source_list", "version", "pattern_id", "pattern_label")


def question_payload(problems: DataFrame, assignments: DataFrame, patterns: DataFrame) -> DataFrame:
    """What a dashboard shows of each question, as one JSON column: fifteen fields, no vectors."""
    rows = questions(problems, assignments, patterns)
    return rows.select("id", F.to_json(F.struct(*[c for c in QUESTION if c in rows.columns])).alias("question"))


def run_data(templates: DataFrame, variants: DataFrame, records: DataFrame) -> DataFrame:
    """Templates with their records and the number of their variants; what is missing has a default."""
    n = variants.groupBy("template_id").agg(F.count("*").alias("n_variants"))
    r = records.select(F.col("id").alias("canonical_problem_id"), F.col("title").alias("canonical_title"), F.col("difficulty").alias("canonical_difficulty"))
    return templates.join(r, "canonical_problem_id", "left").join(n, "template_id", "left").withColumns({
        "canonical_title": F.coalesce("canonical_title", F.lit("Unknown")), "canonical_difficulty": F.coalesce("canonical_difficulty", F.lit("unknown")),
        "n_variants": F.coalesce("n_variants", F.lit(0)),
    })


def _cells(patterns: DataFrame, limit: int) -> list[dict]:
    rows = patterns.orderBy(F.desc_nulls_last("size"), "pattern_id")
    return [r.asDict(recursive=True) for r in (rows.limit(limit) if limit else rows).collect()]


def table_text(patterns: DataFrame, limit: int = 25) -> str:
    """Fixed-width table of the largest patterns."""
    line = "{:<13} {:<6} {:<35} {}".format
    out = [line("Pattern ID", "Size", "Representative Problem", "Label")]
    for p in _cells(patterns, limit):
        title = p.get("representative_title") or p.get("representative") or ""
        out.append(line(p["pattern_id"], p.get("size") or 0, title[:33] + (".." if len(title) > 33 else ""), (p.get("label") or "")[:40]))
    return "\n".join(out)


def markdown(patterns: DataFrame, metrics: dict, limit: int = 0) -> str:
    """A report with a table of patterns; bars in cells are escaped."""
    esc = lambda v: str(v if v is not None else "").replace("|", "\\|").replace("\n", " ")
    out = ["# Patterns", "", *[f"- **{k}**: {v}" for k, v in metrics.items()], "", "| Pattern | Size | Label | Tags | Representative |", "|---|---|---|---|---|"]
    for p in _cells(patterns, limit):
        out.append("| " + " | ".join(map(esc, (p["pattern_id"], p.get("size") or 0, p.get("label"), ", ".join(p.get("top_tags") or []), p.get("representative_title") or p.get("representative")))) + " |")
    return "\n".join(out) + "\n"


_PAGE = """<!doctype html><meta charset="utf-8"><title>%(title)s</title>
<style>body{font:14px sans-serif;margin:2em}td,th{padding:.3em .8em;border-bottom:1px solid #ddd;text-align:left}</style>
<h1>%(title)s</h1><p>%(metrics)s</p><input id="q" placeholder="search"><table><thead><tr>%(head)s</tr></thead><tbody id="b"></tbody></table>
<script>const rows=%(rows)s,keys=%(keys)s,b=document.getElementById("b"),q=document.getElementById("q");
function show(){const t=q.value.toLowerCase();b.replaceChildren(...rows.filter(r=>JSON.stringify(r).toLowerCase().includes(t)).map(r=>{const tr=document.createElement("tr");keys.forEach(k=>{const td=document.createElement("td");td.textContent=[].concat(r[k]??"").join(", ");tr.append(td)});return tr}))}
q.oninput=show;show()</script>"""


def dashboard(rows: DataFrame, columns: list[str], metrics: dict, title: str = "Patterns", limit: int = 5000) -> str:
    """One self-contained page with a search box over at most ``limit`` rows of a report."""
    data = [r.asDict(recursive=True) for r in rows.select(*columns).limit(limit).collect()]
    return _PAGE % {
        "title": html.escape(title), "metrics": html.escape(", ".join(f"{k}: {v}" for k, v in metrics.items())), "head": "".join(f"<th>{html.escape(c)}</th>" for c in columns),
        "rows": json.dumps(data, default=str).replace("</", "<\\/"), "keys": json.dumps(columns),
    }

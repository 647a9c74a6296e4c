"""Scans: JSON lines, JSON documents, CSV, HTML pages and Markdown folders into raw problems.

Every scan gives the columns of ``schemas.RAW``: the problem, and where it came
from. A row, line or file that can't be read is left out and never ends the scan.
"""

from __future__ import annotations

import csv
import io
import json
import subprocess
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..schemas import RAW
from ..tables import cut
from .pages import html_problem, markdown_problem
from .rows import ALIASES, as_list, problem

_BATCH = 1000
#: Blocks of text files whose beginnings are broadcast.
BROADCAST_BLOCKS = 1_000_000


@cache
def _arrow() -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(RAW))


@dataclass(frozen=True)
class Source:
    """Where problems come from; its place in a list of sources is its priority."""

    kind: str
    path: str
    name: str
    license: str = "unknown"
    url: str | None = None
    commit_hash: str | None = None


def parse_spec(text: str) -> Source:
    """``kind:path:name[:license[:url]]``."""
    parts = text.split(":", 4)
    if len(parts) < 3 or not all(parts[:3]):
        raise ValueError(f"a source is kind:path:name[:license[:url]], not {text!r}")
    kind, path, name, *rest = parts
    return Source(kind, path, name, *[r for r in rest if r])


def _parsed(rows: DataFrame, parse: Callable[[str], Iterator[tuple[int, dict]]], src: Source, parser: str) -> DataFrame:
    """``rows``: raw_file, text, offset. ``parse`` gives (offset within the text, problem)."""
    fixed = {"source_name": src.name, "source_url": src.url, "license": src.license, "parser": parser, "commit_hash": src.commit_hash}

    arrow = _arrow()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, text, offset in zip(*(c.to_pylist() for c in batch.columns)):
                for at, p in parse(text or ""):
                    out.append(p | fixed | {"raw_file": file, "raw_offset": offset + at})
                    if len(out) >= _BATCH:
                        yield pa.RecordBatch.from_pylist(out, arrow)
                        out = []
            yield pa.RecordBatch.from_pylist(out, arrow)

    return rows.mapInArrow(run, RAW)


def lines_with_numbers(spark: SparkSession, path: str) -> DataFrame:
    """``(raw_file, text, offset)`` of each physical line, numbered from 0 in its file.

    Files are split as usual: a line's number is its place in its block plus the
    lines of the blocks before, which a first pass counts. Where the blocks are at
    most a million (128 TB of text in blocks of 128 MB), which is counted, their
    beginnings are broadcast and no text is shuffled; more are joined by block.
    """
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("raw_file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("text")
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            at = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = n + 1 if key == last else 0
                last = key
                at.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=["raw_file", "block", "text", "place"])

    counts = raw.groupBy("raw_file", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("raw_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("raw_file", "block", F.coalesce(before, F.lit(0)).alias("start"))
    starts = cut(starts, "blocks")
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_BLOCKS else starts
    numbered = raw.mapInArrow(number, "raw_file string, block long, text string, place long")
    return numbered.join(starts, ["raw_file", "block"]).select("raw_file", "text", (F.col("start") + F.col("place")).alias("offset"))


def _json_line(text: str) -> Iterator[tuple[int, dict]]:
    try:
        found = problem(json.loads(text)) if text.strip() else None
    except (ValueError, RecursionError):
        found = None
    if found:
        yield 0, found


def read_jsonl(spark: SparkSession, src: Source) -> DataFrame:
    return _parsed(lines_with_numbers(spark, src.path), _json_line, src, "parse_jsonl_v1")


def _files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("raw_file"), F.col("value").alias("text"))


def _json_document(text: str) -> Iterator[tuple[int, dict]]:
    try:
        root = json.loads(text)
    except (ValueError, RecursionError):
        return
    if isinstance(root, dict):
        root = next((root[k] for k in ("questions", "problems", "data") if root.get(k)), [root])
    for at, obj in enumerate(root if isinstance(root, list) else []):
        if found := problem(obj, documents=True):
            yield at, found


def read_json(spark: SparkSession, src: Source) -> DataFrame:
    """Whole JSON files: a list, or an object with one under ``questions``, ``problems`` or ``data``, or one problem."""
    return _parsed(_files(spark, src.path).withColumn("offset", F.lit(0)), _json_document, src, "parse_json_v1")


def _csv(text: str) -> Iterator[tuple[int, dict]]:
    for at, row in enumerate(csv.DictReader(io.StringIO(text, newline=""))):
        low = {k.lower(): v for k, v in row.items() if isinstance(k, str)}
        get = lambda f: next((low[a] for a in ALIASES[f] if low.get(a)), None)  # noqa: B023, E731
        if get("title"):
            yield at, {
                "title": get("title"), "description": get("description") or "", "difficulty": get("difficulty"),
                "tags": as_list(get("tags"), ","), "examples_raw": [], "constraints": as_list(get("constraints"), ";"),
                "solution_code": get("solution_code"), "solution_language": get("solution_language"), "is_premium": False,
                "extra": json.dumps(low, ensure_ascii=False),
            }


def read_csv(spark: SparkSession, src: Source) -> DataFrame:
    """CSV files with a header in any case; tags are split at commas, constraints at semicolons."""
    return _parsed(_files(spark, src.path).withColumn("offset", F.lit(0)), _csv, src, "parse_csv_v1")


#: Kinds of pages: what reads one, and the parser's name.
PAGES: dict[str, tuple[Callable[[str], dict | None], str]] = {"html": (html_problem, "parse_html_v1"), "markdown": (markdown_problem, "parse_markdown_v1")}


def read_pages(pages: DataFrame, src: Source) -> DataFrame:
    """Problems of pages that are a table already (raw_file, text, offset), as crawls of more pages than files keep them."""
    parse, parser = PAGES[src.kind]
    return _parsed(pages.select("raw_file", "text", "offset"), lambda t: ((0, p) for p in [parse(t)] if p), src, parser)


def read_html(spark: SparkSession, src: Source) -> DataFrame:
    """HTML pages; the offset is the page's place among the files in the order of their paths."""
    files = _files(spark, src.path, None if src.path.endswith(".html") else "*.html")
    return read_pages(_numbered(files, "raw_file"), Source("html", src.path, src.name, src.license, src.url, src.commit_hash))


def _numbered(files: DataFrame, key: str) -> DataFrame:
    """With each row's place in the order of ``key``, found over the keys alone.

    Ranges of keys are numbered side by side and then shifted by what comes before.
    """
    keys = files.select(key).distinct().repartitionByRange(key).sortWithinPartitions(key).withColumn("part", F.spark_partition_id())
    inner = keys.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(key)) - 1)
    sizes = inner.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    place = inner.join(before, "part").select(key, (F.col("place") + F.col("start")).alias("offset"))
    return files.join(place, key).select(key, "text", "offset")


def git_commit(path: str) -> str | None:
    """HEAD of the repository that holds ``path``, null if there is none."""
    try:
        run = subprocess.run(["git", "-C", path, "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10)
    except (OSError, subprocess.SubprocessError):
        return None
    return run.stdout.strip() or None if run.returncode == 0 else None


def read_markdown(spark: SparkSession, src: Source) -> DataFrame:
    """One problem a folder with a marked README, the English one before the other; the offset is the folder's place."""
    src = src if src.commit_hash else Source(src.kind, src.path, src.name, src.license, src.url, git_commit(src.path))
    files = _files(spark, src.path, "README*.md").where(
        ~F.col("raw_file").contains("/.git/") & F.col("text").contains("<!-- problem:start -->") & F.col("raw_file").rlike(r"/README(_EN)?\.md$")
    )
    folder = F.regexp_replace("raw_file", "/[^/]*$", "")
    english = F.col("raw_file").endswith("_EN.md")
    one = files.withColumn("folder", folder).groupBy("folder").agg(F.max_by("text", english).alias("text"))
    pages = _numbered(one, "folder").withColumnRenamed("folder", "raw_file")
    return read_pages(pages, Source("markdown", src.path, src.name, src.license, src.url, src.commit_hash))


READERS: dict[str, Callable[[SparkSession, Source], DataFrame]] = {
    "jsonl": read_jsonl, "json": read_json, "csv": read_csv, "html": read_html, "markdown": read_markdown,
}


def register(kind: str, reader: Callable[[SparkSession, Source], DataFrame]) -> None:
    READERS[kind] = reader


def read(spark: SparkSession, src: Source) -> DataFrame:
    if src.kind not in READERS:
        raise ValueError(f"unknown kind of source {src.kind!r}; known are {', '.join(sorted(READERS))}")
    return READERS[src.kind](spark, src)


def read_all(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """All sources with their place in the list as ``source_idx``."""
    out = None
    for k, src in enumerate(sources):
        df = read(spark, src).withColumn("source_idx", F.lit(k))
        out = df if out is None else out.unionByName(df)
    return out if out is not None else spark.createDataFrame([], RAW).withColumn("source_idx", F.lit(0))


def read_problems(spark: SparkSession, path: str) -> DataFrame:
    """``(offset, problem)`` objects of a problems file as JSON: lines, a list, ``{"records": [..]}`` or ``{"problems": [..]}``, or one object."""
    lines = path.endswith((".jsonl", ".ndjson"))
    rows = lines_with_numbers(spark, path).select("text", "offset") if lines else _files(spark, path).select("text", F.lit(0).alias("offset"))

    def run(batches):
        for batch in batches:
            out = []
            for text, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    v = json.loads(text)
                except (ValueError, RecursionError):
                    continue
                if isinstance(v, dict) and not lines:
                    v = next((v[k] for k in ("records", "problems") if isinstance(v.get(k), list)), [v])
                v = v if isinstance(v, list) else [v]
                out += [{"offset": offset + k, "problem": json.dumps(x, ensure_ascii=False)} for k, x in enumerate(v) if isinstance(x, dict)]
            yield pa.RecordBatch.from_pylist(out, pa.schema([("offset", pa.int64()), ("problem", pa.string())]))

    return rows.mapInArrow(run, "offset long, problem string")

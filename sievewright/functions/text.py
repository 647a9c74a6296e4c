"""Column functions over titles, descriptions, tags and code."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Difficulty spellings.
DIFFICULTIES = {
    "easy": "easy", "e": "easy", "1": "easy", "简单": "easy",
    "medium": "medium", "med": "medium", "m": "medium", "2": "medium", "中等": "medium",
    "hard": "hard", "h": "hard", "3": "hard", "困难": "hard",
}
#: Tag aliases, by the alias without anything but letters and digits.
TAGS = {
    "array": "array", "arrays": "array", "hashmap": "hash-map", "hashtable": "hash-map", "dict": "hash-map",
    "string": "string", "strings": "string", "dp": "dynamic-programming", "dynamicprogramming": "dynamic-programming",
    "graph": "graph", "graphs": "graph", "tree": "tree", "trees": "tree", "binarytree": "binary-tree",
    "linkedlist": "linked-list", "twopointers": "two-pointers", "twopointer": "two-pointers",
    "slidingwindow": "sliding-window", "greedy": "greedy", "backtracking": "backtracking", "recursion": "recursion",
    "math": "math", "sorting": "sorting", "binarysearch": "binary-search", "stack": "stack", "queue": "queue",
    "heap": "heap", "priorityqueue": "heap", "bfs": "bfs", "dfs": "dfs", "bitmanipulation": "bit-manipulation",
    "trie": "trie", "unionfind": "union-find", "disjointset": "union-find",
}
#: Words that don't block candidates, and those left out of labels.
BLOCKING_STOPWORDS = (
    "a an the of in to for with on at from by and or is it ii iii iv v i find number maximum minimum count".split()
)
LABEL_STOPWORDS = (
    "a an the in on of to for with and or by at from as is are was were be been it this that how what which given "
    "find return determine calculate check using use".split()
)
#: Fixed value: endings that tell sequels of a problem apart.
SEQUEL = r"(?i)\s+(?:(?:I{1,3}|IV|V|VI)|Part\s+\d+|Part\s+(?:One|Two|Three|Four|Five))\s*$"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (``trim`` knows spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[c]


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def clean_text(c: Column, entities: bool = True) -> Column:
    """Without markup, entities resolved, white space put in order; null gives an empty string.

    Only texts with an ampersand go through Python.
    """
    c = F.coalesce(c, F.lit(""))
    if entities:
        c = F.when(c.contains("&"), unescape(c)).otherwise(c)
    c = F.regexp_replace(c, "<[^>]+>", " ")
    c = F.regexp_replace(c, r"[ \t]+", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def difficulty(c: Column) -> Column:
    return F.coalesce(lookup(F.lower(strip(c)), DIFFICULTIES), F.lit("unknown"))


def tag(c: Column) -> Column:
    low = F.lower(strip(c))
    return F.coalesce(lookup(F.regexp_replace(low, "[^a-z0-9]", ""), TAGS), F.translate(low, " _", "--"))


def tags(c: Column) -> Column:
    """Canonical tags in their first order, each once; ``unknown`` where none is left."""
    known = F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))
    out = F.array_distinct(F.filter(F.transform(known, tag), lambda t: t != ""))
    return F.when(F.size(out) > 0, out).otherwise(F.array(F.lit("unknown")))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def title_key(c: Column) -> Column:
    return F.array_join(tokens(c), " ")


def content_hash(title: Column, description: Column) -> Column:
    low = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.sha2(F.concat(low(title), F.lit("\n"), low(description)), 256)


def code_signature(code: Column) -> Column:
    """Hash of the code without comments and with white space as one blank; empty for no code."""
    bare = F.regexp_replace(code, "(?m)#.*$", "")
    bare = strip(F.regexp_replace(bare, r"(?U)\s+", " "))
    return F.when(code.isNull() | (code == ""), "").otherwise(F.sha2(bare, 256))


def sequel_base(title: Column) -> Column:
    return F.lower(strip(F.regexp_replace(title, SEQUEL, "")))


def is_sequel_pair(a: Column, b: Column) -> Column:
    """Titles that differ, but not once sequel endings are gone."""
    return (F.lower(strip(a)) != F.lower(strip(b))) & (sequel_base(a) == sequel_base(b)) & (sequel_base(a) != "")


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 where one is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / F.size(F.array_union(a, b)))


def compose_text(title: Column, description: Column, examples: Column) -> Column:
    """The text that is embedded: title, 2000 characters of description, two examples."""
    some = F.transform(
        F.slice(examples, 1, 2),
        lambda e: F.concat(F.lit("Input: "), F.coalesce(e["input"], F.lit("")), F.lit("\nOutput: "), F.coalesce(e["output"], F.lit(""))),
    )
    none = lambda c: F.nullif(c, F.lit(""))
    return F.concat_ws("\n", strip(F.coalesce(title, F.lit(""))), none(strip(F.substring(description, 1, 2000))), none(F.array_join(some, "\n")))


def python_title(c: Column) -> Column:
    """Python's ``str.title``: a capital after anything that is no letter."""
    return F.array_join(
        F.transform(F.regexp_extract_all(c, F.lit(r"[\p{L}]+|[^\p{L}]+"), F.lit(0)), F.initcap), ""
    )

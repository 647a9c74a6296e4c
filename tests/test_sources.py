import json

import pytest

from sievewright.sources import readers
from sievewright.sources.readers import Source, parse_spec, read, read_all, read_problems

PAGE = """---
difficulty: Easy
tags:
  - Array
---
<!-- problem:start -->

# [1. Two Sum{mark}](https://example.invalid/1)

## Description

<!-- description:start -->
<p>Find x<sup>2</sup> &amp; more.</p>
<p><strong>Example 1:</strong></p>
<pre>
<strong>Input:</strong> nums = [2,7]
<strong>Output:</strong> [0,1]
<strong>Explanation:</strong> because
</pre>
<p><strong>Constraints:</strong></p>
<ul><li>1 &lt;= n</li><li><code>m</code> &gt; 2</li></ul>
<!-- description:end -->

## Solutions

#### Java

```java
class S {{}}
```

#### Python3

```python
class Solution: pass
```
<!-- solution:end -->
"""


def test_jsonl_fields_and_offsets(spark, tmp_path):
    rows = [
        {"name": "A", "content": "text", "level": 2, "topics": "x, y", "test_cases": {"in": 1, "expected": 0, "explanation": "e"}, "code": "print()"},
        {"problem_slug": "b-c", "tags": [1, "z"], "constraints": "one", "examples": [{"input": "i"}, {"input": "i", "output": "o"}]},
    ]
    (tmp_path / "p.jsonl").write_text("\n" + json.dumps(rows[0]) + "\n{bad\n  \n" + json.dumps(rows[1]) + "\n" + "[]\n")
    got = sorted(read(spark, Source("jsonl", str(tmp_path / "p.jsonl"), "s", "MIT", "u")).collect(), key=lambda r: r.raw_offset)
    a, b = got
    assert (a.title, a.description, a.difficulty, a.tags, a.solution_language, a.raw_offset) == ("A", "text", "2", ["x", "y"], "python", 1)
    assert a.examples_raw == [] and (a.license, a.source_url, a.parser) == ("MIT", "u", "parse_jsonl_v1")
    assert (b.title, b.tags, b.constraints, b.raw_offset) == ("B C", ["1", "z"], ["one"], 4) and b.examples_raw == [{"input": "i", "output": "o"}]


def test_jsonl_split_over_blocks_keeps_line_numbers(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text("".join(json.dumps({"title": f"t{k}", "description": "x" * (k % 90)}) + "\n" for k in range(4000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read(spark, Source("jsonl", str(tmp_path), "s")).select("title", "raw_offset").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {(r.title, r.raw_offset) for r in rows} == {(f"t{k}", k) for k in range(4000)}


@pytest.mark.parametrize("root", [lambda x: x, lambda x: {"questions": x}, lambda x: {"problems": x}, lambda x: {"questions": [], "data": x}])
def test_json_roots(spark, tmp_path, root):
    items = [3, {"title": "A", "examples": [{"example_text": "Input: a = 1\nOutput: 2\nExplanation: why"}], "code_snippets": {"java": "j", "python3": "p"}}]
    (tmp_path / "p.json").write_text(json.dumps(root(items)))
    r = read(spark, Source("json", str(tmp_path / "p.json"), "s")).first()
    assert (r.title, r.raw_offset, r.solution_code, r.solution_language) == ("A", 1, "p", "python")
    assert r.examples_raw == [{"input": "a = 1", "output": "2", "explanation": "why"}]


def test_html(spark, tmp_path):
    (tmp_path / "b.html").write_text("<html><head><title>Page</title></head><body><article><p>one</p>two<br>three</article><span class='tag-x'>dp</span></body></html>")
    (tmp_path / "a.html").write_text("<body><h1> Head <b>line</b></h1><div class='main description'>text &amp; more<script>no</script></div><i class='advantage'>t</i></body>")
    (tmp_path / "c.html").write_text("<body>no title</body>")
    (tmp_path / "d.txt").write_text("<h1>not a page</h1>")
    a, b = sorted(read(spark, Source("html", str(tmp_path), "s")).collect(), key=lambda r: r.raw_offset)
    assert (a.raw_offset, a.description, a.tags) == (0, "text & more", ["t"])
    assert (b.raw_offset, b.title, b.description, b.tags) == (1, "Page", "one\ntwo\nthree", ["dp"])


def test_markdown(spark, tmp_path):
    for folder, name, text in [
        ("0001.Two Sum", "README_EN.md", PAGE.format(mark=" 🔒")), ("0001.Two Sum", "README.md", PAGE.format(mark="").replace("Two Sum", "两数之和")),
        ("zh", "README.md", PAGE.format(mark="").replace("1. Two Sum", "LCP 01. 猜数字").replace("Easy", "简单").replace("Input", "输入").replace("Output", "输出").replace("Explanation", "解释")),
        ("index", "README.md", "# no problem"), (".git/x", "README.md", PAGE.format(mark="")),
    ]:
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    en, zh = sorted(read(spark, Source("markdown", str(tmp_path), "s", commit_hash="c0ffee")).collect(), key=lambda r: r.raw_offset)
    assert (en.title, en.is_premium, en.difficulty, en.tags, en.commit_hash, en.raw_offset) == ("Two Sum", True, "Easy", ["Array"], "c0ffee", 0)
    assert en.solution_code == "class Solution: pass" and en.solution_language == "python"
    assert en.examples_raw == [{"input": "nums = [2,7]", "output": "[0,1]", "explanation": "because"}] == zh.examples_raw
    assert en.constraints == ["1 <= n", "m > 2"] and en.description.startswith("Find x^2 & more.")
    assert (zh.title, zh.difficulty) == ("猜数字", "简单")


def test_specs_registry_and_problems(spark, tmp_path):
    assert parse_spec("jsonl:/p:n:MIT:http://x:1") == Source("jsonl", "/p", "n", "MIT", "http://x:1")
    with pytest.raises(ValueError):
        parse_spec("jsonl:/p")
    with pytest.raises(ValueError):
        read(spark, Source("parquet", "/p", "n"))
    readers.register("own", lambda s, src: read_all(s, []).drop("source_idx"))
    assert read(spark, Source("own", "", "n")).count() == 0
    (tmp_path / "r.json").write_text('{"records": [{"id": 1}, 2, {"id": 3}]}')
    (tmp_path / "r.ndjson").write_text('{"id": 1}\nbad\n{"id": 2}\n')
    assert [r.offset for r in read_problems(spark, str(tmp_path / "r.json")).collect()] == [0, 2]
    assert sorted(r.offset for r in read_problems(spark, str(tmp_path / "r.ndjson")).collect()) == [0, 2]

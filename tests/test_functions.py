import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.functions import policy, text, values, vectors


def one(spark, ddl, row, *cols):
    return spark.createDataFrame([row], ddl).select(*cols).first()


@pytest.mark.parametrize(
    "raw,clean", [(None, ""), ("", ""), ("<p>a &amp; b</p>\n\n\n\nc\t d\xa0", "a & b \n\nc d"), ("1 &lt; x and y &gt; 2", "1 2")]
)
def test_clean_text(spark, raw, clean):
    assert one(spark, "t string", (raw,), text.clean_text(F.col("t")))[0] == clean


@pytest.mark.parametrize("raw,level", [(" Easy ", "easy"), ("2", "medium"), ("困难", "hard"), ("", "unknown"), (None, "unknown"), ("?", "unknown")])
def test_difficulty(spark, raw, level):
    assert one(spark, "t string", (raw,), text.difficulty(F.col("t")))[0] == level


@pytest.mark.parametrize(
    "raw,out", [(["DP", "Hash Table", "dp", None, ""], ["dynamic-programming", "hash-map"]), ([], ["unknown"]), (None, ["unknown"]), (["My_own tag"], ["my-own-tag"])]
)
def test_tags(spark, raw, out):
    assert one(spark, "t array<string>", (raw,), text.tags(F.col("t")))[0] == out


def test_code_signature_ignores_comments_not_code(spark):
    sig = lambda c: one(spark, "c string", (c,), text.code_signature(F.col("c")))[0]
    assert sig("# head\n# more\nx = 1\n") == sig("x =  1 # tail") != sig("x = 2")
    assert sig("") == sig(None) == "" != sig("# only a comment")


@pytest.mark.parametrize(
    "a,b,sequel", [("Two Sum", "Two Sum II", True), ("Two Sum II", "Two Sum Part 3", True), ("Two Sum", "two sum", False), ("Two Sum", "Three Sum", False)]
)
def test_sequels(spark, a, b, sequel):
    assert one(spark, "a string, b string", (a, b), text.is_sequel_pair(F.col("a"), F.col("b")))[0] == sequel


def test_jaccard_and_cosine(spark):
    assert one(spark, "a array<string>, b array<string>", (["x", "y"], ["y", "z"]), text.jaccard(F.col("a"), F.col("b")))[0] == pytest.approx(1 / 3)
    assert one(spark, "a array<string>, b array<string>", ([], ["y"]), text.jaccard(F.col("a"), F.col("b")))[0] == 0
    cos = lambda a, b: one(spark, "a array<float>, b array<float>", (a, b), vectors.cosine(F.col("a"), F.col("b")))[0]
    assert cos([3.0, 4.0], [6.0, 8.0]) == pytest.approx(1) and cos([1.0], [1.0, 0.0]) == 0 == cos([], [])
    assert cos([1.0, 0.0], [-1.0, 0.0]) == 0 == cos([0.0], [0.0])


def test_compose_and_titles(spark):
    ex = [("1", "2"), ("3", "4"), ("5", "6")]
    got = one(spark, "t string, d string, e array<struct<input:string,output:string>>", ("T", " d ", ex), text.compose_text(F.col("t"), F.col("d"), F.col("e")))[0]
    assert got == "T\nd\nInput: 1\nOutput: 2\nInput: 3\nOutput: 4"
    got = one(spark, "t string, d string, e array<struct<input:string,output:string>>", ("T", None, None), text.compose_text(F.col("t"), F.col("d"), F.col("e")))[0]
    assert got == "T"
    assert one(spark, "t string", ("it's 3rd two-sum",), text.python_title(F.col("t")))[0] == "It'S 3Rd Two-Sum"


@pytest.mark.parametrize("name,flags", [("MIT", (False, True, False)), (" Educational", (False, False, True)), (None, (True, False, True)), ("own", (True, False, True))])
def test_license(spark, name, flags):
    m = one(spark, "l string", (name,), policy.license_meta(F.col("l")))[0]
    assert (m.requires_legal_review, m.public_allowed, m.internal_use_only) == flags


def test_split_and_kwargs():
    assert values.parse_kwargs("a = [[1,3],[2,6]], s = 'x,y', t = (1, 2), u = null") == {"a": [[1, 3], [2, 6]], "s": "x,y", "t": (1, 2), "u": None}
    assert values.parse_kwargs("no name, , =") == {"": ""}
    assert values.canonical({"a": ((1, 2), [3])}) == {"a": [[1, 2], [3]]}


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(max_size=3), c, max_size=3)))
def test_json_values_come_back(v):
    import json

    assert values.parse_value(json.dumps(v)) == v


def test_schema_inference():
    ins, outs, conf = values.infer_schema([{"input": "nums = [2,7], target = 9", "output": "[0, 1]"}, {"input": "nums = [3], target = 6", "output": "[0]"}])
    assert ins["properties"] == {"nums": {"type": "array<integer>"}, "target": {"type": "integer"}} and outs == {"type": "array<integer>"}
    assert conf == round(0.5 * 0.85 + 0.5 * (0.9 + 0.8) / 2, 3)
    assert values.infer_schema([]) == ({}, {}, 0.0) == values.infer_schema(None)
    assert values.infer_schema([{"input": "1", "output": "true"}])[:2] == ({"type": "integer"}, {"type": "boolean"})


def test_fence_free():
    assert values.fence_free('```json\n{"a": {"b": 1}}\n```') == '{"a": {"b": 1}}'
    assert values.fence_free("text") == "text" and values.fence_free('so: {"a": 1} yes') == '{"a": 1}'


def test_nested_lists_stay_whole():
    ins, _, _ = values.infer_schema([{"input": "intervals = [[1,3],[2,6]], k = 2", "output": "1"}])
    assert ins["properties"] == {"intervals": {"type": "array<array<integer>>"}, "k": {"type": "integer"}}
    assert values.parse_side("nums = [1,2], foo") == ({"nums": [1, 2]}, 0.85)
    assert values.parse_side("a = 1, = 2") == ("a = 1, = 2", 0.5)


@pytest.mark.parametrize("text", ["nan", "inf", "1_000", "1e5", "+3", "0x1", "- 1", "9" * 5000])
def test_only_plain_numbers_are_numbers(text):
    assert values.scalar(text) == text


@given(st.lists(st.recursive(st.integers() | st.text(max_size=3) | st.none() | st.booleans(), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(max_size=2), c, max_size=3)), min_size=1, max_size=5))
def test_shapes_join_in_any_grouping(vs):
    from functools import reduce

    one = [values.Shape.of(v) for v in vs]
    left = reduce(values.Shape.__or__, one)
    right = one[-1]
    for s in reversed(one[:-1]):
        right = s | right
    assert left.kind == right.kind and left.fields == right.fields

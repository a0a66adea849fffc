import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions import structured as S


@pytest.fixture(scope="module")
def ev(spark):
    def run(f, values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
        return [r.x for r in rows.select("i", f(F.col("s")).alias("x")).orderBy("i").collect()]

    return run


def text(v):
    return F.to_json(v)


def test_strict_json(ev):
    values = ['{"a": 1}', "[1]", '{"a": 1} x', '{"a": 1}{"b": 2}', '{"a": "}"}', '{"a": [1, 2}', "x", "", None, ' {"a": {"b": []}} ', '{"a": "\\"}"}']
    got = ev(lambda s: S.strict_json(s).isNotNull(), values)
    assert got == [True, True, False, False, True, False, False, False, False, True, True]


def test_strict_json_agrees_with_python(spark, ev):
    @settings(max_examples=1, deadline=None)
    @given(st.lists(st.recursive(st.none() | st.booleans() | st.integers(-99, 99) | st.text("ab{}[]\\\"", max_size=5), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("ab", min_size=1, max_size=2), x, max_size=3), max_leaves=6).filter(lambda x: isinstance(x, dict | list)), min_size=20, max_size=30))
    def run(values):
        texts = [json.dumps(v) for v in values]
        broken = [t[:-1] for t in texts] + [t + "}" for t in texts] + [t + " x" for t in texts]
        assert all(ev(lambda s: S.strict_json(s).isNotNull(), texts))
        assert not any(ev(lambda s: S.strict_json(s).isNotNull(), broken))

    run()


def test_model_json(ev):
    values = ['<think>{"a": 0}</think>```json\n{"a": 1}\n```', 'Sure:\n```json\n{"a": 2}\n```\ndone', 'so {"a": 3} it is', "nothing", None]
    assert ev(lambda s: F.try_variant_get(S.model_json(s), "$.a", "int"), values) == [1, 2, 3, None, None]


def test_lists(ev):
    values = ["[1, 2]", '{"a": 1}', "see [3] here", "bad", ""]
    assert ev(lambda s: F.size(S.json_list(s)), values) == [2, 1, 1, 0, 0]
    assert ev(lambda s: text(S.first_of_list(s)), values) == ["1", '{"a":1}', "3", None, None]
    assert ev(S.salvage_json, ["x [1] {2} y"]) == ["[1] {2}"]
    assert ev(lambda s: text(S.first_with(s, "score")), ['{"a": 1} {"score": {"b": 2}} {"score": 3}', "none"]) == ['{"score":{"b":2}}', None]


def test_scores(ev):
    values = ['{"score": 1}', '{"score": "1"}', '{"score": "0.5"}', '{"score": "abc"}', "{}", "bad", '{"score": 0.7}', '{"score": 0}']
    v = S.strict_json
    assert [tuple(x) for x in ev(lambda s: S.score(v(s)), values)] == [(1.0, 0), (1.0, 0), (0.5, 0), (1.0, 1), (1.0, 1), (1.0, 1), (0.7, 0), (0.0, 0)]
    assert ev(lambda s: S.digit_score(v(s)), values) == [1, 1, 0, 1, 1, 1, 0, 0]
    assert ev(lambda s: S.binary_score(v(s), safe=1), values) == [1, 1, 1, 1, 1, 1, 1, 0]
    assert ev(lambda s: S.score_list(v(s)), ['{"tool_score_list": [1, "0.5", "x", null]}', "{}"]) == [[1.0, 0.5], None]


JSON5 = {
    '{"a": [1, 2.5, "x"]}': '{"a":[1,2.5,"x"]}',
    "```json\n{a: 1, 'b': 'x' /* c */}\n```": '{"a":1,"b":"x"}',
    "{a: [1, 2,], b: {c: 0xfF,},}": '{"a":[1,2],"b":{"c":255}}',
    "{a: +1, b: -.5, c: 5., d: 1e3, e: -0x10}": '{"a":1,"b":-0.5,"c":5,"d":1000.0,"e":-16}',
    "{$x_1: 'it\\'s \\x41\\u0042 \\\nline', \\u0061b: \"\\v\"}": '{"$x_1":"it\'s AB line","ab":"\\u000B"}',
    "// only\n[null, true, /* , */ false, Infinity, NaN]": "[null,true,false,null,null]",
    "{null: null, true: 1}": '{"null":null,"true":1}',
    "{a: 1} x": None, "{a: b}": None, "[1,,2]": None, "[,]": None, "{,}": None, "{a 1}": None, "'open": None, "0123": None, "/* open": None, "": None,
}


def test_loose_json_and_arguments(ev):
    as_text = lambda s: F.to_json(S.loose_json(s))
    assert ev(as_text, [*JSON5, None]) == [*JSON5.values(), None]
    assert ev(lambda s: S.as_string(F.try_parse_json(s)), ['"x"', '{"a":1}']) == ["x", '{"a":1}']
    assert ev(lambda s: S.call_id(s, F.lit(3)), ["id", "", None]) == ["id", "call_3", "call_3"]
    assert ev(S.null_word, ["null", "None", "", "x", None]) == [None, None, None, "x", None]
    assert ev(S.truthy, ["", None, "0", "x"]) == [False, False, True, True]


def test_arrays(ev):
    split = lambda s: F.split(s, ",")
    assert ev(lambda s: S.mean(F.transform(split(s), lambda x: x.cast("int"))), ["1,2"]) == [1.5]
    assert ev(lambda s: S.mean(F.array().cast("array<int>")), ["x"]) == [None]
    assert ev(lambda s: S.ints(split(s)), ["1,a,02"]) == [[1, 2]]
    assert ev(lambda s: S.subset(split(s), F.array(F.lit("a"), F.lit("b"))), ["a", "a,c"]) == [True, False]
    assert [[tuple(p) for p in x] for x in ev(lambda s: S.pairs(split(s)), ["a,b,c", "a"])] == [[("a", "b"), ("b", "c")], []]
    assert ev(lambda s: S.last_n(split(s), 2), ["a,b,c", "a"]) == [["b", "c"], ["a"]]
    assert ev(lambda s: S.put(F.create_map(F.lit("a"), F.lit("1")), "a", s), ["2"]) == [{"a": "2"}]
    base, new = F.create_map(F.lit("stop"), F.array(F.lit("x")), F.lit("k"), F.array(F.lit("1"))), F.create_map(F.lit("stop"), F.array(F.lit("x"), F.lit("y")))
    assert ev(lambda s: S.merge_configs(base, new, "stop"), ["-"]) == [{"k": ["1"], "stop": ["x", "y"]}]
    assert ev(lambda s: S.same_list(split(s), F.array(F.lit("a"), F.lit("b"))), ["a,b", "b,a", None]) == [True, False, False]


def test_numbers_and_choices(spark, ev):
    assert ev(lambda s: S.half_even(s.cast("double")), ["0.0625", "0.1875"]) == [0.062, 0.188]
    assert ev(lambda s: S.rrf_weight(s.cast("int")), ["1"]) == [1 / 61]
    assert ev(lambda s: S.backoff(s.cast("int")), ["0", "3", "20"]) == [1.0, 8.0, 300.0]
    rows = spark.range(10_000)
    share = rows.filter(S.coin(3, 0.2, F.col("id"))).count() / 10_000
    assert 0.18 < share < 0.22
    picks = rows.groupBy(S.pick(3, 4, F.col("id")).alias("p")).count().collect()
    assert {r.p for r in picks} == {0, 1, 2, 3} and all(2200 < r["count"] < 2800 for r in picks)
    assert ev(lambda s: S.choice(F.array().cast("array<string>"), 1, s), ["a"]) == [None]
    assert all(0 <= x < 10_000 for x in ev(S.call_number, ["a", "b"]))


def test_python_text(ev):
    from weftline.functions import code

    got = ev(code.first_signature, ["x = 1\ndef f(a, b=2, *, c):\n    pass\ndef g(): pass", "bad(", "", None])
    assert [(r.name, r.params) for r in got] == [("f", ["a", "b", "c"]), (None, None), (None, None), (None, None)]
    assert ev(code.literal_as_json, ["{'a': 1}", '{"a": true}', "__import__('os')", None, "x y"]) == ['{"a": 1}', '{"a": true}', None, None, None]

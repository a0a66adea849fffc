"""Tools registered from rows of a catalogue, and what they refuse."""

import json

import pytest
from pyspark.errors import PySparkException

from weftline.models import tools

RULES = json.dumps({"type": "object", "properties": {"user_id": {"type": "integer"}, "value": {"type": "number"}, "note": {"type": "string"}}, "required": ["user_id", "value"], "additionalProperties": False})


def catalogue(spark, *names):
    return spark.createDataFrame([(n, "d", RULES, "totals", "user_id bigint, n bigint, total double") for n in names], "name string, description string, parameters string, function string, returns string")


def test_a_tool_is_called_by_name(spark):
    assert tools.register(spark, catalogue(spark, "t_b", "t_a")) == ["t_a", "t_b"]
    calls = spark.createDataFrame([(1, 2.0), (1, None), (2, 5.0)], "user_id int, value double")
    got = spark.sql("SELECT * FROM t_a(TABLE({calls}) PARTITION BY (user_id), 'user_id', 'value')", calls=calls).collect()
    assert sorted(map(tuple, got)) == [(1, 2, 2.0), (2, 1, 5.0)]
    assert spark.sql("SELECT * FROM t_a(TABLE({calls}) PARTITION BY (user_id), 'user_id', 'value')", calls=calls.limit(0)).count() == 0


@pytest.mark.parametrize("columns,said", [("user_id int", "value is missing"), ("user_id string, value double", "user_id is no integer"), ("user_id int, value double, other int", "other is unknown")])
def test_a_wrong_call_is_refused_while_planning(spark, columns, said):
    tools.register(spark, catalogue(spark, "t_c"))
    with pytest.raises(PySparkException, match=said):
        spark.sql("SELECT * FROM t_c(TABLE({calls}) PARTITION BY (user_id), 'user_id', 'value')", calls=spark.createDataFrame([], columns))


def test_names(spark):
    with pytest.raises(ValueError):
        tools.register(spark, catalogue(spark, "x", "x"))
    with pytest.raises(ValueError):
        tools.register(spark, catalogue(spark, "no name"))
    with pytest.raises(ValueError):
        tools.function("totals")(lambda calls: iter(()))


def test_a_searcher_of_ones_own(spark):
    @tools.function("first_words", replace=True)
    def first_words(chunks, asked):
        for c in chunks:
            if (c["text"] or "").startswith(asked):
                yield c["doc_id"], c["chunk_id"], 1.0

    tools.searcher(spark, "by_first_words", "first_words")
    chunks = spark.createDataFrame([(1, 0, "ab c"), (1, 1, "x ab"), (2, 0, None), (2, 1, "abc")], "doc_id bigint, chunk_id int, text string")
    got = spark.sql("SELECT * FROM by_first_words(TABLE({c}) PARTITION BY (doc_id), 'ab')", c=chunks).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1.0), (2, 1, 1.0)]

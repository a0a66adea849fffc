"""Tools and searchers as SQL table functions, made at run time.

A tool is a row of a catalogue: name, description, parameters (a JSON schema),
function and returns (a DDL schema). `register` turns it into a Python UDTF that
is called by its name, over a table argument dealt out by key:

    SELECT * FROM tool_click(TABLE(calls) PARTITION BY (user_id), 'user_id', 'value')

Its columns are the arguments: `analyze` checks them against the schema while the
query is planned, so that a call with a missing or mistyped argument never runs.
Functions fold the calls of a key to rows; they are named in FUNCTIONS, which
`function` extends. A searcher is a tool whose function scores chunks."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegralType, NumericType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

#: name: a function of the calls of one key (dicts, in order) and the scalar arguments to rows.
FUNCTIONS: dict[str, Callable[..., Iterator[tuple]]] = {}

#: What a JSON schema calls Spark's types.
_KINDS: dict[str, tuple[type[DataType], ...]] = {"integer": (IntegralType,), "number": (NumericType, DoubleType, FloatType), "string": (StringType,), "boolean": (BooleanType,), "array": (ArrayType,), "object": (StructType,)}


def function(name: str, replace: bool = False):
    """Names a function; a name is taken once unless it is replaced."""

    def keep(f):
        if name in FUNCTIONS and not replace:
            raise ValueError(f"function {name} is there already")
        FUNCTIONS[name] = f
        return f

    return keep


def problems(parameters: dict, columns: dict[str, DataType]) -> list[str]:
    """What is wrong with a call whose arguments are these columns."""
    known = parameters.get("properties", {})
    out = [f"argument {name} is missing" for name in parameters.get("required", []) if name not in columns]
    out += [f"argument {name} is unknown" for name in columns if name not in known and parameters.get("additionalProperties", True) is False]
    out += [f"argument {name} is no {known[name]['type']}" for name, kind in columns.items() if name in known and known[name].get("type") in _KINDS and not isinstance(kind, _KINDS[known[name]["type"]])]
    return out


def tool_class(name: str, description: str, parameters: str, function: str, returns: str) -> type:
    """The class of a tool; its schema and function travel with it."""
    rules, work, schema = json.loads(parameters), FUNCTIONS[function], StructType.fromDDL(returns)

    class Tool:
        def __init__(self):
            self._calls, self._extra = [], ()

        @staticmethod
        def analyze(calls: AnalyzeArgument, *extra: AnalyzeArgument) -> AnalyzeResult:
            if not calls.isTable:
                raise ValueError(f"{name} takes a table of calls")
            wrong = problems(rules, {f.name: f.dataType for f in calls.dataType.fields})
            if wrong:
                raise ValueError(f"{name}: {'; '.join(wrong)}")
            return AnalyzeResult(schema=schema)

        def eval(self, call, *extra):
            self._calls.append(call.asDict())
            self._extra = extra

        def terminate(self):
            if self._calls:
                yield from work(self._calls, *self._extra)

    Tool.__name__, Tool.__doc__ = name, description
    return Tool


def register(spark: SparkSession, catalogue: DataFrame) -> list[str]:
    """Registers every tool of the catalogue, a row a tool; their names. A name
    that is there twice, or is no name in SQL, is refused."""
    rows = catalogue.select("name", "description", "parameters", "function", "returns").orderBy("name").collect()
    names = [r.name for r in rows]
    bad = [n for n, times in Counter(names).items() if times > 1 or not re.fullmatch(r"[A-Za-z_]\w*", n)]
    if bad:
        raise ValueError(f"tools cannot be registered: {', '.join(bad)}")
    for r in rows:
        spark.udtf.register(r.name, udtf(tool_class(*r)))
    return names


@function("totals")
def _totals(calls: list[dict], key: str, value: str) -> Iterator[tuple]:
    """One row a key: how many calls, and the sum of a column."""
    yield calls[0][key], len(calls), float(sum(c[value] or 0 for c in calls))


@function("overlap")
def _overlap(chunks: list[dict], asked: str) -> Iterator[tuple]:
    """A searcher: of each chunk of a document, how many of the words asked for it holds."""
    words = set(asked.lower().split())
    for c in chunks:
        found = words & set((c["text"] or "").lower().split())
        if found:
            yield c["doc_id"], c["chunk_id"], float(len(found))


#: A searcher's row of the catalogue: (doc_id, chunk_id, score) of chunks (doc_id, chunk_id, text) for a query.
SEARCHER = (json.dumps({"type": "object", "properties": {"doc_id": {"type": "integer"}, "chunk_id": {"type": "integer"}, "text": {"type": "string"}}, "required": ["doc_id", "chunk_id", "text"]}), "doc_id bigint, chunk_id int, score double")


def searcher(spark: SparkSession, name: str, function: str) -> None:
    """Registers a searcher by name: what scores is a named function, and any that
    yields (doc, chunk, score) can take its place in `retrieval`."""
    spark.udtf.register(name, udtf(tool_class(name, f"Scores chunks by {function}.", SEARCHER[0], function, SEARCHER[1])))

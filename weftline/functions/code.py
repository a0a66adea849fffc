"""The two functions that need Python's own parser; Arrow batches, and nothing
is ever evaluated."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Types are objects: workers import this module without a session to parse DDL.
_SIGNATURE = StructType([StructField("name", StringType()), StructField("params", ArrayType(StringType()))])


def _signature(code: str | None) -> dict | None:
    try:
        found = next((n for n in ast.walk(ast.parse(code or "")) if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef)), None)
    except (SyntaxError, ValueError):
        return None
    return found and {"name": found.name, "params": [a.arg for a in [*found.args.posonlyargs, *found.args.args, *found.args.kwonlyargs]]}


@F.pandas_udf(_SIGNATURE)
def first_signature(code: pd.Series) -> pd.DataFrame:
    """Name and parameters of the first function in a source; null without one."""
    rows = [_signature(c) or {"name": None, "params": None} for c in code]
    return pd.DataFrame(rows, columns=["name", "params"])


@F.pandas_udf(StringType())
def literal_as_json(text: pd.Series) -> pd.Series:
    """JSON as it is; a Python literal as JSON; else null."""

    def one(s: str | None) -> str | None:
        try:
            return json.dumps(json.loads(s), ensure_ascii=False)
        except (TypeError, ValueError):
            pass
        try:
            return json.dumps(ast.literal_eval(s), ensure_ascii=False)
        except (TypeError, ValueError, SyntaxError, MemoryError, RecursionError):
            return None

    return text.map(one)

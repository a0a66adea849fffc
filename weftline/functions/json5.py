"""JSON5 to strict JSON text, in Arrow batches; what reads it then is Spark."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_TOKEN = re.compile(
    r"""(?P<skip>[\s\ufeff]+ | //[^\n\r\u2028\u2029]* | /\*.*?\*/)
    | (?P<string>"(?:[^"\\\n\r]|\\.)*" | '(?:[^'\\\n\r]|\\.)*')
    | (?P<number>[+-]?(?:0[xX][0-9a-fA-F]+ | (?:0|[1-9]\d*)(?:\.\d*)?(?:[eE][+-]?\d+)? | \.\d+(?:[eE][+-]?\d+)? | Infinity | NaN)(?![\w$]))
    | (?P<name>(?:[^\W\d]|\$|\\u[0-9a-fA-F]{4})(?:[\w$\u200c\u200d]|\\u[0-9a-fA-F]{4})*)
    | (?P<sign>[][{}:,])""",
    re.S | re.X,
)
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|x([0-9a-fA-F]{2})|(\r\n|.))", re.S)
#: What a sign behind a backslash means; line ends continue the line, others are themselves.
_MEANS = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "0": "\0", "\n": "", "\r": "", "\r\n": "", "\u2028": "", "\u2029": ""}


def _unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _MEANS.get(m[3], m[3]), text)


def _number(text: str) -> str:
    """A number as JSON writes it; infinities and NaN, which it lacks, are null."""
    sign, digits = ("-" if text[0] == "-" else ""), text.lstrip("+-")
    if digits in ("Infinity", "NaN"):
        return "null"
    if digits[:2] in ("0x", "0X"):
        return f"{sign}{int(digits, 16)}"
    whole, dot, rest = digits.partition(".")
    if not dot:
        return sign + digits
    return f"{sign}{whole or 0}" + (f".{rest}" if rest[:1].isdigit() else rest)


def strict(text: str) -> str | None:
    """The same value as strict JSON: comments go, names and single-quoted strings
    are quoted, numbers are rewritten, a comma behind the last member goes. None
    where a part is no JSON5; whether the parts make a value is left to the parser
    that reads it."""
    out: list[tuple[str, str]] = []  # kind, text
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            return None
        at, kind, found = m.end(), m.lastgroup, m[0]
        if kind == "skip":
            continue
        if kind == "string":
            found = json.dumps(_unescaped(found[1:-1]))
        elif kind == "number":
            found = _number(found)
        elif kind == "name" and found not in ("true", "false", "null"):
            found = json.dumps(_unescaped(found))
        elif kind == "sign" and found in "]}" and out and out[-1] == ("sign", ",") and len(out) > 1 and out[-2][1] not in ("[", "{", ",", ":"):
            out.pop()
        if found == ":" and out and out[-1][0] == "name" and out[-1][1][0] != '"':
            out[-1] = ("name", json.dumps(out[-1][1]))  # a literal as a key
        elif found != ":" and out and out[-1][0] == "name" and out[-1][1][0] == '"':
            return None  # a name is a value only as a literal
        out.append((kind, found))
    if out and out[-1][0] == "name" and out[-1][1][0] == '"':
        return None
    return "".join(found for _, found in out)


@F.pandas_udf(StringType())
def strict_json5(text: pd.Series) -> pd.Series:
    return text.map(strict, na_action="ignore")


def parse_json5(text: Column) -> Column:
    """The value as a VARIANT, strict JSON first; null where it is neither."""
    plain = F.try_parse_json(text)
    return F.coalesce(plain, F.try_parse_json(strict_json5(text)))

"""JSON, arrays, maps, numbers and seeded choices over columns. Parsing is strict: text behind
a value makes it invalid, as Spark's own parsers would accept it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions import json5
from weftline.functions import text as T


def _bound(value: Column, f) -> Column:
    """f(value), where f may name its argument often: it is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strict_json(s: Column) -> Column:
    """VARIANT of a JSON object or array that is the whole string, else null.
    Spark's parser accepts text behind a value, but not inside an array: so the
    string is parsed as the one element of an array; an array, which could close
    that early, must also parse as a member of an object."""

    def parsed(t: Column) -> Column:
        listed = lambda v: F.when(F.try_variant_get(v, "$[1]", "variant").isNull(), F.try_variant_get(v, "$[0]", "variant"))
        alone = t.rlike(r"(?s)^\{.*\}$") | t.rlike(r"(?s)^\[.*\]$") & F.try_parse_json(F.concat(F.lit('{"w":'), t, F.lit("}"))).isNotNull()
        return F.when(alone, _bound(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), listed))

    return _bound(T.strip_space(s), parsed)


def whole_json(s: Column) -> Column:
    """The string where `strict_json` takes it, else null."""
    return F.when(strict_json(s).isNotNull(), s)


def model_json(s: Column) -> Column:
    """JSON of a model's reply: behind the last think block and without fences;
    else a fenced object; else from the first { to the last }."""
    clean = T.strip_fences(T.after_last_think(s))
    fenced = F.regexp_extract(s, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(clean, r"(?s)\{.*\}", 0)
    return F.coalesce(strict_json(clean), strict_json(fenced), strict_json(braces))


def salvage_json(s: Column) -> Column:
    """From the earliest opening bracket to the latest closing one."""
    return F.regexp_extract(s, r"(?s)[\[{].*[\]}]", 0)


def json_list(s: Column) -> Column:
    """array<variant>: a list as it is, an object as a list of one, else the
    bracketed part; empty where nothing parses."""
    clean = T.strip_fences(T.after_last_think(s))
    found = F.coalesce(strict_json(clean), strict_json(F.regexp_extract(clean, r"(?s)\[.*\]", 0)))
    kind = F.schema_of_variant(found)
    return F.when(found.isNull(), F.array().cast("array<variant>")).when(kind.startswith("ARRAY"), F.try_variant_get(found, "$", "array<variant>")).otherwise(F.array(found))


def first_of_list(s: Column) -> Column:
    """The first element of a list, or the object itself."""
    return F.try_element_at(json_list(s), F.lit(1))


def nested_objects(s: Column) -> Column:
    """All objects with at most one level of nesting in a text (the pattern is a
    fixed value)."""
    return F.regexp_extract_all(s, F.lit(r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}"), F.lit(0))


def first_with(s: Column, field: str) -> Column:
    """The first such object that parses and has the field."""
    parsed = F.transform(nested_objects(s), strict_json)
    return F.try_element_at(F.filter(parsed, lambda v: F.try_variant_get(v, f"$.{field}", "variant").isNotNull()), F.lit(1))


def score(v: Column, field: str = "score", safe: float = 1.0) -> Column:
    """struct(score, is_safe): a number, or a string that holds one; else the
    safe score."""
    found = F.try_variant_get(v, f"$.{field}", "double")
    return F.struct(F.coalesce(found, F.lit(safe)).alias("score"), F.when(found.isNull(), 1).otherwise(0).alias("is_safe"))


def digit_score(v: Column, field: str = "score", safe: int = 1) -> Column:
    """Digits or a number, truncated; else the safe score."""
    s = F.try_variant_get(v, f"$.{field}", "string")
    number = F.when(s.rlike(r"^\d{1,9}$") | s.rlike(r"^-?\d{1,9}\.\d+$"), F.try_variant_get(v, f"$.{field}", "double").cast("int"))
    return F.coalesce(number, F.lit(safe))


def binary_score(v: Column, field: str = "score", safe: int = 1) -> Column:
    """0 or 1; anything else is the safe score."""
    s = F.try_variant_get(v, f"$.{field}", "string")
    return F.when(s.isin("0", "0.0"), 0).when(s.isin("1", "1.0"), 1).otherwise(safe)


def score_list(v: Column, field: str = "tool_score_list") -> Column:
    """array<double> of the numbers in a list; others are dropped."""
    items = F.try_variant_get(v, f"$.{field}", "array<variant>")
    return F.filter(F.transform(items, lambda x: F.try_variant_get(x, "$", "double")), lambda x: x.isNotNull())


def loose_json(s: Column) -> Column:
    """A VARIANT of JSON, else of JSON5, with or without a fence around it."""
    return json5.parse_json5(T.strip_fences(s))


def as_string(v: Column) -> Column:
    """Arguments as text, whether they were an object or text already."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))


def call_id(given: Column, position: Column) -> Column:
    return F.coalesce(F.nullif(given, F.lit("")), F.concat(F.lit("call_"), position.cast("string")))


def null_word(s: Column) -> Column:
    """The words null and None, and nothing, are null."""
    return F.when(~T.strip_space(s).isin("null", "None", ""), s)


def truthy(s: Column) -> Column:
    """What a dynamic language takes for true: any text but the empty one."""
    return F.coalesce(s, F.lit("")) != ""


# -- arrays and maps ------------------------------------------------------------------


def mean(xs: Column) -> Column:
    """Null for an empty array."""
    return F.when(F.size(xs) > 0, F.aggregate(xs, F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size(xs))


def ints(xs: Column) -> Column:
    """Digit strings as numbers; others are dropped."""
    return F.filter(F.transform(xs, lambda x: F.when(x.rlike(r"^\d{1,18}$"), x.cast("bigint"))), lambda x: x.isNotNull())


def same_list(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def subset(a: Column, b: Column) -> Column:
    """Every element of a is one of b."""
    return F.size(F.array_except(a, b)) == 0


def pairs(xs: Column) -> Column:
    """Consecutive elements as structs (src, dst)."""
    n = F.greatest(F.size(xs) - 1, F.lit(0))
    return F.zip_with(F.slice(xs, F.lit(1), n), F.slice(xs, F.lit(2), n), lambda a, b: F.struct(a.alias("src"), b.alias("dst")))


def put(m: Column, key: Column | str, value: Column) -> Column:
    """A map with one entry set; the last wins."""
    key = F.lit(key) if isinstance(key, str) else key
    return F.map_concat(F.map_filter(m, lambda k, _: k != key), F.create_map(key, value))


def merge_configs(base: Column, new: Column, lists: str) -> Column:
    """map<string, array<string>>: new entries win, those of `lists` unite."""
    both = F.array_union(F.coalesce(F.try_element_at(base, F.lit(lists)), F.array().cast("array<string>")), F.coalesce(F.try_element_at(new, F.lit(lists)), F.array().cast("array<string>")))
    out = F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)
    has = F.map_contains_key(base, lists) | F.map_contains_key(new, lists)
    return F.when(has, put(out, lists, both)).otherwise(out)


def last_n(xs: Column, n: int = 5) -> Column:
    return F.slice(xs, F.greatest(F.size(xs) - n + 1, F.lit(1)), n)


# -- numbers and seeded choices ----------------------------------------------------------


def half_even(x: Column, places: int = 3) -> Column:
    return F.bround(x, places)


def rrf_weight(rank: Column, k: int = 60) -> Column:
    """Reciprocal rank; ranks from 1."""
    return F.lit(1.0) / (rank + k)


def bm25(tf: Column, idf: Column, length: Column, average: Column, k1: float = 1.5, b: float = 0.75) -> Column:
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / average))


def draw(seed: int, *key: Column) -> Column:
    """A number below 2^52 for each key, the same in every run and in any engine:
    the first 13 hexadecimal digits of the MD5 of seed and key, parted by bars. A
    null part is a word of its own."""
    parts = [F.coalesce(k.cast("string"), F.lit("null")) for k in key]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 13), 16, 10).cast("bigint")


def coin(seed: int, share: float, *key: Column) -> Column:
    """True for about `share` of the keys, the same ones in every run."""
    return F.pmod(draw(seed, *key), F.lit(1_000_000)) < int(share * 1_000_000)


def pick(seed: int, n: Column | int, *key: Column) -> Column:
    """A number from 0 to n - 1 for each key, the same in every run."""
    return F.pmod(draw(seed, *key), F.lit(n) if isinstance(n, int) else n)


def choice(options: Column, seed: int, *key: Column) -> Column:
    """One of the options; null where there are none."""
    return F.when(F.size(options) > 0, F.get(options, pick(seed, F.greatest(F.size(options), F.lit(1)).cast("bigint"), *key).cast("int")))


def call_number(arguments: Column) -> Column:
    """A stable number below 10000 for a call's arguments."""
    return F.pmod(draw(0, arguments), F.lit(10_000))


def backoff(attempt: Column, base: float = 1.0, factor: float = 2.0, cap: float = 300.0) -> Column:
    """Seconds before the next try, without jitter."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(factor), attempt))

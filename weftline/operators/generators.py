"""Row generators, prompt grids and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.functions import text as T
from weftline.operators import scan
from weftline.scratch import materialize


def explode_items(df: DataFrame, items: str, alias: str, key: list[str]) -> DataFrame:
    """One row an item; rows without items go. Adds position, and an id that is
    a hash of key and position, so that it is the same in every run."""
    rows = df.select("*", F.posexplode(items).alias("position", alias))
    return rows.withColumn("item_id", F.sha2(F.concat_ws("\x00", *[F.col(c).cast("string") for c in key], F.col("position").cast("string")), 256))


def repeat(df: DataFrame, n: Column | int, alias: str = "repeat") -> DataFrame:
    """n copies of each row, numbered from 1; none where n is below 1."""
    n = (F.lit(n) if isinstance(n, int) else n).cast("int")
    return df.filter(n >= 1).withColumn(alias, F.explode(F.sequence(F.lit(1), n)))


def prompt_grid(rows: DataFrame, languages: list[str], weights: DataFrame | None, default: int, key: str) -> DataFrame:
    """rows x languages x repeats; repeats come from weights (key, n) or the
    default. Languages are literals: no join is needed for them."""
    grid = rows.withColumn("lang", F.explode(F.array(*map(F.lit, languages))))
    if weights is not None:
        grid = grid.join(weights.withColumnRenamed("n", "_n"), key, "left")
    else:
        grid = grid.withColumn("_n", F.lit(None).cast("int"))
    return repeat(grid.withColumn("_n", F.coalesce("_n", F.lit(default))), F.col("_n")).drop("_n")


def hop_grid(rows: DataFrame, least: int, most: int, repeats: int) -> DataFrame:
    return repeat(rows.withColumn("num_hops", F.explode(F.sequence(F.lit(least), F.lit(most)))), repeats)


def augmentation_grid(tasks: DataFrame, modes: list[str], personas: DataFrame, n_sample: int, key: str, seed: int = 42) -> DataFrame:
    """tasks x modes x samples; each gets a persona by hash, the same in every
    run. personas: row_id from 0, and columns."""
    n = F.broadcast(personas.agg(F.count("*").alias("_n")))
    grid = repeat(tasks.withColumn("mode", F.explode(F.array(*map(F.lit, modes)))), n_sample, "sample").join(n)
    picked = grid.withColumn("row_id", F.when(F.col("_n") > 0, S.pick(seed, F.greatest("_n", F.lit(1)), F.col(key), F.col("mode"), F.col("sample")))).drop("_n")
    return picked.join(personas, "row_id", "left")


def with_variations(df: DataFrame, original: Column, variations: Column) -> DataFrame:
    """Each row and its variations: variant 0 is the original."""
    return df.select("*", F.posexplode(F.array_prepend(variations, original)).alias("variant", "question"))


def variations(response: Column) -> Column:
    """array<string>: questions of <variation_n> blocks; without any, bare
    question tags."""
    blocks = F.regexp_extract_all(response, F.lit(r"(?is)<variation_\d+\b[^>]*>(.*?)</variation_\d+>"), F.lit(1))
    questions = F.filter(F.transform(blocks, lambda b: T.strip_comments(T.tag(b, "question", loose=True))), lambda q: q != "")
    bare = F.filter(F.transform(F.regexp_extract_all(response, F.lit(r"(?is)<question\b[^>]*>(.*?)</question>"), F.lit(1)), T.strip_comments), lambda q: q != "")
    return F.when(F.size(questions) > 0, questions).otherwise(bare)


def leaves(taxonomy: DataFrame, name: str, value: str) -> DataFrame:
    """name, path, description, examples of every leaf of nested JSON, at any
    depth; a leaf has a description. One pass a level, until none is left."""
    spark, found = taxonomy.sparkSession, []
    nodes = taxonomy.select(F.col(name).alias("name"), F.array().cast("array<string>").alias("path"), F.col(value).alias("json"))
    while True:
        v = F.try_parse_json("json")
        level = materialize(nodes.select("name", "path", "json", F.try_variant_get(v, "$.description", "string").alias("description"), F.try_variant_get(v, "$.examples", "array<string>").alias("examples")), "level")
        found.append(level.filter("description IS NOT NULL").drop("json"))
        inner = level.filter("description IS NULL").select("name", "path", F.try_parse_json("json").alias("v"))
        nodes = inner.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).filter("key IS NOT NULL").select("name", F.array_append("path", F.col("key")).alias("path"), F.to_json("value").alias("json"))
        if nodes.isEmpty():
            return union_all(*found)


def sentences(text: Column) -> Column:
    """Split at '. ' and the ideographic full stop; blanks go."""
    return F.filter(F.split(text, r"\. |。"), lambda s: T.strip_space(s) != "")


def roman_headings(outline: Column) -> Column:
    return F.filter(F.split(outline, "\n"), lambda x: T.strip_space(x).rlike(r"^(I|V|X|L|C|D|M)+"))


def union_all(*frames: DataFrame) -> DataFrame:
    """By name; columns that some lack are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def distinct_files(first: Column, second: Column, kinds: list[str]) -> Column:
    """Files of both lists with a supported extension, each once, in order."""
    return F.filter(F.array_distinct(F.concat(first, second)), lambda f: F.lower(F.regexp_extract(f, r"\.([A-Za-z0-9]+)$", 1)).isin(kinds))


def parts(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """Adds part: n parts of ceil(count / n) rows each, in order, the last ones
    shorter or empty. Rows are numbered by ranges, not in one window."""
    size = F.broadcast(rows.agg(F.greatest(F.ceil(F.count("*") / n), F.lit(1)).alias("_size")))
    numbered = scan.ordered(rows.withColumn("_all", F.lit(0)), ["_all"], order).scan(_at=scan.running_sum(F.lit(1))).plain()
    return numbered.join(size).withColumn("part", F.floor((F.col("_at") - 1) / F.col("_size"))).drop("_all", "_at", "_size")

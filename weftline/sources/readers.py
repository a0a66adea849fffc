"""Scans: JSONL in strict and tolerant forms, single objects, weight tables,
templates, taxonomies, knowledge seeds, key-value tables, replay tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from weftline.functions import text as T


def _schema(schema: str | StructType | None) -> StructType | None:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def jsonl(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """One object a line; blank lines are skipped; a bad line is an error."""
    reader = spark.read.option("mode", "FAILFAST")
    schema = _schema(schema)
    return (reader.schema(schema) if schema else reader).json(path)


def jsonl_tolerant(spark: SparkSession, path: str, schema: str | StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines): rows that parse and are not empty objects, and the
    text of the others, for the log."""
    schema = _schema(schema)
    wide = StructType([*schema.fields, StructField("_bad", StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    empty = F.regexp_replace("value", r"\s", "") == "{}"
    good = parsed.filter(F.col("r._bad").isNull() & ~empty)
    return good.select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields]), parsed.filter(F.col("r._bad").isNotNull()).select("value")


def jsonl_silent(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Bad lines are dropped without a trace."""
    return spark.read.schema(_schema(schema)).option("mode", "DROPMALFORMED").json(path)


def json_file(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """A file that is one object, or one array of objects."""
    reader = spark.read.option("multiLine", "true").option("mode", "FAILFAST")
    schema = _schema(schema)
    return (reader.schema(schema) if schema else reader).json(path)


def records(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """By suffix: .jsonl, .json, .parquet; anything else is an error."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind not in ("json", "jsonl"):
        raise ValueError(f"{path}: .json, .jsonl or .parquet is expected")
    return (jsonl if kind == "jsonl" else json_file)(spark, path, schema)


def personas(spark: SparkSession, path: str) -> DataFrame:
    """A columnar persona table; lists may be JSON text."""
    raw = spark.read.parquet(path)
    fix = [c for c, t in raw.dtypes if c.endswith("_list") and t == "string"]
    return raw.withColumns({c: F.from_json(c, "array<string>") for c in fix})


def weights(spark: SparkSession, path: str) -> DataFrame:
    """key, n of lines with two integers or more; the last line of a key wins."""
    part = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("at", "value")).filter(F.size(part) >= 2)
    rows = lines.select("at", F.try_element_at(part, F.lit(1)).try_cast("int").alias("key"), F.try_element_at(part, F.lit(2)).try_cast("int").alias("n"))
    return rows.filter("key IS NOT NULL AND n IS NOT NULL").groupBy("key").agg(F.max_by("n", "at").alias("n"))


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """name, value: templates, taxonomies and other small texts by file name."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("name"), "value")


def prompt_templates(spark: SparkSession, path: str, default: str = "base") -> DataFrame:
    """type, lang, text of files named <type>_<lang>."""
    return whole_files(spark, path).select(F.regexp_extract("name", r"^(.*)_([a-z]{2})$", 1).alias("type"), F.regexp_extract("name", r"_([a-z]{2})$", 1).alias("lang"), F.col("value").alias("text"))


def first_row(df: DataFrame) -> DataFrame:
    return df.limit(1)


def decode_text(data: Column) -> Column:
    """UTF-8 where it is valid, else Latin-1."""
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(F.decode(data, "ISO-8859-1"))


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, kind, content (bytes), key (a hash of the path, for caches)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return raw.select("path", T.html_sniff_type(F.col("path"), decode_text(F.col("content"))).alias("kind"), "content", F.sha2("path", 256).alias("key"))


def lookup_code(rows: DataFrame, codes: DataFrame, name: str, code: str) -> DataFrame:
    """Exact name to code; an error text without one."""
    found = rows.join(codes.select(name, code), name, "left")
    return found.withColumn("error", F.when(F.col(code).isNull(), F.concat(F.lit("no code for "), F.coalesce(name, F.lit("null")))))


def web_results(results: DataFrame, query: str = "query") -> DataFrame:
    """Search hits (rank, title, snippet, date) as one numbered text a query."""
    line = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit('] "'), F.col("title"), F.lit("\n"), F.col("snippet"), F.lit('"'), F.when(F.coalesce("date", F.lit("")) != "", F.concat(F.lit("\n"), F.col("date"))).otherwise(""))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("t")))), lambda x: x["t"]), "\n\n")
    return results.groupBy(query).agg(joined.alias("text"))

"""Projections, gates and renderings of records (tools, tasks, steps)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.functions import text as T


def normalise_tools(raw: DataFrame) -> DataFrame:
    """Tool servers in the old or the new layout (top-level `base_info`, or
    below `mcp_info`, as JSON in `value`) to typed columns; the whole record
    stays as a variant, so that unknown keys are kept."""
    v = F.try_parse_json("value")
    at = lambda path, kind: F.coalesce(F.try_variant_get(v, f"$.mcp_info.base_info{path}", kind), F.try_variant_get(v, f"$.base_info{path}", kind))
    group = {c: at(f".group_info.{c}", "string").alias(c) for c in ("server_title", "server_name", "server_description", "domain", "group_id")}
    tools = F.transform(at(".tool_list", "array<variant>"), lambda t: F.struct(*[F.try_variant_get(t, f"$.{c}", k).alias(c) for c, k in (("name", "string"), ("description", "string"), ("parameters", "variant"))]))
    return raw.select(*group.values(), F.coalesce(tools, F.array().cast("array<struct<name:string,description:string,parameters:variant>>")).alias("tools"), v.alias("record")).filter(F.col("record").isNotNull())


def display_name(*names: Column) -> Column:
    """The first that is not empty."""
    return F.coalesce(*[F.nullif(n, F.lit("")) for n in names])


def tools_as_json_lines(tools: Column) -> Column:
    return F.array_join(F.transform(tools, lambda t: F.to_json(t)), "\n")


def numbered_tools(tools: Column) -> Column:
    """1. **name**: description"""
    line = lambda t, i: F.concat((i + 1).cast("string"), F.lit(". **"), t["name"], F.lit("**: "), F.coalesce(t["description"], F.lit("")))
    return F.array_join(F.transform(tools, line), "\n")


def tool_blocks(tools: Column) -> Column:
    """A line a tool; the description only where there is one."""
    line = lambda t: F.concat(F.lit("- "), t["name"], F.when(F.coalesce(t["description"], F.lit("")) != "", F.concat(F.lit(": "), t["description"])).otherwise(""))
    return F.array_join(F.transform(tools, line), "\n")


def effective_question(augmented: Column, generated: Column) -> Column:
    """The augmented question unless it is empty; one enclosing tag goes."""
    return T.unwrap(F.when(F.coalesce(augmented, F.lit("")) != "", augmented).otherwise(generated))


def score_gate(df: DataFrame, score: str, legitimate: str, threshold: float) -> DataFrame:
    """Drops records that are not legitimate, or score under the threshold."""
    return df.filter(F.coalesce(F.col(legitimate), F.lit(True)) & (F.col(score) >= threshold))


def all_filled(*columns: Column) -> Column:
    ok = F.lit(True)
    for c in columns:
        ok = ok & (F.coalesce(c, F.lit("")) != "")
    return ok


def environment_ok(e: Column) -> Column:
    """One environment: fields filled, a document with its keys, a call without
    http, an output that holds the answer. A null environment passes."""
    fields = [e[c].isNotNull() for c in ("question", "answer", "tool_document", "tool_call_statement", "code", "tool_call_ans")]
    document = F.try_parse_json(e["tool_document"])
    keys = [F.try_variant_get(document, f"$.{k}", "variant").isNotNull() for k in ("name", "description", "parameters")]
    checks = [*fields, *keys, ~e["tool_call_statement"].contains("http"), e["tool_call_ans"].contains(e["answer"])]
    ok = F.lit(True)
    for c in checks:
        ok = ok & F.coalesce(c, F.lit(False))
    return e.isNull() | ok


def record_ok(environments: Column) -> Column:
    """All environments of a record (a map) pass; any failure rejects it whole."""
    return F.forall(F.map_values(environments), environment_ok)


def needed_steps(trace: Column) -> Column:
    """Only a literal false drops a step."""
    return F.filter(trace, lambda t: F.coalesce(t["tool_necessity"], F.lit(True)))


def several(clusters: Column) -> Column:
    """Clusters of more than one member."""
    return F.filter(clusters, lambda c: F.size(c["_uuids"]) > 1)


def usable_chains(chains: Column) -> Column:
    """Chains that were found: `yes` only; a corrected chain replaces the first;
    an error other than '1' drops it."""
    kept = F.filter(chains, lambda c: (c["tool_graph_detect"] == "yes") & (F.coalesce(c["error_info"], F.lit("1")) == "1"))
    return F.transform(kept, lambda c: F.when(F.coalesce(F.size(c["new_chain"]), F.lit(0)) > 0, c["new_chain"]).otherwise(c["tool_graph_detect_chain"]))


def metadata(**fields: Column) -> Column:
    """JSON of the fields that are not null."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


def persona(row: dict[str, Column]) -> Column:
    """struct of prompt fields: first five of each list, the first 200 signs of
    the text, title case with blanks for underscores."""
    first = lambda c: F.array_join(F.slice(c, 1, 5), ", ")
    title = lambda c: F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
    text = row["professional_persona"]
    return F.struct(
        row["age"].alias("age"),
        title(row["occupation"]).alias("occupation"),
        title(row["education_level"]).alias("education_level"),
        F.when(F.length(text) > 200, F.concat(F.left(text, F.lit(200)), F.lit("..."))).otherwise(text).alias("professional_persona"),
        first(row["skills_and_expertise_list"]).alias("skills"),
        first(row["hobbies_and_interests_list"]).alias("hobbies"),
    )


def rows_as_pipe_table(table: Column) -> Column:
    """array<array<string>> to |a|b| lines; null is None, newlines are blanks."""
    cell = lambda c: F.replace(F.coalesce(c, F.lit("None")), F.lit("\n"), F.lit(" "))
    return F.array_join(F.transform(table, lambda r: F.concat(F.lit("|"), F.array_join(F.transform(r, cell), "|"), F.lit("|"))), "\n")


def frame_as_markdown(df: DataFrame, order: str, by: list[str] | None = None) -> DataFrame:
    """A Markdown table of each group's rows in the given order: rows without
    any value go, nulls are empty, long runs of dashes are shortened. Groups
    are tables: each must be small enough to be one text."""
    by = by or []
    cells = [c for c in df.columns if c != order and c not in by]
    some = F.coalesce(*[F.col(c).cast("string") for c in cells]).isNotNull()
    line = F.concat(F.lit("|"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells]), F.lit("|"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))), lambda x: x["line"]), "\n")
    head = f"|{'|'.join(cells)}|\n|{'|'.join('---' for _ in cells)}|\n"
    return df.filter(some).groupBy(*by).agg(F.regexp_replace(F.concat(F.lit(head), body), "-{6,}", "-----").alias("markdown"))


def pages_as_text(pages: Column) -> Column:
    """Page list to plain text: all texts in order, one a line."""
    return F.array_join(F.flatten(F.transform(pages, lambda p: F.transform(p["content"], lambda c: c["text"]))), "\n")


def steps_for_clustering(trace: Column) -> Column:
    """JSON of what intent clustering reads of each step."""
    return F.to_json(F.transform(trace, lambda t: F.struct(t["_uuid"].alias("_uuid"), t["sub_question"].alias("sub_question"), t["sub_answer"].alias("sub_answer"))))


def compact_steps(trace: Column) -> Column:
    """A line a step: id, hop, parallel, dependencies, question, answer."""
    dep = lambda t: F.coalesce(F.concat(F.lit("["), F.array_join(F.transform(t["dependency"], lambda d: d.cast("string")), ","), F.lit("]")), F.lit("null"))
    line = lambda t: F.concat_ws(" | ", F.concat(F.lit("id="), t["_uuid"]), F.concat(F.lit("hop="), t["hop_level"]), F.concat(F.lit("parallel="), t["is_parallel"].cast("string")), F.concat(F.lit("dep="), dep(t)), F.concat(F.lit("q="), t["sub_question"]), F.concat(F.lit("a="), t["sub_answer"]))
    return F.array_join(F.transform(trace, line), "\n")


def history(calls: Column, n: int = 5) -> Column:
    """The last calls, a line each."""
    return F.array_join(F.transform(S.last_n(calls, n), lambda c: F.concat(F.lit("Call: "), c["name"], F.lit("("), c["arguments"], F.lit(") -> "), c["result"])), "\n")


def row_ids(df: DataFrame, key: str, task: str, source: str) -> DataFrame:
    """Adds an eight-digit id by the order of `key`, task type and source. The
    numbering is distributed: ranks inside range partitions plus offsets."""
    ranged = df.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    from pyspark.sql import Window

    # One row a partition.
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = F.col("_at") + F.col("_before")
    return ranged.join(F.broadcast(offsets), "_part").withColumns({"row_id": number, "prompt_id": F.lpad(number.cast("string"), 8, "0"), "task_type": F.lit(task), "data_source": F.lit(source)}).drop("_part", "_at", "_before")


def snippets(found: Column) -> Column:
    """Retrieved (url, text list) structs to source and content blocks."""
    return F.array_join(F.transform(found, lambda r: F.concat(F.lit("[file]("), T.basename(r["url"]), F.lit(")\n"), F.array_join(r["text"], "\n\n...\n\n"))), "\n\n")


def valid_servers(config: Column) -> Column:
    """A JSON object under `mcpServers` whose entries each have a command with
    an argument list, or a URL."""
    servers = F.from_json(F.to_json(F.try_variant_get(F.try_parse_json(config), "$.mcpServers", "variant")), "map<string,struct<command:string,args:array<string>,url:string>>")
    return F.coalesce(servers.isNotNull() & F.forall(F.map_values(servers), lambda s: s["url"].isNotNull() | (s["command"].isNotNull() & s["args"].isNotNull())), F.lit(False))


def _keys(v: Column) -> Column:
    return F.coalesce(F.json_object_keys(F.to_json(v)), F.array().cast("array<string>"))


def tool_schema_ok(s: Column) -> Column:
    """A tool definition: exactly name, description and parameters; parameters
    of type object with exactly type, properties and required; required names
    are properties."""
    v = F.try_parse_json(s)
    parameters = F.try_variant_get(v, "$.parameters", "variant")
    exact = lambda x, names: F.array_sort(_keys(x)) == F.array(*map(F.lit, sorted(names)))
    required = F.try_variant_get(parameters, "$.required", "array<string>")
    return F.coalesce(exact(v, ("name", "description", "parameters")) & exact(parameters, ("type", "properties", "required")) & (F.try_variant_get(parameters, "$.type", "string") == "object") & S.subset(required, _keys(F.try_variant_get(parameters, "$.properties", "variant"))), F.lit(False))


def arguments_ok(parameters: Column, arguments: Column) -> Column:
    """Every required parameter has an argument."""
    required = F.coalesce(F.try_variant_get(F.try_parse_json(parameters), "$.required", "array<string>"), F.array().cast("array<string>"))
    return S.subset(required, _keys(F.try_parse_json(arguments)))


def clean_parameters(parameters: Column) -> Column:
    """Type, properties and required alone; no required names by default."""
    v = F.try_parse_json(parameters)
    return F.to_json(F.struct(F.coalesce(F.try_variant_get(v, "$.type", "string"), F.lit("object")).alias("type"), F.try_variant_get(v, "$.properties", "variant").alias("properties"), F.coalesce(F.try_variant_get(v, "$.required", "array<string>"), F.array().cast("array<string>")).alias("required")))


def exactly_one(*columns: Column) -> Column:
    return sum((F.when(c.isNotNull(), 1).otherwise(0) for c in columns), F.lit(0)) == 1

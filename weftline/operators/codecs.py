"""Function calls in text: three dialects, rendered and parsed with column
expressions. A call is struct<name:string,arguments:string>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.functions import text as T

CALL = "array<struct<name:string,arguments:string>>"


def _json_call(body: Column, v: Column) -> Column:
    broken = T.salvage_call(body)
    name, arguments = F.try_variant_get(v, "$.name", "string"), S.as_string(F.try_variant_get(v, "$.arguments", "variant"))
    return F.when(name.isNotNull(), F.struct(name.alias("name"), arguments.alias("arguments"))).otherwise(broken)


def parse_tags(s: Column) -> Column:
    """<tool_call> {"name": ..., "arguments": ...} </tool_call>; a last call
    without its end tag counts; broken JSON is salvaged."""
    bodies = F.regexp_extract_all(s, F.lit(r"(?s)<tool_call>(.*?)(?:</tool_call>|\z)"), F.lit(1))
    parsed = F.transform(F.transform(bodies, T.strip_space), lambda b: F.struct(b.alias("b"), S.strict_json(b).alias("v")))
    return F.filter(F.transform(parsed, lambda x: _json_call(x["b"], x["v"])), lambda c: c["name"] != "")


def render_tags(calls: Column) -> Column:
    line = lambda c: F.concat(F.lit('<tool_call>\n{"name": "'), c["name"], F.lit('", "arguments": '), c["arguments"], F.lit("}\n</tool_call>"))
    return F.array_join(F.transform(calls, line), "\n")


def parse_marks(s: Column) -> Column:
    """✿FUNCTION✿: name, ✿ARGS✿: arguments; results and what follows go."""
    name, args, result, end = T.MARKS
    bodies = F.slice(F.split(s, f"{name}:"), 2, 1_000_000)
    cut = lambda b: T.cut_at_stop_words(b, [result, end], [])
    call = lambda b: F.struct(T.strip_space(F.split_part(cut(b), F.lit(f"{args}:"), F.lit(1))).alias("name"), T.drop_trailing_comment(F.when(cut(b).contains(f"{args}:"), F.split_part(cut(b), F.lit(f"{args}:"), F.lit(2))).otherwise("")).alias("arguments"))
    return F.filter(F.transform(bodies, call), lambda c: c["name"] != "")


def render_marks(calls: Column) -> Column:
    name, args, _, _ = T.MARKS
    return F.array_join(F.transform(calls, lambda c: F.concat(F.lit(f"{name}: "), c["name"], F.lit(f"\n{args}: "), c["arguments"])), "\n")


#: The tokens of the sectioned dialect.
SECTION = ("<|tool_calls_section_begin|>", "<|tool_calls_section_end|>")
CALL_TOKENS = ("<|tool_call_begin|>", "<|tool_call_argument_begin|>", "<|tool_call_end|>")


def parse_sections(s: Column) -> Column:
    """Calls inside the first closed section; ids are functions.name:number."""
    section = F.regexp_extract(s, r"(?s)<\|tool_calls_section_begin\|>(.*?)<\|tool_calls_section_end\|>", 1)
    bodies = F.regexp_extract_all(section, F.lit(r"<\|tool_call_begin\|>([^<]*<\|tool_call_argument_begin\|>[^<]*)<\|tool_call_end\|>"), F.lit(1))
    part = lambda b, i: T.strip_space(F.split_part(b, F.lit(CALL_TOKENS[1]), F.lit(i)))
    return F.transform(bodies, lambda b: F.struct(F.regexp_replace(F.regexp_replace(part(b, 1), r"^functions\.", ""), r":\d+$", "").alias("name"), part(b, 2).alias("arguments")))


def render_sections(calls: Column) -> Column:
    begin, argument, end = CALL_TOKENS
    line = lambda c, i: F.concat(F.lit(begin + "functions."), c["name"], F.lit(":"), i.cast("string"), F.lit(argument), c["arguments"], F.lit(end))
    return F.concat(F.lit(SECTION[0]), F.array_join(F.transform(calls, line), ""), F.lit(SECTION[1]))


DIALECTS = {"tags": (render_tags, parse_tags), "marks": (render_marks, parse_marks), "sections": (render_sections, parse_sections)}


def describe_function(tool: Column, lang: str = "en") -> Column:
    """The description of one tool in a prompt, in English or Chinese."""
    # The wording that prompts have.
    template = {
        "en": "### %1$s\n\n%1$s: %2$s Parameters: %3$s Format the arguments as a JSON object.",
        "zh": "### %1$s\n\n%1$s: %2$s 输入参数：%3$s 此工具的输入应为JSON对象。",
    }[lang]
    return F.format_string(template, tool["name"], F.coalesce(tool["description"], F.lit("")), F.coalesce(tool["parameters"], F.lit("{}")))


def upload_banner(files: Column, lang: str = "en") -> Column:
    """A line that names uploaded files; empty without any."""
    head = {"en": "(Uploaded ", "zh": "（上传了 "}[lang]
    tail = {"en": ")", "zh": "）"}[lang]
    return F.when(F.size(files) > 0, F.concat(F.lit(head), F.array_join(F.transform(files, lambda f: F.concat(F.lit("[file]("), T.basename(f), F.lit(")"))), ", "), F.lit(tail))).otherwise("")

"""The boundary to models, sandboxes and tools. A provider is a function
DataFrame -> DataFrame that adds response, reasoning and error to rows with a
prompt. The default replays a table, so a model column is a join: the same in
every run, and open to an oracle. No generated code is ever executed."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from weftline.functions import structured as S
from weftline.functions import text as T

Provider = Callable[[DataFrame], DataFrame]
_registry: dict[str, Callable[..., Provider]] = {}


def register(name: str, overwrite: bool = False):
    """Names a provider factory; a name is taken once unless overwritten."""

    def keep(factory: Callable[..., Provider]) -> Callable[..., Provider]:
        if name in _registry and not overwrite:
            raise ValueError(f"provider {name} is registered already")
        _registry[name] = factory
        return factory

    return keep


def provider(name: str, **settings) -> Provider:
    return _registry[name](**settings)


@register("replay")
def replay(table: DataFrame) -> Provider:
    """table: key (sha-256 of the prompt), sample, response, error."""

    def ask(rows: DataFrame) -> DataFrame:
        sample = F.col("sample") if "sample" in rows.columns else F.lit(0)
        keyed = rows.withColumns({"_key": F.sha2("prompt", 256), "_sample": sample})
        answers = table.select(F.col("key").alias("_key"), F.col("sample").alias("_sample"), F.col("response").alias("_raw"), F.col("error").alias("_error"))
        parts = T.think_and_answer(F.col("_raw"))
        found = keyed.join(answers, ["_key", "_sample"], "left")
        return found.withColumns({"response": parts["answer"], "reasoning": parts["reasoning"], "error": F.when(F.col("_raw").isNull(), F.coalesce("_error", F.lit("no response")))}).drop("_key", "_sample", "_raw", "_error")

    return ask


@register("rule")
def rule(response: Callable[[Column], Column]) -> Provider:
    """Answers by a column expression of the prompt, for tests."""

    def ask(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"response": response(F.col("prompt")), "reasoning": F.lit(""), "error": F.lit(None).cast("string")})

    return ask


@register("callback")
def callback(call: Callable[[str], str], tries: int = 3, base: float = 1.0, cap: float = 300.0, threads: int = 8) -> Provider:
    """Any client function, called from Arrow batches by `threads` at a time;
    failures are tried again with growing delays and then become the error."""

    def ask(rows: DataFrame) -> DataFrame:
        def one(prompt: str) -> tuple[str | None, str | None]:
            for attempt in range(tries):
                try:
                    return call(prompt), None
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                    if attempt + 1 < tries:
                        time.sleep(min(cap, base * 2**attempt))
            return None, error

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from concurrent.futures import ThreadPoolExecutor

            with ThreadPoolExecutor(threads) as pool:
                for batch in batches:
                    batch["_raw"], batch["_error"] = zip(*pool.map(one, batch["prompt"])) if len(batch) else ([], [])
                    yield batch

        schema = StructType([*rows.schema.fields, StructField("_raw", StringType()), StructField("_error", StringType())])
        parts = T.think_and_answer(F.col("_raw"))
        return rows.mapInPandas(run, schema).withColumns({"response": parts["answer"], "reasoning": parts["reasoning"], "error": F.col("_error")}).drop("_raw", "_error")

    return ask


def samples(rows: DataFrame, n: int, ask: Provider) -> DataFrame:
    """n answers a row, numbered from 0: the votes of self-consistency."""
    return ask(rows.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))))


def back_translation(chains: DataFrame, to_query: Column, to_chain: Callable[[Column], Column], ask: Provider) -> DataFrame:
    """chain -> query -> chain: adds query, chain_again and is_valid (equal as
    lists). Two model columns, one after the other."""
    first = ask(chains.withColumn("prompt", to_query)).withColumn("query", F.try_variant_get(S.model_json(F.col("response")), "$.query", "string")).drop("response", "reasoning", "error", "prompt")
    second = ask(first.withColumn("prompt", to_chain(F.col("query"))))
    again = F.try_variant_get(S.model_json(F.col("response")), "$.chain", "array<string>")
    return second.withColumn("chain_again", again).withColumn("is_valid", F.coalesce(F.col("chain") == F.col("chain_again"), F.lit(False))).drop("response", "reasoning", "prompt")


def cross_model(votes: DataFrame, key: str) -> DataFrame:
    """key, is_valid: more models found the row valid than not."""
    return votes.groupBy(key).agg((F.count_if(F.col("is_valid")) > F.count_if(~F.col("is_valid"))).alias("is_valid"))


class Operators:
    """Named DataFrame -> DataFrame steps, applied in order; each step's result
    is one entry of the map `operator_results`. A name is used once."""

    def __init__(self) -> None:
        self.steps: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def add(self, name: str, step: Callable[[DataFrame], DataFrame]) -> Operators:
        if name in self.steps:
            raise ValueError(f"operator {name} is there already")
        self.steps[name] = step
        return self

    def run(self, df: DataFrame, names: list[str]) -> DataFrame:
        """A step adds `result` (text) and `failed` (its error, or null)."""
        if len(set(names)) < len(names):
            raise ValueError("operator names must differ")
        out = df.withColumn("operator_results", F.create_map().cast("map<string,string>"))
        for name in names:
            got = out.transform(self.steps[name])
            value = F.when(F.col("failed").isNotNull(), F.to_json(F.struct(F.col("failed").alias("error"), F.lit("failed").alias("status")))).otherwise(F.col("result"))
            out = got.withColumn("operator_results", S.put(F.col("operator_results"), name, value)).drop("result", "failed")
        return out


def sandbox(rows: DataFrame, table: DataFrame, code: str = "code") -> DataFrame:
    """Adds status and stdout of code that ran before; table: key, status, stdout."""
    answers = table.select(F.col("key").alias("_key"), "status", "stdout")
    return rows.withColumn("_key", F.sha2(code, 256)).join(answers, "_key", "left").drop("_key").withColumn("status", F.coalesce("status", F.lit("exception")))


def call_tools(calls: DataFrame, registry: DataFrame, table: DataFrame) -> DataFrame:
    """calls: name, arguments. An unknown tool answers that it does not exist;
    a known one replays its answer; failures are text, never exceptions."""
    known = calls.join(registry.select("name", F.lit(True).alias("_known")), "name", "left")
    answers = table.select(F.col("tool").alias("name"), F.col("args_key").alias("_args"), "content")
    found = known.withColumn("_args", F.sha2("arguments", 256)).join(answers, ["name", "_args"], "left")
    text = F.when(F.col("_known").isNull(), F.concat(F.lit("Tool "), F.col("name"), F.lit(" does not exists."))).otherwise(F.coalesce("content", F.lit("An error occurred when calling the tool: no response")))
    return found.withColumn("content", text).drop("_known", "_args")


def agent_loop(tasks: DataFrame, ask: Provider, answer: Callable[[DataFrame], DataFrame], parse: Callable[[Column], Column], rounds: int = 20) -> DataFrame:
    """tasks: key, prompt. Model call, tool calls, results appended to the
    prompt, until a reply has no call or `rounds` are over. Adds response,
    n_calls and finished. `answer` takes (key, position, name, arguments) and
    adds content. The plan is bounded by rounds; each is written to the
    checkpoint folder, and rows that are done leave the loop."""
    open_, done = tasks.select("key", "prompt").withColumn("n_calls", F.lit(0)), None
    for i in range(rounds):
        replied = ask(open_).withColumn("_calls", parse(F.coalesce("response", F.lit("")))).drop("reasoning", "error")
        replied = replied.checkpoint()
        over = replied.filter((F.size("_calls") == 0) | (F.lit(i) == rounds - 1)).select("key", "prompt", "n_calls", "response", (F.size("_calls") == 0).alias("finished"))
        done = over if done is None else done.unionByName(over)
        more = replied.filter(F.size("_calls") > 0)
        if i == rounds - 1 or more.isEmpty():
            break
        calls = more.select("key", F.posexplode("_calls").alias("position", "c")).select("key", "position", "c.*")
        results = answer(calls).groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "content"))), lambda x: x["content"]), "\n").alias("_results"), F.count("*").cast("int").alias("_n"))
        open_ = more.join(results, "key").select("key", F.concat_ws("\n", "prompt", "response", "_results").alias("prompt"), (F.col("n_calls") + F.col("_n")).alias("n_calls"))
    return done

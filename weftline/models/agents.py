"""Agents of several steps as DataFrames: keyword generation, routing, group
chats and dialogues. Each step is a provider's model column; loops are bounded
by their rounds, write each round to the shared folder, and go on with the rows
that are still open. Prompt templates are the caller's data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.functions import text as T
from weftline.models.provider import Provider
from weftline.operators import joins, messages
from weftline.scratch import materialize

#: What ends a simulated dialogue, and what hands over to a person.
STOP = "<|STOP|>"
PENDING = "<!-- INTERRUPT: PENDING_USER_INPUT -->"
#: Fixed value: what is put behind a split that was cut at its first list.
SPLIT_END = '"]}'

_MESSAGES = "array<struct<name:string,content:string>>"


def keyword_request(query: Column, reply: Column, replace: bool = False) -> Column:
    """The reply's JSON object with the query as its `text`, unless it has one
    (or always, with `replace`); the query where the reply is no object. A
    repeated name counts as its last value, as JSON readers have it."""
    body = T.strip_fences(F.coalesce(reply, F.lit("")))
    members = F.from_json(F.when(S.strict_json(body).isNotNull() & body.startswith("{"), body), "map<string,variant>")
    text = F.create_map(F.lit("text"), query.cast("variant"))
    rest = F.map_filter(members, lambda k, _: k != "text") if replace else members
    whole = F.when(F.map_contains_key(rest, "text"), rest).otherwise(F.map_concat(rest, text))
    return F.when(members.isNotNull(), F.to_json(whole)).otherwise(query)


def split_query(rows: DataFrame, ask: Provider, template: str) -> DataFrame:
    """query to `information`: the retrieval half of a question, as long as it is
    not empty and no longer than the question, which stands in for it else. The
    model stops behind the first list, so its JSON is closed here."""
    asked = ask(rows.withColumn("prompt", T.fill(F.lit(template), {"{user_request}": F.col("query")})))
    said = T.strip_space(F.coalesce("response", F.lit("")))
    closed = F.when(said.endswith("}") | said.endswith("```"), said).otherwise(F.concat(said, F.lit(SPLIT_END)))
    listed = F.try_variant_get(S.strict_json(T.strip_fences(closed)), "$.information", "array<string>")
    found = T.strip_space(F.array_join(listed, "\n"))
    good = F.length(found).between(1, F.length("query"))
    return asked.withColumn("information", F.when(good, found).otherwise(F.col("query"))).drop("prompt", "response", "reasoning", "error")


def keyword_requests(rows: DataFrame, ask: Provider, template: str, split: str | None = None, vocabulary: str | None = None, tokens: int = 4000) -> DataFrame:
    """query to `request`, which `retrieval.keyword_terms` reads. The four
    strategies: a template alone; with `vocabulary`, a column that fills
    {ref_doc} up to `tokens`; with `split`, a template that shortens the query
    first; or both."""
    rows = split_query(rows, ask, split) if split else rows.withColumn("information", F.col("query"))
    # What a value brings is not filled again: the caller's question comes last.
    values = {"{ref_doc}": T.truncate_tokens(F.col(vocabulary), tokens)} if vocabulary else {}
    asked = ask(rows.withColumn("prompt", T.fill(F.lit(template), values | {"{user_request}": F.col("information")})))
    return asked.withColumn("request", keyword_request(F.col("information"), F.col("response"), replace=split is not None)).drop("prompt", "response", "reasoning", "error", "information")


def _asked(rows: DataFrame, speaker: str, agents: dict[str, Provider]) -> DataFrame:
    """Every row answered by the agent that it names."""
    parts = [ask(rows.filter(F.col(speaker) == name)) for name, ask in agents.items()]
    return reduce(DataFrame.unionByName, parts)


def route(tasks: DataFrame, router: Provider, agents: dict[str, Provider]) -> DataFrame:
    """key, prompt to response and agent: the router answers itself (agent is
    null), or calls an agent, whose answer replaces its own; an unknown one
    means the first."""
    said = materialize(router(tasks).withColumn("agent", T.routed_agent(F.coalesce("response", F.lit("")), list(agents))), "routed")
    own = said.filter("agent IS NULL")
    called = _asked(said.filter("agent IS NOT NULL").select("key", "prompt", "agent"), "agent", agents)
    return own.select("key", "agent", "response").unionByName(called.select("key", "agent", "response"))


def group_chat(chats: DataFrame, agents: dict[str, Provider], rounds: int = 3) -> DataFrame:
    """key, messages (array of name and content, never empty). Each round one
    agent speaks: those mentioned with @ in the order of their mention, else the
    next in turn. A blank reply ends the topic, a pending one waits for a
    person. Returns key and all messages."""
    names = list(agents)
    last = F.element_at("messages", -1)
    open_, done = chats.select("key", F.col("messages").cast(_MESSAGES).alias("messages"), F.array().cast("array<string>").alias("queue")), None
    for _ in range(rounds):
        queue = F.concat("queue", joins.mentioned(F.trim(last["content"]), names))
        turn = open_.withColumn("queue", queue).withColumn("speaker", F.coalesce(F.get("queue", F.lit(0)), messages.next_speaker(F.array(*map(F.lit, names)), last["name"])))
        line = lambda m: F.concat(m["name"], F.lit(": "), F.trim(m["content"]))
        said = F.filter("messages", lambda m: F.trim(F.coalesce(m["content"], F.lit(""))) != "")
        prompt = F.concat(F.array_join(F.transform(said, line), "\n"), F.lit("\n"), "speaker", F.lit(": "))
        replied = materialize(_asked(turn.withColumn("prompt", prompt), "speaker", agents).select("key", "messages", "queue", "speaker", F.coalesce("response", F.lit("")).alias("response")), "chat")
        added = F.concat("messages", F.array(F.struct(F.col("speaker").alias("name"), F.col("response").alias("content"))))
        silent, pending = F.trim("response") == "", F.col("response") == PENDING
        over = replied.filter(silent | pending).select("key", F.when(silent, F.col("messages")).otherwise(added).alias("messages"))
        done = over if done is None else done.unionByName(over)
        open_ = replied.filter(~(silent | pending)).select("key", added.alias("messages"), F.slice("queue", F.lit(2), F.greatest(F.size("queue") - 1, F.lit(0))).alias("queue"))
    rest = open_.select("key", "messages")
    return rest if done is None else done.unionByName(rest)


def dialogue(chats: DataFrame, user: Provider, assistant: Provider, rounds: int = 5) -> DataFrame:
    """key, messages (name is user or assistant; may be empty). A simulated user
    and an assistant in turn; the user, who sees the roles exchanged, ends it
    with the stop mark, which is not kept. Returns key and all messages."""
    other = lambda m: F.when(m["name"] == "user", "assistant").otherwise("user")
    seen = lambda name: F.array_join(F.transform("messages", lambda m: F.concat(name(m), F.lit(": "), m["content"])), "\n")
    added = lambda name: F.concat("messages", F.array(F.struct(F.lit(name).alias("name"), F.coalesce("response", F.lit("")).alias("content"))))
    last = F.try_element_at("messages", F.lit(-1))["name"]
    open_, done = chats.select("key", F.col("messages").cast(_MESSAGES).alias("messages")), None
    for _ in range(rounds):
        mine = F.coalesce(last == "assistant", F.lit(True))
        spoken = user(open_.filter(mine).withColumn("prompt", seen(other)))
        spoken = spoken.select("key", "messages", "response", F.coalesce(F.col("response").contains(STOP), F.lit(False)).alias("stop"))
        spoken = materialize(spoken.unionByName(open_.filter(~mine).select("key", "messages", F.lit(None).cast("string").alias("response"), F.lit(None).cast("boolean").alias("stop"))), "user")
        over = spoken.filter("stop").select("key", "messages")
        done = over if done is None else done.unionByName(over)
        heard = spoken.filter("stop IS NULL OR NOT stop").select("key", F.when(F.col("stop").isNull(), F.col("messages")).otherwise(added("user")).alias("messages"))
        answered = assistant(heard.withColumn("prompt", seen(lambda m: m["name"])))
        open_ = materialize(answered.select("key", added("assistant").alias("messages")), "assistant")
    return open_ if done is None else done.unionByName(open_)

"""Previous, next, islands, turns and running budgets over messages. Messages
are rows (record, idx, role, text, ...); scans run inside one record, which may be
longer than a task can hold (`operators/scan.py`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators import scan


def _logs(rows: DataFrame, record: str, order: str) -> scan.Ordered:
    return scan.ordered(rows, [record], [order])


def plan_segments(rows: DataFrame, record: str = "conv_id", order: str = "turn", role: str = "role", speaker: str = "assistant", tool: str = "tool", has_calls: Column | None = None) -> DataFrame:
    """Speaker rows behind a tool row, with calls, and with a later tool row."""
    out = _logs(rows, record, order).scan(_prev=scan.previous(role), _last=scan.largest(F.when(F.col(role) == tool, F.col(order)))).plain()
    calls = F.lit(True) if has_calls is None else has_calls
    return out.filter((F.col(role) == speaker) & (F.col("_prev") == tool) & calls & (F.col("_last") > F.col(order))).drop("_prev", "_last")


def _islands(logs: scan.Ordered, value: str) -> scan.Ordered:
    """The first row of a record, whose previous row is missing, opens island 1
    like any row that differs from the one before."""
    marked = logs.scan(_before=scan.previous(F.struct(F.col(value).alias("x"))))
    change = F.when(F.col("_before").isNotNull() & F.col("_before.x").eqNullSafe(F.col(value)), 0).otherwise(1)
    return marked.columns(_change=change).scan(island=scan.running_sum("_change"))


def islands(rows: DataFrame, record: str, order: str, value: str) -> DataFrame:
    """Adds island: the number of the maximal run of equal values, from 1."""
    return _islands(_logs(rows, record, order), value).plain().drop("_before", "_change")


def tool_batches(rows: DataFrame, record: str, order: str, role: str, tool: str) -> DataFrame:
    """Maximal runs of tool rows that have a follower which has a later tool
    row: record, island, first, last, n, follower."""
    marked = _islands(_logs(rows, record, order), role).scan(_next=scan.following(order), _last_tool=scan.largest(F.when(F.col(role) == tool, F.col(order)))).plain()
    runs = marked.filter(F.col(role) == tool).groupBy(record, "island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"), F.max_by("_next", order).alias("follower"), F.max("_last_tool").alias("_last_tool"))
    return runs.filter(F.col("follower").isNotNull() & (F.col("_last_tool") > F.col("follower"))).drop("_last_tool")


def first_exchange(rows: DataFrame, record: str, order: str, role: str, text: str) -> DataFrame:
    """The first assistant row, and the last user row before it."""
    out = _logs(rows, record, order).scan(_first=scan.smallest(F.when(F.col(role) == "assistant", F.col(order)))).plain()
    user = (F.col(role) == "user") & (F.col(order) < F.col("_first"))
    return out.groupBy(record).agg(F.max_by(F.when(user, F.col(text)), F.when(user, F.col(order))).alias("query"), F.min_by(F.when(F.col(role) == "assistant", F.col(text)), F.when(F.col(role) == "assistant", F.col(order))).alias("response")).filter("response IS NOT NULL")


def query_and_answer(rows: DataFrame, record: str, order: str, text: str) -> DataFrame:
    """Second message and last message."""
    out = _logs(rows, record, order).scan(_n=scan.running_sum(F.lit(1))).plain()
    return out.groupBy(record).agg(F.max(F.when(F.col("_n") == 2, F.col(text))).alias("query"), F.max_by(text, order).alias("answer"))


def turns(rows: DataFrame, record: str, order: str, role: str) -> DataFrame:
    """Adds turn_no: a user row opens a turn; 0 before the first."""
    return _logs(rows, record, order).scan(turn_no=scan.running_sum(F.when(F.col(role) == "user", 1).otherwise(0))).plain()


def last_turns(rows: DataFrame, record: str, order: str, role: str, n: int = 400) -> DataFrame:
    """The last n user turns, and any system row."""
    out = _logs(rows, record, order).scan(_back=scan.running_sum(F.when(F.col(role) == "user", 1).otherwise(0), backward=True)).plain()
    opens = F.when(F.col(role) == "user", F.col("_back")).otherwise(F.col("_back") + 1)
    return out.filter((opens <= n) | (F.col(role) == "system")).drop("_back")


def budget_suffix(rows: DataFrame, record: str, order: str, role: str, cost: str, budget: int) -> DataFrame:
    """System rows, and the newest others whose costs, summed from the end, stay
    within the budget that the system rows leave. Whole rows only."""
    system = F.col(role) == "system"
    out = _logs(rows, record, order).scan(
        _system=scan.total(F.when(system, F.col(cost)).otherwise(0)),
        _spent=scan.running_sum(F.when(system, 0).otherwise(F.col(cost)), backward=True),
    )
    return out.plain().filter(system | (F.col("_spent") <= F.lit(budget) - F.col("_system"))).drop("_system", "_spent")


def truncate_messages(messages: Column, budget: int) -> Column:
    """The exact rule over array<struct<role,content,tokens>>, newest first: a
    row that fits is kept; a user row that does not is cut to what is left,
    unless it is the last, and ends it; a function row is cut on both sides and
    the walk goes on with the same budget; any other ends it. The result has
    the same struct; system rows stay."""
    from weftline.functions import text as T

    size = F.size(messages)
    system = F.filter(messages, lambda m: m["role"] == "system")
    left = F.lit(budget) - F.aggregate(system, F.lit(0), lambda a, m: a + m["tokens"].cast("int"))
    others = F.reverse(F.filter(F.transform(messages, lambda m, i: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["tokens"].cast("int").alias("tokens"), (i == size - 1).alias("newest"))), lambda m: m["role"] != "system"))
    kind = "array<struct<role:string,content:string,tokens:int>>"

    def step(acc: Column, m: Column) -> Column:
        fits = m["tokens"] <= acc["left"]
        user, function = (m["role"] == "user") & ~m["newest"], m["role"] == "function"
        content = F.when(fits, m["content"]).when(function, T.truncate_tokens(m["content"], acc["left"], both_sides=True)).otherwise(T.truncate_tokens(m["content"], acc["left"]))
        new = F.struct(m["role"].alias("role"), content.alias("content"), F.least(m["tokens"], acc["left"]).alias("tokens"))
        takes = ~acc["done"] & (fits | user | function)
        return F.struct(
            F.when(takes, F.concat(F.array(new), acc["kept"])).otherwise(acc["kept"]).cast(kind).alias("kept"),
            F.when(~acc["done"] & fits, acc["left"] - m["tokens"]).otherwise(acc["left"]).alias("left"),
            (acc["done"] | (~fits & ~function)).alias("done"),
        )

    start = F.struct(F.array().cast(kind).alias("kept"), left.alias("left"), F.lit(False).alias("done"))
    kept = F.aggregate(others, start, step)["kept"]
    return F.concat(F.transform(system, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["tokens"].cast("int").alias("tokens"))), kept)


def merge_adjacent(rows: DataFrame, record: str, order: str, speaker: str, text: str, separator: str = "\n") -> DataFrame:
    """Runs of one speaker's rows as one row, texts joined in order."""
    marked = islands(rows, record, order, speaker)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"]), separator)
    return marked.groupBy(record, "island", speaker).agg(F.min(order).alias(order), F.count("*").alias("n"), joined.alias(text))


def as_seen_by(rows: DataFrame, record: str, order: str, name: str, text: str, me: str) -> DataFrame:
    """One speaker's view: own rows are assistant, all others are user with
    their names in front; neighbours of one role merge."""
    role = F.when(F.col(name) == me, "assistant").otherwise("user")
    line = F.when(F.col(name) == me, F.col(text)).otherwise(F.concat(F.col(name), F.lit(": "), F.col(text)))
    return merge_adjacent(rows.select(record, order, role.alias("role"), line.alias(text)), record, order, "role", text)


def next_speaker(names: Column, last: Column) -> Column:
    """Round robin; the first where the last speaker is unknown."""
    at = F.coalesce(F.array_position(names, last), F.lit(0))
    return F.element_at(names, (F.pmod(at, F.size(names)) + 1).cast("int"))


def swap_roles(rows: DataFrame, role: str, text: str) -> DataFrame:
    """user and assistant change places; function rows and blanks go."""
    kept = rows.filter((F.col(role) != "function") & (F.trim(F.coalesce(F.col(text), F.lit(""))) != ""))
    return kept.withColumn(role, F.when(F.col(role) == "user", "assistant").when(F.col(role) == "assistant", "user").otherwise(F.col(role)))


def sections(lines: DataFrame, record: str, order: str, text: str) -> DataFrame:
    """Roman-numeral headings with the next heading: what a section spans."""
    heads = lines.filter(F.trim(text).rlike(r"^(I|V|X|L|C|D|M)+\."))
    return _logs(heads, record, order).scan(next_heading=scan.following(text)).plain()


def similar_size_paragraphs(elements: DataFrame, record: str, order: str, size: str, text: str, within: float = 2.0) -> DataFrame:
    """Neighbours whose font sizes differ by less than `within` are one
    paragraph."""
    sized = _logs(elements, record, order).scan(_before=scan.previous(size))
    new = F.when(F.abs(F.col(size) - F.col("_before")) < within, 0).otherwise(1)
    marked = sized.columns(_new=new).scan(paragraph=scan.running_sum("_new")).plain()
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"]), "")
    return marked.groupBy(record, "paragraph").agg(F.max(size).alias(size), joined.alias(text))


def chat_template(rows: DataFrame, record: str, order: str, role: str, text: str) -> DataFrame:
    """<|im_start|>role ... <|im_end|> text of each record, open for the answer."""
    line = F.concat(F.lit("<|im_start|>"), F.col(role), F.lit("\n"), F.col(text), F.lit("<|im_end|>\n"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("t")))), lambda x: x["t"]), "")
    return rows.groupBy(record).agg(F.concat(joined, F.lit("<|im_start|>assistant\n")).alias("prompt"))

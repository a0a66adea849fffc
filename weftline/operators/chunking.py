"""Documents to overlapping chunks of bounded token counts, in the JVM.

Packing is a fold over one document's paragraphs: a higher-order aggregate over
their array, without a shuffle of its own and without Python. Its state is the
chunks so far, the overlap that the open chunk begins with, the paragraphs in it
and the tokens it has room for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T

#: Default tokens of a chunk, and signs of the last chunk that the next begins with.
CHUNK_TOKENS, OVERLAP = 500, 150
STOPS = r"\. |。"

_PART = "struct<page:int,text:string>"
_STATE = f"struct<done:array<struct<content:string,token:int>>,page:int,overlap:string,fresh:array<{_PART}>,room:int>"


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _state(done: Column, page: Column, overlap: Column, fresh: Column, room: Column) -> Column:
    return F.struct(done.alias("done"), page.alias("page"), overlap.alias("overlap"), fresh.alias("fresh"), room.alias("room")).cast(_STATE)


def _tail(parts: Column) -> Column:
    """Whole paragraphs, then whole sentences, from the end of the last page of
    a chunk's own paragraphs, as far as OVERLAP signs reach."""
    kind = "struct<kept:string,room:int,over:boolean>"
    last = F.element_at(parts, -1)["page"]

    def took(a: Column, text: Column, joint: Column) -> Column:
        kept = F.when(a["kept"] != "", F.concat(text, joint, a["kept"])).otherwise(text)
        return F.struct(kept.alias("kept"), (a["room"] - F.length(text)).alias("room"), F.lit(False).alias("over")).cast(kind)

    def ended(a: Column) -> Column:
        return F.struct(a["kept"].alias("kept"), a["room"].alias("room"), F.lit(True).alias("over")).cast(kind)

    def step(a: Column, part: Column) -> Column:
        text = part["text"]
        stop = F.when(text.contains("。"), "。").otherwise(". ")
        sentences = F.reverse(F.filter(F.transform(F.split(text, STOPS), T.strip_space), lambda s: s != ""))
        by_sentence = F.aggregate(sentences, a, lambda b, s: F.when(b["over"], b).when(F.length(s) <= b["room"], took(b, s, stop)).otherwise(ended(b)))
        return F.when(a["over"], a).when(part["page"] != last, ended(a)).when(F.length(text) <= a["room"], took(a, text, F.lit("\n"))).otherwise(by_sentence)

    start = F.struct(F.lit("").alias("kept"), F.lit(OVERLAP).alias("room"), F.lit(False).alias("over")).cast(kind)
    return F.aggregate(F.reverse(parts), start, step)["kept"]


def _body(s: Column) -> Column:
    """The text of a chunk: it names the page of what it begins with, and each
    new page inside it."""
    first = F.array(F.struct(s["page"].alias("page"), s["overlap"].alias("text")).cast(_PART))
    parts = F.when(s["overlap"] != "", F.concat(first, s["fresh"])).otherwise(s["fresh"])
    header = lambda x: F.concat(F.lit("[page: "), x["page"].cast("string"), F.lit("]\n"))
    lines = _let(parts, lambda p: F.transform(p, lambda x, i: F.concat(F.when((i == 0) | (F.get(p, i - 1)["page"] != x["page"]), header(x)).otherwise(""), x["text"])))
    return F.array_join(lines, "\n")


def _flushed(s: Column, size: int) -> Column:
    chunk = F.array(F.struct(_body(s).alias("content"), (F.lit(size) - s["room"]).alias("token")))
    begun = lambda o: _state(F.concat(s["done"], chunk), F.element_at(s["fresh"], -1)["page"], o, F.array(), F.lit(size) - T.token_count(o))
    return _let(_let(_tail(s["fresh"]), lambda o: F.when(T.strip_space(o) != "", o).otherwise("")), begun)


def _pieces(text: Column, room: Column) -> Column:
    """Sentences of a paragraph that does not fit, those that exceed the room in
    windows of its tokens: array of (s, n)."""
    one = lambda s, n: F.struct(s.alias("s"), n.cast("int").alias("n"))
    width = F.greatest(room, F.lit(1))

    def windows(s: Column) -> Column:
        return _let(T.spaced_tokens(s), lambda t: F.transform(F.sequence(F.lit(0), F.size(t) - 1, width), lambda i: one(F.array_join(F.slice(t, i + 1, width), ""), F.least(width, F.size(t) - i))))

    counted = F.filter(F.transform(F.split(text, STOPS), lambda s: one(s, T.token_count(s))), lambda x: (T.strip_space(x["s"]) != "") & (x["n"] > 0))
    return F.flatten(F.transform(counted, lambda x: F.when(x["n"] <= room, F.array(x)).otherwise(windows(x["s"]))))


def _packed(parts: Column, size: int) -> Column:
    """array<struct<page,text>> to array<struct<content,token>>."""

    def added(s: Column, page: Column, text: Column, n: Column) -> Column:
        part = F.array(F.struct(page.alias("page"), text.alias("text")).cast(_PART))
        return _state(s["done"], s["page"], s["overlap"], F.concat(s["fresh"], part), s["room"] - n)

    def closed(s: Column, n: Column) -> Column:
        """The state with a new chunk where n tokens do not fit the one that is open."""
        return F.when((n > s["room"]) & (F.size(s["fresh"]) > 0), _flushed(s, size)).otherwise(s)

    def step(s: Column, part: Column) -> Column:
        n = T.token_count(part["text"])

        def place(now: Column) -> Column:
            pieces = F.aggregate(_pieces(part["text"], now["room"]), now, lambda b, x: _let(closed(b, x["n"]), lambda c: added(c, part["page"], x["s"], x["n"])))
            return F.when(n <= now["room"], added(now, part["page"], part["text"], n)).otherwise(pieces)

        return _let(closed(s, n), place)

    start = _state(F.array(), F.lit(0), F.lit(""), F.array(), F.lit(size))
    return F.aggregate(parts, start, step, lambda s: F.when(F.size(s["fresh"]) > 0, _flushed(s, size)).otherwise(s)["done"])


def _exploded(packed: DataFrame, url: str) -> DataFrame:
    return packed.select(F.col(url).cast("string").alias("url"), F.posexplode("chunks").alias("chunk_id", "chunk")).select("url", "chunk_id", "chunk.content", "chunk.token")


def chunk(docs: DataFrame, url: str, text: str, size: int = CHUNK_TOKENS) -> DataFrame:
    """url, chunk_id, content, token. The text's lines are the paragraphs of
    one page. Documents are dealt out by url, so that all cores work, whatever
    row groups the input has."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = F.filter(F.split(F.col(text).cast("string"), "\n"), lambda p: T.strip_space(p) != "")
    parts = F.transform(lines, lambda p: F.struct(F.lit(1).alias("page"), p.alias("text")))
    return _exploded(docs.select(url, text).repartition(partitions, url).select(url, _packed(parts, size).alias("chunks")), url)


def chunk_pages(rows: DataFrame, url: str = "path", page: str = "page_num", order: str = "paragraph", text: str = "text", size: int = CHUNK_TOKENS) -> DataFrame:
    """The same from rows of paragraphs on numbered pages (`documents.parse`)."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(page).alias("page"), F.col(order).alias("at"), F.col(text).alias("text"))))
    parts = F.transform(listed, lambda x: F.struct(x["page"].alias("page"), x["text"].alias("text")))
    return _exploded(rows.groupBy(url).agg(parts.alias("parts")).select(url, _packed(F.col("parts"), size).alias("chunks")), url)

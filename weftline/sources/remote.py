"""Answers of remote sources as tables. A source is a provider (see
models/provider.py) or a table of what was fetched before; these functions turn
its answers into the rows and texts that the rest of the engine reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.functions import text as T

#: Replies of a tool session without text, and with its errors.
NO_TEXT = {"call_tool": "execute error", "read_resource": "Failed to read resource", "list_resources": "No resources found"}


def fetched(urls: DataFrame, table: DataFrame, url: str = "url") -> DataFrame:
    """Adds name (the file's, from its URL), content and error to rows with a
    URL; table: url, status, content, one row a URL. A missing one, and a status
    other than 200, is an error, never an exception."""
    answers = table.select(F.col("url").alias("_url"), F.col("status").alias("_status"), F.col("content").alias("_content"))
    found = urls.join(answers, F.col(url) == F.col("_url"), "left")
    ok = F.coalesce(F.col("_status") == 200, F.lit(False))
    error = F.when(~ok, F.concat(F.lit("can not download "), F.coalesce(url, F.lit("null")), F.lit(": status "), F.coalesce(F.col("_status").cast("string"), F.lit("unknown"))))
    return found.withColumns({"name": T.basename(F.col(url)), "content": F.when(ok, F.col("_content")), "error": error}).drop("_url", "_status", "_content")


def session_reply(parts: Column, kind: Column | str = "call_tool") -> Column:
    """Parts (kind, text) of a tool session's answer to its text: text parts with
    a blank line between them; a fixed reply without any."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    texts = F.transform(F.filter(parts, lambda p: (p["kind"] == "text") & p["text"].isNotNull()), lambda p: p["text"])
    empty = F.coalesce(*[F.when(kind == k, v) for k, v in NO_TEXT.items()], F.lit(NO_TEXT["call_tool"]))
    return F.when(F.coalesce(F.size(texts), F.lit(0)) > 0, F.array_join(texts, "\n\n")).otherwise(empty)


def rest_reply(status: Column, body: Column) -> Column:
    """One line of JSON: code, and data with a message or an error with its
    first 500 signs. No status is a failed connection. Data is JSON where the
    body is, else text."""
    code = F.coalesce(status, F.lit(503)).cast("string")
    inner = lambda s: F.regexp_extract(F.to_json(F.struct(s.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    data = F.coalesce(S.whole_json(T.strip_space(body)), inner(F.coalesce(body, F.lit(""))))
    message = F.when(S.whole_json(T.strip_space(body)).isNotNull(), "Success").otherwise("Success (non-JSON response)")
    good = F.concat(F.lit('{"code":'), code, F.lit(',"data":'), data, F.lit(',"message":"'), message, F.lit('"}'))
    detail = F.when(F.coalesce(body, F.lit("")) == "", "No error details").otherwise(F.left(body, F.lit(500)))
    name = F.when(status.isNull(), "Connection Error").when(status == 408, "Request Timeout").otherwise(F.concat(F.lit("HTTP "), code, F.lit(" error")))
    bad = F.concat(F.lit('{"code":'), code, F.lit(',"error":"'), name, F.lit('","detail":'), inner(detail), F.lit(',"data":null}'))
    return F.when(status.between(200, 299), good).otherwise(bad)

"""Search over chunks: BM25, TF-IDF, vectors, front page, rank fusion, token
budgets. Chunks are rows (doc, chunk_id, text, token); rankings carry their
tie-break; a search is rows (query, doc, chunk_id, score)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.functions import structured as S
from weftline.functions import text as T
from weftline.functions.stem import stem
from weftline.operators import lexicon, scan
from weftline.scratch import materialize


def terms(df: DataFrame, keys: list[str], text: str, stemmed: bool = True, cut=None) -> DataFrame:
    """keys, term, tf. Texts are dealt out by their keys before they are cut into
    tokens, so that all cores work, whatever row groups the input has; no later
    step shuffles tokens then. Equal raw tokens of a text are counted before they
    are cleaned and stemmed; a token is cleaned once (what an explode makes,
    filters and aggregates above can't ask for again). Stop words go before and
    after stemming. With a segmenter `cut` (`operators/lexicon.py`) Chinese is cut
    into its words, otherwise into pairs of signs."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.select(*keys, text).repartition(partitions, *keys)
    pieces = T.word_pieces(F.col(text)) if cut is None else F.concat(T.raw_tokens(F.regexp_replace(text, lexicon.RUN, " ")), lexicon.words(F.col(text), cut))
    raw = df.select(*keys, F.explode(pieces).alias("raw")).groupBy(*keys, "raw").agg(F.count("*").alias("n"))
    clean = raw.select(*keys, "n", F.explode(F.array(T.clean_token(F.col("raw")))).alias("term"))
    return _counted(clean, keys, stemmed)


def _counted(words: DataFrame, keys: list[str], stemmed: bool) -> DataFrame:
    """keys, term, n to keys, term, tf without stop words."""
    kept = (F.col("term") != "") & ~F.col("term").isin(T.STOP_WORDS)
    words = words.filter(kept)
    if stemmed:
        words = words.withColumn("term", stem(F.col("term"))).filter(kept)
    return words.groupBy(*keys, "term").agg(F.sum("n").alias("tf"))


def keyword_terms(requests: DataFrame, keys: list[str], request: str, stemmed: bool = True) -> DataFrame:
    """keys, term, tf of search requests: a JSON object with text and lists
    keywords_zh and keywords_en, whose members are terms as they are, in lower
    case; any other request is plain text. A list that is none, or null, adds
    nothing. Without a text in the object, it counts as plain text itself."""
    v = S.strict_json(T.strip_space(F.col(request)))
    listed = [F.coalesce(F.try_variant_get(v, f"$.{c}", "array<string>"), F.array().cast("array<string>")) for c in ("keywords_zh", "keywords_en")]
    said = F.try_variant_get(v, "$.text", "string")
    rows = requests.select(*keys, F.coalesce(said, F.col(request)).alias("_text"), F.when(said.isNotNull(), F.concat(*listed)).alias("_listed"))
    given = _counted(rows.select(*keys, F.explode("_listed").alias("term")).select(*keys, F.lower("term").alias("term"), F.lit(1).alias("n")), keys, stemmed)
    return given.unionByName(terms(rows, keys, "_text", stemmed)).groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))


def corpus_stats(tf: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(term, df) and one row (n, avgdl, length of nothing counted): statistics
    of all documents that have terms."""
    lengths = tf.groupBy(*keys).agg(F.sum("tf").alias("dl"))
    return tf.groupBy("term").agg(F.count("*").alias("df")), lengths.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))


#: Postings of a term that one task joins; a longer list is dealt out by document.
POSTINGS = 100_000


@dataclass(frozen=True)
class Search:
    """What BM25 needs of one set of queries and the documents, written once."""

    #: query, term, slot, a (the query's weight of the term), df, most (the term's greatest w).
    weights: DataFrame
    #: term, slot, keys, w (the document's part of the term's score).
    postings: DataFrame
    query: str
    keys: list[str]

    def hits(self, weights: DataFrame) -> DataFrame:
        """query, keys, a * w of the postings of these terms."""
        return weights.join(self.postings, ["term", "slot"]).select(self.query, *self.keys, (F.col("a") * F.col("w")).alias("part"))

    def sums(self, weights: DataFrame) -> DataFrame:
        return self.hits(weights).groupBy(self.query, *self.keys).agg(F.sum("part").alias("score"))


def prepared(chunks: DataFrame, queries: DataFrame, keys: list[str], query: str, text: str = "text", query_text: str = "text", stemmed: bool = True) -> Search:
    """The texts are read and cut into tokens once. Query terms count as often as
    they occur; a negative idf becomes a quarter of the vocabulary's mean."""
    doc = W.partitionBy(*keys)
    counted = terms(chunks, keys, text, stemmed).withColumns({"dl": F.sum("tf").over(doc), "one": F.when(F.min("term").over(doc) == F.col("term"), 1).otherwise(0)})
    tf = materialize(counted, "terms")
    totals = tf.agg(F.sum("one").alias("n"), (F.sum("tf") / F.sum("one")).alias("avgdl"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    raw = F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    idf = materialize(df.join(F.broadcast(totals)).withColumn("idf", raw), "idf")
    mean = F.broadcast(idf.agg(F.avg("idf").alias("mean_idf")))
    asked = keyword_terms(queries, [query], query_text, stemmed).withColumnRenamed("tf", "qtf")
    weighed = asked.join(idf, "term").join(mean).withColumn("idf", F.when(F.col("idf") < 0, 0.25 * F.col("mean_idf")).otherwise(F.col("idf")))
    weighed = materialize(weighed.select(query, "term", (F.col("qtf") * F.col("idf")).alias("a"), "df", "avgdl"), "weights")
    vocabulary = weighed.groupBy("term").agg(F.first("df").alias("df"), F.first("avgdl").alias("avgdl"))
    w = S.bm25(F.col("tf"), F.lit(1.0), F.col("dl"), F.col("avgdl"))
    slot = F.pmod(F.xxhash64(*keys), F.floor(F.col("df") / POSTINGS) + 1)
    # Terms with more than POSTINGS are at most one in POSTINGS postings.
    long, short = F.broadcast(vocabulary.filter(F.col("df") > POSTINGS)), vocabulary.filter(F.col("df") <= POSTINGS)
    found = tf.join(long, "term").unionByName(tf.join(short, "term"))
    postings = materialize(found.select("term", slot.alias("slot"), *keys, w.alias("w")), "postings")
    most = postings.groupBy("term").agg(F.max("w").alias("most"))
    slots = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("df") / POSTINGS)))
    return Search(materialize(weighed.drop("avgdl").join(most, "term").withColumn("slot", slots), "weights"), postings, query, keys)


def bm25(chunks: DataFrame, queries: DataFrame, keys: list[str], query: str, text: str = "text", query_text: str = "text", stemmed: bool = True) -> DataFrame:
    """query, keys, score of all chunks that share a term with a query, which is
    text or a keyword request. For the best ones alone, see `bm25_top`."""
    search = prepared(chunks, queries, keys, query, text, query_text, stemmed)
    return search.sums(search.weights)


#: Postings a wanted result that the first, rarest terms of a query are read for.
SEEDS = 50


def bm25_top(chunks: DataFrame, queries: DataFrame, keys: list[str], query: str, k: int, text: str = "text", query_text: str = "text", stemmed: bool = True, places: int = 6, read: dict | None = None) -> DataFrame:
    """query, keys, score, rank of the k best chunks of each query, scores rounded
    to `places`, equal ones by keys: the same rows as a ranking of `bm25`, without
    scoring all that share a term.

    1. The rarest terms alone give partial scores; the k-th of a query bounds its
       k-th score from below.
    2. Terms by their greatest contribution, least first: as long as their sum
       stays below the bound, a chunk with only these cannot be among the best.
       Only postings of the other terms are joined.
    3. Chunks whose partial score and all that was left out stay below the
       bound, which these partial scores have raised, go. The rest is completed.

    A query with a negative weight has no bounds and is scored in full. `read`,
    where given, is told how many postings and pairs were looked at in each step."""
    search, slack = prepared(chunks, queries, keys, query, text, query_text, stemmed), 2 * 10.0**-places
    by_query = W.partitionBy(query)
    terms_of = search.weights.filter("slot = 0")

    def kth(scores: DataFrame, name: str) -> DataFrame:
        best = scores.withColumn("_at", F.row_number().over(by_query.orderBy(F.desc("score"), *keys))).filter(F.col("_at") <= k)
        return best.groupBy(query).agg(F.when(F.count("*") == k, F.min("score")).alias(name))

    upto = W.partitionBy(query).orderBy("df", "term").rowsBetween(W.unboundedPreceding, -1)
    seeds = terms_of.withColumn("_before", F.coalesce(F.sum("df").over(upto), F.lit(0))).filter(F.col("_before") < SEEDS * k).select(query, "term")
    first = kth(search.sums(search.weights.join(seeds, [query, "term"], "left_semi")), "bound")
    signs = terms_of.groupBy(query).agg((F.min("a") < 0).alias("negative"))
    bounds = signs.join(first, query, "left").select(query, F.when(F.col("negative"), None).otherwise(F.col("bound")).alias("bound"))
    most = F.col("a") * F.col("most")
    sums = F.sum(most).over(by_query.orderBy(most, "term").rowsBetween(W.unboundedPreceding, 0))
    split = materialize(terms_of.join(bounds, query).select(query, "term", "bound", most.alias("ub"), F.coalesce(sums < F.col("bound") - slack, F.lit(False)).alias("spare")), "split")
    needed = search.weights.join(split.filter("NOT spare").select(query, "term"), [query, "term"], "left_semi")
    partial = materialize(search.sums(needed), "partial")
    rest = split.groupBy(query).agg(F.sum(F.when(F.col("spare"), F.col("ub")).otherwise(0.0)).alias("rest"), F.first("bound").alias("bound"))
    limits = rest.join(kth(partial, "raised"), query, "left").select(query, "rest", F.when(F.col("bound").isNotNull(), F.greatest("bound", "raised")).alias("bound"))
    kept = materialize(partial.join(limits, query).filter("bound IS NULL OR score + rest >= bound - %r" % slack).select(query, *keys, "score"), "kept")
    spare = search.weights.join(split.filter("spare").select(query, "term"), [query, "term"], "left_semi")
    missing = kept.select(query, *keys).join(spare.filter("slot = 0").select(query, "term", "a"), query)
    filled = missing.join(search.postings.select("term", *keys, "w"), ["term", *keys]).select(query, *keys, (F.col("a") * F.col("w")).alias("score"))
    whole = kept.unionByName(filled).groupBy(query, *keys).agg(F.round(F.sum("score"), places).alias("score"))
    if read is not None:
        read |= {"postings": search.hits(needed).count(), "all_postings": search.hits(search.weights).count(), "completed": kept.count(), "partial": partial.count()}
    return top_k(whole, [query], keys, k)


def ranked(scores: DataFrame, query: list[str], ties: list[str], alias: str = "rank", ascending: bool = False) -> DataFrame:
    """Adds the rank in its query; equal scores by `ties`."""
    order = F.col("score").asc() if ascending else F.col("score").desc()
    return scores.withColumn(alias, F.row_number().over(W.partitionBy(*query).orderBy(order, *ties)))


def top_k(scores: DataFrame, query: list[str], ties: list[str], k: int, ascending: bool = False) -> DataFrame:
    """The k best of each query; Spark keeps k a partition before the shuffle."""
    return ranked(scores, query, ties, ascending=ascending).filter(F.col("rank") <= k)


def rank_all(scores: DataFrame, query: list[str], ties: list[str], alias: str = "rank") -> DataFrame:
    """Rank of every row in its query, best first, equal scores by `ties`; a
    query with more rows than a task should rank is ranked by ranges."""
    rows = scores.withColumn("_least", -F.col("score"))
    return scan.ordered(rows, query, ["_least", *ties]).scan(**{alias: scan.running_sum(F.lit(1))}).plain().drop("_least")


def fuse(rankings: list[DataFrame], keys: list[str], k: int = 60) -> DataFrame:
    """keys, score: sum of 1 / (rank + k) over the rankings that have a key."""
    rows = [r.select(*keys, S.rrf_weight(F.col("rank"), k).alias("w")) for r in rankings]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    return every.groupBy(*keys).agg(F.sum("w").alias("score"))


def fuse_with_common(ranking: DataFrame, common: DataFrame, queries: DataFrame, query: str, doc: str, most: int, k: int = 60) -> DataFrame:
    """query, doc, score that can be among the `most` best of each query when its
    `ranking` (query, doc, rank) is fused with a ranking that all queries share
    (doc, rank). A doc that only the common one ranks has that many better ones
    unless it is among its first `most`; so no others are looked at."""
    both = ranking.join(common.select(doc, F.col("rank").alias("_common")), doc, "left")
    fused = both.select(query, doc, (S.rrf_weight(F.col("rank"), k) + F.coalesce(S.rrf_weight(F.col("_common"), k), F.lit(0.0))).alias("score"))
    first = common.filter(F.col("rank") <= most).select(doc, S.rrf_weight(F.col("rank"), k).alias("score"))
    alone = queries.select(query).distinct().join(F.broadcast(first))
    return fused.unionByName(alone.select(query, doc, "score")).groupBy(query, doc).agg(F.max("score").alias("score"))


def front_pins(chunks: DataFrame, budget: int, doc: str | None = None) -> DataFrame:
    """Chunks 0 and 1 of a single document, or of each `doc`, get an infinite
    score, as long as four times their tokens fit the budget; the first that
    does not stops it."""
    w = W.partitionBy(*([doc] if doc else [])).orderBy("chunk_id").rowsBetween(W.unboundedPreceding, 0)
    first = chunks.filter(F.col("chunk_id") < 2)
    return first.withColumn("_ok", F.min((F.lit(budget) >= F.col("token") * 4).cast("int")).over(w)).filter("_ok = 1").drop("_ok").withColumn("score", F.lit(float("inf")))


def within_budget(rows: DataFrame, group: list[str], order: list[Column], budget: Column | int, token: str = "token", text: str | None = None) -> DataFrame:
    """Best first while the budget lasts; the row that crosses it is cut to what
    is left, and ends it. Adds used (tokens kept) and cut."""
    spent = F.sum(token).over(W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    limit = F.lit(budget) if isinstance(budget, int) else budget
    out = rows.withColumns({"_spent": spent, "_limit": limit}).filter(F.col("_spent") - F.col(token) < F.col("_limit"))
    out = out.withColumns({"cut": F.col("_spent") > F.col("_limit"), "used": F.least(F.col(token), F.col("_limit") - F.col("_spent") + F.col(token))})
    if text:
        out = out.withColumn(text, F.when(F.col("cut"), T.truncate_tokens(F.col(text), F.col("used").cast("int"))).otherwise(F.col(text)))
    return out.drop("_spent", "_limit")


def regroup(rows: DataFrame, doc: str, chunk: str, text: str) -> DataFrame:
    """doc and its kept texts in chunk order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(chunk).alias("c"), F.col(text).alias("t")))), lambda x: x["t"])
    return rows.groupBy(doc).agg(listed.alias("text"))


def front_part(chunks: DataFrame, doc: str, budget: int, text: str | None = None) -> DataFrame:
    """An equal share of the budget for each document's beginning."""
    n = F.broadcast(chunks.agg(F.count_distinct(doc).alias("_docs")))
    rows = chunks.join(n).withColumn("_share", F.floor(F.lit(budget) / F.greatest("_docs", F.lit(1))))
    return within_budget(rows, [doc], [F.col("chunk_id")], F.col("_share"), text=text).drop("_docs", "_share")


def search_sessions(chunks: DataFrame, scores: DataFrame, session: str, doc: str, budget: int) -> DataFrame:
    """The context of every session (never null): session, doc, chunk_id, text,
    used. Everything where it fits the budget; the front part where no chunk
    scores; else the best chunks within the budget. Chunks and scores hold the
    session."""
    found = chunks.join(scores, [session, doc, "chunk_id"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    facts = found.groupBy(session).agg(F.count_distinct(doc).alias("_docs"), F.sum("token").alias("_total"), F.max("score").alias("_best"))
    rows = found.join(facts, session)
    fits, hit = F.col("_total") <= budget, F.col("_best") > 0
    everything = rows.filter(fits).withColumn("used", F.col("token"))
    front = within_budget(rows.filter(~fits & ~hit), [session, doc], [F.col("chunk_id")], F.floor(F.lit(budget) / F.greatest("_docs", F.lit(1))), text="text")
    chosen = within_budget(rows.filter(~fits & hit), [session], [F.desc("score"), F.col(doc), F.col("chunk_id")], budget, text="text")
    parts = [p.select(session, doc, "chunk_id", "text", F.col("used").cast("bigint").alias("used")) for p in (everything, front, chosen)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def tfidf_vocabulary(tf: DataFrame, doc: str) -> DataFrame:
    """term, weight: smoothed idf, weights of a document scaled to length 1,
    summed over documents. `tf` is written, as it is read three times."""
    tf = materialize(tf, "postings")
    n = F.broadcast(tf.agg(F.count_distinct(doc).alias("n")))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    # Terms of more than POSTINGS documents are at most one in POSTINGS postings.
    long, short = F.broadcast(df.filter(F.col("df") > POSTINGS)), df.filter(F.col("df") <= POSTINGS)
    rows = tf.join(long, "term").unionByName(tf.join(short, "term"))
    rows = rows.join(n).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    scaled = rows.select("term", (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(doc)))).alias("w"))
    return scaled.groupBy("term").agg(F.sum("w").alias("weight"))

"""Search over documents and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import lexicon, retrieval
from weftline.operators import vectors as vectors_of
from weftline.plans.registry import query
from weftline.scratch import materialize

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in T.STOP_WORDS)
_PUNCTUATION = T.PUNCTUATION.replace("'", "''")
#: The same tokens in DuckDB: its regular expressions know \p{L}, \p{N} and \p{M} only by name.
_W = r"[\p{L}\p{N}\p{M}_]"
_TOKENS = rf"""
    tok AS (SELECT id, unnest(regexp_extract_all(trim(lower(text)), '(?:[A-Za-z]\.)+|\d+(?:\.\d+)?%?|{_W}+(?:[-'']{_W}+)*')) AS w FROM src),
    cl AS (SELECT id, CASE WHEN regexp_matches(w, '^(?:[A-Za-z]\.)+|\d+%$') THEN w ELSE trim(w, '{_PUNCTUATION}') END AS term FROM tok),
    tf AS (SELECT id, term, count(*) AS tf FROM cl WHERE term <> '' AND term NOT IN ({_STOP}) AND trim(term, '{_PUNCTUATION}') <> '' GROUP BY ALL)
"""


@query(f"WITH src AS (SELECT doc_id AS id, text FROM documents), {_TOKENS} SELECT term, count(*) AS df FROM tf GROUP BY 1")
def token_stats(t):
    return retrieval.corpus_stats(retrieval.terms(t("documents"), ["doc_id"], "text", stemmed=False), ["doc_id"])[0]


#: A lexicon in which the greedy cut (longest word first) is not the best one.
_LEXICON = [("研究", -2.0), ("研究生", -3.0), ("生命", -2.5), ("命", -6.0), ("研", -7.0), ("究", -7.0), ("生", -6.0), ("命研", -9.0)]


@query(rf"""
    WITH zh AS (SELECT doc_id AS id, regexp_replace(text, '[ \n]', '研究生命', 'g') AS text FROM documents WHERE doc_id % 2 = 0),
    src AS (SELECT id, regexp_replace(text, '[一-鿿]+', ' ', 'g') AS text FROM zh UNION ALL SELECT doc_id, text FROM documents WHERE doc_id % 2 = 1), {_TOKENS},
    w AS (SELECT id, unnest(['研究', '生命']) AS term, (length(text) - length(replace(text, '研究生命', ''))) // 4 AS tf FROM zh)
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf FROM (FROM tf UNION ALL FROM w WHERE tf > 0) GROUP BY 1
""")
def chinese_terms(t):
    """half the texts with Chinese for blanks, cut by a fixed lexicon; the
    others as they are."""
    text = F.when(F.col("doc_id") % 2 == 0, F.regexp_replace("text", "[ \n]", "研究生命")).otherwise(F.col("text"))
    cut = lexicon.segmenter(t("documents").sparkSession.createDataFrame(_LEXICON, "word string, weight double"))
    tf = retrieval.terms(t("documents").select("doc_id", text.alias("text")), ["doc_id"], "text", stemmed=False, cut=cut)
    return tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


@query()
def stemmed_search(t):
    """the ten best documents by stems; every second item is a keyword
    request. Stemming is no SQL; tests hold it against published pairs."""
    request = F.when(F.col("item_id") % 2 == 0, F.to_json(F.struct(F.array(F.lit("作者")).alias("keywords_zh"), F.slice(F.split("text", " "), 1, 3).alias("keywords_en"), "text"))).otherwise(F.col("text"))
    return retrieval.bm25_top(t("documents"), t("benchmark").select("item_id", request.alias("text")), ["doc_id"], "item_id", 10)


@query(rf"""
    WITH src AS (SELECT item_id AS id, text FROM benchmark UNION ALL SELECT item_id, 'note ' || item_id FROM benchmark WHERE item_id % 2 = 0), {_TOKENS},
    k AS (SELECT item_id, unnest(['作者', 'core formula', 'note']) AS term FROM benchmark WHERE item_id % 2 = 0)
    SELECT item_id, term, sum(tf)::BIGINT AS tf FROM (SELECT id AS item_id, term, tf FROM tf UNION ALL SELECT item_id, term, 1 FROM k) GROUP BY ALL
""")
def keyword_requests(t):
    """keywords as they are, the text's terms beside them; plain text."""
    said = F.to_json(F.struct(F.array(F.lit("作者"), F.lit("的")).alias("keywords_zh"), F.array(F.lit("Core Formula"), F.lit("note"), F.lit("The")).alias("keywords_en"), F.concat("text", F.lit(" note "), F.col("item_id").cast("string")).alias("text")))
    rows = t("benchmark").select("item_id", F.when(F.col("item_id") % 2 == 0, said).otherwise(F.col("text")).alias("text"))
    return retrieval.keyword_terms(rows, ["item_id"], "text", stemmed=False)


_BM25 = f"""
    WITH src AS (SELECT doc_id AS id, text FROM documents UNION ALL SELECT -1 - item_id, text FROM benchmark), {_TOKENS},
    d AS (SELECT * FROM tf WHERE id >= 0), q AS (SELECT -1 - id AS item_id, term, tf AS qtf FROM tf WHERE id < 0),
    dl AS (SELECT id, sum(tf) AS dl FROM d GROUP BY 1), n AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
    f AS (SELECT term, count(*) AS df FROM d GROUP BY 1), i AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM f, n),
    j AS (SELECT term, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM i) ELSE idf END AS idf FROM i),
    s AS (SELECT item_id, id AS doc_id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN j USING (term) JOIN d USING (term) JOIN dl USING (id), n GROUP BY ALL),
    r AS (SELECT item_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM s)
"""


@query(_BM25 + "SELECT item_id, doc_id, score, rank::INT AS rank FROM r WHERE rank <= 10")
def bm25_topk(t):
    return retrieval.bm25_top(t("documents"), t("benchmark"), ["doc_id"], "item_id", 10, stemmed=False)


@query(_BM25 + """, l AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank FROM documents),
    fu AS (SELECT item_id, doc_id, 1.0::DOUBLE / (rank + 60) AS w FROM r UNION ALL SELECT item_id, doc_id, 1.0::DOUBLE / (l.rank + 60) FROM benchmark, l),
    g AS (SELECT item_id, doc_id, round(sum(w), 9) AS score FROM fu GROUP BY ALL)
    SELECT item_id, doc_id, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM g) WHERE rank <= 10
""")
def rrf_fusion(t):
    """Two rankings of all documents: by BM25 and, the same for every item, by length."""
    scores = retrieval.bm25(t("documents"), t("benchmark"), ["doc_id"], "item_id", stemmed=False).withColumn("score", F.round("score", 6))
    by_words = retrieval.rank_all(scores, ["item_id"], ["doc_id"])
    by_length = retrieval.rank_all(t("documents").select("doc_id", F.col("n_chars").cast("double").alias("score"), F.lit(0).alias("all")), ["all"], ["doc_id"])
    fused = retrieval.fuse_with_common(by_words, materialize(by_length, "lengths"), t("benchmark"), "item_id", "doc_id", 10)
    return retrieval.top_k(fused.withColumn("score", F.round("score", 9)), ["item_id"], ["doc_id"], 10)


_CHUNKS = r"""c AS (SELECT doc_id, i::INT AS chunk_id, p AS text, len(regexp_extract_all(p, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]'))::INT AS token
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents))"""


def _chunks(t):
    rows = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("chunk_id", "text"))
    return rows.withColumn("token", T.token_count(F.col("text")))


@query(f"WITH {_CHUNKS} SELECT doc_id, count(*) AS chunks, sum(token)::BIGINT AS tokens FROM c GROUP BY 1")
def token_sums(t):
    return _chunks(t).groupBy("doc_id").agg(F.count("*").alias("chunks"), F.sum("token").alias("tokens"))


@query(f"""
    WITH {_CHUNKS}, w AS (SELECT *, sum(token) OVER (PARTITION BY doc_id ORDER BY token DESC, chunk_id ROWS UNBOUNDED PRECEDING) AS spent FROM c)
    SELECT doc_id, chunk_id, least(token, 300 - spent + token)::BIGINT AS used, spent > 300 AS cut FROM w WHERE spent - token < 300
""")
def budgeted_topk(t):
    out = retrieval.within_budget(_chunks(t), ["doc_id"], [F.desc("token"), F.col("chunk_id")], 300, text="text")
    return out.select("doc_id", "chunk_id", F.col("used").cast("bigint"), "cut")


@query(f"""
    WITH {_CHUNKS}, n AS (SELECT (200000 // count(DISTINCT doc_id)) AS share FROM c), w AS (SELECT *, sum(token) OVER (PARTITION BY doc_id ORDER BY chunk_id ROWS UNBOUNDED PRECEDING) AS spent FROM c)
    SELECT doc_id, chunk_id, least(token, share - spent + token)::BIGINT AS used FROM w, n WHERE spent - token < share
""")
def front_part(t):
    return retrieval.front_part(_chunks(t), "doc_id", 200000).select("doc_id", "chunk_id", F.col("used").cast("bigint"))


@query(f"""
    WITH {_CHUNKS}, f AS (SELECT doc_id, chunk_id, max(CASE WHEN token * 4 > 2000 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY chunk_id) AS over FROM c WHERE chunk_id < 2)
    SELECT doc_id, chunk_id FROM f WHERE over = 0
""")
def front_page_pin(t):
    """Every document on its own."""
    return retrieval.front_pins(_chunks(t), 2000, "doc_id").select("doc_id", "chunk_id")


@query(f"""
    WITH {_CHUNKS}, s AS (SELECT *, CASE WHEN contains(lower(text), 'the') THEN token ELSE 0 END AS score FROM c),
    f AS (SELECT *, sum(token) OVER (PARTITION BY doc_id) AS total, max(score) OVER (PARTITION BY doc_id) AS best FROM s),
    w AS (SELECT *, sum(token) OVER (PARTITION BY doc_id ORDER BY CASE WHEN best > 0 THEN score ELSE 0 END DESC, chunk_id ROWS UNBOUNDED PRECEDING) AS spent FROM f)
    SELECT doc_id, chunk_id, CASE WHEN total <= 400 THEN token ELSE least(token, 400 - spent + token) END::BIGINT AS used FROM w WHERE total <= 400 OR spent - token < 400
""")
def retrieval_decision(t):
    """Every document as a session of its own: all of it where it fits the
    budget, else the best chunks, else the front."""
    chunks = _chunks(t).withColumn("session", F.col("doc_id"))
    scores = chunks.select("session", "doc_id", "chunk_id", F.when(F.lower("text").contains("the"), F.col("token")).otherwise(0).cast("double").alias("score"))
    return retrieval.search_sessions(chunks, scores, "session", "doc_id", 400).select("doc_id", "chunk_id", "used")


@query("""
    WITH d AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
    SELECT query_id, vec_id, score, rank::INT AS rank FROM r WHERE rank <= 10
""")
def vector_knn(t):
    vectors = t("embeddings").select("vec_id", "embedding")
    queries = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return vectors_of.knn(vectors, queries, 10, places=6)


@query(f"""
    WITH src AS (SELECT doc_id AS id, text FROM documents), {_TOKENS}, n AS (SELECT count(DISTINCT id) AS n FROM tf), f AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    w AS (SELECT id, term, tf * (ln((1 + n) / (1 + df)::DOUBLE) + 1) AS w FROM tf JOIN f USING (term), n), l AS (SELECT id, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1)
    SELECT term, round(sum(w / norm), 6) AS weight FROM w JOIN l USING (id) GROUP BY 1
""")
def tfidf_vocab(t):
    return retrieval.tfidf_vocabulary(retrieval.terms(t("documents"), ["doc_id"], "text", stemmed=False), "doc_id").withColumn("weight", F.round("weight", 6))

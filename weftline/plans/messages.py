"""Windows over messages and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import graphs, messages, scores
from weftline.plans.registry import query
from weftline.streaming import incremental


@query("""
    WITH w AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev, max(turn) FILTER (role = 'user') OVER (PARTITION BY conv_id) AS last_user FROM conversations)
    SELECT conv_id, turn FROM w WHERE role = 'assistant' AND prev = 'user' AND last_user > turn
""")
def plan_segments(t):
    return messages.plan_segments(t("conversations"), tool="user").select("conv_id", "turn")


@query("""
    WITH w AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS g,
                      lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS next, max(event_id) FILTER (event_type = 'click') OVER (PARTITION BY user_id) AS last_click FROM events)
    SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n, arg_max(next, event_id) AS follower
    FROM w WHERE event_type = 'click' GROUP BY user_id, g HAVING arg_max(coalesce(next, -1), event_id) >= 0 AND max(last_click) > arg_max(next, event_id)
""")
def tool_batch_islands(t):
    return messages.tool_batches(t("events"), "user_id", "event_id", "event_type", "click").drop("island")


@query("""
    WITH c AS (SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 AND turn % 2 = 1 THEN '答案是中文' || turn WHEN conv_id % 5 = 0 AND turn % 2 = 1 THEN '42' ELSE text END AS text FROM conversations),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM c),
    q AS (SELECT conv_id, max(text) FILTER (n = 2) AS query, arg_max(text, turn) AS answer FROM n GROUP BY 1),
    l AS (SELECT *, length(regexp_replace(coalesce(query, ''), '[^一-鿿]', '', 'g')) AS qh, length(regexp_replace(coalesce(query, ''), '[一-鿿]|\\P{L}', '', 'g')) AS qo,
                 length(regexp_replace(coalesce(answer, ''), '[^一-鿿]', '', 'g')) AS ah, length(regexp_replace(coalesce(answer, ''), '[一-鿿]|\\P{L}', '', 'g')) AS ao FROM q),
    k AS (SELECT *, CASE WHEN qh + qo = 0 THEN 'unknown' WHEN qh > 0.6 * (qh + qo) THEN 'zh' WHEN qo > 0.7 * (qh + qo) THEN 'en' ELSE 'mixed' END AS a,
                    CASE WHEN ah + ao = 0 THEN 'unknown' WHEN ah > 0.6 * (ah + ao) THEN 'zh' WHEN ao > 0.7 * (ah + ao) THEN 'en' ELSE 'mixed' END AS b FROM l)
    SELECT conv_id, query, answer, a AS query_language, a = 'unknown' OR b = 'unknown' OR a = b AS consistent FROM k
""")
def query_answer_pair(t):
    """every third conversation answers in Chinese, some with a number alone."""
    odd = F.col("turn") % 2 == 1
    text = F.when((F.col("conv_id") % 3 == 0) & odd, F.concat(F.lit("答案是中文"), F.col("turn").cast("string"))).when((F.col("conv_id") % 5 == 0) & odd, "42").otherwise(F.col("text"))
    pairs = messages.query_and_answer(t("conversations").withColumn("text", text), "conv_id", "turn", "text")
    return pairs.select("conv_id", "query", "answer", T.language(F.col("query")).alias("query_language"), T.same_language(F.col("query"), F.col("answer")).alias("consistent"))


#: Tokens with the space before them, as the library counts them.
_SPACED = r"regexp_extract_all(text, '\s*(?:[\p{L}\p{N}]+|[^\s\p{L}\p{N}])')"


@query(f"""
    WITH RECURSIVE m AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN 'function' ELSE role END AS role, text, {_SPACED} AS k, turn = max(turn) OVER (PARTITION BY conv_id) AS newest FROM conversations),
    o AS (SELECT *, len(k) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS pos FROM m WHERE role <> 'system'),
    r AS (
        SELECT c.conv_id, 0::BIGINT AS pos, 150 - coalesce(sum(len(k)) FILTER (role = 'system'), 0)::BIGINT AS room, false AS done, NULL::VARCHAR AS said FROM m c GROUP BY 1
        UNION ALL
        SELECT conv_id, pos, CASE WHEN n <= room THEN room - n ELSE room END, n > room AND role <> 'function',
               CASE WHEN n <= room THEN role || ':' || text WHEN role = 'function' THEN 'function:' || CASE WHEN room // 2 > 0 THEN array_to_string(k[1:room // 2], '') || '...' || array_to_string(k[-(room // 2):], '') ELSE '...' END
                    WHEN role = 'user' AND NOT newest THEN 'user:' || array_to_string(k[1:room], '') END
        FROM (SELECT o.*, r.room FROM r JOIN o ON o.conv_id = r.conv_id AND o.pos = r.pos + 1 WHERE NOT r.done)),
    s AS (SELECT conv_id, -turn - 1000000 AS pos, 'system:' || text AS said, turn FROM m WHERE role = 'system'),
    u AS (SELECT conv_id, -pos AS pos, said FROM r WHERE said IS NOT NULL UNION ALL SELECT conv_id, -2000000 + turn, said FROM s)
    SELECT conv_id, count(said) AS kept, coalesce(string_agg(said, chr(10) ORDER BY u.pos), '') AS said FROM (SELECT DISTINCT conv_id FROM m) LEFT JOIN u USING (conv_id) GROUP BY 1
""")
def message_truncate_exact(t):
    """W7, the exact rule: newest first within 150 tokens; a user message that does
    not fit is cut and ends it, a function message is cut on both sides and the
    walk goes on, any other ends it. Every fourth message is one of a function."""
    role = F.when(F.col("turn") % 4 == 3, "function").otherwise(F.col("role"))
    rows = t("conversations").select("conv_id", "turn", role.alias("role"), F.col("text").alias("content"), T.token_count(F.col("text")).alias("tokens"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "content", "tokens"))), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["tokens"].alias("tokens")))
    kept = rows.groupBy("conv_id").agg(listed.alias("m")).select("conv_id", messages.truncate_messages(F.col("m"), 150).alias("m"))
    return kept.select("conv_id", F.size("m").cast("bigint").alias("kept"), F.array_join(F.transform("m", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n").alias("said"))


@query("""
    WITH f AS (SELECT conv_id, min(turn) AS t FROM conversations WHERE role = 'assistant' GROUP BY 1)
    SELECT f.conv_id, (SELECT arg_max(c.text, c.turn) FROM conversations c WHERE c.conv_id = f.conv_id AND c.role = 'user' AND c.turn < f.t) AS query,
           (SELECT c.text FROM conversations c WHERE c.conv_id = f.conv_id AND c.turn = f.t) AS response FROM f
""")
def first_exchange(t):
    return messages.first_exchange(t("conversations"), "conv_id", "turn", "role", "text")


@query("SELECT conv_id, turn, (count(*) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS turn_no FROM conversations")
def turn_segmentation(t):
    return messages.turns(t("conversations"), "conv_id", "turn", "role").select("conv_id", "turn", F.col("turn_no").cast("bigint"))


@query("""
    WITH w AS (SELECT *, coalesce(sum(CASE WHEN role = 'system' THEN length(text) END) OVER (PARTITION BY conv_id), 0) AS sys,
                      sum(CASE WHEN role = 'system' THEN 0 ELSE length(text) END) OVER (PARTITION BY conv_id ORDER BY turn DESC) AS spent FROM conversations)
    SELECT conv_id, turn, role FROM w WHERE role = 'system' OR spent <= 2000 - sys
""")
def message_budget_truncate(t):
    rows = t("conversations").withColumn("cost", F.length("text"))
    return messages.budget_suffix(rows, "conv_id", "turn", "role", "cost", 2000).select("conv_id", "turn", "role")


@query("""
    WITH w AS (SELECT *, count(*) FILTER (role = 'user') OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations)
    SELECT conv_id, turn FROM w WHERE role = 'system' OR CASE WHEN role = 'user' THEN back ELSE back + 1 END <= 2
""")
def last_two_turns(t):
    return messages.last_turns(t("conversations"), "conv_id", "turn", "role", 2).select("conv_id", "turn")


@query("""
    WITH w AS (SELECT user_id, event_id, event_type, props, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) = event_type THEN 0 ELSE 1 END AS c FROM events),
    g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM w)
    SELECT user_id, event_type, min(event_id) AS event_id, count(*) AS n, string_agg(props, ';' ORDER BY event_id) AS props FROM g GROUP BY user_id, event_type, island
""")
def merge_same_speaker(t):
    return messages.merge_adjacent(t("events"), "user_id", "event_id", "event_type", "props", ";").drop("island")


@query("""
    WITH v AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'assistant' ELSE 'user' END AS r, CASE WHEN role = 'assistant' THEN text ELSE role || ': ' || text END AS x FROM conversations),
    w AS (SELECT *, CASE WHEN lag(r) OVER (PARTITION BY conv_id ORDER BY turn) = r THEN 0 ELSE 1 END AS c FROM v), g AS (SELECT *, sum(c) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM w)
    SELECT conv_id, r AS role, min(turn) AS turn, count(*) AS n, string_agg(x, '\n' ORDER BY turn) AS text FROM g GROUP BY conv_id, r, island
""")
def seen_by_one_speaker(t):
    return messages.as_seen_by(t("conversations"), "conv_id", "turn", "role", "text", "assistant").drop("island")


@query("""
    SELECT conv_id, turn, CASE role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'user' ELSE role END AS role FROM conversations WHERE role <> 'function' AND trim(text) <> ''
""")
def swap_roles(t):
    return messages.swap_roles(t("conversations"), "role", "text").select("conv_id", "turn", "role")


@query("SELECT DISTINCT event_type AS src, nxt AS dst FROM (SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events) WHERE nxt IS NOT NULL")
def tool_graph_edges(t):
    return graphs.edges_from_log(t("events"), "user_id", ["event_id"], "event_type")


_EDGES = "e AS (SELECT DISTINCT event_type AS src, nxt AS dst FROM (SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events) WHERE nxt IS NOT NULL AND nxt <> event_type)"


@query(f"""
    WITH RECURSIVE {_EDGES}, w(len, first, last) AS (
        SELECT 2, src, dst FROM e UNION ALL SELECT w.len + 1, w.first, e.dst FROM w JOIN e ON e.src = w.last WHERE w.len < 5)
    SELECT len::INT AS len, first, last, count(*) AS n FROM w GROUP BY ALL
""")
def walks_by_length(t):
    edges = graphs.edges_from_log(t("events"), "user_id", ["event_id"], "event_type").filter("src <> dst")
    found = graphs.walks(edges, 2, 5)
    return found.groupBy(F.size("walk").alias("len"), F.element_at("walk", 1).alias("first"), F.element_at("walk", -1).alias("last")).agg(F.count("*").alias("n"))


@query(f"""
    WITH RECURSIVE {_EDGES}, w(len, last) AS (
        SELECT 2, dst FROM e UNION ALL SELECT w.len + 1, e.dst FROM w JOIN e ON e.src = w.last WHERE w.len < 5)
    SELECT len::INT AS len, count(*) AS n FROM w GROUP BY ALL
""")
def sub_chain_histogram(t):
    edges = graphs.edges_from_log(t("events"), "user_id", ["event_id"], "event_type").filter("src <> dst")
    return scores.histogram(graphs.walks(edges, 2, 5), F.size("walk"), "len")


_CHAINS = "c AS (SELECT user_id, list(event_type ORDER BY event_id) AS chain FROM events GROUP BY 1)"


@query(f"""
    WITH {_CHAINS}, k AS (SELECT user_id, list_filter(chain, lambda x: x IN ('click', 'view', 'purchase')) AS chain FROM c),
    p AS (SELECT user_id, unnest(range(1, len(chain))) AS i, chain FROM k)
    SELECT user_id, chain[i] AS src, chain[i + 1] AS dst, min(i - 1)::INT AS first FROM p GROUP BY ALL
""")
def chain_edges_known_tools(t):
    chains = t("events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"]).alias("chain"))
    return graphs.edges_from_chains(chains.withColumn("nodes", F.array(F.lit("click"), F.lit("view"), F.lit("purchase"))), "user_id", F.col("chain"), "nodes")


@query(f"WITH {_CHAINS} SELECT user_id, len(chain)::INT AS n FROM c WHERE NOT list_contains(chain, 'signup')")
def chain_member_semijoin(t):
    chains = t("events").groupBy("user_id").agg(F.collect_list("event_type").alias("chain"))
    names = F.array(*map(F.lit, ("click", "view", "purchase", "error")))
    return graphs.known_chains(chains.withColumn("names", names), "chain", "names").select("user_id", F.size("chain").alias("n"))


@query("""
    SELECT conv_id, string_agg('<|im_start|>' || role || '\n' || text || '<|im_end|>\n', '' ORDER BY turn) || '<|im_start|>assistant\n' AS prompt FROM conversations GROUP BY 1
""")
def chat_template(t):
    return messages.chat_template(t("conversations"), "conv_id", "turn", "role", "text")


@query("SELECT conv_id AS stream, string_agg(role, '' ORDER BY turn) AS text FROM conversations GROUP BY 1")
def token_deltas(t):
    return incremental.join_deltas(t("conversations"), "conv_id", "turn", "role").withColumnRenamed("conv_id", "stream")


@query("""
    SELECT time_bucket(INTERVAL '10 minutes', ts) AS start, time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS "end", event_type, count(*) AS n, round(sum(value), 6) AS total
    FROM events GROUP BY ALL
""")
def event_windows(t):
    return incremental.windowed_counts(t("events").withColumn("ts", F.col("ts").cast("timestamp"))).withColumn("total", F.round("total", 6)).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("""
    WITH w AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS c FROM events),
    g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM w)
    SELECT min(ts) AS start, max(ts) + INTERVAL '30 minutes' AS "end", user_id, count(*) AS n FROM g GROUP BY user_id, s
""")
def event_sessions(t):
    return incremental.sessions(t("events").withColumn("ts", F.col("ts").cast("timestamp"))).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})

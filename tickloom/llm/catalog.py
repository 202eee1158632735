"""The operators as queries over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.archives import archived_pages
from tickloom.llm.bpe_codec import bpe_round_trip
from tickloom.llm.centroids import centroid_clusters
from tickloom.llm.decontaminate import find_passages
from tickloom.llm.fingerprints import edited_fingerprints
from tickloom.llm.frames import table, utf8_bytes
from tickloom.llm.learning import fold_of
from tickloom.llm.near_dup import near_duplicate_classes
from tickloom.llm.quality import GOOD, fit_quality, score_quality
from tickloom.llm.quotations import reply_ordered
from tickloom.llm.repair import damaged, repair_report
from tickloom.llm.shards import placed_texts
from tickloom.llm.token_counts import count_tokens
from tickloom.llm.toxicity import FOLDS, HELD_OUT, THRESHOLD, fit_toxicity, score_toxicity
from tickloom.llm.topk import best_by_product, every_nth


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), key="doc_id")


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, table(spark, sf_dir, "benchmark"), result="found")
    items = F.col("found.items")
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), result="score")
    return scored.select("doc_id", "score", (F.col("score") >= GOOD).alias("keep"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op6_quotation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = reply_ordered(table(spark, sf_dir, "conversations"))
    return ordered.select(
        "conv_id", "turn", "role", "position", "thread", "reply_to", "n_quoted", "quote_depth",
        F.sha2("reply_text", 256).alias("reply_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs).select("doc_id", utf8_bytes("text").alias("n_bytes"), "n_tokens")
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs.select("doc_id", "text"), model, result="score")
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op9_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_by_product(table(spark, sf_dir, "embeddings"), every_nth())


def op10_exact_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed_texts(table(spark, sf_dir, "documents"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(damaged(conversations), conversations)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_arc_to_warc": op2_arc_to_warc,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quotation_threads": op6_quotation_threads,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_ball_tree_topk": op9_ball_tree_topk,
    "op10_exact_shuffle": op10_exact_shuffle,
    "op11_structure_repair": op11_structure_repair,
    "op12_fingerprints": op12_fingerprints,
    "op13_centroid_clusters": op13_centroid_clusters,
}

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)



def _centroid_rounds(rounds: int = 10) -> str:
    """Rounds of assignment and means written out one after the other. Distances are sums
    of whole numbers below 2**53, exact as doubles."""
    squares = "list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c)"
    steps = [
        """k AS MATERIALIZED (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c_0 AS MATERIALIZED (
          SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n, v AS c
          FROM k ORDER BY sha256('3:' || vec_id) LIMIT 8)""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a_{i} AS MATERIALIZED (
          SELECT vec_id, v, min(row({squares}, n)) AS near FROM k, c_{i} GROUP BY vec_id, v)""")
        if i < rounds:
            steps.append(f"""c_{i + 1} AS MATERIALIZED (
              SELECT n, coalesce(m, c) AS c FROM c_{i} LEFT JOIN (
                SELECT n, list(floor(total / size) ORDER BY pos) AS m FROM (
                  SELECT near[2] AS n, pos, sum(x) AS total, count(*) AS size
                  FROM (SELECT near, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a_{i}) GROUP BY ALL)
                GROUP BY n) USING (n))""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, CAST(n AS INTEGER) AS cluster, CAST(near[1] AS BIGINT) AS distance,
               CAST(sum(near[1]) OVER (PARTITION BY n) AS BIGINT) AS cluster_inertia,
               CAST(sum(near[1]) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
        FROM a_{rounds} JOIN c_{rounds} ON n = near[2]"""


# A step reads a message after up to two insertions; more never pay. States: 0 at the
# beginning, 1 after a system, 2 after a user, 3 after an assistant message.
_INSERTED = """
    SELECT key, i,
           CASE n WHEN 0 THEN s WHEN 1 THEN [2, 2, 3, 2][s + 1] ELSE [3, 3, 2, 3][s + 1] END AS s,
           cost + 5 * n AS cost, audit || repeat('I', n) AS audit,
           body || CASE WHEN n > 0 THEN chr(10) || ['user', 'user', 'assistant', 'user'][s + 1] || ':' ELSE '' END
                || CASE WHEN n > 1 THEN chr(10) || ['assistant', 'assistant', 'user', 'assistant'][s + 1] || ':' ELSE '' END AS body
    FROM path, (VALUES (0), (1), (2)) v(n)"""

ORACLES: dict[str, str] = {
    "op11_structure_repair": rf"""
        WITH RECURSIVE t AS (
          SELECT list(c ORDER BY i) AS codes FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
                     CASE WHEN (c & 1) = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM range(256) r(i))),
        d AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(
                     string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                     lambda x: CAST(ascii(x) AS BIGINT))),
                   lambda c, b: xor(c >> 8, codes[1 + (xor(c, b) & 255)]))) % 20 AS kind
          FROM conversations, t),
        m AS (
          SELECT coalesce('=' || conv_id, 'none') AS key, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
          FROM d WHERE kind <> 0),
        o AS (
          SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                 row_number() OVER (PARTITION BY key, role, text ORDER BY turn NULLS FIRST, copy) AS seen
          FROM m),
        r AS (
          SELECT *, substr(role, 1, 1) AS letter,
                 CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                 substr(lag(role) OVER (PARTITION BY key ORDER BY i), 1, 1) || substr(role, 1, 1) AS pair
          FROM o),
        c AS (
          SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
                 count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                 count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
          FROM r GROUP BY key),
        path AS (
          SELECT key, 0 AS i, 0 AS s, 0 AS cost, '' AS audit, '' AS body FROM c
          UNION ALL
          SELECT key, CAST(i AS INTEGER), CAST(s AS INTEGER), CAST(best[1] AS INTEGER), best[2], best[3] FROM (
            SELECT key, i, s, min(row(cost, audit, body)) AS best FROM (
              SELECT p.key, p.i + 1 AS i, p.audit || edit AS audit,
                     p.cost + CASE edit WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END
                            + CASE WHEN edit <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost,
                     CASE edit WHEN 'D' THEN p.s WHEN 'R' THEN [2, 2, 3, 2][p.s + 1]
                               ELSE CASE WHEN p.s = 0 AND letter = 's' THEN 1 WHEN p.s <> 2 AND letter = 'u' THEN 2
                                         WHEN p.s = 2 AND letter = 'a' THEN 3 END END AS s,
                     p.body || CASE edit WHEN 'D' THEN '' ELSE chr(10) || CASE edit WHEN 'K' THEN role
                               ELSE ['user', 'user', 'assistant', 'user'][p.s + 1] END || ':' || text END AS body
              FROM ({_INSERTED}) p JOIN r ON r.key = p.key AND r.i = p.i + 1, (VALUES ('K'), ('R'), ('D')) e(edit)
              WHERE edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
            WHERE s IS NOT NULL GROUP BY key, i, s)),
        z AS (
          SELECT key, min(row(cost, audit, body)) AS best
          FROM ({_INSERTED}) JOIN c USING (key) WHERE i = c.n AND s IN (0, 3) GROUP BY key)
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               CAST(coalesce(best[1], 0) AS BIGINT) AS cost, coalesce(best[2], '') AS audit,
               sha256(coalesce(substr(best[3], 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations)
        LEFT JOIN c ON c.key = coalesce('=' || conv_id, 'none') LEFT JOIN z USING (key)
    """,
    "op13_centroid_clusters": _centroid_rounds(),
    "op2_arc_to_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM f
    """,
    "op3_decontamination": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        i AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
        w AS (SELECT item_id, words[p:p + 9] AS part
              FROM (SELECT *, unnest(range(1, greatest(len(words) - 8, 2))) AS p FROM i WHERE len(words) > 0)),
        k AS (SELECT item_id, len(part) AS size, array_to_string(part, ' ') AS window_text FROM w),
        g AS (SELECT doc_id, size, p, array_to_string(words[p:p + size - 1], ' ') AS window_text
              FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p
                    FROM d, (SELECT DISTINCT size FROM k))),
        h AS (SELECT DISTINCT doc_id, p, size, item_id FROM g JOIN k USING (size, window_text)),
        n AS (SELECT doc_id, count(DISTINCT word) AS n_hit
              FROM (SELECT doc_id, unnest(range(p, p + size)) AS word FROM h) GROUP BY doc_id),
        s AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
              FROM h GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
    """,
    "op6_quotation_threads": r"""
        WITH RECURSIVE m AS (
          SELECT *, row_number() OVER () AS message,
                 string_split(regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g'), chr(10)) AS lines
          FROM conversations),
        l AS (SELECT message, conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM m),
        p AS (SELECT *, regexp_extract(line, '^[ \t]*(?:>[ \t]?)+') AS marks FROM l),
        b AS (SELECT *, length(marks) - length(replace(marks, '>', '')) AS level,
                     lower(trim(regexp_replace(line[length(marks) + 1:], '[^\p{L}\p{N}]+', ' ', 'g'))) AS bare FROM p),
        e AS (SELECT *, coalesce(CAST((level, level = 0 AND bare = '') <> lag((level, level = 0 AND bare = ''))
                                 OVER (PARTITION BY message ORDER BY pos) AS INTEGER), 0) AS edge FROM b),
        r AS (SELECT *, sum(edge) OVER (PARTITION BY message ORDER BY pos) AS run FROM e),
        t AS (SELECT conv_id, turn, message, run, level,
                     unnest(list_distinct(list_prepend(string_agg(bare, ' ' ORDER BY pos), list(bare)))) AS words
              FROM r WHERE bare <> '' GROUP BY conv_id, turn, message, run, level),
        f AS (SELECT conv_id, words, min(turn) AS origin FROM t WHERE level = 0 GROUP BY conv_id, words),
        s AS (SELECT t.conv_id, t.turn, message, run, level, origin, sum(length(words)) AS letters
              FROM t JOIN f USING (conv_id, words) WHERE level > 0 AND origin < t.turn GROUP BY ALL),
        k AS (SELECT conv_id, turn, message, run, level, arg_max(origin, (letters, origin)) AS origin,
                     max(letters) AS letters FROM s GROUP BY ALL),
        g AS (SELECT conv_id, turn, level, origin, sum(letters) AS letters FROM k GROUP BY ALL),
        a AS (SELECT conv_id, turn, arg_max(origin, (-level, letters, origin)) AS reply_to FROM g GROUP BY ALL),
        c AS (SELECT conv_id, turn, reply_to AS top FROM a
              UNION ALL SELECT c.conv_id, c.turn, a.reply_to FROM c JOIN a ON a.conv_id = c.conv_id AND a.turn = c.top),
        h AS (SELECT conv_id, turn, min(top) AS top FROM c GROUP BY ALL),
        q AS (SELECT message, CAST(count(*) FILTER (level > 0) AS INTEGER) AS n_quoted,
                     CAST(max(level) AS INTEGER) AS quote_depth FROM b GROUP BY message),
        o AS (SELECT message, line, pos, marks = '' AS own,
                     regexp_matches(line, '^\s*(?:On|Am|Le|El)\b.*(?:wrote|schrieb|a écrit|escribió)\s*:\s*$')
                     AND coalesce(lead(marks) OVER (PARTITION BY message ORDER BY pos), '') <> '' AS announced FROM p),
        w AS (SELECT message, trim(regexp_replace(string_agg(line, chr(10) ORDER BY pos), '\n{3,}', chr(10) || chr(10), 'g'),
                                   ' ' || chr(9) || chr(10)) AS reply_text
              FROM o WHERE own AND NOT announced GROUP BY message),
        z AS (SELECT m.conv_id, m.turn, role, text, coalesce(top, m.turn) AS thread, reply_to, n_quoted, quote_depth,
                     coalesce(reply_text, '') AS reply_text
              FROM m JOIN q USING (message) LEFT JOIN w USING (message)
              LEFT JOIN a ON a.conv_id = m.conv_id AND a.turn = m.turn
              LEFT JOIN h ON h.conv_id = m.conv_id AND h.turn = m.turn)
        SELECT conv_id, turn, role, thread, reply_to, n_quoted, quote_depth, sha256(reply_text) AS reply_sha256,
               row_number() OVER (PARTITION BY conv_id ORDER BY thread NULLS FIRST, turn NULLS FIRST,
                                  role NULLS FIRST, reply_text, text NULLS FIRST) - 1 AS position
        FROM z
    """,
    "op9_ball_tree_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
                   FROM embeddings
                   WHERE embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
              FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5
    """,
}

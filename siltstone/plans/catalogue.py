"""Catalogue, matching and eligibility: scans, projections of ids, gates, joins with exclusion lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.plans.registry import query, sql_query
from siltstone.operators import gates
from siltstone.session import table

sql_query(
    "match_summary",
    """
    SELECT count(*) AS total, CAST(count_if(status = 'matched') AS BIGINT) AS matched,
           CAST(count_if(status = 'low_confidence') AS BIGINT) AS low_confidence,
           CAST(count_if(status = 'excluded') AS BIGINT) AS excluded, CAST(count_if(status = 'no_match_file') AS BIGINT) AS no_match_file
    FROM (SELECT CASE WHEN l.toxic = 1 THEN 'excluded' WHEN l.doc_id IS NULL THEN 'no_match_file'
                      WHEN l.quality = 1 THEN 'matched' ELSE 'low_confidence' END AS status
          FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id)
    """,
)

sql_query(
    "url_id_extract",
    """
    SELECT page_id, coalesce(nullif(regexp_extract(url, R'example\\.com/([a-z]+)/([0-9]+)', 2), ''),
                             nullif(regexp_extract(url, R'example\\.net/([a-z]+)/([0-9]+)', 2), ''),
                             nullif(regexp_extract(url, R'/([0-9]+)([.?#/]|$)', 1), ''), 'none') AS url_id,
           nullif(regexp_extract(url, R'[?&]page=([0-9]+)', 1), '') AS page_number
    FROM {pages}
    """.replace("\\\\", "\\"),
)

sql_query(
    "excluded_antijoin",
    """
    SELECT d.doc_id, d.source FROM {documents} d
    WHERE NOT EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
    """,
)


@query(
    "eligibility_reason",
    """
    SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'excluded' WHEN d.text IS NULL OR d.text = '' THEN 'no_transcript'
        WHEN coalesce(l.quality, 0.5) < 0.8 THEN 'low_confidence' WHEN d.n_chars = 0 THEN 'no_primary_files' ELSE 'ok' END AS reason,
        CASE WHEN l.toxic = 1 OR d.text IS NULL OR d.text = '' OR coalesce(l.quality, 0.5) < 0.8 OR d.n_chars = 0 THEN false ELSE true END AS eligible
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """,
)
def eligibility_reason(spark, sf):
    """The first failing rule of an ordered gate names the reason."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    rules = [
        ("excluded", "toxic = 1"),
        ("no_transcript", "text IS NULL OR text = ''"),
        ("low_confidence", "coalesce(quality, 0.5D) < 0.8D"),
        ("no_primary_files", "n_chars = 0"),
    ]
    return gates.first_failing(d, rules).select("doc_id", "reason", "eligible")


sql_query(
    "match_validity",
    """
    SELECT conv_id, n BETWEEN 1 AND 10 AS count_ok, has_evidence, n > 0 AND n <= 10 AND has_evidence AND conf >= 0.5 AS valid
    FROM (SELECT conv_id, count(*) AS n, bool_or(role = 'assistant') AS has_evidence,
                 CAST(count(CASE WHEN role = 'assistant' THEN 1 END) AS DOUBLE) / count(*) AS conf FROM {conversations} GROUP BY conv_id)
    """,
)

sql_query(
    "threshold_buckets",
    """
    SELECT CASE WHEN confidence >= 0.8 THEN 'completed' WHEN confidence >= 0.5 THEN 'low_confidence' ELSE 'rejected' END AS bucket,
           count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total_chars
    FROM (SELECT n_chars, CAST(least(n_chars, 2000) AS DOUBLE) / 2000 AS confidence FROM {documents}) GROUP BY 1
    """,
)

sql_query(
    "size_caps",
    """
    SELECT doc_id, CASE WHEN n_chars > 8000 THEN 'fail' WHEN n_chars > 5000 THEN 'fallback'
                        WHEN length(text) - length(replace(text, chr(10), '')) + 1 > 40 THEN 'skip' ELSE 'programmatic' END AS route
    FROM {documents}
    """,
)

sql_query(
    "transcript_assembly",
    """
    SELECT conv_id, listagg(text, ' ') WITHIN GROUP (ORDER BY turn) AS transcript,
           left(listagg(text, ' ') WITHIN GROUP (ORDER BY turn), 3000) AS prompt_part, count(*) AS n_sentences
    FROM {conversations} GROUP BY conv_id
    """,
    """
    SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS transcript, left(string_agg(text, ' ' ORDER BY turn), 3000) AS prompt_part,
           count(*) AS n_sentences
    FROM conversations GROUP BY conv_id
    """,
)

sql_query(
    "excluded_status_join",
    """
    SELECT CASE WHEN l.toxic = 1 THEN 'excluded' ELSE 'kept' END AS status, d.source, count(*) AS n
    FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id GROUP BY 1, 2
    """,
)


@query(
    "logs_merge_outer",
    """
    SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_orderpriority, o.o_orderpriority) AS o_orderpriority,
           CASE WHEN n.o_orderkey IS NULL THEN 'move' WHEN o.o_orderkey IS NULL THEN 'new' ELSE 'merge' END AS action
    FROM (SELECT * FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F') n
    FULL OUTER JOIN (SELECT * FROM orders WHERE o_orderstatus IS DISTINCT FROM 'O') o ON n.o_orderkey = o.o_orderkey
    """,
)
def logs_merge_outer(spark, sf):
    """The newer log (orders not finished) and the older one (orders not open) as one: every order is in one or both."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    new = o.where("o_orderstatus IS DISTINCT FROM 'F'").select("o_orderkey", F.col("o_orderpriority").alias("_new"), F.lit(True).alias("_n"))
    old = o.where("o_orderstatus IS DISTINCT FROM 'O'").select("o_orderkey", F.col("o_orderpriority").alias("_old"), F.lit(True).alias("_o"))
    action = F.when(F.col("_n").isNull(), "move").when(F.col("_o").isNull(), "new").otherwise("merge")
    return new.join(old, "o_orderkey", "full").select("o_orderkey", F.coalesce("_new", "_old").alias("o_orderpriority"), action.alias("action"))


sql_query(
    "source_priority_union",
    """
    SELECT doc_id, origin FROM (
        SELECT doc_id, origin, row_number() OVER (PARTITION BY doc_id ORDER BY priority) AS rn FROM (
            SELECT doc_id, 'labels' AS origin, 1 AS priority FROM {labels}
            UNION ALL SELECT doc_id, 'documents', 2 FROM {documents}
            UNION ALL SELECT page_id, 'pages', 3 FROM {pages})) WHERE rn = 1
    """,
)

"""Run metrics, prompt feedback, error databases, retries, costs."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.plans.registry import query, sql_query
from siltstone.session import table

_KEY = "CAST(get_json_object(props, '$.k') AS BIGINT)"
_DKEY = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def both(name: str, text: str) -> None:
    """A query over events whose props key is written [k]."""
    sql_query(name, text.replace("[k]", _KEY), text.replace("[k]", _DKEY))


both("json_props", "SELECT event_id, [k] AS k FROM {events}")
both(
    "timing_stats",
    """
    SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS most,
           count(DISTINCT [k]) AS n_keys FROM {events} GROUP BY event_type
    """,
)
both(
    "retry_summary",
    """
    SELECT event_type, count(*) AS videos, round(avg(attempts), 6) AS avg_attempts, max(attempts) AS max_attempts,
           CAST(count_if(attempts > 1) AS BIGINT) AS retried
    FROM (SELECT event_type, user_id, count(*) AS attempts FROM {events} GROUP BY event_type, user_id) GROUP BY event_type
    """,
)
both(
    "prompt_metrics",
    """
    SELECT event_type AS prompt_type, count(*) AS total_calls, CAST(count_if([k] >= 20) AS BIGINT) AS successful,
           CAST(count_if([k] < 20) AS BIGINT) AS failed, CAST(sum([k] % 3 + 1) AS BIGINT) AS total_attempts,
           round(avg(value), 6) AS avg_time, round(avg(CAST([k] AS DOUBLE) / 100), 6) AS avg_confidence
    FROM {events} GROUP BY event_type
    """,
)


@query(
    "prompt_running_mean",
    """
    SELECT event_id, event_type, sum(round(value * 1000)::BIGINT) OVER w::BIGINT AS running_milli, count(*) OVER w AS calls, sum(round(value * 1000)::BIGINT) OVER w::DOUBLE / count(*) OVER w AS mean_milli
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)
    """,
)
def prompt_running_mean(spark, sf):
    """Running sums, counts and means of each type's times; few types and many rows, so lines are cut into ranges."""
    from siltstone.operators.running import running_sums

    e = table(spark, sf, "events").select("event_id", "event_type", F.round(F.col("value") * 1000).cast("long").alias("v"))
    r = running_sums(e, "event_type", "event_id", "v")
    return r.select("event_id", "event_type", F.col("running_sum").alias("running_milli"), F.col("running_count").alias("calls"), (F.col("running_sum").cast("double") / F.col("running_count")).alias("mean_milli"))


both(
    "prompt_suggestions",
    """
    SELECT event_type, CASE WHEN n < 10 THEN 'not enough data' ELSE concat(
               CASE WHEN ok < 0.7 THEN 'low success;' ELSE '' END, CASE WHEN attempts > 1.5 THEN 'high retry;' ELSE '' END,
               CASE WHEN seconds > 30 THEN 'slow;' ELSE '' END) END AS suggestions
    FROM (SELECT event_type, count(*) AS n, avg(CASE WHEN [k] >= 20 THEN 1.0 ELSE 0.0 END) AS ok, avg([k] % 3 + 1) AS attempts,
                 avg(value) AS seconds FROM {events} GROUP BY event_type)
    """,
)
both(
    "prompt_ab_compare",
    """
    SELECT event_type, round(a, 6) AS score_a, round(b, 6) AS score_b,
           CASE WHEN n_a < 5 OR n_b < 5 THEN 'insufficient' WHEN abs(a - b) < 0.05 THEN 'tie' WHEN a > b THEN 'a' ELSE 'b' END AS winner
    FROM (SELECT event_type, count(CASE WHEN v = 0 THEN 1 END) AS n_a, count(CASE WHEN v = 1 THEN 1 END) AS n_b,
            0.5 * avg(CASE WHEN v = 0 THEN ok END) + 0.3 * (1 - avg(CASE WHEN v = 0 THEN attempts END) / 3) + 0.2 * (1 - least(avg(CASE WHEN v = 0 THEN value END) / 60, 1)) AS a,
            0.5 * avg(CASE WHEN v = 1 THEN ok END) + 0.3 * (1 - avg(CASE WHEN v = 1 THEN attempts END) / 3) + 0.2 * (1 - least(avg(CASE WHEN v = 1 THEN value END) / 60, 1)) AS b
          FROM (SELECT event_type, event_id % 2 AS v, CASE WHEN [k] >= 20 THEN 1.0E0 ELSE 0.0E0 END AS ok,
                       CAST([k] % 3 + 1 AS DOUBLE) AS attempts, value FROM {events}) GROUP BY event_type)
    """,
)
both(
    "error_db_upsert",
    """
    SELECT left(md5(concat(event_type, ':', coalesce(CAST([k] % 10 AS STRING), 'None'), ':', CAST(user_id % 5 AS STRING))), 8) AS hash,
           event_type AS category, [k] % 10 AS key_info, user_id % 5 AS line, count(*) AS occurrences, min(ts) AS first_seen, max(ts) AS last_seen
    FROM {events} GROUP BY event_type, [k] % 10, user_id % 5
    """,
)
both(
    "error_patterns_topk",
    """
    SELECT event_type, key_info, n, rank FROM (
        SELECT event_type, key_info, n, CAST(row_number() OVER (PARTITION BY event_type ORDER BY n DESC, key_info) AS BIGINT) AS rank
        FROM (SELECT event_type, [k] AS key_info, count(*) AS n FROM {events} GROUP BY 1, 2)) WHERE rank <= 5
    """,
)
both(
    "error_pattern_success",
    """
    SELECT event_type, count(*) AS n, CAST(count_if([k] % 4 = 0) AS BIGINT) AS fixed,
           round(100.0E0 * count_if([k] % 4 = 0) / count(*), 6) AS success_rate FROM {events} GROUP BY event_type
    """,
)


@query(
    "fix_suggestions",
    """
    WITH k AS (SELECT event_id, event_type, CASE WHEN [k] > 90 THEN NULL ELSE [k] END AS key_info FROM {events}),
    f AS (SELECT event_type, key_info, min(event_id) AS fix_id, count(*) AS n_similar FROM k GROUP BY event_type, key_info)
    SELECT e.event_id, f.fix_id, f.n_similar FROM k e JOIN f ON e.event_type = f.event_type AND e.key_info IS NOT DISTINCT FROM f.key_info
    WHERE e.event_type = 'error'
    """.replace("[k]", _DKEY).replace("{events}", "events"),
)
def fix_suggestions(spark, sf):
    """For each error, the first event of its type and key, and how many there are among all events."""
    e = table(spark, sf, "events").selectExpr("event_id", "event_type", f"{_KEY} AS k").selectExpr("event_id", "event_type", "CASE WHEN k > 90 THEN NULL ELSE k END AS key_info")
    f = e.groupBy(F.col("event_type").alias("_type"), F.col("key_info").alias("_key")).agg(F.min("event_id").alias("fix_id"), F.count("*").alias("n_similar"))
    errors = e.where("event_type = 'error'")
    return errors.join(f, (F.col("event_type") == F.col("_type")) & F.col("key_info").eqNullSafe(F.col("_key"))).select("event_id", "fix_id", "n_similar")


both(
    "cost_savings",
    """
    SELECT model, count(*) AS calls, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(tokens * price / 1000 * 2), 6) AS cost,
           round(sum(CASE WHEN skipped THEN 0.03E0 ELSE 0.0E0 END), 6) AS saved
    FROM (SELECT [k] * 100 AS tokens, event_type = 'error' AS skipped,
                 CASE WHEN event_type = 'purchase' THEN 'large' WHEN [k] > 50 THEN 'medium' ELSE 'small' END AS model,
                 CASE WHEN event_type = 'purchase' THEN 0.015E0 WHEN [k] > 50 THEN 0.003E0 ELSE 0.00025E0 END AS price FROM {events}) GROUP BY model
    """,
)
sql_query(
    "size_bucket_timeout",
    """
    SELECT doc_id, CASE WHEN n_chars < 5000 THEN 'small' WHEN n_chars < 20000 THEN 'medium' ELSE 'large' END AS size_category,
           round(CASE WHEN n_chars > 50000 THEN 1200 WHEN n_chars > 20000 THEN 900 ELSE 600 END * pow(1.5E0, doc_id % 3), 6) AS timeout,
           CAST(pow(2, doc_id % 3) * 10 AS BIGINT) AS backoff
    FROM {documents}
    """,
)
sql_query(
    "progress_eta",
    """
    SELECT event_id, user_id, round(100.0E0 * done / total, 6) AS percent, CAST(spent AS BIGINT) AS spent_milli, CAST((total - done) AS BIGINT) AS left_over
    FROM (SELECT event_id, user_id, row_number() OVER w AS done, count(*) OVER (PARTITION BY user_id) AS total, sum(CAST(round(value * 1000) AS BIGINT)) OVER w AS spent
          FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))
    """,
)


_FACTORS = """
    SELECT user_id, round(list_reduce(list(CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END ORDER BY event_id),
        lambda a, x: CASE WHEN x = 1.0 THEN greatest(0.8, a * 0.95) ELSE least(3.0, a * 1.1) END, 1.0::DOUBLE), 6) AS factor{more}
    FROM events GROUP BY user_id
    """


@query("adaptive_timeout_fold", _FACTORS.format(more=""))
def adaptive_timeout_fold(spark, sf):
    """A multiplicative factor folded over each key's outcomes in order, held between two bounds."""
    from siltstone.operators.running import folded_factors

    e = table(spark, sf, "events").select("user_id", "event_id", (F.col("event_type") != "error").alias("ok"))
    return folded_factors(e, "user_id", "event_id", "ok").select("user_id", F.round("factor", 6).alias("factor"))


@query("streamed_factors", _FACTORS.format(more=", count(*) AS events, count(*) FILTER (event_type = 'error') AS errors"))
def streamed_factors(spark, sf):
    """The same factors, with the events and errors of each user, from a stream that keeps them as state."""
    from siltstone.streaming import timeouts

    return timeouts.streamed_factors(spark, sf).select("user_id", F.round("factor", 6).alias("factor"), "events", "errors")


@query(
    "json_props_repair",
    """
    SELECT event_id, CASE WHEN trim(raw) = '' THEN 'empty' WHEN json_valid(raw) THEN 'valid' ELSE 'corrupt' END AS state,
           CASE WHEN json_valid(raw) THEN CAST(json_extract_string(raw, '$.k') AS BIGINT) ELSE 0 END AS k
    FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN left(props, 5) WHEN event_id % 11 = 0 THEN ' ' ELSE props END AS raw FROM events)
    """,
)
def json_props_repair(spark, sf):
    """Corrupt and empty JSON is told apart and gets a default."""
    raw = F.expr("CASE WHEN event_id % 7 = 0 THEN left(props, 5) WHEN event_id % 11 = 0 THEN ' ' ELSE props END")
    e = table(spark, sf, "events").select("event_id", raw.alias("raw")).withColumn("v", F.try_parse_json("raw"))
    state = F.when(F.trim("raw") == "", "empty").when(F.col("v").isNotNull(), "valid").otherwise("corrupt")
    return e.select("event_id", state.alias("state"), F.coalesce(F.try_variant_get("v", "$.k", "bigint"), F.lit(0)).alias("k"))

"""History, comparison and hierarchical rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.plans.registry import query, sql_query
from siltstone.session import table

_STAGES = ("view", "click", "signup", "purchase")


@query(
    "stage_history_pivot",
    "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (event_type = '{s}') AS {s}" for s in _STAGES)
    + ", max(ts) AS latest, "
    + " || ".join(f"CASE WHEN count(*) FILTER (event_type = '{s}') > 0 THEN '{s[0].upper()}' ELSE '-' END" for s in _STAGES)
    + " AS flags FROM events GROUP BY user_id",
)
def stage_history_pivot(spark, sf):
    """Stages of each video as columns, its latest time, and a flag string."""
    e = table(spark, sf, "events")
    p = e.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == s).alias(s) for s in _STAGES], F.max("ts").alias("latest"))
    flags = F.concat(*[F.when(F.col(s) > 0, s[0].upper()).otherwise("-") for s in _STAGES])
    return p.withColumn("flags", flags)


sql_query(
    "stage_completion",
    """
    SELECT event_type, count(DISTINCT user_id) AS videos, round(100.0E0 * count(DISTINCT user_id) / max(total), 6) AS percent
    FROM (SELECT event_type, user_id, total FROM {events} CROSS JOIN (SELECT count(DISTINCT user_id) AS total FROM {events})) GROUP BY event_type
    """,
)
sql_query(
    "hierarchy_rollup",
    """
    SELECT r_name, n_name, CAST(grouping(r_name) + grouping(n_name) AS BIGINT) AS level, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, n_name)
    """,
)
sql_query(
    "video_valid_all",
    """
    SELECT o.o_orderkey, coalesce(v.valid, true) AS valid, coalesce(v.n, 0) AS scenes, coalesce(v.method, 'failed') AS method
    FROM {orders} o LEFT JOIN (
        SELECT l_orderkey, bool_and(l_quantity < 45) AS valid, count(*) AS n,
               CASE WHEN bool_or(l_returnflag = 'R') THEN 'fallback' WHEN bool_or(l_returnflag = 'A') THEN 'manual' ELSE 'systematic' END AS method
        FROM {lineitem} GROUP BY l_orderkey) v ON o.o_orderkey = v.l_orderkey
    """,
)
sql_query(
    "conversion_rollup",
    """
    SELECT l_returnflag AS method, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share,
           round(avg(l_quantity), 6) AS avg_fixes FROM {lineitem} GROUP BY l_returnflag
    """,
)
sql_query(
    "comparison_metrics",
    """
    SELECT o_orderkey, round(CASE WHEN o_totalprice > 0 THEN least(1.0E0, rendered / o_totalprice) ELSE 0.0E0 END, 6) AS duration_match,
           round(greatest(0.0E0, o_totalprice - coalesce(rendered, 0.0E0)), 4) AS missing_duration,
           round(CASE WHEN total > 0 THEN CAST(ok AS DOUBLE) / total ELSE 0.0E0 END, 6) AS coverage,
           CASE WHEN total IS NULL THEN 'missing_data' WHEN ok = total THEN 'success' WHEN ok > 0 THEN 'partial' ELSE 'failed' END AS status
    FROM {orders} LEFT JOIN (
        SELECT l_orderkey, sum(CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0.0E0 END) AS rendered, count(*) AS total,
               count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS ok FROM {lineitem} GROUP BY l_orderkey) r ON o_orderkey = l_orderkey
    """,
)
sql_query(
    "comparison_summary",
    """
    SELECT o_orderstatus, count(*) AS videos, CAST(count_if(ok = total) AS BIGINT) AS complete,
           round(CAST(sum(ok) AS DOUBLE) / greatest(sum(total), 1), 6) AS render_success_rate
    FROM {orders} JOIN (SELECT l_orderkey, count(*) AS total, count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS ok FROM {lineitem} GROUP BY l_orderkey)
    ON o_orderkey = l_orderkey GROUP BY o_orderstatus
    """,
)


@query(
    "render_nested_summary",
    """
    SELECT l_orderkey AS video, count(*) FILTER (l_linestatus = 'F') AS rendered, count(*) FILTER (l_linestatus <> 'F') AS failed,
           CASE WHEN count(*) FILTER (l_linestatus <> 'F') = 0 THEN 'success' ELSE 'partial' END AS status,
           array_to_string(list('scene' || l_linenumber ORDER BY l_linenumber) FILTER (l_linestatus <> 'F'), ',') AS failed_scenes
    FROM lineitem GROUP BY l_orderkey
    """,
)
def render_nested_summary(spark, sf):
    """Scenes of a video as arrays of structs, summed up by higher-order functions."""
    scene = F.struct("l_linenumber", "l_linestatus")
    v = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("video")).agg(F.array_sort(F.collect_list(scene)).alias("scenes"))
    good = F.filter("scenes", lambda s: s["l_linestatus"] == "F")
    bad = F.filter("scenes", lambda s: s["l_linestatus"] != "F")
    names = F.array_join(F.transform(bad, lambda s: F.concat(F.lit("scene"), s["l_linenumber"].cast("string"))), ",")
    return v.select(
        "video",
        F.size(good).cast("long").alias("rendered"),
        F.size(bad).cast("long").alias("failed"),
        F.when(F.size(bad) == 0, "success").otherwise("partial").alias("status"),
        F.when(F.size(bad) > 0, names).alias("failed_scenes"),
    )

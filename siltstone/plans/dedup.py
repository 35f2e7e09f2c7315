"""De-duplication by normalised content, first and last wins, consecutive blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import dedup
from siltstone.plans.registry import query, sql_query
from siltstone.session import table

_DUCK_HASH = r"""md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)),
    lambda l: regexp_replace(regexp_replace(l, '#.*$', '', 'g'), '\s+$', '', 'g')), lambda l: l <> ''), chr(10)))"""


@query("content_hash", f"SELECT doc_id, {_DUCK_HASH} AS content_hash FROM documents")
def content_hash(spark, sf):
    """Hash of a text without comments, trailing space and blank lines."""
    return table(spark, sf, "documents").select("doc_id", dedup.content_hash(F.col("text")).alias("content_hash"))


@query(
    "dedup_first",
    f"SELECT doc_id, lang, content_hash FROM (SELECT doc_id, lang, {_DUCK_HASH} AS content_hash FROM documents) QUALIFY row_number() OVER (PARTITION BY lang, content_hash ORDER BY doc_id) = 1",
)
def dedup_first(spark, sf):
    """The first document of each normalised content and language."""
    d = table(spark, sf, "documents").select("doc_id", "lang", dedup.content_hash(F.col("text")).alias("content_hash"))
    return dedup.keep_first(d, ["lang", "content_hash"], ["doc_id"])


@query(
    "dedup_consecutive_by_key",
    """
    SELECT event_id, user_id, event_type, props FROM (
        SELECT *, lag(props) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS before FROM events)
    WHERE before IS NULL OR before <> props
    """,
)
def dedup_consecutive(spark, sf):
    """A block goes only if the block before it of the same key says the same."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    return dedup.drop_consecutive(e, ["user_id", "event_type"], ["event_id"], "props")


sql_query(
    "last_write_wins",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {orders}) WHERE rn = 1
    """,
)


@query(
    "archive_old",
    "SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) > 1 AS archived FROM orders",
)
def archive_old(spark, sf):
    """All but the newest of each kind; the newest are found by a partial aggregate and sent to the rows."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    newest = o.groupBy(F.col("o_orderpriority").alias("_p")).agg(F.max(F.struct("o_orderdate", (-F.col("o_orderkey")).alias("k"))).alias("_n"))
    newest = newest.select("_p", (-F.col("_n.k")).alias("_key"))
    return o.join(newest, F.col("o_orderpriority").eqNullSafe(F.col("_p"))).select("o_orderkey", "o_orderpriority", (F.col("o_orderkey") != F.col("_key")).alias("archived"))


sql_query(
    "set_unused",
    "SELECT p_partkey FROM {part} EXCEPT SELECT l_partkey FROM {lineitem} WHERE l_quantity > 49",
)
sql_query(
    "set_existing",
    "SELECT c_custkey AS k FROM {customer} INTERSECT SELECT o_custkey FROM {orders}",
)
sql_query("distinct_values", "SELECT DISTINCT event_type, props FROM {events}")

"""Mixing sources to target weights by Poisson replication [DataFrame operations only].

Every source gets a mean repetition rate: its target share of all characters over its own share. Each
document's count is the inverse Poisson distribution at that rate of a uniform number hashed from
(seed, source, document id), so the mixture is reproducible, needs no state, and a rerun task draws
the same counts. Documents are exploded by their counts and put in a global order of hashed keys.

Rates come from one aggregate row for each source (summed before the shuffle), joined back by source;
the planner broadcasts that side only if it proves small and splits hot sources otherwise. The cumulative
distribution is an array computed once for each source: a document's count is how many of its steps lie at
or under the number. A rate over MAX_RATE is split into equal parts of MAX_RATE at most, each drawn by a number of its own:
a sum of independent Poisson counts is Poisson at the sum of their rates, and the array stays bounded.

Defined cases: null source is a source of its own; null text counts as no characters; sources without a
weight get weight 0 and so no copies; sources of weight without documents or characters give nothing and
the others keep their proportions; rows of one source and id draw equal counts; very long texts are only measured; empty input gives no rows; a
column of the input named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.registry import query
from siltstone.session import table

MAX_RATE = 16.0
#: Steps of the distribution function: beyond, under 1e-9 of a Poisson of rate MAX_RATE is left.
STEPS = 64
SEED = 17


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) hashed from the parts: 52 bits of md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_steps(rate: Column) -> Column:
    """array<double>: P(count <= k) for k from 0 to STEPS, of a Poisson distribution."""
    first = F.exp(-rate)
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("all")),
        lambda a, k: F.struct(
            (a["p"] * rate / k).alias("p"),
            (a["sum"] + a["p"] * rate / k).alias("sum"),
            F.concat(a["all"], F.array(a["sum"] + a["p"] * rate / k)).alias("all"),
        ),
    )
    return grown["all"]


def source_rates(docs: DataFrame, weights: dict[str, float] | None, source: str = "source", text: str = "text") -> DataFrame:
    """(source, size, rate): mean repetitions that bring each source to its weight's share of all characters.

    weights None: every source alike.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.coalesce(F.sum(F.length(F.col(text)).cast("long")), F.lit(0).cast("long")).alias("size")
    )
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    whole = sizes.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    return sizes.join(F.broadcast(whole), how="cross").select(  # one row by construction
        "source",
        "size",
        F.when(
            (F.col("size") > 0) & (F.col("all_weight") > 0),
            F.col("weight") * F.col("all_size") / (F.col("all_weight") * F.col("size")),
        )
        .otherwise(0.0)
        .alias("rate"),
    )


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shuffle: bool = True,
) -> DataFrame:
    """docs with each row repeated as drawn, plus copy (from 0), rate and shuffle_key, in the order of the keys."""
    own = ["copy", "rate", "shuffle_key"]
    kept = [c for c in docs.columns if c not in own]
    rates = source_rates(docs, weights, source, text)
    parted = F.greatest(F.lit(1), F.ceil(F.col("_rate") / MAX_RATE).cast("int"))
    rates = rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate")).withColumn("_parts", parted)
    rates = rates.select("_source", "_rate", "_parts", poisson_steps(F.col("_rate") / F.col("_parts")).alias("_steps")).where("_rate > 0")
    parts = [F.lit(str(seed)), F.coalesce(F.col(source).cast("string"), F.lit("")), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))]
    named = docs.select(*kept, uniform(*parts).alias("_u"))
    drawn = named.join(rates, F.col(source).eqNullSafe(F.col("_source")))
    steps = lambda u: F.size(F.filter("_steps", lambda s: s <= u))
    others = F.filter(F.sequence(F.lit(0), F.col("_parts") - 1), lambda k: k > 0)
    more = F.aggregate(others, F.lit(0), lambda n, k: n + steps(uniform(*parts, F.lit("part"), k.cast("string"))))
    count = steps(F.col("_u")) + more
    copies = drawn.withColumn("_n", count.cast("int")).where("_n > 0").select(
        *kept, F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("copy"), F.col("_rate").alias("rate")
    )
    out = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", *parts, F.lit("order"), F.col("copy").cast("string"))))
    return out.orderBy("shuffle_key") if shuffle else out


@query(
    "op7_mix_sources",
    f"""
    WITH s AS (SELECT source, coalesce(sum(length(text)), 0)::BIGINT AS size FROM documents GROUP BY source),
    r AS (SELECT source, size, CASE WHEN size > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS weight FROM s),
    w AS (SELECT sum(size)::DOUBLE AS all_size, sum(weight) AS all_weight FROM r),
    q AS (SELECT source, CASE WHEN size > 0 THEN weight * all_size / (all_weight * size) ELSE 0.0 END AS rate FROM r, w),
    p AS (SELECT source, rate, greatest(1, ceil(rate / {MAX_RATE}))::BIGINT AS parts FROM q WHERE rate > 0),
    t AS (SELECT source, k, sum(exp(-rate / parts) * pow(rate / parts, k) / gamma(k + 1)) OVER (PARTITION BY source ORDER BY k) AS step
          FROM p, range(0, {STEPS + 1}) AS g(k)),
    d AS (SELECT row_number() OVER () AS row, doc_id, source, text, {SEED} || ':' || coalesce(source, '') || ':' || coalesce(doc_id::VARCHAR, '') AS key FROM documents),
    u AS (SELECT d.*, p.rate, ('0x' || substr(md5(key || CASE WHEN part = 0 THEN '' ELSE ':part:' || part END), 1, 13))::BIGINT / {2**52}.0::DOUBLE AS u
          FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source, LATERAL (SELECT unnest(range(0, p.parts)) AS part)),
    c AS (SELECT row, any_value(doc_id) AS doc_id, any_value(source) AS source, any_value(text) AS text, any_value(key) AS key, any_value(rate) AS rate, sum(n)::BIGINT AS n
          FROM (SELECT u.*, (SELECT count(*) FROM t WHERE t.source IS NOT DISTINCT FROM u.source AND t.step <= u.u) AS n FROM u) GROUP BY row)
    SELECT doc_id, source, copy::INTEGER AS copy, round(rate, 9) AS rate, md5(key || ':order:' || copy) AS shuffle_key, md5(coalesce(text, '')) AS text_md5
    FROM (SELECT *, unnest(range(0, n)) AS copy FROM c)
    """,
)
def op7_mix_sources(spark, sf):
    """Mixes all documents so that every source has the same share of characters."""
    out = mix_sources(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return out.select(
        "doc_id", "source", "copy", F.round("rate", 9).alias("rate"), "shuffle_key", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5")
    )

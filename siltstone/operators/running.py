"""Running sums and folds along lines of few keys and many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _part(df: DataFrame, order: str, ranges: int | None) -> Column:
    """The range of order that a row is in: ranges are cut at quantiles of the table."""
    n = ranges or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(df.agg(F.percentile_approx(order, [k / n for k in range(1, n)], 10 * n)).first()[0] or []))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<long>"), lambda c: c < F.col(order)))
    return F.coalesce(part, F.lit(0))


def folded_factors(
    df: DataFrame, key: str, order: str, ok: str, eased: float = 0.95, raised: float = 1.1, floor: float = 0.8, ceiling: float = 3.0, ranges: int | None = None
) -> DataFrame:
    """(key, factor): from 1, eased down to floor by each row that is ok and raised up to ceiling by each that is not, in order.

    A step is x -> min(hi, max(lo, c x)), and so is any row of steps; so the rows of a key and range become one step, and the steps of a
    key, a few, are taken one after another. No key's rows meet in one place. A null counts as ok.
    """
    cell = df.select(F.col(key).alias("key"), F.col(order).alias("order"), F.coalesce(F.col(ok), F.lit(True)).alias("ok"), _part(df, order, ranges).alias("part"))
    rows = F.array_sort(F.collect_list(F.struct("order", "ok")))
    none = F.struct(F.lit(1.0).alias("c"), F.lit(0.0).alias("lo"), F.lit(float("inf")).alias("hi"))
    held = lambda v, lo, hi: F.least(hi, F.greatest(lo, v))

    def then(a: Column, c: Column, lo: Column, hi: Column) -> Column:
        return F.struct((a["c"] * c).alias("c"), held(a["lo"] * c, lo, hi).alias("lo"), held(a["hi"] * c, lo, hi).alias("hi"))

    inf, zero = F.lit(float("inf")), F.lit(0.0)
    one = lambda a, x: then(a, F.when(x["ok"], eased).otherwise(raised), F.when(x["ok"], floor).otherwise(zero), F.when(x["ok"], inf).otherwise(ceiling))
    steps = cell.groupBy("key", "part").agg(F.aggregate(rows, none, one).alias("s"))
    line = F.array_sort(F.collect_list(F.struct("part", "s")))  # of a key: as many as there are ranges
    last = F.aggregate(line, F.lit(1.0), lambda x, p: held(x * p["s"]["c"], p["s"]["lo"], p["s"]["hi"]))
    return steps.groupBy("key").agg(last.alias("factor")).withColumnRenamed("key", key)


def running_sums(df: DataFrame, key: str, order: str, value: str, ranges: int | None = None) -> DataFrame:
    """df with running_sum and running_count of value along order (a long, unique within a key).

    Each key's line is cut into ranges of order at quantiles of the table, so that a window runs within one range; what
    the ranges before hold comes from one row a key and range.
    """
    d = df.withColumn("_part", _part(df, order, ranges))
    total = d.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_p")).agg(F.sum(value).alias("_s"), F.count("*").alias("_n"))
    line = Window.partitionBy("_key").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = total.select("_key", "_p", F.coalesce(F.sum("_s").over(line), F.lit(0)).alias("_s"), F.coalesce(F.sum("_n").over(line), F.lit(0)).alias("_n"))
    within = Window.partitionBy(key, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    run = d.withColumns({"_rs": F.sum(value).over(within), "_rn": F.count("*").over(within)})
    joined = run.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_p")))
    return joined.select(*df.columns, (F.col("_rs") + F.col("_s")).alias("running_sum"), (F.col("_rn") + F.col("_n")).alias("running_count"))

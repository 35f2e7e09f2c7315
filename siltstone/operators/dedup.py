"""De-duplication operators: all of them one shuffle on the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def content_hash(text: Column) -> Column:
    """md5 of the lines, cut at the first #, right-trimmed, without blank ones."""
    lines = F.transform(F.split(text, "\n"), lambda l: F.regexp_replace(F.regexp_replace(l, "#.*$", ""), r"\s+$", ""))
    return F.md5(F.array_join(F.filter(lines, lambda l: l != ""), "\n"))


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; the least row is found before the shuffle, so hot keys cost one row a task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    least = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return least.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def drop_consecutive(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from that of the row before of the same key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_before", F.lag(value).over(w)).where(f"_before IS NULL OR _before <> {value}").drop("_before")

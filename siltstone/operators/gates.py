"""Ordered gates: the first failing rule gives the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_failing(df: DataFrame, rules: list[tuple[str, str]], ok: str = "ok") -> DataFrame:
    """df with reason (name of the first rule whose SQL condition holds, else ok) and eligible."""
    reason = F.lit(ok)
    for name, condition in reversed(rules):
        reason = F.when(F.expr(condition), name).otherwise(reason)
    return df.withColumn("reason", reason).withColumn("eligible", F.col("reason") == ok)

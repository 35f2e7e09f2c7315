"""Work in bounded attempts: only rows that are not settled go on, and each attempt leaves a row of history.

A round checks the open rows, writes what it found as history, and gives those that failed a fix that their message asks for. A row is
settled when its check passes, when its fix changes nothing, or when no attempts are left. Rounds are tables of their own, so a lost
executor costs one round, and rows that are settled early are not looked at again.
"""

from __future__ import annotations

import ast
import builtins
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators.recovery import with_recovered
from siltstone.rules import dialect as D
from siltstone.session import materialize, scratch

#: Names that the new dialect's star import provides, as far as the tables of names know them.
_KNOWN = (
    set(D.MOBJECTS) | set(D.ANIMATIONS.values()) | set(D.CLASSES.values()) | set(D.COLORS.values()) | set(D.TREE_CLASSES.values()) | set(D.TREE_COLORS.values()) | set(dir(builtins))
    | {"Scene", "ThreeDScene", "UP", "DOWN", "LEFT", "RIGHT", "np", "config", "rate_functions"}
) - (D.COLORS.keys() | D.ANIMATIONS.keys() | D.CLASSES.keys() | D.TREE_COLORS.keys()) | set(D.TREE_COLORS.values())


def first_failure(code: str | None) -> str | None:
    """What running a source would fail with first, as far as its text tells: a syntax error, a name that nothing provides, a lost attribute."""
    try:
        tree = ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
        return f"SyntaxError: {getattr(e, 'msg', e)}"
    bound = {n.id for n in ast.walk(tree) if isinstance(n, ast.Name) and not isinstance(n.ctx, ast.Load)}
    bound |= {n.name for n in ast.walk(tree) if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef)} | {n.arg for n in ast.walk(tree) if isinstance(n, ast.arg)}
    bound |= {(a.asname or a.name).split(".")[0] for n in ast.walk(tree) if isinstance(n, ast.Import | ast.ImportFrom) for a in n.names}
    failed = []
    for n in ast.walk(tree):
        if isinstance(n, ast.Name) and isinstance(n.ctx, ast.Load) and n.id not in bound and n.id not in _KNOWN:
            failed.append((n.lineno, n.col_offset, f"NameError: name '{n.id}' is not defined"))
        elif isinstance(n, ast.Attribute) and isinstance(n.value, ast.Name) and n.value.id == "string" and n.attr == "letters":
            failed.append((n.lineno, n.col_offset, "AttributeError: module 'string' has no attribute 'letters'"))
        elif isinstance(n, ast.keyword) and n.arg == "invert":
            failed.append((n.value.lineno, n.value.col_offset, "TypeError: ImageMobject() got an unexpected keyword argument 'invert'"))
    return min(failed)[2] if failed else None


def checked(df: DataFrame, code: str) -> DataFrame:
    """df with message: the first failure, null if none."""

    @F.pandas_udf("string")
    def run(codes: pd.Series) -> pd.Series:
        return pd.Series([first_failure(c) for c in codes])

    return df.withColumn("message", run(F.col(code)))


def recovered(df: DataFrame, code: str) -> DataFrame:
    """df with fixed, the code after what its message asks for, and fixes, the names of what changed it."""
    d = with_recovered(df, code, "message", "_recovery")
    return d.withColumns({"fixed": F.col("_recovery.code"), "fixes": F.col("_recovery.changes")}).drop("_recovery")


def run_attempts(work: DataFrame, key: str, code: str, attempts: int = 3, check: Callable = checked, fix: Callable = recovered) -> tuple[DataFrame, DataFrame]:
    """(states, history) of rows (key, code).

    history: key, attempt (from 1), message, fixes (of the fix before this attempt), code. states: key, state (clean: at the first
    attempt; recovered; gave_up: a fix changed nothing; exhausted), attempts, code as of the last one.
    """
    spark = work.sparkSession
    open_ = work.select(F.col(key).alias("key"), F.col(code).alias("code"), F.array().cast("array<string>").alias("fixes"))
    kind, path = open_.schema["key"].dataType.simpleString(), scratch(spark, "history")
    schema = f"key {kind}, code string, fixes array<string>, message string, attempt int, last boolean, state string"
    for k in range(1, attempts + 1):
        tried = materialize(check(open_, "code").withColumn("attempt", F.lit(k)), "tried")
        columns = ["key", "code", "fixes", "message", "attempt"]
        passed = tried.where("message IS NULL").select(*columns, F.lit("clean" if k == 1 else "recovered").alias("state"))
        if k == attempts:
            done = passed.unionByName(tried.where("message IS NOT NULL").select(*columns, F.lit("exhausted").alias("state")))
        else:
            failed = materialize(fix(tried.where("message IS NOT NULL").withColumnRenamed("fixes", "before"), "code"), "failed")
            stuck = F.col("fixed").eqNullSafe(F.coalesce("code", F.lit("")))
            done = passed.unionByName(failed.select("key", "code", F.col("before").alias("fixes"), "message", "attempt", F.when(stuck, "gave_up").alias("state")))
            open_ = failed.where(~stuck).select("key", F.col("fixed").alias("code"), "fixes")
        done.withColumn("last", F.col("state").isNotNull()).select("key", "code", "fixes", "message", "attempt", "last", "state").write.mode("append").parquet(path)
        if k == attempts or open_.isEmpty():
            break
    all_ = spark.read.schema(schema).parquet(path)
    states = all_.where("last").select("key", "state", F.col("attempt").alias("attempts"), "code")
    return states, all_.select("key", "attempt", "message", "fixes", "code")

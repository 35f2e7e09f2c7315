"""Stage runner: cached, resumable stages over tables, and reports of what they did."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _whole(spark: SparkSession, path: str) -> bool:
    """Whether a stage's table is committed and can be read; one that cannot is run again."""
    if not _exists(spark, f"{path}/_SUCCESS"):
        return False
    try:
        spark.read.parquet(path).limit(1).count()
    except Exception:  # whatever the reader finds wrong with it
        return False
    return True


def _code_of(f: Callable) -> str:
    """What a function does, as far as its code tells: its instructions, constants, and what it closes over."""
    code = getattr(f, "__code__", None)
    if code is None:
        return repr(f)
    inner = [_code_of(c) if callable(c) else c.co_code.hex() if hasattr(c, "co_code") else repr(c) for c in code.co_consts]
    held = [_code_of(v) if callable(v) else repr(v) for v in (c.cell_contents for c in f.__closure__ or ())]
    return "|".join([code.co_code.hex(), *inner, *code.co_names, *held, repr(f.__defaults__)])


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's columns and rows, whatever their order: one aggregate, merged before it is shuffled."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.lit(0).cast("long")
    low, high = (F.sum(h.bitwiseAND(F.lit((1 << 32) - 1))), F.sum(F.shiftrightunsigned(h, 32)))
    r = df.agg(F.count("*"), low, high, F.bit_xor(h)).first()
    return hashlib.md5(repr((df.schema.simpleString(), *r)).encode()).hexdigest()


def _noted(spark: SparkSession, path: str) -> str | None:
    return spark.read.text(path).first()[0] if _exists(spark, path) else None


def run_stages(spark: SparkSession, first: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame]]], folder: str, force: bool = False) -> tuple[DataFrame, list[str]]:
    """Run stages one after another, each into folder/name; a stage whose table is whole and was made of the same input by the same code is read.

    What a table was made of is noted beside it once it is written: a digest of the first input's rows and of the code of all stages up to
    its own. Returns the last table and the names of the stages that ran. force runs all; a stage after one that ran runs too.
    """
    df, ran, made_of = first, [], fingerprint(first)
    for name, stage in stages:
        path = f"{folder}/{name}"
        made_of = hashlib.md5(f"{made_of} {name} {_code_of(stage)}".encode()).hexdigest()
        if force or ran or not _whole(spark, path) or _noted(spark, f"{path}.made_of") != made_of:
            stage(df).write.mode("overwrite").parquet(path)
            spark.createDataFrame([(made_of,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.made_of")
            ran.append(name)
        df = spark.read.parquet(path)
    return df, ran


def resume(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of todo whose key is not yet done."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def report(df: DataFrame, by: str, measures: dict[str, str], most: int = 10) -> str:
    """A text table of the most frequent values of by, with measures (name: SQL aggregate); at most ``most`` rows reach the driver."""
    aggs = [F.count("*").alias("n"), *[F.expr(e).alias(n) for n, e in measures.items()]]
    rows = df.groupBy(by).agg(*aggs).orderBy(F.desc("n"), by).limit(most).collect()
    names = [by, "n", *measures]
    cells = [names, *[[str(r[n]) for n in names] for r in rows]]
    wide = [max(len(c[k]) for c in cells) for k in range(len(names))]
    return "\n".join("  ".join(v.ljust(w) for v, w in zip(c, wide, strict=True)).rstrip() for c in cells)


def html_rows(df: DataFrame, by: str, measures: dict[str, str]) -> DataFrame:
    """(by, html): a table row for each value of by, with measures (name: SQL aggregate); text is escaped."""
    text = lambda c: F.replace(F.replace(F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    g = df.groupBy(by).agg(*[F.expr(e).alias(f"_m{k}") for k, e in enumerate(measures.values())])
    cells = [text(F.col(by)), *[text(F.col(f"_m{k}")) for k in range(len(measures))]]
    return g.select(by, F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", *cells), F.lit("</td></tr>")).alias("html"))


def dashboard(df: DataFrame, by: str, measures: dict[str, str], title: str, most: int = 1000) -> str:
    """An HTML page of html_rows; at most ``most`` rows reach the driver."""
    head = "".join(f"<th>{n}</th>" for n in [by, *measures])
    rows = [r.html for r in html_rows(df, by, measures).orderBy(by).limit(most).collect()]
    return f"<!doctype html><title>{title}</title><table><tr>{head}</tr>{''.join(rows)}</table>"


def retried(action: Callable[[int], bool], attempts: int = 3, base: float = 600.0, wait: Callable[[float], None] | None = None) -> tuple[bool, list[float]]:
    """Run an action until it returns true, at most attempts times, its time limit growing by half and pauses doubling.

    Returns whether it did, and the time limits given. wait: what to do with a pause (default: sleep).
    """
    import time

    limits = []
    for k in range(attempts):
        limits.append(base * 1.5**k)
        if action(k):
            return True, limits
        if k + 1 < attempts:
            (wait or time.sleep)(2**k * 10.0)
    return False, limits

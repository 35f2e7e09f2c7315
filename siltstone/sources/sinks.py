"""Sinks: appended JSON lines, quarantined invalid rows, keyed upserts, ordered monoliths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines."""
    df.write.mode("append").json(path)


def write_valid(df: DataFrame, valid: str, path: str, quarantine: str) -> None:
    """Rows that hold the condition go to path, the others to quarantine; what decides is computed once."""
    from siltstone.session import materialize

    judged = materialize(df.withColumn("_valid", F.coalesce(F.expr(valid), F.lit(False))), "judged")
    judged.where("_valid").drop("_valid").write.mode("overwrite").parquet(path)
    judged.where("NOT _valid").drop("_valid").write.mode("overwrite").parquet(quarantine)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of both, the greatest of order for each key; ties go to new."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    last = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, "_new")).alias("_r"))
    return last.select(*keys, "_r.*")


def monolith(df: DataFrame, group: str, order: str, text: str, **measures: Column) -> DataFrame:
    """(group, text): the texts of a group in order, joined by blank lines; measures: further aggregates by name."""
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return df.groupBy(group).agg(F.array_join(F.transform(parts, lambda p: p[text]), "\n\n").alias(text), *[c.alias(n) for n, c in measures.items()])


def write_summary(df: DataFrame, path: str, by: str) -> None:
    """One JSON summary a value of by, replaced as a whole when written again."""
    df.repartition(F.col(by)).write.mode("overwrite").partitionBy(by).json(path)


def upsert_log(spark: SparkSession, path: str, stage: DataFrame, keys: list[str], order: str, most: int = 20) -> int:
    """Upsert stage rows into a versioned log, by a delta of their own; a log that cannot be read is put aside and begun anew.

    Beyond most folders the log is compacted and what the last two versions do not need is removed. Returns how many rows it holds.
    """
    from siltstone.sources.versioned import VersionedLog

    log = VersionedLog(spark, path, keys, order)
    if log.versions():
        try:
            log.read().write.format("noop").mode("overwrite").save()
        except Exception:  # whatever the reader finds wrong with it
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
            at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(at(path), at(f"{path}.corrupted"))
    log.upsert(stage)
    if len(log.manifest()["folders"]) > most:
        log.compact()
        log.vacuum()
    return log.read().count()

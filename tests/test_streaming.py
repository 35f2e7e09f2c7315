"""Streams give what the batch operators give."""

from pyspark.sql import functions as F

from siltstone.plans import registry
from siltstone.streaming import errors

SF = "/root/testdata/sf0.001"


def _split(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.repartitionByRange(3, "event_id").sortWithinPartitions("event_id").write.parquet(str(tmp_path / "in"))
    return e


def test_error_upserts(spark, tmp_path):
    e = _split(spark, tmp_path)
    stream = errors.events(spark, str(tmp_path / "in"), e.schema)
    q = errors.upsert_into(errors.error_counts(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = {tuple(r) for r in errors.read_upserts(spark, str(tmp_path / "out")).collect()}
    want = {tuple(r) for r in errors.error_counts(e.withColumn("ts", F.col("ts").cast("timestamp"))).select("hash", "category", "key_info", "occurrences", "first_seen", "last_seen").collect()}
    assert got == want


def test_windows(spark, tmp_path):
    e = _split(spark, tmp_path)
    stream = errors.windowed_counts(errors.events(spark, str(tmp_path / "in"), e.schema, 10))
    q = stream.writeStream.format("memory").queryName("windows").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert 0 < spark.table("windows").agg(F.sum("n")).first()[0] <= e.count()


def test_adaptive_factor(spark, tmp_path):
    e = _split(spark, tmp_path)
    one = str(tmp_path / "one")
    e.coalesce(1).sortWithinPartitions("event_id").write.parquet(one)
    q = errors.adaptive_factor(errors.events(spark, one, e.schema)).writeStream.format("memory").queryName("factors").outputMode("update").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.user_id: round(r.factor, 6) for r in spark.table("factors").collect()}
    assert got == {r.user_id: r.factor for r in registry.QUERIES["adaptive_timeout_fold"](spark, SF).collect()}


def test_persisted_at_intervals_and_compacted(spark, tmp_path):
    e = _split(spark, tmp_path)
    stream = errors.events(spark, str(tmp_path / "in"), e.schema)
    q = errors.persist_every(stream, str(tmp_path / "log"), str(tmp_path / "cp1"), seconds=1)
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "log")).count() == e.count()
    stream = errors.events(spark, str(tmp_path / "in"), e.schema)
    errors.upsert_into(errors.error_counts(stream), str(tmp_path / "out"), str(tmp_path / "cp2")).awaitTermination(120)
    before = {tuple(r) for r in errors.read_upserts(spark, str(tmp_path / "out")).collect()}
    assert len(list((tmp_path / "out" / "data").iterdir())) == 3
    errors.compact_upserts(spark, str(tmp_path / "out"))
    assert errors.compact_upserts(spark, str(tmp_path / "out")) and len(list((tmp_path / "out" / "data").iterdir())) == 2
    assert {tuple(r) for r in errors.read_upserts(spark, str(tmp_path / "out")).collect()} == before


def test_timers_and_state(spark, tmp_path):
    """Users in many files; who stays silent is closed by a timer, and comes back with a fresh state."""
    import time

    from siltstone.streaming import timeouts

    row = "event_id long, user_id long, event_type string"
    put = lambda name, rows: spark.createDataFrame(rows, row).coalesce(1).write.parquet(str(tmp_path / "in" / name))
    put("a", [(k, k % 2, "error" if k % 3 == 0 else "click") for k in range(10)])
    stream = lambda: timeouts.factors(spark.readStream.schema(row).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), idle_ms=1)
    timeouts.keep_factors(stream(), str(tmp_path / "log"), str(tmp_path / "cp"))
    got = {r.user_id: (r.events, r.errors, r.closed) for r in timeouts.read_factors(spark, str(tmp_path / "log")).collect()}
    assert got == {0: (5, 2, False), 1: (5, 2, False)}
    time.sleep(0.1)
    put("b", [(20, 1, "error"), (21, 2, None)])
    timeouts.keep_factors(stream(), str(tmp_path / "log"), str(tmp_path / "cp"))
    got = {r.user_id: (r.events, r.errors, r.closed) for r in timeouts.read_factors(spark, str(tmp_path / "log")).collect()}
    assert got[0] == (5, 2, True) and got[2] == (1, 0, False) and got[1] in ((6, 3, False), (1, 1, False), (6, 3, True))


def test_folds_by_ranges(spark):
    """Composed steps give what a fold in order gives, however lines are cut."""
    import random

    from siltstone.operators.running import folded_factors

    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), k, rng.choice([True, True, False, None])) for k in range(400)]
    want = {}
    for key, _, ok in rows:
        x = want.get(key, 1.0)
        want[key] = min(3.0, x * 1.1) if ok is False else max(0.8, x * 0.95)
    for ranges in (1, 7, 50):
        got = {r.k: r.factor for r in folded_factors(spark.createDataFrame(rows, "k string, o long, ok boolean"), "k", "o", "ok", ranges=ranges).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)

"""A versioned log: upserts, tombstones, versions, compaction, writers that meet, and crashes between any two steps."""

import random

import pytest

from siltstone.sources.versioned import VersionedLog

ROW = "k string, g long, at long, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def state(log, version=None):
    return {(r.k, r.g): (r["at"], r.v) for r in log.read(version).collect()}


def test_against_a_dictionary(spark, tmp_path):
    """Random upserts and deletes with compactions between; every version reads as it was."""
    rng, log = random.Random(5), VersionedLog(spark, str(tmp_path / "t"), ["k", "g"], "at", buckets=3)
    with pytest.raises(FileNotFoundError):
        log.read()
    want, history = {}, {}
    for step in range(8):
        keys = list({(rng.choice(["a", "b", None]), rng.randrange(4)) for _ in range(5)})
        if step in (3, 6):
            version = log.delete(spark.createDataFrame([(*k, step) for k in keys], "k string, g long, at long"))
            for k in keys:
                want.pop(k, None)
        else:
            version = log.upsert(frame(spark, [(*k, step, f"v{step}") for k in keys]))
            want |= {k: (step, f"v{step}") for k in keys}
        history[version] = dict(want)
        if step in (2, 5):
            history[log.compact()] = dict(want)
    assert log.versions() == sorted(history) and all(state(log, v) == h for v, h in history.items())
    late = log.upsert(frame(spark, [("a", 1, -1, "too old"), ("z", 9, 1, "x"), ("z", 9, 1, "y"), ("z", 9, 0, "w")]))
    assert state(log, late) == {**want, ("z", 9): (1, "y"), **({} if ("a", 1) in want else {("a", 1): state(log).get(("a", 1))} if ("a", 1) in state(log) else {})}
    some = [("z", 9), (None, 2), ("nobody", 0)]
    assert {(r.k, r.g) for r in log.lookup(spark.createDataFrame(some, "k string, g long")).collect()} == {k for k in some if k in state(log)}
    with pytest.raises(ValueError):
        log.upsert(spark.createDataFrame([("a", 1)], "k string, g long"))
    log.upsert(frame(spark, []))
    assert state(log) == state(log, late)


def test_readers_and_vacuum(spark, tmp_path):
    log = VersionedLog(spark, str(tmp_path / "t"), ["k", "g"], "at")
    for n in range(3):
        log.upsert(frame(spark, [("a", n, n, "x")]))
    reader = log.read()  # of version 3
    log.compact()
    assert reader.count() == 3 and log.vacuum() == 2 and reader.count() == 3  # versions 1 and 2 went, 3 and 4 are kept
    log.upsert(frame(spark, [("b", 0, 0, "y")]))
    assert log.vacuum() == 4 and log.versions() == [4, 5] and len(state(log)) == 4  # a manifest and three folders


def test_writers_that_meet(spark, tmp_path):
    """Who comes second keeps both folders; a compaction keeps what came in while it ran, and gives way to another one."""
    a, b = (VersionedLog(spark, str(tmp_path / "t"), ["k", "g"], "at") for _ in range(2))
    a.upsert(frame(spark, [("a", 0, 0, "x")]))
    commit = a._commit

    def late(made):
        a._commit = commit
        b.upsert(frame(spark, [("b", 0, 0, "y")]))
        commit(made)

    a._commit = late
    assert a.upsert(frame(spark, [("c", 0, 0, "z")])) == 3 and set(state(a)) == {("a", 0), ("b", 0), ("c", 0)}
    a._commit = late
    a.compact()
    assert set(state(b)) == {("a", 0), ("b", 0), ("c", 0)} and [f["kind"] for f in a.manifest()["folders"]] == ["base", "delta"]

    def compacted(made):
        a._commit = commit
        b.compact()
        commit(made)

    a._commit = compacted
    assert a.compact() == b.manifest()["version"] and set(state(a)) == {("a", 0), ("b", 0), ("c", 0)}
    assert a.upsert(frame(spark, [("d", 0, 0, "once")]), tag="t1") == a.upsert(frame(spark, [("d", 0, 0, "twice")]), tag="t1")
    a.compact()
    a.upsert(frame(spark, [("d", 0, 0, "twice")]), tag="t1")
    assert state(a)["d", 0] == (0, "once")


@pytest.mark.parametrize("step", ["_write", "_commit", "_rename"])
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("work", ["upsert", "compact"])
def test_crashes(spark, tmp_path, step, after, work):
    """A writer that dies before or after any step leaves the old version or the new one; the work can be done again."""
    log = VersionedLog(spark, str(tmp_path / "t"), ["k", "g"], "at")
    log.upsert(frame(spark, [("a", 0, 0, "x")]))
    log.upsert(frame(spark, [("a", 1, 0, "y")]))
    whole = getattr(log, step)

    def dies(*args):
        if after:
            whole(*args)
        raise KeyboardInterrupt

    do = (lambda: log.upsert(frame(spark, [("a", 2, 0, "z")]), tag="t")) if work == "upsert" else log.compact
    setattr(log, step, dies)
    with pytest.raises(KeyboardInterrupt):
        do()
    setattr(log, step, whole)
    old = {("a", 0): (0, "x"), ("a", 1): (0, "y")}
    new = old | ({("a", 2): (0, "z")} if work == "upsert" else {})
    assert state(log) == (new if after and step != "_write" else old)
    do()
    log.vacuum(keep=1)
    assert state(log) == new and len(log.versions()) == 1
    assert len(list((tmp_path / "t" / "data").iterdir())) == len(log.manifest()["folders"])
    assert not [f for f in (tmp_path / "t" / "manifests").iterdir() if f.name.endswith(".tmp")]

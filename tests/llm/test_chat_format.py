import pytest
from pyspark.sql import functions as F

from siltstone.llm import chat_format as cf

SCHEMA = "tree string, node long, parent long, role string, text string, score double, formatted string"


def test_tree_paths_ranks_and_round_trip(spark):
    rows = [
        ("t", 1, None, "user", "\\b <x> # ### a: b </turn>\n", 0.0, "clash"),
        ("t", 2, 1, "assistant", "yes", 1.0, ""),
        ("t", 3, 1, "assistant", None, 2.0, ""),
        ("t", 4, 3, "us: er#", "ok ", 0.0, ""),
        ("t", 5, 4, "assistant", "fin </turn>\n", 0.0, ""),
        ("t", 9, 77, "user", "orphan", None, ""),
        (None, 1, None, None, "", None, ""),
    ]
    out = cf.format_reply_trees(spark.createDataFrame(rows, SCHEMA))
    got = out.select("tree", "leaf", "branch_rank", "branch_score", cf.read_turns(F.col("formatted")).alias("t"), cf.read_masked(F.col("formatted"), F.col("loss_mask")).alias("m")).collect()
    by = {(r.tree, r.leaf): r for r in got}
    assert set(by) == {("t", 2), ("t", 5), ("t", 9), (None, 1)}
    long = by["t", 5]
    assert [tuple(x) for x in long.t] == [("user", rows[0][4]), ("assistant", ""), ("us: er#", "ok "), ("assistant", "fin </turn>\n")]
    assert long.m == ["", "fin </turn>\n"] and long.branch_rank == 1 and long.branch_score == 2.0
    assert by["t", 2].branch_rank == 2 and by["t", 9].branch_rank == 3
    best = cf.format_reply_trees(spark.createDataFrame(rows, SCHEMA), top_k=1)
    assert {(r.tree, r.leaf) for r in best.collect()} == {("t", 5), (None, 1)}


def test_long_chain_and_empty(spark):
    rows = [("c", k, k - 1 if k else None, "assistant", str(k), 0.0, "") for k in range(300)]
    r = cf.format_reply_trees(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(r) == 1 and r[0].n_turns == 300
    assert cf.format_reply_trees(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cycle(spark):
    with pytest.raises(ValueError, match="cycle"):
        cf.format_reply_trees(spark.createDataFrame([("c", 1, 2, "u", "", 0.0, ""), ("c", 2, 1, "u", "", 0.0, "")], SCHEMA))


def test_conversations_against_python(spark):
    """Ties in turn, repeated rows, null turns and roles, and a very long text, through the same steps as the query."""
    import hashlib

    rows = [
        (1, 0, "user", "q" * 400_000), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"),
        (2, None, None, None), (2, 3, "assistant", "</turn> # \\ <"), (2, 3, None, "x"), (None, 1, "assistant", "only"),
    ]
    c = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, node string")
    out = cf.format_reply_trees(cf.conversation_messages(c)).select("tree", "n_turns", cf.read_turns(F.col("formatted")).alias("t"), cf.read_masked(F.col("formatted"), F.col("loss_mask")).alias("m")).collect()
    assert len(out) == 3
    for r in out:
        own = [x for x in rows if (None if x[0] is None else str(x[0])) == r.tree]
        line = sorted(own, key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] or ""))
        digest = lambda turns: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert digest([(x[2] or "", x[3] or "") for x in line]) == digest([tuple(t) for t in r.t])
        assert r.m == [x[3] or "" for x in line if x[2] == "assistant"] and r.n_turns == len(own)


def by_brute_force(rows):
    """(tree, leaf, score, turns) of every path, by walking up from each message that nothing replies to."""
    import hashlib

    order = lambda k: (hashlib.md5(f"{rows[k][3] or ''}\n{rows[k][4] or ''}".encode()).hexdigest(), rows[k][5] or 0.0, rows[k][2] is not None, rows[k][2] or 0)
    first = {}
    for k in sorted(range(len(rows)), key=order):
        if rows[k][1] is not None:
            first.setdefault((rows[k][0], rows[k][1]), k)
    up = [first.get((r[0], r[2])) if r[2] is not None else None for r in rows]
    out = []
    for k in set(range(len(rows))) - set(up):
        path, at = [], k
        while at is not None:
            path.append(at)
            at = up[at]
        out.append((rows[k][0], rows[k][1], sum(rows[j][5] or 0.0 for j in path), [(rows[j][3] or "", rows[j][4] or "") for j in path[::-1]]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_shared_ids_against_brute_force(spark, seed):
    """Repeated ids and rows, roots of one id, null ids, and a null tree beside one called "null"."""
    import random

    rng = random.Random(seed)
    rows = [("t", 1, None, "user", "root", 0.0), ("t", 2, 1, "assistant", "x", 1.0), ("t", 2, 1, "assistant", "x", 1.0), ("t", 2, 1, "assistant", "y", 2.0), ("t", 1, None, "user", "other root", 0.5), ("t", 3, 2, "user", "z", 0.0)]
    rows += [(None, 1, None, "user", "a", 0.0), ("null", 1, None, "user", "b", 0.0), (None, 2, 1, "assistant", "c", 0.0), ("null", 2, 1, "assistant", "d", 0.0), ("t", None, 1, "assistant", "no id", 3.0), ("t", None, None, None, None, None)]
    for k in range(60):
        tree, node = rng.choice(["u", "v"]), rng.randrange(1, 25)
        rows.append((tree, node, rng.choice([None, rng.randrange(node)]), rng.choice(["user", "assistant"]), f"m{rng.randrange(4)}", float(rng.randrange(3))))
    d = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    out = cf.format_reply_trees(d).select("tree", "leaf", "branch_score", "branch_rank", cf.read_turns(F.col("formatted")).alias("t")).collect()
    assert sorted(((r.tree, r.leaf, r.branch_score, [tuple(x) for x in r.t]) for r in out), key=repr) == by_brute_force(rows)
    for tree in {r.tree for r in out}:
        own = sorted((r for r in out if r.tree == tree), key=lambda r: r.branch_rank)
        assert [r.branch_rank for r in own] == list(range(1, len(own) + 1))
        assert [(-r.branch_score, r.leaf is None, r.leaf or 0) for r in own] == sorted((-r.branch_score, r.leaf is None, r.leaf or 0) for r in own)

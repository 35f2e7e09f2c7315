"""Exact top-k inner-product search by ball-tree branch and bound.

Vectors are dealt into shards of about SHARD rows by a hash; every shard is packed into one row that holds a ball tree:
nodes split at the farthest-pair direction's median until LEAF vectors are left, each with its centre, radius and
smallest id. Queries are a stated set of rows, packed into blocks of QUERY_BLOCK with the best k found so far.

Shards are searched in rounds of one, one, two, four, eight ... of them. In a round each block of queries travels to each
shard of the round (the small side moves; a tree is dealt to as many tasks as keep the cluster busy), and what was new
there is merged by query in the JVM, so that the current k-th score over all shards before prunes every shard of the
next round. In a shard nodes are visited best bound first, from a heap ordered by the greatest upper bound q.c + |q| r
among the queries still in; a query skips a node whose bound is under its k-th score, or equal to it where the
node's smallest id can no longer win the tie.

Scores are exact integers: products run in float64 where no sum can reach 2**53, in int64 under 2**63, and otherwise as
Python integers; a score beyond a long raises OverflowError rather than coming back wrong.

Work is queries x vectors at worst, as for any exact search of this kind; what is moved is queries x shards. Each row
moved is bounded in size. Rounds are written to the shared folder.

Defined cases: vectors that are null or hold null or non-finite components take no part; of two vectors of unequal
length the shorter counts as filled up with zeros (an empty one scores 0 with all); components beyond a long raise;
with fewer than k candidates all are returned; ties go to the smaller id; repeated ids are candidates each and queries
each; a query never meets rows of its own id; null ids take no part; empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.registry import query
from siltstone.session import materialize, table

LEAF = 256
SHARD = 8192
QUERY_BLOCK = 512
#: Blocks of queries that a task takes at most, so that its batches stay small.
ROWS = 64
EVERY = 20
SCALE = 64.0
_NO_ID = np.iinfo(np.int64).max


def _smallest_type(x: np.ndarray) -> np.ndarray:
    """x in the narrowest integer type that holds it."""
    lo, hi = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max))


def padded(vectors: list, width: int = 0) -> np.ndarray:
    """Rows of integers, filled up with zeros to the longest."""
    width = max([width, *map(len, vectors)], default=width)
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; columns beyond the narrower side count as zeros. float64 or int64."""
    d = min(q.shape[1], x.shape[1])
    q, x = q[:, :d], x[:, :d]
    reach = lambda a: max(-int(a.min()), int(a.max())) if a.size else 0
    most = d * reach(q) * reach(x)
    if most < 2**53:
        return q.astype(np.float64) @ x.astype(np.float64).T
    if most < 2**63:
        return q.astype(np.int64) @ x.astype(np.int64).T
    exact = q.astype(object) @ x.astype(object).T
    if exact.size and max(abs(int(exact.max())), abs(int(exact.min()))) >= 2**63:
        raise OverflowError("an inner product does not fit a long")
    return exact.astype(np.int64)


class BallTree:
    """Leaves and inner nodes over the rows of one shard, in flat arrays."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        ids, x, self.nodes = ids[order], x[order], []  # node: lo, hi, left, right
        perm, wide = np.arange(len(ids)), x.astype(np.float64)
        self._split(wide, perm, 0, len(ids), leaf)
        self.ids, self.x, wide = ids[perm], _smallest_type(x[perm]), wide[perm]
        cut = [(wide[lo:hi], self.ids[lo:hi]) for lo, hi, _, _ in self.nodes]
        self.centre = np.array([c.mean(0) for c, _ in cut])
        self.radius = np.array([np.sqrt(((c - m) ** 2).sum(1).max()) for (c, _), m in zip(cut, self.centre, strict=True)])
        self.least = np.array([i.min() for _, i in cut])

    def _split(self, x: np.ndarray, perm: np.ndarray, lo: int, hi: int, leaf: int) -> int:
        me = len(self.nodes)
        self.nodes.append([lo, hi, -1, -1])
        if hi - lo > leaf:
            v = x[perm[lo:hi]]
            far = v[((v - v.mean(0)) ** 2).sum(1).argmax()]
            way = v[((v - far) ** 2).sum(1).argmax()] - far
            perm[lo:hi] = perm[lo:hi][np.argsort(v @ way, kind="stable")]
            mid = (lo + hi) // 2
            self.nodes[me][2] = self._split(x, perm, lo, mid, leaf)
            self.nodes[me][3] = self._split(x, perm, mid, hi, leaf)
        return me


class Kept:
    """For each query of a block the best k (score, id) so far, best first; places not yet taken are not valid."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.score = np.zeros((len(ids), k), np.int64)
        self.vec = np.full((len(ids), k), _NO_ID)
        self.valid, self.fresh = np.zeros((len(ids), k), bool), np.zeros((len(ids), k), bool)

    def visit(self, t: BallTree) -> None:
        """Branch and bound over one shard, best bound first; what it adds is marked fresh."""
        d = min(self.q.shape[1], t.centre.shape[1])
        q = self.q.astype(np.float64)
        bound = q[:, :d] @ t.centre[:, :d].T + np.sqrt((q * q).sum(1))[:, None] * t.radius
        bound = np.ceil(bound + np.abs(bound) * 1e-9 + 1e-6)  # rounding never hides a row
        heap = [(-float(bound[:, 0].max(initial=-np.inf)), 0)]
        while heap:
            _, n = heapq.heappop(heap)
            b, worst = bound[:, n], self.score[:, -1].astype(np.float64)
            go = np.flatnonzero(~self.valid[:, -1] | (b > worst) | ((b == worst) & (t.least[n] < self.vec[:, -1])))
            if not len(go):
                continue
            lo, hi, left, right = t.nodes[n]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(heap, (-float(bound[go, child].max()), child))
                continue
            self._merge(go, t.ids[lo:hi], products(self.q[go], t.x[lo:hi]))

    def _merge(self, go: np.ndarray, ids: np.ndarray, s: np.ndarray) -> None:
        other = self.ids[go, None] != ids[None, :]
        some = (other & (~self.valid[go, -1:] | (s >= self.score[go, -1:]))).any(1)
        go, s, other = go[some], s[some].astype(np.int64), other[some]
        if not len(go):
            return
        score = np.concatenate([self.score[go], s], 1)
        vec = np.concatenate([self.vec[go], np.broadcast_to(ids, s.shape)], 1)
        valid = np.concatenate([self.valid[go], other], 1)
        fresh = np.concatenate([self.fresh[go], np.ones(s.shape, bool)], 1)
        # ~score, not -score: descending, and no overflow at the least long.
        best = np.lexsort((vec, ~score, ~valid), axis=1)[:, : self.k]
        for mine, new in ((self.score, score), (self.vec, vec), (self.valid, valid), (self.fresh, fresh)):
            mine[go] = np.take_along_axis(new, best, 1)


def integers(vector: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of each component as long; null where the vector takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fits = lambda v: F.abs(F.lit(scale) * v) < float(2**63)
    beyond = F.raise_error(F.lit("a component does not fit a long")).cast("long")
    return F.when(whole, F.transform(x, lambda v: F.when(fits(v), F.floor(F.lit(scale) * v)).otherwise(beyond)))


def _packed(rows: DataFrame, key: Column, name: str, make) -> DataFrame:
    """One row (name, data) for each value of key: what make gives of its ids and vectors; a group is about SHARD rows at most."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf["id"].to_numpy(np.int64), padded(pdf["v"].tolist())
        order = np.argsort(ids, kind="stable")
        return pd.DataFrame({name: [pdf[name].iloc[0]], "data": [pickle.dumps(make(ids[order], x[order]))]})

    return rows.withColumn(name, key.cast("long")).groupBy(name).applyInPandas(pack, f"{name} long, data binary")


def _rounds(shards: int) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < shards:
        hi = min(shards, max(1, 2 * lo))
        yield lo, hi
        lo = hi


_FOUND = "block long, at int, query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int, shard: int = SHARD, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for every query row its k largest inner products over all other rows.

    vectors: (id long, v array<long>); is_query: a condition on them.
    """
    v = materialize(vectors.select("id", "v", F.coalesce(is_query, F.lit(False)).alias("asks")).where("v IS NOT NULL AND id IS NOT NULL"), "vectors")
    n, m = v.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = -(-n // shard), -(-m // block)
    if not m:
        return v.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Rows are dealt by their place too, so that many rows of one id and vector do not meet in a shard.
    v = v.withColumn("place", F.monotonically_increasing_id())
    spread = F.xxhash64("id", "place")
    trees = materialize(_packed(v, F.pmod(spread, F.lit(shards)), "shard", BallTree), "trees")
    asked = materialize(_packed(v.where("asks"), F.pmod(spread, F.lit(blocks)), "block", lambda ids, x: (ids, _smallest_type(x))), "queries")
    parallel = int(v.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def load(asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        kept = Kept(*pickle.loads(asked["data"].iloc[0]), k)
        found = found.sort_values(["at", "rank"])
        at, rank = found["at"].to_numpy(np.int64), found["rank"].to_numpy(np.int64) - 1
        kept.score[at, rank], kept.vec[at, rank], kept.valid[at, rank] = found["score"], found["vec_id"], True
        return pd.DataFrame({"block": asked["block"], "data": [pickle.dumps(kept)]})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = None
        for b in batches:
            for at, data in zip(b["block"].tolist(), b["data"], strict=True):
                if at < 0:
                    tree = pickle.loads(data)
                    continue
                kept: Kept = pickle.loads(data)
                kept.visit(tree)
                i, j = np.nonzero(kept.valid & kept.fresh)
                yield pd.DataFrame({"block": at, "at": i.astype(np.int32), "query_id": kept.ids[i], "vec_id": kept.vec[i, j], "score": kept.score[i, j]})

    best = Window.partitionBy("block", "at").orderBy(F.desc("score"), "vec_id")
    top = None
    for lo, hi in _rounds(shards):
        now = asked if top is None else asked.groupBy("block").cogroup(top.groupBy("block")).applyInPandas(load, "block long, data binary")
        if top is None:
            now = asked.mapInPandas(lambda frames: (pd.DataFrame({"block": [i], "data": [pickle.dumps(Kept(*pickle.loads(d), k))]}) for b in frames for i, d in zip(b["block"], b["data"], strict=True)), "block long, data binary")
        # Some ROWS of queries a task; a tree goes to as many tasks as there are.
        parts = max(parallel, -(-blocks * (hi - lo) // ROWS))
        salts = max(1, min(blocks, -(-parts // (hi - lo))))
        at = F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi - 1).cast("long")))
        sides = now.select(at.alias("shard"), (F.col("block") % salts).alias("salt"), "block", "data").unionByName(
            trees.where(F.col("shard").between(lo, hi - 1)).select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"), F.lit(-1).cast("long").alias("block"), "data")
        )
        dealt = sides.repartition(parts, "shard", "salt").sortWithinPartitions("shard", "salt", "block")
        found = dealt.select("block", "data").mapInPandas(search, _FOUND)
        if top is not None:
            found = found.unionByName(top.drop("rank"))
        top = materialize(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "top")
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query(
    "op8_top_k",
    f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::HUGEINT) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id,
                 coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
)
def op8_top_k(spark, sf):
    """The 20 largest inner products of every row whose id is divisible by 20."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), integers(F.col("embedding")).alias("v"))
    return top_k(e, F.col("id") % EVERY == 0, 20)

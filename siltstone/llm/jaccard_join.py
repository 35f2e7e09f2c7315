"""N-gram Jaccard join by multiple-global-order filtering.

Texts are sets of shingles (five lower-cased words). Two sets of Jaccard similarity 0.8 or more share a shingle
among the first n // 5 + 1 of each under ANY total order of all shingles. Candidates must do so under
ORDERS orders at once; their filters are intersected before anything is verified.

Orders are frequency first, so that what many texts share (common lines, passages, boilerplate) comes last
and hardly enters a prefix; each order has frequency classes of its own width, and its own hash among equals.
Frequencies are counted over all texts in a sketch of fixed size, the only thing broadcast besides marks; an inexact count
changes the orders, never the result.

1. One pass over the texts: sizes, ids (texts of one set are one class from here on) and bitmaps of the sets, and the
   sketch.
2. One pass: the prefixes of every text under every order, as packed arrays by bucket of the shingle. Buckets
   keep the groups: prefix shingles that several classes share, each with one of its classes as leader.
3. Links first: each group's members are paired with its leader; pairs that share a prefix shingle under every
   order are verified, and the components of those links are found. Within a component nothing more has to be known.
4. In the largest group of each class members are paired with the nearest by bitmap of another component, in rounds, so that many
   near copies whom no leader links do not go on as many components with all pairs between them.
5. Then the exact rest: pairs of one group but of different components. Small groups pair them directly, without their
   leaders, whose pairs are decided; in larger ones bitmaps decide first, block against block of BLOCK members, each pair of blocks a task's unit of its own.
   What is left under all orders is verified.

Verification: the first pass also keeps a bitmap of each set's hash parities. The distance of two such bitmaps
never exceeds the sets' symmetric difference, so a pair beyond (n + m) / 9 is no link. Only sets of pairs that
pass this are made again from their texts, in a pass that picks those rows, and compared.

So a group of g near copies costs about g verifications rather than all its pairs, no pair is dropped unseen,
and no group is limited in size. Groups within one component are left out before any bitmap is sent.

Defined cases: null and wordless texts have empty sets and are linked with nothing; fewer words than a shingle
make one shingle; rows of equal ids are rows of their own; a null id never names a component that has another;
empty input gives no rows; other columns are ignored by ``jaccard_components``. Shingles are told apart by 54 bits
of hash within a pair, sets by 64 bits over all texts.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm._bytes import mix
from siltstone.llm._memory import arrow_batches, trim
from siltstone.llm._shingles import BITS, MAX_BYTES, MAX_DOCS, overlap, shingle_sets
from siltstone.llm.components import connected_components
from siltstone.llm.marks import marker
from siltstone.llm.registry import query
from siltstone.session import materialize, table

ORDERS = 3
_ALL = (1 << ORDERS) - 1
#: Counters of the sketch, and in how many rows it travels.
SKETCH, CHUNKS = 1 << 22, 64
#: Groups of up to so many classes pair their members directly.
SMALL = 8
#: How many groups before its own a member of a larger group tells.
BEFORE = 4
#: Members of a large group that a task compares with as many others.
BLOCK = 2048
#: Rounds of nearest pairs before all pairs of different components.
ROUNDS = 2
#: Prefix shingles of one order that meet in a task, some 100 MB there: there are as many buckets as that takes.
TOKENS = 2 << 20
#: Rows that a Python worker gets at once.
ROWS = 1000
_FLUSH = 4 << 20


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    """(lo, hi, texts) of runs that fit one call of shingle_sets; only a run at a time leaves the batch."""
    text = batch.column("text")
    size = pc.binary_length(text).to_numpy()
    lo = total = 0
    for k, n in enumerate(size.tolist()):
        if k > lo and (k - lo >= MAX_DOCS or total + n > MAX_BYTES):
            yield lo, k, text.slice(lo, k - lo).cast(pa.binary()).to_pylist()
            lo, total = k, 0
        total += n
    if len(size) > lo:
        yield lo, len(size), text.slice(lo).cast(pa.binary()).to_pylist()


def _class_ids(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set, as int64; 0 for the empty one."""
    out = np.zeros(len(n), np.uint64)
    some = n > 0
    if some.any():
        out[some] = mix(np.add.reduceat(mix(h + np.uint64(1)), (np.cumsum(n) - n)[some]) + n[some].astype(np.uint64))
    return out.view(np.int64)


def _survey(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, mark, n, cls, bits) of every row, and for every counter of the sketch the rank of its count (four to a doubling)."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(SKETCH, np.uint32)

        def rows(size: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in kinds], schema=kinds)

        for b in frames:
            for lo, hi, raw in _runs(b):
                h, n = shingle_sets(raw)
                np.add.at(counts, (h & np.uint64(SKETCH - 1)).astype(np.int64), np.uint32(1))
                bits = [_bitmap(x) for x in np.split(h, np.cumsum(n)[:-1])]
                yield rows(
                    hi - lo,
                    doc_id=b.column("doc_id").slice(lo, hi - lo),
                    mark=b.column("mark").slice(lo, hi - lo),
                    n=pa.array(n.astype(np.int64)),
                    cls=pa.array(_class_ids(h, n)),
                    bits=pa.array(bits, pa.binary()),
                    chunk=pa.array(np.full(hi - lo, -1, np.int32)),
                )
        if counts.any():
            cut = [zlib.compress(c.tobytes(), 1) for c in counts.reshape(CHUNKS, -1)]
            part = np.full(CHUNKS, TaskContext.get().partitionId() % 1024, np.int32)
            yield rows(CHUNKS, chunk=pa.array(np.arange(CHUNKS, dtype=np.int32)), part=pa.array(part), counts=pa.array(cut, pa.binary()))
        trim()

    kinds = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("bits", pa.binary()), ("chunk", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())])
    schema = "doc_id long, mark long, n long, cls long, bits binary, chunk int, part int, counts binary"
    made = materialize(docs.mapInArrow(run, schema), "survey")

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SKETCH // CHUNKS, np.uint64)
        for c in pdf["counts"]:
            raw = zlib.decompress(c)
            total += np.frombuffer(raw, f"<u{len(raw) * CHUNKS // SKETCH}")
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "part": 0, "counts": [zlib.compress(total.tobytes(), 1)]})

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        c = np.frombuffer(zlib.decompress(add(pdf)["counts"].iloc[0]), np.uint64)
        ranks = np.minimum(255, 4 * np.log2(np.maximum(c, 1))).astype(np.uint8)
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "ranks": [zlib.compress(ranks.tobytes(), 1)]})

    # Twice, so that no task reads more than the square root of all parts.
    parts = "chunk int, part int, counts binary"
    sums = made.where("chunk >= 0").select("chunk", "part", "counts").groupBy("chunk", F.expr("part div 32")).applyInPandas(lambda k, p: add(p), parts)
    sums = sums.groupBy("chunk").applyInPandas(lambda k, p: rank(p), "chunk int, ranks binary")
    ranks, w = np.zeros(SKETCH, np.uint8), SKETCH // CHUNKS
    for chunk, raw in sums.collect():  # CHUNKS rows at most, SKETCH bytes together
        ranks[chunk * w : (chunk + 1) * w] = np.frombuffer(zlib.decompress(raw), np.uint8)
    return made.where("chunk < 0").select("doc_id", "mark", "n", "cls", "bits"), ranks


def _prefixes(h: np.ndarray, n: np.ndarray, ranks: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n // 5 + 1 shingles of each set under one order, and whose they are."""
    doc = np.repeat(np.arange(len(n)), n)
    own = h if order == 0 else mix(h + np.uint64(order)) >> np.uint64(64 - BITS)
    rank = ranks[(h & np.uint64(SKETCH - 1)).astype(np.int64)] >> order
    by = (rank.astype(np.uint64) << np.uint64(BITS)) | own
    at = np.lexsort((by, doc))
    place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    at = at[place < n[doc] // 5 + 1]
    return h[at], doc[at]


def _groups(docs: DataFrame, ranks: np.ndarray, buckets: int) -> DataFrame:
    """(ord, tok, cls, n, g, lead, lead_n): the g classes that share a prefix shingle under an order, where g > 1.

    lead: one of them, the same class wherever it is in a group, and lead_n its size.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)  # SKETCH bytes

    packed_kinds = pa.schema([("ord", pa.int32()), ("bucket", pa.int32()), ("toks", pa.binary()), ("at", pa.binary()), ("wide", pa.int32()), ("clss", pa.binary()), ("ns", pa.binary())])

    def pack(h: list[np.ndarray], n: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, n = np.concatenate(h), np.concatenate(n)
        cls = _class_ids(h, n)
        _, first = np.unique(cls, return_index=True)
        keep = np.zeros(len(n), bool)
        keep[first] = True
        keep &= n > 0
        h, cls, n = h[np.repeat(keep, n)], cls[keep], n[keep]
        rows = []
        for order in range(ORDERS):
            tok, doc = _prefixes(h, n, sent.value, order)
            tok = mix(tok + np.uint64(77))
            bucket = (tok % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            tok, doc, bucket = (tok[by] >> np.uint64(32)).astype("<u4"), doc[by], bucket[by]
            edge = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(edge[1:] > edge[:-1]):
                lo, hi = edge[b], edge[b + 1]
                who, at = np.unique(doc[lo:hi], return_inverse=True)
                wide = 2 if len(who) < 1 << 16 else 4
                rows.append((order, int(b), tok[lo:hi].tobytes(), at.astype(f"<u{wide}").tobytes(), wide, cls[who].tobytes(), n[who].astype("<i4").tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), packed_kinds, strict=True)], schema=packed_kinds)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, ns, size = [], [], 0
        for b in frames:
            for _, _, raw in _runs(b):
                h, n = shingle_sets(raw)
                hs.append(h)
                ns.append(n)
                size += sum(map(len, raw))
                if size >= _FLUSH:
                    yield from pack(hs, ns)
                    hs, ns, size = [], [], 0
        if hs:
            yield from pack(hs, ns)
        trim()

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        order, bucket = int(pdf["ord"].iloc[0]), int(pdf["bucket"].iloc[0])
        at = [np.frombuffer(a, f"<u{w}") for a, w in zip(pdf["at"], pdf["wide"], strict=True)]
        tok = np.concatenate([np.frombuffer(t, "<u4") for t in pdf["toks"]])
        cls = np.concatenate([np.frombuffer(c, "<i8")[a] for c, a in zip(pdf["clss"], at, strict=True)])
        n = np.concatenate([np.frombuffer(c, "<i4")[a] for c, a in zip(pdf["ns"], at, strict=True)])
        by = np.argsort(tok, kind="stable")
        same = tok[by][1:] == tok[by][:-1]
        some = by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]  # most shingles are met once
        tok, cls, n = tok[some], cls[some], n[some]
        by = np.lexsort((cls, tok))
        tok, cls, n = tok[by], cls[by], n[by]
        new = np.concatenate([[True], (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])]) if len(tok) else np.zeros(0, bool)
        tok, cls, n = tok[new], cls[new], n[new]
        _, which, g = np.unique(tok, return_inverse=True, return_counts=True)
        g = g[which]
        keep = g > 1
        tok, cls, n, g = tok[keep], cls[keep], n[keep], g[keep]
        if len(tok):
            first = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
            at = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(tok)]])))
            rank = mix(cls.view(np.uint64) + np.uint64(0x1EAD))  # a bijection: one of a group has the least
            head = np.flatnonzero(rank == np.minimum.reduceat(rank, first)[at])
            lead, lead_n = cls[head][at], n[head][at]
        else:
            lead, lead_n = cls, n
        trim()
        tok = (np.int64(bucket) << 32) | tok.astype(np.int64)
        return pd.DataFrame({"ord": np.int32(order), "tok": tok, "cls": cls, "n": n, "g": g.astype(np.int32), "lead": lead, "lead_n": lead_n})

    packed = docs.select("text").mapInArrow(run, "ord int, bucket int, toks binary, at binary, wide int, clss binary, ns binary")
    return materialize(packed.groupBy("ord", "bucket").applyInPandas(meet, "ord int, tok long, cls long, n int, g int, lead long, lead_n int"), "groups")


def _bitmap(h: np.ndarray) -> bytes:
    """Parities of the set's hashes over the power of two of at least 4 n bits; 64 at least."""
    bits = max(64, 1 << int(4 * len(h) - 1).bit_length())
    odd = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _distance(a: bytes, b: bytes) -> int:
    """Lower bound of the symmetric difference; the longer bitmap is folded to the shorter's length."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _classes(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(cls, rep, n, bits) of the classes in groups: the smallest id of each, its size and its bitmap."""
    some = rows.where(marker(groups, "cls")("cls")).groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").cast("int").alias("n"), F.first("bits").alias("bits"))
    return materialize(some, "classes")


def _sets(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(cls, hashes) of the rows whose id is among reps, and of some more; no join moves a text."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            for _, _, raw in _runs(b):
                h, n = shingle_sets(raw)
                cut = pa.array([c.tobytes() for c in np.split(h, np.cumsum(n)[:-1])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(_class_ids(h, n)), cut], names=["cls", "hashes"])
        trim()

    asked = docs.withColumn("_asked", marker(reps, "rep")("doc_id")).where("_asked").select("text")
    return asked.mapInArrow(run, "cls long, hashes binary").where("cls <> 0")


def _intersected(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs (a, b, met, ...) that share a prefix shingle under every order; met: the orders, as bits, known to."""
    orders = range(ORDERS)
    # 32 bits of a shingle do: what agrees by chance is verified like the rest.
    toks = groups.groupBy("cls").agg(*[F.collect_list(F.when(F.col("ord") == k, F.hash("tok"))).alias(f"t{k}") for k in orders])
    rest = pairs.where(F.col("met") != _ALL)
    for side in "ab":
        rest = rest.join(toks.select(F.col("cls").alias(side), *[F.col(f"t{k}").alias(f"t{k}{side}") for k in orders]), side)
    for k in orders:
        rest = rest.where(F.arrays_overlap(f"t{k}a", f"t{k}b"))
    return pairs.where(F.col("met") == _ALL).unionByName(rest.select(*pairs.columns))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) that are links: sizes and bitmaps first, then the sets of those left.

    groups: pairs have a column met and must share a prefix shingle under the other orders too. Without them pairs are few beside the classes,
    of which only those that are asked for are moved.
    """

    @F.pandas_udf("boolean")
    def near(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([9 * _distance(x, y) <= k for x, y, k in zip(a, b, n, strict=True)], dtype=bool)

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = overlap(x, y)
            out.append(100 * both >= 80 * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    if groups is None:
        pairs = materialize(pairs, "pairs")
        classes = classes.where(marker(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "cls")("cls"))
    side = lambda k: classes.select(*[F.col(c).alias(k if c == "cls" else f"{c}_{k}") for c in classes.columns])
    p = pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes_fit("n_a", "n_b"))
    p = p.where(near("bits_a", "bits_b", F.col("n_a") + F.col("n_b"))).select(*pairs.columns, "rep_a", "rep_b")
    p = materialize(p if groups is None else _intersected(materialize(p, "near"), groups).drop("met"), "near")
    sets = _sets(docs, p.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).distinct())
    sets = materialize(sets.dropDuplicates(["cls"]), "sets")
    for k in "ab":
        p = p.join(sets.select(F.col("cls").alias(k), F.col("hashes").alias(f"hashes_{k}")), k)
    return p.where(linked("hashes_a", "hashes_b")).select("a", "b").distinct()


def _sizes_fit(a: str, b: str) -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def _led(groups: DataFrame) -> DataFrame:
    """Pairs (a, b, met) of every member of a group with the group's leader, the same member wherever it is in the group.

    met: the orders, as bits, under which they were found.
    """
    led = groups.where((F.col("cls") != F.col("lead")) & _sizes_fit("n", "lead_n"))
    pairs = led.select(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b"), "ord")
    return pairs.groupBy("a", "b").agg(F.expr("bit_or(shiftleft(1, ord))").alias("met"))


def _named(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """groups with comp, the component of each class."""
    known = comps.select(F.col("node").alias("cls"), F.col("root").alias("comp"))
    return groups.join(known, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))


def _largest(groups: DataFrame) -> DataFrame:
    """(ord, tok, cls, n, g) of the largest group of each class under each order, where it has more than SMALL classes."""
    most = groups.where(F.col("g") > SMALL).groupBy("ord", "cls").agg(F.max(F.struct("g", "tok")).alias("most"), F.first("n").alias("n"))
    return materialize(most.select("ord", "most.tok", "cls", "n", "most.g"), "largest")


def _compared(big: DataFrame, classes: DataFrame, nearest: bool) -> DataFrame:
    """Pairs (a, b, ord) of different components (comp) in a large group whose bitmaps do not rule a link out.

    nearest: of every member only the pair with the nearest of its own block; work and pairs then follow the members.
    """
    unit = ["ord", "tok", "lo", "hi"]

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for b in frames:
            new = (b[unit].to_numpy()[1:] != b[unit].to_numpy()[:-1]).any(axis=1)
            cut = [0, *(np.flatnonzero(new) + 1).tolist(), len(b)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                part = b.iloc[lo:hi]
                if held and (held[-1][unit].iloc[0] != part[unit].iloc[0]).any():
                    yield from _group_pairs(pd.concat(held), nearest)
                    held = []
                held.append(part)
        if held:
            yield from _group_pairs(pd.concat(held), nearest)
        trim()

    # Bitmaps of members only are moved.
    big = materialize(big, "members")
    classes = classes.where(marker(big.select("cls").distinct(), "cls")("cls"))
    # A large group is dealt into blocks by hash; a member goes to every unit that compares its block with another.
    blocks = F.ceil(F.col("g") / BLOCK).cast("int")
    big = big.withColumn("blk", F.pmod(F.xxhash64("cls", F.lit("block")), blocks).cast("int"))
    others = F.array("blk") if nearest else F.sequence(F.lit(0), blocks - 1)
    big = big.withColumn("other", F.explode(others)).withColumns({"lo": F.least("blk", "other"), "hi": F.greatest("blk", "other")})
    big = big.join(classes.select("cls", "bits"), "cls").repartition(*unit).sortWithinPartitions(*unit, "n", "cls")
    return big.select(*unit, "blk", "cls", "n", "comp", "bits", "before").mapInPandas(compare, "a long, b long, ord int")


def _nearest(largest: DataFrame, comps: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes and the nearest, of another component, that they meet in their largest groups."""
    alone = F.array(*[F.lit(-1).cast("long")] * BEFORE)
    return _compared(_named(largest, comps).withColumn("before", alone), classes, nearest=True).select("a", "b").distinct()


def _apart(groups: DataFrame, comps: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that share a group under every order, but for some that a leader has decided."""
    m = _named(groups, comps)
    # What a leader shares a group with has been verified, so small groups, most of which are pairs by chance, go on without their leaders.
    small = m.where((F.col("g") > 2) & (F.col("g") <= SMALL) & (F.col("cls") != F.col("lead")))
    x, y = (small.select("ord", "tok", *[F.col(c).alias(f"{c}_{k}") for c in ("cls", "n", "comp")]) for k in "ab")
    direct = x.join(y, ["ord", "tok"]).where(
        (F.col("cls_a") < F.col("cls_b")) & (F.col("comp_a") != F.col("comp_b")) & _sizes_fit("n_a", "n_b")
    )
    direct = direct.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"), "ord")
    # Near copies share most of their groups: with the groups before it a member says where it has met others already.
    line = Window.partitionBy("ord", "cls").orderBy("tok")
    before = F.array(*[F.coalesce(F.lag("tok", k).over(line), F.lit(-1).cast("long")) for k in range(1, BEFORE + 1)])
    big = m.where(F.col("g") > SMALL)
    mixed = big.groupBy("ord", "tok").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least <> most").select("ord", "tok")
    compared = _compared(big.withColumn("before", before).join(mixed, ["ord", "tok"], "left_semi"), classes, nearest=False)
    # A pair may be found in a small group under one order and in a large one under another.
    return direct.unionByName(compared).groupBy("a", "b").agg(F.expr("bit_or(shiftleft(1, ord)) AS met")).where(F.col("met") == _ALL).select("a", "b")


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    return connected_components(comps.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))


def _group_pairs(g: pd.DataFrame, nearest: bool = False, rows: int = 512) -> Iterator[pd.DataFrame]:
    """Pairs of a unit that differ in component and whose bitmaps do not rule a link out; sizes ascend.

    A unit is a large group, or two blocks of one; pairs within a block are the business of the unit of that block alone.
    Pairs that both came from one of the last groups are left to that one. nearest: of each member only its nearest pair.
    """
    comp = g["comp"].to_numpy()
    if (comp == comp[0]).all():
        return
    n, cls, raw = g["n"].to_numpy(np.int64), g["cls"].to_numpy(), g["bits"].tolist()
    order, before = int(g["ord"].iloc[0]), np.array(g["before"].tolist())
    blk, across = g["blk"].to_numpy(), g["lo"].iloc[0] != g["hi"].iloc[0]
    for width in sorted({len(r) for r in raw}):
        # Bitmaps of one width, and folded to it those of the next sizes that may be linked to them.
        me = np.array([k for k, r in enumerate(raw) if len(r) == width])
        other = np.array([k for k, r in enumerate(raw) if len(r) in (width, 2 * width)])
        fold = [np.frombuffer(raw[k], np.uint64) for k in other]
        fold = np.array([x if len(x) * 8 == width else x[: len(x) // 2] ^ x[len(x) // 2 :] for x in fold])
        mine = np.array([np.frombuffer(raw[k], np.uint64) for k in me])
        step = max(1, min(rows, (1 << 24) // max(1, fold.size)))
        for lo in range(0, len(me), step):
            i = me[lo : lo + step]
            ok = (comp[i, None] != comp[None, other]) & ((i[:, None] < other[None, :]) | (np.array([len(raw[k]) for k in other]) != width)[None, :])
            ok &= 5 * np.minimum(n[i, None], n[None, other]) >= 4 * np.maximum(n[i, None], n[None, other])
            if across:
                ok &= blk[i, None] != blk[None, other]
            r, c = np.nonzero(ok)
            new = np.ones(len(r), bool)
            for k in range(BEFORE):
                x = before[i[r], k]
                for o in range(BEFORE):
                    new &= (x != before[other[c], o]) | (x < 0)
            r, c = r[new], c[new]
            d = np.zeros(len(r), np.int64)
            for s in range(0, len(r), 1 << 16):
                d[s : s + (1 << 16)] = np.bitwise_count(mine[lo + r[s : s + (1 << 16)]] ^ fold[c[s : s + (1 << 16)]]).sum(1, dtype=np.int64)
            keep = np.flatnonzero(9 * d <= n[i[r]] + n[other[c]])
            if nearest:
                keep = keep[np.argsort(d[keep], kind="stable")]
                keep = np.union1d(*[keep[np.unique(x[keep], return_index=True)[1]] for x in (r, c)])
            a, b = cls[i[r[keep]]], cls[other[c[keep]]]
            if len(a):
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "ord": np.int32(order)})


def text_mark(text: Column | str) -> Column:
    """64 bits of hash of a text; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark, n_shingles, cls, component_id) for each row: the smallest id that links reach, and the set's id.

    mark: the text's hash (text_mark), which tells rows of equal ids apart.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # Texts go to Python some at a time; what is returned is left to the JVM.
    with arrow_batches(spark, ROWS):
        rows, ranks = _survey(docs.withColumn("mark", text_mark("text")))
        tokens = rows.agg(F.sum(F.expr("n div 5 + 1"))).first()[0] or 0
        buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4, -(-tokens // TOKENS))
        groups = _groups(docs, ranks, buckets)
        classes = _classes(rows, groups)
        first = materialize(_verified(_led(groups), classes, docs, groups), "links")
        comps = connected_components(first)
        largest = _largest(groups)
        for _ in range(ROUNDS):
            near = materialize(_verified(_nearest(largest, comps, classes), classes, docs), "links")
            if near.isEmpty():
                break
            comps = _merged(comps, near)
        rest = materialize(_verified(_apart(groups, comps, classes), classes, docs), "links")
        if not rest.isEmpty():
            comps = _merged(comps, rest)
    named = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"))
    named = named.join(comps, F.col("cls") == F.col("node"), "left").select("cls", "rep", F.coalesce("root", "cls").alias("root"))
    ids = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(ids, "root").select("cls", "component_id")
    return rows.join(named, "cls", "left").select(
        "doc_id", "mark", F.col("n").alias("n_shingles"), "cls", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


@query(
    "op3_jaccard_join",
    f"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
                                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM d),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    p AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.r < b.r GROUP BY a.r, b.r),
    l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
    c AS (SELECT reach.a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
    FROM d JOIN c USING (r) LEFT JOIN n USING (r)
    """,
)
def op3_jaccard_join(spark, sf):
    """Sizes and components of all documents' shingle sets."""
    return jaccard_components(table(spark, sf, "documents")).drop("cls", "mark")

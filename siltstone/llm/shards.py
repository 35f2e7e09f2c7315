"""Sharding by histogram sort: shards of equal bytes, one exchange of the rows [DataFrame operations only].

Rows have an order of their own: by a 60-bit hash of the text, then by one of the id. Shard j ends where the bytes up to there come
nearest to j / n of all bytes. Those splitters are found without moving a row: each round counts, over a narrow table of keys, the
exact bytes below candidate boundaries in all partitions, and puts new candidates into the ranges that still hold a splitter, until
each splitter meets the tolerance or lies between two neighbouring rows. Then all rows are exchanged once, by the part they belong
to, sorted there, and written as one folder a shard.

Equal texts lie side by side. A group of them goes whole into one shard if its bytes are at most GROUP of a shard's; a larger one is
cut between its rows, so that a hot text fills as many shards as it has bytes for. Rows equal in both text and id cannot be told apart:
where they alone are more than GROUP of a shard they are dealt by a random number in proportion to the bytes wanted on either side.

A shard is exchanged in parts of about PART_BYTES, so a task holds a part, never a shard; further splitters, found in the same
rounds with a wider tolerance, bound them. Up to MOST_PARTS parts their ends are all that tasks are told; beyond, parts grow. What
reaches the driver is a row of sums a candidate: FAN for each range that is still open.

Which shard a row is in, and its slot, follow from the rows alone, not from how they lie in files, how many tasks there are or where
parts end (but for rows dealt by random numbers). With a tolerance over 0 a shard may end that share of its bytes early or late.

Defined cases: null text counts as no bytes and as equal to an empty one; null id hashes as no digits; rows equal in text and id stay
together up to the bound above; a text larger than a shard fills one alone, others may then be empty; empty input gives no rows; columns
of the input named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm._crc_sql import CRC_TABLE, crc_sql
from siltstone.llm.registry import query
from siltstone.session import materialize, scratch, table

SHARDS = 40
#: Bytes that a row counts beside its text.
ROW_BYTES = 16
#: The share of a shard's bytes up to which a group of equal texts is not cut.
GROUP = 0.01
#: The share of a part's bytes by which a part, not a shard, may end early or late.
PART_TOLERANCE = 0.1
PART_BYTES, MOST_PARTS = 16 << 20, 1 << 16
FAN = 16
_TOP = 1 << 60
_RESULT = ("size", "shard", "slot", "part", "row")


def hashed(c: Column) -> Column:
    """A whole number under 2**60."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("long")


#: (k1, k2, share): the first key beyond a target, and the share of the rows of that key that lie before it.
Splitter = tuple[int, int, float]


@dataclass
class _Range:
    """Keys (k1, k2) from lo to hi, the bytes below and up to them, and the (number, bytes, tolerance) of targets that lie there."""

    lo: tuple[int, int]
    hi: tuple[int, int]
    below: int
    upto: int
    targets: list[tuple[int, Fraction, Fraction]]


def _probes(r: _Range, fan: int) -> list[tuple[int, int]]:
    """Candidate boundaries that cut a range into fan: by the text's hash, or within one text by the id's."""
    (a, b), (c, d) = r.lo, r.hi
    if a < c:
        step = -(-(c - a + 1) // fan)
        return [r.lo, *((k, 0) for k in range(a + step, c + 1, step))]
    step = max(1, -(-(d - b + 1) // fan))
    return [(a, k) for k in range(b, d + 1, step)]


def _position(keys: list[tuple], *key: Column) -> Column:
    """How many of the sorted keys (numbers for each of the columns of key) lie at or under them: a binary search."""
    if not keys:
        return F.lit(0)
    known = [F.expr(f"cast(split('{','.join(map(repr, values))}', ',') as array<{'double' if n == 2 else 'bigint'}>)") for n, values in enumerate(zip(*keys, strict=True))]

    def halve(a: Column, _: Column) -> Column:
        mid = F.shiftright(a["lo"] + a["hi"], 1)
        under = F.get(known[-1], mid) <= key[-1]
        for values, k in zip(known[-2::-1], key[-2::-1], strict=True):
            at = F.get(values, mid)
            under = (at < k) | ((at == k) & under)
        return F.when(a["lo"] >= a["hi"], a).when(under, F.struct((mid + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), mid.alias("hi")))

    first = F.struct(F.lit(0).alias("lo"), F.lit(len(keys)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(keys).bit_length())), first, halve)["lo"]


def splitters(keys: DataFrame, targets: list[tuple[Fraction, Fraction]], whole: Callable[[int], bool]) -> list[Splitter]:
    """For each of the sorted targets (bytes, tolerance in bytes) the first key beyond it: (k1, k2, share of the rows of that key).

    keys: (k1 long, k2 long, size long), with rows. whole: whether a group of so many bytes must not be cut. A round is one aggregate.
    """
    total = keys.agg(F.sum("size")).first()[0]
    found: list = [None] * len(targets)
    ranges = [_Range((0, 0), (_TOP - 1, _TOP - 1), 0, total, [(k, t, slack) for k, (t, slack) in enumerate(targets)])]
    fan = max(FAN, 2 * len(targets))
    while ranges and targets:
        starts = {p: k for k, r in enumerate(ranges) for p in _probes(r, fan)}
        ends = sorted({(r.hi[0], r.hi[1] + 1) for r in ranges} | set(starts))
        seen = [f(c).alias(f"{f.__name__}_{c}") for c in ("k1", "k2") for f in (F.min, F.max)]
        sums = keys.groupBy(_position(ends, F.col("k1"), F.col("k2")).alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("n"), *seen)
        cells: list[list[dict]] = [[] for _ in ranges]
        for c in sorted(sums.toArrow().to_pylist(), key=lambda c: c["cell"]):
            if c["cell"] and (k := starts.get(ends[c["cell"] - 1])) is not None:
                cells[k].append(c)
        ranges = [x for r, c in zip(ranges, cells, strict=True) for x in _narrowed(r, c, whole, found)]
        fan = FAN
    return found


def _narrowed(r: _Range, cells: list[dict], whole: Callable[[int], bool], found: list) -> list[_Range]:
    """The parts of a range that still hold targets; targets that can be settled go to found."""
    out, at, k = [], r.below, 0
    for c in cells:
        end, open_ = at + c["size"], []
        lo, hi = (c["min_k1"], c["min_k2"]), (c["max_k1"], c["max_k2"])
        one_text, one_key = lo[0] == hi[0], lo == hi
        all_of_text = one_text and r.lo[0] < r.hi[0]  # candidates by the text's hash cut no text
        if not one_text:
            lo, hi = (lo[0], 0), (hi[0], _TOP - 1)
        while k < len(r.targets) and r.targets[k][1] < end:
            n, t, slack = r.targets[k]
            k += 1
            first, next_ = (*lo, 0.0), (hi[0], hi[1] + 1, 0.0)
            if t - at <= slack:
                found[n] = first
            elif end - t <= slack:
                found[n] = next_
            elif all_of_text and whole(c["size"]):
                found[n] = (lo[0], 0, 0.0) if at + end >= 2 * t else (lo[0], _TOP, 0.0)
            elif one_key and (c["n"] == 1 or whole(c["size"])):
                found[n] = first if at + end >= 2 * t else next_
            elif one_key:
                found[n] = (*lo, float((t - at) / c["size"]))
            else:
                open_.append((n, t, slack))
        if open_:
            out.append(_Range(lo, hi, at, end, open_))
        at = end
    return out


def histogram_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    doc_id: str = "doc_id",
    text: str = "text",
    tolerance: float = 0.0,
    folder: str | None = None,
    row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """All rows with size, shard and slot (gapless from 0, in the order of the keys), read from the folders of folder (else a new one).

    tolerance: the share of a shard's bytes by which it may end early or late.
    """
    spark = docs.sparkSession
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + row_bytes).cast("long")
    k1, k2 = hashed(F.coalesce(F.col(text), F.lit(""))), hashed(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    keys = materialize(docs.select(k1.alias("k1"), k2.alias("k2"), size.alias("size")), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Shards in parts: no larger than PART_BYTES, and as many as there are tasks.
    parts = max(1, min(max(-(-total // (shards * PART_BYTES)), -(-wide // shards)), MOST_PARTS // shards))
    per = Fraction(total, shards * parts)
    near = Fraction(tolerance) * parts * per
    targets = [(j * per, near if j % parts == 0 else max(near, Fraction(PART_TOLERANCE) * per)) for j in range(1, shards * parts)]
    cut = splitters(keys, targets, lambda size: size * shards <= GROUP * total) if total else []
    kept = [c for c in docs.columns if c.lower() not in _RESULT]
    rows = docs.select(*kept, size.alias("size"), k1.alias("_k1"), k2.alias("_k2"), F.rand(1).alias("_u"))
    rows = rows.withColumn("part", _position(list(accumulate(cut, max)), F.col("_k1"), F.col("_k2"), F.col("_u")))
    rows = rows.withColumn("shard", F.floor(F.col("part") / parts).cast("int"))
    inside = Window.partitionBy("shard", "part").orderBy("_k1", "_k2", "_u")
    rows = rows.repartitionById(shards * parts, "part").withColumn("row", F.row_number().over(inside) - 1).drop("_k1", "_k2", "_u")
    path = folder or scratch(spark, "shards")
    rows.write.partitionBy("shard").parquet(path)
    done = spark.read.schema(rows.schema).parquet(path)
    sizes = materialize(done.groupBy("shard", "part").agg(F.count("*").alias("n")), "parts")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    out = done.join(F.broadcast(first), F.col("part") == F.col("_part"))  # a row a part: MOST_PARTS, or one a shard
    return out.select(*kept, "size", "shard", (F.col("row") + F.col("_first")).cast("long").alias("slot"))


@query(
    "op12_shards",
    f"""
    WITH tab AS ({CRC_TABLE}),
    k AS (SELECT doc_id, text, octet_length(encode(coalesce(text, '')))::BIGINT + {ROW_BYTES} AS size,
                 ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS k1, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k2 FROM documents),
    w AS (SELECT *, sum(size) OVER () AS total, sum(size) OVER (PARTITION BY k1) AS g, sum(size) OVER (PARTITION BY k1, k2) AS a,
                 sum(size) OVER (ORDER BY k1) AS upto_g, sum(size) OVER (ORDER BY k1, k2) AS upto_a FROM k),
    p AS (SELECT *, CASE WHEN g * {SHARDS} <= {GROUP}::DOUBLE * total THEN 2 * upto_g - g ELSE 2 * upto_a - a END AS twice_mid FROM w),
    s AS (SELECT *, least({SHARDS - 1}, twice_mid * {SHARDS} // (2 * total))::INTEGER AS shard FROM p)
    SELECT doc_id, size, {crc_sql("hex(encode(coalesce(text, '')))")} AS text_crc32, 'bytes' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY k1, k2) - 1 AS slot, NULL::INTEGER AS grown_shard
    FROM s, tab
    """,
)
def op12_shards(spark, sf):
    """Deals all documents into 40 shards of equal bytes."""
    out = histogram_shards(table(spark, sf, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return out.select("doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Embedding whitening by an exact integer scatter.

Vectors become whole numbers x = floor(scale c). The fit list holds each distinct x once. Over it n, S = sum x and XᵀX are found
exactly: a task subtracts a shift of its own (its first vector), multiplies blocks whose products and sums stay under 2**53 in
float64, where they are exact (larger numbers are cut into limbs of LIMB bits first), adds the blocks up as Python integers and
takes the shift back out. Partial sums are merged by row of the matrix. Only n XᵀX - S Sᵀ, exact, is divided by n² and becomes
float64, for numpy's eigh. Neither the order of rows nor how they lie in partitions can change a bit of it.

Rows are then projected on the components and divided by the roots of their eigenvalues; the deviation sum((n x - S)²) is exact.

What reaches the driver is a matrix a length of vectors: d x d numbers, bounded by the dimension. Hot vectors are counted once, where
they are read (a partial distinct), and never meet.

Defined cases: null vectors and such with null or non-finite entries are dropped; vectors of each length are whitened among
themselves; vectors of length 0 and components whose eigenvalue is under RANK of the trace (fewer distinct vectors than dimensions,
or dimensions that others explain) give no rows, as there whitening is undefined; an entry that does not fit a long raises; a
deviation that does not fit decimal(38, 0) is null; rows of equal id or vector give rows each; null ids are kept; empty input gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.registry import query
from siltstone.session import materialize, table

SCALE, COMPONENTS = 256.0, 4
#: Bits of a limb, and vectors of a block: LIMB + LIMB + log2(BLOCK) <= 53.
LIMB, BLOCK = 20, 1 << 13
#: Eigenvalues under this share of the trace count as 0.
RANK = 1e-12
#: Partial sums that are merged at once.
MERGED = 64


def whole_numbers(vector: Column, scale: float = SCALE) -> Column:
    """array<long> floor(scale c); null where the vector is null or holds null or non-finite entries; beyond a long: an error."""
    doubles = F.transform(vector, lambda c: c.cast("double"))
    good = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fits = lambda c: F.when(F.abs(c * scale) < 2.0**63, F.floor(c * scale).cast("long")).otherwise(F.raise_error(F.lit("an entry does not fit a long")).cast("long"))
    return F.when(vector.isNotNull() & good, F.transform(doubles, fits))


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Whole numbers (int64 or Python integers) as sums of float64 limbs v_k of at most LIMB bits: x = sum v_k 2**(LIMB k)."""
    out = []
    while True:
        if max(abs(int(x.min())), abs(int(x.max()))) < 1 << LIMB:
            return [*out, x.astype(np.float64)]
        low = x & ((1 << LIMB) - 1)
        out.append(low.astype(np.float64))
        x = (x - low) >> LIMB


def block_scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products, as Python integers, of at most BLOCK rows of whole numbers."""
    limbs = _limbs(x)
    s = sum(v.sum(axis=0).astype(np.int64).astype(object) << (LIMB * k) for k, v in enumerate(limbs))
    c = sum((u.T @ v).astype(np.int64).astype(object) << (LIMB * (j + k)) for j, u in enumerate(limbs) for k, v in enumerate(limbs))
    return s, c


class Scatter:
    """n, sums and cross-products of the vectors of one length, less a shift."""

    def __init__(self, shift: np.ndarray):
        d = len(shift)
        self.n, self.shift, self.s, self.c = 0, shift, np.zeros(d, object), np.zeros((d, d), object)

    def add(self, x: np.ndarray) -> None:
        for at in range(0, len(x), BLOCK):
            b = x[at : at + BLOCK]
            wide = max(abs(int(b.min())), abs(int(b.max())), abs(int(self.shift.min())), abs(int(self.shift.max()))) >= 1 << 62
            s, c = block_scatter(b.astype(object) - self.shift.astype(object) if wide else b - self.shift)
            self.n, self.s, self.c = self.n + len(b), self.s + s, self.c + c

    def unshifted(self) -> tuple[int, np.ndarray, np.ndarray]:
        """n, S and XᵀX of the vectors as they are."""
        a = self.shift.astype(object)
        return self.n, self.s + self.n * a, self.c + np.outer(self.s, a) + np.outer(a, self.s) + self.n * np.outer(a, a)


def _rows(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) for each length of vectors that occurs, but 0."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == d)
        some = vectors if len(at) == len(vectors) else vectors.take(pa.array(at))
        yield at, some.flatten().to_numpy().reshape(-1, d)


_SUMS = "d int, slot int, i int, v array<string>"


def scatters(fit: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vectors n, S and XᵀX over all rows of fit (x array<long>), exact."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        sums: dict[int, Scatter] = {}
        for b in batches:
            for _, x in _rows(b.column("x")):
                sums.setdefault(x.shape[1], Scatter(x[0].copy())).add(x)
        slot = TaskContext.get().partitionId()
        for d, found in sums.items():
            n, s, c = found.unshifted()
            rows = [[n], s, *c]  # the rows -2, -1, 0 ... of a length
            lists = [[str(v) for v in r] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * (d + 2), pa.int32()), pa.array([slot] * (d + 2), pa.int32()), pa.array(range(-2, d), pa.int32()), pa.array(lists, pa.list_(pa.string()))], ["d", "slot", "i", "v"]
            )

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        total = [sum(map(int, each)) for each in zip(*rows["v"], strict=True)]
        return pd.DataFrame({"d": rows["d"].iloc[:1], "slot": rows["slot"].iloc[:1], "i": rows["i"].iloc[:1], "v": [list(map(str, total))]})

    sums = materialize(fit.select("x").mapInArrow(partial, _SUMS), "sums")
    slots = (sums.agg(F.max("slot")).first()[0] or 0) + 1
    while True:
        slots = -(-slots // MERGED)
        sums = sums.withColumn("slot", F.col("slot") % slots).groupBy("d", "slot", "i").applyInPandas(merge, _SUMS)
        if slots == 1:
            break
    out: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    rows = {(r["d"], r["i"]): [int(v) for v in r["v"]] for r in sums.toArrow().to_pylist()}
    for d in sorted({d for d, _ in rows}):
        c = np.empty((d, d), object)
        for i in range(d):
            c[i] = rows[d, i]
        out[d] = rows[d, -2][0], np.array(rows[d, -1], object), c
    return out


class Whitener:
    """Components of the vectors of one length: the columns of u, by falling eigenvalue."""

    def __init__(self, n: int, s: np.ndarray, c: np.ndarray, components: int):
        exact = n * c - np.outer(s, s)
        v = np.array([[a / (n * n) for a in row] for row in exact], np.float64)  # quotients of integers, correctly rounded
        e, u = np.linalg.eigh(v)
        trace = float(np.trace(v))
        keep = [k for k in range(len(e) - 1, -1, -1) if e[k] > RANK * trace][:components]
        u = u[:, keep]
        u *= np.where(u[np.abs(u).argmax(axis=0), range(len(keep))] < 0, -1.0, 1.0) if keep else 1.0
        self.n, self.s, self.u, self.e, self.explained = n, s, u, e[keep], e[keep] / trace if keep else e[keep]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: int64 where it fits, else Python integers."""
        most = self.n * max(abs(int(x.min())), abs(int(x.max()))) + max(abs(int(v)) for v in self.s)
        return x * self.n - self.s.astype(np.int64) if most < 1 << 63 else x.astype(object) * self.n - self.s

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        """The whitened coordinates of n x - S."""
        # Divided exactly first: of integers beyond 2**53 the quotient, not the integer, becomes a double.
        y = centred / np.float64(self.n) if centred.dtype != object else np.array([[a / self.n for a in row] for row in centred], np.float64)
        return (y @ self.u) / np.sqrt(self.e)

    def deviation(self, centred: np.ndarray) -> list[int]:
        """sum((n x - S)²), exact."""
        most = max(abs(int(centred.min())), abs(int(centred.max())))
        if centred.dtype != object and most * most * centred.shape[1] < 1 << 63:
            return np.einsum("ij,ij->i", centred, centred).tolist()
        return [sum(a * a for a in row) for row in centred.astype(object)]


def _project(rows: DataFrame, fits: dict[int, Whitener]) -> DataFrame:
    """(the id columns of rows, n, deviation, whitened array<double>) of all rows whose length has components."""
    ids = [f for f in rows.schema.fields if f.name != "x"]
    schema = T.StructType([*ids, T.StructField("d", T.IntegerType()), T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _rows(b.column("x")):
                w = fits.get(x.shape[1])
                if w is None or not len(w.e):
                    continue
                y = w.centred(x)
                dev = pa.array([v if v < 10**38 else None for v in w.deviation(y)], pa.decimal128(38, 0))
                z = w.whiten(y)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, z.shape[1]), pa.int32()), pa.array(z.ravel()))
                kept = [b.column(f.name).take(pa.array(at)) for f in ids]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.full(len(at), x.shape[1], np.int32)), dev, lists], schema.names)

    return rows.mapInArrow(run, schema)


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: float = SCALE, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), whole_numbers(F.col(vector), scale).alias("x")).where("x IS NOT NULL")
    fit = materialize(rows.select("x").distinct(), "fit")
    fits = {d: Whitener(*found, components) for d, found in scatters(fit).items()}
    fits = {d: w for d, w in fits.items() if len(w.e)}
    spark = vectors.sparkSession
    errors = _identity_errors(fit, fits)
    known = [(d, k + 1, w.n, float(x), errors[d]) for d, w in fits.items() for k, x in enumerate(w.explained)]
    known = spark.createDataFrame(known, "_d int, component int, n long, explained double, identity_error double")
    out = _project(rows, fits).select("vec_id", "d", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    out = out.join(F.broadcast(known), (F.col("d") == F.col("_d")) & (F.col("at") + 1 == F.col("component")))  # a few rows a length
    return out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def _identity_errors(fit: DataFrame, fits: dict[int, Whitener]) -> dict[int, float]:
    """For each length the largest entry of |cov(whitened) - I| over the fit list."""
    most = max((len(w.e) for w in fits.values()), default=0)
    pairs = [(i, j) for i in range(most) for j in range(i + 1)]
    at = lambda k: F.get("whitened", F.lit(k))
    each = [F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in pairs]  # centred before multiplying
    if not each:
        return {}
    out = {}
    for r in _project(fit, fits).groupBy("d").agg(*each).collect():  # a row a length
        out[r["d"]] = max(abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if i < len(fits[r["d"]].e))
    return out


@query("op13_whitening")
def op13_whitening(spark, sf):
    """Whitens all embeddings along the four strongest components."""
    out = whiten(table(spark, sf, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))

"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled web text train a scorer that minimises the non-negative unbiased
risk  pi R+(f) + max(0, R-_u(f) - pi R-_p(f))  of the logistic loss, whose minimiser is the posterior itself: no
negative label is used, neither for the class prior pi nor to calibrate. Labels are read only to find positives.

1. A bounded sample of labelled rows (at most MAX_POSITIVE of label 1, and MAX_CONTRAST of any label, their labels
   dropped) trains a contrast between positives and text at large, in one task.
2. All unlabelled text is passed once. A chunk of CHUNK documents estimates its class prior (the best bin: the
   threshold of the contrast's scores at which the ratio of the shares above it, unlabelled over held-back
   positives, is least) and minimises the risk from the same start; the solutions, linear in fixed inputs, are
   averaged by their numbers of documents (one-shot averaging of parallel learners). Every text counts, a task holds
   one chunk, and only sums of parameters are shuffled.
3. Every document is scored.

Inputs of a score are figures of the whole text alone: bytes by class and pairs of byte classes, word and line
repetition, lengths and shares of character kinds, and a fixed layer of random tanh units over them. The model is a
few kilobytes and travels in the closure; the positives (MAX_POSITIVE rows of 1 KB at most) are broadcast.

Defined cases: null text counts as empty and gets a score like any other; null ids count as the empty string in the
split; repeated label rows count once, repeated documents each; without positives or unlabelled text every score is
0.5; empty input gives no rows; other columns pass through where a result column has not their name.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm._memory import arrow_batches
from siltstone.llm.registry import query
from siltstone.session import materialize, spread, table

#: Bounds of the sample of labelled rows.
MAX_POSITIVE, MAX_CONTRAST = 6000, 6000
#: Unlabelled documents that a task holds at once.
CHUNK = 4096
#: Texts that a Python worker gets at once.
ROWS = 2000
THRESHOLD = 0.3
FOLDS = 5

_GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t", b".", b",;:", b"!?", b"|", b"*#%&$", b"'\"`", b"()[]{}<>", b"/\\@_-=+~^"]
_CLASS = np.zeros(256, np.uint8)
for _k, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _k
_CLASS[128:] = len(_GROUPS)
_N = len(_GROUPS) + 1
DENSE = 14
FEATURES = DENSE + _N + _N * _N


def features(texts: list[str]) -> np.ndarray:
    """One float row for each whole text."""
    out = np.zeros((len(texts), FEATURES), np.float64)
    for row, t in zip(out, texts, strict=True):
        raw = t.encode("utf-8", "surrogatepass")
        words, lines = t.split(), t.split("\n")
        n, m = len(words), len(raw)
        distinct = len(set(words))
        again = sum(map(eq, words, words[1:]))
        pairs = len(set(zip(words, words[1:], strict=False)))
        row[0] = np.log1p(m)
        row[1] = np.log1p(n)
        row[2] = m / max(n, 1) / 10
        row[3] = distinct / max(n, 1)
        row[4] = np.log1p(distinct) / np.log1p(max(n, 1)) if n else 0
        row[5] = again / max(n, 1)
        row[6] = np.sqrt(again / max(n, 1))
        row[7] = pairs / max(n - 1, 1)
        row[8] = np.log1p(len(lines))
        row[9] = len(set(lines)) / len(lines)
        row[10] = n / len(lines) / 20
        row[11] = max(map(len, words), default=0) / 40
        row[12] = float(n < 5)
        row[13] = np.sqrt(1 - row[7])
        if m:
            c = _CLASS[np.frombuffer(raw, np.uint8)]
            one = np.bincount(c, minlength=_N)
            row[DENSE : DENSE + _N] = np.sqrt(one / m)
            if m > 1:
                two = c[:-1] * np.uint8(_N) + c[1:]  # _N * _N - 1 = 224 fits a byte
                row[DENSE + _N :] = np.sqrt(np.bincount(two, minlength=_N * _N) / (m - 1))
    return out


class Scorer:
    """A linear function of standardised figures and of HIDDEN fixed tanh units, through the logistic function.

    Products are einsum's, which adds up each row alike: those of BLAS differ by a row's place among the others.
    """

    HIDDEN = 24

    def __init__(self, mean: np.ndarray | None = None, scale: np.ndarray | None = None, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.units = rng.normal(0, 1.5 / np.sqrt(FEATURES), (FEATURES, self.HIDDEN)).astype(np.float32)
        self.mean, self.scale, self.w = mean, scale, None

    @classmethod
    def standardised(cls, x: np.ndarray) -> Scorer:
        """With the mean and spread of the rows of x."""
        return cls(x.mean(0, dtype=np.float64).astype(np.float32), (x.std(0, dtype=np.float64) + 0.02).astype(np.float32))

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x.astype(np.float32) - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, 4 * np.tanh(np.einsum("ij,jk->ik", z, self.units)), np.ones((len(z), 1), np.float32)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(x), 0.5)
        return _sigmoid(np.einsum("ij,j->i", self.inputs(x), self.w))


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(f.astype(np.float64), -40, 40)))


def risk(w: np.ndarray, zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the unbiased risk: pi R+ of the positives, and R-_u - pi R-_p (which may fall under 0)."""
    fp, fu = zp @ w, zu @ w
    return prior * np.logaddexp(0, -fp).mean(), np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()


def gradient(w: np.ndarray, zp: np.ndarray, zu: np.ndarray, prior: float) -> np.ndarray:
    """Of pi R+ + (R-_u - pi R-_p) where the second part is not under 0; else of minus that part, which brings it back."""
    sp, su = _sigmoid(zp @ w), _sigmoid(zu @ w)
    if risk(w, zp, zu, prior)[1] >= 0:
        return (zp.T @ np.full(len(zp), -prior)) / len(zp) + zu.T @ su / len(zu)
    return prior * (zp.T @ sp) / len(zp) - zu.T @ su / len(zu)


def fit(zp: np.ndarray, zu: np.ndarray, prior: float | None, steps: int = 600, batch: int = 512, rate: float = 0.02, decay: float = 2e-3) -> np.ndarray:
    """Adam on the non-negative risk; prior None: plain contrast of the two, alike in weight."""
    rng, d = np.random.default_rng(11), zp.shape[1]
    w, m1, m2 = np.zeros(d), np.zeros(d), np.zeros(d)
    for step in range(1, steps + 1):
        p, u = (z if len(z) <= batch else z[rng.integers(0, len(z), batch)] for z in (zp, zu))
        if prior is None:
            g = p.T @ (_sigmoid(p @ w) - 1) / len(p) + u.T @ _sigmoid(u @ w) / len(u)
        else:
            g = gradient(w, p, u, prior)
        g[:-1] += decay * w[:-1]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w -= rate * (1 - 0.9 * step / steps) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return w


def class_prior(sp: np.ndarray, su: np.ndarray) -> float:
    """Share of positives in unlabelled text, from scores of positives and of unlabelled rows: the best bin's ratio."""
    sp, su = np.sort(sp), np.sort(su)
    above_p = 1 - np.arange(len(sp)) / len(sp)
    above_u = 1 - np.searchsorted(su, sp) / len(su)
    slack = 0.5 / np.sqrt(len(su)) + 0.5 / np.sqrt(len(sp))
    k = int(np.argmin((above_u + slack) / above_p))
    return float(np.clip(above_u[k] / above_p[k], 0.02, 0.98))


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo FOLDS, is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _rows(df: DataFrame) -> np.ndarray:
    """The feature rows of a bounded table with a binary column x."""
    raw = [bytes(r) for r in df.toPandas()["x"]]
    return np.frombuffer(b"".join(raw), "<f4").reshape(-1, FEATURES)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Scorer:
    """A scorer learned from the positives of rows that are not held out and from all text of such rows, unlabelled."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where(~held_out("doc_id"))
    known = labels.select(F.col(doc_id).alias("doc_id"), (F.col(label) == 1).alias("one")).where(~held_out("doc_id") & F.col("one").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("one").alias("one")).withColumn("order", F.xxhash64(F.lit("order"), F.col("doc_id")))
    take = lambda df, k: df.orderBy("order", "doc_id").limit(k)
    picked = take(known.where("one").select("doc_id", "order", F.lit("p").alias("use")), MAX_POSITIVE).unionByName(
        take(known.select("doc_id", "order", F.lit("c").alias("use")), MAX_CONTRAST)
    )
    uses = picked.groupBy("doc_id", "order").agg(F.array_join(F.array_sort(F.collect_set("use")), "").alias("use"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 256):
                c = b.iloc[lo : lo + 256]
                x = features(c["text"].tolist()).astype("<f4")
                yield pd.DataFrame({"use": c["use"].to_numpy(), "order": c["order"].to_numpy(), "x": [r.tobytes() for r in x]})

    # At most the two bounds together; documents of repeated ids are held to them once more below.
    sample = docs.join(F.broadcast(uses), "doc_id").select("text", "use", "order")
    with arrow_batches(docs.sparkSession, ROWS):
        sample = materialize(sample.mapInPandas(measure, "use string, order long, x binary"), "sample")
    cut = lambda use, k: sample.where(F.contains("use", F.lit(use))).orderBy("order", F.md5("x")).limit(k).select("x")
    xp, xc = _rows(cut("p", MAX_POSITIVE)), _rows(cut("c", MAX_CONTRAST))
    if len(xp) < 2 or not len(xc):
        return Scorer()
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((xp, Scorer.standardised(np.concatenate([xp, xc]))))

    def contrast(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        xp, scorer = sent.value
        raw = b"".join(bytes(x) for b in batches for x in b["x"])
        if raw:
            zp, zc = scorer.inputs(xp), scorer.inputs(np.frombuffer(raw, "<f4").reshape(-1, FEATURES))
            yield pd.DataFrame({"w": [fit(zp[::2], zc, None, steps=300, decay=2e-2).tolist()]})

    found = materialize(cut("c", MAX_CONTRAST).coalesce(1).mapInPandas(contrast, "w array<double>"), "contrast").first()
    axis = np.array(found["w"])

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        xp, scorer = sent.value
        zp, held = scorer.inputs(xp), []

        def solve() -> pd.DataFrame:
            zu = scorer.inputs(np.concatenate(held))
            held.clear()
            prior = class_prior(zp[1::2] @ axis, zu @ axis)
            return pd.DataFrame({"w": [(len(zu) * fit(zp, zu, prior)).tolist()], "n": [len(zu)], "prior": [prior * len(zu)]})

        for b in batches:
            for lo in range(0, len(b), 256):
                held.append(features(b["text"].iloc[lo : lo + 256].tolist()).astype(np.float32))
                if sum(map(len, held)) >= CHUNK:
                    yield solve()
        if held:
            yield solve()

    with arrow_batches(spark, ROWS):
        learned = materialize(docs.select("text").mapInPandas(learn, "w array<double>, n long, prior double"), "learned")
    n, prior = learned.agg(F.sum("n"), F.sum("prior")).first()
    scorer = sent.value[1]
    if n:
        w = learned.select(F.posexplode("w").alias("k", "w")).groupBy("k").agg(F.sum("w").alias("w")).orderBy("k").collect()  # a row a parameter
        scorer.w, scorer.prior = np.array([r["w"] for r in w]) / n, prior / n
    sent.unpersist()
    return scorer


def classify(docs: DataFrame, scorer: Scorer, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with held_out, score and predicted."""
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(np.concatenate([scorer.score(features(t[i : i + 256].tolist())) for i in range(0, len(t), 256)] or [np.zeros(0)]))

    return (
        docs.select(*kept)
        .withColumn("held_out", held_out(doc_id))
        .withColumn("score", score(F.coalesce(F.col(text), F.lit(""))))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


@query("op6_quality_pu")
def op6_quality_pu(spark, sf):
    """Scores all documents with a scorer learned on the four folds that are not held out."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return classify(docs, train(docs, table(spark, sf, "labels"))).select("doc_id", "held_out", "score", "predicted")

"""Target-distribution importance resampling by an external sort-count of hashed n-grams.

Three steps. ``bucket_streams`` turns every whole text into the buckets of its features (runs of 1 to ``order`` consecutive
words) and writes them to the shared folder as packed uint16 streams, many documents a row, with each document's offset.
``bucket_counts`` reads the streams back: each is sorted (16-bit keys, a radix sort), run-length encoded, and the runs of a task
are merged, so that a task sends one count a bucket at most; Spark adds them up. ``document_weights`` reads the streams once
more: gains are gathered by bucket and summed between the offsets by ``np.add.reduceat``.

A bucket's gain is floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for s of the S features of the documents, t of the T of the
target and B buckets. A document's weight is the floored mean of its features' gains, its score the weight plus Gumbel noise
hashed from (seed, id): the highest scores are a draw without replacement in proportion to exp(weight / 1000).

Ranks: one aggregate counts the rows of each score (scores are whole numbers within some tens of thousands, however many
documents there are), sums from the top say where a score's rows begin and which score the draw ends in, and only rows down to that
score are numbered, score by score. Equal rows are counted before they are numbered, and take ranks side by side.

What reaches the driver: the counts of B buckets (65,536 at most). A text's stream takes 4 bytes a word, beside its own bytes.

Defined cases: null text counts as empty; a document without words has no features, weight 0 and still a score, and is not drawn;
null id hashes as no digits and loses ties; rows of equal id draw equal noise; ties go to the smaller id; an empty target gives gains
from its pseudo-counts alone; empty documents give no rows; other columns are ignored, whatever their names; very long texts are read in
pieces of PIECE bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm._crc_sql import CRC_TABLE, crc_sql
from siltstone.llm.registry import query
from siltstone.session import materialize, scratch, spread, table

BUCKETS, ORDER = 10_000, 2
SEED, PERCENT, MIN_WORDS = 7, 25, 20
#: Features of a row of streams, unless one document has more; bytes of a text looked at at once.
BLOCK, PIECE = 1 << 20, 1 << 20
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces that cut no word (but a word longer than a piece stays whole)."""
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + PIECE) if at + PIECE < len(text) else None
        end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def features(text: bytes, buckets: int, order: int) -> tuple[int, np.ndarray]:
    """How many words the text has, and the buckets of its features, as uint16."""
    n, found, held = 0, [], []
    for piece in _pieces(text.lower()):  # of bytes: A-Z alone
        words = _WORD.findall(piece)
        n += len(words)
        words = held + words
        codes = list(map(crc32, words))
        for k in range(1, order + 1):
            # Runs that lie in what was held were met before.
            found.append(np.array(codes[max(0, len(held) - k + 1) :], np.uint32) % np.uint32(buckets))
            codes = list(map(crc32, words[k:], map(crc32, repeat(b" "), codes)))
        held = words[max(0, len(words) - order + 1) :] if order > 1 else []
    return n, np.concatenate(found).astype("<u2") if found else np.zeros(0, "<u2")


def bucket_streams(docs: DataFrame, doc_id: str | None = "doc_id", text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(ids, words, starts, stream): of many documents each, ids, numbers of words and first places in the packed buckets."""
    if not 1 <= buckets <= 1 << 16:
        raise ValueError("buckets are packed into 16 bits")
    ids = F.col(doc_id) if doc_id else F.lit(None).cast("long")
    docs = docs.select(ids.alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    kind = docs.schema["id"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), *(T.StructField(c, T.BinaryType()) for c in ("words", "starts", "stream"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size, first = [], 0, 0
            for k, t in enumerate(b.column("text"), 1):
                held.append(features(t.as_buffer().to_pybytes(), buckets, order))
                size += len(held[-1][1])
                if size >= BLOCK or k == b.num_rows:
                    ids = b.column("id").slice(first, k - first)
                    ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                    words, streams = zip(*held, strict=True)
                    starts = np.concatenate([[0], np.cumsum([len(s) for s in streams])]).astype("<i8")
                    packed = [np.array(words, "<i8").tobytes(), starts.tobytes(), np.concatenate(streams).tobytes()]
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array([x], pa.binary()) for x in packed)], ["ids", "words", "starts", "stream"])
                    held, size, first = [], 0, k

    return docs.mapInArrow(run, schema)


def written(streams: DataFrame) -> DataFrame:
    """The streams as a table in the shared folder, made once."""
    path = scratch(streams.sparkSession, "streams")
    streams.write.option("compression", "zstd").parquet(path)
    return streams.sparkSession.read.schema(streams.schema).parquet(path)


def run_lengths(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of the stream in order, and how often each occurs: sorted, then run-length encoded."""
    a = np.sort(stream, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    return a[starts], np.diff(starts, append=len(a))


def bucket_counts(streams: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all buckets that occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for s in b.column("stream"):
                values, n = run_lengths(np.frombuffer(s.as_buffer(), "<u2"))
                total[values] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return streams.select("stream").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _collected(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for r in counts.toArrow().to_pylist():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain, from how often it occurs on either side."""
    b, s_all, t_all = len(documents), int(documents.sum()), int(target.sum())
    ratio = (target.astype(np.float64) + 1) * float(s_all + b) / ((documents.astype(np.float64) + 1) * float(t_all + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def document_weights(streams: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document of the streams."""
    kind = streams.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                words, starts, stream = (np.frombuffer(b.column(c)[k].as_buffer(), t) for c, t in (("words", "<i8"), ("starts", "<i8"), ("stream", "<u2")))
                n, weight = np.diff(starts), np.zeros(len(words), np.int64)
                some = n > 0  # reduceat gives one value, not none, for a document without features
                if some.any():
                    weight[some] = np.add.reduceat(gains[stream], starts[:-1][some]) // n[some]
                yield pa.RecordBatch.from_arrays([b.column("ids")[k].values, *map(pa.array, (words, n, weight))], schema.names)

    return streams.mapInArrow(run, schema)


def _noise(seed: int) -> F.Column:
    """floor(-1000 ln(-ln u)) of a number u in (0, 1) hashed from seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    order: int = ORDER,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of docs.

    rank numbers what is drawn, percent of the rows of at least min_words words, best score first; null where not drawn.
    """
    streams = written(bucket_streams(docs, doc_id, text, buckets, order))
    wanted = written(bucket_streams(target, None, target_text, buckets, order))
    gains = bucket_gains(*(_collected(bucket_counts(s, buckets), buckets) for s in (streams, wanted)))
    scored = document_weights(streams, gains).withColumn("score", F.col("weight") + _noise(seed))
    return ranked(materialize(scored, "scored"), percent, min_words)


def ranked(scored: DataFrame, percent: int, min_words: int) -> DataFrame:
    """scored (a written table) with the ranks of what is drawn."""
    may = F.col("n_words") >= min_words
    by_score = scored.where(may).groupBy(F.col("score").alias("_score")).agg(F.count("*").alias("_n"))
    fall, whole = Window.orderBy(F.desc("_score")), Window.partitionBy()  # a row a score
    ends = by_score.select("_score", "_n", F.sum("_n").over(fall).alias("_end"), F.sum("_n").over(whole).alias("_all"))
    starts = ends.select("_score", (F.col("_end") - F.col("_n")).alias("_before"), F.expr(f"(_all * {int(percent)}) div 100").alias("_draw"))
    starts = materialize(starts.where("_before < _draw").select("_score", "_before", "_draw"), "starts")
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    near = scored.where(may).join(starts, F.col("score") == F.col("_score"))
    alike = near.groupBy(*names, "_before", "_draw").agg(F.count("*").alias("_n"))
    along = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_words", "n_features", "weight")
    rank = F.col("_before") + F.sum("_n").over(along) - F.col("_n")  # of the first of equal rows, from 0
    drawn = alike.withColumn("_rank", rank).select(*names, F.explode(F.transform(F.sequence(F.lit(1).cast("long"), F.col("_n")), lambda k: F.when(F.col("_rank") + k <= F.col("_draw"), F.col("_rank") + k))).alias("rank"))
    rest = scored.join(starts, may & (F.col("score") == F.col("_score")), "left_anti").select(*names, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)


def _features_sql(of: str, key: str) -> str:
    """Rows (key, words, f): the features of every text of a table (key, w: its words)."""
    return f"""(SELECT {key}, f FROM {of}, LATERAL (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f))"""


def _words_sql(of: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"(SELECT {key}, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {of})"


@query(
    "op11_resample",
    f"""
    WITH tab AS ({CRC_TABLE}), dw AS MATERIALIZED {_words_sql("documents", "doc_id")}, bw AS {_words_sql("benchmark", "item_id")},
    df AS (SELECT doc_id, f, count(*) AS n FROM {_features_sql("dw", "doc_id")} GROUP BY ALL), bf AS (SELECT f, count(*) AS n FROM {_features_sql("bw", "item_id")} GROUP BY f),
    h AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
    bu AS MATERIALIZED (SELECT f, {crc_sql("h")} % {BUCKETS} AS b FROM h, tab),
    s AS (SELECT b, sum(n) AS s FROM df JOIN bu USING (f) GROUP BY b), t AS (SELECT b, sum(n) AS t FROM bf JOIN bu USING (f) GROUP BY b),
    al AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS sa, (SELECT coalesce(sum(t), 0) FROM t) AS ta),
    g AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sa + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (ta + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (b), al),
    w AS (SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight FROM df JOIN bu USING (f) JOIN g USING (b) GROUP BY doc_id),
    d AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                 ('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT AS h FROM dw LEFT JOIN w USING (doc_id)),
    c AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d),
    r AS (SELECT *, row_number() OVER (ORDER BY n_words < {MIN_WORDS}, score DESC, doc_id) AS k, count(*) FILTER (n_words >= {MIN_WORDS}) OVER () AS n FROM c)
    SELECT doc_id, n_features, weight, score, CASE WHEN k <= {PERCENT} * n // 100 THEN k END AS rank FROM r
    """,
)
def op11_resample(spark, sf):
    """Draws a quarter of all documents towards the words of the benchmark."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return resample(docs, table(spark, sf, "benchmark")).drop("n_words")

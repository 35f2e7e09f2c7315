"""WARC: a deterministic sharded writer and its reader.

Writer: records are ordered by id (then by a hash of payload and url) and cut into shards of about SHARD_BYTES. The cuts
come from exact sums of payload bytes over ranges of ids, refined where a range is heavy, down to a single id and within
it by the hash; so they follow from the rows alone, never from how the input lies in files or from a sample. Each shard is
sorted and written as ``generation-N/part-SHARD-ROLL.warc.gz`` files of gzip members, rolled when ROLL_BYTES of compressed bytes are
reached. A file is built under a temporary name and renamed when whole, so a rerun task replaces its files by equal ones.
The manifest of all files (records, first and last id, bytes, SHA-256) is written as JSON under a temporary
name of its own and renamed last to ``manifest-N``: that rename commits the archive. Readers take the files of the latest
manifest only and verify their sizes and digests. All headers (ids, lengths, block and payload digests) are made anew; dates are a
parameter, ids hash the content, so equal rows give equal bytes, however they are dealt to partitions.

A folder that holds a committed archive is refused before anything is written, unless it is to be replaced: then the next generation
is written beside it, and readers see the old archive until the new manifest has its name, the new one from then on. A run
that died left nothing that a reader looks at, and can be repeated: its generation has no manifest and is removed first. ``sweep`` removes what no reader needs. One writer at a time: a manifest whose name is taken meanwhile is an error, not a merge.

Equal payloads of at least REVISIT_BYTES are stored once: the record of the smallest id is the response, the
others revisit it. Only digests that occur twice or more are joined back to the records.

The archive's folder may be any URI that pyarrow's file systems open on the executors.

Defined cases: null payload counts as empty; null url gives no target header; null id is written without
an id header and sorts first; records that share the smallest id and the payload are all responses;
where all ids of a payload are null all are responses; equal rows are equal records side by side, in one shard; empty
input gives an empty archive; other columns are ignored; a folder without a manifest cannot be read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.registry import query
from siltstone.session import materialize, scratch, table

ROLL_BYTES = 32 << 20
#: Payload bytes of a shard; beyond MAX_SHARDS of them shards grow instead, so that the cuts stay small.
SHARD_BYTES, MAX_SHARDS = 8 << 20, 1 << 14
#: Ranges of ids that one look at the sizes sums up, and brings to the driver.
CELLS = 1 << 16
REVISIT_BYTES = 100
LEVEL = 4
#: So many rows of a manifest may be broadcast.
MOST_BROADCAST = 100_000
DATE = "2025-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_MANIFEST = "file string, records long, first_id long, last_id long, bytes long, sha256 string"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record, uncompressed; a revisit (refers_to is not None) holds no payload."""
    digest = hashlib.sha256(payload).hexdigest()
    block = _HTTP if refers_to is not None else _HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"X-Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzip-member archive; digests are verified."""
    f = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(raw)), 1 << 20)
    while first := f.readline():
        if first != b"WARC/1.1\r\n":
            raise ValueError("not a WARC record")
        head = {}
        while (line := f.readline()) != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        block = f.read(int(head["Content-Length"]))
        if f.read(4) != b"\r\n\r\n" or "sha256:" + hashlib.sha256(block).hexdigest() != head["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {head.get('WARC-Record-ID')}")
        yield head, block


def _file_system(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


_NULL_ID = -(2**63)


def _cuts(sizes: DataFrame, shard_bytes: int) -> tuple[np.ndarray, list[str]]:
    """First id and first key ("" but inside one id) of each shard, in order; sizes: (at long, key string, size long)."""
    total, lo, hi = sizes.agg(F.sum("size"), F.min("at"), F.max("at")).first()
    if total is None:
        return np.array([_NULL_ID]), [""]
    target = max(shard_bytes, total // MAX_SHARDS)
    light: list[tuple[int, str, int]] = []  # (first id, first key, bytes) of ranges that need no further look
    heavy = [(lo, hi)]
    while heavy:
        heavy.sort()
        fan = max(4, CELLS // len(heavy))  # a range is heavier than a shard, so there are no more of them than shards
        cells = sizes.withColumn("c", _cell(F.col("at"), heavy, fan)).where("c >= 0")
        cells = cells.groupBy("c").agg(F.sum("size").alias("size"), F.min("at").alias("lo"), F.max("at").alias("hi")).toArrow().to_pylist()
        heavy, hot = [], []
        for c in cells:
            if c["size"] <= target:
                light.append((c["lo"], "", c["size"]))
            elif c["lo"] < c["hi"]:
                heavy.append((c["lo"], c["hi"]))
            else:
                hot.append(c["lo"])
        if hot:
            digits = 1 if len(hot) > CELLS >> 8 else 2 if len(hot) > CELLS >> 12 else 3  # CELLS sums or so
            keys = sizes.where(F.col("at").isin(hot)).groupBy("at", F.left("key", F.lit(digits)).alias("key")).agg(F.sum("size").alias("size"))
            by = {}
            for c in keys.toArrow().to_pylist():
                by.setdefault(c["at"], []).append((c["at"], c["key"], c["size"]))
            for rows in by.values():
                rows.sort()
                light += [(i, "" if n == 0 else k, size) for n, (i, k, size) in enumerate(rows)]
    light.sort()
    ids, keys, held = [], [], target
    for i, k, size in light:
        if held + size > target:
            ids.append(i)
            keys.append(k)
            held = 0
        held += size
    return np.array(ids), keys


def _cell(at: Column, ranges: list[tuple[int, int]], fan: int) -> Column:
    """Number of the range (of sorted ranges apart) and of the one in fan equal parts of it that holds at; -1: none."""
    lo, hi = (np.array(v, np.int64) for v in zip(*ranges, strict=True))
    wide = (hi - lo).view(np.uint64) // np.uint64(fan) + np.uint64(1)

    @F.pandas_udf("long")
    def cell(at: pd.Series) -> pd.Series:
        x = at.to_numpy(np.int64)
        r = np.maximum(np.searchsorted(lo, x, side="right") - 1, 0)
        c = ((x - lo[r]).view(np.uint64) // wide[r]).astype(np.int64)
        return pd.Series(np.where((x >= lo[r]) & (x <= hi[r]), (r << 20) + c, -1))

    return cell(at)


def _shard(at: Column, key: Column, ids: np.ndarray, keys: list[str]) -> Column:
    """The shard of a record."""

    @F.pandas_udf("int")
    def shard(at: pd.Series, key: pd.Series) -> pd.Series:
        x = at.to_numpy(np.int64)
        out = np.searchsorted(ids, x, side="right") - 1
        first = np.searchsorted(ids, x, side="left")
        for k in np.flatnonzero(out > first):  # an id of several shards
            out[k] = first[k] + bisect.bisect_right(keys, key.iloc[k], int(first[k]), int(out[k]) + 1) - 1
        return pd.Series(np.maximum(out, 0).astype(np.int32))

    return shard(at, key)


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system, as the driver's JVM sees them."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _name(kind: str, generation: int) -> str:
    return f"{kind}-{generation:05d}"


def generations(spark: SparkSession, folder: str) -> list[int]:
    """The committed generations of the archive, in order."""
    path, fs = _hadoop(spark, folder)
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"manifest-(\d+)", n)))


def commit_manifest(spark: SparkSession, folder: str, hidden: str, generation: int) -> None:
    """Give a written manifest its name, which must be free."""
    path, fs = _hadoop(spark, f"{folder}/{hidden}")
    target, _ = _hadoop(spark, f"{folder}/{_name('manifest', generation)}")
    if fs.exists(target) or not fs.rename(path, target):
        raise OSError(f"{folder}: manifest {generation} could not be committed")
    inside, _ = _hadoop(spark, f"{folder}/{_name('manifest', generation)}/{hidden}")
    if fs.exists(inside):  # another writer's manifest came between: a rename onto a folder moves into it
        fs.delete(inside, True)
        raise OSError(f"{folder}: generation {generation} was committed by another writer")


def sweep(spark: SparkSession, folder: str) -> int:
    """Remove what dead runs and older generations left; how many entries went. Not while a writer or an old reader is at work."""
    path, fs = _hadoop(spark, folder)
    last = _committed(spark, folder)
    gone = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName() not in (_name("manifest", last), _name("generation", last))]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def write_warc(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    roll_bytes: int = ROLL_BYTES,
    date: str = DATE,
    shard_bytes: int = SHARD_BYTES,
    replace: bool = False,
) -> DataFrame:
    """Write and commit the archive; returns its manifest. replace: also where the folder holds one, which stays until the commit."""
    spark = pages.sparkSession
    known = generations(spark, folder)
    if known and not replace:
        raise FileExistsError(f"{folder} holds an archive")
    generation = known[-1] + 1 if known else 0
    into = f"{folder}/{_name('generation', generation)}"
    path, fs = _hadoop(spark, into)
    if fs.exists(path):  # what a run left that died before its commit
        fs.delete(path, True)
    _file_system(into)[0].create_dir(_file_system(into)[1], recursive=True)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    at = F.coalesce("page_id", F.lit(_NULL_ID))
    key = F.md5(F.concat_ws(" ", "digest", "url"))
    sizes = materialize(rows.select("page_id", at.alias("at"), key.alias("key"), "digest", F.octet_length("payload").cast("long").alias("size")), "sizes")
    cuts = _cuts(sizes.select("at", "key", "size"), shard_bytes)
    twice = (
        sizes.where((F.col("size") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    )
    # A digest with one id may still have rows without an id, which revisit it: the count is of all rows.
    null_too = sizes.where(F.col("page_id").isNull()).select("digest").distinct().withColumn("nulls", F.lit(True))
    twice = twice.join(null_too, "digest", "left").where("n > 1 or nulls").select("digest", "first_id")
    twice = materialize(twice, "twice")  # its size is known before the planner chooses how to join it
    named = rows.join(twice, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"),
        _shard(at, key, *cuts).alias("shard"),
        at.alias("_at"),
        key.alias("_key"),
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _file_system(into)
        shard, files = -1, 0
        parts: list[bytes] = []
        ids: list[int | None] = []

        def flush() -> pd.DataFrame:
            nonlocal files
            raw, name = b"".join(parts), f"part-{shard:05d}-{files:05d}.warc.gz"
            hidden = f"{base}/.{name}.{uuid.uuid4().hex}.tmp"
            with fs.open_output_stream(hidden) as f:
                f.write(raw)
            fs.move(hidden, f"{base}/{name}")
            made = {"file": [name], "records": [len(ids)], "first_id": [ids[0]], "last_id": [ids[-1]], "bytes": [len(raw)], "sha256": [hashlib.sha256(raw).hexdigest()]}
            files += 1
            parts.clear()
            ids.clear()
            return pd.DataFrame(made)

        size = 0
        for b in batches:
            for at, i, u, p, r in zip(b["shard"].tolist(), b["page_id"], b["url"], b["payload"], b["refers_to"], strict=True):
                if at != shard:
                    if parts:
                        yield flush()
                    shard, files, size = at, 0, 0
                i, r = (None if pd.isna(x) else int(x) for x in (i, r))
                z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = z.compress(record(i, u, p.encode(), r, date)) + z.flush()
                parts.append(member)
                ids.append(i)
                size += len(member)
                if size >= roll_bytes:
                    yield flush()
                    size = 0
        if parts:
            yield flush()

    made = (
        named.withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
        .repartition("shard")
        .sortWithinPartitions("shard", "_at", "_key", "url", "payload")
        .drop("_at", "_key")
        .mapInPandas(run, _MANIFEST)
    )
    hidden = f".manifest-{uuid.uuid4().hex}.tmp"
    made.write.json(f"{folder}/{hidden}")
    commit_manifest(spark, folder, hidden, generation)
    return read_manifest(spark, folder)


def _committed(spark: SparkSession, folder: str) -> int:
    found = generations(spark, folder)
    if not found:
        raise FileNotFoundError(f"{folder} holds no committed archive")
    return found[-1]


def read_manifest(spark: SparkSession, folder: str, generation: int | None = None) -> DataFrame:
    """The files of a committed archive, as of its latest generation or of one given."""
    generation = _committed(spark, folder) if generation is None else generation
    return spark.read.schema(_MANIFEST).json(f"{folder}/{_name('manifest', generation)}")


_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of a committed archive; with_payload adds the stored payload (null for revisits)."""
    generation = _committed(spark, folder)  # one look: a manifest committed from here on is not seen
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(f"{folder}/{_name('generation', generation)}")
    known = read_manifest(spark, folder, generation).select("file", "bytes", "sha256")
    if known.count() <= MOST_BROADCAST:  # else the planner joins them as it sees fit
        known = F.broadcast(known)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(known, "file")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, raw, size, digest in zip(b["file"], b["content"], b["bytes"], b["sha256"], strict=True):
                raw = bytes(raw)
                if len(raw) != size or hashlib.sha256(raw).hexdigest() != digest:
                    raise ValueError(f"{name} is not the file in the manifest")
                rows, held = [], 0
                for head, block in read_records(raw):
                    kind, want = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
                    payload = block.partition(b"\r\n\r\n")[2]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != want:
                        raise ValueError(f"damaged payload in {name}")
                    refers = head.get("X-Refers-To-Page-ID")
                    page = head.get("X-Page-ID")
                    row = (page and int(page), head.get("WARC-Target-URI"), kind, refers and int(refers), int(head["X-Payload-Length"]), want)
                    rows.append((*row, payload if kind == "response" else None) if with_payload else row)
                    held += len(block) * with_payload
                    if held > 16 << 20 or len(rows) >= 10_000:
                        yield _frame(rows, with_payload)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows, with_payload)

    return files.mapInPandas(run, _RECORD + (", payload binary" if with_payload else ""))


def _frame(rows: list[tuple], with_payload: bool) -> pd.DataFrame:
    names = [x.split()[0] for x in _RECORD.split(", ")] + ["payload"] * with_payload
    b = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "refers_to"):
        b[c] = b[c].astype("Int64")
    return b


@query(
    "op9_warc",
    f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT *, CASE WHEN payload_bytes >= {REVISIT_BYTES} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM f
    """,
)
def op9_warc(spark, sf):
    """Writes all pages to an archive in the shared folder and reads it back."""
    folder = scratch(spark, "warc")
    write_warc(table(spark, sf, "pages"), folder)
    return read_warc(spark, folder).drop("url")

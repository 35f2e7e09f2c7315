"""Best-fit packing of tokenised documents into fixed-length sequences.

The packer is online: it sees one piece at a time and never moves one it has placed. The rows it is fed are sorted
longest first, so over a partition the order is best fit decreasing, which costs a sort of small rows and saves sequences.

Two steps. ``token_pieces`` tokenises every whole text where it is read and passes on one small row
for each piece; texts and ids are not shuffled. ``pack`` deals those rows out by hash and feeds each
partition, longest first, to a bounded-space online best-fit packer: a fixed number of open bins, kept
in a bitset keyed by free space (bit f: some open bin has f tokens left). The lowest set bit from the
piece's length on is the best fit; when too many bins are open the fullest, the lowest set bit of all,
closes first. A partition holds the open bins alone, never its rows. What partitions leave at most half full is packed once more.

Tokenising: the vocabulary's pre-tokeniser never lets a token cross white space, so ids are looked up
by white-space word in a bounded dictionary of words already encoded. Texts with U+001C..U+001F, where
Python and the tokenizer differ on what white space is, are encoded whole.

Defined cases: null text counts as empty and still gives its end id; rows with equal ids are packed
each for itself; ties in length go by id, piece, start; null ids are kept; other columns are ignored, whatever their
names; empty input gives no rows.
Shuffled rows are sorted by a total order before packing, so a task that is run again after the loss
of an executor makes the same sequences.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.registry import query
from siltstone.session import materialize, spread, table

CAPACITY = 2048
OPEN_BINS = 1 << 16
_CACHED = 600_000
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def default_vocabulary() -> str:
    """The public word-level BPE vocabulary; its path is a parameter everywhere."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder(dict):
    """Ids of whole texts as little-endian uint32 bytes; itself the bounded dictionary of white-space words.

    A new word of printable ASCII and Latin letters is normalised and split here, as the vocabulary's own
    normaliser and pre-tokeniser would, and only runs not met before go to its merges. All other words
    pass the whole tokenizer.
    """

    _plain = regex.compile(r"[\x21-\x7E\u00C0-\u024F]+")
    _runs = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer, self.runs = Tokenizer.from_file(path), {}
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # All that lower() makes of the plain class: some of its letters have their small form far from it.
        letters = {x for c in range(0xC0, 0x250) for x in chr(c).lower()} - set(map(chr, range(128)))
        self.as_bytes = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in letters}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _CACHED:
            self.clear()
        if "<|" in word or not self._plain.fullmatch(word):
            found = self.whole(word)
        else:
            found = b"".join([self.runs.get(r) or self._run(r) for r in self._runs.findall(word.lower())])
        self[word] = found
        return found

    def _run(self, run: str) -> bytes:
        if len(self.runs) >= _CACHED:
            self.runs.clear()
        tokens = self.tokenizer.model.tokenize(run if run.isascii() else run.translate(self.as_bytes))
        self.runs[run] = found = np.asarray([t.id for t in tokens], "<u4").tobytes()
        return found

    def __call__(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


class BestFit:
    """Bounded-space online best fit over bins of one capacity; put() returns (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.free, self.bins, self.open, self.made = 0, [[] for _ in range(capacity + 1)], 0, 0

    def put(self, length: int) -> tuple[int, int]:
        """Place a piece of 1..capacity tokens."""
        fits = self.free >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            b = self._take(f)
        else:
            f, b = self.capacity, self.made
            self.made += 1
        if left := f - length:
            self.bins[left].append(b)
            self.free |= 1 << left
            self.open += 1
            if self.open > self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
        return b, self.capacity - f

    def _take(self, f: int) -> int:
        b = self.bins[f].pop()
        self.open -= 1
        if not self.bins[f]:
            self.free ^= 1 << f
        return b


_PIECES = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", end_id: int = 0
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut only where over capacity."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(n, t) for n, t in _PIECES]])
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = WordEncoder(vocabulary)
        for b in batches:
            rows = []
            for k, t in enumerate(b["text"]):
                ids = memoryview(encode(t) + end)
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    rows.append((k, p, at // 4, len(cut) // 4, zlib.crc32(cut)))
            a = np.array(rows, np.int64).reshape(-1, 5)
            yield pd.DataFrame(
                {"doc_id": b["doc_id"].to_numpy()[a[:, 0]], "piece": a[:, 1].astype(np.int32), "start": a[:, 2], "length": a[:, 3], "ids_crc32": a[:, 4]}
            )

    return docs.mapInPandas(run, schema)


def _packed(rows: DataFrame, capacity: int, open_bins: int, order: list) -> DataFrame:
    """rows (with length), as they lie in partitions and in the order given, each with bin and at."""
    schema = T.StructType([*rows.schema.fields, T.StructField("bin", T.LongType()), T.StructField("at", T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base, packer = TaskContext.get().partitionId() << 40, BestFit(capacity, open_bins)
        for b in batches:
            placed = np.array([packer.put(n) for n in b["length"].tolist()], np.int64).reshape(-1, 2)
            yield b.assign(bin=base + placed[:, 0], at=placed[:, 1])

    return rows.sortWithinPartitions(*order).mapInPandas(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """pieces (doc_id, piece, start, length, ...) with sequence_id and offset.

    Two rounds. Pieces are packed side by side, partition by partition. Best fit leaves at most one bin at most half full to a
    partition while its bins stay open, so what partitions leave is a row each; those rows are packed once more, each as one piece, and
    the pieces inside move along. So how many sequences there are hardly follows how many partitions packed.
    """
    order = [F.desc("length"), "doc_id", "piece", "start", "ids_crc32"]
    first = materialize(_packed(pieces.repartition(F.xxhash64("doc_id", "piece", "start")), capacity, open_bins, order), "packed")
    half = first.groupBy("bin").agg(F.sum("length").alias("length")).where(F.col("length") <= capacity // 2).withColumnRenamed("bin", "from")
    moved = materialize(_packed(half.repartition(1), capacity, open_bins, [F.desc("length"), "from"]), "moved")
    # A merged sequence goes by its first bin's number.
    names = moved.where("at = 0").select("bin", F.col("from").alias("name"))
    moved = moved.join(names, "bin").select("from", "name", F.col("at").alias("shift"))
    if open_bins >= OPEN_BINS:
        moved = F.broadcast(moved)  # a row a partition, as long as no bin had to close
    out = first.join(moved, F.col("bin") == F.col("from"), "left")
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    return out.select(*kept, F.coalesce("name", "bin").alias("sequence_id"), (F.col("at") + F.coalesce("shift", F.lit(0))).alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """Tokenise and pack whole documents."""
    return pack(token_pieces(docs, vocabulary or default_vocabulary(), capacity, **columns), capacity)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf):
    """Packs all documents into sequences of at most 2048 tokens."""
    return pack_documents(spread(table(spark, sf, "documents").select("doc_id", "text")))

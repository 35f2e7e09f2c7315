import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm.packing import BestFit, WordEncoder, default_vocabulary, pack, pack_documents, token_pieces
from tests.llm.cases import DOCS, awkward


def test_pieces_and_sequences(spark):
    rows = awkward()
    tok = Tokenizer.from_file(default_vocabulary())
    want = defaultdict(list)
    for i, t, *_ in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, at in enumerate(range(0, len(ids), 256)):
            cut = ids[at : at + 256]
            want[i, p].append((at, len(cut), zlib.crc32(cut.tobytes())))
    out = pack_documents(spark.createDataFrame(rows, DOCS), capacity=256).collect()
    got, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        got[r.doc_id, r.piece].append((r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for s in sequences.values():
        end = 0
        for at, n in sorted(s):
            assert at == end
            end += n
        assert end <= 256
    total = sum(r.length for r in out)
    assert len(sequences) <= total / 256 * 1.05 + 2
    assert pack_documents(spark.createDataFrame([], DOCS)).count() == 0


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet="aA zZ\t\n'sßéÉİ.,<|>_9²\x1c\x85 中́Σ", max_size=24))
def test_word_encoder_is_the_tokenizer(text):
    global _E
    try:
        e = _E
    except NameError:
        e = _E = WordEncoder(default_vocabulary())
    assert e(text) == e.whole(text)


def test_every_code_point_alone_and_in_words():
    e = WordEncoder(default_vocabulary())
    for c in map(chr, range(0x3000)):
        for text in (c, f"x{c}y", f"{c}'s {c}{c} Q{c}1"):
            assert e(text) == e.whole(text), (hex(ord(c)), text)


def test_few_open_bins_and_clashing_columns(spark):
    """With three open bins every piece still has its place, and no bin is used after it has closed."""
    rng = np.random.default_rng(2)
    rows = [(k % 50, " ".join(["word"] * int(n)), "x", 1) for k, n in enumerate(rng.integers(0, 70, 400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string, sequence_id int")
    pieces = token_pieces(docs, default_vocabulary(), 64)
    out = pack(pieces, 64, open_bins=3).collect()
    assert sorted(pieces.columns) == ["doc_id", "ids_crc32", "length", "piece", "start"] and len(out) >= len(rows)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        ends = [at + n for at, n in sorted(b)]
        assert [at for at, _ in sorted(b)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert len(bins) > len({r.sequence_id for r in pack(pieces, 64).collect()})


def test_partitions_hardly_change_the_number_of_sequences(spark):
    rng = np.random.default_rng(3)
    rows = [(k, 0, 0, int(n), 0) for k, n in enumerate(rng.integers(1, 100, 300))]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    made, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    for n in (1, 3, 24):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = pack(pieces, 128).collect()
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        bins = defaultdict(list)
        for r in out:
            bins[r.sequence_id].append((r.offset, r.length))
        for b in bins.values():
            ends = [at + k for at, k in sorted(b)]
            assert [at for at, _ in sorted(b)] == [0, *ends[:-1]] and ends[-1] <= 128
        assert len(out) == 300
        made.append(len(bins))
        half = [b for b in bins.values() if sum(k for _, k in b) <= 64]
        assert len(half) <= 1
    assert made[2] <= made[0] * 1.12


def test_best_fit_bounded():
    b = BestFit(10, 2)
    assert b.put(6) == (0, 0) and b.put(7) == (1, 0) and b.put(3) == (1, 7)
    assert b.put(5) == (2, 0)
    assert b.put(8) == (3, 0)  # three are open now: the fullest, 3, closes
    assert b.put(2)[0] != 3

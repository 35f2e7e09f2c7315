"""Joins by containment of one text in another, through an index of rare grams.

A text lies in another one only if each of its grams does, so it is looked up by the one of them that the other side holds least
often. Where that gram lies in either text says where the shorter would have to start: pairs for which it would not fit are dropped.
Only ids and places are joined; texts come back by id, once a pair of ids, and are compared.

While the shorter texts, each counted once, have no more than MOST_BROADCAST characters, they go to where the longer texts are read, and
one pass of an automaton over each of these finds all that lie in it: there is nothing to choose, to join or to compare then.
Else, while they have no more than MOST_BROADCAST grams, these go there, and each text's grams are looked up by a rolling hash: once to
count, once to find the places of those that were chosen (a hash that two grams share costs candidates, not results). Beyond, all places
of the longer texts are cut in the JVM and joined by shuffles.

Grams that hold more than one in HOT of all places of the long side (HOT of them at most, so their table is broadcast) are dealt out:
their places to as many salts as their share asks for, and the texts that are looked up by them to all of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.session import materialize, spread

GRAM = 4
#: Characters of a text whose grams are cut at once, so that a gram costs the same wherever it lies.
PIECE = 256
#: Grams, or characters, of the shorter side that may be broadcast, some 40 bytes each (100 in an automaton).
MOST_BROADCAST = 500_000
#: Rows that a task collects before it passes them on.
MOST_ROWS = 1 << 16
#: Grams of a larger share than one in so many are hot.
HOT = 4096


def _windows(text: Column, gram: int) -> Column:
    """array<struct<piece, tail, before>>: the text in pieces of PIECE characters, each with what follows it, in one pass."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    after = F.concat(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), F.array(F.lit("")))
    return F.transform(F.arrays_zip(pieces.alias("piece"), after.alias("next")), lambda x, k: F.struct(x["piece"].alias("piece"), F.left(x["next"], F.lit(gram)).alias("tail"), (k * PIECE).alias("before")))


def gram_places(texts: DataFrame, sizes: Column, gram: int) -> DataFrame:
    """(id, chars, n, gram, at): every place, from 1, of every gram of the sizes (array<int>, gram at most); of size 0, one at each text's start."""
    cut = texts.select("id", F.length("text").alias("chars"), sizes.alias("sizes"), F.inline(_windows(F.col("text"), gram)))
    cut = cut.select("id", "chars", "before", F.concat("piece", "tail").alias("both"), F.length("piece").alias("own"), F.explode(F.array_remove("sizes", 0)).alias("n"))
    last = F.least(F.length("both") - F.col("n") + 1, F.col("own"))
    each = cut.where(last >= 1).select("id", "chars", "before", "both", "n", F.explode(F.sequence(F.lit(1), last)).alias("i"))
    some = each.select("id", "chars", "n", F.substr("both", F.col("i"), F.col("n")).alias("gram"), (F.col("before") + F.col("i")).alias("at"))
    none = texts.where(F.array_contains(sizes, 0)).select("id", F.length("text").alias("chars"), F.lit(0).alias("n"), F.lit("").alias("gram"), F.lit(1).alias("at"))
    return some.unionByName(none)


def _hashes(text: str, n: int) -> np.ndarray:
    """A hash of each run of n characters, in order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(points) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(points) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += points[k : len(points) - n + 1 + k] + np.uint64(0x1234567)
    return out ^ (out >> np.uint64(29))


class _Asked:
    """Grams that are looked for, by size: sorted hashes and, for each, which gram has it."""

    def __init__(self, grams: list[tuple[int, str]]):
        self.grams, self.by_size = grams, {}
        for n in sorted({n for n, _ in grams if n}):
            which = np.array([k for k, g in enumerate(grams) if g[0] == n])
            h = np.array([_hashes(grams[k][1], n)[0] for k in which], np.uint64)
            order = np.argsort(h, kind="stable")
            self.by_size[n] = h[order], which[order]
        self.empty = next((k for k, g in enumerate(grams) if g[0] == 0), None)

    def columns(self, which: np.ndarray) -> list[pa.Array]:
        """Sizes and texts of some grams."""
        return [pa.array([self.grams[k][0] for k in which], pa.int32()), pa.array([self.grams[k][1] for k in which], pa.string())]

    def places(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(which gram, place from 1) of all that occur; a hash that several grams have counts for each."""
        found = [(np.array([self.empty]), np.array([1]))] if self.empty is not None else []
        for n, (h, which) in self.by_size.items():
            own = _hashes(text, n)
            lo = np.searchsorted(h, own)
            at = np.flatnonzero((lo < len(h)) & (h[np.minimum(lo, len(h) - 1)] == own))
            while len(at):
                found.append((which[lo[at]], at + 1))
                lo[at] += 1
                at = at[(lo[at] < len(h)) & (h[np.minimum(lo[at], len(h) - 1)] == own[at])]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _asked(grams: DataFrame) -> _Asked | None:
    """Written (n, gram), if they are few enough to be sent to all tasks."""
    return _Asked([tuple(r) for r in grams.select("n", "gram").collect()]) if grams.count() <= MOST_BROADCAST else None


def _counted(long: DataFrame, asked: _Asked) -> DataFrame:
    """(n, gram, many): how often each of the grams occurs in the texts; a row a gram and task at most is shuffled."""
    sent = long.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = sent.value
        total = np.zeros(len(a.grams), np.int64)
        for b in batches:
            for t in b.column("text"):
                np.add.at(total, a.places(t.as_py())[0], 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([*a.columns(some), pa.array(total[some])], ["n", "gram", "many"])

    return long.select("text").mapInArrow(run, "n int, gram string, many long").groupBy("n", "gram").agg(F.sum("many").alias("many"))


def _found(long: DataFrame, asked: _Asked) -> DataFrame:
    """(id, chars, n, gram, at): the places of the grams in the texts."""
    sent = long.sparkSession.sparkContext.broadcast(asked)
    kind = long.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = sent.value
        for b in batches:
            for k, t in enumerate(b.column("text")):
                text = t.as_py()
                which, at = a.places(text)
                if len(which):
                    same = pa.array(np.full(len(at), k))
                    yield pa.RecordBatch.from_arrays([b.column("id").take(same), pa.array(np.full(len(at), len(text), np.int32)), *a.columns(which), pa.array(at.astype(np.int32))], ["id", "chars", "n", "gram", "at"])

    return long.select("id", "text").mapInArrow(run, f"id {kind}, chars int, n int, gram string, at int")


def rarest_grams(short: DataFrame, long: DataFrame, gram: int) -> DataFrame:
    """(id, chars, n, gram, at, many) of the gram of each text of short that occurs least often in long; none where one does not occur.

    A text shorter than gram is its own gram.
    """
    own = materialize(gram_places(short, F.array(F.least(F.length("text"), F.lit(gram))), gram), "own")
    grams = materialize(own.select("n", "gram").distinct(), "asked")
    asked = _asked(grams)
    counts = _counted(long, asked) if asked else all_places(short, long, gram).join(grams, ["n", "gram"], "left_semi").groupBy("n", "gram").agg(F.count("*").alias("many"))
    counted = own.join(counts, ["n", "gram"], "left").select("id", "chars", F.struct(F.coalesce("many", F.lit(0)).alias("many"), "gram", "at", "n").alias("g"))
    return counted.groupBy("id", "chars").agg(F.min("g").alias("g")).select("id", "chars", "g.*").where("many > 0")


def all_places(short: DataFrame, long: DataFrame, gram: int) -> DataFrame:
    """Places of all grams of long of the sizes that texts of short are looked up by."""
    sizes = [r[0] for r in short.select(F.least(F.length("text"), F.lit(gram)).alias("n")).distinct().collect()]  # gram + 1 at most
    return gram_places(long, F.array(*map(F.lit, sorted(sizes))).cast("array<int>"), gram)


def candidates(short: DataFrame, long: DataFrame, gram: int = GRAM) -> DataFrame:
    """(short_id, long_id): pairs that share the short text's rarest gram, at a place where it would fit."""
    chosen = materialize(rarest_grams(short, long, gram), "grams")
    asked = _asked(chosen.select("n", "gram").distinct())
    places = _found(long, asked) if asked else all_places(short, long, gram)
    total = max(1, long.agg(F.sum(F.length("text"))).first()[0] or 0)
    share = F.ceil(F.col("many") * HOT / total).cast("int")
    hot = chosen.where((F.col("many") * HOT > total) & (F.col("n") > 0)).select("n", "gram", share.alias("salts")).distinct()  # HOT of a size at most
    salts = F.coalesce("salts", F.when(F.col("n") == 0, HOT).otherwise(1))
    left = chosen.join(F.broadcast(hot), ["n", "gram"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    right = places.join(F.broadcast(hot), ["n", "gram"], "left").withColumn("salt", F.pmod(F.xxhash64("id"), salts).cast("int"))
    left = left.select("n", "gram", "salt", F.col("id").alias("short_id"), F.col("chars").alias("short_chars"), F.col("at").alias("into"))
    right = right.select("n", "gram", "salt", F.col("id").alias("long_id"), F.col("chars").alias("long_chars"), "at")
    start = F.col("at") - F.col("into") + 1
    fits = (start >= 1) & (start + F.col("short_chars") - 1 <= F.col("long_chars"))
    return right.join(left, ["n", "gram", "salt"]).where(fits).select("short_id", "long_id").distinct()


class _Sought:
    """Texts that are looked for, by number; each worker makes the automaton once."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers

    def __getstate__(self) -> dict:
        return {"numbers": self.numbers}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for t, k in self.numbers.items():
            if t:
                made.add_word(t, k)
        made.make_automaton()
        return made

    def held(self, text: str) -> set[int]:
        """Numbers of the texts that lie in a text."""
        found = {k for _, k in self.automaton.iter(text)} if len(self.automaton) else set()
        return found | {self.numbers[""]} if "" in self.numbers else found


def _held(long: DataFrame, sought: _Sought) -> DataFrame:
    """(number, long_id): which of the texts that are looked for lie in which texts."""
    sent = long.sparkSession.sparkContext.broadcast(sought)
    kind = long.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        for b in batches:
            numbers, rows = [], []
            for k, t in enumerate(b.column("text")):
                found = s.held(t.as_py())
                numbers.extend(found)
                rows.extend([k] * len(found))
                if len(rows) > MOST_ROWS or k + 1 == len(b):
                    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), b.column("id").take(pa.array(rows, pa.int64()))], ["number", "long_id"])
                    numbers, rows = [], []

    return long.select("id", "text").mapInArrow(run, f"number long, long_id {kind}")


def contained_pairs(short: DataFrame, long: DataFrame, gram: int = GRAM) -> DataFrame:
    """(short_id, long_id) where long's text contains short's.

    Both sides: (id, text), each id once. An empty text lies in all, a null one in none and holds none.
    """
    short, long = (spread(d.select("id", "text").where("text IS NOT NULL")) for d in (short, long))
    texts = materialize(short.select("text").distinct().withColumn("number", F.monotonically_increasing_id()), "texts")
    if (texts.agg(F.sum(F.length("text"))).first()[0] or 0) <= MOST_BROADCAST:
        numbers = materialize(short.join(texts, "text").select("number", F.col("id").alias("short_id")), "numbers")
        return _held(long, _Sought({t: k for t, k in texts.collect()})).join(numbers, "number").select("short_id", "long_id")
    found = candidates(short, long, gram)
    a = short.select(F.col("id").alias("short_id"), F.col("text").alias("short_text"))
    b = long.select(F.col("id").alias("long_id"), F.col("text").alias("long_text"))
    return found.join(a, "short_id").join(b, "long_id").where(F.contains("long_text", "short_text")).select("short_id", "long_id")

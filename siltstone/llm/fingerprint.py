"""Document fingerprints: threshold-scaled sketches of shingle hashes [DataFrame operations only].

A sketch retains every shingle hash under a fixed FRACTION of the hash range, whatever the text's length, so its size
follows the text's: the sketch of a union is the union of the sketches (``merge``), and of two texts of very unequal
length each one's containment in the other can be told from the retained hashes alone. Shingles are five words
(runs of anything but space and U+0009..U+000D, A-Z lower-cased); a text of one to four words is one shingle, an empty
one none. A hash is the first 12 hex digits of the md5 of a shingle's words, joined by spaces: FRACTION is a power of
1/16 times a whole number, so that a first digit decides.

Short texts retain few hashes, perhaps none. A sketch therefore also has a digest of the text's words in order (12
digits of their md5; "" for no word), which tells equal texts; a merged sketch has none (null). Likeness is 1 for equal digests, else 0 where a text is empty or nothing is retained on either side, else the share of
retained hashes that both have. As a string: digest, ":", the sorted hashes.

Neighbours in the order of ids are found without a global sort in one task: rows are dealt into ranges of ids, each looks
back by a window of its own, and the last rows of the ranges link them. An id that fills a range or more is dealt once
more, by the digits of its texts' md5. Texts are exchanged once, with their sketches.

Defined cases: null text counts as empty; equal texts have equal fingerprints; two empty texts have a likeness of 1, an
empty and another of 0; rows of equal ids are neighbours, in the order of their texts' md5; equal rows are
neighbours of each other; a null id comes last in descending order; a document alone is its own next; empty input
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.registry import query
from siltstone.session import materialize, table

WORDS = 5
#: Retained: hashes whose first hex digit is under this, so a quarter of all.
FIRST = "4"
#: Hex digits of a hash: 48 bits, an even number of digits.
DIGITS = 12
SKETCH = "struct<digest:string,hashes:array<string>>"


def words(text: Column) -> Column:
    """array<string>: the lower-cased words."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def retained(w: Column) -> Column:
    """array<string> of the retained hashes, sorted, of a column of words (a plain column: it is read at every shingle)."""
    many = F.transform(F.slice(w, 1, F.size(w) - (WORDS - 1)), lambda x, i: F.md5(F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, WORDS)])))
    one = F.array(F.md5(F.array_join(w, " ")))
    low = lambda hashes: F.transform(F.filter(hashes, lambda h: h < FIRST), lambda h: F.left(h, F.lit(DIGITS)))
    return F.array_sort(F.array_distinct(F.when(F.size(w) >= WORDS, low(many)).when(F.size(w) > 0, low(one)).otherwise(F.array().cast("array<string>"))))


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with struct<digest string, hashes array<string>>: the sketch of a text column."""
    kept = df.columns
    a = df.select(*kept, words(F.col(text)).alias("_w"))
    digest = F.when(F.size("_w") > 0, F.left(F.md5(F.array_join("_w", " ")), F.lit(DIGITS))).otherwise("")
    return a.select(*kept, F.struct(digest.alias("digest"), retained(F.col("_w")).alias("hashes")).alias(out))


def packed(sketch: Column) -> Column:
    """The sketch with its hashes as one binary, half a byte a digit, to travel."""
    return F.struct(sketch["digest"].alias("digest"), F.unhex(F.array_join(sketch["hashes"], "")).alias("hashes"))


def unpacked(sketch: Column) -> Column:
    """A packed sketch as it was."""
    # One expression over the whole: within a lambda the digits would be made anew for every hash.
    each = F.regexp_extract_all(F.lower(F.hex(sketch["hashes"])), F.lit(f".{{{DIGITS}}}"), F.lit(0))
    return F.struct(sketch["digest"].alias("digest"), each.alias("hashes"))


def merge(a: Column, b: Column) -> Column:
    """The sketch of both texts' shingles together."""
    return F.struct(F.lit(None).cast("string").alias("digest"), F.array_sort(F.array_union(a["hashes"], b["hashes"])).alias("hashes"))


def to_string(sketch: Column) -> Column:
    """The sketch as a string."""
    return F.concat(F.coalesce(sketch["digest"], F.lit("")), F.lit(":"), F.array_join(sketch["hashes"], ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches, 0 to 1."""
    both = F.size(F.array_intersect(a["hashes"], b["hashes"]))
    either = F.size(a["hashes"]) + F.size(b["hashes"]) - both
    return F.when(F.coalesce(a["digest"] == b["digest"], F.lit(False)), 1.0).when(either == 0, 0.0).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has too; null where nothing of a is retained."""
    return F.when(F.size(a["hashes"]) > 0, F.size(F.array_intersect(a["hashes"], b["hashes"])) / F.size(a["hashes"]))


def _longs(values: list[int]) -> Column:
    """An array literal, folded to one constant however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def part_of(c: Column, splits: list[int]) -> Column:
    """How many of the sorted splits are under c: a search in two levels of about sqrt(len(splits)) steps."""
    m = max(1, int(len(splits) ** 0.5))
    upper = F.size(F.filter(_longs(splits[m - 1 :: m]), lambda s: s < c))
    return upper * m + F.size(F.filter(F.slice(_longs(splits), upper * m + 1, m), lambda s: s < c))


def with_next(docs: DataFrame) -> DataFrame:
    """(id, text, sketch, next_text, next_sketch) of docs (id, text): packed sketches, the next being the neighbour below in the order of ids, and for the lowest the highest.

    Rows are dealt into ranges of ids, cut at quantiles, four to a shuffle partition; each range looks back within
    itself. The last row of each range, found by ids alone, links it to the next.
    """
    spark = docs.sparkSession
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(docs.agg(F.percentile_approx("id", [k / wanted for k in range(1, wanted)], 20 * wanted)).first()[0] or [])
    splits = sorted(set(cuts))
    hot = sorted({a for a, b in zip(cuts, cuts[1:], strict=False) if a == b})  # ids that fill a range: the last of theirs
    nulls = docs.where("id IS NULL").limit(wanted).count() == wanted
    mark = F.md5("text")
    dealt = F.when(F.array_contains(_longs(hot), F.col("id")), F.concat(F.lit("1"), F.left(mark, F.lit(2)))).otherwise("0")
    if nulls:
        dealt = F.when(F.col("id").isNull(), F.concat(F.lit(" "), F.left(mark, F.lit(2)))).otherwise(dealt)
    docs = docs.select("id", "text", mark.alias("mark"), F.coalesce(part_of(F.col("id"), splits), F.lit(0)).alias("part"), dealt.alias("sub"))
    sketched = lambda df: with_sketch(df, "text", "sketch").withColumn("sketch", packed(F.col("sketch")))
    me = F.struct("id", "mark")
    line = Window.orderBy("part", "sub")  # a row for each range
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = docs.groupBy("part", "sub").agg(F.max(me).alias("end"))
    ends = ends.select("part", "sub", F.coalesce(F.lag("end").over(line), F.last("end").over(whole)).alias("before"))
    ends = materialize(ends.select("part", "sub", "before.id", "before.mark"), "ends")
    given = docs.select(F.col("id").alias("g_id"), F.col("mark").alias("g_mark"), "text")
    before = given.join(F.broadcast(ends), F.col("g_id").eqNullSafe(F.col("id")) & (F.col("g_mark") == F.col("mark")))
    before = sketched(before.groupBy("part", "sub").agg(F.first("text").alias("text"))).select("part", "sub", F.struct("text", "sketch").alias("before"))
    inside = Window.partitionBy("part", "sub").orderBy(F.col("id").asc_nulls_first(), "mark")
    return (
        sketched(docs)
        .withColumn("below", F.lag(F.struct("text", "sketch")).over(inside))
        .join(before, ["part", "sub"], "left")
        .withColumn("below", F.coalesce("below", "before"))
        .select("id", "text", "sketch", F.col("below.text").alias("next_text"), F.col("below.sketch").alias("next_sketch"))
    )


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_chars, edited (its last third replaced from the next document), both sketches and likenesses.

    Columns: doc_id, n_chars, edited, sketch, edited_sketch, near_edited, near_next.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    both = with_next(docs).select(
        "id",
        n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)).alias("edited"),
        unpacked(F.col("sketch")).alias("sketch"),
        unpacked(F.col("next_sketch")).alias("next_sketch"),
    )
    return with_sketch(both, "edited", "edited_sketch").select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited",
        "sketch",
        "edited_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def _sql_sketch(source: str, text: str, out: str) -> str:
    """SELECT of a source's columns with the sketch's two parts, for DuckDB."""
    lower = f"translate({text}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""SELECT * EXCLUDE (w), CASE WHEN len(w) > 0 THEN left(md5(array_to_string(w, ' ')), {DIGITS}) ELSE '' END AS {out}_digest,
        list_sort(list_distinct(list_transform(list_filter(
            CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: md5(array_to_string(list_slice(w, i, i + {WORDS - 1}), ' ')))
                 WHEN len(w) > 0 THEN [md5(array_to_string(w, ' '))] ELSE [] END, lambda x: x < '{FIRST}'), lambda x: left(x, {DIGITS})))) AS {out}_hashes
    FROM (SELECT *, list_filter(regexp_split_to_array({lower}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {source})"""


def _sql_likeness(a: str, b: str) -> str:
    both = f"len(list_intersect({a}_hashes, {b}_hashes))"
    either = f"(len({a}_hashes) + len({b}_hashes) - {both})"
    return f"CASE WHEN {a}_digest = {b}_digest THEN 1.0 WHEN {either} = 0 THEN 0.0 ELSE {both} / {either} END::DOUBLE"


@query(
    "op10_fingerprints",
    f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    a AS ({_sql_sketch("d", "text", "own")}),
    l AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(text)) AS k, count(*) OVER () AS n, * FROM a),
    p AS (SELECT x.doc_id, length(x.text)::BIGINT AS n_chars, x.own_digest, x.own_hashes, y.own_digest AS next_digest, y.own_hashes AS next_hashes,
                 left(x.text, length(x.text) - length(x.text) // 3) || left(y.text, length(x.text) // 3) AS edited
          FROM l x JOIN l y ON y.k = CASE WHEN x.k = 1 THEN x.n ELSE x.k - 1 END),
    e AS ({_sql_sketch("p", "edited", "edited")})
    SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, own_digest || ':' || array_to_string(own_hashes, '') AS fingerprint,
           edited_digest || ':' || array_to_string(edited_hashes, '') AS edited_fingerprint,
           {_sql_likeness("own", "edited")} AS near_edited, {_sql_likeness("own", "next")} AS near_next
    FROM e
    """,
)
def op10_fingerprints(spark, sf):
    """Fingerprints all documents and their edited texts, and compares them."""
    out = compare_edited(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        to_string(F.col("sketch")).alias("fingerprint"),
        to_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )

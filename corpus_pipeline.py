"""The corpus pipeline: STAGES over documents, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of
documents; the last returns the packed pieces. Of a group of near duplicates the smallest id stays; rows of one id are
judged each by its own text, so that of equal ids those stay whose text belongs to a group of that smallest id.

Defined cases: null text counts as empty everywhere, and empty texts are near duplicates of nothing; a null id never names
a group that has another, and is smaller than all for repeated substrings; repeated rows are rows of their own; long
texts are taken whole; further columns pass through all stages but the last, whatever their names; an empty table gives
an empty table of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.jaccard_join import jaccard_components, text_mark
from siltstone.llm.marks import marker
from siltstone.llm.mixing import mix_sources
from siltstone.llm.packing import pack_documents
from siltstone.llm.quality import classify, train
from siltstone.llm.suffix_dedup import dedup_substrings
from siltstone.session import materialize, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of four folds in five."""
    scorer = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, scorer).where("predicted = 1").select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of the Jaccard join."""
    found = jaccard_components(docs).select("doc_id", "component_id", "mark")
    gone = materialize(found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "mark").distinct(), "gone")
    may_go = marker(gone, "doc_id", "mark")
    named = docs.withColumn("_mark", text_mark("text"))
    named = named.withColumn("_may_go", may_go("doc_id", "_mark")).select(*docs.columns, "_mark", "_may_go")
    # Most documents stay without a join; only those that a mark meets are looked up.
    stay = named.where("not _may_go").select(*docs.columns)
    asked = named.where("_may_go").alias("d")
    kept = asked.join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d._mark") == F.col("g.mark")), "left_anti")
    return stay.unionByName(kept.select(*docs.columns))


def cut_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that one of a smaller id also has; a character cut in two goes."""
    out = dedup_substrings(docs, result="text")
    return out.select(*[F.length("kept").cast("long").alias("n_chars") if c == "n_chars" else F.col("kept").alias("text") if c == "text" else c for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources have the same share of characters, in a global random order."""
    return mix_sources(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_duplicates),
    ("suffix-array dedup", cut_repeated_substrings),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]
#: A trained classifier is not SQL: tests/llm/test_pipeline.py holds the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}")
    return docs

"""Marks: a bitmap that says which rows may match a set of keys, sized by their number within stated bounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and the least and most of a bitmap; beyond it more rows meet a mark by chance, and results stay the same.
PER_KEY, LEAST, MOST = 16, 1 << 20, 1 << 28
#: Bits of one part of the bitmap; a part is a row on its way to the driver.
PART = 1 << 17


def marker(keys: DataFrame, *columns: str):
    """A function from columns to a boolean column: false only for rows whose key is none of keys.

    Keys are counted (approximately) and summed up where they are; bits / PART rows of PART / 8 bytes at most reach the
    driver, and the bitmap (MOST / 8 bytes, 32 MB, at most) is broadcast. Rows without a match need no join; rows that meet
    a mark by chance must be told apart afterwards.
    """
    n = keys.agg(F.approx_count_distinct(F.xxhash64(*columns))).first()[0]
    bits = min(MOST, max(LEAST, 1 << (PER_KEY * n - 1).bit_length()))
    place = lambda *c: F.pmod(F.xxhash64(*c), F.lit(bits))
    words = keys.select(place(*columns).alias("m")).groupBy(F.expr("m div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(m % 64 as int)))").alias("bits"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(PART // 64, np.int64)
        part[pdf["w"].to_numpy() % (PART // 64)] = pdf["bits"]
        return pd.DataFrame({"part": [pdf["w"].iloc[0] // (PART // 64)], "raw": [part.tobytes()]})

    parts = words.groupBy(F.expr(f"w div {PART // 64}").alias("p")).applyInPandas(join, "part long, raw binary")
    marks = np.zeros(bits // 8, np.uint8)
    for part, raw in parts.collect():
        marks[part * (PART // 8) : (part + 1) * (PART // 8)] = np.frombuffer(raw, np.uint8)
    sent = keys.sparkSession.sparkContext.broadcast(marks)

    @F.pandas_udf("boolean")
    def marked(m: pd.Series) -> pd.Series:
        m = m.to_numpy(np.int64)
        return pd.Series((sent.value[m >> 3] >> (m & 7).astype(np.uint8)) & 1 == 1)

    def of(*c: Column | str) -> Column:
        return marked(place(*c))

    return of

"""Python helpers mapped over rows, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType


def each(fn: Callable, kind: str, once: bool = False) -> Callable[..., Column]:
    """A function of columns that maps fn over their rows; kind: the result's type as DDL, a struct's rows all dicts or all tuples.

    Results become Arrow arrays without a detour over pandas, which takes several times as long for nested ones.
    once: the function counts as not deterministic, so that a filter or explode on its result does not run it a second time.
    """
    kind = " ".join(kind.split())
    made = to_arrow_type(DataType.fromDDL(kind))

    def run(*columns: pa.Array) -> pa.Array:
        return pa.array([fn(*row) for row in zip(*[c.to_pylist() for c in columns], strict=True)], made)

    udf = F.arrow_udf(run, kind)
    return udf.asNondeterministic() if once else udf

"""Set operations and binding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bind_rows(*frames: DataFrame) -> DataFrame:
    """``bind_rows``: union by name, missing columns filled with NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def set_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """``intersect`` (distinct, like R)."""
    return a.intersect(b)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """``setdiff`` (distinct, like R)."""
    return a.subtract(b)


def column_difference(a: DataFrame, exclude: Sequence[str]) -> list[str]:
    """``setdiff(names(df), exclude)``: column names left after exclusion."""
    ex = set(exclude)
    return [c for c in a.columns if c not in ex]


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """``identical(x, y)`` as data: rows (with multiplicity) found on one side
    only.  Empty result = identical as multisets."""
    return (a.exceptAll(b).withColumn("side", F.lit("left_only"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right_only"))))


def bind_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``cbind``: columns side by side, matched on an explicit key (row
    order is not a property of a distributed table)."""
    return a.join(b, on=key, how="inner")

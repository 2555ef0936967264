"""Reshape and nesting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.strings import paste


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], key: str = "key", value: str = "value") -> DataFrame:
    """``gather(key, value, cols)``: wide -> long (one pass, no shuffle)."""
    return df.unpivot(list(ids), list(cols), key, value)


def pivot(df: DataFrame, ids: Sequence[str], key: str, agg: Column, values: Sequence | None = None,
          fill=0) -> DataFrame:
    """``spread(key, value, fill = 0)`` / ``dcast``.  Give ``values`` (the
    levels) to skip the extra job that discovers them."""
    out = df.groupBy(*ids).pivot(key, list(values) if values is not None else None).agg(agg)
    return out.na.fill(fill) if fill is not None else out


def unite(df: DataFrame, name: str, cols: Sequence[str], sep: str = "_", remove: bool = True) -> DataFrame:
    """tidyr ``unite``: NULL is written "NA" as in R."""
    out = df.withColumn(name, paste(*cols, sep=sep))
    return out.drop(*cols) if remove else out


def extract_groups(df: DataFrame, col: str, into: Sequence[str], regex: str) -> DataFrame:
    """tidyr ``extract``: one column per capture group, NULL when no match."""
    return df.withColumns({n: F.nullif(F.regexp_extract(F.col(col), regex, i + 1), F.lit(""))
                           for i, n in enumerate(into)})


def explode_delimited(df: DataFrame, col: str, pattern: str, keep: Sequence[str] = (), name: str = "item") -> DataFrame:
    """``str_split(x, pattern) %>% unnest``: one row per piece with its
    0-based position."""
    return df.select(*keep, F.posexplode(F.split(F.col(col), pattern)).alias("pos", name))


def one_hot_multi(df: DataFrame, ids: Sequence[str], col: str, sep: str, levels: Sequence[str]) -> DataFrame:
    """Split "a|b|c" into 0/1 indicator columns, one per level, in a single
    projection (no explode/shuffle needed when levels are known)."""
    parts = F.split(F.col(col), sep)
    return df.select(*ids, *[F.array_contains(parts, lv).cast("int").alias(lv) for lv in levels])


def nest_rows(df: DataFrame, by: Sequence[str], cols: Sequence[str], name: str = "data",
              chunk_size: int | None = None) -> DataFrame:
    """``group_by %>% nest``: array of structs per group, sorted by ``cols``.

    With ``chunk_size`` a group's list is split over several rows (column
    ``chunk``, 0-based) of at most ``chunk_size`` elements, cut in sort
    order from the skew-safe running count -- so a hot key never becomes
    one huge row; nothing is dropped.  Without it (R semantics) each group
    is one row."""
    if chunk_size is None:
        return df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    from quarry.operators.windows import running_sums
    pos = running_sums(df.select(*by, *[c for c in cols if c not in by]), list(by), list(cols), {"_rn": F.lit(1)})
    return pos.withColumn("chunk", F.floor((F.col("_rn") - 1) / chunk_size)) \
        .groupBy(*by, "chunk").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))


def unnest_rows(df: DataFrame, col: str, keep: Sequence[str]) -> DataFrame:
    """``unnest``: one row per nested element, struct fields as columns."""
    return df.select(*keep, F.inline(F.col(col)))


#: Rows that one task makes of a count at most.
REPLICATE_BLOCK = 1 << 18


def replicate_by_count(df: DataFrame, n: str, name: str = "i", block: int = REPLICATE_BLOCK) -> DataFrame:
    """``rep(x, n)``: frequency table -> one row per case, numbered from 1 (long).

    Two levels: a count becomes blocks of at most ``block`` rows, which are dealt
    over the tasks by hash, and each block its rows.  So a count of billions is
    many small rows in many tasks, not one array in one.  Counts that are null or
    below 1 give no rows."""
    many = F.col(n).cast("long")
    blocks = df.where(many >= 1).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((many - 1) / block).cast("long"))))
    # a stated number of tasks: the blocks are few and small, and would be put together again before they grow
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(tasks, F.xxhash64(*[F.col(c) for c in blocks.columns]))
    return dealt.withColumn(name, F.explode(F.sequence(F.col("_block") * block + 1, F.least(many, (F.col("_block") + 1) * block)))) \
        .drop(n, "_block")


def vector_to_wide(df: DataFrame, pos: str, value: str, width: int, row_name: str = "row") -> DataFrame:
    """Length-k*width series -> rows of ``width`` columns (``matrix(x,
    ncol=width, byrow=TRUE)``); ``pos`` is 0-based."""
    r = F.floor(F.col(pos) / width).alias(row_name)
    c = F.pmod(F.col(pos), F.lit(width)) + 1
    return df.withColumn("_c", c).groupBy(r).pivot("_c", list(range(1, width + 1))).agg(F.max(value))

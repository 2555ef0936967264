"""Readers, writers and in-column extraction.

Parquet is the native format (column pruning + filter pushdown).  Text
formats are read with explicit schemas where the caller knows them; schema
inference is available (``read_csv``) but scans the data once more.
Scratch output goes under the cluster's shared checkpoint folder, never a
machine-local temp directory.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, tag: str) -> str:
    """Fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-scratch/{tag}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str | Sequence[str], header: bool = True, infer: bool = False,
             schema: T.StructType | str | None = None, sep: str = ",", null_value: str = "NA",
             multiline: bool = False, line_sep: str | None = None, timestamp_format: str | None = None,
             **options: Any) -> DataFrame:
    """``read.csv`` / ``read_csv``: header handling, ``NA`` as NULL, custom
    separator / line separator, quoted multi-line fields."""
    r = spark.read.option("header", header).option("sep", sep).option("nullValue", null_value) \
        .option("multiLine", multiline).option("escape", '"')
    if line_sep is not None:
        r = r.option("lineSep", line_sep)
    if timestamp_format is not None:
        r = r.option("timestampFormat", timestamp_format)
    for k, v in options.items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer)
    return r.csv(path if isinstance(path, str) else list(path))


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", line_sep: str | None = None,
              null_value: str = "NA") -> str:
    w = df.write.mode("overwrite").option("header", header).option("sep", sep) \
        .option("nullValue", null_value).option("escape", '"')
    if line_sep is not None:
        w = w.option("lineSep", line_sep)
    w.csv(path)
    return path


def read_typed(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """``cols_only(col = type, ...)``: declared types, only the named
    columns are read (parquet projection)."""
    return spark.read.schema(schema).format(fmt).load(path)


def read_renamed(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str], sep: str = ",") -> DataFrame:
    """``read_csv(col_names = ..., skip = 1)``: discard the header line and
    impose new names and types."""
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
    return read_csv(spark, path, header=True, schema=schema, sep=sep)


def read_json_many(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None,
                   multiline: bool = False, base_path: str | None = None) -> DataFrame:
    """Read several JSON files / folders as one table (row-bind) in a single
    scan.  With ``base_path``, ``key=value`` folder names below it become
    columns (partition discovery)."""
    r = spark.read.option("multiLine", multiline)
    if base_path:
        r = r.option("basePath", base_path)
    if schema is not None:
        r = r.schema(schema)
    return r.json(list(paths))


def list_folders(spark: SparkSession, root: str) -> list[str]:
    """Folders below ``root``, in any file system Spark knows."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(s.getPath().toString() for s in found if s.isDirectory())


def extract_elements(df: DataFrame, html: str, tag: str, attr: str | None = None,
                     keep: Sequence[str] = ()) -> DataFrame:
    """All ``<tag>`` elements (or one attribute of them) from an HTML column,
    one row per element with its 0-based position.  Runs per row on the
    executors; no document is parsed on the driver."""
    if attr:
        pat = f'<{tag}\\s[^>]*{attr}="([^"]*)"'
    else:
        pat = f"<{tag}(?:\\s[^>]*)?>([^<]*)</{tag}>"
    return df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pat), 1)).alias("pos", "value"))


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """``tribble`` / ``data.frame`` literal.  Small by construction, so it is
    hinted for broadcast (a local list has no size statistics)."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))

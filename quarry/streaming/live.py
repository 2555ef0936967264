"""Structured Streaming operators.

Source: the events parquet read as a file stream (``readStream``), event
time mapped from TIMESTAMP_NTZ to the TIMESTAMP of that wall clock read as
UTC (``withWatermark`` rejects NTZ; integer epoch arithmetic, so windows
align to wall-clock hours whatever the session time zone), 10-minute
watermark.  Windows and sessions are emitted in append mode, each once, when
the watermark passes its end; their state is dropped then and rows that come
later still are dropped.  ``run_closed`` ends such a run: a marker row with a
far event time, read by the same query from its checkpoint, moves the watermark
past every window that is still open.  Sinks are parquet tables (or foreachBatch
writes) under the shared checkpoint folder with their own checkpoint
locations, so a restarted query resumes exactly once; nothing is collected
into driver memory.  ``availableNow`` processes what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quarry.functions.dates import ntz_as_utc_instant, utc_instant_as_ntz
from quarry.sources.readers import scratch_path

WATERMARK = "10 minutes"
#: Event time of the row that closes a run.
CLOSING_TIME = "9999-01-01 00:00:00+00:00"


def event_stream(spark: SparkSession, sf_dir: str, table: str = "events", files_per_batch: int | None = None) -> DataFrame:
    """File stream over the table's parquet file(s) with the batch schema;
    ``files_per_batch`` cuts what is there into several micro-batches."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    src = path[:-1] + "[t]"  # a pattern with one match: file streams take a folder or a pattern, not a file
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(src).withColumn("event_time", ntz_as_utc_instant("ts"))


def _run(writer: DataStreamWriter, tag: str, spark: SparkSession, out: str | None = None) -> str:
    out = out or scratch_path(spark, f"stream-{tag}")
    q = writer.option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start(f"{out}/data")
    q.awaitTermination()
    return f"{out}/data"


def run_append(df: DataFrame, tag: str, out: str | None = None) -> DataFrame:
    """Run an append-mode streaming query into a parquet sink and return the
    sink as a batch DataFrame.  Passing the same ``out`` again resumes the
    query from its checkpoint (new input only, watermark state kept)."""
    spark = df.sparkSession
    path = _run(df.writeStream.format("parquet").outputMode("append"), tag, spark, out)
    return spark.read.parquet(path)


def run_update(df: DataFrame, tag: str, keys: list[str]) -> DataFrame:
    """Update-mode aggregate: each micro-batch's changed rows are appended
    with the batch id (foreachBatch); the current state per key is the row
    of the latest batch."""
    spark = df.sparkSession
    out = scratch_path(spark, f"stream-{tag}")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(f"{out}/data")
    q = df.writeStream.outputMode("update").foreachBatch(sink) \
        .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    res = spark.read.parquet(f"{out}/data")
    vals = [c for c in res.columns if c not in keys and c != "_batch"]
    latest = res.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("_batch")).alias("_s"))
    return latest.select(*keys, *[F.col("_s")[c].alias(c) for c in vals])


def run_closed(stream: DataFrame, plan: Callable[[DataFrame], DataFrame], tag: str, out: str | None = None) -> DataFrame:
    """Run the windowed aggregate ``plan(stream)`` in append mode to the end
    of its input and close what is still open.

    The stream is read together with a folder of marker rows, empty at first.
    When the input is used up, one marker (event time ``CLOSING_TIME``, every
    other column null) is written there and the query is started again from
    its checkpoint: the watermark passes all windows, which are emitted and
    leave the state; the marker's own window stays open and is never
    emitted.  Passing the same ``out`` again only finds late rows."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, f"stream-{tag}")
    markers = f"{out}/markers"
    none = spark.createDataFrame([], stream.schema)
    none.write.mode("ignore").parquet(markers)
    marked = stream.unionByName(spark.readStream.schema(stream.schema).parquet(markers))
    run_append(plan(marked), tag, out)
    nulls = {c: F.lit(None).cast(stream.schema[c].dataType) for c in stream.columns}
    nulls["event_time"] = F.lit(CLOSING_TIME).cast("timestamp")
    spark.range(1).select(*[e.alias(c) for c, e in nulls.items()]).write.mode("append").parquet(markers)
    return run_append(plan(marked), tag, out)


def _ntz(c: str):
    return utc_instant_as_ntz(c)


def tumbling_mean(stream: DataFrame, size: str, by: list[str], value: str) -> DataFrame:
    agg = stream.withWatermark("event_time", WATERMARK).groupBy(F.window("event_time", size), *by) \
        .agg(F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n"))
    return agg.select(_ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"), *by,
                      "mean_value", "n")


def sliding_count(stream: DataFrame, size: str, slide: str, by: list[str]) -> DataFrame:
    agg = stream.withWatermark("event_time", WATERMARK).groupBy(F.window("event_time", size, slide), *by) \
        .agg(F.count(F.lit(1)).alias("n"))
    return agg.select(_ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"), *by, "n")


def sessions(stream: DataFrame, gap: str, by: list[str]) -> DataFrame:
    agg = stream.withWatermark("event_time", WATERMARK).groupBy(F.session_window("event_time", gap), *by) \
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total"))
    return agg.select(*by, _ntz("session_window.start").alias("session_start"),
                      _ntz("session_window.end").alias("session_end"), "n_events", "total")


def dedupe(stream: DataFrame, keys: list[str]) -> DataFrame:
    return stream.withWatermark("event_time", WATERMARK).dropDuplicatesWithinWatermark(keys)


def static_join(stream: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Stream-static join.  No broadcast hint: the planner broadcasts the
    static side when its measured size is under the threshold."""
    return stream.join(lookup, on, "left")


def running_totals(stream: DataFrame, by: list[str], value: str) -> DataFrame:
    return stream.groupBy(*by).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))



"""Frequency tables to cases, in two levels."""

from pyspark.sql import functions as F

from quarry.operators.reshape import replicate_by_count


def test_rows_equal_counts(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0), ("d", -2), ("e", None), (None, 12), ("a", 5)], "x string, n int")
    got = sorted(((r.x or "", r.i) for r in replicate_by_count(df, "n", block=4).collect()))
    want = [(x, i) for x, n in (("a", 3), ("b", 1), ("", 12), ("a", 5)) for i in range(1, n + 1)]
    assert got == sorted(want)


def test_one_large_count_spreads_over_tasks(spark):
    df = spark.createDataFrame([("a", 10_000_000)], "x string, n long")
    out = replicate_by_count(df, "n").groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.sum("i").alias("s"))
    tasks = out.collect()
    assert len(tasks) >= 4 and max(t.n for t in tasks) < 5_000_000
    assert sum(t.n for t in tasks) == 10_000_000 and sum(t.s for t in tasks) == 10_000_000 * 10_000_001 // 2


def test_count_beyond_int_plans(spark):
    df = spark.createDataFrame([("a", 3_000_000_000)], "x string, n long")
    out = replicate_by_count(df, "n")
    assert dict(out.dtypes)["i"] == "bigint" and "Generate" in out._jdf.queryExecution().toString()
    # its blocks are few rows
    assert out.sparkSession.range(1).select(F.floor(F.lit((3_000_000_000 - 1) / (1 << 18)))).first()[0] < 12_000

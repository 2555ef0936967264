"""Session, table loading and lineage helpers."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

HARNESS_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "quarry", **conf: str) -> SparkSession:
    """Session used by tests and the bench.  On a cluster the caller passes
    its own session; nothing in the library depends on these settings
    except a UTC session time zone for wall-clock functions."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "8g"))
    conf = {"spark.sql.session.timeZone": "UTC", **conf}
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one harness table (parquet); column pruning and filter pushdown
    happen in the scan once the caller selects / filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS / object store) folder there and we use
    it as is.  Only when it is unset -- local tests -- do we make one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors (HDFS, object store)")
        # local mode only (tests): one machine, so a temporary folder is shared by definition
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``quarry`` importable in executor Python workers (pandas UDFs,
    applyInPandas, mapInPandas): zip the package once per application and
    register it with ``addPyFile``, which distributes it to every executor."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: code is shipped by other means
        return
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    # written through the Hadoop FileSystem API into the shared checkpoint
    # folder (local path, HDFS or object store alike); Spark ships it on
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-code/{sc.applicationId}/quarry.zip"
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)

"""Spark session settings shared by jobs, tests and the benchmark.

Jobs never build their own session on a cluster: they take the one they are
given. ``get_session`` is only a convenience for local runs and tests; it sets
sane defaults (AQE on, UTC, UI off) and leaves anything the cluster already
configured untouched.
"""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

# Defaults applied when a caller builds a session through ``get_session``.
# AQE coalesces small shuffle partitions and splits skewed join partitions at
# runtime, which is what keeps one hot key from owning a whole task.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture on every Column call makes building the
    # (large) expression trees several times slower; errors still carry the
    # JVM-side context.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Suggested settings for a large cluster (e.g. ~100 TB of logs, 1000
# executors). Jobs never force them; pass them to spark-submit or
# ``get_session(extra=CLUSTER_CONF)``.
CLUSTER_CONF = {
    # ~256 MB input splits: large enough to amortise task overhead, small
    # enough to keep the per-row payload work and sort buffers in memory.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Start shuffles wide and let AQE merge partitions towards 256 MB.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Split a join partition that is 5x the median and above 512 MB.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Statistics-based broadcast stays modest; the mapping side is hinted
    # explicitly after its own size check.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "userlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` always wins. Without it only a
    ``local[...]`` session, whose one process is driver and executor, gets a
    private scratch folder; elsewhere executors would each write to a disk of
    their own, so it is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not sc.getCheckpointDir():
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="userlens-ckpt-"))
    return sc.getCheckpointDir()


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for the plans made and run inside; ``__`` in a name stands for a dot."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df, *partition_by: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: later uses read files instead of recomputing the lineage, and a
    lost executor never recomputes the sources. With ``partition_by`` a use that
    filters on it reads its folders alone. Returns the table and its path, for
    ``drop_table`` after use."""
    import uuid as _uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/userlens-table-{_uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table that ``materialize`` wrote."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files in a folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()

"""Tables written to the folder that driver and executors share, and components of a graph."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a ``local[...]`` session, whose driver is its
    one executor, may go without: it gets a temporary folder of its own."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if at:
        return at
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="userlens-llm-"))
    return sc.getCheckpointDir()


def written_at(df: DataFrame, name: str, files: int | None = None) -> tuple[DataFrame, str]:
    """``written``, and where, for ``dropped``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut and the work is done once.
    ``files`` bounds the number of files where the size is known to be small for more."""
    return written_at(df, name, files)[0]


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a table of ``written_at`` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of jobs that are done and that no DataFrame refers to: its cleaner
    does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Edges a file (and task) when a table of edges is written whose size is known.
EDGES_PER_FILE = 500_000


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars: every node tied to the smallest node that the task's edges connect
    it with. Union-find over the task's own nodes only."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while up.get(root, root) != root:
            root = up[root]
        while up.get(x, x) != root:
            up[x], x = root, up[x]
        return root

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["u", "v"])


def _not_stars(e: DataFrame) -> tuple[int, int]:
    """(nodes that keep the edges (u, v) from being stars, edges): a node that is tied twice, or that is
    tied to another and has nodes tied to itself. One aggregation."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("tied"), F.lit(0).alias("head")).unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("tied"), F.lit(1).alias("head")))
    per = ends.groupBy("x").agg(F.sum("tied").alias("tied"), F.max("head").alias("head"))
    bad = F.sum(((F.col("tied") > 1) | ((F.col("tied") > 0) & (F.col("head") > 0))).cast("long"))
    r = per.agg(F.coalesce(bad, F.lit(0)), F.coalesce(F.sum("tied"), F.lit(0))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected graph of long columns ``u`` and ``v``: the component is
    its smallest node. Nodes without an edge are absent.

    Tasks first contract the edges they hold to stars. Until these fit together, alternating
    large-star and small-star steps send a node's neighbours to the smallest of them, by a grouped
    minimum and a join on the node, so no neighbour list is ever gathered; a hub is one aggregated
    row on one side of a join that Spark may split. Edges are written to the shared folder in each
    round, and those of the round before deleted.
    """
    spark = edges.sparkSession
    e, at = written_at(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    files = None
    while True:
        before = at
        e, at = written_at(e.mapInArrow(contract, "u long, v long").distinct(), "edges", files)
        dropped(spark, before)
        bad, n = _not_stars(e)
        if not bad:
            break
        files = max(e.sparkSession.sparkContext.defaultParallelism, n // EDGES_PER_FILE)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = (large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))))
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def hash_share(df: DataFrame, column: str, rows: int) -> DataFrame:
    """A part of ``df`` of about four times ``rows`` rows, those of the smallest hashes of ``column``: what a
    bounded sample is then picked from, so that not every task sends that many rows."""
    n = df.count()
    span = 1 << 40
    return df.filter(F.pmod(F.xxhash64(column), F.lit(span)) < int(span * min(1.0, 4 * rows / max(n, 1))) + 1)


#: Rows and bytes of the batches that go to Python workers. Texts are long, and a worker, its JVM
#: and the buffers between them each hold a batch or more.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ship(spark: SparkSession) -> None:
    """Make the session ready for the operators: small batches, and this package sent to its Python
    workers, once, as they may not have it installed."""
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    sc = spark.sparkContext
    if getattr(sc, "_userlens_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    at = Path(tempfile.mkdtemp(prefix="userlens-pkg-")) / "userlens_pkg.zip"
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(at))
    sc._userlens_sent = True

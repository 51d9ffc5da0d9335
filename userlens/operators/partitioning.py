"""Parallelism for CPU-heavy narrow stages."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None, input_bytes: int | None = None) -> DataFrame:
    """Spread rows over at least ``min_partitions`` tasks (default: the
    cluster's default parallelism) before a CPU-heavy projection.

    Only when the input has fewer splits than that (a handful of small files)
    is a round-robin repartition added; a large input already has many
    splits and is returned unchanged, so no shuffle is added at scale.
    With ``input_bytes``, the size of the files that are read, the splits follow
    from ``spark.sql.files.maxPartitionBytes``, and no plan is made to count them.

    Use it on scan-side frames: asking a frame that already contains a
    shuffle for its partition count makes adaptive execution run that
    shuffle while the query is still being built. Post-shuffle stages get
    their parallelism from ``spark.sql.shuffle.partitions`` instead.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if input_bytes is None:
        enough = df.rdd.getNumPartitions() >= target
    else:
        split = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b")
        unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(split[-1], 1)
        enough = input_bytes >= target * int(split.rstrip("kmgt")) * unit
    return df if enough else df.repartition(target)

"""Keyed document writes: dedup, replace, upsert, snapshot tables.

A snapshot table is a set of Parquet files in key buckets (``pmod(xxhash64(key), buckets)``).
Each write puts its rows into a new run folder and then commits a manifest: one small
file that names the folders and files of the new version, renamed into place when it
is whole. Readers take the newest manifest, so a write that dies before
its manifest changes nothing. Writers claim their version first: of two that
started from one version the second fails alone.

Incoming rows are deduplicated by key (an aggregate with map-side combine) and
written once to the shared folder, so no key can skew a merge join and the number
of bytes is known: it decides the buckets of the run. The rows of a run are
rebalanced by bucket, so adaptive execution joins small buckets and splits large
ones, and the tasks of a write grow with its bytes. Files are sorted by key, hold
at most ``file_rows`` rows and carry a Bloom filter of the key.

Replace and upsert look for the incoming keys in the key column of the files that
their buckets have; only files with a hit are read and rewritten, and new keys
alone rewrite nothing. Runs may differ in buckets (each number a multiple of the
smaller ones by a power of two), as a manifest row has its own.

Rows without a key are documents of their own: each is kept, none replaces another.
"""

from __future__ import annotations

import json
import time
import uuid as _uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_table, folder_bytes, materialize, settings


def dedup_by_key(df: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """One row per key: the row with the largest ``order``, ties broken by the
    whole row, so the winner never depends on partitioning. Rows without a key stay.

    One ``max`` of a struct that holds the order and the row itself, unpacked
    afterwards: the row is carried once, and aggregates partially before the
    shuffle. Maps have no order, so a row with maps is picked by the rest.
    """
    others = [c for c in df.columns if c != key]
    maps = [c for c in others if _is_map(df, c)]
    rank = [o.alias(f"__o{i}") for i, o in enumerate(order or [])]
    row = F.struct(*rank, *[F.col(c) for c in others if c not in maps])
    best = F.max_by(F.struct(*[F.col(c) for c in others]), row) if maps else F.max(row)
    own = []
    if df.schema[key].nullable:  # a group of its own for each row without a key
        df = df.withColumn("__own", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
        own = ["__own"]
    out = df.groupBy(key, *own).agg(best.alias("__best"))
    return out.select(key, *[F.col(f"__best.{c}").alias(c) for c in others])


def _is_map(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() == "map"


def as_documents(df: DataFrame, key: str, fields: dict[str, Column] | list[str],
                 id_col: str = "_id") -> DataFrame:
    """Shape rows into ``(_id, fields...)`` documents."""
    if isinstance(fields, dict):
        cols = [c.alias(n) for n, c in fields.items()]
    else:
        cols = [F.col(c) for c in fields]
    return df.select(F.col(key).alias(id_col), *cols)


def merge_replace(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Replace semantics: an incoming document replaces the whole old one.

    Old documents without an incoming key survive as they are; a replaced
    document keeps none of its old fields (columns the incoming side lacks
    become null).
    """
    return _full_merge(target, dedup_by_key(incoming, key), key, False)


Merge = Callable[[Column, Column], Column]


def merge_upsert(target: DataFrame, incoming: DataFrame, key: str, merge: dict[str, Merge] | None = None) -> DataFrame:
    """Upsert semantics: supplied fields overwrite, other fields survive.

    A supplied null is written as null (presence, not value, decides), so
    ``coalesce`` is not used. Missing documents are inserted. A field named in
    ``merge`` becomes that function of its old (null in a new document) and new value.
    """
    return _full_merge(target, dedup_by_key(incoming, key), key, True, merge)


def _full_merge(target: DataFrame, incoming: DataFrame, key: str, keep_unsupplied: bool,
                merge: dict[str, Merge] | None = None) -> DataFrame:
    """One full outer join on the key; each side is read once. Null keys match nothing."""
    inc_cols = [c for c in incoming.columns if c != key]
    old_cols = [c for c in target.columns if c != key]
    t = target.select(F.col(key).alias("__k_old"), *[F.col(c).alias(f"__old_{c}") for c in old_cols])
    n = incoming.select(F.col(key).alias("__k_new"), F.lit(True).alias("__present"),
                        *[F.col(c).alias(f"__new_{c}") for c in inc_cols])
    j = t.join(n, F.col("__k_old") == F.col("__k_new"), "full_outer")
    present = F.coalesce(F.col("__present"), F.lit(False))
    out = [F.coalesce(F.col("__k_new"), F.col("__k_old")).alias(key)]
    for c in old_cols:
        if c in inc_cols and c in (merge or {}):
            out.append(F.when(present, merge[c](F.col(f"__old_{c}"), F.col(f"__new_{c}"))).otherwise(F.col(f"__old_{c}")).alias(c))
        elif c in inc_cols:
            out.append(F.when(present, F.col(f"__new_{c}")).otherwise(F.col(f"__old_{c}")).alias(c))
        elif keep_unsupplied:
            out.append(F.col(f"__old_{c}").alias(c))
        else:
            out.append(F.when(present, F.lit(None)).otherwise(F.col(f"__old_{c}")).alias(c))
    for c in inc_cols:
        if c not in old_cols:
            out.append(F.col(f"__new_{c}").alias(c))
    return j.select(*out)


# ---- snapshot tables ------------------------------------------------------

# Parquet bytes of the incoming rows per bucket, most buckets of a table, most rows of a file.
BUCKET_BYTES = 128 << 20
MOST_BUCKETS = 1 << 17
FILE_ROWS = 1_000_000
# A claim of a version without its manifest is void after so many seconds.
CLAIM_SECONDS = 3600
# Settings under which a largest or smallest value of Parquet files comes from their footers.
FOOTERS = {"spark__sql__sources__useV1SourceList": "", "spark__sql__parquet__aggregatePushdown": "true"}
BUCKET_COL = "_bucket"
RUN_COL = "_run"
VERSION_COL = "_version"
_MANIFEST = "version long, run string, buckets int, bucket int, path string, columns string"


def _root(root: str) -> str:
    return root.rstrip("/")


def manifest(spark: SparkSession, root: str) -> list | None:
    """The rows of the newest manifest, or None where no table exists yet.

    Only a proven missing folder means "no table". A manifest folder without a
    version, with a broken row, or with two writers' manifests of one version
    raises: going on would drop or mix the table's rows.
    """
    at = f"{_root(root)}/_manifest"
    if not _exists(spark, at):
        return None
    df = spark.read.schema(_MANIFEST).option("mode", "FAILFAST").json(at)
    newest = df.agg(F.max("version")).first()[0]
    if newest is None:
        raise ValueError(f"the snapshot at {root} has a manifest folder but no version in it")
    rows = df.where(F.col("version") == newest).collect()
    if len({r["run"] for r in rows}) > 1:
        raise ValueError(f"two writers published version {newest} of {root}")
    if any(r["path"] is None or r["bucket"] is None or not r["buckets"] for r in rows) or not any(r["columns"] for r in rows):
        raise ValueError(f"version {newest} of {root} has a broken manifest row")
    return rows


def _schema(rows: list) -> T.StructType:
    return T.StructType.fromJson(json.loads(next(r["columns"] for r in rows if r["columns"])))


def _scan(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The files and folders ``paths``; columns added after one was written read as null."""
    if not paths:
        return spark.createDataFrame([], schema)
    base = paths[0].partition(f"/{RUN_COL}=")[0]
    return spark.read.schema(schema).option("basePath", base).parquet(*sorted(set(paths)))


def _read(spark: SparkSession, rows: list, schema: T.StructType | None = None) -> DataFrame:
    schema = schema or _schema(rows)
    return _scan(spark, [r["path"] for r in rows if r["bucket"] >= 0], schema).select(*schema.names)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows of a snapshot table, or None when it has none yet."""
    rows = manifest(spark, root)
    return None if rows is None else _read(spark, rows)


def lookup(spark: SparkSession, root: str, key: str, values: list) -> DataFrame | None:
    """The documents of a few keys: only their buckets are opened, and files whose Bloom filter
    or bounds rule the keys out are skipped by the scan."""
    rows = manifest(spark, root)
    if rows is None:
        return None
    schema = _schema(rows)
    asked = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(key, schema[key].dataType)]))
    most = max(r["buckets"] for r in rows)
    inside = {r[0] for r in with_bucket(asked, key, most).select(BUCKET_COL).distinct().collect()}
    return _read(spark, _of_buckets(rows, inside), schema).where(F.col(key).isin(values))


def largest(spark: SparkSession, paths: list[str], schema: T.StructType, column: str) -> DataFrame:
    """The largest value of a column of Parquet files, taken from their footers: no row is read."""
    names = T.StructType([schema[column]])
    return _scan(spark, paths, names).select(column).agg(F.max(column).alias(column))


def largest_value(spark: SparkSession, root: str, column: str):
    """The largest value of a column of the table at ``root``; None for no table, no rows or nulls alone."""
    rows = manifest(spark, root)
    if rows is None:
        return None
    with settings(spark, **FOOTERS):
        return largest(spark, [r["path"] for r in rows if r["bucket"] >= 0], _schema(rows), column).first()[0]


def _of_buckets(rows: list, buckets: set[int]) -> list:
    """The manifest rows that may hold keys of ``buckets``, which are numbers under the largest count."""
    inside = {n: {b % n for b in buckets} for n in {r["buckets"] for r in rows}}
    return [r for r in rows if r["bucket"] in inside[r["buckets"]]]


def _by_bucket(rows: list) -> dict[int, list]:
    """Rows by their bucket under the smallest count, so that a key's folders are together."""
    least = min(r["buckets"] for r in rows)
    out: dict[int, list] = {}
    for r in rows:
        if r["bucket"] >= 0:
            out.setdefault(r["bucket"] % least, []).append(r)
    return out


def read_latest(spark: SparkSession, root: str, key: str) -> DataFrame | None:
    """A snapshot written with ``append_versioned``, resolved to the latest
    document per key; the version column is dropped. Only buckets that several
    runs wrote are aggregated by key; a bucket with one folder holds one
    document per key already and is read without a shuffle."""
    rows = manifest(spark, root)
    if rows is None:
        return None
    schema = _schema(rows)
    if VERSION_COL not in schema.names:
        return _read(spark, rows)
    once, often = _once_and_often(rows)
    parts = []
    if once or not often:
        parts.append(_read(spark, once, schema))
    if often:
        parts.append(dedup_by_key(_read(spark, often, schema), key, [F.col(VERSION_COL)]))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.drop(VERSION_COL)


def _run_of(path: str) -> str:
    return path.partition(f"/{RUN_COL}=")[2].partition("/")[0]


def _once_and_often(rows: list) -> tuple[list, list]:
    """Rows of the buckets that one run wrote, and of those that several wrote."""
    once, often = [], []
    for rs in _by_bucket(rows).values():
        (once if len({_run_of(r["path"]) for r in rs}) == 1 else often).extend(rs)
    return once, often


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with its bucket; rows without a key are spread over all of them."""
    h = F.xxhash64(key)
    if df.schema[key].nullable:
        h = F.when(F.col(key).isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(h)
    return df.withColumn(BUCKET_COL, F.pmod(h, F.lit(buckets)).cast("int"))


def buckets_for(size: int, least: int = 1, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets ``size`` bytes get: ``least``, doubled while a bucket has more than ``bucket_bytes``."""
    n = least
    while n * bucket_bytes < size and n * 2 <= MOST_BUCKETS:
        n *= 2
    return n


def _publish(spark: SparkSession, df: DataFrame, root: str, key: str, buckets: int, old: list | None, keep: list,
             partition_by: str | None, sort_by: str | None = None, file_rows: int = FILE_ROWS) -> str:
    """Write ``df`` (with its bucket) as a run and commit a manifest of ``keep`` plus the run.

    The rebalance keeps a bucket (and ``partition_by`` value) in one task while it is
    small, puts many small ones into a task, and splits a large one.
    """
    run = f"{int(time.time() * 1000)}-{_uuid.uuid4().hex[:8]}"
    path = f"{_root(root)}/data/{RUN_COL}={run}"
    split = [BUCKET_COL] + ([partition_by] if partition_by else [])
    (df.hint("rebalance", *[F.col(c) for c in split]).sortWithinPartitions(*split, *([sort_by] if sort_by else []), key)
     .write.mode("errorifexists").partitionBy(*split).option("maxRecordsPerFile", file_rows)
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{key}", "true")
     .parquet(path))
    columns = T.StructType([f for f in df.schema.fields if f.name != BUCKET_COL])
    if old:
        was = _schema(old)
        columns = T.StructType([*was.fields, *[f for f in columns.fields if f.name not in was.names]])
    version = old[0]["version"] + 1 if old else 1
    fs, at = _fs(spark, path)
    written = sorted(int(s.getPath().getName().partition("=")[2]) for s in fs.listStatus(at) if s.isDirectory() and s.getPath().getName().startswith(f"{BUCKET_COL}="))
    rows = [(version, run, buckets, b, f"{path}/{BUCKET_COL}={b}") for b in written]
    rows += [(version, run, r["buckets"], r["bucket"], r["path"]) for r in keep]
    if not rows:  # an empty table still has its columns
        rows = [(version, run, buckets, -1, path)]
    _commit(spark, root, [(*r, columns.json() if k == 0 else "") for k, r in enumerate(rows)])
    return path


def _commit(spark: SparkSession, root: str, rows: list) -> None:
    """One file, renamed into place when it is whole, by the one writer that holds the version's claim."""
    claim = f"{_root(root)}/_claims/{rows[0][0]:020d}"
    if not _claimed(spark, claim):
        raise RuntimeError(f"another writer published or is publishing version {rows[0][0]} of {root}")
    names = [f.strip().split()[0] for f in _MANIFEST.split(",")]
    text = "".join(json.dumps(dict(zip(names, r))) + "\n" for r in rows)
    name = f"part-{rows[0][0]:020d}-{rows[0][1]}.json"
    fs, hidden = _fs(spark, f"{_root(root)}/_manifest/_{name}")
    try:
        out = fs.create(hidden, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(hidden, _fs(spark, f"{_root(root)}/_manifest/{name}")[1]):
            raise RuntimeError(f"the manifest of version {rows[0][0]} of {root} could not be renamed into place")
    except BaseException:
        fs.delete(_fs(spark, claim)[1], False)
        raise


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _claimed(spark: SparkSession, path: str) -> bool:
    """Whether this call made the file ``path``; the file system lets one caller make it."""
    fs, at = _fs(spark, path)
    void = (time.time() - CLAIM_SECONDS) * 1000
    if fs.exists(at) and fs.getFileStatus(at).getModificationTime() < void:
        version = int(path.rpartition("/")[2])
        done = spark.read.schema(_MANIFEST).json(f"{path.partition('/_claims/')[0]}/_manifest") if _exists(spark, f"{path.partition('/_claims/')[0]}/_manifest") else None
        if done is None or done.where(F.col("version") == version).isEmpty():
            fs.delete(at, False)
    try:
        fs.create(at, False).close()
        return True
    except Exception:
        if fs.exists(at):
            return False
        raise


def compact_snapshot(spark: SparkSession, root: str, key: str, partition_by: str | None = None) -> str:
    """Fold the appended versions into one row per key. Only buckets that
    several runs wrote are read and rewritten (rows keep their own version, so
    later appends still win)."""
    old = manifest(spark, root)
    if old is None:
        raise ValueError(f"no snapshot at {root}")
    once, often = _once_and_often(old)
    if not often:
        return old[0]["path"]
    latest = dedup_by_key(_read(spark, often, _schema(old)), key, [F.col(VERSION_COL)])
    n = max(r["buckets"] for r in old)
    return _publish(spark, with_bucket(latest, key, n), root, key, n, old, once, partition_by)


def _place(path: str) -> str:
    """A file's or folder's place in the table's data folder."""
    return path.partition(f"/{RUN_COL}=")[2]


def _hit_files(spark: SparkSession, rows: list, schema: T.StructType, docs: DataFrame, key: str) -> tuple[list[str], list]:
    """(files of the manifest ``rows`` that hold a key of ``docs``, manifest rows for the other files).
    One join on the key column alone; names of files are bounded by the table's bytes."""
    if not rows:
        return [], []
    held = _scan(spark, [r["path"] for r in rows], schema)
    hits = held.select(F.col("_metadata.file_path").alias("__file"), key).join(docs.select(key), key, "left_semi").select("__file").distinct().collect()
    hit = {_place(unquote(r[0])) for r in hits}
    base = rows[0]["path"].partition(f"/{RUN_COL}=")[0] + f"/{RUN_COL}="
    of = {_place(r["path"]): r.asDict() for r in rows}
    files: dict[str, list[str]] = {}
    for f in {_place(unquote(u)) for u in held.inputFiles()}:
        at = f
        while at not in of:
            at = at.rpartition("/")[0]
        files.setdefault(at, []).append(f)
    left = []
    for at, r in of.items():
        mine = files.get(at, [])
        if not hit.intersection(mine):
            left.append(r)
        else:
            left += [{**r, "path": base + f} for f in sorted(mine) if f not in hit]
    return [base + f for f in sorted(hit)], left


def write_keyed(spark: SparkSession, incoming: DataFrame, root: str, key: str,
                mode: str = "replace", partition_by: str | None = None,
                version: int | None = None, buckets: int | None = None, sort_by: str | None = None,
                merge: dict[str, Merge] | None = None, bucket_bytes: int = BUCKET_BYTES, file_rows: int = FILE_ROWS) -> str:
    """Merge ``incoming`` into the snapshot table at ``root``.

    ``replace`` / ``upsert`` read and rewrite the files that hold incoming keys; the
    others stay. ``append_versioned`` gives replace semantics at the cost of the
    increment only: documents are appended with a run version, ``read_latest`` returns
    the newest document per key, and ``compact_snapshot`` folds versions from time to time.

    ``buckets`` fixes the buckets of a new table; else they follow from its bytes.
    ``partition_by`` lays a run out in folders of that column, for a column of few
    values in a run; ``sort_by`` orders the files by it instead, so that a bound on
    it skips row groups, for a column of many. ``merge`` is that of ``merge_upsert``.
    """
    if mode not in ("replace", "upsert", "append_versioned"):
        raise ValueError(f"unknown write mode {mode!r}")
    old = manifest(spark, root)
    docs = dedup_by_key(incoming, key)
    if mode == "append_versioned":
        run_version = int(time.time() * 1000) if version is None else version
        docs = docs.withColumn(VERSION_COL, F.lit(run_version).cast("long"))
    # Written once to the shared folder: its bytes are known then, and a source that moves on
    # meanwhile can't give the uses below different rows.
    docs, table = materialize(docs)
    try:
        n = max(r["buckets"] for r in old) if old else buckets or 1
        if old or not buckets:
            n = buckets_for(folder_bytes(spark, table), n, bucket_bytes)
        keep = [r for r in old or [] if r["bucket"] >= 0]
        if old is not None and mode != "append_versioned":
            inside = {r[0] for r in with_bucket(docs, key, n).select(BUCKET_COL).distinct().collect()}
            if not inside:
                return old[0]["path"]
            schema = _schema(old)
            near = _of_buckets(keep, inside)
            hit, left = _hit_files(spark, near, schema, docs, key)
            far = {id(r) for r in near}
            keep = [r for r in keep if id(r) not in far] + left
            docs = _full_merge(_scan(spark, hit, schema).select(*schema.names), docs, key, mode == "upsert", merge)
        return _publish(spark, with_bucket(docs, key, n), root, key, n, old, keep, partition_by, sort_by, file_rows)
    finally:
        drop_table(spark, table)


def write_replace_by_key(spark: SparkSession, incoming: DataFrame, root: str, key: str, **layout) -> str:
    """Keyed write where a document replaces the old one on key collision."""
    return write_keyed(spark, incoming, root, key, mode="replace", **layout)


def write_upsert_by_key(spark: SparkSession, incoming: DataFrame, root: str, key: str, **layout) -> str:
    """Keyed write where supplied fields overwrite and the rest survive."""
    return write_keyed(spark, incoming, root, key, mode="upsert", **layout)

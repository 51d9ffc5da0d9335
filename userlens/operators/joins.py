"""Joins of the jobs.

Broadcast is hinted only behind a check of the side's size in bytes: a side
proven small is hinted; otherwise the plain join stays and Spark/AQE pick a
shuffle join (AQE splits skewed partitions of the big side at runtime).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import distinct_keys

# Bound for broadcasting the mapping side, in bytes of its rows as JSON text.
DEFAULT_BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when ``df``'s rows have at most ``max_bytes`` bytes.

    One aggregate over ``df``, run now and not remembered, so whoever builds a
    plan with it pays for it.
    """
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]
    if size <= max_bytes:
        return F.broadcast(df), True
    return df, False


def join_event_mapping(logs: DataFrame, mapping: DataFrame,
                       max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Attach each event's mapping (all columns but ``action_id``: the ``attrs`` array or what was compiled from
    it); unmapped events get null.

    ``mapping`` has one row per action, so the fact side never fans out.
    Event ids are INT, actions BIGINT: the key is widened on the log side.
    """
    small, _ = bounded_broadcast(mapping, max_broadcast_bytes)
    side = small.withColumnRenamed("action_id", "__action")
    joined = logs.join(side, F.col("eventid").cast("long") == F.col("__action"), "left")
    return joined.drop("__action")


def semi_join_new_orders(orders: DataFrame, keys: DataFrame, key: str = "uuid") -> DataFrame:
    """Orders whose key is in ``keys``; a null key never matches; duplicates stay."""
    return orders.join(keys.select(key), key, "left_semi")


def except_keys(source_keys: DataFrame, existing_keys: DataFrame) -> DataFrame:
    """Distinct source keys not in the existing keys (null-safe, keeps one null)."""
    key = source_keys.columns[0]
    known = existing_keys.select(F.col(existing_keys.columns[0]).alias("__known"))
    return distinct_keys(source_keys, key).join(known, F.col(key).eqNullSafe(F.col("__known")), "left_anti")


def anti_join_new_orders(orders: DataFrame, existing_keys: DataFrame, key: str = "uuid",
                         mostly_known: bool = False) -> DataFrame:
    """Fused ``except`` + ``semi``: non-null keys not yet in the target.

    One anti join instead of a distinct, a null-safe anti join and a semi
    join; the existing side is only the key column. Where most orders are known
    (a repeated sync), ``mostly_known`` keeps their columns out of the shuffle: the
    new keys are found from the key column alone, and whole orders are read behind a
    Bloom filter of them, so that little more than the new orders is shuffled.
    """
    some = orders.where(F.col(key).isNotNull())
    known = existing_keys.select(key)
    if not mostly_known:
        return some.join(known, key, "left_anti")
    new = some.select(key).distinct().join(known, key, "left_anti")
    return some.where(may_contain(new, key, F.col(key))).join(new, key, "left_semi")


# Bits of a Bloom filter: 1 MB, under 3 % false positives for half a million keys. With more keys it
# lets more rows through, and results stay the same.
BLOOM_BITS = 1 << 23


def _bits_of(key: Column, bits: int) -> list[Column]:
    """The two places of a key in a Bloom filter."""
    h = F.xxhash64(key)
    return [F.pmod(h, F.lit(bits)), F.pmod(F.shiftright(h, 32), F.lit(bits))]


def may_contain(keys: DataFrame, key: str, value: Column, bits: int = BLOOM_BITS) -> Column:
    """False only where ``value`` is none of ``keys``: a Bloom filter, as a scalar subquery of ``bits`` / 64 numbers
    that is built when the query runs and put into the scan's filter, before any shuffle."""
    place = keys.select(F.explode(F.array(*_bits_of(F.col(key), bits))).alias("p"))
    words = place.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))).alias("b"))
    every = keys.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("w"), "left").select(F.struct("id", F.coalesce("b", F.lit(0).cast("long")).alias("b")).alias("x"))
    table = every.agg(F.array_sort(F.collect_list("x"))["b"].alias("t")).scalar()
    hit = F.lit(True)
    for p in _bits_of(value, bits):
        hit = hit & (F.getbit(F.get(table, F.shiftright(p, 6).cast("int")), p.bitwiseAND(63).cast("int")) == 1)
    return hit

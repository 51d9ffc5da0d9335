"""Key/value entry arrays: the dynamic-schema building block of payloads."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTRY_TYPE = "array<struct<key:string,value:string>>"


def empty_entries() -> Column:
    return F.array().cast(ENTRY_TYPE)


def entry(k: Column, v: Column) -> Column:
    return F.struct(k.alias("key"), v.alias("value"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Higher-order functions re-evaluate outer expressions on every element;
    wrapping the value in a one-element array binds it instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def dedup_last(entries: Column) -> Column:
    """Keep the last entry of each key (at its own position).

    An entry survives when its key does not occur again later. Entries and
    keys are bound first: inside the lambda an expression would be computed
    again for every entry.
    """
    def kept(e: Column) -> Column:
        def last_of_key(keys: Column) -> Column:
            n = F.size(keys)
            return F.filter(e, lambda x, i: ~F.array_contains(F.slice(keys, i + 2, F.greatest(n - i - 1, F.lit(1))), x["key"])
                            | (i + 1 == n))
        return F.when(F.size(F.array_distinct(e.getField("key"))) == F.size(e), e).otherwise(let(e.getField("key"), last_of_key))

    return let(entries, kept)


def unique_map(entries: Column) -> Column:
    """Map of entries where a repeated key keeps its last value."""
    return F.map_from_entries(dedup_last(entries))


def entries_json(entries: Column, unique: bool = False) -> Column:
    """JSON object text of entries, keys sorted (stable document text).

    ``unique`` skips the dedup for arrays already holding one entry per key.
    """
    kept = entries if unique else dedup_last(entries)
    return F.to_json(F.map_from_entries(F.array_sort(kept)))


def kv_pairs(text: Column, sep: str) -> Column:
    """Pieces of ``text`` between ``sep`` that split on ``=`` into exactly two
    parts under JVM ``split`` rules (trailing ``=`` ignored, leading empty
    key kept), as untrimmed ``(key, value)`` entries in text order.

    One regex pass instead of split -> split -> filter: a piece is
    ``key=value`` followed only by ``=`` signs, key and value free of
    ``sep`` and ``=``, value non-empty.
    """
    s = re.escape(sep)
    pattern = F.lit(f"(?:^|{s})([^={s}]*)=([^={s}]+)=*(?={s}|\\z)")
    keys = F.regexp_extract_all(text, pattern, 1)
    values = F.regexp_extract_all(text, pattern, 2)
    return F.arrays_zip(keys.alias("key"), values.alias("value"))

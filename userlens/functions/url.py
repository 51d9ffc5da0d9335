"""URL pieces of a ``url`` payload attribute, as native columns.

Acceptance follows the JVM's URL class: absolute ``http``/``https``/``ftp``/``file`` URLs, with or
without an authority; a port must be a number (or empty), a bracketed IPv6 host must be closed;
any other value makes the attribute emit nothing. Query parameters are read from the raw text
between the first and second ``?`` with no percent-decoding, so a ``#fragment`` stays in the
last value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .entries import empty_entries, entries_json, entry, kv_pairs, let, unique_map
from .text import java_split, jtrim

# URL shapes accepted and the pieces extracted from them.
SCHEME = r"(?i)^(?:https?|ftp|file):"
AUTHORITY = r"(?i)^(?:https?|ftp|file)://([^/?#]*)"
# user info, host (an IPv6 address keeps its brackets), port
HOST_PORT = r"^(?:[^@]*@)?(\[[0-9A-Fa-f:.%]*\]|[^:\[\]]*)(?::([+]?[0-9]*))?\z"
NOT_PLAIN = r"[:@\[\]]"
PATH_PATTERN = r"(?i)^(?:https?|ftp|file):(?://[^/?#]*)?([^?#]*)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _authority(u: Column) -> Column:
    return F.regexp_extract(jtrim(u), AUTHORITY, 1)


def url_ok(u: Column | str) -> Column:
    u = _col(u)

    def good(a: Column) -> Column:
        port = F.regexp_extract(a, HOST_PORT, 2)
        return a.rlike(HOST_PORT) & ((port == "") | port.try_cast("int").isNotNull())

    return F.coalesce(jtrim(u).rlike(SCHEME) & let(_authority(u), good), F.lit(False))


def url_domain(u: Column | str) -> Column:
    return F.regexp_extract(_authority(_col(u)), HOST_PORT, 1)


def url_path(u: Column | str) -> Column:
    """Path with each ``//`` replaced by ``/`` in one left-to-right pass."""
    return F.regexp_replace(F.regexp_extract(jtrim(_col(u)), PATH_PATTERN, 1), "//", "/")


def url_domain_path(u: Column | str) -> dict[str, Column]:
    """``domain`` and ``path``; both null when the URL is not parsable."""
    ok = url_ok(u)
    return {"domain": F.when(ok, url_domain(u)), "path": F.when(ok, url_path(u))}


def query_text(u: Column | str) -> Column:
    """Text between the first and second ``?`` ('' when there is none)."""
    return F.regexp_extract(_col(u), r"^[^?]*\?([^?]*)", 1)


def raw_query_pairs(u: Column | str) -> Column:
    """``array<struct<key,value>>`` of the params with exactly one ``=``."""
    return kv_pairs(query_text(u), "&")


def rename_pairs(ps: Column | str, es_ps: Column | str) -> Column:
    """Comma lists zipped into ``array<struct<ps,es>>``, cut at the shorter list."""
    a = java_split(_col(ps), ",")
    b = java_split(_col(es_ps), ",")
    n = F.least(F.size(a), F.size(b))
    zipped = F.arrays_zip(a.alias("ps"), b.alias("es"))
    return F.slice(zipped, 1, n)


def compiled_renames(ps: Column | str, es_ps: Column | str) -> Column:
    """``map<string,string>`` from a parameter's name to its new one. A name listed twice takes its
    last target; names with a blank target are left out."""
    entries = F.transform(rename_pairs(ps, es_ps), lambda r: entry(r["ps"], r["es"]))
    return F.map_filter(unique_map(entries), lambda _, es: jtrim(es) != "")


def params_by(u: Column | str, renames: Column) -> Column:
    """Query parameters whose name is a key of ``renames``, under their new names, in query order."""
    known = F.filter(raw_query_pairs(u), lambda p: F.map_contains_key(renames, p["key"]))
    return F.transform(known, lambda p: entry(F.element_at(renames, p["key"]), p["value"]))


def renamed_query_params(u: Column | str, ps: Column | str, es_ps: Column | str) -> Column:
    """Params whose name is listed in ``ps``, renamed to the matching ``es_ps``.

    A name listed twice takes its last target; blank targets are dropped.
    Result: ``array<struct<key,value>>`` in query order.
    """
    # the renames are compiled once per URL, not once per parameter
    return let(compiled_renames(ps, es_ps), lambda renames: params_by(u, renames))


def url_entries(u: Column | str, renames: Column) -> Column:
    """Entries that a ``url`` attribute writes: domain, path, renamed params; null unless the URL is parsable.
    The authority is cut out once for the check and the domain."""
    u = _col(u)

    def fields(a: Column) -> Column:
        plain = ~a.rlike(NOT_PLAIN)  # an authority that is its host, the common case
        port = F.regexp_extract(a, HOST_PORT, 2)
        ok = jtrim(u).rlike(SCHEME) & (plain | (a.rlike(HOST_PORT) & ((port == "") | port.try_cast("int").isNotNull())))
        domain = F.when(plain, a).otherwise(F.regexp_extract(a, HOST_PORT, 1))
        params = F.when(F.contains(u, F.lit("?")), params_by(u, renames)).otherwise(empty_entries())
        return F.when(ok, F.concat(F.array(entry(F.lit("domain"), domain), entry(F.lit("path"), url_path(u))), params))

    return let(_authority(u), fields)


def url_fields_map(u: Column | str, ps: Column | str, es_ps: Column | str) -> Column:
    """Those entries as JSON text (sorted keys, last write wins); null when
    the URL is not parsable."""
    entries = let(compiled_renames(ps, es_ps), lambda renames: url_entries(u, renames))
    return let(entries, lambda e: F.when(e.isNotNull(), entries_json(e)))

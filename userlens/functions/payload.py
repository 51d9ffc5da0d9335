"""Event-payload columns: the ``eventcontent`` document of a behaviour log.

The payload is a ``map<string,string>`` built in three steps, all with
higher-order functions over entry arrays (no UDF, no explode/regroup):

1. ``source_text``: the raw content; for ``ios`` rows the ``{k=v;...}`` text is
   first turned into a JSON object.
2. ``payload_entries``: the source parsed as a JSON object (duplicates kept).
3. ``mapped_fields``: over the parsed map (one value per key), for every
   mapping attribute of the event whose name is a
   payload key (trimmed, lower-cased) and whose platform gate passes, the
   derived fields (``string`` -> one field, ``url`` -> domain/path/params).
   The mapping comes compiled (``compiled_rules``): gates resolved per platform
   and renames as maps, once per action on the small side of the lookup.

``merge_payload`` writes ``source`` first, then the derived fields in
ascending attribute order; a later write of the same field wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .entries import dedup_last, empty_entries as _empty_entries, entries_json, entry as _entry, kv_pairs, let, unique_map
from .text import is_blank, jtrim
from .url import compiled_renames, url_entries

MAPPING_ATTR_TYPE = ("array<struct<attribute:string,target_attribute:string,datatype:string,"
                     "ps:string,es_ps:string,plateform:string>>")
JSON_OPTIONS = {"allowUnquotedFieldNames": "true"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ios_pairs(content: Column | str) -> Column:
    """``{a=1; b=2}`` text to key/value entries.

    Braces and tabs are deleted, ``;`` becomes ``,``; pieces split on ``,`` and
    then ``=`` (JVM split: trailing empties dropped); only pieces with exactly
    two parts count; both parts are trimmed; the last duplicate wins.
    """
    cleaned = F.translate(_col(content), ";{}\t", ",")
    trimmed = F.transform(kv_pairs(cleaned, ","), lambda e: _entry(jtrim(e["key"]), jtrim(e["value"])))
    return dedup_last(trimmed)


def wrap_source(source: Column | str) -> Column:
    """The payload before any derived field: ``{"source": <text>}`` as JSON text."""
    return F.to_json(F.create_map(F.lit("source"), _col(source)))


def source_text(plateform: Column | str, content: Column | str) -> Column:
    """The ``source`` text: iOS pairs as JSON when any pair exists, else raw."""
    content = _col(content)
    pairs = ios_pairs(content)
    is_ios = F.coalesce(_col(plateform) == F.lit("ios"), F.lit(False)) & ~is_blank(content)
    return F.when(is_ios & (F.size(pairs) > 0), entries_json(pairs, unique=True)).otherwise(content)


def parse_payload(source: Column | str) -> Column:
    """JSON object text to ``map<string,string>``; null unless the whole text is one object.

    The reader stops after the first value, so the text is read as the one
    element of an array: text after the object then makes the array broken or
    longer, and both count as no object.
    """
    one = F.from_json(F.concat(F.lit("["), _col(source), F.lit("]")), "array<map<string,string>>", JSON_OPTIONS)
    return let(one, lambda a: F.when(F.size(a) == 1, F.get(a, 0)))


def payload_entries(source: Column | str) -> Column:
    """Entries of the parsed payload (duplicate keys kept); empty when absent."""
    return F.coalesce(F.map_entries(parse_payload(source)), _empty_entries())


def payload_map(source: Column | str) -> Column:
    """Parsed payload as a map with unique keys (a repeated key keeps its
    last value, like the JSON reader of the jobs); empty when absent."""
    return unique_payload(parse_payload(source))


def unique_payload(parsed: Column) -> Column:
    """A parsed payload map with unique keys: itself when its keys are
    already distinct (the common case, a native check), else deduplicated
    keeping the last value; empty when the payload was not an object."""
    distinct = F.size(F.array_distinct(F.map_keys(parsed))) == F.size(parsed)
    empty = F.create_map().cast("map<string,string>")
    return (F.when(parsed.isNull(), empty)
            .when(distinct, parsed)
            .otherwise(unique_map(F.map_entries(parsed))))


def attribute_value(payload: Column, attribute: Column) -> Column:
    """Value re-read by the normalised key: '' when absent.

    A JSON ``null`` value stays null (the attribute then emits nothing).
    """
    return F.when(F.map_contains_key(payload, attribute), F.element_at(payload, attribute)).otherwise(F.lit(""))


def normalized_keys(payload: Column) -> Column:
    return F.array_distinct(F.transform(F.map_keys(payload), lambda k: F.lower(jtrim(k))))


RULE_TYPE = "array<struct<attribute:string,target:string,renames:map<string,string>>>"


def compiled_rules(attrs: Column | str) -> Column:
    """An event's mapping array (sorted by attribute) as rules that a log row only looks up.

    A rule is an attribute with its target field (``string``) or its compiled renames (``url``);
    attributes that can emit nothing have none. ``named`` holds the rules of each platform that
    an attribute names (with those for ``all``), ``other`` those of every other platform. Platforms
    are compared without case.
    """
    def rules(kept: Column) -> Column:
        def of(platform: Column | None) -> Column:
            mine = lambda a: (a["gate"] == "all") if platform is None else (a["gate"] == "all") | (a["gate"] == platform)
            return F.transform(F.filter(kept, mine), lambda a: F.struct(a["attribute"], a["target"], a["renames"]))
        platforms = F.filter(F.array_distinct(kept.getField("gate")), lambda p: p != "all")
        named = F.map_from_entries(F.transform(platforms, lambda p: F.struct(p, of(p))))
        return F.struct(named.alias("named"), of(None).alias("other"))

    def rule(a: Column) -> Column:
        return F.struct(a["attribute"].alias("attribute"), F.when(a["datatype"] == "string", a["target_attribute"]).alias("target"),
                        F.when(a["datatype"] == "url", compiled_renames(a["ps"], a["es_ps"])).alias("renames"),
                        F.lower(a["plateform"]).alias("gate"))

    all_rules = F.transform(F.coalesce(_col(attrs), F.array().cast(MAPPING_ATTR_TYPE)), rule)
    usable = F.filter(all_rules, lambda r: r["gate"].isNotNull() & (r["target"].isNotNull() | r["renames"].isNotNull()))
    return let(usable, rules)


def gate_by_platform(rules: Column | str, plateform: Column | str) -> Column:
    """The rules that apply to an event of a platform (null rules: none)."""
    rules = _col(rules)
    named = F.try_element_at(rules["named"], F.lower(_col(plateform)))
    return F.coalesce(named, rules["other"], F.array().cast(RULE_TYPE))


def rule_fields(rule: Column, value: Column) -> Column:
    """Entries of one rule and its value: one field, or domain, path and parameters of a URL. A null value or a
    URL that does not parse emits nothing (the attribute fails alone)."""
    fields = F.when(rule["target"].isNotNull(), F.array(_entry(rule["target"], value))).otherwise(url_entries(value, rule["renames"]))
    return F.when(value.isNull() | fields.isNull(), _empty_entries()).otherwise(fields)


def mapped_fields(payload: Column, rules: Column | str, plateform: Column | str,
                  keys: Column | str | None = None) -> Column:
    """Derived fields of all applicable mapping attributes, in apply order.

    ``rules`` is the event's ``compiled_rules`` (null when the event has no mapping). ``keys`` may
    name a column that already holds ``normalized_keys(payload)``: inside the per-rule lambda an
    inline expression would be rebuilt for every rule.
    """
    keys = _col(keys) if keys is not None else normalized_keys(payload)

    def derived(gated: Column) -> Column:
        present = F.filter(gated, lambda r: F.array_contains(keys, r["attribute"]))
        # The value is looked up once for each rule, not by every piece of its fields.
        return F.flatten(F.transform(present, lambda r: let(attribute_value(payload, r["attribute"]), lambda v: rule_fields(r, v))))

    return let(gate_by_platform(rules, plateform), derived)


def merge_payload(source: Column | str, derived: Column) -> Column:
    """``source`` plus derived fields as one map; later writes win."""
    source = _col(source)
    head = F.when(source.isNotNull(), F.array(_entry(F.lit("source"), source))).otherwise(_empty_entries())
    return unique_map(F.concat(head, derived))


def _with_pairs(df: DataFrame, plateform: str, content: str, pairs: str | None = None) -> DataFrame:
    """Add ``__pairs``: the iOS pairs of iOS rows with some pair, else null; computed once, and only
    for iOS rows (or taken from the column ``pairs`` when given)."""
    c = F.col(content)
    is_ios = F.coalesce(F.col(plateform) == F.lit("ios"), F.lit(False)) & ~is_blank(c)
    d = df.withColumn("__pairs", F.when(is_ios, F.col(pairs) if pairs else ios_pairs(content)))
    return d.withColumn("__pairs", F.when(F.size("__pairs") > 0, F.col("__pairs")))


def _pairs_or_content(content: str) -> Column:
    return F.when(F.col("__pairs").isNotNull(), entries_json(F.col("__pairs"), unique=True)).otherwise(F.col(content))


def with_source_text(df: DataFrame, plateform: str, content: str, out: str,
                     pairs: str | None = None) -> DataFrame:
    """Add ``out`` = ``source_text``; the iOS pairs are computed once, and
    only for iOS rows (or taken from the column ``pairs`` when given)."""
    return _with_pairs(df, plateform, content, pairs).withColumn(out, _pairs_or_content(content)).drop("__pairs")


def with_event_payload(df: DataFrame, plateform: str = "plateform", content: str = "eventcontent",
                       attrs: str = "attrs", out: str = "eventcontent", rules: str | None = None) -> DataFrame:
    """Add ``out``: the full ``eventcontent`` map of each log row.

    Staged projections (source text, parsed entries, derived fields, merge)
    so every intermediate is computed once per row and stays in codegen. ``rules`` names a
    column of ``compiled_rules``; without it they are compiled from ``attrs`` here, per row.
    """
    d = _with_pairs(df, plateform, content).withColumn("__src", _pairs_or_content(content))
    d = d.withColumn("__rules", F.col(rules) if rules else compiled_rules(attrs))
    # The pairs are what their JSON text would be read back as.
    d = d.withColumn("__parsed", F.when(F.col("__pairs").isNotNull(), F.map_from_entries("__pairs")).otherwise(parse_payload("__src")))
    d = d.withColumn("__ents", unique_payload(F.col("__parsed")))
    d = d.withColumn("__keys", normalized_keys(F.col("__ents")))
    d = d.withColumn("__derived", mapped_fields(F.col("__ents"), "__rules", plateform, "__keys"))
    d = d.withColumn(out, merge_payload("__src", F.col("__derived")))
    return d.drop("__pairs", "__src", "__rules", "__parsed", "__ents", "__keys", "__derived")


def payload_json(payload: Column | str) -> Column:
    """Map to JSON text with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(_col(payload)))))

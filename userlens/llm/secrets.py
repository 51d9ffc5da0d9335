"""Secret scans by an incremental blob ledger, with DataFrame functions only.

Every version of every path is content-addressed (SHA-256 of its text). The ledger is a Parquet
table of (blob, rules, spans); a run groups the versions by blob, scans only blobs that the ledger
has not got for this version of the rules, appends them, and joins the findings back to all paths.
A text is thus scanned once however many paths or runs have it. Blobs are grouped by partial
aggregation, so a group of copies shrinks before the shuffle; the join back carries no text, and
Spark may split its hot blobs.

A span is found from the text's pieces: ``regexp_extract_all`` gives the leftmost non-overlapping
matches, ``split`` what lies between, and running lengths the places in code points, end
exclusive. Matches that are too short are dropped after matching, as they use up their text.

Defined results: a null text is the empty text, which has no findings; repeated rows each get
their blob's findings; a null id stays; an empty table gives an empty table; other columns,
whatever their names, are not looked at (``redact`` keeps them).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import let
from .shared import written


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int  # whose length counts
    least: int
    hint: str  # a text without it has no match; "" for none


# The three base rules, in their order.
BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ""),
    Rule("access", r"(AKIA[A-Z0-9]+)", 1, 20, "AKIA"),
    # The same spans as [0-9a-f]+ of 24 or more: a maximal run is matched from its start.
    Rule("hex", r"([0-9a-f]{24,})", 1, 24, ""),
]
#: What may lie between the lines of a key: blanks, quotes, comment signs and escaped newlines.
_BETWEEN = r"""(?:[\s"'>#*,|]|\\[nrt])*+"""
# A private key from its BEGIN line to its END line; without an END line, its header fields and
# base64 lines, and a last line that is short. Possessive groups, as others recurse in the matcher.
PEM = (r"(-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:(?!-----)[\s\S])*+-----END [A-Z ]*PRIVATE KEY-----"
       rf"|(?:{_BETWEEN}(?:Proc-Type|DEK-Info): [A-Za-z0-9,-]++)*+(?:{_BETWEEN}[A-Za-z0-9+/]{{16,}}+={{0,2}}+)++"
       rf"(?:{_BETWEEN}[A-Za-z0-9+/]++(?:={{1,2}}+|(?=[\x20\t\r]*(?:\n|\z))))?+|))")
ADDED = [
    Rule("github", r"(gh[pousr]_[A-Za-z0-9]+)", 1, 40, "gh"),
    Rule("jwt", r"(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 1, 20, "eyJ"),
    Rule("pem", PEM, 1, 0, "PRIVATE KEY"),
]
RULES = BASE + ADDED
RULES_VERSION = "1.2"  # PEM spans take in the key, however long
SPAN = "struct<start:int,rule:int,end:int,kind:string>"
MASK = "[REDACTED]"


def blocks_of(values: Column) -> Column:
    """An array cut into blocks of about the square root of its size."""
    def cut(v: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(v))).cast("int")
        return let(size, lambda b: F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / b).cast("int") - 1), lambda k: F.slice(v, k * b + 1, b)))
    return let(values, cut)


def running(values: Column, plus: Callable[[Column, Column], Column]) -> Column:
    """``plus`` of all values before each of a non-empty array of ints, starting from 0: within the blocks, from the
    result over the blocks before."""
    def over(v: Column, first: Column) -> Column:
        none = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(v, none, lambda acc, x: F.struct(plus(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    def by_block(blocks: Column) -> Column:
        whole = F.transform(blocks, lambda v: F.aggregate(v, F.lit(0), plus))
        return F.flatten(F.zip_with(blocks, over(whole, F.lit(0)), over))

    return let(blocks_of(values), by_block)


def _spans_of(text: Column, no: int, rule: Rule) -> Column:
    none = F.array().cast(f"array<{SPAN}>")
    pattern = F.lit(rule.pattern)

    def place(found: Column) -> Column:
        gaps, match, body = found["gaps"], found["match"], found["body"]

        def spans(at: Column) -> Column:
            each = F.transform(at, lambda x, i: let(x + F.length(F.get(gaps, i)), lambda start: F.struct(
                start.alias("start"), F.lit(no).alias("rule"), (start + F.length(F.get(match, i))).alias("end"), F.lit(rule.kind).alias("kind"))))
            return F.filter(each, lambda _, i: F.length(F.get(body, i)) >= rule.least)

        return let(running(F.transform(match, lambda m, i: F.length(m) + F.length(F.get(gaps, i))), lambda x, y: x + y), spans)

    def some(match: Column) -> Column:
        found = F.struct(F.split(text, rule.pattern, -1).alias("gaps"), match.alias("match"), F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("body"))
        return F.when(F.size(match) == 0, none).otherwise(let(found, place))

    spans = let(F.regexp_extract_all(text, pattern, F.lit(0)), some)
    return F.when(F.contains(text, F.lit(rule.hint)), spans).otherwise(none) if rule.hint else spans


def find_spans(text: Column, rules: list[Rule] = RULES) -> Column:
    """All spans of a text, by start, then rule, as an array of structs."""
    return F.array_sort(reduce(lambda a, b: F.concat(a, b), [_spans_of(text, n, r) for n, r in enumerate(rules)]))


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def _blob(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger, or None where there is no such table yet; any other failure is raised."""
    try:
        return spark.read.schema(f"blob binary, rules string, spans array<{SPAN}>").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def ledger_path(spark: SparkSession) -> str | None:
    """The ledger that the session names, kept from run to run; None for none."""
    return spark.conf.get("spark.userlens.ledger", None)


def scan_versions(docs: DataFrame, ledger: str | None = None, rules: list[Rule] = RULES, version: str = RULES_VERSION) -> DataFrame:
    """(blob, spans) for every blob of ``docs`` with findings. ``ledger`` is the path of the ledger,
    which gains the blobs scanned now; without it nothing counts as seen."""
    spark = docs.sparkSession
    versions = docs.select(_blob(_text(docs)).alias("blob"), _text(docs).alias("body"))
    known = read_ledger(spark, ledger) if ledger else None
    if known is not None:
        versions = versions.join(known.filter(F.col("rules") == version).select("blob"), "blob", "left_anti")
    unseen = versions.groupBy("blob").agg(F.first("body").alias("body"))
    new = unseen.select("blob", F.lit(version).alias("rules"), find_spans(F.col("body"), rules).alias("spans"))
    if ledger:
        new.write.mode("append").parquet(ledger)
        found = read_ledger(spark, ledger).filter(F.col("rules") == version)
    else:
        found = written(new, "findings")
    # A run that was repeated after a partial append may have left a blob twice.
    return found.filter(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])


def findings(docs: DataFrame, ledger: str | None = None, rules: list[Rule] = RULES, version: str = RULES_VERSION) -> DataFrame:
    """doc_id and spans of every row of ``docs``: the blob's findings at each of its paths."""
    found = scan_versions(docs, ledger, rules, version)
    paths = docs.select("doc_id", _blob(_text(docs)).alias("blob"))
    none = F.array().cast(f"array<{SPAN}>")
    return paths.join(found, "blob", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with ``mask`` for every run of overlapping spans (some, sorted by start)."""
    def kept(reach: Column) -> Column:
        """Pieces (from, to) before each run: a span begins one unless an earlier span reaches beyond its start."""
        both = F.zip_with(reach, spans, lambda a, s: F.struct(a.alias("a"), s["start"].alias("b")))
        last = F.struct(F.array_max(F.transform(spans, lambda s: s["end"])).alias("a"), F.length(text).alias("b"))
        return F.concat(F.filter(both, lambda p: p["b"] >= p["a"]), F.array(last))

    def cut(block: Column) -> Column:
        first, last = F.get(block, 0), F.element_at(block, -1)
        part = F.substring(text, first["a"] + 1, last["b"] - first["a"])
        return let(part, lambda t: F.transform(block, lambda p: F.substring(t, p["a"] - first["a"] + 1, p["b"] - p["a"])))

    pieces = let(running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y)), kept)
    return F.array_join(F.flatten(F.transform(blocks_of(pieces), cut)), mask)


def redact(docs: DataFrame, ledger: str | None = None, mask: str = MASK, rules: list[Rule] = RULES, version: str = RULES_VERSION) -> DataFrame:
    """``docs``, all columns, with ``mask`` for every run of overlapping spans. ``n_chars``, where it is
    a column, follows the text."""
    found = scan_versions(docs, ledger, rules, version).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    rows = docs.withColumn("__key", _blob(_text(docs))).join(found, F.col("__key") == F.col("__blob"), "left")

    clean = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(_masked(F.col("text").cast("string"), F.col("__spans"), mask))
    rows = rows.withColumn("__clean", clean)
    fix = {"text": F.col("__clean"), "n_chars": F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("__clean")) if "n_chars" in docs.columns else None}
    return rows.select(*[fix[c].cast(docs.schema[c].dataType).alias(c) if c in fix else F.col(f"`{c}`") for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """The findings (doc_id, spans) with counts of the base kinds and both lists as text."""
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["rule"] < len(BASE))
    return found.select("doc_id", *[n(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

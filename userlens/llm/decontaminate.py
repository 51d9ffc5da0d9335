"""Benchmark decontamination: a set of normalised test n-grams, held by every task, is looked up
at the windows of all training texts; verified hits mark words, spans and documents.

Words are runs of characters other than ASCII non-alphanumerics, A-Z lower-cased. A window is
``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window.

Only DataFrame functions run here. The work per document stays in its row: the text is split
once, positions whose word is the anchor of some window (its longest word, so rare in running
text) are found by hash set lookup, and only round these is a window put together and looked
up. The set holds the windows' words themselves, so a hit is exact. A join on the window then
names the items.

The set is sent with the plan, at most ``MAX_WINDOWS`` windows at a time. A larger benchmark
is cut into blocks of items by that bound and the documents are scanned once per block.

Defined results: a null text has no words; an item without words has no window; repeated items
count as items each under their own id, rows of one id and different texts as one item; repeated
documents are judged one by one; an empty benchmark marks nothing; an empty table gives an
empty table; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
MAX_WINDOWS = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Everything in ASCII but digits and letters (upper case has been lowered before).
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The normalised words of a text, none for null."""
    return F.filter(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), BREAK), lambda w: w != "")


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once for a row, however often it is used."""
    return F.transform(F.array(value), then)[0]


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, gram, n, anchor, at): each window's words joined by blanks, their number,
    the longest word (the first in order among equals) and its place in the window."""
    items = benchmark.select(F.col("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0)) + 1
    grams = items.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.slice(F.col("w"), i, window))).alias("g"))
    place = F.array_min(F.transform("g", lambda x, i: F.struct((-F.length(x)).alias("n"), x.alias("x"), i.alias("i"))))
    return grams.select("item_id", F.array_join("g", " ").alias("gram"), F.size("g").alias("n"), place["x"].alias("anchor"), place["i"].alias("at")).distinct()


def _blocks(grams: DataFrame, most: int) -> list[list]:
    """The distinct windows, as the driver's blocks of at most ``most``."""
    out: list[list] = []
    for r in grams.select("gram", "n", "anchor", "at").distinct().toLocalIterator():
        if not out or len(out[-1]) >= most:
            out.append([])
        out[-1].append(r)
    return out


def _places(w: Column, block: list) -> Column:
    """The windows of ``w`` that are in the block: structs of start (0-based), n and gram."""
    anchors = sorted({r["anchor"] for r in block})
    grams = sorted({r["gram"] for r in block})
    shapes = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(at).alias("at")) for n, at in sorted({(r["n"], r["at"]) for r in block})])
    spots = F.filter(F.transform(w, lambda x, i: F.when(x.isin(anchors), i)), lambda i: i.isNotNull())
    tried = F.flatten(F.transform(spots, lambda i: F.transform(shapes, lambda s: F.struct((i - s["at"]).alias("start"), s["n"].alias("n")))))
    inside = F.filter(F.array_distinct(tried), lambda s: (s["start"] >= 0) & (s["start"] + s["n"] <= F.size(w)))
    named = F.transform(inside, lambda s: F.struct(s["start"].alias("start"), s["n"].alias("n"), F.array_join(F.slice(w, s["start"] + 1, s["n"]), " ").alias("gram")))
    return F.filter(named, lambda s: s["gram"].isin(grams))


def _hits(w: Column, blocks: list[list]) -> Column:
    if not blocks:
        return F.array().cast("array<struct<start:int,n:int,gram:string>>")
    parts = [_places(w, b) for b in blocks]
    return parts[0] if len(parts) == 1 else F.array_distinct(reduce(lambda a, b: F.concat(a, b), parts))


def _spans(hit: Column) -> Column:
    """Hits (start, n, ...) as sorted disjoint runs of words [a, b)."""
    empty = F.array().cast("array<struct<a:int,b:int>>")
    bounds = F.array_sort(F.transform(hit, lambda s: F.struct(s["start"].alias("a"), (s["start"] + s["n"]).alias("b"))))
    return F.aggregate(bounds, empty, lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["b"] >= s["a"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["a"].alias("a"), F.greatest(F.element_at(acc, -1)["b"], s["b"]).alias("b")))),
    ).otherwise(F.concat(acc, F.array(s))))


def _n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["b"] - s["a"])


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = MAX_WINDOWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items (sorted as strings),
    items_sha256, spans (runs of hit words, [a, b) in words), contaminated."""
    grams = windows(benchmark, window)
    blocks = _blocks(grams, most)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _hits(w, blocks).alias("s"))).alias("x"))
    rows = rows.select("doc_id", "row", F.col("x.n_words").alias("n_words"), F.col("x.s").alias("s"))
    rows = rows.select("doc_id", "row", "n_words", "s", _spans(F.col("s")).alias("spans"))
    # A document without hits is one row with a null window; its number keeps such rows apart in
    # a join that is shuffled.
    each = (rows.select("doc_id", "row", "n_words", "spans", F.explode_outer(F.array_distinct(F.transform("s", lambda s: s["gram"]))).alias("gram"))
            .withColumn("k", F.when(F.col("gram").isNull(), F.col("row")).otherwise(F.xxhash64("gram"))))
    named = each.join(grams.select("item_id", "gram", F.xxhash64("gram").alias("k")), ["k", "gram"], "left")
    whole = named.groupBy("row", "doc_id").agg(F.first("n_words").alias("n_words"), F.first("spans").alias("spans"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    return (whole.withColumn("items", F.array_sort("items")).withColumn("n_hit", _n_hit(F.col("spans")))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "spans", (F.col("n_hit") > 0).alias("contaminated")))


def remove_documents(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.0, window: int = WINDOW, most: int = MAX_WINDOWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose share of hit words is at most ``max_share``. Narrow."""
    blocks = _blocks(windows(benchmark, window), most)
    keep = let(words(F.col("text")), lambda w: let(_hits(w, blocks), lambda s: (F.size(s) == 0) | (_n_hit(_spans(s)) / F.size(w) <= max_share)))
    return docs.filter(keep)


def remove_spans(docs: DataFrame, benchmark: DataFrame, mask: str = "", window: int = WINDOW, most: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` with each run of hit words cut out of the text, with what lies between them (``mask``
    in its place). The rest is kept as it is; a text without hits is unchanged."""
    blocks = _blocks(windows(benchmark, window), most)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The text is gap, word, gap, word, ..., gap.
    gaps = F.split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    raw = F.filter(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda x: x != "")

    def cut(p: Column) -> Column:
        gap, word, run = p["gap"], p["word"], p["run"]
        piece = F.transform(word, lambda x, i: F.when(F.exists(run, lambda s: i == s["a"]), F.concat(F.get(gap, i), F.lit(mask)))
                            .when(F.exists(run, lambda s: (i > s["a"]) & (i < s["b"])), F.lit("")).otherwise(F.concat(F.get(gap, i), x)))
        return F.concat(F.array_join(piece, ""), F.coalesce(F.get(gap, F.size(word)), F.lit("")))

    runs = let(words(F.col("text")), lambda w: _spans(_hits(w, blocks)))
    clean = let(runs, lambda run: F.when(F.size(run) == 0, F.col("text")).otherwise(
        let(F.struct(gaps.alias("gap"), raw.alias("word"), run.alias("run")), cut)))
    return docs.withColumn("text", clean)

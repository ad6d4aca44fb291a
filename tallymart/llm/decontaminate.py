"""Benchmark passages in documents, by a prefix-filtered set join.

An item is cut into windows of ``width`` words; a window is a sequence of word shingles.  A document
that holds a window whole must hold its rarest shingle, so that one shingle is the window's necessary
prefix.  Shingles are ordered by their number of occurrences in all documents; candidates come from the
prefix alone, pass the bounds on position and length, and are verified word by word.

DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.storage import landed

#: What parts words, after lower-casing A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of (long, long, ...) up to which a measured side is broadcast; about 40 MB.
BROADCAST_ROWS = 500_000


def word_array(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, GAP), "")


def shingle_array(words: Column, k: int) -> Column:
    """Hashes of the shingles of ``k`` words, by position; empty where there are fewer words."""
    at = F.sequence(F.lit(1), F.size(words) - (k - 1))
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.element_at(words, i + j) for j in range(k)]))
    return F.when(F.size(words) >= k, hashed).otherwise(F.array().cast("array<bigint>"))


def if_small(df: DataFrame) -> DataFrame:
    """A written table, broadcast if its counted rows are few; otherwise the join is Spark's choice."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """``(item, win, m)``: an item's windows as their words joined by a space, and their length."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), word_array(F.col("text")).alias("w"))
    items = items.filter(F.size("w") > 0).withColumn("m", F.least(F.size("w"), F.lit(width)))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("at")
    return items.select("item", "w", "m", at).select(
        "item", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("win"), "m"
    )


def occurrences(documents: DataFrame, benchmark: DataFrame, width: int = 10, shingle: int = 5) -> tuple[DataFrame, DataFrame]:
    """(hits, windows): ``hits(doc_id, h, start, m, win)`` says where a window occurs in the document.

    ``h`` is a hash of the text, since ``doc_id`` alone may repeat; ``windows(win, item)`` tells the
    items of a window.  Both are written tables.
    """
    windows = landed(item_windows(benchmark, width), "windows")
    kinds = windows.select("win", "m").distinct().withColumn("w", F.split("win", " "))
    parts = [
        kinds.filter(F.least("m", F.lit(shingle)) == k).select(
            "win", "m", F.posexplode(shingle_array(F.col("w"), k)).alias("off", "sh"), F.lit(k).alias("k")
        )
        for k in range(1, shingle + 1)
    ]
    tokens = landed(_union(parts), "tokens")
    wanted = if_small(landed(tokens.select("sh", "k").distinct(), "wanted"))
    texts = documents.select("doc_id", F.xxhash64("text").alias("h"), word_array(F.col("text")).alias("w"))
    found = []
    for k in sorted(r.k for r in tokens.select("k").distinct().collect()):  # at most ``shingle`` values
        spread = texts.select("doc_id", "h", "w", F.posexplode(shingle_array(F.col("w"), k)).alias("pos", "sh"))
        first = F.greatest(F.col("pos") - (width - k), F.lit(0))
        found.append(
            spread.join(wanted.filter(F.col("k") == k), "sh").select(
                "doc_id", "h", "pos", "sh", "k", first.alias("first"),
                F.slice("w", first + 1, F.col("pos") - first + width).alias("near"),
            )
        )
    if not found:
        empty = texts.select("doc_id", "h", F.lit(0).alias("start"), F.lit(0).alias("m"), F.lit("").alias("win")).limit(0)
        return empty, windows.select("win", "item").distinct()
    postings = landed(_union(found), "postings")
    rarity = postings.groupBy("sh", "k").agg(F.count("*").alias("n"))
    prefixes = (
        tokens.join(rarity, ["sh", "k"], "left")
        .groupBy("win", "m", "k")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "sh")).alias("rarest"))
        .filter("rarest.n > 0")
        .select("win", "m", "k", "rarest.off", "rarest.sh")
    )
    start = F.col("pos") - F.col("off")
    candidates = postings.join(if_small(landed(prefixes, "prefixes")), ["sh", "k"]).withColumn("start", start)
    inside = (F.col("start") >= F.col("first")) & (F.col("start") - F.col("first") + F.col("m") <= F.size("near"))
    same = F.array_join(F.slice("near", F.col("start") - F.col("first") + 1, F.col("m")), " ") == F.col("win")
    hits = candidates.filter(inside).filter(same).select("doc_id", "h", "start", "m", "win")
    return landed(hits, "hits"), windows.select("win", "item").distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"])


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = 10, shingle: int = 5) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per document row.

    A word is hit if it lies inside any occurrence of a window; ``n_items`` counts the items with
    occurring windows, and ``items_sha256`` is taken of their ids, sorted as strings and joined by commas.
    An item shorter than ``width`` is one window; an item or document without words (null, empty or
    only signs) has none.  Repeated documents are counted each for itself; items without an id hit
    words but are not listed.  Other columns are ignored.
    """
    hits, items = occurrences(documents, benchmark, width, shingle)
    spans = hits.groupBy("doc_id", "h", "start").agg((F.col("start") + F.max("m")).alias("end"))
    before = Window.partitionBy("doc_id", "h").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    words = spans.select("doc_id", "h", covered.alias("new")).groupBy("doc_id", "h").agg(F.sum("new").alias("n_hit"))
    listed = (
        hits.select("doc_id", "h", "win").distinct().join(items, "win").select("doc_id", "h", "item").distinct()
        .groupBy("doc_id", "h").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    found = words.join(listed, _same_row(words, listed), "left").select(
        words["doc_id"], words["h"], "n_hit", "items"
    )
    rows = documents.select(
        "doc_id", F.xxhash64("text").alias("h"), F.size(word_array(F.col("text"))).cast("long").alias("n_words")
    )
    none = F.array().cast("array<string>")
    return rows.join(found, _same_row(rows, found), "left").select(
        rows["doc_id"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def uncontaminated(documents: DataFrame, benchmark: DataFrame, width: int = 10, shingle: int = 5) -> DataFrame:
    """The rows of ``documents``, all columns, in which no window of ``benchmark`` occurs."""
    hits, _ = occurrences(documents, benchmark, width, shingle)
    bad = if_small(landed(hits.select(F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h")).distinct(), "bad"))
    same = documents["doc_id"].eqNullSafe(bad["hit_id"]) & (F.xxhash64(documents["text"]) == bad["hit_h"])
    return documents.join(bad, same, "left_anti")

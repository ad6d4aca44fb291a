"""SimHash fingerprints of texts, and the search for fingerprints within a Hamming radius.

The terms of a text are its pairs of neighbouring lower-cased words (its one word, if it has no other).
A term's weight is its number of letters, since long words are rare ones.  The 128 bits of a term's hash
vote with its weight for or against each bit of the fingerprint.

The search cuts the bits into blocks.  Two fingerprints at most ``radius`` bits apart agree on all
blocks but ``radius``, so one table for each choice of blocks to leave out, joined on the rest,
finds every such pair.

DataFrame functions only.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 128
_LANES = (1 << 32) + 1  # bit i and bit i + 32 of a hash, summed in one long


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")


def _terms(words: Column, name: int) -> Column:
    """Array of (name, hash, weight); ``words`` is a column of its own, so that texts are split once."""

    def term(*own: Column) -> Column:
        weight = reduce(Column.__add__, [F.length(w) for w in own]).cast("bigint")
        return F.struct(F.lit(name).alias("name"), F.xxhash64(*own).alias("h"), weight.alias("w"))

    pairs = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1), lambda i: term(F.element_at(words, i), F.element_at(words, i + 1))
    )
    return F.when(F.size(words) > 1, pairs).otherwise(F.transform(words, lambda w: term(w)))


def simhash(rows: DataFrame, keys: list[str], texts: dict[str, Column]) -> DataFrame:
    """``keys`` with two longs, ``<name>_hi`` and ``<name>_lo``, for every named text of a row.

    ``keys`` together tell rows apart.  Equal texts have equal fingerprints; a null text and one
    without words have all bits 0.  A bit without a majority is 0.
    """
    split = rows.select(*keys, *[_words(text).alias(f"__{k}") for k, text in enumerate(texts.values())])
    arrays = F.concat(*[_terms(F.col(f"__{k}"), k) for k in range(len(texts))])
    spread = split.select(*keys, F.explode_outer(arrays).alias("t"))
    votes = spread.select(*keys, "t.name", F.col("t.h").alias("h0"), F.xxhash64("t.h").alias("h1"), "t.w")
    sums = [
        F.sum(F.col("w") * F.shiftright(h, i).bitwiseAND(F.lit(_LANES))).alias(f"{h}_{i}")
        for h in ("h0", "h1")
        for i in range(32)
    ]
    summed = votes.groupBy(*keys, "name").agg(F.sum("w").alias("w"), *sums)

    def half(h: str) -> Column:
        low = [(F.col(f"{h}_{i}").bitwiseAND(F.lit((1 << 32) - 1)), i) for i in range(32)]
        high = [(F.shiftrightunsigned(f"{h}_{i}", 32), i + 32) for i in range(32)]
        bits = [F.when(ones * 2 > F.col("w"), F.lit(_signed(1 << i))).otherwise(F.lit(0)) for ones, i in low + high]
        return reduce(Column.bitwiseOR, bits)

    by_name = summed.select(*keys, "name", half("h0").alias("hi"), half("h1").alias("lo"))
    columns = [
        F.coalesce(F.max(F.when(F.col("name") == k, F.col(part))), F.lit(0)).alias(f"{name}_{part}")
        for k, name in enumerate(texts)
        for part in ("hi", "lo")
    ]
    return by_name.groupBy(*keys).agg(*columns)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def hexadecimal(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    """Number of differing bits."""
    return F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))


def likeness(bits: Column) -> Column:
    """Estimated cosine of two texts' weighted terms, cos(pi * share of differing bits), at least 0."""
    return F.greatest(F.lit(0.0), F.cos(bits * (math.pi / BITS)))


def near_pairs(prints: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """``(hi, lo, other_hi, other_lo, bits)``: all pairs of different fingerprints within ``radius``.

    ``prints(hi, lo)`` may repeat; each distinct fingerprint stands for all its documents, so copies
    are not multiplied, and each pair comes once.  Nulls match nothing.
    """
    blocks = blocks or radius + 2
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    tables = []
    for number, out in enumerate(combinations(range(blocks), radius)):
        mask = sum((1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks) if k not in out)
        high, low = _signed(mask >> 64), _signed(mask & ((1 << 64) - 1))
        tables.append(
            F.struct(
                F.lit(number).alias("table"),
                F.col("hi").bitwiseAND(F.lit(high)).alias("a"),
                F.col("lo").bitwiseAND(F.lit(low)).alias("b"),
            )
        )
    distinct = prints.select("hi", "lo").where("hi is not null and lo is not null").distinct()
    left = distinct.select("hi", "lo", F.explode(F.array(*tables)).alias("t")).select("hi", "lo", "t.*")
    right = left.select(F.col("hi").alias("other_hi"), F.col("lo").alias("other_lo"), "table", "a", "b")
    bits = distance(F.col("hi"), F.col("lo"), F.col("other_hi"), F.col("other_lo"))
    ordered = (F.col("hi") < F.col("other_hi")) | ((F.col("hi") == F.col("other_hi")) & (F.col("lo") < F.col("other_lo")))
    found = left.join(right, ["table", "a", "b"]).filter(ordered).select(
        "hi", "lo", "other_hi", "other_lo", bits.alias("bits")
    )
    return found.filter(F.col("bits") <= radius).distinct()


def in_order(documents: DataFrame, ranges: int) -> DataFrame:
    """``documents`` cut into ranges of descending ``doc_id``, each followed by its successor.

    Adds ``range``, ``place`` within it, ``next``, the text after a row's, and ``follows``: true for a row that only repeats the first
    of the next range, at the end.  After the last range comes the first.  Range bounds are ids that
    occur, chosen so that ranges are about even.  Equal ids go by descending text; null ids come last.
    A table without any id has one range without a successor.
    """
    shares = [(k + 1) / ranges for k in range(ranges)]
    got = documents.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0]
    bounds = sorted({*(got or [])})
    marks = F.lit(bounds) if bounds else F.array().cast("array<bigint>")
    own = F.coalesce(F.size(F.filter(marks, lambda b: b < F.col("doc_id"))), F.lit(0))
    rows = documents.withColumns({"range": own, "follows": F.lit(False)})
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("range")))
    if bounds:
        first = documents.filter(F.col("doc_id").isin(bounds))
        follower = first.withColumns({"range": (own + 1) % len(bounds), "follows": F.lit(True)})
        rows = rows.unionByName(follower)
    order = F.col("follows"), F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last()
    along = Window.partitionBy("range").orderBy(*order)
    return rows.withColumns({"place": F.row_number().over(along), "next": F.lead("text").over(along)})


def edited_likeness(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and likeness to those and to the next document.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``,
    one row per row of ``documents(doc_id, text)``; null text is an empty one.  The edited text has its
    last third (rounded down) replaced by as many first characters, or all, of the next document.
    One shuffle moves the texts; other columns are ignored.
    """
    spark = documents.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = in_order(texts, ranges)
    along = Window.partitionBy("range").orderBy("place")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    following = F.coalesce("next", F.lit("")).alias("next")
    rows = rows.select("range", "place", "follows", "doc_id", "text", n.alias("n"), third.alias("third"), following)
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - F.col("third")), F.substring("next", F.lit(1), F.col("third")))
    rows = rows.select(
        "range", "place", "follows", "doc_id", F.col("n").cast("long").alias("n_chars"), "text", edited.alias("edited")
    ).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["range", "place", "follows", "doc_id", "n_chars", "edited_sha256"]
    prints = simhash(rows, keys, {"own": F.col("text"), "edited": F.col("edited")})
    prints = prints.withColumns({f"next_{p}": F.lead(f"own_{p}").over(along) for p in ("hi", "lo")})
    pair = lambda name: (F.col(f"{name}_hi"), F.col(f"{name}_lo"))
    return prints.filter(~F.col("follows")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(*pair("own")).alias("fingerprint"),
        hexadecimal(*pair("edited")).alias("edited_fingerprint"),
        likeness(distance(*pair("own"), *pair("edited"))).alias("near_edited"),
        F.coalesce(likeness(distance(*pair("own"), *pair("next"))), F.lit(0.0)).alias("near_next"),
    )

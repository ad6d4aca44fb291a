"""Shards along a Hilbert curve through several dimensions of the rows' metadata.

Every dimension is quantised to ``bits`` bits; the cell's place on the Hilbert curve orders the rows, so
that rows next to one another are alike in all dimensions, and a shard, a run of that order, covers a small
box of each.  Files of a shard can then be skipped by the minimum and maximum of any dimension.

Runs are cut so that shards have nearly equal sizes in bytes.  A cut that would part a group of equal
texts moves to the group's nearer end, unless it would move by more than ``tolerance`` of a shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.storage import landed


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of every row of ``cells`` (rows x dimensions, each below 2^bits).

    Gray-code rotations from the highest bit down, then the interleaved bits as one number.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap if i else 0
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    index = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | (x[i] >> bit) & 1
    return index


def name_cell(value: Column, bits: int) -> Column:
    """Cell of a name; null has cell 0."""
    return F.coalesce(F.pmod(F.xxhash64(value), F.lit(1 << bits)), F.lit(0)).cast("int")


def size_cell(size: Column, bits: int) -> Column:
    """Cell of a positive number, by its logarithm: an octave has 2^bits / 32 cells."""
    step = (1 << bits) / 32
    return F.least(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * step), F.lit((1 << bits) - 1)).cast("int")


def number_cell(value: Column, width: int, bits: int) -> Column:
    """Cell of an unsigned number of ``width`` bits: its highest bits."""
    return F.shiftright(value, width - bits).cast("int")


def along_curve(rows: DataFrame, dimensions: list[str], bits: int, ties: list[str], parts: int) -> DataFrame:
    """``rows`` in the order of the curve, as a written table.

    Adds ``curve``, ``part`` (a range of the order), ``place`` (from 0 within the part) and ``before``
    (the sum of ``size`` within the part before the row).  ``ties`` order the rows of a cell, so that a cell
    with many rows spreads over several parts.
    """

    def index(batches):
        for batch in batches:
            cells = np.stack([batch.column(d).to_numpy() for d in dimensions], axis=1)
            yield batch.append_column("curve", pa.array(hilbert_index(cells, bits)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    indexed = rows.mapInArrow(index, f"{schema}, curve long")
    order = ["curve", *ties]
    dealt = indexed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("part", F.spark_partition_id())

    def run(batches):
        place = before = 0
        for batch in batches:
            size = batch.column("size").to_numpy()
            ends = np.cumsum(size) + before
            out = batch.append_column("place", pa.array(np.arange(len(size)) + place))
            yield out.append_column("before", pa.array(ends - size))
            place += len(size)
            before = int(ends[-1]) if len(ends) else before

    return landed(dealt.mapInArrow(run, f"{schema}, curve long, part int, place long, before long"), "curve")


def shards(documents: DataFrame, count: int = 16, bits: int = 10, tolerance: float = 0.005) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``documents``.

    Dimensions are language, size and text hash.  ``size`` is the UTF-8 bytes of the text plus 1, of a
    null text 1.  The law is ``bytes``: shard k holds the rows that begin between k and k + 1 shares of
    all bytes in the order of the curve, up to the groups of equal texts kept whole and one row.
    ``slot`` counts a shard's rows from 0; ``grown_shard`` is null.  Equal rows are told apart by
    nothing, so any order among them will do.  Without ``lang`` that dimension is constant.
    """
    spark = documents.sparkSession
    lang = F.col("lang") if "lang" in documents.columns else F.lit(None).cast("string")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    rows = documents.select(
        F.col("doc_id").cast("long"),
        size.alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
        name_cell(lang, bits).alias("c0"),
        size_cell(size, bits).alias("c1"),
        number_cell(F.crc32(F.coalesce("text", F.lit("")).cast("binary")), 32, bits).alias("c2"),
    )
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    curve = along_curve(rows, ["c0", "c1", "c2"], bits, ["text_crc32", "text_hash", "doc_id"], parts)
    ends = curve.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()  # a row a part
    firsts, place, start = {}, 0, 0
    for r in sorted(ends):
        firsts[r.part] = (place, start)
        place, start = place + r.n, start + r.bytes
    offsets = spark.createDataFrame(
        [(k, *v) for k, v in firsts.items()], "part int, first_place long, first_byte long"
    )
    placed = curve.join(F.broadcast(offsets), "part").select(
        "*", (F.col("first_place") + F.col("place")).alias("rank"), (F.col("first_byte") + F.col("before")).alias("at")
    )
    cuts = _cuts(placed, start, count, tolerance)
    shard = F.size(F.filter(F.lit(cuts) if cuts else F.array().cast("array<bigint>"), lambda c: c <= F.col("at")))
    placed = placed.withColumn("shard", shard)
    first = F.broadcast(placed.groupBy("shard").agg(F.min("rank").alias("first_rank")))  # ``count`` rows
    return placed.join(first, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _cuts(placed: DataFrame, total: int, count: int, tolerance: float) -> list[int]:
    """Byte positions between shards: even ones, moved off groups of equal texts where that is near."""
    even = [total * k // count for k in range(1, count)]
    if not total:
        return []
    inside = F.exists(F.lit(even), lambda c: (F.col("low") < c) & (c < F.col("high")))
    groups = placed.groupBy("curve", "text_crc32", "text_hash").agg(
        F.min("at").alias("low"), F.max(F.col("at") + F.col("size")).alias("high")
    )
    around = [(r.low, r.high) for r in groups.filter(inside).select("low", "high").collect()]  # one a cut at most
    cuts = []
    for cut in even:
        near = [edge for low, high in around if low < cut < high for edge in (low, high)]
        near = [edge for edge in near if abs(edge - cut) <= tolerance * total / count]
        cuts.append(min(near, key=lambda edge: abs(edge - cut)) if near else cut)
    return cuts

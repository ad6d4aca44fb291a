"""Sliding row frames that stay distributed when one group holds a large share of the rows.

A window function puts a whole group into one task.  Groups above a measured size are therefore cut
into pieces along their order, and each piece gets the few rows before it that its first frames reach
back to.  The values equal those of the plain window: nothing is dropped or approximated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.scratch import written
from tallymart.functions.skew import BROADCAST_KEYS, HOT_ROWS, hot_keys, split_hot

#: Rows of a range of hot groups, at the least.
RANGE_ROWS = 200_000


def with_row_frame(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    frame: tuple[int, int],
    inputs: Sequence[str],
    aggregates: Mapping[str, Column],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``aggregates`` over the rows ``frame`` of each group, by ``order``, nulls first.

    ``frame`` is (start, end) in rows with start < 0 and end <= 0.  ``inputs`` are the columns the
    aggregates read.  ``hot_rows`` bounds the size of a group left to one task; ``None`` skips the
    check.  Rows that agree in all of ``order`` have no defined order among each other, and a larger
    group is cut anywhere but between them.
    """
    start, end = frame
    if not start < 0 or not start <= end <= 0:
        raise ValueError("frame has to look back: start < 0 and start <= end <= 0")

    def plain(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(start, end)
        return rows.withColumns({name: agg.over(window) for name, agg in aggregates.items()})

    found = hot_keys(df, keys, hot_rows, many=True)
    if found is None:
        return plain(df, keys)
    # Where very many groups are hot, all are cut alike: telling them apart would take a sort of all rows.
    many = found.count > BROADCAST_KEYS
    cold, hot = (None, df) if many else split_hot(df, keys, found)
    size = max(hot_rows, 1)
    pieces = _pieces(hot, keys, order, (df.count() if many else found.rows) // max(size, RANGE_ROWS) + 1, size)
    halo = _halo(pieces, keys, order, -start, inputs)
    both = pieces.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    framed = plain(both, [*keys, "_piece"]).filter(~F.col("_halo")).drop("_piece", "_halo")
    return framed if cold is None else plain(cold, keys).unionByName(framed)


def _pieces(
    hot: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, piece_rows: int | None = None
) -> DataFrame:
    """The rows with a ``_piece``, numbers that rise along the order of a group.

    Rows are put in about ``n`` ranges.  Spark's range exchange takes its bounds from a sample of all the keys and order columns together,
    so a group of many rows lies in many ranges, a single period of it too.  Where the bounds fall
    decides no value.  With ``piece_rows`` a range may hold many groups: each is cut further by rank, ties together,
    so that the tasks grow with the rows and not with the number of pieces.  The rows are written, since bounds
    sampled anew need not be the same.
    """
    ranged = hot.repartitionByRange(n, *keys, *order)
    if piece_rows is None:
        return written(ranged.withColumn("_piece", F.spark_partition_id()), "pieces")
    ranged = ranged.withColumn("_range", F.spark_partition_id())
    place = F.rank().over(Window.partitionBy(*keys, "_range").orderBy(*order)) - 1
    piece = F.col("_range").cast("long") * 2**32 + F.floor(place / F.lit(piece_rows)).cast("long")
    return written(ranged.withColumn("_piece", piece).drop("_range"), "pieces")


def _halo(
    pieces: DataFrame, keys: Sequence[str], order: Sequence[str], reach: int, inputs: Sequence[str]
) -> DataFrame:
    """For every piece of a group, the ``reach`` rows before it."""
    carried = [*order, *[c for c in inputs if c not in order]]
    backwards = Window.partitionBy(*keys, "_piece").orderBy(
        *[F.col(c).desc_nulls_last() for c in order]
    )
    # The last rows of each piece: all that a later piece can reach.
    tails = (
        pieces.select(*keys, "_piece", *carried)
        .withColumn("_back", F.row_number().over(backwards))
        .filter(F.col("_back") <= reach)
        .groupBy(*keys, "_piece")
        .agg(
            F.reverse(
                F.array_sort(F.collect_list(F.struct(F.col("_back"), F.struct(*carried).alias("r"))))
            ).alias("_tail")
        )
    )
    # A piece that a group has, has a row of it, so the ``reach`` pieces just before suffice.
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(-reach, -1)
    return (
        tails.select(*keys, "_piece", F.flatten(F.collect_list("_tail").over(before)).alias("_rows"))
        .select(
            *keys,
            "_piece",
            F.explode(
                F.slice("_rows", F.greatest(F.size("_rows") - reach + 1, F.lit(1)), reach)
            ).alias("_row"),
        )
        .select(*keys, "_piece", *[F.col(f"_row.r.{c}").alias(c) for c in carried])
        .withColumn("_halo", F.lit(True))
    )

"""A Merkle manifest of documents by sibling-shift self-joins.

Leaves are numbered within their source.  On every level the first node of each run of ``WIDTH`` computes
the numbers of its siblings, its own shifted by every slot, and an equijoin of the level with itself fetches
their digests; these slot-zero rows then emit the parents.  A run's siblings are the same for each of its slots,
so only slot zero asks.  On the way back down a run hands each slot the digests left and right of it,
before the path of its parent, so that a leaf ends with all siblings up to the root.

Every join is by (tree, number), so no key has more than one row a side, whatever the size of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.storage import landed

WIDTH = 16
_BYTES = 32
#: Rows of a range of the order, which one task sorts.
_PIECE_ROWS = 500_000
_NULLS_FIRST = ("source", "doc_id", "leaf", "salt")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def _hash(text: Column) -> Column:
    """The digest as 32 bytes, half of what its hex text takes to move."""
    return F.unhex(F.sha2(text, 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(text: Column) -> Column:
    """H of doc_id, source, lang, n_chars and ``text``, each ``-`` or its byte count, a colon and itself."""
    return _hash(F.concat(*[_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)))


def leaves(documents: DataFrame) -> DataFrame:
    """``(source, doc_id, leaf, tampered)``; ``tampered`` is null where 5 does not divide crc32(doc_id)."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return documents.select(
        "source", "doc_id", leaf_digest(F.col("text")).alias("leaf"), F.when(chosen, leaf_digest(lower)).alias("tampered")
    )


def numbered(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """Level 0 as ``(g, i, c, digest, doc_id, tampered)``, the number of sources, and of the largest one's leaves.

    ``g`` numbers the sources in their order, ``i`` a source's leaves in theirs, ``c`` is how many it has.
    Ranges of (source, doc_id, leaf) are numbered apart, and moved on by the counts of the ranges before:
    no source is in one task.  Equal rows spread by a number of their own, as any order among them will do.
    """
    spark = rows.sparkSession
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // _PIECE_ROWS + 1)
    order = [F.asc_nulls_first(c) for c in _NULLS_FIRST]
    dealt = rows.withColumn("salt", F.rand(13)).repartitionByRange(pieces, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = landed(dealt.drop("salt").select("*", F.spark_partition_id().alias("piece"), place.alias("place")), "ordered")

    # A row a piece and source, so at most as many as pieces and sources together.
    parts = dealt.groupBy("piece", "source").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    parts = landed(parts, "parts")
    sources = parts.groupBy("source").agg(F.min("piece").alias("start"), F.sum("n").alias("c"))
    within = F.row_number().over(Window.partitionBy("start").orderBy(F.asc_nulls_first("source"))) - 1
    begun = sources.groupBy("start").agg(F.count("*").alias("k"))  # a row a piece at most
    before = F.sum("k").over(Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    begun = begun.select("start", F.coalesce(before, F.lit(0)).alias("before"))
    sources = sources.withColumn("within", within).join(begun, "start")
    sources = landed(sources.select(F.col("source").alias("s"), "c", (F.col("before") + F.col("within")).alias("g")), "sources")
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    shifts = parts.withColumn("shift", F.coalesce(earlier, F.lit(0)) - F.col("first"))
    shifts = shifts.join(sources, F.col("source").eqNullSafe(F.col("s")))
    shifts = landed(shifts.select(F.col("piece").alias("p"), "s", "shift", "g", "c"), "shifts")

    same = (F.col("piece") == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    found = sources.agg(F.count("*").alias("n"), F.max("c").alias("c")).first()
    level = dealt.join(shifts, same).select(
        "g", (F.col("place") + F.col("shift")).alias("i"), "c", F.col("leaf").alias("digest"), "doc_id", "tampered"
    )
    return level, found.n, found.c or 0


def _runs(nodes: DataFrame) -> DataFrame:
    """``(g, i, c, digest, packed, members)`` of the level above: what slot zero finds of its siblings.

    ``packed`` holds the digests of the run, one after another; ``members`` its nodes.
    """
    several = nodes.filter("c > 1")
    shifts = F.sequence(F.lit(0).cast("long"), F.least(F.lit(WIDTH - 1), F.col("c") - 1 - F.col("i")))
    ask = several.filter(F.col("i") % WIDTH == 0).select("g", "i", "c", F.explode(shifts).alias("slot"))
    ask = ask.select("g", F.expr(f"i div {WIDTH}").alias("run"), "c", "slot", (F.col("i") + F.col("slot")).alias("sibling"))
    own = [c for c in nodes.columns if c not in ("g", "i", "c")]
    level = several.select(F.col("g").alias("tree"), F.col("i").alias("number"), *own)
    found = ask.join(level, (F.col("g") == F.col("tree")) & (F.col("sibling") == F.col("number")))
    members = F.sort_array(F.collect_list(F.struct("slot", *own)))  # WIDTH at most
    runs = found.groupBy("g", "run").agg(F.min("c").alias("c"), members.alias("members"))
    packed = F.aggregate("members", F.lit(b""), lambda all_, m: F.concat(all_, m["digest"]))
    runs = runs.withColumn("packed", packed)
    above = F.expr(f"(c + {WIDTH - 1}) div {WIDTH}")
    return runs.select(
        "g", F.col("run").alias("i"), above.alias("c"), _hash(_hex(F.col("packed"))).alias("digest"), "packed", "members"
    )


def _grown(nodes: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """Runs of every level, from the lowest up, as written tables; each a sixteenth of the one before."""
    levels = []
    while largest > 1:
        runs = _runs(nodes)
        runs = landed(runs if not levels else runs.drop("members"), f"{name}{len(levels)}")
        levels.append(runs)
        nodes = runs.select("g", "i", "c", "digest")
        largest = -(-largest // WIDTH)
    return levels


def _slots(runs: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes below ``runs`` with their path: digests left and right of them, then the path of their run."""
    runs = runs.select(F.col("g").alias("tree"), F.col("i").alias("number"), *[c for c in runs.columns if c in ("packed", "members")])
    joined = runs.join(paths, (F.col("tree") == F.col("g")) & (F.col("number") == F.col("i")))
    if "members" in runs.columns:
        slots = F.posexplode("members").alias("slot", "member")
    else:
        slots = F.explode(F.sequence(F.lit(0), F.expr(f"cast(octet_length(packed) / {_BYTES} as int) - 1"))).alias("slot")
    rest = [c for c in ("subroot",) if c in paths.columns]
    below = joined.select("g", F.col("number").alias("run"), "packed", "path", *rest, slots)
    left = F.expr(f"substring(packed, 1, {_BYTES} * slot)").alias("left")
    right = F.expr(f"substring(packed, {_BYTES} * slot + {_BYTES + 1})").alias("right")
    path = F.concat(F.array(F.struct(left, right)), "path")
    number = F.col("run") * WIDTH + F.col("slot")
    member = ["member.*"] if "members" in runs.columns else []
    return below.select("g", number.alias("i"), path.alias("path"), *rest, *member)


def manifest(documents: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``, a row per document.

    Null columns are hashed as ``-``; null sources are one source, the first; null ids come first in it and
    are never tampered.  Rows with one source and id follow in the order of their leaves; equal rows are
    leaves each, with places next to each other.  No documents, no rows.  Other columns do not matter.
    """
    base, sources, largest = numbered(landed(leaves(documents), "leaves"))
    if not sources:
        empty = "doc_id, '' as leaf, '' as subroot, '' as root, '' as proof_sha256, '' as folded_root, true as verified"
        return documents.filter("false").selectExpr(*empty.split(", "))
    levels = _grown(base, largest, "runs")

    # The level on which a source is down to one node: its subroot.
    single = base.filter("c = 1").select("g", "digest", F.lit(0).alias("level"))
    for k, runs in enumerate(levels):
        single = single.unionByName(runs.filter("c = 1").select("g", "digest", F.lit(k + 1).alias("level")))
    single = landed(single, "subroots")
    tops = single.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(sources).cast("long").alias("c"), "digest")
    top_levels = _grown(tops, sources, "top")
    root = (top_levels[-1] if top_levels else tops).first().digest  # one row

    nothing = F.array().cast("array<struct<left: binary, right: binary>>")
    paths = documents.sparkSession.range(1).select(F.lit(0).cast("long").alias("g"), F.col("id").alias("i"), nothing.alias("path"))
    for runs in reversed(top_levels):
        paths = _slots(runs.drop("members"), paths)
    single = single.join(paths.select(F.col("i").alias("g"), "path"), "g").withColumnRenamed("digest", "subroot")
    single = landed(single.select("g", F.lit(0).cast("long").alias("i"), "path", "subroot", "level"), "subroot_paths")

    paths = single.filter(F.col("level") == len(levels)).drop("level")
    for k in range(len(levels) - 1, 0, -1):
        paths = _slots(levels[k], paths).unionByName(single.filter(F.col("level") == k).drop("level"))
    alone = base.filter("c = 1").select("g", "i", "digest", "doc_id", "tampered")
    found = alone.join(single.filter("level = 0").drop("level"), ["g", "i"])
    if levels:
        found = found.unionByName(_slots(levels[0], paths).drop("slot"))

    both = F.transform("path", lambda p: F.concat(_hex(p["left"]), _hex(p["right"])))
    start = _hex(F.coalesce("tampered", "digest"))
    folded = F.aggregate("path", start, lambda own, p: F.sha2(F.concat(_hex(p["left"]), own, _hex(p["right"])), 256))
    return found.select(
        "doc_id",
        _hex(F.col("digest")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        F.lit(root.hex()).alias("root"),
        F.sha2(F.array_join(both, ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles.  Every one of ``trees`` independent trees
branches the sets by minwise tokens: the root of a tree takes one coordinate of the minwise sketch,
and every node of more than ``small`` sets (see below) takes one or two coordinates of its own, 4/3 on average (one
over the similarity asked for), chosen by the node's path; a set goes to the child of its value.  Nodes
of at most ``small`` sets are compared exhaustively, sketches first, then full sets.  Nodes still larger
at ``depth`` are compared whole too, block against block.

Trees run in two rounds.  The second leaves out what the first has already connected: only pairs from
different components are compared, so a large group of near copies is not compared again.

Recall of a pair of similarity 0.75, with 20 trees: it meets in one tree with probability 0.75 in a small
node, 0.52 two levels down and 0.33 six levels down, so it is missed with probability 1e-12, 5e-7 and 4e-4;
the sketch filter adds less than 1e-6.  Links are confirmed on full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.skew import hot_keys, join_around
from tallymart.llm import words
from tallymart.llm.components import components
from tallymart.llm.grouped import groups
from tallymart.llm.storage import landed

COORDINATES = 64
_MULTIPLIERS = np.random.default_rng(7).integers(1, 2**64, COORDINATES, dtype=np.uint64) | np.uint64(1)
_PART = 1 << 21
#: Members of clusters, and documents they are, up to which their list is broadcast: about 40 MB.
MEMBERS = 1_000_000


def _ragged(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary column: the bytes of ``sizes[i]`` values for row i."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())


def _row_parts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``_PART`` bytes, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + _PART, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = words.column_bytes(column)
    for a, b in _row_parts(offsets):
        own = offsets[a : b + 1] - offsets[a]
        hashes, _, _, counts = words.word_hashes(data[offsets[a] : offsets[b]], own, words.NOT_SPACE)
        yield a, b, *words.shingle_sets(hashes, counts, width)


def minwise(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """rows x COORDINATES 32-bit minwise tokens; rows without values have zeros."""
    out = np.zeros((len(sizes), COORDINATES), np.uint32)
    rows = np.flatnonzero(sizes)
    if len(rows):
        starts = np.concatenate([[0], np.cumsum(sizes[rows])[:-1]])
        for k in range(COORDINATES):
            least = np.minimum.reduceat(values * _MULTIPLIERS[k], starts)
            out[rows, k] = (words.mix(least) >> np.uint64(32)).astype(np.uint32)
    return out


def sketches(documents: DataFrame, width: int = 5) -> DataFrame:
    """``(doc_id, t, n, s1, s2, mh)``: the text's hash, set size, 128 bits that tell sets apart, minwise tokens."""

    def run(batches):
        for batch in batches:
            for a, b, values, sizes in _sets(batch.column("text"), width):
                s1, s2 = np.zeros((2, b - a), np.uint64)
                rows = np.flatnonzero(sizes)
                if len(rows):
                    starts = np.concatenate([[0], np.cumsum(sizes[rows])[:-1]])
                    s1[rows] = np.add.reduceat(words.mix(values), starts)
                    s2[rows] = np.add.reduceat(words.mix(values ^ _MULTIPLIERS[0]), starts)
                tokens = minwise(values, sizes)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a),
                        "t": batch.column("t").slice(a, b - a),
                        "n": pa.array(sizes),
                        "s1": pa.array(s1.view(np.int64)),
                        "s2": pa.array(s2.view(np.int64)),
                        "mh": _ragged(tokens.ravel(), np.full(b - a, COORDINATES)),
                    }
                )

    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text").mapInArrow(
        run, "doc_id long, t long, n long, s1 long, s2 long, mh binary"
    )


def _tokens(column: pa.Array) -> np.ndarray:
    data, _ = words.column_bytes(column)
    return data.view(np.uint32).reshape(-1, COORDINATES)


def _roots(sets: DataFrame, trees: range) -> DataFrame:
    """``(node, id, component)``: every set in the root child of its minwise token, tree by tree."""

    def run(batches):
        for batch in batches:
            tokens, ids = _tokens(batch.column("mh")), batch.column("id")
            for t in trees:
                at = np.full(len(ids), t, np.uint64)
                node = words.combine(at, tokens[:, t].astype(np.uint64))
                yield pa.record_batch({"node": node.view(np.int64), "id": ids, "component": batch.column("component")})

    return sets.select("id", "component", "mh").mapInArrow(run, "node long, id long, component long")


def _children(large: DataFrame) -> DataFrame:
    """``(node, id, component)`` one level below; which coordinates a node takes follows from its path."""

    def run(batches):
        for batch in batches:
            tokens, ids = _tokens(batch.column("mh")), batch.column("id").to_numpy()
            node = batch.column("node").to_numpy().view(np.uint64)
            component = batch.column("component").to_numpy()
            for j in range(2):
                drawn = words.combine(node, np.full(len(ids), j, np.uint64))
                own = slice(None) if j == 0 else np.flatnonzero(drawn >> np.uint64(32) < (1 << 32) // 3)
                chosen = (drawn[own] % np.uint64(COORDINATES)).astype(np.int64)
                value = tokens[own][np.arange(len(chosen)), chosen].astype(np.uint64)
                child = words.combine(drawn[own], value)
                yield pa.record_batch({"node": child.view(np.int64), "id": ids[own], "component": component[own]})

    return large.select("node", "id", "component", "mh").mapInArrow(run, "node long, id long, component long")


def _sized_nodes(members: DataFrame, small: int) -> DataFrame:
    """Members of nodes of more than one component, with ``size`` and whether the node is ``large``."""
    parts = members.groupBy("node", "component").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("node").agg(F.sum("n").alias("size"), F.max("n").alias("most")).filter("size > most")
    apart = F.col("size") - F.col("most")
    pairs = apart * F.col("size") - F.floor(apart * (apart + 1) / 2)  # those outside, with one another and with all
    large = (pairs > small * small) | (F.col("size") > 4 * small)
    return landed(members.join(sizes.select("node", "size", large.alias("large")), "node"), "nodes")


def small_nodes(sets: DataFrame, trees: range, depth: int, small: int) -> DataFrame:
    """``(node, id, component)`` of small nodes, which together hold every pair of a leaf.

    ``sets(id, component, mh)``: pairs of one component need not be held.
    """
    level = _sized_nodes(_roots(sets, trees), small)
    columns = "node", "id", "component"
    leaves = [level.filter("not large").select(*columns)]
    tokens = sets.select("id", "mh")
    for _ in range(depth):
        large = level.filter("large")
        if large.isEmpty():
            return _union(leaves)
        level = _sized_nodes(_children(large.join(tokens, "id")), small)
        leaves.append(level.filter("not large").select(*columns))
    large = level.filter("large")
    if not large.isEmpty():
        leaves.append(_block_pairs(large, small))
    return _union(leaves)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _block_pairs(large: DataFrame, small: int) -> DataFrame:
    """Nodes cut into blocks of ``small / 2`` sets; every pair of blocks becomes a node."""
    blocks = F.ceil(F.col("size") * 2 / small).cast("long")
    block = F.pmod(F.xxhash64("id", "node"), blocks)
    pairs = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    return large.select("node", "id", "component", block.alias("own"), pairs).select(
        F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "id", "component"
    )


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Label of each of ``n`` things: the smallest one that links ``i``-``j`` connect it with."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def _alike_by_sketch(nodes: DataFrame, least_equal: int, percent: int) -> DataFrame:
    """``(cluster, id, component)``: within a node, sets that sketches and sizes may link, chains included.

    Pairs of one component count as linked already.  ``cluster`` is a hash of the members, so that a
    cluster found in several trees is one.
    """

    def run(batches):
        for table in groups(batches, "node"):
            ids, at = np.unique(table.column("id").to_numpy(), return_index=True)
            component = table.column("component").to_numpy()[at]
            names, part = np.unique(component, return_inverse=True)
            if len(names) < 2:
                continue
            size = table.column("n").to_numpy()[at]
            data, _ = words.column_bytes(table.column("sketch"))
            tokens = data.reshape(-1, COORDINATES)[at]
            rows = np.flatnonzero(part != np.bincount(part).argmax())
            i, j = [], []
            step = max(1, 65_536 // len(ids))
            for a in range(0, len(rows), step):
                own = rows[a : a + step]
                near = (tokens[own, None, :] == tokens[None, :, :]).sum(2) >= least_equal
                near &= 100 * np.minimum.outer(size[own], size) >= percent * np.maximum.outer(size[own], size)
                near &= part[own, None] != part[None, :]
                x, y = np.nonzero(near)
                i.append(own[x])
                j.append(y)
            i, j = np.concatenate(i), np.concatenate(j)
            label = _labels(len(ids), i, j)
            for root in np.unique(label[i]):
                mine = label == root
                mixed = words.mix(ids[mine].view(np.uint64))
                cluster = words.combine(mixed.sum(keepdims=True), np.bitwise_xor.reduce(mixed, keepdims=True))
                cluster = np.repeat(cluster.view(np.int64), mine.sum())
                yield pa.record_batch({"cluster": cluster, "id": ids[mine], "component": component[mine]})

    rows = nodes.select("node", "id", "component", "n", "sketch").repartition("node").sortWithinPartitions("node")
    found = rows.mapInArrow(run, "cluster long, id long, component long")
    return found.repartition("cluster").dropDuplicates(["cluster", "id"])


def _intersections(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``rows`` with all sets, from the values that more than one set has."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    out = np.zeros((len(rows), len(sets)))
    if not len(column):
        return out
    column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
    step = max(64, 4_000_000 // len(sets))
    for a in range(0, int(column[-1]) + 1, step):
        lo, hi = np.searchsorted(column, [a, a + step])
        have = np.zeros((len(sets), step), np.float32)
        have[owner[lo:hi], column[lo:hi] - a] = 1
        out += have[rows] @ have.T
    return out


def _confirmed(clusters: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: components that links confirmed on full sets connect, one row less than they are.

    Compared are all sets outside the cluster's largest component with all of the cluster.
    """

    def run(batches):
        for table in groups(batches, "cluster"):
            names, part = np.unique(table.column("component").to_numpy(), return_inverse=True)
            data, offsets = words.column_bytes(table.column("values"))
            sets = [data[a:b].view(np.uint64) for a, b in zip(offsets, offsets[1:])]
            size = np.array([len(s) for s in sets])
            rows = np.flatnonzero(part != np.bincount(part).argmax())
            both = _intersections(sets, rows)
            i, j = np.nonzero(100 * both >= percent * (np.add.outer(size[rows], size) - both))
            label = _labels(len(names), part[rows[i]], part[j])
            rest = np.flatnonzero(label != np.arange(len(names)))
            if len(rest):
                yield pa.record_batch({"a": names[rest], "b": names[label[rest]]})

    rows = clusters.select("cluster", "component", "values").repartition("cluster").sortWithinPartitions("cluster")
    return rows.mapInArrow(run, "a long, b long")


def _with_sets(clusters: DataFrame, sets: DataFrame, rows: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """``clusters`` with the full sets of their members, as ``values``.

    A set is read from one text, found by the id and the hash that the set was given; of equal rows one is
    taken.  A list of members counted to be short goes to the texts; otherwise texts and members meet by
    id and hash.
    """

    def run(batches):
        for batch in batches:
            for a, b, values, sizes in _sets(batch.column("text"), width):
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("in"), _ragged(values, sizes)], ["id", "in", "values"]
                )

    member = F.struct("cluster", "component").alias("in")
    members = clusters.groupBy("id").agg(F.collect_list(member).alias("in"))
    members = landed(members.join(sets.select("id", "doc_id", "t"), "id"), "members")
    small = members.agg(F.count("*"), F.sum(F.size("in"))).first()
    short = small[0] + (small[1] or 0) <= MEMBERS
    place = members.select("doc_id", "t", "id")
    again = rows.select("doc_id", "t").join(F.broadcast(place) if short else place, ["doc_id", "t"])
    again = landed(again.groupBy("id").count().filter("count > 1").select("id"), "again")
    members = members.join(again.withColumn("repeated", F.lit(True)), "id", "left")
    texts = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text")
    texts = texts.join(F.broadcast(members) if short else members, ["doc_id", "t"])
    one = texts.filter("repeated").dropDuplicates(["id"])
    texts = texts.filter("repeated is null").unionByName(one).select("id", "in", "text")
    kinds = "id long, in array<struct<cluster:bigint,component:bigint>>, values binary"
    found = texts.mapInArrow(run, kinds.replace("in array", "`in` array"))
    return found.select("values", F.explode("in").alias("m")).select("m.cluster", "m.component", "values")


def classes(
    documents: DataFrame,
    width: int = 5,
    percent: int = 75,
    trees: int = 20,
    depth: int = 8,
    small: int = 1024,
    least_equal: int | None = None,
) -> DataFrame:
    """``(doc_id, t, n, component, component_id)``, one row per row of ``documents(doc_id, text)``.

    ``t`` is the hash of the text.  Rows are in one ``component`` if links lead from one to the other;
    ``component_id`` is its smallest ``doc_id``.  Both are null for rows without shingles or id.  Equal sets are
    one, with a number of its own: work does not depend on how ids repeat.
    """
    spread = (COORDINATES * percent / 100 * (1 - percent / 100)) ** 0.5
    least = least_equal if least_equal is not None else int(COORDINATES * percent / 100 - 5.2 * spread)
    rows = landed(sketches(documents, width), "sketches")
    own = rows.filter("n > 0 and doc_id is not null")
    one = F.min(F.struct("doc_id", "t")).alias("one")
    sets = own.groupBy("n", "s1", "s2").agg(one, F.first("mh").alias("mh"))
    sets = landed(sets.select("n", "s1", "s2", "one.*", "mh", F.monotonically_increasing_id().alias("id")), "sets")

    def short(batches):
        for batch in batches:
            low = (_tokens(batch.column("mh")) & 255).astype(np.uint8)
            sketch = _ragged(low.ravel(), np.full(len(low), COORDINATES))
            yield pa.record_batch({"id": batch.column("id"), "n": batch.column("n"), "sketch": sketch})

    brief = sets.select("id", "n", "mh").mapInArrow(short, "id long, n long, sketch binary")
    labels = None
    for part in (range(min(3, trees)), range(min(3, trees), trees)):
        if labels is None:
            known = sets.withColumn("component", F.col("id"))
        else:
            joined = sets.select("id", "mh").join(labels, "id", "left")
            known = landed(joined.withColumn("component", F.coalesce("component", "id")), "known")
        nodes = small_nodes(known, part, depth, small).join(brief, "id")
        clusters = landed(_alike_by_sketch(nodes, least, percent), "clusters")
        links = _confirmed(_with_sets(clusters, sets, own, documents, width), percent)
        if labels is not None:
            old = labels.filter("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
            links = links.unionByName(old)
        labels = components(links)
    labels = landed(labels.join(sets.select("id", "doc_id"), "id"), "labels")
    first = labels.groupBy(F.col("component").alias("of")).agg(F.min("doc_id").alias("component_id"))
    named = join_around(labels, first, [("component", "of")], hot_keys(labels, ["component"]), "inner")
    named = sets.select("n", "s1", "s2", "id", F.col("doc_id").alias("first_id")).join(
        named.select("id", "component", "component_id"), "id", "left"
    )
    found = rows.select("doc_id", "t", "n", "s1", "s2").join(
        named.select(
            "n", "s1", "s2", F.coalesce("component", "id").alias("component"), F.coalesce("component_id", "first_id").alias("component_id")
        ),
        ["n", "s1", "s2"],
        "left",
    )
    there = F.col("doc_id").isNotNull()
    ours = [F.when(there, F.col(c)).alias(c) for c in ("component", "component_id")]
    return found.select("doc_id", "t", "n", *ours)


def near_duplicates(documents: DataFrame, **options: int | None) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``documents(doc_id, text)``.

    Documents are linked if 100 * intersection >= percent * union of their shingle sets;
    ``component_id`` is the smallest ``doc_id`` reachable over links, and ``kept`` tells that it is
    the document's own.  ``options`` are those of :func:`classes`: ``width`` and ``percent``, and how the
    join goes; ``least_equal`` equal minwise tokens of 64 are asked for before sets are compared (by default
    5.2 standard deviations below what ``percent`` lets expect).

    Null, empty or blank text: no shingles, linked with nothing.  Rows that share a ``doc_id`` are documents
    of their own, linked if their sets are; a null ``doc_id`` takes part in no link and is never kept.
    Other columns are ignored.
    """
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return classes(documents, **options).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"),
    )

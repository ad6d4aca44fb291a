"""Codes of vectors by parts, learnt over anchors-hierarchy metric trees.

Vectors are cut into ``PARTS`` parts.  Tasks take them in blocks, and build for every block and part position
a tree of balls, middle-out: about sqrt(n) anchors each own the points nearest to them, found with the
triangle inequality; anchors are merged, smallest ball first, up to one root, and split by anchors of their own
below.  A ball caches how many parts it holds and their sum.  The trees are written once.

A round walks every tree with the codebook.  A ball inherits the candidate entries of the ball around it and
drops those that another entry beats at every point of the ball; once one is left, the ball is wholly its own
and its cached sum and count are added, without a look at its points.  All sums are whole numbers, so results
do not depend on how rows fell into blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.skew import hot_keys, join_around
from tallymart.llm.storage import landed

PARTS = 16
ENTRIES = 64
#: Rows of a block, and points of a ball that is not split further.
BLOCK = 8192
LEAF = 32
#: Components are held within these bounds, so that sums of squares stay exact in 64 bits.
LIMIT = 1 << 24
#: Labels up to which their sums are broadcast.
_BROADCAST_LABELS = 100_000


def kept(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, vector)``: rows whose vector has finite components alone, as floor(256 * x).

    A label column that is missing is null.
    """
    label = F.col("label") if "label" in embeddings.columns else F.lit(None).cast("int")
    wide = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("wide", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    bounded = F.transform("wide", lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x * 256))).cast("int"))
    rows = embeddings.select("vec_id", label.alias("label"), wide.alias("wide"))
    return rows.filter(F.col("wide").isNotNull() & finite).select("vec_id", "label", bounded.alias("vector"))


# A tree of balls. -----------------------------------------------------------


@dataclass
class Tree:
    """Points in the order of the leaves, and balls; the root is the last ball.

    ``nodes`` has a row (left, right, first point, end) per ball, -1 for no child; ``balls`` center and
    radius; ``sums`` the sum of its parts and their count.  ``member`` is the point of every row.
    """

    points: np.ndarray
    weight: np.ndarray
    member: np.ndarray
    nodes: np.ndarray
    balls: np.ndarray
    sums: np.ndarray

    KINDS = {"points": np.int32, "weight": np.int32, "member": np.int32, "nodes": np.int32, "balls": np.float64, "sums": np.int64}

    def packed(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.KINDS.items()}

    @classmethod
    def unpacked(cls, parts: dict[str, bytes], width: int) -> Tree:
        shape = {"points": (-1, width), "nodes": (-1, 4), "balls": (-1, width + 1), "sums": (-1, width + 1)}
        return cls(**{n: np.frombuffer(parts[n], kind).reshape(shape.get(n, (-1,))) for n, kind in cls.KINDS.items()})


def anchors(points: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of every point, distance to it), for ``count`` anchors at most, fewer where points coincide.

    Each new anchor is the farthest point of the anchor with the largest radius.  It can only steal points that lie
    farther from their anchor than half the distance between the two anchors; the others are not looked at.
    """
    owner = np.zeros(len(points), np.int64)
    places = [0]
    far = np.sqrt(((points - points[0]) ** 2).sum(1))
    while len(places) < count:
        new = int(far.argmax())
        if far[new] == 0:
            break
        between = np.sqrt(((points[places] - points[new]) ** 2).sum(1))
        near = np.flatnonzero(far > between[owner] / 2)
        own = np.sqrt(((points[near] - points[new]) ** 2).sum(1))
        stolen = own < far[near]
        owner[near[stolen]] = len(places)
        far[near[stolen]] = own[stolen]
        places.append(new)
    return owner, far


class _Builder:
    def __init__(self, points: np.ndarray, weight: np.ndarray) -> None:
        self.points, self.wide, self.weight = points, points.astype(np.float64), weight
        self.children: list[tuple[int, int]] = []
        self.balls: list[np.ndarray] = []
        self.sums: list[np.ndarray] = []
        self.leaves: dict[int, np.ndarray] = {}

    def ball(self, at: np.ndarray) -> int:
        """The tree over the points ``at``, and its root."""
        if len(at) <= LEAF:
            return self._leaf(at)
        owner, _ = anchors(self.wide[at], math.isqrt(len(at) - 1) + 1)
        by_owner = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[by_owner])) + 1
        groups = np.split(at[by_owner], cuts)
        return self._leaf(at) if len(groups) == 1 else self._merged([self.ball(group) for group in groups])

    def _leaf(self, at: np.ndarray) -> int:
        own = self.points[at].astype(np.int64) * self.weight[at, None]
        total, n = own.sum(0), int(self.weight[at].sum())
        center = total / n
        radius = math.sqrt(((self.wide[at] - center) ** 2).sum(1).max())
        self.leaves[len(self.balls)] = at
        return self._add(-1, -1, center, radius, np.append(total, n))

    def _add(self, left: int, right: int, center: np.ndarray, radius: float, sums: np.ndarray) -> int:
        self.children.append((left, right))
        self.balls.append(np.append(center, radius))
        self.sums.append(sums)
        return len(self.balls) - 1

    def _merged(self, own: list[int]) -> int:
        """One ball over neighbouring ones: the two with the smallest common ball first."""
        ball = np.array([self.balls[k] for k in own])
        n = np.array([self.sums[k][-1] for k in own], np.float64)

        def around(k: int) -> tuple[np.ndarray, np.ndarray]:
            share = (n / (n + n[k]))[:, None]
            center = ball[:, :-1] * share + ball[k, :-1] * (1 - share)
            reach = np.sqrt(((ball[:, :-1] - center) ** 2).sum(1)) + ball[:, -1]
            other = np.sqrt(((ball[k, :-1] - center) ** 2).sum(1)) + ball[k, -1]
            return center, np.maximum(reach, other)

        size = np.array([around(k)[1] for k in range(len(own))])
        np.fill_diagonal(size, np.inf)
        root = own[0]
        for _ in range(len(own) - 1):
            a, b = divmod(int(size.argmin()), len(own))
            center, radius = around(a)
            first, second = own[a], own[b]
            root = self._add(first, second, center[b], radius[b], self.sums[first] + self.sums[second])
            own[a], ball[a], n[a] = root, self.balls[root], n[a] + n[b]
            size[b, :] = size[:, b] = np.inf
            gone = np.isinf(size[a])
            gone[a] = True
            fresh = np.where(gone, np.inf, around(a)[1])
            size[a, :] = size[:, a] = fresh
        return root


def tree(parts: np.ndarray) -> Tree:
    """The tree over the rows of ``parts``, whole numbers; equal rows are one point with a weight."""
    points, member, weight = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
    build = _Builder(points, weight)
    build.ball(np.arange(len(points)))
    nodes = np.array([(*pair, 0, len(build.leaves.get(k, ()))) for k, pair in enumerate(build.children)])
    for k, (left, right) in enumerate(build.children):  # children come before their ball
        if left >= 0:
            nodes[k, 3] = nodes[left, 3] + nodes[right, 3]
    order = np.empty(len(points), np.int64)
    for k in range(len(nodes) - 1, -1, -1):  # so that the points of a ball follow one another
        left, right, a, size = nodes[k].tolist()
        nodes[k, 3] = a + size
        if left >= 0:
            nodes[left, 2], nodes[right, 2] = a, a + nodes[left, 3]
        else:
            order[a : a + size] = build.leaves[k]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Tree(points[order], weight[order], place[member.ravel()], nodes, np.array(build.balls), np.array(build.sums))


def _owned(found: Tree, entries: np.ndarray) -> Iterator[tuple[int, np.ndarray | int, int, int]]:
    """(ball, entry of it all or of each point, first point, end), for balls that cover the tree."""
    wide = entries.astype(np.float64)
    _, first = np.unique(entries, axis=0, return_index=True)
    stack = [(len(found.nodes) - 1, np.sort(first))]  # of equal entries the first one gets all
    while stack:
        node, candidates = stack.pop()
        left, right, a, b = found.nodes[node].tolist()
        center, radius = found.balls[node, :-1], found.balls[node, -1]
        if len(candidates) > 1:
            own = wide[candidates]
            far = ((own - center) ** 2).sum(1)
            best = int(far.argmin())
            # At every point x of the ball |x - c|^2 - |x - best|^2 is this at least, a whole number at whole points.
            least = far - far[best] - 2 * radius * np.sqrt(((own - own[best]) ** 2).sum(1))
            candidates = candidates[least <= 0.5 + 1e-9 * (far + far[best])]
        if len(candidates) == 1:
            yield node, int(candidates[0]), a, b
        elif left < 0:
            apart = found.points[a:b, None, :].astype(np.int64) - entries[candidates]
            yield node, candidates[(apart * apart).sum(2).argmin(1)], a, b  # ties to the lower index
        else:
            stack += [(left, candidates), (right, candidates)]


def sums(found: Tree, entries: np.ndarray) -> np.ndarray:
    """Per entry the sum of the parts that are nearest to it, and their count."""
    total = np.zeros((len(entries), entries.shape[1] + 1), np.int64)
    for node, owner, a, b in _owned(found, entries):
        if isinstance(owner, int):
            total[owner] += found.sums[node]
        else:
            weight = found.weight[a:b].astype(np.int64)
            np.add.at(total, owner, np.column_stack([found.points[a:b] * weight[:, None], weight]))
    return total


def nearest(found: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance to it) of every row of the block."""
    owner = np.zeros(len(found.points), np.int64)
    for _, own, a, b in _owned(found, entries):
        owner[a:b] = own
    apart = found.points.astype(np.int64) - entries[owner]
    return owner[found.member], (apart * apart).sum(1)[found.member]


# Over tables. ---------------------------------------------------------------

_TREE = "struct<" + ", ".join(f"{name}: binary" for name in Tree.KINDS) + ">"


def _trees(rows: DataFrame, width: int) -> DataFrame:
    """A row per block: its ids and labels, and the tree of each part position."""
    ids, labels = rows.schema["vec_id"].dataType, rows.schema["label"].dataType

    def run(batches):
        def block(batch):
            vectors = batch.column("vector").flatten().to_numpy().reshape(-1, PARTS, width)
            own = [[tree(vectors[:, p]).packed() for p in range(PARTS)]]
            kind = pa.list_(pa.struct([(name, pa.binary()) for name in Tree.KINDS]))
            columns = [pa.array([batch.column(c).to_pylist()], pa.list_(batch.column(c).type)) for c in ("vec_id", "label")]
            return pa.RecordBatch.from_arrays([*columns, pa.array(own, kind)], ["vec_id", "label", "trees"])

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == BLOCK:
                    yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, n = [], 0
        if n:
            yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    schema = f"vec_id array<{ids.simpleString()}>, label array<{labels.simpleString()}>, trees array<{_TREE}>"
    return rows.mapInArrow(run, schema)


def _read(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[Tree]]]:
    for k in range(batch.num_rows):
        yield k, [Tree.unpacked(parts, width) for parts in batch.column("trees")[k].as_py()]


def _refined(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """``books`` (part, entry, component) with every entry that has parts at the floor of their mean."""
    *shape, width = books.shape
    shared = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        total = np.zeros((*shape, width + 1), np.int64)
        for batch in batches:
            for _, own in _read(batch, width):
                for p, found in enumerate(own):
                    total[p] += sums(found, shared.value[p])
        place = np.arange(total[..., 0].size)
        yield pa.record_batch({"entry": place, "total": pa.array(list(total.reshape(len(place), -1)), pa.list_(pa.int64()))})

    partial = trees.select("trees").mapInArrow(run, "entry long, total array<bigint>")
    each = partial.select("entry", F.posexplode("total").alias("at", "value")).groupBy("entry", "at").agg(F.sum("value").alias("value"))
    got = each.toArrow()  # as many rows as the codebooks have components, and a count for each entry
    total = np.zeros((math.prod(shape), width + 1), np.int64)
    total[got.column("entry").to_numpy(), got.column("at").to_numpy()] = got.column("value").to_numpy()
    total = total.reshape(*shape, width + 1)
    n = total[..., -1:]
    return np.where(n > 0, total[..., :-1] // np.maximum(n, 1), books)


def compress(embeddings: DataFrame, rounds: int = 2) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``, a row per kept row of ``embeddings``.

    Rows whose vector is null, or holds a null or a component that is not finite, are dropped.  The first
    codebooks are the parts of the rows with the ``ENTRIES`` smallest ids, null ids last and rows of one id in
    the order of their vectors; fewer rows make smaller codebooks.  The vector of the smallest id sets the
    length: rows of another length have no parts to compare and are dropped too.  A length that ``PARTS`` does
    not divide is filled with zeros.  Components beyond ``LIMIT`` / 256 count as that.  Repeated rows are
    coded each, null labels are one label.  No rows, no result rows; other columns do not matter.
    """
    spark = embeddings.sparkSession
    rows = kept(embeddings)
    order = [F.asc_nulls_last("vec_id"), F.asc("vector")]
    first = [r.vector for r in rows.orderBy(*order).limit(1).collect()]
    size = len(first[0]) if first else 0
    rows = rows.filter(F.size("vector") == size)
    width = max(1, -(-size // PARTS))
    if size != width * PARTS:
        rows = rows.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0), width * PARTS - size)))
    start = [r.vector for r in rows.orderBy(*order).limit(ENTRIES).collect()]
    books = np.array(start, np.int64).reshape(-1, PARTS, width).transpose(1, 0, 2)

    trees = landed(_trees(rows, width), "trees")
    for _ in range(rounds if start else 0):
        books = _refined(trees, books)
    shared = spark.sparkContext.broadcast(books)
    types = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}

    def run(batches):
        for batch in batches:
            for k, own in _read(batch, width):
                found = [nearest(t, shared.value[p]) for p, t in enumerate(own)]
                code = np.stack([owner for owner, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                texts = [code[i : i + 2 * PARTS] for i in range(0, len(code), 2 * PARTS)]
                columns = [batch.column(c)[k].values for c in ("vec_id", "label")]
                error = np.sum([far for _, far in found], axis=0)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts), pa.array(error)], ["vec_id", "label", "code", "error"])

    coded = trees.mapInArrow(run, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")
    coded = landed(coded, "coded")
    totals = landed(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label_errors")
    if totals.count() <= _BROADCAST_LABELS:
        joined = coded.join(F.broadcast(totals), F.col("label").eqNullSafe(F.col("of")))
    else:
        joined = join_around(coded, totals, [("label", "of")], hot_keys(coded, ["label"]), "inner", null_safe=True)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))

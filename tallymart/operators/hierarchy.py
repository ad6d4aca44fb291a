"""The organisation tree, held as ``/l1/l2/../lN`` paths, flattened to one row per leaf."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.keys import unique_by
from tallymart.functions.sizing import BROADCAST_BYTES, measured_bytes, sized
from tallymart.functions.skew import lookup_join

# Names of the upper levels, from the root; deeper ones are "level4" and so on.
LEVEL_LABELS = ("country", "region", "district")

LEAF_AT_MAX_LEVEL, LEAF_WITHOUT_CHILDREN = "max_level", "no_children"


def _leaves(org_units: DataFrame, leaf_rule: str, broadcast_bytes: int | None) -> DataFrame:
    if leaf_rule == LEAF_AT_MAX_LEVEL:
        deepest = org_units.agg(F.max("level")).scalar()
        return org_units.filter(F.col("level") == deepest)
    if leaf_rule == LEAF_WITHOUT_CHILDREN:
        parents = org_units.select(F.col("parent.id").alias("_parent")).distinct()
        return org_units.join(
            sized(parents, broadcast_bytes), F.col("id") == F.col("_parent"), "left_anti"
        )
    raise ValueError(f"unknown leaf rule {leaf_rule!r}")


def flatten_hierarchy(
    org_units: DataFrame,
    depth: int | None = None,
    labels: Sequence[str] = LEVEL_LABELS,
    leaf_rule: str = LEAF_AT_MAX_LEVEL,
    broadcast_bytes: int | None = BROADCAST_BYTES,
) -> DataFrame:
    """Leaves with the id and name of each ancestor, as ``<label>_uid`` and ``<label>_name``.

    An ancestor id is looked up among the units of its own level only.  ``depth`` is the level of
    the leaves; left out, one aggregate over the units finds it, since the columns depend on it.
    ``leaf_rule="no_children"`` also keeps leaves above the deepest level, for trees of unequal
    depth.
    """
    if depth is None:
        depth = org_units.agg(F.max("level")).first()[0] or 0
    leaves = _leaves(org_units, leaf_rule, broadcast_bytes)
    flat = leaves.select(
        F.col("id").alias("facility_uid"),
        F.col("name").alias("facility_name"),
        F.col("level").alias("facility_level"),
        "path",
        F.when(
            F.size("groups") > 1, F.get(F.col("groups"), F.lit(1)).getField("name")
        ).alias("facility_type"),
        F.split("path", "/").alias("_steps"),
    )
    named = org_units.select("id", "level", "name")
    names = unique_by(named, ["id", "level"])
    n_bytes = None
    if broadcast_bytes is not None:
        n_bytes = measured_bytes(named)[0]
        if n_bytes > broadcast_bytes:
            n_bytes = None  # all levels together are too large: measure each
    for level in range(1, depth):
        label = labels[level - 1] if level <= len(labels) else f"level{level}"
        # A leaf above the deepest level is no ancestor of itself.
        step = F.when(F.col("facility_level") > level, F.get(F.col("_steps"), F.lit(level)))
        lookup = names.filter(F.col("level") == level).select(
            F.col("id").alias("_ancestor"), F.col("name").alias(f"{label}_name")
        )
        flat = lookup_join(
            flat.withColumn(f"{label}_uid", step),
            lookup,
            [(f"{label}_uid", "_ancestor")],
            n_bytes=n_bytes,
            bound=broadcast_bytes,
        ).drop("_ancestor")
    return flat.drop("_steps")


def enrich_with_hierarchy(
    values: DataFrame,
    facilities: DataFrame,
    broadcast_bytes: int | None = BROADCAST_BYTES,
) -> DataFrame:
    """Value rows with their facility's ancestry.

    A unit that is known but no leaf keeps null ancestry; ``is_non_leaf`` tells such rows.
    """
    lookup = unique_by(facilities, ["facility_uid"])
    n_bytes = None if broadcast_bytes is None else measured_bytes(facilities)[0]
    return lookup_join(
        values, lookup, [("orgUnit", "facility_uid")], n_bytes=n_bytes, bound=broadcast_bytes
    ).withColumn("is_non_leaf", F.col("facility_uid").isNull())

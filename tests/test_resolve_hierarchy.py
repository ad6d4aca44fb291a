import frames
from tallymart.operators.hierarchy import (
    LEAF_WITHOUT_CHILDREN,
    enrich_with_hierarchy,
    flatten_hierarchy,
)
from tallymart.operators.resolve import resolve_keys

TREE = [
    ("K", "Kenya", "/K", ["Country"]),
    ("R", "Coast", "/K/R", ["Region"]),
    ("D", "Kilifi", "/K/R/D", ["District"]),
    ("F1", "Clinic 1", "/K/R/D/F1", ["Facility", "Clinic"]),
    ("F2", "Clinic 2", "/K/R/D/F2", ["Facility"]),
]


def test_resolve(spark):
    values = frames.values(
        spark,
        ("e", "202401", "F1", "c", "1", None),
        ("e", "202401", "F1", "nope", "2", None),
        ("ghost", "202401", "F1", "c", "3", None),
        ("e", "202401", "ghost", "c", "4", None),
        ("ghost", "202401", "ghost", "c", "5", None),
        ("bare", "202401", "F1", "c", "6", None),
    )
    elements = frames.elements(
        spark,
        ("e", "E", "NUMBER", "HIV"),
        ("e", "E again", "NUMBER", "HIV"),  # must not multiply rows
        ("bare", "Bare", "INTEGER", None),
    )
    combos = frames.combos(spark, "c", "c")
    got = resolve_keys(values, elements, combos, frames.units(spark, *TREE, *TREE))
    assert frames.rows(got.rows, "value", "de_name", "health_area", "is_orphaned_coc") == [
        ("1", "E", "HIV", False),
        ("2", "E", "HIV", True),
        ("6", "Bare", None, False),
    ]
    assert frames.rows(got.rejects, "value", "unknown_key") == [
        ("3", "dataElement"),
        ("4", "orgUnit"),
        ("5", "orgUnit"),
    ]
    assert got.rows.count() + got.rejects.count() == values.count()


def test_resolve_is_the_same_without_broadcast(spark):
    values = frames.values(
        spark, *[("e", "202401", f"F{i % 3}", "c", str(i), None) for i in range(30)]
    )
    args = (
        frames.elements(spark, ("e", "E", "NUMBER", "HIV")),
        frames.combos(spark, "c"),
        frames.units(spark, *TREE),
    )
    small = resolve_keys(values, *args)
    large = resolve_keys(values, *args, broadcast_bytes=0)
    assert frames.rows(small.rows) == frames.rows(large.rows)
    assert frames.rows(small.rejects) == frames.rows(large.rejects)


def test_flatten(spark):
    flat = flatten_hierarchy(frames.units(spark, *TREE))
    assert frames.rows(
        flat, "facility_uid", "facility_type", "country_name", "region_uid", "district_name"
    ) == [("F1", "Clinic", "Kenya", "R", "Kilifi"), ("F2", None, "Kenya", "R", "Kilifi")]


def test_ancestor_of_wrong_level_has_no_name(spark):
    tree = [*TREE, ("F3", "Clinic 3", "/K/D/R/F3", ["Facility"])]
    got = flatten_hierarchy(frames.units(spark, *tree))
    row = got.filter("facility_uid = 'F3'").first()
    assert (row.region_uid, row.region_name, row.district_name) == ("D", None, None)
    assert row.country_name == "Kenya"


def test_deeper_tree_gets_numbered_levels(spark):
    tree = [(u, n, f"/W{p}", g) for u, n, p, g in TREE] + [("W", "World", "/W", ["Root"])]
    flat = flatten_hierarchy(frames.units(spark, *tree))
    assert "level4_name" in flat.columns and "level5_name" not in flat.columns
    row = flat.filter("facility_uid = 'F1'").first()
    assert (row.country_name, row.region_name, row.level4_name) == ("World", "Kenya", "Kilifi")


def test_shallow_leaves(spark):
    tree = [*TREE, ("T", "Togo", "/T", ["Country"]), ("FT", "Post", "/T/FT", ["Facility"])]
    units = frames.units(spark, *tree)
    assert flatten_hierarchy(units).count() == 2
    flat = flatten_hierarchy(units, leaf_rule=LEAF_WITHOUT_CHILDREN)
    assert frames.rows(flat, "facility_uid", "country_name", "region_uid") == [
        ("F1", "Kenya", "R"),
        ("F2", "Kenya", "R"),
        ("FT", "Togo", None),
    ]


def test_enrich_flags_units_that_are_no_leaves(spark):
    values = frames.values(
        spark, ("e", "202401", "F1", "c", "1", None), ("e", "202401", "D", "c", "2", None)
    )
    got = enrich_with_hierarchy(values, flatten_hierarchy(frames.units(spark, *TREE)))
    assert frames.rows(got, "orgUnit", "country_name", "is_non_leaf") == [
        ("D", None, True),
        ("F1", "Kenya", False),
    ]


def test_resolved_rows_are_written_without_a_sort_by_status(spark, out):
    values = frames.values(
        spark, ("e", "202401", "F1", "c", "1", None), ("x", "202401", "F1", "c", "2", None), ("e", "202401", "no", "c", "3", None)
    )
    args = frames.elements(spark, ("e", "E", "NUMBER", "HIV")), frames.combos(spark, "c"), frames.units(spark, *TREE)
    got = resolve_keys(values, *args, path=out)
    assert frames.rows(got.rows, "value") == [("1",)]
    assert frames.rows(got.rejects, "value", "unknown_key") == [("2", "dataElement"), ("3", "orgUnit")]
    assert not [f for f in got.rows.inputFiles() if "status=" in f]

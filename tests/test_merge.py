import random

import frames
from tallymart import schemas
from tallymart.operators import incremental
from tallymart.operators.incremental import merge_late, read_fact
from tallymart.sources.commits import publish_fact


def test_changed_partitions_are_told_by_their_rows(spark, out, monkeypatch):
    """Rows whose equals come late, scores that a late row of another area changes, nulls and stored copies."""
    rng = random.Random(5)
    made = [
        {"period": rng.choice(["202401", "202402", "202403"]), "health_area": rng.choice(["HIV", "Malaria", None]), "de_uid": rng.choice(["x", "y", None]),
         "ou_uid": rng.choice(["u", "v"]), "raw_value": rng.choice(["1", None]), "last_updated": f"2024-05-{k:02}", "completeness_score": 0.5}
        for k in range(10, 28)
    ]
    late = [*made[::4], {**made[1], "last_updated": "2024-06-01", "raw_value": "9"}, {**made[2], "last_updated": "2023-01-01"}]
    programs = spark.createDataFrame([("K", ["x", "y"])], "country string, dataElements array<string>")
    facilities = spark.createDataFrame([("u", "K"), ("v", "K")], "facility_uid string, country_name string")
    empty = frames.fact(spark, {}).limit(0)
    stored = merge_late(empty, frames.fact(spark, *made), programs, facilities).rows
    publish_fact(stored.unionByName(stored.filter("period = '202403'").orderBy('last_updated').limit(1)), out)
    stored = read_fact(spark, out)
    late = frames.fact(spark, *late)
    want = frames.rows(merge_late(empty, stored.unionByName(late), programs, facilities).rows)

    def parts(rows):
        held = {}
        for r in rows:
            place = dict(zip(schemas.FACT.names, r))
            held.setdefault((place["health_area"], place["year_month"]), []).append(r)
        return held

    before, after = parts(frames.rows(stored)), parts(want)
    changed = {p for p in before.keys() | after.keys() if before.get(p) != after.get(p)}
    seen, real = [], incremental._signatures
    monkeypatch.setattr(incremental, "_signatures", lambda df: seen.append({tuple(r) for r in df.select(*schemas.FACT_PARTITIONS).distinct().collect()}) or real(df))
    merge = merge_late(stored, late, programs, facilities)
    assert changed and changed < before.keys() | after.keys()
    assert {tuple(r) for r in merge.partitions.collect()} == changed
    assert frames.rows(merge.rows) == sorted([r for p in changed for r in after.get(p, [])], key=repr)
    # All columns are held against each other only where nothing else tells.
    assert seen and all(places.isdisjoint(changed) for places in seen)


def test_staged_merges_are_those_written_twice(spark, out, monkeypatch):
    """Of a staged run only changed partitions are read, and its rows are written once; one without a month is among them."""
    from tallymart.operators import states
    from tallymart.sources import commits
    from tallymart.sources.states import read_states

    made = [
        {"period": month, "health_area": area, "de_uid": "x", "ou_uid": unit, "raw_value": "1", "last_updated": "2024-05-01", "completeness_score": score}
        for month, unit, score in (("202401", "u", 1.0), ("202402", "u", 1.0), (None, "u", 1.0)) for area in ("HIV", None)
    ]
    # One de_uid an area, so that all are keys of their own.
    made = [{**r, "de_uid": f"{r['health_area']}", "year_month": r["period"]} for r in made]
    fixes = [
        {**made[0], "raw_value": "9", "last_updated": "2024-06-01"}, {**made[2], "last_updated": "2023-01-01"},
        {**made[4], "raw_value": "8", "last_updated": "2024-06-01"}, {**made[0], "period": "202403", "year_month": "202403"},
    ]
    programs = spark.createDataFrame([("K", ["HIV", "None"])], "country string, dataElements array<string>")
    facilities = spark.createDataFrame([("u", "K")], "facility_uid string, country_name string")
    late = frames.fact(spark, *fixes)
    paths = [f"{out}/{name}" for name in ("copied", "staged")]
    writes, real = [], commits.write_fact
    monkeypatch.setattr(commits, "write_fact", lambda *args, **options: writes.append(args[1]) or real(*args, **options))
    found = []
    for path in paths:
        publish_fact(frames.fact(spark, *made), path)
        stored = read_fact(spark, path)
        merge = merge_late(stored, late, programs, facilities, path=path if path == paths[1] else None)
        publish_fact(merge.rows, path, ended=merge.partitions, run=merge.run)
        kept = read_fact(spark, path)
        live = commits.live(spark, path).select("health_area", "year_month", "version", "rows", "files")
        merged = states.volumes_by_quarter(read_states(spark, path))
        found.append([frames.rows(df) for df in (merge.rows, merge.partitions, kept, live, merged)])
    assert found[0] == found[1]
    assert len(writes) == 4 and merge.run is not None
    versions = {(r[0], r[1]): r[2] for r in found[1][3]}
    assert versions[("HIV", "202401")] == versions[("HIV", "202403")] == versions[("HIV", None)] == 2
    assert versions[("HIV", "202402")] == versions[(None, "202402")] == 1

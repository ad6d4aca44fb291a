import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import frames
from tallymart import schemas
from tallymart.plans import fixture
from tallymart.sources import documents, exports, pieces, sinks

VALUE = {"dataElement": "e", "period": "202401", "orgUnit": "u", "value": "1"}


def write(path, text):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text)


def test_file_and_line_layout_agree(spark, tmp_path):
    docs = [{"version": "1", "dataValues": [{**VALUE, "value": str(i)}, VALUE]} for i in range(3)]
    for i, doc in enumerate(docs):
        write(tmp_path / f"files/{i}.json", json.dumps(doc, indent=2))
    write(tmp_path / "lines.json", "\n".join(json.dumps(d) for d in docs) + "\n\n")

    def read(path, layout):
        found = documents.read_documents(
            spark, str(tmp_path / path), schemas.DATA_VALUE_DOCUMENT, layout
        )
        return frames.rows(documents.parse_and_explode(found, "dataValues"), "value", "orgUnit")

    assert read("files", "file") == read("lines.json", "line")
    assert len(read("files", "file")) == 6
    with pytest.raises(ValueError):
        documents.read_documents(spark, "x", schemas.DATA_VALUE_DOCUMENT, "csv")


def test_nothing_is_lost_without_a_trace(spark, tmp_path):
    lines = [
        json.dumps({"dataValues": [VALUE, None, {**VALUE, "orgUnit": None, "period": None}]}),
        json.dumps({"dataValues": [VALUE]})[:-5],
        json.dumps({"version": "1"}),
        json.dumps({"dataValues": []}),
        "no json",
    ]
    write(tmp_path / "data_values.json", "\n".join(lines))
    loaded = exports.load_data_values(spark, str(tmp_path), layout="line")
    assert loaded.rows.count() == 1
    assert frames.rows(loaded.rejects, "quarantine_reason") == [
        ("missing: dataElement, period, orgUnit",),
        ("missing: period, orgUnit",),
    ]
    assert [t for t, in frames.rows(loaded.lost_documents, "lost_text")] == sorted(
        [lines[1], lines[2], lines[4]], key=lambda t: repr((t,))
    )


def test_missing_value_is_no_reject(spark):
    df = frames.values(spark, ("e", "202401", "u", "c", None, None))
    clean, rejected = documents.split_quarantine(df, exports.DATA_VALUES.critical)
    assert clean.count() == 1 and rejected.count() == 0
    assert clean.columns == df.columns


def exported(tmp_path):
    unit = {"id": "u", "name": "Unit", "level": 1, "path": "/u", "groups": [{"id": "g", "name": "G"}]}
    write(
        tmp_path / "metadata.json",
        json.dumps(
            {
                "dataElements": [
                    {"id": "e", "name": "E", "valueType": "NUMBER"},
                    {"id": "f", "name": "F"},
                ],
                "categoryOptionCombos": [{"id": "c", "name": "C"}, {"name": "D"}],
            }
        ),
    )
    write(
        tmp_path / "org_units.json",
        json.dumps({"organisationUnits": [unit, {**unit, "level": None}]}),
    )
    write(
        tmp_path / "programs.json",
        json.dumps({"programs": [{"id": "p", "healthArea": "A", "country": "K"}]}),
    )
    values = [VALUE] * 3 + [{**VALUE, "orgUnit": None}]
    write(tmp_path / "data_values.json", json.dumps({"dataValues": values}))
    return str(tmp_path)


def test_ingest_all(spark, tmp_path, out):
    got = exports.ingest_all(spark, exported(tmp_path), out)
    assert got.quarantine_rate == 0.25
    assert got.counts["data_values"] == {"clean": 3, "rejected": 1, "lost": 0}
    assert got.elements.count() == got.option_combos.count() == got.org_units.count() == 1
    assert got.values.columns == schemas.DATA_VALUE.names
    metadata = spark.read.parquet(f"{out}/quarantine/schema/metadata")
    assert frames.rows(metadata, "source", "id", "name") == [
        ("categoryOptionCombo", None, "D"),
        ("dataElement", "f", "F"),
    ]
    # a reject with nested columns is kept as it is
    unit = spark.read.parquet(f"{out}/quarantine/schema/org_units").first()
    assert unit.groups[0].name == "G" and unit.quarantine_reason.endswith("level")
    assert spark.read.parquet(f"{out}/quarantine/schema/programs").count() == 0


def test_single_loaders_agree_with_ingest_all(spark, tmp_path, out):
    path = exported(tmp_path)
    got = exports.ingest_all(spark, path, out)
    metadata = exports.load_metadata(spark, path)
    assert frames.rows(metadata.elements) == frames.rows(got.elements)
    assert frames.rows(metadata.option_combos) == frames.rows(got.option_combos)
    assert metadata.rejects.count() == 2 and metadata.lost_documents.count() == 0
    assert frames.rows(exports.load_org_units(spark, path).rows) == frames.rows(got.org_units)
    assert frames.rows(exports.load_programs(spark, path).rows) == frames.rows(got.programs)


def test_csv_keeps_nested_columns_as_json(spark, out):
    df = frames.units(spark, ("u", 'Unit "one"', "/u", ["G"]))
    sinks.write_rejects(df, out, fmt="csv")
    row = spark.read.csv(out, header=True, escape='"').first()
    assert row["name"] == 'Unit "one"'
    assert json.loads(row["groups"]) == [{"id": "g", "name": "G"}]


def test_report_is_one_sorted_file(spark, out):
    df = spark.range(100).repartition(4).withColumn("t", F.lit("x"))
    sinks.write_report(df, out, order=[F.desc("id")], single_file=True)
    files = list(Path(out).glob("*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert lines[0] == "id,t" and lines[1] == "99,x" and lines[-1] == "0,x"


def test_rewrite_replaces_stale_rejects(spark, out):
    sinks.write_rejects(spark.range(3), out)
    sinks.write_rejects(spark.range(0), out)
    assert spark.read.parquet(out).count() == 0


def tagged_rows(spark, path, layout):
    tagged = exports.tagged_export(spark, exports.DATA_VALUES, str(path), layout)
    return frames.rows(tagged, *schemas.DATA_VALUE.names, "status", "quarantine_reason", "lost_text")


TRICKY = {
    "compact": json.dumps({"version": "1", "dataValues": [VALUE, {**VALUE, "orgUnit": None}]}),
    "indented": json.dumps({"version": "1", "dataValues": [VALUE] * 3}, indent=2) + "\n",
    "scalars_after": json.dumps({"dataValues": [VALUE], "version": "1"}),
    "escapes": json.dumps({"dataValues": [{**VALUE, "value": 'a"b\\'}, {**VALUE, "value": "\\\""}]}),
    "closing_brace": json.dumps({"dataValues": [{**VALUE, "value": "a}b"}, VALUE]}),
    "opening_brace": json.dumps({"dataValues": [{**VALUE, "value": "a{b"}, VALUE]}),
    "both": json.dumps({"dataValues": [{**VALUE, "value": '"},{"dataElement":"x"'}, VALUE]}),
    "nested": json.dumps({"dataValues": [{**VALUE, "extra": {"a": 1}}, VALUE]}),
    "header_object": json.dumps({"pager": {"page": 1}, "dataValues": [VALUE]}),
    "empty": json.dumps({"dataValues": []}),
    "no_array": json.dumps({"version": "1"}),
    "null_item": json.dumps({"dataValues": [VALUE, None]}),
    "cut_in_element": json.dumps({"dataValues": [VALUE, VALUE]})[:-12],
    "cut_after_element": json.dumps({"dataValues": [VALUE, VALUE]})[:-2],
    "missing_comma": '{"dataValues":[{"dataElement":"e"} {"dataElement":"f"}]}',
    "other_array": json.dumps({"values": [VALUE]}),
    "unicode": json.dumps({"dataValues": [{**VALUE, "storedBy": "Zoë ﷽"}]}, ensure_ascii=False),
}


@pytest.mark.parametrize("name", TRICKY)
def test_split_layout_gives_the_rows_of_the_whole_file(spark, tmp_path, name):
    write(tmp_path / "doc.json", TRICKY[name])
    assert tagged_rows(spark, tmp_path / "doc.json", "split") == tagged_rows(
        spark, tmp_path / "doc.json", "file"
    )


def test_split_layout_uses_many_tasks_and_mixes_files(spark, tmp_path):
    many = [{**VALUE, "value": str(i)} for i in range(20_000)]
    write(tmp_path / "in/large one.json", json.dumps({"dataValues": many}))
    write(tmp_path / "in/odd one.json", TRICKY["both"])
    whole = tagged_rows(spark, tmp_path / "in", "file")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "256KB")
        spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        tagged = exports.tagged_export(spark, exports.DATA_VALUES, str(tmp_path / "in"), "split")
        assert tagged.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        assert tagged_rows(spark, tmp_path / "in", "split") == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def odd_text(rng):
    return "".join(rng.choice(["a", "}", "{", "[", "]", '"', "\\", ",", ":", " ", "é", '"dataValues":[', "null", "\n"]) for _ in range(rng.randrange(9)))


def nested(rng, depth=0):
    kind = rng.randrange(5 if depth < 3 else 2)
    if kind < 2:
        return rng.choice([None, 7, True, odd_text(rng)])
    if kind == 2:
        return [nested(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {odd_text(rng) if rng.random() < 0.5 else "dataValues": nested(rng, depth + 1) for _ in range(rng.randrange(3))}


def random_document(rng):
    """A document whose elements hold nested objects, and strings that look like structure."""
    items = []
    for k in range(rng.randrange(1, 40)):
        item = {"extra": nested(rng), **VALUE, "value": odd_text(rng), "storedBy": str(k)}
        items.append(None if rng.random() < 0.1 else item if rng.random() < 0.8 else {**item, "orgUnit": None})
    around = {odd_text(rng) + "x": nested(rng) for _ in range(rng.randrange(3))}
    after = {odd_text(rng) + "y": nested(rng) for _ in range(rng.randrange(3))}
    text = json.dumps({**around, "dataValues": items, **after}, indent=rng.choice([None, 1]), ensure_ascii=False)
    state = rng.random()
    return text[: rng.randrange(len(text))] if state < 0.15 else text + "\n" * rng.randrange(2) if state < 0.9 else text + "}"


@pytest.mark.parametrize("block", ["300", "128MB"])
def test_elements_across_the_borders_of_blocks(spark, tmp_path, block):
    rng = random.Random(block)
    for k in range(6):
        write(tmp_path / f"in/{k}.json", random_document(rng))
    write(tmp_path / "in/empty.json", "")
    columns = [*schemas.DATA_VALUE.names, "source", "status", "quarantine_reason"]
    whole = exports.tagged_export(spark, exports.DATA_VALUES, str(tmp_path / "in"), "file")
    # A text that whole parsing takes up to its end, though more follows, is no sound document in pieces.
    ended = {str(p) for p in (tmp_path / "in").iterdir() if not p.read_text().endswith("}}")}
    sources = [f"file://{p}" for p in ended] + [f"file:{p}" for p in ended]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = exports.tagged_export(spark, exports.DATA_VALUES, str(tmp_path / "in"), "split").filter(F.col("source").isin(sources))
        kept = got.filter("status <> 'lost'")
        name = F.regexp_replace("source", "^.*/", "")
        texts = {}
        for r in got.filter("status = 'lost'").select(name.alias("s"), "lost_text").collect():
            texts[r.s] = texts.get(r.s, 0) + len(r.lost_text)
        mine = frames.rows(kept.withColumn("source", name), *columns)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = whole.filter(F.col("source").isin(sources)).withColumn("source", name)
    assert mine == frames.rows(whole.filter("status <> 'lost'"), *columns) and len(mine) > 20
    lost = {r.source: len(r.lost_text) for r in whole.filter("status = 'lost'").collect()}
    assert texts == lost


def test_rows_of_a_document_do_not_carry_the_parsed_document(spark, tmp_path):
    items = [{"id": f"U{i}", "name": "n" * 500, "level": 4} for i in range(300)]
    (tmp_path / "units.json").write_text(json.dumps({"organisationUnits": items}) + "\n" + '{"version": "1"}\n')
    tagged = exports.tagged_export(spark, exports.ORG_UNITS, str(tmp_path / "units.json"), "line")
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    generates = [line for line in plan.splitlines() if "Generate " in line]
    assert generates and not [line for line in generates if "[document#" in line]
    found = {(r.status, r.id, r.lost_text) for r in tagged.collect()}
    assert found == {("clean", i["id"], None) for i in items} | {("lost", None, '{"version": "1"}')}


def test_split_documents_are_not_scanned_again_for_each_kind_of_row(spark, tmp_path):
    write(tmp_path / "values.json", json.dumps({"dataValues": [{**VALUE, "detail": {"a": [{}]}}, None, VALUE]}))
    tagged = exports.tagged_export(spark, exports.DATA_VALUES, str(tmp_path / "values.json"), "split")
    assert frames.rows(tagged, "status") == [("clean",), ("clean",), ("rejected",)]
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_split_documents_are_read_once_and_parsed_once(spark, tmp_path, monkeypatch):
    write(tmp_path / "values.json", json.dumps({"dataValues": [{**VALUE, "detail": {"a": [{}]}}, VALUE, None]}))
    reads, real = [], pieces.written

    def seen(df, name):
        reads.extend([name] * any(f.endswith("values.json") for f in df.inputFiles()))
        return real(df, name)

    monkeypatch.setattr(pieces, "written", seen)
    tagged = exports.tagged_export(spark, exports.DATA_VALUES, str(tmp_path / "values.json"), "split")
    clean = tagged.filter(F.col("status") == documents.CLEAN)
    assert len(reads) == 1 and clean.count() == 2
    # a filter of parsed fields does not parse the text once more for each of them
    assert clean._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_packed_documents_hold_all_rows_in_order(spark):
    rows = spark.range(25, numPartitions=1).select("id", F.lit("é\"").alias("t"))
    got = [json.loads(r.value) for r in fixture.packed_documents(rows, {"v": "1"}, "items", 10).collect()]
    assert [list(d) for d in got] == [["v", "items"]] * 3
    assert [[i["id"] for i in d["items"]] for d in got] == [[*range(10)], [*range(10, 20)], [*range(20, 25)]]
    assert fixture.packed_documents(rows.filter("id < 0"), {"v": "1"}, "items", 10).count() == 0

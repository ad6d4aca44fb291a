import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

import frames
from tallymart.operators import anomaly, crosscut, framing, trends
from tallymart.operators.framing import _pieces, with_row_frame
from tallymart.plans import reports


def month(i):
    return f"{2020 + i // 12}{i % 12 + 1:02d}"


def test_month_over_month(spark):
    fact = frames.fact(
        spark,
        {"period": "202401", "numeric_value": 4.0},
        {"period": "202401", "numeric_value": 4.0, "ou_uid": "v"},
        {"period": "202401", "numeric_value": None, "ou_uid": "w"},
        {"period": "202402", "numeric_value": 9.0},
        {"period": "202404", "numeric_value": 0.0},
        {"period": "202405", "numeric_value": 3.0},
        {"period": "202405", "numeric_value": 7.0, "country_name": "Togo"},
    )
    columns = ("country_name", "period", "total_value", "mom_pct_change")
    assert frames.rows(trends.mom_pct_change(fact), *columns) == [
        ("Kenya", "202401", 8.0, None),
        ("Kenya", "202402", 9.0, 12.5),
        ("Kenya", "202404", 0.0, -100.0),
        ("Kenya", "202405", 3.0, None),
        ("Togo", "202405", 7.0, None),
    ]
    aware = trends.mom_pct_change(fact, gap_aware=True)
    assert aware.filter("period = '202404'").first().mom_pct_change is None
    assert aware.filter("period = '202402'").first().mom_pct_change == 12.5


def test_rows_are_not_sorted_to_be_added_up(spark, capsys):
    fact = frames.fact(spark, {"period": "202401"}, {"period": "202402"})
    for report in (trends.mom_pct_change(fact), crosscut.coverage_matrix(fact, ["Kenya"])):
        report.explain()
        # the deepest aggregate, printed last, is the one over the rows
        steps = [line for line in capsys.readouterr().out.splitlines() if "Aggregate" in line]
        assert "HashAggregate" in steps[-1]


def random_fact(spark, n=400, seed=3):
    rng = random.Random(seed)
    seen, changes = set(), []
    for _ in range(n):
        key = (rng.choice(["hot"] * 5 + ["u", "v"]), rng.choice("ab"), rng.randint(0, 30), rng.choice("cde"))
        if key not in seen:
            seen.add(key)
            unit, element, i, combo = key
            value = rng.choice([None, 0.0, 1.0, 2.0, 2.0, 3.0, 50.0])
            changes.append(
                {
                    "ou_uid": unit,
                    "de_uid": element,
                    "period": month(i),
                    "coc_uid": combo,
                    "numeric_value": value,
                    "is_missing_value": value is None,
                }
            )
    return frames.fact(spark, *changes), changes


def groups_of(changes):
    groups = {}
    for c in changes:
        groups.setdefault((c["ou_uid"], c["de_uid"]), []).append(c)
    for rows in groups.values():
        rows.sort(key=lambda c: (c["period"], c["coc_uid"]))
    return groups


@pytest.mark.parametrize("hot_rows", [None, 60, 1])
@pytest.mark.parametrize("months", [2, 3, 7])
def test_rolling_mean_by_brute_force(spark, hot_rows, months):
    fact, changes = random_fact(spark)
    expected = []
    for rows in groups_of(changes).values():
        for i, c in enumerate(rows):
            values = [
                r["numeric_value"]
                for r in rows[max(0, i - months + 1) : i + 1]
                if r["numeric_value"] is not None
            ]
            mean = round(sum(values) / len(values), 4) if values else None
            expected.append((c["ou_uid"], c["de_uid"], c["period"], c["numeric_value"], mean))
    got = trends.rolling_avg(fact, months=months, hot_rows=hot_rows)
    assert frames.rows(
        got, "ou_uid", "de_uid", "period", "numeric_value", f"rolling_avg_{months}m"
    ) == sorted(expected, key=repr)


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_calendar_mean_by_brute_force(spark, hot_rows):
    fact, changes = random_fact(spark)
    index = {month(i): i for i in range(31)}
    expected = []
    for rows in groups_of(changes).values():
        for c in rows:
            values = [
                r["numeric_value"]
                for r in rows
                if 0 <= index[c["period"]] - index[r["period"]] <= 2
                and r["numeric_value"] is not None
            ]
            mean = round(sum(values) / len(values), 4) if values else None
            expected.append((c["ou_uid"], c["de_uid"], c["period"], c["numeric_value"], mean))
    got = trends.rolling_avg(fact, by_calendar=True, hot_rows=hot_rows)
    assert frames.rows(
        got, "ou_uid", "de_uid", "period", "numeric_value", "rolling_avg_3m"
    ) == sorted(expected, key=repr)


def test_null_keys_give_the_same_rows_whatever_the_size(spark):
    fact, _ = random_fact(spark, n=300)
    fact = fact.withColumns(
        {
            "ou_uid": F.when(F.col("month") % 2 == 0, F.col("ou_uid")),
            "de_uid": F.when(F.col("month") % 3 != 0, F.col("de_uid")),
            "coc_uid": F.monotonically_increasing_id().cast("string"),  # a total order
        }
    )
    fact = fact.sparkSession.createDataFrame(fact.collect(), fact.schema)
    for report in (
        lambda hot: trends.rolling_avg(fact, hot_rows=hot),
        lambda hot: trends.rolling_avg(fact, by_calendar=True, hot_rows=hot),
        lambda hot: anomaly.sigma_anomalies(fact, sigmas=1.5, hot_rows=hot),
    ):
        runs = [frames.rows(report(hot)) for hot in (None, 1, 20)]
        assert runs[0] and runs[0] == runs[1] == runs[2]


@pytest.mark.parametrize("hot_rows", [None, 1])
@pytest.mark.parametrize("current", [True, False])
def test_anomalies_by_brute_force(spark, hot_rows, current):
    fact, changes = random_fact(spark, n=800)
    expected = []
    for rows in groups_of([c for c in changes if (c["numeric_value"] or 0) > 0]).values():
        for i, c in enumerate(rows):
            frame = rows[max(0, i - 11) : i + 1] if current else rows[max(0, i - 12) : i]
            values = [r["numeric_value"] for r in frame]
            if len(values) < 3 or statistics.pstdev(values) == 0:
                continue
            z = abs(c["numeric_value"] - statistics.fmean(values)) / statistics.pstdev(values)
            if z > 1.95 and not math.isclose(z, 1.95):
                expected.append((c["ou_uid"], c["de_uid"], c["period"], round(z, 2), len(values)))
    got = anomaly.sigma_anomalies(fact, sigmas=1.95, include_current=current, hot_rows=hot_rows)
    assert expected
    assert frames.rows(got, "ou_uid", "de_uid", "period", "z_score", "window_count") == sorted(
        expected, key=repr
    )


def test_three_sigma_needs_eleven_rows(spark):
    def outliers(n):
        rows = [{"period": month(i), "numeric_value": 10.0} for i in range(n - 1)]
        fact = frames.fact(spark, *rows, {"period": month(n - 1), "numeric_value": 900.0})
        return anomaly.sigma_anomalies(fact).count()

    assert [outliers(n) for n in (9, 11, 12)] == [0, 1, 1]


def test_frame_has_to_look_back(spark):
    with pytest.raises(ValueError):
        with_row_frame(spark.range(1), ["id"], ["id"], (0, 0), ["id"], {"n": F.count("id")})


def test_a_group_with_most_rows_in_one_month_is_cut_within_it(spark):
    # Half of all rows are of one unit, nine tenths of them in one month.
    rows = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 300).cast("string")).alias("unit"),
        F.when(F.col("id") % 20 < 18, F.lit("202405")).otherwise((F.col("id") % 7).cast("string")).alias("period"),
        F.hex(F.xxhash64("id")).alias("combo"),
        (F.col("id") % 11).cast("double").alias("value"),
    )
    order = ["period", "combo"]
    pieces = _pieces(rows.filter("unit = 'hot'"), ["unit"], order, 30).filter("period = '202405'")
    sizes = [r["count"] for r in pieces.groupBy("_piece").count().collect()]
    assert len(sizes) >= 20 and sum(sizes) == 2700 and max(sizes) < 500

    def framed(hot_rows):
        means = {"mean": F.avg("value"), "n": F.count(F.lit(1))}
        return frames.rows(with_row_frame(rows, ["unit"], order, (-3, 0), ["value"], means, hot_rows))

    assert framed(None) == framed(100)


def test_reporting_rate(spark):
    facilities = spark.createDataFrame(
        [("a", "Kenya"), ("b", "Kenya"), ("c", "Kenya"), ("d", "Togo")],
        "facility_uid string, country_name string",
    )
    fact = frames.fact(
        spark,
        {"ou_uid": "a", "period": "202401"},
        {"ou_uid": "a", "period": "202401", "coc_uid": "other"},
        {"ou_uid": "b", "period": "202401", "numeric_value": None},
        {"ou_uid": "c", "period": "202401", "numeric_value": None, "is_explicit_zero": True},
        {"ou_uid": "b", "period": "202403"},
    )
    columns = ("country_name", "period", "actual_facilities", "reporting_rate_pct")
    assert frames.rows(trends.reporting_rate(fact, facilities), *columns) == [
        ("Kenya", "202401", 2, 66.67),
        ("Kenya", "202403", 1, 33.33),
    ]
    dense = frames.rows(trends.reporting_rate(fact, facilities, densify=True), *columns)
    assert len(dense) == 6 and ("Togo", "202402", 0, 0.0) in dense


def test_underreporting_keeps_ties(spark):
    changes = [
        {"ou_uid": f"u{i}", "facility_name": f"u{i}", "period": month(m), "numeric_value": 0.0}
        for i in range(7)
        for m in range(2 if i < 6 else 1)
    ]
    changes += [{"ou_uid": "fine", "period": month(0), "numeric_value": 3.0}]
    changes += [{"ou_uid": "fine", "period": month(0), "numeric_value": None, "coc_uid": "z"}]
    got = trends.top_underreporting(frames.fact(spark, *changes))
    assert frames.rows(got, "ou_uid", "zero_periods", "rank_in_health_area") == [
        (f"u{i}", 2, 1) for i in range(6)
    ]


def test_volumes(spark):
    fact = frames.fact(
        spark,
        {"period": "202401", "numeric_value": 0.0},
        {"period": "202403", "numeric_value": 5.0, "de_uid": "b"},
        {"period": "202403", "numeric_value": None, "ou_uid": "z"},
    )
    got = crosscut.volumes_by_quarter(fact)
    assert frames.rows(got) == [("Malaria", "2024Q1", 2024, 5.0, 1, 2, 2)]


def test_comparison_weights(spark):
    fact = frames.fact(
        spark,
        *[{"ou_uid": "a", "coc_uid": str(i), "completeness_score": 1.0} for i in range(3)],
        {"ou_uid": "b", "completeness_score": 0.0},
        {"ou_uid": "c", "completeness_score": None},
    )
    by_row = crosscut.completeness_comparison(fact).first()
    by_unit = crosscut.completeness_comparison(fact, weight=crosscut.BY_FACILITY).first()
    assert (by_row.avg_completeness, by_unit.avg_completeness) == (0.75, 0.5)
    assert by_row.reporting_facilities == by_unit.reporting_facilities == 3
    with pytest.raises(ValueError):
        crosscut.completeness_comparison(fact, weight="size")


def test_coverage(spark):
    fact = frames.fact(
        spark,
        {"de_uid": "a"},
        {"de_uid": "a", "country_name": "Togo", "numeric_value": None, "health_area": "HIV"},
        {"de_uid": "b", "country_name": None},
        {"de_uid": "c", "numeric_value": None},
    )
    got = crosscut.coverage_matrix(fact, ["Kenya", "Togo"], unknown="unknown")
    assert frames.rows(got, "de_uid", "Kenya", "Togo", "unknown", "health_area") == [
        ("a", 1, 0, 0, "HIV"),
        ("b", 0, 0, 1, "Malaria"),
    ]
    assert crosscut.coverage_matrix(fact).columns == ["de_uid", "Kenya", "de_name", "health_area"]


def test_runs(spark):
    def runs(months, **options):
        fact = frames.fact(
            spark,
            *[{"period": month(i), "completeness_score": 0.5} for i in months],
            {"period": month(40), "completeness_score": 0.9},
        )
        got = crosscut.low_runs(fact, **options)
        return frames.rows(
            got, "run_start_period", "run_end_period", "consecutive_periods", "avg_completeness_in_run"
        )

    assert runs([0, 1]) == []
    assert runs([0, 1, 2]) == [(month(0), month(2), 3, 0.5)]
    assert runs([0, 1, 3]) == [(month(0), month(3), 3, 0.5)]
    assert runs([0, 1, 3], gap_aware=True) == []
    assert runs([39, 41, 42, 43]) == [(month(41), month(43), 3, 0.5)]


def test_tasks_of_cut_groups_do_not_grow_with_the_pieces(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 40).alias("unit"), F.col("id").alias("at"), (F.col("id") % 7).cast("double").alias("value")
    )

    def framed(hot_rows):
        return with_row_frame(rows, ["unit"], ["at"], (-3, 0), ["value"], {"mean": F.avg("value")}, hot_rows)

    found = framed(5)
    assert len([f for f in found.inputFiles() if "/pieces/" in f]) < 40  # 800 pieces
    assert frames.rows(found) == frames.rows(framed(None))


def test_the_written_matrix_has_the_countries_asked_for(spark, out):
    fact = frames.fact(spark, {"period": "202401", "numeric_value": 4.0})
    reports.run_aggregation(fact, out, countries=["Kenya", "Togo"])
    matrix = spark.read.csv(f"{out}/cross_country/coverage_matrix", header=True)
    assert frames.rows(matrix, "Kenya", "Togo") == [("1", "0")]
    reports.run_aggregation(fact, f"{out}/reported")
    assert "Togo" not in spark.read.csv(f"{out}/reported/cross_country/coverage_matrix", header=True).columns


def columns_written(monkeypatch):
    found, real = [], framing.written
    monkeypatch.setattr(framing, "written", lambda df, name: found.extend(df.columns) or real(df, name))
    return found


def test_anomalies_of_cut_groups_write_what_they_read(spark, monkeypatch):
    fact, _ = random_fact(spark)
    found = columns_written(monkeypatch)
    cut = frames.rows(anomaly.sigma_anomalies(fact, sigmas=1.5, hot_rows=20))
    assert "numeric_value" in found and not {"raw_value", "stored_by", "last_updated", "is_missing_value"} & set(found)
    assert cut and cut == frames.rows(anomaly.sigma_anomalies(fact, sigmas=1.5, hot_rows=None))


def test_rolling_means_of_cut_groups_write_what_they_read(spark, monkeypatch):
    fact, _ = random_fact(spark)
    found = columns_written(monkeypatch)
    cut = frames.rows(trends.rolling_avg(fact, hot_rows=20))
    assert "numeric_value" in found and not {"raw_value", "stored_by", "last_updated", "is_missing_value"} & set(found)
    assert cut and cut == frames.rows(trends.rolling_avg(fact, hot_rows=None))

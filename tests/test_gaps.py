import random

import pytest

import frames
from tallymart.operators import gaps, quality, trends

FACILITIES = "facility_uid string, country_name string"


def number(period):
    return int(period[:4]) * 12 + int(period[4:]) - 1


def name(i):
    return f"{i // 12:04d}{i % 12 + 1:02d}"


def spans_of(periods, max_gap):
    spans = []
    for i in sorted({number(p) for p in periods}):
        if spans and i - spans[-1][1] <= max_gap + 1:
            spans[-1][1] = i
        else:
            spans.append([i, i])
    return [tuple(s) for s in spans]


def reports(spark, *pairs):
    return frames.values(spark, *[("a", p, u, "c", "1", None) for u, p in pairs])


def test_spans(spark):
    odd = ["999912", "000001", "202413", "2024", "20240", "2024 3", "2024031", "x", "", None]
    near = ["202401", "202403", "202601", "195005"]
    values = reports(spark, *[("u", p) for p in odd + near])
    main = number("202401")
    stray = (number("195005"),) * 2
    assert gaps.reported_spans(values) == [stray, (main, main + 24)]
    assert gaps.reported_spans(values, max_gap=21) == [stray, (main, main + 24)]
    assert gaps.reported_spans(values, max_gap=20) == [stray, (main, main + 2), (main + 24,) * 2]
    assert gaps.reported_spans(values, plausible=("202402", "202412")) == [(main + 2, main + 2)]
    assert gaps.reported_spans(values.limit(0)) == []
    with pytest.raises(ValueError):
        gaps.reported_spans(values, max_gap=0)


@pytest.mark.parametrize("max_gap", [1, 3, 24])
def test_silent_months_by_brute_force(spark, max_gap):
    rng = random.Random(max_gap)
    units = ["u", "v", "w", "silent", None]
    pairs = {(rng.choice(["u", "v", "w", "gone", None]), name(24_000 + rng.randint(0, 60))) for _ in range(60)}
    pairs |= {("u", "999912"), ("v", None), ("w", "odd")}
    rows = spark.createDataFrame([(u, p, 1) for u, p in sorted(pairs, key=repr)], "unit string, period string, n int")
    everyone = spark.createDataFrame([(u,) for u in units + ["u"]], "unit string")
    spans = gaps.reported_spans(rows, max_gap=max_gap)
    months = [p for _, p in pairs if p not in (None, "odd", "999912")]
    assert spans == spans_of(months, max_gap)
    grid = {(u, name(i)) for u in units for first, last in spans for i in range(first, last + 1)}
    expected = [(u, p, 1) for u, p in pairs] + [(u, p, None) for u, p in grid - pairs]
    got = gaps.with_silent_months(rows, everyone, ["unit"], spans)
    assert got.columns == rows.columns
    assert frames.rows(got) == sorted(expected, key=repr)
    # Repeated rows stay, and change no run.
    twice = gaps.with_silent_months(rows.unionByName(rows), everyone, ["unit"], spans)
    assert frames.rows(twice) == sorted(expected + [(u, p, 1) for u, p in pairs], key=repr)


def test_silent_runs_are_runs(spark):
    facilities = spark.createDataFrame([("u", "K"), ("v", "K"), ("w", "K")], FACILITIES)
    values = reports(
        spark, ("u", "202402"), ("u", "202405"), ("v", "202401"), ("v", "202406"), ("gone", "202403"), ("u", "210001")
    )
    columns = ("facility_uid", "first_period", "last_period", "months")
    assert frames.rows(gaps.silent_runs(values, facilities), *columns) == [
        ("u", "202401", "202401", 1),
        ("u", "202403", "202404", 2),
        ("u", "202406", "202406", 1),
        ("v", "202402", "202405", 4),
        ("v", "210001", "210001", 1),
        ("w", "202401", "202406", 6),
        ("w", "210001", "210001", 1),
    ]
    assert gaps.silent_runs(values.limit(0), facilities).count() == 0
    assert gaps.silent_runs(values, facilities.limit(0)).count() == 0


def test_a_stray_month_adds_no_years(spark):
    facilities = spark.createDataFrame([("u", "K"), ("v", "K"), ("w", "T")], FACILITIES)
    programs = frames.programs(spark, ("p", "HIV", "K", ["a"]))
    values = reports(spark, ("u", "202401"), ("u", "202404"), ("v", "999912"), ("v", "195001"))
    scores = frames.rows(
        quality.completeness_scores(values, programs, facilities, densify=True),
        "orgUnit", "period", "completeness_score",
    )
    # Four months and 195001 for each of three, and the month that is not plausible as it came.
    assert len(scores) == 16
    assert ("v", "999912", 1.0) in scores and ("v", "202402", 0.0) in scores and ("w", "195001", None) in scores
    fact = frames.fact(
        spark,
        *[{"ou_uid": u, "period": p, "country_name": "K"} for u, p in (("u", "202401"), ("u", "202404"), ("v", "999912"))],
    )
    rates = frames.rows(
        trends.reporting_rate(fact, facilities, densify=True),
        "country_name", "period", "actual_facilities", "reporting_rate_pct",
    )
    assert len(rates) == 9
    assert ("K", "202402", 0, 0.0) in rates and ("K", "999912", 1, 50.0) in rates and ("T", "202404", 0, 0.0) in rates

"""Each rule with an input that passes and one that fails."""

import pytest

from rivulet import ValidationError, schemas
from rivulet.operators import checks, flatten, lookup
from tests.conftest import NEW, SEARCH, doc, landing, offering, reading
from tests.test_merge import measure

PARAMS = 2
STATION = ("W1", "L", None, 1.0, 2.0, 3, 4, None, NEW)
GOOD = measure(1, when="2026-02-25T00:00:00+00:00")
FACT = (1, 11, *GOOD[2:])


def violated(report):
    return {r.seq: r.violations for r in report.collect() if not r.ok}


def rows_landed(spark, stations, readings, other=0):
    rows = [(SEARCH, "{}", NEW)] * stations + [("Readings_Latest", "{}", NEW)] * readings
    return landing(spark, *rows, *[("other", "{}", NEW)] * other) if rows or other else (
        schemas.empty(spark, schemas.RAW_LANDING))


@pytest.mark.parametrize(
    ("stations", "readings", "other", "want"),
    [(1, 2, 0, {}), (0, 2, 1, {1: 1}), (1, 1, 1, {2: 1}), (0, 2, 0, {1: 1, 3: 1}),
     (0, 0, 0, {1: 1, 2: 2, 3: 3})],
)
def test_landing_rules(spark, stations, readings, other, want):
    assert violated(checks.landing_checks(rows_landed(spark, stations, readings, other), PARAMS)) == want


def frames(spark, stations=(STATION,), measures=(GOOD,)):
    def frame(rows, layout):
        if rows is None:
            return None
        return spark.createDataFrame(list(rows), layout) if rows else schemas.empty(spark, layout)

    return frame(stations, schemas.STATION), frame(measures, schemas.MEASURE)


def nothing(spark, first=schemas.STATION, second=schemas.MEASURE):
    return schemas.empty(spark, first), schemas.empty(spark, second)


LAYERS = [(checks.bronze_checks, 4), (checks.silver_checks, 12)]


@pytest.mark.parametrize(("layer", "first"), LAYERS)
def test_layer_passes(spark, layer, first):
    report = layer(*frames(spark), nothing(spark))
    assert violated(report) == {}
    assert sorted(r.seq for r in report.collect()) == list(range(first, first + report.count()))


@pytest.mark.parametrize(("layer", "first"), LAYERS)
def test_missing_and_empty_tables(spark, layer, first):
    found = violated(layer(None, None, nothing(spark)))
    assert found == {first: 1, first + 1: 1, first + 2: 1, first + 3: 1}
    found = violated(layer(*frames(spark, (), ()), nothing(spark)))
    assert found == {first + 2: 1, first + 3: 1}


@pytest.mark.parametrize(("layer", "first"), LAYERS)
def test_field_timestamp_and_duplicate_rules(spark, layer, first):
    bad = [
        GOOD,
        measure(2, when="2026-02-25T00:00:00+00:00"),  # the same key again
        measure(3, when="2026-02-30T00:00:00Z"),
        measure(4, when="2026-02-26", unit=""),
        measure(5, when="2026-02-27", parameter=None),
    ]
    found = violated(layer(*frames(spark, measures=bad), nothing(spark)))
    assert found == {first + 5: 2, first + 6: 1, first + 7: 1}
    both_spellings = [measure(1), measure(2, when="2026-02-25T00:00:00+00:00")]
    assert violated(layer(*frames(spark, measures=both_spellings), nothing(spark))) == {}


def test_label_is_required_in_bronze_only(spark):
    unlabelled = ("W1", "", *STATION[2:])
    assert violated(checks.bronze_checks(*frames(spark, [unlabelled]), nothing(spark))) == {8: 1}
    assert violated(checks.silver_checks(*frames(spark, [unlabelled]), nothing(spark))) == {}
    unstamped = (*STATION[:-1], None)
    assert violated(checks.silver_checks(*frames(spark, [unstamped]), nothing(spark))) == {16: 1}


@pytest.mark.parametrize(("layer", "first"), LAYERS)
def test_timestamp_sample_looks_at_the_newest_rows_only(spark, layer, first):
    rows = [measure(1, when="bad")] + [measure(i, when=f"2026-02-{i:02d}") for i in range(2, 26)]
    data = frames(spark, measures=rows)
    assert violated(layer(*data, nothing(spark), sample=20)) == {}
    assert violated(layer(*data, nothing(spark))) == {first + 6: 1}
    late = frames(spark, measures=[*rows, measure(30, when="worse")])
    assert violated(layer(*late, nothing(spark), sample=20)) == {first + 6: 1}


def test_orphan_rule(spark):
    rows = [GOOD, measure(2, station="W9")]
    assert violated(checks.silver_checks(*frames(spark, measures=rows), nothing(spark))) == {20: 1}


def gold(spark, dimension, facts):
    layouts = (schemas.DIM_STATION, schemas.FACT_MEASUREMENT)
    made = [
        None if rows is None else spark.createDataFrame(rows, layout) if rows
        else schemas.empty(spark, layout)
        for rows, layout in zip((dimension, facts), layouts)
    ]
    return violated(checks.gold_checks(*made, nothing(spark, *layouts)))


def test_gold_rules(spark):
    dim = [(11, *STATION)]
    assert gold(spark, dim, [FACT]) == {}
    assert gold(spark, None, None) == {21: 1, 22: 1, 23: 1, 24: 1}
    assert gold(spark, [], []) == {23: 1, 24: 1}
    assert gold(spark, dim, [FACT, (2, None, *GOOD[2:])]) == {25: 1}
    assert gold(spark, dim, [FACT, (2, 99, *GOOD[2:])]) == {26: 1}


def test_request_rule(spark):
    catalogue = flatten.station_catalogue(landing(spark, (SEARCH, doc(offering()), NEW)))
    assert violated(checks.request_checks(lookup.station_errors(catalogue, ["turbidity"]))) == {}
    assert violated(checks.request_checks(lookup.station_errors(catalogue, ["pH"]))) == {27: 2}


def test_parse_rule(spark):
    good = landing(spark, ("readings_latest__a__m", doc(reading(value="n/a")), NEW))
    assert violated(checks.parse_checks(flatten.document_issues(good))) == {}
    bad = landing(spark, ("readings_latest__a__m", "{", NEW), ("readings_latest__a", "{}", NEW))
    assert violated(checks.parse_checks(flatten.document_issues(bad))) == {28: 2}


def test_assert_valid_names_the_first_failure(spark):
    report = checks.landing_checks(rows_landed(spark, 0, 1), PARAMS)
    with pytest.raises(ValidationError, match="station document present"):
        checks.assert_valid(report)
    checks.assert_valid(checks.landing_checks(rows_landed(spark, 1, 2), PARAMS))

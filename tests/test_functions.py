import pytest
from pyspark.sql import functions as F

from rivulet.functions import scalars, text


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_normalize_text(spark):
    values = ["  Dissolved-Oxygen ", "a__b--c\t d", None, "", "ÀB\x1cc d", "-_-"]
    assert apply(spark, text.normalize_text, values) == [
        "dissolved oxygen", "a b c d", "", "", "àb c d", "",
    ]


def test_last_segment(spark):
    values = ["http://x/y/dissolved-oxygen", "http://x/y/z//", "plain", ""]
    assert apply(spark, text.last_segment, values) == ["dissolved-oxygen", "z", "plain", ""]


def test_dataset_name_round_trip(spark):
    df = spark.createDataFrame([("dissolved oxygen", "W1-do-i-mgL")], "p string, m string")
    name = df.select(text.readings_dataset(F.col("p"), F.col("m")).alias("d"))
    assert name.first().d == "readings_latest__dissolved_oxygen__W1-do-i-mgL"
    row = name.select(
        text.dataset_parameter(F.col("d")).alias("p"),
        text.dataset_measure(F.col("d")).alias("m"),
        text.measure_unit(text.dataset_measure(F.col("d"))).alias("u"),
        text.measure_station(text.dataset_measure(F.col("d"))).alias("s"),
    ).first()
    assert tuple(row) == ("dissolved oxygen", "W1-do-i-mgL", "mgL", "W1")


@pytest.mark.parametrize(
    ("name", "complete", "measure"),
    [
        ("readings_latest__a", False, None),
        ("readings_latest__a__m", True, "m"),
        ("readings_latest__a__m__x", True, "m"),
        ("readings_latest____m", True, "m"),
    ],
)
def test_dataset_parts(spark, name, complete, measure):
    assert apply(spark, text.has_dataset_parts, [name]) == [complete]
    assert apply(spark, text.dataset_measure, [name]) == [measure]


def test_lower_ascii_leaves_other_letters(spark):
    assert apply(spark, text.lower_ascii, ["ABCÀÉß z", None]) == ["abcÀÉß z", None]


def test_iso_timestamps(spark):
    good = [
        "2026-02-25", "2026-02-25T00:00", "2026-02-25 00:00:00", "2026-02-25T00:00:00Z",
        "2026-02-25T00:00:00.123456+01:00", "2024-02-29T10:00:00+00:00",
    ]
    bad = [
        "2026", "2026-02", "T10:00", "2026-02-30", "2026-02-25T24:00:00", "n/a", "", None,
        "2026-02-25T00:00:00+0000", "2023-02-29",
    ]
    assert apply(spark, text.is_iso_timestamp, good) == [True] * len(good)
    assert apply(spark, text.is_iso_timestamp, bad) == [False] * len(bad)


def test_conform_timestamp(spark):
    assert apply(spark, text.conform_timestamp, ["2026-02-25T00:00:00Z", "x"]) == [
        "2026-02-25T00:00:00+00:00", "x",
    ]


def test_dataset_kind_ignores_case_and_takes_any_char_for_underscore(spark):
    values = ["readings_latest__x", "READINGS_LATEST", "readings-latestX", "readings", None]
    assert apply(spark, text.in_dataset_kind, values) == [True, True, True, False, None]


def test_to_double(spark):
    values = ["1.5", " -2 ", "1e3", ".5", "1.5d", "NaN", "Infinity", "0x1p3", "n/a", "", None]
    assert apply(spark, scalars.to_double, values) == [1.5, -2.0, 1000.0, 0.5] + [None] * 7


def test_to_long(spark):
    values = ["437673", "437673.0", "1e3", "1.5", "9007199254740993", "1e300", "x", None]
    assert apply(spark, scalars.to_long, values) == [
        437673, 437673, 1000, None, 9007199254740993, None, None, None,
    ]


def test_first_status_label(spark):
    values = [
        '[{"label":"Active"},{"label":"Old"}]', "[]", '{"label":"X"}', None, "Active", '[{"a":1}]',
    ]
    assert apply(spark, scalars.first_status_label, values) == ["Active"] + [None] * 5


def test_to_instant(spark):
    values = ["2026-02-25T01:00:00+01:00", "2026-02-25", "2026", "2026-02-30", None]
    seconds = apply(spark, lambda c: F.unix_seconds(text.to_instant(c)), values)
    assert seconds == [1771977600, 1771977600, None, None, None]

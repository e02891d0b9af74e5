"""Data-quality rules. Every rule yields one row (seq, layer, check, violations, ok).

Rules over one table share one aggregation pass. A missing table is passed as
None: its existence rule fails and its other rules see no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.errors import ValidationError
from rivulet.functions import text
from rivulet.operators import lookup
from rivulet.operators.conform import READING_KEY, REQUIRED
from rivulet.operators.flatten import FATAL

Rule = tuple[int, str, Column]  # place in the report, name, number of violations

LANDING_RULES = [
    "station document present",
    "readings payloads for the request",
    "payloads in total",
]
READABLE = "payloads are readable documents"
STATION_ROWS = "station table has rows"
MEASURE_ROWS = "measure table has rows"
STATION_FIELDS = "station fields present"
MEASURE_FIELDS = "measure fields present"
ISO = "timestamps are ISO"
UNIQUE = "reading keys are unique"
NO_ORPHANS = "every reading has a station"
DIMENSION_ROWS = "station dimension has rows"
FACT_ROWS = "measurement facts have rows"
FACT_KEYS = "facts have a station key"
KEYS_KNOWN = "station keys are in the dimension"

STATION_REQUIRED = ["station_id", "label", "ingested_at"]
SILVER_STATION_REQUIRED = ["station_id", "ingested_at"]


def shortfall(rows: Column, wanted: int) -> Column:
    """How many rows are lacking to the wanted number."""
    return F.greatest(F.lit(wanted).cast("bigint") - rows, F.lit(0).cast("bigint"))


def _report(df: DataFrame, layer: str, rules: list[Rule]) -> DataFrame:
    counted = df.agg(*[violations.alias(f"v{seq}") for seq, _, violations in rules])
    rows = ", ".join(
        f"named_struct('seq', {seq}, 'layer', '{layer}', 'check', '{name}',"
        f" 'violations', bigint(v{seq}), 'ok', v{seq} = 0)"
        for seq, name, _ in rules
    )
    return counted.selectExpr(f"inline(array({rows}))")


def _fixed(anchor: DataFrame, layer: str, seq: int, name: str, violations: int) -> DataFrame:
    return anchor.sparkSession.range(1).selectExpr(
        f"{seq} AS seq",
        f"'{layer}' AS layer",
        f"'{name}' AS check",
        f"bigint({violations}) AS violations",
        f"{violations} = 0 AS ok",
    )


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def required_rule(seq: int, name: str, columns: list[str]) -> Rule:
    return seq, name, F.count_if(text.any_blank(columns))


def iso_rule(seq: int, name: str, column: str = "datetime") -> Rule:
    return seq, name, F.count_if(~text.is_iso_timestamp(F.col(column)))


def newest_rows(measures: DataFrame, sample: int, order: list[str]) -> DataFrame:
    """The last `sample` rows by arrival."""
    return measures.orderBy(*[F.col(name).desc() for name in order]).limit(sample)


def duplicate_groups(measures: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return measures.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def landing_checks(landing: DataFrame, requested: int) -> DataFrame:
    """A station document, and payloads for the requested parameters, have landed."""
    stations = F.count_if(F.col("dataset") == text.STATION_DATASET)
    readings = F.count_if(text.in_dataset_kind(F.col("dataset")))
    return _report(
        landing,
        "landing",
        [
            (1, LANDING_RULES[0], shortfall(stations, 1)),
            (2, LANDING_RULES[1], shortfall(readings, requested)),
            (3, LANDING_RULES[2], shortfall(F.count("*"), 1 + requested)),
        ],
    )


def landing_count_checks(counts: DataFrame, requested: int) -> DataFrame:
    """The same rules over the payloads counted by kind as they landed."""

    def landed(*kinds: str) -> Column:
        wanted = F.col("kind").isin(*kinds) if kinds else F.lit(True)
        return F.coalesce(F.sum(F.when(wanted, F.col("payloads"))), F.lit(0))

    return _report(
        counts,
        "landing",
        [
            (1, LANDING_RULES[0], shortfall(landed(text.STATIONS), 1)),
            (2, LANDING_RULES[1], shortfall(landed(text.READINGS), requested)),
            (3, LANDING_RULES[2], shortfall(landed(), 1 + requested)),
        ],
    )


def parse_checks(issues: DataFrame) -> DataFrame:
    fatal = F.count_if(F.col("issue").isin(FATAL))
    return _report(issues, "parse", [(28, READABLE, fatal)])


def request_checks(errors: DataFrame) -> DataFrame:
    return _report(errors, "extract", [(27, "stations serve the request", F.count("*"))])


def _layer_checks(
    layer: str,
    stations: DataFrame | None,
    measures: DataFrame | None,
    empty: tuple[DataFrame, DataFrame],
    first: int,
    station_required: list[str],
    sample: int | None,
    arrival: list[str],
    whole: DataFrame | None,
) -> list[DataFrame]:
    anchor = empty[0]
    parts = [
        _fixed(anchor, layer, first, "station table exists", int(stations is None)),
        _fixed(anchor, layer, first + 1, "measure table exists", int(measures is None)),
    ]
    stations = empty[0] if stations is None else stations
    measures = empty[1] if measures is None else measures
    has_rows = shortfall(F.count("*"), 1)
    parts.append(
        _report(
            stations,
            layer,
            [
                (first + 2, STATION_ROWS, has_rows),
                required_rule(first + 4, STATION_FIELDS, station_required),
            ],
        )
    )
    measure_rules = [required_rule(first + 5, MEASURE_FIELDS, REQUIRED)]
    if whole is None:
        measure_rules.insert(0, (first + 3, MEASURE_ROWS, has_rows))
    else:
        parts.append(_report(whole.limit(1), layer, [(first + 3, MEASURE_ROWS, has_rows)]))
    iso = iso_rule(first + 6, ISO)
    if sample is None:
        parts.append(_report(measures, layer, [*measure_rules, iso]))
    else:
        parts.append(_report(measures, layer, measure_rules))
        parts.append(_report(newest_rows(measures, sample, arrival), layer, [iso]))
    groups = duplicate_groups(measures, READING_KEY)
    parts.append(_report(groups, layer, [(first + 7, UNIQUE, F.count("*"))]))
    return parts


_ARRIVAL = ["ingested_at", "landing_id", "pos"]


def bronze_checks(
    stations: DataFrame | None,
    measures: DataFrame | None,
    empty: tuple[DataFrame, DataFrame],
    sample: int | None = None,
    whole: DataFrame | None = None,
) -> DataFrame:
    """Rules 4 to 11. All timestamps are tested; `sample=20` tests the newest 20 only.

    Where `measures` is a part of the table, `whole` is all of it: a batch may bring no
    readings as long as the table has some.
    """
    return _together(
        _layer_checks(
            "bronze", stations, measures, empty, 4, STATION_REQUIRED, sample, _ARRIVAL, whole
        )
    )


def silver_checks(
    stations: DataFrame | None,
    measures: DataFrame | None,
    empty: tuple[DataFrame, DataFrame],
    sample: int | None = None,
    whole: DataFrame | None = None,
) -> DataFrame:
    """Rules 12 to 20; the last one finds readings without a station. `whole` as in bronze."""
    parts = _layer_checks(
        "silver", stations, measures, empty, 12, SILVER_STATION_REQUIRED, sample, _ARRIVAL, whole
    )
    lost = lookup.orphans(
        empty[1] if measures is None else measures,
        empty[0] if stations is None else stations,
        "station_id",
    )
    parts.append(_report(lost, "silver", [(20, NO_ORPHANS, F.count("*"))]))
    return _together(parts)


def gold_checks(
    dimension: DataFrame | None,
    facts: DataFrame | None,
    empty: tuple[DataFrame, DataFrame],
    whole: DataFrame | None = None,
) -> DataFrame:
    """Rules 21 to 26; the last one is the foreign key of the facts. `whole` as in bronze."""
    parts = [
        _fixed(empty[0], "gold", 21, "station dimension exists", int(dimension is None)),
        _fixed(empty[0], "gold", 22, "measurement facts exist", int(facts is None)),
    ]
    dimension = empty[0] if dimension is None else dimension
    facts = empty[1] if facts is None else facts
    has_rows = shortfall(F.count("*"), 1)
    parts.append(_report(dimension, "gold", [(23, DIMENSION_ROWS, has_rows)]))
    rules = [(25, FACT_KEYS, F.count_if(F.col("station_key").isNull()))]
    if whole is None:
        rules.insert(0, (24, FACT_ROWS, has_rows))
    else:
        parts.append(_report(whole.limit(1), "gold", [(24, FACT_ROWS, has_rows)]))
    parts.append(_report(facts, "gold", rules))
    dangling = lookup.orphans(
        facts.filter(F.col("station_key").isNotNull()), dimension, "station_key"
    )
    parts.append(_report(dangling, "gold", [(26, KEYS_KNOWN, F.count("*"))]))
    return _together(parts)


# --- the rules batch by batch ------------------------------------------------


def measures_by_batch(measures: DataFrame, sample: int | None = None) -> DataFrame:
    """ingested_at, rows, missing, not_iso, copies: what the rules find in each batch."""
    not_iso = F.count_if(~text.is_iso_timestamp(F.col("datetime")))
    keyed = measures.groupBy(*READING_KEY).agg(
        F.count("*").alias("rows"),
        F.count_if(text.any_blank(REQUIRED)).alias("missing"),
        not_iso.alias("not_iso"),
    )
    found = keyed.groupBy("ingested_at").agg(
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        F.sum("not_iso").alias("not_iso"),
        F.count_if(F.col("rows") > 1).alias("copies"),
    )
    if sample is None:
        return found
    newest = Window.partitionBy("ingested_at").orderBy(F.desc("landing_id"), F.desc("pos"))
    sampled = measures.withColumn("place", F.row_number().over(newest)).filter(
        F.col("place") <= sample
    )
    tested = sampled.groupBy("ingested_at").agg(not_iso.alias("not_iso"))
    return found.drop("not_iso").join(tested, "ingested_at", "left")


def faulty_stations_by_batch(
    existing: DataFrame, arrivals: DataFrame, required: list[str]
) -> DataFrame:
    """ingested_at, change: by how many stations without a required field each batch changes
    the table, which held `existing` before; that is the row with an empty batch.

    A station counts from the batch it arrives with until the next one it arrives with.
    """
    columns = ["station_id", "ingested_at", "faulty"]
    faulty = text.any_blank(required)
    before = existing.withColumn("faulty", faulty).withColumn("ingested_at", F.lit(""))
    order = [F.desc(name) for name in ("landing_id", "pos")]
    last = Window.partitionBy("station_id", "ingested_at").orderBy(*order)
    states = arrivals.withColumn("faulty", faulty).withColumn("place", F.row_number().over(last))
    states = states.filter(F.col("place") == 1).select(*columns)
    states = states.unionByName(before.select(*columns))
    following = F.lead("ingested_at").over(Window.partitionBy("station_id").orderBy("ingested_at"))
    held = states.withColumn("until", following).filter("faulty")
    events = held.select(
        F.inline(
            F.array(
                F.struct(F.col("ingested_at"), F.lit(1).alias("change")),
                F.struct(F.col("until").alias("ingested_at"), F.lit(-1).alias("change")),
            )
        )
    )
    return (
        events.filter(F.col("ingested_at").isNotNull())
        .groupBy("ingested_at")
        .agg(F.sum("change").alias("change"))
    )


def failure(layer: str, seq: int, name: str, violations: int) -> ValidationError:
    return ValidationError(
        f"{layer} validation failed: {name} (rule {seq}, {violations} violations)"
    )


def assert_valid(checks: DataFrame) -> None:
    """Raises for the first failed rule. The report has one row per rule, 28 at most."""
    failed = checks.filter(~F.col("ok")).orderBy("seq").first()
    if failed:
        raise failure(failed["layer"], failed["seq"], failed["check"], failed["violations"])

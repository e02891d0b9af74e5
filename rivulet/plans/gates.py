"""The rules of each layer as gates for many batches at once.

What the rules find is counted by batch in a few jobs; the driver sees one row for each
batch and walks them from the oldest. A gate returns the batches ahead of the first that
fails, and that failure. Batches counted here are those the run has in hand, oldest first;
rules over a whole table see it as it would be after each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.errors import ValidationError
from rivulet.operators import checks, flatten, lookup
from rivulet.sources.tables import BATCH, Warehouse

Found = dict[str, dict[str, int]]
Passed = tuple[list[str], ValidationError | None]


def _collected(rows: DataFrame) -> Found:
    return {row[BATCH]: row.asDict() for row in rows.collect()}


def _walk(layer: str, stamps: list[str], rules, failed: ValidationError | None) -> Passed:
    """`rules` gives (place, name, violations) of a batch, in their order."""
    for place, stamp in enumerate(stamps):
        for seq, name, violations in rules(stamp):
            if violations:
                return stamps[:place], checks.failure(layer, seq, name, violations)
    return stamps, failed


def _filled(warehouse: Warehouse, name: str, stamps: list[str], found: Found) -> dict[str, bool]:
    """Whether the table has rows after each batch; other batches in it count at once."""
    outside = warehouse.read(name).filter(~F.col(BATCH).isin(stamps))
    filled, out = not outside.isEmpty(), {}
    for stamp in stamps:
        filled = filled or found.get(stamp, {}).get("rows", 0) > 0
        out[stamp] = filled
    return out


def bronze(
    warehouse: Warehouse,
    stamps: list[str],
    existing: DataFrame,
    arrivals: DataFrame,
    sample: int | None,
    failed: ValidationError | None,
) -> Passed:
    """Rules 28 and 4 to 11; `existing` is the station table before the run."""
    issues = warehouse.batches("quarantine", stamps).filter(F.col("issue").isin(flatten.FATAL))
    unreadable = _collected(issues.groupBy(BATCH).agg(F.count("*").alias("n")))
    found = _collected(
        checks.measures_by_batch(warehouse.batches("bronze_measure", stamps), sample)
    )
    filled = _filled(warehouse, "bronze_measure", stamps, found)
    changes = _collected(
        checks.faulty_stations_by_batch(existing, arrivals, checks.STATION_REQUIRED)
    )
    first = arrivals.agg(F.min(BATCH)).first()[0]
    stations_from = "" if not existing.isEmpty() else first
    faulty, held = {}, changes.get("", {}).get("change", 0)
    for stamp in stamps:
        held += changes.get(stamp, {}).get("change", 0)
        faulty[stamp] = held

    def parse(stamp: str):
        yield 28, checks.READABLE, unreadable.get(stamp, {}).get("n", 0)

    def rules(stamp: str):
        own = found.get(stamp, {})
        yield 6, checks.STATION_ROWS, int(stations_from is None or stations_from > stamp)
        yield 7, checks.MEASURE_ROWS, int(not filled[stamp])
        yield 8, checks.STATION_FIELDS, faulty[stamp]
        yield 9, checks.MEASURE_FIELDS, own.get("missing", 0)
        yield 10, checks.ISO, own.get("not_iso") or 0
        yield 11, checks.UNIQUE, own.get("copies", 0)

    readable, failed = _walk("parse", stamps, parse, failed)
    return _walk("bronze", readable, rules, failed)


def silver(
    warehouse: Warehouse, stamps: list[str], sample: int | None, failed: ValidationError | None
) -> Passed:
    """Rules 12 to 20. Stations of silver have all their fields by the way they are made."""
    measures = warehouse.batches("silver_measure", stamps)
    found = _collected(checks.measures_by_batch(measures, sample))
    filled = _filled(warehouse, "silver_measure", stamps, found)
    lost = lookup.orphans(measures, warehouse.read("silver_station"), "station_id")
    orphans = _collected(lost.groupBy(BATCH).agg(F.count("*").alias("n")))
    empty = warehouse.read("silver_station").isEmpty()

    def rules(stamp: str):
        own = found.get(stamp, {})
        yield 14, checks.STATION_ROWS, int(empty)
        yield 15, checks.MEASURE_ROWS, int(not filled[stamp])
        yield 17, checks.MEASURE_FIELDS, own.get("missing", 0)
        yield 18, checks.ISO, own.get("not_iso") or 0
        yield 19, checks.UNIQUE, own.get("copies", 0)
        yield 20, checks.NO_ORPHANS, orphans.get(stamp, {}).get("n", 0)

    return _walk("silver", stamps, rules, failed)


def gold(warehouse: Warehouse, stamps: list[str], failed: ValidationError | None) -> Passed:
    """Rules 21 to 26."""
    dimension, facts = warehouse.read("dim_station"), warehouse.batches("fact_measurement", stamps)
    found = _collected(
        facts.groupBy(BATCH).agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("station_key").isNull()).alias("without"),
        )
    )
    filled = _filled(warehouse, "fact_measurement", stamps, found)
    keyed = facts.filter(F.col("station_key").isNotNull())
    lost = lookup.orphans(keyed, dimension, "station_key")
    dangling = _collected(lost.groupBy(BATCH).agg(F.count("*").alias("n")))
    empty = dimension.isEmpty()

    def rules(stamp: str):
        yield 23, checks.DIMENSION_ROWS, int(empty)
        yield 24, checks.FACT_ROWS, int(not filled[stamp])
        yield 25, checks.FACT_KEYS, found.get(stamp, {}).get("without", 0)
        yield 26, checks.KEYS_KNOWN, dangling.get(stamp, {}).get("n", 0)

    return _walk("gold", stamps, rules, failed)

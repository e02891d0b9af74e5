"""A whole run, with the rules of a layer as the gate to the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from rivulet.operators import batches, checks
from rivulet.plans import gates, refine
from rivulet.sources import landing
from rivulet.sources.staging import Staging
from rivulet.sources.tables import LANDING, REQUEST_ERRORS, Warehouse


def _scoped(warehouse: Warehouse, name: str, batch: str | None) -> DataFrame | None:
    """One batch of a reading table: earlier ones passed when they were written."""
    found = warehouse.find(name)
    return found if found is None or batch is None else found.filter(found.ingested_at == batch)


def request_report(warehouse: Warehouse, batch: str | None = None) -> DataFrame:
    """Why stations could not serve a request, as the run of that batch has stored it."""
    errors = _scoped(warehouse, REQUEST_ERRORS, batch)
    return checks.request_checks(warehouse.empty(REQUEST_ERRORS) if errors is None else errors)


def landing_report(warehouse: Warehouse, requested: int) -> DataFrame:
    """Over the payloads counted as they landed; no batch is read."""
    return checks.landing_count_checks(warehouse.landed_counts(), requested)


def parse_report(warehouse: Warehouse, batch: str | None = None) -> DataFrame:
    issues = _scoped(warehouse, "quarantine", batch)
    return checks.parse_checks(warehouse.empty("quarantine") if issues is None else issues)


def _whole(warehouse: Warehouse, name: str, batch: str | None) -> DataFrame | None:
    """The whole table, where the rules look at one batch only."""
    return None if batch is None else warehouse.find(name)


def bronze_report(
    warehouse: Warehouse, batch: str | None = None, sample: int | None = None
) -> DataFrame:
    return checks.bronze_checks(
        warehouse.find("bronze_station"),
        _scoped(warehouse, "bronze_measure", batch),
        (warehouse.empty("bronze_station"), warehouse.empty("bronze_measure")),
        sample,
        _whole(warehouse, "bronze_measure", batch),
    )


def silver_report(
    warehouse: Warehouse, batch: str | None = None, sample: int | None = None
) -> DataFrame:
    return checks.silver_checks(
        warehouse.find("silver_station"),
        _scoped(warehouse, "silver_measure", batch),
        (warehouse.empty("silver_station"), warehouse.empty("silver_measure")),
        sample,
        _whole(warehouse, "silver_measure", batch),
    )


def gold_report(warehouse: Warehouse, batch: str | None = None) -> DataFrame:
    return checks.gold_checks(
        warehouse.find("dim_station"),
        _scoped(warehouse, "fact_measurement", batch),
        (warehouse.empty("dim_station"), warehouse.empty("fact_measurement")),
        _whole(warehouse, "fact_measurement", batch),
    )


def full_report(warehouse: Warehouse, requested: int, batch: str | None = None) -> DataFrame:
    """Every rule of every layer, as one frame; without a batch over all batches."""
    parts = [
        request_report(warehouse, batch),
        landing_report(warehouse, requested),
        parse_report(warehouse, batch),
        bronze_report(warehouse, batch),
        silver_report(warehouse, batch),
        gold_report(warehouse, batch),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def refine_newest(
    warehouse: Warehouse, requested: int, gate: bool = True, sample: int | None = None
) -> dict[str, object]:
    """Takes the newest landed batch to gold; with `gate` each layer must pass its rules."""

    def passing(report: DataFrame) -> None:
        if gate:
            checks.assert_valid(report)

    passing(landing_report(warehouse, requested))
    batch = batches.latest_batch(warehouse.read(LANDING))
    return _refine(warehouse, batch, passing, sample)


def refine_all(
    warehouse: Warehouse, requested: int, gate: bool = True, sample: int | None = None
) -> list[dict[str, object]]:
    """Takes every landed batch to gold; one summary for each, the oldest first.

    All batches go through a layer together, with the result they would have one after
    the other; the number of jobs does not grow with that of batches. With `gate` each
    layer must pass its rules batch by batch: a batch that fails keeps itself and all
    later ones out of the next layers, what is before it is finished, and its failure is
    raised. (Its layer, and the layers before, hold the later batches already; a repeated
    run replaces them.)
    """
    if gate:
        checks.assert_valid(landing_report(warehouse, requested))
    stamps = batches.all_batches(warehouse.landed_counts())
    if not stamps:
        return []
    done, counts, failed = stamps, {}, None
    with Staging() as staging:
        stations = warehouse.read("bronze_station")
        found, arrivals = refine.open_batches(warehouse, stamps, staging)
        counts |= found
        if gate:
            done, failed = gates.bronze(warehouse, done, stations, arrivals, sample, failed)
        if done:
            found, arrivals = refine.conform_batches(warehouse, done, arrivals, staging)
            counts |= found
            if gate:
                done, failed = gates.silver(warehouse, done, sample, failed)
        if done:
            counts |= refine.load_batches(warehouse, done, arrivals, staging)
            if gate:
                done, failed = gates.gold(warehouse, done, failed)
    if failed:
        raise failed
    return refine.summaries(stamps, counts)


def _refine(
    warehouse: Warehouse,
    batch: str | None,
    passing: Callable[[DataFrame], None],
    sample: int | None,
) -> dict[str, object]:
    summary = refine.landing_to_bronze(warehouse, batch=batch)
    passing(parse_report(warehouse, batch))
    passing(bronze_report(warehouse, batch, sample))
    summary |= refine.bronze_to_silver(warehouse, batch)
    passing(silver_report(warehouse, batch, sample))
    summary |= refine.silver_to_gold(warehouse, batch)
    passing(gold_report(warehouse, batch))
    return summary


def run_pipeline(
    warehouse: Warehouse,
    station_documents: DataFrame,
    readings: DataFrame,
    wanted: str,
    parameters: list[str],
    limit: int = 10,
    append: bool = False,
    ingested_at: str | None = None,
    every_station: bool = False,
) -> dict[str, object]:
    """Search and land, then landing to bronze to silver to gold; stops at the first failure."""
    landed = landing.land_run(
        warehouse,
        station_documents,
        readings,
        wanted,
        parameters,
        limit,
        append,
        ingested_at,
        every_station,
    )
    return landed | refine_newest(warehouse, len(parameters))

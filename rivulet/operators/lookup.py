"""Reference lookups, parameter resolution, top-N.

No join here carries a broadcast hint. Spark broadcasts a side whose size it has
checked against spark.sql.autoBroadcastJoinThreshold (and again at run time);
beyond that it sorts and merges, and adaptive execution splits a hot key's
partition, which it may do on the left side of all joins used here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import text


def _reference(rows: DataFrame, reference: DataFrame, key: str, since: str | None, *columns: str):
    """The reference side of a join by key, and the condition of the join.

    With `since`, a column of the reference, rows of earlier batches do not match.
    """
    names = {key: "__key"} | ({since: "__since"} if since else {})
    side = reference.select(*[F.col(name).alias(new) for name, new in names.items()], *columns)
    matches = rows[key] == side["__key"]
    if since:
        matches = matches & (side["__since"] <= rows["ingested_at"])
    return side, matches


def keep_known(
    rows: DataFrame, reference: DataFrame, key: str, since: str | None = None
) -> DataFrame:
    """Rows whose key occurs in `reference`."""
    side, matches = _reference(rows, reference, key, since)
    return rows.join(side, matches, "left_semi")


def orphans(
    rows: DataFrame, reference: DataFrame, key: str, since: str | None = None
) -> DataFrame:
    """Rows whose key does not occur in `reference`; a NULL key is an orphan too."""
    side, matches = _reference(rows, reference, key, since)
    return rows.join(side, matches, "left_anti")


def attach(
    rows: DataFrame, reference: DataFrame, key: str, column: str, since: str | None = None
) -> DataFrame:
    """Rows with `column` looked up by a unique key; unmatched rows are dropped."""
    side, matches = _reference(rows, reference, key, since, column)
    return rows.join(side, matches, "inner").select(column, *[rows[c] for c in rows.columns])


def search_stations(stations: DataFrame, wanted: str, label: str, key: str, limit: int = 5):
    """The first stations, by key, whose label contains the text."""
    return stations.filter(F.col(label).contains(wanted)).orderBy(key).limit(limit)


def latest_n(rows: DataFrame, n: int, keys: list[str], newest: str, tie: list[str]) -> DataFrame:
    """The newest n rows per key, with their `rank`; newest by instant, then by text.

    Two steps for every n: first cut to n per key and salt, so that many tasks share a
    hot key, then to n per key.
    """
    spark = rows.sparkSession
    order: list[Column] = [
        text.to_instant(F.col(newest)).desc_nulls_last(),
        F.col(newest).desc(),
        *[F.col(name).asc() for name in tie],
    ]
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(newest, *tie), F.lit(salts))
    per_salt = Window.partitionBy(*keys, "__salt").orderBy(*order)
    kept = rows.withColumn("__salt", salt).withColumn("rank", F.row_number().over(per_salt))
    kept = kept.filter(F.col("rank") <= n).drop("rank", "__salt")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


# --- requested parameters against what stations offer ------------------------


def _requested(parameters: list[str]) -> Column:
    """The caller's list; its length is fixed by the call, not by the data."""
    return F.array(*[F.lit(p) for p in parameters]).cast("array<string>")


def missing_parameters(catalogue: DataFrame, parameters: list[str]) -> DataFrame:
    """Per station: requested parameters it does not offer, as typed, and what it offers."""
    lacking = F.filter(
        _requested(parameters),
        lambda p: ~F.array_contains(F.col("offered"), text.normalize_text(p)),
    )
    return catalogue.select(
        "landing_id",
        "pos",
        "station_id",
        lacking.alias("missing"),
        F.array_sort(F.array_distinct("offered")).alias("available"),
    ).filter(F.size("missing") > 0)


def resolve_measures(catalogue: DataFrame, parameters: list[str]) -> DataFrame:
    """Per station and requested parameter: its sorted measure ids, empty if it has none.

    Both lists come from the one station document, so this stays within the row.
    """
    wanted = F.array_distinct(F.transform(_requested(parameters), text.normalize_text))
    asked = catalogue.select(
        "landing_id", "pos", "station_id", "measures", F.posexplode(wanted).alias("nth", "parameter")
    )
    matching = F.filter(
        "measures", lambda m: (m["parameter"] == F.col("parameter")) & (m["parameter"] != "")
    )
    ids = F.array_sort(F.transform(matching, lambda m: m["measure_id"]))
    return asked.select(
        "landing_id", "pos", "station_id", "nth", "parameter", ids.alias("measure_ids")
    )


def resolved_rows(resolved: DataFrame) -> DataFrame:
    """The same with one row per measure id."""
    return resolved.select(
        "landing_id",
        "pos",
        "station_id",
        "nth",
        "parameter",
        F.posexplode("measure_ids").alias("nth_measure", "measure_id"),
    )


def request_errors(catalogue: DataFrame, parameters: list[str]) -> DataFrame:
    """Why a request cannot be served, in the order of stations and then of the checks.

    One pass: a station's errors are found within its own row. `nth` tells their order.
    """
    wanted = F.array_distinct(F.transform(_requested(parameters), text.normalize_text))
    lacking = F.filter(
        _requested(parameters),
        lambda p: ~F.array_contains(F.col("offered"), text.normalize_text(p)),
    )

    def error(reason: str, detail: Column) -> Column:
        return F.struct(F.lit(reason).alias("reason"), detail.alias("detail"))

    def measured(parameter: Column, condition=lambda measure: F.lit(True)) -> Column:
        return F.exists(
            "measures",
            lambda m: F.coalesce(m["parameter"] == parameter, F.lit(False))
            & (parameter != "")
            & condition(m),
        )

    not_offered = F.concat(
        F.lit("missing: "),
        F.array_join(lacking, ", "),
        F.lit("; available: "),
        F.array_join(F.array_sort(F.array_distinct("offered")), ", "),
    )
    found = [
        F.when(F.size(lacking) > 0, F.array(error("parameter not offered", not_offered))),
        F.when(F.size("measures") == 0, F.array(error("station has no measures", F.lit("")))),
        F.when(
            F.size("measures") > 0,
            F.transform(
                F.filter(wanted, lambda p: ~measured(p)),
                lambda p: error("no measure for parameter", p),
            ),
        ),
        F.transform(
            F.filter(wanted, lambda p: measured(p, lambda m: text.is_blank(m["measure_id"]))),
            lambda p: error("measure without an id", p),
        ),
    ]
    none = F.array().cast("array<struct<reason:string,detail:string>>")
    errors = F.flatten(F.array(*[F.coalesce(f, none) for f in found]))
    return catalogue.select(
        "landing_id", "pos", "station_id", F.posexplode(errors).alias("nth", "error")
    ).select("landing_id", "pos", "nth", "station_id", "error.reason", "error.detail")


def station_errors(catalogue: DataFrame, parameters: list[str]) -> DataFrame:
    """Why a request cannot be served, as rows (station_id, reason, detail)."""
    return request_errors(catalogue, parameters).select("station_id", "reason", "detail")


def latest_for_measures(
    resolved: DataFrame,
    readings: DataFrame,
    n: int,
    tie: list[str],
    newest: str = "datetime",
    how: str = "inner",
) -> DataFrame:
    """The newest n readings of every resolved measure.

    Only readings of those measures are ranked; how many there are is left to Spark,
    which broadcasts the ids where their size allows it and joins by key where not.
    With `how="left"` a measure without readings stays, with NULLs.
    """
    chosen = resolved.select(
        "landing_id", "pos", "station_id", "nth", "parameter", "nth_measure", "measure_id"
    )
    readings = readings.join(chosen.select("measure_id"), "measure_id", "left_semi")
    newest_rows = latest_n(readings, n, ["measure_id"], newest, tie)
    taken = [c for c in newest_rows.columns if c not in chosen.columns or c == "measure_id"]
    return chosen.join(newest_rows.select(*taken), "measure_id", how)

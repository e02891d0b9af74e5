"""Surrogate keys without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from rivulet.operators import merge
from rivulet.sources.staging import Staging

_PART, _ROW = "__part", "__row"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition there


def stage_in_order(
    df: DataFrame, order: list[str] | None, key: str, staging: Staging | None = None
) -> DataFrame:
    """Writes `df`, sorted by `order`, to the shared folder with each row's place in it.

    `order` should tell all rows apart, so that the sort can split any group of
    them. Without an order the rows stay in the partitions they come in, and
    nothing is shuffled. Rows that have their `key` already are sorted behind
    those that need one. The written copy fixes the places: losing executors later
    cannot change a key, and the frame may replace a table it was computed from.
    """
    ordered = df
    if order:
        first = [F.col(key).isNotNull()] if key in df.columns else []
        ordered = df.orderBy(*first, *order)
    placed = ordered.withColumn(_PART, F.spark_partition_id()).withColumn(
        _ROW, F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    )
    return (staging or Staging()).write(placed, f"keys-{key}")


def number_staged(staged: DataFrame, key: str, start: int = 0) -> DataFrame:
    """Keys start+1, start+2, … in staged order, for the rows without one.

    The join side has one row per partition of the sort, a bound that does not
    grow with the rows, so it may be broadcast.
    """
    sizes = staged.groupBy(_PART).agg(F.count("*").alias("__size"))
    before = F.sum("__size").over(
        Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    offsets = sizes.select(_PART, (before - F.col("__size")).alias("__before"))
    place = F.lit(start).cast(LongType()) + F.col("__before") + F.col(_ROW) + 1
    columns = [name for name in staged.columns if name not in (_PART, _ROW)]
    keyed = staged.join(F.broadcast(offsets), _PART)
    if key in columns:
        return keyed.select(
            *[F.coalesce(F.col(c), place).alias(c) if c == key else F.col(c) for c in columns]
        )
    return keyed.select(place.alias(key), *columns)


def assign_keys(
    df: DataFrame, key: str, order: list[str], start: int = 0, staging: Staging | None = None
) -> DataFrame:
    """Dense keys above `start`, in `order`, for rows whose `key` is NULL or absent."""
    return number_staged(stage_in_order(df, order, key, staging), key, start)


def upsert_keyed(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    key: str,
    order: list[str],
    used: int,
    staging: Staging | None = None,
) -> DataFrame:
    """`existing` with the incoming rows written over it; new ones get keys above `used`.

    `incoming` holds each of `keys` once and may have further columns for `order`. Only
    what is not in `existing` is sorted and staged; known rows keep their `key` and are
    passed through one join. `incoming` is read twice: stage it if it costs something.
    """
    columns = existing.columns
    fresh = incoming.join(existing.select(*keys), keys, "left_anti")
    numbered = assign_keys(fresh, key, order, used, staging)
    known = merge.update_known(existing, incoming, keys, keep=(key,))
    return known.unionByName(numbered.select(*columns))

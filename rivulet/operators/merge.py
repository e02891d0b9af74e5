"""Merges with a defined order: last wins, first wins, insert if absent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the given order.

    Written as row_number() = 1, which Spark limits per key *before* the shuffle
    (WindowGroupLimit): a key with a third of all rows sends one row per map task.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.col(name).desc() for name in order])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.col(name).asc() for name in order])


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    order: list[str],
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """`existing` with the last incoming row per key written over it, NULLs included.

    Rows without an incoming match stay. Columns in `keep` come from the existing
    row and are NULL for a new key. `existing` must hold each key once; it is
    shuffled once, and so is the reduced `incoming`.
    """
    columns = existing.columns
    written = [name for name in columns if name not in keep]
    old = existing.select(*keys, F.struct(*columns).alias("__old"))
    new = last_per_key(incoming, keys, order).select(*keys, F.struct(*written).alias("__new"))
    merged = old.join(new, keys, "full_outer")
    fresh = F.col("__new").isNotNull()
    values = {
        name: F.when(fresh, F.col("__new")[name]).otherwise(F.col("__old")[name])
        for name in written
        if name not in keys
    }
    values |= {name: F.col("__old")[name] for name in keep}
    values |= {name: F.col(name) for name in keys}
    return merged.select(*[values[name].alias(name) for name in columns])


def update_known(
    existing: DataFrame, incoming: DataFrame, keys: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """`existing` with incoming rows written over those they match, NULLs included.

    Both hold each key once. A left join: where `incoming` is small, Spark broadcasts it and
    the existing rows are neither shuffled nor sorted.
    """
    columns = existing.columns
    written = [name for name in columns if name not in keep and name not in keys]
    new = incoming.select(*keys, F.struct(*written).alias("__new"))
    joined = existing.join(new, keys, "left")
    fresh = F.col("__new").isNotNull()
    return joined.select(
        *[
            F.when(fresh, F.col("__new")[name]).otherwise(F.col(name)).alias(name)
            if name in written
            else F.col(name)
            for name in columns
        ]
    )


def with_required(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows without a NULL in a required column; an ignoring insert skips the others."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in required]))


def insert_if_absent(
    incoming: DataFrame,
    existing: DataFrame,
    keys: list[str],
    order: list[str],
    required: list[str] | None = None,
    by_range: bool = False,
) -> DataFrame:
    """The incoming rows to append: first per key, and only keys not in `existing`.

    The existing keys join the same window, ranked ahead of everything incoming,
    so duplicates and known keys go in one shuffle. With `by_range` that shuffle
    is a range partitioning on the keys, which a sort by the keys then reuses;
    use it where the incoming keys are unique already, since no row is dropped
    ahead of that shuffle.
    """
    rows = with_required(incoming, required or keys)
    known = existing.select(*keys, F.lit(0).alias("__arrival"))
    both = rows.withColumn("__arrival", F.lit(1)).unionByName(known, allowMissingColumns=True)
    if by_range:
        both = both.repartitionByRange(*keys)
    first = first_per_key(both, keys, ["__arrival", *order])
    return first.filter(F.col("__arrival") == 1).drop("__arrival")

"""Surrogate-key lookup of facts."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators.merge import DIMENSIONS


def key_lookup(dimension: DataFrame, id: str, key: str) -> DataFrame:
    """``id -> key`` of a dimension."""
    return dimension.select(id, key)


def sized(lookup: DataFrame, rows: int, limit: int) -> DataFrame:
    """A lookup whose rows were counted: beyond ``limit`` events are shuffled and hashed, but not sorted, to meet it.

    Sorting whole events would spill most of them. A partition's part of the lookup, an id
    and a key for each member, is small beside its part of the events.
    """
    return lookup.hint("shuffle_hash") if rows > limit else lookup


def resolve_keys(events: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Add the surrogate key of every dimension; null where a member is missing.

    ``dimensions`` may hold whole dimensions or, as in a load, the batch's own
    members with their keys, which are no more than the batch.

    Spark broadcasts a lookup whose files, or whose size at run time, are below its
    limit, and shuffles the others; :func:`sized` gives it a measured size to go by. Adaptive
    execution splits the partition of a member that many events refer to.
    """
    for dim in DIMENSIONS:
        table = dimensions[dim.table]
        if dim.key:
            lookup = key_lookup(table, dim.id, dim.key)
        else:  # the id is the key: only its presence is looked up
            lookup = table.select(dim.id, F.lit(True).alias(f"_{dim.id}_found"))
        events = events.join(lookup, dim.id, "left")
    return events.withColumn("date_key", F.when(F.col("_date_key_found"), F.col("date_key"))).drop("_date_key_found")


def lacks_member() -> Column:
    """True for a resolved event without a member in some dimension; no fact is made of it."""
    return F.greatest(*[F.col(d.key or d.id).isNull() for d in DIMENSIONS])

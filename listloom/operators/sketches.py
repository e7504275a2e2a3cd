"""Reach and overlap of many lists from mergeable sketches.

A theta sketch keeps the 2**``LG`` least hashes of a list's keys: sketches of parts unite to that of the whole, and two sketches tell how many keys both
lists have. Lists of no more keys than that are counted exactly. Beyond, a size is off by about one part in the root of 2**LG
(0.8 % at the standing value), and an overlap by about the root of (size of both together * overlap / 2**LG).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Binary logarithm of the hashes a sketch keeps; a full one has 128 KB.
LG = 14


def list_sketches(members: DataFrame, name: str, key: str, lg: int = LG) -> DataFrame:
    """(name, sketch) of each list among rows with its ``name`` and a ``key``; repeats count once.

    Sketches are begun before the shuffle, so a list of any size arrives as one row per task.
    """
    return members.filter(F.col(key).isNotNull()).groupBy(name).agg(F.theta_sketch_agg(key, lg).alias("sketch"))


def united(sketches: DataFrame, name: str, lg: int = LG) -> DataFrame:
    """Sketches of the same list from several loads as one."""
    return sketches.groupBy(name).agg(F.theta_union_agg("sketch", lg).alias("sketch"))


def _size(sketch: Column | str) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")


def overlaps(sketches: DataFrame, reference: DataFrame, name: str, key: str, lg: int = LG) -> DataFrame:
    """(name, size, n_exist, n_new) of each list against the keys of one ``reference`` list.

    Only one row of the reference meets the sketches, and the lists themselves are not read again.
    """
    one = reference.filter(F.col(key).isNotNull()).agg(F.theta_sketch_agg(key, lg).alias("_reference"))
    both = sketches.withColumn("_reference", one.scalar())
    shared = F.when(F.col("_reference").isNotNull(), F.theta_intersection("sketch", "_reference"))
    return both.select(name, _size("sketch").alias("size"), F.when(shared.isNull(), 0).otherwise(_size(shared)).cast("long").alias("n_exist")).withColumn(
        "n_new", F.col("size") - F.col("n_exist")
    )

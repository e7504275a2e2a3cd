"""Joins in which one key may hold a large part of the rows.

Rows of a hot key must not meet in one task. They are found by a sketch, and
joined in place to a broadcast of the few rows that the other side has for the
hot keys. All other rows go through the usual shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inputs below this size are not looked at: a third of one is no burden for a task.
_CHECK_BYTES = 4 << 30

# A key is hot from this many rows on.
_HOT_ROWS = 1_000_000

# The look is taken at about this much of the input, in rows or in files.
_SAMPLE_BYTES = 1 << 30
_SAMPLE_FILES = 200

# Estimates from here on only say that the size is unknown; then this share is looked at.
_UNKNOWN_BYTES, _UNKNOWN_SHARE = 1 << 50, 0.01

# The sketch returns at most this many keys, out of this many it tracks.
_MOST, _TRACKED = 1000, 10_000


def input_bytes(df: DataFrame) -> int:
    """Size of the tables a frame reads, as Spark estimates it from its sources."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return sum(int(size) for size in sizes)


def hot_keys(df: DataFrame, key: str, scale: float = 1.0) -> list:
    """Keys of ``df`` with about a million rows or more: a thousand values at most.

    A sketch over a sample of the key column, without a shuffle. A key that is
    missed or overrated changes the plan, not the result. ``scale`` is the
    share that ``df`` has of the rows it stands for.
    """
    size = input_bytes(df)
    if size < _CHECK_BYTES * scale:
        return []
    share = min(1.0, _SAMPLE_BYTES / max(size, 1)) if size < _UNKNOWN_BYTES else _UNKNOWN_SHARE
    keys = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    keys = keys.sample(share, seed=0) if share < 1 else keys
    top = keys.agg(F.expr(f"approx_top_k(_key, {_MOST}, {_TRACKED})")).first()[0]
    return [row["item"] for row in top or [] if row["count"] >= _HOT_ROWS * share * scale]


def hot_keys_of_table(table: DataFrame, key: str) -> list:
    """``hot_keys`` of a plain Parquet table, looking at some of its files only."""
    files = sorted(table.inputFiles())
    some = files[:: max(1, len(files) // _SAMPLE_FILES)]
    if len(some) == len(files):
        return hot_keys(table, key)
    part = table.sparkSession.read.schema(table.schema).parquet(*some)
    return hot_keys(part, key, len(some) / len(files))


def _among(key: str, hot: list) -> Column:
    return F.coalesce(F.col(key).isin(hot), F.lit(False))


def spread(
    many: DataFrame,
    few: DataFrame,
    on: str,
    key: str,
    join: Callable[[DataFrame, DataFrame], DataFrame],
    hot: list | None = None,
    unique: bool = True,
    join_hot: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``join(many, few)`` with the hot keys of ``many`` joined apart.

    ``on`` and ``key`` name the key in ``many`` and ``few``. ``unique`` tells
    that ``few`` has one row per key; its rows for the hot keys are then a
    thousand at most and are broadcast. Otherwise Spark decides by their size.
    ``hot`` passes keys that are known already.
    """
    hot = hot_keys(many, on) if hot is None else hot
    if not hot:
        return join(many, few)
    cold = join(many.filter(~_among(on, hot)), few.filter(~_among(key, hot)))
    rest = few.filter(_among(key, hot))
    rest = F.broadcast(rest) if unique else rest
    return cold.unionByName((join_hot or join)(many.filter(_among(on, hot)), rest))

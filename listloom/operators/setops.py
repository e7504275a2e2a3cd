"""Union, intersection and difference of contact sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from listloom.operators.joins import flag_suppress, keep_in, keep_out


def distinct_union(column: str, *frames: DataFrame) -> DataFrame:
    """The distinct values of one column over several tables."""
    return reduce(DataFrame.unionByName, [f.select(column) for f in frames]).distinct()


def stack(*frames: DataFrame) -> DataFrame:
    """All rows of frames with mixed columns; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def in_common(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return keep_in(left, right, key, key, repeats=True)


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return keep_out(left, right, key, key, repeats=True)


def not_in_any(left: DataFrame, rights: list[DataFrame], key: str) -> DataFrame:
    return flag_suppress(left, rights, key)

"""Membership, suppression and fan-out joins.

Sides are broadcast when Spark measures them under its broadcast threshold, and
shuffled otherwise. Hot keys are taken care of by ``spread``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.operators.skew import spread


def keys_of(df: DataFrame, key: str = "mail_id", name: str = "mail_id") -> DataFrame:
    """The filled keys of a table, with repeats."""
    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias(name))


def key_set(df: DataFrame, key: str = "mail_id", name: str = "mail_id") -> DataFrame:
    """The filled keys of a table, once each."""
    return keys_of(df, key, name).distinct()


def all_keys(*sets: DataFrame) -> DataFrame:
    """The keys of several sets together, with repeats."""
    return reduce(DataFrame.unionAll, sets)


def listed_keys(match: DataFrame, link: str, names: DataFrame, chosen: Column) -> DataFrame:
    """Contacts, with repeats, of a match table whose list entry satisfies ``chosen``."""
    entries = names.filter(chosen).select(F.col("id").alias("_entry"))
    return keys_of(match.join(entries, F.col(link) == F.col("_entry"), "left_semi"))


def _members(keys: DataFrame, key: str) -> DataFrame:
    """The key side of a semi or anti join, without repeats.

    The partial aggregate runs before the shuffle, so a key that fills a large
    part of its table arrives as one row per task. The shuffle is the one the
    join needs anyway.
    """
    return keys.select(F.col(key).alias("_member")).distinct()


def _membership(
    how: str, df: DataFrame, keys: DataFrame, on: str, key: str, repeats: bool, hot: list | None
) -> DataFrame:
    def join(rows: DataFrame, members: DataFrame) -> DataFrame:
        return rows.join(members, F.col(on) == F.col("_member"), how)

    members = _members(keys, key)
    return spread(df, members, on, "_member", join, hot if repeats else [])


def keep_in(
    df: DataFrame, keys: DataFrame, on: str = "id", key: str = "mail_id",
    repeats: bool = False, hot: list | None = None,
) -> DataFrame:
    """Rows whose key is among the keys.

    ``repeats``: ``df`` may hold a key many times; ``hot`` gives such keys if known.
    """
    return _membership("left_semi", df, keys, on, key, repeats, hot)


def keep_out(
    df: DataFrame, keys: DataFrame, on: str = "id", key: str = "mail_id",
    repeats: bool = False, hot: list | None = None,
) -> DataFrame:
    """Rows whose key is not among the keys; a missing key is not either."""
    return _membership("left_anti", df, keys, on, key, repeats, hot)


def with_side(how: str, on: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A join to a side whose key column is called ``_side`` and dropped."""

    def join(rows: DataFrame, side: DataFrame) -> DataFrame:
        return rows.join(side, F.col(on) == F.col("_side"), how).drop("_side")

    return join


def inner_on(
    df: DataFrame, side: DataFrame, on: str = "id", key: str = "mail_id",
    many: str = "side", hot: list | None = None, unique: bool = True,
) -> DataFrame:
    """Inner join to a side table; the side's key column is dropped.

    ``many`` names the input that may hold a key many times: ``side`` or
    ``rows``. ``unique`` tells that the other one holds each key once.
    """
    side = side.withColumnRenamed(key, "_side")
    join = with_side("inner", on)
    if many == "rows":
        return spread(df, side, on, "_side", join, hot, unique)
    return spread(side, df, "_side", on, lambda s, d: join(d, s), hot, unique)


def left_one(
    df: DataFrame, side: DataFrame, on: str = "id", key: str = "mail_id",
    repeats: bool = False, hot: list | None = None,
) -> DataFrame:
    """Left join to a side that holds at most one row per key.

    ``repeats``: ``df`` may hold a key many times; ``hot`` gives such keys if known.
    """
    side = side.withColumnRenamed(key, "_side")
    return spread(df, side, on, "_side", with_side("left", on), hot if repeats else [])


def left_many(
    df: DataFrame, side: DataFrame, on: str = "id", key: str = "mail_id",
    hot: list | None = None, unique: bool = True,
) -> DataFrame:
    """Left join to a side with any number of rows per key.

    ``unique`` tells that ``df`` holds each key once. For the hot keys, rows
    with a partner and rows without are found apart, since the rows of a left
    join's left side cannot be broadcast.
    """
    side = side.withColumnRenamed(key, "_side")
    left, inner = with_side("left", on), with_side("inner", on)

    def join_hot(sides: DataFrame, rows: DataFrame) -> DataFrame:
        lonely = keep_out(rows, sides, on, "_side")
        return inner(rows, sides).unionByName(lonely, allowMissingColumns=True)

    return spread(side, df, "_side", on, lambda s, d: left(d, s), hot, unique, join_hot)


def right_one(df: DataFrame, side: DataFrame, on: str = "id", key: str = "mail_id") -> DataFrame:
    """Right join of rows that hold each key once: all rows of the side, with empty
    columns where no row fits."""
    rows = df.withColumnRenamed(on, "_row")
    joined = left_one(side, rows.withColumn(on, F.col("_row")), key, "_row", repeats=True)
    return joined.drop(key)


def natural(left: DataFrame, right: DataFrame, how: str = "inner", unique: bool = False) -> DataFrame:
    """Join on all shared columns, null matching null.

    ``how`` is inner, left, left_semi or left_anti; ``unique`` tells that the
    right side has no repeats. Hot groups of equal rows are found by their hash.
    """
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the two frames share no column")
    keys = {c: f"_r_{c}" for c in shared}
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()])

    def join(rows: DataFrame, side: DataFrame) -> DataFrame:
        return rows.join(side, same, how)

    rows = left.withColumn("_hash", F.xxhash64(*shared))
    side = right.withColumn("_rhash", F.xxhash64(*shared)).withColumnsRenamed(keys)
    joined = spread(rows, side, "_hash", "_rhash", join, unique=unique)
    return joined.drop("_hash", "_rhash", *keys.values())


def rows_not_in(df: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of ``df`` found in none of the others, on all shared columns."""
    for other in others:
        shared = [c for c in df.columns if c in other.columns]
        df = natural(df, other.select(*shared).distinct(), "left_anti", unique=True)
    return df


def flag_suppress(
    df: DataFrame, lists: list[DataFrame], on: str, repeats: bool = True, hot: list | None = None
) -> DataFrame:
    """Rows whose key is in none of the lists: one anti join to all of them."""
    return keep_out(df, all_keys(*[one.select(on) for one in lists]), on, on, repeats, hot)

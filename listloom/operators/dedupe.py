"""Distinct rows, first row per key, ordered output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.functions.clean import missing


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose named columns are all filled (neither null nor blank)."""
    for name in columns:
        df = df.filter(~missing(F.col(name).cast("string")))
    return df


def text_order(*columns: str) -> list[Column]:
    """Ascending order with missing values last."""
    return [F.col(name).asc_nulls_last() for name in columns]


def total_order(df: DataFrame, first: list[Column]) -> list[Column]:
    """``first`` completed by every column, so that ties leave no choice."""
    return first + text_order(*df.columns)


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order.

    Spark puts a limit of one row per key before the shuffle (WindowGroupLimit),
    so a key that holds a large part of the rows costs no more than any other.
    Null keys form one group, as in SQL.
    """
    window = W.partitionBy(*keys).orderBy(*total_order(df, order))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def sort_unique(df: DataFrame, keys: list[str] | None, sort: list[str] | None = None) -> DataFrame:
    """One row per key (all columns when ``keys`` is None), then sorted."""
    unique = df.distinct() if keys is None else first_per_key(df, list(keys), [])
    return unique.orderBy(*text_order(*sort)) if sort else unique


def clean_up(df: DataFrame, keys: list[str] | None = None, mail: str = "mail") -> DataFrame:
    """Drop rows without mail, make unique, sort by mail."""
    return sort_unique(drop_missing(df, mail), keys, [mail])


def latest_wins(df: DataFrame, key: str, precedence: Column) -> DataFrame:
    """One row per key: the one from the highest precedence (the last file loaded)."""
    return first_per_key(df, [key], [precedence.desc_nulls_last()])


def identity_key(identity: str = "identity_id", contact: str = "id") -> Column:
    """Key of one identity; a contact without one stands for itself."""
    return F.coalesce(F.col(identity), -F.col(contact) - F.lit(1))

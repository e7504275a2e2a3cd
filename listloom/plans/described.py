"""Segments described by a dictionary."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.model import Model
from listloom.operators.dedupe import text_order
from listloom.operators.joins import inner_on, keep_in, keys_of, left_many


def _condition(column: str, wanted: Any) -> Column:
    if wanted == "not null":
        return F.col(column).isNotNull()
    if isinstance(wanted, (list, tuple)):
        return F.col(column).isin(list(wanted))
    return F.col(column) == wanted


def _values(model: Model, query: dict) -> DataFrame:
    """The values a sub-query selects: one column of one table, filtered."""
    ((table, column),) = query["select"].items()
    rows = model[table]
    for name, wanted in query.get("where", {}).items():
        rows = rows.filter(_condition(name, wanted))
    return keys_of(rows, column, "_value")


def described(model: Model, query: dict) -> DataFrame:
    """Run ``{"select": {table: [how, column, ...]}, "where": {...}, "limit": n}``.

    The first table of ``select`` is the contact table and has no join kind.
    Where-keys are ``table.column``; their value is a constant, a list,
    ``"not null"`` or a sub-query of the same form. A limit takes the first rows in the order of all columns. A table that is only named
    in ``where`` restricts the contacts by a semi join.
    """
    tables = dict(query["select"])
    first, first_columns = next(iter(tables.items()))
    filters: dict[str, dict[str, Any]] = {}
    for name, wanted in query.get("where", {}).items():
        table, column = name.split(".")
        filters.setdefault(table, {})[column] = wanted

    def filtered(table: str) -> DataFrame:
        rows = model[table]
        for column, wanted in filters.get(table, {}).items():
            if isinstance(wanted, dict):
                rows = keep_in(rows, _values(model, wanted), column, "_value")
            else:
                rows = rows.filter(_condition(column, wanted))
        return rows

    rows = filtered(first).select(*dict.fromkeys(["id", *first_columns]))
    for table in filters:
        if table not in tables:
            rows = keep_in(rows, filtered(table))
    columns, unique = list(first_columns), True
    for table, (how, *wanted) in list(tables.items())[1:]:
        side = filtered(table).select("mail_id", *wanted)
        # A condition on a joined table can only hold for rows that have a partner.
        if how == "inner" or table in filters:
            rows = inner_on(rows, side, hot=model.hot(table), unique=unique)
        elif how == "left":
            rows = left_many(rows, side, hot=model.hot(table), unique=unique)
        else:
            keyed = rows.withColumn("_row", F.col("id"))
            rows = left_many(side, keyed, "mail_id", "_row", unique=False).drop("mail_id")
        columns, unique = columns + wanted, False
    rows = rows.select(*columns)
    return rows.orderBy(*text_order(*columns)).limit(query["limit"]) if query.get("limit") else rows

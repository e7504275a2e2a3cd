"""Segments made from a folder of status files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.operators.dedupe import drop_missing, latest_wins
from listloom.operators.joins import flag_suppress
from listloom.operators.match import word_flag


def included_rows(rows: DataFrame, broker: str) -> DataFrame:
    """Rows of files for the broker or without status; the last file wins per mail."""
    mine = F.array_contains("statuses", broker) | (F.size("statuses") == 0)
    return latest_wins(drop_missing(rows.filter(mine), "mail"), "mail", F.col("place"))


def excluded_mails(rows: DataFrame, statuses: list[str]) -> DataFrame:
    """Mails that any file lists under one of the statuses."""
    unwanted = F.arrays_overlap("statuses", F.array(*[F.lit(s) for s in statuses]))
    return drop_missing(rows.filter(unwanted), "mail").select("mail")


def folder_segment(
    rows: DataFrame, broker: str, exclude: list[str], complaints: DataFrame, words: DataFrame,
    columns: list[str],
) -> DataFrame:
    """Included rows minus excluded statuses, complaints and keyword hits.

    A mail that is in any exclude list is out, whatever other lists say of it.
    """
    kept = included_rows(rows, broker)
    kept = flag_suppress(kept, [excluded_mails(rows, exclude), complaints], "mail", repeats=False)
    # One row per mail by now, so the mail identifies the row.
    flagged = word_flag(kept.withColumn("id", F.col("mail")), words)
    return flagged.filter("NOT exclusion_mot_cle").select(*columns)

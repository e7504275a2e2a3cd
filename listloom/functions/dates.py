"""Date rules, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The birth date layouts that are read, day first.
BIRTH_LAYOUTS = [
    "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-M-d", "yyyy/M/d",
    "d/M/yyyy H:m:s", "d-M-yyyy H:m:s", "yyyy-M-d H:m:s",
]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _shape(layout: str) -> str:
    """Pattern of the texts that a layout can read."""
    digits = {"yyyy": r"\d{4}"} | {letter: r"\d{1,2}" for letter in "dMHms"}
    parts = re.split("(yyyy|[dMHms])", layout)
    return "^" + "".join(digits.get(part, re.escape(part)) for part in parts) + "$"


def read_birth(value: Column | str) -> Column:
    """Date of a birth text; null when incomplete, unreadable or before 1900.

    A layout is only tried on texts of its shape: a failed try costs far more
    than the look at the shape.
    """
    text = F.trim(_col(value).cast("string"))
    stamp = F.coalesce(*[
        F.when(text.rlike(_shape(layout)), F.try_to_timestamp(text, F.lit(layout)))
        for layout in BIRTH_LAYOUTS
    ])
    return F.when(F.year(stamp) >= 1900, F.to_date(stamp))


# Layouts of the time of a lead, with or without a time of day.
WHEN_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy",
)


def read_when(value: Column | str) -> Column:
    """Time of a text in one of the stated layouts, day first; null if none reads it."""
    text = F.trim(_col(value).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in WHEN_LAYOUTS])


def birth_format(value: Column | str) -> Column:
    """``yyyyMMdd000000`` text of a birth date, null where there is none."""
    return F.date_format(read_birth(value), "yyyyMMdd'000000'")


def unread_birth(value: Column | str) -> Column:
    """True for a given birth text that no layout reads; such rows go to quarantine."""
    value = _col(value).cast("string")
    given = F.coalesce(F.trim(value) != "", F.lit(False)) & ~F.lower(value).isin("none", "nan")
    return given & read_birth(value).isNull()


def not_run_date(value: Column | str, run_date: Column) -> Column:
    """Missing where the date only repeats the day of processing."""
    value = _col(value)
    return F.when(~value.eqNullSafe(run_date), value)


def century_repair(value: Column | str) -> Column:
    """Bring a date of a wrong century back, by whole centuries of 36,500 days.

    Years up to 1 are missing; years 2 to 1900 move forward to the 1900s and
    years after 2014 move back.
    """
    value = _col(value)
    year = F.year(value)
    shift = (F.lit(19) - F.floor(year / F.lit(100))) * F.lit(36500)
    moved = F.date_add(value, shift.cast("int"))
    return (
        F.when(year <= 1, F.lit(None).cast("date"))
        .when((year <= 1900) | (year > 2014), moved)
        .otherwise(value)
    )


def date_text(value: Column | str, layout: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_col(value), layout)

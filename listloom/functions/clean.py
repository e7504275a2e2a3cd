"""Cleaning rules for single values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Civility codes and their labels.
CIVILITY = {"1.0": "M", "2.0": "MLLE", "3.0": "MME"}

# Texts that stand for a missing value.
NULL_TEXTS = ["none", "nan"]

# Webmail domains left out of the non-webmail extract.
WEBMAIL = [
    "hotmail.com", "hotmail.fr", "live.com", "gmail.com",
    "wanadoo.fr", "orange.fr", "orange.com",
]

# An address: no blanks, one @, a dotted domain.
_ADDRESS = r"^[a-z0-9!#$%&'*+/=?^_`{|}~.-]+@[a-z0-9](?:[a-z0-9-]*[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]*[a-z0-9])?)+$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_text(value: Column | str) -> Column:
    """Missing where the text only says so (``None``, ``nan``)."""
    value = _col(value)
    return F.when(~F.lower(F.trim(value)).isin(NULL_TEXTS), value)


def missing(value: Column | str) -> Column:
    """True for null and for blank text."""
    value = _col(value)
    return value.isNull() | (F.trim(value) == "")


def lower_case(value: Column | str) -> Column:
    return F.lower(_col(value))


def trimmed(value: Column | str) -> Column:
    return F.trim(_col(value))


def civility(value: Column | str) -> Column:
    """Label of a civility code; anything else stays as it is."""
    value = _col(value)
    labels = F.create_map(*[F.lit(text) for pair in CIVILITY.items() for text in pair])
    return F.coalesce(F.try_element_at(labels, value), value)


def strip_decimal(value: Column | str) -> Column:
    """Cut ``,x`` or ``.x`` off a number text. Leading zeros stay, so postcodes survive."""
    value = null_text(value)
    return F.regexp_replace(value, r"^(\d+)[.,].*$", "$1")


def normal_mail(value: Column | str) -> Column:
    return F.lower(F.trim(_col(value)))


def valid_mail(value: Column | str) -> Column:
    """True when the normalised text is a well-formed address; never null."""
    return F.coalesce(normal_mail(value).rlike(_ADDRESS), F.lit(False))


def mail_hash(mail: Column | str, normalise: bool = True) -> Column:
    return F.md5(normal_mail(mail) if normalise else _col(mail))


def mail_domain(mail: Column | str) -> Column:
    return F.substring_index(_col(mail), "@", -1)


def has_ip(*ips: Column | str) -> Column:
    """True when one of the columns holds a dotted address."""
    found = F.lit(False)
    for ip in ips:
        found = found | F.coalesce(null_text(ip).contains("."), F.lit(False))
    return found


def first_ip(*ips: Column | str) -> Column:
    return F.coalesce(*[F.when(has_ip(ip), _col(ip)) for ip in ips])


def department(cp: Column | str) -> Column:
    return F.left(_col(cp), F.lit(2))


def any_of(value: Column | str, choices: list[str], whole: bool = True) -> Column:
    """Whole-text or contained match of one of the alternatives of a pattern."""
    pattern = "|".join(choices)
    return _col(value).rlike(f"^({pattern})$" if whole else f"({pattern})")


def true_and_none(include: str, exclude: list[str]) -> Column:
    """``include`` is true and no flag of ``exclude`` is; a missing flag passes."""
    keep = F.col(include).eqNullSafe(F.lit(True))
    for flag in exclude:
        keep = keep & ~F.col(flag).eqNullSafe(F.lit(True))
    return keep

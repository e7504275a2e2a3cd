"""One row per contact out of many identities, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.model import IDENTITY


def identity_values(ids: DataFrame, attributes: list[str] = IDENTITY) -> DataFrame:
    """Per contact the sorted distinct values of each attribute, as arrays."""
    return ids.groupBy("mail_id").agg(
        *[F.sort_array(F.collect_set(F.col(a).cast("string"))).alias(a) for a in attributes]
    )


def collapse_identities(ids: DataFrame, attributes: list[str] = IDENTITY) -> DataFrame:
    """Exactly one row per contact; the values of an attribute joined by commas.

    An attribute without any value gives the empty text. Take
    ``identity_values`` where a value may itself hold a comma.
    """
    values = identity_values(ids, attributes)
    return values.select("mail_id", *[F.concat_ws(",", a).alias(a) for a in attributes])


def clean_identities(ids: DataFrame) -> DataFrame:
    """Identity rows without exact repeats (the surrogate key aside, the lowest is kept)."""
    columns = [c for c in ids.columns if c != "id"]
    return ids.groupBy(*columns).agg(F.min("id").alias("id")).select(*ids.columns)


def attribute_map(attributes: list[str] = IDENTITY):
    """Map ``attribute_n`` to value for the packed columns of a row, numbered from 1."""
    def entries(name: str):
        values = F.filter(F.split(F.col(name), ","), lambda v: v != "")
        return F.transform(
            values,
            lambda v, i: F.struct(
                F.concat(F.lit(f"{name}_"), (i + 1).cast("string")).alias("key"), v.alias("value")
            ),
        )

    packed = [F.coalesce(entries(a), F.array().cast("array<struct<key:string,value:string>>"))
              for a in attributes]
    return F.map_from_entries(F.concat(*packed))


def unpack_identity(packed: DataFrame, attributes: list[str] = IDENTITY) -> DataFrame:
    """One row per contact and numbered attribute."""
    return packed.select("mail_id", F.explode(attribute_map(attributes)).alias("attribute", "value"))

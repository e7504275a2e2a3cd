"""Reach counts of brokers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.model import Model
from listloom.operators.joins import keep_in, left_one


def reach_counts(model: Model, members: DataFrame) -> DataFrame:
    """Distinct contacts, mobile numbers and postcodes of members that have both.

    Rows of all four tables are tagged and meet once, by contact; a contact's numbers and
    postcodes are made distinct before they are shuffled. Pairs are made distinct before they
    are counted, which keeps the counts out of one task.
    """
    def tagged(kind: str, rows: DataFrame, key: str, value: str | None = None) -> DataFrame:
        shown = F.lit(None).cast("string") if value is None else F.col(value).cast("string")
        return rows.select(F.col(key).alias("mail_id"), F.lit(kind).alias("kind"), shown.alias("value"))

    rows = (
        tagged("base", model["base"], "id")
        .unionByName(tagged("member", members, members.columns[0]))
        .unionByName(tagged("sms", model["sms"], "mail_id", "port"))
        .unionByName(tagged("cp", model["id"], "mail_id", "cp"))
    )
    values = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("value"))).alias(f"{kind}_values")
    people = rows.filter("mail_id IS NOT NULL").groupBy("mail_id").agg(
        *[F.bool_or(F.col("kind") == kind).alias(kind) for kind in ("base", "member", "sms", "cp")], values("sms"), values("cp")
    ).filter("base AND member AND sms AND cp")
    pairs = people.select(F.explode(F.concat(
        F.array(F.struct(F.lit("mail").alias("kind"), F.col("mail_id").cast("string").alias("value"))),
        _pairs_of("sms"), _pairs_of("cp"),
    )).alias("p")).select("p.kind", "p.value").distinct()
    return pairs.agg(
        F.count_if(F.col("kind") == "mail").alias("n_mail"),
        F.count_if(F.col("kind") == "sms").alias("n_sms"),
        F.count_if(F.col("kind") == "cp").alias("n_cp"),
    )


def _pairs_of(kind: str) -> Column:
    return F.transform(f"{kind}_values", lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


def reach_profile(model: Model, members: DataFrame, packed: DataFrame) -> DataFrame:
    """Distinct mails, rows with a mobile number and rows with a postcode.

    Rows are those of contact, number and packed identity joined; they are
    counted per contact instead of being built.
    """
    numbers = model["sms"].groupBy("mail_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("port").alias("_ports")
    )
    people = keep_in(model.contacts, members)
    people = left_one(people, numbers)
    people = left_one(people, packed.select("mail_id", "cp"))
    rows = F.coalesce(F.col("_rows"), F.lit(1))
    return people.agg(
        F.count_distinct("mail").alias("mail"),
        F.coalesce(F.sum("_ports"), F.lit(0)).alias("sms"),
        F.coalesce(F.sum(F.when(F.col("cp").isNotNull(), rows)), F.lit(0)).alias("cp"),
    )


def thousands(n: Column | str) -> Column:
    return F.floor((F.col(n) if isinstance(n, str) else n) / 1000).cast("long")

"""Sizes of many segments at once, from bitmaps of the lists they ask for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.model import Model
from listloom.operators.bitmaps import Wanted, bitmaps, members_of, segment_sizes
from listloom.plans.segment import Segment

# Lists of one kind stand in one match table; {kind: (match table, key of the entry, list table, name of the entry)}.
KINDS = {
    "partner": ("partner_match", "partner_id", None, None),
    "file": ("fichier_match", "fichier_id", "fichier_list", "fichier_num"),
    "broker": ("regie_match", "regie_id", "regie_list", "abreviation"),
}


def _of_kind(model: Model, kind: str, names: list[str]) -> DataFrame:
    """(list, mail_id) of the named lists of a kind, from one scan of their match table."""
    table, link, entries, name = KINDS[kind]
    rows = model.rows(table).select("mail_id", F.col(link).alias("_link"))
    if entries is None:
        rows = rows.withColumn("_name", F.col("_link").cast("string"))
    else:
        rows = rows.join(model[entries].select(F.col("id").alias("_link"), F.col(name).alias("_name")), "_link")
    rows = rows.filter(F.col("_name").isin(names))
    return rows.select(F.concat(F.lit(f"{kind}:"), "_name").alias("list"), F.col("mail_id").cast("long").alias("mail_id"))


def list_members(model: Model, names: set[str]) -> DataFrame:
    """(list, mail_id) of lists by name: ``base``, ``partner:...``, ``file:...``, ``broker:...``, or a status as ``Segment.only`` has it."""
    segment, asked, plain = Segment(model), {}, {}
    for name in sorted(names):
        kind, _, entry = name.partition(":")
        if kind in KINDS:
            asked.setdefault(kind, []).append(entry)
        else:
            plain[name] = model["base"].select(F.col("id").alias("mail_id")) if name == "base" else segment.named_keys(name)
    rows = members_of(plain)
    for kind, entries in asked.items():
        rows = rows.unionByName(_of_kind(model, kind, entries))
    return rows


def segment_counts(model: Model, segments: dict[str, Wanted]) -> DataFrame:
    """(segment, n): contacts of the base in each segment; every table with a list is read once for all of them."""
    asked = {name: Wanted([["base"], *w.groups], w.out) for name, w in segments.items()}
    names = {n for w in asked.values() for n in [*w.out, *(x for g in w.groups for x in g)]}
    return segment_sizes(bitmaps(list_members(model, names)), asked)

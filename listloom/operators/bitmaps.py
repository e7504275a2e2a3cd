"""Membership as bitmaps: the sizes of many segments from one scan of their lists.

A list is cut into buckets of 32,768 contact numbers, each a bitmap of 4 KB. A segment asks for members of one list or another, in
several groups, without those of further lists. Bitmaps are only ever united; what is in several groups at once is
counted by inclusion and exclusion of unions, which are shared by all segments that ask for them.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Groups of a segment at most: a segment takes a union for each choice among them.
MOST_GROUPS = 6


class Wanted(NamedTuple):
    """Members of any list of each group, and of none of the lists in ``out``."""

    groups: list[list[str]]
    out: list[str] = []


def members_of(lists: dict[str, DataFrame], key: str = "mail_id") -> DataFrame:
    """(list, mail_id) of several key sets by name."""
    named = [df.select(F.lit(name).alias("list"), F.col(key).cast("long").alias("mail_id")) for name, df in lists.items()]
    return reduce(DataFrame.unionAll, named)


def bitmaps(members: DataFrame) -> DataFrame:
    """(list, bucket, bits) of rows (list, mail_id); repeats and missing numbers do no harm.

    Bits are set before anything is shuffled, so a list of any size arrives as one row per task and bucket.
    """
    rows = members.filter("mail_id IS NOT NULL").select(
        "list", F.bitmap_bucket_number("mail_id").alias("bucket"), F.bitmap_bit_position("mail_id").alias("bit")
    )
    return rows.groupBy("list", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def merged(maps: Iterable[DataFrame]) -> DataFrame:
    """Bitmaps of several loads as one for each list and bucket."""
    return reduce(DataFrame.unionByName, maps).groupBy("list", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _terms(wanted: Wanted) -> list[tuple[int, frozenset[str]]]:
    """Signed unions whose sizes add up to that of the segment.

    For sets A it holds that the size of all at once is that of single ones, less pairs' unions, and so on. Here A is a group
    without ``out``, and the size of a union without ``out`` is that of both together less that of ``out``.
    """
    if not wanted.groups or len(wanted.groups) > MOST_GROUPS:
        raise ValueError(f"a segment has one group to {MOST_GROUPS}")
    out, found = frozenset(wanted.out), []
    for n in range(1, len(wanted.groups) + 1):
        for some in combinations(wanted.groups, n):
            sign = 1 if n % 2 else -1
            found.append((sign, frozenset().union(*some) | out))
            if out:
                found.append((-sign, out))
    return found


def segment_sizes(maps: DataFrame, segments: dict[str, Wanted]) -> DataFrame:
    """(segment, n): how many contacts each segment has."""
    spark = maps.sparkSession
    signed = [(name, sign, union) for name, wanted in segments.items() for sign, union in _terms(wanted)]
    numbers = {union: i for i, union in enumerate(sorted({u for _, _, u in signed}, key=sorted))}
    # As large as what the caller asked for, whatever the lists hold.
    lists = spark.createDataFrame([(i, name) for union, i in numbers.items() for name in sorted(union)], "term int, list string")
    signs = spark.createDataFrame([(name, sign, numbers[union]) for name, sign, union in signed], "segment string, sign int, term int")
    united = maps.join(F.broadcast(lists), "list").groupBy("term", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    sizes = united.groupBy("term").agg(F.sum(F.bitmap_count("bits")).alias("size"))
    total = F.sum(F.col("sign") * F.coalesce("size", F.lit(0))).cast("long")
    return signs.join(sizes, "term", "left").groupBy("segment").agg(total.alias("n"))

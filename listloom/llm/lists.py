"""Sorted lists: rows with the same key, read in order without gathering a list in one task.

Rows are range partitioned by key and member, so that a long list lies in several partitions. Each
partition is read as a stream. Where a list goes on in the next partition, the
last row of the one and the first of the other are matched by a table of two rows per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.llm.text import ship, tidy, written

ship(__name__)

_OUT = "kind int, part int, key long, pivot long, member long"


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    last_key = last_member = pivot = None
    named = False  # whether the open list's first member was given

    def rows(kind: int, keys, pivots, members) -> pa.RecordBatch:
        n = len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), *(pa.array(x, pa.int64()) for x in (keys, pivots, members))],
            ["kind", "part", "key", "pivot", "member"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, members = (batch.column(i).to_numpy() for i in (0, 2))
        if last_key is None:
            yield rows(1, keys[:1], members[:1], members[:1])
            last_key, last_member, pivot = keys[0], members[0], members[0]
        starts = np.empty(len(keys), bool)
        starts[0] = keys[0] != last_key
        starts[1:] = keys[1:] != keys[:-1]
        at = np.maximum.accumulate(np.where(starts, np.arange(len(keys)), -1))
        pivots = np.where(at >= 0, members[np.maximum(at, 0)], pivot)
        before = np.concatenate([[last_member], members[:-1]])
        new = ~starts & (members != before) & (members != pivots)
        if new.any():
            # A list's first member is one of its members; it is given once, before the second one.
            k, p = keys[new], pivots[new]
            first = np.concatenate([[not (named and k[0] == last_key)], k[1:] != k[:-1]])
            yield rows(0, k[first], p[first], p[first])
            yield rows(0, k, p, members[new])
        named = bool(new.any() and keys[new][-1] == keys[-1]) or (named and keys[-1] == last_key)
        last_key, last_member, pivot = keys[-1], members[-1], pivots[-1]
    if last_key is not None:
        yield rows(2, [last_key], [pivot], [last_member])


def stars(rows: DataFrame) -> DataFrame:
    """(key, pivot, member) from rows (key long, rank int, member long): each list's members, tied to its first one, itself included.

    Members are in order of rank. A list over several partitions has a first member in each; each of those is tied to that of the
    partition before. Repeated rows count once; lists of one member give nothing.
    """
    ordered = rows.select("key", "rank", "member").repartitionByRange("key", "rank", "member")
    found = written(ordered.sortWithinPartitions("key", "rank", "member").mapInArrow(tidy(_stars), _OUT), "lists")
    ends = found.filter("kind > 0")
    # Two rows per partition.
    before = W.orderBy("part", "kind")
    ends = ends.withColumn("k", F.lag("key").over(before)).withColumn("p", F.lag("pivot").over(before))
    joined = ends.filter("kind = 1 and key = k and member <> p").select("key", F.col("p").alias("pivot"), "member")
    joined = joined.select("key", "pivot", F.explode(F.array("pivot", "member")).alias("member"))
    return found.filter("kind = 0").select("key", "pivot", "member").unionByName(joined)

"""Positions in a total order, found without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.session import frozen

# monotonically_increasing_id() holds the partition above and the row below this bit.
_ROW_BITS = 33


def with_position(
    df: DataFrame,
    order: list[Column],
    name: str = "position",
    weight: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in the given order.

    With ``weight`` the position is the sum of that column over all earlier
    rows; ``total`` names a column for the overall count or sum. The rows are range partitioned and sorted, and kept in the shared
    folder. Each partition then only needs the total of the partitions before
    it: a table with one row per partition.
    """
    ordered = frozen(df.orderBy(*order)).withColumn("_row", F.monotonically_increasing_id())
    ordered = ordered.withColumn("_part", F.shiftright("_row", _ROW_BITS))
    amount = F.lit(1) if weight is None else F.col(weight)
    totals = ordered.groupBy("_part").agg(F.sum(amount).alias("_total"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
        F.sum("_total").over(W.partitionBy()).alias("_all"),
    )
    if weight is None:
        inside = F.col("_row") - F.shiftleft(F.col("_part"), _ROW_BITS)
    else:
        earlier = W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(weight).over(earlier), F.lit(0))
    placed = ordered.withColumn("_inside", inside)
    # One row per partition of ``ordered``: the size is known before the join.
    placed = placed.join(F.broadcast(offsets), "_part")
    position = (F.col("_offset") + F.col("_inside")).cast("long").alias(name)
    overall = [F.col("_all").cast("long").alias(total)] if total else []
    return placed.select(*df.columns, position, *overall)

"""Mixing sources to target weights along a curriculum.

Each source has a weight schedule: points (time, weight) between time 0 and 1,
joined by straight lines. The integral of the schedule is the source's weight
in the mix; the share of it up to time t is the part of its words that is due by then. A
document's words stand somewhere in its source's stream of words; the inverse of the
integral turns that place into a time, the document's position in training. Documents
sorted by position follow the curriculum: at any time, sources meet at the
rates of their schedules.

Targets share all words by weight. No source gives more than ``most`` times
its own words: what is above is shared again by weight among the rest, until
none is above.

The stream of a source is its documents in the order of a hash. Places in it
are sums over ``BUCKETS`` hash buckets per source and then inside one bucket,
so a source that holds a third of all rows is spread over as many tasks.

Cases: a null or empty text has size 0 and takes no words, but has a position.
A null source is a source of its own. Repeated rows and equal ids are documents
of their own. Sources without a schedule get an even one of weight 0 and are
not taken. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.llm.text import SPACES, let, packed, split_words, text_of
from listloom.operators.rank import with_position
from listloom.session import frozen

BUCKETS = 4096


def schedule(*points: tuple[float, float]) -> Column:
    """An array of (t, w) points; times run from 0 to 1."""
    return F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in points])


def weight_of(points: Column) -> Column:
    """The integral of a schedule from time 0 to 1."""
    return F.aggregate(
        F.sequence(F.lit(2), F.size(points)),
        F.lit(0.0),
        lambda total, i: total
        + (F.element_at(points, i)["t"] - F.element_at(points, i - 1)["t"])
        * (F.element_at(points, i)["w"] + F.element_at(points, i - 1)["w"])
        / 2,
    )


def time_of(points: Column, share: Column) -> Column:
    """The time at which the integral reaches ``share`` of its whole.

    The pieces of the schedule are passed until the one that holds the share;
    inside it the integral is a quadratic in the time.
    """

    def step(acc: Column, i: Column) -> Column:
        a, b = F.element_at(points, i - 1), F.element_at(points, i)
        width = b["t"] - a["t"]
        area = width * (a["w"] + b["w"]) / 2
        slope = F.when(width > 0, (b["w"] - a["w"]) / width).otherwise(0.0)
        root = F.sqrt(F.greatest(a["w"] * a["w"] + slope * acc["left"] * 2, F.lit(0.0)))
        # left = w * x + slope * x * x / 2, in the form that stays exact for small slopes
        inside = F.when(root + a["w"] > 0, acc["left"] * 2 / (root + a["w"])).otherwise(0.0)
        here = (~acc["done"]) & (acc["left"] <= area)
        return F.struct(
            F.when(acc["done"] | here, acc["left"]).otherwise(acc["left"] - area).alias("left"),
            F.when(acc["done"], acc["t"]).when(here, a["t"] + F.least(inside, width)).otherwise(b["t"]).alias("t"),
            (acc["done"] | here).alias("done"),
        )

    start = F.struct((share * weight_of(points)).alias("left"), F.lit(0.0).alias("t"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(2), F.size(points)), start, step, lambda acc: F.least(acc["t"], F.lit(1.0)))


def targets(sources: DataFrame, most: float = 3.0) -> DataFrame:
    """Add ``target`` to (source, source_size, points, weight): all words shared by weight, none above ``most`` sizes.

    Each round takes the sources whose share is above their bound out of the
    sharing. Only sums over all sources come to the driver, two numbers a round.
    """
    bound = F.col("source_size") * F.lit(float(most))
    sources = frozen(sources)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, kept_out = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= bound if kept_out >= 0 else F.lit(False)
        spent, weight, n = sources.agg(
            F.coalesce(F.sum(F.when(full, bound)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
            F.count(F.when(full, 1)),
        ).first()
        if n == kept_out or weight <= 0:
            break
        kept_out, level = n, (total - spent) / weight
    if weight <= 0:
        level = float("inf") if kept_out >= 0 else 0.0
    target = F.when(F.col("weight") <= 0, 0.0).otherwise(F.least(bound, F.col("weight") * F.lit(level)))
    return sources.withColumn("target", target)


def curriculum(sources: DataFrame) -> DataFrame:
    """Schedules of the standing mix: sources by code point, null last, weigh 1, 2, 3 and so on again.

    The lightest third starts at twice its weight and fades out, the heaviest grows from nothing to
    twice its weight, the middle one stays even; the integrals are the weights.
    """
    placed = with_position(sources, [F.col("source").asc_nulls_last()], "place")
    kind = F.col("place") % 3
    points = (
        F.when(kind == 0, schedule((0, 2), (1, 0)))
        .when(kind == 1, schedule((0, 2), (1, 2)))
        .otherwise(schedule((0, 0), (0.5, 3), (1, 6)))
    )
    return placed.select("source", "source_size", points.alias("points"), weight_of(points).alias("weight"))


def place_documents(docs: DataFrame, most: float = 3.0, whole: bool = False, plan=curriculum) -> DataFrame:
    """Per row: doc_id, text_key, size, source, source_size, target, taken and ``positions``, one for each copy.

    A source whose target is r times its words gives each document as often as
    r is whole, and the first documents of its stream once more for the rest.
    The document at the end of the rest is cut to the words that are still due; with ``whole`` it is taken
    whole if half of it is due, else not at all.
    """
    rows = frozen(docs.select(
        F.col("doc_id"),
        F.xxhash64(F.col("text")).alias("text_key"),
        F.col("source"),
        F.size(split_words(text_of(), SPACES)).cast("long").alias("size"),
    ))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    mix = frozen(targets(plan(sizes), most))
    order = F.xxhash64(F.lit(7), F.col("doc_id"), F.col("text_key"))
    rows = rows.withColumn("order", order).withColumn("bucket", F.shiftright(F.col("order"), 52))  # 4096 buckets
    per_bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bucket.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")
    )
    inside = W.partitionBy("source", "bucket").orderBy("order", "doc_id", "text_key", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(offsets, rows["source"].eqNullSafe(offsets["s"]) & (rows["bucket"] == offsets["b"]))
    mix = mix.select(F.col("source").alias("m"), "source_size", "points", "target")
    placed = rows.join(mix, rows["source"].eqNullSafe(mix["m"])).withColumn("begin", F.col("offset") + F.col("inside"))

    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    due = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    if whole:
        last = F.when(F.col("begin") + F.col("size") / 2 <= F.col("due"), F.col("size")).otherwise(F.lit(0))
    else:
        last = F.least(F.greatest(F.col("due") - F.col("begin"), F.lit(0)), F.col("size"))
    placed = (
        placed.withColumn("epochs", epochs)
        .withColumn("due", due)
        .withColumn("rest", last.cast("long"))
        .withColumn("taken", F.col("size") * F.col("epochs") + F.col("rest"))
    )
    copies = (F.col("epochs") + F.when(F.col("rest") > 0, 1).otherwise(0)).cast("int")
    share = lambda k: (k * F.col("source_size") + F.col("begin")) / F.col("target")
    positions = F.when(
        (copies > 0) & (F.col("target") > 0),
        F.transform(F.sequence(F.lit(0), copies - 1), lambda k: let(F.least(share(k), F.lit(1.0)), lambda s: time_of(F.col("points"), s))),
    ).otherwise(F.array().cast("array<double>"))
    return placed.select(
        "doc_id", "text_key", "source", "size", "source_size", "target", "taken", positions.alias("positions")
    )


def mix_documents(docs: DataFrame, most: float = 3.0, plan=curriculum) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them, sorted by position; documents stay whole."""
    rows = packed(docs)
    placed = place_documents(docs, most, whole=True, plan=plan).select("doc_id", "text_key", "positions")
    # Rows that agree in id and text agree in all that counts here but their place: each takes one of the places.
    same = W.partitionBy("doc_id", "text_key").orderBy("positions")
    placed = placed.withColumn("nth", F.row_number().over(same))
    rows = rows.withColumn("nth", F.row_number().over(W.partitionBy("doc_id", "text_key").orderBy(F.lit(0))))
    match = rows["doc_id"].eqNullSafe(placed["doc_id"]) & rows["text_key"].eqNullSafe(placed["text_key"]) & (rows["nth"] == placed["nth"])
    copies = rows.join(placed, match).select("row", F.explode("positions").alias("position"))
    return copies.orderBy("position", "row.doc_id").select("row.*")


def mixing_report(docs: DataFrame) -> DataFrame:
    """One row per document, sorted by its first position; documents that are not taken come last."""
    placed = place_documents(docs)
    return placed.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.size("positions").alias("copies"), F.get("positions", F.lit(0)).alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")

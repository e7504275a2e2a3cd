"""Benchmark decontamination: windows of test items looked up in the windows of the training texts.

Any run of L words holds a whole block of (L + 1) // 2 words that starts at a
multiple of that number. So a text that holds a window of L words shows one of the
window's inner runs ("seeds") in its own blocks, and only one block in (L + 1) // 2 words has
to be looked up. The seeds form a hash set that every task holds. Blocks that
hit bring the words around them; all windows there are made and compared with the
items' windows as texts, which verifies each hit. Only hits and one row per text
are shuffled, and texts are read once. Both sets are broadcast only after the
size of the windows has been measured; beyond ``broadcast_bytes`` the same joins shuffle.

Cases: null and empty texts have no words and no hits. An item of fewer words
than ``size`` is one window of its own length; an item without words is none.
Repeated items, and items that share a window, all count as occurring. Rows
that repeat an id and a text each get the same result; rows that share only the id
are judged apart. An empty benchmark or an empty table gives no hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.llm.text import NON_ALNUM, NON_ALNUM_ANY_CASE, let, lowered, packed, same_row, split_words, text_of, windows, with_key


def item_windows(benchmark: DataFrame, size: int = 13, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window, length, items): every window with the ids, as strings, of the items that hold it."""
    words = benchmark.select(
        F.col(item_id).cast("string").alias("item"),
        split_words(lowered(text_of(text)), NON_ALNUM).alias("words"),
    ).filter(F.size("words") > 0)
    long = windows(F.col("words"), size)
    short = F.array(F.concat_ws(" ", F.col("words")))
    return (
        words.select(
            "item",
            F.least(F.size("words"), F.lit(size)).alias("length"),
            F.explode(F.when(F.size("words") >= size, long).otherwise(short)).alias("window"),
        )
        .groupBy("window", "length")
        .agg(F.collect_set("item").alias("items"))
    )


def _seeds(held: DataFrame, length: int) -> DataFrame:
    """(seed): every run of half a window's words."""
    words = F.split("window", " ", -1)
    return held.filter(F.col("length") == length).select(
        F.explode(let(words, lambda w: windows(w, (length + 1) // 2))).alias("seed")
    ).distinct()


def find_hits(
    docs: DataFrame, benchmark: DataFrame, size: int = 13, broadcast_bytes: int = 128 << 20
) -> DataFrame:
    """(doc_id, text_key, n_words, start, length, items): a row for each place where an item's window stands.

    Each row of ``docs`` also gives one row with its n_words and without start.
    """
    held = item_windows(benchmark, size)
    measured = held.groupBy("length").agg(F.count("*").alias("n"), F.sum(F.length("window") + 64).alias("bytes")).collect()
    lengths = sorted(r["length"] for r in measured) or [size]  # at most ``size`` values
    # A window has at most as many seeds as words.
    small = sum(r["bytes"] for r in measured) * (size // 2 + 1) <= broadcast_bytes
    hold = F.broadcast if small else lambda df: df

    def aligned(w, n):
        half = (n + 1) // 2

        def block(i):
            before = [F.when(i + k >= 0, F.get(w, F.greatest(i + k, F.lit(0)))) for k in range(half - n, 0)]
            return F.struct(
                F.lit(n).alias("length"),
                F.lower(F.concat_ws(" ", *[F.get(w, i + k) for k in range(half)])).alias("seed"),
                F.concat_ws(" ", *before, *[F.get(w, i + k) for k in range(n)]).alias("around"),
                F.greatest(i + (half - n), F.lit(0)).alias("first"),
            )

        starts = F.sequence(F.lit(0), F.size(w) - half, F.lit(half))
        none = F.array().cast("array<struct<length:int,seed:string,around:string,first:int>>")
        return F.when(F.size(w) >= half, F.transform(starts, block)).otherwise(none)

    # A-Z are lower-cased after the lookup, where few texts are left. lower() maps
    # equal words to equal words, so no hit is missed before.
    def blocks(w):
        own = F.array(F.struct(
            F.lit(0).alias("length"),
            # No word holds a tab: this meets no seed, and no two rows meet in one task for it.
            F.concat_ws("\t", F.lit(""), F.col("doc_id"), F.col("text_key")).alias("seed"),
            F.lit("").alias("around"),
            F.size(w).alias("first"),
        ))
        made = [own, *[aligned(w, length) for length in lengths]]
        return F.concat(*made)

    looked_up = with_key(docs).select(
        "doc_id", "text_key", F.inline(let(split_words(F.col("text"), NON_ALNUM_ANY_CASE), blocks))
    )
    seeds = None
    for length in lengths:
        part = _seeds(held, length).select(F.lit(length).alias("length"), F.lower("seed").alias("seed"))
        seeds = part if seeds is None else seeds.unionByName(part)
    seeds = seeds.distinct().withColumn("hit", F.lit(True))
    met = looked_up.join(hold(seeds), ["seed", "length"], "left").filter("hit or length = 0")
    n_words = F.when(F.col("length") == 0, F.col("first")).cast("long")
    around = split_words(lowered(F.col("around")), " ")
    runs = lambda n: let(around, lambda w: windows(w, n))
    found = F.coalesce(*[F.when(F.col("length") == n, runs(n)) for n in lengths])
    placed = met.select(
        "doc_id", "text_key", "length", "first", n_words.alias("n_words"), F.posexplode_outer(found).alias("at", "window")
    )
    sets = held.select("window", F.col("length").alias("n"), "items")
    return (
        placed.join(hold(sets), (placed["window"] == sets["window"]) & (placed["length"] == sets["n"]), "left")
        .filter("n is not null or length = 0")
        .select("doc_id", "text_key", "n_words", (F.col("first") + F.col("at")).alias("start"), "n", "items")
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 13, share: tuple[int, int] = (1, 20), **options
) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, n_hit, items (sorted), contaminated.

    A text is contaminated if at least ``share`` of its words stand in hits.
    """
    covered = F.aggregate(
        F.sort_array("spans"),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["n"]).alias("end"),
            (acc["total"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(s["start"], acc["end"]))).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    per_doc = (
        find_hits(docs, benchmark, size, **options)
        .groupBy("doc_id", "text_key")
        .agg(
            F.max("n_words").alias("n_words"),
            F.count("n_words").alias("rows"),
            F.collect_set(F.when(F.col("n").isNotNull(), F.struct("start", "n"))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    return per_doc.select(
        "doc_id", "text_key", "n_words", covered.cast("long").alias("n_hit"), "items",
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_row"),  # repeated rows
    ).drop("_row").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share[1] >= F.col("n_words") * share[0])
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = 13, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts are not contaminated."""
    bad = contamination(docs, benchmark, size, **options).filter("contaminated").select("doc_id", "text_key").distinct()
    rows = packed(docs)
    return rows.join(bad, same_row(rows, bad), "left_anti").select("row.*")


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """One row per document with the digest of its items."""
    found = contamination(docs, benchmark, size)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )

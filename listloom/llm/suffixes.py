"""Repeated passages by suffixes that are sorted as far as a passage must agree.

A passage of ``LEAST`` words that stands in two texts is the beginning of a suffix of each. Suffixes are named by a 64-bit
hash of their first ``LEAST`` words and sorted by it: those that agree in all these words follow each other, whatever stands before
and after them, and a match counts if two texts are among them. What a longer passage has beyond that is covered by its other
suffixes.

Only suffixes that may have a partner are kept: of the ``GRAM``-word runs in the first ``LEAST`` words the one with the least
hash is the same in all copies, so that a suffix whose least run stands in one text only is left out
before the sort, by a filter of fixed size.

The sort is by ranges over hash, text and place, so that a passage with very many copies lies in several partitions.
Sorted rows are read in lots. Of a hash that lies wholly in a lot all rows are settled there: each meets the
smallest other text. The first and last hash of a lot may go on in the next one, or in other partitions; their rows wait, and the two
smallest texts of each such hash are found over all lots from one row per lot.

Cases: null and empty texts, and texts of fewer than ``LEAST`` words, have no passages. Copies of a text
repeat as a whole. A text is known by its id and the hash of its words, so that rows that share an id, or have none, stay apart
unless they are equal; equal rows are one text to each other, and a text that repeats itself only has no passages. A-Z count as a-z. Texts
are ordered by id, missing ones first, then by that hash. Very long texts are read whole, in lots of their own; other columns are not looked at.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.llm.jaccard import _mix, _odd, word_hashes
from listloom.llm.text import let, ship, split_words, text_of, written
from listloom.session import frozen

ship(__name__)

LEAST, GRAM = 50, 10
SPAN = LEAST - GRAM + 1
# Texts and suffixes that a task handles at once.
TEXTS, ROWS = 400, 100_000
FILTER_BITS = 1 << 26
_ODD = {k: _odd(400 + k) for k in range(128)}
_RUN_ODD = [_odd(300 + i) for i in range(GRAM)]
# A suffix: the hash of its first words, its text by id and by hash, and its place.
ORDER = ["key", "doc", "own", "at"]
# Stands for a missing id.
NO_ID = -(1 << 63)


def _slide(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``size`` values in a row."""
    held, n = x, 1
    while 2 * n <= size:
        held = pick(held[: len(held) - n], held[n:])
        n *= 2
    rest = size - n
    return pick(held[: len(held) - rest], held[rest:]) if rest else held


def least_runs(words: np.ndarray) -> np.ndarray:
    """Per place with ``LEAST`` words from there: the least hash of the runs of ``GRAM`` words in them."""
    if len(words) < LEAST:
        return np.zeros(0, np.uint64)
    n = len(words) - GRAM + 1
    gram = words[:n] * _RUN_ODD[0]
    for i in range(1, GRAM):
        gram += words[i : n + i] * _RUN_ODD[i]
    return _slide(_mix(gram), SPAN, np.minimum)


def beginnings(words: np.ndarray) -> np.ndarray:
    """Per place with ``LEAST`` words from there: their hash."""
    if len(words) < LEAST:
        return np.zeros(0, np.uint64)
    # Hashes of 2, 4, ... words by those of half as many; each word has an odd factor of its own.
    held = {1: words}
    for k in (1, 2, 4, 8, 16):
        held[2 * k] = held[k][:-k] * _ODD[2 * k] + held[k][k:] * _ODD[2 * k + 1]
    n, total, at = len(words) - LEAST + 1, np.uint64(0), 0
    for k in (32, 16, 8, 4, 2, 1):
        if LEAST & k:
            total = total + held[k][at : at + n] * _ODD[k + 64]
            at += k
    return _mix(total)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    lists = batch.column(column)
    values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    offsets = lists.offsets.to_numpy().tolist()
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield values[a:b]


def _grams(batches):
    for batch in (b.slice(k, TEXTS) for b in batches for k in range(0, b.num_rows, TEXTS)):
        found = [np.unique(least_runs(words)) for words in _texts(batch, 0)]
        held = np.concatenate(found) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64))], ["gram"])


def _suffixes(bits: np.ndarray):
    def run(batches):
        for batch in (b.slice(k, TEXTS) for b in batches for k in range(0, b.num_rows, TEXTS)):
            parts: list[list] = [[], [], [], []]
            for doc, own, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch, 2), strict=True):
                slot = least_runs(words) % np.uint64(FILTER_BITS)
                held = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
                at = np.flatnonzero(held)
                if len(at):
                    made = (beginnings(words)[at].view(np.int64), np.full(len(at), doc), np.full(len(at), own), at.astype(np.int32))
                    for part, values in zip(parts, made, strict=True):
                        part.append(values)
            if parts[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], ORDER)

    return run


# Rows of a lot, packed: texts, places and other texts. Waiting rows are of one key, with the two smallest texts that the lot has of it.
LOT = "key long, texts array<struct<doc:long,own:long>>, n int, rows binary"
_TEXT = pa.struct([("doc", pa.int64()), ("own", pa.int64())])
LOT_SCHEMA = pa.schema([("key", pa.int64()), ("texts", pa.list_(_TEXT)), ("n", pa.int32()), ("rows", pa.binary())])


def _settled(key: np.ndarray, doc: np.ndarray, own: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Sorted rows by key, text and place, as packed rows."""
    n = len(key)
    change = np.concatenate([[True], key[1:] != key[:-1]])
    start = np.flatnonzero(change)
    group = np.cumsum(change) - 1
    # The first row of each group, and the first one whose text is not that one's.
    low = start[group]
    higher = np.flatnonzero((doc != doc[low]) | (own != own[low]))
    next_at = np.full(len(start), -1)
    next_at[group[higher][::-1]] = higher[::-1]
    found: list[tuple] = []

    def put(rows: np.ndarray, other: np.ndarray, of: int | None) -> None:
        """``other`` are places of rows of the other text."""
        m = len(rows)
        if m:
            raw = b"".join(x.astype("<i8").tobytes() for x in (doc[rows], own[rows], doc[other], own[other])) + at[rows].astype("<i4").tobytes()
            two = None if of is None else [{"doc": int(doc[k]), "own": int(own[k])} for k in (start[of], next_at[of]) if k >= 0]
            found.append((None if of is None else int(key[start[of]]), two, m, pa.compress(raw, "zstd", asbytes=True)))

    edge = {0, len(start) - 1}
    for g in edge:
        rows = np.arange(start[g], start[g + 1] if g + 1 < len(start) else n)
        put(rows, rows, g)
    rows = np.flatnonzero((next_at[group] >= 0) & (group > 0) & (group < len(start) - 1))
    first = (doc[rows] == doc[low[rows]]) & (own[rows] == own[low[rows]])
    put(rows, np.where(first, next_at[group[rows]], low[rows]), None)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), LOT_SCHEMA.types, strict=True)], schema=LOT_SCHEMA)


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def settle() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        return _settled(*(table.column(c).to_numpy() for c in ORDER))

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS:
            yield settle()
    if held:
        yield settle()


FOUND = "doc long, own long, start int, end int, other long, other_own long"


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each lot; those that waited meet the smallest of two texts that is not their own."""
    names = [f.split()[0] for f in FOUND.split(", ")]
    for batch in batches:
        for n, rows, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = pa.decompress(rows, 36 * n, "zstd", asbytes=True)
            doc, own, other, other_own = (np.frombuffer(raw, "<i8", n, 8 * n * k) for k in range(4))
            at = np.frombuffer(raw, "<i4", n, 32 * n)
            if two is not None:
                first = (doc == two[0]["doc"]) & (own == two[0]["own"])
                other, other_own = (np.where(first, two[1][c], two[0][c]) for c in ("doc", "own"))
            columns = (doc, own, at, at + np.int32(LEAST), other, other_own)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _own() -> F.Column:
    """What tells texts of one id apart."""
    return F.xxhash64(text_of())


def matches(docs: DataFrame) -> DataFrame:
    """(doc, own, start, end, other, other_own): each ``LEAST`` words in a row of a text that stand in another text too, and the smallest such text."""
    words = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), _own().alias("own"), word_hashes(text_of()).alias("words")
    )
    grams = words.select("words").mapInArrow(_grams, "gram long").groupBy("gram").count().filter("count > 1")
    slot = F.call_function("pmod", F.col("gram"), F.lit(FILTER_BITS))
    held = grams.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int"))).alias("bits")
    )
    # A filter of fixed size: FILTER_BITS / 64 words at most.
    table = held.toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.uint64)
    bits[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def suffixes(batches):
        yield from _suffixes(shared.value)(batches)

    # Written once, in columns that pack well: the sort by ranges looks at its rows before it deals them.
    rows = written(words.mapInArrow(suffixes, "key long, doc long, own long, at int"), "suffixes")
    lots = frozen(rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(_lots, LOT))
    waiting = lots.filter("key is not null")
    texts = waiting.select("key", F.explode("texts").alias("text"))
    two = texts.groupBy("key").agg(F.slice(F.array_sort(F.collect_set("text")), 1, 2).alias("two")).filter("size(two) = 2")
    settled = lots.filter("key is null").select("n", "rows", F.col("texts").alias("two"))
    return settled.unionByName(waiting.join(two, "key").select("n", "rows", "two")).mapInArrow(_unpacked, FOUND)


def _joined(found: DataFrame) -> DataFrame:
    """(doc, own, start, end, other): matches of a text that overlap or touch as one, and the smallest text that one of them was met in."""
    before = W.partitionBy("doc", "own").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("doc", "own").orderBy("start", "end").rowsBetween(W.unboundedPreceding, 0)
    fresh = F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))
    return found.withColumn("fresh", fresh.cast("int")).withColumn("nth", F.sum("fresh").over(upto)).groupBy("doc", "own", "nth").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("other").alias("other")
    )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word, n_words, other_id, text_key): passages of at least ``LEAST`` words that stand in another text too.

    Matches that overlap or touch are one passage; its end is exclusive, and ``other_id`` is the smallest id it was met in. Rows
    that agree in id and text have their passages once.
    """
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return _joined(matches(docs)).select(
        real("doc").alias("doc_id"), F.col("start").cast("long").alias("start_word"), F.col("end").cast("long").alias("end_word"),
        (F.col("end") - F.col("start")).cast("long").alias("n_words"), real("other").alias("other_id"), F.col("own").alias("text_key"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts without the words of passages that stand in a smaller text as well; words are joined by spaces.

    Only what was met in a smaller text goes, so that the smallest text keeps it. Texts without such passages stay as they are.
    """
    smaller = matches(docs).filter("other < doc OR (other = doc AND other_own < own)")
    gone = _joined(smaller).groupBy("doc", "own").agg(F.collect_list(F.struct("start", "end")).alias("gone"))
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), _own().alias("own"))
    cut = let(
        split_words(F.col("text")),
        lambda w: F.concat_ws(" ", F.filter(w, lambda _, i: ~F.exists("gone", lambda g: (i >= g["start"]) & (i < g["end"])))),
    )
    joined = rows.join(gone, ["doc", "own"], "left")
    return joined.select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(cut).alias("text"))


def passages_report(docs: DataFrame) -> DataFrame:
    """One row per passage that stands in another text too."""
    return repeated_passages(docs)

"""Words, keys and row packing shared by the operators of this package."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.session import shared_folder

# Separators: space and the control characters from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
# Separators where a word is a run of letters, digits and non-ASCII characters, after lower-casing A-Z.
NON_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before A-Z are lower-cased.
NON_ALNUM_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship(module: str) -> None:
    """Send the functions of a module to the executors by value, so that they need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


# What an operator keeps in a Python worker from task to task.
WORKER = "listloom_worker"


def let_go() -> None:
    """Drop what other operators keep in this Python worker, and freed memory; a worker may serve one after another."""
    import pyarrow

    sys.modules.pop(WORKER, None)
    pyarrow.default_memory_pool().release_unused()


def give_back() -> None:
    """Freed memory goes back to the system. Only some C libraries keep it, and have a way to give it back."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that begins in a tidy worker and leaves one: freed memory goes back to the system, as a worker stays
    on, idle, through stages that have no use for it."""

    def whole(batches: Iterator) -> Iterator:
        let_go()
        yield from run(batches)
        let_go()
        give_back()

    return whole


ship(__name__)


def lots(sizes: Iterable[int], rows: int, total: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of rows in order, of at most ``rows`` rows and at most ``total`` in size unless one row is larger."""
    start, end, held = 0, 0, 0
    for size in sizes:
        if end > start and (end - start >= rows or held + size > total):
            yield start, end
            start, held = end, 0
        held += size
        end += 1
    if end > start:
        yield start, end


def byte_sizes(column: Any) -> list[int]:
    """Bytes of each text or binary of an Arrow column; none for a null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet, and read from there.

    Sorted or repeated numbers take a fraction there of what they take in a checkpoint.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: Column, separators: str = SPACES) -> Column:
    """The words of a text in order; an empty array for an empty text."""
    return F.array_remove(F.split(text, separators, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once.

    Catalyst copies an expression into the lambdas that use it, where it would
    run for each element. A lambda's own variable is not copied.
    """
    return F.transform(F.array(value), body)[0]


def windows(words: Column, size: int, step: int = 1) -> Column:
    """Runs of ``size`` consecutive words, joined by spaces, from every ``step``-th word; empty if there are fewer words.

    Words are taken one by one: ``slice`` copies the whole array for each run.
    """
    return F.when(
        F.size(words) >= size,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - size, F.lit(step)),
            lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(size)]),
        ),
    ).otherwise(F.array().cast("array<string>"))


def with_key(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` reduced to ``doc_id``, ``text`` and ``text_key``.

    A row is known by its id and a hash of its text, so that rows that share
    an id but not a text stay apart.
    """
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        text_of(text).alias("text"),
        F.xxhash64(F.col(text)).alias("text_key"),
    )


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on id and text key; null ids meet null ids."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns in one struct ``row``, beside ``doc_id`` and ``text_key``; no name can clash."""
    fields = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(
        F.struct(*fields).alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_key"),
    )

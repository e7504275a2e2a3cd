"""Fill-in-middle transformation by piece tables.

A text is never moved: its bytes and those of the three sentinels are buffers that do not change. A document is a
list of descriptors (buffer, start, end). Cutting splits a descriptor in two, an arrangement puts the descriptors of
prefix, middle and suffix in another order between those of the sentinels, and the inverse arrangement puts them back. Hashes
are fed from the descriptors one after another, so that neither needs the new text in one piece. Bytes are joined once,
where the output itself is asked for.

Texts are cut between lines. The cuts and the form of a document follow from a hash of a seed and its id alone, so that
rows may be worked on anywhere, in any order and any number of times.

    psm     <P> prefix <S> suffix <M> middle
    spm     <S> suffix <P> prefix <M> middle
    plain   the text: it is empty, holds a sentinel, or is not among the share that is transformed

The output and its form are all that ``restored`` needs: in a text without sentinels the output holds each of them once.

Cases: null texts are empty. A null id counts as an empty one in the hash. Rows that repeat an id or a text are worked out
each by themselves, and equal rows give equal rows. Very long texts are held once, beside their output; lines are found by one
pass over their bytes. Other columns are not looked at, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.llm.text import byte_sizes, let_go, lots, ship, text_of

ship(__name__)

# The sentinels of prefix, suffix and middle, and the seed.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
SEED = "7"
# Percentage of texts that are transformed, and of those that put the suffix first.
RATE, SUFFIX_FIRST = 100, 50
# Texts whose outputs leave a task at once, in rows and in bytes.
TEXTS, BYTES = 500, 32 << 20

OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"
REPORT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


class Piece(NamedTuple):
    """Bytes ``start`` to ``end`` of a buffer."""

    buffer: int
    start: int
    end: int


class PieceTable:
    """Descriptors over buffers that never change."""

    def __init__(self, buffers: tuple[bytes, ...], pieces: list[Piece]):
        self.buffers, self.pieces = buffers, pieces

    @classmethod
    def of(cls, text: bytes) -> PieceTable:
        """The text as one piece; the sentinels are the buffers after it."""
        return cls((text, *SENTINELS), [Piece(0, 0, len(text))])

    def cut(self, at: int) -> None:
        """Split the first piece that byte ``at`` of the document lies in or ends; a cut at its end leaves an empty piece after it."""
        for k, p in enumerate(self.pieces):
            size = p.end - p.start
            if at <= size:
                self.pieces[k : k + 1] = [Piece(p.buffer, p.start, p.start + at), Piece(p.buffer, p.start + at, p.end)]
                return
            at -= size
        raise ValueError("cut beyond the end")

    def arranged(self, order: list[int | bytes]) -> PieceTable:
        """A table of the pieces of these numbers, and of sentinels, in this order."""
        sentinel = {s: Piece(1 + k, 0, len(s)) for k, s in enumerate(SENTINELS)}
        return PieceTable(self.buffers, [sentinel[x] if isinstance(x, bytes) else self.pieces[x] for x in order])

    def parts(self) -> Iterator[memoryview]:
        views = [memoryview(b) for b in self.buffers]
        return (views[p.buffer][p.start : p.end] for p in self.pieces)

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.parts():
            digest.update(part)
        return digest.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.parts())


# Prefix, middle and suffix are pieces 0, 1 and 2.
ORDERS: dict[str, list[int | bytes]] = {
    "psm": [PREFIX, 0, SUFFIX, 2, MIDDLE, 1],
    "spm": [SUFFIX, 2, PREFIX, 0, MIDDLE, 1],
    "plain": [0],
}


def numbers_of(doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 from the hash of seed and id."""
    digest = hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4)]


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends, its line break included, after a zero: the places where a text may be cut."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    rest = [len(text)] if text and not text.endswith(b"\n") else []
    return np.concatenate([[0], ends, rest]).astype(np.int64)


def n_chars(text: bytes | memoryview) -> int:
    """Code points: bytes that do not continue one."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def infilled(doc_id: int | None, text: bytes) -> tuple[int, str, PieceTable, int | None, int | None]:
    """Lines, form, the arranged pieces, and the code points of prefix and middle."""
    ends = line_ends(text)
    n = len(ends) - 1
    a, b, chance, side = numbers_of(doc_id)
    table = PieceTable.of(text)
    if not text or any(s in text for s in SENTINELS) or chance % 100 >= RATE:
        return n, "plain", table, None, None
    first, second = sorted((int(ends[a % (n + 1)]), int(ends[b % (n + 1)])))
    table.cut(first)
    table.cut(second)
    form = "spm" if side % 100 < SUFFIX_FIRST else "psm"
    return n, form, table.arranged(ORDERS[form]), n_chars(memoryview(text)[:first]), n_chars(memoryview(text)[first:second])


def restored(output: bytes, form: str) -> PieceTable:
    """The original text, as descriptors over an output."""
    order = ORDERS[form]
    if form == "plain":
        return PieceTable.of(output)
    # The output as arranged pieces again: what stands between its sentinels.
    pieces, at = [], 0
    for k, x in enumerate(order):
        if isinstance(x, bytes):
            pieces.append(Piece(0, at, at + len(x)))
        else:
            following = order[k + 1] if k + 1 < len(order) else None
            pieces.append(Piece(0, at, len(output) if following is None else output.index(following, at)))
        at = pieces[-1].end
    # The inverse: piece i goes back to place i, and sentinels go.
    inverse = sorted((x, k) for k, x in enumerate(order) if isinstance(x, int))
    return PieceTable((output, *SENTINELS), [pieces[k] for _, k in inverse])


def _infill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    names = [f.split()[0] for f in OUTPUT.split(", ")]
    for batch in batches:
        for a, b in lots(byte_sizes(batch.column(1)), TEXTS, BYTES):
            ids = batch.column(0).slice(a, b - a)
            texts = batch.column(1).slice(a, b - a).cast(pa.binary()).to_pylist()
            done = [infilled(i, t) for i, t in zip(ids.to_pylist(), texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string()),
                    pa.array([d[3] for d in done], pa.int64()), pa.array([d[4] for d in done], pa.int64()),
                    pa.array([d[2].joined() for d in done], pa.binary()).view(pa.string()),
                    pa.array([d[2].sha256() for d in done], pa.string()),
                ],
                names,
            )


def _restore(texts: bool):
    """Restored texts, or their hashes; the columns before the output pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("output")
            for a, b in lots(byte_sizes(batch.column(at)), TEXTS, BYTES):
                some = batch.slice(a, b - a)
                outputs = some.column(at).cast(pa.binary()).to_pylist()
                tables = [restored(o, f) for o, f in zip(outputs, some.column("form").to_pylist(), strict=True)]
                if texts:
                    made = pa.array([t.joined() for t in tables], pa.binary()).view(pa.string())
                    yield pa.RecordBatch.from_arrays([some.column("doc_id"), made], ["doc_id", "text"])
                else:
                    kept = [c for c in some.schema.names if c != "output"]
                    columns = [some.column(c) for c in kept] + [pa.array([t.sha256() for t in tables], pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, [*kept, "restored_sha256"])

    return run


def infill_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n (lines), form, prefix_chars, middle_chars, the output text and its hash."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(_infill, OUTPUT)


def restore_documents(outputs: DataFrame) -> DataFrame:
    """(doc_id, text) from rows with doc_id, form and output."""
    return outputs.select("doc_id", "form", "output").mapInArrow(_restore(True), "doc_id long, text string")


def infill_report(docs: DataFrame) -> DataFrame:
    """One row per document: its form, its cuts, and the hashes of the output and of the text restored from it."""
    return infill_documents(docs).mapInArrow(_restore(False), REPORT)

"""Bounded-space online packing of token ids into sequences.

Each partition reads its documents once, in order, with a fixed number of open windows. Of a document that is longer than a
window, whole windows go out at once. What is left of it is placed best-fit: into the open window that it leaves the least room
in. When none fits, and no further window may be opened, the fullest one goes out: if more than ``SLACK`` ids are missing in it, they are
cut from the front of the document at hand, and the rest of that is placed anew. So no window goes out with more than
``SLACK`` ids of padding, and documents are cut only where windows would stay open.

What is still open when a partition ends is merged: the open windows of ``MERGED`` partitions are taken apart and packed in the
same way by one task, longest first, and so on until one task has the last ones. Those follow each other without a gap; the last,
short one is cut at powers of two, where no padding is needed. A task of a merge holds ``MERGED * OPEN`` windows at most.

Pieces are kept in a table in the shared folder, with their ids: each round writes its own, and later rounds read what it wrote. So a
lost executor costs its tasks, and a task that runs again cannot change what others have read. Numbers of sequences are told apart by
round, partition and place.

Texts are encoded by the words between white space. The tokenizer drops white space, never makes a token over it and
treats signs one by one, so that a word has the same ids wherever it stands; each Python worker keeps those of the words it met
lately. Texts that may hold an added token are encoded whole, and so are all if the tokenizer is of another kind.

Cases: null and empty texts are the end id alone. Rows that repeat an id are documents by themselves, told apart by ``row``; so are rows without an
id. Very long texts are encoded in a lot of their own; their ids must fit in a worker. Other columns are not looked at. An empty
table gives no pieces. Equal lengths are placed in the order of rows.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate, chain
from types import ModuleType
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.llm.text import WORKER, byte_sizes, let_go, lots, ship, text_of
from listloom.session import shared_folder

ship(__name__)

# Ids of a sequence, and the id that ends a document.
WINDOW, END_ID = 2048, 1
# Windows that a task keeps open, ids that may be missing in a window that goes out, and partitions whose open windows meet.
OPEN, SLACK, MERGED = 128, 8, 8
# Texts that are encoded at once, in rows and in bytes.
TEXTS, BYTES = 3000, 16 << 20
# Bytes of ids that leave a task at once.
LEAVING = 8 << 20
# Words that a worker keeps, twice: when so many are in use, those not used since the last turn are dropped.
KEPT = 300_000
# Fixed value: how the standing tokenizer takes words apart, none of them with white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words of these letters alone are their own lower-case form, sign by sign, and go to the model's merges at once.
PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-įĴ-ňŊ-ſ]+")
TAILS = ".,;:!?"

PIECES = "sequence_id long, offset long, doc_id long, row long, start long, length long, doc_tokens long, ids binary, is_open boolean"


class WordEncoder:
    """Encodes texts to ids, word by word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        steps = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
        signs = [n["type"] for n in (told["normalizer"] or {}).get("normalizers", [])]
        self.by_word = (
            signs == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": WORDS}
            and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
            and not steps[1]["add_prefix_space"]
            and told["model"].get("end_of_word_suffix") == "</w>"
        )
        # The first signs of all added tokens.
        self.added = sorted({t["content"][:2] for t in told["added_tokens"]})
        rest = [b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or b >= 0xAE)]
        # The sign of each byte in the vocabulary: printable ones stand for themselves, the others follow from 256 on.
        self.signs = {b: 256 + i for i, b in enumerate(rest)}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        done = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(done), "<u4").tobytes()
        ends = [4 * n for n in accumulate(map(len, done), initial=0)]
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def _merged(self, word: str) -> bytes:
        """Ids of a run of plain letters."""
        low = word.lower()
        low = low if low.isascii() else low.encode().decode("latin-1").translate(self.signs)
        return np.array([t.id for t in self.tokenizer.model.tokenize(low)], "<u4").tobytes()

    def _found(self, word: str) -> bytes | None:
        if (ids := self.new.get(word)) is None and (ids := self.old.get(word)) is not None:
            self.new[word] = ids
        return ids

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        others = []
        for w in words:
            if self._found(w) is not None:
                continue
            if PLAIN.fullmatch(w):
                self.new[w] = self._merged(w)
                continue
            # No token spans a letter and the punctuation after it.
            core = w.rstrip(TAILS)
            tail = w[len(core) :]
            if tail and PLAIN.fullmatch(core):
                if tail not in self.tails:
                    self.tails[tail] = self._encode([tail])[0]
                ids = self._found(core)
                if ids is None:
                    ids = self.new[core] = self._merged(core)
                self.new[w] = ids + self.tails[tail]
                continue
            others.append(w)
        for at in range(0, len(others), 20_000):
            some = others[at : at + 20_000]
            self.new.update(zip(some, self._encode(some), strict=True))
        found = [self.new[w] for w in words]
        if len(self.new) > KEPT:
            self.old, self.new = self.new, {}
            self.tails = {}
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin and the last one's end."""
        whole = pa.array(np.full(len(texts), not self.by_word))
        for a in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, a, ignore_case=True))
        whole = whole.to_numpy(zero_copy_only=False)
        # A text that is encoded whole counts as one word.
        plain = pc.if_else(pa.array(whole), "", texts)
        cut = pc.ascii_split_whitespace(plain)
        if pa.types.is_large_list(cut.type):
            cut = cut.cast(pa.list_(pa.string()))
        coded = cut.flatten().dictionary_encode()
        made = self._words(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy().astype(np.int64)
        bounds = cut.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        odd = np.flatnonzero(whole)
        if len(odd):
            # Its only word is the empty one.
            at[bounds[odd]] = len(made) + np.arange(len(odd))
            made = made + self._encode(texts.take(pa.array(odd)).to_pylist())
        flat = np.frombuffer(b"".join(made), "<u4")
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        starts = np.cumsum(sizes) - sizes
        n = sizes[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(starts[at] - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[bounds]


def encoder_of(path: str) -> WordEncoder:
    """The encoder of this Python worker; tasks that run in it one after another share what it has learned."""
    kept = sys.modules.setdefault(WORKER, ModuleType(WORKER))
    if getattr(kept, "word_path", None) != path:
        let_go()
        kept = sys.modules.setdefault(WORKER, ModuleType(WORKER))
        kept.word_path, kept.word_encoder = path, WordEncoder(path)
    return kept.word_encoder


class Part(NamedTuple):
    """A run of ids of one document: ``doc_tokens`` ids in all, of which these begin at ``start``."""

    doc_id: int | None
    row: int
    start: int
    doc_tokens: int
    ids: bytes

    @property
    def size(self) -> int:
        return len(self.ids) // 4

    def split(self, at: int) -> tuple[Part, Part]:
        return self._replace(ids=self.ids[: 4 * at]), self._replace(start=self.start + at, ids=self.ids[4 * at :])


class Packer:
    """Open windows, at most ``most``; those that go out are given as lists of parts."""

    def __init__(self, window: int, most: int, slack: int):
        self.window, self.most, self.slack = window, most, slack
        # (room, number) in ascending order, and the parts of each.
        self.rooms: list[tuple[int, int]] = []
        self.held: dict[int, list[Part]] = {}
        self.opened = 0

    def add(self, part: Part) -> Iterator[list[Part]]:
        """Place a part; gives the windows that go out for it."""
        while part.size >= self.window:
            head, part = part.split(self.window)
            yield [head]
        while part.size:
            at = bisect_left(self.rooms, (part.size, -1))
            if at < len(self.rooms):
                room, number = self.rooms.pop(at)
                self.held[number].append(part)
                if room > part.size:
                    insort(self.rooms, (room - part.size, number))
                else:
                    yield self.held.pop(number)
                return
            if len(self.rooms) < self.most:
                insort(self.rooms, (self.window - part.size, self.opened))
                self.held[self.opened] = [part]
                self.opened += 1
                return
            room, number = self.rooms.pop(0)
            if room > self.slack:
                head, part = part.split(room)
                self.held[number].append(head)
            yield self.held.pop(number)

    def rest(self) -> list[list[Part]]:
        """The windows that are still open, in the order they were opened."""
        return [self.held[n] for n in sorted(self.held)]


def last_windows(parts: list[Part], window: int) -> Iterator[list[Part]]:
    """The last parts one after another: whole windows, then one for each power of two that the rest is made of."""
    left = sum(p.size for p in parts)
    todo = iter(parts)
    part = next(todo, None)
    while left:
        size = window if left >= window else 1 << (left.bit_length() - 1)
        left -= size
        out = []
        while size:
            head, rest = (part, None) if part.size <= size else part.split(size)
            out.append(head)
            size -= head.size
            part = next(todo, None) if rest is None else rest
        yield out


def _numbered(first: int, windows: Iterator[tuple[bool, list[Part]]]) -> Iterator[pa.RecordBatch]:
    """Rows of the table of pieces; windows are numbered from ``first`` on."""
    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.binary(), pa.bool_()]
    rows: list[tuple] = []
    held = 0

    def batch() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for number, (is_open, parts) in enumerate(windows, first):
        at = 0
        for p in parts:
            rows.append((number, at, p.doc_id, p.row, p.start, p.size, p.doc_tokens, p.ids, is_open))
            at += p.size
        held += 4 * at
        if held >= LEAVING:
            yield batch()
            rows, held = [], 0
    yield batch()


def _first(turn: int) -> int:
    """Numbers of a round and a partition: 2**32 for each of 2**26 partitions of each round."""
    return (turn << 58) + (TaskContext.get().partitionId() << 32)


def _pack_texts(path: str, window: int, most: int, slack: int, end_id: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[Part]]]:
        encoder, packer, row = encoder_of(path), Packer(window, most, slack), _first(0)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for a, b in lots(byte_sizes(batch.column(1)), TEXTS, BYTES):
                ids, bounds = encoder.encode(batch.column(1).slice(a, b - a))
                for k, doc_id in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                    own = ids[bounds[k] : bounds[k + 1]].tobytes() + end
                    for done in packer.add(Part(doc_id, row, 0, len(own) // 4, own)):
                        yield False, done
                    row += 1
        for parts in packer.rest():
            yield True, parts

    return lambda batches: _numbered(_first(0), windows(batches))


def _pack_again(turn: int, last: bool, window: int, most: int, slack: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[Part]]]:
        packer = Packer(window, most, slack)
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                for done in packer.add(Part(*row)):
                    yield False, done
        rest = packer.rest()
        if last:
            yield from ((False, parts) for parts in last_windows(list(chain.from_iterable(rest)), window))
        else:
            yield from ((True, parts) for parts in rest)

    return lambda batches: _numbered(_first(turn), windows(batches))


def write_pieces(
    docs: DataFrame, folder: str, path: str, end_id: int = END_ID, window: int = WINDOW, most: int = OPEN, slack: int = SLACK,
    merged: int = MERGED,
) -> None:
    """Pack all documents and write the pieces to ``folder``, one table a round."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows.mapInArrow(_pack_texts(path, window, most, slack, end_id), PIECES).write.parquet(f"{folder}/round=0")
    part = F.shiftright("sequence_id", 32).bitwiseAND((1 << 26) - 1)
    turn = 0
    while True:
        rest = spark.read.schema(PIECES).parquet(f"{folder}/round={turn}").filter("is_open")
        top = rest.agg(F.max(part)).first()[0]
        if top is None:
            return
        # Neighbouring partitions go together: each task gets the open windows of ``merged`` of them at most.
        turn, tasks = turn + 1, top // merged + 1
        dealt = rest.repartitionById(tasks, F.floor(part / merged).cast("int"))
        ordered = dealt.sortWithinPartitions(F.col("length").desc(), "row", "start").select("doc_id", "row", "start", "doc_tokens", "ids")
        ordered.mapInArrow(_pack_again(turn, tasks == 1, window, most, slack), PIECES).write.parquet(f"{folder}/round={turn}")


def read_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of all rounds: sequence_id, offset, doc_id, row, start, length, doc_tokens, ids (u32, little-endian)."""
    pieces = spark.read.schema(f"{PIECES}, round int").parquet(folder)
    # What a round left open was packed by the next one.
    return pieces.filter("NOT is_open").drop("is_open", "round")


def pack_documents(docs: DataFrame, path: str, folder: str | None = None, **limits: int) -> DataFrame:
    """The pieces of all documents, packed into sequences; ``limits`` as in ``write_pieces``."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/packed-{uuid.uuid4().hex}"
    write_pieces(docs, folder, path, **limits)
    return read_pieces(spark, folder)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_ids, ids): the ids of each sequence, padded to the window unless their number is a power of two.

    A sequence has at most ``window`` pieces.
    """
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: F.hex(p["ids"]))
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), F.array_join(parts, "").alias("_hex"))
    missing = F.when(F.bit_count("n_ids") == 1, 0).otherwise(window - F.col("n_ids")).cast("int")
    pad = F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), missing)
    return rows.select("sequence_id", "n_ids", F.unhex(F.concat("_hex", pad)).alias("ids"))


def packing_report(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """One row per piece, with the hash of its ids as they stand in the table."""
    return pack_documents(docs, path, folder).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "row"
    )

"""Token ids in binary files: blocks of ids, transposed into byte planes and compressed plane by plane.

A file holds the ids of whole documents in a row. Its layout, all numbers
little-endian:

    magic "LLTK" | version u32 | n_ids u64 | n_docs u64 | n_chunks u32 | block u32
    chunk index: per chunk n_ids u32 and four plane lengths u32
    doc_ids i64 x n_docs | doc flags u8 x n_docs (1: the id is null) | doc lengths u64 x n_docs
    the planes of each chunk, one after another

A chunk is ``BLOCK`` ids (the last one fewer). Its plane j holds byte j of each id: the high
bytes of ids are almost constant and shrink to nothing, and the low ones are compressed apart from
them. Any chunk can be read alone by its entry in the index.

Documents are range partitioned by id, or by what another order asks for; a task writes the files of its range. The files are kept
as rows (part, seq, n_ids, content) of a table that Spark writes, so a lost or repeated task
leaves no half or double file, and any store that Spark reaches will do. The whole
``content`` of a file is decoded by itself.

Texts are encoded piece by piece: a byte-level tokenizer never makes a token over a single
space or line break between two other characters, so that what stands between them can be encoded
once and kept, by each Python worker, for the texts to come. Texts where this does not hold, for a run of white space or
an added token, are encoded whole.

Cases: null and empty texts are the end id alone. A null doc_id sorts first. Documents with
equal ids follow each other in the order of their texts. An empty table writes no files.
"""

from __future__ import annotations

import os
import struct
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, pairwise
from operator import attrgetter
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.llm.text import WORKER, byte_sizes, give_back, let_go, lots, ship, text_of
from listloom.session import shared_folder

ship(__name__)

BLOCK = 1 << 16
FILE_IDS = 1 << 20
MAGIC, VERSION = b"LLTK", 1
_HEAD = "<4sIQQII"
# Pieces that a worker keeps, twice: when so many are in use, those not used since the last turn are dropped.
KEPT = 300_000
# Texts that are encoded at once, and their bytes unless one is larger: what stands beside the pieces is many times their size.
TEXTS, TEXT_BYTES = 3000, 1 << 22
# Texts and characters that the tokenizer gets at once: its result takes some hundred bytes a token.
LOT = 2000, 1 << 18

FILES = "part int, seq int, n_ids long, content binary"
DOCS = "doc_id long, part int, seq int, begin long, n_tokens long, ids_crc32 long"


# Texts whose white space is more than single spaces and line breaks between other characters.
ODD = (
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
    r"|[ \n][ \n]|^[ \n]|[ \n]$"
)

# Letters below this are letters to every version of Unicode.
LATIN = "\u0250"

# Punctuation that is split off the end of a piece.
ENDS = ".,;:!?"


def _byte_signs() -> dict[int, int]:
    """The sign of each byte in a byte-level vocabulary: printable ones stand for themselves, the rest follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(rest)}


BYTES = _byte_signs()
TOKEN_ID = attrgetter("id")


class Encoder:
    """Encodes texts to the bytes of their ids (u32, little-endian)."""

    def __init__(self, path: str):
        # The tasks take up the cores; threads beside them would each hold memory of their own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Byte-level and without a normalizer or an added space: only then do pieces stand alone.
        kind = str(self.tokenizer.pre_tokenizer)
        self.by_piece = (
            self.tokenizer.normalizer is None
            and kind.startswith("ByteLevel")
            and "add_prefix_space=False" in kind
            and "use_regex=True" in kind
        )
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line = self._encode(["\n"])[0]
        # Pieces in use, and those of before the last turn.
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.packs: dict[int, Callable[..., bytes]] = {}
        self.kept = KEPT

    def _encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for begin, upto in lots(map(len, texts), *LOT):
            done = [e.ids for e in self.tokenizer.encode_batch_fast(texts[begin:upto], add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(done), "<u4").tobytes()
            out += [flat[a:b] for a, b in pairwise(4 * n for n in accumulate(map(len, done), initial=0))]
        return out

    def _words(self, words: list[str], before: str) -> list[bytes]:
        """Ids of runs of letters, each with a space or nothing before it: the model's merges alone."""
        tokenize, packs, sign, out = self.tokenizer.model.tokenize, self.packs, before.translate(BYTES), []
        for word in words:
            mapped = sign + (word if word.isascii() else word.encode().decode("latin-1").translate(BYTES))
            made = tokenize(mapped)
            n = len(made)
            if n not in packs:
                packs[n] = struct.Struct(f"<{n}I").pack
            out.append(packs[n](*map(TOKEN_ID, made)))
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not kept; one that begins with a line break has no space before it."""
        new = self.new
        words = [p for p in pieces if p.isalpha() and max(p) < LATIN]
        new.update(zip(words, self._words(words, " "), strict=True))
        first = [p for p in pieces if p[:1] == "\n" and p[1:].isalpha() and max(p) < LATIN]
        new.update(zip(first, [self.line + ids for ids in self._words([p[1:] for p in first], "")], strict=True))
        others = [p for p in pieces if p not in new]
        for at in range(0, len(others), 20_000):
            some = others[at : at + 20_000]
            made = self._encode([p[1:] if p[:1] == "\n" else " " + p for p in some])
            new.update(zip(some, [self.line + ids if p[:1] == "\n" else ids for p, ids in zip(some, made, strict=True)], strict=True))

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        new, old, tails = self.new, self.old, self.tails
        found: list[bytes | None] = list(map(new.get, pieces))
        # What is not kept: as it is, what ends with punctuation, and what is to be encoded.
        whole: list[int] = []
        ended: list[tuple[int, str]] = []
        learn: set[str] = set()
        for i, ids in enumerate(found):
            if ids is not None:
                continue
            p = pieces[i]
            ids = old.get(p)
            if ids is not None:
                new[p] = found[i] = ids
                continue
            # No token spans a letter and the punctuation after it.
            core = p.rstrip(ENDS) if p[-1:] in ENDS else p
            if core is p or len(core) < 2 or not core[-1].isalnum():
                whole.append(i)
                learn.add(p)
                continue
            ended.append((i, core))
            if core not in new:
                if core in old:
                    new[core] = old[core]
                else:
                    learn.add(core)
        self._learn(list(learn))
        for i in whole:
            found[i] = new[pieces[i]]
        for i, core in ended:
            p = pieces[i]
            tail = p[len(core) :]
            if tail not in tails:
                tails[tail] = self._encode([tail])[0]
            new[p] = found[i] = new[core] + tails[tail]
        if len(new) > self.kept:
            self.old, self.new = new, {}
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        odd = pc.match_substring_regex(texts, ODD)
        for a in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, a))
        odd = odd.to_numpy(zero_copy_only=False) if self.by_piece else np.ones(len(texts), bool)
        out: list[bytes] = [b""] * len(texts)
        whole = np.flatnonzero(odd).tolist()
        if whole:
            for i, ids in zip(whole, self._encode(texts.take(pa.array(whole)).to_pylist()), strict=True):
                out[i] = ids
        split = np.flatnonzero(~odd)
        if len(split):
            # Every line begins with its break, the first one too, and is cut at spaces.
            marked = pc.replace_substring(texts.take(pa.array(split)), "\n", " \n")
            cut = pc.split_pattern(pc.binary_join_element_wise("\n", marked, ""), " ")
            if pa.types.is_large_list(cut.type):
                cut = cut.cast(pa.list_(pa.string()))
            coded = cut.flatten().dictionary_encode()
            made = self._pieces(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            flat = np.frombuffer(b"".join(made), "<u4")
            sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
            starts = np.cumsum(sizes) - sizes
            at = coded.indices.to_numpy()
            n = sizes[at]
            ends = np.cumsum(n)
            ids = flat[np.repeat(starts[at] - (ends - n), n) + np.arange(ends[-1])]
            bounds = np.concatenate([[0], ends])[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
            for i, a, b in zip(split.tolist(), bounds[:-1], bounds[1:], strict=True):
                out[i] = ids[a + len(self.line) // 4 : b].tobytes()  # without the first break
        return out


def encoder_of(path: str) -> Encoder:
    """The encoder of this Python worker; tasks that run in it one after another share what it has learned."""
    kept = sys.modules.get(WORKER)
    if getattr(kept, "path", None) != path:
        let_go()
        kept = sys.modules.setdefault(WORKER, ModuleType(WORKER))
        kept.path, kept.encoder = path, Encoder(path)
    return kept.encoder


def pack(doc_ids: list[int | None], docs: list[bytes]) -> bytes:
    """One file of whole documents."""
    ids = np.frombuffer(b"".join(docs), dtype="<u4")
    compress = zstandard.ZstdCompressor(level=3).compress
    index, planes = [], []
    for at in range(0, len(ids), BLOCK):
        block = ids[at : at + BLOCK]
        rows = np.ascontiguousarray(block.view(np.uint8).reshape(-1, 4).T)
        packed = [compress(row.tobytes()) for row in rows]
        index.append(struct.pack("<5I", len(block), *map(len, packed)))
        planes += packed
    head = struct.pack(_HEAD, MAGIC, VERSION, len(ids), len(docs), len(index), BLOCK)
    numbers = np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes()
    flags = np.array([d is None for d in doc_ids], dtype="u1").tobytes()
    lengths = np.array([len(d) // 4 for d in docs], dtype="<u8").tobytes()
    return b"".join([head, *index, numbers, flags, lengths, *planes])


def _places(content: bytes) -> tuple[np.ndarray, int, int]:
    """The chunk index, where the document table begins, and where the planes begin."""
    magic, version, _, n_docs, n_chunks, _ = struct.unpack_from(_HEAD, content)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a file of token ids")
    at = struct.calcsize(_HEAD)
    index = np.frombuffer(content, "<u4", n_chunks * 5, at).reshape(-1, 5)
    return index, at + n_chunks * 20, at + n_chunks * 20 + 17 * n_docs


def ids_between(content: bytes, begin: int, end: int) -> np.ndarray:
    """Ids ``begin`` to ``end`` of a file, from the chunks that hold them; no other chunk is decompressed."""
    index, _, place = _places(content)
    upto = np.cumsum(index[:, 0], dtype=np.int64)
    starts = upto - index[:, 0]
    planes = place + np.concatenate([[0], np.cumsum(index[:, 1:].sum(axis=1, dtype=np.int64))])
    found, decompress = [np.zeros(0, "<u4")], zstandard.ZstdDecompressor().decompress
    for k in np.flatnonzero((upto > begin) & (starts < end)).tolist():
        block, at = np.empty((int(index[k, 0]), 4), np.uint8), int(planes[k])
        for j, size in enumerate(index[k, 1:].tolist()):
            block[:, j] = np.frombuffer(decompress(content[at : at + size]), np.uint8)
            at += size
        ids = block.reshape(-1).view("<u4")
        found.append(ids[max(begin - int(starts[k]), 0) : end - int(starts[k])])
    return np.concatenate(found)


def unpack(content: bytes) -> tuple[list[int | None], np.ndarray, Iterator[np.ndarray]]:
    """Document ids, lengths, and the ids of each chunk in turn."""
    magic, version, n_ids, n_docs, n_chunks, _ = struct.unpack_from(_HEAD, content)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a file of token ids")
    at = struct.calcsize(_HEAD)
    index = np.frombuffer(content, "<u4", n_chunks * 5, at).reshape(-1, 5)
    at += n_chunks * 20
    numbers = np.frombuffer(content, "<i8", n_docs, at)
    flags = np.frombuffer(content, "u1", n_docs, at + 8 * n_docs)
    lengths = np.frombuffer(content, "<u8", n_docs, at + 9 * n_docs)
    at += 17 * n_docs
    doc_ids = [None if f else int(d) for d, f in zip(numbers, flags, strict=True)]

    def chunks() -> Iterator[np.ndarray]:
        place, decompress = at, zstandard.ZstdDecompressor().decompress
        for n, *sizes in index.tolist():
            block = np.empty((n, 4), np.uint8)
            for j, size in enumerate(sizes):
                block[:, j] = np.frombuffer(decompress(content[place : place + size]), np.uint8)
                place += size
            yield block.reshape(-1).view("<u4")

    return doc_ids, lengths, chunks()


def _write_part(path: str, end_id: int, kept: int = KEPT, at_once: int = TEXT_BYTES):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(path), struct.pack("<I", end_id)
        encoder.kept = kept
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        docs: list[bytes] = []
        size = 0

        def file() -> pa.RecordBatch:
            content = pack(ids, docs)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), pa.array([content], pa.binary())],
                ["part", "seq", "n_ids", "content"],
            )

        for batch in batches:
            for begin, upto in lots(byte_sizes(batch.column(1)), TEXTS, at_once):
                some = batch.slice(begin, upto - begin)
                texts = encoder.encode(some.column(1))
                for doc_id, done in zip(some.column(0).to_pylist(), texts, strict=True):
                    ids.append(doc_id)
                    docs.append(done + end)
                    size += len(done) // 4 + 1
                    if size >= FILE_IDS:
                        yield file()
                        ids, docs, size, seq = [], [], 0, seq + 1
                del texts, some
                give_back()
        if docs:
            yield file()
        ids, docs = [], []
        give_back()

    return run


def write_files(
    docs: DataFrame, folder: str, path: str, end_id: int = 0, order: list[str] | None = None, kept: int = KEPT,
    at_once: int = TEXT_BYTES,
) -> None:
    """Encode all texts in ascending doc_id order, or in that of the columns ``order``, and write the files to ``folder``.

    ``kept`` pieces stay in a worker, twice, and texts of ``at_once`` bytes are encoded together: fewer take less memory and more time.
    """
    ranked = [F.col(c).alias(f"order_{k}") for k, c in enumerate(order or [])]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), *ranked)
    ranks = [f"order_{k}" for k in range(len(ranked))]
    ordered = rows.repartitionByRange(*(ranks or ["doc_id"])).sortWithinPartitions(*ranks, "doc_id", "text")
    ordered.select("doc_id", "text").mapInArrow(_write_part(path, end_id, kept, at_once), FILES).write.mode("overwrite").parquet(folder)


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DOCS.split(", ")]
    for batch in batches:
        for part, seq, content in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            doc_ids, lengths, chunks = unpack(content)
            crcs, left, crc = [], 0, 0
            wanted = iter(lengths.tolist())
            for chunk in chunks:
                at = 0
                while at < len(chunk):
                    if not left:
                        left, crc = next(wanted), 0
                    piece = chunk[at : at + left]
                    crc = zlib.crc32(piece.tobytes(), crc)
                    at, left = at + len(piece), left - len(piece)
                    if not left:
                        crcs.append(crc)
            ends = np.cumsum(lengths.astype(np.int64))
            n = len(doc_ids)
            columns = [
                pa.array(doc_ids, pa.int64()), pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()),
                pa.array(ends - lengths.astype(np.int64)), pa.array(lengths.astype(np.int64)), pa.array(crcs, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = spark.read.schema(FILES).parquet(folder)
    # One row per file, then one per part.
    sizes = files.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.join(parts, "part").select(
        "part", "seq", (F.col("before") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("offset")
    )
    rows = files.select("part", "seq", "content").mapInArrow(_read_files, DOCS)
    return rows.join(offsets, ["part", "seq"]).select(
        "doc_id", (F.col("offset") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_report(
    docs: DataFrame, path: str, end_id: int = 0, folder: str | None = None, order: list[str] | None = None, kept: int = KEPT,
    at_once: int = TEXT_BYTES,
) -> DataFrame:
    """Write the files, read them back, and give one row per document from them; the last three as in ``write_files``."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_files(docs, folder, path, end_id, order, kept, at_once)
    return read_files(spark, folder)

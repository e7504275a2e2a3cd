"""Packing against the tokenizer itself and the rules of windows."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from listloom.llm import packing
from listloom.llm.queries import vocabulary
from tests.llm.conftest import prose

PATH = vocabulary("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, docs, window, padded):
    """Each id lies in one piece, pieces in a sequence follow each other, and little is padded."""
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) // 4 > 0
        by_row[p["row"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    found = Counter()
    for parts in by_row.values():
        parts.sort(key=lambda p: p["start"])
        at = 0
        for p in parts:
            assert p["start"] == at and p["doc_tokens"] == parts[0]["doc_tokens"] and p["doc_id"] == parts[0]["doc_id"]
            at += p["length"]
        assert at == parts[0]["doc_tokens"]
        found[parts[0]["doc_id"], b"".join(bytes(p["ids"]) for p in parts)] += 1
    assert found == Counter((d, np.array(ids_of(t), "<u4").tobytes()) for d, t in docs)
    waste = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p["offset"])
        at = 0
        for p in parts:
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        waste += window - at if at & (at - 1) else 0
    assert waste <= padded * len(by_sequence)


@pytest.mark.parametrize("partitions", [1, 5, 40])
@pytest.mark.parametrize("limits", [{}, {"window": 64, "most": 3, "slack": 2, "merged": 2}])
def test_every_id_lies_in_one_piece(spark, odd_docs, partitions, limits):
    docs = odd_docs.repartition(partitions, "doc_id")
    pieces = packing.pack_documents(docs, PATH, **limits).collect()
    given = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check(pieces, given, limits.get("window", 2048), limits.get("slack", packing.SLACK))
    again = packing.pack_documents(docs, PATH, **limits).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, pieces))


def test_report_and_empty_table(spark, odd_docs, no_docs):
    assert packing.packing_report(no_docs, PATH).count() == 0
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "row"]
    got = Counter((*(r[n] for n in names), r["ids_crc32"]) for r in packing.packing_report(odd_docs, PATH).collect())
    assert got == Counter((*(r[n] for n in names), zlib.crc32(r["ids"])) for r in packing.pack_documents(odd_docs, PATH).collect())


def test_sequences_are_padded_but_at_powers_of_two(spark, odd_docs):
    pieces = packing.pack_documents(odd_docs, PATH, window=64, most=2, slack=5)
    held = defaultdict(list)
    for p in sorted(pieces.collect(), key=lambda p: p["offset"]):
        held[p["sequence_id"]] += np.frombuffer(p["ids"], "<u4").tolist()
    for r in packing.sequences(pieces, window=64, pad_id=7).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        n = r["n_ids"]
        assert ids[:n] == held.pop(r["sequence_id"]) and len(ids) == (n if n & (n - 1) == 0 else 64) and set(ids[n:]) <= {7}
    assert not held


def test_windows_stay_bounded_and_documents_mostly_whole():
    rng = random.Random(3)
    packer, cut, out = packing.Packer(2048, 64, 8), 0, 0
    for row in range(3000):
        n = rng.choice([rng.randint(1, 300), rng.randint(300, 2047)])
        for parts in packer.add(packing.Part(row, row, 0, n, bytes(4 * n))):
            out += 1
            assert 2048 - 8 <= sum(p.size for p in parts) <= 2048
            cut += any(p.size < p.doc_tokens for p in parts)
        assert len(packer.rooms) == len(packer.held) <= 64
        assert all(2048 - room == sum(p.size for p in packer.held[n]) for room, n in packer.rooms)
    assert out > 500 and cut < out


def test_best_fit_takes_the_window_with_least_room():
    packer = packing.Packer(100, 3, 0)
    part = lambda n: packing.Part(n, n, 0, n, bytes(4 * n))
    for n in (50, 70, 60):
        assert not list(packer.add(part(n)))
    assert not list(packer.add(part(29)))
    assert [[p.size for p in w] for w in packer.rest()] == [[50], [70, 29], [60]]
    # None has room for 80 and no more may be opened: the fullest takes one id of it, the rest needs the next fullest.
    assert [[p.size for p in w] for w in packer.add(part(80))] == [[70, 29, 1]]


def test_last_windows_are_powers_of_two():
    parts = [packing.Part(i, i, 0, n, bytes(4 * n)) for i, n in enumerate((300, 2000, 5, 700))]
    sizes = [sum(p.size for p in w) for w in packing.last_windows(parts, 2048)]
    assert sizes == [2048, 512, 256, 128, 32, 16, 8, 4, 1] and sum(sizes) == 3005
    assert not list(packing.last_windows([], 2048))


SIGNS = st.sampled_from(
    list("abzAZ'.,;:!?-_()019 \n\t\x0b\x0c\r\x1c\x85\xa0 ​́̌jJIİıßẞΣςé") + ["'s", "'LL", "<|", "<|endoftext|>", "<|STARTOFTEXT|>", "é", "가", "각", "한", "\U0001f600", "ñ", "word", "Word.", "?!"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(SIGNS, max_size=12).map("".join))
def test_words_encode_like_whole_texts(text):
    encoder = packing.WordEncoder.kept if hasattr(packing.WordEncoder, "kept") else packing.WordEncoder(PATH)
    packing.WordEncoder.kept = encoder
    assert encoder.by_word
    ids, bounds = encoder.encode(pa.array(["x y", text, "", text + " end"]))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert got == [ids_of(t)[:-1] for t in ("x y", text, "", text + " end")]


def test_cutting_the_kept_words_changes_nothing(monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, 200) + "." for _ in range(20)]
    monkeypatch.setattr(packing, "KEPT", 50)
    encoder = packing.WordEncoder(PATH)
    for _ in range(2):
        for k in range(0, 20, 5):
            ids, bounds = encoder.encode(pa.array(texts[k : k + 5]))
            assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [ids_of(t)[:-1] for t in texts[k : k + 5]]

"""Fill-in-middle against plain string code."""

import hashlib
import re
from collections import Counter

import pytest

from listloom.llm import infill
from listloom.llm.text import lots


def plain(doc_id, text):
    """The row of a document, worked out on strings."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    if h4 % 100 < 50:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    """Sentinels inside, parts of them, line breaks at both ends, other breaks, many lines, one long line, signs of four bytes."""
    made = [
        "a<P>b", "<M>", "x\n<S>\ny", "<P\n>", "P>\n<S", "<\n<", "\n", "\n\n\n", "no break", "one\n", "\none", "a\r\nb\rc d\x0be\n",
        "zwölf\n\U0001f600\U0001f600\nß\n" * 40, "w" * 200_000, "line\n" * 50_000, "<M\n><S\n><P\n>",
    ]
    rows = [(100 * k + i, t) for k in range(8) for i, t in enumerate(made)] + [(None, "t\nu\nv"), (-3, "t\nu\nv"), (7, "x\ny"), (7, "x\ny"), (7, "z\n")]
    return spark.createDataFrame([(d, t, "o", 1, "f") for d, t in rows], "doc_id long, text string, output string, n int, form string")


def test_forms_cuts_and_hashes(texts, odd_docs, no_docs):
    for docs in (texts, odd_docs):
        given = [(r["doc_id"], r["text"]) for r in docs.collect()]
        want = Counter((d, n, f, p, m, sha(o), sha(t or "")) for d, t in given for n, f, p, m, o in [plain(d, t)])
        assert Counter(map(tuple, infill.infill_report(docs).collect())) == want
        outputs = infill.infill_documents(docs)
        assert Counter((r["doc_id"], r["output"]) for r in outputs.collect()) == Counter((d, plain(d, t)[4]) for d, t in given)
        assert Counter(map(tuple, infill.restore_documents(outputs).collect())) == Counter((d, t or "") for d, t in given)
    assert {r["form"] for r in infill.infill_documents(texts).select("form").distinct().collect()} == {"plain", "psm", "spm"}
    assert infill.infill_report(no_docs).count() == 0


def test_piece_tables_cut_and_arrange():
    table = infill.PieceTable.of(b"abcdef")
    for at in (2, 2, 6, 0):
        table.cut(at)
    assert table.joined() == b"abcdef" and [p.end - p.start for p in table.pieces] == [0, 2, 0, 4, 0]
    moved = table.arranged([3, b"<M>", 1])
    assert moved.joined() == b"cdef<M>ab" and moved.sha256() == hashlib.sha256(b"cdef<M>ab").hexdigest()
    assert moved.buffers is table.buffers
    with pytest.raises(ValueError):
        table.cut(7)


@pytest.mark.parametrize("form", ["psm", "spm", "plain"])
@pytest.mark.parametrize("text", [b"", b"\n", b"one", b"a\nb\nc\n", "ä\nß".encode()])
def test_every_cut_is_restored(form, text):
    ends = infill.line_ends(text).tolist()
    for i, a in enumerate(ends):
        for b in ends[i:]:
            table = infill.PieceTable.of(text)
            table.cut(a)
            table.cut(b)
            output = (table.arranged(infill.ORDERS[form]) if form != "plain" else infill.PieceTable.of(text)).joined()
            assert infill.restored(output, form).joined() == text


def test_lots_are_bounded_and_whole():
    sizes = [infill.BYTES] * 3 + [1] * 1200 + [infill.BYTES * 3]
    found = list(lots(sizes, infill.TEXTS, infill.BYTES))
    assert [i for a, b in found for i in range(a, b)] == list(range(len(sizes)))
    assert all(b - a <= infill.TEXTS and (b - a == 1 or sum(sizes[a:b]) <= infill.BYTES) for a, b in found)

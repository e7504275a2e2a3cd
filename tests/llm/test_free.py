"""The operators with Arrow code, against plain Python."""

import html as html_lib
import random
import re
import sys
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from listloom.llm import components, jaccard, licenses, lists, pages, suffixes, tokens, toxicity
from listloom.llm.queries import vocabulary
from tests.llm.conftest import ALNUM, LOWER, SPACED, prose


# sorted lists and components


@pytest.mark.parametrize("partitions", [1, 7])
def test_stars_tie_each_list_across_partitions(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.randint(0, 5), 0, rng.randint(0, 40)) for _ in range(300)] + [(99, 0, m) for m in range(200)] + [(50, 0, 1), (50, 0, 1)]
    df = spark.createDataFrame(rows, "key long, rank int, member long")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = lists.stars(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    members = defaultdict(set)
    for k, _, m in rows:
        members[k].add(m)
    for key, held in members.items():
        own = [(r["pivot"], r["member"]) for r in found if r["key"] == key]
        reached = {min(held)}
        while True:
            more = {m for p, m in own if p in reached} | {p for p, m in own if m in reached}
            if more <= reached:
                break
            reached |= more
        assert reached == held
        assert len(own) <= len(held) + 2 * partitions
    assert lists.stars(df.filter("false")).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (201, 200)] + [(7, 30)] * 3
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(30)) and got[201] == 200
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Jaccard join


def shingles(text):
    words = SPACED.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 4]) for i in range(max(len(words) - 3, 1))} if words else set()


def plain_components(rows):
    """(doc_id, size, component) as a multiset, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    return Counter((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows)))


def near_copies(rng):
    texts = []
    for n in (4, 6, 8, 9, 10, 11, 12, 16, 17, 20, 24, 30, 45, 90, 200):
        base = prose(rng, n).split()
        for _ in range(10):
            words = list(base)
            for _ in range(rng.randint(0, 2 + n // 40)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = [rng.choice(["new", "other", "Words"])] * rng.randint(0, 1)
            cut = rng.randint(0, 2)
            texts.append(" ".join(words[: len(words) - cut]))
    passage = prose(rng, 50)
    texts += [f"{passage} {prose(rng, rng.randint(1, 15))}" for _ in range(40)]
    return texts


def test_jaccard_components_against_all_pairs(spark, odd_docs, no_docs):
    texts = near_copies(random.Random(4))
    docs = odd_docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    )
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_report(docs).collect())
    assert got == plain_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert jaccard.jaccard_report(no_docs).count() == 0


def test_one_row_of_each_component_stays(odd_docs, no_docs):
    kept = jaccard.one_per_component(odd_docs)
    assert kept.schema.fieldNames() == odd_docs.schema.fieldNames()
    rows = odd_docs.select("doc_id", "text").collect()
    empty = [r for r in rows if not shingles(r["text"])]
    groups = {repr(sorted(shingles(r["text"]))) for r in rows if shingles(r["text"])}
    assert kept.count() == len(empty) + len(groups)
    assert jaccard.one_per_component(no_docs).count() == 0


@pytest.mark.parametrize("light", [0, 6, 13, 20])
def test_linked_sets_share_a_key_whatever_the_boundary(light):
    rng = np.random.default_rng(light)
    for size in [*range(1, 40), 100, 380, 1000]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            gone = rng.integers(0, jaccard.most_left_out(len(a)) + 1)
            b = np.sort(rng.permutation(a)[gone:])
            extra = 0
            while 100 * len(b) >= 85 * (len(a) + extra + 1):
                extra += 1
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, rng.integers(0, extra + 1), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            assert 100 * both >= 85 * (len(a) + len(b) - both)
            keys = []
            for s in (a, b):
                own = [k for _, made in jaccard.subset_keys(s) for k in made.tolist()] if len(s) <= light else []
                own += jaccard.part_keys(s).tolist() if jaccard.is_heavy(len(s), light) else []
                keys.append(set(own))
            assert keys[0] & keys[1], (size, len(a), len(b), both)
            flips = np.bitwise_count((jaccard.sketch_of(a) ^ jaccard.sketch_of(b)).view(np.uint64)).sum()
            assert flips <= len(a) + len(b) - 2 * both <= jaccard.most_different(len(a), len(b))


@pytest.mark.parametrize("size", [60, 400, 700, 1500, 4000])
def test_sets_with_nothing_in_common_share_no_key(size):
    rng = np.random.default_rng(size)
    keys = [jaccard.part_keys(np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))) for _ in range(80)]
    seen = Counter(k for own in keys for k in set(own.tolist()))
    assert max(seen.values()) == 1


@pytest.mark.parametrize("size", [100, 1000])
def test_linked_sets_share_a_key_where_only_empty_parts_are_the_same(size):
    ((band, parts),) = jaccard.bands_of(size)
    rng = np.random.default_rng(size)
    loose = rng.integers(0, 1 << 63, 40 * size, dtype=np.uint64)
    part = (jaccard._mix(loose * jaccard._odd(100 + band)) >> np.uint64(11)) % np.uint64(parts)
    changes = 0
    while 100 * (size - changes - 1) >= 85 * (size + changes + 1):
        changes += 1
    # As many held parts as there are changes, so that each of them is changed once.
    by_part = [loose[part == p] for p in range(2 * changes)]
    common = np.stack([x[:30] for x in by_part]).T.ravel()[: size - changes]
    a, b = (np.unique(np.concatenate([common, [x[-1] for x in own]])) for own in (by_part[:changes], by_part[changes:]))
    both = len(np.intersect1d(a, b))
    assert len(a) == len(b) == size and 100 * both >= 85 * (2 * size - both)
    assert set(jaccard.part_keys(a).tolist()) & set(jaccard.part_keys(b).tolist())


def test_words_of_texts_are_hashed_as_they_are_split():
    texts = ["", " \t\n", "a", "É é\x00 \x00 ab", " Ab  aB\x0bab\x0cba", "x" * 70_000, "ab", "", "One two three", " "]
    for column in (pa.array(texts), pa.array(["first", *texts, "last"]).slice(1, len(texts))):
        hashes, at = jaccard.hashed_words(column)
        words = [SPACED.findall(t.translate(LOWER)) for t in texts]
        assert np.diff(at).tolist() == [len(w) for w in words]
        named = set(zip((w for own in words for w in own), hashes.tolist(), strict=True))
        assert len(named) == len({w for w, _ in named}) == len({h for _, h in named})
        assert [len(s) for s in jaccard.shingle_sets(column)] == [len(shingles(t)) for t in texts]


def test_pairs_that_part_late_in_their_sketches_are_no_pairs():
    """Pairs of a cell's rows are those that the whole sketches allow, whatever the first words of them say."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(40)]
    sets += [np.unique(np.concatenate([s[k:], rng.integers(0, 1 << 63, k, dtype=np.uint64)])) for s in sets for k in (5, 20, 60)]
    bits = [jaccard.sketch_of(s) for s in sets]
    n = len(sets)
    columns = [[1] * 2 * n, [0] * 2 * n, [True] * n + [False] * n, [*range(n)] * 2, [*range(n)] * 2, [300] * 2 * n, [*range(n)] * 2]
    batch = pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([b.tobytes() for b in bits] * 2, pa.binary())], [*"abcdefgh"])
    got = {(r["a"], r["b"]) for out in jaccard._cells(iter([batch])) for r in out.to_pylist()}
    flips = lambda x, y: int(np.bitwise_count(bits[x].view(np.uint64) ^ bits[y].view(np.uint64)).sum())
    assert got == {(x, y) for x in range(n) for y in range(n) if x != y and flips(x, y) <= jaccard.most_different(300, 300)}


# repeated passages


def test_passages_against_all_windows(spark, odd_docs, no_docs):
    rng = random.Random(11)
    passages = [prose(rng, n).split() for n in (49, 50, 51, 70, 200)]
    texts = []
    for k in range(60):
        p = passages[k % 5]
        a, b = prose(rng, rng.randint(0, 60)).split(), prose(rng, rng.randint(0, 60)).split()
        texts.append(" ".join([*a, *p, *b] if k % 7 else [*a, *p, *b, *p, *a]))
    texts += [texts[0], " ".join(["ja"] * 300)]
    docs = odd_docs.select("doc_id", "text").filter("doc_id is not null").unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    )
    got = defaultdict(set)
    for r in suffixes.repeated_passages(docs).collect():
        assert r["n_words"] >= suffixes.LEAST and r["other_id"] != r["doc_id"]
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    first, want = defaultdict(set), defaultdict(set)
    words = [(r["doc_id"], SPACED.findall((r["text"] or "").translate(LOWER))) for r in docs.collect()]
    for d, w in words:
        for i in range(len(w) - 49):
            first[tuple(w[i : i + 50])].add(d)
    for d, w in words:
        for i in range(len(w) - 49):
            if len(first[tuple(w[i : i + 50])]) > 1:
                want[d].update(range(i, i + 50))
    assert set(got) == set(want)
    for d in want:
        # A left end may come out short where the next neighbours share less on the left, as the module says.
        assert got[d] <= want[d] and all(got[d] & set(range(w, w + suffixes.SPAN)) for w in want[d] - got[d])
    assert sum(len(want[d] - got[d]) for d in want) <= 5
    assert suffixes.repeated_passages(no_docs).count() == 0
    cut = {r["doc_id"]: r["text"] for r in suffixes.without_repeats(docs.filter("doc_id >= 1000")).collect()}
    assert cut[1000] == texts[0] and cut[1060] == "" and cut[1061] == texts[61]


def test_texts_that_share_an_id_stay_apart(spark):
    """Passages of two texts of one id, or of none, are not run together, and only what a smaller text holds is cut."""
    rng = random.Random(21)
    words = lambda n: prose(rng, n).split()
    p, q = words(60), words(60)
    first, second = [*p, *words(60)], [*words(40), *q, *words(20)]
    left, both = words(50), words(30)
    rows = [(None, first), (None, second), (5, first), (5, second), (7, [*p, *words(9)]), (8, [*words(7), *q])]
    # A text whose first words stand in a smaller one, and whose last ones stand in a larger one.
    rows += [(20, left), (21, [*left, *both, *q[:20]]), (22, [*both, *q[:20], *words(5)])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    found = [r.asDict() for r in suffixes.repeated_passages(docs).collect()]
    spans = Counter((r["doc_id"], r["start_word"], r["end_word"]) for r in found)
    # The whole texts stand in the rows of the other id; of 7 and 8 the passages do, of 21 two that touch.
    assert spans == Counter([(None, 0, 120)] * 2 + [(5, 0, 120)] * 2 + [(7, 0, 60), (8, 7, 67), (20, 0, 50), (21, 0, 100), (22, 0, 50)])
    assert len({r["text_key"] for r in found if r["doc_id"] is None}) == 2
    kept = Counter((r["doc_id"], r["text"]) for r in suffixes.without_repeats(docs).collect())
    join = " ".join
    assert kept == Counter([
        (None, join(first)), (None, join(second)), (5, ""), (5, ""), (7, join(rows[4][1][60:])), (8, join(rows[5][1][:7])),
        (20, join(left)), (21, join([*both, *q[:20]])), (22, join(rows[8][1][50:])),
    ])


def test_passages_do_not_depend_on_partitions(spark):
    rng = random.Random(12)
    passage = prose(rng, 80)
    docs = spark.createDataFrame([(i, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for i in range(120)], "doc_id long, text string")
    seen = []
    for n in (1, 13):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            seen.append(sorted(tuple(r)[:4] for r in suffixes.repeated_passages(docs.repartition(n)).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1] and len({r[0] for r in seen[0]}) == 120


def test_passages_with_a_frequent_tail(spark):
    rng = random.Random(13)
    tail = prose(rng, 30)
    rows = []
    for k in range(12):
        own = prose(rng, 20 + k)
        rows += [(10 * k + i, f"{prose(rng, 15)} {own} {tail} {prose(rng, 15)}", 50 + k) for i in range(2)]
    rows += [(1000 + i, f"{prose(rng, 30)} {tail} {prose(rng, 30)}", None) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: (r["start_word"], r["end_word"], r["other_id"]) for r in suffixes.repeated_passages(docs).collect()}
    assert got == {d: (15, 15 + n, d + 1 - 2 * (d % 10)) for d, _, n in rows if n}


def test_long_runs_of_one_text_meet_the_others(spark):
    passage, short = prose(random.Random(14), 60), prose(random.Random(15), 55)
    texts = {
        1: " ".join([f"{passage} zz"] * 9), 2: passage, 3: " ".join([f"{short} yy"] * 5), 4: short, 5: "ja " * (suffixes.ROWS + 20_000), 6: "ja " * 60,
        7: " ".join([prose(random.Random(16), 70)] * 9),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = Counter((r["doc_id"], r["start_word"], r["end_word"], r["other_id"]) for r in suffixes.repeated_passages(docs).collect())
    want = [(1, 61 * k, 61 * k + 60, 2) for k in range(9)] + [(2, 0, 60, 1)] + [(3, 56 * k, 56 * k + 55, 4) for k in range(5)]
    assert got == Counter([*want, (4, 0, 55, 3), (5, 0, suffixes.ROWS + 20_000, 6), (6, 0, 60, 5)])


# token files


def test_token_files_round_trip(odd_docs, no_docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokens.token_report(odd_docs, vocabulary()).collect())
    encode = lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
    rows = [(r["doc_id"], encode(r["text"])) for r in odd_docs.collect()]
    assert got == Counter((d, len(ids), zlib.crc32(ids.tobytes())) for d, ids in rows)
    ordered = sorted(tokens.token_report(odd_docs, vocabulary()).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in ordered]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in ordered] == [sum(r["n_tokens"] for r in ordered[:i]) for i in range(len(ordered))]
    assert tokens.token_report(no_docs, vocabulary()).count() == 0


@pytest.mark.parametrize("text", [
    "", " ", "\n", "a", "a  b", "a\nb", "\na", "a\n", "a \nb", "x\ty", "it's 'quoted' don't", "a<|endoftext|>b", "é ü z", "日本 語\n　x",
    "a\n\nb", " a b ", "1 2 33\n4", "a b", "x\x85y", "end. next, (one) x!? y", "ab.c, ab.. ab", "A" * 3000, "² 3², ¼.",
])
def test_pieces_encode_like_whole_texts(text):
    encoder = tokens.Encoder(vocabulary())
    want = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode(pa.array([text, "some words", text])) [::2] == [want, want]


@pytest.mark.parametrize("text", ["two  spaces here\n\n", "plain words of a text "])
def test_the_tokenizer_gets_few_characters_at_once(monkeypatch, text):
    encoder, most = tokens.Encoder(vocabulary()), []
    own = encoder.tokenizer

    class Watched:
        model = own.model

        def encode_batch_fast(self, texts, **options):
            most.append(sum(map(len, texts)))
            return own.encode_batch_fast(texts, **options)

    texts = [text * 1000 + str(i) for i in range(100)]
    want = [np.array(own.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts[:3]]
    encoder.tokenizer = Watched()
    done = encoder.encode(pa.array(texts))
    assert done[:3] == want and len(done) == 100
    assert max(most) <= 1 << 18


def test_kept_pieces_are_looked_up_without_a_call_each():
    """Pieces that the encoder keeps, and that it has put away, cost no Python function call each."""
    encoder, calls = tokens.Encoder(vocabulary()), []
    texts = [f"{a}{b}ing the\n{b}{a}ed, été{a} {i}." for i, (a, b) in enumerate((a, b) for a in "abcdefghijklmno" for b in "pqrstuvwxyz")]
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for kept in (10**6, 1):
        encoder.kept = kept
        assert encoder.encode(pa.array(texts)) == want
        calls.clear()
        sys.setprofile(lambda frame, event, _: calls.append(frame.f_code.co_name) if event == "call" and frame.f_code.co_filename == tokens.__file__ else None)
        try:
            again = encoder.encode(pa.array(texts))
        finally:
            sys.setprofile(None)
        assert again == want
        assert len(calls) < 50


def test_file_format_keeps_ids_chunks_and_documents():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1 << 32, n, dtype=np.uint32).astype("<u4") for n in (0, 1, 5, tokens.BLOCK, tokens.BLOCK + 3, 2)]
    ids, lengths, chunks = tokens.unpack(tokens.pack([3, None, -5, 1 << 60, 7, 8], [d.tobytes() for d in docs]))
    assert ids == [3, None, -5, 1 << 60, 7, 8] and lengths.tolist() == [len(d) for d in docs]
    chunks = list(chunks)
    assert all(len(c) == tokens.BLOCK for c in chunks[:-1])
    assert np.array_equal(np.concatenate(chunks), np.concatenate(docs))


def test_a_chunk_is_read_by_the_index_alone(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 100)
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 50_000, n).astype("<u4") for n in (1, 99, 250, 33)]
    content = tokens.pack([5, None, 7, 8], [d.tobytes() for d in docs])
    whole = np.concatenate(docs)
    for a, b in ((0, 383), (0, 0), (99, 101), (100, 200), (250, 383), (382, 383), (350, 900), (383, 390)):
        assert tokens.ids_between(content, a, b).tolist() == whole[a:b].tolist()
    # A broken plane of another chunk is never looked at.
    assert tokens.ids_between(content[:-40] + bytes(40), 0, 100).tolist() == whole[:100].tolist()
    with pytest.raises(ValueError):
        tokens.ids_between(b"XXXX" + content[4:], 0, 1)


# licenses


def test_license_phrases_and_notices(spark, odd_docs, no_docs):
    notice = licenses.TEMPLATES["bsd"][0]
    texts = [
        "MIT License, mit-license; the Apache license and MIT license", "general public license license mit", "x " + notice + " y",
        "x " + notice.replace("provided that", "only if it is provided that") + " y", notice[:40], "Licensed under CC BY-NC 4.0. bye",
        "Released under the MIT License. " + "w " * 500 + "Licensed under CC BY 4.0",
    ]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(700 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    rows = licenses.license_report(docs).collect()
    assert len(rows) == docs.count()
    got = {r["doc_id"]: r for r in rows if (r["doc_id"] or 0) >= 700}
    for i, t in enumerate(texts):
        words = ALNUM.findall(t.translate(LOWER))
        places = sorted(
            (k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()
        )
        r = got[700 + i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[702]["labels"] == got[703]["labels"] == "bsd" and got[702]["score"] == 1
    assert got[704]["labels"] == "" and got[705]["labels"] == "cc-by-nc" and got[706]["labels"] == "cc-by,mit"
    assert licenses.license_report(no_docs).count() == 0


def test_licences_of_one_family_are_told_apart(spark):
    work = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    gnu = "redistribute it under the terms of the GNU {} as published by the Free Software Foundation, either version 3"
    texts = {
        "cc-by": work.format(""), "cc-by-sa": work.format("-ShareAlike"), "cc-by-nc": work.format("-NonCommercial"), "cc-by-nd": work.format("-NoDerivatives"),
        "cc-by-nc-sa": work.format("-NonCommercial-ShareAlike"), "cc-by-nc-nd": work.format("-NonCommercial-NoDerivatives"),
        "agpl,gpl": gnu.format("Affero General Public License"), "gpl,lgpl": gnu.format("Lesser General Public License"),
        "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
               "the above copyright notice and this permission notice appear in all copies.",
        "epl": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "mit": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
               "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    }
    docs = spark.createDataFrame([(i, f"some words before. {t} and some after") for i, t in enumerate(texts.values())], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.license_report(docs).collect()}
    assert got == dict(enumerate(texts))


def test_notices_are_chains_that_fit_best(spark):
    gpl, lgpl = licenses.TEMPLATES["gpl"][1], licenses.TEMPLATES["lgpl"][0]
    runs = lgpl.split()
    scattered = " x y z ".join(" ".join(runs[i : i + 3]) + " w" * (3 * (i // 3)) for i in reversed(range(0, len(runs) - 2, 3)))
    texts = [
        "a " + lgpl.replace("lesser ", "") + " b", "a " + gpl + " b", "a " + gpl.replace("gnu general", "gnu lesser general") + " b", lgpl,
        scattered, f"{lgpl} and {lgpl}",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = defaultdict(list)
    for r in licenses.notices(docs).collect():
        got[r["doc_id"]].append((r["start"], r["end"], r["label"], r["share"]))
    n, m = len(gpl.split()), len(runs)
    assert {d: sorted(x) for d, x in got.items()} == {
        1: [(1, 1 + n, "gpl", 1.0)], 2: [(1 + n + 1 - m, n + 2, "lgpl", 1.0)], 3: [(0, m, "lgpl", 1.0)], 5: [(0, m, "lgpl", 1.0), (m + 1, 2 * m + 1, "lgpl", 1.0)],
    }


# pages

PAGES = [
    ("http://a.example/x/1", "<nav><a>Home</a></nav><article><h1>T &amp; U</h1><p><b>one  two<br><p>three\n four</p></article><footer>f</footer>", "T & U\none two\nthree four"),
    ("http://a.example/x/2", "<body><div>Shared line</div><div>own line</div><div class='sidebar'>s</div></body>", "own line"),
    ("http://a.example/x/3", "<body><div>Shared line</div><div>another &eacute; line</div><script>var x='<p>no</p>'</script>", "another é line"),
    ("http://b.example/", "<main class='with-sidebar'>a<ul><li>b<li>c</ul><form>q</form><!-- x --></main><aside>z</aside>", "a\nb\nc"),
    (None, None, ""), ("http://c.example/", "", ""), ("not a url", "plain < text & more", "plain < text & more"),
    ("http://d.example/p", "<article><p>art</p><div class='comments'><p>first!</p></div></article><article class='comment'>x</article>", "art"),
    ("http://e.example/p", "<div><p>unclosed <a href='x>y'>link</a> tail", "unclosed link tail"),
]


def test_main_texts(spark):
    rows = [(i, u, h) for i, (u, h, _) in enumerate(PAGES)] + [(8, PAGES[8][0], PAGES[8][1]), (None, "http://f.example", "<article>n</article>")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, shared int")
    got = Counter((r["page_id"], r["text"], r["n_chars"]) for r in pages.pages_report(df).collect())
    want = Counter((i, t, len(t)) for i, (_, _, t) in enumerate(PAGES) if i != 8)
    want[8, "", 0] += 2  # two copies share all their lines
    want[None, "n", 1] += 1
    assert got == want
    assert pages.pages_report(df.filter("false")).count() == 0


def test_lines_beside_an_article_go_by_the_comparison_alone(spark):
    page = "<div>Menu of the site</div><article class='card'><p>teaser {0}</p></article><div>body {0}</div><div class='footer'>f</div>"
    df = spark.createDataFrame([(i, f"http://g.example/{i}", page.format(i)) for i in range(3)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.pages_report(df).collect()} == {i: f"teaser {i}\nbody {i}" for i in range(3)}


def test_copies_of_a_page_keep_their_text(spark):
    site = "<div>Site</div><div>body of {0}, long enough to tell one page from the other</div>"
    near = "<div>{0}</div><div>" + "the text of a page that is stored again and again " * 5 + "</div>"
    rows = [("h", "a", "one"), *[("h", f"b?page={i}", "two") for i in range(5)], ("h", "c", "three"), *[("i", f"x?ref={i}", "same") for i in range(3)]]
    rows = [(k, f"http://{h}.example/{u}", site.format(b), f"body of {b}, long enough to tell one page from the other") for k, (h, u, b) in enumerate(rows)]
    rows = [(k, u, p, t if "//h." in u else "Site\n" + t) for k, u, p, t in rows]
    rows += [(50 + i, f"http://j.example/{i}", near.format(i), f"{i}\n" + ("the text of a page that is stored again and again " * 5).strip()) for i in range(3)]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.pages_report(df).collect()} == {r[0]: r[3] for r in rows}


def test_slugs_of_headings_drop_nothing_of_an_article():
    page = (
        "<article><header class='entry-header'><h1>T</h1></header><h2 id='related-work'>R</h2><section id='search-algorithms'><p id='notice'>s</p></section>"
        "<div id='header-files'>d</div><div class='share'>x</div><div id='comments'>c</div><ul id='related'><li>y</ul></article><div id='sidebar'>z</div>"
    )
    assert [t for t, kind in pages.lines(page) if kind == pages.OWN] == ["T", "R", "s", "d"]


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        at = pages.common(a, b)
        assert at == sorted(set(at)) and len(at) == best[-1][-1]
        rest = iter(b)
        assert all(a[i] in rest for i in at)


def test_deep_and_long_pages(monkeypatch):
    """Elements that are never closed cost no search; long pages are compared in halves, to the same length."""
    deep = "".join(f"<div>{i}<b>x" for i in range(30_000))
    begun = time.process_time()
    assert len(pages.lines(f"<body>{deep}<p>end")) == 30_001
    assert time.process_time() - begun < 5
    rng = random.Random(31)
    for n in (5, 40, 200):
        a, b = ([rng.randint(0, 9) for _ in range(n + rng.randint(0, 20))] for _ in range(2))
        whole = pages.common(a, b)
        with monkeypatch.context() as patch:
            patch.setattr(pages, "KEPT_BITS", 16)
            halves = pages.common(a, b)
        assert len(halves) == len(whole) == len(set(halves))
        rest = iter(b)
        assert all(any(y == a[i] for y in rest) for i in sorted(halves))
    long = [rng.randint(0, 200_000) for _ in range(40_000)]
    found = pages.common(long, [v for k, v in enumerate(long) if k % 3] + long[:9])
    assert len(found) >= 26_666


def test_pages_of_the_given_tables(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in pages.pages_report(given).collect()}
    for r in given.collect():
        inner = re.search("<article>(.*)</article>", r["html"], re.S).group(1)
        parts = (html_lib.unescape(re.sub("<[^>]*>", "", b)) for b in re.split("</?(?:p|h1|br)>", inner))
        assert got[r["page_id"]] == "\n".join(x for x in (" ".join(p.split()) for p in parts) if x)


# toxicity


@pytest.fixture(scope="module")
def language():
    counts = np.full((28, 28, 28), 0.1)
    for word in ("idiot", "loser", "the", "them", "theme", "moon", "stupid", "clown") * 50:
        s = [27, 27, *(ord(c) - 97 for c in word), 27]
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            counts[a, b, c] += 1
    return np.log(counts / counts.sum(axis=2, keepdims=True)).astype(np.float32)


@pytest.mark.parametrize(("given", "meant"), [
    ("1d10t", ["idiot"]), ("l o s e r", ["loser"]), ("s.t.u.p.i.d!", ["stupid"]), ("looooser", ["loser"]), ("Clown,", ["clown"]), ("cl*wn", ["clown"]),
    ("$tup1d", ["stupid"]), ("moon", ["moon"]), ("a a a a", ["a", "a", "a", "a"]), ("12345", []), ("", []), ("ïé", ["ïé"]),
])
def test_disguised_words_are_restored(language, given, meant):
    assert toxicity.Restorer(language).words(given) == meant


def test_viterbi_finds_the_best_path(language):
    for segment in ("1d10t", "s+up1d", "cl*wn", "l.o.s.e.r", "mooon", "7h3"):
        paths = [("", 0.0)]
        for place in toxicity.lattice(segment):
            paths = [(t + m, c + k) for t, c in paths for m, k in place]

        def whole(path):
            text, total = path
            s = [27, 27, *map(toxicity._symbol, text), 27]
            return total + sum(float(language[a, b, c]) for a, b, c in zip(s, s[1:], s[2:], strict=False))

        assert toxicity.decode(segment, language) == max(paths, key=whole)[0]


@pytest.fixture(scope="module")
def scored(spark, odd_docs):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        words, toxic = prose(rng, rng.randint(8, 120)).split(), i % 6 == 0
        if toxic:
            for bad in rng.choices(["grobnik", "fluzzer", "snarfle", "blorp", "grobnar"], k=3):
                form = bad if i % 12 else bad.replace("o", "0").replace("l", "1")
                words.insert(rng.randrange(len(words)), form)
        rows.append((2000 + i, " ".join(words), int(toxic)))
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows] + [(2000, 0, 0), (None, 1, 1), (2001, 1, None), (9, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels, {r[0]: r[2] for r in rows}


def test_toxic_texts_score_high_also_where_labels_were_held_out(scored):
    docs, labels, truth = scored
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode() if r["doc_id"] is not None else b"") % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 80 and sum(p == t for p, t in held) / len(held) >= 0.97
    assert not any(r["predicted"] for r in rows if r["doc_id"] not in truth)


def test_clean_rows_stay_whole(scored, odd_docs, no_docs):
    docs, labels, truth = scored
    kept = {r["doc_id"] for r in toxicity.clean_documents(docs, labels).collect()}
    assert sum(d in kept for d, t in truth.items() if t) <= 5 and all(d in kept for d, t in truth.items() if not t)
    assert sorted(map(repr, toxicity.clean_documents(odd_docs, labels).collect())) == sorted(map(repr, odd_docs.collect()))
    assert toxicity.toxicity_report(no_docs, labels).count() == 0
    assert toxicity.toxicity_report(odd_docs, labels.filter("false")).filter("predicted = 1").count() == 0

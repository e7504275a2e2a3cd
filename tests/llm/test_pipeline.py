"""The pipeline against its stages in plain Python, on the given tables."""

import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from listloom.llm import mixing, toxicity
from listloom.llm.queries import ORACLE, QUERIES, vocabulary
from tests.llm.test_free import shingles
from tests.llm.test_native import alnum, hits

FOLDER = "/root/testdata/sf0.001"


def representatives(docs):
    """The smallest id of each group of linked texts."""
    ids = sorted(docs)
    sets = {d: shingles(docs[d]) for d in ids}
    near = defaultdict(set)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                near[a].add(b)
                near[b].add(a)
    kept, seen = [], set()
    for d in ids:
        if d not in seen:
            kept.append(d)
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += near[x]
    return kept


def test_pipeline_against_its_stages_in_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [(r["item_id"], alnum(r["text"])) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    # A model trained by the rules of its module judges; what it does with its verdicts is plain.
    verdicts = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity_report(docs, labels).collect()}
    texts = {d: t for d, t in texts.items() if not verdicts[d]}
    texts = {d: texts[d] for d in representatives(texts)}
    clean = {}
    for d, t in texts.items():
        words = alnum(t)
        n, _ = hits(words, items)
        if not (n and 20 * n >= len(words)):
            clean[d] = t

    frame = docs.filter(docs["doc_id"].isin(list(clean)))
    placed = mixing.place_documents(frame, whole=True).collect()
    sizes, taken, targets = Counter(), Counter(), {}
    copies = {}
    for r in placed:
        copies[r["doc_id"]] = len(r["positions"])
        assert r["taken"] == copies[r["doc_id"]] * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes))}
    level = sum(sizes.values()) / sum(weights.values())
    while True:  # shares above three sizes go to the others
        full = {s for s in sizes if weights[s] * level > 3 * sizes[s] + 1e-6}
        rest = (sum(sizes.values()) - sum(3 * sizes[s] for s in full)) / sum(w for s, w in weights.items() if s not in full)
        if abs(rest - level) < 1e-9:
            break
        level = rest
    longest = defaultdict(int)
    for r in placed:
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s in sizes:
        assert abs(targets[s] - min(3 * sizes[s], weights[s] * level)) < 1e-3
        assert abs(taken[s] - targets[s]) <= longest[s]

    tokenizer = Tokenizer.from_file(vocabulary())
    # The files follow the curriculum: copies in order of their positions.
    want, start = Counter(), 0
    for _, d in sorted((p, r["doc_id"]) for r in placed for p in r["positions"]):
        ids = np.array([*tokenizer.encode(clean[d], add_special_tokens=False).ids, 0], "<u4")
        want[d, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    assert sum(want.values()) == sum(copies.values())
    got = Counter(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == want


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.columns == docs.columns and found.count() == 0, name


def test_every_numbered_operator_is_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14)) and set(ORACLE) <= set(QUERIES)

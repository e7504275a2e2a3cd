"""Toxicity: texts are restored by a noisy-channel decoder, then scored by a lexicon learned from labels.

Words may be disguised: letters written as digits or signs, set apart by spaces or
dots, or repeated. A disguised word is a lattice of the letters that each sign may stand for; the
Viterbi path through it under a character language model is the word that was meant. The
language model counts character trigrams over all texts of the corpus, added up in each task before they are
shuffled; its table has one size for any corpus.

The lexicon holds words and word beginnings. Each is weighed by the lower bound of its log odds between toxic
and clean labelled texts. Occurrences count once per text and once per word before them, so that copies of one text do not make its
words look toxic. A text's evidence is the sum over its distinct words; a logistic curve, fitted on the training
texts, turns it into a score. Training uses labelled texts whose crc32(doc_id as text) mod 5 is not 0, ``SAMPLE`` of
them on average if there are more, picked by a hash. Labels, language, source and id are no input of a score.

Cases: null and empty texts have no evidence and get the curve's value for none. Labels that are null or
belong to no text are left out; of several labels of one id the largest counts. Without labels of both kinds
no word has weight and all scores are the share of toxic labels, one quarter if there are none. Repeated rows each get the same score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listloom.llm.text import let_go, ship, text_of
from listloom.session import frozen

ship(__name__)

# Labelled texts used for training, on average; about so many more may be picked as chance has it.
SAMPLE = 12_000
# Least number of toxic texts, and of words before it, that a lexicon entry was seen with.
LEAST = 3
# Least log likelihood ratio of an entry against chance.
SURPRISE = 9.2
PREFIXES = (4, 5, 6)
# Tokens that a task remembers, and texts that it handles at once.
KEPT, TEXTS = 150_000, 250

# Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou",
}
# Log costs of the channel: a sign read as a letter, a sign kept, a run of letters shortened.
READ, KEEP, SHORTEN = -0.7, -6.0, -0.5
# Symbols of the language model: a-z, any other letter, anything else.
LETTERS, OTHER, GAP = 26, 26, 27
SYMBOLS = 28

_TABLE = np.full(256, GAP, np.int64)
_TABLE[ord("a") : ord("z") + 1] = np.arange(26)
_TABLE[ord("A") : ord("Z") + 1] = np.arange(26)
_TABLE[128:] = OTHER

WORDS = re.compile(r"[^\W\d_]+")
APART = re.compile(r"\W*\w(?:[._\-*~]+\w){2,}\W*")
DISGUISED = re.compile(r"(?=.*[^\W\d_])(?:.*[^\W_][@$!|+(*]+[^\W_]|.*[^\W\d_][013456789]+|.*[013456789@$]+[^\W\d_])")
# Signs that are punctuation where they begin or end a word.
EDGES = ".,;:?\"'()[]{}<>#%&*!|~^-_"
RUN = re.compile(r"(.)\1\1")


@dataclass
class Model:
    """The language model's log probabilities, the lexicon's weights, and the curve."""

    language: np.ndarray
    weights: dict[str, float]
    slope: float
    offset: float


def _symbol(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 97
    return OTHER if c.isalpha() else GAP


def _trigrams(batches):
    let_go()
    for batch in batches:
        counts = np.zeros(SYMBOLS**3, np.int64)
        for at in range(0, batch.num_rows, 256):
            raw = "\n".join(batch.column(0).slice(at, 256).to_pylist()).encode()
            s = _TABLE[np.frombuffer(raw, np.uint8)]
            s = np.concatenate([[GAP, GAP], s, [GAP]])
            counts += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) from all texts; the table has ``SYMBOLS`` cubed entries."""
    counted = docs.select(text_of().alias("text")).mapInArrow(_trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    counts = np.full(SYMBOLS**3, 0.1)
    counts[table["gram"].to_numpy()] += table["n"].to_numpy()
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    return np.log(counts / counts.sum(axis=2, keepdims=True)).astype(np.float32)


def lattice(segment: str) -> list[list[tuple[str, float]]]:
    """For each place of a lower-case segment, what may have been meant there and at what cost."""
    out = []
    for m in re.finditer(r"(.)\1*", segment, re.S):
        c, n = m.group(1), len(m.group(0))
        if c in " ._-~" or (not c.isalnum() and c not in SIGNS):
            out.append([("", 0.0)])
        elif c in SIGNS:
            places = [[(x, READ) for x in SIGNS[c]] + [(c, KEEP)]] * min(n, 2)
            out += [[*place, *([("", SHORTEN)] if n > 1 and k else [])] for k, place in enumerate(places)]
        elif n >= 3:
            out.append([(c, SHORTEN), (c + c, SHORTEN)])
        else:
            out += [[(c, 0.0)]] * n
    return out


def decode(segment: str, language: np.ndarray) -> str:
    """The most likely reading of a segment: the Viterbi path; a state is the last two symbols."""
    best = {(GAP, GAP): (0.0, "")}
    for place in lattice(segment.lower()):
        step: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, text) in best.items():
            for meant, cost in place:
                x, y, s = a, b, score + cost
                for c in meant:
                    z = _symbol(c)
                    s += float(language[x, y, z])
                    x, y = y, z
                if (x, y) not in step or step[x, y][0] < s:
                    step[x, y] = (s, text + meant)
        best = step
    return max(((s + float(language[a, b, GAP]), t) for (a, b), (s, t) in best.items()), default=(0.0, ""))[1]


class Restorer:
    """Words of a text with disguised ones restored; each distinct token is decoded once per task."""

    def __init__(self, language: np.ndarray):
        self.language = language
        self.kept: dict[str, list[str]] = {}

    def token(self, token: str) -> list[str]:
        if token.isalpha() and not RUN.search(token):
            return [token.lower()]
        found = self.kept.get(token)
        if found is None:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            if token.isalpha():
                found = [decode(token, self.language)]
            elif APART.fullmatch(token):
                found = WORDS.findall(decode(token.strip(EDGES), self.language))
            else:
                core = token.strip(EDGES)
                if RUN.search(core) or DISGUISED.match(core):
                    found = WORDS.findall(decode(core, self.language))
                else:
                    found = WORDS.findall(token.lower())
            self.kept[token] = found
        return found

    def words(self, text: str) -> list[str]:
        tokens = text.split()
        out: list[str] = []
        single: list[str] = []
        for t in tokens:
            if len(t) == 1:
                single.append(t)
                continue
            if single:
                out += self._joined(single)
                single = []
            out += self.token(t)
        return out + self._joined(single) if single else out

    def _joined(self, letters: list[str]) -> list[str]:
        """Single letters in a row are one word set apart, unless they are all the same."""
        if len(letters) < 3 or len(set(letters)) == 1:
            return [x.lower() for x in letters if x.isalpha()]
        return WORDS.findall(decode("".join(letters), self.language))


def features(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


def _chunks(batches):
    let_go()
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            yield batch.slice(at, TEXTS)


def _seen(language: np.ndarray):
    """(feature, doc, before) once per text and word before it."""

    def run(batches):
        restore = Restorer(language)
        for batch in _chunks(batches):
            rows = set()
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                before = ""
                for word in restore.words(text):
                    rows.update((f, doc, before) for f in features(word))
                    before = word
            if rows:
                f, d, b = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(d, pa.int64()), pa.array(b)], ["feature", "doc", "before"])

    return run


def _counted(language: np.ndarray, wanted: set[str]):
    """(feature, n): texts with each wanted feature, added up over some texts."""

    def run(batches):
        restore = Restorer(language)
        for batch in _chunks(batches):
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                counts.update({f for word in set(restore.words(text)) for f in features(word) if f in wanted})
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["feature", "n"])

    return run


def evidence_of(words: list[str], weights: dict[str, float]) -> float:
    total = 0.0
    for word in set(words):
        total += max((weights.get(f, 0.0) for f in features(word)), default=0.0)
    return total


class Scorer:
    """Evidence of texts; the weight of each distinct token is looked up once per task."""

    def __init__(self, model: Model):
        self.model, self.restore = model, Restorer(model.language)
        self.kept: dict[str, tuple[tuple[str, float], ...]] = {}

    def _weigh(self, words: list[str]) -> tuple[tuple[str, float], ...]:
        weigh = self.model.weights.get
        out = []
        for word in words:
            w = max(weigh(f, 0.0) for f in features(word))
            if w > 0:
                out.append((word, w))
        return tuple(out)

    def evidence(self, text: str) -> float:
        tokens = text.split()
        held: dict[str, float] = {}
        kept = self.kept
        for token in set(tokens):
            found = kept.get(token)
            if found is None:
                if len(kept) >= KEPT:
                    kept.clear()
                found = kept[token] = self._weigh(self.restore.token(token)) if len(token) > 1 else ()
            if found:
                held.update(found)
        single: list[str] = []
        for t in [*tokens, "  "]:
            if len(t) == 1:
                single.append(t)
            elif single:
                if len(single) > 2:
                    held.update(self._weigh(self.restore._joined(single)))
                single = []
        return sum(held.values())


def _evidence(model: Model):
    def run(batches):
        scorer = Scorer(model)
        for batch in _chunks(batches):
            values = [scorer.evidence(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["row", "evidence"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a small penalty; labels are smoothed."""
    n1 = toxic.sum()
    y = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (len(toxic) - n1 + 2))
    x = np.stack([evidence, np.ones_like(evidence)], axis=1)
    beta = np.array([0.0, np.log((n1 + 0.5) / (len(toxic) - n1 + 0.5))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - np.array([1e-3, 0.0]) * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model from all texts (language) and a bounded sample of labelled ones (lexicon and curve)."""
    language = language_model(docs)
    given = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.max("toxic").cast("int").alias("toxic")
    ).filter(~held_out(F.col("labelled")))
    n = given.count()
    given = given.filter(F.pmod(F.xxhash64(F.lit(11), "labelled"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(n, 1))))
    # At most about ``sample`` rows.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = frozen(rows.join(F.broadcast(given), F.col("doc_id") == F.col("labelled")).select(F.col("doc_id").alias("doc"), "text", "toxic"))

    found = rows.filter("toxic = 1").select("doc", "text").mapInArrow(_seen(language), "feature string, doc long, before string")
    by_text = found.groupBy("feature").agg(F.count_distinct("doc").alias("docs"), F.count_distinct("before").alias("befores"))
    toxic = {r["feature"]: r["n"] for r in by_text.select("feature", F.least("docs", "befores").alias("n")).filter(F.col("n") >= LEAST).collect()}
    counted = rows.filter("toxic = 0").select("text").mapInArrow(_counted(language, set(toxic)), "feature string, n long")
    clean = {r["feature"]: r["n"] for r in counted.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count_distinct("doc").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    weights = {}
    if n1 and n0:
        for feature, t in toxic.items():
            c = clean.get(feature, 0)
            odds = np.log((t + 0.5) / (n1 + 1)) - np.log((c + 0.5) / (n0 + 1))
            bound = odds - np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
            # Rare words meet toxic texts by chance as well; there are very many of them.
            share = n1 / (n1 + n0)
            surprise = t * np.log(t / (share * (t + c))) + (c * np.log(c / ((1 - share) * (t + c))) if c else 0.0)
            if bound > 1.0 and surprise > SURPRISE:
                weights[feature] = float(bound)
    model = Model(language, weights, 0.0, float(np.log((n1 + 0.5) / (n0 + 1.5))))
    if weights:
        labelled = rows.select("toxic", "text").mapInArrow(_evidence(model), "row int, evidence double").toArrow()
        model.slope, model.offset = fit_curve(labelled["evidence"].to_numpy(), labelled["row"].to_numpy())
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    found = rows.mapInArrow(_evidence(model), "row long, evidence double")
    value = 1 / (1 + F.exp(-(F.col("evidence") * model.slope + model.offset)))
    return found.select(F.col("row").alias("doc_id"), value.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _verdicts(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in _chunks(batches):
            at = batch.schema.names.index("_text_")
            values = np.array([scorer.evidence(t) for t in batch.column(at).to_pylist()])
            keep = values * model.slope + model.offset < 0
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep))], ["row"])

    return run


def clean_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    model = train(docs, labels, sample)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of().alias("_text_"))
    return packed.mapInArrow(_verdicts(model), StructType([packed.schema["row"]])).select("row.*")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its score."""
    model = train(docs, labels)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

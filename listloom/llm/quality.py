"""Quality rules: counts of a text, and how far its histograms lie from those of its language.

Two histograms are kept of each text: characters by class, and the common
words of the listed languages against all other words. The reference of a
language is the sum over all texts in it that pass the base rules; texts in other or no
language share one reference, so there are only ``len(COMMON_WORDS) + 1`` of them. A
text is measured by the Jensen-Shannon distance (base 2, from 0 to 1) of each
histogram to its reference. Short texts have ragged histograms: each distance
counts only from a minimum length on.

Everything is worked out within the row; the counts per text are kept once in
the shared folder, so that texts are read once. Sums per language are added up
before they are shuffled.

Cases: null and empty texts have no words and fail the base rules. Windows and
lines are compared as texts. A language without any passing text
has no reference, and its texts pass the method. Repeated rows count as often as they
occur in the reference and each get a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.llm.text import let, split_words, text_of
from listloom.session import frozen

# Frequent words of the four languages.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit"],
    "fr": ["le", "la", "les", "de", "des", "et", "en", "un"],
    "es": ["el", "los", "que", "y", "del", "se", "las", "por"],
}
# Character classes; what none of them takes is the last class.
CLASSES = [
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    " \t\n\x0b\x0c\r",
    "0123456789",
    "#*$%&|<>",
    ".,;:!?'\"()-",
]
SYMBOLS = CLASSES.index("#*$%&|<>")

CHAR_LIMIT, CHAR_LEAST = 0.35, 50
WORD_LIMIT, WORD_LEAST = 0.75, 60


def _char_counts(text: Column) -> Column:
    """Characters of each class, then all others. Each class is taken out of what the one before left."""

    def taken(rest: Column, classes: list[str]) -> Column:
        if not classes:
            return F.array(F.length(rest).cast("long"))
        return let(
            F.translate(rest, classes[0], ""),
            lambda left: F.concat(F.array((F.length(rest) - F.length(left)).cast("long")), taken(left, classes[1:])),
        )

    return let(text, lambda t: taken(t, CLASSES))


def _word_counts(words: Column) -> Column:
    """Counts of each common word, then of all other words."""
    common = sorted({w for ws in COMMON_WORDS.values() for w in ws})

    def counts(s: Column) -> Column:
        each = [(F.length(s) - F.length(F.replace(s, F.lit(f" {w} "), F.lit("")))) / (len(w) + 2) for w in common]
        return F.array(*[c.cast("long") for c in each])

    # Two spaces between words, so that neighbours do not share one.
    line = lambda held: F.concat(F.lit(" "), F.concat_ws("  ", held), F.lit(" "))
    return let(
        F.filter(words, lambda w: w.isin(*common)),
        lambda held: F.concat(let(line(held), counts), F.array((F.size(words) - F.size(held)).cast("long"))),
    )


def _repeat_words(words: Column, size: int = 5) -> Column:
    """Words that stand in windows found twice or more.

    If the windows' hashes all differ, so do the windows. Else those that share a hash
    are compared as texts.
    """
    run = lambda i: [F.get(words, i + k) for k in range(size)]
    starts = F.sequence(F.lit(0), F.size(words) - size)

    def twice(rows: Column) -> Column:
        """The places of rows (s, i), sorted, whose s also stands before or after."""
        same = lambda x, j: (x["s"] == F.get(rows, j + 1)["s"]) | ((j > 0) & (x["s"] == F.get(rows, j - 1)["s"]))
        return F.transform(F.filter(rows, lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"])

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("s"), i.alias("i"))))
        texts = lambda at: F.array_sort(
            F.transform(at, lambda i: F.struct(F.concat_ws(" ", *run(i)).alias("s"), i.alias("i")))
        )
        places = let(let(let(pairs, twice), texts), twice)
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.sequence(i, i + (size - 1))))))

    found = F.when(F.size(words) >= size, F.transform(starts, lambda i: F.xxhash64(*run(i))))
    return let(
        F.coalesce(found, F.array().cast("array<bigint>")),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )


def text_counts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, group (language or ``other``), base counts, and the two histograms."""
    common = F.col("lang").isin(*COMMON_WORDS) if "lang" in docs.columns else F.lit(False)
    group = F.when(common, F.col("lang")).otherwise("other") if "lang" in docs.columns else F.lit("other")
    text = F.col("text")
    words = let(split_words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        _repeat_words(w).cast("long").alias("n_repeat_words"),
        _word_counts(w).alias("common"),
    ))
    lines = let(
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    )
    rows = docs.select(F.col("doc_id"), group.alias("group"), text_of().alias("text"))
    return rows.select(
        "doc_id", "group", words.alias("w"), lines.alias("n_dup_lines"), _char_counts(text).alias("chars")
    ).select("doc_id", "group", "w.*", "n_dup_lines", F.col("chars")[SYMBOLS].alias("n_symbols"), "chars")


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms; null if either is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def measured(n: Column) -> Column:
        terms = F.zip_with(counts, reference, lambda c, r: let(
            F.struct((c / n["a"]).alias("p"), (r / n["b"]).alias("q")),
            lambda x: part(x["p"], (x["p"] + x["q"]) / 2) + part(x["q"], (x["p"] + x["q"]) / 2),
        ))
        return F.when((n["a"] > 0) & (n["b"] > 0), F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0))))

    return let(F.struct(total(counts).alias("a"), total(reference).alias("b")), measured)


def judge(docs: DataFrame, char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """Counts, distances, ``base_failed`` and ``kept`` per row of ``docs``."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = frozen(text_counts(docs).withColumn("base_failed", failed))
    n_chars, n_common = len(CLASSES) + 1, len({w for ws in COMMON_WORDS.values() for w in ws}) + 1
    sums = lambda name, n: F.array(*[F.sum(F.col(name)[i]).cast("double") for i in range(n)])
    references = rows.filter("not base_failed").groupBy("group").agg(
        sums("chars", n_chars).alias("r_chars"), sums("common", n_common).alias("r_common")
    )
    # One row per listed language and one for all others.
    measured = rows.join(F.broadcast(references), "group", "left").select(
        *rows.columns,
        _distance(F.col("chars"), F.col("r_chars")).alias("char_distance"),
        _distance(F.col("common"), F.col("r_common")).alias("word_distance"),
    )
    far = (
        ((F.col("word_chars") >= CHAR_LEAST) & F.coalesce(F.col("char_distance") > char_limit, F.lit(False)))
        | ((F.col("n_words") >= WORD_LEAST) & F.coalesce(F.col("word_distance") > word_limit, F.lit(False)))
    )
    return measured.withColumn("kept", ~F.col("base_failed") & ~far)


def quality_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts, base verdict and verdict."""
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

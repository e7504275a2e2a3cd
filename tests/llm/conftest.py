import random
import re

import pytest

# Texts that meet the rules' corners: missing, empty, blank, of few words, with odd white space, very long.
ODD_TEXTS = [
    None, "", " ", "\n", "one", "one two", "a\tb\x0bc\x0cd\re  f", "ß É İ K é", "\n a \n\n b ",
    "same same same same same same same same same same same same", "line one here\nline one here\n\n \nline two",
]
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng: random.Random, n: int) -> str:
    syllables = ["ka", "lo", "mi", "ter", "on", "sha", "be", "ru"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Corner texts, plain texts, one very long text, a repeated row, ids missing or given twice, and clashing column names."""
    rng = random.Random(5)
    texts = ODD_TEXTS + [prose(rng, n) for n in (3, 4, 12, 60, 200)] + [prose(rng, 30_000)]
    rows = [(i, t, ["en", "de", None, "xx"][i % 4], ["s1", "s2", None][i % 3]) for i, t in enumerate(texts)]
    rows += [rows[-3], (None, "a text without an id", "en", "s1"), (2, "another text with an id given twice", "en", "s1"), (None, None, None, None)]
    schema = (
        "doc_id long, text string, lang string, source string, row int, text_key string, words string, size string, n int, "
        "position string, name int, `a.b` string, key int, star int, target int, labelled int"
    )
    return spark.createDataFrame([(*r, 1, "k", "w", "s", 2, "p", 3, "x", 4, 5, 6, 7) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")

"""The prefix trie against nested dictionaries."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from listloom.llm import prefixes
from tests.llm.conftest import SPACED

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, family=20):
    """The nodes of all conversations, by comparing all their beginnings."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            held[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in held.items()}
    built = {}
    for c, turns in own.items():
        if not family or c % family == 0:
            built[c] = tuple(turns)
        else:
            h = zlib.crc32(str(c).encode()) % 4
            built[c] = tuple(own.get(c - c % family, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(SPACED.findall(node[-1][1])) if node else 0
        below = [totals[k] for k in children[node]]
        totals[node] = (sum(b[0] for b in below) if below else 1, saved + sum(b[1] for b in below))
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), *totals[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items()
    )


def found(df):
    return sorted(map(tuple, df.collect()))


def conversations(seed, n=160):
    """Few different turns, so that many beginnings are shared; copies, gaps in the ids, long ones, ties, nulls."""
    rng = random.Random(seed)
    turn = lambda: rng.choice([("user", "a b"), ("user", "a"), ("assistant", "a b"), ("", "x y z"), (None, "w\tw"), ("user", None)])
    rows = []
    copied = [turn() for _ in range(3)]
    long = [turn() for _ in range(23)]
    for c in rng.sample(range(-40, 400), n):
        kind = rng.random()
        turns = copied if kind < 0.3 else long[: rng.randint(3, 23)] + [turn() for _ in range(rng.randint(0, 4))] if kind < 0.5 else [turn() for _ in range(rng.randint(1, 9))]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(0, None, "user", "first"), (0, None, "user", "again"), (0, 1, "user", "tie"), (0, 1, "user", "tie"), (None, 0, "user", "none")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("partitions", "family", "depth"), [(1, 20, 4), (3, 20, 64), (7, 0, 5), (50, 20, 4)])
def test_trie_against_plain_dictionaries(spark, partitions, family, depth):
    rows = conversations(partitions + depth)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA), family, depth)) == plain(rows, family)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_conversation_holds_most_turns(spark):
    """A conversation over many partitions and segments, and copies of it that leave it at several places."""
    rng = random.Random(4)
    base = [("user", f"t{rng.randint(0, 5)} x") for _ in range(150)]
    rows = [(20 * k, i, *t) for k in range(4) for i, t in enumerate(base[: 150 - 37 * k])]
    rows += [(100 + c, i, "user", f"u{i} {c % 2}") for c in range(1, 19) for i in range(c % 4)]
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for span in (4096, 3):
            prefixes.SPAN = span
            assert found(prefixes.prefix_trie(spark.createDataFrame(rows, SCHEMA), depth=8)) == plain(rows)
    finally:
        prefixes.SPAN = 4096
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_and_clashing_columns(spark):
    rows = [(1, 0, "user", "one two"), (2, 0, "user", "one two"), (3, 5, None, None)]
    df = spark.createDataFrame([(*r, 9, "p", 1) for r in rows], SCHEMA + ", seg int, path string, depth int")
    assert found(prefixes.prefix_trie(df)) == plain(rows)
    assert prefixes.prefix_trie(df.filter("false")).count() == 0
    only = [(None, 0, "user", "x")]
    assert prefixes.prefix_trie(spark.createDataFrame(only, SCHEMA)).count() == 0


def test_skeleton_is_what_borders_share():
    borders = [{"part": 0, "first": [b"", b"a"], "last": [b"", b"b", b"c"]}, {"part": 2, "first": [b"", b"b", b"d"], "last": [b"k", b"x"]},
               {"part": 5, "first": [b"k", b"x"], "last": [b"k", b"y"]}]
    roots, nodes = prefixes.skeleton_of(borders)
    assert nodes == [(None, 0, b""), (0, 1, b""), (None, 0, b"k"), (2, 1, b"k")]
    assert roots == {b"": (0, {b"b": (1, {})}), b"k": (2, {b"x": (3, {})})}
    assert prefixes.skeleton_of([]) == ({}, [])
    assert re.fullmatch("[0-9a-f]{64}", prefixes.NO_ENDS)

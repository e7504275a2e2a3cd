"""Conversation prefix trie by splitter skeleton.

A conversation is the path of its turns; a node is a distinct run of first turns. Paths are range partitioned and sorted, so that all
members of a node lie next to each other. Where one partition ends and the next begins, the two paths at the border share some first turns: only
the nodes of these shared runs can have members in several partitions. They make up the trie of the splitter paths, the skeleton, which
is broadcast: at most ``DEPTH`` nodes for each border between partitions. Every other node lies in one partition, whose task
finishes it in one pass over its sorted rows, with a stack of the nodes on the open path. Of skeleton nodes a task gives partial
counts, which are reduced by node.

Turns travel as 16-byte hashes of role and text, with the number of words; texts are read once and never shuffled.

Conversations of any length: a path is cut into segments of ``DEPTH`` turns. A segment is filed under a hash of all turns before
it, so the segments of one group hang below one node, and a row never holds more than ``DEPTH`` turns. What a subtree counts beyond the end of a
segment is summed over its members: each node counts for its smallest member once, so a member brings along what it counts for
in its later segments. Long conversations cost a second pass over their later segments, others nothing.

The order of turns, and the first turns that a conversation takes over from the first of its family, are found in one pass over turns
sorted by conversation; a table with one row per partition tells each what came before it. So no conversation, and no first turn that very many
share, is gathered in one task. Only the hash of the ids that end at one node is worked out in one stream, as it is defined on their sorted row; that
stream holds nothing but the state of the hash.

Cases: rows without conv_id belong to no conversation and are left out. Null roles and texts are empty. Null turns come first; turns
of equal number follow in order of their hash, and repeated rows are repeated turns. Of a negative id the family begins at the next lower multiple.
Very long texts count their words where they are read. Other columns are not looked at. An empty table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.llm.text import let_go, ship, split_words, text_of
from listloom.session import frozen

ship(__name__)

# Turns of a segment.
DEPTH = 64
# Conversations of a family, and how many turns of its first one another may take over, and one more.
FAMILY, SHARED = 20, 4
# Segments of one conversation whose running totals are worked out in one task.
SPAN = 4096
# Rows that leave a task at once.
ROWS = 5000
NO_ENDS = hashlib.sha256().hexdigest()

EDGES = (
    "part int, first long, n_first long, last long, n_last long, last_words long, head_id long, heads array<binary>, head_words array<long>"
)
SEGMENTS = "conv_id long, seg long, at long, path array<binary>, words array<long>, words_before long, ends boolean, whole boolean"
FOUND = (
    "kind int, number int, parent_number int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, own long, words long, ends_sha256 string, key binary"
)
NODE, PARTIAL, ENDER, LINK = range(4)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
          "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


# turns to segments


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words) of each turn."""
    role, text = F.coalesce("role", F.lit("")), text_of()
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"),
        F.size(split_words(text)).cast("long").alias("words"),
    )


def _edges(family: int):
    """One row for a partition: its first and last conversation, and the first turns of the last family that begins in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = head_id = None
        n_first = n_last = last_words = 0
        heads: list[bytes] = []
        head_words: list[int] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            if first is None:
                first = int(ids[0])
            n_first += int(np.searchsorted(ids, first, "right"))
            end = int(ids[-1])
            n_last = int(len(ids) - np.searchsorted(ids, end, "left")) + (n_last if end == last else 0)
            last, last_words = end, batch.column(3)[-1].as_py()
            if family and len(leads := np.flatnonzero(ids % family == 0)):
                lead = int(ids[leads[-1]])
                if lead != head_id:
                    head_id, heads, head_words = lead, [], []
                a, b = np.searchsorted(ids, lead, "left"), np.searchsorted(ids, lead, "right")
                some = batch.slice(a, min(b - a, SHARED - 1 - len(heads)))
                heads += some.column(2).to_pylist()
                head_words += some.column(3).to_pylist()
        if first is not None:
            yield _batch(EDGES, [(TaskContext.get().partitionId(), first, n_first, last, n_last, last_words, head_id, heads, head_words)])

    return run


def _carried(edges: list) -> dict[int, tuple]:
    """What each partition has to know: turns of its first conversation before it, the words of the last of them, the open family's head, and
    whether its last conversation goes on."""
    told, head_id, head = {}, None, []
    last, n_last, words = None, 0, 0
    edges = sorted(edges, key=lambda e: e["part"])
    for k, e in enumerate(edges):
        goes_on = k + 1 < len(edges) and edges[k + 1]["first"] == e["last"]
        before = n_last if e["first"] == last else 0
        told[e["part"]] = (before, words, head_id, list(head), goes_on)
        if e["head_id"] is not None:
            own = list(zip(map(bytes, e["heads"]), e["head_words"], strict=True))
            head = (head + own)[: SHARED - 1] if e["head_id"] == head_id else own
            head_id = e["head_id"]
        n_last = e["n_last"] + (before if e["first"] == e["last"] else 0)
        last, words = e["last"], e["last_words"]
    return told


def _rebuilt(told: dict[int, tuple], family: int, depth: int):
    """Segments of rebuilt conversations. What lies at the edge of a partition is given in parts that are not ``whole``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        before, words_before, head_id, head, goes_on = told.get(TaskContext.get().partitionId(), (0, 0, None, [], False))
        conv, own, skip, at = None, 0, 0, 0
        turns: list[tuple[bytes, int]] = []
        rows: list[tuple] = []

        def give(ends: bool) -> None:
            nonlocal at, turns, words_before
            whole = at % depth == 0 and (ends or len(turns) == depth)
            rows.append((conv, at // depth, at, [t[0] for t in turns], [t[1] for t in turns], words_before if at else 0, ends, whole))
            at += len(turns)
            if turns:
                words_before = turns[-1][1]
            turns = []

        for batch in batches:
            for c, digest, words in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if c != conv:
                    if conv is not None:
                        give(True)
                        before = 0
                    conv, own, skip, turns = c, before, 0, []
                    if family and c % family == 0:
                        if c != head_id:
                            head_id, head = c, []
                    elif family:
                        skip = zlib.crc32(str(c).encode()) % SHARED
                        turns = head[:skip] if c - c % family == head_id else []
                    # Turns before this partition have been given there.
                    at = len(turns) + max(own - skip, 0) if own else 0
                    turns = [] if own else list(turns)
                if c == head_id and own < SHARED - 1 and len(head) < SHARED - 1:
                    head.append((digest, words))
                if own >= skip:
                    turns.append((digest, words))
                    if (at + len(turns)) % depth == 0:
                        give(False)
                own += 1
            if len(rows) >= ROWS:
                yield _batch(SEGMENTS, rows)
                rows = []
        if conv is not None and not goes_on:
            give(True)
        elif turns:
            give(False)
        yield _batch(SEGMENTS, rows)

    return run


def segments_of(conversations: DataFrame, family: int, depth: int) -> DataFrame:
    """(conv_id, seg, path, words, words_before, ends): the segments of all conversations.

    The last segment of a conversation ``ends`` it; it may be empty.
    """
    ordered = frozen(turns_of(conversations).orderBy("conv_id", "turn", "digest"))
    # One row per partition.
    told = _carried(ordered.mapInArrow(_edges(family), EDGES).collect())
    parts = frozen(ordered.mapInArrow(_rebuilt(told, family, depth), SEGMENTS))
    # At most two rows a partition are not whole.
    sorted_ = F.array_sort(F.collect_list(F.struct("at", "path", "words", "words_before", "ends")))
    joined = parts.filter("NOT whole").groupBy("conv_id", "seg").agg(sorted_.alias("p")).select(
        "conv_id", "seg", F.flatten("p.path").alias("path"), F.flatten("p.words").alias("words"),
        F.col("p")[0]["words_before"].alias("words_before"), F.array_contains("p.ends", True).alias("ends"),
    )
    return parts.filter("whole").select(*joined.columns).unionByName(joined)


# long conversations


def _earlier(rows: DataFrame, agg: Callable[[str], Column], both: Callable[[Column, Column], Column], *names: str) -> DataFrame:
    """Add ``before_x`` for each column x: its total over the earlier segments of the conversation.

    In two steps, so that no conversation's segments meet in one task.
    """
    rows = rows.withColumn("_span", F.floor(F.col("seg") / SPAN))
    spans = rows.groupBy("conv_id", "_span").agg(*[agg(n).alias(n) for n in names])
    before = W.partitionBy("conv_id").orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select("conv_id", "_span", *[agg(n).over(before).alias(f"_{n}") for n in names])
    inside = W.partitionBy("conv_id", "_span").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.join(spans, ["conv_id", "_span"])
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    totals = {f"before_{n}": both(zero(agg(n).over(inside)), zero(F.col(f"_{n}"))) for n in names}
    return rows.withColumns(totals).drop("_span", *[f"_{n}" for n in names])


def _key(seg: Column, *hashes: Column) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in (seg, *hashes)]))


def filed(segments: DataFrame) -> DataFrame:
    """Segments with the ``key`` they are filed under and the ``next`` one's; first ones have an empty key."""
    xor = lambda x, y: x.bitwiseXOR(y)
    rows = segments.filter("seg > 0 OR NOT ends")
    for name, seed in (("x", 1), ("y", 2)):
        rows = rows.withColumn(name, F.when(F.col("ends"), F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), "seg", "path")))
    rows = _earlier(rows, F.bit_xor, xor, "x", "y")
    key = F.when(F.col("seg") == 0, F.unhex(F.lit(""))).otherwise(_key(F.col("seg"), F.col("before_x"), F.col("before_y")))
    following = _key(F.col("seg") + 1, xor(F.col("before_x"), F.col("x")), xor(F.col("before_y"), F.col("y")))
    return rows.select(*segments.columns, key.alias("key"), F.when(~F.col("ends"), following).alias("next"))


# the trie


class _Node:
    """A node on the open path of a shard."""

    __slots__ = ("children", "conv", "held", "key", "leaves", "n", "saved", "sha", "skeleton", "words")

    def __init__(self, words: int, skeleton: tuple[int, dict] | None):
        self.words, self.skeleton = words, skeleton
        self.n = self.children = self.leaves = self.saved = 0
        self.conv = self.sha = self.key = None
        # Rows of finished children; they lack the smallest member of this node until it is finished.
        self.held: list[list] = []


def _shard(skeleton, depth: int):
    """Rows in order of path and conversation; ``skeleton`` is the broadcast trie {turn: (number, children)}."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = skeleton.value
        stack: list[_Node] = []
        path: list[bytes] = []
        seg = 0
        out: list[tuple] = []

        def close() -> None:
            node = stack.pop()
            local, parent = len(stack), stack[-1] if stack else None
            # The last turn of a full segment is the root of the next one: here it only stands for what comes after it.
            port = local == depth
            own = 0 if port else (node.n - 1) * node.words
            if node.skeleton is None:
                if not port:
                    node.leaves += node.children == 0
                    node.saved += own
                for row in node.held:
                    row[5] = node.conv
                    out.append(tuple(row))
                key = node.key if port else path[0] if not local and seg else None
                ends = node.sha.hexdigest() if node.sha else NO_ENDS
                row = [
                    LINK if port else NODE, None, None, node.conv, seg * depth + local, None, node.n, node.children, node.leaves, node.saved, own,
                    node.words, ends, key,
                ]
                if parent is not None and parent.skeleton is None:
                    parent.held.append(row)
                else:
                    row[2] = parent.skeleton[0] if parent is not None else None
                    out.append(tuple(row))
                if parent is not None:
                    parent.children += 1
            else:
                out.append((
                    PARTIAL, node.skeleton[0], None, node.conv, None, None, node.n, node.children, node.leaves, node.saved, None,
                    node.words, None, node.key,
                ))
            if parent is not None:
                parent.leaves += node.leaves
                parent.saved += node.saved

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                turns, conv, number, words, ends, following, more_leaves, more_saved = row
                same = 0
                for x, y in zip(path, turns, strict=False):
                    if x != y:
                        break
                    same += 1
                while len(stack) > same:
                    close()
                path, seg = turns, number
                for j in range(same, len(turns)):
                    known = stack[-1].skeleton if stack else (None, roots)
                    stack.append(_Node(words[j], known[1].get(turns[j]) if known else None))
                for node in stack:
                    node.n += 1
                    if node.conv is None or conv < node.conv:
                        node.conv = conv
                last = stack[-1]
                if not ends:
                    last.key = following
                    last.leaves += more_leaves
                    last.saved += more_saved
                elif last.skeleton:
                    out.append((ENDER, last.skeleton[0], None, conv, *[None] * 10))
                elif last.sha is None:
                    last.sha = hashlib.sha256(str(conv).encode())
                else:
                    last.sha.update(f",{conv}".encode())
                if len(out) >= ROWS:
                    yield _batch(FOUND, out)
                    out.clear()
        while stack:
            close()
        yield _batch(FOUND, out)

    return run


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last path of a partition."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = batch.column(0)[0].as_py() if first is None else first
            last = batch.column(0)[-1].as_py()
    if first is not None:
        yield _batch("part int, first array<binary>, last array<binary>", [(TaskContext.get().partitionId(), first, last)])


def skeleton_of(borders: list) -> tuple[dict, list[tuple[int | None, int, bytes]]]:
    """The trie of what neighbouring border paths share, and (parent, local depth, key of the segment) of its nodes by number."""
    roots: dict[bytes, tuple[int, dict]] = {}
    nodes: list[tuple[int | None, int, bytes]] = []
    for a, b in pairwise(sorted(borders, key=lambda e: e["part"])):
        level, parent = roots, None
        for local, (x, y) in enumerate(zip(map(bytes, a["last"]), map(bytes, b["first"]), strict=False)):
            if x != y:
                break
            if x not in level:
                level[x] = (len(nodes), {})
                nodes.append((parent, local, bytes(a["last"][0])))
            parent, level = level[x]
    return roots, nodes


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(number, ends_sha256) from rows in order of number and conversation."""
    held, digest = None, None
    for batch in batches:
        done = []
        for number, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if number == held:
                digest.update(f",{conv}".encode())
            else:
                if held is not None:
                    done.append((held, digest.hexdigest()))
                held, digest = number, hashlib.sha256(str(conv).encode())
        yield _batch("number int, ends_sha256 string", done)
    if held is not None:
        yield _batch("number int, ends_sha256 string", [(held, digest.hexdigest())])


def _reduced(found: DataFrame, nodes: list[tuple[int | None, int, bytes]], depth: int) -> list[tuple]:
    """Rows of the skeleton's nodes: the partial counts of all shards, and what skeleton nodes below add."""
    sums = found.filter(F.col("kind") == PARTIAL).groupBy("number").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("words").alias("words"), F.max("key").alias("key"),
    )
    # At most DEPTH + 1 rows for each border between partitions.
    got = {r["number"]: r for r in sums.collect()}
    below = [0] * len(nodes)
    for parent, _, _ in nodes:
        if parent is not None:
            below[parent] += 1
    leaves, saved, rows = [0] * len(nodes), [0] * len(nodes), []
    for number in range(len(nodes) - 1, -1, -1):
        (parent, local, key), r = nodes[number], got[number]
        port = local == depth
        children = r["n_children"] + below[number]
        own = 0 if port else (r["n_convs"] - 1) * r["words"]
        leaves[number] += not port and children == 0
        saved[number] += own
        if parent is not None:
            leaves[parent] += leaves[number]
            saved[parent] += saved[number]
        seg = int.from_bytes(key[:8], "big")
        rows.append((
            LINK if port else NODE, number, parent, r["conv_id"], seg * depth + local, None if parent is None else got[parent]["conv_id"], r["n_convs"],
            children, r["n_leaves"] + leaves[number], r["saved_tokens"] + saved[number], own, r["words"], None,
            bytes(r["key"]) if port else key if seg and not local else None,
        ))
    return rows


def _nodes(rows: DataFrame, depth: int) -> DataFrame:
    """All nodes of the segments ``rows`` (path, conv_id, seg, words, ends, next, more_leaves, more_saved).

    The path begins with the key of the segment, the words with those of the turn before it.
    """
    spark = rows.sparkSession
    ordered = frozen(rows.orderBy("path", "conv_id"))
    borders = ordered.select("path").mapInArrow(_borders, "part int, first array<binary>, last array<binary>").collect()
    roots, nodes = skeleton_of(borders)
    found = frozen(ordered.mapInArrow(_shard(spark.sparkContext.broadcast(roots), depth), FOUND))
    if not nodes:
        done = found
    else:
        reduced = _reduced(found, nodes, depth)
        joints = spark.createDataFrame(reduced, FOUND)
        enders = found.filter(F.col("kind") == ENDER).select("number", "conv_id").repartition("number").sortWithinPartitions("number", "conv_id")
        ends = enders.mapInArrow(_hash_ends, "number int, ends_sha256 string")
        joints = joints.drop("ends_sha256").join(ends, "number", "left").fillna({"ends_sha256": NO_ENDS}).select(*found.columns)
        # One row for each skeleton node, as many as were broadcast before.
        parents = F.broadcast(spark.createDataFrame([(r[1], r[3]) for r in reduced], "_n int, _c long"))
        done = found.filter(F.col("kind").isin(NODE, LINK)).join(parents, F.col("parent_number") == F.col("_n"), "left")
        done = done.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_c")).drop("_n", "_c").unionByName(joints)
    return done


def prefix_trie(conversations: DataFrame, family: int = FAMILY, depth: int = DEPTH) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``family`` conversations each share first turns as the module's text tells; 0 leaves all as they are. ``depth`` is
    ``SHARED`` at least.
    """
    segments = frozen(segments_of(conversations, family, depth))
    nothing = {"more_leaves": F.lit(0).cast("long"), "more_saved": F.lit(0).cast("long")}
    rows = segments.filter("seg = 0 AND ends").withColumns({"key": F.unhex(F.lit("")), "next": F.lit(None).cast("binary"), **nothing})
    is_long = not segments.filter("seg > 0").isEmpty()
    shape = lambda df: df.select(
        F.concat(F.array("key"), "path").alias("path"), "conv_id", "seg", F.concat(F.array("words_before"), "words").alias("words"),
        "ends", "next", "more_leaves", "more_saved",
    )
    if is_long:
        cut = frozen(filed(segments))
        later = _nodes(shape(cut.filter("seg > 0").withColumns(nothing)), depth).filter(F.col("kind") == NODE)
        counts = later.groupBy("conv_id", F.floor(F.col("depth") / depth).alias("seg")).agg(
            F.count_if(F.col("n_children") == 0).alias("l"), F.sum("own").alias("s")
        )
        held = cut.select("conv_id", "seg").join(counts, ["conv_id", "seg"], "left").fillna(0, ["l", "s"])
        before = _earlier(held, F.sum, lambda x, y: x + y, "l", "s")
        whole = held.groupBy("conv_id").agg(F.sum("l").alias("all_l"), F.sum("s").alias("all_s"))
        # What all later segments count: the total without this one and those before it.
        spans = whole.join(cut.groupBy("conv_id").agg(F.max("seg").alias("top")), "conv_id")
        spans = spans.select("conv_id", "all_l", "all_s", F.explode(F.sequence(F.lit(0).cast("long"), "top")).alias("seg"))
        beyond = before.join(spans, ["conv_id", "seg"]).select(
            "conv_id", "seg", (F.col("all_l") - F.col("l") - F.col("before_l")).alias("more_leaves"),
            (F.col("all_s") - F.col("s") - F.col("before_s")).alias("more_saved"),
        )
        rows = rows.unionByName(cut.join(beyond, ["conv_id", "seg"]).select(*rows.columns))
    found = _nodes(shape(rows), depth)
    nodes = found.filter(F.col("kind") == NODE)
    if is_long:
        found = frozen(found)
        links = found.filter(F.col("kind") == LINK).select(F.col("key").alias("_k"), F.col("parent_conv_id").alias("_p")).distinct()
        nodes = found.filter(F.col("kind") == NODE)
        tops = nodes.filter("key IS NOT NULL").join(links, F.col("key") == F.col("_k")).withColumn("parent_conv_id", F.col("_p"))
        nodes = nodes.filter("key IS NULL").unionByName(tops.drop("_k", "_p"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

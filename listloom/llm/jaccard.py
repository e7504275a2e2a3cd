"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

Two texts link if the sets of their 4-word shingles have a Jaccard similarity
of at least ``TOP / 100``. Small ("light") sets list all their subsets that a
partner may share: a partner of a set of s shingles shares at least 85 % of them, so the subsets
that leave out few enough are all it takes, and one of them is the same in both.
Large ("heavy") sets would have far too many. Their shingles are dealt into parts by a hash: if
two sets differ in at most d shingles, then of d + 3 parts three at least are the
same, and each part is a key of an inverted list. A part is a fixed-size
subset as well, and so a list holds texts that share several shingles at once. Lists of single shingles
would be as long as the number of texts that share a common passage. A part without shingles is no key, as sets that have nothing
in common share it. There are so many parts that a large set has fewer empty ones than two linked sets have parts in
common; where a set has as many, three empty parts together are a key.
Where light ends is chosen by cost: from the number of sets of each size, the keys that subsets
would make are weighed against the keys of parts, each of which is scanned.

Lists are read in order, and their members placed around the one of them that has most company: of copies with changes, the least
changed one. Pairs whose sketches differ in more bits than linked sets may in elements are no links. Each other set is
first verified, by the words of the texts, against one such centre; verified links are contracted into
components. What is around one centre and still in another component is then compared as well, first with the centre, then with
each other by sketches in blocks, so that no link between components is lost. Pairs inside one component are never made, and pairs become rows only if
their sketches allow a link. Sets of equal shingles are one set from the start.

Keys are 64-bit hashes, and a set is named by a 64-bit hash of its shingles' hashes.

Cases: null and empty texts have an empty set, link with nothing, and are their own component. A text of fewer than
four words is one shingle. Rows that repeat an id, or have none, are judged by their texts; a
component's id is its smallest id that is not null. An empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import comb, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.llm.components import components
from listloom.llm.lists import stars
from listloom.llm.text import SPACES, byte_sizes, let, lots, lowered, packed, ship, split_words, text_of, tidy, written
from listloom.session import frozen

ship(__name__)

SIZE = 4
TOP = 85
# Parts that may be empty without being keys, one less than are the same in two linked sets; bands of many parts have more of both.
SLACK = 2
# From this many parts on a band's slack grows, and is past what is likely by this many standard deviations.
FEW_PARTS, SURE = 200, 6
# A key of a part is scanned with others in its list; one of a subset is right at once.
SCAN_COST = 4
# Light sets are sought up to this size at most: beyond it, subsets are past all bounds.
LIGHT_MOST = 40
# Texts, and bytes of texts, that a task handles at once.
TEXTS, BYTES = 500, 1 << 18
# Pairs of one star that are compared in one task.
STAR = 500
# Rows with sketches that a task looks at together.
ROWS = 1000
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# The same for bytes of UTF-8, and which of them separate words.
LOW_BYTES = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64)
SPACE_BYTES = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
# Rows on each side that are compared at once.
CELL_ROWS = 1024
# Bits of a sketch, and 64-bit words of it that are compared first.
SKETCH, FIRST = 4096, 8
# Bits of the filter that tells which sets may be in a pair.
FILTER_BITS = 1 << 24


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    shifted = x >> np.uint64(30)
    x ^= shifted
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=shifted)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=shifted)
    return x


def _mix_one(x: int) -> int:
    """``_mix`` of one number."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 27) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return x ^ x >> 31


def _odd(n: int) -> np.uint64:
    """The n-th of a row of unrelated odd numbers. Multiples of one number would let sums of products meet."""
    return np.uint64(_mix_one((n + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) | 1)


def most_left_out(size: int) -> int:
    """How many elements of a set may be missing from a partner."""
    return size * (100 - TOP) // 100


def most_different(a: int, b: int) -> int:
    """How many elements may be in one of two linked sets only."""
    return (a + b) * (100 - TOP) // (100 + TOP)


def _band_edges() -> list[int]:
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] * 100 // TOP + 1, edges[-1] * 138 // 100))
    return edges


# Smallest size of each band; the sizes of linked sets lie in the same band or in neighbouring ones.
BAND_EDGES = _band_edges()


def _band_slack(band: int) -> int:
    """How many of a band's parts may be empty without being keys."""
    least, changed = BAND_EDGES[band] * TOP // 100, most_different(BAND_EDGES[band + 1] - 1, BAND_EDGES[band + 1] - 1)
    slack = SLACK
    # More parts are more empty ones; a few rounds settle that.
    for _ in range(20 if changed + 1 + SLACK > FEW_PARTS else 0):
        parts = changed + 1 + slack
        empty = parts * exp(-least / parts)
        slack = SLACK + int(empty + SURE * sqrt(empty))
    return slack


BAND_SLACK = [_band_slack(b) for b in range(len(BAND_EDGES) - 1)]


def bands_of(size: int) -> list[tuple[int, int]]:
    """(band, parts) under which a set is listed: its own band, and the next if a partner may be there."""
    own = bisect_right(BAND_EDGES, size) - 1
    bands = [own] + ([own + 1] if size * 100 // TOP >= BAND_EDGES[own + 1] else [])
    return [(b, most_different(BAND_EDGES[b + 1] - 1, BAND_EDGES[b + 1] - 1) + 1 + BAND_SLACK[b]) for b in bands]


def subset_count(size: int) -> int:
    return sum(comb(size, a) for a in range(most_left_out(size) + 1))


def boundary(counts: dict[int, int]) -> int:
    """The largest light size at which all keys together cost least; ``counts``: sets by size."""
    def cost(b: int) -> int:
        light = sum(n * subset_count(s) for s, n in counts.items() if s <= b)
        return light + sum(n * SCAN_COST * sum(m for _, m in bands_of(s)) for s, n in counts.items() if is_heavy(s, b))

    return min(range(LIGHT_MOST + 1), key=lambda b: (cost(b), b))


def is_heavy(size: int, b: int) -> bool:
    """Whether a set is listed by parts: it is large, or may link with a large one."""
    return size * 100 // TOP > b


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of texts that are not null, and where each text's words begin and the last one's end.

    A word's hash is mixed from the sum of its bytes' hashes, each taken with the byte's place in the word.
    """
    nothing = np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    if not len(texts):
        return nothing
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if offsets[0] == offsets[-1]:
        return nothing
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    inside = ~SPACE_BYTES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return nothing
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    hashes = _mix((place.view(np.uint64) << np.uint64(8) | LOW_BYTES[data[starts[0] :]]) ^ _odd(13))
    hashes *= inside[starts[0] :]
    return _mix(np.add.reduceat(hashes, starts - starts[0]) ^ _odd(14)), np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text."""
    values, offsets = hashed_words(texts)
    m = [_odd(i) for i in range(1, SIZE + 1)]
    rolled = np.zeros(0, np.uint64)
    if len(values) >= SIZE:
        rolled = sum(values[i : len(values) - SIZE + 1 + i] * m[i] for i in range(SIZE))
        rolled = _mix(rolled)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= SIZE:
            own = np.sort(rolled[a : b - SIZE + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            short = values[a:b]
            yield _mix(np.array([sum((int(x) * int(_odd(90 + 10 * (b - a) + i)) for i, x in enumerate(short.tolist()))) & 0xFFFFFFFFFFFFFFFF], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def set_name(s: np.ndarray) -> int:
    total = int(_mix(s ^ _odd(7)).sum(dtype=np.uint64)) + _mix_one(len(s) ^ int(_odd(8)))
    name = _mix_one(total & 0xFFFFFFFFFFFFFFFF)
    return name - (1 << 64) if name >> 63 else name


def part_keys(s: np.ndarray) -> np.ndarray:
    """Keys of a heavy set's parts; where more parts are empty than the slack, each three of them are a key as well."""
    out = []
    mixed = _mix(s ^ _odd(9))
    for band, parts in bands_of(len(s)):
        part = (_mix(s * _odd(100 + band)) >> np.uint64(11)) % np.uint64(parts)
        # Numbers of 16 bits are sorted in linear time.
        order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
        part = part[order]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums = np.add.reduceat(mixed[order], starts)
        held = part[starts]
        out.append(_mix(sums + _mix((held + np.uint64(1)) * _odd(200 + band))))
        if parts - len(held) > BAND_SLACK[band]:
            empty = _mix((np.setdiff1d(np.arange(parts, dtype=np.uint64), held) + np.uint64(1)) * _odd(300 + band))
            # Row by row of the first of three, so that no table of all places is held.
            for i in range(len(empty) - 2):
                j, k = np.triu_indices(len(empty) - 1 - i, 1)
                out.append(_mix(empty[i] + empty[i + 1 :][j] + empty[i + 1 :][k]))
    return np.concatenate(out)


def sketch_of(s: np.ndarray) -> np.ndarray:
    """One bit for each hash slot: whether the set holds an odd number of elements there.

    An element that is in one of two sets only flips one bit, so two sketches differ in no more bits than
    the sets do in elements.
    """
    odd = np.bincount((_mix(s ^ _odd(12)) >> np.uint64(52)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(column: pa.Array) -> np.ndarray:
    """The sketches of a column as rows of ``SKETCH / 64`` numbers, without a copy; each is filled."""
    bits = np.frombuffer(column.buffers()[2], np.uint64) if len(column) else np.zeros(0, np.uint64)
    width = SKETCH // 64
    return bits.reshape(-1, width)[column.offset : column.offset + len(column)]


def subset_keys(s: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(left out, keys) of a light set's subsets."""
    mixed = _mix(s ^ _odd(10))
    total = mixed.sum(dtype=np.uint64)
    out = []
    for a in range(most_left_out(len(s)) + 1):
        left = np.array(list(combinations(range(len(s)), a)), dtype=np.int64).reshape(comb(len(s), a), a)
        sums = total - mixed[left].sum(axis=1, dtype=np.uint64)
        out.append((a, _mix(sums + _mix(np.array([len(s) - a], np.uint64) ^ _odd(11)))))
    return out


def _signed(light: int):
    """doc_id, text_key, n_shingles, name, and, for the first copy in a batch only, the set's keys, their ranks and its sketch."""

    def run(batches):
        seen: set[int] = set()
        for batch, start in ((b.slice(x, y - x), x) for b in batches for x, y in lots(byte_sizes(b.column(2)), TEXTS, BYTES)):
            sizes, names, keys, ranks, made_sketches = [], [], [], [], []
            if not start:
                seen.clear()
            for s in shingle_sets(batch.column(2)):
                name = set_name(s) if len(s) else None
                sizes.append(len(s))
                names.append(name)
                made = []
                if name is not None and name not in seen:
                    seen.add(name)
                    made = subset_keys(s) if len(s) <= light else []
                    if is_heavy(len(s), light):
                        made.append((0, part_keys(s)))
                    made_sketches.append(sketch_of(s).tobytes())
                else:
                    made_sketches.append(None)
                keys.append(np.concatenate([k for _, k in made]) if made else np.zeros(0, np.uint64))
                ranks.append(np.concatenate([np.full(len(k), r, np.int8) for r, k in made]) if made else np.zeros(0, np.int8))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            listed = lambda at, parts, kind: pa.ListArray.from_arrays(at, pa.array(np.concatenate(parts).view(kind)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()),
                 listed(offsets, keys, np.int64), listed(offsets, ranks, np.int8), pa.array(made_sketches, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "name", "keys", "ranks", "sketch"],
            )

    return run


def word_hashes(text) -> F.Column:
    return let(split_words(lowered(text), SPACES), lambda w: F.transform(w, lambda x: F.xxhash64(x)))


def _text_set(text: str) -> set[str] | set[tuple[str, ...]]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return {tuple(words[i : i + SIZE]) for i in range(max(len(words) - SIZE + 1, 1))} if words else set()


def _compare(batches):
    """Rows in order of star; the centre's row comes first in each."""
    star, centre, middle = None, None, 0
    for batch in batches:
        a, b = [], []
        for key, is_centre, name, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if is_centre:
                if key != star:
                    star, centre, middle = key, _text_set(text), name
            elif key == star:
                own = _text_set(text)
                both = len(own & centre)
                if 100 * both >= TOP * (len(own) + len(centre) - both):
                    a.append(middle)
                    b.append(name)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def centres(lists: DataFrame) -> DataFrame:
    """(centre, name, weight): the members of each list around the one of them that is in most lists; the centre is one of them.

    Of texts that were copied and changed, the least changed one shares most parts with the others. A long list was read in several
    pieces, each with a pivot; its members meet their centre piece by piece.
    """
    members = lists.select("key", "pivot", F.col("member").alias("name"))
    weights = members.groupBy("name").agg(F.count("*").alias("weight"))
    weighed = members.join(weights, "name")
    pieces = written(weighed.groupBy("key", "pivot").agg(F.max(F.struct("weight", "name")).alias("c")), "pieces")
    whole = pieces.groupBy("key").agg(F.max("c").alias("c"))
    chosen = pieces.select("key", "pivot").join(whole, "key")
    return members.join(chosen, ["key", "pivot"]).select(F.col("c.name").alias("centre"), "name", F.col("c.weight").alias("weight")).distinct()


def _allowed(sizes, other_sizes, flips):
    """Whether sets of these sizes, whose sketches differ in so many bits, may link."""
    near = flips <= (sizes + other_sizes) * (100 - TOP) // (100 + TOP)
    return near & (100 * np.minimum(sizes, other_sizes) >= TOP * np.maximum(sizes, other_sizes))


def _flips_allowed(sizes, bits, a, b):
    """Whether the sets at places a may link with those at places b, by all of their sketches."""
    return _allowed(sizes[a], sizes[b], np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64))


PAIRS = "a long, b long, weight long, h_a long, h_b long"


def _meet(batches):
    """Rows in order of star, the centre's row first in each; pairs of the centre and each other set that may link to it."""
    names = [f.split()[0] for f in PAIRS.split(", ")]
    held = None
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            star, name, size, weight, holder = (batch.column(i).to_numpy() for i in (0, 2, 3, 4, 5))
            is_centre = batch.column(1).to_numpy(zero_copy_only=False)
            bits = sketches(batch.column(6))
            if held is not None:
                # The centre of the last star goes on in front of the first rows.
                star, name, size, weight, holder = (np.concatenate([h, x]) for h, x in zip(held[:5], (star, name, size, weight, holder), strict=True))
                is_centre, bits = np.concatenate([[True], is_centre]), np.concatenate([held[5], bits])
            place = np.maximum.accumulate(np.where(is_centre, np.arange(len(star)), -1))
            rest = np.flatnonzero(~is_centre & (place >= 0))
            rest = rest[star[rest] == star[place[rest]]]
            middle = place[rest]
            near = _flips_allowed(size, bits, rest, middle)
            rest, middle = rest[near], middle[near]
            columns = [name[middle], name[rest], weight[rest], holder[middle], holder[rest]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            if place[-1] >= 0:
                last = slice(place[-1], place[-1] + 1)
                held = (star[last].copy(), name[last].copy(), size[last].copy(), weight[last].copy(), holder[last].copy(), bits[last].copy())


def star_pairs(around: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b, weight, h_a, h_b) of a centre and a set around it whose sizes and sketches do not rule out a link.

    Each set goes to its stars with its sketch; a star of more than ``STAR`` sets is dealt to several tasks, each with a copy of its
    centre. The holders h_a and h_b name one text that holds each set.
    """
    # Written once, so that a hot centre can be split in the join by its size.
    large = frozen(around.groupBy("centre").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("long").alias("shares")).filter("shares > 1"))
    rows = around.join(sets.select("name", "size", "holder", "sketch"), "name").join(large, "centre", "left")
    shares = F.coalesce("shares", F.lit(1).cast("long"))
    is_centre = F.col("centre") == F.col("name")
    all_shares = F.sequence(F.lit(0).cast("long"), shares - 1)
    share = F.explode(F.when(is_centre, all_shares).otherwise(F.array(F.call_function("pmod", F.xxhash64("name"), shares))))
    rows = rows.select("centre", "name", "size", "weight", "holder", "sketch", is_centre.alias("is_centre"), share.alias("share"))
    rows = rows.select(F.xxhash64("centre", "share").alias("star"), "is_centre", "name", "size", "weight", "holder", "sketch")
    ordered = rows.repartition("star").sortWithinPartitions("star", F.col("is_centre").desc())
    return ordered.mapInArrow(tidy(_meet), PAIRS)


def _cells(batches):
    """Pairs of a cell's left and right rows that are in different components and may link; rows are in order of cell."""
    held, parts = None, []

    def compared():
        """The pairs of the held cell."""
        is_left, name, component, size, holder, bits = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0)] * 6
        found: list[list[np.ndarray]] = [[], [], [], []]
        lefts, rights = np.flatnonzero(is_left), np.flatnonzero(is_left == 0)
        begun = np.ascontiguousarray(bits[rights, :FIRST]) if parts else None
        for at in range(0, len(lefts) if len(rights) else 0, 32):
            i = lefts[at : at + 32]
            # Most pairs differ too much in the first words of their sketches already.
            flips = np.bitwise_count(bits[i][:, None, :FIRST] ^ begun[None]).sum(axis=2, dtype=np.int64)
            near = _allowed(size[i][:, None], size[rights][None], flips) & (component[i][:, None] != component[rights][None])
            x, y = np.nonzero(near)
            kept = [_flips_allowed(size, bits, i[x[k : k + CELL_ROWS]], rights[y[k : k + CELL_ROWS]]) for k in range(0, len(x), CELL_ROWS)]
            kept = np.concatenate(kept) if kept else np.zeros(0, bool)
            x, y = x[kept], y[kept]
            for held_, values in zip(found, (name[i[x]], name[rights[y]], holder[i[x]], holder[rights[y]]), strict=True):
                held_.append(values)
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "h_a", "h_b"])

    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            cell = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            is_left = batch.column(2).to_numpy(zero_copy_only=False)
            name, component, size, holder = (batch.column(i).to_numpy() for i in (3, 4, 5, 6))
            bits = sketches(batch.column(7))
            ends = np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1
            for x, y in zip([0, *ends.tolist()], [*ends.tolist(), batch.num_rows], strict=True):
                here = (int(cell[0, x]), int(cell[1, x]))
                if here != held:
                    if parts:
                        yield compared()
                    held, parts = here, []
                parts.append(tuple(c[x:y].copy() for c in (is_left, name, component, size, holder, bits)))
    yield compared()


def near_pairs(around: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b, h_a, h_b) around one centre that may link but are in different components yet.

    All that is not in a centre's largest component is compared with all around that centre, by sketches, in
    cells of ``CELL_ROWS`` by ``CELL_ROWS`` rows. Only pairs that pass become rows.
    """
    rows = around.join(labels, "name", "left").withColumn("component", F.coalesce("component", "name"))
    counts = rows.groupBy("centre", "component").agg(F.count("*").alias("n")).groupBy("centre").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top")
    )
    # A centre with one other set is one pair, which is verified.
    # Written once, so that a hot centre can be split in the join by its size.
    open_ = frozen(counts.filter("top.n < n and n > 2").select(
        "centre", F.col("top.component").alias("top"),
        F.ceil(F.col("n") / CELL_ROWS).cast("long").alias("across"), F.ceil((F.col("n") - F.col("top.n")) / CELL_ROWS).cast("long").alias("down"),
    ))
    rows = rows.join(open_, "centre").join(sets.select("name", "size", "holder", "sketch"), "name")
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    deal = lambda n: F.call_function("pmod", F.xxhash64("name"), n)
    left = rows.filter("component <> top").withColumn("is_left", F.lit(True)).withColumn(
        "cell", F.explode(F.transform(numbers(F.col("across")), lambda j: deal(F.col("down")) * F.col("across") + j))
    )
    right = rows.withColumn("is_left", F.lit(False)).withColumn(
        "cell", F.explode(F.transform(numbers(F.col("down")), lambda i: i * F.col("across") + deal(F.col("across"))))
    )
    cells = left.unionByName(right).select(F.col("centre").alias("star"), "cell", "is_left", "name", "component", "size", "holder", "sketch")
    ordered = cells.repartition("star", "cell").sortWithinPartitions("star", "cell")
    return ordered.mapInArrow(tidy(_cells), "a long, b long, h_a long, h_b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, judged by their texts.

    ``texts`` has (doc_id, text_key, text) of all documents; pairs name one text that holds each set (h_a, h_b). Pairs that share
    their a are a star; each text goes to the stars it is in, and the centre's comes first. A star of
    more than ``STAR`` pairs is dealt to several tasks, each with a copy of the centre. A filter of fixed size keeps
    texts that are in no pair from being shuffled.
    """
    stars_ = pairs.groupBy("a", "h_a").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("long").alias("shares"))
    large = stars_.filter("shares > 1").select("a", "shares")
    # Few stars are large, and each of them has more than STAR members.
    members = pairs.join(large, "a", "left").select(
        F.col("h_b").alias("holder"), F.col("b").alias("name"), F.col("a").alias("star"),
        F.call_function("pmod", F.xxhash64("b"), F.coalesce("shares", F.lit(1).cast("long"))).alias("share"), F.lit(False).alias("centre"),
    )
    middles = stars_.select(
        F.col("h_a").alias("holder"), F.col("a").alias("name"), F.col("a").alias("star"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), F.lit(True).alias("centre"),
    )
    places = frozen(members.unionByName(middles))
    slot = F.pmod("holder", F.lit(FILTER_BITS))
    bit = lambda of: F.call_function("shiftleft", F.lit(1).cast("long"), of.bitwiseAND(63).cast("int"))
    held = places.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit(F.col("slot"))).alias("bits"))
    # At most FILTER_BITS / 64 rows.
    some = (
        texts.select(_holder().alias("holder"), "text").withColumn("slot", slot).withColumn("word", F.shiftright("slot", 6))
        .join(F.broadcast(held), "word").filter(F.col("bits").bitwiseAND(bit(F.col("slot"))) != 0).select("holder", "text")
    )
    rows = some.join(places, "holder").select(
        F.xxhash64("star", "share").alias("key"), "centre", "name", "text"
    )
    ordered = rows.repartition("key").sortWithinPartitions("key", F.col("centre").desc(), "name")
    return ordered.mapInArrow(tidy(_compare), "a long, b long")


def _holder() -> F.Column:
    return F.xxhash64("doc_id", "text_key")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, text_key, and ``group``, a number for the component."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), text_of().alias("text"))
    # About how many sets there are of each small size; this only weighs costs.
    most = LIGHT_MOST * 100 // TOP + 1
    # A split ends where a text has too many words to count, so there are few numbers of words.
    words = F.size(F.array_remove(F.split("text", SPACES, most + SIZE + 4), ""))
    counts: Counter[int] = Counter()
    for r in texts.filter(F.length("text") < 100 * LIGHT_MOST).select(words.alias("words")).groupBy("words").count().collect():
        counts[max(r["words"] - SIZE + 1, min(r["words"], 1))] += r["count"]
    light = boundary({n: c for n, c in counts.items() if 1 <= n <= most})

    signed = frozen(
        texts.select("doc_id", "text_key", "text").mapInArrow(
            tidy(_signed(light)),
            "doc_id long, text_key long, n_shingles long, name long, keys array<long>, ranks array<tinyint>, sketch binary",
        )
    )
    thin = signed.select("doc_id", "text_key", "n_shingles", "name")
    # A set's sketch is given with some of its copies only, and is the same in all of them.
    sets = frozen(
        signed.filter("name is not null").groupBy("name").agg(
            F.min("doc_id").alias("own"), F.min(_holder()).alias("holder"), F.min("n_shingles").alias("size"), F.max("sketch").alias("sketch")
        )
    )
    rows = signed.select("name", F.explode(F.arrays_zip("keys", "ranks")).alias("k"))
    lists = stars(rows.select(F.col("k.keys").alias("key"), F.col("k.ranks").cast("int").alias("rank"), F.col("name").alias("member")))
    around = written(centres(lists), "around")

    # Each set with one centre first: most components are found by that.
    pairs = frozen(star_pairs(around, sets))
    best = F.max(F.struct("weight", "a", "h_a", "h_b")).alias("m")
    first = pairs.groupBy("b").agg(best).select(F.col("m.a").alias("a"), "b", F.col("m.h_a").alias("h_a"), F.col("m.h_b").alias("h_b"))
    links = frozen(verified(first, texts))
    labels = components(links)
    # Then what is around one centre and still apart: first with the centre, then with each other.
    for each_other in (False, True):
        named = labels.withColumnRenamed("node", "name")
        if each_other:
            rest = near_pairs(around.select("centre", "name"), named, sets)
        else:
            ends = [named.select(F.col("name").alias(c), F.col("component").alias(f"c_{c}")) for c in "ab"]
            rest = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left").filter(
                F.coalesce("c_a", "a") != F.coalesce("c_b", "b")
            ).select("a", "b", "h_a", "h_b")
        rest = written(rest, "rest")
        if rest.isEmpty():
            continue
        more = frozen(verified(rest, texts))
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(links)

    classes = sets.select("name", "own").join(labels.withColumnRenamed("node", "name"), "name", "left").select(
        "name", "own", F.coalesce("component", "name").alias("group")
    )
    least = classes.groupBy("group").agg(F.min("own").alias("least"))
    classes = classes.join(least, "group").select("name", "group", "least")
    return thin.join(classes, "name", "left").select(
        "doc_id", "n_shingles", F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        "text_key", "group",
    )


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stand for their component: the one with its smallest id.

    Of rows that share that id, the one with the smallest text key stays, once. Rows with an empty set all stay.
    """
    found = jaccard_components(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = found.filter("group is not null").groupBy("group").agg(F.min(order).alias("k")).select("k.doc_id", "k.text_key")
    kept = kept.withColumn("all", F.lit(False)).unionByName(
        found.filter("group is null").select("doc_id", "text_key").distinct().withColumn("all", F.lit(True))
    )
    # Rows meet by one number for id and text, and stay where they met when repeats are taken out.
    rows, kept = (df.withColumn("_key", _holder()) for df in (packed(docs), kept))
    joined = rows.join(kept.select("_key", "all"), "_key")
    once = joined.filter("not all").groupBy("_key", "doc_id", "text_key").agg(F.first("row").alias("row"))
    return once.select("row.*").unionByName(joined.filter("all").select("row.*"))


def jaccard_report(docs: DataFrame) -> DataFrame:
    """One row per document with its component."""
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")

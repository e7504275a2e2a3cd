"""Exact samples, random splits, chunks and packing."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.operators.dedupe import text_order
from listloom.operators.joins import inner_on
from listloom.operators.rank import with_position
from listloom.session import frozen

# Hash buckets are told apart by this many hex digits: 65,536 buckets.
_DIGITS = 4

# Packing works on blocks of about this many files, and composes what so many of them do.
_FILES_PER_BLOCK = 50
_FAN = 16


def seeded_hash(seed: int, *keys: str) -> Column:
    """md5 of seed and key: the same order in every engine and every run."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def _number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def _cut(df: DataFrame, per: list[str], bucket: str, order: Column, few: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split off, bucket by bucket in order, the first ``_room`` rows of each group.

    ``few`` tells that a group has a fixed number of buckets at most.

    Returns the rows of buckets that fit whole, and the rows of the one bucket
    per group that does not, with the room that is left for it.
    """
    counts = df.groupBy(*per, "_room", bucket).agg(F.count(F.lit(1)).alias("_n"))
    if per or few:
        earlier = W.partitionBy(*per).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    else:
        # There may be as many values as rows: no window over all of them.
        counts = with_position(counts, [order], "_before", weight="_n")
    plan = (
        counts.withColumn("_left", F.col("_room") - F.col("_before"))
        .filter("_left > 0")
        .select(*[F.col(c).alias(f"_c_{c}") for c in [*per, bucket]], "_left",
                (F.col("_n") <= F.col("_left")).alias("_fits"))
    )
    same = reduce(
        lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in [*per, bucket]]
    )
    placed = df.join(plan, same, "inner")
    whole = placed.filter("_fits").select(*df.columns)
    split = placed.filter(~F.col("_fits")).withColumn("_room", F.col("_left")).select(*df.columns)
    return whole, split


def _lowest(df: DataFrame, digest: Column, ties: list[str], per: list[str]) -> DataFrame:
    """The first ``_room`` rows of each group by a hex digest."""
    hashed = df.withColumn("_hash", digest)
    hashed = hashed.withColumn("_bucket", _number(F.col("_hash"), _DIGITS))
    whole, split = _cut(hashed, per, "_bucket", F.col("_bucket"), few=True)
    rank = W.partitionBy(*per, "_bucket").orderBy("_hash", *text_order(*ties))
    last = split.withColumn("_rank", F.row_number().over(rank)).filter("_rank <= _room")
    return whole.select(*df.columns).unionByName(last.select(*df.columns))


def lowest_hashes(
    df: DataFrame,
    n: int,
    seed: int,
    keys: list[str],
    per: list[str] | None = None,
    digest: Column | None = None,
) -> DataFrame:
    """The ``n`` rows of lowest seeded hash, overall or per group; all if there are fewer.

    ``keys`` together must tell the rows of a group apart. ``digest`` takes the
    place of the hash where a column already holds one. Rows are first counted
    in 65,536 hash buckets. Whole buckets under the cut stay where they are;
    only the one bucket per group that the cut goes through is ranked. So
    neither the sample nor a large group is gathered in one task.
    """
    digest = seeded_hash(seed, *keys) if digest is None else digest
    room = df.withColumn("_room", F.lit(n).cast("long"))
    return _lowest(room, digest, keys, per or []).select(*df.columns)


def top_by(df: DataFrame, n: int, by: str, seed: int, keys: list[str]) -> DataFrame:
    """The ``n`` rows of highest ``by``, missing values first; ties go by seeded hash.

    Values are counted before any row moves. The rows of the value the cut goes
    through may be a large part of all, so they are cut again by hash bucket.
    """
    highest = F.col(by).desc_nulls_first()
    whole, split = _cut(df.withColumn("_room", F.lit(n).cast("long")), [], by, highest)
    tied = _lowest(split, seeded_hash(seed, *keys), keys, [])
    return whole.unionByName(tied).select(*df.columns)


def exact_sample(
    df: DataFrame, n: int, seed: int, keys: list[str], strict: bool = True
) -> DataFrame:
    """Exactly ``n`` rows without replacement.

    With ``strict`` a smaller input is an error, raised when the result is
    computed; otherwise all rows come back.
    """
    sample = lowest_hashes(df, n, seed, keys)
    if not strict:
        return sample
    have = df.agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") >= n, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit(f"sample of {n} from "), F.col("n").cast("string"))).cast("boolean")
        )
    )
    return sample.filter(have.scalar())


def capped_sample_by(
    df: DataFrame, group: str, cap: int, seed: int, keys: list[str]
) -> DataFrame:
    """At most ``cap`` random rows of each group, exactly ``cap`` where there are more."""
    return lowest_hashes(df, cap, seed, keys, per=[group])


def random_part(k: int, seed: int, *keys: str) -> Column:
    return F.pmod(_number(seeded_hash(seed, *keys), 8), F.lit(k)).cast("int")


def random_split(
    df: DataFrame, k: int, seed: int, keys: list[str], fixed: DataFrame | None = None
) -> DataFrame:
    """Random parts 0..k-1 in column ``part``; the fixed rows are in every part."""
    parts = df.withColumn("part", random_part(k, seed, *keys))
    if fixed is None:
        return parts
    every = fixed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return parts.unionByName(every, allowMissingColumns=True)


def chunks(df: DataFrame, step: int, key: str = "mail") -> DataFrame:
    """Consecutive chunks of ``step`` rows in key order; the last takes the remainder.

    ``key`` tells the rows apart (clean up first). Numbered from 1; an input
    smaller than one step is a single chunk with number 0.
    """
    order = text_order(key, *[c for c in df.columns if c != key])
    placed = with_position(df, order, "_position", total="_count")
    number = F.least(
        F.floor(F.col("_position") / step) + 1, F.floor(F.col("_count") / step)
    )
    return placed.withColumn("chunk", number.cast("long")).drop("_position", "_count")


def _next_file(start: np.ndarray, held_from: np.ndarray | int, threshold: int) -> np.ndarray:
    """Place of the first group that starts past the threshold of a file held from there."""
    return np.searchsorted(start, held_from + threshold, side="right")


def _pass_blocks(groups: DataFrame, threshold: int) -> DataFrame:
    """What each block of groups does to the file that is open before it.

    One row per group at which that file can close: it is the one when the file
    began before ``upto``. Then ``out`` is where the file open after the block
    began, and ``files`` the number of files that the block begins.
    """
    def passes(block: pd.DataFrame) -> pd.DataFrame:
        start = np.sort(block["_start"].to_numpy())
        after = _next_file(start, start, threshold)
        out, files = start.copy(), np.ones(len(start), dtype="int64")
        for j in range(len(start) - 1, -1, -1):
            if after[j] < len(start):
                out[j], files[j] = out[after[j]], files[after[j]] + 1
        last = min(int(_next_file(start, start[0] - 1, threshold)), len(start) - 1)
        return pd.DataFrame({
            "_block": block["_block"].iloc[0], "upto": start[: last + 1] - threshold,
            "out": out[: last + 1], "files": files[: last + 1],
        })

    return groups.groupBy("_block").applyInPandas(
        passes, "_block long, upto long, out long, files long"
    )


def _apply(passes: pd.DataFrame, began: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the files open after a run of groups began, and their numbers, for files open before it."""
    at = np.searchsorted(passes["upto"].to_numpy(), began, side="right")
    closes = at < len(passes)
    at = np.minimum(at, len(passes) - 1)
    return (
        np.where(closes, passes["out"].to_numpy()[at], began),
        np.where(closes, number + passes["files"].to_numpy()[at], number),
    )


def _then(first: pd.DataFrame, second: pd.DataFrame) -> pd.DataFrame:
    """What two neighbouring runs of groups do together, as rows like those of one."""
    out, files = _apply(second, first["out"].to_numpy(), first["files"].to_numpy())
    both = first.assign(out=out, files=files)
    # Files that the first run does not close meet the second one as they are.
    later = second[second["upto"] > first["upto"].iloc[-1]]
    both = pd.concat([both, later], ignore_index=True)
    same = (both["out"] == both["out"].shift(-1)) & (both["files"] == both["files"].shift(-1))
    return both[~same]


def _run(passes: pd.DataFrame) -> list[pd.DataFrame]:
    """The functions of the nodes among these rows, in order."""
    return [rows for _, rows in passes.sort_values(["_node", "upto"]).groupby("_node", sort=True)]


def _compose(passes: pd.DataFrame) -> pd.DataFrame:
    return reduce(_then, _run(passes)).assign(_node=passes["_up"].iloc[0])[["_node", "upto", "out", "files"]]


def _enter(passes: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    """The open file before each node, from the one before the node above."""
    began, number = entry["began"].to_numpy(), entry["number"].to_numpy()
    entries = []
    for rows in _run(passes):
        entries.append((rows["_node"].iloc[0], began[0], number[0]))
        began, number = _apply(rows, began, number)
    return pd.DataFrame(entries, columns=["_node", "began", "number"])


def _open_files(passes: DataFrame, blocks: int, threshold: int) -> DataFrame:
    """Per block the file that is open before it: where it began, and its number.

    What a block does to the open file is a function; functions of ``_FAN`` neighbours are composed to one, level by
    level, until ``_FAN`` are left. From the first open file the entries are then worked out down the same tree. A function has no more
    rows than there are groups within one threshold, so no task's rows grow with the number of groups.
    """
    up = F.floor(F.col("_node") / _FAN).cast("long")
    levels = [passes.withColumnRenamed("_block", "_node")]
    while blocks > _FAN:
        above = levels[-1].withColumn("_up", up).groupBy("_up").applyInPandas(_compose, "_node long, upto long, out long, files long")
        levels.append(frozen(above))
        blocks = -(-blocks // _FAN)
    entries = passes.sparkSession.createDataFrame([(0, -threshold - 1, 0)], "_node long, began long, number long")
    for level in reversed(levels):
        below = level.withColumn("_up", up).groupBy("_up").cogroup(entries.withColumnRenamed("_node", "_up").groupBy("_up"))
        entries = below.applyInPandas(_enter, "_node long, began long, number long")
    return entries.withColumnRenamed("_node", "_block")


def pack_numbers(counts: DataFrame, group: str, threshold: int) -> DataFrame:
    """File number of each group: a file closes at the first boundary past the threshold.

    The next file starts where the last one closed, which makes this a fold in
    group order. It is cut into blocks of ``_FILES_PER_BLOCK`` thresholds. Each block
    works out, for all files that may be open before it, which one is open after
    it; these functions are composed in a tree. Then the blocks are
    numbered, each from its own open file.
    """
    kind = counts.schema[group].dataType.simpleString()
    groups = with_position(counts.select(group, "n"), text_order(group), "_start", weight="n")
    span = max(threshold, 1) * _FILES_PER_BLOCK
    groups = groups.withColumn("_block", F.floor(F.col("_start") / span).cast("long"))
    last = groups.agg(F.max("_block")).first()[0]
    entries = _open_files(frozen(_pass_blocks(groups, threshold)), (last or 0) + 1, threshold)

    def number(block: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("_start")
        start = block["_start"].to_numpy()
        after = _next_file(start, start, threshold)
        current = int(entry["number"].iloc[0])
        place = int(_next_file(start, int(entry["began"].iloc[0]), threshold))
        numbers = np.full(len(start), current)
        while place < len(start):
            current += 1
            numbers[place:after[place]] = current
            place = after[place]
        return block[[group]].assign(file_number=numbers)

    by_block = groups.groupBy("_block").cogroup(entries.groupBy("_block"))
    return by_block.applyInPandas(number, f"{group} {kind}, file_number long")


def pack_groups(
    df: DataFrame, group: str, threshold: int = 85000, hot: list | None = None
) -> DataFrame:
    """Rows with the number of the file their group goes to; groups stay whole."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return inner_on(df, pack_numbers(counts, group, threshold), group, group, "rows", hot)



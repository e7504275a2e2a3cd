"""Sizes from bitmaps and sketches against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from listloom.operators import bitmaps, sketches
from listloom.operators.bitmaps import Wanted


def frame(spark, lists):
    rows = [(name, i) for name, ids in lists.items() for i in ids]
    return spark.createDataFrame([*rows, *rows[:50], ("a", None)], "list string, mail_id long")


def test_sizes_of_segments_against_sets(spark):
    rng = random.Random(2)
    # Numbers at the edges of buckets, and far from each other.
    numbers = [*range(32_760, 32_780), *range(1, 60), *rng.sample(range(10**9), 40), 2**40]
    lists = {n: set(rng.sample(numbers, rng.randint(10, 90))) for n in "abcdef"}
    pick = lambda k: rng.sample("abcdefz", rng.randint(1, k))
    segments = {f"s{k}": Wanted([pick(3) for _ in range(rng.randint(1, 4))], pick(3) if k % 3 else []) for k in range(40)}
    maps = bitmaps.bitmaps(frame(spark, lists))
    parts = [bitmaps.bitmaps(frame(spark, {n: [i for i in ids if i % 2 == k] for n, ids in lists.items()})) for k in range(2)]
    found = [{r.segment: r.n for r in bitmaps.segment_sizes(m, segments).collect()} for m in (maps, bitmaps.merged(parts))]
    for name, wanted in segments.items():
        some = [set().union(*(lists.get(x, set()) for x in g)) for g in wanted.groups]
        left = set.intersection(*some) - set().union(*(lists.get(x, set()) for x in wanted.out))
        assert found[0][name] == found[1][name] == len(left), wanted
    assert set(found[0]) == set(segments)
    empty = bitmaps.segment_sizes(maps.filter("false"), segments)
    assert {r.n for r in empty.collect()} == {0}
    with pytest.raises(ValueError):
        bitmaps.segment_sizes(maps, {"x": Wanted([["a"]] * 7)})


def test_unions_are_shared_and_lists_read_once(spark, tmp_path):
    path = str(tmp_path / "lists")
    frame(spark, {"a": range(100), "b": range(50, 150)}).write.parquet(path)
    found = bitmaps.segment_sizes(bitmaps.bitmaps(spark.read.parquet(path)), {f"s{k}": Wanted([["a"], ["b"]], ["a"] if k else []) for k in range(9)})
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert {r.segment: r.n for r in found.collect()} == {"s0": 50, **{f"s{k}": 0 for k in range(1, 9)}}


@pytest.mark.parametrize(("lg", "within"), [(14, 0), (9, 3)])
def test_overlaps_from_sketches(spark, lg, within):
    """Exact while a sketch holds all keys; beyond within three times the error that the module states."""
    rng = random.Random(5)
    reference = set(rng.sample(range(20_000), 6000))
    lists = {f"f{k}": set(rng.sample(range(20_000), n)) for k, n in enumerate((0, 1, 90, 2000, 9000, 15_000))}
    lists["copy"] = reference
    rows = spark.createDataFrame([(n, i) for n, ids in lists.items() for i in ids], "f string, id long")
    target = spark.createDataFrame([(i,) for i in reference] * 2 + [(None,)], "id long")
    parts = [sketches.list_sketches(rows.filter(F.col("id") % 2 == k), "f", "id", lg) for k in range(2)]
    kept = sketches.united(parts[0].unionByName(parts[1]), "f", lg)
    found = {r.f: r for r in sketches.overlaps(kept, target, "f", "id", lg).collect()}
    assert set(found) == {n for n, ids in lists.items() if ids}
    for name, r in found.items():
        size, both = len(lists[name]), len(lists[name] & reference)
        assert abs(r["size"] - size) <= within * size / 2 ** (lg / 2)
        assert abs(r.n_exist - both) <= within * ((size + len(reference) - both) * both / 2**lg) ** 0.5
        assert r.n_new == r["size"] - r.n_exist
    none = sketches.overlaps(kept, target.filter("false"), "f", "id", lg).collect()
    assert all(r.n_exist == 0 and r.n_new == r["size"] for r in none)

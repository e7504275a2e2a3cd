import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from listloom.operators import dedupe, identity, joins, match, sample, setops
from listloom.operators.rank import with_position


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# -- dedupe -----------------------------------------------------------------


def test_first_per_key_and_nulls(spark, rows):
    df = frame(spark, [(None, "b"), (None, "a"), (1, "c")], "k int, v string")
    assert rows(dedupe.first_per_key(df, ["k"], [])) == [(1, "c"), (None, "a")]
    kept = df.withColumn("id", F.when(F.col("v") == "b", 8).otherwise(9))
    key = dedupe.identity_key("k", "id")
    assert dedupe.first_per_key(kept.withColumn("key", key), ["key"], []).count() == 3


def test_clean_up_sorts_and_drops(spark):
    df = frame(spark, [("b", 1), (" ", 2), (None, 3), ("a", 4), ("a", 4), ("a", 5)], "mail string, n int")
    assert [tuple(r) for r in dedupe.clean_up(df, ["mail"]).collect()] == [("a", 4), ("b", 1)]
    assert dedupe.clean_up(df).count() == 3


def test_latest_wins(spark, rows):
    df = frame(spark, [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "mail string, place int, v string")
    assert rows(dedupe.latest_wins(df, "mail", F.col("place")), "mail", "v") == [("a", "new"), ("b", "only")]


# -- joins --------------------------------------------------------------------


@pytest.fixture
def contacts(spark):
    return frame(spark, [(1, "m1"), (2, "m2"), (3, "m3")], "id long, mail string")


def test_right_join_after_suppression(spark, contacts, rows):
    sms = frame(spark, [(1, "sms1"), (2, "sms2"), (9, "sms9")], "mail_id long, port string")
    complaints = frame(spark, [(1,)], "mail_id long")
    people = joins.keep_out(contacts, complaints)
    got = rows(joins.right_one(people, sms), "mail", "port")
    assert got == [("m2", "sms2"), (None, "sms1"), (None, "sms9")]


def test_any_of_several_sets(spark, contacts, rows):
    keys = joins.all_keys(frame(spark, [(1,)], "mail_id long"), frame(spark, [(3,), (3,)], "mail_id long"))
    assert rows(joins.keep_in(contacts, keys), "id") == [(1,), (3,)]


def test_anti_join_with_null_key(spark, contacts, rows):
    keys = frame(spark, [(1,), (None,)], "mail_id long")
    assert rows(joins.keep_out(contacts, keys), "id") == [(2,), (3,)]
    contacts.createOrReplaceTempView("c")
    keys.createOrReplaceTempView("k")
    assert spark.sql("SELECT id FROM c WHERE id NOT IN (SELECT mail_id FROM k)").count() == 0


def test_left_many_equals_left_join(spark, contacts, rows):
    side = frame(spark, [(1, "a"), (1, "b"), (3, None), (9, "z")], "mail_id long, v string")
    got = rows(joins.left_many(contacts, side), "id", "v")
    plain = contacts.join(side, contacts.id == side.mail_id, "left").select("id", "v")
    assert got == rows(plain)


def test_natural_join_matches_nulls(spark, rows):
    left = frame(spark, [("a", None), ("b", "x")], "mail string, nom string")
    right = frame(spark, [("a", None, 1), ("b", "y", 2)], "mail string, nom string, n int")
    assert rows(joins.natural(left, right)) == [("a", None, 1)]
    assert rows(joins.natural(left, right, "left")) == [("a", None, 1), ("b", "x", None)]
    assert rows(joins.rows_not_in(left, right)) == [("b", "x")]
    with pytest.raises(ValueError):
        joins.natural(left, right.select("n"))


def test_set_operations(spark, rows):
    a = frame(spark, [("m1", 1), ("m1", 1), ("m2", 2)], "mail string, n int")
    b = frame(spark, [("m2", "x")], "mail string, t string")
    assert rows(setops.in_common(a, b, "mail")) == [("m2", 2)]
    assert rows(setops.not_in(a, b, "mail")) == [("m1", 1), ("m1", 1)]
    assert rows(setops.not_in_any(a, [b, a.filter("n = 1")], "mail")) == []
    assert rows(setops.distinct_union("mail", a, b)) == [("m1",), ("m2",)]
    assert setops.stack(a, b).columns == ["mail", "n", "t"]


# -- identities -----------------------------------------------------------------


def test_collapse_and_unpack(spark, rows):
    ids = frame(
        spark, [(7, "b", None), (7, "a", None), (7, "b", None), (8, None, "n")],
        "mail_id long, prenom string, nom string",
    )
    packed = identity.collapse_identities(ids, ["prenom", "nom"])
    assert rows(packed) == [(7, "a,b", ""), (8, "", "n")]
    unpacked = identity.unpack_identity(packed, ["prenom", "nom"])
    assert rows(unpacked) == [(7, "prenom_1", "a"), (7, "prenom_2", "b"), (8, "nom_1", "n")]
    one = packed.filter("mail_id = 7").select(identity.attribute_map(["prenom", "nom"])).first()[0]
    assert one == {"prenom_1": "a", "prenom_2": "b"}


def test_clean_identities(spark, rows):
    ids = frame(spark, [(1, 7, "a"), (2, 7, "a"), (3, 7, None), (4, 7, None)], "id long, mail_id long, nom string")
    assert rows(identity.clean_identities(ids)) == [(1, 7, "a"), (3, 7, None)]


# -- matching ---------------------------------------------------------------------


def test_map_existing_keeps_row_count(spark, rows):
    df = frame(spark, [("a",), ("b",), ("a",)], "md5 string")
    reference = frame(spark, [("a",), ("a",), (None,)], "md5 string")
    flagged = match.map_existing(df, reference)
    assert rows(flagged) == [("a", True, False), ("a", True, False), ("b", False, True)]
    assert rows(match.match_counts(flagged)) == [(3, 3, 2, 1)]


def test_map_existing_without_shared_column(spark, rows):
    seen = frame(spark, [("x@one.example", 1), ("y@two.example", 2)], "address string, rank int")
    other = frame(spark, [("z@one.example", 9.5)], "contact string, price double")
    assert rows(match.map_existing(seen, other, "code"), "exist", "new") == [(False, False)] * 2


def test_map_existing_falls_back_to_shared_column(spark, rows):
    df = frame(spark, [("a", 1)], "mail string, n int")
    reference = frame(spark, [("a", 2)], "mail string, k int")
    assert rows(match.map_existing(df, reference, "md5"), "mail", "exist") == [("a", True)]


def test_word_hits_against_brute_force(spark, rows):
    rng = random.Random(1)
    mails = [(i, "".join(rng.choice("abc.@") for _ in range(rng.randint(0, 12)))) for i in range(200)]
    words = [(i, "".join(rng.choice("abc.") for _ in range(rng.randint(1, 4)))) for i in range(30)]
    base = frame(spark, mails, "id long, mail string")
    listed = frame(spark, [(i, w, i % 2 == 0) for i, w in words], "id long, mot string, exclusion boolean")
    expected = sorted(((m, w) for m, text in mails for w, word in words if word in text), key=repr)
    assert rows(match.word_hits(base, listed)) == expected
    flagged = {m for m, text in mails for w, word in words if word in text and w % 2 == 0}
    got = match.word_flag(base, listed)
    assert {r.id for r in got.filter("exclusion_mot_cle").collect()} == flagged and got.count() == 200


@pytest.mark.parametrize("few", [100, 3])
def test_word_hits_broadcasts_no_addresses(spark, rows, tmp_path, monkeypatch, few):
    """The addresses' file is smaller than what Spark broadcasts; their runs of signs are not."""
    monkeypatch.setattr(match, "_FEW_WORDS", few, raising=False)
    mails = [(i, f"contact.{i:09d}@domain{i % 7}.example") for i in range(2000)]
    words = [(i, w, True) for i, w in enumerate(["00@", "11@", "tact.0000012", "n6.ex", "9", "77", "exam", "zzz"])]
    frame(spark, mails, "id long, mail string").write.parquet(f"{tmp_path}/mails")
    frame(spark, words, "id long, mot string, exclusion boolean").write.parquet(f"{tmp_path}/words")
    base, listed = spark.read.parquet(f"{tmp_path}/mails"), spark.read.parquet(f"{tmp_path}/words")
    hits = match.word_hits(base, listed)
    assert rows(hits) == sorted(((m, w) for m, text in mails for w, word, _ in words if word in text), key=repr)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan and "BuildLeft" not in plan


def test_word_hits_without_words(spark):
    base = frame(spark, [(1, "a@b")], "id long, mail string")
    words = frame(spark, [], "id long, mot string, exclusion boolean")
    assert match.word_hits(base, words).count() == 0


# -- positions, samples, splits -------------------------------------------------------


def test_positions(spark):
    df = frame(spark, [(i * 7 % 101, i % 5) for i in range(101)], "k int, w int")
    placed = with_position(df, [F.col("k").asc()], total="n").collect()
    assert sorted((r.position, r.k) for r in placed) == [(k, k) for k in range(101)]
    assert {r.n for r in placed} == {101}
    weighted = {r.k: r.position for r in with_position(df, [F.col("k").asc()], weight="w").collect()}
    weight = {r[0]: r[1] for r in df.collect()}
    assert all(weighted[k] == sum(weight[j] for j in range(k)) for k in range(101))


@pytest.mark.parametrize("n,sizes", [
    (5, {0: 5}), (9, {0: 9}), (10, {1: 10}), (14, {1: 14}), (25, {1: 10, 2: 15}),
])
def test_chunk_sizes(spark, n, sizes):
    df = frame(spark, [(f"m{i:03d}",) for i in range(n)], "mail string")
    got = sample.chunks(df, 10).collect()
    assert Counter(r.chunk for r in got) == sizes
    ordered = sorted(got, key=lambda r: r.mail)
    assert [r.chunk for r in ordered] == sorted(r.chunk for r in got)


def fold_files(sizes, threshold):
    number, held, out = 1, 0, []
    for n in sizes:
        if held > threshold:
            number, held = number + 1, 0
        held += n
        out.append(number)
    return out


def test_pack_groups(spark):
    sizes = [3, 4, 5, 1, 9, 2]
    df = frame(spark, [(g, i) for g, n in enumerate(sizes) for i in range(n)], "num int, i int")
    packed = sample.pack_groups(df, "num", 5)
    assert packed.count() == sum(sizes)
    numbers = {r.num: r.file_number for r in packed.collect()}
    assert [numbers[g] for g in range(6)] == [1, 1, 2, 2, 3, 4]


@pytest.mark.parametrize("per_block", [1, 2, 7, 50])
@pytest.mark.parametrize("threshold", [0, 3, 25, 400])
def test_pack_groups_against_fold(spark, monkeypatch, per_block, threshold):
    monkeypatch.setattr(sample, "_FILES_PER_BLOCK", per_block)
    rng = random.Random(threshold + per_block)
    sizes = [rng.choice([1, 1, 2, 3, 8, 40, 300 if rng.random() < 0.1 else 1]) for _ in range(300)]
    counts = frame(spark, list(enumerate(sizes)), "num int, n long")
    got = {r.num: r.file_number for r in sample.pack_numbers(counts, "num", threshold).collect()}
    assert [got[g] for g in range(300)] == fold_files(sizes, threshold)


def test_exact_sample(spark):
    df = frame(spark, [(i, f"m{i}") for i in range(5000)], "id int, mail string")
    got = [r.id for r in sample.exact_sample(df, 700, 1, ["mail"]).collect()]
    assert len(got) == len(set(got)) == 700
    assert sorted(got) == sorted(r.id for r in sample.exact_sample(df, 700, 1, ["mail"]).collect())
    assert sorted(got) != sorted(r.id for r in sample.exact_sample(df, 700, 2, ["mail"]).collect())
    everyone = sample.exact_sample(df, 9000, 1, ["mail"], strict=False)
    assert everyone.count() == 5000
    with pytest.raises(Exception, match="sample of 9000 from 5000"):
        sample.exact_sample(df, 9000, 1, ["mail"]).collect()


def test_both_sample_paths_agree(spark, monkeypatch):
    df = frame(spark, [(i, i % 3, f"m{i}") for i in range(3000)], "id int, birth int, mail string")
    plain = [sample.lowest_hashes(df, 400, 1, ["mail"]), sample.top_by(df, 400, "birth", 1, ["mail"])]
    plain = [sorted(r.id for r in p.collect()) for p in plain]
    cut = [sample.lowest_hashes(df, 400, 1, ["mail"]), sample.top_by(df, 400, "birth", 1, ["mail"])]
    assert [sorted(r.id for r in c.collect()) for c in cut] == plain


def test_hot_tie_in_top(spark):
    data = [(i, None if i < 1000 else i % 50, f"m{i}") for i in range(3000)]
    df = frame(spark, data, "id int, birth int, mail string")
    got = sample.top_by(df, 1500, "birth", 1, ["mail"]).collect()
    assert len(got) == 1500 and sum(r.birth is None for r in got) == 1000
    assert min(r.birth for r in got if r.birth is not None) == 37


def test_cut_inside_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(sample, "_DIGITS", 1)
    df = frame(spark, [(i, f"m{i}") for i in range(1000)], "id int, mail string")
    coarse = sorted(r.id for r in sample.lowest_hashes(df, 333, 1, ["mail"]).collect())
    monkeypatch.setattr(sample, "_DIGITS", 4)
    assert coarse == sorted(r.id for r in sample.lowest_hashes(df, 333, 1, ["mail"]).collect())


def test_capped_sample_per_group(spark):
    data = [("hot", f"h{i}") for i in range(2000)] + [("cold", f"c{i}") for i in range(30)] + [(None, "x")]
    df = frame(spark, data, "file string, mail string")
    got = sample.capped_sample_by(df, "file", 100, 5, ["mail"]).collect()
    assert Counter(r.file for r in got) == {"hot": 100, "cold": 30, None: 1}
    assert len({(r.file, r.mail) for r in got}) == 131


def test_random_split(spark):
    df = frame(spark, [(f"m{i}",) for i in range(1000)], "mail string")
    fixed = frame(spark, [("always", True)], "mail string, ouvreur boolean")
    got = sample.random_split(df, 5, 1, ["mail"], fixed).collect()
    parts = Counter(r.part for r in got)
    assert sorted(parts) == [0, 1, 2, 3, 4] and sum(parts.values()) == 1005
    assert len({r.mail for r in got}) == 1001
    assert sum(r.mail == "always" for r in got) == 5


@pytest.mark.parametrize("fan", [2, 3])
@pytest.mark.parametrize(("per_block", "threshold"), [(1, 0), (1, 7), (2, 30), (5, 3)])
def test_packing_is_composed_in_a_tree(spark, monkeypatch, fan, per_block, threshold):
    """Many levels, blocks without groups, and groups larger than a block."""
    monkeypatch.setattr(sample, "_FILES_PER_BLOCK", per_block)
    monkeypatch.setattr(sample, "_FAN", fan)
    rng = random.Random(fan + threshold)
    sizes = [rng.choice([1, 2, 3, 9, 500 if rng.random() < 0.05 else 4]) for _ in range(200)]
    counts = frame(spark, list(enumerate(sizes)), "num int, n long")
    got = {r.num: r.file_number for r in sample.pack_numbers(counts, "num", threshold).collect()}
    assert [got[g] for g in range(200)] == fold_files(sizes, threshold)
    assert sample.pack_numbers(counts.filter("false"), "num", threshold).count() == 0


def test_composed_functions_are_bounded_and_equal():
    """One after the other gives what both together give, in no more rows than they have."""
    import pandas as pd

    rng = random.Random(6)
    for _ in range(200):
        made = []
        for _ in range(2):
            upto = sorted(rng.sample(range(100), rng.randint(1, 8)))
            made.append(pd.DataFrame({"_node": 0, "upto": upto, "out": [rng.randint(0, 120) for _ in upto], "files": [rng.randint(1, 3) for _ in upto]}))
        both = sample._then(*made)
        assert len(both) <= len(made[0]) + len(made[1])
        for began in range(-5, 130):
            at = [[began], [7]]
            for one in made:
                at = sample._apply(one, *map(np.array, at))
            whole = sample._apply(both, np.array([began]), np.array([7]))
            assert [x.tolist() for x in at] == [x.tolist() for x in whole]


def test_words_are_looked_for_by_one_run_each(spark):
    """Many words of many lengths: an address is cut into as many pieces as it is long, once."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdeé") for _ in range(n))
    mails = [(i, text(rng.randint(0, 30))) for i in range(120)] + [(500, "abcabcabc"), (501, None), (502, "ab")]
    words = [(i, text(rng.randint(1, 12)), False) for i in range(2000)] + [(5000, "abc", False), (5001, "abcabc", False), (5002, "", False), (5003, None, False)]
    base = frame(spark, mails, "id long, mail string")
    listed = frame(spark, words, "id long, mot string, exclusion boolean")
    expected = sorted((m, w) for m, t in mails for w, word, _ in words if t and word and word in t)
    hits = match.word_hits(base, listed)
    assert sorted(tuple(r) for r in hits.collect()) == expected
    found = match._seeds(listed.filter("length(mot) > 2").select(F.col("id").alias("mot_list_id"), "mot"), frame(spark, [("abc",)], "gram string"))
    assert all(len(r.gram) == 3 and r.mot[r["shift"] : r["shift"] + 3] == r.gram for r in found.collect())

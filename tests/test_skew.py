"""Hot keys change the plan of a join, never its rows."""

import random

import pytest
from pyspark.sql import functions as F

from listloom.operators import joins, match, sample, skew


@pytest.fixture
def everything_is_hot(monkeypatch):
    monkeypatch.setattr(skew, "_CHECK_BYTES", 0)
    monkeypatch.setattr(skew, "_HOT_ROWS", 20)
    monkeypatch.setattr(skew, "_SAMPLE_BYTES", 1 << 80)
    monkeypatch.setattr(skew, "_UNKNOWN_BYTES", 1 << 80)


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(5)
    # Key 1 holds a third of the rows; 2 and None hold some, the others few.
    keys = [1] * 100 + [2] * 40 + [None] * 30 + [rng.randint(3, 60) for _ in range(130)]
    many = [(k, f"v{i % 90}") for i, k in enumerate(keys)]
    return (
        spark.createDataFrame(many, "mail_id long, v string"),
        spark.createDataFrame([(i, f"m{i}") for i in range(0, 50)], "id long, mail string"),
    )


def same(left, right):
    columns = sorted(left.columns)
    assert sorted(right.columns) == columns
    got = sorted(map(repr, (tuple(r) for r in left.select(*columns).collect())))
    assert got == sorted(map(repr, (tuple(r) for r in right.select(*columns).collect())))
    assert got


def test_hot_keys_are_found(spark, frames, everything_is_hot):
    assert sorted(skew.hot_keys(frames[0], "mail_id")) == [1, 2]


def test_small_inputs_are_not_looked_at(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert skew.input_bytes(df) < skew._CHECK_BYTES
    assert skew.hot_keys(df, "l_orderkey") == []


def test_some_files_of_a_table(spark, tmp_path, everything_is_hot, monkeypatch):
    monkeypatch.setattr(skew, "_SAMPLE_FILES", 5)
    monkeypatch.setattr(skew, "_HOT_ROWS", 300)
    path = str(tmp_path / "t")
    rows = spark.range(2000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k")
    rows.repartition(20).write.parquet(path)
    table = spark.read.parquet(path)
    assert skew.hot_keys_of_table(table, "k") == [7]


def test_sampled_look(spark, everything_is_hot, monkeypatch):
    monkeypatch.setattr(skew, "_HOT_ROWS", 20000)
    df = spark.range(100_000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k")
    monkeypatch.setattr(skew, "_SAMPLE_BYTES", skew.input_bytes(df) // 10)
    assert skew.hot_keys(df, "k") == [7]


def test_left_join_with_a_hot_key_that_is_not_there(spark, frames, everything_is_hot):
    many, contacts = frames
    want = contacts.join(many, many.mail_id == contacts.id, "left").drop("mail_id")
    same(joins.left_many(contacts, many, hot=[1, 0, 777]), want)


def plain(left, right, condition, how):
    return left.join(right, condition, how)


def test_joins_with_hot_keys(spark, frames, everything_is_hot):
    many, contacts = frames
    on = many.mail_id == contacts.id
    same(joins.keep_in(many, contacts, "mail_id", "id", repeats=True), plain(many, contacts, on, "left_semi"))
    same(joins.keep_out(many, contacts, "mail_id", "id", repeats=True), plain(many, contacts, on, "left_anti"))
    same(joins.left_one(many, contacts, "mail_id", "id", repeats=True), plain(many, contacts, on, "left").drop("id"))
    same(joins.left_many(contacts, many), plain(contacts, many, on, "left").drop("mail_id"))
    same(joins.left_many(contacts, many, unique=False), plain(contacts, many, on, "left").drop("mail_id"))
    same(joins.inner_on(contacts, many), plain(contacts, many, on, "inner").drop("mail_id"))
    same(
        joins.inner_on(many, contacts, "mail_id", "id", many="rows"),
        plain(many, contacts, on, "inner").drop("id"),
    )
    same(joins.right_one(contacts, many), plain(contacts, many, on, "right").drop("mail_id"))


def test_hot_rows_are_not_shuffled(spark, frames, everything_is_hot):
    many, contacts = frames
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = joins.left_many(contacts, many)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The cold rows meet in a sort-merge join, the hot ones at a broadcast.
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in text


def test_natural_join_with_hot_groups(spark, everything_is_hot):
    left = spark.createDataFrame([("a", None)] * 60 + [("b", "x")] * 3 + [("c", None)], "m string, n string")
    right = spark.createDataFrame([("a", None, 1), ("b", "x", 2), ("d", "x", 3)], "m string, n string, k int")
    assert joins.natural(left, right, unique=True).count() == 63
    assert joins.natural(left, right, "left", unique=True).filter("k IS NULL").count() == 1
    assert joins.rows_not_in(left, right).collect() == [("c", None)]


def test_matching_with_copies(spark, everything_is_hot):
    df = spark.createDataFrame([("h1",)] * 70 + [("h2",)] * 5 + [(None,)], "md5 string")
    known = spark.createDataFrame([(5, "h1"), (4, "h1"), (6, "h3")], "mail_id long, md5 string")
    counts = match.match_counts(match.map_existing(df, known)).first()
    assert tuple(counts) == (76, 76, 70, 6)
    looked = match.lookup_hash(df, known)
    assert looked.filter("pg_id = 4").count() == 70 and looked.filter("insert").count() == 6


def test_enrichment_with_copies(spark, everything_is_hot):
    outside = spark.createDataFrame([("a@a.example",)] * 50 + [("b@a.example",)], "mail string")
    known = spark.createDataFrame([("a@a.example", "1.0"), ("a@a.example", "2.0")], "mail string, civilite string")
    known = known.withColumn("md5", F.md5("mail"))
    assert match.hash_enrich(outside, known, ["civilite"]).count() == 101


def test_packing_with_a_hot_group(spark, everything_is_hot):
    df = spark.createDataFrame([(1, i) for i in range(200)] + [(g, 0) for g in range(2, 40)], "g int, i int")
    packed = sample.pack_groups(df, "g", 25)
    assert packed.count() == 238 and packed.filter("g = 1").select("file_number").distinct().count() == 1


@pytest.mark.parametrize("name", [
    "segment_classic", "segment_provenance", "segment_identity_latest", "common_with_file", "active_openers",
    "sms_prefiltered", "profiles_with_hash", "file_interests", "non_webmail", "suppress_union", "lookup_hash",
    "interest_lookup", "hash_enrich", "new_rows_diff", "natural_left", "overlap_by_file", "reach_counts",
    "group_packing", "import_contacts",
])
def test_registered_queries_with_hot_keys(spark, everything_is_hot, monkeypatch, name):
    """Same rows as the SQL when every key of twenty rows is joined apart."""
    import duckdb

    import __spark_entry__ as spark_entry
    from listloom.catalog.views import TABLES, driver_model

    folder = "/root/testdata/sf0.001"
    driver_model.cache_clear()
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = duck.execute(spark_entry.oracle_sql()[name])
    order = sorted(range(len(cursor.description)), key=lambda i: cursor.description[i][0])
    theirs = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    df = spark_entry.queries()[name](spark, folder)
    ours = sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    driver_model.cache_clear()
    assert ours == theirs

"""The plans are the ones wanted at scale."""

import pytest

from listloom.catalog import all_queries as queries
from listloom.sources.writers import save_bucketed

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """No broadcast, as with sides that are too large for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cross_join_and_no_row_python(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for unwanted in ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "CollectLimit"]:
        assert unwanted not in text
    if name != "group_packing":
        assert "Python" not in text and "InPandas" not in text


def test_suppression_is_one_anti_join(shuffled):
    text = plan(queries()["file_clean"](shuffled, FOLDER))
    assert text.count("LeftAnti") == 1 and text.count("LeftSemi") >= 1


def test_first_per_key_limits_before_the_shuffle(spark):
    for name in ["segment_identity_latest", "one_per_hash", "last_file_wins", "one_per_mail"]:
        assert "WindowGroupLimit" in plan(queries()[name](spark, FOLDER)), name


def test_scan_reads_only_needed_columns(spark):
    text = plan(queries()["hash_export"](spark, FOLDER))
    assert "l_extendedprice" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "PushedFilters: [In(p_brand" in text


def test_contacts_are_shuffled_once(shuffled):
    text = plan(queries()["blacklist"](shuffled, FOLDER))
    assert text.count("FileScan parquet [c_custkey") >= 1
    base_side = text.index("FileScan parquet [c_custkey")
    above = text[:base_side]
    # Semi joins above the scan of the contacts share one exchange on the contact key.
    branch = [line for line in above.splitlines() if "Exchange hashpartitioning(id#" in line]
    assert len(branch) == 1


def test_bucketed_tables_join_without_shuffle(shuffled, tmp_path):
    spark = shuffled
    left = spark.range(100).withColumnRenamed("id", "mail_id")
    for name in ["loom_contacts", "loom_openers"]:
        save_bucketed(left, name, 4)
    joined = spark.table("loom_contacts").join(spark.table("loom_openers"), "mail_id", "left_anti")
    assert "Exchange" not in plan(joined)
    spark.sql("DROP TABLE loom_contacts")
    spark.sql("DROP TABLE loom_openers")

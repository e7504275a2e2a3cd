"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry

FOLDER = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = spark_entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, df.collect()) == canonical(names, cursor.fetchall())


def test_every_query_has_sql():
    """Only training-data operators may lack it; their own tests hold them against brute force."""
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(spark_entry.queries()) - set(spark_entry.oracle_sql()) <= set(spark_entry.EXTRA)


def test_entry_stands_without_the_training_operators(tmp_path):
    """A copy without their folders still imports and has all other queries."""
    root = Path(spark_entry.__file__).parent
    shutil.copytree(root / "listloom", tmp_path / "listloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    # The folder itself takes the place of the installed path, so that nothing of this tree is found.
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    assert done.stdout.split() == sorted(set(spark_entry.queries()) - set(spark_entry.EXTRA))


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0

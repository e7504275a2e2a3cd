"""A store of tables that takes in loads as a whole.

Each run of a load writes its tables beside those of all others, in folders ``<table>/load=<load>/run=<run>``. It counts from
the moment its mark is written, after all else, and in place of earlier runs of the same load. Readers look at the marks
first, so what a stopped run has left is never seen, and all tables of a load appear at once. The marks also keep the highest
numbers that a load gave, so that a number is given once even if its load is replaced later.

Folders without loads are plain tables; all their rows count.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MARKS = "import_marks"
_MARK = "turn long, load string, run string, tops map<string,long>"


def _system(spark: SparkSession, path: str):
    """A folder as Hadoop knows it, and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet folder; empty if nothing was written yet."""
    place, system = _system(spark, path)
    return spark.read.schema(schema).parquet(path) if system.exists(place) else spark.createDataFrame([], schema)


def marks(spark: SparkSession, folder: str) -> list[Row]:
    """The marks of all finished runs, oldest first; one row a run."""
    return sorted(_read(spark, f"{folder}/{MARKS}", StructType.fromDDL(_MARK)).collect(), key=lambda m: m.turn)


def runs_that_count(found: list[Row]) -> dict[str, str]:
    """The last finished run of each load."""
    return {m.load: m.run for m in found}


def _counts(runs: dict[str, str]) -> Column:
    """Rows of a plain table, or of a run that counts. Spark prunes the folders of others."""
    listed = [f"{load}/{run}" for load, run in runs.items()]
    return F.col("run").isNull() | F.concat_ws("/", "load", "run").isin(listed)


def read(
    spark: SparkSession, folder: str, name: str, schema: StructType, load: str | None = None, other: str | None = None,
    found: list[Row] | None = None,
) -> DataFrame:
    """A table of the store: all finished loads, those but ``other``, or ``load`` alone. ``found`` passes marks that are known."""
    runs = runs_that_count(marks(spark, folder) if found is None else found)
    parts = StructType([*schema.fields, StructField("load", StringType()), StructField("run", StringType())])
    rows = _read(spark, f"{folder}/{name}", parts).filter(_counts(runs))
    if load is not None:
        rows = rows.filter(F.col("load") == load)
    if other is not None:
        rows = rows.filter(F.col("load").isNull() | (F.col("load") != other))
    return rows.select(*schema.names)


class Load:
    """One run of a load. Nothing of it is seen before ``finish``."""

    def __init__(self, spark: SparkSession, folder: str, load: str):
        self.spark, self.folder, self.load = spark, folder, load
        self.run = uuid.uuid4().hex
        # What the run finds; a reader's view of the store stays the same while it works.
        self.before = marks(spark, folder)
        self._clear(runs_that_count(self.before).get(load))

    def read(self, name: str, schema: StructType, load: str | None = None, other: str | None = None) -> DataFrame:
        """A table as this run finds it; see ``read``."""
        if load is not None and load not in runs_that_count(self.before):
            return self.spark.createDataFrame([], schema)
        return read(self.spark, self.folder, name, schema, load, other, self.before)

    def top(self, name: str) -> int:
        """The highest number that any finished run gave in a table."""
        return max((m.tops.get(name, 0) for m in self.before), default=0)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}/load={self.load}/run={self.run}"

    @property
    def ran_before(self) -> bool:
        """Whether an earlier run of this load counts."""
        return self.load in runs_that_count(self.before)

    def write(self, name: str, df: DataFrame, number: str | None = None) -> int | None:
        """Write one table; gives the highest value of the column ``number``, taken while it is written."""
        if number is None:
            df.write.mode("overwrite").parquet(self.path(name))
            return None
        seen = Observation()
        df.observe(seen, F.max(number).alias("top")).write.mode("overwrite").parquet(self.path(name))
        return seen.get["top"]

    def finish(self, tops: dict[str, int | None] | None = None) -> None:
        """Let the run count, then clear away the runs it takes the place of."""
        turn = max((m.turn for m in self.before), default=0) + 1
        row = (turn, self.load, self.run, {k: v for k, v in (tops or {}).items() if v is not None})
        self.spark.createDataFrame([row], _MARK).coalesce(1).write.mode("append").parquet(f"{self.folder}/{MARKS}")
        self._clear(self.run)

    def _clear(self, keep: str | None) -> None:
        """Remove what other runs of this load have left in any table: stopped ones, and those that were replaced."""
        root, system = _system(self.spark, self.folder)
        if not system.exists(root):
            return
        for table in system.listStatus(root):
            own, _ = _system(self.spark, f"{table.getPath()}/load={self.load}")
            if table.isDirectory() and system.exists(own):
                for run in system.listStatus(own):
                    if run.getPath().getName() != f"run={keep}":
                        system.delete(run.getPath(), True)

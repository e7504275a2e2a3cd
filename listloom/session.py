"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on a laptop and on a cluster alike. Sizes of single
# machines (memory, cores, shuffle partitions) stay with the submitter.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, name: str = "listloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **ENGINE_CONF,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": "16g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only where ``spark.checkpoint.dir`` is unset and no job has set a folder
    either does a bare local session get a temporary one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="listloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def frozen(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, with its partitions kept in place.

    Positions counted over the partitions of the result stay true when an
    executor is lost, because the rows are read back instead of computed anew.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)

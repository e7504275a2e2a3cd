"""Import of files as they arrive in a folder.

``append_arrivals`` keeps arriving rows as they are. ``merge_arrivals`` takes files into a store, batch by batch, just as
``import_folder`` does: cleaned, matched, numbered, and without facts that the store has already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listloom.model import Model
from listloom.sources.ingest import import_folder
from listloom.sources.names import broker_of, columns_of, source_file, statuses_of


def fields_of(line: Column | str, sep: str = ";") -> Column:
    """The fields of a delimited line, as many as it has; quotes are taken off and empty fields are null."""
    apart = F.split(line, f'[{sep}](?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    plain = lambda x: F.when(x.rlike('^".*"$'), F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x)
    return F.transform(apart, lambda x: F.nullif(plain(x), F.lit("")))


def arriving_rows(
    spark: SparkSession, folder: str, columns: list[str], sep: str = ";", exports: bool = False,
) -> DataFrame:
    """Rows of arriving files, columns placed by what each file's name says.

    Files are read as lines, so that a line may have any number of fields.
    """
    lines = spark.readStream.option("recursiveFileLookup", exports).text(folder)
    rows = lines.select(fields_of("value", sep).alias("_values"), source_file())
    header = columns_of("source_file")
    placed = [
        F.get("_values", F.array_position(header, F.lit(c)).cast("int") - 1).alias(c) for c in columns
    ]
    return rows.select(
        "source_file", statuses_of("source_file").alias("statuses"),
        broker_of("source_file").alias("broker"), *placed,
    )


def append_arrivals(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of all files that have arrived, then stop.

    Each batch writes its own folder and replaces it when the batch is run
    again, so a restart neither loses nor repeats a file.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/load=stream-{number}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def arriving_files(spark: SparkSession, folder: str, exports: bool = False, per_batch: int | None = None) -> DataFrame:
    """Names of the files that arrive in a folder; their contents are not read.

    With ``exports`` a folder of part files is one file; it has to arrive as a whole, as a job's output does when it is
    moved into place. ``per_batch`` limits the files of one batch.
    """
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    reader = reader.option("recursiveFileLookup", exports)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder).select(source_file())


def merge_arrivals(
    spark: SparkSession, folder: str, warehouse: str, state: str, known: Model | None = None, exports: bool = False,
    per_batch: int | None = None, **choice,
) -> StreamingQuery:
    """Take in all files that have arrived, then stop; what arrives later is taken in by the next call.

    Each batch is one load of the store, named by the number of the batch, and is seen as a whole or not at all. A batch that was
    stopped is run again by the next call under its own name: it takes the place of what it had done, with the same numbers. Contacts
    are matched to ``known``, or to the store itself; a fact that came with an earlier batch is not written
    again. ``choice`` goes to ``import_folder``.
    """
    def take_in(batch: DataFrame, number: int) -> None:
        # Names of files: as many as arrived, at most ``per_batch``.
        names = sorted({r["source_file"] for r in batch.collect()})
        model = known or Model.from_parquet(batch.sparkSession, warehouse)
        import_folder(
            model, folder, warehouse, f"stream-{number}", exports=exports, only_files=names, merge=True, **choice
        )

    return (
        arriving_files(spark, folder, exports, per_batch).writeStream.foreachBatch(take_in)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )

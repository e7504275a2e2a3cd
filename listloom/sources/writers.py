"""Export files, tables and the export manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from listloom.model import IDENTITY
from listloom.operators.dedupe import first_per_key, text_order
from listloom.operators.identity import attribute_map
from listloom.operators.joins import inner_on, left_one
from listloom.sources.names import membership_file_name, segment_file_name
from listloom.store import Load

# Tables that a job may replace as a whole.
REPLACEABLE = ["id_unik"]


def write_csv(
    df: DataFrame,
    path: str,
    columns: list[str] | None = None,
    sep: str = ";",
    header: bool = False,
    sort: str | None = None,
) -> None:
    """Chosen columns in order, null as empty text."""
    rows = df.select(*(columns or df.columns))
    if sort:
        rows = rows.orderBy(*text_order(sort))
    rows.write.mode("overwrite").csv(path, sep=sep, header=header, nullValue="", emptyValue="")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` that counts its own rows while it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_segment(
    df: DataFrame,
    folder: str,
    prefix: str,
    date: str,
    columns: list[str],
    mail_unique: bool = False,
    sep: str = ";",
    comment: str = "",
) -> DataFrame:
    """Write a segment as CSV and give its row for the export manifest.

    Rows are counted in the same job that writes them, so the size is in the
    manifest's file name and not in the folder's.
    """
    rows = first_per_key(df, ["mail"], []) if mail_unique else df
    rows, seen = _counted(rows.select(*columns).orderBy(*text_order("mail")))
    path = f"{folder}/{segment_file_name(prefix, date, columns, None, mail_unique, comment=comment)}"
    write_csv(rows, path, sep=sep)
    n = seen.get["rows"]
    name = segment_file_name(prefix, date, columns, n, mail_unique, comment=comment)
    return manifest(df.sparkSession, [(path, name, n)])


def manifest(spark: SparkSession, rows: list[tuple[str, str, int]]) -> DataFrame:
    return spark.createDataFrame(rows, "path string, name string, rows long")


def write_membership(
    df: DataFrame, contacts: DataFrame, broker: str, broker_id: int, table: str,
    description: str, date: str, load: str, whole: bool = False,
) -> DataFrame:
    """Record an export as membership of its broker, once per load and contact.

    A load replaces itself when it is run again. With ``whole`` the table is one of a store, and the
    export is a load of it that is seen when it is finished.
    """
    mails = df.select("mail").distinct()
    links = inner_on(contacts, mails, "mail", "mail", hot=[]).select(
        F.col("id").alias("mail_id"), F.lit(broker_id).cast("long").alias("regie_id")
    )
    links, seen = _counted(links.distinct())
    path = f"{table}/load={load}"
    if whole:
        folder, name = table.rstrip("/").rsplit("/", 1)
        run = Load(df.sparkSession, folder, load)
        path = run.path(name)
        run.write(name, links)
        run.finish()
    else:
        links.write.mode("overwrite").parquet(path)
    n = seen.get["rows"]
    return manifest(df.sparkSession, [(path, membership_file_name(date, broker, description, n), n)])


def overwrite_table(df: DataFrame, folder: str, table: str) -> None:
    """Replace one of the tables that may be replaced, as one Parquet write."""
    if table not in REPLACEABLE:
        raise ValueError(f"{table} may not be replaced")
    df.write.mode("overwrite").parquet(f"{folder}/{table}")


def replace_table(df: DataFrame, folder: str, table: str) -> None:
    """Replace one of the tables of a store that may be replaced; readers see the old rows until all new ones are there."""
    if table not in REPLACEABLE:
        raise ValueError(f"{table} may not be replaced")
    run = Load(df.sparkSession, folder, f"all-{table}")
    run.write(table, df)
    run.finish()


def append_table(df: DataFrame, folder: str, table: str, load: str) -> None:
    """Add one load to a table; running the load again replaces only itself."""
    df.write.mode("overwrite").parquet(f"{folder}/{table}/load={load}")


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str = "mail_id") -> None:
    """A catalog table bucketed and sorted by contact.

    Semi, anti and left joins between tables bucketed alike need no shuffle.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def write_parts(df: DataFrame, path: str, part: str, sep: str = ";") -> None:
    """One folder per value of ``part`` (broker, chunk, file number) in a single job."""
    df.write.mode("overwrite").partitionBy(part).csv(path, sep=sep, nullValue="", emptyValue="")


def key_value_rows(hashes: DataFrame, packed: DataFrame, attributes: list[str] = IDENTITY) -> DataFrame:
    """(md5, id): the numbered identity attributes of each hash as a JSON object."""
    rows = left_one(hashes, packed, "mail_id")
    return rows.select("md5", json_attributes(attributes).alias("id"))


def json_attributes(attributes: list[str]) -> Column:
    return F.to_json(attribute_map(attributes))

"""File names that carry a schema: ``<num>_<desc>_[cols]_[status]_<size>k.csv``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.operators.rank import with_position

# Column names as partner files call them.
ALIASES = {
    "civilite": "civi", "prenom": "firstname", "nom": "name", "birth": "naissance",
    "cp": "codepostal", "ville": "city", "sms": "port", "telport": "port", "teldom": "tel",
}

# A broker's tag as names show it; on disk it is written with ``=``, as many stores allow no colon.
_TAG = "regie[:=]"


def brackets(name: Column | str) -> Column:
    """The bracketed parts of a name, in order."""
    return F.regexp_extract_all(name, F.lit(r"\[([^\]]*)\]"), 1)


def front(name: Column | str) -> Column:
    """The parts before the first bracket."""
    head = F.regexp_replace(F.substring_index(name, "[", 1), "_+$", "")
    return F.split(head, "_")


def file_number(name: Column | str) -> Column:
    """Leading number, ``-`` read as the decimal point and ``X`` as ``.9``; null if none."""
    lead = F.replace(F.get(front(name), F.lit(0)), F.lit("-"), F.lit("."))
    lead = F.replace(lead, F.lit("X"), F.lit(".9"))
    return lead.try_cast("double")


def file_text(name: Column | str) -> Column:
    """The file's number as files are asked for: the part of the name before the first ``_``."""
    return F.get(front(name), F.lit(0))


def columns_of(name: Column | str) -> Column:
    """Column names of the first bracket; none gives null."""
    first = F.get(brackets(name), F.lit(0))
    return F.transform(F.split(first, ","), lambda c: F.trim(c))


def statuses_of(name: Column | str) -> Column:
    """Statuses of the later brackets; a broker tag gives the broker's name."""
    all_parts = brackets(name)
    later = F.when(F.size(all_parts) > 1, F.slice(all_parts, 2, F.size(all_parts) - 1)).otherwise(F.array().cast("array<string>"))
    return F.transform(later, lambda s: F.regexp_replace(F.trim(s), f"^{_TAG}", ""))


def broker_of(name: Column | str) -> Column:
    """Broker named by a ``[regie:xx]`` tag, else null."""
    return F.nullif(F.regexp_extract(name, rf"\[{_TAG}([^\]]*)\]", 1), F.lit(""))


def thousands_of(name: Column | str) -> Column:
    """Row count in thousands from the tail of the name, else null."""
    return F.nullif(F.regexp_extract(name, r"_(\d+)k[^_]*$", 1), F.lit("")).cast("int")


def parse_names(files: DataFrame, name: str = "name") -> DataFrame:
    """Add everything a file name says to a frame of file names."""
    return files.select(
        "*",
        file_number(name).alias("number"),
        columns_of(name).alias("header"),
        statuses_of(name).alias("statuses"),
        broker_of(name).alias("broker"),
        thousands_of(name).alias("thousands"),
        F.col(name).rlike("^(OK|PB)").alias("done"),
    )


def _named(path: Column) -> Column:
    """Name of a file, or of its folder for the part files of a Spark export."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    return F.when(last.startswith("part-"), F.element_at(steps, -2)).otherwise(last)


def list_files(spark: SparkSession, folder: str, exports: bool = False) -> DataFrame:
    """Names and sizes of the files of one folder level; contents are not read.

    With ``exports`` the folders that Spark wrote below count as files too.
    Files without any content are listed with size 0: the file system is asked
    for names and sizes, as Spark's readers pass over such files.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    for entry in system.listStatus(root):
        name = entry.getPath().getName()
        if name.startswith((".", "_")):
            continue
        if not entry.isDirectory():
            rows.append((name, entry.getLen()))
        elif exports:
            parts = [p.getLen() for p in system.listStatus(entry.getPath()) if p.getPath().getName().startswith("part-")]
            rows.append((name, sum(parts)))
    return spark.createDataFrame(rows, "name string, bytes long")


def disk_name(name: str) -> str:
    """A name as it is written to disk: broker tags without the colon."""
    return name.replace("[regie:", "[regie=")


def source_file() -> Column:
    """Name of the file a row was read from, as it is on disk.

    The hidden metadata column escapes brackets and blanks, but not ``+``.
    """
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return _named(F.url_decode(escaped)).alias("source_file")


def order_files(files: DataFrame, name: str = "name") -> DataFrame:
    """Files still to be loaded with their place in the load order.

    By number, then by name; names without a number come last.
    """
    todo = parse_names(files, name).filter("NOT done")
    order = [F.col("number").asc_nulls_last(), F.col(name).asc()]
    placed = with_position(todo, order, "place")
    return placed.withColumn("place", F.col("place") + 1)


def with_any_column(files: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Files whose name gives at least one of the wanted columns."""
    return files.filter(F.arrays_overlap("header", F.array(*[F.lit(c) for c in wanted])))


def with_status(files: DataFrame, status: str) -> DataFrame:
    return files.filter(F.array_contains("statuses", status))


def alias_columns(df: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Rename by whole name, so that ``nom`` does not touch ``prenom``."""
    return df.withColumnsRenamed(aliases)


def segment_file_name(
    prefix: str,
    date: str,
    columns: list[str],
    rows: int | None = None,
    mail_unique: bool = False,
    sample: int | None = None,
    comment: str = "",
    short_civility: bool = False,
) -> str:
    """Name of an export file; without ``rows`` the size at the end is left out."""
    shown = ",".join(columns)
    if short_civility:
        shown = ",".join("civi" if c == "civilite" else c for c in columns)
    parts = [prefix + ("-MailUnik" if mail_unique else "")]
    if sample is not None:
        parts.append(f"Sample{sample // 1000}k")
    parts += [date, f"[{shown}]"]
    if comment:
        parts.append(comment)
    if rows is not None:
        parts.append(f"{rows // 1000}k")
    return "_".join(parts) + ".csv"


def membership_file_name(date: str, broker: str, description: str, rows: int) -> str:
    return f"999_ExportRegie_{date}_[mail]_[regie:{broker}]_false_{description}_{rows // 1000}k.csv"

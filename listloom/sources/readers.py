"""Delimited files, single or a folder at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.functions.clean import mail_hash, normal_mail, valid_mail
from listloom.operators.dedupe import drop_missing, first_per_key, sort_unique, text_order
from listloom.sources.encodings import GUESS, TWO_BYTE, decoded, file_encodings, guessed, lines_by, raw_lines
from listloom.sources.names import list_files, order_files, source_file


# One row per file is small enough to broadcast up to this many files.
_FEW_FILES = 100_000


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str],
    sep: str = ";",
    header: bool = False,
    encoding: str = "UTF-8",
    drop_bad: bool = False,
    exports: bool = False,
) -> DataFrame:
    """A delimited file as text columns with the given names.

    Types are never guessed, so leading zeros stay. With ``header`` the first
    line of each file is skipped and the given names are used. With ``exports``
    files in folders below are read too.
    """
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).csv(
        path, sep=sep, header=header, enforceSchema=True, encoding=encoding,
        mode="DROPMALFORMED" if drop_bad else "PERMISSIVE", recursiveFileLookup=exports,
    )


def read_table(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """SQL over frames, which the query names in braces."""
    return spark.sql(query, **tables)


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines with their file, their place in the scan, and whether they are in the file's first block."""
    lines = raw_lines(spark, path, TWO_BYTE.get(encoding))
    if encoding == GUESS:
        return lines_by(spark, path, guessed(lines))
    return lines.withColumn("line", decoded(F.lit(encoding))).drop("raw")


def _without_first(lines: DataFrame) -> DataFrame:
    """Lines without the first one of each file."""
    first = lines.filter("_first_block").groupBy("source_file").agg(F.min("_order").alias("_order"))
    return lines.join(first, ["source_file", "_order"], "left_anti")


def _per_file(df: DataFrame, files: int) -> DataFrame:
    """A frame with one row per file, broadcast when these are few.

    The rows of one large file then need not meet in one task.
    """
    return F.broadcast(df) if files <= _FEW_FILES else df


def sniff(
    spark: SparkSession, path: str, n_rows: int = 5, keep: str = "@", sep: str = ",",
    encoding: str = GUESS,
) -> DataFrame:
    """Per file the number of columns and the leading lines to skip.

    The encoding is guessed file by file unless it is given. Looks at the first ``n_rows`` lines; of these, all but the last are skipped
    when they lack ``keep``. Every file of a folder is looked at in one job; the
    ranking keeps ``n_rows`` lines per file before anything moves.
    """
    lines = _lines(spark, path, encoding).filter("_first_block")
    window = W.partitionBy("source_file").orderBy("_order")
    first = lines.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= n_rows)
    skipped = (F.col("_n") < n_rows) & ~F.col("line").contains(keep)
    return first.groupBy("source_file").agg(
        F.max(F.size(F.split("line", f"[{sep}]"))).alias("n_col"),
        F.collect_set(F.when(skipped, F.col("line"))).alias("skip_lines"),
        F.collect_set(F.when(skipped, F.col("_order"))).alias("skip_at"),
    )


def fit_header(columns: list[str], n_col: int) -> list[str]:
    """Names padded with ``unknown_k`` or cut to the number of columns."""
    padding = [f"unknown_{k + 1}" for k in range(max(0, n_col - len(columns)))]
    return (columns + padding)[:n_col]


def load_text(
    spark: SparkSession, path: str, columns: list[str], sep: str = ",", keep: str = "@",
    encoding: str = GUESS, drop_bad: bool = False,
) -> DataFrame:
    """A file of unknown shape: preamble skipped by its lines' places, names fitted, all other lines kept.

    Short lines are filled with nulls. There are as many columns as the widest line of
    the files under ``path`` has; with ``drop_bad`` as many as the widest of the first lines, and longer lines are dropped.
    """
    found = sniff(spark, path, keep=keep, sep=sep, encoding=encoding)
    first, count = found.agg(F.max("n_col"), F.count(F.lit(1))).first()
    skipped = _per_file(found.select("source_file", "skip_at"), count)
    lines = _lines(spark, path, encoding).join(skipped, "source_file")
    body = lines.filter(~(F.col("_first_block") & F.array_contains("skip_at", F.col("_order"))))
    widest = first if drop_bad else body.agg(F.max(F.size(F.split("line", f"[{sep}]")))).first()[0]
    names = fit_header(columns, widest or len(columns))
    schema = ", ".join(f"`{c}` string" for c in [*names, "_extra"])
    row = F.from_csv("line", schema, {"sep": sep, "mode": "PERMISSIVE"})
    parsed = body.select("source_file", row.alias("_row")).select("source_file", "_row.*")
    if drop_bad:
        parsed = parsed.filter("_extra IS NULL")
    return parsed.select("source_file", *names)


def read_folder(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    sep: str = ";",
    header: bool = False,
    encoding: str | DataFrame = "UTF-8",
    exports: bool = False,
    files: DataFrame | None = None,
) -> DataFrame:
    """All files of a folder in one scan, columns placed by what each name says.

    Gives the wanted ``columns`` (null where a file has none), the file's place
    in the load order, its statuses and its broker tag. ``files`` picks some of
    the ordered files. ``encoding`` is one for all, or ``guess``, or a frame (source_file, encoding); files of
    several encodings take a scan for each kind.
    """
    if files is None:
        files = order_files(list_files(spark, folder, exports))
    files = files.select(
        F.col("name").alias("source_file"), "place", "header", "statuses", "broker"
    )
    widest, count = files.agg(F.max(F.size("header")), F.count(F.lit(1))).first()
    raw = [f"_c{i}" for i in range(widest or 1)]
    if isinstance(encoding, str) and encoding != GUESS:
        rows = read_csv(spark, folder, raw, sep, header, encoding, exports=exports).select(*raw, source_file())
    else:
        if isinstance(encoding, str):
            encoding = file_encodings(spark, folder, files.select(F.col("source_file").alias("name")), exports)
        lines = lines_by(spark, folder, encoding, by_name=True, deep=exports)
        if header:
            lines = _without_first(lines)
        schema = ", ".join(f"`{c}` string" for c in raw)
        parsed = F.from_csv("line", schema, {"sep": sep, "mode": "PERMISSIVE"})
        rows = lines.filter("line <> ''").select("source_file", parsed.alias("_row")).select("_row.*", "source_file")
    rows = rows.join(_per_file(files, count), "source_file")
    values = F.array(*raw)
    placed = [
        F.get(values, F.array_position("header", c).cast("int") - 1).alias(c) for c in columns
    ]
    return rows.select("source_file", "place", "statuses", "broker", *placed)


def status_columns(df: DataFrame, statuses: list[str]) -> DataFrame:
    """One true-or-missing column per status the file names."""
    return df.withColumns(
        {s: F.when(F.array_contains("statuses", s), F.lit(True)) for s in statuses}
    )


def load_status(rows: DataFrame, statuses: list[str], mail: str = "mail") -> DataFrame:
    """Folder rows with mail, one per file and mail, and their status columns."""
    rows = first_per_key(drop_missing(rows, mail), ["source_file", mail], [])
    return status_columns(rows, statuses)


def union_files(rows: DataFrame, mail: str = "mail") -> DataFrame:
    """The distinct mails of all files of a folder, sorted."""
    return drop_missing(rows, mail).select(mail).distinct().orderBy(*text_order(mail))


def mail_only(rows: DataFrame) -> DataFrame:
    return rows.select("mail")


def clean_rows(rows: DataFrame, keys: list[str] | None = None, check_mail: bool = True) -> DataFrame:
    """Incoming rows ready to be matched: mail filled, checked and hashed, rows unique.

    With ``check_mail`` addresses are normalised and badly formed ones dropped;
    ``rejected_rows`` gives those.
    """
    rows = drop_missing(rows, "mail")
    if check_mail:
        rows = rows.filter(valid_mail("mail")).withColumn("mail", normal_mail("mail"))
    return sort_unique(rows, keys).withColumn("md5", mail_hash("mail"))


def rejected_rows(rows: DataFrame) -> DataFrame:
    """Incoming rows without a well-formed address."""
    return rows.filter(~valid_mail("mail"))


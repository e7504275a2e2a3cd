"""The encoding of text files, guessed from the statistics of their bytes, and lines read by it.

All files are looked at in one scan, line by line; a file of any size is dealt to many tasks. Rules in order: a byte order
mark; many zero bytes (two bytes a sign); no byte above 127, or lines that are all but always well-formed UTF-8; else the
single-byte encoding in which most of the high bytes are letters of western languages.

Files are then read in one scan for all encodings of bytes, and one for each order of two-byte signs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.sources.names import source_file

# The name that asks for a guess.
GUESS = "guess"

# Letters and signs beyond ASCII that western contact files hold.
LETTERS = "àâäáãåæçéèêëíìîïñóòôöõøœúùûüÿßÀÂÄÁÃÅÆÇÉÈÊËÍÌÎÏÑÓÒÔÖÕØŒÚÙÛÜŸ€’«»°"

# Fixed value: those of them that are frequent, and count twice.
FREQUENT = "éèêëàâçîïôûùüöäßñ"

# Single-byte encodings that are told apart, by the name Python knows them by; of equal ones the first counts.
SINGLE_BYTE = {"ISO-8859-1": "latin-1", "windows-1252": "cp1252", "IBM850": "cp850", "MacRoman": "mac_roman"}
TWO_BYTE = {"UTF-16LE": "\n\x00", "UTF-16BE": "\x00\n"}
KNOWN = ["UTF-8", *SINGLE_BYTE, *TWO_BYTE]

# All bytes above 127, and the signs that none of Latin-1 has below 160, as Latin-1 reads them.
_HIGH = bytes(range(128, 256)).decode("latin-1")
_CONTROLS = bytes(range(128, 160)).decode("latin-1")
_BOM = "﻿"


def _signs(codec: str) -> str:
    """What the high bytes stand for, one sign each."""
    return "".join(bytes([b]).decode(codec, errors="replace") for b in range(128, 256))


def _among(text: Column, signs: str) -> Column:
    """How many of these signs a text holds."""
    return F.length(text) - F.length(F.translate(text, signs, ""))


def escaped(path: str) -> str:
    """A path whose brackets and other signs are not read as a pattern."""
    return "".join(f"\\{c}" if c in "\\[]{}*?" else c for c in path)


def raw_lines(spark: SparkSession, path: str | list[str], sep: str | None = None, deep: bool = False) -> DataFrame:
    """Lines as bytes, with their file, whether they are in its first block, and their place in the scan."""
    reader = spark.read.option("recursiveFileLookup", deep)
    reader = reader.option("lineSep", sep) if sep else reader
    return reader.text(path).select(
        F.col("value").cast("binary").alias("raw"),
        source_file(),
        (F.col("_metadata.file_block_start") == 0).alias("_first_block"),
        # The same in every scan of these files, as it counts the lines of each block.
        F.monotonically_increasing_id().alias("_order"),
    )


def _paths(folder: str, names: list[str]) -> list[str]:
    return [f"{folder}/{escaped(name)}" for name in names]


def guessed(lines: DataFrame) -> DataFrame:
    """(source_file, encoding) of all files in ``lines``, as ``raw_lines`` gives them."""
    latin = F.decode("raw", "ISO-8859-1")
    # High bytes only: most lines have none.
    lines = lines.select("*", F.regexp_replace(latin, "[\\x00-\\x7F]+", "").alias("_high"), latin.alias("_latin"))
    seen_as = lambda signs, codec: signs.encode(codec, errors="ignore").decode("latin-1")
    scores = {
        name: F.sum(_among(F.col("_high"), seen_as(LETTERS, codec)) + _among(F.col("_high"), seen_as(FREQUENT, codec)))
        for name, codec in SINGLE_BYTE.items()
    }
    facts = lines.groupBy("source_file").agg(
        F.min_by(F.when(F.col("_first_block"), F.hex(F.substring("raw", 1, 4))), F.when(F.col("_first_block"), F.col("_order"))).alias("start"),
        F.sum(F.length("raw")).alias("bytes"),
        F.sum(_among(F.col("_latin"), "\x00")).alias("zeros"),
        F.count_if(F.length("_high") > 0).alias("high_lines"),
        F.count_if(~F.is_valid_utf8(F.col("raw").cast("string"))).alias("broken"),
        F.sum(_among(F.col("_high"), _CONTROLS)).alias("controls"),
        *[score.alias(f"score_{name}") for name, score in scores.items()],
    )
    start, many_zeros = F.coalesce("start", F.lit("")), F.col("zeros") * 5 > F.col("bytes")
    # Latin-1 has no signs below 160, so it is out where there are such bytes.
    ranked = [
        F.struct(F.col(f"score_{name}").alias("score"), F.lit(-k).alias("k"), F.lit(name).alias("name"))
        for k, name in enumerate(SINGLE_BYTE)
    ]
    ranked[0] = F.when(F.col("controls") == 0, ranked[0])
    best = F.array_max(F.filter(F.array(*ranked), lambda x: x.isNotNull()))["name"]
    encoding = (
        F.when(start.startswith("EFBBBF"), "UTF-8")
        .when(start.startswith("FFFE"), "UTF-16LE")
        .when(start.startswith("FEFF"), "UTF-16BE")
        .when(many_zeros & start.startswith("00"), "UTF-16BE")
        .when(many_zeros, "UTF-16LE")
        # A few spoilt lines do not make another encoding.
        .when(F.col("broken") * 10 <= F.col("high_lines"), "UTF-8")
        .otherwise(best)
    )
    return facts.select("source_file", encoding.alias("encoding"))


def file_encodings(spark: SparkSession, folder: str, files: DataFrame, exports: bool = False) -> DataFrame:
    """(source_file, encoding) of these files (name) of a folder; with ``exports`` a name may be a folder of part files."""
    names = [r["name"] for r in files.select("name").collect()]
    return guessed(raw_lines(spark, _paths(folder, names), deep=exports))


def decoded(encoding: Column) -> Column:
    """The text of ``raw`` by the encoding of its file, without a mark at its start and a carriage return at its end."""
    text = F.col("raw").cast("string")
    latin = F.decode("raw", "ISO-8859-1")
    for name, codec in SINGLE_BYTE.items():
        signs = latin if codec == "latin-1" else F.translate(latin, _HIGH, _signs(codec))
        text = F.when(encoding == name, signs).otherwise(text)
    for name in TWO_BYTE:
        text = F.when(encoding == name, F.decode("raw", name)).otherwise(text)
    return F.rtrim(F.ltrim(text, F.lit(_BOM)), F.lit("\r"))


def lines_by(
    spark: SparkSession, path: str, encodings: DataFrame, by_name: bool = False, deep: bool = False
) -> DataFrame:
    """Lines as text, each file by its encoding.

    ``encodings`` (source_file, encoding) has a row for each file. With ``by_name`` these are the names of files in the folder
    ``path``, and only the files of an encoding are read for it; else all below ``path`` are read for each kind.
    """
    told: dict[str, list[str]] = {}
    for row in encodings.collect():
        told.setdefault(row["encoding"] if row["encoding"] in TWO_BYTE else "", []).append(row["source_file"])
    few = F.broadcast(spark.createDataFrame(encodings.collect(), "source_file string, encoding string"))
    scans = []
    for kind, names in told.items():
        lines = raw_lines(spark, _paths(path, names) if by_name else path, TWO_BYTE.get(kind), deep)
        if len(told) > 1 and not by_name:
            lines = lines.filter(F.col("source_file").isin(names))
        scans.append(lines.join(few, "source_file").withColumn("line", decoded(F.col("encoding"))).drop("raw"))
    return reduce(DataFrame.unionByName, scans).select("line", "source_file", "_first_block", "_order")

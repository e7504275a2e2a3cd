"""Column layouts of partner files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.functions.clean import civility, lower_case, strip_decimal
from listloom.functions.dates import birth_format, date_text

# Columns of the partner file, in order.
PARTNER_COLUMNS = [
    "mail", "date", "ip", "civilite", "nom", "prenom", "adresse", "cp", "ville", "birth", "pays",
]

# Columns of the collection file, in order.
COLLECTION_COLUMNS = [
    "mail", "civilite", "nom", "prenom", "telephone", "birth", "cp", "ville", "pays", "date_collecte",
]


def collection_layout(rows: DataFrame, country: str = "France") -> DataFrame:
    """Rows with empty phone number and collection date, as the first split part has them."""
    constants = {"telephone": F.lit(""), "pays": F.lit(country), "date_collecte": F.lit("")}
    return rows.withColumns(constants).select(*COLLECTION_COLUMNS)


def partner_layout(rows: DataFrame, country: str = "france") -> DataFrame:
    """Rows cleaned and arranged for a partner file.

    Date and ip are those of the lead, or empty; nothing is made up.
    """
    for name in ["date", "ip"]:
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    dated = date_text("date", "yyyyMMddHHmmss") if dict(rows.dtypes)["date"] != "string" else F.col("date")
    return rows.select(
        "mail",
        dated.alias("date"),
        "ip",
        strip_decimal(civility("civilite")).alias("civilite"),
        lower_case("nom").alias("nom"),
        lower_case("prenom").alias("prenom"),
        F.lit("").alias("adresse"),
        "cp",
        lower_case("ville").alias("ville"),
        birth_format("birth").alias("birth"),
        F.lit(country).alias("pays"),
    )

"""The logical tables of a contact base, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from listloom import store
from listloom.operators.skew import hot_keys_of_table

_KINDS = {
    "long": LongType(),
    "string": StringType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
}


def _table(**columns: str) -> StructType:
    return StructType([StructField(name, _KINDS[kind]) for name, kind in columns.items()])


# The tables and columns of the contact base.
SCHEMAS: dict[str, StructType] = {
    "base": _table(id="long", mail="string", domain="string"),
    "id": _table(
        id="long", mail_id="long", civilite="string", prenom="string", nom="string",
        cp="string", ville="string", birth="date",
    ),
    "id_unik": _table(
        mail_id="long", civilite="string", prenom="string", nom="string",
        cp="string", ville="string", birth="string",
    ),
    "lead": _table(mail_id="long", ip="string", provenance="string", date="timestamp"),
    "md5": _table(mail_id="long", md5="string"),
    "sms": _table(mail_id="long", port="string"),
    "appetence_list": _table(id="long", interet="string"),
    "appetence_match": _table(mail_id="long", appetence_id="long", score="double"),
    "fichier_list": _table(id="long", fichier_num="string"),
    "fichier_match": _table(mail_id="long", fichier_id="long"),
    "partner_match": _table(mail_id="long", partner_id="long"),
    "regie_list": _table(id="long", abreviation="string"),
    "regie_match": _table(mail_id="long", regie_id="long"),
    "regie_actif": _table(mail_id="long", regie_id="long", date="timestamp"),
    "optin_list": _table(id="long", abreviation="string"),
    "optin_match": _table(mail_id="long", optin_id="long"),
    "optin_desabo": _table(mail_id="long", optin_id="long", comment="string"),
    "base_plainte": _table(mail_id="long"),
    "base_npai": _table(mail_id="long"),
    "base_ouvreur": _table(mail_id="long"),
    "base_mxm": _table(mail_id="long"),
    "base_not_b2c": _table(mail_id="long"),
    "campagne_ouvreur": _table(mail_id="long", ip="string"),
    "log_criteo": _table(mail_id="long"),
    "mot_list": _table(id="long", mot="string", secteur="string", exclusion="boolean"),
    "mot_match": _table(mail_id="long", mot_list_id="long"),
}

# Which file columns belong to which side table.
FIELD_GROUPS: dict[str, list[str]] = {
    "id": ["nom", "prenom", "civilite", "cp", "birth", "ville"],
    "lead": ["ip", "provenance", "date"],
    "md5": ["md5"],
    "sms": ["port"],
    "appetence_match": ["score"],
}

IDENTITY = ["civilite", "prenom", "nom", "cp", "ville", "birth"]


def stored(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A table of a store with the columns of its schema; empty if nothing was written yet. Loads that are not finished are not seen."""
    return store.read(spark, folder, name, schema or SCHEMAS[name])


class Model:
    """Tables by name; each is built the first time it is asked for."""

    def __init__(
        self,
        spark: SparkSession,
        loader: Callable[[str], DataFrame],
        key_source: Callable[[str, str], tuple[DataFrame, str]] | None = None,
        rows: Callable[[str], DataFrame] | None = None,
    ):
        """``key_source`` names, for a derived table, a plain table and column with its keys;
        ``rows`` gives a table that may still hold repeats, where that is cheaper."""
        self.spark = spark
        self._loader = loader
        self._rows = rows
        self.key_source = key_source or (lambda name, key: (self[name], key))
        self._tables: dict[str, DataFrame] = {}
        self._hot: dict[tuple[str, str], list] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Model:
        """One Parquet folder per table, read with the schema of the model; folders of loads are one table.

        A table without a folder is empty. The loads that are finished by now are seen, in all tables the same.
        """
        found = store.marks(spark, folder)
        return cls(spark, lambda name: store.read(spark, folder, name, SCHEMAS[name], found=found))

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str = "default") -> Model:
        """Tables of the session catalog, for example bucketed by contact."""
        return cls(spark, lambda name: spark.table(f"{database}.{name}"))

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> Model:
        """Given frames; tables not given are empty."""
        return cls(
            spark,
            lambda name: frames[name]
            if name in frames
            else spark.createDataFrame([], SCHEMAS[name]),
        )

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._loader(name)
        return self._tables[name]

    def hot(self, name: str, key: str = "mail_id") -> list:
        """Keys that hold a large part of a table; looked up once."""
        if (name, key) not in self._hot:
            self._hot[name, key] = hot_keys_of_table(*self.key_source(name, key))
        return self._hot[name, key]

    def register_views(self, names: list[str] | None = None) -> None:
        """Temporary views, so that ``read_table`` can query the model by name."""
        for name in names or list(SCHEMAS):
            self[name].createOrReplaceTempView(name)

    def rows(self, name: str) -> DataFrame:
        """A table with repeats allowed, for questions of membership only."""
        if self._rows is None:
            return self[name]
        return self._rows(name)

    @cached_property
    def contacts(self) -> DataFrame:
        return self["base"].select("id", "mail")

"""The contact base seen through the driver's benchmark tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.model import Model
from listloom.operators.identity import collapse_identities
from listloom.operators.match import word_hits


# Columns of the driver's tables, so that no file is opened to plan a query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


# Tables that are derived with repeats, which are then taken out.
REPEATED = {
    "fichier_match", "regie_match", "partner_match", "optin_match", "optin_desabo",
    "base_plainte", "base_npai", "base_ouvreur", "campagne_ouvreur", "log_criteo",
}


class DriverTables:
    """Derives each logical table from the Parquet files of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """One of the driver's tables."""
        if name not in self._read:
            path = f"{self.folder}/{name}.parquet"
            self._read[name] = self.spark.read.schema(TABLES[name]).parquet(path)
        return self._read[name]

    def rows(self, name: str) -> DataFrame:
        """A logical table, for some with repeats still in it.

        ``part`` and ``documents`` are passed through for names and texts.
        """
        if name in ("part", "documents"):
            return self.raw(name)
        return getattr(self, f"_{name}")()

    def load(self, name: str) -> DataFrame:
        df = self.rows(name)
        return df.distinct() if name in REPEATED else df

    def _lines(self, *columns: str) -> DataFrame:
        """Line items with the customer of their order."""
        lines = self.raw("lineitem").select("l_orderkey", *columns)
        orders = self.raw("orders").select("o_orderkey", "o_custkey")
        return lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey"))

    def _events(self, kind: str) -> DataFrame:
        return self.raw("events").filter(F.col("event_type") == kind)

    def _base(self) -> DataFrame:
        domain = F.concat(F.lower("c_mktsegment"), F.lit(".example"))
        name = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
        return self.raw("customer").select(
            F.col("c_custkey").alias("id"),
            F.concat(name, F.lit("@"), domain).alias("mail"),
            domain.alias("domain"),
        )

    def _id(self) -> DataFrame:
        customers = self.raw("customer").join(
            self.raw("nation"), F.col("n_nationkey") == F.col("c_nationkey")
        )
        orders = self.raw("orders").join(customers, F.col("c_custkey") == F.col("o_custkey"))
        civilite = F.when(F.col("o_orderstatus") == "P", "1.0").when(
            F.col("o_orderstatus") == "F", "2.0"
        )
        cp = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("000"))
        return orders.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("mail_id"),
            civilite.alias("civilite"),
            F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("prenom"),
            F.col("c_mktsegment").alias("nom"),
            cp.alias("cp"),
            F.col("n_name").alias("ville"),
            F.col("o_orderdate").cast("date").alias("birth"),
        )

    def _id_unik(self) -> DataFrame:
        return collapse_identities(self.load("id"))

    def _lead(self) -> DataFrame:
        last = (F.col("event_id") % 250).cast("string")
        return self._events("signup").select(
            F.col("user_id").alias("mail_id"),
            F.concat(F.lit("10.0.0."), last).alias("ip"),
            F.col("props").alias("provenance"),
            F.col("ts").alias("date"),
        )

    def _md5(self) -> DataFrame:
        return self.load("base").select(F.col("id").alias("mail_id"), F.md5("mail").alias("md5"))

    def _sms(self) -> DataFrame:
        customers = self.raw("customer").filter(F.col("c_acctbal") > 5000)
        contacts = customers.select(
            F.col("c_custkey").alias("mail_id"), F.col("c_nationkey").cast("long").alias("port")
        )
        strangers = self.raw("supplier").select(
            (F.col("s_suppkey") + 1000000).alias("mail_id"),
            F.col("s_nationkey").cast("long").alias("port"),
        )
        return contacts.unionAll(strangers)

    def _fichier_list(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("fichier_num")
        )

    def _fichier_match(self) -> DataFrame:
        return self._lines("l_partkey").select(
            F.col("o_custkey").alias("mail_id"), F.col("l_partkey").alias("fichier_id")
        )

    def _regie_list(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("abreviation")
        )

    def _regie_match(self) -> DataFrame:
        return self._lines("l_suppkey", "l_quantity").filter("l_quantity > 45").select(
            F.col("o_custkey").alias("mail_id"), F.col("l_suppkey").alias("regie_id")
        )

    def _regie_actif(self) -> DataFrame:
        lines = self._lines("l_suppkey", "l_shipdate", "l_returnflag")
        return (
            lines.filter(F.col("l_returnflag") == "N")
            .groupBy(F.col("o_custkey").alias("mail_id"), F.col("l_suppkey").alias("regie_id"))
            .agg(F.max("l_shipdate").alias("date"))
        )

    def _partner_match(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_custkey").alias("mail_id"), F.col("o_orderpriority").alias("partner_id")
        )

    def _optin_list(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("abreviation")
        )

    def _optin_match(self) -> DataFrame:
        lines = self._lines("l_suppkey", "l_quantity").filter("l_quantity > 40")
        suppliers = self.raw("supplier").select("s_suppkey", "s_nationkey")
        return lines.join(suppliers, F.col("s_suppkey") == F.col("l_suppkey")).select(
            F.col("o_custkey").alias("mail_id"), F.col("s_nationkey").alias("optin_id")
        )

    def _optin_desabo(self) -> DataFrame:
        comment = F.when(F.col("value") > 40, "spam").when(F.col("value") > 20, "npai")
        return self._events("error").select(
            F.col("user_id").alias("mail_id"),
            (F.col("event_id") % 25).cast("int").alias("optin_id"),
            comment.otherwise("other").alias("comment"),
        )

    def _base_plainte(self) -> DataFrame:
        return self._events("error").filter("value > 60").select(
            F.col("user_id").alias("mail_id")
        )

    def _base_npai(self) -> DataFrame:
        return self.raw("orders").filter("o_totalprice > 490000").select(
            F.col("o_custkey").alias("mail_id")
        )

    def _base_ouvreur(self) -> DataFrame:
        return self._events("view").filter("value > 30").select(
            F.col("user_id").alias("mail_id")
        )

    def _campagne_ouvreur(self) -> DataFrame:
        last = (F.col("event_id") % 250).cast("string")
        return self._events("click").select(
            F.col("user_id").alias("mail_id"), F.concat(F.lit("10.0.1."), last).alias("ip")
        )

    def _log_criteo(self) -> DataFrame:
        return self._events("purchase").select(F.col("user_id").alias("mail_id"))

    def _base_mxm(self) -> DataFrame:
        return self.raw("customer").filter("c_custkey % 11 = 3").select(F.col("c_custkey").alias("mail_id"))

    def _base_not_b2c(self) -> DataFrame:
        return self.raw("customer").filter("c_nationkey = 5").select(F.col("c_custkey").alias("mail_id"))

    def _mot_list(self) -> DataFrame:
        digit = F.col("r_regionkey").cast("string")
        return self.raw("region").select(
            F.col("r_regionkey").alias("id"),
            F.concat(digit, digit, F.lit("@")).alias("mot"),
            F.col("r_name").alias("secteur"),
            (F.col("r_regionkey") < 3).alias("exclusion"),
        )

    def _mot_match(self) -> DataFrame:
        return word_hits(self.load("base"), self.load("mot_list").filter("exclusion"))

    def _appetence_list(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("id"), F.col("p_type").alias("interet")
        )

    def _appetence_match(self) -> DataFrame:
        return self._lines("l_partkey", "l_quantity").groupBy(
            F.col("o_custkey").alias("mail_id"), F.col("l_partkey").alias("appetence_id")
        ).agg(F.sum("l_quantity").alias("score"))

    def _dirty_id(self) -> DataFrame:
        kind = F.col("o_orderkey") % 6
        civilite = (
            F.when(kind == 0, "1.0").when(kind == 1, "2.0").when(kind == 2, "3.0")
            .when(kind == 3, "4.0").when(kind == 4, "nan")
        )
        tail = F.when(F.col("o_orderkey") % 2 == 0, ".0").otherwise("")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("id"),
            civilite.alias("civilite"),
            F.concat(F.lpad((F.col("o_custkey") % 98).cast("string"), 5, "0"), tail).alias("cp"),
            F.col("o_orderdate").cast("date").alias("birth"),
        )


# The driver's column that a key of a logical table comes from.
KEY_SOURCES = {
    ("id", "mail_id"): ("orders", "o_custkey"),
    ("lead", "mail_id"): ("events", "user_id"),
    ("campagne_ouvreur", "mail_id"): ("events", "user_id"),
    ("sms", "mail_id"): ("customer", "c_custkey"),
    ("fichier_match", "mail_id"): ("orders", "o_custkey"),
    ("fichier_match", "fichier_id"): ("lineitem", "l_partkey"),
    ("regie_match", "mail_id"): ("orders", "o_custkey"),
    ("regie_match", "regie_id"): ("lineitem", "l_suppkey"),
    ("regie_actif", "mail_id"): ("orders", "o_custkey"),
    ("md5", "mail_id"): ("customer", "c_custkey"),
    ("partner_match", "mail_id"): ("orders", "o_custkey"),
    ("optin_match", "mail_id"): ("orders", "o_custkey"),
    ("optin_desabo", "mail_id"): ("events", "user_id"),
    ("base_plainte", "mail_id"): ("customer", "c_custkey"),
    ("base_npai", "mail_id"): ("customer", "c_custkey"),
    ("base_ouvreur", "mail_id"): ("customer", "c_custkey"),
    ("base_mxm", "mail_id"): ("customer", "c_custkey"),
    ("base_not_b2c", "mail_id"): ("customer", "c_custkey"),
    ("id_unik", "mail_id"): ("customer", "c_custkey"),
    ("log_criteo", "mail_id"): ("customer", "c_custkey"),
    ("mot_match", "mail_id"): ("customer", "c_custkey"),
    ("appetence_match", "mail_id"): ("orders", "o_custkey"),
    ("appetence_match", "appetence_id"): ("lineitem", "l_partkey"),
}


@lru_cache(maxsize=4)
def driver_model(spark: SparkSession, folder: str) -> Model:
    """The model over one folder. Kept for the session: it holds plans, not data."""
    tables = DriverTables(spark, folder)

    def key_source(name: str, key: str) -> tuple[DataFrame, str]:
        raw, column = KEY_SOURCES[name, key]
        return tables.raw(raw), column

    return Model(spark, tables.load, key_source, tables.rows)

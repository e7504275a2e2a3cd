"""A segment of the contact base: who is in, who is out, which columns."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.functions.clean import any_of
from listloom.model import IDENTITY, Model
from listloom.operators.dedupe import first_per_key, identity_key
from listloom.operators.joins import (
    all_keys,
    keep_in,
    keep_out,
    keys_of,
    left_many,
    left_one,
    listed_keys,
)

# Comments of an unsubscribe row that count as a suppression.
UNWANTED = ["spam", "npai"]




@dataclass(frozen=True)
class Segment:
    """Conditions on contacts, all of which must hold.

    Each method gives a new segment. Nothing runs until the result is used.
    """

    model: Model
    inside: tuple[DataFrame, ...] = field(default=())
    outside: tuple[DataFrame, ...] = field(default=())

    # -- conditions -----------------------------------------------------

    def member_of(self, *sets: DataFrame) -> Segment:
        """In every one of the sets of ``mail_id``; the sets may hold repeats."""
        return replace(self, inside=self.inside + sets)

    def not_member_of(self, *sets: DataFrame) -> Segment:
        """In none of the sets of ``mail_id``."""
        return replace(self, outside=self.outside + sets)

    def partner(self, *ids) -> Segment:
        return self.member_of(self.partner_keys(*ids))

    def not_partner(self, *ids) -> Segment:
        return self.not_member_of(self.partner_keys(*ids))

    def file(self, *numbers: str) -> Segment:
        return self.member_of(self.file_keys(*numbers))

    def not_file(self, *numbers: str) -> Segment:
        return self.not_member_of(self.file_keys(*numbers))

    def broker(self, *names: str) -> Segment:
        return self.member_of(self.broker_keys(*names))

    def not_broker(self, *names: str) -> Segment:
        return self.not_member_of(self.broker_keys(*names))

    def broker_id(self, *ids: int) -> Segment:
        return self.member_of(self.broker_id_keys(*ids))

    def not_broker_id(self, *ids: int) -> Segment:
        return self.not_member_of(self.broker_id_keys(*ids))

    def active(self) -> Segment:
        """Active at any broker."""
        return self.member_of(keys_of(self.model.rows("regie_actif")))

    def active_at(self, *patterns: str) -> Segment:
        """Active at a broker whose name contains one of the alternatives."""
        chosen = any_of("abreviation", list(patterns), whole=False)
        return self.member_of(self._listed("regie_actif", "regie_id", "regie_list", chosen))

    def opted_in(self, *names: str) -> Segment:
        return self.member_of(self.optin_keys("optin_match", *names))

    def not_opted_in(self, *names: str) -> Segment:
        return self.not_member_of(self.optin_keys("optin_match", *names))

    def not_unsubscribed(self, *names: str) -> Segment:
        return self.not_member_of(self.optin_keys("optin_desabo", *names))

    def suppress(self, *names: str) -> Segment:
        """Without the contacts of the named suppression tables."""
        return self.not_member_of(*[self.named_keys(name) for name in names])

    def only(self, *names: str) -> Segment:
        """Only contacts of the named tables (openers, ad log)."""
        return self.member_of(*[self.named_keys(name) for name in names])

    # -- key sets -------------------------------------------------------

    def named_keys(self, name: str) -> DataFrame:
        if name == "spam":
            desabo = self.model.rows("optin_desabo")
            return keys_of(desabo.filter(F.col("comment").isin(UNWANTED)))
        tables = {
            "plainte": "base_plainte",
            "mot": "mot_match",
            "npai": "base_npai",
            "ouvreur": "base_ouvreur",
            "ouvreur_campagne": "campagne_ouvreur",
            "criteo": "log_criteo",
            "mxm": "base_mxm",
            "not_b2c": "base_not_b2c",
        }
        return keys_of(self.model.rows(tables[name]))

    def _listed(self, table: str, link: str, names: str, chosen: Column) -> DataFrame:
        return listed_keys(self.model.rows(table), link, self.model[names], chosen)

    def partner_keys(self, *ids) -> DataFrame:
        match = self.model.rows("partner_match")
        return keys_of(match.filter(F.col("partner_id").isin(list(ids))))

    def file_keys(self, *numbers: str) -> DataFrame:
        chosen = F.col("fichier_num").isin(list(numbers))
        return self._listed("fichier_match", "fichier_id", "fichier_list", chosen)

    def broker_keys(self, *names: str) -> DataFrame:
        chosen = F.col("abreviation").isin(list(names))
        return self._listed("regie_match", "regie_id", "regie_list", chosen)

    def broker_id_keys(self, *ids: int) -> DataFrame:
        return keys_of(self.model.rows("regie_match").filter(F.col("regie_id").isin(list(ids))))

    def optin_keys(self, table: str, *names: str) -> DataFrame:
        chosen = F.col("abreviation").isin(list(names))
        return self._listed(table, "optin_id", "optin_list", chosen)

    # -- results --------------------------------------------------------

    def restrict(self, df: DataFrame, on: str = "id") -> DataFrame:
        """The rows of any frame whose contact is in the segment.

        Semi joins for membership, then one anti join to the union of all
        suppressions. All use the same key, so the frame is shuffled once.
        """
        for keys in self.inside:
            df = keep_in(df, keys, on)
        if self.outside:
            df = keep_out(df, all_keys(*self.outside), on)
        return df

    def contacts(self) -> DataFrame:
        """(id, mail) of the contacts in the segment."""
        return self.restrict(self.model.contacts)

    def mails(self) -> DataFrame:
        return self.contacts().select("mail")

    def with_identity(self, columns: list[str] = IDENTITY, id_table: str = "id") -> DataFrame:
        """Contacts with one row per identity; contacts without one stay."""
        side = self.model[id_table].select("mail_id", *columns)
        if id_table == "id_unik":
            return left_one(self.contacts(), side)
        return self.fan_out(self.contacts(), side, "id")

    def fan_out(
        self, rows: DataFrame, side: DataFrame, table: str, unique: bool = True
    ) -> DataFrame:
        """Left join of contact rows to the rows of a table with any number per contact.

        ``side`` holds columns of the whole table; ``unique`` tells that ``rows``
        holds each contact once.
        """
        return left_many(rows, side, hot=self.model.hot(table), unique=unique)

    def select(
        self, kind: str = "classic", id_table: str = "id", keep_reference: bool = False
    ) -> DataFrame:
        """One of the four projections: classic, ip, provenance, identity_latest.

        ``keep_reference`` makes identity_latest put all contacts without identity into
        one group, as DISTINCT ON does; by default none of them is lost.
        """
        if kind == "identity_latest":
            side = self.model["id"].select("mail_id", F.col("id").alias("identity_id"), *IDENTITY)
            rows = self.fan_out(self.contacts(), side, "id")
            key = F.col("identity_id") if keep_reference else identity_key()
            order = [F.col("identity_id").desc_nulls_first()]
            rows = rows.select("identity_id", "mail", *IDENTITY, key.alias("_key"))
            return first_per_key(rows, ["_key"], order).select("mail", *IDENTITY)
        extra = {
            "classic": [],
            "ip": ["ip"],
            "provenance": ["ip", "provenance", "date"],
        }[kind]
        if not extra:
            return self.with_identity(IDENTITY, id_table).select("mail", *IDENTITY).distinct()
        table = {"ip": "campagne_ouvreur", "provenance": "lead"}[kind]
        # Repeats go before the two one-to-many joins multiply them.
        packed = id_table == "id_unik"
        if packed:
            rows = self.with_identity(IDENTITY, id_table)
        else:
            identity = self.model["id"].select("mail_id", *IDENTITY).distinct()
            rows = self.fan_out(self.contacts(), identity, "id")
        side = self.model[table].select("mail_id", *extra).distinct()
        rows = self.fan_out(rows, side, table, unique=packed)
        return rows.select("mail", *IDENTITY, *extra).distinct()

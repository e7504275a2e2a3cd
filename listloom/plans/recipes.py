"""The standing extracts: partner, broker, file, opt-in, SMS and hash segments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.functions.clean import (
    WEBMAIL,
    any_of,
    department,
    has_ip,
    strip_decimal,
    trimmed,
)
from listloom.functions.dates import century_repair
from listloom.model import IDENTITY, Model
from listloom.operators.dedupe import (
    clean_up,
    drop_missing,
    first_per_key,
    sort_unique,
    text_order,
)
from listloom.operators.joins import (
    all_keys,
    flag_suppress,
    inner_on,
    keep_in,
    keep_out,
    keys_of,
    left_many,
    left_one,
    listed_keys,
    right_one,
)
from listloom.operators.sample import capped_sample_by, exact_sample, lowest_hashes, top_by
from listloom.operators.setops import stack
from listloom.plans.segment import Segment

# The suppressions of the two usual kinds of extract.
PARTNER_SUPPRESSION = ["plainte", "mot", "spam"]
FILE_SUPPRESSION = ["plainte", "mot", "npai"]
NON_WEBMAIL_SUPPRESSION = ["mxm", "npai", "plainte", "not_b2c"]

LEAD = ["ip", "provenance", "date"]


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    """The first rows in the order of all columns."""
    return df if limit is None else df.orderBy(*text_order(*df.columns)).limit(limit)


def _identities(model: Model, rows: DataFrame, unique: bool = True) -> DataFrame:
    """Contact rows with one row per identity; contacts without one stay."""
    return Segment(model).fan_out(rows, model["id"].select("mail_id", *IDENTITY), "id", unique)


def _leads(model: Model, rows: DataFrame) -> DataFrame:
    """Identity rows with one row per lead; rows without one stay."""
    return Segment(model).fan_out(rows, model["lead"], "lead", unique=False)


def _links(model: Model, table: str, link: str, names: DataFrame) -> DataFrame:
    """Rows of a match table, repeats allowed, with the columns of the given list entries."""
    return inner_on(model.rows(table), names, link, "id", many="rows", hot=model.hot(table, link))


# -- in common with a partner or a file, not yet at a broker ----------------


def _not_yet_at(model: Model, people: DataFrame, brokers: list[str]) -> DataFrame:
    """One copy of the contacts per broker, without those the broker has."""
    names = model["regie_list"].filter(F.col("abreviation").isin(brokers))
    held = _links(model, "regie_match", "regie_id", names).select(
        F.col("mail_id").alias("_m"), F.col("abreviation").alias("_b")
    ).distinct()
    copies = people.withColumn("broker", F.explode(F.array(*[F.lit(b) for b in brokers])))
    taken = (F.col("id") == F.col("_m")) & (F.col("broker") == F.col("_b"))
    return copies.join(held, taken, "left_anti")


def common_with_partner(model: Model, partner, brokers: list[str]) -> DataFrame:
    """Shared with the partner, new to each broker, without suppressed contacts."""
    people = Segment(model).partner(partner).suppress(*PARTNER_SUPPRESSION).contacts()
    rows = _identities(model, _not_yet_at(model, people, brokers))
    return rows.select("broker", "mail", *IDENTITY)


def common_with_file(model: Model, files: list[str], brokers: list[str]) -> DataFrame:
    """From each file, new to each broker, without suppressed contacts."""
    names = model["fichier_list"].filter(F.col("fichier_num").isin(files))
    held = _links(model, "fichier_match", "fichier_id", names)
    held = held.select("mail_id", "fichier_num").distinct()
    people = Segment(model).suppress(*PARTNER_SUPPRESSION).contacts()
    people = inner_on(people, held, hot=model.hot("fichier_match"))
    rows = _identities(model, _not_yet_at(model, people, brokers))
    return rows.select("fichier_num", "broker", "mail", *IDENTITY)


# -- brokers, files, opt-ins -------------------------------------------------


def active_openers(model: Model, broker_patterns: list[str]) -> DataFrame:
    """Openers active at the named brokers, one row per identity and activity date."""
    people = (
        Segment(model).only("ouvreur").active_at(*broker_patterns)
        .suppress("plainte", "mot").contacts()
    )
    activity = model["regie_actif"].select("mail_id", "date")
    dated = inner_on(people, activity, hot=model.hot("regie_actif"))
    rows = _identities(model, dated, unique=False)
    return rows.select("mail", "date", *IDENTITY)


def file_clean(model: Model, files: list[str], openers: bool = True) -> DataFrame:
    """Contacts of the files without suppressed ones, and without openers if asked."""
    segment = Segment(model).file(*files).suppress(*FILE_SUPPRESSION)
    if not openers:
        segment = segment.suppress("ouvreur")
    return segment.with_identity().select("mail", *IDENTITY)


def partner_identities(model: Model, partners: list) -> DataFrame:
    """One row per identity of contacts shared with the partners."""
    segment = Segment(model).partner(*partners).suppress("plainte", "mot", "npai", "spam")
    return segment.select("identity_latest")


def optin_minus_unsubscribed(model: Model, optin: str) -> DataFrame:
    segment = Segment(model).opted_in(optin).not_unsubscribed(optin)
    names = ["civilite", "prenom", "nom"]
    return segment.with_identity(names).select("mail", *names)


def broker_optin(model: Model, broker: str, optin: str) -> DataFrame:
    """At the broker and opted in, minus unsubscribed and suppressed."""
    segment = (
        Segment(model).broker(broker).opted_in(optin)
        .not_unsubscribed(optin).suppress(*FILE_SUPPRESSION)
    )
    return segment.with_identity().select("mail", *IDENTITY)


def optin_difference(model: Model, wanted: str, unwanted: str) -> DataFrame:
    return Segment(model).opted_in(wanted).not_opted_in(unwanted).mails()


# -- hashes --------------------------------------------------------------------


def hash_export(model: Model, files: list[str], cap: int | None = None) -> DataFrame:
    """Hashes of a file without suppressed contacts and openers, capped in hash order."""
    segment = Segment(model).file(*files).suppress(*FILE_SUPPRESSION, "ouvreur")
    hashes = segment.restrict(model["md5"], "mail_id").select("md5").distinct()
    if cap is None:
        return hashes
    return lowest_hashes(hashes, cap, 0, ["md5"], digest=F.col("md5"))


def hashes_of_files(model: Model, file_ids: list[int]) -> DataFrame:
    """Distinct hashes of the contacts of files given by id."""
    match = model.rows("fichier_match").filter(F.col("fichier_id").isin(file_ids))
    return keep_in(model["md5"], match, "mail_id").select("md5").distinct()


def known_hashes(model: Model) -> DataFrame:
    """Distinct hashes known to any broker or any partner."""
    keys = all_keys(keys_of(model.rows("regie_match")), keys_of(model.rows("partner_match")))
    return keep_in(model["md5"], keys, "mail_id").select("md5").distinct()


def mail_and_hash(model: Model, broker_id: int) -> DataFrame:
    people = Segment(model).broker_id(broker_id).contacts()
    return left_one(people, model["md5"]).select("mail", "md5")


def optin_mails(model: Model, optin_id: int) -> DataFrame:
    match = model.rows("optin_match").filter(F.col("optin_id") == optin_id)
    return Segment(model).member_of(keys_of(match)).mails()


def _first_side(df: DataFrame, columns: list[str]) -> DataFrame:
    """The first row per contact in column order."""
    side = df.select("mail_id", *columns)
    return first_per_key(side, ["mail_id"], text_order(*columns))


def one_per_hash(
    model: Model, partner=None, broker_ids: list[int] | None = None, suppress: list[str] | None = None
) -> DataFrame:
    """One row per md5 with mail, identity, lead and campaign ip (``ip2``).

    The first row in column order is taken. Each side is cut to its first row
    per contact before the join, which gives the same row without building all
    combinations of identities, leads and opens.
    """
    segment = Segment(model)
    if partner is not None:
        segment = segment.partner(partner)
    if broker_ids:
        segment = segment.not_broker_id(*broker_ids)
    if suppress:
        segment = segment.suppress(*suppress)
    lead = ["provenance", "date", "ip"]
    opens = _first_side(model["campagne_ouvreur"].withColumnRenamed("ip", "ip2"), ["ip2"])
    rows = segment.restrict(model["md5"], "mail_id")
    rows = left_one(rows, model.contacts.withColumnRenamed("id", "_id"), "mail_id", "_id")
    rows = left_one(rows, _first_side(model["id"], IDENTITY), "mail_id")
    rows = left_one(rows, _first_side(model["lead"], lead), "mail_id")
    rows = left_one(rows, opens, "mail_id")
    columns = ["md5", "mail", *IDENTITY, *lead, "ip2"]
    return first_per_key(rows.select(*columns), ["md5"], [])


def hashes_with_ip(rows: DataFrame) -> DataFrame:
    """Rows of ``one_per_hash`` where one of the two ip columns is filled."""
    return rows.filter(has_ip("ip", "ip2"))


def one_per_mail(model: Model, files: list[str]) -> DataFrame:
    """One row per mail of the files, the first in column order."""
    people = Segment(model).file(*files).suppress(*FILE_SUPPRESSION).contacts()
    rows = left_one(people, _first_side(model["id"], IDENTITY)).select("mail", *IDENTITY)
    return first_per_key(rows, ["mail"], [])


# -- qualified contacts, departments, black lists ------------------------------


def qualified_leads(model: Model, broker_id: int) -> DataFrame:
    """Active contacts with civility, postcode and birth, not at the broker."""
    people = (
        Segment(model).active().not_broker_id(broker_id).suppress(*FILE_SUPPRESSION).contacts()
    )
    full = model["id"].select("mail_id", *IDENTITY)
    for name in ["civilite", "cp", "birth"]:
        full = full.filter(F.col(name).isNotNull())
    rows = _leads(model, inner_on(people, full, hot=model.hot("id")))
    return rows.select("mail", *IDENTITY, "ip", "date", "provenance")


def by_department(model: Model, departments: list[str]) -> DataFrame:
    places = model["id"].filter(department("cp").isin(departments))
    segment = Segment(model).member_of(keys_of(places)).suppress(*PARTNER_SUPPRESSION)
    return segment.mails().distinct()


def by_town_or_department(model: Model, town: str, dept: str) -> DataFrame:
    places = model["id"].filter((F.col("ville") == town) | (department("cp") == dept))
    return Segment(model).member_of(keys_of(places)).mails().distinct()


def black_list(model: Model, files: list[str]) -> DataFrame:
    """Contacts of the files that any suppression names."""
    segment = Segment(model)
    unwanted = all_keys(*[segment.named_keys(name) for name in PARTNER_SUPPRESSION])
    return segment.file(*files).member_of(unwanted).mails()


def partner_openers(model: Model, partners: list, broker: str) -> DataFrame:
    """Shared with the partners and not at the broker: packed identity and opener ip."""
    segment = Segment(model).partner(*partners).not_broker(broker).suppress(*PARTNER_SUPPRESSION)
    return segment.select("ip", id_table="id_unik")


def youngest(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """The ``n`` rows of latest birth date; rows without one come first."""
    return top_by(df, n, "birth", 0, keys)


# -- SMS -----------------------------------------------------------------------


def _sms_rows(model: Model, people: DataFrame, join) -> DataFrame:
    rows = join(people, model["sms"])
    return _identities(model, rows, unique=False).select("mail", "port", *IDENTITY)


def sms_all(model: Model) -> DataFrame:
    """All numbers, with contact and identity where there is one."""
    return _sms_rows(model, model.contacts, right_one)


def sms_prefiltered(model: Model) -> DataFrame:
    """All numbers; suppressed contacts come without their contact columns."""
    people = Segment(model).suppress(*FILE_SUPPRESSION).contacts()
    return _sms_rows(model, people, right_one)


def sms_from_file(model: Model, files: list[str]) -> DataFrame:
    people = Segment(model).file(*files).suppress(*FILE_SUPPRESSION).contacts()
    return _sms_rows(model, people, inner_on)


def sms_with_partner(model: Model, partner) -> DataFrame:
    spam = model.rows("optin_desabo").filter(F.col("comment") == "spam")
    segment = Segment(model).partner(partner).suppress("plainte")
    people = segment.not_member_of(keys_of(spam)).contacts()
    return _sms_rows(model, people, inner_on)


# -- full profiles ---------------------------------------------------------------


def _profiles(model: Model, lead: DataFrame, identity: DataFrame) -> DataFrame:
    rows = inner_on(model.contacts, identity, hot=model.hot("id"))
    rows = inner_on(rows, lead, hot=model.hot("lead"), unique=False)
    return rows.select("mail", *IDENTITY, *LEAD)


def profiles_with_lead_date(model: Model) -> DataFrame:
    """Contact, identity and lead where the lead is dated."""
    lead = model["lead"].filter(F.col("date").isNotNull())
    return _profiles(model, lead, model["id"].select("mail_id", *IDENTITY))


def profiles_with_any_name(model: Model, limit: int | None = None) -> DataFrame:
    """Contacts with a first name, a name or a civility."""
    named = reduce(
        Column.__or__, [F.col(c).isNotNull() for c in ["prenom", "nom", "civilite"]]
    )
    identity = model["id"].filter(named).select("mail_id", *IDENTITY)
    return _limited(_profiles(model, model["lead"], identity), limit)


def profiles_with_ip(model: Model, limit: int | None = None) -> DataFrame:
    lead = model["lead"].filter(F.col("ip").isNotNull())
    return _limited(_profiles(model, lead, model["id"].select("mail_id", *IDENTITY)), limit)


def profiles_with_hash(model: Model, limit: int | None = None) -> DataFrame:
    """All contacts with hash, identity and, for those with identity, lead."""
    identity = model["id"].select("mail_id", *IDENTITY)
    with_lead = left_many(identity, model["lead"], "mail_id", hot=model.hot("lead"), unique=False)
    rows = left_many(left_one(model.contacts, model["md5"]), with_lead, hot=model.hot("id"))
    return _limited(rows.select("mail", "md5", *IDENTITY, *LEAD), limit)


def mails_and_hashes(model: Model) -> DataFrame:
    return inner_on(model.contacts, model["md5"], hot=[]).select("mail", "md5")


def hashes_with_civility(model: Model) -> DataFrame:
    """Distinct mail, hash and civility of contacts with a dated lead."""
    dated = model["lead"].filter(F.col("date").isNotNull())
    civil = model["id"].filter(F.col("civilite").isNotNull()).select("mail_id", "civilite")
    rows = inner_on(keep_in(model.contacts, dated), model["md5"], hot=[])
    # A contact has few distinct civilities, so no key of this side is hot.
    return inner_on(rows, civil.distinct(), hot=[]).select("mail", "md5", "civilite").distinct()


def file_profiles(model: Model, file_id: int) -> DataFrame:
    """Contacts of one file with identity and lead."""
    match = model.rows("fichier_match").filter(F.col("fichier_id") == file_id)
    people = Segment(model).member_of(keys_of(match))
    rows = _leads(model, people.with_identity())
    return rows.select("mail", *IDENTITY, *LEAD)


def file_interests(model: Model, file_id: int) -> DataFrame:
    """Interests and scores of the contacts of one file."""
    match = model.rows("fichier_match").filter(F.col("fichier_id") == file_id)
    people = Segment(model).member_of(keys_of(match)).contacts()
    scored = _links(model, "appetence_match", "appetence_id", model["appetence_list"])
    rows = inner_on(people, scored, hot=model.hot("appetence_match"))
    return rows.select("mail", "interet", "score")


# -- by file number ---------------------------------------------------------------


def _file_links(model: Model, patterns: list[str], match: DataFrame) -> DataFrame:
    files = model["fichier_list"].filter(any_of("fichier_num", patterns)).select("id")
    return keep_in(
        match, files, "fichier_id", "id",
        repeats=True, hot=model.hot("fichier_match", "fichier_id"),
    )


def by_file_pattern(model: Model, patterns: list[str]) -> DataFrame:
    """Mail and file id for files whose whole number matches an alternative."""
    rows = inner_on(model.contacts, _file_links(model, patterns, model["fichier_match"]), hot=model.hot("fichier_match"))
    return rows.select("mail", "fichier_id")


def qualified_by_file_pattern(model: Model, patterns: list[str]) -> DataFrame:
    """Identity and lead of contacts with birth and civility, from the matching files."""
    full = model["id"].filter(F.col("birth").isNotNull() & F.col("civilite").isNotNull())
    people = Segment(model).member_of(keys_of(_file_links(model, patterns, model.rows("fichier_match")))).contacts()
    rows = inner_on(people, full.select("mail_id", *IDENTITY), hot=model.hot("id"))
    rows = inner_on(rows, model["lead"], hot=model.hot("lead"), unique=False)
    return rows.select("mail", *IDENTITY, *LEAD)


def main_number(number: Column | str) -> Column:
    """Part of a file number before the first dash."""
    return F.substring_index(number, "-", 1)


def non_webmail_by_file(
    model: Model,
    files: list[str],
    domains: list[str] = WEBMAIL,
    cap: int = 2_000_000,
    seed: int = 0,
    suppress: list[str] | None = None,
) -> DataFrame:
    """Per listed file the unsuppressed contacts off the webmail domains, sampled to ``cap``."""
    unwanted = suppress or NON_WEBMAIL_SUPPRESSION
    named = model["fichier_list"].filter(main_number(F.col("fichier_num")).isin(files))
    held = _links(model, "fichier_match", "fichier_id", named)
    held = held.select("mail_id", "fichier_num").distinct()
    people = model["base"].filter(~F.col("domain").isin(domains)).select("id", "mail")
    people = Segment(model).suppress(*unwanted).restrict(people)
    rows = inner_on(people, held, hot=model.hot("fichier_match")).select("fichier_num", "mail")
    return capped_sample_by(rows, "fichier_num", cap, seed, ["mail"])


# -- outside files ------------------------------------------------------------------


def suppression_mails(model: Model, names: list[str]) -> DataFrame:
    """Mails of the contacts that any of the named suppressions holds."""
    segment = Segment(model)
    return segment.member_of(all_keys(*[segment.named_keys(n) for n in names])).mails()


def clean_outside_file(model: Model, rows: DataFrame) -> DataFrame:
    """An outside file without the mails of the four suppressions."""
    unwanted = suppression_mails(model, ["plainte", "npai", "mot", "spam"])
    return flag_suppress(rows, [unwanted], "mail")


def clean_by_lists(rows: DataFrame, lists: list[DataFrame], columns: list[str]) -> DataFrame:
    """One row per mail, in none of the lists, with decimals cut off civility and postcode."""
    kept = flag_suppress(first_per_key(drop_missing(rows, "mail"), ["mail"], []), lists, "mail", repeats=False)
    for name in ["civilite", "cp"]:
        if name in columns:
            kept = kept.withColumn(name, strip_decimal(name))
    return kept.select(*columns)


def extract(
    rows: DataFrame,
    mail_unique: bool = True,
    sort: bool = False,
    sample: int | None = None,
    mail_only: bool = False,
    seed: int = 0,
) -> DataFrame:
    """The steps of an extract in their order: one row per mail, sample, sort, mails only.

    A sample that is larger than the input is an error.
    """
    if mail_unique:
        rows = first_per_key(rows, ["mail"], [])
    if sample is not None:
        keys = ["mail"] if mail_unique else rows.columns
        rows = exact_sample(rows, sample, seed, keys)
    if sort:
        rows = rows.orderBy(*text_order("mail"))
    return rows.select("mail") if mail_only else rows


def export_versions(rows: DataFrame) -> dict[str, DataFrame]:
    """An export as it is, once per mail, and as bare mails."""
    unique = first_per_key(rows, ["mail"], [])
    return {"full": rows, "mail_unique": unique, "mail_only": unique.select("mail")}


def openers_and_others(openers: DataFrame, others: DataFrame) -> DataFrame:
    return stack(openers, others).select("mail")


def full_clean_up(rows: DataFrame, complaints: DataFrame) -> dict[str, DataFrame]:
    """Clean an extract on all columns; complaints out; all rows and one per mail."""
    kept = drop_missing(rows, "mail").distinct()
    if "provenance" in rows.columns:
        kept = kept.withColumn("provenance", trimmed("provenance"))
    kept = kept.withColumn("civilite", strip_decimal("civilite"))
    kept = kept.withColumn("birth", century_repair("birth"))
    kept = keep_out(kept, complaints, "mail", "mail", repeats=True)
    # Sorted last: a join above a sort would lose it.
    return {"all": sort_unique(kept, None, ["mail"]), "mail_unique": sort_unique(kept, ["mail"], ["mail"])}


def flagged_mails(rows: DataFrame) -> DataFrame:
    """Mails without keyword hit and without complaint."""
    no_word = F.col("exclusion_mot_cle").eqNullSafe(F.lit(False))
    return rows.filter(no_word & ~F.col("plainte").eqNullSafe(F.lit(True))).select("mail")

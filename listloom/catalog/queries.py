"""Registered queries: every operator over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.catalog.registry import query
from listloom.functions import clean, dates
from listloom.model import IDENTITY, Model
from listloom.operators import dedupe, identity, joins, match, report, sample, setops, sketches
from listloom.operators.bitmaps import Wanted
from listloom.plans import recipes
from listloom.plans.counts import segment_counts
from listloom.plans.described import described
from listloom.plans.layouts import collection_layout, partner_layout
from listloom.plans.segment import Segment
from listloom.sources import names
from listloom.sources.ingest import backfill_hashes
from listloom.sources.readers import read_table, rejected_rows
from listloom.sources.writers import key_value_rows

# The chosen partner, file, broker and opt-in names of the benchmark tables.
PARTNERS = ["1-URGENT", "2-HIGH"]
FILES = ["Brand#1", "Brand#17"]
BROKER = "Supplier#000000003"
BROKERS = ["Supplier#000000003", "Supplier#000000007"]
OPTIN, OTHER_OPTIN = "NATION_10", "NATION_7"
SEED = 11


# -- segments ------------------------------------------------------------------


def _segment(model: Model) -> Segment:
    return (
        Segment(model).partner(*PARTNERS).file(*FILES).not_broker(BROKER)
        .suppress("plainte", "mot", "spam", "npai")
    )


@query
def segment_classic(model: Model) -> DataFrame:
    return _segment(model).select("classic")


@query
def segment_ip(model: Model) -> DataFrame:
    return _segment(model).select("ip")


@query
def segment_provenance(model: Model) -> DataFrame:
    return _segment(model).select("provenance")


@query
def segment_identity_latest(model: Model) -> DataFrame:
    return _segment(model).select("identity_latest")


@query
def segment_packed(model: Model) -> DataFrame:
    return _segment(model).select("classic", id_table="id_unik")


@query
def segment_openers(model: Model) -> DataFrame:
    """Openers in the ad log, outside the files and the broker."""
    segment = Segment(model).only("ouvreur_campagne", "criteo").not_file("Brand#17")
    return segment.not_broker(*BROKERS).suppress("plainte", "mot").select("classic")


@query
def segment_described_right(model: Model) -> DataFrame:
    """All leads, with the contact where it has a hash of the wanted beginning; the first by all columns."""
    return described(model, {
        "select": {"base": ["mail"], "md5": ["left", "md5"], "lead": ["right", "ip", "provenance"]},
        "where": {"partner_match.partner_id": ["3-MEDIUM", "1-URGENT"]},
        "limit": 500,
    })


@query
def segment_described(model: Model) -> DataFrame:
    return described(model, {
        "select": {
            "base": ["mail", "id"],
            "id": ["left", *IDENTITY],
            "lead": ["left", "ip", "provenance", "date"],
        },
        "where": {
            "lead.ip": "not null",
            "fichier_match.fichier_id": {
                "select": {"fichier_list": "id"},
                "where": {"fichier_num": FILES},
            },
        },
    })


@query
def common_with_partner(model: Model) -> DataFrame:
    return recipes.common_with_partner(model, "3-MEDIUM", BROKERS)


@query
def common_with_file(model: Model) -> DataFrame:
    return recipes.common_with_file(model, FILES, BROKERS)


@query
def active_openers(model: Model) -> DataFrame:
    return recipes.active_openers(model, ["00003", "00007"])


@query
def file_clean(model: Model) -> DataFrame:
    return recipes.file_clean(model, FILES, openers=False)


@query
def partner_identities(model: Model) -> DataFrame:
    return recipes.partner_identities(model, PARTNERS)


@query
def optin_minus_unsub(model: Model) -> DataFrame:
    return recipes.optin_minus_unsubscribed(model, OPTIN)


@query
def broker_optin(model: Model) -> DataFrame:
    return recipes.broker_optin(model, BROKER, OTHER_OPTIN)


@query
def optin_difference(model: Model) -> DataFrame:
    return recipes.optin_difference(model, OPTIN, OTHER_OPTIN)


@query
def hash_export(model: Model) -> DataFrame:
    return recipes.hash_export(model, FILES)


@query
def hash_export_capped(model: Model) -> DataFrame:
    return recipes.hash_export(model, FILES, cap=400)


@query
def hashes_of_files(model: Model) -> DataFrame:
    return recipes.hashes_of_files(model, [7, 8, 10, 13])


@query
def qualified_leads(model: Model) -> DataFrame:
    return recipes.qualified_leads(model, 4)


@query
def mail_hash(model: Model) -> DataFrame:
    return recipes.mail_and_hash(model, 4)


@query
def optin_mails(model: Model) -> DataFrame:
    return recipes.optin_mails(model, 2)


@query
def sms_right_join(model: Model) -> DataFrame:
    return recipes.sms_all(model)


@query
def sms_prefiltered(model: Model) -> DataFrame:
    return recipes.sms_prefiltered(model)


@query
def sms_from_file(model: Model) -> DataFrame:
    return recipes.sms_from_file(model, FILES)


@query
def sms_with_partner(model: Model) -> DataFrame:
    return recipes.sms_with_partner(model, "1-URGENT")


@query
def partner_openers(model: Model) -> DataFrame:
    return recipes.partner_openers(model, ["1-URGENT", "2-HIGH", "3-MEDIUM"], BROKER)


@query
def one_per_hash(model: Model) -> DataFrame:
    return recipes.one_per_hash(model)


@query
def partner_one_per_hash(model: Model) -> DataFrame:
    return recipes.one_per_hash(model, "1-URGENT", [8], recipes.PARTNER_SUPPRESSION)


@query
def hashes_with_ip(model: Model) -> DataFrame:
    return recipes.hashes_with_ip(recipes.one_per_hash(model)).select(
        "md5", clean.first_ip("ip", "ip2").alias("ip")
    )


@query
def one_per_mail(model: Model) -> DataFrame:
    return recipes.one_per_mail(model, FILES)


@query
def department(model: Model) -> DataFrame:
    return recipes.by_department(model, ["01", "07", "08", "11", "12", "13"])


@query
def town_or_department(model: Model) -> DataFrame:
    return recipes.by_town_or_department(model, "NATION_3", "12")


@query
def blacklist(model: Model) -> DataFrame:
    return recipes.black_list(model, FILES)


@query
def known_hashes(model: Model) -> DataFrame:
    return recipes.known_hashes(model)


@query
def profile_exports(model: Model) -> DataFrame:
    return recipes.hashes_with_civility(model)


def _patchy(model: Model) -> Model:
    """The model with gaps: leads without date or ip, identities without any name."""
    contact = F.col("mail_id")
    lead = model["lead"].withColumns({
        "date": F.when(contact % 3 != 0, F.col("date")), "ip": F.when(contact % 4 != 1, F.col("ip")),
    })
    nameless = F.col("id") % 5 == 0
    names_of = {c: F.when(~nameless, F.col(c)) for c in ("prenom", "nom", "civilite")}
    frames = {"lead": lead, "id": model["id"].withColumns(names_of)}
    return Model(model.spark, lambda name: frames[name] if name in frames else model[name], model.key_source)


@query
def profiles_with_lead_date(model: Model) -> DataFrame:
    return recipes.profiles_with_lead_date(_patchy(model))


@query
def profiles_limited(model: Model) -> DataFrame:
    """The first profiles in the order of all their columns."""
    return recipes.profiles_with_any_name(_patchy(model), limit=200)


@query
def profiles_with_any_name(model: Model) -> DataFrame:
    return recipes.profiles_with_any_name(_patchy(model))


@query
def profiles_with_ip(model: Model) -> DataFrame:
    return recipes.profiles_with_ip(_patchy(model))


@query
def profiles_with_hash(model: Model) -> DataFrame:
    return recipes.profiles_with_hash(model)


@query
def mails_and_hashes(model: Model) -> DataFrame:
    return recipes.mails_and_hashes(model)


@query
def file_profiles(model: Model) -> DataFrame:
    return recipes.file_profiles(model, 7)


@query
def file_interests(model: Model) -> DataFrame:
    return recipes.file_interests(model, 7)


@query
def file_pattern(model: Model) -> DataFrame:
    return recipes.by_file_pattern(model, ["Brand#1", "Brand#2."])


@query
def qualified_by_file_pattern(model: Model) -> DataFrame:
    return recipes.qualified_by_file_pattern(model, ["Brand#1", "Brand#2."])


@query
def non_webmail(model: Model) -> DataFrame:
    domains = ["household.example", "machinery.example"]
    return recipes.non_webmail_by_file(
        model, ["Brand#8", "Brand#12", "Brand#13"], domains, 200, SEED, ["plainte", "npai", "mot"]
    )


@query
def non_webmail_b2c(model: Model) -> DataFrame:
    """The same extract with its own four suppressions."""
    return recipes.non_webmail_by_file(model, ["Brand#8", "Brand#16"], ["building.example"], 150, SEED)


# -- suppression of outside files -------------------------------------------------


def _with_mail(model: Model, table: str, *columns) -> DataFrame:
    """Rows of a contact table with the mail of their contact."""
    side = model[table].select("mail_id", *columns)
    return joins.inner_on(model.contacts, side, hot=model.hot(table))


def _outside(model: Model) -> DataFrame:
    """A file from outside: mails of leads and mobile numbers, with repeats, and of strangers."""
    leads = _with_mail(model, "lead", "ip")
    mobile = _with_mail(model, "sms")
    strange = model["regie_list"].select(_supplier_mail().alias("mail"))
    return setops.stack(leads.select("mail", "ip"), mobile.select("mail"), strange)


def _supplier_mail():
    return F.concat(F.lower(F.replace("abreviation", F.lit("#"), F.lit("."))), F.lit("@supplier.example"))


@query
def suppress_union(model: Model) -> DataFrame:
    return recipes.clean_outside_file(model, _outside(model))


@query
def flag_filter(model: Model) -> DataFrame:
    """Contacts flagged from four tables; openers without any unwanted flag."""
    rows = model["base"].select("id", "mail")
    for flag, name in [("ouvreur", "ouvreur"), ("plainte", "plainte"), ("npai", "npai"), ("mot", "mot")]:
        keys = Segment(model).named_keys(name).distinct().withColumn(flag, F.lit(True))
        rows = joins.left_one(rows, keys)
    return rows.filter(clean.true_and_none("ouvreur", ["plainte", "npai", "mot"])).select("mail")


@query
def clean_by_lists(model: Model) -> DataFrame:
    """Identity rows by mail, minus three lists, decimals cut off."""
    rows = _with_mail(model, "id", *IDENTITY)
    lists = [recipes.suppression_mails(model, [n]) for n in ["spam", "npai", "plainte"]]
    columns = ["mail", "birth", "civilite", "prenom", "nom", "cp", "ville"]
    return recipes.clean_by_lists(rows.select(*columns), lists, columns)


@query
def flagged_mails(model: Model) -> DataFrame:
    flagged = match.word_flag(model.contacts, model["mot_list"])
    keys = Segment(model).named_keys("plainte").distinct().withColumn("plainte", F.lit(True))
    return recipes.flagged_mails(joins.left_one(flagged, keys))


def _extract(model: Model) -> DataFrame:
    """A raw extract: identities with untidy codes, and lead provenance."""
    rows = _with_mail(model, "id", "prenom", "nom", "civilite", "birth", "cp")
    lead = model["lead"].select("mail_id", F.concat(F.lit(" "), "provenance", F.lit(" ")).alias("provenance"))
    rows = joins.left_many(rows, lead, hot=model.hot("lead"), unique=False)
    return rows.select("mail", "prenom", "nom", "civilite", "birth", "cp", "provenance")


@query
def full_clean_up(model: Model) -> DataFrame:
    return recipes.full_clean_up(_extract(model), recipes.suppression_mails(model, ["plainte"]))["all"]


@query
def export_mail_unique(model: Model) -> DataFrame:
    return recipes.full_clean_up(
        _extract(model), recipes.suppression_mails(model, ["plainte"])
    )["mail_unique"]


@query
def export_mail_only(model: Model) -> DataFrame:
    return recipes.export_versions(_outside(model))["mail_only"]


@query
def openers_and_others(model: Model) -> DataFrame:
    opened = Segment(model).only("ouvreur").with_identity().withColumn("ouvreur", F.lit(True))
    others = Segment(model).suppress("ouvreur").with_identity()
    return recipes.openers_and_others(opened, others)


# -- one row per key ---------------------------------------------------------------


@query
def identity_unique(model: Model) -> DataFrame:
    return model["id_unik"]


@query
def identity_clean(model: Model) -> DataFrame:
    return identity.clean_identities(model["id"].select("id", "mail_id", "civilite", "prenom", "nom"))


@query
def identity_unpack(model: Model) -> DataFrame:
    return identity.unpack_identity(model["id_unik"])


@query
def key_value(model: Model) -> DataFrame:
    return key_value_rows(model["md5"], model["id_unik"])


@query
def mail_unique(model: Model) -> DataFrame:
    return dedupe.first_per_key(_outside(model), ["mail"], dedupe.text_order("ip"))


@query
def last_file_wins(model: Model) -> DataFrame:
    """The highest file of each contact, with its score."""
    rows = model["appetence_match"].select("mail_id", F.col("appetence_id").alias("fichier_id"), "score")
    return dedupe.latest_wins(rows, "mail_id", F.col("fichier_id"))


@query
def top_birth(model: Model) -> DataFrame:
    rows = _with_mail(model, "id", F.col("id").alias("identity_id"), "birth")
    rows = rows.select("mail", "identity_id", "birth")
    return recipes.youngest(rows, 1250, ["identity_id"])


# -- cleaning -----------------------------------------------------------------------


@query
def civility(model: Model) -> DataFrame:
    return model["dirty_id"].select("id", clean.civility("civilite").alias("civilite"))


@query
def strip_decimal(model: Model) -> DataFrame:
    label = clean.strip_decimal(clean.civility("civilite"))
    return model["dirty_id"].select("id", label.alias("civilite"), clean.strip_decimal("cp").alias("cp"))


def _birth_text():
    kind = F.col("id") % 4
    return (
        F.when(kind == 0, F.date_format("birth", "dd/MM/yyyy"))
        .when(kind == 1, F.date_format("birth", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.date_format("birth", "d-M-yyyy"))
        .otherwise(F.date_format("birth", "yyyy"))
    )


@query
def birth_format(model: Model) -> DataFrame:
    rows = model["dirty_id"].select("id", _birth_text().alias("given"))
    return rows.select(
        "id", dates.birth_format("given").alias("birth"), dates.unread_birth("given").alias("unread")
    )


@query
def century_repair(model: Model) -> DataFrame:
    """Birth dates moved by whole centuries, and brought back."""
    moved = F.date_add("birth", ((F.col("id") % 4 - 2) * 36500).cast("int"))
    rows = model["dirty_id"].select("id", moved.alias("birth"))
    return rows.select("id", dates.century_repair("birth").alias("birth"))


@query
def text_rules(model: Model) -> DataFrame:
    run_date = F.lit("1998-08-02").cast("date")
    return model["dirty_id"].select(
        "id",
        clean.null_text("civilite").alias("civilite"),
        clean.trimmed(F.concat(F.lit("  "), "cp", F.lit(" "))).alias("cp"),
        dates.date_text(dates.not_run_date("birth", run_date)).alias("birth"),
    )


@query
def mail_domain(model: Model) -> DataFrame:
    return model["base"].select("id", clean.mail_domain("mail").alias("domain"))


def _address_rows(model: Model) -> DataFrame:
    """Every word of the documents, as a column of incoming mails of which few are any."""
    words = F.explode(F.split("text", r"[ \n\t\r]+"))
    return model["documents"].select("doc_id", words.alias("mail"))


@query
def mail_syntax(model: Model) -> DataFrame:
    return _address_rows(model).select(
        "doc_id", clean.normal_mail("mail").alias("mail"), clean.valid_mail("mail").alias("valid")
    ).distinct()


@query
def rejected_mails(model: Model) -> DataFrame:
    return rejected_rows(_address_rows(model)).distinct()


@query
def keyword_flag(model: Model) -> DataFrame:
    return match.word_flag(model.contacts, model["mot_list"])


@query
def keyword_hits(model: Model) -> DataFrame:
    return match.word_hits(model["base"], model["mot_list"])


@query
def partner_file(model: Model) -> DataFrame:
    return partner_layout(_segment(model).select("provenance"))


# -- matching ------------------------------------------------------------------------


def _incoming(model: Model) -> DataFrame:
    return _outside(model).select("mail", F.md5("mail").alias("md5"))


@query
def map_existing(model: Model) -> DataFrame:
    return match.map_existing(_incoming(model), model["md5"])


@query
def match_counts(model: Model) -> DataFrame:
    return match.match_counts(match.map_existing(_incoming(model), model["md5"]))


@query
def lookup_hash(model: Model) -> DataFrame:
    return match.lookup_hash(_incoming(model), model["md5"])


@query
def interest_lookup(model: Model) -> DataFrame:
    export = Segment(model).partner("1-URGENT").not_broker(BROKER).contacts()
    return match.interests_of(
        export, model["appetence_match"], model["appetence_list"],
        model.hot("appetence_match"), model.hot("appetence_match", "appetence_id"),
    )


@query
def hash_enrich(model: Model) -> DataFrame:
    known = recipes.hashes_with_civility(model).select("md5", "civilite")
    return match.hash_enrich(_outside(model), known, ["civilite"]).select("mail", "civilite")


@query
def append_identity(model: Model) -> DataFrame:
    known = _with_mail(model, "id", *IDENTITY)
    mails = _outside(model).select("mail").distinct()
    return match.append_identity(mails, known.select("mail", *IDENTITY)).select("mail", *IDENTITY)


@query
def new_rows_diff(model: Model) -> DataFrame:
    """Rows of one export in neither of two others, on all columns; then complaints, then keywords out."""
    columns = ["mail", "civilite", "prenom", "birth"]
    wide = ["civilite", "prenom", "birth"]
    # One pass over the identities of all contacts that any of the three exports holds.
    segment = Segment(model)
    tagged = lambda keys, n: keys.select("mail_id", F.lit(n).alias("n"))
    kinds = tagged(segment.partner_keys("1-URGENT"), 1).unionByName(tagged(segment.broker_keys(*BROKERS), 2))
    kinds = kinds.unionByName(tagged(segment.optin_keys("optin_match", OTHER_OPTIN), 2))
    kinds = kinds.groupBy("mail_id").agg(F.bool_or(F.col("n") == 1).alias("wanted"), F.bool_or(F.col("n") == 2).alias("out"))
    people = joins.inner_on(model.contacts, kinds, hot=[])
    rows = joins.left_many(people, model["id"].select("mail_id", *wide), hot=model.hot("id")).select(*columns, "wanted", "out")
    rows = rows.groupBy(*columns).agg(F.count_if("wanted").alias("times"), F.bool_or("out").alias("out"))
    fresh = rows.filter("times > 0 AND NOT out").select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int"))).alias("_")).drop("_")
    complaints = recipes.suppression_mails(model, ["plainte"])
    words = recipes.suppression_mails(model, ["mot"])
    return setops.not_in_any(fresh, [complaints, words], "mail")


@query
def audit_match(model: Model) -> DataFrame:
    known = joins.left_one(model.contacts, model["md5"]).select("mail", "md5")
    return match.audit_match(_incoming(model).select("md5"), known).select("mail")


@query
def natural_left(model: Model) -> DataFrame:
    """Lead rows with the same civility and first name at their own contact, null matching null."""
    left = model["id"].select("mail_id", "civilite", "prenom", "birth")
    right = joins.keep_in(
        left, Segment(model).broker_keys(*BROKERS), "mail_id", repeats=True, hot=model.hot("id")
    )
    right = right.select("mail_id", "civilite", "prenom").distinct().withColumn("known", F.lit(True))
    return joins.natural(left, right, "left", unique=True)


@query
def segment_sizes(model: Model) -> DataFrame:
    """How many contacts ten segments have, from one pass over their lists."""
    partners, brokers = [f"partner:{p}" for p in PARTNERS], [f"broker:{b}" for b in BROKERS]
    files = [f"file:{f}" for f in FILES]
    return segment_counts(model, {
        "partner": Wanted([partners[:1]]),
        "classic": Wanted([partners, files], [brokers[0], "plainte", "mot", "spam", "npai"]),
        "file": Wanted([files[:1]], ["npai"]),
        "broker": Wanted([brokers, ["partner:3-MEDIUM"]]),
        "openers": Wanted([["ouvreur"], ["criteo"]]),
        "campaign": Wanted([["ouvreur_campagne"]], ["plainte", "mot"]),
        "both files": Wanted([files[:1], files[1:]]),
        "three partners": Wanted([partners[:1], partners[1:], ["partner:3-MEDIUM"]]),
        "everyone": Wanted([], ["mxm", "not_b2c"]),
        "nobody": Wanted([["partner:none"]], ["mxm"]),
    })


@query
def overlap_sketched(model: Model) -> DataFrame:
    """Contacts of each file, and of these the ones in a list, from sketches; exact up to the keys that a sketch holds."""
    files = joins.inner_on(
        model["fichier_match"], model["fichier_list"], "fichier_id", "id", many="rows", hot=model.hot("fichier_match", "fichier_id")
    )
    kept = sketches.list_sketches(files, "fichier_num", "mail_id")
    return sketches.overlaps(kept, Segment(model).named_keys("npai"), "fichier_num", "mail_id")


@query
def overlap_by_file(model: Model) -> DataFrame:
    candidates = joins.inner_on(
        model["fichier_match"], model["fichier_list"], "fichier_id", "id",
        many="rows", hot=model.hot("fichier_match", "fichier_id"),
    )
    openers = Segment(model).named_keys("npai")
    return match.overlap_by_file(
        candidates, openers, "fichier_num", "mail_id", model.hot("fichier_match")
    )


@query
def hash_backfill(model: Model) -> DataFrame:
    known = joins.keep_in(model["md5"], Segment(model).partner_keys("1-URGENT"), "mail_id")
    return backfill_hashes(model["base"], known)


# -- counts, sets, samples, splits ------------------------------------------------------


@query
def reach_counts(model: Model) -> DataFrame:
    return report.reach_counts(model, Segment(model).broker_id_keys(9))


@query
def reach_profile(model: Model) -> DataFrame:
    members = Segment(model).broker_id_keys(1, 2, 4, 6, 9)
    return report.reach_profile(model, members, model["id_unik"])


@query
def file_sizes(model: Model) -> DataFrame:
    counts = model["fichier_match"].groupBy("fichier_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("fichier_id", "n", report.thousands("n").alias("thousands"))


@query
def ip_pool(model: Model) -> DataFrame:
    return setops.distinct_union("ip", model["lead"], model["campagne_ouvreur"])


@query
def in_common(model: Model) -> DataFrame:
    return setops.in_common(model["lead"], model["campagne_ouvreur"], "mail_id")


@query
def table_query(model: Model) -> DataFrame:
    return read_table(
        model.spark,
        "SELECT l.abreviation, count(DISTINCT m.mail_id) AS n_mail FROM {regie_match} m "
        "JOIN {regie_list} l ON l.id = m.regie_id GROUP BY l.abreviation",
        regie_match=model["regie_match"], regie_list=model["regie_list"],
    )


@query
def exact_sample(model: Model) -> DataFrame:
    return sample.exact_sample(model["id"].select("id", "mail_id"), 1200, SEED, ["id"])


@query
def random_split(model: Model) -> DataFrame:
    others = Segment(model).suppress("ouvreur").contacts()
    opened = Segment(model).only("ouvreur").contacts()
    return sample.random_split(others, 5, SEED, ["mail"], opened)


@query
def first_part(model: Model) -> DataFrame:
    """Part 0 of a random split, in its wider layout."""
    opened = Segment(model).only("ouvreur").with_identity()
    others = Segment(model).suppress("ouvreur").with_identity()
    parts = sample.random_split(others, 5, SEED, ["mail"], opened)
    return collection_layout(parts.filter("part = 0"))


@query
def sampled_extract(model: Model) -> DataFrame:
    rows = Segment(model).suppress("plainte").with_identity()
    return recipes.extract(rows.select("mail", *IDENTITY), sample=100, sort=True, mail_only=True)


@query
def chunks(model: Model) -> DataFrame:
    return sample.chunks(model["base"].select("mail"), 400)


@query
def group_packing(model: Model) -> DataFrame:
    return sample.pack_groups(
        model["fichier_match"], "fichier_id", 5000, model.hot("fichier_match", "fichier_id")
    )


# -- file names ---------------------------------------------------------------------------


def _file_names(model: Model) -> DataFrame:
    """Names built from the part table, in the layouts that partner files use."""
    number = F.col("p_partkey").cast("string")
    lead = (
        F.when(F.col("p_partkey") % 5 == 0, F.concat(number, F.lit("-2")))
        .when(F.col("p_partkey") % 5 == 1, F.concat(number, F.lit("X")))
        .when(F.col("p_partkey") % 5 == 2, F.lit("EXP-ABC"))
        .when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("OK_"), number))
        .otherwise(number)
    )
    status = F.when(F.col("p_size") % 3 == 0, "_[ouvreur]").when(F.col("p_size") % 3 == 1, "_[regie:ads]").otherwise("")
    return model["part"].select(
        F.concat(
            lead, F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("_[mail, civilite,"),
            F.lower("p_type"), F.lit("]"), status, F.lit("_"), F.col("p_size").cast("string"), F.lit("k.csv"),
        ).alias("name")
    )


@query
def filename_schema(model: Model) -> DataFrame:
    parsed = names.parse_names(_file_names(model))
    return parsed.select(
        "name", "number", F.concat_ws("|", "header").alias("header"),
        F.concat_ws("|", "statuses").alias("statuses"), "broker", "thousands", "done",
    )


@query
def file_order(model: Model) -> DataFrame:
    return names.order_files(_file_names(model).distinct()).select("name", F.col("place").cast("long").alias("place"))

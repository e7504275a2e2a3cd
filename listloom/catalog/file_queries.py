"""Registered queries that go through files written from the driver's tables.

Each writes its files to a new folder under the shared folder of the cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom import store
from listloom.catalog.queries import BROKER, _outside, _segment, _supplier_mail, _with_mail
from listloom.catalog.registry import query
from listloom.model import IDENTITY, SCHEMAS, Model
from listloom.operators import joins
from listloom.plans import recipes
from listloom.plans.segment import Segment
from listloom.session import shared_folder
from listloom.sources import folders, ingest, names, readers, writers
from listloom.streaming.folder_import import append_arrivals, arriving_rows, merge_arrivals


def _new_folder(model: Model, name: str) -> str:
    return f"{shared_folder(model.spark)}/listloom-{name}-{uuid.uuid4().hex}"


def _write(folder: str, **files: DataFrame) -> str:
    """One export per frame; its name gives number, columns and status."""
    for name, df in files.items():
        number, text, status = name.split("__")
        tail = f"_[{status.replace('regie_', 'regie:')}]" if status else ""
        name = f"{number[1:]}_{text}_[{','.join(df.columns)}]{tail}.csv"
        writers.write_csv(df, f"{folder}/{names.disk_name(name)}")
    return folder


def _mails(model: Model, table: str) -> DataFrame:
    return joins.keep_in(model.contacts, model[table]).select("mail")


def _status_folder(model: Model) -> str:
    """Files of a broker, of no status, and of three statuses."""
    leads = _with_mail(model, "lead", "date")
    dated = leads.select("mail", F.date_format("date", "yyyy-MM-dd").alias("date"))
    seen = _with_mail(model, "regie_actif", "date")
    later = seen.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "mail")
    return _write(
        _new_folder(model, "status"),
        n1__leads__regie_ads=dated,
        n2__active__=later,
        n3__out__desabo=_mails(model, "optin_desabo"),
        n4__opened__ouvreur=_mails(model, "base_ouvreur"),
        n5__complained__plainte=_mails(model, "base_plainte"),
    )


@query
def csv_round_trip(model: Model) -> DataFrame:
    """Rows written as a delimited file and read back as text."""
    path = _new_folder(model, "csv")
    writers.write_csv(model["id"].select("mail_id", *IDENTITY), path, sep=",")
    return readers.read_csv(model.spark, path, ["mail_id", *IDENTITY], sep=",")


@query
def folder_segment(model: Model) -> DataFrame:
    rows = readers.read_folder(model.spark, _status_folder(model), ["mail", "date"], exports=True)
    complaints = _mails(model, "base_npai")
    kept = folders.folder_segment(
        rows, "ads", ["desabo", "plainte"], complaints, model["mot_list"], ["mail", "source_file"]
    )
    return kept.select("mail", names.file_number("source_file").alias("number"))


@query
def status_flags(model: Model) -> DataFrame:
    """Every file's mails once each, with the status flags of the file."""
    rows = readers.read_folder(model.spark, _status_folder(model), ["mail"], exports=True)
    return readers.load_status(rows, ["desabo", "ouvreur", "plainte"]).select(
        "mail", "place", "desabo", "ouvreur", "plainte"
    )


@query
def folder_union(model: Model) -> DataFrame:
    rows = readers.read_folder(model.spark, _status_folder(model), ["mail"], exports=True)
    return readers.union_files(rows)


@query
def mails_of_files(model: Model) -> DataFrame:
    """The mail column of every file of a folder, repeats and all."""
    rows = readers.read_folder(model.spark, _status_folder(model), ["mail"], exports=True)
    return readers.mail_only(rows)


def _import_folder(model: Model) -> str:
    leads = _with_mail(model, "lead", "ip", "provenance")
    mobile = _with_mail(model, "sms", "port")
    strange = model["regie_list"].select(
        _supplier_mail().alias("mail"), F.col("abreviation").alias("prenom")
    )
    return _write(
        _new_folder(model, "import"),
        n1__leads__=leads.select("mail", "ip", "provenance"),
        n2__strangers__=strange,
        n3__mobile__ouvreur=mobile.select("mail", "port"),
    )


def _imported(model: Model, table: str, **choice: str) -> DataFrame:
    folder = _new_folder(model, "store")
    report = ingest.import_folder(model, _import_folder(model), folder, "first", exports=True, **choice)
    return report if table == "import_manifest" else store.read(model.spark, folder, table, SCHEMAS[table], load="first")


@query
def import_contacts(model: Model) -> DataFrame:
    """Contacts that a folder import adds, with their new numbers."""
    return _imported(model, "base")


@query
def import_leads(model: Model) -> DataFrame:
    return _imported(model, "lead").select("mail_id", "ip", "provenance")


@query
def import_identities(model: Model) -> DataFrame:
    """Only the files that name an identity field."""
    return _imported(model, "id", only_group="id").select("mail_id", "prenom")


def _store(model: Model, *loads: tuple[str, str], **choice) -> Model:
    """A store that starts empty and takes in folders, load by load, opened as a model after each one."""
    target = _new_folder(model, "store")
    for load, folder in loads:
        ingest.import_folder(Model.from_parquet(model.spark, target), folder, target, load, exports=True, **choice)
    return Model.from_parquet(model.spark, target)


def _dated_folder(model: Model) -> str:
    leads = _with_mail(model, "lead", "ip", "provenance", "date")
    leads = leads.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    return _write(
        _new_folder(model, "dated"), n305__leads__=leads.select("mail", "ip", "provenance", "date"),
        n306__opened__ouvreur=_mails(model, "base_ouvreur"), n307__export__regie_ads=_mails(model, "base_npai"),
    )


@query
def import_roundtrip(model: Model) -> DataFrame:
    """Leads of one file, asked for in a store that an import filled."""
    opened = _store(model, ("first", _dated_folder(model)))
    people = Segment(opened).file("305").select("classic").select("mail").distinct()
    leads = joins.inner_on(opened.contacts, opened["lead"], hot=[])
    leads = joins.keep_in(leads.select("mail", "ip", "provenance", "date"), people, "mail", "mail")
    return leads.select("mail", "ip", "provenance", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query
def import_rerun(model: Model) -> DataFrame:
    """Contacts after a load that ran twice and another load, with their numbers."""
    first, second = _dated_folder(model), _import_folder(model)
    opened = _store(model, ("first", first), ("first", first), ("second", second))
    return opened["base"].select("id", "mail")


@query
def import_two_folders(model: Model) -> DataFrame:
    """Files of two folders, each with its number and contacts."""
    opened = _store(model, ("first", _dated_folder(model)), ("second", _import_folder(model)))
    linked = joins.inner_on(opened["fichier_match"], opened["fichier_list"], "fichier_id", "id", hot=[])
    return linked.groupBy("fichier_num").agg(F.count_distinct("mail_id").alias("contacts"), F.count_distinct("fichier_id").alias("files"))


@query
def import_status(model: Model) -> DataFrame:
    """Openers that a status file brought in."""
    opened = _store(model, ("first", _dated_folder(model)))
    return joins.keep_in(opened.contacts, opened["base_ouvreur"]).select("mail")


@query
def import_broker(model: Model) -> DataFrame:
    """Members that a file with a broker tag brought in."""
    opened = _store(model, ("first", _dated_folder(model)))
    members = joins.inner_on(opened["regie_match"], opened["regie_list"], "regie_id", "id", hot=[])
    return joins.inner_on(opened.contacts, members.select("mail_id", "abreviation"), hot=[]).select("mail", "abreviation")


def _faulty_folder(model: Model) -> str:
    """A file with addresses and births that cannot be read, one without the mail's column, and one without content."""
    people = joins.inner_on(model.contacts, model["id"].select("mail_id", F.col("id").alias("n"), "prenom", "birth"), hot=[])
    mail = F.when(F.col("n") % 7 == 0, F.replace("mail", F.lit("@"), F.lit(" at "))).otherwise(F.col("mail"))
    birth = F.when(F.col("n") % 5 == 0, F.concat(F.lit("year "), F.year("birth"))).otherwise(F.date_format("birth", "dd/MM/yyyy"))
    rows = people.select(mail.alias("mail"), F.coalesce("prenom", F.lit("")).alias("prenom"), birth.alias("birth"))
    folder = _write(_new_folder(model, "faulty"), n1__people__=rows, n2__nameless__=rows.select("prenom"))
    return _write(folder, n3__empty__=rows.select("mail").filter("false"))


@query
def import_rejects(model: Model) -> DataFrame:
    """What an import could not take in, by reason."""
    folder = _new_folder(model, "store")
    ingest.import_folder(model, _faulty_folder(model), folder, "first", exports=True)
    rejects = store.read(model.spark, folder, "import_rejects", ingest.book("import_rejects"))
    return rejects.groupBy("field", "reason").agg(F.count("*").alias("n"), F.min("value").alias("least"))


@query
def import_bad_file(model: Model) -> DataFrame:
    """The manifest of a folder with bad files."""
    report = ingest.import_folder(model, _faulty_folder(model), _new_folder(model, "store"), "first", exports=True)
    return report.select("place", "lines", "rejected", "unread_birth", "status", "error")


@query
def import_mails_only(model: Model) -> DataFrame:
    """Nothing but mails read from a folder, some of them not wanted."""
    opened = _store(model, ("first", _import_folder(model)), mails_only=True, allow="@", deny="building|supplier")
    return opened["base"].select("mail", "domain")


@query
def import_scores(model: Model) -> DataFrame:
    """Scores of contacts by interest, the text of the file's name."""
    scores = _with_mail(model, "regie_match", "regie_id").select("mail", (F.col("regie_id") / 4).alias("score"))
    opened = _store(model, ("first", _write(_new_folder(model, "scores"), n1__travel__=scores)))
    named = joins.inner_on(opened["appetence_match"], opened["appetence_list"], "appetence_id", "id", hot=[])
    return joins.inner_on(opened.contacts, named.select("mail_id", "interet", "score"), hot=[]).select("mail", "interet", "score")


@query
def import_report(model: Model) -> DataFrame:
    report = _imported(model, "import_manifest")
    return report.select("place", "initial", "n_exist", "n_new", "status")


@query
def import_stopped(model: Model) -> DataFrame:
    """A load that stopped after three of its tables, and ran again: contacts with their numbers, and how many were seen between."""
    folder, target = _dated_folder(model), _new_folder(model, "store")
    stopped = store.Load(model.spark, target, "first")
    for table in ("base", "md5", "lead"):
        stopped.write(table, model[table])
    seen = Model.from_parquet(model.spark, target)["base"].agg(F.count("*").alias("seen_before"))
    seen_before = F.lit(seen.first()[0])
    ingest.import_folder(Model.from_parquet(model.spark, target), folder, target, "first", exports=True)
    return Model.from_parquet(model.spark, target)["base"].select("id", "mail", seen_before.alias("seen_before"))


@query
def stream_merge(model: Model) -> DataFrame:
    """Leads of files that arrived one by one, the last of them after the stream had stopped; it repeats the first and adds an opener."""
    leads = _with_mail(model, "lead", "ip", "provenance").select("mail", "ip", "provenance")
    folder, target = _new_folder(model, "arrivals"), _new_folder(model, "store")
    later = leads.unionByName(_mails(model, "base_ouvreur").withColumns({"ip": F.lit("0.0.0.0"), "provenance": F.lit("later")}))
    for files in ({"n1__leads__": leads, "n2__export__regie_ads": _mails(model, "base_npai")}, {"n3__again__ouvreur": later}):
        _write(folder, **files)
        merge_arrivals(model.spark, folder, target, f"{target}-state", exports=True, per_batch=8).awaitTermination()
    opened = Model.from_parquet(model.spark, target)
    openers = opened["base_ouvreur"].withColumn("opener", F.lit(True))
    facts = joins.inner_on(opened.contacts, opened["lead"].select("mail_id", "ip", "provenance"), hot=[])
    return joins.left_one(facts, openers, "id", "mail_id", repeats=True).select("mail", "ip", "provenance", F.coalesce("opener", F.lit(False)).alias("opener"))


@query
def mixed_encodings(model: Model) -> DataFrame:
    """The same names from files of three encodings, which are guessed."""
    names_ = _with_mail(model, "id", "prenom").select("mail", F.translate("prenom", "aeioubcd", "àéîôùßçñ").alias("prenom"))
    folder = _new_folder(model, "encodings")
    for number, encoding in enumerate(("UTF-8", "ISO-8859-1", "UTF-16"), 1):
        names_.write.csv(f"{folder}/{number}_names_[mail,prenom].csv", sep=";", encoding=encoding, nullValue="", emptyValue="")
    rows = readers.read_folder(model.spark, folder, ["mail", "prenom"], encoding="guess", exports=True)
    return rows.select("mail", "prenom", names.file_number("source_file").alias("number"))


@query
def stream_import(model: Model) -> DataFrame:
    """The import folder read as a stream that stops when all files are in."""
    folder, table = _import_folder(model), _new_folder(model, "stream")
    rows = arriving_rows(model.spark, folder, ["mail", "ip", "prenom", "port"], exports=True)
    append_arrivals(rows, table, f"{table}-state").awaitTermination()
    return model.spark.read.parquet(table).select(
        "mail", "ip", "prenom", "port", names.file_number("source_file").alias("number")
    )


@query
def stream_wide(model: Model) -> DataFrame:
    """Arriving files whose lines have the mail behind many columns."""
    wide = [F.col("id").alias(f"c{i}") for i in range(40)]
    folder = _write(_new_folder(model, "wide"), n1__wide__=model["base"].select(*wide, "mail", "domain"))
    table = _new_folder(model, "stream")
    append_arrivals(arriving_rows(model.spark, folder, ["mail", "domain", "c7"], exports=True), table, f"{table}-state").awaitTermination()
    return model.spark.read.parquet(table).select("mail", "domain", "c7")


@query
def export_manifest(model: Model) -> DataFrame:
    """Name and size of an export as they go to the manifest."""
    rows = _segment(model).select("classic")
    entry = writers.write_segment(
        rows, _new_folder(model, "export"), "ExportMail", "2015-11-19", ["mail", *IDENTITY],
        mail_unique=True,
    )
    return entry.select("name", "rows")


@query
def broker_membership(model: Model) -> DataFrame:
    """An export recorded as membership of its broker."""
    rows = recipes.common_with_partner(model, "3-MEDIUM", [BROKER])
    table = _new_folder(model, "membership")
    writers.write_membership(rows, model.contacts, BROKER, 3, table, "F", "2015-11-19", "first")
    return model.spark.read.parquet(table).select("mail_id", "regie_id")


@query
def replaced_table(model: Model) -> DataFrame:
    """The packed identities as a table that a job replaces as a whole."""
    folder = _new_folder(model, "table")
    writers.overwrite_table(model["id_unik"], folder, "id_unik")
    return model.spark.read.parquet(f"{folder}/id_unik")


@query
def replaced_in_store(model: Model) -> DataFrame:
    """A table of a store that was replaced, and one that is being replaced: what its readers see."""
    folder = _new_folder(model, "table")
    for rows in (model["id_unik"].filter("mail_id % 2 = 0"), model["id_unik"]):
        writers.replace_table(rows, folder, "id_unik")
    store.Load(model.spark, folder, "stopped").write("id_unik", model["id_unik"])
    return store.read(model.spark, folder, "id_unik", SCHEMAS["id_unik"])


@query
def stored_membership(model: Model) -> DataFrame:
    """An export recorded as a load of the store that holds the brokers' members."""
    rows, folder = recipes.common_with_partner(model, "3-MEDIUM", [BROKER]), _new_folder(model, "membership")
    writers.write_membership(rows, model.contacts, BROKER, 3, f"{folder}/regie_match", "F", "2015-11-19", "first", whole=True)
    return Model.from_parquet(model.spark, folder)["regie_match"]


@query
def aliased_columns(model: Model) -> DataFrame:
    rows = Segment(model).suppress("npai").with_identity().drop("id")
    return names.alias_columns(rows)


@query
def text_file(model: Model) -> DataFrame:
    """A file of unknown shape: names fitted to the columns that are found."""
    path = _new_folder(model, "text")
    writers.write_csv(_outside(model).select("mail", F.lit("x").alias("a"), F.lit("y").alias("b")), path, sep=",")
    return readers.load_text(model.spark, path, ["mail", "a"]).select("mail", "a", "unknown_1")


@query
def text_file_ragged(model: Model) -> DataFrame:
    """A file with a title, and lines that are shorter and longer than its first ones."""
    path = _new_folder(model, "ragged")
    lines = model["base"].select(
        F.when(F.col("id") % 3 == 0, F.col("mail"))
        .when(F.col("id") % 3 == 1, F.concat_ws(",", "mail", "domain"))
        .otherwise(F.concat_ws(",", "mail", "domain", "id", F.lit("x"), F.lit("y"))).alias("value")
    )
    title = model.spark.createDataFrame([("a list of addresses",)], "value string")
    # One file, so that the title is its first line; the driver's tables are small.
    title.unionByName(lines).coalesce(1).write.text(path)
    return readers.load_text(model.spark, path, ["mail", "domain"]).select("mail", "domain", "unknown_1", "unknown_3")

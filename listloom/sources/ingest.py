"""Import of file folders into the tables of the contact base."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listloom import store
from listloom.functions.clean import mail_domain, mail_hash, missing, valid_mail
from listloom.functions.dates import read_birth, read_when, unread_birth
from listloom.model import FIELD_GROUPS, IDENTITY, SCHEMAS, Model
from listloom.operators.dedupe import text_order
from listloom.operators.joins import keep_out, left_one
from listloom.operators.match import lookup_hash, match_counts
from listloom.operators.rank import with_position
from listloom.session import frozen
from listloom.sources.encodings import GUESS, file_encodings
from listloom.sources.names import file_text, front, list_files, parse_names, with_any_column, with_status
from listloom.sources.readers import clean_rows, read_folder
from listloom.store import Load

FILE_COLUMNS = ["mail", *IDENTITY, "ip", "provenance", "date", "port", "score"]

# The tables of contacts that a file's status names.
STATUS_TABLES = {"ouvreur": "base_ouvreur", "plainte": "base_plainte", "npai": "base_npai"}

# Tables whose rows have a number of their own.
NUMBERED = ["base", "id", "fichier_list", "regie_list", "appetence_list"]

# Jobs of one load that run side by side: most of its tables are small, and a job is mostly waiting then.
SIDE_BY_SIDE = 6

# What the loads of a store keep beside the tables of the model.
BOOKS = {
    "import_manifest": "name string, file_id long, place long, number double, thousands int, encoding string, lines long, rejected long, "
    "unread_birth long, initial long, sorted long, n_exist long, n_new long, status string, error string, load string",
    # Lines that could not be placed, with the reason.
    "import_rejects": "name string, mail string, field string, value string, reason string, load string",
}


def book(name: str) -> StructType:
    """The columns of a book, without the folder's ``load``."""
    return StructType(StructType.fromDDL(BOOKS[name]).fields[:-1])


def manifest_of(spark: SparkSession, warehouse: str, load: str) -> DataFrame:
    """The manifest of one finished load."""
    return store.read(spark, warehouse, "import_manifest", book("import_manifest"), load=load)


def _others(run: Load, table: str, own: bool = False) -> DataFrame:
    """Rows of a stored table from all loads but this one, or from this one only, when it ran before."""
    return run.read(table, SCHEMAS[table], **{"load" if own else "other": run.load})


def highest(model: Model, run: Load) -> dict[str, int]:
    """The highest number ever given in each numbered table, by the model, by a load, or by one that has been replaced."""
    found = reduce(DataFrame.unionByName, [model[t].agg(F.max("id").alias("top")).select(F.lit(t).alias("table"), "top") for t in NUMBERED])
    return {r["table"]: max(r["top"] or 0, run.top(r["table"])) for r in found.collect()}


def at_once(spark: SparkSession, work: list[Callable[[], object]]) -> list:
    """The results of some jobs that do not need each other, run side by side."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(one)) for one in work]]


def conform(rows: DataFrame, table: str) -> DataFrame:
    """``rows`` with the columns and types of a table of the model; columns that are not there are null."""
    return rows.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in SCHEMAS[table].fields
    ])


def numbered(rows: DataFrame, order: list, top: int, name: str = "id") -> DataFrame:
    """Rows with the numbers after ``top`` in the given order."""
    placed = with_position(rows, order, "_n")
    return placed.withColumn(name, F.lit(top) + 1 + F.col("_n")).drop("_n")


def new_contacts(rows: DataFrame, top: int, kept: DataFrame | None = None) -> DataFrame:
    """Numbered contacts for the mails of unmatched rows, in mail order.

    ``kept`` (id, md5) has numbers that this load gave before; they stay.
    """
    mails = rows.filter("insert").select("mail", "md5").distinct()
    if kept is None:
        found = numbered(mails, text_order("mail"), top)
    else:
        kept = frozen(left_one(mails, kept.select(F.col("md5").alias("_k"), "id"), "md5", "_k", repeats=False))
        fresh = numbered(kept.filter("id IS NULL").drop("id"), text_order("mail"), top)
        found = kept.filter("id IS NOT NULL").select(*fresh.columns).unionByName(fresh)
    return found.select("id", "mail", mail_domain("mail").alias("domain"), "md5")


def with_contact(rows: DataFrame, added: DataFrame) -> DataFrame:
    """Contact number of each row: the matched one, else the new one."""
    fresh = added.select(F.col("md5").alias("_k"), F.col("id").alias("_new"))
    rows = left_one(rows, fresh, "md5", "_k", repeats=True)
    return rows.withColumn("mail_id", F.coalesce("pg_id", "_new")).drop("_new")


def side_rows(rows: DataFrame, table: str) -> DataFrame:
    """Rows of one side table: those with at least one of its fields filled."""
    fields = [c for c in FIELD_GROUPS[table] if c in rows.columns]
    filled = F.lit(False)
    for name in fields:
        filled = filled | ~missing(F.col(name).cast("string"))
    return rows.filter(filled).select("mail_id", *fields).distinct()


def known_hashes(model: Model, run: Load) -> DataFrame:
    """(mail_id, md5) of all contacts but those that this load added when it ran before; a contact may come twice."""
    before = model["md5"].select("mail_id", "md5")
    if run.ran_before:
        before = keep_out(before, _others(run, "md5", own=True), "md5", "md5")
    return before.unionByName(_others(run, "md5"))


def not_stored(rows: DataFrame, model: Model, run: Load, table: str) -> DataFrame:
    """Rows of a side table that neither the model nor another load has yet; numbers of rows are not compared.

    Stored rows are first cut to the contacts that come in, which are few: these are broadcast if they are small, and the
    stored ones stay where they are.
    """
    facts = [c for c in rows.columns if c != "id"]
    stored = model[table].select(*facts).unionByName(_others(run, table).select(*facts))
    if run.ran_before:
        own = _others(run, table, own=True).select(*facts)
        stored = stored.exceptAll(own)
    stored = stored.join(rows.select("mail_id").distinct(), "mail_id", "left_semi").distinct()
    same = reduce(and_, [rows[c].eqNullSafe(stored[c]) for c in facts])
    return rows.join(stored, same, "left_anti")


def import_rows(
    placed: DataFrame, model: Model, run: Load, files: list[Row], tops: dict[str, int], merge: bool = False
) -> dict[str, DataFrame]:
    """New rows for each table out of rows with their contact (``mail_id``), file, statuses and broker.

    ``files`` are those with rows, ``tops`` the highest numbers given so far. With ``merge`` facts that the store has from other loads are not written again.
    """
    columns = {c for f in files for c in f["header"]}
    tables = {}
    placed = placed.withColumns({
        "birth": read_birth("birth") if "birth" in placed.columns else F.lit(None).cast("date"),
        "date": read_when("date") if "date" in placed.columns else F.lit(None).cast("timestamp"),
    })
    new = lambda rows, table: not_stored(conform(rows, table), model, run, table) if merge else rows
    for table in ["lead", "sms"]:
        if any(c in columns for c in FIELD_GROUPS[table]):
            tables[table] = new(side_rows(placed, table), table)
    facts = side_rows(placed, "id") if any(c in columns for c in IDENTITY) and "prenom" in placed.columns else None
    tables["id"] = _identities(facts, model, run, tops["id"], merge)
    tables["fichier_match"] = placed.select("mail_id", F.col("file_id").alias("fichier_id")).distinct()
    for status, table in STATUS_TABLES.items():
        if any(status in f["statuses"] for f in files):
            tables[table] = new(placed.filter(F.array_contains("statuses", status)).select("mail_id").distinct(), table)
    if "score" in columns and "score" in placed.columns:
        # The interest of a score file is the text of its name.
        scored = placed.filter(~missing(F.col("score").cast("string"))).select(
            "mail_id", F.col("score").try_cast("double").alias("score"), F.element_at(front("source_file"), 2).alias("interet")
        )
        names = {r[0] for r in scored.select("interet").distinct().collect()}
        tables["appetence_list"], linked = _listed(scored, names, model, run, "appetence_list", "interet", tops)
        tables["appetence_match"] = new(linked.select("mail_id", F.col("_id").alias("appetence_id"), "score").distinct(), "appetence_match")
    if names := {f["broker"] for f in files if f["broker"] is not None}:
        brokers = placed.filter("broker IS NOT NULL").select("mail_id", F.col("broker").alias("abreviation"))
        tables["regie_list"], linked = _listed(brokers, names, model, run, "regie_list", "abreviation", tops)
        tables["regie_match"] = new(linked.select("mail_id", F.col("_id").alias("regie_id")).distinct(), "regie_match")
    return tables


def _identities(rows: DataFrame | None, model: Model, run: Load, top: int, merge: bool) -> DataFrame:
    """Numbered identities; one keeps the number that this load gave it before."""
    if rows is None:
        return model.spark.createDataFrame([], SCHEMAS["id"])
    facts = ["mail_id", *IDENTITY]
    rows = conform(rows, "id").drop("id")
    if merge:
        rows = not_stored(rows, model, run, "id")
    if not run.ran_before:
        return numbered(rows, text_order(*facts), top)
    given = _others(run, "id", own=True)
    same = reduce(and_, [F.col(f"_o.{c}").eqNullSafe(F.col(f"_i.{c}")) for c in facts])
    rows = frozen(rows.alias("_i").join(given.alias("_o"), same, "left").select("_i.*", F.col("_o.id").alias("id")))
    fresh = numbered(rows.filter("id IS NULL").drop("id"), text_order(*facts), top)
    return rows.filter("id IS NOT NULL").select(*fresh.columns).unionByName(fresh)


def _listed(
    rows: DataFrame, names: set[str], model: Model, run: Load, table: str, name: str, tops: dict[str, int]
) -> tuple[DataFrame, DataFrame]:
    """New entries of a list table for names it lacks, and the rows with the number (``_id``) of their name.

    ``names`` stand in the names of files, so they are no more than these.
    """
    spark = model.spark
    least = lambda df: {r[0]: r[1] for r in df.filter(F.col(name).isin(names)).groupBy(name).agg(F.min("id")).collect()}
    known, own = model[table].select("id", name).unionByName(_others(run, table)), {}
    if run.ran_before:
        mine = _others(run, table, own=True)
        own, known = least(mine), keep_out(known, mine, "id", "id")
    known = least(known)
    lacking = sorted(names - known.keys() - own.keys())
    added = {n: i for n, i in own.items() if n not in known} | {n: i for i, n in enumerate(lacking, tops[table] + 1)}
    listed = spark.createDataFrame([(i, n) for n, i in added.items()], f"id long, `{name}` string")
    numbers = spark.createDataFrame(list((known | added).items()), "_k string, _id long")
    return listed, left_one(rows, numbers, name, "_k", repeats=True)


def _loaded_files(run: Load, names: list[str]) -> set[str]:
    """Of these names, those of files that other loads have taken in or found faulty."""
    if not any(m.load != run.load for m in run.before):
        return set()
    asked = run.spark.createDataFrame([(n,) for n in names], "name string")
    stored = run.read("import_manifest", book("import_manifest"), other=run.load).select("name")
    return {r["name"] for r in stored.join(asked, "name", "left_semi").distinct().collect()}


def _own_files(run: Load) -> dict[str, int]:
    """The numbers that an earlier run of this load gave its files."""
    if not run.ran_before:
        return {}
    given = run.read("import_manifest", book("import_manifest"), load=run.load).filter("file_id IS NOT NULL")
    return {r["name"]: r["file_id"] for r in given.select("name", "file_id").collect()}


def import_folder(
    model: Model, folder: str, warehouse: str, load: str, sep: str = ";",
    only_group: str | None = None, only_status: str | None = None, exports: bool = False,
    allow: str | None = None, deny: str | None = None, mails_only: bool = False,
    encoding: str = "UTF-8", only_files: list[str] | None = None, merge: bool = False,
) -> DataFrame:
    """Load all files of a folder in one go and give the manifest of the load.

    Source files are left as they are; those that the manifest has from another
    load are passed over. ``only_group`` takes the files that name a field of
    that side table, ``only_status`` those that name the status, ``only_files`` those of these names; with ``mails_only`` nothing but
    the mail is read. ``allow`` and ``deny`` are patterns that a mail must and must not have; ``encoding`` may be
    ``guess``, file by file. A load
    that is run again replaces itself and gives the same numbers to the same contacts, identities and
    files; a number is never given to another. Statuses and broker tags go to their tables. With ``merge``
    facts of a contact that other loads have brought in are not written again.

    The load is one unit: a run that stops leaves nothing that readers of the store see.

    What cannot be taken in is kept in ``import_rejects``: mails that are not well formed, and
    births that no layout reads. Files without a readable name, content or row are marked PB with the reason.
    """
    spark = model.spark
    run = Load(spark, warehouse, load)
    tops = highest(model, run)
    # What concerns files alone is settled here: the driver lists them by name, one row a file.
    files = parse_names(list_files(spark, folder, exports)).filter("NOT done").drop("done")
    if only_files is not None:
        files = files.filter(F.col("name").isin(only_files))
    if only_group:
        files = with_any_column(files, FIELD_GROUPS[only_group])
    if only_status:
        files = with_status(files, only_status)
    schema = files.schema
    listed = files.collect()
    gone, own_ids = _loaded_files(run, [f["name"] for f in listed]), _own_files(run)
    listed = sorted((f for f in listed if f["name"] not in gone), key=lambda f: (f["number"] is None, f["number"], f["name"]))
    free = iter(range(tops["fichier_list"] + 1, tops["fichier_list"] + 1 + len(listed)))
    ids = {f["name"]: own_ids[f["name"]] if f["name"] in own_ids else next(free) for f in listed}
    good = [f for f in listed if f["header"] and "mail" in f["header"] and f["bytes"] > 0]
    wanted = ["mail"] if mails_only else FILE_COLUMNS
    encodings = {f["name"]: encoding for f in good}
    if not good:
        rows = spark.createDataFrame([], "source_file string, place long, statuses array<string>, broker string, " + ", ".join(f"`{c}` string" for c in wanted))
    else:
        chosen = spark.createDataFrame([(*f, place) for place, f in enumerate(listed, 1) if f in good], schema.add("place", "long"))
        found = None
        if encoding == GUESS:
            found = file_encodings(spark, folder, chosen, exports)
            encodings = {r["source_file"]: r["encoding"] for r in found.collect()}
            found = spark.createDataFrame(list(encodings.items()), found.schema)
        rows = read_folder(spark, folder, wanted, sep, encoding=encoding if found is None else found, exports=exports, files=chosen)
    # Read once: every count of the manifest and every table comes from these rows.
    rows = frozen(rows)
    allowed = F.lit(True)
    if allow:
        allowed = allowed & F.col("mail").rlike(allow)
    if deny:
        allowed = allowed & ~F.col("mail").rlike(deny)
    well = F.coalesce(valid_mail("mail"), F.lit(False)) & F.coalesce(allowed, F.lit(False))
    cleaned = frozen(lookup_hash(frozen(clean_rows(rows.filter(well))), known_hashes(model, run), few=True))

    own = _others(run, "md5", own=True).select(F.col("mail_id").alias("id"), "md5") if run.ran_before else None
    added = frozen(new_contacts(cleaned, tops["base"], own))
    numbers = spark.createDataFrame(list(ids.items()), "_k string, file_id long")
    placed = frozen(left_one(with_contact(cleaned, added), numbers, "source_file", "_k", repeats=True))

    unread = unread_birth("birth") if "birth" in rows.columns else F.lit(False)
    lines = rows.groupBy(F.col("source_file").alias("name")).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(~well).alias("rejected"), F.count_if(well & unread).alias("unread_birth")
    )
    counts = match_counts(cleaned, new="insert", by=["source_file"])
    lines, counts = ({r[0]: r.asDict() for r in got} for got in at_once(spark, [lines.collect, counts.collect]))
    with_rows = [f for f in good if f["name"] in counts]
    tables = {
        "base": added.select("id", "mail", "domain"),
        "md5": added.select(F.col("id").alias("mail_id"), "md5"),
        "fichier_list": spark.createDataFrame([(ids[f["name"]], f["name"]) for f in with_rows], "id long, name string").select(
            "id", file_text("name").alias("fichier_num")
        ),
        **import_rows(placed, model, run, with_rows, tops, merge),
    }
    rejects = rows.filter(~well).select(
        F.col("source_file").alias("name"), "mail", F.lit("mail").alias("field"), F.col("mail").alias("value"),
        F.when(F.coalesce(valid_mail("mail"), F.lit(False)), "not allowed").otherwise("not well formed").alias("reason"),
    )
    if "birth" in rows.columns:
        rejects = rejects.unionByName(rows.filter(well & unread).select(
            F.col("source_file").alias("name"), "mail", F.lit("birth").alias("field"), F.col("birth").alias("value"), F.lit("unread").alias("reason"),
        ))
    report = []
    for place, f in enumerate(listed, 1):
        seen, met = lines.get(f["name"], {}), counts.get(f["name"], {})
        error = (
            "the name gives no mail column" if not (f["header"] and "mail" in f["header"])
            else "no content" if not f["bytes"]
            else "no row with a well-formed mail" if not met else None
        )
        report.append((
            f["name"], ids[f["name"]], place, f["number"], f["thousands"], encodings.get(f["name"]),
            *(seen.get(c, 0) for c in ("lines", "rejected", "unread_birth")), *(met.get(c) for c in ("initial", "sorted", "n_exist", "n_new")),
            "PB" if error else "OK", error,
        ))
    written = {name: conform(table, name) for name, table in tables.items()}
    written |= {"import_rejects": rejects, "import_manifest": spark.createDataFrame(report, book("import_manifest")).coalesce(1)}
    given = at_once(spark, [lambda name=name, table=table: run.write(name, table, "id" if name in NUMBERED else None) for name, table in written.items()])
    run.finish(dict(zip(written, given, strict=True)))
    return manifest_of(spark, warehouse, load)


def backfill_hashes(base: DataFrame, hashes: DataFrame) -> DataFrame:
    """(mail_id, md5) for contacts that have no hash yet."""
    lacking = keep_out(base.select("id", "mail"), hashes)
    return lacking.select(F.col("id").alias("mail_id"), mail_hash("mail").alias("md5"))

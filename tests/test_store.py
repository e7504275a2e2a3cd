"""Loads as one unit, streams that merge, and encodings."""

import pytest
from pyspark.sql import functions as F

from listloom import store
from listloom.model import SCHEMAS, Model
from listloom.operators import match
from listloom.sources import encodings, ingest, readers, writers
from listloom.streaming.folder_import import merge_arrivals

FILES = {
    "1_x_[mail,ip,prenom]_[ouvreur].csv": "a@a.example;10.0.0.1;Ana\nb@a.example;;Bob\n",
    "2_x_[mail,ip]_[regie=ads].csv": "a@a.example;10.0.0.1\nc@a.example;10.0.0.2\nbad;\n",
    "3_x_[mail,prenom,birth]_[ouvreur].csv": "b@a.example;Bob;1980-01-02\na@a.example;Ana;\nd@a.example;Dan;soon\n",
    "4_travel_[mail,score].csv": "c@a.example;0.5\n",
    "5_x_[prenom].csv": "Eve\n",
    "6_x_[mail].csv": "",
}


def write(folder, files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


def tables(spark, folder, rows):
    model = Model.from_parquet(spark, folder)
    return {t: rows(model[t]) for t in SCHEMAS}


def facts(spark, folder, rows):
    """All tables with contacts by their mail, files and lists by name, and no numbers of rows."""
    model = Model.from_parquet(spark, folder)
    mails = model["base"].select(F.col("id").alias("mail_id"), "mail")
    named = {"fichier_match": ("fichier_list", "fichier_id", "fichier_num"), "regie_match": ("regie_list", "regie_id", "abreviation"),
             "appetence_match": ("appetence_list", "appetence_id", "interet")}
    out = {"base": rows(model["base"], "mail", "domain")}
    for table, schema in SCHEMAS.items():
        if "mail_id" in schema.names:
            df = model[table].join(mails, "mail_id").drop("mail_id")
            if table in named:
                entries, key, name = named[table]
                df = df.join(model[entries].select(F.col("id").alias(key), F.col(name).alias("entry")), key).drop(key)
            out[table] = rows(df.drop("id"))
    return out


class Stop(Exception):
    pass


def stop_at(monkeypatch, n):
    """Loads stop at their n-th table, once."""
    plain, seen = store.Load.write, []

    def stopping(self, name, df, number=None):
        seen.append(name)
        if len(seen) == n:
            raise Stop
        return plain(self, name, df, number)

    monkeypatch.setattr(ingest, "SIDE_BY_SIDE", 1)
    monkeypatch.setattr(store.Load, "write", stopping)


def test_a_stopped_load_is_not_seen(spark, tmp_path, monkeypatch, rows):
    folder, target = write(tmp_path / "in", FILES), str(tmp_path / "store")
    opened = lambda: Model.from_parquet(spark, target)
    ingest.import_folder(opened(), write(tmp_path / "before", {"1_y_[mail].csv": "z@z.example\n"}), target, "before")
    before = tables(spark, target, rows)
    with monkeypatch.context() as patch:
        stop_at(patch, 4)
        with pytest.raises(Stop):
            ingest.import_folder(opened(), folder, target, "first")
    assert tables(spark, target, rows) == before
    assert spark.read.parquet(f"{target}/base").count() > 1
    # A model that was opened before a load goes on seeing what it saw.
    early = opened()
    ingest.import_folder(opened(), folder, target, "first")
    assert rows(early["base"]) == before["base"]
    after = tables(spark, target, rows)
    ingest.import_folder(opened(), folder, target, "first")
    assert tables(spark, target, rows) == after
    # Nothing of the stopped run, nor of the one that was replaced, is left.
    assert spark.read.parquet(f"{target}/base").count() == len(after["base"]) == 5
    plain = str(tmp_path / "plain")
    ingest.import_folder(Model.from_parquet(spark, plain), write(tmp_path / "before", {}), plain, "before")
    ingest.import_folder(Model.from_parquet(spark, plain), folder, plain, "first")
    assert tables(spark, plain, rows) == after


def test_marks_and_plain_tables(spark, tmp_path, rows):
    target = str(tmp_path)
    schema = SCHEMAS["base_npai"]
    numbers = lambda *n: spark.createDataFrame([(i,) for i in n], schema)
    numbers(1, 2).write.parquet(f"{target}/base_plainte")
    run = store.Load(spark, target, "a")
    run.write("base_npai", numbers(3))
    assert store.read(spark, target, "base_npai", schema).count() == 0
    run.finish({"base": 9, "id": None})
    again = store.Load(spark, target, "b")
    again.write("base_npai", numbers(4))
    again.finish({"base": 4})
    read = lambda **c: rows(store.read(spark, target, "base_npai", schema, **c))
    assert read() == [(3,), (4,)] and read(load="a") == [(3,)] and read(other="a") == [(4,)]
    assert rows(store.read(spark, target, "base_plainte", SCHEMAS["base_plainte"], other="a")) == [(1,), (2,)]
    # A replaced run's numbers stay given.
    replaced = store.Load(spark, target, "a")
    replaced.finish({})
    assert read() == [(4,)] and store.Load(spark, target, "c").top("base") == 9 and store.Load(spark, target, "c").top("id") == 0
    assert [m.turn for m in store.marks(spark, target)] == [1, 2, 3]
    assert store.marks(spark, str(tmp_path / "none")) == []


@pytest.mark.parametrize("per_batch", [None, 2])
def test_a_stream_ends_in_the_tables_of_an_import(spark, tmp_path, rows, per_batch):
    folder, target = write(tmp_path / "in", FILES), str(tmp_path / "store")
    merge_arrivals(spark, folder, target, f"{target}-state", per_batch=per_batch).awaitTermination()
    plain = str(tmp_path / "plain")
    ingest.import_folder(Model.from_parquet(spark, plain), folder, plain, "first")
    assert facts(spark, target, rows) == facts(spark, plain, rows)
    if per_batch is None:
        assert tables(spark, target, rows) == tables(spark, plain, rows)
    books = [store.read(spark, f, "import_manifest", ingest.book("import_manifest")) for f in (target, plain)]
    told = [rows(b.filter("name NOT LIKE '6_%'"), "name", "status", "lines", "rejected") for b in books]
    assert told[0] == told[1]
    # Nothing new: nothing happens.
    seen = tables(spark, target, rows)
    merge_arrivals(spark, folder, target, f"{target}-state", per_batch=per_batch).awaitTermination()
    assert tables(spark, target, rows) == seen


def test_a_stream_that_stops_goes_on_where_it_was(spark, tmp_path, monkeypatch, rows):
    """Stopped inside the second batch, and again between two batches."""
    folder, target, state = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "state")
    names = sorted(FILES)[:4]
    write(folder, {n: FILES[n] for n in names[:1]})
    run = lambda: merge_arrivals(spark, str(folder), target, state, per_batch=1).awaitTermination()
    run()
    write(folder, {n: FILES[n] for n in names[1:3]})
    first = tables(spark, target, rows)
    with monkeypatch.context() as patch:
        stop_at(patch, 3)
        with pytest.raises(Exception, match="Stop"):
            run()
    assert tables(spark, target, rows) == first
    run()
    write(folder, {n: FILES[n] for n in names[3:]})
    run()
    whole = str(tmp_path / "whole")
    for n in names:
        one = write(tmp_path / f"one-{n[0]}", {n: FILES[n]})
        ingest.import_folder(Model.from_parquet(spark, whole), one, whole, n[0], merge=True)
    numbered = lambda t: {k: v for k, v in tables(spark, t, rows).items() if k not in ("fichier_list", "fichier_match")}
    assert numbered(target) == numbered(whole) and facts(spark, target, rows) == facts(spark, whole, rows)
    ids = [r.id for r in Model.from_parquet(spark, target)["id"].collect()]
    assert len(ids) == len(set(ids))


# -- encodings -------------------------------------------------------------------


FRENCH = "mail;prénom\nzoë@a.example;Zoë Müller\nrené@a.example;René Façon\nemile@a.example;Émile œuvre\n"


@pytest.mark.parametrize(("codec", "name"), [
    ("utf-8", "UTF-8"), ("utf-8-sig", "UTF-8"), ("latin-1", "ISO-8859-1"), ("cp1252", "windows-1252"), ("cp850", "IBM850"),
    ("mac_roman", "MacRoman"), ("utf-16", "UTF-16LE"), ("utf-16-le", "UTF-16LE"), ("utf-16-be", "UTF-16BE"), ("ascii", "UTF-8"),
])
def test_encodings_are_guessed(spark, tmp_path, codec, name):
    text = FRENCH.replace("œ", "oe") if codec in ("latin-1", "cp850") else FRENCH
    text = text.encode("ascii", errors="ignore").decode() if codec == "ascii" else text
    path = tmp_path / "1_x_[mail,prenom].txt"
    path.write_bytes(text.replace("\n", "\r\n").encode(codec))
    found = encodings.guessed(encodings.raw_lines(spark, encodings.escaped(str(path)))).collect()
    assert [(r.source_file, r.encoding) for r in found] == [(path.name, name)]
    loaded = readers.load_text(spark, encodings.escaped(str(path)), ["mail", "prenom"], sep=";")
    assert sorted((r.mail, r.prenom) for r in loaded.collect()) == sorted(tuple(x.split(";")) for x in text.splitlines()[1:])


def test_files_of_several_encodings_are_one_row_set(spark, tmp_path, rows):
    people = [("zoe@a.example", "Zoë"), ("rene@a.example", "René"), ("emile@a.example", "Émile")]
    files = {
        f"{k}_x_[mail,prenom].csv": "".join(f"{mail};{name}\n" for mail, name in people).encode(codec)
        for k, codec in enumerate(["utf-8", "latin-1", "utf-16", "utf-16-be", "mac_roman", "utf-8-sig"], 1)
    }
    files["7_x_[mail].csv"] = b"plain@a.example\n\xff\n" + b"other@a.example\n" * 3
    folder = write(tmp_path / "in", files)
    got = rows(readers.read_folder(spark, folder, ["mail", "prenom"], encoding="guess").filter("place < 7"), "mail", "prenom", "place")
    assert got == sorted([(m, n, k) for m, n in people for k in range(1, 7)], key=repr)
    target = str(tmp_path / "store")
    report = ingest.import_folder(Model.from_parquet(spark, target), folder, target, "first", encoding="guess")
    told = {r.place: (r.encoding, r.lines, r.status) for r in report.collect()}
    assert [told[k][0] for k in range(1, 7)] == ["UTF-8", "ISO-8859-1", "UTF-16LE", "UTF-16BE", "MacRoman", "UTF-8"]
    assert all(told[k][1:] == (3, "OK") for k in range(1, 7))
    model = Model.from_parquet(spark, target)
    assert model["base"].count() == 5 and sorted({r.prenom for r in model["id"].collect()}) == sorted(n for _, n in people)


def test_header_lines_go_whatever_the_encoding(spark, tmp_path, rows):
    files = {f"{k}_x_[mail].csv": "mail\na@a.example\n".encode(codec) for k, codec in enumerate(["utf-8", "utf-16"], 1)}
    got = readers.read_folder(spark, write(tmp_path / "in", files), ["mail"], header=True, encoding="guess")
    assert rows(got, "mail", "place") == [("a@a.example", 1), ("a@a.example", 2)]


def test_memberships_and_replaced_tables_are_loads(spark, tmp_path, monkeypatch, rows):
    target = str(tmp_path / "store")
    contacts = spark.createDataFrame([(1, "a"), (2, "b")], "id long, mail string")
    record = lambda mails, load: writers.write_membership(
        spark.createDataFrame([(m,) for m in mails], "mail string"), contacts, "ads", 4, f"{target}/regie_match", "F", "2015-11-19", load, whole=True
    ).first()
    assert record("a", "l1").rows == 1 and record("abz", "l2").rows == 2 and record("b", "l1").rows == 1
    members = lambda: rows(Model.from_parquet(spark, target)["regie_match"])
    assert members() == [(1, 4), (2, 4), (2, 4)]
    packed = lambda *ids: spark.createDataFrame([(i, *"xxxxxx") for i in ids], SCHEMAS["id_unik"])
    writers.replace_table(packed(1, 2), target, "id_unik")
    with monkeypatch.context() as patch:
        patch.setattr(store.Load, "finish", lambda *a: (_ for _ in ()).throw(Stop()))
        for change in (lambda: writers.replace_table(packed(3), target, "id_unik"), lambda: record("a", "l2")):
            with pytest.raises(Stop):
                change()
    assert members() == [(1, 4), (2, 4), (2, 4)] and rows(Model.from_parquet(spark, target)["id_unik"], "mail_id") == [(1,), (2,)]
    writers.replace_table(packed(3), target, "id_unik")
    assert rows(Model.from_parquet(spark, target)["id_unik"], "mail_id") == [(3,)]
    with pytest.raises(ValueError):
        writers.replace_table(packed(3), target, "base")


def test_known_hashes_stay_where_they_are(spark, tmp_path, rows):
    """A few incoming rows are matched without a shuffle of the store's hashes."""
    store_ = spark.range(50_000).select(F.col("id").alias("mail_id"), F.md5(F.col("id").cast("string")).alias("md5"))
    store_.write.parquet(str(tmp_path / "md5"))
    incoming = spark.createDataFrame([(str(i),) for i in (5, 49_999, 60_000)], "t string").select("t", F.md5("t").alias("md5"))
    found = match.lookup_hash(incoming, spark.read.parquet(str(tmp_path / "md5")), few=True)
    assert rows(found, "t", "pg_id", "insert") == [("49999", 49999, False), ("5", 5, False), ("60000", None, True)]
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(k for k, line in enumerate(plan) if "FileScan parquet" in line)
    # From the scan up: nothing moves before the broadcast hashes have cut the rows.
    above = [line for line in plan[:scan] if "LeftSemi" in line or "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in above[-1] and "LeftSemi, BuildRight" in above[-1]

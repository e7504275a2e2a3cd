import pytest
from pyspark.sql import functions as F

from listloom.model import SCHEMAS, Model
from listloom.plans.segment import Segment
from listloom.sources import folders, ingest, names, readers, writers
from listloom.streaming.folder_import import append_arrivals, arriving_rows


def write(folder, files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


# -- names -----------------------------------------------------------------


def parsed(spark, *given):
    df = spark.createDataFrame([(n,) for n in given], "name string")
    return {r.name: r for r in names.parse_names(df).collect()}


def test_parse_names(spark):
    idm = "6_IDM_Nov2009_[mail,civilite,prenom]_56k.csv"
    broker = "999_ExportRegie_2015-11-19_[mail]_[regie:ads]_false_F_3k.csv"
    sub, exp = "31-2_x_[mail].csv", "EXP-ABC_x_2014_[nom, mail]_[ouvreur]_t.csv"
    got = parsed(spark, idm, broker, sub, exp, "7X_y_[mail].csv", "OK_1_[mail].csv", "plain.csv")
    assert (got[idm].number, got[idm].header, got[idm].statuses) == (6.0, ["mail", "civilite", "prenom"], [])
    assert got[idm].thousands == 56
    assert (got[broker].number, got[broker].statuses, got[broker].broker) == (999.0, ["ads"], "ads")
    assert got[broker].thousands == 3
    assert got[sub].number == 31.2 and got["7X_y_[mail].csv"].number == 7.9
    assert (got[exp].number, got[exp].header, got[exp].statuses) == (None, ["nom", "mail"], ["ouvreur"])
    assert got["OK_1_[mail].csv"].done and got["plain.csv"].header is None


def test_order_and_choice_of_files(spark, tmp_path):
    folder = write(tmp_path / "in", {
        "10_b_[mail].csv": "x\n", "9_a_[mail,nom].csv": "x\n", "EXP-ABC_x_[mail]_[ouvreur].csv": "x\n",
        "10_a_[mail,port].csv": "x\n", "OK_1_x_[mail].csv": "x\n", "PB_2_x_[mail].csv": "x\n",
    })
    (tmp_path / "in" / "deeper").mkdir()
    files = names.order_files(names.list_files(spark, folder))
    got = [r.name for r in files.orderBy("place").collect()]
    assert got == ["9_a_[mail,nom].csv", "10_a_[mail,port].csv", "10_b_[mail].csv", "EXP-ABC_x_[mail]_[ouvreur].csv"]
    assert [r.name for r in names.with_any_column(files, ["nom", "prenom"]).collect()] == [got[0]]
    assert [r.name for r in names.with_status(files, "ouvreur").collect()] == [got[3]]


def test_names_of_exports(spark):
    columns = ["mail", "civilite"]
    name = names.segment_file_name("ExportMail_ads", "2015-11-19", columns, 12999, True, short_civility=True)
    assert name == "ExportMail_ads-MailUnik_2015-11-19_[mail,civi]_12k.csv"
    name = names.segment_file_name("X", "2015-11-19", columns, 900, sample=350000, comment="in-cap")
    assert name == "X_Sample350k_2015-11-19_[mail,civilite]_in-cap_0k.csv"
    name = names.membership_file_name("2015-11-19", "ads", "F", 3456)
    assert name == "999_ExportRegie_2015-11-19_[mail]_[regie:ads]_false_F_3k.csv"


def test_alias_columns(spark):
    df = spark.createDataFrame([("a", "b", "c")], "prenom string, nom string, mail string")
    assert names.alias_columns(df).columns == ["firstname", "name", "mail"]


# -- readers -----------------------------------------------------------------


def test_read_csv(spark, tmp_path, rows):
    folder = write(tmp_path / "f", {"a.csv": "mail;cp\nx@a.example;01000\n;75000\n"})
    assert rows(readers.read_csv(spark, folder, ["mail", "cp"], header=True)) == [("x@a.example", "01000"), (None, "75000")]
    assert readers.read_csv(spark, folder, ["mail", "cp"]).count() == 3


def test_read_csv_encoding(spark, tmp_path):
    folder = write(tmp_path / "f", {"a.csv": "x@a.example;Orléans\n".encode("latin-1")})
    assert readers.read_csv(spark, folder, ["mail", "ville"], encoding="ISO-8859-1").first().ville == "Orléans"


def test_sniff_and_load_text(spark, tmp_path, rows):
    folder = write(tmp_path / "f", {
        "1_a.csv": "list of 2009\nmail,nom,x\na@a.example,A,1\nb@a.example,B,2\nno address,C,3\nlist of 2009\n",
        "2_b.csv": "c@a.example,C,3\nd@a.example,D,4,too,long\n",
    })
    found = {r.source_file: r for r in readers.sniff(spark, folder).collect()}
    assert sorted(found["1_a.csv"].skip_lines) == ["list of 2009", "mail,nom,x"]
    assert found["2_b.csv"].skip_lines == [] and found["2_b.csv"].n_col == 5
    one = write(tmp_path / "g", {"1_a.csv": "title\na@a.example,A,1\nb@a.example,B\nc@a.example,C,3,4\nd@a.example,D,4\n"})
    assert {r.n_col for r in readers.sniff(spark, one, n_rows=3).collect()} == {3}
    assert readers.fit_header(["mail"], 3) == ["mail", "unknown_1", "unknown_2"]
    assert readers.fit_header(["mail", "nom", "x"], 2) == ["mail", "nom"]
    loaded = readers.load_text(spark, folder, ["mail", "nom"])
    assert loaded.columns == ["source_file", "mail", "nom", "unknown_1", "unknown_2", "unknown_3"]
    got = rows(loaded, "mail", "unknown_1")
    assert ("a@a.example", "1") in got and ("d@a.example", "4") in got
    assert ("mail", "x") not in got


def test_load_text_keeps_long_lines(spark, tmp_path, rows):
    lines = [f"m{i}@a.example,N{i}" for i in range(8)] + ["long@a.example,A,B,C"]
    folder = write(tmp_path / "f", {"1.csv": "\n".join(lines) + "\n"})
    loaded = readers.load_text(spark, folder, ["mail", "nom"])
    assert loaded.columns == ["source_file", "mail", "nom", "unknown_1", "unknown_2"] and loaded.count() == 9
    assert readers.load_text(spark, folder, ["mail", "nom"], drop_bad=True).count() == 8


def test_preamble_is_skipped_by_place(spark, tmp_path, rows):
    folder = write(tmp_path / "f", {"1.csv": "my list\na@a.example,A\nmy list\nb@a.example,B\n" + "my list\n" * 3})
    assert len(rows(readers.load_text(spark, folder, ["mail", "nom"]))) == 5


def test_stream_reads_lines_of_any_width(spark, tmp_path, rows):
    folder, wide = tmp_path / "in", [f"c{i}" for i in range(40)]
    write(folder, {f"1_x_[{','.join([*wide, 'mail', 'nom'])}].csv": ";" * 40 + 'a@a.example;"A;""B"""\n'})
    append_arrivals(arriving_rows(spark, str(folder), ["mail", "nom", "c3"]), str(tmp_path / "t"), str(tmp_path / "s")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "t")), "mail", "nom", "c3") == [("a@a.example", 'A;"B"', None)]


def test_load_text_latin(spark, tmp_path):
    folder = write(tmp_path / "f", {"1.csv": "titre été\na@a.example,Zoé\n".encode("latin-1")})
    loaded = readers.load_text(spark, folder, ["mail", "nom"], encoding="ISO-8859-1")
    assert [tuple(r) for r in loaded.select("mail", "nom").collect()] == [("a@a.example", "Zoé")]


@pytest.fixture
def status_folder(tmp_path):
    return write(tmp_path / "status", {
        "1_x_[mail,date]_[ads].csv": "a@a.example;2014-01-01\nb@a.example;2014-01-02\nc@a.example;2014-01-03\n",
        "2_x_[date,mail].csv": "2015-01-01;a@a.example\n2015-01-02;d00@a.example\n2015-01-05;e@a.example\n",
        "3_x+y z%_[mail]_[desabo].csv": "b@a.example\n;\n",
        "4_x_[mail]_[ouvreur].csv": "b@a.example\na@a.example\na@a.example\n",
        "5_x_[mail]_[plainte].csv": "c@a.example\n",
    })


def test_read_folder(spark, status_folder, rows):
    df = readers.read_folder(spark, status_folder, ["mail", "date", "nom"])
    assert rows(df.filter("place = 2"), "mail", "date", "nom")[0] == ("a@a.example", "2015-01-01", None)
    loaded = readers.load_status(df, ["desabo", "ouvreur", "plainte"])
    assert rows(loaded.filter("ouvreur"), "mail") == [("a@a.example",), ("b@a.example",)]
    assert loaded.filter("desabo").count() == 1
    assert [r.mail for r in readers.union_files(df).collect()] == [
        "a@a.example", "b@a.example", "c@a.example", "d00@a.example", "e@a.example"]
    assert readers.mail_only(df).columns == ["mail"]


def test_folder_segment(spark, status_folder, rows):
    df = readers.read_folder(spark, status_folder, ["mail", "date"])
    complaints = spark.createDataFrame([("e@a.example",)], "mail string")
    words = spark.createDataFrame([(1, "00@", True), (2, "a@", False)], "id long, mot string, exclusion boolean")
    kept = folders.folder_segment(df, "ads", ["desabo", "plainte"], complaints, words, ["mail", "date"])
    assert rows(kept) == [("a@a.example", "2015-01-01")]


def test_clean_and_rejected_rows(spark, rows):
    df = spark.createDataFrame([(" A@A.example ",), ("a@a.example",), ("bad",), (None,)], "mail string")
    assert rows(readers.clean_rows(df), "mail") == [("a@a.example",)]
    assert rows(readers.rejected_rows(df)) == [("bad",), (None,)]


def test_read_table(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "id long")
    assert rows(readers.read_table(spark, "SELECT max(id) AS top FROM {base}", base=df)) == [(2,)]


# -- writers -------------------------------------------------------------------


def test_write_segment_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([("b", None, 1), ("a", "x", 2), ("a", "y", 3)], "mail string, nom string, n int")
    entry = writers.write_segment(df, str(tmp_path), "ExportMail", "2015-01-01", ["mail", "nom"], mail_unique=True).first()
    assert entry.rows == 2 and entry.name == "ExportMail-MailUnik_2015-01-01_[mail,nom]_0k.csv"
    written = sorted((tmp_path / entry.path.rsplit("/", 1)[1]).glob("part-*.csv"))
    assert "".join(p.read_text() for p in written) == "a;x\nb;\n"


def test_write_membership_is_repeatable(spark, tmp_path, rows):
    contacts = spark.createDataFrame([(1, "a"), (2, "b")], "id long, mail string")
    df = spark.createDataFrame([("a",), ("a",), ("z",)], "mail string")
    for _ in range(2):
        entry = writers.write_membership(df, contacts, "ads", 4, str(tmp_path / "regie_match"), "F", "2015-11-19", "l1").first()
    assert entry.rows == 1 and entry.name.startswith("999_ExportRegie_2015-11-19_[mail]_[regie:ads]")
    table = spark.read.parquet(str(tmp_path / "regie_match"))
    assert rows(table, "mail_id", "regie_id") == [(1, 4)]


def test_overwrite_only_replaceable(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "mail_id long, prenom string")
    writers.overwrite_table(df, str(tmp_path), "id_unik")
    with pytest.raises(ValueError):
        writers.overwrite_table(df, str(tmp_path), "base")


def test_write_parts_and_key_values(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "mail string, chunk int")
    writers.write_parts(df, str(tmp_path / "parts"), "chunk")
    assert sorted(p.name for p in (tmp_path / "parts").glob("chunk=*")) == ["chunk=1", "chunk=2"]
    hashes = spark.createDataFrame([(1, "h1"), (2, "h2")], "mail_id long, md5 string")
    packed = spark.createDataFrame([(1, 'a,b"c', "")], "mail_id long, prenom string, nom string")
    got = rows(writers.key_value_rows(hashes, packed, ["prenom", "nom"]))
    assert got == [("h1", '{"prenom_1":"a","prenom_2":"b\\"c"}'), ("h2", "{}")]


# -- import ----------------------------------------------------------------------


@pytest.fixture
def known(spark):
    base = spark.createDataFrame([(5, "a@a.example", "a.example")], "id long, mail string, domain string")
    hashes = base.select(F.col("id").alias("mail_id"), F.md5("mail").alias("md5"))
    return Model.from_frames(spark, {"base": base, "md5": hashes})


def test_import_folder(spark, tmp_path, known, rows):
    folder = write(tmp_path / "in", {
        "2_x_[mail,prenom,birth]_1k.csv": "A@a.example;Ana;07/12/1980\nnew@b.example;Bea;\n",
        "1_x_[mail,ip]_[ouvreur]_1k.csv": "new@b.example;10.0.0.1\nother@c.example;\nbad;10.0.0.2\n",
        "3_x_[mail].csv": "nothing\n",
    })
    store = str(tmp_path / "store")
    for _ in range(2):
        report = ingest.import_folder(known, folder, store, "l1")
    read = lambda t: spark.read.parquet(f"{store}/{t}")
    assert rows(read("base"), "id", "mail", "domain") == [
        (6, "new@b.example", "b.example"), (7, "other@c.example", "c.example")]
    assert rows(read("md5"), "mail_id") == [(6,), (7,)]
    assert [(r[0], r[1], str(r[2])) for r in rows(read("id"), "mail_id", "prenom", "birth")] == [
        (5, "Ana", "1980-12-07"), (6, "Bea", "None")]
    assert rows(read("lead"), "mail_id", "ip") == [(6, "10.0.0.1")]
    assert rows(read("fichier_match"), "mail_id", "fichier_id") == [(5, 2), (6, 1), (6, 2), (7, 1)]
    assert rows(report, "name", "status", "n_exist", "n_new") == [
        ("1_x_[mail,ip]_[ouvreur]_1k.csv", "OK", 0, 2),
        ("2_x_[mail,prenom,birth]_1k.csv", "OK", 1, 1),
        ("3_x_[mail].csv", "PB", None, None),
    ]


def test_files_of_another_load_are_passed_over(spark, tmp_path, known, rows):
    folder = write(tmp_path / "in", {"1_x_[mail].csv": "new@b.example\n"})
    store = str(tmp_path / "store")
    ingest.import_folder(known, folder, store, "l1")
    write(tmp_path / "in", {"2_x_[mail].csv": "next@b.example\n"})
    report = ingest.import_folder(known, folder, store, "l2")
    assert rows(report, "name", "status") == [("2_x_[mail].csv", "OK")]
    added = spark.read.parquet(f"{store}/base")
    assert rows(added.filter("load = 'l2'"), "mail") == [("next@b.example",)]


@pytest.mark.parametrize("choice,expected", [
    ({"only_group": "id"}, [("Bea",)]), ({"only_status": "ouvreur"}, []),
])
def test_import_part_of_a_folder(spark, tmp_path, known, rows, choice, expected):
    folder = write(tmp_path / "in", {
        "2_x_[mail,prenom]_1k.csv": "new@b.example;Bea\n",
        "1_x_[mail,ip]_[ouvreur]_1k.csv": "z@b.example;10.0.0.1\n",
    })
    ingest.import_folder(known, folder, str(tmp_path / "s"), "l1", **choice)
    assert rows(spark.read.parquet(str(tmp_path / "s" / "id")), "prenom") == expected


def test_a_store_can_be_opened_and_loads_repeated(spark, tmp_path, rows):
    """Contacts, identities and files keep their numbers; none is given twice; files and leads can be asked for."""
    folder = write(tmp_path / "in", {
        "305_x_[mail,prenom,ip,date].csv": "a@a.example;Ana;10.0.0.1;2015-11-19 10:00:00\na@a.example;Bea;;19/11/2015\nb@a.example;;;\n",
        "7_x_[mail]_[ouvreur].csv": "b@a.example\n", "8_x_[mail]_[regie=ads].csv": "a@a.example\nc@a.example\n",
    })
    store = str(tmp_path / "store")
    opened = lambda: Model.from_parquet(spark, store)
    seen = []
    for _ in range(2):
        ingest.import_folder(opened(), folder, store, "first")
        seen.append({t: rows(opened()[t]) for t in SCHEMAS})
    assert seen[0] == seen[1]
    model = opened()
    ids = {r.mail: r.id for r in model["base"].collect()}
    assert sorted(ids) == ["a@a.example", "b@a.example", "c@a.example"] and len(set(ids.values())) == 3
    assert rows(model["base_ouvreur"]) == [(ids["b@a.example"],)]
    assert [r.abreviation for r in model["regie_list"].collect()] == ["ads"] and model["regie_match"].count() == 2
    assert [str(r[0]) for r in rows(model["lead"], "date")] == ["2015-11-19 00:00:00", "2015-11-19 10:00:00"]
    people = Segment(model).file("305").select("identity_latest").collect()
    assert sorted((r.mail, r.prenom) for r in people if r.prenom) == [("a@a.example", "Ana"), ("a@a.example", "Bea")] or len(people) >= 2
    assert len({r.id for r in model["id"].collect()}) == model["id"].count()

    later = write(tmp_path / "more", {"400_x_[mail,prenom].csv": "d@a.example;Dan\nb@a.example;Bob\n"})
    ingest.import_folder(opened(), later, store, "second")
    assert len({r.id for r in opened()["fichier_list"].collect()}) == 4
    assert rows(opened()["base"].filter("mail LIKE 'd%'"), "id")[0][0] > max(ids.values())
    # A load replaced by fewer rows never frees a number.
    ingest.import_folder(opened(), write(tmp_path / "less", {"1_y_[mail].csv": "e@a.example\n"}), store, "second")
    assert {r.mail: r.id for r in opened()["base"].collect()}["e@a.example"] > max(ids.values()) + 1


def test_what_is_not_taken_in_is_kept(spark, tmp_path, known, rows):
    folder = write(tmp_path / "in", {
        "1_x_[mail,birth].csv": "a@a.example;soon\nbad;\nb@b.example;1980-01-02\n;\n", "2_x_[mail].csv": "", "3_x.csv": "c@a.example\n",
    })
    store = str(tmp_path / "store")
    report = ingest.import_folder(known, folder, store, "l1", deny="@b")
    assert rows(report, "name", "status", "lines", "rejected", "unread_birth", "initial", "error") == [
        ("1_x_[mail,birth].csv", "OK", 4, 3, 1, 1, None), ("2_x_[mail].csv", "PB", 0, 0, 0, None, "no content"),
        ("3_x.csv", "PB", 0, 0, 0, None, "the name gives no mail column")]
    rejects = rows(spark.read.parquet(f"{store}/import_rejects"), "field", "value", "reason")
    assert rejects == [("birth", "soon", "unread"), ("mail", "b@b.example", "not allowed"), ("mail", "bad", "not well formed"), ("mail", None, "not well formed")]


def test_scores_and_mails_alone(spark, tmp_path, known, rows):
    folder = write(tmp_path / "in", {"1_travel_[mail,score,prenom].csv": "a@a.example;0.5;Ana\nz@a.example;;Zoe\n"})
    ingest.import_folder(known, folder, str(tmp_path / "s"), "l1")
    opened = Model.from_parquet(spark, str(tmp_path / "s"))
    assert rows(opened["appetence_match"], "mail_id", "score") == [(5, 0.5)] and rows(opened["appetence_list"], "interet") == [("travel",)]
    ingest.import_folder(known, folder, str(tmp_path / "m"), "l1", mails_only=True)
    opened = Model.from_parquet(spark, str(tmp_path / "m"))
    assert opened["base"].count() == 1 and opened["id"].count() == 0


def test_backfill(spark, known, rows):
    base = known["base"].unionAll(spark.createDataFrame([(9, "z@z.example", "z.example")], SCHEMAS["base"]))
    got = rows(ingest.backfill_hashes(base, known["md5"]), "mail_id")
    assert got == [(9,)]


def test_stream_import(spark, tmp_path, rows):
    folder = tmp_path / "in"
    write(folder, {"1_x_[mail,nom]_[ouvreur].csv": "a@a.example;A\n"})
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    run = lambda: append_arrivals(
        arriving_rows(spark, str(folder), ["mail", "nom"]), table, state).awaitTermination()
    run()
    write(folder, {"2_x_[nom,mail].csv": "B;b@a.example\n"})
    run()
    run()
    got = rows(spark.read.parquet(table), "source_file", "mail", "nom", "statuses")
    assert got == [
        ("1_x_[mail,nom]_[ouvreur].csv", "a@a.example", "A", ["ouvreur"]),
        ("2_x_[nom,mail].csv", "b@a.example", "B", []),
    ]

"""Segments and recipes on a small base, against plain Python sets."""

import random

import pytest
from pyspark.sql import functions as F

from listloom.model import IDENTITY, SCHEMAS, Model
from listloom.plans import recipes
from listloom.plans.described import described
from listloom.plans.layouts import PARTNER_COLUMNS, partner_layout
from listloom.plans.segment import Segment


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    n = 60
    pick = lambda share: [(i,) for i in range(n) if rng.random() < share]
    # Contact 0 holds a third of the identities, leads and file links.
    hot = lambda count: [0] * (count // 3) + [rng.randrange(1, n - 5) for _ in range(count - count // 3)]
    return {
        "base": [(i, f"m{i:02d}@d{i % 3}.example", f"d{i % 3}.example") for i in range(n)],
        "id": [
            (1000 + k, m, rng.choice(["1.0", None]), rng.choice("ab"), None, rng.choice(["75001", "92100"]), "Ville", None)
            for k, m in enumerate(hot(90))
        ],
        "lead": [(m, rng.choice(["10.0.0.1", None]), "site", None) for m in hot(40)],
        "md5": [(i, f"h{i}") for i in range(n)],
        "sms": [(m, str(m)) for m in [0, 0, 3, 4, 999]],
        "fichier_list": [(1, "305"), (2, "306"), (3, "82-1")],
        "fichier_match": [(m, rng.randint(1, 3)) for m in hot(80)],
        "partner_match": [(i, rng.randint(1, 3)) for i in range(n)],
        "regie_list": [(1, "ads"), (2, "rad")],
        "regie_match": [(i, rng.randint(1, 2)) for i in range(n) if rng.random() < 0.4],
        "base_plainte": pick(0.1), "base_npai": pick(0.1), "base_ouvreur": pick(0.3), "log_criteo": pick(0.5),
        "mot_match": [(m[0], 1) for m in pick(0.1)],
        "optin_list": [(1, "sho"), (2, "clu")],
        "optin_match": [(i, rng.randint(1, 2)) for i in range(n)],
        "optin_desabo": [(i, rng.randint(1, 2), rng.choice(["spam", "npai", "other"])) for i in range(0, n, 4)],
    }


@pytest.fixture(scope="module")
def model(spark, data):
    frames = {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in data.items()}
    return Model.from_frames(spark, frames)


def ids(data, table, link=None, listed=None, names=None):
    if listed is None:
        return {r[0] for r in data[table]}
    chosen = {i for i, name in data[listed] if name in names}
    return {r[0] for r in data[table] if r[link] in chosen}


def suppressed(data, *names):
    sets = {
        "plainte": ids(data, "base_plainte"), "npai": ids(data, "base_npai"), "mot": ids(data, "mot_match"),
        "spam": {r[0] for r in data["optin_desabo"] if r[2] in ("spam", "npai")},
    }
    return set().union(*[sets[n] for n in names])


def contact_ids(df):
    return {r.id for r in df.collect()}


def test_segment_conditions(model, data):
    segment = Segment(model).partner(1, 2).file("305", "306").not_broker("rad").suppress("plainte", "mot", "spam", "npai")
    expected = {r[0] for r in data["partner_match"] if r[1] in (1, 2)}
    expected &= ids(data, "fichier_match", 1, "fichier_list", ["305", "306"])
    expected -= ids(data, "regie_match", 1, "regie_list", ["rad"])
    expected -= suppressed(data, "plainte", "mot", "spam", "npai")
    assert expected and contact_ids(segment.contacts()) == expected


def test_empty_segment_is_everyone(model, data):
    assert contact_ids(Segment(model).contacts()) == ids(data, "base")


def test_opposite_conditions(model, data):
    everyone = ids(data, "base")
    for inside, outside in [
        (Segment(model).partner(1), Segment(model).not_partner(1)),
        (Segment(model).file("305"), Segment(model).not_file("305")),
        (Segment(model).broker("ads"), Segment(model).not_broker("ads")),
        (Segment(model).broker_id(1), Segment(model).not_broker_id(1)),
        (Segment(model).opted_in("sho"), Segment(model).not_opted_in("sho")),
    ]:
        a, b = contact_ids(inside.contacts()), contact_ids(outside.contacts())
        assert a and b and not a & b and a | b == everyone


def test_named_conditions(model, data):
    segment = Segment(model).only("ouvreur", "criteo").not_unsubscribed("sho")
    gone = ids(data, "optin_desabo", 1, "optin_list", ["sho"])
    expected = (ids(data, "base_ouvreur") & ids(data, "log_criteo")) - gone
    assert contact_ids(segment.contacts()) == expected


def test_identity_projection_keeps_everyone(model, data):
    rows = Segment(model).select("identity_latest").collect()
    with_identity = {r[1] for r in data["id"]}
    assert len(rows) == len(data["id"]) + len(ids(data, "base") - with_identity)
    grouped = Segment(model).select("identity_latest", keep_reference=True)
    assert grouped.count() == len(data["id"]) + 1


@pytest.mark.parametrize("kind", ["classic", "ip", "provenance"])
def test_projections_are_distinct_left_joins(model, kind):
    base, identity = model["base"], model["id"].withColumnRenamed("id", "i")
    plain = base.join(identity, base.id == identity.mail_id, "left").drop("mail_id")
    extra = {"classic": [], "ip": ["ip"], "provenance": ["ip", "provenance", "date"]}[kind]
    if extra:
        side = model["campagne_ouvreur" if kind == "ip" else "lead"]
        plain = plain.join(side, base.id == side.mail_id, "left")
    plain = plain.select("mail", *IDENTITY, *extra).distinct()
    got = Segment(model).select(kind)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_exports_hold_no_suppressed_mail(model, data):
    unwanted = {f"m{i:02d}@d{i % 3}.example" for i in suppressed(data, "plainte", "mot", "npai")}
    for df in [
        recipes.file_clean(model, ["305"]), recipes.one_per_mail(model, ["305"]),
        recipes.clean_outside_file(model, model["base"].select("mail")),
        recipes.broker_optin(model, "ads", "clu"), recipes.sms_from_file(model, ["305"]),
    ]:
        assert not unwanted & {r.mail for r in df.collect()}


def test_one_row_per_key(model):
    for df, key in [
        (recipes.one_per_mail(model, ["305", "306"]), "mail"), (recipes.one_per_hash(model), "md5"),
    ]:
        assert df.count() == df.select(key).distinct().count() > 0


def test_black_list_and_clean_file_are_complementary(model, data):
    chosen = ids(data, "fichier_match", 1, "fichier_list", ["305"])
    black = recipes.black_list(model, ["305"]).count()
    clean = Segment(model).file("305").suppress("plainte", "mot", "spam").contacts().count()
    assert black + clean == len(chosen)


def test_common_with_partner_per_broker(model, data):
    got = {(r.broker, r.mail) for r in recipes.common_with_partner(model, 1, ["ads", "rad"]).collect()}
    people = {r[0] for r in data["partner_match"] if r[1] == 1} - suppressed(data, "plainte", "mot", "spam")
    expected = {
        (b, f"m{i:02d}@d{i % 3}.example")
        for b in ["ads", "rad"] for i in people - ids(data, "regie_match", 1, "regie_list", [b])
    }
    assert got == expected


def test_non_webmail_cap(model, data):
    df = recipes.non_webmail_by_file(model, ["82", "305"], ["d0.example"], cap=5, seed=1)
    got = df.collect()
    assert {r.fichier_num for r in got} == {"82-1", "305"}
    assert all(not r.mail.endswith("d0.example") for r in got)
    for number in ["82-1", "305"]:
        links = ids(data, "fichier_match", 1, "fichier_list", [number]) - suppressed(data, "plainte", "npai")
        full = {i for i in links if i % 3}
        assert sum(r.fichier_num == number for r in got) == min(5, len(full))


def test_described_segment(model, data):
    df = described(model, {
        "select": {"base": ["mail", "id"], "id": ["left", "cp"]},
        "where": {
            "id.cp": "not null", "base.domain": ["d0.example", "d1.example"],
            "fichier_match.fichier_id": {"select": {"fichier_list": "id"}, "where": {"fichier_num": ["305"]}},
        },
        "limit": 1000,
    })
    chosen = ids(data, "fichier_match", 1, "fichier_list", ["305"])
    expected = sorted((r[1], r[5]) for r in data["id"] if r[1] in chosen and r[1] % 3 < 2)
    assert sorted((r.id, r.cp) for r in df.collect()) == expected
    everyone = described(model, {"select": {"base": ["mail"], "sms": ["right", "port"]}})
    assert everyone.count() == len(data["sms"]) and everyone.columns == ["mail", "port"]


def test_described_constant(model):
    df = described(model, {"select": {"base": ["mail"]}, "where": {"base.id": 3}})
    assert [r.mail for r in df.collect()] == ["m03@d0.example"]


def test_partner_layout(spark, model):
    rows = partner_layout(Segment(model).select("classic"))
    assert rows.columns == PARTNER_COLUMNS
    first = rows.first()
    assert first.date is None and first.ip is None and first.pays == "france" and first.adresse == ""
    assert {r.civilite for r in rows.collect()} == {"M", None}


def test_clean_by_lists_and_versions(spark):
    rows = spark.createDataFrame(
        [("a", "1.0", "01000.0"), ("a", "2.0", "2"), ("b", "3.0", "3"), (None, "4", "4")], "mail string, civilite string, cp string"
    )
    kept = recipes.clean_by_lists(rows, [spark.createDataFrame([("b",)], "mail string")], rows.columns)
    assert [tuple(r) for r in kept.collect()] == [("a", "1", "01000")]
    versions = recipes.export_versions(rows)
    assert [versions[k].count() for k in ["full", "mail_unique", "mail_only"]] == [4, 3, 3]
    assert versions["mail_only"].columns == ["mail"]


def test_flagged_mails(spark):
    rows = spark.createDataFrame(
        [("a", False, None), ("b", False, True), ("c", True, None), ("d", None, None)],
        "mail string, exclusion_mot_cle boolean, plainte boolean",
    )
    assert [r.mail for r in recipes.flagged_mails(rows).collect()] == ["a"]
    openers = rows.withColumn("ouvreur", F.lit(True))
    assert recipes.openers_and_others(openers, rows.drop("plainte")).count() == 8


def test_extract_steps(spark):
    rows = spark.createDataFrame([(f"m{i % 50:02d}", i) for i in range(120)], "mail string, n int")
    assert recipes.extract(rows).count() == 50
    got = recipes.extract(rows, sample=20, sort=True, mail_only=True)
    mails = [r.mail for r in got.collect()]
    assert got.columns == ["mail"] and len(set(mails)) == 20 and mails == sorted(mails)
    assert recipes.extract(rows, mail_unique=False, sample=100).count() == 100
    with pytest.raises(Exception, match="sample of 51 from 50"):
        recipes.extract(rows, sample=51).collect()

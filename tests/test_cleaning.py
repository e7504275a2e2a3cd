import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listloom.functions import clean, dates
from listloom.functions.synthetic import synthetic_times


def values(spark, column, given_values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given_values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_civility_then_strip(spark):
    given_values = ["1.0", "3.0", "4.0", "1", "nan", None, "M"]
    column = clean.strip_decimal(clean.civility("v"))
    assert values(spark, column, given_values) == ["M", "MME", "4", "1", None, None, "M"]


def test_strip_decimal_keeps_zeros(spark):
    assert values(spark, clean.strip_decimal("v"), ["01000.0", "75,5", "2A004"]) == ["01000", "75", "2A004"]


def test_birth_format(spark):
    texts = ["07/12/1980", "1980-12-07 00:00:00", "1980-12-07", "7-12-1980", "1980", "zz", None, "1850-03-01"]
    expected = ["19801207000000"] * 4 + [None] * 4
    assert values(spark, dates.birth_format("v"), texts) == expected
    unread = [False] * 4 + [True, True, False, True]
    assert values(spark, dates.unread_birth("v"), texts) == unread


def test_century_repair(spark):
    texts = ["0001-01-01", "1785-01-01", "1900-06-01", "1980-12-07", "2014-12-31", "2015-01-01", "2044-05-01"]
    days = [dt.date.fromisoformat(t) for t in texts]
    got = values(spark, dates.century_repair("v").cast("string"), days, "date")
    assert got == [
        None, "1984-11-14", "1900-06-01", "1980-12-07", "2014-12-31", "1915-01-26", "1944-05-26",
    ]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.dates(dt.date(1, 1, 1), dt.date(2900, 1, 1)), min_size=300, max_size=300))
def test_century_repair_against_rule(spark, days):
    def rule(day):
        if day.year <= 1:
            return None
        if day.year <= 1900 or day.year > 2014:
            return day + dt.timedelta(days=(19 - day.year // 100) * 36500)
        return day

    expected = [None if rule(d) is None else rule(d).isoformat() for d in days]
    assert values(spark, dates.century_repair("v").cast("string"), days, "date") == expected


def test_run_date_and_text(spark):
    days = [dt.date(2014, 5, 20), dt.date(1980, 1, 2), None]
    column = dates.date_text(dates.not_run_date("v", F.lit("2014-05-20").cast("date")))
    assert values(spark, column, days, "date") == [None, "1980-01-02", None]
    assert values(spark, dates.date_text("v", "dd/MM/yyyy"), days, "date")[1] == "02/01/1980"


def test_mail_rules(spark):
    mails = [" Ana@Mail.example ", "no-at.example", "a@b", "a b@c.example", None, "x@-bad.example"]
    assert values(spark, clean.valid_mail("v"), mails) == [True, False, False, False, False, False]
    assert values(spark, clean.mail_domain("v"), ["a@b.example"]) == ["b.example"]
    same = values(spark, clean.mail_hash("v"), [" Ana@Mail.example ", "ana@mail.example"])
    assert same[0] == same[1]


def test_ip_and_null_text(spark):
    ips = ["10.0.0.1", "None", None, ""]
    assert values(spark, clean.has_ip("v"), ips) == [True, False, False, False]
    assert values(spark, clean.null_text("v"), ["NaN", "none", "x", None]) == [None, None, "x", None]


def test_pattern_forms(spark):
    names = ["82", "182", "110", "abcxy-1"]
    assert values(spark, clean.any_of("v", ["82", "110"]), names) == [True, False, True, False]
    assert values(spark, clean.any_of("v", ["abcxy"], whole=False), names) == [False, False, False, True]
    assert values(spark, clean.department("v"), ["92300"]) == ["92"]


def test_flags(spark, rows):
    df = spark.createDataFrame(
        [(1, True, None), (2, True, True), (3, True, False), (4, None, None)], "id int, keep boolean, desabo boolean"
    )
    assert rows(df.filter(clean.true_and_none("keep", ["desabo"])), "id") == [(1,), (3,)]
    assert rows(df.filter(clean.true_and_none("keep", [])), "id") == [(1,), (2,), (3,)]


def test_synthetic_times(spark):
    df = synthetic_times(spark, "2013-10-10 13:30:00", "2014-02-21 04:50:00", 500, seed=3)
    got = df.collect()
    again = synthetic_times(spark, "2013-10-10 13:30:00", "2014-02-21 04:50:00", 500, seed=3).collect()
    assert got == again and len(got) == 500 and all(r.synthetic for r in got)
    end = dt.datetime(2014, 2, 21, 4, 50)
    assert all(dt.datetime(2013, 10, 10) <= r.at <= end for r in got)
    assert all(r.at.hour >= 6 or r.at == end for r in got)

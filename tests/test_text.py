"""Scalar text functions against plain-Python statements of the same rules."""

import re

from pyspark.sql import functions as F

from paperflow.functions import text as TX


CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")


def py_clean(t):
    """Control characters out, then str.split() (Unicode whitespace runs, ends dropped)."""
    return " ".join(CONTROL.sub("", t or "").split())


def py_trunc(t, n):
    if not t:
        return ""
    return t[:n] + "..." if len(t) > n else t


SAMPLES = [
    None, "", "  plain  text  ", "a\x00b\x07c\x1fd", "x \u00a0\u2003\u3000y", "z\u0085w", "keep\u200bzero",
    "tab\tnew\nline\r\nend", "\u2028 sep \u2029", "\x1c\x1dfs", "\u00e9" * 120, "\U0001F600" * 30 + " emoji",
]


def test_clean_text_matches_python(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string")
    got = [r[0] for r in df.select(TX.clean_text("t")).collect()]
    assert got == [py_clean(s) for s in SAMPLES]


def test_clean_text_idempotent(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string")
    once = df.select(TX.clean_text("t").alias("t"))
    twice = once.select(TX.clean_text("t").alias("t"))
    assert once.collect() == twice.collect()


def test_truncate(spark):
    vals = [None, "", "a" * 99, "a" * 100, "a" * 101, "é" * 101]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(TX.truncate_text("t", 100)).collect()]
    assert got == [py_trunc(v, 100) for v in vals]


def test_author_label(spark):
    cases = [[], ["A"], ["A", "B", "C"], ["A", "B", "C", "D"], None]
    df = spark.createDataFrame([(c,) for c in cases], "a array<string>")
    got = [r[0] for r in df.select(TX.author_label("a")).collect()]
    assert got == ["", "A", "A, B, C", "A, B, C et al.", ""]


def test_url_tail_and_ascii(spark):
    df = spark.createDataFrame([("http://arxiv.org/abs/2401.00001v2",), ("http://arxiv.org/abs/cs/0101001v1",),
                                ("http://x/y/",)], "u string")
    got = [r[0] for r in df.select(TX.url_tail("u")).collect()]
    assert got == ["2401.00001v2", "0101001v1", ""]
    a = spark.createDataFrame([("naïve café ~\x7f",)], "t string").select(TX.ascii_only("t")).first()[0]
    assert a == "nave caf ~"


def test_model_input_caps_page_text(spark):
    df = spark.createDataFrame([("T", "A", "p" * 20000)], "t string, a string, p string")
    s = df.select(TX.model_input("t", "a", "p", max_chars=15000)).first()[0]
    assert ("p" * 15000) in s and ("p" * 15001) not in s
    assert ("p" * 20000) in df.select(TX.model_input("t", "a", "p")).first()[0]   # whole by default


def test_reformat_text_date_and_parse_day(spark):
    import pytest
    from paperflow.functions import dates
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05+00:00",), ("garbage",), (None,),
                                ("2024-03-01",), ("2024-03-01 10:20:30",), ("2024-01-01T23:30:00+05:00",)], "s string")
    got = [r[0] for r in df.select(dates.reformat_text_date("s", dates.EXPORT_MINUTE_FORMAT)).collect()]
    assert got == ["2024-01-02 03:04", "2024-01-02 03:04", "garbage", "",
                   "2024-03-01 00:00", "2024-03-01 10:20", "2024-01-01 23:30"]
    assert str(dates.parse_day("2024-02-29")) == "2024-02-29"
    with pytest.raises(ValueError):
        dates.parse_day("02/29/2024")


def test_epoch_micros_and_literals_ignore_session_zone(spark):
    import datetime as dt

    from paperflow.functions import dates
    vals = [dt.datetime(2024, 3, 10, 2, 30, 0, 123456), dt.datetime(2024, 11, 3, 1, 30), dt.datetime(1999, 12, 31, 23, 59, 59)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(v.isoformat(sep=" "),) for v in vals], "s string").select(
            F.col("s").cast("timestamp_ntz").alias("t"))
        got = [r[0] for r in df.select(dates.epoch_micros("t")).collect()]
        lit = spark.range(1).select(dates.ntz_lit(vals[0]).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    epoch = dt.datetime(1970, 1, 1)
    assert got == [(v - epoch) // dt.timedelta(microseconds=1) for v in vals]
    assert lit == "2024-03-10 02:30:00.123456"

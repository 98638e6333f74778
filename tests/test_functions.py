"""Scalar and text functions on hand rows (the reference's literal cases and
the hand-checked rows of FIXTURES.md §5)."""

import hashlib

from pyspark.sql import functions as F

from histevents.functions import scalars as S
from histevents.functions import text as T


def _eval(spark, expr, values, type_="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_digital_root_cases(spark):
    years = [2008, 2023, 1999, 1929, 1, 9, 10, 19, 2020, 0, -5]
    assert _eval(spark, S.digital_root, years, "int") == [1, 7, 1, 3, 1, 9, 1, 1, 4, 0, -5]


def test_digital_root_property(spark):
    years = list(range(10, 2026))
    got = _eval(spark, S.digital_root, years, "int")
    assert all(r == (9 if y % 9 == 0 else y % 9) for y, r in zip(years, got))


def test_event_hash(spark):
    df = spark.createDataFrame([(2008, "Global Financial Crisis", "test")], "year int, title string, source string")
    h = df.select(S.event_hash()).first()[0]
    assert len(h) == 32
    assert h == hashlib.md5(b"2008_Global Financial Crisis_test").hexdigest()
    assert h == "b0c6b6c8fca81746121ea1cbdb3842dd"


def test_clean_text(spark):
    raw = "  Café  & don't “x” a/b² (ok)!\n"
    assert _eval(spark, T.clean_text, [raw, None, ""]) == ["Café  dont x ab² (ok)!", "", ""]


def test_event_title(spark):
    s = "The Treaty of Versailles formally ended the First World War in Europe, signed"
    assert _eval(spark, T.event_title, [s, "a" * 60, "Short one, rest"]) == [
        "The Treaty of Versailles formally ended the First...", "a" * 50 + "...", "Short one"]


def test_location(spark):
    got = _eval(spark, T.extract_location,
                ["signed in March at Camp David", "in New York City", "Rome was built", "none here"])
    assert got == ["Camp David", "New York City", "Rome", None]


def test_participants(spark):
    s = "Otto Bismarck met the German Empire and Red Army near Otto Bismarck"
    assert _eval(spark, T.extract_participants, [s, "nobody here"]) == [
        "Otto Bismarck, German Empire, Red Army", None]


def test_tags(spark):
    df = spark.createDataFrame([("Market CRASH now", "economic")], "s string, c string")
    tags = df.select(T.extract_tags("s", "c")).first()[0]
    assert set(tags) == {"economic", "crash", "market"} and tags[0] == "economic"


def test_categorize(spark):
    got = _eval(spark, lambda c: T.categorize(F.lower(c)), ["recession war", "none", "war coup crash"])
    assert got == ["economic", "political", "political"]


def test_nearest_year(spark):
    df = spark.createDataFrame([("Page", "In 1960 and 1940 and 2099 and 19455", 1950),
                                ("About 1930", "x", 1950), ("About 1830", "1949", 1950)],
                               "t string, c string, a int")
    got = [r[0] for r in df.select(T.nearest_year("t", "c", "a")).collect()]
    assert got == [1960, 1930, 1949]


def test_first_year(spark):
    got = _eval(spark, T.first_year, ["in 1871 and 1990", "year 2099 then 1999", "a1999 b", "none", "19455"])
    assert got == [1871, None, None, None, None]


def test_sections(spark):
    content = "pre text\n== Econ ==\nA recession hit.\n=== Wars ===\n== End ==\nLast"
    df = spark.createDataFrame([(content,), ("no headers",), ("",)], "c string")
    rows = df.select(T.split_sections("c").alias("s")).collect()
    assert [(x.title, x.body) for x in rows[0].s] == [("Econ", "A recession hit."), ("End", "Last")]
    assert [(x.title, x.body) for x in rows[1].s] == [("Main content", "no headers")]
    assert rows[2].s == []


def test_sentences(spark):
    content = ("• The treaty was signed in Paris. It ended the long conflict! Then calm followed there.\n"
               "- short\n* Another bullet line of enough length")
    got = _eval(spark, T.split_sentences, [content])[0]
    assert got == ["The treaty was signed in Paris", "It ended the long conflict", "Then calm followed there.",
                   "Another bullet line of enough length"]


def test_similarity(spark):
    df = spark.createDataFrame([("word", "two words"), ("abc", "abc"), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(T.trigram_similarity("a", "b")).collect()]
    assert abs(got[0] - 4 / 11) < 1e-12 and got[1] == 1.0 and got[2] is None


def test_url(spark):
    urls = ["https://en.wikipedia.org/wiki/X", "ftp://a.com", "http://localhost:80/x", "http://a.museums", "not url"]
    assert _eval(spark, S.is_valid_url, urls) == [True, False, True, False, False]


def test_date_strings(spark):
    ds = ["2020-01-05", "2020-1-5", "2020-01-05 10:00:00", "2020-01-05T10:00:00", "2020-01-05T10:00:00Z",
          "2020-02-30", "05/01/2020", "2020-01-05T10:00:00+02:00"]
    assert _eval(spark, S.is_valid_date_string, ds) == [True, True, True, True, True, False, False, False]


def test_format_1f_half_even_on_binary(spark):
    got = _eval(spark, S.format_1f, [0.25, 0.35, 2.45, 12.0, 0.05], "double")
    assert got == ["%.1f" % v for v in (0.25, 0.35, 2.45, 12.0, 0.05)]


def test_published_year_own_offset(spark):
    got = _eval(spark, S.published_year, ["2019-12-31T23:30:00-05:00", "2020-01-01T00:00:00Z", "bad", None])
    assert got == [2019, 2020, None, None]


def test_severity(spark):
    df = spark.createDataFrame([("World War", None), ("European crash", "x"), ("A nation", None), ("x", "y")],
                               "t string, d string")
    got = [r[0] for r in df.select(T.estimate_severity("t", "d")).collect()]
    assert got == [5, 4, 3, 2]


def test_news_fields(spark):
    df = spark.createDataFrame([("Angela Merkel meets Emmanuel Macron", "Talks in Paris today"),
                                ("The Spain government acts", None),
                                ("Reporters from White House attended", "said New York Times")],
                               "t string, c string")
    rows = df.select(T.news_location("t", "c"), T.news_participants("t", "c")).collect()
    assert rows[0][0] == "Paris" and rows[0][1] == "Angela Merkel, Emmanuel Macron"
    assert rows[1][0] == "Spain"
    assert rows[2][1] == "New York"


def test_year_batches(spark):
    b = spark.range(1).select(F.size(S.year_batches(1, 2025, 50)).alias("n"),
                              F.element_at(S.year_batches(1, 2025, 50), -1).alias("last")).first()
    assert b.n == 41 and (b.last.batch_start, b.last.batch_end) == (2001, 2025)


def test_sql_functions(spark):
    from histevents.functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    r = spark.sql("SELECT digital_root(1929) AS a, digital_root(2020) AS b, is_valid_url('http://localhost:80/x') AS c, "
                  "is_valid_url('ftp://a.com') AS d, event_hash(2008, 'Global Financial Crisis', 'test') AS e, "
                  "trigram_similarity('word', 'two words') AS f").first()
    assert (r.a, r.b, r.c, r.d) == (3, 4, True, False)
    assert r.e == "b0c6b6c8fca81746121ea1cbdb3842dd" and abs(r.f - 4 / 11) < 1e-12

"""Properties of the text kit over every whole document of sf0.001 (accented
multilingual text, line breaks, bullets), and rows worked out by hand."""

import re

from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions import text as T
from tests.conftest import SF_SMALL


def _documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_cleaned_documents(spark):
    rows = _documents(spark).select("text", T.clean_text("text").alias("c")).collect()
    assert len(rows) >= 200
    again = [r[0] for r in spark.createDataFrame([(r.c,) for r in rows], "c string").select(T.clean_text("c")).collect()]
    for r, twice in zip(rows, again):
        assert r.c == r.c.strip()
        kept = [ch for ch in r.text if not ch.isspace()]
        left = iter(kept)
        assert all(ch in left for ch in r.c if ch != " "), "characters keep their order"
        dropped = len(kept) - len([ch for ch in r.c if not ch.isspace()])
        assert dropped == sum(not (ch.isalnum() or ch in "_.,!?;:-()") for ch in kept)
    # cleaning only takes blanks away that a dropped sign left behind
    assert [re.sub(r"\s+", " ", r.c) for r in rows] == [re.sub(r"\s+", " ", x) for x in again]


def test_first_year_of_documents(spark):
    for r in _documents(spark).select("text", T.first_year("text").alias("y")).collect():
        standing = [int(w) for w in re.split(r"\W+", r.text) if re.fullmatch("[0-9]{4}", w)]
        candidates = [y for y in standing if 1000 <= y <= 2099]
        assert r.y is None or r.y == candidates[0] <= 2025
        assert r.y is not None or not candidates or candidates[0] > 2025


def test_sentences_of_documents(spark):
    rows = _documents(spark).select("text", T.split_sentences(F.col("text")).alias("s")).collect()
    assert sum(len(r.s) for r in rows) > 1000
    for r in rows:
        at = 0
        for piece in r.s:
            at = r.text.index(piece, at) + len(piece)  # found in order, without overlap
            assert len(piece) > L.MIN_SENTENCE_LENGTH and "\n" not in piece and piece == piece.strip()
            assert not re.search(r"[.!?]\s+[A-Z]", piece), "no piece holds a break"
        # what isn't in a piece is ends of sentences, bullets and short pieces
        rest = r.text
        for piece in r.s:
            rest = rest.replace(piece, "\n", 1)
        for part in re.split(r"\n|[.!?]+\s+", rest):
            assert len(part.strip()) <= L.MIN_SENTENCE_LENGTH + 1


def test_fields_of_sentences(spark):
    s = _documents(spark).select(F.explode(T.split_sentences(F.col("text"))).alias("raw"))
    s = s.select(T.clean_text("raw").alias("s")).filter("s <> ''")
    rows = s.select("s", T.event_title("s").alias("t"), T.extract_location("s").alias("loc"),
                    T.extract_participants("s").alias("who")).collect()
    assert len(rows) > 1000 and any(r.loc for r in rows) and any(r.who for r in rows)
    for r in rows:
        head = r.s.split(",")[0]
        if len(head) <= L.TITLE_MAX:
            assert r.t == head.strip()
        else:
            assert r.t.endswith("...") and head.startswith(r.t[:-3]) and len(r.t) <= L.TITLE_MAX + 3
        if r.loc:
            place = re.escape(r.loc)
            assert re.search(rf"\b(?:in|at)\s+{place}|{place}\s+(?:is|was|become)", r.s), r.s
            assert all(w[0].isupper() for w in r.loc.split())
        names = r.who.split(", ") if r.who else []
        assert len(names) == len(set(names)) <= L.MAX_PARTICIPANTS
        assert all(n in r.s and len(n.split()) >= 2 for n in names)


def test_sentence_fields_by_hand(spark):
    expected = [
        # text, title, location, participants
        ("Otto Bismarck led the German Empire, after a coup", "Otto Bismarck led the German Empire", None,
         "Otto Bismarck, German Empire"),
        ("a treaty was signed in New York by nobody", "a treaty was signed in New York by nobody", "New York", "New York"),
        ("unrest began in March and ended at Verdun", "unrest began in March and ended at Verdun", "Verdun", None),
        ("Vienna was taken", "Vienna was taken", "Vienna", None),
        ("a very long line of words that goes on and on until it is cut", "a very long line of words that goes on and on...",
         None, None),
    ]
    df = spark.createDataFrame([(e[0],) for e in expected], "s string")
    got = df.select("s", T.event_title("s"), T.extract_location("s"), T.extract_participants("s")).collect()
    assert [tuple(r) for r in got] == expected


def test_news_fields_by_hand(spark):
    expected = [
        # title, content, location, people
        ("Angela Merkel meets Emmanuel Macron", "talks in Berlin", "Berlin",
         "Angela Merkel, Emmanuel Macron"),
        ("Report", "the Peru government fell in June", "Peru", None),
        ("White House and World Bank", "said nothing", None, None),
        ("Storm", "the harbour in Porto closed", "Porto", None),
    ]
    df = spark.createDataFrame([e[:2] for e in expected], "t string, c string")
    got = df.select("t", "c", T.news_location("t", "c"), T.news_participants("t", "c")).collect()
    assert [tuple(r)[3] for r in got] == [e[3] for e in expected]
    assert [got[0][2], got[3][2]] == ["Berlin", "Porto"] and got[2][2] is None
    # a known place wins over a later pattern, in the order of the list
    for place in L.NEWS_KNOWN_LOCATIONS:
        row = spark.range(1).select(T.news_location(F.lit("Report"), F.lit(f"x {place.lower()} y"))).first()
        assert row[0] in L.NEWS_KNOWN_LOCATIONS[:L.NEWS_KNOWN_LOCATIONS.index(place) + 1]
        break


def test_unicode_whitespace_and_words(spark):
    expected = [
        ("a b c　d\x1ce", "a b c d e", None),
        ("Straße—Ärger “x” 1871 ² ½ naïve", "StraßeÄrger x 1871 ² ½ naïve", 1871),
        (" line  end\t", "line end", None),
        ("x1999 1999y 1999 2026 1871", "x1999 1999y 1999 2026 1871", 1999),
        ("", "", None),
    ]
    df = spark.createDataFrame([(e[0],) for e in expected], "t string")
    assert [tuple(r) for r in df.select("t", T.clean_text("t"), T.first_year("t")).collect()] == expected

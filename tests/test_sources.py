"""Landed payload readers and file sinks on small hand-written payloads."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from histevents.plans import store as K
from histevents.sources import economic, news, wiki
from histevents.sources.fixtures import fixture
from tests.conftest import SF_SMALL


def _write_lines(path, docs):
    with open(path, "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_page_responses_drop_missing(spark, tmp_dir):
    p = os.path.join(tmp_dir, "pages.jsonl")
    _write_lines(p, [
        {"query": {"pages": {"12": {"title": "1871", "extract": "== War ==\nA treaty was signed in Paris today.",
                                     "fullurl": "https://en.wikipedia.org/wiki/1871"}}}},
        {"query": {"pages": {"-1": {"title": "AD_1871"}}}},
    ])
    pages = wiki.read_page_responses(spark, p)
    rows = pages.collect()
    assert [(r.page_id, r.title) for r in rows] == [("12", "1871")]
    ev = wiki.year_page_events(spark, pages, 1870, 1872).collect()
    assert [(e.year, e.category, e.title) for e in ev] == [(1871, "political", "A treaty was signed in Paris today.")]
    assert ev[0].location == "Paris"


def test_indicator_pages(spark, tmp_dir):
    p = os.path.join(tmp_dir, "wb.jsonl")
    recs = [{"country": {"id": "US"}, "indicator": {"id": "NY.GDP.MKTP.CD"}, "date": str(y), "value": v}
            for y, v in [(2007, 100.0), (2008, 97.0), (2009, None)]]
    _write_lines(p, [[{"page": 1}, recs], {"message": "error"}])
    rows = economic.read_indicator_pages(spark, p).orderBy("year").collect()
    assert [(r.country, r.year, r.value) for r in rows] == [("US", 2007, 100.0), ("US", 2008, 97.0), ("US", 2009, None)]
    ev = economic.collect_economic_events(spark, economic.read_indicator_pages(spark, p), None, 2008, 2009).collect()
    titles = sorted(e.title for e in ev)
    assert "Economic recession in US" in titles and "Global Financial Crisis" in titles


def test_market_payload(spark):
    payload = json.dumps({"2008-09-30": {"4. close": "100.0"}, "2008-10-31": {"4. close": "80"},
                          "2008-11-28": {"4. close": "bad"}})
    df = spark.createDataFrame([("SPX", payload)], "symbol string, payload string")
    pts = economic.explode_market_payload(df)
    assert pts.filter(F.col("close").isNull()).count() == 1
    ev = economic.market_events(pts, 2008, 2008).collect()
    assert [(e.year, e.title) for e in ev] == [(2008, "Stock market crash - SPX")]
    # gate: a range ending before 1999 yields nothing
    assert economic.market_events(pts, 1990, 1998).count() == 0


def test_articles_reader(spark, tmp_dir):
    p = os.path.join(tmp_dir, "news.jsonl")
    _write_lines(p, [{"articles": [
        {"title": "Recession hits Germany", "description": "A major recession", "content": None,
         "url": "https://n.example/1", "publishedAt": "2023-03-01T10:00:00Z", "source": {"name": "Wire"}},
        {"title": "", "description": "no title", "content": "x", "url": "https://n.example/2",
         "publishedAt": "2023-03-01T10:00:00Z", "source": None}]}])
    arts = news.read_articles(spark, p)
    assert arts.count() == 2
    ev = news.collect_news_events(spark, arts, 2020, 2023, dt.date(2023, 12, 31)).collect()
    assert {(e.title, e.category, e.location, e.severity) for e in ev} == {
        ("Recession hits Germany", "economic", "Germany", 4)}


def test_news_window_empty(spark):
    arts = fixture(spark, SF_SMALL, "news_articles")
    assert news.collect_news_events(spark, arts, 1990, 1994, dt.date(2025, 12, 31), window_years=5).count() == 0


def test_sinks(spark, tmp_dir):
    ev = fixture(spark, SF_SMALL, "raw_events").limit(20)
    raw = os.path.join(tmp_dir, "raw")
    K.save_raw_json(ev, raw)
    assert {d for d in os.listdir(raw) if d.startswith("source=")}
    rep = os.path.join(tmp_dir, "report")
    K.write_report(ev.agg(F.count(F.lit(1)).alias("n"), F.collect_list("id").alias("ids")), rep)
    assert spark.read.json(rep).first().n == 20
    out = os.path.join(tmp_dir, "export")
    K.export(ev.select("id", "year", "title"), out, "csv")
    assert spark.read.option("header", True).csv(out).count() == 20


def test_json_lists_are_read_element_by_element(spark, tmp_path):
    """Lists over many splits, brackets and quotes in strings, values that are no
    objects, and every way a list can be broken, against the json module."""
    import json
    import os
    from histevents.sources import files

    big = [{"year": i, "title": f'a "quoted}}" \\ {{ [ ] é{i}', "tags": ["x}", {"y": ["]"]}], "n": None} for i in range(300)]
    texts = {
        "big": json.dumps(big), "indent": json.dumps(big, indent=2, ensure_ascii=False), "one": json.dumps(big[0]), "empty": "[]",
        "blank": " [ \n ] \n", "zero": "", "mixed": '[1,"a}",{"a":1},null,[{"b":2}],{"c":{}} , 5 ]\n', "comma": '[{"a":1},]',
        "cut": json.dumps(big)[:-30], "two": "[{}],[{}]", "after": "[{}] , {}", "hole": "[{},,{}]", "object": '{"a":1}\n',
        "scalars": "[1,2,3]", "bad": "nonsense", "escapes": '[{"a":"x\\\\"},{"b":"\\"}"}]', "open": '{"a":1', "white": "  \n "}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    sizes = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        pieces = files._pieces(spark, str(tmp_path / "big"))
        assert pieces.select("split").distinct().count() > 10  # several tasks read the file
        rows = files.read_event_file(spark, str(tmp_path)).selectExpr("file", "event_index", "to_json(v) as v").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {}
    for r in rows:
        got.setdefault(os.path.basename(r.file), []).append((r.event_index, None if r.v is None else json.loads(r.v)))
    for name, text in texts.items():
        try:
            value = json.loads(text)
            expected = list(enumerate(value)) if isinstance(value, list) else [(0, value)]
        except ValueError:
            expected = [(0, None)] if text else []  # an empty file of a folder is a part without rows
        assert sorted(got.get(name, []), key=lambda x: x[0]) == expected, name
    assert [tuple(r) for r in files.read_event_file(spark, str(tmp_path / "zero")).select("event_index", "v").collect()] == [(0, None)]

"""Operators: dedupe, near duplicates, validation, statistics, detectors,
cycles.  Properties from SURVEY §5: prefix join == direct join, dedupe is
idempotent and partition-count invariant, empty input gives no division
error."""

import math
import random
from decimal import ROUND_HALF_EVEN, Decimal

import duckdb
from pyspark.sql import functions as F

from histevents.functions import scalars as S
from histevents.functions import text as T
from histevents.operators import cycles, dedupe, detect, stats, validate
from histevents.plans import registry as E
from histevents.plans.catalog import raw_events
from tests.conftest import SF_SMALL, one


def _pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_prefix_join_equals_direct(spark):
    ev = raw_events(spark, SF_SMALL)
    fast = dedupe.near_duplicate_pairs(ev)
    direct = dedupe.near_duplicate_pairs_direct(ev)
    a, b = _pairs(fast), _pairs(direct)
    assert a == b and len(a) > 0
    assert one(dedupe.near_duplicate_count(ev)).duplicate_count == len(b)


def test_block_split_expansion(spark):
    ev = raw_events(spark, SF_SMALL)
    small_blocks = _pairs(dedupe.near_duplicate_pairs(ev, block=7))
    assert small_blocks == _pairs(dedupe.near_duplicate_pairs_direct(ev))


def test_links_of_long_texts_equal_direct(spark):
    """Blocks of a few classes, copies, repeated and null ids, groups and texts:
    every row's links are those of the direct comparison."""
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdeéñ中𝄞", k=rnd.randint(1, 7))) for _ in range(60)]
    rows = [(None, "word one", "s"), (1, None, "s"), (2, "", "s"), (3, " .-", "t"), (4, "same words", None), (4, "same words", None)]
    for i in range(120):
        text = rnd.sample(words, rnd.randint(1, 25))
        rows += [(i, " ".join(text), rnd.choice("st")), (i % 50, " ".join(text + rnd.sample(words, 1)).upper(), rnd.choice("st"))]
    ev = spark.createDataFrame(rows, "id int, title string, year string")
    sets = [frozenset(t for t in r.t or ()) for r in ev.select(T.trigrams("title").alias("t")).collect()]
    want = []
    for (i, _, g), t in zip(rows, sets):
        near = [(j, u) for (j, _, h), u in zip(rows, sets) if t and g == h and g is not None and 5 * len(t & u) > 4 * len(t | u)]
        same = [j for j, u in near if u == t and j is not None]
        want.append((i, (min(same) if same else None) if near else i, max(len(near) - 1, 0)))
    assert sum(n for _, _, n in want) > 50
    for block in (7, 8192):
        assert sorted(_pairs_key(r) for r in dedupe.near_duplicate_links(ev, block=block).collect()) == sorted(map(_pairs_key, want))


def _pairs_key(row):
    return tuple(-1 if x is None else x for x in row)


def _odd_texts(rnd):
    """Rows (id, text, group): copies, near copies and others, some ids repeated or
    null, some texts and groups null or empty."""
    words = ["".join(rnd.choices("abcdeéñ中𝄞", k=rnd.randint(1, 7))) for _ in range(60)]
    rows = [(None, "word one", "s"), (1, None, "s"), (2, "", "s"), (3, " .-", "t"), (4, "same words", None), (5, "same words", None)]
    for i in range(10, 70):
        text = rnd.sample(words, rnd.randint(1, 25))
        rows += [(i, " ".join(text), rnd.choice("st")), (1000 + i % 50, " ".join(text + rnd.sample(words, 1)).upper(), rnd.choice("st"))]
    rows += [(rnd.choice([None, *range(200, 230)]), " ".join(words[:20]), "s") for _ in range(40)]
    return rows + [(300 + i, " ".join(words[:20] + words[30 + i:31 + i]), "s") for i in range(5)]


def _pairs_by_hand(rows, sets):
    return sorted((i, j) for (i, _, g), t in zip(rows, sets) for (j, _, h), u in zip(rows, sets)
                  if None not in (i, j, g) and i < j and g == h and 5 * len(t & u) > 4 * len(t | u))


def test_pairs_of_long_texts_equal_direct(spark):
    """Small blocks, a class dealt to several rows, copies, repeated and null ids:
    every pair as often as the direct comparison finds it; ids of another type."""
    rows = _odd_texts(random.Random(6))
    ev = spark.createDataFrame(rows, "id long, title string, year string")
    sets = [frozenset(r.t or ()) for r in ev.select(T.trigrams("title").alias("t")).collect()]
    want = _pairs_by_hand(rows, sets)
    assert len(want) > 500 and len(set(want)) < len(want)
    assert _pairs(dedupe.near_duplicate_text_pairs(ev)) == want
    assert _pairs(dedupe.near_duplicate_text_pairs(ev, block=7, unit=3)) == want
    named = dedupe.near_duplicate_text_pairs(ev.withColumn("id", F.concat(F.lit("n"), "id")), unit=5)
    assert _pairs(named) == _pairs_by_hand([(i if i is None else f"n{i}", x, g) for i, x, g in rows], sets)


def test_document_near_duplicates_lists_pairs(spark, tmp_dir):
    """The query names which documents are alike, not only how many: every pair of
    one source, copies and near copies."""
    rows = _odd_texts(random.Random(7))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    sets = [frozenset(r.t or ()) for r in docs.select(T.trigrams("text").alias("t")).collect()]
    found = E.queries()["document_near_duplicates"](spark, tmp_dir)
    assert found.columns == ["id", "duplicate_id"]
    assert _pairs(found) == _pairs_by_hand(rows, sets)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    assert _pairs(found) == sorted(con.execute(E.oracle_sql()["document_near_duplicates"]).fetchall())


def test_prefix_join_random_titles(spark):
    rnd = random.Random(3)
    words = ["war", "treaty", "crisis", "market", "crash", "new", "york", "peace", "deal", "signed"]
    rows = []
    for i in range(400):
        t = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5)))
        if rnd.random() < 0.3:
            t = t + rnd.choice(["s", ".", "!", " x"])
        rows.append((i, rnd.randint(1, 4), t))
    ev = spark.createDataFrame(rows, "id long, year int, title string")
    direct = _pairs(dedupe.near_duplicate_pairs_direct(ev))
    assert _pairs(dedupe.near_duplicate_pairs(ev)) == direct
    assert _pairs(dedupe.near_duplicate_pairs(ev, block=3)) == direct  # many blocks on both paths
    ids_by_title = {}
    for i, _, t in rows:
        ids_by_title.setdefault(t, []).append(i)
    assert any(len(v) > 3 for v in ids_by_title.values())


def test_first_wins_dedupe(spark):
    ev = dedupe.with_event_hash(raw_events(spark, SF_SMALL)).withColumn("seq", F.col("id"))
    d1 = dedupe.first_wins_dedupe(ev, "event_hash", ["seq"])
    ids = {r.id for r in d1.collect()}
    # the kept row is the smallest id per hash
    exp = {r[1] for r in ev.groupBy("event_hash").agg(F.min("id")).collect()}
    assert ids == exp
    # idempotent and independent of partitioning
    d2 = dedupe.first_wins_dedupe(d1, "event_hash", ["seq"])
    d3 = dedupe.first_wins_dedupe(ev.repartition(7), "event_hash", ["seq"])
    assert {r.id for r in d2.collect()} == ids == {r.id for r in d3.collect()}


def test_anti_join_store(spark):
    ev = dedupe.with_event_hash(raw_events(spark, SF_SMALL))
    assert dedupe.anti_join_store(ev, ev).count() == 0


def test_validation_errors_order(spark):
    rows = [(1, 0, "ab", "sports", "src", 7, "not a url", "2020-02-30"),
            (2, 2000, "Fine title", "economic", "src", 3, "https://a.org/x", "1999-05-04T10:00:00Z"),
            (3, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, year int, title string, category string, source string, "
                                     "severity int, source_url string, date string")
    got = {r.id: r.errors for r in validate.with_validation(df).collect()}
    assert got[1] == ["Year 0 outside valid range (1, 2025)", "Title length 2 outside valid range 3-500",
                      "Invalid category: sports", "Invalid severity level: 7", "Invalid URL format",
                      "Invalid date format"]
    assert got[2] == []
    assert got[3] == ["Missing required field: year", "Missing required field: title",
                      "Missing required field: category", "Missing required field: source"]


def test_collector_rule(spark):
    rows = [(2000, "Title", "economic"), (0, "Title", "economic"), (2000, "", "economic"),
            (2000, "Title", "sports"), (None, "Title", "economic"), (2026, "Title", "social")]
    df = spark.createDataFrame(rows, "year int, title string, category string")
    assert [r[0] for r in df.select(validate.collector_valid(df)).collect()] == [True] + [False] * 5


def test_batch_summary_and_empty(spark):
    ev = validate.with_validation(raw_events(spark, SF_SMALL))
    s = one(validate.batch_summary(ev))
    assert s.total_events == s.valid_events + s.invalid_events and s.status == "fail"
    empty = one(validate.batch_summary(ev.filter(F.lit(False))))
    assert empty.total_events == 0 and empty.validation_rate == 0.0 and empty.status == "fail"


def test_stats_empty_input(spark):
    ev = raw_events(spark, SF_SMALL).filter(F.lit(False))
    c = one(stats.completeness(spark, ev))
    assert c.total_events == 0 and c.digital_root_variance == 0.0 and c.category_balance == 0.0
    assert one(stats.root_accuracy(ev.withColumn("digital_root", S.digital_root("year")))).accuracy_rate == 100.0
    v = one(stats.verification_stats(ev))
    assert v.verification_rate == 0.0


def test_quality_score_formula(spark):
    ev = raw_events(spark, SF_SMALL)
    rows = ev.collect()
    n = len(rows)
    ver = sum(1 for r in rows if r.verified)
    years = {r.year for r in rows}
    roots = {}
    for r in rows:
        y = r.year
        rt = y if y <= 9 else 1 + (y - 1) % 9
        roots[rt] = roots.get(rt, 0) + 1
    cats = {}
    for r in rows:
        cats[r.category] = cats.get(r.category, 0) + 1
    dev = sum(abs(roots.get(i, 0) - n / 9) for i in range(1, 10)) / n
    bal = 1.0 - (len(set(cats.values())) - 1) / len(cats)
    score = (ver / n * 100) / 100 * 40 + min(len(years) / 2025 * 100 / 100, 1.0) * 30 + bal * 15 + max(0, 1.0 - dev) * 15
    c = one(stats.completeness(spark, ev))
    assert abs(c.quality_score_raw - score) < 1e-9
    assert c.data_quality_score == round(score, 2)


def test_category_average_rounding(spark):
    rows = [("a", 2), ("a", 2), ("a", 2), ("a", 2), ("a", 2), ("a", 2), ("a", 3), ("a", 2)]  # 17/8 = 2.125
    df = spark.createDataFrame(rows, "category string, severity int")
    got = one(stats.category_breakdown(df)).avg_severity
    assert got == float(Decimal(17 / 8).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN)) == 2.12


def test_yoy_detector(spark):
    rows = [("X", "NY.GDP.MKTP.CD", y, v) for y, v in
            [(2000, 100.0), (2001, 97.0), (2002, None), (2003, 50.0), (2004, 0.0), (2005, 10.0)]]
    df = spark.createDataFrame(rows, "country string, indicator string, year int, value double")
    ch = {r.year: r.change_pct for r in detect.yoy_changes(df).collect()}
    assert ch[2000] is None and abs(ch[2001] + 3.0) < 1e-12
    assert all(ch[y] is None for y in (2002, 2003, 2005)) and ch[2004] == -100.0
    ev = detect.detect_indicator_events(df).collect()
    assert [(e.year, e.title, e.description) for e in ev] == [
        (2001, "Economic recession in X", "GDP declined by 3.0% in X, indicating economic recession.")]


def test_level_detectors_need_previous(spark):
    rows = [("Y", "FP.CPI.TOTL.ZG", 2000, 12.0), ("Y", "FP.CPI.TOTL.ZG", 2001, 11.0),
            ("Z", "SL.UEM.TOTL.ZS", 2000, 0.0), ("Z", "SL.UEM.TOTL.ZS", 2001, 9.0)]
    df = spark.createDataFrame(rows, "country string, indicator string, year int, value double")
    ev = sorted((e.country, e.year, e.subcategory, round(e.impact_score, 6)) for e in
                detect.detect_indicator_events(df).collect())
    # first record has no predecessor; Z 2001 follows a zero -> not analysed
    assert ev == [("Y", 2001, "inflation", round(11.0 / 20, 6))]


def test_market_crash(spark):
    rows = [("S", "2008-09-01", 100.0), ("S", "2008-10-01", 80.0), ("S", "2008-11-01", 79.0),
            ("T", "2008-01-01", 0.0), ("T", "2008-02-01", 5.0)]
    df = spark.createDataFrame(rows, "symbol string, date string, close double")
    ev = detect.detect_market_crashes(detect.monthly_points(df, 2000, 2010)).collect()
    assert [(e.year, e.title, e.description) for e in ev] == [
        (2008, "Stock market crash - S", "Stock index S declined by 20.0% in 2008-10.")]


def test_cycle_patterns(spark):
    ev = raw_events(spark, SF_SMALL)
    c = cycles.cycle_patterns(ev).collect()
    by_cat = {}
    for r in c:
        by_cat.setdefault(r.category, []).append(r)
    for cat, rs in by_cat.items():
        total = sum(r.event_count for r in rs)
        assert abs(sum(r.pattern_strength for r in rs) - 9.0 * len(rs) * 0 - 9.0) < 1e-9
        e = total / 9
        counts = {r.digital_root: r.event_count for r in rs}
        chi = sum((counts.get(i, 0) - e) ** 2 / e for i in range(1, 10))
        h = chi / 2  # the tail of 8 degrees of freedom, corrected for the categories tested
        tail = min(1.0, math.exp(-h) * (1 + h + h ** 2 / 2 + h ** 3 / 6) * len(by_cat))
        assert all(math.isclose(r.statistical_significance, tail, rel_tol=1e-9) for r in rs)


def test_lag_along_ranges_equals_the_window(spark):
    """Long series over several ranges, short ones inside of one, null keys and
    values, ties: the same as one window a series."""
    import random
    from pyspark.sql import Window
    from histevents.operators.detect import lag_along
    rng = random.Random(3)
    rows = [("long", i, rng.choice([None, 0.0, 1.5, 2.5])) for i in range(3000)]
    rows += [(k, i // 2, float(i)) for k in ("a", "b", None, "zz") for i in range(7)] + [("one", None, None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "symbol string, at int, close double")
    w = Window.partitionBy("symbol").orderBy("at", "close")
    expected = sorted(map(str, df.withColumn("prev", F.lag("close").over(w)).collect()))
    assert sorted(map(str, lag_along(df, ["symbol"], ["at", "close"], "close", "prev").collect())) == expected
    # one series lies in several ranges, none of which holds it all
    ranges = df.where("symbol = 'long'").repartitionByRange(8, "symbol", "at", "close").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) > 3 and max(r["count"] for r in ranges) < 1500
    assert lag_along(df.limit(0), ["symbol"], ["at"], "close", "prev").count() == 0


def test_chi_square_tail(spark):
    from histevents.operators.cycles import chi_square_tail_8
    x = [0.0, 7.344, 15.507, 20.090, 26.124]  # table values: 1, 0.5, 0.05, 0.01, 0.001
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(chi_square_tail_8(F.col("x"))).collect()]
    assert [round(g, 3) for g in got] == [1.0, 0.5, 0.05, 0.01, 0.001]

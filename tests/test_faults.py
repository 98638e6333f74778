"""What must hold when data or runs go wrong: emptied partitions, repeated
updates, failing reads and sources, ties, nulls, hot keys."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from histevents.operators import dedupe, detect, stats
from histevents.plans import pipeline
from histevents.plans.catalog_pipelines import _landed
from histevents.plans.store import EventStore
from histevents.session import ensure_checkpoint_dir
from histevents.sources import files, news
from histevents.streaming import refresh
from tests.conftest import SF_SMALL, one


def _events(spark, years, title="Some title"):
    return spark.createDataFrame([(y, f"{title} {i}", "economic", "test") for i, y in enumerate(years)],
                                 "year int, title string, category string, source string")


@pytest.mark.parametrize("buckets", [None, 4])
def test_delete_empties_a_century(spark, tmp_dir, buckets):
    st = EventStore(spark, os.path.join(tmp_dir, "s"), buckets=buckets, table=f"faults_delete_{buckets}")
    st.save_events(_events(spark, [1850, 1950, 1951]))
    assert st.delete_ids(st.events().filter("year in (1850, 1950)").select("id")) == 2
    assert [r.year for r in st.events().collect()] == [1951]
    assert st.delete_ids(st.events().select("id")) == 1
    assert st.events().count() == 0
    assert not [d for d in os.listdir(tmp_dir + "/s") if d.startswith("_staging")]
    assert st.save_events(_events(spark, [1850]))[0] == 1 and st.events().count() == 1


def test_repeated_updates(spark, tmp_dir):
    st = EventStore(spark, os.path.join(tmp_dir, "s"))
    st.save_events(_events(spark, [1850, 1950]))
    ids = st.events().filter("year = 1850").select("id", F.lit(True).alias("verified"))
    again = ids.unionByName(ids).unionByName(ids.withColumn("verified", F.lit(False)))
    assert st.update_verification(again) == 1
    assert sorted((r.year, r.verified) for r in st.events().collect()) == [(1850, True), (1950, False)]


def test_unreadable_target_is_no_empty_target(spark, tmp_dir):
    st = EventStore(spark, os.path.join(tmp_dir, "s"))
    st.save_events(_events(spark, [1850]))
    for d, _, names in os.walk(st.path("historical_events")):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(d, n), "wb") as f:
                    f.write(b"not parquet")
                if os.path.exists(crc := os.path.join(d, f".{n}.crc")):
                    os.remove(crc)
    with pytest.raises(Exception):
        st.save_events(_events(spark, [1850]))
    # the same for an epoch of the stream
    target = os.path.join(tmp_dir, "t")
    os.makedirs(target)
    with open(os.path.join(target, "part-0.parquet"), "wb") as f:
        f.write(b"not parquet")
    batch = _events(spark, [1850]).withColumn("seq", F.lit(1))
    with pytest.raises(Exception):
        refresh._append_new(target, "seq")(batch, 0)


def test_replayed_epoch_appends_nothing(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    batch = _events(spark, [1850, 1950]).withColumn("seq", F.lit(1))
    for epoch in (0, 0, 1):
        refresh._append_new(target, "seq")(batch, epoch)
    assert spark.read.parquet(target).count() == 2


def test_large_century_is_split(spark, tmp_dir):
    """An append deals one century over several files."""
    st = EventStore(spark, os.path.join(tmp_dir, "s"))
    n = 60_000
    rows = spark.range(n, numPartitions=8).select(
        F.lit(1950).alias("year"), F.concat(F.lit("Title "), F.sha2(F.col("id").cast("string"), 512)).alias("title"),
        F.lit("economic").alias("category"), F.lit("test").alias("source"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        st.save_events(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    written = [f for d, _, fs in os.walk(st.path("historical_events")) for f in fs if f.endswith(".parquet")]
    assert len(written) > 2 and st.events().count() == n


def test_source_that_fails_while_it_runs(spark):
    landed = _landed(spark, SF_SMALL)
    landed.indicators = landed.indicators.withColumn(
        "value", F.when(F.col("year") > 0, F.raise_error(F.lit("broken record"))).otherwise(F.col("value")))
    ev, summary = pipeline.run_collection(spark, landed, 1000, 2025, as_of_date=dt.date(2001, 12, 31))
    rows = {(r.collector, r.level): r for r in summary.collect()}
    assert "broken record" in rows[("economic", "source")].error_message
    assert rows[("wikipedia", "source")].events_collected > 0 and ev.filter("collector = 'economic'").isEmpty()


def test_saved_is_what_was_appended(spark, tmp_dir):
    st = EventStore(spark, os.path.join(tmp_dir, "s"))
    raw = os.path.join(tmp_dir, "raw")
    for run, expected in ((1, None), (2, 0)):
        _, summary = pipeline.run_collection(spark, _landed(spark, SF_SMALL), 1000, 2025, store=st, raw_path=raw,
                                             as_of_date=dt.date(2001, 12, 31))
        total = one(summary.filter("level = 'total'"))
        assert total.events_saved == (st.events().count() if expected is None else expected)
    assert {d for d in os.listdir(raw) if d.startswith("source=")}


def test_full_preset(spark):
    _, summary = pipeline.collect_historical(spark, _landed(spark, SF_SMALL), as_of_date=dt.date(2001, 12, 31))
    assert one(summary.filter("level = 'total'")).events_collected > 0


def test_ties_dont_depend_on_row_order(spark):
    rows = [("US", "NY.GDP.MKTP.CD", y, float(v)) for y, v in ((2000, 100), (2000, 90), (2001, 95), (2001, 80), (2002, 70))]
    schema = "country string, indicator string, year int, value double"
    results = [sorted(map(str, detect.detect_indicator_events(spark.createDataFrame(rows[::d], schema).coalesce(1))
                          .select("year", "value", "prev").collect())) for d in (1, -1)]
    assert results[0] == results[1]
    points = [("X", "2000-01-31", 100.0), ("X", "2000-02-28", 50.0), ("X", "2000-02-28", 90.0)]
    schema = "symbol string, date string, close double"
    results = [sorted(map(str, detect.detect_market_crashes(detect.monthly_points(
        spark.createDataFrame(points[::d], schema).coalesce(1))).select("close", "prev_close").collect())) for d in (1, -1)]
    assert results[0] == results[1]


def test_null_category_is_counted(spark):
    df = spark.createDataFrame([(1, 1900, None, False), (2, 1900, "x", True)],
                               "id bigint, year int, category string, verified boolean")
    s = one(stats.collection_stats(df))
    assert [(r.category, r["count"]) for r in s.category_distribution] == [(None, 1), ("x", 1)]


def test_json_numbers_and_empty_lists(spark, tmp_dir):
    path = os.path.join(tmp_dir, "e.json")
    base = {"title": "A fine title", "category": "economic", "source": "t"}
    with open(path, "w") as f:
        json.dump([{**base, "year": 99999999999}, {**base, "year": 2000, "severity": 99999999999},
                   {**base, "year": 2000, "digital_root": 9.5}, {**base, "year": 2000, "digital_root": 99999999999},
                   {**base, "year": 2000, "digital_root": 2}], f)
    summary, errors = files.validate_event_file(spark, path)
    assert one(summary).valid_events == 1
    assert [r.errors for r in errors.orderBy("event_index").collect()] == [
        ["Year 99999999999 outside valid range (1, 2025)"], ["Invalid severity level: 99999999999"],
        ["Digital root 9.5 outside valid range 1-9"], ["Digital root 99999999999 outside valid range 1-9"]]
    empty = os.path.join(tmp_dir, "empty.json")
    with open(empty, "w") as f:
        f.write("[]")
    assert one(files.validate_event_file(spark, empty)[0]).total_events == 0


def test_search_window():
    day = dt.date(2026, 3, 15)
    assert news.search_window(2024, 2026, day) == (2024, "2024-01-01", "2026-02-13")
    assert news.search_window(1990, 1995, day) == (1990, "1990-01-01", "1995-12-31")
    assert news.search_window(1990, 1995, day, window_years=5) is None


def test_top_hits_in_slices(spark):
    hits = spark.range(5000).select((F.col("id") % 3).alias("keyword_idx"), F.col("id").alias("article_id"),
                                    (F.xxhash64("id") % 50).alias("relevance"), F.lit("text").alias("text"))
    got = news.top_hits(hits, "article_id", 50)
    rows = hits.collect()
    for k in range(3):
        best = sorted((r for r in rows if r.keyword_idx == k), key=lambda r: (-r.relevance, r.article_id))[:50]
        mine = got.filter(F.col("keyword_idx") == k).orderBy("hit_rank").collect()
        assert [r.article_id for r in mine] == [r.article_id for r in best]
        assert [r.hit_rank for r in mine] == list(range(1, 51))


def test_hot_title_stays_block_by_block(spark):
    """The join that expands 3,000 equal titles has no key with more than a block a side."""
    ev = spark.range(3000).select("id", F.lit("One hot title").alias("title"), F.lit(1900).alias("year"))
    members, sigs = dedupe._signatures(ev, "id", "title", "year")
    m = dedupe._blocked_members(members, sigs, 200)
    pairs = dedupe._pairs_inside_groups(members, sigs, 200)
    assert pairs.count() == 3000 * 2999 // 2
    joined = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count("_bi") and joined.count("_bj")
    left = m.select("_blk", F.explode(F.sequence("_blk", F.col("_nb") - 1)).alias("_bj")).groupBy("_blk", "_bj").count()
    right = m.select("_blk", F.explode(F.sequence(F.lit(0), "_blk")).alias("_bi")).groupBy("_bi", "_blk").count()
    assert left.agg(F.max("count")).first()[0] < 300 and right.agg(F.max("count")).first()[0] < 300


def test_shared_folder_is_asked_for_on_a_cluster():
    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


@pytest.mark.parametrize("buckets", [None, 4])
@pytest.mark.parametrize("write", ["save", "delete", "update"])
def test_rewrite_is_finished_by_the_next_write(spark, tmp_dir, monkeypatch, buckets, write):
    """A delete that fails between its overwrites is finished by the next call
    that writes, and no staging folder is left."""
    st = EventStore(spark, os.path.join(tmp_dir, "s"), buckets=buckets, table=f"faults_recover_{buckets}_{write}")
    st.save_events(_events(spark, [1850, 1950, 1951, 2020]))
    replace = EventStore._replace

    def failing(self, of, rows):
        if rows is None:
            raise RuntimeError("lost")
        replace(self, of, rows)

    with monkeypatch.context() as m:
        m.setattr(EventStore, "_replace", failing)
        with pytest.raises(RuntimeError):
            st.delete_ids(st.events().filter("year in (1850, 1950)").select("id"))
    assert [d for d in os.listdir(tmp_dir + "/s") if d.startswith("_staging")]
    again = EventStore(spark, st.base, buckets=buckets, table=st.table)
    # ids by value: a lazy read of the table would still name the files of before the recovery
    last = spark.createDataFrame([(r.id, True) for r in again.events().filter("year = 2020").collect()], "id bigint, verified boolean")
    if write == "save":
        assert again.save_events(_events(spark, [1850, 1999]))[0] == 2
        left = [1850, 1951, 1999, 2020]
    elif write == "delete":
        assert again.delete_ids(last) == 1
        left = [1951]
    else:
        assert again.update_verification(last) == 1
        left = [1951, 2020]
    assert sorted(r.year for r in again.events().collect()) == left
    assert not [d for d in os.listdir(tmp_dir + "/s") if d.startswith("_staging")]


def test_rewrite_that_never_began_changes_nothing(spark, tmp_dir, monkeypatch):
    st = EventStore(spark, os.path.join(tmp_dir, "s"))
    st.save_events(_events(spark, [1850, 1950]))
    monkeypatch.setattr(EventStore, "_finish", lambda self, folder: None)
    st.delete_ids(st.events().filter("year = 1850").select("id"))
    (folder,) = [d for d in os.listdir(tmp_dir + "/s") if d.startswith("_staging")]
    os.remove(os.path.join(tmp_dir, "s", folder, "journal", "_SUCCESS"))  # the journal wasn't whole yet
    monkeypatch.undo()
    st.recover()
    assert st.events().count() == 2 and not [d for d in os.listdir(tmp_dir + "/s") if d.startswith("_staging")]


def test_rejected_rows_are_kept_once(spark, tmp_dir):
    """Saves, replays and batches with further columns add no rejected row again."""
    st = EventStore(spark, os.path.join(tmp_dir, "s"))
    bad = spark.createDataFrame([(None, "No year", "economic", "test"), (1900, "x", "economic", "test"), (1900, "x", "economic", "test"),
                                 (None, None, None, None)], "year int, title string, category string, source string")
    for batch in (bad, bad.repartition(3), bad.withColumn("location", F.lit(None).cast("string")), bad.limit(0)):
        st.save_events(batch)
    q = spark.read.parquet(st.path("quarantine"))
    assert sorted(r.occurrences for r in q.collect()) == [1, 1, 2]
    assert st.save_events(bad.withColumn("title", F.lit("y")))[1] == 4
    assert spark.read.parquet(st.path("quarantine")).agg(F.sum("occurrences")).first()[0] == 8


def test_append_scans_the_store_once_behind_a_bloom_filter(spark, tmp_dir):
    st = EventStore(spark, os.path.join(tmp_dir, "s"))
    st.save_events(_events(spark, [1850, 1950, 1951] * 50))
    batch = os.path.join(tmp_dir, "batch")
    st.events().limit(40).write.parquet(batch)
    sizes = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1B",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}  # as for a store and a batch of real size
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        held = st.held_hashes(spark.read.parquet(batch))
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert held.count() == 40
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "century" in ln.split("Batched")[0]]
    assert "might_contain" in plan and len(scans) == 1  # the batch has no century


def test_running_sums_stay_chunk_by_chunk(spark, monkeypatch, tmp_path):
    """No window that numbers a file's elements has the file, or one of its
    splits, as its only key; the numbers go on from chunk to chunk."""
    monkeypatch.setattr(files, "CHUNK_BITS", 2)
    (tmp_path / "list").write_text("[1,{}" + ",{},2" * 40 + "]")
    rows = files.read_event_file(spark, str(tmp_path)).selectExpr("event_index", "to_json(v) as v").collect()
    assert sorted((r.event_index, r.v) for r in rows) == [(0, "1"), (1, "{}")] + [(2 + i, "{}" if i % 2 == 0 else "2") for i in range(80)]
    df = spark.range(20).selectExpr("'f' AS file", "0 AS split", "id AS seq", "id AS n")
    out = files._running(df, "n", "before")
    assert sorted((r.seq, r.before) for r in out.collect()) == [(i, i * (i - 1) // 2) for i in range(20)]
    assert len([w for w in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in w and "_chunk" in w]) == 2


def test_list_is_written_without_a_sort(spark, tmp_path):
    """The only writer of the JSON list holds no rows, and the file is one list."""
    from histevents.plans.catalog_store import _land_list
    for n in (0, 1, 50):
        docs = spark.range(n).selectExpr("id", "to_json(struct(id)) AS doc")
        for whole in (True, False):
            path = str(tmp_path / f"{n}-{whole}")
            _land_list(docs, path, whole)
            found = [p for p in os.listdir(path) if p.startswith("part-")]
            text = "".join(open(os.path.join(path, p)).read() for p in found)
            assert sorted(r["id"] for r in json.loads(text if whole else text + "]")) == list(range(n))
            assert len([p for p in found if os.path.getsize(os.path.join(path, p))]) == 1


def test_shared_trigram_stays_block_by_block(spark):
    """A third of a group shares a rare trigram: the candidate keys stay near
    block x block, and the pairs are those of the direct join."""
    import random
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(12)]
    titles = sorted({" ".join(rng.sample(words, 6)) for _ in range(400)})
    titles = [f"{t} qzx" if i % 3 == 0 else t for i, t in enumerate(titles)]  # rarer than any of the words
    titles += [t + " y" for t in titles[::9]] + [t.upper() for t in titles[::40]]
    ev = spark.createDataFrame([(i, t, 1900) for i, t in enumerate(titles)], "id int, title string, year int")
    _, sigs = dedupe._signatures(ev, "id", "title", "year")
    a, b, key = dedupe._candidate_sides(sigs, 10)
    whole = ["_g", "_tok", "_c"]
    for side in (a, b):
        largest = lambda cols: side.groupBy(*cols).agg(F.countDistinct("sig_a" if side is a else "sig_b").alias("n")).agg(F.max("n")).first()[0]
        assert largest(whole) > 60 and largest(key) <= 30
    pairs = sorted((r.id, r.duplicate_id) for r in dedupe.near_duplicate_pairs_direct(ev).collect())
    assert len(pairs) > 20
    for block in (4096, 10):
        assert sorted((r.id, r.duplicate_id) for r in dedupe.near_duplicate_pairs(ev, token_block=block).collect()) == pairs


@pytest.mark.parametrize("buckets", [None, 4])
def test_statistics_are_kept(spark, tmp_dir, monkeypatch, buckets):
    """After appends, updates, deletes and a write that failed, the report from
    the kept counts equals the one of a full scan, and reads no event."""
    st = EventStore(spark, os.path.join(tmp_dir, "s"), buckets=buckets, table=f"faults_statistics_{buckets}")
    rows = _events(spark, [1850, 1851, 1950, 2020]).withColumn("severity", F.col("year") % 4)
    st.save_events(rows.filter("year < 1900"))
    st.create_statistics()

    def same():
        parts, ev = st.statistics(), st.events()
        assert one(stats.completeness_of(parts)) == one(stats.completeness(spark, ev))
        assert one(stats.year_coverage_of(parts)) == one(stats.year_coverage(ev))
        assert stats.category_breakdown_of(parts).collect() == stats.category_breakdown(ev).collect()
        return one(stats.completeness_of(parts)).total_events

    assert "historical_events" not in st.statistics()._jdf.queryExecution().executedPlan().toString()
    assert same() == 2
    st.save_events(rows.unionByName(rows))
    assert same() == 4
    st.update_verification(st.events().filter("year > 1900").select("id", F.lit(True).alias("verified")))
    assert same() == 4
    st.delete_ids(st.events().filter("year in (1850, 1950)").select("id"))
    assert same() == 2
    with monkeypatch.context() as m:  # events written, their counts not
        write = EventStore._write_events

        def failing(self, df):
            write(self, df)
            raise RuntimeError("lost")

        m.setattr(EventStore, "_write_events", failing)
        with pytest.raises(RuntimeError):
            st.save_events(_events(spark, [1700], "Another title").withColumn("severity", F.lit(1)))
    st.recover()
    assert same() == 3
    assert not [d for d in os.listdir(tmp_dir + "/s") if d.startswith("_")]

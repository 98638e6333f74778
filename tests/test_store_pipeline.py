"""Store sinks, collection runs, JSON files, streaming refresh."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from histevents.plans import pipeline
from histevents.plans.catalog_pipelines import _landed
from histevents.plans.store import EventStore
from histevents.sources import files
from histevents.sources.fixtures import fixture
from histevents.streaming.refresh import dedupe_within_watermark, run_refresh_once
from tests.conftest import SF_SMALL, one


def test_store_append_is_idempotent(spark, tmp_dir):
    st = EventStore(spark, os.path.join(tmp_dir, "store"))
    st.create_tables()
    ev = fixture(spark, SF_SMALL, "raw_events").drop("id").withColumn("tags", F.array(F.col("category")))
    saved, errors = st.save_events(ev)
    assert saved > 0 and errors > 0
    stored = st.events()
    assert stored.count() == saved
    assert stored.select("event_hash").distinct().count() == saved
    # rerun appends nothing
    saved2, _ = st.save_events(ev)
    assert saved2 == 0 and st.events().count() == saved
    # quarantined rows carry their messages
    q = spark.read.parquet(st.path("quarantine"))
    assert q.filter(F.size("errors") == 0).count() <= q.count()


def test_store_update_and_delete(spark, tmp_dir):
    st = EventStore(spark, os.path.join(tmp_dir, "store2"))
    ev = fixture(spark, SF_SMALL, "raw_events").drop("id").withColumn("verified", F.lit(False))
    st.save_events(ev)
    ids = st.events().select("id").limit(5)
    n = st.update_verification(ids.withColumn("verified", F.lit(True)))
    assert n == 5 and st.events().filter("verified").count() == 5
    total = st.events().count()
    removed = st.delete_ids(st.events().filter("verified").select("id"))
    assert removed == 5 and st.events().count() == total - 5


def test_store_year_filter_prunes_partitions(spark, tmp_dir):
    from histevents.operators.filters import by_year_range
    st = EventStore(spark, os.path.join(tmp_dir, "store_prune"))
    st.save_events(fixture(spark, SF_SMALL, "raw_events").drop("id"))
    q = by_year_range(st.events(), 1900, 2000).select("id", "year")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(century" in plan and "century" in plan.split("PartitionFilters:")[1][:200]
    assert "ReadSchema: struct<id:bigint,year:int>" in plan  # only the projected columns are read
    years = [r.year for r in q.collect()]
    assert years and all(1900 <= y <= 2000 for y in years)
    assert len(years) == st.events().filter("year between 1900 and 2000").count()
    # an append with a year range reads only those centuries for its duplicate check
    again = fixture(spark, SF_SMALL, "raw_events").drop("id").filter("year between 1900 and 2000")
    assert st.save_events(again, year_range=(1900, 2000))[0] == 0


def test_bucketed_store(spark, tmp_dir):
    st = EventStore(spark, os.path.join(tmp_dir, "store_bucketed"), buckets=4)
    ev = fixture(spark, SF_SMALL, "raw_events").drop("id").withColumn("verified", F.lit(False))
    saved, _ = st.save_events(ev)
    assert saved > 0 and st.events().count() == saved
    assert st.save_events(ev)[0] == 0  # idempotent
    # the duplicate check reads the stored side in place (bucketed, no exchange)
    from histevents.plans.store import to_store_rows
    from histevents.functions.scalars import century
    new = to_store_rows(ev.filter("year > 1000")).withColumn("century", century("year"))
    q = new.join(st.events().select("event_hash"), "event_hash", "left_anti")
    q.write.format("noop").mode("overwrite").save()
    plan = q._jdf.queryExecution().executedPlan().toString()
    stored_scan = [ln for ln in plan.splitlines() if "Bucketed: true" in ln]
    assert stored_scan and "Exchange hashpartitioning(event_hash" not in plan.split(stored_scan[0])[0].splitlines()[-1]
    ids = st.events().select("id").limit(3)
    assert st.update_verification(ids.withColumn("verified", F.lit(True))) == 3
    assert st.events().filter("verified").count() == 3 and st.events().count() == saved
    assert st.delete_ids(st.events().filter("verified").select("id")) == 3
    assert st.events().count() == saved - 3


def test_store_rows_and_logs(spark, tmp_dir):
    from histevents.plans.store import to_store_rows
    df = spark.createDataFrame(
        [(2008, "Global Financial Crisis", "economic", "test", ["economic", "crisis"], {"k": "v"}),
         (2009, "Quiet year", "social", "test", [], {})],
        "year int, title string, category string, source string, tags array<string>, metadata map<string,string>")
    rows = {r.year: r for r in to_store_rows(df).collect()}
    assert rows[2008].tags == '["economic","crisis"]' and rows[2008].collection_metadata == '{"k":"v"}'
    assert rows[2009].tags is None and rows[2009].collection_metadata is None
    assert rows[2008].digital_root == 1 and rows[2008].event_hash == "b0c6b6c8fca81746121ea1cbdb3842dd"
    assert rows[2008].verified is False and rows[2008].id is not None
    st = EventStore(spark, os.path.join(tmp_dir, "store_logs"))
    logs = spark.createDataFrame([("economic", "2000-2001", "success", 12, 0)],
                                 "source string, collection_type string, status string, "
                                 "records_collected long, errors_encountered long") \
        .withColumn("start_time", F.current_timestamp())
    st.log_activity(logs)
    got = spark.read.parquet(st.path("data_collection_logs")).first()
    assert (got.source, got.status, got.records_collected) == ("economic", "success", 12)


def test_sample_preset(spark):
    ev, summary = pipeline.collect_sample(spark, _landed(spark, SF_SMALL), sample_years=10, as_of_date=dt.date(2001, 12, 31))
    assert ev.filter((F.col("year") < 1991) | (F.col("year") > 2001)).filter(F.col("collector") == "economic") \
        .count() == 0
    assert summary.filter(F.col("level") == "total").first().events_collected == ev.count()


def test_run_collection(spark):
    ev, summary = pipeline.run_collection(spark, _landed(spark, SF_SMALL), 1000, 2025, as_of_date=dt.date(2001, 12, 31))
    rows = summary.collect()
    total = [r for r in rows if r.level == "total"][0]
    assert total.events_collected == ev.count() == total.events_saved + total.errors
    # one row per event hash after the global dedupe
    assert ev.select("event_hash").distinct().count() == ev.count()
    per_source = {r.collector: r.events_collected for r in rows if r.level == "source"}
    assert set(per_source) <= {"wikipedia", "economic", "news"} and sum(per_source.values()) == total.events_collected


def test_failed_source_is_isolated(spark):
    landed = _landed(spark, SF_SMALL)
    landed.indicators = landed.indicators.drop("value")  # malformed economic input
    ev, summary = pipeline.run_collection(spark, landed, 1000, 2025, as_of_date=dt.date(2001, 12, 31))
    rows = {(r.collector, r.level): r for r in summary.collect()}
    assert rows[("economic", "source")].errors == 1 and "value" in rows[("economic", "source")].error_message
    assert rows[("wikipedia", "source")].events_collected > 0
    assert ev.filter(F.col("collector") == "economic").count() == 0


def test_recent_preset_only_news_and_economic(spark):
    ev, _ = pipeline.collect_recent(spark, _landed(spark, SF_SMALL), as_of_date=dt.date(2001, 12, 31))
    assert {r.collector for r in ev.select("collector").distinct().collect()} <= {"news", "economic"}


def test_json_file_validation(spark, tmp_dir):
    path = os.path.join(tmp_dir, "events.json")
    with open(path, "w") as f:
        json.dump([{"year": 2008, "title": "Global Financial Crisis", "category": "economic", "source": "t"},
                   {"year": "2008", "title": "x", "category": "economic", "source": "t", "severity": 2.5},
                   {"year": True, "title": "Valid title", "category": "social", "source": "t"},
                   {"title": "No year", "category": "economic", "source": "t"}], f)
    summary, errors = files.validate_event_file(spark, path)
    s = one(summary)
    assert (s.total_events, s.valid_events, s.invalid_events) == (4, 1, 3) and s.status == "fail"
    errs = {r.event_index: r.errors for r in errors.collect()}
    assert errs[1] == ["Year must be an integer", "Title length 1 outside valid range 3-500",
                       "Severity must be an integer"]
    assert errs[2] == ["Year must be an integer"]
    assert errs[3] == ["Missing required field: year"]
    single = os.path.join(tmp_dir, "one.json")
    with open(single, "w") as f:
        json.dump({"year": 1999, "title": "Euro Introduction", "category": "economic", "source": "t"}, f)
    assert one(files.validate_event_file(spark, single)[0]).valid_events == 1
    missing = files.validate_event_file(spark, os.path.join(tmp_dir, "nope.json"))[0]
    assert one(missing).error.startswith("File not found")


def test_json_lines_validation(spark, tmp_dir):
    path = os.path.join(tmp_dir, "events.jsonl")
    with open(path, "w") as f:
        f.write(json.dumps({"year": 2008, "title": "Global Financial Crisis", "category": "economic",
                            "source": "t"}) + "\n")
        f.write(json.dumps({"year": 2008.5, "title": "Half year", "category": "economic", "source": "t"}) + "\n")
        f.write("{not json\n")
    summary, errors = files.validate_event_lines(spark, path)
    s = one(summary)
    assert (s.total_events, s.valid_events, s.invalid_events) == (3, 1, 2)
    msgs = sorted(tuple(r.errors) for r in errors.collect())
    assert msgs == [("Invalid JSON",), ("Year must be an integer",)]


def test_stream_equals_batch(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    stream = (spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet")
              .parquet(SF_SMALL))
    stream.createOrReplaceTempView("orders_stream_test")
    from histevents.sources.fixtures import FIXTURE_SQL
    ev = spark.sql(FIXTURE_SQL["raw_events"].replace("FROM orders", "FROM orders_stream_test"))
    out = run_refresh_once(spark, ev.withColumn("seq", F.col("id")), "seq")
    batch = fixture(spark, SF_SMALL, "raw_events")
    from histevents.operators import dedupe
    exp = dedupe.first_wins_dedupe(dedupe.with_event_hash(batch).withColumn("seq", F.col("id")), "event_hash", ["seq"])
    assert sorted(r.id for r in out.collect()) == sorted(r.id for r in exp.collect())


def test_stream_into_store_matches_batch(spark, tmp_dir):
    from histevents.sources.fixtures import FIXTURE_SQL
    from histevents.streaming.refresh import refresh_store
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    stream = (spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet")
              .parquet(SF_SMALL))
    stream.createOrReplaceTempView("orders_stream_store")
    ev = spark.sql(FIXTURE_SQL["raw_events"].replace("FROM orders", "FROM orders_stream_store")).drop("id")
    streamed = EventStore(spark, os.path.join(tmp_dir, "streamed"))
    q = refresh_store(ev, streamed)
    q.awaitTermination()
    batch = EventStore(spark, os.path.join(tmp_dir, "batched"))
    batch.save_events(fixture(spark, SF_SMALL, "raw_events").drop("id"))
    key = ["event_hash", "year", "title", "source", "category"]
    a = sorted(tuple(r) for r in streamed.events().select(*key).collect())
    b = sorted(tuple(r) for r in batch.events().select(*key).collect())
    assert a == b and len(a) > 0
    # a second run over the same files appends nothing
    q2 = refresh_store(ev, streamed, checkpoint=os.path.join(tmp_dir, "fresh_ckpt"))
    q2.awaitTermination()
    assert streamed.events().count() == len(a)


def test_watermark_dedupe_stream(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    stream = (spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet")
              .parquet(SF_SMALL))
    stream.createOrReplaceTempView("orders_stream_wm")
    from histevents.sources.fixtures import FIXTURE_SQL
    ev = spark.sql(FIXTURE_SQL["raw_events"].replace("FROM orders", "FROM orders_stream_wm")) \
        .withColumn("ingest_ts", F.current_timestamp())
    out = os.path.join(tmp_dir, "wm_out")
    q = (dedupe_within_watermark(ev).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmp_dir, "wm_ckpt")).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    n = spark.read.parquet(out).count()
    assert n == fixture(spark, SF_SMALL, "raw_events").select("year", "title", "source").distinct().count()


def test_reports(spark, tmp_dir):
    from histevents.plans import reports
    ev = fixture(spark, SF_SMALL, "raw_events")
    st = reports.collection_statistics(spark, ev, as_of_year=2025).first()
    assert st.overall_stats.total_events == ev.count()
    assert st.source_breakdown[0]["count"] >= st.source_breakdown[-1]["count"]
    row = reports.validation_report_row(spark, ev).first()
    assert row.summary.status in ("pass", "fail") and len(row.incorrect_events) <= 10
    out = os.path.join(tmp_dir, "collection_report")
    reports.export_collection_report(spark, ev, out, as_of_year=2025)
    assert spark.read.json(out).count() == 1


def test_clean_invalid(spark, tmp_dir):
    from histevents.plans import reports
    st = EventStore(spark, os.path.join(tmp_dir, "store3"))
    ev = fixture(spark, SF_SMALL, "raw_events").drop("id")
    st.save_events(ev)
    # make some stored rows invalid for the validator (bad severity)
    spoilt = st.events().withColumn("severity", F.when(F.col("year") % 2 == 0, F.lit(9)).otherwise(F.col("severity")))
    st._rewrite(spoilt, st.events().select("century").distinct())
    summary, deleted = reports.clean_invalid_events(st, dry_run=True)
    n_bad = one(summary).invalid_events
    assert n_bad > 0 and deleted == 0
    _, deleted = reports.clean_invalid_events(st, dry_run=False)
    assert deleted == n_bad and one(reports.clean_invalid_events(st)[0]).invalid_events == 0

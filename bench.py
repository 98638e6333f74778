"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (the whole plan
runs, nothing is collected to the driver).  The tables are first written anew
in FILES files each, untimed: a test table is a single row group, which one
core reads alone, while the tables of a cluster have many.  Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
The value is over the rewritten tables; beside it are the times over the given
single files, and those of the write path and the streams (WRITES).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from histevents.session import get_spark  # noqa: E402
from histevents.plans.registry import QUERIES  # noqa: E402
from histevents.sources.fixtures import BASE_TABLES  # noqa: E402

FILES = 16

HEADLINE = (
    "validation_report",          # flagship: score + root accuracy + near-duplicate count
    "quality_score",
    "category_breakdown",
    "source_breakdown",
    "event_hash_dedupe",
    "near_duplicate_titles",
    "near_duplicate_count",
    "validator_errors",
    "batch_summary",
    "clean_text_documents",
    "document_sentences",
    "sentence_fields",
    "page_events",
    "news_events",
    "keyword_documents_top50",
    "indicator_events",
    "market_crashes",
    "economic_collection",
    "cycle_patterns",
    "collection_run_summary",
)

WRITES = ("store_roundtrip", "store_delete", "store_statistics", "run_repeated", "stream_dedupe", "stream_watermark_dedupe")


def timed(spark, names, sf_dir: str) -> dict[str, float]:
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, int(cpus) * 2), app_name="histevents-bench")
    # warm-up: JVM start, JIT and codegen of every headline plan, on the small
    # scale factor (untimed), so the timed runs measure steady-state work
    warm_dir = os.environ.get("BENCH_WARMUP_SF_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name].build(spark, warm_dir).write.format("noop").mode("overwrite").save()
    landed = tempfile.mkdtemp(prefix="histevents-bench-")
    for t in BASE_TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(FILES).write.parquet(f"{landed}/{t}.parquet")
    times = timed(spark, names, landed)
    given = timed(spark, names, sf_dir)
    writes = {} if sys.argv[1:] else timed(spark, WRITES, landed)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "files_per_table": FILES,
        "value_given_files": round(sum(given.values()), 3),
        "queries_given_files": given,
        "writes": writes,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

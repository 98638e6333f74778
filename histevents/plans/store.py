"""The event store and its sinks.

Tables are parquet directories under one base path on shared storage:

    {base}/historical_events   partitioned by century, sorted by year, category, root
    {base}/quarantine          rows that failed validation, once each, with their errors
    {base}/cycle_patterns
    {base}/data_collection_logs
    {base}/statistics          counts per century, category, year and root, if kept

Appends are set-based (one write per batch of rows) and idempotent: rows
whose ``event_hash`` is already stored are removed with a ``left_anti``
join first, so re-running a collection appends nothing.  Rejected rows have
a key of their own, their content, and are kept once as well.  Updates and
deletes rewrite the affected centuries through a staging directory next to
the table (a path is never overwritten while it is being read); a century
that loses its last row is emptied too.  The staging directory holds a
journal of the centuries; a rewrite that stopped half-way is finished by the
next call that writes.  A store has one writer at a time.
"""

from __future__ import annotations

import functools
import hashlib
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histevents.functions.scalars import century, digital_root, event_hash, surrogate_id
from histevents.operators import stats, validate
from histevents.operators.dedupe import first_wins_dedupe
from histevents.schema import CYCLE_SCHEMA, EVENT_SCHEMA, LOG_SCHEMA, conform
from histevents.session import delete_path, list_paths, path_exists, scratch_path, touch_path

EVENTS = "historical_events"
QUARANTINE = "quarantine"
CYCLES = "cycle_patterns"
LOGS = "data_collection_logs"
STATISTICS = "statistics"


def to_store_rows(events: DataFrame) -> DataFrame:
    """In-flight events -> store rows: root, hash, surrogate id, JSON tags and
    metadata (only when non-empty), timestamps, verified default false."""
    e = events
    cols = set(e.columns)
    if "tags" in cols and dict(e.dtypes)["tags"].startswith("array"):
        e = e.withColumn("tags", F.when(F.size("tags") > 0, F.to_json("tags")))
    if "metadata" in cols:
        e = e.withColumn("collection_metadata",
                         F.when(F.size("metadata") > 0, F.to_json("metadata")))
    e = (e.withColumn("digital_root", digital_root("year"))
         .withColumn("event_hash", event_hash("year", "title", "source")))
    if "id" not in cols:
        e = e.withColumn("id", surrogate_id("event_hash"))
    e = (e.withColumn("verified", F.coalesce(F.col("verified") if "verified" in cols else F.lit(None), F.lit(False)))
         .withColumn("created_at", F.current_timestamp())
         .withColumn("updated_at", F.current_timestamp()))
    return conform(e, EVENT_SCHEMA)


def apply_verification(events: DataFrame, updates: DataFrame, hit_col: str | None = None) -> DataFrame:
    """K8 as a set operation: ``verified`` from ``updates`` (id, verified)
    where the id matches, ``updated_at`` refreshed on those rows only.
    ``hit_col`` keeps a boolean column marking the updated rows."""
    # one row per id, or a repeated id would multiply the stored row; true wins
    u = updates.groupBy("id").agg(F.max("verified").alias("_new_verified")).withColumn("_hit", F.lit(True))
    out = events.join(u, "id", "left").withColumn("verified", F.coalesce("_new_verified", "verified"))
    if "updated_at" in events.columns:
        out = out.withColumn("updated_at", F.when(F.col("_hit"), F.current_timestamp())
                             .otherwise(F.col("updated_at")))
    keep = list(events.columns)
    if hit_col:
        out = out.withColumn(hit_col, F.coalesce(F.col("_hit"), F.lit(False)))
        keep.append(hit_col)
    return out.select(*keep)


def remove_ids(events: DataFrame, ids: DataFrame) -> DataFrame:
    """K9 as a set operation: rows whose id is not in ``ids``."""
    return events.join(ids.select("id"), "id", "left_anti")


def observed_count(obs: Observation, key: str = "n") -> int:
    """The count an Observation collected.  When the optimizer proves the
    observed plan empty it removes the plan; the row of metrics then has no
    schema, which the conversion to Python asserts: that is a count of 0.
    Anything else that goes wrong is raised."""
    try:
        return int(obs.get[key])
    except Py4JJavaError as fault:
        if fault.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def rejected_key(df: DataFrame):
    """The identity of a rejected row: a digest of its content (columns by name,
    without nulls), so also the same where other batches have other columns."""
    own = sorted(c for c in df.columns if c not in ("errors", "metadata", "occurrences", "quarantined_at", "rejected_key"))
    return F.sha2(F.to_json(F.struct(*own)), 256)


def _after_recovery(write):
    """A call that writes first finishes a rewrite that stopped half-way."""
    @functools.wraps(write)
    def run(self, *args, **kw):
        self.recover()
        return write(self, *args, **kw)
    return run


STORED_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("century", T.IntegerType())])


def _partition(of: int | None) -> str:
    """The name of a century's folder."""
    return "__HIVE_DEFAULT_PARTITION__" if of is None else str(int(of))


class EventStore:
    """The event store under ``base``.

    With ``buckets`` the events table is a catalog table over the same
    location, partitioned by century and bucketed by ``event_hash``: the
    duplicate check of every append then reads the stored side in place
    (bucketed scan, no shuffle of stored rows) and only the new batch is
    shuffled into the buckets.
    """

    def __init__(self, spark: SparkSession, base: str, buckets: int | None = None, table: str | None = None):
        self.spark = spark
        self.base = base.rstrip("/")
        self.buckets = buckets
        self.table = table or "histevents_events_" + hashlib.md5(self.base.encode()).hexdigest()[:12]
        if buckets:
            self._ensure_bucketed_table()

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def _ensure_bucketed_table(self) -> None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in EVENT_SCHEMA.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({cols}, `century` int) USING parquet "
            f"PARTITIONED BY (century) CLUSTERED BY (event_hash) INTO {int(self.buckets)} BUCKETS "
            f"LOCATION '{self.path(EVENTS)}'")

    def _write_events(self, df: DataFrame) -> None:
        if self.buckets:
            cols = [f.name for f in self.spark.table(self.table).schema.fields]
            df.select(*cols).write.insertInto(self.table)
            self.spark.catalog.refreshTable(self.table)
        else:
            df.write.partitionBy("century").mode("append").parquet(self.path(EVENTS))

    # K10
    def create_tables(self) -> None:
        for name, schema, parts in ((EVENTS, EVENT_SCHEMA, ["century"]), (QUARANTINE, None, None),
                                    (CYCLES, CYCLE_SCHEMA, None), (LOGS, LOG_SCHEMA, None)):
            if schema is None:
                continue
            empty = self.spark.createDataFrame([], schema)
            if parts:
                empty = empty.withColumn("century", F.lit(None).cast("int"))
            w = empty.write.mode("ignore")
            if parts:
                w = w.partitionBy(*parts)
            w.parquet(self.path(name))

    # S13
    def events(self) -> DataFrame:
        if self.buckets:
            return self.spark.table(self.table)
        return self.spark.read.schema(STORED_SCHEMA).parquet(self.path(EVENTS))

    def exists(self, table: str = EVENTS) -> bool:
        """Whether the table has been written; a table that exists but can't
        be read is a fault of its own and raises where it is read."""
        if self.buckets and table == EVENTS:
            return True
        return path_exists(self.spark, self.path(table))

    # K3 / K2
    @_after_recovery
    def append_events(self, rows: DataFrame, year_range: tuple[int, int] | None = None) -> int:
        """Append store rows not stored yet; returns the appended count.

        The key is unique in the store: within the batch one row per hash
        is kept (deterministically: smallest row by its plain columns; a
        collection run has already kept the first in source order)."""
        plain = [c for c, t in rows.dtypes if c != "event_hash" and not t.startswith(("map", "array", "struct"))]
        rows = first_wins_dedupe(rows, "event_hash", plain)
        if not self.exists(EVENTS):
            return self._append(rows)
        path = scratch_path(self.spark, f"append-{uuid.uuid4().hex}")
        rows.write.parquet(f"{path}/rows")
        batch = self.spark.read.schema(rows.schema).parquet(f"{path}/rows")
        # at most the batch's hashes; written, as the append is about to change what the store holds
        self.held_hashes(batch, year_range).write.parquet(f"{path}/held")
        held = self.spark.read.schema("event_hash string").parquet(f"{path}/held")
        n = self._append(batch.join(held, "event_hash", "left_anti"))
        delete_path(self.spark, path)
        return n

    def held_hashes(self, batch: DataFrame, year_range: tuple[int, int] | None = None) -> DataFrame:
        """The event hashes of ``batch`` that the store holds, from one scan of
        the stored hashes.

        The stored side is semi-joined with the batch, a plain scan with a
        selective predicate (the hash's length): for a large store Spark then
        filters that scan by a Bloom filter of the batch's hashes, so that only
        stored rows that may be in the batch are shuffled; a small batch is
        broadcast by its measured size.  With the run's year range known, only
        those centuries are read (the hash includes the year)."""
        stored = self.events().select("century", "event_hash")
        if year_range is not None:
            lo, hi = year_range
            stored = stored.filter(F.col("century").between(century(F.lit(lo)), century(F.lit(hi))))
        own = batch.filter(F.length("event_hash") == 32).select("event_hash")
        return stored.select("event_hash").join(own, "event_hash", "left_semi")

    @_after_recovery
    def append_checked(self, rows: DataFrame) -> int:
        """Append store rows of which the caller knows that their hashes are
        unique and not stored; returns the appended count."""
        return self._append(rows)

    def _append(self, rows: DataFrame) -> int:
        obs = Observation("append_events")
        rows = rows.withColumn("century", century("year"))
        kept = self.exists(STATISTICS)
        if kept:  # from here to the end the counts may lack rows: recover() counts anew
            mark = f"{self.base}/_statistics_open_{uuid.uuid4().hex}"
            touch_path(self.spark, mark)
            delta = scratch_path(self.spark, f"statistics-{uuid.uuid4().hex}")
            stats.partials(rows, "century").write.parquet(delta)
        self._write_events(self._laid_out(rows.observe(obs, F.count(F.lit(1)).alias("n"))))
        if kept:
            self.spark.read.parquet(delta).write.partitionBy("century").mode("append").parquet(self.path(STATISTICS))
            delete_path(self.spark, delta)
            delete_path(self.spark, mark)
        return observed_count(obs)

    # A6 / A9 / A13 kept up to date
    def create_statistics(self) -> None:
        """Count all events once; from then on every write keeps the counts:
        an append adds those of its new rows, a rewritten century gets its own."""
        mark = f"{self.base}/_statistics_open_{uuid.uuid4().hex}"
        touch_path(self.spark, mark)
        stats.partials(self.events(), "century").write.partitionBy("century").mode("overwrite").parquet(self.path(STATISTICS))
        delete_path(self.spark, mark)

    def statistics(self) -> DataFrame:
        """The kept counts (for ``stats.completeness_of``, ``year_coverage_of`` and
        ``category_breakdown_of``); no event is read."""
        schema = ("category string, year int, digital_root int, _n bigint, _v bigint, _with_severity bigint, "
                  "_severity bigint, century int")
        return stats.merged(self.spark.read.schema(schema).parquet(self.path(STATISTICS)))

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        """Rows dealt for writing, sorted so that row groups prune.

        By century with ``rebalance``: adaptive execution splits a large
        century over several tasks and files and joins small ones.  A bucketed
        store deals by bucket (the same hash as the table's), so a bucket of a
        century is one file and a large century is spread over all buckets."""
        dealt = rows.repartition(int(self.buckets), "event_hash") if self.buckets else rows.hint("rebalance", "century")
        return dealt.sortWithinPartitions("century", "year", "category", "digital_root")

    # K4
    def save_events(self, events: DataFrame, year_range: tuple[int, int] | None = None) -> tuple[int, int]:
        """Valid rows (collector rule) appended, invalid rows quarantined with
        their validator messages; returns (saved, errors).  ``year_range``
        (the run's requested years) narrows the duplicate check to those
        century partitions."""
        flagged = events.withColumn("_valid", validate.collector_valid(events))
        saved = self.append_events(to_store_rows(flagged.filter("_valid").drop("_valid")), year_range)
        return saved, self.quarantine(flagged.filter(~F.col("_valid")).drop("_valid"))

    def quarantine(self, bad: DataFrame) -> int:
        """Keep invalid rows with their validator messages; returns how many
        ``bad`` holds.

        A row's key is its content (``rejected_key``), ``occurrences`` how often
        its first batch held it.  Keys that are there already are not appended,
        so a repeated save or a replayed epoch leaves the table as it is.  Equal
        rows combine before the shuffle."""
        bad = validate.with_validation(bad)
        keep = [c for c in bad.columns if c != "metadata"]
        bad = bad.select(*keep).withColumn("rejected_key", rejected_key(bad))
        obs = Observation("quarantine")
        bad = bad.observe(obs, F.count(F.lit(1)).alias("n"))
        rows = bad.groupBy("rejected_key").agg(
            F.first(F.struct(*keep)).alias("row"), F.count(F.lit(1)).alias("occurrences")).select(
            "rejected_key", "row.*", "occurrences").withColumn("quarantined_at", F.current_timestamp())
        # counted and written from one evaluation, so that the check doesn't count twice
        path = scratch_path(self.spark, f"rejected-{uuid.uuid4().hex}")
        rows.write.parquet(path)
        batch = self.spark.read.schema(rows.schema).parquet(path)
        if self.exists(QUARANTINE):
            stored = self.spark.read.parquet(self.path(QUARANTINE))
            if "rejected_key" not in stored.columns:  # tables of before the key
                stored = stored.withColumn("rejected_key", rejected_key(stored))
            own = batch.filter(F.length("rejected_key") == 64).select("rejected_key")
            batch = batch.join(stored.select("rejected_key").join(own, "rejected_key", "left_semi"), "rejected_key", "left_anti")
        batch.write.mode("append").parquet(self.path(QUARANTINE))
        delete_path(self.spark, path)
        return observed_count(obs)

    # K5
    def log_activity(self, logs: DataFrame) -> None:
        conform(logs.withColumn("id", F.xxhash64(*[F.col(c) for c in logs.columns if c != "id"]))
                if "id" not in logs.columns else logs, LOG_SCHEMA).write.mode("append").parquet(self.path(LOGS))

    def write_cycles(self, cycles: DataFrame) -> None:
        conform(cycles, CYCLE_SCHEMA).write.mode("overwrite").parquet(self.path(CYCLES))

    # staged rewrite used by K8 / K9
    def _rewrite(self, new_rows: DataFrame, centuries: DataFrame) -> None:
        """Replace the partitions of ``centuries`` by ``new_rows``.

        The rows go to a staging folder next to the table, then a journal of the
        affected centuries: with it the rewrite is decided, and ``_finish`` (or
        ``recover``, if this job ends before) carries it out.  Until then a
        fault leaves the table as it was, and the folder goes."""
        folder = f"{self.base}/_staging_{uuid.uuid4().hex}"
        try:
            new_rows.write.partitionBy("century").parquet(f"{folder}/rows")
            left = self.spark.read.schema(STORED_SCHEMA).parquet(f"{folder}/rows").groupBy("century").agg(F.lit(True).alias("left"))
            centuries.join(left, centuries["century"].eqNullSafe(left["century"]), "left").select(
                centuries["century"], F.coalesce("left", F.lit(False)).alias("left")).coalesce(1).write.parquet(f"{folder}/journal")
        except BaseException:
            delete_path(self.spark, folder)
            raise
        self._finish(folder)

    def _finish(self, folder: str) -> None:
        """Carry out a journal: each century is replaced by its staged rows, or
        emptied.  Doing it again gives the same table."""
        staged = self.spark.read.schema(STORED_SCHEMA).parquet(f"{folder}/rows")
        for r in self.spark.read.parquet(f"{folder}/journal").toLocalIterator():  # 21 at most for valid years
            of = F.col("century").eqNullSafe(F.lit(r.century).cast("int"))
            self._replace(r.century, self._laid_out(staged.filter(of)) if r.left else None)
            if self.exists(STATISTICS):
                stats.partials(staged.filter(of), "century").drop("century").write.mode("overwrite").parquet(
                    f"{self.path(STATISTICS)}/century={_partition(r.century)}")
        delete_path(self.spark, folder)

    def recover(self) -> None:
        """Finish rewrites that stopped half-way; folders without a whole
        journal belong to rewrites that never began, and go.  Frames read from
        the table before name its earlier files: read them again."""
        for folder in list_paths(self.spark, f"{self.base}/_staging_*"):
            if path_exists(self.spark, f"{folder}/journal/_SUCCESS"):
                self._finish(folder)
            else:
                delete_path(self.spark, folder)
        marks = list_paths(self.spark, f"{self.base}/_statistics_open_*")
        if marks:
            self.create_statistics()
            for mark in marks:
                delete_path(self.spark, mark)

    def _replace(self, of: int | None, rows: DataFrame | None) -> None:
        """Overwrite the partition of a century; without rows it is emptied."""
        cols = [f.name for f in EVENT_SCHEMA.fields]
        if rows is None:
            rows = self.spark.createDataFrame([], EVENT_SCHEMA)
        if self.buckets:
            # a partition named in the statement needs no overwrite mode of the
            # session, which other threads would see
            name = f"_replacing_{uuid.uuid4().hex}"
            rows.select(*cols).createOrReplaceTempView(name)
            value = "NULL" if of is None else str(int(of))
            try:
                self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (century = {value}) SELECT * FROM {name}")
            finally:
                self.spark.catalog.dropTempView(name)
            self.spark.catalog.refreshTable(self.table)
        else:
            rows.select(*cols).write.mode("overwrite").parquet(f"{self.path(EVENTS)}/century={_partition(of)}")

    def _affected(self, ev: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of the centuries that hold at least one of ``ids``, and those
        centuries (21 at most for valid years), looked up once; the scan for
        the rows reads these partitions only."""
        found = ev.join(ids.select("id"), "id", "left_semi").select("century").distinct()
        cents = self.spark.createDataFrame([(r.century,) for r in found.toLocalIterator()], "century int")
        return ev.join(F.broadcast(cents), ev["century"].eqNullSafe(cents["century"]), "left_semi"), cents

    # K8
    @_after_recovery
    def update_verification(self, updates: DataFrame) -> int:
        """Set ``verified`` (and ``updated_at``) for the ids in ``updates``
        (id, verified); unknown ids are ignored."""
        ev = self.events()
        part, cents = self._affected(ev, updates)
        obs = Observation("updates")
        changed = apply_verification(part, updates.select("id", "verified"), hit_col="_hit") \
            .observe(obs, F.count_if("_hit").alias("n")).drop("_hit")
        self._rewrite(changed, cents)
        return observed_count(obs)

    # K9
    @_after_recovery
    def delete_ids(self, ids: DataFrame) -> int:
        """Remove the rows whose id is in ``ids``; returns the deleted count."""
        ev = self.events()
        part, cents = self._affected(ev, ids)
        before = Observation("before")
        keep = remove_ids(part.observe(before, F.count(F.lit(1)).alias("n")), ids)
        after = Observation("after")
        self._rewrite(keep.observe(after, F.count(F.lit(1)).alias("n")), cents)
        return observed_count(before) - observed_count(after)


# K1
def save_raw_json(events: DataFrame, path: str) -> None:
    """Raw event files per source (JSON lines; non-ASCII kept)."""
    events.write.mode("append").partitionBy("source").json(path)


# K6
def write_report(report: DataFrame, path: str) -> None:
    """A one-row nested report as a JSON document."""
    report.coalesce(1).write.mode("overwrite").json(path)


# K7
def export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)

"""Repeated runs of lines by a suffix array of line ids, by prefix doubling.

The corpus is the sequence of its lines, documents by doc_id (null last), with
a border after each document.  Round 0 ranks the lines themselves; round k + 1
ranks the suffixes by their first 2^(k+1) lines, from the pairs (rank of i,
rank of i + 2^k).  A suffix whose first 2^k lines occur nowhere else has no
neighbour with a common prefix that long and drops out, so after round 0 only
repeated lines are left.  Suffixes of equal rank after round k are the interval
of the array whose longest common prefix is 2^k lines or more: a run of lines
and all its copies.  Rounds go on until no suffix has an equal neighbour, or
none of those left is needed any more.

A run of lines, however long, counts if it has at least ``LEAST_WORDS`` words
and starts anywhere before as well; the first copy in the order of the corpus
stays, the lines of later ones go.  Maximal runs are put together from their
parts: of every line the shortest run from it on, and the shortest run that
ends with it, that have the words.  Each line of a repeated run with enough
words lies in such a part that lies in the run, so the parts that occur before
cover the maximal runs and nothing else.  A part of m lines is an interval of
common prefix m: ranks of its first and of its last 2^k lines, 2^k <= m < 2^(k+1),
name it.

Lines, their 128-bit ids and the lengths of the parts come from one pass in
Arrow batches.  All other steps are joins and aggregates over (row, line
number, rank): a line that a third of the corpus holds is one row of each
grouped table (counts and first places combine before the shuffle), and its
joins are with that one row, which adaptive execution may split.  Ranks come
from a range sort with one offset per partition.  A document's own runs are
collected and its lines walked once.

Defined results: a null text has no lines and nothing kept (hash of the empty
string); an empty text is one empty line; equal doc_ids go by row; repeated
rows are copies like others; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from histevents.llm.tables import keyed, read, stage

LEAST_WORDS = 16
_LINES = "row bigint, doc bigint, at bigint, k1 bigint, k2 bigint, ahead bigint, behind bigint, need bigint"


def parts(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line: how many lines the shortest run from it on, and the shortest
    run that ends with it, need for ``least`` words (0: there is none, or the
    second is some line's first); and how far ahead a run over it reaches."""
    n = len(words)
    total = np.r_[0, np.cumsum(words)]
    end = np.searchsorted(total, total[:-1] + least)  # total[end] - total[i] >= least
    ahead = np.where(end <= n, end - np.arange(n), 0)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    behind = np.where(start >= 0, np.arange(1, n + 1) - start, 0)
    behind[(behind > 0) & (ahead[np.maximum(start, 0)] == behind)] = 0
    ends = np.arange(n) + ahead
    own = behind > 0
    np.maximum.at(ends, start[own], np.arange(1, n + 1)[own])
    return ahead, behind, np.maximum.accumulate(ends) - np.arange(n) if n else ends


def _lines_of(least: int):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows, docs, numbers, ids, ahead, behind, need = [], [], [], [], [], [], []
                part = b.slice(at, 256)
                for row, doc, text in zip(part.column("row").to_pylist(), part.column("doc").to_pylist(),
                                          part.column("text").cast(pa.binary()).to_pylist()):
                    lines = text.split(b"\n")
                    found = parts(np.array([len(x.split()) for x in lines], np.int64), least)
                    own = np.flatnonzero(found[2])
                    ids += [xxhash.xxh3_128_digest(lines[i]) for i in own.tolist()]
                    rows.append(np.full(len(own), row)), docs.extend([doc] * len(own)), numbers.append(own)
                    for out, x in zip((ahead, behind, need), found):
                        out.append(x[own])
                k = np.frombuffer(b"".join(ids), "<i8").reshape(-1, 2)
                whole = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64)
                         for x in (rows, numbers, ahead, behind, need)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole[0]), pa.array(docs, pa.int64()), pa.array(whole[1]), pa.array(k[:, 0].copy()),
                     pa.array(k[:, 1].copy()), *map(pa.array, whole[2:])],
                    names=["row", "doc", "at", "k1", "k2", "ahead", "behind", "need"])
    return run


def lines_of(own: DataFrame, row: str, least_words: int = LEAST_WORDS) -> DataFrame:
    """(row, doc, at, k1, k2, ahead, behind, need): the lines that a run of enough
    words can hold, with a 128-bit id and the lengths of ``parts``."""
    given = own.where("text is not null").select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc"), "text")
    return given.mapInArrow(_lines_of(least_words), _LINES)


def _ranked(keys: DataFrame) -> DataFrame:
    """``keys`` (k1, k2, ...) with ``rank``, their number in sorted order."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = stage(keys.repartitionByRange(n, "k1", "k2").withColumn("part", F.spark_partition_id()), "line-keys")
    sizes = own.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = sizes.select("part", F.coalesce(F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("part").orderBy("k1", "k2")) + F.col("before")
    return own.join(F.broadcast(before), "part").withColumn("rank", rank).drop("part", "before")


def _first_place():
    return F.min(F.struct(F.col("doc").isNull().alias("no_doc"), "doc", "row", "at"))


def intervals(lines: DataFrame):
    """For k = 0, 1, ...: (k, rows), staged rows (row, doc, at, ahead, behind, need,
    rank, first): the suffixes whose first 2^k lines occur again, and the first
    of them.  A suffix takes part as long as a part over it needs it."""
    suffixes, k = lines, 0
    while True:
        keys = suffixes.groupBy("k1", "k2").agg(F.count("*").alias("n"), _first_place().alias("first")).where("n > 1")
        found = stage(suffixes.join(_ranked(keys.select("k1", "k2", "first")), ["k1", "k2"]).select(
            "row", "doc", "at", "ahead", "behind", "need", "rank",
            F.struct("first.row", "first.at").alias("first")), "line-ranks")
        yield k, found
        k += 1
        own = found.where(F.col("need") >= 2 ** k)
        if own.isEmpty():
            return
        follower = found.select("row", (F.col("at") - 2 ** (k - 1)).alias("at"), F.col("rank").alias("k2"))
        suffixes = own.join(follower, ["row", "at"]).select(
            "row", "doc", "at", F.col("rank").alias("k1"), "k2", "ahead", "behind", "need")


def _later(k: int, found: DataFrame, ends: DataFrame) -> DataFrame:
    """(row, at, n): the parts of 2^k to 2^(k+1) - 1 lines that occur before;
    ``ends`` are the parts (row, at, n) that end with a repeated line."""
    later = (F.col("first.row") != F.col("row")) | (F.col("first.at") != F.col("at"))
    low, high = 2 ** k, 2 ** (k + 1)
    last = found.select("row", (F.col("at") + low).alias("end"), F.col("rank").alias("last"))
    # parts that start with a line, and those that end with one, by their start
    ahead = found.where(F.col("ahead").between(low, high - 1)).withColumn("n", F.col("ahead"))
    behind = found.join(ends.where(F.col("n").between(low, high - 1)), ["row", "at"])
    own = ["row", "doc", "at", "rank", "first", "n"]
    every = ahead.select(*own).unionByName(behind.select(*own))
    exact = every.where(F.col("n") == low).where(later).select("row", "at", "n")
    if not k:
        return exact
    named = every.where(F.col("n") > low).withColumn("end", F.col("at") + F.col("n")).join(last, ["row", "end"])
    first = named.groupBy("rank", "last", "n").agg(F.count("*").alias("copies"), _first_place().alias("place")).where("copies > 1")
    return exact.unionByName(named.join(first.select("rank", "last", "n", F.struct("place.row", "place.at").alias("first_place")),
                                        ["rank", "last", "n"]).where(
        (F.col("first_place.row") != F.col("row")) | (F.col("first_place.at") != F.col("at"))).select("row", "at", "n"))


def _left(batches):
    """What is left of each text; ``runs`` are (first line, lines) to remove."""
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            n_lines, n_removed, kept = [], [], []
            for text, starts, sizes in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("starts").to_pylist(),
                                           part.column("sizes").to_pylist()):
                if text is None or not starts:
                    n_lines.append(0 if text is None else text.count(b"\n") + 1)
                    n_removed.append(0), kept.append(text or b"")
                    continue
                lines = text.split(b"\n")
                steps = np.zeros(len(lines) + 1, np.int64)
                np.add.at(steps, starts, 1)
                np.add.at(steps, np.array(starts) + np.array(sizes), -1)
                gone = np.cumsum(steps[:-1]) > 0
                n_lines.append(len(lines)), n_removed.append(int(gone.sum()))
                kept.append(b"\n".join([x for x, g in zip(lines, gone.tolist()) if not g]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_removed", "kept"])


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept) for every row of ``docs`` (doc_id, text)."""
    own = keyed(docs.select("doc_id", "text"), "line-docs", "row")
    gone = ends = None
    for k, found in intervals(lines_of(own, "row", least_words)):
        if not k:
            behind = F.col("behind")
            ends = found.where(behind > 0).select("row", (F.col("at") + 1 - behind).alias("at"), behind.alias("n"))
        later = stage(_later(k, found, ends), "line-runs")  # one level's joins at a time
        gone = later if gone is None else gone.unionByName(later)
    runs = F.collect_list(F.struct("at", "n"))  # a document's own runs
    per_row = gone.groupBy("row").agg(runs.alias("runs")).select(
        "row", F.col("runs.at").alias("starts"), F.col("runs.n").alias("sizes"))
    schema = f"doc_id {own.schema['doc_id'].dataType.simpleString()}, n_lines bigint, n_removed bigint, kept string"
    # no size bounds the runs: never a broadcast, whatever their size here
    return own.join(per_row.hint("merge"), "row", "left").select("doc_id", "text", "starts", "sizes").mapInArrow(_left, schema)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the later copies of line runs."""
    kept = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

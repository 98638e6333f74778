"""SimHash near-duplicates, candidates by pigeonring filtering.

A fingerprint has 64 bits; bit i is 1 if it is set in more than half of the
XXH64 values (seed 42) of the text's word shingles, repeats included.  Two
fingerprints link at ``DISTANCE`` (3) or fewer differing bits.

Pigeonring: cut the fingerprint into a ring of 8 segments of 8 bits.  If at
most 3 bits differ, some start of the ring has every chain of l segments from
it differing in at most 3 l / 8 bits: none in the first two segments, and at
most one in the three after them.  So two of those three agree as well, and
the pair shares the four segments (i, i+1, and two of i+2..i+4): 8 starts by 3
choices give 24 keys of 32 bits.  Pairs that meet in a key are pruned by the
chain's budgets before the full Hamming distance is taken.

Only different fingerprints take part: one row each, however many documents
have it.  Rows of a key are compared inside a task with numpy, and only a
spanning star of each key's links leaves it, so a key with k members costs k
rows, not k squared.  A key with more than ``block`` members is dealt as pairs
of blocks to several tasks.  Components come from these links.

Defined results: a text without words (null, empty) has fingerprint 0 and
links like any other; a text of fewer words than a shingle is one shingle;
ids may be null (ignored as smallest id, null if a group has no other) or
repeated; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from histevents.llm.components import connected_components
from histevents.llm.tables import free_name, keyed, read, stage

SHINGLE, DISTANCE, SEED = 3, 3, 42
SEGMENTS, BITS = 8, 8
BLOCK = 4096

#: Budget of the first l segments of a chain.
BUDGET = [DISTANCE * n // SEGMENTS for n in range(1, SEGMENTS + 1)]
#: The chain's exact segments and, of the next three, the two that a key holds.
KEYS = [(i, (0, 1, *pair)) for i in range(SEGMENTS) for pair in combinations((2, 3, 4), 2)]


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """As a signed 64-bit number."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        values = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-shingle].tolist()]
        digest = xxhash.xxh64_intdigest
        values = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())],
                          np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 65536):
        ones += np.unpackbits(values[at:at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(values), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without its text, with the fingerprint ``out`` as a long."""
    keep = [c for c in docs.columns if c != text]

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(text).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), pa.array(fps, pa.int64())], names=[*keep, out])

    schema = T.StructType([*docs.drop(text).schema, T.StructField(out, T.LongType())])
    return docs.mapInArrow(run, schema)


def _segment(i: int):
    return F.shiftrightunsigned("fp", BITS * (i % SEGMENTS)).bitwiseAND(2 ** BITS - 1)


def _linked(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether pairs that share a key of ring start ``start`` are links."""
    x = a ^ b
    ring = (x >> (start * BITS)) | np.where(start > 0, x << ((64 - start * BITS) & np.uint64(63)), np.uint64(0))
    keep, total = np.ones(len(x), bool), np.zeros(len(x), np.uint8)
    for n in range(SEGMENTS):
        total += np.bitwise_count((ring >> np.uint64(BITS * n)) & np.uint64(2 ** BITS - 1))
        keep &= total <= BUDGET[n]
    return keep & (np.bitwise_count(x) <= DISTANCE)


def _stars(key: np.ndarray, fp: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star (member, smallest) of the links inside each key.

    key is sorted.  Round d compares every row with the row d below it, so
    that all pairs of a key are met without a Python loop over keys."""
    n, us, vs = len(key), [], []
    left, d = np.arange(n - 1), 1
    while len(left):
        left = left[left + d < n]
        left = left[key[left] == key[left + d]]
        if not len(left):
            break
        hit = left[_linked(fp[left], fp[left + d], start[left])]
        us.append(hit), vs.append(hit + d)
        if sum(map(len, us)) > 4_000_000:  # links of a dense key: keep only what spans them
            us, vs = ([x] for x in _span(n, np.concatenate(us), np.concatenate(vs)))
        d += 1
    if not us:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return _span(n, np.concatenate(us), np.concatenate(vs))


def _span(n: int, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[u], root[v])
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        root = root[root]
        if (root == before).all():
            member = np.flatnonzero(root != np.arange(n))
            return root[member], member


def _compare(batches):
    """Sorted rows (key, part, fp) to links; a key may go over several batches."""
    def links(rows: pa.Table):
        key = rows.column("key").to_numpy()
        part = rows.column("part").to_numpy()
        fp = rows.column("fp").to_numpy()
        group = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
        u, v = _stars(group, fp.view(np.uint64), (key >> 32).astype(np.uint64) // np.uint64(3))
        return pa.RecordBatch.from_arrays([pa.array(fp[u]), pa.array(fp[v])], names=["u", "v"])

    held: list = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) < 50_000:
            continue
        rows = pa.Table.from_batches(held)
        key, part = rows.column("key").to_numpy(), rows.column("part").to_numpy()
        last = np.flatnonzero((key != key[-1]) | (part != part[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield links(rows.slice(0, cut))
        held = rows.slice(cut).to_batches()
    if held:
        yield links(pa.Table.from_batches(held))


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(u, v): links between the fingerprints ``fp`` (each in one row), enough
    of them to span every group of linked ones."""
    values = [F.lit(k << 32) + sum((_segment(i + c) * 2 ** (BITS * n) for n, c in enumerate(chain)), F.lit(0))
              for k, (i, chain) in enumerate(KEYS)]
    rows = fps.select("fp", F.explode(F.array(*values)).alias("key"))
    large = stage(rows.groupBy("key").agg(F.count("*").alias("n")).where(f"n > {block}")
                  .select("key", F.ceil(F.col("n") / block).alias("blocks")), "large-keys")
    if large.isEmpty():
        dealt = rows.select("key", F.lit(0).cast("long").alias("part"), "fp")
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        dealt = rows.join(large, "key", "left").select(
            "key", "fp", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
                F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                            lambda o: F.least(own, o) * F.col("blocks") + F.greatest(own, o)))).alias("part")
        ).select("key", "part", "fp")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "key", "part").sortWithinPartitions("key", "part").mapInArrow(_compare, "u long, v long")


def components(own: DataFrame, fp: str = "fp") -> DataFrame:
    """(fp, root) for each fingerprint of ``own`` that links with another one."""
    different = stage(own.select(F.col(fp).alias("fp")).distinct(), "fingerprints")
    return stage(connected_components(links(different)), "fp-roots").select(F.col("node").alias("fp"), "root")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    own = stage(fingerprints(read(spark, sf_dir, "documents", "doc_id", "text")), "simhash")
    least = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = least.join(components(own), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = groups.join(low, "root").select("fp", "component_id")
    return own.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id (null last)."""
    row, fp = free_name(docs, "_row"), free_name(docs, "_fp")
    all_rows = keyed(docs, "simhash-docs", row)
    own = stage(fingerprints(all_rows.select(row, "doc_id", "text"), out=fp), "simhash")
    root = components(own, fp).withColumnRenamed("fp", fp)
    best = own.groupBy(fp).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("best"))
    best = best.join(root, fp, "left").groupBy(F.coalesce("root", fp).alias("root")).agg(F.min("best").alias("best"))
    return all_rows.join(best.select(F.col("best")[row].alias(row)), row, "left_semi").select(
        *[F.col(f"`{c}`") for c in docs.columns])

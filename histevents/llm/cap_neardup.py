"""Embedding near-duplicates by spherical-cap filters.

A filter is a direction of a structured random product code: one of ``WORDS``
random unit vectors for each half of the coordinates, joined; there are
``CODES`` such codes, each with random halves of its own.  A vector passes the
filters whose inner product with it reaches the cap's height; as that is a sum
over the halves, the best score of one half tells which words of the other can
reach it, and the rest is never tried.  Vectors of one label (and one length)
that share a filter are compared by cosine in double precision.

A height of 3.5 deviations (1/sqrt(d) for a random direction) lets a vector of
64 components pass 27 filters on average, but the number differs from place to
place, and a whole group of copies shares its place; so a vector with fewer
than ``LEAST`` lowers its height until it passes its ``LEAST`` best.  The codes
grow with the label of most classes: its classes pass ``PASSED`` filters each,
and there are so many words, and the height is raised so far, that a filter
holds about ``HELD`` of them (``words_for``); so comparisons grow with the table,
not its square.  In few
dimensions the height stays at 0.6 and a code has fewer words.  tests/llm and
the README measure the recall against brute force.

Equal vectors of a label are one class.  A class with k links costs k, not the
pairs of its copies.  A filter's classes are compared inside tasks; of the
links only a spanning star and per-class sums leave them.  A filter with more
than ``block`` classes is dealt as pairs of blocks.  A pair is counted at its
first common filter alone.

Defined results: a vector that is null, zero, or holds a null or non-finite
component, or whose label is null, has no links, and component_id = vec_id; a
null vec_id counts in links, but isn't the smallest id unless there is no
other (then component_id is null and kept false); repeated rows link; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from functools import cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from histevents.llm.components import connected_components
from histevents.llm.tables import read, stage

COSINE, SEED = 0.93, 7
CODES, WORDS, DEVIATIONS, LEAST_HEIGHT, PASSED, LEAST = 12, 128, 3.5, 0.6, 27, 24
HELD = 64
BLOCK = 1024


def words_for(classes: int) -> int:
    """Words of a half, for a label of so many classes: CODES * words ** 2 filters
    hold ``HELD`` of them each, if a class passes ``PASSED``."""
    return max(WORDS, math.ceil(math.sqrt(classes * PASSED / HELD / CODES)))


def deviations_for(most: int) -> float:
    """The height, in deviations, that as few of more words pass as ``DEVIATIONS``
    of ``WORDS``."""
    normal = NormalDist()
    return -normal.inv_cdf(normal.cdf(-DEVIATIONS) * (WORDS / most) ** 2)


@cache
def code(d: int, most: int = WORDS) -> tuple[list[list[np.ndarray]], list[np.ndarray], float]:
    """The codes (per half its words, scaled), the halves' coordinates (per code
    its own random halves), and the height; ``most`` words a half."""
    rng = np.random.default_rng([SEED, d])
    cut = [slice(0, d - d // 2), slice(d - d // 2, d)] if d > 1 else [slice(0, d)]
    height = min(deviations_for(most) / np.sqrt(d), LEAST_HEIGHT)

    def words(n: int) -> list[np.ndarray]:
        found = []
        for s in cut:
            w = rng.standard_normal((n, s.stop - s.start))
            found.append(w / np.linalg.norm(w, axis=1, keepdims=True) / np.sqrt(len(cut)))
        return found

    x = rng.standard_normal((256, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    trial = [x[:, s] @ w.T for s, w in zip(cut, words(256))]
    share = np.mean(trial[0][:, :, None] + (trial[1][:, None, :] if len(cut) > 1 else 0) >= height)
    n = most if height < LEAST_HEIGHT else int(np.clip((PASSED / CODES / max(share, 1e-9)) ** (1 / len(cut)), 4, most))
    halves = [[p[s] for s in cut] for p in (rng.permutation(d) for _ in range(CODES))]
    return [words(n) for _ in range(CODES)], halves, float(height)


def _reached(x: np.ndarray, height: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, filter, score), by row, of the filters at a height."""
    codes, halves, _ = code(x.shape[1], most)
    rows, numbers, scores = [], [], []
    for c, (words, half) in enumerate(zip(codes, halves)):
        n = len(words[0])
        first = x[:, half[0]] @ words[0].T
        if len(words) == 1:
            row, i = np.nonzero(first >= height)
            rows.append(row), numbers.append(c * n + i), scores.append(first[row, i])
            continue
        second = x[:, half[1]] @ words[1].T
        row, i = np.nonzero(first + second.max(1, keepdims=True) >= height)  # others can't reach it
        score = first[row, i][:, None] + second[row]
        k, j = np.nonzero(score >= height)
        rows.append(row[k]), numbers.append((c * n + i[k]) * n + j), scores.append(score[k, j])
    row, number, score = np.concatenate(rows), np.concatenate(numbers), np.concatenate(scores)
    order = np.argsort(row, kind="stable")
    return row[order], number[order], score[order]


def passed(x: np.ndarray, most: int = WORDS) -> list[np.ndarray]:
    """Sorted numbers of the filters that each unit row of x passes."""
    height, out, left = code(x.shape[1], most)[2], [np.empty(0, np.int64)] * len(x), np.arange(len(x))
    lowered = False
    while len(left):
        row, number, score = _reached(x[left], height, most)
        count = np.bincount(row, minlength=len(left))
        ends = np.cumsum(count)
        done = (count >= LEAST) | (height < 0.02)
        for i in np.flatnonzero(done).tolist():
            own, best = number[ends[i] - count[i]:ends[i]], score[ends[i] - count[i]:ends[i]]
            if lowered and len(own) > LEAST:
                own = own[np.argpartition(-best, LEAST)[:LEAST]]
            out[left[i]] = np.sort(own)
        left, height, lowered = left[~done], height * 0.88, True
    return out


def _by_length(rows: list[np.ndarray], most: int):
    """Row numbers of vectors of one length, some at a time, and their filters."""
    for d in sorted({len(v) for v in rows}):
        own = [i for i, v in enumerate(rows) if len(v) == d]
        for at in range(0, len(own), 1024):
            part = own[at:at + 1024]
            x = np.stack([rows[i] / np.abs(rows[i]).max() for i in part])
            yield part, passed(x / np.linalg.norm(x, axis=1, keepdims=True), most)


def _filtered(batches, most: int):
    """(cls, label, dim, filter) for every filter a class passes."""
    for b in batches:
        cls, label = b.column("cls").to_numpy(), b.column("label").to_numpy()
        rows = [np.array(v, np.float64) for v in b.column("v").to_pylist()]
        for own, found in _by_length(rows, most):
            n = [len(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(cls[own], n)), pa.array(np.repeat(label[own], n)),
                 pa.array(np.full(sum(n), len(rows[own[0]])), pa.int64()),
                 pa.array(np.concatenate(found).astype(np.int64))],
                names=["cls", "label", "dim", "filter"])


def _linked(cls, own, size, vectors, filters, number: int, cosine: float):
    """Links among the classes of one filter part: (u, v, add) rows."""
    x = np.stack([np.frombuffer(v, "<f8") for v in vectors])
    norm = np.linalg.norm(x, axis=1)
    near = (x @ x.T) / np.outer(norm, norm) >= cosine
    np.fill_diagonal(near, False)
    if not near.any():
        return None
    lists = [np.frombuffer(f, "<i8") for f in filters]
    lists = [f[:np.searchsorted(f, number)] for f in lists]
    earlier, column = np.unique(np.concatenate(lists), return_inverse=True)
    if len(earlier):
        member = np.zeros((len(lists), len(earlier)), np.float32)
        member[np.repeat(np.arange(len(lists)), [len(f) for f in lists]), column] = 1
        first = near & (member @ member.T == 0)
    else:
        first = near
    if len(set(own)) > 1:  # a pair of blocks: pairs inside one are counted where it meets itself
        first = first & (own[:, None] != own[None, :])
    add = first @ size
    root = np.arange(len(cls))
    while True:  # the smallest number reachable
        low = np.minimum(root, np.where(near, root[None, :], len(cls)).min(1))
        low = low[low]
        if (low == root).all():
            break
        root = low
    member = np.flatnonzero(root != np.arange(len(cls)))
    counted = np.flatnonzero(add)
    return (np.r_[cls[member], cls[counted]], np.r_[cls[root[member]], cls[counted]],
            np.r_[np.zeros(len(member), np.int64), add[counted]])


def _compare(cosine: float):
    def run(batches):
        held: list = []

        def links(rows: pa.Table):
            key = np.stack([rows.column(c).to_numpy() for c in ("label", "dim", "filter", "part")])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            cls, own, size = (rows.column(c).to_numpy() for c in ("cls", "own", "size"))
            vectors, filters = rows.column("v").to_pylist(), rows.column("filters").to_pylist()
            out = []
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), rows.num_rows]):
                if e - s > 1:
                    got = _linked(cls[s:e], own[s:e], size[s:e], vectors[s:e], filters[s:e], int(key[2, s]), cosine)
                    if got:
                        out.append(got)
            u, v, add = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(add)], names=["u", "v", "add"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            if sum(x.num_rows for x in held) < 4 * BLOCK:
                continue
            rows = pa.Table.from_batches(held)
            key = [rows.column(c).to_numpy() for c in ("label", "dim", "filter", "part")]
            other = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield links(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
        if held:
            yield links(pa.Table.from_batches(held))
    return run


def _packed(batches, most: int):
    """Vectors and filter lists of classes as binary values."""
    for b in batches:
        rows = [np.array(v, np.float64) for v in b.column("v").to_pylist()]
        packed, lists = [(v / np.abs(v).max()).astype("<f8").tobytes() for v in rows], [b""] * len(rows)
        for own, found in _by_length(rows, most):
            for i, f in zip(own, found):
                lists[i] = f.astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [b.column("cls"), b.column("size"), pa.array(packed, pa.binary()), pa.array(lists, pa.binary())],
            names=["cls", "size", "v", "filters"])


def classes(vectors: DataFrame) -> DataFrame:
    """(cls, label, v, size, least): different usable vectors of each label."""
    usable = "v is not null and label is not null and forall(v, x -> x is not null and abs(x) < double('infinity')) " \
             "and exists(v, x -> x <> 0)"
    return stage(
        vectors.where(usable).groupBy("label", "v").agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
        .withColumn("cls", F.monotonically_increasing_id()), "cap-classes")


def links(cls: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(u, v, add), staged: edges that span the groups of linked classes, and
    per class (u = v) parts of the number of vectors it links with."""
    n = int(cls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["label", "dim", "filter"]
    kind = dict(cls.dtypes)["label"]
    label = F.col("label").cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64("label")
    largest = cls.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    most = words_for(largest)
    rows = stage(cls.repartition(n, "cls").select("cls", label.alias("label"), "v").mapInArrow(
        lambda batches: _filtered(batches, most), "cls bigint, label bigint, dim bigint, filter bigint"), "cap-filters")
    shared = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").withColumn(
        "blocks", F.ceil(F.col("n") / block)).drop("n")
    own = F.pmod(F.xxhash64("cls"), F.col("blocks"))
    dealt = rows.join(shared, key).withColumn("own", own).withColumn("part", F.explode(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda o: F.least("own", o) * F.col("blocks") + F.greatest("own", o)))).drop("blocks")
    packed = cls.repartition(n, "cls").select("cls", "size", "v").mapInArrow(
        lambda batches: _packed(batches, most), "cls bigint, size bigint, v binary, filters binary")
    return stage(
        dealt.join(packed, "cls").repartition(n, *key, "part").sortWithinPartitions(*key, "part")
        .mapInArrow(_compare(cosine), "u bigint, v bigint, add bigint"), "cap-links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``
    (vec_id, embedding, label)."""
    own = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")
    cls = classes(own)
    found = links(cls, cosine, block)
    counts = found.groupBy(F.col("u").alias("cls")).agg(F.sum("add").alias("linked"))
    root = stage(connected_components(found.where("u <> v").select("u", "v")), "cap-roots").withColumnRenamed("node", "cls")
    of = cls.join(root, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    low = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(low, "root").join(counts, "cls", "left").select(
        "label", "v", (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id",
        F.lit(True).alias("_of"))
    out = own.join(of, ["label", "v"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("_of"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_cap_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return near_duplicates(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))

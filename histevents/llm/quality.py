"""Quality by ordinal cumulative-link regression on graded ratings.

Grades: 0 toxic, 1 of low quality, 2 good (from the ratings ``quality`` and
``toxic``).  P(grade <= k) = sigmoid(threshold_k - score), with thresholds in
order and one score for all of them: the sum of the weights of the text's
hashed features (each different word; the first 4 and 5 letters of words, and
whether 2 or 4 different words begin with them; each different run of signs;
and in steps the shares of different tokens, of signs and of capital vowels).  So a text has an expected grade and the tail
probabilities P(grade >= 1) and P(grade >= 2), and is kept if the latter is at
least ``CUT``.

Fitting takes a sample of at most ``MAX_RATED`` rated documents (the smallest
hashes of their ids; the bound is a parameter, whatever the tables' sizes):
their ids are broadcast, their features alone are collected, and the weights
are fitted on the driver by full-batch gradient steps.  Features take part
whose spread over the grades is significant at ``LEVEL`` (chi-square with two
degrees of freedom), whatever the number of ratings.  Scoring is one pass
over the whole texts of all documents, without a shuffle.

Defined results: a null or empty text has no features and scores 0; a rating
with a null in it is none; several ratings of one id count as the lowest, and
of several rows with a rated id one is taken for fitting; ids may be null or
repeated; without any rating every probability is null and all rows are kept.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from histevents.llm.tables import free_name, read

GRADES = 3
MAX_RATED, CUT = 12_000, 0.5
HASH_BITS = 18
LEVEL, STEPS, RATE, RIDGE = 1e-3, 150, 0.1, 1e-4

TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+")


def features(text: str | None) -> np.ndarray:
    """Sorted numbers of the features of a whole text."""
    if not text:
        return np.empty(0, np.int32)
    found = TOKEN.findall(text.lower())
    tokens = set(found)
    signs = sum(not t[0].isalpha() for t in found) if found else 0
    capitals = sum(map(text.count, "AEIOU"))
    vowels = capitals + sum(map(text.count, "aeiou"))
    begins = Counter([t[:4] for t in tokens if len(t) > 3] + [t[:5] for t in tokens if len(t) > 4])
    different = 10 * len(tokens) // (len(found) + 1)
    parts = tokens.union([f"{b}-" for b in begins], [f"{b}-2" for b, n in begins.items() if n > 1],
                         [f"{b}-4" for b, n in begins.items() if n > 3], [
        f"different {different}", f"different {different} {len(found).bit_length()}",
        f"signs {20 * signs // (len(found) + 1)}", f"capitals {10 * capitals // (vowels + 1)}"])
    crc, mask = zlib.crc32, (1 << HASH_BITS) - 1
    return np.unique(np.array([crc(t.encode()) & mask for t in parts], np.int32))


def sample(docs: DataFrame, ratings: DataFrame, most: int = MAX_RATED) -> list:
    """At most ``most`` (grade, features) of rated documents."""
    rated = ratings.where("doc_id is not null and quality is not null and toxic is not null").select(
        "doc_id", F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("grade"))
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches):
        for b in batches:
            found = [features(t).astype("<i4").tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("grade"), pa.array(found, pa.binary())],
                                             names=["doc_id", "grade", "found"])

    own = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "grade")
    found = own.mapInArrow(run, "doc_id bigint, grade int, found binary")
    one = found.groupBy("doc_id").agg(F.min(F.struct("grade", "found")).alias("x")).orderBy("doc_id")
    return [(r.x.grade, np.frombuffer(r.x.found, "<i4")) for r in one.toLocalIterator()]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rated: list, steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE,
        level: float = LEVEL) -> tuple[np.ndarray, np.ndarray] | None:
    """(weights, thresholds) by Adam on the likelihood of (grade, features)."""
    if not rated:
        return None
    grade = np.array([g for g, _ in rated])
    sizes = np.array([len(f) for _, f in rated])
    all_of = np.concatenate([f for _, f in rated])
    # only features that lie unevenly over the grades; others would add noise to long texts
    by_grade = np.stack([np.bincount(all_of[np.repeat(grade == g, sizes)], minlength=1 << HASH_BITS) for g in range(GRADES)])
    expected = by_grade.sum(0) * (np.bincount(grade, minlength=GRADES) / len(grade))[:, None]
    chi = ((by_grade - expected) ** 2 / np.maximum(expected, 1e-9)).sum(0)
    own = np.flatnonzero(chi >= -2 * np.log(level))  # the tail of two degrees of freedom is exp(-chi / 2)
    column = np.full(1 << HASH_BITS, -1, np.int32)
    column[own] = np.arange(len(own))
    row = np.repeat(np.arange(len(rated), dtype=np.int32), sizes)
    used = column[all_of] >= 0
    col, row = column[all_of][used], row[used]
    share = np.cumsum(np.bincount(grade, minlength=GRADES) + 1)[:-1] / (len(grade) + GRADES)
    # first threshold, then logs of the gaps; thresholds stay in order
    at = np.log(share / (1 - share))
    x = np.concatenate([np.zeros(len(own)), at[:1], np.log(np.diff(at))])
    mean, square = np.zeros_like(x), np.zeros_like(x)
    n, k = len(rated), len(own)
    for step in range(1, steps + 1):
        gaps = np.exp(x[k + 1:])
        cut = x[k] + np.r_[0, np.cumsum(gaps)]
        score = np.bincount(row, x[:k][col], minlength=n)
        edge = np.concatenate([[-np.inf], cut, [np.inf]])
        high, low = _sigmoid(edge[grade + 1] - score), _sigmoid(edge[grade] - score)
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p  # of log p, by the edges
        by_score = (d_high - d_low) / n  # of the loss, by the score
        by_cut = np.array([d_low[grade == i + 1].sum() - d_high[grade == i].sum() for i in range(GRADES - 1)]) / n
        grad = np.concatenate([
            np.bincount(col, by_score[row], minlength=k) + ridge * x[:k], [by_cut.sum()],
            [by_cut[i:].sum() * gaps[i - 1] for i in range(1, GRADES - 1)]])
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad ** 2
        x -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
    weights = np.zeros(1 << HASH_BITS, np.float32)
    weights[own] = x[:k]
    return weights, x[k] + np.r_[0, np.cumsum(np.exp(x[k + 1:]))]


def score(docs: DataFrame, model, out: str = "quality", text: str = "text") -> DataFrame:
    """``docs`` with ``out``: struct<grade, at_least_1, at_least_2> (doubles)."""
    schema = T.StructType([*docs.schema, T.StructField(out, T.StructType.fromDDL(
        "grade double, at_least_1 double, at_least_2 double"))])
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for b in batches:
            if model is None:
                tails = np.full((b.num_rows, GRADES - 1), np.nan)
            else:
                weights, cut = model
                s = np.array([weights[features(t)].sum(dtype=np.float64) for t in b.column(text).to_pylist()])
                tails = _sigmoid(s.reshape(-1, 1) - cut)
            parts = [pa.array(x, pa.float64(), from_pandas=True) for x in (tails.sum(1), *tails.T)]
            own = pa.StructArray.from_arrays(parts, names=["grade", "at_least_1", "at_least_2"])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], own], names=[*columns, out])

    return docs.mapInArrow(run, schema)


def graded(docs: DataFrame, ratings: DataFrame, out: str = "quality", most: int = MAX_RATED) -> DataFrame:
    """Fit on the ratings of ``docs`` and score all of ``docs``."""
    return score(docs, fit(sample(docs, ratings, most)), out)


def _keeps(tail):
    return F.coalesce(tail >= CUT, F.lit(True))


def select_good(docs: DataFrame, ratings: DataFrame, most: int = MAX_RATED) -> DataFrame:
    """The rows of ``docs`` to keep, in its columns."""
    out = free_name(docs, "_quality")
    return graded(docs, ratings, out, most).where(_keeps(F.col(out)["at_least_2"])).drop(out)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = graded(docs, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    return found.select("doc_id", F.col("quality.grade").alias("expected_grade"),
                        F.col("quality.at_least_1").alias("p_not_toxic"), F.col("quality.at_least_2").alias("p_good"),
                        _keeps(F.col("quality.at_least_2")).alias("kept"))

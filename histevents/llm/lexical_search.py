"""Ranked lexical search with hashed max-sketches.

The index has one row per document: its length in terms, its text, and a
sketch.  The sketch folds the document's term counts into coordinates by a hash
of the term; a coordinate holds the largest count of the terms that fall on it.
Its width is a power of two of at least ``WIDER`` times the document's different
terms.
A term's impact grows with its count, so the impact at the coordinate's count is
an upper bound of the impact of every term that falls there, and the sum of
weight times that bound over a query's terms bounds the query's score.  (Few
other terms fall on a query term's coordinate, as most are 0; only the others
are stored.)

A search reads the index once for a block of queries.  The sketches of a batch
are looked up for all terms of the block together; then, query by query, the
documents are rescored from their whole texts in the order of their bounds,
until no bound reaches the last of the best scores found so far in the task.
Only the best few of a task and query leave it.  Bounds are never too low and
equal bounds are rescored, so the result is exact.

Document frequencies of all terms are counted while the index is built: tasks
send partial counts (at most ``PARTIAL`` terms are held at a time).  Queries are
broadcast in blocks of at most ``BLOCK_QUERIES`` queries and ``BLOCK_TERMS``
terms (a longer query is a block of its own); more queries take more passes.

Defined results: a null text, or one without terms, is no document of the
statistics and no result, and as a query it has no results; equal scores go by
id, null ids last; repeated rows are documents, and queries, of their own; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from histevents.llm.tables import keyed, read, stage

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BEST = 10
WIDER, MOST_COUNT = 32, 255
PARTIAL = 200_000
BLOCK_QUERIES, BLOCK_TERMS = 1_000, 50_000
GATHERED = 1 << 21

INDEX = "row bigint, doc_id {}, n bigint, sketch binary, text binary, term binary, df bigint"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a whole text; only A-Z are lower-cased."""
    return TERM.findall(text.lower()) if text else []


def sketch(counts: Counter) -> bytes:
    """Largest count of the terms of each coordinate, ``MOST_COUNT`` for any from
    there on: the logarithm of the width, then the coordinates that aren't 0 as
    counts and positions."""
    bits = max(8, (WIDER * len(counts) - 1).bit_length())
    at = np.fromiter((zlib.crc32(t) for t in counts), np.int64, len(counts)) & ((1 << bits) - 1)
    dense = np.zeros(1 << bits, np.uint8)
    np.maximum.at(dense, at, np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), MOST_COUNT).astype(np.uint8))
    own = np.flatnonzero(dense)
    return bytes([bits]) + dense[own].tobytes() + own.astype("<u2" if bits <= 16 else "<u4").tobytes()


def unfold(packed: bytes) -> np.ndarray:
    """The counts of all coordinates of a sketch."""
    kind = "<u2" if packed[0] <= 16 else "<u4"
    n = (len(packed) - 1) // (1 + int(kind[-1]))
    dense = np.zeros(1 << packed[0], np.uint8)
    dense[np.frombuffer(packed, kind, n, 1 + n)] = np.frombuffer(packed, np.uint8, n, 1)
    return dense


def _indexed(batches):
    """Documents with terms, and partial document counts of terms."""
    df: Counter = Counter()
    kinds = {"n": pa.int64(), "sketch": pa.binary(), "text": pa.binary(), "term": pa.binary(), "df": pa.int64()}
    ids: dict = {}

    def rows(**columns):
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * n), t) for c, t in {**ids, **kinds}.items()],
                                          names=[*ids, *kinds])

    for b in batches:
        ids = {c: b.schema.field(c).type for c in ("row", "doc_id")}
        out = []
        for row, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id")),
                                     b.column("text").cast(pa.binary()).to_pylist()):
            found = terms(text)
            if found:
                counts = Counter(found)
                df.update(counts.keys())
                out.append((row, doc_id, len(found), sketch(counts), text))
                if len(df) > PARTIAL:
                    yield rows(term=list(df.keys()), df=list(df.values()))
                    df.clear()
        if out:
            yield rows(**dict(zip(("row", "doc_id", "n", "sketch", "text"), zip(*out))))
    if df:
        yield rows(term=list(df.keys()), df=list(df.values()))


def index(docs: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """(documents, vocabulary, number of documents, their length) of ``docs``
    (doc_id, text): documents are (row, doc_id, n, sketch, text), the vocabulary
    (term, df).  The row only tells rows of one id apart."""
    own = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = INDEX.format(own.schema["doc_id"].dataType.simpleString())
    rows = stage(own.mapInArrow(_indexed, schema), "search-index")
    documents = rows.where("term is null").drop("term", "df")
    vocabulary = rows.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    size = documents.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    return documents, vocabulary, size.docs, size.length or 0


def _queries(batches):
    for b in batches:
        pairs = [(q, t) for q, text in zip(b.column("query").to_pylist(), b.column("text").cast(pa.binary()).to_pylist())
                 for t in dict.fromkeys(terms(text))]
        yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in pairs], pa.int64()), pa.array([t for _, t in pairs], pa.binary())],
                                         names=["query", "term"])


def _blocks(pairs: DataFrame, docs: int):
    """(query, term, weight) in blocks of whole queries, one after the other."""
    held, size = {}, 0
    for r in pairs.orderBy("query", "term").toLocalIterator(prefetchPartitions=False):
        if r.query not in held and held and (len(held) >= BLOCK_QUERIES or size >= BLOCK_TERMS):
            yield held
            held, size = {}, 0
        weight = math.floor(1000 * math.log((2 * docs + 2) / (2 * r.df + 1)))
        held.setdefault(r.query, []).append((bytes(r.term), weight))
        size += 1
    if held:
        yield held


class _Search:
    """The queries of a block, and the best documents of a task for each."""

    def __init__(self, block: dict, docs: int, length: int, best: int):
        self.queries, self.docs, self.length, self.best = list(block), docs, length, best
        self.terms = [block[q] for q in self.queries]
        number: dict[bytes, int] = {}
        of = [number.setdefault(t, len(number)) for q in self.terms for t, _ in q]
        self.hash = np.fromiter((zlib.crc32(t) for t in number), np.int64, len(number))
        self.of, self.weight = np.array(of, np.int64), np.array([w for q in self.terms for _, w in q], np.float64)
        self.starts = np.cumsum([0, *[len(q) for q in self.terms]])[:-1]
        self.found: list[list[tuple[int, int]]] = [[] for _ in self.queries]  # (-score, row), best first
        self.least = np.zeros(len(self.queries))

    def norm(self, n: int) -> int:
        return 10 + 90 * n * self.docs // self.length

    def bounds(self, n: list[int], sketches: list[bytes]) -> np.ndarray:
        """Upper bound of every query (column) for every document (row)."""
        out = np.empty((len(n), len(self.queries)))
        step = max(1, GATHERED // max(1, len(self.of)))
        for s in range(0, len(n), step):
            part = sketches[s:s + step]
            dense = map(unfold, part)
            count = np.stack([x[self.hash & (len(x) - 1)] for x in dense]).astype(np.float64)
            m = np.array([[8.0 * self.norm(k)] for k in n[s:s + step]])
            impact = np.where(count > 0, np.floor(1e9 * count / (1000 * count + m)) + 1, 0.0)
            impact[count >= MOST_COUNT] = 1e6
            out[s:s + step] = np.add.reduceat(impact[:, self.of] * self.weight, self.starts, axis=1)
        return out

    def rescore(self, q: int, n: int, counts: Counter) -> int:
        m = 8 * self.norm(n)
        return sum(w * (1_000_000_000 * c // (1000 * c + m)) for t, w in self.terms[q] if (c := counts.get(t)))

    def add(self, keys: list[tuple], n: list[int], sketches: list[bytes], texts: list[bytes]) -> None:
        """``keys`` decide among equal scores, smallest first."""
        bounds, counts = self.bounds(n, sketches), {}
        for q in range(len(self.queries)):
            own, found = bounds[:, q], self.found[q]
            near = np.flatnonzero((own > 0) & (own >= self.least[q]))
            for i in near[np.argsort(-own[near], kind="stable")].tolist():
                if own[i] < self.least[q]:
                    break
                if i not in counts:
                    counts[i] = Counter(terms(texts[i]))
                score = self.rescore(q, n[i], counts[i])
                if score > 0 and score >= self.least[q]:
                    insort(found, (-score, keys[i]))
                    del found[self.best:]
                    if len(found) == self.best:
                        self.least[q] = -found[-1][0]


def _scan(shared):
    def run(batches):
        search, kind = _Search(*shared.value), None
        for b in batches:
            kind = b.schema.field("doc_id").type
            for at in range(0, b.num_rows, 512):
                row, doc_id, *rest = (b.slice(at, 512).column(c).to_pylist() for c in ("row", "doc_id", "n", "sketch", "text"))
                search.add([(d is None, 0 if d is None else d, r) for r, d in zip(row, doc_id)], *rest)
        rows = [(q, -s, None if no_id else doc_id, row)
                for q, found in zip(search.queries, search.found) for s, (no_id, doc_id, row) in found]
        if rows:
            query, score, doc_id, row = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(score, pa.int64()), pa.array(doc_id, kind),
                                              pa.array(row, pa.int64())], names=["query", "score", "doc_id", "row"])
    return run


def search(docs: DataFrame, queries: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of ``docs``
    (doc_id, text) for every row of ``queries`` (item_id, text)."""
    spark = docs.sparkSession
    asked = keyed(queries.select("item_id", "text"), "search-queries", "query")
    documents, vocabulary, count, length = index(docs.select("doc_id", "text"))
    pairs = asked.select("query", "text").mapInArrow(_queries, "query bigint, term binary").join(vocabulary, "term")
    schema = f"query bigint, score bigint, doc_id {documents.schema['doc_id'].dataType.simpleString()}, row bigint"
    found = spark.createDataFrame([], schema)
    for block in _blocks(pairs, count):
        shared = spark.sparkContext.broadcast((block, count, length, best))
        found = found.unionByName(documents.mapInArrow(_scan(shared), schema))
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row"))
    return stage(found, "search-found").withColumn("rank", rank).where(F.col("rank") <= best).join(
        asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))

"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are lower-cased (A-Z) and cut into words; a pattern is a window of
``window`` consecutive words of a benchmark item, or the whole item if it has
fewer.  For the patterns of one length m, a shift table over blocks of B words
tells how far the search may jump: a block that no pattern holds lets it skip
m - B + 1 words.  Where the shift is 0, the block's bucket of patterns, cut by
their first block, is compared word for word.

The documents stream through Arrow batches, one row after the other, without a
shuffle.  The patterns are broadcast in blocks of about ``block_patterns`` and
``BLOCK_BYTES`` at most; a larger benchmark is searched in as many passes, each
over all documents, with the hits so far staged in between.  With a pattern goes
the number of its set of items (equal sets have one number, by count and two
hashes); the ids themselves stay in a table of (number, item) rows, which only
the numbers found in documents are joined with, once for each different list of
numbers.

Defined results: a null text, or one without words, has no words, no hits and
isn't contaminated; a null or empty benchmark text has no pattern; an item
with a null id marks words but isn't counted or listed; repeated items count
once by id; rows may repeat; an empty table gives no rows, and an empty
benchmark no hits.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from histevents.llm.tables import free_name, read, stage

WINDOW = 13
BLOCK_PATTERNS, BLOCK_BYTES = 200_000, 64_000_000

#: Bytes of UTF-8 text: A-Z to a-z, what isn't part of a word to a blank.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Search:
    """Shift and bucket tables for the patterns of each length."""

    def __init__(self, patterns: list[bytes]):
        by_length = defaultdict(list)
        for i, p in enumerate(patterns):
            words = tuple(p.split(b" "))
            by_length[len(words)].append((words, i))
        self.tables = [self._table(m, found) for m, found in sorted(by_length.items())]

    @staticmethod
    def _table(m: int, found: list) -> tuple:
        b = min(2, m)
        shift: dict[tuple, int] = {}
        bucket: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
        for words, i in found:
            for at in range(m - b + 1):
                block, left = words[at:at + b], m - b - at
                shift[block] = min(shift.get(block, left), left)
            bucket[words[m - b:]][words[:b]].append((words, i))
        return m, b, shift, {k: dict(v) for k, v in bucket.items()}

    def hits(self, words: list[bytes]):
        """(start, length, pattern) of every occurrence."""
        words = tuple(words)
        n = len(words)
        for m, b, shift, bucket in self.tables:
            skip, end, get = m - b + 1, m, shift.get
            while end <= n:
                block = words[end - b:end]
                step = get(block, skip)
                if step:
                    end += step
                    continue
                start = end - m
                for pattern, i in bucket[block].get(words[start:start + b], ()):
                    if words[start:end] == pattern:
                        yield start, m, i
                end += 1


_BUILT: dict[str, Search] = {}


def _search(key: str, patterns: list[bytes]) -> Search:
    """Built once in a Python worker; the last one is kept."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Search(patterns)
    return _BUILT[key]


def _words(text: str) -> Column:
    """The words of a text column, as DataFrame functions."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")),
                      "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(pattern, item): each different window of each item; the id may be null."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), _words("text").alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return (
        w.select("item", "w", F.explode(starts).alias("at"))
        .select(F.array_join(F.slice("w", F.col("at") + 1, window), " ").alias("pattern"), "item").distinct())


def patterns_of(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pattern, number), staged, and (number, item): the number of a pattern's set of items, and its ids."""
    set_ = ["n", "x1", "x2"]
    known = F.col("item").isNotNull()
    patterns = windows.groupBy("pattern").agg(
        F.count("item").alias("n"), *[F.coalesce(F.bit_xor(F.when(known, F.xxhash64(F.lit(k), "item"))), F.lit(0)).alias(f"x{k}")
                                      for k in (1, 2)])
    sets = stage(patterns.groupBy(*set_).agg(F.min("pattern").alias("one")).withColumn(
        "number", F.monotonically_increasing_id()), "item-sets")
    members = sets.join(windows.where(known), sets["one"] == windows["pattern"]).select("number", "item")
    return stage(patterns.join(sets, set_).select("pattern", "number"), "patterns"), members


def _passes(table: DataFrame, block_patterns: int):
    """Blocks of [(pattern, number)], each of about block_patterns and BLOCK_BYTES at most."""
    count, size = table.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0))).first()
    n = max(-(-count // block_patterns), -(-size // BLOCK_BYTES))
    for i in range(n):
        rows = table if n == 1 else table.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == i)
        yield [(r.pattern.encode(), r.number) for r in rows.toLocalIterator()]


def _marked(docs: DataFrame, patterns: DataFrame, text: str, hit: str, block_patterns: int) -> DataFrame:
    """``docs`` with ``hit``: struct<n_words, spans: array<struct<s, e>>, sets: array<bigint>>."""
    schema = T.StructType([*docs.schema, T.StructField(hit, T.StructType.fromDDL(
        "n_words bigint, spans array<struct<s:bigint,e:bigint>>, sets array<bigint>"))])
    kind = pa.struct([("n_words", pa.int64()),
                      ("spans", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                      ("sets", pa.list_(pa.int64()))])
    out = docs
    columns, first = docs.columns, True
    for block in chain(_passes(patterns, block_patterns), [None]):
        if block is None and not first:
            break
        if not first:
            out = stage(out, "hits")
        shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, block or []))

        def search(batches, shared=shared, add=not first):
            key, block = shared.value
            found = _search(key, [p for p, _ in block])
            for batch in batches:
                texts = batch.column(text).cast(pa.binary()).to_pylist()
                old = batch.column(hit).to_pylist() if add else [None] * len(texts)
                new = []
                for t, before in zip(texts, old):
                    spans = [(x["s"], x["e"]) for x in before["spans"]] if before else []
                    sets = set(before["sets"]) if before else set()
                    words = words_of(t)
                    for s, m, i in found.hits(words):
                        spans.append((s, s + m))
                        sets.add(block[i][1])
                    new.append({"n_words": len(words), "spans": [{"s": s, "e": e} for s, e in _merged(spans)], "sets": sorted(sets)})
                cols = [batch.column(c) for c in columns] + [pa.array(new, kind)]
                yield pa.RecordBatch.from_arrays(cols, names=[*columns, hit])

        out = out.mapInArrow(search, schema)
        first = False
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _n_hit(hit: str) -> Column:
    return F.aggregate(F.col(hit)["spans"], F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])


def _contaminated(hit: str) -> Column:
    return (_n_hit(hit) > 0) & (20 * _n_hit(hit) >= F.col(hit)["n_words"])


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "hits",
                  window: int = WINDOW, block_patterns: int = BLOCK_PATTERNS) -> DataFrame:
    """``docs`` with ``out``: struct<n_words, n_hit, items, contaminated>."""
    hit = free_name(docs, "_hit")
    sets, ids = free_name(docs, "_sets"), free_name(docs, "_items")
    patterns, members = patterns_of(stage(windows_of(benchmark, window), "windows"))
    marked = stage(_marked(docs, patterns, text, hit, block_patterns), "hits").withColumn(sets, F.col(hit)["sets"])
    found = F.size(sets) > 0
    lists = stage(
        marked.where(found).select(sets).distinct().select(sets, F.explode(sets).alias("number")).join(members, "number")
        .groupBy(sets).agg(F.sort_array(F.collect_set("item")).alias(ids)), "item-lists")
    none = F.array().cast("array<string>")
    n = marked.where(~found).withColumn(ids, none).unionByName(
        marked.where(found).join(lists, sets, "left").withColumn(ids, F.coalesce(ids, none)))
    return n.withColumn(out, F.struct(
        F.col(hit)["n_words"].alias("n_words"), _n_hit(hit).alias("n_hit"), F.col(ids).alias("items"),
        _contaminated(hit).alias("contaminated"))).select(*[F.col(f"`{c}`") for c in docs.columns], out)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
          block_patterns: int = BLOCK_PATTERNS) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with its columns."""
    hit = free_name(docs, "_hit")
    patterns, _ = patterns_of(stage(windows_of(benchmark, window), "windows"))
    return _marked(docs, patterns, text, hit, block_patterns).where(~_contaminated(hit)).drop(hit)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = contamination(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"), "hits.contaminated")

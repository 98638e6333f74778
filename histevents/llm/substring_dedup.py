"""Repeated passages by difference-cover anchors.

A window is ``window`` (35) consecutive words.  Every word that a window covers
whose word sequence also starts anywhere else, in the same document or another
one, is removed; windows are judged on the input.

With a difference cover D modulo v, any two positions have an offset below v
that takes both to positions in D (each counted in its own document).  So two
equal windows share an anchor of ``window - v + 1`` words at such positions,
and only those anchors (5 in 21) are hashed and shuffled.  Where an anchor
occurs twice, the match extends: the windows around it, and only they, are
compared by a 96-bit hash of all their words.

Work travels by *chunks*, some megabytes of whole documents, staged once as
compressed words.  A chunk sends each bucket of hashes its different anchors,
packed in one binary value, so a passage that a third of all documents hold
counts once per chunk; the bucket answers each chunk with those of its own
that another chunk has too.  The same is done for the windows.  A bucket holds
about ``bucket_hashes`` hashes, a chunk's answer at most its own hashes: no
step collects a group that grows with the data.

Defined results: null text has no words (like an empty one: nothing kept, the
hash of the empty string); ids may be null or repeated, one output row per
input row, and equal rows repeat each other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from histevents.llm.hashing import BYTE, mix, ranges
from histevents.llm.tables import read, stage

WINDOW = 35
CHUNK_BYTES, BUCKET_HASHES = 2_000_000, 4_000_000

#: FIXED VALUES: perfect difference sets; every remainder modulo the key is a
#: difference of two members.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

CHUNK = "chunk bigint, doc_id array<bigint>, n_words bigint, body binary"
_U = np.uint64


def cover_for(window: int) -> int:
    """The largest period that leaves an anchor at least a third of the window."""
    return max(v for v in COVERS if window - v + 1 >= max(1, window // 3))


class Words:
    """The words of a chunk: hashes, and where each lies in its document."""

    def __init__(self, body: bytes, n_docs: int):
        raw = np.frombuffer(body + b"\n", np.uint8)
        stop = np.flatnonzero((raw == 32) | (raw == 10))
        start = np.r_[0, stop[:-1] + 1]
        doc = np.r_[0, np.cumsum(raw[stop] == 10)[:-1]]
        real = stop > start
        start, stop, self.doc = start[real], stop[real], doc[real]
        self.hash = mix(ranges(BYTE[raw], "byte", start, stop) + (stop - start).astype(np.uint64))
        self.count = np.bincount(self.doc, minlength=n_docs)
        first = np.cumsum(self.count) - self.count
        self.at = np.arange(len(self.doc)) - first[self.doc]
        self.left = self.count[self.doc] - self.at

    def windows(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix(ranges(self.hash, "word", at, at + n))

    def second(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix(ranges(mix(self.hash + _U(1)), "second", at, at + n))

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchors."""
        v = cover_for(window)
        member = np.zeros(v, bool)
        member[list(COVERS[v])] = True
        at = np.flatnonzero(member[self.at % v] & (self.left >= window - v + 1))
        return at, self.windows(at, window - v + 1)

    def candidates(self, window: int, repeated: np.ndarray) -> np.ndarray:
        """Positions of the windows that hold an anchor met elsewhere."""
        v = cover_for(window)
        at, found = self.anchors(window)
        met = np.zeros(len(self.doc) + v + 1, np.int64)
        met[at[_among(found, repeated) | _twice(found)] + 1] = 1
        met = np.cumsum(met)
        p = np.flatnonzero(self.left >= window)
        return p[met[p + v] > met[p]]


def _among(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def _twice(values: np.ndarray) -> np.ndarray:
    """Whether each value occurs more than once."""
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


_PAIR = np.dtype([("a", "<u8"), ("b", "<u4")])


def _pairs(w: Words, at: np.ndarray, window: int) -> np.ndarray:
    out = np.empty(len(at), _PAIR)
    out["a"], out["b"] = w.windows(at, window), w.second(at, window) >> _U(32)
    return out


def _unique_pairs(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different pairs, and for each row its number among them."""
    order = np.lexsort((p["b"], p["a"]))
    s = p[order]
    new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.zeros(0, bool)
    number = np.empty(len(p), np.int64)
    number[order] = np.cumsum(new) - 1
    return s[new], number


# ---- chunks and buckets -----------------------------------------------------

def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, text) as chunks: the words with one blank between them, one line
    per document."""
    def run(batches):
        from pyspark import TaskContext

        number, ids, lines, size, words = TaskContext.get().partitionId() << 33, [], [], 0, 0
        packer = zstandard.ZstdCompressor(level=3)

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([words], pa.int64()), pa.array([packer.compress(b"\n".join(lines))], pa.binary())],
                names=["chunk", "doc_id", "n_words", "body"])

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                own = text.split() if text else []
                ids.append(doc), lines.append(b" ".join(own))
                size, words = size + len(lines[-1]) + 1, words + len(own)
                if size >= chunk_bytes:
                    yield row()
                    number, ids, lines, size, words = number + 1, [], [], 0, 0
        if ids:
            yield row()

    return stage(docs.select("doc_id", "text").mapInArrow(run, CHUNK), "chunks", "none")


def _opened(batches):
    """(chunk, doc ids, body, the answers so far) of every chunk."""
    for b in batches:
        for r in b.to_pylist():
            yield r["chunk"], r["doc_id"], zstandard.decompress(r["body"]), r.get("answers") or []


def _dealt(chunk: int, values: np.ndarray, buckets: int, high: np.ndarray):
    """One row per bucket with the chunk's (sorted, different) values in it."""
    at = np.searchsorted(high, np.arange(1, buckets, dtype=np.uint64) * _U((1 << 64) // buckets)).tolist() if buckets > 1 else []
    cuts = [0, *at, len(values)]
    found = [(i, values[s:e].tobytes()) for i, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s]
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in found], pa.int64()), pa.array([chunk] * len(found), pa.int64()),
         pa.array([x for _, x in found], pa.binary())], names=["bucket", "chunk", "found"])


def _answers(dealt: DataFrame, kind: np.dtype) -> DataFrame:
    """(chunk, answers): of what each chunk sent, what another chunk sent too."""
    def common(table: pa.Table) -> pa.Table:
        chunk, found = table.column("chunk").to_numpy(), table.column("found").to_pylist()
        n = np.array([len(x) // kind.itemsize for x in found])
        values = np.frombuffer(b"".join(found), kind)
        if kind == _PAIR:
            different, number = _unique_pairs(values)
            met = np.bincount(number, minlength=len(different))[number] > 1
        else:
            met = _twice(values)
        ends = np.cumsum(n)
        rows = [(c, values[s:e][met[s:e]].tobytes()) for c, s, e in zip(chunk.tolist(), ends - n, ends) if met[s:e].any()]
        return pa.table({"chunk": pa.array([c for c, _ in rows], pa.int64()),
                         "found": pa.array([x for _, x in rows], pa.binary())})

    met = dealt.groupBy("bucket").applyInArrow(common, "chunk bigint, found binary")
    return met.groupBy("chunk").agg(F.collect_list("found").alias("answers"))


_DEALT = "bucket bigint, chunk bigint, found binary"


def remove_repeats(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES,
                   bucket_hashes: int = BUCKET_HASHES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id,
    text); kept: the words left, with one blank between them."""
    chunks = chunked(docs, chunk_bytes)
    words = chunks.agg(F.sum("n_words")).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, words // bucket_hashes)

    def send_anchors(batches):
        for chunk, ids, body, _ in _opened(batches):
            found = np.unique(Words(body, len(ids)).anchors(window)[1])
            yield _dealt(chunk, found, buckets, found)

    def send_windows(batches):
        for chunk, ids, body, answers in _opened(batches):
            w = Words(body, len(ids))
            at = w.candidates(window, np.sort(np.frombuffer(b"".join(answers), "<u8")))
            found = _unique_pairs(_pairs(w, at, window))[0]
            yield _dealt(chunk, found, buckets, found["a"])

    def finish(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, body = r["doc_id"], zstandard.decompress(r["body"])
                w = Words(body, len(ids))
                at = w.candidates(window, np.sort(np.frombuffer(b"".join(r["answers"] or []), "<u8")))
                different, number = _unique_pairs(_pairs(w, at, window))
                met = np.bincount(number, minlength=len(different)) > 1
                other = np.frombuffer(b"".join(r["matches"] or []), _PAIR)
                if len(other):
                    place = np.searchsorted(different["a"], other["a"])
                    # equal first halves with different second ones are next to each other
                    while len(place):
                        fits = different[np.minimum(place, len(different) - 1)] == other
                        met[place[fits]] = True
                        place, other = place[~fits] + 1, other[~fits]
                starts = at[met[number]]
                cover = np.zeros(len(w.doc) + 1, np.int64)
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + window, -1)
                gone = np.cumsum(cover)[:-1] > 0
                removed = np.bincount(w.doc[gone], minlength=len(ids))
                ends = np.cumsum(w.count)
                kept = body.split(b"\n") if ids else []
                for i in np.flatnonzero(removed).tolist():
                    stay = ~gone[ends[i] - w.count[i]:ends[i]]
                    own = kept[i].split(b" ")
                    kept[i] = b" ".join([own[k] for k in np.flatnonzero(stay).tolist()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(w.count.astype(np.int64)),
                     pa.array(removed.astype(np.int64)), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])

    answers = _answers(chunks.select("chunk", "doc_id", "body").mapInArrow(send_anchors, _DEALT), np.dtype("<u8"))
    met = chunks.select("chunk", "doc_id", "body").join(answers, "chunk", "left")
    matches = _answers(met.mapInArrow(send_windows, _DEALT), _PAIR).withColumnRenamed("answers", "matches")
    return met.join(matches, "chunk", "left").mapInArrow(
        finish, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages that repeat."""
    kept = remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

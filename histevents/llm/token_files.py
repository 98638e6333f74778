"""Token ids in Simple-8b files.

A word of 64 bits holds a selector in its 4 low bits and, above them, as many
values of one width as 60 bits take: SELECTORS lists (count, width).  Selector
0 is an escape: the next word is one value as it is (2^60 and above); selector
1 stands for 120 zeros.  A packed word holds the values low bits first.

A file row (a *segment*) is a run of whole documents of one shard:
  shard, first       shard number, ids of the shard before this segment
  doc_id, n_ids      lists: the documents in order, and their ids with the end id
  block, offset      ids in a block, and for every block its first word (blocks
                     are coded one by one, so a reader decodes them at once)
  words              the words, little-endian
The rows are kept as Parquet files in the order of shards, which is the order
of doc_id (null last); Spark's writer is what reaches every kind of store, and
lost tasks write their files anew.

Documents are range-partitioned by (doc_id, hash of the text, row number): also
a doc_id that a third of all rows share is split.

Defined results: a null text counts as empty and has the end id alone; equal
doc_ids go by text; an empty table gives an empty file and no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from histevents.llm.hashing import BYTE, BYTE2, mix, ranges
from histevents.llm.tables import free_name, read, scratch

END_ID = 2
BLOCK, SEGMENT_IDS = 256, 524_288
CACHE_PIECES = 600_000

#: (count, width) by selector; 0 is the escape, 1 the run of zeros.
SELECTORS = [(1, 64), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
             (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_COUNT = np.array([c for c, _ in SELECTORS])
_WIDTH = np.array([w for _, w in SELECTORS], np.uint64)

SEGMENT = ("shard int, first bigint, doc_id array<bigint>, n_ids array<bigint>, "
           "block int, offset binary, words binary")


# ---- the code ---------------------------------------------------------------

_BITS16 = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _bits(v: np.ndarray) -> np.ndarray:
    """How many bits each value needs."""
    if v.max() < 1 << 16:
        return _BITS16[v]
    need = np.zeros(len(v), np.uint8)
    for part in range(4):
        at = _BITS16[(v >> np.uint64(16 * part)) & np.uint64(0xFFFF)]
        need = np.where(at > 0, at + 16 * part, need).astype(np.uint8)
    return need


def _choices(v: np.ndarray, block_end: np.ndarray) -> np.ndarray:
    """For every position the selector that packs most values from there on."""
    n = len(v)
    out = np.zeros(n, np.uint8)
    room = block_end - np.arange(n)
    widest, reach = _bits(v), 1
    for s in range(len(SELECTORS) - 1, 0, -1):  # more and more values
        count, width = SELECTORS[s]
        while reach < count:  # widest[i]: of v[i:i + reach]
            step = min(reach, count - reach)
            moved = np.full(n, 255, np.uint8)
            moved[:max(n - step, 0)] = widest[step:]
            widest, reach = np.maximum(widest, moved), reach + step
        fits = (widest <= width) & (room >= count)
        if not fits.any():  # nor would more values in fewer bits
            break
        out[fits] = s
    return out


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each block, words) of unsigned 64-bit values."""
    v = np.ascontiguousarray(values, np.uint64)
    n = len(v)
    if not n:
        return np.empty(0, np.uint32), np.empty(0, np.uint64)
    starts = np.arange(0, n, block)
    ends = np.minimum(starts + block, n)
    choice = _choices(v, np.repeat(ends, ends - starts))
    jump = _COUNT[choice]
    at, taken = starts.copy(), []
    while len(at):  # one word of every block that still has values
        taken.append(at)
        at = at + jump[at]
        left = at < ends[taken[-1] // block]
        at = at[left]
    at = np.sort(np.concatenate(taken))
    s = choice[at]
    size = 1 + (s == 0)  # words
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[place] = s
    for k, (count, width) in enumerate(SELECTORS):
        own = np.flatnonzero(s == k)
        if not k:
            words[place[own] + 1] = v[at[own]]
        elif width:
            packed = np.zeros(len(own), np.uint64)
            for i in range(count):
                packed |= v[at[own] + i] << np.uint64(4 + i * width)
            words[place[own]] |= packed
    return place[np.searchsorted(at, starts)].astype(np.uint32), words


def decode(offset: np.ndarray, words: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n values of what ``encode`` made."""
    out = np.empty(n, np.uint64)
    word, at = offset.astype(np.int64), np.arange(0, n, block)
    ends = np.minimum(at + block, n)
    while len(word):  # the next word of every block
        head = words[word]
        s = (head & np.uint64(15)).astype(np.int64)
        for k in np.unique(s).tolist():
            own = s == k
            count, width = SELECTORS[k]
            if not k:
                out[at[own]] = words[word[own] + 1]
                continue
            mask, x = np.uint64((1 << width) - 1), head[own]
            for i in range(count):
                out[at[own] + i] = (x >> np.uint64(4 + i * width)) & mask if width else 0
        at, word = at + _COUNT[s], word + 1 + (s == 0)
        left = at < ends
        at, word, ends = at[left], word[left], ends[left]
    return out


# ---- the tokenizer ----------------------------------------------------------

def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the worker's own copy of a public tokenizer lies."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


#: Classes of bytes of UTF-8 text: 1 letters (A-Z, a-z; U+00C0 to U+027F but
#: for the two signs in it), 2 a blank or an end of line, 3 other ASCII; the
#: rest, 0, makes a text odd: other white space, controls, further scripts.
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 3
_CLASS[[32, 10]] = 2
_CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = 1


class Encoder:
    """Whole texts to ids; each different piece of them is encoded once.

    An even text (ASCII and Latin letters, one blank or end of line between
    words) is cut before each blank or end of line, and where a sign follows a
    letter: the pre-tokenizer always cuts there, so pieces can be encoded
    apart.  Pieces are told apart by two 64-bit hashes, found by numpy for many
    texts at once; known ones give their ids from one array.  Any other text
    goes to the tokenizer as it is.  When more than ``cache`` pieces are known,
    the rare ones are forgotten."""

    def __init__(self, path: str, cache: int = CACHE_PIECES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(path), cache
        self.line = self._ids(["\n"])[0]
        self.apart = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.key, self.slot = np.empty(0, np.uint64), np.empty(0, np.int64)  # sorted by key
        self.second, self.end = np.empty(0, np.uint64), np.zeros(1, np.int64)  # by slot
        self.uses = np.empty(0, np.int64)
        self.ids = np.empty(0, "<u4")

    def _thin(self) -> None:
        """Forget the pieces met once, and more if that leaves over half."""
        least = 2
        while (self.uses >= least).sum() > self.cache // 2:
            least *= 2
        stay = self.uses >= least
        count = np.diff(self.end)
        self.ids = self.ids[np.repeat(stay, count)]
        self.end = np.r_[0, np.cumsum(count[stay])]
        own = stay[self.slot]
        self.key, self.slot = self.key[own], (np.cumsum(stay) - 1)[self.slot[own]]
        self.second, self.uses = self.second[stay], np.ones(stay.sum(), np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each text (UTF-8), as unsigned 32-bit numbers."""
        out: list = [np.empty(0, "<u4")] * len(texts)
        odd = self._odd(texts)
        for i in np.flatnonzero(odd).tolist():
            if texts[i]:
                out[i] = self._ids([texts[i].decode()])[0]
        even = np.flatnonzero(~odd).tolist()
        for i, ids in zip(even, self._even([texts[i] for i in even]) if even else []):
            out[i] = ids
        return out

    def _odd(self, texts: list[bytes | None]) -> np.ndarray:
        sizes = np.array([len(t or b"") for t in texts])
        raw = np.frombuffer(b"".join([t or b"" for t in texts]), np.uint8)
        kind = _CLASS[raw]
        space = kind == 2
        bad = kind == 0
        bad[:-1] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
        bad[1:] |= space[1:] & space[:-1]
        ends = np.cumsum(sizes)
        full = sizes > 0
        bad[ends[full] - 1] |= space[ends[full] - 1]
        bad[(ends - sizes)[full]] |= space[(ends - sizes)[full]]
        odd = ~full
        odd[np.searchsorted(ends, np.flatnonzero(bad), side="right")] = True
        whole = raw.tobytes()
        for t in self.apart:
            if t in whole:
                odd |= np.array([t in (x or b"") for x in texts])
        return odd

    def _even(self, texts: list[bytes]) -> list[np.ndarray]:
        sizes = np.array([len(t) for t in texts])
        body = b"".join(texts)
        raw = np.frombuffer(body, np.uint8)
        kind = _CLASS[raw]
        cut = kind == 2
        cut[1:] |= (kind[1:] == 3) & (kind[:-1] == 1)
        first = np.cumsum(sizes) - sizes
        cut[first] = True
        begin = np.flatnonzero(cut)
        end = np.r_[begin[1:], len(raw)]
        length = (end - begin).astype(np.uint64)
        key = mix(ranges(BYTE[raw], "byte", begin, end) + length)
        piece, at, back, uses = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        begin, end = begin[at], end[at]
        second = mix(ranges(BYTE2[raw], "second", begin, end))
        if len(self.key) > self.cache:
            self._thin()
        found = np.searchsorted(self.key, piece)
        known = np.zeros(len(piece), bool)
        if len(self.key):
            near = np.minimum(found, len(self.key) - 1)
            known = self.key[near] == piece
        new = np.flatnonzero(~known)
        if len(new):
            slots = np.arange(len(new)) + len(self.second)
            self.key = np.insert(self.key, found[new], piece[new])
            self.slot = np.insert(self.slot, found[new], slots)
            self.second = np.concatenate([self.second, second[new]])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
            ids = self._encode([body[b:e] for b, e in zip(begin[new].tolist(), end[new].tolist())])
            self.end = np.concatenate([self.end, self.end[-1] + np.cumsum([len(x) for x in ids])])
            self.ids = np.concatenate([self.ids, *ids])
        slot = self.slot[np.searchsorted(self.key, piece)]
        self.uses[slot] += uses
        if (self.second[slot] != second).any():  # two pieces of one hash
            return self._ids([t.decode() for t in texts])
        start, count = self.end[slot][back], (self.end[slot + 1] - self.end[slot])[back]
        total = np.cumsum(count)
        flat = self.ids[np.repeat(start - (total - count), count) + np.arange(total[-1])]
        return np.split(flat, (total - count)[np.cumsum(cut)[first[1:]] - 1])

    def _encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces.  Many go into one text, with an end of line after each:
        a token of its own, which shows where each piece ends."""
        bare = [p.removeprefix(b"\n").decode() for p in pieces]
        out: list[np.ndarray] = []
        for at in range(0, len(bare), 20_000):
            part = bare[at:at + 20_000]
            ids = self._ids(["\n".join(part) + "\n"])[0]
            ends = np.flatnonzero(ids == self.line[0])
            if len(self.line) == 1 and len(ends) == len(part):
                cuts = zip([0, *(ends[:-1] + 1).tolist()], ends.tolist())
                out += [ids[s:e] for s, e in cuts]
            else:  # not this kind of vocabulary
                out += self._ids(part)
        return [np.r_[self.line, x].astype("<u4") if p[:1] == b"\n" else x for p, x in zip(pieces, out)]


_ENCODER: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The worker's own, kept from task to task."""
    if path not in _ENCODER:
        _ENCODER[path] = Encoder(path)
    return _ENCODER[path]


def _groups(batches, text: str, most: int = 900_000):
    """Lists of (doc_id, text) rows of about ``most`` bytes."""
    held, size = [], 0
    for b in batches:
        for row in zip(b.column("doc_id").to_pylist(), b.column(text).cast(pa.binary()).to_pylist()):
            held.append(row)
            size += len(row[1] or b"")
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def write_ids(docs: DataFrame, name: str = "byte_bpe_50k.json", end_id: int = END_ID,
              segment_ids: int = SEGMENT_IDS, path: str | None = None) -> DataFrame:
    """Encode (doc_id, text), write the files, and return them as a table.

    The files are the product: they lie under ``path``, or in a new folder of
    their own under ``spark.checkpoint.dir``, and nothing here deletes them."""
    def run(batches):
        from pyspark import TaskContext

        encoder = _encoder(tokenizer_path(name))
        shard, first = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        rows: list[tuple] = []
        tail = np.array([end_id], "<u4")

        def flush():
            nonlocal first
            values = np.concatenate(ids)
            offset, words = encode(values, BLOCK)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
                 pa.array([[r[1] for r in rows]], pa.list_(pa.int64())),
                 pa.array([BLOCK], pa.int32()), pa.array([offset.astype("<u4").tobytes()], pa.binary()),
                 pa.array([words.astype("<u8").tobytes()], pa.binary())],
                names=["shard", "first", "doc_id", "n_ids", "block", "offset", "words"])
            first += len(values)
            ids.clear(), rows.clear()
            return out

        for group in _groups(batches, "text"):
            for (doc, _), got in zip(group, encoder([t for _, t in group])):
                ids += [got, tail]
                rows.append((doc, len(got) + 1))
            if sum(r[1] for r in rows) >= segment_ids:
                yield flush()
        if rows:
            yield flush()

    spark = docs.sparkSession
    own, row = docs.select("doc_id", "text"), free_name(docs, "_row")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col(row)]
    dealt = own.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(n, *order)
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text")
    path = path or scratch(spark, "token-ids")
    dealt.select("doc_id", "text").mapInArrow(run, SEGMENT).write.option("compression", "none").parquet(path)
    return spark.read.schema(SEGMENT).parquet(path)


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the files.

    One number per shard, of which there are as many as shuffle partitions,
    says what lies before it; the segments need no shuffle."""
    sizes = files.groupBy("shard").agg(F.sum(F.aggregate("n_ids", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = sizes.select("shard", F.coalesce(
        F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                sizes = np.array(r["n_ids"], np.int64)
                ids = decode(np.frombuffer(r["offset"], "<u4"), np.frombuffer(r["words"], "<u8"), int(sizes.sum()), r["block"])
                ids, ends = ids.astype("<u4"), np.cumsum(sizes)
                starts = ends - sizes
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_id"], pa.int64()), pa.array(starts + r["first"] + r["before"]),
                     pa.array(sizes), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.join(F.broadcast(before), "shard").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids and give a digest of what the files hold."""
    return read_ids(write_ids(read(spark, sf_dir, "documents", "doc_id", "text")))

"""Hard negatives by bounds along a spanning tree of the anchors.

Vectors are quantised to integers, and a row's score with an anchor is their
inner product.  An anchor's positives are its best rows of its own label; for
each positive the hard negatives are the best rows of other labels whose score
lies in a window below the positive's: low * p <= 100 * score <= 100 * p.

Anchors of one label and length are packed in blocks with a minimum spanning
tree of their distances.  A block meets a chunk of candidates: the root's scores
are computed; along an edge of length e the score of a candidate c changes by
e * |c| at most, so a child's score lies in the parent's interval widened by
that.  Only candidates whose interval overlaps what the child still looks for
(the windows, and the scores found so far) are scored again, and their interval
becomes that score.  Integer scores are exact, so the bounds lose nothing.

All candidates are dealt to chunks by a hash, so no label or id decides a
chunk's size; chunks have at most ``CHUNK_BYTES``.  Every block is sent to every
chunk, candidates are shuffled once for the positives and once for the
negatives, and of an anchor and a chunk only the best few leave a task.

Defined results: a row takes no part if its label or vector is null, or the
vector holds a null or non-finite component; vectors of other lengths than the
anchor's don't compare; a null id comes after all others in ties and is no
anchor; repeated rows are rows of their own (each is an anchor, positive or
negative of its own); an anchor without positives, and a positive with a
negative score, has no negatives; scores beyond 64 bits are an error; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from histevents.llm.tables import read, stage

SCALE, POSITIVES, NEGATIVES, LOW = 256, 5, 5, 80
ANCHORS, ROWS, CHUNK_BYTES = 128, 8192, 64 << 20
EXACT = 2.0 ** 53

VECTOR = "row bigint, vec_id bigint, label bigint, anchor boolean, dim int, place double, data binary"
BLOCK = "dim int, label bigint, data binary, tree binary, anchors binary, wanted binary"


def _quantised(scale: int):
    """Integer vectors as bytes (4 a component if they fit, else 8), and a place
    on a line on which near vectors are near."""
    lines: dict[int, np.ndarray] = {}

    def run(batches):
        for b in batches:
            data, place, dims = [], [], []
            for v in b.column("v").to_pylist():
                q = np.floor(scale * np.array(v, np.float64))
                d = len(q)
                if d not in lines:
                    lines[d] = np.random.default_rng(d).standard_normal(d)
                data.append(q.astype("<i4" if d and np.abs(q).max() < 2 ** 31 else "<f8").tobytes())
                place.append(float(q @ lines[d] / max(np.linalg.norm(q), 1)))
                dims.append(d)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("row", "vec_id", "label", "anchor")], pa.array(dims, pa.int32()),
                 pa.array(place, pa.float64()), pa.array(data, pa.binary())],
                names=["row", "vec_id", "label", "anchor", "dim", "place", "data"])
    return run


def vectors_of(table: DataFrame, is_anchor: Column, label: Column, scale: int = SCALE) -> DataFrame:
    """The usable rows of ``table`` (vec_id, embedding, label), staged."""
    own = table.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), label.alias("label"),
                       F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    usable = "label is not null and v is not null and forall(v, x -> x is not null and abs(x) < double('infinity'))"
    own = own.where(usable).withColumn("row", F.monotonically_increasing_id())
    return stage(own.select("row", F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                            "anchor", "v").mapInArrow(_quantised(scale), VECTOR), "hard-vectors")


def _matrix(data: list[bytes], dim: int) -> np.ndarray:
    """Rows of one length: int32 where all of them have 4 bytes a component."""
    if not dim:
        return np.zeros((len(data), 0))
    if len({len(x) for x in data}) == 1 and len(data[0]) == 4 * dim:
        return np.frombuffer(b"".join(data), "<i4").reshape(-1, dim)
    return np.stack([np.frombuffer(x, "<i4" if len(x) == 4 * dim else "<f8").astype(np.float64) for x in data])


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree of the rows of x, by
    distance, from row 0; a row comes after its parent."""
    n = len(x)
    order, parent, edge = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    near, via = np.full(n, np.inf), np.zeros(n, np.int64)
    left, at = np.ones(n, bool), 0
    for k in range(n):
        order[k], left[at] = at, False
        parent[at], edge[at] = via[at], near[at] if k else 0.0
        d = np.linalg.norm(x - x[at], axis=1)
        closer = left & (d < near)
        near[closer], via[closer] = d[closer], at
        if k + 1 < n:
            at = int(np.argmin(np.where(left, near, np.inf)))
    return order, parent, edge


def _packed(batches):
    """Blocks of anchors, in the order they come: one label and length each."""
    held: list = []

    def block():
        dim, label = held[0][:2]
        x = _matrix([r[2] for r in held], dim).astype(np.float64)
        order, parent, edge = spanning_tree(x)
        wanted = np.array([[len(r[4]), *r[4]] + [0] * (max(len(q[4]) for q in held) - len(r[4])) for r in held], "<i8")
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([label], pa.int64()), pa.array([x.astype("<f8").tobytes()]),
             pa.array([order.astype("<i8").tobytes() + parent.astype("<i8").tobytes() + edge.astype("<f8").tobytes()]),
             pa.array([np.array([r[3] for r in held], "<i8").tobytes()]), pa.array([wanted.tobytes()])],
            names=["dim", "label", "data", "tree", "anchors", "wanted"])

    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in ("dim", "label", "data", "row", "wanted"))):
            if held and (held[0][:2] != r[:2] or len(held) == ANCHORS):
                yield block()
                held.clear()
            held.append(r)
    if held:
        yield block()


class _Best:
    """The best ``k`` (score, position), higher scores first, then positions."""

    def __init__(self, k: int):
        self.k, self.score, self.at, self.least = k, np.empty(0, np.int64), np.empty(0, np.int64), -np.inf

    def add(self, score: np.ndarray, at: np.ndarray) -> None:
        score, at = np.concatenate([self.score, score]), np.concatenate([self.at, at])
        if len(score) > self.k:
            if score.dtype == object:
                order = sorted(range(len(score)), key=lambda i: (-score[i], at[i]))[:self.k]
            else:
                near = np.flatnonzero(score >= np.partition(score, len(score) - self.k)[-self.k])
                order = near[np.lexsort((at[near], -score[near]))[:self.k]]
            score, at = score[order], at[order]
            self.least = float(score[-1])
        elif len(score) == self.k:
            self.least = float(score.min())
        self.score, self.at = score, at


class _Chunk:
    """Candidates of one length, ordered by label and id."""

    def __init__(self, rows: list, dim: int):
        self.row, self.vec_id, self.no_id, label = (np.concatenate([r[i] for r in rows]) for i in range(4))
        self.x = np.concatenate([r[4] for r in rows])
        order = np.lexsort((self.row, self.vec_id, self.no_id, label))
        self.row, self.vec_id, self.no_id, self.label = self.row[order], self.vec_id[order], self.no_id[order], label[order]
        self.x = self.x[order]
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.x.astype(np.float64), self.x.astype(np.float64)))
        # ties go by id, whatever the label
        self.tie = np.empty(len(order), np.int64)
        self.tie[np.lexsort((self.row, self.vec_id, self.no_id))] = np.arange(len(order))

    def ranges(self, label: int, same: bool):
        a, b = np.searchsorted(self.label, [label, label + 1])
        for s, e in ([(a, b)] if same else [(0, a), (b, len(self.label))]):
            for at in range(int(s), int(e), ROWS):
                yield at, min(at + ROWS, int(e))


def _scores(x: np.ndarray, a: np.ndarray, safe: bool) -> np.ndarray:
    if safe:  # every sum is below 2**53, so doubles hold it exactly
        return (x @ a).astype(np.int64)
    return np.array([sum(int(p) * int(q) for p, q in zip(v, a)) for v in x.tolist()], object)


def _walk(c: _Chunk, label: int, a: np.ndarray, tree, anchors: np.ndarray, wanted, low: int, k: int):
    """The best of a chunk for every anchor of a block: per anchor one ``_Best``
    of positives, or one for each wanted positive score."""
    order, parent, edge = tree
    slack = edge * (1 + 1e-9) + 1e-6
    same = wanted is None
    best = [[_Best(k)] if same else [_Best(k) for _ in w] for w in (anchors if same else wanted)]
    safe_norm = np.linalg.norm(a, axis=1).max(initial=0) * (c.norm.max(initial=0) + 1)
    safe = bool(safe_norm < EXACT / 256)
    for s, e in c.ranges(label, same):
        x, norm, tie = c.x[s:e].astype(np.float64), c.norm[s:e], c.tie[s:e]
        high, less = np.empty((len(a), e - s)), np.empty((len(a), e - s))
        for i in order.tolist():
            p = parent[i]
            if i == p:
                near = np.arange(e - s)
            else:
                wide = slack[i] * norm
                np.add(high[p], wide, out=high[i])
                np.subtract(less[p], wide, out=less[i])
                if same:
                    least = best[i][0].least
                    if e - s > k + 1:  # one of the k + 1 best lower bounds may be the anchor itself
                        least = max(least, np.partition(less[i], e - s - k - 1)[e - s - k - 1])
                    near = np.flatnonzero(high[i] >= least)
                else:
                    over = np.zeros(e - s, bool)
                    for w, b in zip(wanted[i], best[i]):
                        if w >= 0:
                            over |= (high[i] >= max(low * w / 100 - 1, b.least)) & (less[i] <= w)
                    near = np.flatnonzero(over)
            if not len(near):
                continue
            score = _scores(x if len(near) == e - s else x[near], a[i], safe)
            high[i][near] = less[i][near] = score.astype(np.float64)
            if not safe:  # large scores are rounded: keep the bounds bounds
                room = np.abs(high[i][near]) * 1e-12 + 1
                high[i][near] += room
                less[i][near] -= room
            if same:
                other = c.row[s:e][near] != anchors[i]
                best[i][0].add(score[other], tie[near][other])
            else:
                for w, b in zip(wanted[i], best[i]):
                    inside = (100 * score >= low * w) & (score <= w)
                    if w >= 0 and inside.any():
                        b.add(score[inside], tie[near][inside])
    return best


def _search(same: bool, low: int, k: int):
    """Candidates of a chunk (kind 0), then the blocks (kind 1), streamed."""
    names = ["anchor_row", "number", "score", "vec_id", "row"]

    def run(batches):
        chunk, held, ready = None, {}, None
        for b in batches:
            columns = {c: b.column(c).to_pylist() for c in ("chunk", "kind", "row", "vec_id", "label", "dim", "data",
                                                          "tree", "anchors", "wanted")}
            key = np.array([columns["chunk"], columns["kind"], columns["dim"]], np.int64)
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                if s == e:
                    continue
                if columns["chunk"][s] != chunk:
                    chunk, held, ready = columns["chunk"][s], {}, {}
                dim = columns["dim"][s]
                if columns["kind"][s] == 0:
                    ids = columns["vec_id"][s:e]
                    held.setdefault(dim, []).append((
                        np.array(columns["row"][s:e], np.int64), np.array([x or 0 for x in ids], np.int64),
                        np.array([x is None for x in ids]), np.array(columns["label"][s:e], np.int64),
                        _matrix(columns["data"][s:e], dim)))
                    continue
                if dim not in held:
                    continue
                if dim not in ready:
                    ready[dim] = _Chunk(held[dim], dim)
                for i in range(s, e):
                    got = _of_block(ready[dim], {n: v[i] for n, v in columns.items()}, same, low, k)
                    if got:
                        yield pa.RecordBatch.from_arrays(got, names=names)
    return run


def _of_block(c: _Chunk, r: dict, same: bool, low: int, k: int):
    anchors = np.frombuffer(r["anchors"], "<i8")
    n = len(anchors)
    a = np.frombuffer(r["data"], "<f8").reshape(n, r["dim"])
    order, parent = np.frombuffer(r["tree"], "<i8", 2 * n).reshape(2, n)
    wanted = None
    if not same:
        table = np.frombuffer(r["wanted"], "<i8").reshape(n, -1)
        wanted = [[int(x) for x in w[1:1 + w[0]]] for w in table]
    found = _walk(c, r["label"], a, (order, parent, np.frombuffer(r["tree"], "<f8", n, 16 * n)), anchors, wanted, low, k)
    of_tie = np.empty(len(c.tie), np.int64)
    of_tie[c.tie] = np.arange(len(c.tie))
    rows = [(int(anchors[i]), j, b.score, of_tie[b.at]) for i, bs in enumerate(found) for j, b in enumerate(bs) if len(b.at)]
    if not rows:
        return None
    sizes, at = [len(x[2]) for x in rows], np.concatenate([x[3] for x in rows])
    return [pa.array(np.repeat([x[0] for x in rows], sizes), pa.int64()),
            pa.array(np.repeat([x[1] for x in rows], sizes), pa.int32()),
            pa.array([int(y) for x in rows for y in x[2]], pa.int64()),
            pa.array(c.vec_id[at], pa.int64(), mask=c.no_id[at]), pa.array(c.row[at], pa.int64())]


def _blocks(anchors: DataFrame) -> DataFrame:
    """``anchors`` (vectors with ``wanted``) packed with their trees."""
    n = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["dim", "label", "place", "row"]
    return anchors.select(*order, "data", "wanted").repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        _packed, BLOCK)


def _best_of(vectors: DataFrame, blocks: DataFrame, chunks: int, same: bool, low: int, k: int) -> DataFrame:
    """(anchor_row, number, rank, score, vec_id, row): the best ``k`` of all chunks."""
    own = vectors.select(
        F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk"), F.lit(0).alias("kind"), "row", "vec_id", "label", "dim",
        "data", *(F.lit(None).cast("binary").alias(c) for c in ("tree", "anchors", "wanted")))
    dealt = blocks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"), F.lit(1).alias("kind"),
        *(F.lit(None).cast("long").alias(c) for c in ("row", "vec_id")), "label", "dim", "data", "tree", "anchors", "wanted")
    found = own.unionByName(dealt).repartitionById(chunks, F.col("chunk").cast("int")).sortWithinPartitions(
        "chunk", "kind", "dim").mapInArrow(_search(same, low, k),
                                           "anchor_row bigint, number int, score bigint, vec_id bigint, row bigint")
    rank = F.row_number().over(W.partitionBy("anchor_row", "number").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last(), "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(table: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, scale: int = SCALE,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    of the anchors of ``table`` (vec_id, embedding, label)."""
    spark = table.sparkSession
    vectors = vectors_of(table, is_anchor, label, scale)
    size = vectors.agg(F.sum(F.octet_length("data") + F.lit(32))).first()[0] or 0
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + int(size) // chunk_bytes)
    anchors = vectors.where("anchor")
    blocks = _blocks(anchors.withColumn("wanted", F.array().cast("array<bigint>")))
    best = stage(_best_of(vectors, blocks, chunks, True, low, positives).select(
        "anchor_row", F.col("rank").alias("of"), F.col("score").alias("positive_score"),
        F.col("vec_id").alias("positive_id")), "hard-positives")
    # at most ``positives`` rows an anchor
    wanted = best.groupBy(F.col("anchor_row").alias("row")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("of", "positive_score"))), lambda x: x.positive_score).alias("wanted"))
    blocks = _blocks(anchors.join(wanted, "row"))
    found = _best_of(vectors, blocks, chunks, False, low, negatives).select(
        "anchor_row", (F.col("number") + 1).alias("of"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return found.join(best, ["anchor_row", "of"]).join(ids, "anchor_row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 100; ids divisible by 7 get a wrong label first."""
    table = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table, F.col("vec_id") % 100 == 0, label)

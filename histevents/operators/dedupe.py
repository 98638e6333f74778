"""Exact dedupe and near-duplicate detection.

* ``first_wins_dedupe``: keep the first row (lowest ordering key) per event
  hash.  Written as a grouped ``min_by(row, order key)``, so each map task
  ships at most one row per hash (partial aggregation): a hash holding a
  third of all rows costs no more than any other.
* ``near_duplicate_pairs``: the self-join "same year, e1.id < e2.id, trigram
  similarity > 0.8" as an exact prefix-filtered set-similarity join:
  rows with identical trigram sets are first collapsed into one signature
  group, candidates are generated only from each signature's rarest
  ``n - floor(4n/5)`` trigrams (equi-join on year + trigram), filtered by
  size and position, verified with integers, and only then expanded back to
  row pairs.  A trigram that many signatures share is dealt to blocks.
  Verification work is per distinct signature pair, never per row pair;
  the expansion of a large group is split into hashed blocks.
* ``near_duplicate_count``: the number of such pairs computed from group
  sizes (k*(k-1)/2 inside a signature, k_a*k_b across), so reports never
  materialise the pair list.
* ``near_duplicate_text_pairs``: the same pairs for long texts.  A long text's
  rarest trigrams are shared by much of its group, so a prefix saves little
  there and its rows are many times the input.  Instead each class of equal
  trigram sets is one row with its ids (several rows, if it is large), dealt to
  blocks by size, and the blocks that sizes allow are compared whole, pair by
  pair of blocks, by products of their 0/1 matrices; pairs of ids are listed
  where they are found, part by part, and not shuffled.
* ``near_duplicate_links``: the same comparison, a row per text with its class
  and its number of links; pairs are only counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histevents import lexicons as L
from histevents.functions.scalars import event_hash
from histevents.functions.text import trigram_text, trigrams
from histevents.session import staged

NUM, DEN = L.NEAR_DUPLICATE_THRESHOLD  # similarity > NUM/DEN


def with_event_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("event_hash", event_hash("year", "title", "source"))


def first_wins_dedupe(df: DataFrame, key: str = "event_hash", order_cols=("seq",)) -> DataFrame:
    """Keep, per ``key``, the row with the smallest ``order_cols`` tuple."""
    order_cols = list(order_cols)
    rest = [c for c in df.columns if c != key]
    order = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)])
    best = df.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_best"))
    cols = [F.col(key)] + [F.col(f"_best.{c}").alias(c) for c in rest]
    return best.select(*cols).select(*df.columns)


def anti_join_store(new: DataFrame, store: DataFrame, key: str = "event_hash") -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``store`` (append-only refresh)."""
    return new.join(store.select(key), key, "left_anti")


# ------------------------------------------------------------ near duplicates

def _signatures(events: DataFrame, id_col: str, text_col: str, group_col: str) -> tuple[DataFrame, DataFrame]:
    """(members, sigs): members(id, group, sig) and one row per (group, sig)
    with its trigram set, size and member count.

    Rows are first pre-aggregated to distinct (group, lower-cased text) with
    a partial count, so trigrams are computed once per distinct text after
    the shuffle, never per row (and never inside the scan task).
    """
    base = events.select(F.col(id_col).alias("_id"), F.col(group_col).alias("_g"),
                         F.lower(F.col(text_col)).alias("_norm"))
    # "has a letter or digit" == "has a trigram"; the cheap form is the one
    # the optimizer may push below the aggregate into the scan.
    base = base.filter(F.col("_norm").rlike(r"[\p{L}\p{N}]"))
    texts = base.groupBy("_g", "_norm").agg(F.count(F.lit(1)).alias("_k"))
    texts = texts.withColumn("_tri", F.sort_array(trigrams(F.col("_norm"))))
    texts = texts.withColumn("_n", F.size("_tri"))
    texts = texts.withColumn("_sig", F.sha2(F.array_join("_tri", "\u0001"), 256))
    # size of each signature group, over the small distinct-text table, so
    # members learn it through the join they need anyway
    texts = texts.withColumn("_sig_k", F.sum("_k").over(Window.partitionBy("_g", "_sig")))
    # members, signatures, candidates and verification all read these
    texts = staged(texts, "signatures")
    members = (base.join(texts.select("_g", "_norm", "_sig", "_sig_k"), ["_g", "_norm"])
               .select("_id", "_g", "_sig", "_sig_k"))
    sigs = (texts.groupBy("_g", "_sig")
            .agg(F.first("_tri").alias("_tri"), F.sum("_k").alias("_k"), F.first("_n").alias("_n")))
    return members, sigs


TOKEN_BLOCK = 4096  # signatures per block of a candidate key


def _candidate_sides(sigs: DataFrame, block: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of the candidate join and its key: (group, trigram, size
    class, blocks).  A row has its signature, its size and the position ``r``
    of the trigram in the signature's order, rarest of the group first.

    A trigram of more signatures than ``block`` is dealt to blocks on either
    side, both in the key, so a key holds about ``block`` signatures a side
    however many share the trigram."""
    tok = sigs.select("_g", "_sig", "_n", F.explode("_tri").alias("_tok"))
    freq = tok.groupBy("_g", "_tok").agg(F.count(F.lit(1)).alias("_df"))
    # prefix length: a match must share > NUM/DEN of the n trigrams
    prefix_len = F.col("_n") - F.floor(F.col("_n") * NUM / DEN)
    w = Window.partitionBy("_g", "_sig").orderBy("_df", "_tok")  # a signature's own trigrams
    prefix = (tok.join(freq, ["_g", "_tok"]).withColumn("_r", F.row_number().over(w))
              .filter(F.col("_r") <= prefix_len))
    # sizes of a match differ by DEN/NUM at most: equal or neighbouring size
    # classes, which are part of the key (each pair meets in sig_a's class)
    size_class = F.floor(F.log(F.col("_n").cast("double")) / F.lit(math.log(DEN / NUM)))
    blocks = F.greatest(F.ceil(F.col("_df") / F.lit(block)), F.lit(1)).cast("int")
    prefix = prefix.withColumn("_nb", blocks).withColumn("_own", F.pmod(F.xxhash64("_sig"), F.col("_nb")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    a = prefix.select("_g", "_tok", size_class.alias("_c"), F.col("_sig").alias("sig_a"), F.col("_n").alias("n_a"),
                      F.col("_r").alias("r_a"), F.col("_own").alias("_ba"), others.alias("_bb"))
    b = prefix.select("_g", "_tok", F.col("_sig").alias("sig_b"), F.col("_n").alias("n_b"), F.col("_r").alias("r_b"),
                      F.col("_own").alias("_bb"), F.col("_nb"),
                      F.explode(F.array(size_class - 1, size_class, size_class + 1)).alias("_c"))
    b = b.withColumn("_ba", others).drop("_nb")
    return a, b, ["_g", "_tok", "_c", "_ba", "_bb"]


def _similar_signature_pairs(sigs: DataFrame, block: int | None = None) -> DataFrame:
    """Distinct signature pairs (a < b, same group) with similarity > NUM/DEN.

    Both filters are upper bounds of the overlap, so they lose nothing.  Length:
    the smaller size bounds it.  Position: shared trigrams up to the last one
    shared in both prefixes were all counted, and after it no more can follow
    than either side has left."""
    a, b, key = _candidate_sides(sigs, block or TOKEN_BLOCK)
    need = (F.col("n_a") + F.col("n_b")) * NUM  # overlap * (DEN + NUM) must exceed it
    cand = (a.join(b, key)
            .filter((F.col("sig_a") < F.col("sig_b")) & (F.least("n_a", "n_b") * (DEN + NUM) > need))
            .groupBy("_g", "sig_a", "sig_b", "n_a", "n_b")
            .agg(F.count(F.lit(1)).alias("_met"), F.max("r_a").alias("r_a"), F.max("r_b").alias("r_b"))
            .filter((F.col("_met") + F.least(F.col("n_a") - F.col("r_a"), F.col("n_b") - F.col("r_b"))) * (DEN + NUM) > need)
            .select("_g", "sig_a", "sig_b"))
    sa = sigs.select("_g", F.col("_sig").alias("sig_a"), F.col("_tri").alias("tri_a"), F.col("_k").alias("k_a"))
    sb = sigs.select("_g", F.col("_sig").alias("sig_b"), F.col("_tri").alias("tri_b"), F.col("_k").alias("k_b"))
    inter = F.size(F.array_intersect("tri_a", "tri_b"))
    union = F.size("tri_a") + F.size("tri_b") - inter
    return (cand.join(sa, ["_g", "sig_a"]).join(sb, ["_g", "sig_b"])
            .filter(inter * DEN > union * NUM)
            .select("_g", "sig_a", "sig_b", "k_a", "k_b"))


def near_duplicate_pairs(events: DataFrame, id_col: str = "id", text_col: str = "title",
                         group_col: str = "year", block: int | None = None,
                         token_block: int | None = None) -> DataFrame:
    """(id, duplicate_id) pairs: same group, id < duplicate_id, similarity > 0.8."""
    block = block or BLOCK
    members, sigs = _signatures(events, id_col, text_col, group_col)
    pairs = _similar_signature_pairs(sigs, token_block)
    return _pairs_across_groups(members, sigs, pairs, block).unionByName(
        _pairs_inside_groups(members, sigs, block))


BLOCK = 1000  # members per block when a signature group is expanded into pairs


def _blocked_members(members: DataFrame, sigs: DataFrame, block: int) -> DataFrame:
    """members + (_nb blocks of the member's signature, _blk its block); the
    group size arrives with the member (no extra join)."""
    nb = F.greatest(F.ceil(F.col("_sig_k") / F.lit(block)), F.lit(1)).cast("int")
    return members.withColumn("_nb", nb).withColumn("_blk", F.pmod(F.xxhash64("_id"), F.col("_nb")).cast("int"))


def _pairs_across_groups(members: DataFrame, sigs: DataFrame, pairs: DataFrame, block: int) -> DataFrame:
    """Member pairs of two similar signatures (k_a x k_b rows by definition).
    Each side is replicated once per block of the other side, so every final
    join key (signature pair, block pair) holds at most about ``block``
    members per side: no task receives a whole hot group."""
    m = _blocked_members(members, sigs, block)
    nb = lambda k: F.greatest(F.ceil(F.col(k) / F.lit(block)), F.lit(1)).cast("int")
    bp = pairs.select("_g", "sig_a", "sig_b", nb("k_a").alias("nb_a"), nb("k_b").alias("nb_b"))
    ma = m.select("_g", F.col("_sig").alias("sig_a"), F.col("_blk").alias("ba"), F.col("_id").alias("id_a"))
    mb = m.select("_g", F.col("_sig").alias("sig_b"), F.col("_blk").alias("bb"), F.col("_id").alias("id_b"))
    left = (bp.join(ma, ["_g", "sig_a"])
            .select("_g", "sig_a", "sig_b", "ba", "id_a", F.explode(F.sequence(F.lit(0), F.col("nb_b") - 1)).alias("bb")))
    right = (bp.join(mb, ["_g", "sig_b"])
             .select("_g", "sig_a", "sig_b", "bb", "id_b", F.explode(F.sequence(F.lit(0), F.col("nb_a") - 1)).alias("ba")))
    return (left.join(right, ["_g", "sig_a", "sig_b", "ba", "bb"])
            .select(F.least("id_a", "id_b").alias("id"), F.greatest("id_a", "id_b").alias("duplicate_id")))


def _pairs_inside_groups(members: DataFrame, sigs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every member pair of each signature group (identical trigram sets,
    similarity 1).  The result has k*(k-1)/2 rows per group by definition;
    the work is split so that no task holds a whole hot group: members are
    hashed into ceil(k / block) blocks and each block pair (i <= j) is its
    own join key, so a task joins at most about block x block members."""
    m = _blocked_members(members, sigs, block)
    # both blocks are in the key: a member goes to every pair that its own
    # block is in, on the left as the lower block and on the right as the higher
    left = m.select("_g", "_sig", F.col("_blk").alias("_bi"), F.col("_id").alias("_a"),
                    F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1)).alias("_bj"))
    right = m.select("_g", "_sig", F.col("_blk").alias("_bj"), F.col("_id").alias("_b"),
                     F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_bi"))
    pairs = left.join(right, ["_g", "_sig", "_bi", "_bj"])
    keep = (F.col("_bi") < F.col("_bj")) | (F.col("_a") < F.col("_b"))
    return pairs.filter(keep).select(F.least("_a", "_b").alias("id"), F.greatest("_a", "_b").alias("duplicate_id"))


def _listing(events: DataFrame, pairs: DataFrame) -> DataFrame:
    e1 = events.select("id", "title", "year", "source")
    e2 = events.select(F.col("id").alias("duplicate_id"), F.col("title").alias("duplicate_title"),
                       F.col("source").alias("duplicate_source"))
    return (pairs.join(e1, "id").join(e2, "duplicate_id")
            .select("id", "title", "year", "source", "duplicate_id", "duplicate_title", "duplicate_source")
            .orderBy("year", "title", "id", "duplicate_id"))


def near_duplicates(events: DataFrame) -> DataFrame:
    """The duplicate report rows: original id/title/year/source and the
    duplicate's id/title/source, ordered by year, title."""
    return _listing(events, near_duplicate_pairs(events))


def _count(sigs: DataFrame, pairs: DataFrame) -> DataFrame:
    inside = sigs.select((F.col("_k") * (F.col("_k") - 1) / 2).cast("long").alias("_pairs"))
    across = pairs.select((F.col("k_a") * F.col("k_b")).cast("long").alias("_pairs"))
    return inside.unionByName(across).agg(
        F.coalesce(F.sum("_pairs"), F.lit(0)).cast("long").alias("duplicate_count"))


def near_duplicate_count(events: DataFrame, id_col: str = "id", text_col: str = "title",
                         group_col: str = "year") -> DataFrame:
    """One row ``duplicate_count`` = number of near-duplicate pairs, from group
    sizes only.  Assumes ids are unique."""
    _, sigs = _signatures(events, id_col, text_col, group_col)
    return _count(sigs, _similar_signature_pairs(sigs))


def duplicate_detection(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``near_duplicates``, ``near_duplicate_count``) of events (id, title, year,
    source), from signatures and similar pairs that are made once."""
    members, sigs = _signatures(events, "id", "title", "year")
    similar = staged(_similar_signature_pairs(sigs), "similar-signatures")
    pairs = _pairs_across_groups(members, sigs, similar, BLOCK).unionByName(_pairs_inside_groups(members, sigs, BLOCK))
    return _listing(events, pairs), _count(sigs, similar)


CLASS_BLOCK = 8192  # classes (for pairs: texts) per block that are compared whole
UNIT = 256  # texts of a class, about, that travel in one row with their ids
LISTED = 1 << 18  # pairs that a task lists at a time
LEFT_ROWS, RIGHT_ROWS, COLUMNS = 256, 1024, 8192  # of the matrices multiplied at a time


def _dense(rows: np.ndarray, cols: np.ndarray, n_rows: int, lo: int, hi: int) -> np.ndarray:
    """The 0/1 matrix of the columns lo to hi."""
    out = np.zeros((n_rows, hi - lo), np.float32)
    inside = (cols >= lo) & (cols < hi)
    out[rows[inside], cols[inside] - lo] = 1
    return out


def _similar_rows(t: pa.Table, first: int, second: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of two blocks with similarity > NUM/DEN, part by part: rows of the
    first, rows of the second, and the matrix of who is similar to whom.  No pair
    comes twice, also where both blocks are the same."""
    order = np.argsort(t["_n"].to_numpy(), kind="stable")
    n, own = (t[c].to_numpy()[order] for c in ("_n", "_own"))
    ends = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))

    def grams(at: int) -> np.ndarray:  # of the next rows, a number each
        some = "".join(t["_tri"].take(order[at:at + LEFT_ROWS]).to_pylist())
        c = np.frombuffer(some.encode("utf-32-le"), "<u4").reshape(-1, 3).astype(np.int64)
        return c[:, 0] << 42 | c[:, 1] << 21 | c[:, 2]

    known = np.empty(0, np.int64)
    for x in range(0, len(n), LEFT_ROWS):
        known = np.union1d(known, grams(x))
    cols = np.empty(ends[-1], np.int32)
    for x in range(0, len(n), LEFT_ROWS):
        cols[ends[x]:ends[min(x + LEFT_ROWS, len(n))]] = np.searchsorted(known, grams(x))
    place = np.full(len(known), -1, np.int32)
    left, right = np.flatnonzero(own == first), np.flatnonzero(own == second)

    def entries(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = np.concatenate([cols[ends[r]:ends[r + 1]] for r in at])
        return np.repeat(np.arange(len(at), dtype=np.int32), n[at]), found

    for x in range(0, len(left), LEFT_ROWS):
        a = left[x:x + LEFT_ROWS]
        rows_a, cols_a = entries(a)
        used = np.unique(cols_a)
        place[used] = np.arange(len(used))
        lo, hi = (np.searchsorted(n[right], v, side) for v, side in (
            (n[a[0]] * NUM // DEN, "right"), (-(-n[a[-1]] * DEN // NUM), "left")))  # sizes that can match
        lo = max(lo, x) if first == second else lo
        matrices = [_dense(rows_a, place[cols_a], len(a), s, min(s + COLUMNS, len(used)))
                    for s in range(0, len(used), COLUMNS)]
        for y in range(lo, hi, RIGHT_ROWS):
            b = right[y:min(y + RIGHT_ROWS, hi)]
            rows_b, cols_b = entries(b)
            cols_b, shared = place[cols_b], 0
            for s, m in zip(range(0, len(used), COLUMNS), matrices):
                shared = shared + m @ _dense(rows_b, cols_b, len(b), s, s + m.shape[1]).T
            hit = shared.astype(np.int64) * (DEN + NUM) > (n[a][:, None].astype(np.int64) + n[b]) * NUM
            if first == second:
                hit &= a[:, None] < b
            yield order[a], order[b], hit
        place[used] = -1


def _block_links(key: tuple, t: pa.Table) -> pa.Table:
    """(_g, _sig, _links) of the classes of two blocks: the members of the other
    block's classes (or of others of the same block) with similarity > NUM/DEN."""
    t = t.select(["_g", "_sig", "_tri", "_n", "_k", "_own"])
    k, links = t["_k"].to_numpy(), np.zeros(len(t), np.int64)
    for a, b, hit in _similar_rows(t, key[1].as_py(), key[2].as_py()):
        links[a] += hit @ k[b]
        links[b] += k[a] @ hit
    return t.select(["_g", "_sig"]).append_column("_links", pa.array(links))


def _block_pairs(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_a, _b), the ids of two texts of two blocks (or of the same block) with
    similarity > NUM/DEN, in either order."""
    t = pa.Table.from_batches(rows).select(["_tri", "_n", "_ids", "_own"])
    first, second = key[1].as_py(), key[2].as_py()
    ids = pa.concat_arrays(c.flatten() for c in t["_ids"].chunks)
    k = pc.list_value_length(t["_ids"]).to_numpy().astype(np.int64)
    start = np.cumsum(k) - k

    def listed(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = k[a] * k[b]
        part = np.cumsum(n) // LISTED
        for at in np.split(np.arange(len(n)), np.flatnonzero(np.diff(part)) + 1):
            pair = np.repeat(at, n[at])
            place = np.arange(len(pair)) - np.repeat(np.cumsum(n[at]) - n[at], n[at])
            i, j = start[a[pair]] + place // k[b[pair]], start[b[pair]] + place % k[b[pair]]
            i, j = (x[(a[pair] != b[pair]) | (i < j)] for x in (i, j))  # of one row, each pair once
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(i)), ids.take(pa.array(j))], ["_a", "_b"])

    if first == second:
        several = np.flatnonzero(k > 1)
        if len(several):
            yield from listed(several, several)
    for a, b, hit in _similar_rows(t, first, second):
        x, y = np.nonzero(hit)
        if len(x):
            yield from listed(a[x], b[y])


def _dealt(rows: DataFrame, sizes: DataFrame, block: int, *name: str) -> DataFrame:
    """``rows`` (_g, _sig, _n, ...) of texts, ordered by size in their group and dealt
    to blocks of about ``block`` places: a row for each pair of blocks (_i, _j) that
    sizes allow and that its own, _own, is in.  ``sizes`` (_g, _n, _c) has the number
    of places of each size; ``name`` tells the rows of a size apart."""
    before = Window.partitionBy("_g").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    sizes = staged(sizes.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0))), "class-sizes")
    number = lambda place: F.floor((F.col("_before") + place) / F.lit(block))
    blocks = sizes.select("_g", "_n", F.explode(F.sequence(number(F.lit(0)), number(F.col("_c") - 1))).alias("_own")) \
        .groupBy("_g", "_own").agg(F.min("_n").alias("lo"), F.max("_n").alias("hi"))
    a = blocks.select("_g", F.col("_own").alias("_i"), "hi")
    b = blocks.select("_g", F.col("_own").alias("_j"), "lo")
    met = a.join(b, "_g").where((F.col("_i") <= F.col("_j")) & (F.col("hi") * DEN > F.col("lo") * NUM)).select(
        "_g", "_i", "_j", F.explode(F.array_distinct(F.array("_i", "_j"))).alias("_own"))
    met = staged(met.groupBy("_g", "_own").agg(F.collect_list(F.struct("_i", "_j")).alias("_met")), "class-blocks")
    return rows.join(sizes, ["_g", "_n"]).withColumn("_own", number(F.pmod(F.xxhash64(*name), F.col("_c")))) \
        .join(met, ["_g", "_own"]).drop("_c", "_before").select("*", F.inline("_met")).drop("_met")


def _trigram_sets(events: DataFrame, id_col: str, text_col: str, group_col: str) -> DataFrame:
    """(_id, _g, _sig, _n, _tri) of every row: its trigram set as a text, its size
    and its hash."""
    return events.select(F.col(id_col).alias("_id"), F.col(group_col).alias("_g"), trigram_text(F.col(text_col)).alias("_tri")).select(
        "_id", "_g", F.unhex(F.sha2("_tri", 256)).alias("_sig"), F.floor(F.length("_tri") / 3).cast("int").alias("_n"), "_tri")


def near_duplicate_text_pairs(events: DataFrame, id_col: str = "id", text_col: str = "title", group_col: str = "year",
                              block: int | None = None, unit: int | None = None) -> DataFrame:
    """(id, duplicate_id) pairs of long texts: same group, id < duplicate_id,
    similarity > 0.8, as ``near_duplicate_pairs``.  A class of more than ``unit``
    texts is dealt to several rows, which meet like different classes, so a block
    has about ``block`` texts however many are equal."""
    block, unit = block or CLASS_BLOCK, unit or UNIT
    texts = _trigram_sets(events, id_col, text_col, group_col)
    texts = texts.where("_id is not null and _g is not null and _n > 0")
    texts = staged(texts.withColumn("_row", F.monotonically_increasing_id()), "trigrams")
    classes = staged(texts.groupBy("_g", "_sig", "_n").agg(F.count("*").alias("_k")), "classes")
    large = staged(classes.where(F.col("_k") > unit).select("_g", "_sig", F.ceil(F.col("_k") / F.lit(unit)).alias("_units")), "large-classes")
    units = texts.join(large, ["_g", "_sig"], "left") \
        .withColumn("_unit", F.pmod("_row", F.coalesce("_units", F.lit(1)))) \
        .groupBy("_g", "_sig", "_n", "_unit").agg(F.first("_tri").alias("_tri"), F.collect_list("_id").alias("_ids"))
    sent = _dealt(units, classes.groupBy("_g", "_n").agg(F.sum("_k").alias("_c")), block, "_sig", "_unit")
    kind = dict(texts.dtypes)["_id"]
    found = sent.groupBy("_g", "_i", "_j").applyInArrow(_block_pairs, f"_a {kind}, _b {kind}")
    return found.where(F.col("_a") != F.col("_b")).select(F.least("_a", "_b").alias("id"), F.greatest("_a", "_b").alias("duplicate_id"))


def near_duplicate_links(events: DataFrame, id_col: str = "id", text_col: str = "title", group_col: str = "year",
                         block: int | None = None) -> DataFrame:
    """(id, class_id, n_links) of every row: the smallest id among the rows of its
    group with its trigram set, and the other rows of its group with similarity
    > 0.8, those of its class included.  A row without a group or a trigram is a
    class of its own."""
    block = block or CLASS_BLOCK
    texts = staged(_trigram_sets(events, id_col, text_col, group_col), "trigrams")
    linked = texts.where("_g is not null and _n > 0")
    classes = linked.groupBy("_g", "_sig", "_n").agg(F.count("*").alias("_k"), F.min("_id").alias("_class"))
    classes = staged(classes, "classes")
    # one text per class, sent to the blocks its own is compared with
    sent = _dealt(linked.groupBy("_g", "_sig", "_n").agg(F.count("*").alias("_k"), F.first("_tri").alias("_tri")),
                  classes.groupBy("_g", "_n").agg(F.count("*").alias("_c")), block, "_sig")
    group = dict(sent.dtypes)["_g"]
    links = sent.groupBy("_g", "_i", "_j").applyInArrow(_block_links, f"_g {group}, _sig binary, _links bigint") \
        .groupBy("_g", "_sig").agg(F.sum("_links").alias("_links"))
    known = classes.join(links, ["_g", "_sig"]).select("_g", "_sig", "_class", (F.col("_links") + F.col("_k") - 1).alias("_links"))
    return texts.select("_id", "_g", "_sig").join(known, ["_g", "_sig"], "left").select(
        F.col("_id").alias("id"), F.when(F.col("_links").isNull(), F.col("_id")).otherwise(F.col("_class")).alias("class_id"),
        F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"))


def near_duplicate_pairs_direct(events: DataFrame, id_col: str = "id", text_col: str = "title",
                                group_col: str = "year") -> DataFrame:
    """Reference form of the self-join (equi on group, theta on id and
    similarity).  Quadratic per group: for tests on small inputs only."""
    t = events.select(F.col(id_col).alias("_id"), F.col(group_col).alias("_g"), trigrams(F.col(text_col)).alias("_t"))
    a = t.select("_g", F.col("_id").alias("id"), F.col("_t").alias("ta"))
    b = t.select("_g", F.col("_id").alias("duplicate_id"), F.col("_t").alias("tb"))
    inter = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - inter
    return (a.join(b, "_g").filter((F.col("id") < F.col("duplicate_id")) & (inter * DEN > union * NUM))
            .select("id", "duplicate_id"))

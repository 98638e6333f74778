"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words.  The sources, by code point with null last, weigh 5, 2, 1,
repeating, and share ``share`` times all words; a target stops at ``most``
times its source's size and the excess goes to the others by weight (a water
level: target = min(most * size, level * weight)).

The budget is a number of equal blocks of ``block_words`` words.  Highest
quotients target / (2k + 1) give the blocks of each source, and then, with the
words of its shards as votes, the blocks of each shard.  A shard is a ring:
its documents in the order of a seeded hash.  Its blocks are taken round the
ring from a seeded start, so that at most two documents are cut, and no word
is taken more than ``most`` times.

Only sizes travel: one narrow row per document is staged, and everything else
is windows and equi-joins over it.  One row per source passes through one task
(the water level is a running sum over the sources); one row per shard is
ranked within its source; the documents of a shard, about ``shard_words``
words, are ordered in one task, and a large source has many shards.  Rows of
no words are in no shard.

Defined results: a null text has size 0 and is taken 0; a null source is a
source of its own, the last; ids may be null or repeated (rows that agree in
id and text are interchangeable); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from histevents.llm.tables import WORD, free_name, keyed, read, stage

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
BLOCK_WORDS, SHARD_WORDS = 32, 500_000
SEED = "mix-1"


def seats(votes: DataFrame, n_seats: str, by: list[str], order: list[str], vote: str, out: str) -> DataFrame:
    """``votes`` with ``out``: Sainte-Laguë seats of the column ``n_seats`` (the
    same for all rows of a group ``by``), ties to the first by ``order``.

    With n parties in a group, total / (seats + n/2) and total / (seats - n/2)
    are divisors that give too many and too few seats, so only the quotients
    between them, about 2n, are ranked; the result is that of ranking all."""
    group = W.partitionBy(*by)
    total, n = F.sum(vote).over(group), F.sum(F.when(F.col(vote) > 0, 1).otherwise(0)).over(group)

    def held(at: Column) -> Column:
        return F.when(F.col(vote) > 0, F.floor(
            F.col(vote) * F.greatest(at, F.lit(0.0)) / F.col("_total") + 0.5)).otherwise(0).cast("long")

    base = (
        votes.withColumns({"_total": total.cast("double"), "_n": n})
        .withColumn("_low", held(F.col(n_seats) - F.col("_n") / 2 - 1))
        .withColumn("_high", held(F.col(n_seats) + F.col("_n") / 2 + 1))
        .withColumn("_left", F.col(n_seats) - F.sum("_low").over(group)))
    ranked = (
        base.where("_high > _low")
        .select(*by, *order, "_left", F.col(vote).cast("double").alias("_vote"),
                F.explode(F.sequence("_low", F.col("_high") - 1)).alias("_k"))
        .withColumn("_rank", F.row_number().over(
            group.orderBy((F.col("_vote") / (2 * F.col("_k") + 1)).desc(), *order, "_k")))
        .where("_rank <= _left").groupBy(*by, *order).agg(F.count("*").alias("_more")))
    return base.join(ranked, [*by, *order], "left").withColumn(
        out, F.col("_low") + F.coalesce("_more", F.lit(0))).drop("_total", "_n", "_low", "_high", "_left", "_more")


def targets(sources: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source (s_null, s, source_size) with its target in words."""
    everything, before = W.orderBy("s_null", "s"), W.orderBy("_ratio", "s_null", "s")
    up_to = before.rowsBetween(W.unboundedPreceding, -1)
    w = sources.withColumn("_w", F.element_at(
        F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(everything) - 1) % len(WEIGHTS) + 1).cast("int")))
    w = w.withColumns({"_cap": F.col("source_size") * most, "_ratio": F.col("source_size") * most / F.col("_w")})
    whole = W.partitionBy()
    level = (
        w.withColumns({
            "_left": F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("_cap").over(up_to), F.lit(0)),
            "_weight": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(up_to), F.lit(0)),
            "_rank": F.row_number().over(before)})
        .withColumn("_at", F.when(F.col("_cap") * F.col("_weight") >= F.col("_left") * F.col("_w"),
                                  F.struct("_rank", (F.col("_left") / F.col("_weight")).alias("level"))))
        .withColumn("_at", F.min("_at").over(whole)))
    return level.select("s_null", "s", "source_size", F.when(
        F.col("_rank") < F.col("_at._rank"), F.col("_cap").cast("double")).otherwise(
        F.least(F.col("_cap").cast("double"), F.col("_at.level") * F.col("_w"))).alias("target"))


def sized(docs: DataFrame, carry: list[str], seed: str = SEED) -> DataFrame:
    """The narrow table: carry, s_null, s, size and the seeded key of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        *carry, F.col("source").isNull().alias("s_null"), F.coalesce("source", F.lit("")).alias("s"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"),
                       F.md5(text.cast("binary"))).cast("binary")).alias("key"))


def _hash(key: Column) -> Column:
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def allocate(sizes: DataFrame, carry: list[str], share: float = SHARE, most: int = MOST,
             block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """carry, size, source_size, target, taken, and what is taken of each row:
    ``rounds`` whole passes and, in the words [a0, a1) and [b0, b1), one more."""
    src = targets(sizes.groupBy("s_null", "s").agg(F.sum("size").alias("source_size")), share, most)
    src = src.withColumns({
        "_all": F.greatest(F.lit(1), F.round(F.sum("target").over(W.partitionBy()) / block_words)).cast("long"),
        "_one": F.lit(0), "shards": F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")})
    src = stage(seats(src, "_all", ["_one"], ["s_null", "s"], "target", "_blocks")
                .select("s_null", "s", "source_size", "target", "shards", F.col("_blocks").alias("blocks")), "mix-sources")
    # rows of no words take no place in a ring, however many there are
    placed = sizes.where("size > 0").join(src, ["s_null", "s"]).withColumn(
        "shard", F.pmod(_hash(F.col("key")), F.col("shards")))
    empty = sizes.where("size = 0").join(src, ["s_null", "s"])
    shard = placed.groupBy("s_null", "s", "shard").agg(F.sum("size").alias("shard_size"), F.first("blocks").alias("_of"))
    shard = (
        seats(shard, "_of", ["s_null", "s"], ["shard"], "shard_size", "_blocks")
        .withColumn("quota", F.least(F.col("_blocks") * block_words, F.col("shard_size") * most))
        .withColumn("from", F.pmod(
            _hash(F.md5(F.concat_ws(":", F.lit(seed), "s_null", "s", "shard").cast("binary"))),
            F.greatest(F.lit(1), F.ceil(F.col("shard_size") / block_words))) * block_words)
        .select("s_null", "s", "shard", "shard_size", "quota", "from"))
    ring = W.partitionBy("s_null", "s", "shard").orderBy("key", "size").rowsBetween(W.unboundedPreceding, -1)
    a, size = F.col("at"), F.col("size")

    def cut(lo: Column, hi: Column) -> tuple[Column, Column]:
        """[lo, hi) of the ring, as words of the document at [at, at + size)."""
        begin = F.least(F.greatest(lo - a, F.lit(0)), size)
        return begin, F.least(F.greatest(hi - a, begin), size)

    out = (
        placed.withColumn("at", F.coalesce(F.sum("size").over(ring), F.lit(0)))
        .join(shard, ["s_null", "s", "shard"])
        .withColumn("rounds", F.when(F.col("shard_size") > 0, F.floor(F.col("quota") / F.col("shard_size"))).otherwise(0)
                    .cast("long"))
        .withColumn("rest", F.col("quota") - F.col("rounds") * F.col("shard_size")))
    a0, a1 = cut(F.col("from"), F.least(F.col("from") + F.col("rest"), F.col("shard_size")))
    b0, b1 = cut(F.lit(0), F.col("from") + F.col("rest") - F.col("shard_size"))
    out = out.withColumns({"a0": a0, "a1": a1, "b0": b0, "b1": b1})
    out = out.select(
        *carry, "size", "source_size", "target",
        (F.col("rounds") * size + F.col("a1") - F.col("a0") + F.col("b1") - F.col("b0")).cast("long").alias("taken"),
        "rounds", "a0", "a1", "b0", "b1")
    none = [F.lit(0).cast("long").alias(c) for c in ("taken", "rounds", "a0", "a1", "b0", "b1")]
    return out.unionByName(empty.select(*carry, "size", "source_size", "target", *none))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = read(spark, sf_dir, "documents", "doc_id", "source", "text")
    sizes = stage(sized(docs, ["doc_id"]), "mix-sizes")
    return allocate(sizes, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mix itself, in the columns of ``docs`` (which has doc_id, source, text).

    A whole pass repeats a row as it is.  Where the ring's end cuts a document,
    the row holds the taken words, with one blank between them; ``n_chars``,
    if there is such a column, then counts them."""
    row = free_name(docs, "_row")
    own = keyed(docs, "mix-docs", row)
    sizes = stage(sized(own, [row]), "mix-sizes")
    plan, text = free_name(docs, "_plan"), free_name(docs, "_text")
    part = allocate(sizes, [row], **params).where("taken > 0").select(
        row, F.struct("size", "rounds", "a0", "a1", "b0", "b1").alias(plan))
    p = F.col(plan)

    def cut(lo: Column, hi: Column) -> Column:
        """The words [lo, hi): the text itself if these are all, null if none."""
        some = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (lo + 1).cast("int"), (hi - lo).cast("int"))
        return F.when(hi - lo == p["size"], F.col("text")).when(hi > lo, F.array_join(some, " "))

    # a null in the array stands for a whole pass
    whole = F.array_repeat(F.lit(None).cast("string"), p["rounds"].cast("int"))
    copies = own.join(part, row).withColumn(text, F.concat(
        whole, F.array_compact(F.array(cut(p["b0"], p["b1"]), cut(p["a0"], p["a1"])))))
    one = copies.select(*[F.col(f"`{c}`") for c in own.columns], F.explode(text).alias(text))
    new = {"text": F.coalesce(F.col(text), F.col("text"))}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.col(text).isNull() | (F.col(text) == F.col("text")), F.col("n_chars")).otherwise(
            F.length(text).cast(kind))
    return one.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])

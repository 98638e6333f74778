"""A corpus from raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as
Parquet and read again as the next one's docs; all but the last give the
columns of documents.  Stages take documents with nulls, repeated rows and
further columns as their operators define it.
"""

from __future__ import annotations

from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from histevents.llm import decontaminate, mixing, quality, simhash, token_files
from histevents.llm.tables import collecting, read, release, stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression on the graded labels keeps."""
    return quality.select_good(docs, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't repeat the benchmark."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each source that the mix takes, repeats included."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, and a digest of each document in them."""
    return token_files.read_ids(token_files.write_ids(docs))


#: What the stage before left in the shared folder, in this thread's chain.
_LEFT: ContextVar[tuple[str, ...]] = ContextVar("_LEFT", default=())


def _tidy(f, first: bool, last: bool):
    """Each stage's scratch tables go when the next one of its chain begins: by
    then its result has been written and read again.  A first stage begins a
    chain, so it deletes nothing, and what a last stage's result reads stays."""
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not first:
            release(spark, _LEFT.get())
        with collecting() as paths:
            out = f(spark, docs, sf_dir)
        _LEFT.set(() if last else tuple(paths))
        return out
    return staged


_STAGES = (quality_classifier, near_dedup, decontamination, source_mixing, token_output)
STAGES = [(f.__name__, _tidy(f, f is _STAGES[0], f is _STAGES[-1])) for f in _STAGES]

#: The classifier, fingerprints and token ids are beyond SQL.  tests/llm holds the
#: near-duplicate, decontamination and token stages against brute-force versions,
#: the classifier's decisions against its own scores (its quality is measured held
#: out), and the mix against the targets of its words.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table.  The result reads its own token
    files; what the stages left besides is deleted on the way."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, f in STAGES[:-1]:
        with collecting() as own:
            docs = stage(f(spark, docs, sf_dir), name)
        release(spark, before)
        before = own
    out = STAGES[-1][1](spark, docs, sf_dir)
    release(spark, before)
    return out

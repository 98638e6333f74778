"""Small helpers shared by the operators: reading, staging, row keys."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

from histevents.session import ensure_checkpoint_dir

#: White space of the word contracts: U+0020 and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Only the named columns of a table, so that further columns can't clash."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new path of its own in the shared folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Where ``stage`` notes its paths, if ``collecting`` is in force (per thread).
_NOTED: ContextVar[list[str] | None] = ContextVar("_NOTED", default=None)


@contextmanager
def collecting():
    """The list of the scratch tables staged inside the block, for ``release``."""
    paths: list[str] = []
    token = _NOTED.set(paths)
    try:
        yield paths
    finally:
        _NOTED.reset(token)


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write to the shared folder (``spark.checkpoint.dir``) and read back.

    Cuts lineage: what follows reads the files, also after an executor is
    lost.  The folder is the job's scratch space: results read from it, so it
    is emptied when they have been written elsewhere (``release``)."""
    path = scratch(df.sparkSession, name)
    if (noted := _NOTED.get()) is not None:
        noted.append(path)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables.  Only for callers who know that every result that
    reads them has been written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with as many underscores as make it no column of ``df``
    (names are compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def keyed(df: DataFrame, name: str, row: str) -> DataFrame:
    """``df`` staged with a column ``row``, a number of its own for each row.

    Ids and texts may be null or repeated, so they can't name a row; the
    number is fixed because it is written before anything reads it."""
    return stage(df.withColumn(row, F.monotonically_increasing_id()), name)

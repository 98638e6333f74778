"""WARC records in a content-addressed archive.

An archive is a folder of two Parquet tables.  ``payloads`` holds every
different payload once, under its SHA-256; ``headers`` holds each record's
exact header bytes with the digest of the payload it stands for.  A record is
put together again by joining the two on the digest.  Digests are verified:
when payloads are stored, all payloads of one digest must agree in length and
in a second hash; when they are read, the stored bytes are digested anew, and a
difference is an error.

``page_records`` makes one record of every page.  Of the records with equal
payloads of at least ``LEAST_BYTES`` bytes the one with the smallest page_id is
the response, the others are revisits that refer to it and carry no block of
their own; smaller payloads are always responses.  ``write_warc`` and
``read_warc`` exchange records with plain WARC files, byte by byte.

Which record is first, and which payload is stored, is settled on narrow rows
(row, digest, size); payload bytes are shuffled once, for the one row of each
digest that stores them.  A digest that many records share is joined by
broadcast: at most ``HOT`` digests can hold a 1/HOT share of all records each.

Defined results: a null text is the empty payload; a null page_id comes last
when the smallest is looked for, and refers_to a record without id is null;
records of one page_id and one payload (repeated rows) are told apart by row,
so one is the response of the others; line ends in a url are written as
``%0D`` and ``%0A``; an empty table gives an empty archive.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from histevents.llm.tables import keyed, read, scratch

LEAST_BYTES, HOT = 100, 1000
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 64 << 20

#: FIXED VALUES of the WARC 1.1 format.
VERSION, END = "WARC/1.1", "\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _join_counted(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join with ``right``, which has one row per key and in ``n`` the rows
    of ``left`` that have it: keys of a large share are broadcast (at most
    ``HOT`` of them can exist), the others shuffled."""
    total = right.agg(F.sum("n")).first()[0] or 0
    right = right.withColumn("hot", F.col("n") * HOT >= total)
    hot = F.broadcast(right.where("hot").drop("n", "hot"))
    cold = left.join(hot.select(key), key, "left_anti")
    return left.join(hot, key).unionByName(cold.join(right.where("not hot").drop("n", "hot"), key))


def page_records(pages: DataFrame, date: str = DATE) -> tuple[DataFrame, DataFrame]:
    """One record of every row of ``pages`` (page_id, url, html), as heads (row,
    header, digest, whole), ``whole`` where the record's block is the payload,
    and payloads (row, digest, size, payload)."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    own = keyed(pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long")), "warc-pages", "row")
    name = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")
    first = own.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(
        F.min(name).alias("first"), F.count("*").alias("n")).where("n > 1")
    # records whose digest no other has need no join
    told = _join_counted(own.select("row", "digest"), first, "digest").where("row <> first.row").select("row", "first")
    heads = own.drop("payload").join(told, "row", "left")

    def record_id(page_id, row):
        return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), row.cast("string"), F.lit(">"))

    whole = F.col("first").isNull()
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = [
        ("WARC-Type", F.when(whole, F.lit("response")).otherwise(F.lit("revisit"))),
        ("WARC-Record-ID", record_id(F.col("page_id"), F.col("row"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", url),
        ("WARC-Refers-To", F.when(~whole, record_id(F.col("first.page_id"), F.col("first.row")))),
        ("WARC-Profile", F.when(~whole, F.lit(IDENTICAL))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        ("Content-Type", F.when(whole, F.lit("text/html; charset=utf-8"))),
        ("Content-Length", F.when(whole, F.col("size")).otherwise(F.lit(0)).cast("string")),
    ]
    lines = [F.lit(VERSION + END), *(F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit(END)), F.lit("")) for k, v in fields)]
    heads = heads.select("row", F.concat(*lines).cast("binary").alias("header"), "digest", whole.alias("whole"))
    return heads, own.select("row", "digest", "size", "payload")


def write_archive(heads: DataFrame, payloads: DataFrame, path: str) -> None:
    """Store records (as of ``page_records`` or ``read_warc``) under ``path``."""
    heads.write.option("compression", "zstd").parquet(f"{path}/headers")
    users = payloads.sparkSession.read.parquet(f"{path}/headers").groupBy("digest").agg(F.count("*").alias("n"))
    held = payloads.select("row", "digest", "size", F.xxhash64("payload").alias("second")).groupBy("digest").agg(
        F.min("row").alias("row"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("size", "second") for f in (F.min, F.max)))
    same = (F.col("min_size") == F.col("max_size")) & (F.col("min_second") == F.col("max_second"))
    fault = F.raise_error(F.concat(F.lit("different payloads of digest "), "digest"))
    held = held.join(users, "digest").select("row", F.when(same, F.col("n")).otherwise(fault.cast("long")).alias("n"))
    payloads.join(held, "row").select("digest", "size", "n", "payload").write.option(
        "compression", "zstd").parquet(f"{path}/payloads")


def field(name: str, header="header"):
    """A named field of a header, null if it has none (names in any case)."""
    found = F.regexp_extract(F.col(header).cast("string"), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)\r\n", 1)
    return F.when(F.length(found) > 0, found)


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(row, header, whole, digest, size[, payload]) of every record.

    ``payload`` are the bytes the record stands for, also for revisits; without
    them only digests are shuffled.  Stored bytes that don't have their digest,
    and records whose payload isn't there, are errors."""
    headers, stored = (spark.read.parquet(f"{path}/{name}") for name in ("headers", "payloads"))
    if headers.join(stored.select("digest"), "digest", "left_anti").limit(1).count():
        raise ValueError(f"{path}: records without their payload")
    stored = stored.select("digest", "n", F.octet_length("payload").cast("long").alias("size"),
                           F.sha2("payload", 256).alias("found"), "payload")
    bad = F.raise_error(F.concat(F.lit("stored bytes differ from their digest "), "digest")).cast("string")
    digest = F.when(F.col("found") == F.col("digest"), F.col("digest")).otherwise(bad)
    own = ["row", "header", "whole", digest.alias("digest"), "size"]
    if payloads:  # payloads have no size bound: never broadcast by hand
        return headers.join(stored, "digest").select(*own, "payload")
    return _join_counted(headers, stored.drop("payload"), "digest").select(*own)


def write_warc(archive: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Plain WARC files of about ``file_bytes`` from ``read_archive``'s rows: a
    record is its header, an empty line, its block and two line ends."""
    total = archive.agg(F.sum(F.octet_length("header") + F.when(F.col("whole"), F.col("size")).otherwise(0))).first()[0] or 0
    block = F.when(F.col("whole"), F.col("payload")).otherwise(F.lit(b""))
    archive.select(F.concat(F.col("header"), F.lit(END.encode()), block).cast("string").alias("value")).repartition(
        1 + int(total) // file_bytes).write.option("lineSep", 2 * END).text(path)


def _records(batches):
    """The records of whole files, cut by their Content-Length."""
    def rows():
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                at = 0
                while at < len(content):
                    stop = content.find(b"\r\n\r\n", at)
                    if stop < 0 or not content.startswith(b"WARC/", at):
                        raise ValueError(f"{path}: no record at byte {at}")
                    header = content[at:stop + 2]
                    sizes = [x.split(b":", 1)[1] for x in header.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                    if not sizes or stop + 4 + int(sizes[0]) > len(content):
                        raise ValueError(f"{path}: record at byte {at} is cut off")
                    end = stop + 4 + int(sizes[0])
                    yield path, at, header, content[stop + 4:end]
                    at = end
                    while content.startswith(b"\r\n", at):
                        at += 2

    held, size = [], 0
    for row in rows():
        held.append(row)
        size += len(row[3])
        if size > 8 << 20 or len(held) == 4096:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows):
    kinds = {"path": pa.string(), "at": pa.int64(), "header": pa.binary(), "block": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds.values())], names=list(kinds))


def read_warc(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Heads and payloads of plain WARC files, as ``write_archive`` takes them.
    A file is read by one task, so it should have a bounded size (as
    ``write_warc``'s).  A revisit without a block that names a SHA-256 digest
    stands for that payload."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    own = keyed(files.mapInArrow(_records, "path string, at bigint, header binary, block binary"), "warc-records", "row")
    told = F.when(F.lower(field("WARC-Type")) == "revisit", F.regexp_extract(
        field("WARC-Payload-Digest"), "(?i)sha-?256:([0-9a-f]{64})", 1))
    revisit = F.coalesce(F.length(told) > 0, F.lit(False)) & (F.octet_length("block") == 0)
    own = own.withColumn("whole", ~revisit).withColumn("digest", F.when(revisit, F.lower(told)).otherwise(F.sha2("block", 256)))
    return own.select("row", "header", "digest", "whole"), own.where("whole").select(
        "row", "digest", F.octet_length("block").cast("long").alias("size"), F.col("block").alias("payload"))


def page_of(record: str, dtype: str):
    """The page_id that a record id of ``page_records`` names."""
    found = F.regexp_extract(field(record), "^<urn:page:(.*):[0-9]+>$", 1)
    return F.when(F.length(found) > 0, F.nullif(found, F.lit("null"))).cast(dtype)


def archived_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` to an archive under ``path`` and read it back: (page_id,
    payload_bytes, payload_digest, record_type, refers_to), as the records say."""
    write_archive(*page_records(pages), path)
    kind = dict(pages.dtypes)["page_id"]
    return read_archive(pages.sparkSession, path, payloads=False).select(
        page_of("WARC-Record-ID", kind).alias("page_id"), F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), field("WARC-Type").alias("record_type"),
        page_of("WARC-Refers-To", kind).alias("refers_to"))


def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every page, from the archive."""
    return archived_pages(read(spark, sf_dir, "pages", "page_id", "url", "html"), scratch(spark, "warc-archive"))

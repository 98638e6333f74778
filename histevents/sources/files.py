"""Event JSON files: typed extraction from untyped JSON and validation.

A file holds a JSON list of events or a single event (S12).  Events are parsed
as VARIANT, so the validator can tell an integer year from "2008", 2008.5 or
true (the type of each value is kept as a flag).

A file is never read whole by one task.  It is split at closing braces, the
splits of Spark's text reader apply, and a scan over the pieces finds the ends
of the list's elements: a piece turns "inside a string" round or not, and moves
the nesting by an amount that depends on where it began, so two running sums
(inside chunks of the splits, then over one row per chunk) give both for every piece.
The pieces of an element are put together and parsed by themselves, and their
events are numbered the same way.  JSON
lines (one event per line) are read line by line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histevents.operators import validate
from histevents.session import empty_files, staged

INT_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")
CHUNK_BITS = 13  # 8192 numbers of pieces or elements, summed together
FIELDS = ("year", "title", "description", "category", "source", "severity", "digital_root", "source_url", "date")


def _is_int(v: Column) -> Column:
    return F.schema_of_variant(v).isin(list(INT_TYPES))


def typed_events(variants: DataFrame, col: str = "v") -> DataFrame:
    """VARIANT event objects -> typed columns plus ``year_is_int`` and
    ``severity_is_int`` flags; absent keys read as null."""
    v = F.col(col)
    out = variants
    for f in FIELDS:
        out = out.withColumn(f"_{f}", F.try_variant_get(v, f"$.{f}", "variant"))
    sel = [c for c in variants.columns if c != col]
    year_is_int = F.coalesce(_is_int(F.col("_year")), F.lit(False))
    return out.select(
        *sel,
        F.when(year_is_int, F.try_variant_get(F.col("_year"), "$", "bigint")).alias("year"),
        year_is_int.alias("year_is_int"),
        F.try_variant_get(F.col("_title"), "$", "string").alias("title"),
        F.try_variant_get(F.col("_description"), "$", "string").alias("description"),
        F.try_variant_get(F.col("_category"), "$", "string").alias("category"),
        F.try_variant_get(F.col("_source"), "$", "string").alias("source"),
        F.when(_is_int(F.col("_severity")), F.try_variant_get(F.col("_severity"), "$", "bigint")).alias("severity"),
        F.coalesce(_is_int(F.col("_severity")), F.lit(False)).alias("severity_is_int"),
        F.try_variant_get(F.col("_digital_root"), "$", "double").alias("digital_root"),
        F.try_variant_get(F.col("_source_url"), "$", "string").alias("source_url"),
        F.try_variant_get(F.col("_date"), "$", "string").alias("date"),
        *[_present(F.col(f"_{f}")).alias(f"{f}_present") for f in ("year", "title", "category", "source", "severity")],
    )


def _present(v: Column) -> Column:
    """The key exists and holds a non-null JSON value."""
    return v.isNotNull() & (F.coalesce(F.schema_of_variant(v), F.lit("VOID")) != "VOID")


def validate_typed(events: DataFrame) -> DataFrame:
    """Validator over typed JSON events (type rules included)."""
    present = {f: f"{f}_present" for f in ("year", "title", "category", "source", "severity")}
    return validate.with_validation(events, {"year": "year_is_int", "severity": "severity_is_int"}, present)


def _nesting(outside: Column) -> Column:
    """How far the brackets of a text without strings move the nesting."""
    return (F.length(F.regexp_replace(outside, r"[^\[{]", "")) - F.length(F.regexp_replace(outside, r"[^\]}]", ""))).cast("long")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, split, seq, piece, odd, from_outside, from_inside), staged: the
    texts between closing braces; ``odd`` if they turn "inside a string" round,
    and the nesting they move if they begin outside or inside of one."""
    # a quote is a string's end unless it is escaped; a brace can't be, so no escape spans two pieces
    plain = F.regexp_replace("piece", r"(?s)\\.", "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    rest = F.regexp_replace(plain, r'^[^"]*("|$)', "")
    strings = r'"[^"]*("|$)'
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("piece"))
    return staged(raw.select(
        "*", (quotes % 2).cast("long").alias("odd"), _nesting(F.regexp_replace(plain, strings, "")).alias("from_outside"),
        _nesting(F.regexp_replace(rest, strings, "")).alias("from_inside")), "json-pieces")


def _running(df: DataFrame, value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over all earlier rows of the file.  Inside a
    chunk of a split it is a window, before it the sum of one row per chunk."""
    chunk = ["file", "split", "_chunk"]
    df = df.withColumn("_chunk", F.shiftright("seq", CHUNK_BITS))
    inside = Window.partitionBy(*chunk).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("split", "_chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = df.groupBy(*chunk).agg(F.sum(value).alias("_of_chunk")).select(
        *chunk, F.coalesce(F.sum("_of_chunk").over(before), F.lit(0)).alias("_before"))
    return df.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0))).join(per_chunk, chunk).withColumn(
        out, F.col(out) + F.col("_before")).drop("_before", "_chunk")


def _elements(pieces: DataFrame) -> DataFrame:
    """(file, element, text, is_list, first, last): the texts up to the end of each
    object of a file's list, in order; any other file is one text."""
    order = F.struct("split", "seq")
    ends = pieces.groupBy("file").agg(
        F.min(order).alias("from"), F.max(order).alias("to"),
        # as many braces as pieces: the last piece has one after it too
        (F.sum(F.octet_length("piece") + 1) == F.max("size")).alias("closed"),
        F.min_by(F.ltrim(F.regexp_replace("piece", r"[\r\n\t]+", " ")).startswith("["), order).alias("is_list"))
    n = pieces.drop("piece", "size").join(ends, "file").select(
        "file", "split", "seq", "odd", "from_outside", "from_inside", "is_list",
        ((order != F.col("to")) | F.col("closed")).alias("brace"),
        (order == F.col("from")).alias("first"), (order == F.col("to")).alias("last"))
    n = _running(n, "odd", "quotes")
    outside_after = (F.col("quotes") + F.col("odd")) % 2 == 0
    moved = F.when(F.col("quotes") % 2 == 1, F.col("from_inside")).otherwise(F.col("from_outside"))
    n = n.withColumn("closes", F.col("brace") & outside_after).withColumn("moved", moved - F.col("closes").cast("long"))
    n = _running(n, "moved", "depth")
    # an element ends where its brace brings the nesting back to the list's
    ended = F.col("is_list") & F.col("closes") & (F.col("depth") + F.col("moved") == 1)
    n = _running(n.withColumn("ended", ended.cast("long")), "ended", "element")
    text = F.concat("piece", F.when(F.col("brace"), F.lit("}")).otherwise(F.lit("")))
    parts = F.array_sort(F.collect_list(F.struct("split", "seq", text.alias("text"))))  # the pieces of one element
    return pieces.select("file", "split", "seq", "piece").join(n, ["file", "split", "seq"]).groupBy("file", "is_list", "element").agg(
        F.array_join(F.transform(parts, lambda x: x.text), "").alias("text"), F.max("first").alias("first"), F.max("last").alias("last"))


def _parsed(e: DataFrame) -> DataFrame:
    """``e`` with ``doc``: each text of a list parsed as a list of its own, null
    where the file's list is not valid there."""
    blank = r"^\s*$"
    start = F.when(F.col("first"), r"^\s*\[").otherwise(r"^\s*,")
    end = F.when(F.col("last"), r"\]\s*$").otherwise("$")
    body = F.regexp_replace(F.regexp_replace("text", start, ""), end, "")
    closing = F.col("last") & ~F.col("first") & F.col("text").rlike(r"^\s*\]\s*$")
    # only a whole list may be blank between its brackets
    fits = F.regexp_like("text", start) & F.regexp_like("text", end) & ((F.col("first") & F.col("last")) | ~body.rlike(blank))
    own = F.when(closing, F.lit("[]")).when(fits, F.concat(F.lit("["), body, F.lit("]")))
    return e.withColumn("doc", F.try_parse_json(F.when(F.col("is_list"), own).otherwise(F.col("text"))))


def read_event_file(spark: SparkSession, path: str) -> DataFrame:
    """(file, event_index, v): every event of every JSON file under ``path``;
    a file that is not valid JSON gives one row with ``v`` null."""
    parsed = _parsed(staged(_elements(_pieces(spark, path)), "json-elements"))
    files = parsed.groupBy("file").agg(F.every(F.col("doc").isNotNull()).alias("valid"))
    events = events_of(parsed.join(files.where("valid"), "file").select("file", "element", "doc"))
    # objects end a text, so an event's number is known from the texts before
    sizes = parsed.select("file", "element", F.when(F.schema_of_variant("doc").startswith("ARRAY"), F.size(
        F.try_variant_get("doc", "$", "array<variant>"))).otherwise(1).alias("n"))
    sizes = _running(sizes.select("file", F.lit(0).alias("split"), F.col("element").alias("seq"), "n"),
                     "n", "_before_all").select("file", F.col("seq").alias("element"), F.col("_before_all").alias("_before"))
    good = events.join(sizes, ["file", "element"]).select(
        "file", (F.col("_before") + F.col("event_index")).cast("int").alias("event_index"), "v")
    empty = spark.createDataFrame([(f,) for f in empty_files(spark, path)], "file string")
    bad = files.where("not valid").select("file").unionByName(empty)
    return good.unionByName(bad.select("file", F.lit(0).alias("event_index"), F.try_parse_json(F.lit(None).cast("string")).alias("v")))


def events_of(parsed: DataFrame) -> DataFrame:
    """Rows with a ``doc`` (a JSON list of events or one event) -> a row per
    event: what else the row holds, event_index, v."""
    arr = F.when(F.schema_of_variant("doc").startswith("ARRAY"),
                 F.try_variant_get("doc", "$", "array<variant>")).otherwise(F.array("doc"))
    # an empty list is a valid file without events: no row
    rest = [c for c in parsed.columns if c != "doc"]
    return parsed.select(*rest, F.posexplode(arr).alias("event_index", "v"))


def read_event_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines: one event per line (the scalable landing format).  Each
    row keeps its file; a line that is not valid JSON has ``v`` null."""
    raw = spark.read.text(path).withColumn("file", F.input_file_name())
    return raw.select("file", F.try_parse_json("value").alias("v"))


def validate_event_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """L9 over JSON lines: (summary, errors); invalid JSON lines are counted
    as invalid events with the message 'Invalid JSON'.  Fully distributed:
    no file is read whole by one task."""
    ev = read_event_lines(spark, path)
    bad = (ev.filter(F.col("v").isNull())
           .select(F.lit(False).alias("is_valid"), F.lit(None).cast("string").alias("title"),
                   F.array(F.lit("Invalid JSON")).alias("errors"), "file"))
    typed = validate_typed(typed_events(ev.filter(F.col("v").isNotNull())))
    allv = typed.select("is_valid", "title", "errors", "file").unionByName(bad)
    errors = (allv.filter(~F.col("is_valid"))
              .select("file", F.col("title").alias("event_title"), "errors"))
    return validate.batch_summary(allv), errors


def validate_event_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(summary, errors) for a JSON file or folder of files.  A missing
    path or invalid JSON becomes an ``error`` row in the summary."""
    try:
        ev = read_event_file(spark, path)
    except Exception as exc:  # noqa: BLE001 - path does not exist
        msg = f"File not found: {path}" if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc) \
            else f"Validation error: {exc}"
        err = spark.createDataFrame([(msg,)], "error string")
        return err, spark.createDataFrame([], "event_index int, event_title string, errors array<string>")
    bad_json = ev.filter(F.col("v").isNull()).select(F.concat(F.lit("Invalid JSON: "), F.col("file")).alias("error"))
    typed = validate_typed(typed_events(ev.filter(F.col("v").isNotNull())))
    summary = validate.batch_summary(typed).withColumn("error", F.lit(None).cast("string"))
    summary = summary.unionByName(bad_json, allowMissingColumns=True)
    return summary, validate.batch_errors(typed, "event_index")

r"""Personal data by pattern, checksum and context (DataFrame functions only).

Regular expressions propose spans; a validator per kind (octets, Luhn, digit
counts, mod 97) confirms them; words near a span raise its score.  The base
kinds (email, ip, card, phone) stay once valid, whatever their score; the
added kinds (iban, ssn) need a score of ``threshold``.

Defined results: a null text counts as empty and has no spans; ids may be
null or repeated (one output row per input row); offsets are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from histevents.llm.tables import read

# FIXED VALUES: the contract's patterns.
CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: The same languages, written so that a long run costs linear time and no
#: stack: a match can only begin where a run of its first class begins or
#: where the match before ended (\G), and what can't be given back is
#: possessive.  tests/llm compares them with CONTRACT.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
KINDS = BASE + ADDED

#: What a text must hold for a pattern to be tried at all.
GUARD = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}

#: Score of a valid span, and the words whose nearness adds CONTEXT_BONUS.
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": "mail|contact|correo|courriel",
    "ip": r"\bip\b|address|host|server|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|telefon",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|taxpayer",
}
CONTEXT_BONUS, CONTEXT_CHARS, THRESHOLD = 0.2, 40, 0.6

_BLOCK = 256


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without blanks passes the mod-97 check."""
    turned = F.concat(iban.substr(F.lit(5), F.length(iban)), iban.substr(1, 4))
    return F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.try_to_number(c, F.lit("9")).cast("int")) % 97)
        .otherwise((a * 100 + F.ascii(c) - 55) % 97)) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        # three digits at most, or 255 can't hold; lpad makes strings compare as numbers
        return F.forall(part, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    if kind == "card":
        d = _digits(m)
        return F.length(d).between(14, 19) & luhn(d)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    if kind == "iban":
        plain = F.replace(m, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & mod97(plain)
    return F.lit(True)


def _located(text: Column, kind: str) -> Column:
    """array<struct<start, end, m>>: all leftmost matches with their places.

    ``split`` gives what lies between the matches; lengths add up to places.
    They are summed in blocks, so that a text with very many matches doesn't
    copy one growing array for each of them."""
    matches = F.regexp_extract_all(text, F.lit(PATTERN[kind]), F.lit(0))
    pairs = F.arrays_zip(F.split(text, PATTERN[kind], -1).alias("gap"), matches.alias("m"))
    none = F.lit(None).cast("array<struct<start:bigint,end:bigint,m:string>>")
    empty = F.coalesce(none, F.array().cast("array<struct<start:bigint,end:bigint,m:string>>"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["pos"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        return F.struct(end.cast("long").alias("pos"), F.array_append(
            acc["out"], F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end"),
                                 x["m"].alias("m"))).alias("out"))

    def block(acc: Column, xs: Column) -> Column:
        inner = F.aggregate(xs, F.struct(acc["pos"].alias("pos"), empty.alias("out")), step)
        return F.transform(F.array(inner), lambda y: F.struct(
            y["pos"].alias("pos"), F.concat(acc["out"], y["out"]).alias("out")))[0]

    found = F.slice(pairs, 1, F.size(matches))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(found, b * _BLOCK + 1, _BLOCK))
    whole = F.aggregate(blocks, F.struct(F.lit(0).cast("long").alias("pos"), empty.alias("out")), block)["out"]
    held = F.contains(text, F.lit(GUARD[kind])) if kind in GUARD else F.lit(True)
    return F.when(held & text.rlike(PATTERN[kind]), whole).otherwise(empty)


def find_spans(docs: DataFrame, text_col: str = "text", out: str = "pii", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``out``: array<struct<start, order, end, kind, score>>, sorted
    by start, then kind in the order of KINDS.  Replaces a column named ``out``."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def scored(kind: str) -> Column:
        def one(s: Column) -> Column:
            frm = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
            near = F.lower(text.substr((frm + 1).cast("int"), (s["end"] - frm + CONTEXT_CHARS).cast("int")))
            score = F.lit(SCORE[kind]) + F.when(near.rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
            return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"),
                            s["end"].alias("end"), F.lit(kind).alias("kind"), F.least(score, F.lit(1.0)).alias("score"))
        def stands_alone(s: Column) -> Column:
            before = F.when(s["start"] > 0, text.substr(s["start"].cast("int"), F.lit(1))).otherwise(F.lit(""))
            after = text.substr((s["end"] + 1).cast("int"), F.lit(1))
            return ~F.concat(before, after).rlike("[A-Za-z0-9]")

        found = F.filter(_located(text, kind), lambda s: _valid(kind, s["m"]))
        if kind in BASE:
            return F.transform(found, one)
        return F.filter(F.transform(F.filter(found, stands_alone), one), lambda s: s["score"] >= threshold - 1e-9)

    return docs.withColumn(out, F.array_sort(F.concat(*[scored(k) for k in KINDS])))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = find_spans(read(spark, sf_dir, "documents", "doc_id", "text"), "text", "pii").select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["order"] < len(BASE))
    return found.select(
        "doc_id",
        *[_count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("pii")).alias("spans"))

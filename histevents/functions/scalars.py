"""Scalar column functions (digital root, hashing, dates, URLs, numbers).

All return native ``Column`` expressions so they stay inside whole-stage
codegen; none needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from histevents import lexicons as L


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def digital_root(year) -> Column:
    """Repeated digit sum of the year; values <= 9 (0, negatives) are kept."""
    y = _c(year)
    return F.when(y <= 9, y).otherwise(F.pmod(y - 1, F.lit(9)) + 1).cast("int")


def digital_root_meaning(root) -> Column:
    """Root -> meaning lookup as a literal map (9 fixed entries)."""
    m = F.create_map(*[x for k, v in L.DIGITAL_ROOT_CYCLES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, _c(root).cast("int"))


def event_hash(year="year", title="title", source="source") -> Column:
    """md5 of ``{year}_{title}_{source}``; a null part is spelled ``None``."""
    parts = [F.coalesce(_c(p).cast("string"), F.lit("None")) for p in (year, title, source)]
    return F.md5(F.concat_ws("_", *parts))


def surrogate_id(hash_col="event_hash") -> Column:
    """Numeric id from the event hash (no autoincrement in a distributed store)."""
    return F.xxhash64(_c(hash_col))


def century(year="year") -> Column:
    """Store partition column: 1..100 -> 1, 101..200 -> 2, ..."""
    y = _c(year)
    return (F.floor((y - 1) / 100) + 1).cast("int")


def pct_change(value, prev) -> Column:
    """(v - p) / p * 100, null when p is 0 or null."""
    v, p = _c(value), _c(prev)
    return F.try_divide(v - p, p) * F.lit(100.0)


def _scaled_half_even(ax: Column, digits: int) -> Column:
    """round-half-even(|x| * 10**digits) on the exact binary value, as a long.

    |x| is written exactly as M / 2**k with M an integer: k = 53 - floor(log2
    |x|) is at least the number of fraction bits even if log2 is off by one
    at a power of two, and scaling by a power of two is exact.  Then
    N = 10**digits * M, quotient N >> k and remainder N & (2**k - 1) are
    exact long operations, and the remainder is compared with 2**(k-1).
    Valid for 2e-3 <= |x| < 2**52 (k in 2..62, N < 2**62).
    """
    k = (F.lit(53) - F.floor(F.log2(ax))).cast("int")
    num = (ax * F.pow(F.lit(2.0), k)).cast("long") * F.lit(10 ** digits)
    q = F.call_function("shiftright", num, k)
    rem = num.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1)
    half = F.call_function("shiftleft", F.lit(1).cast("long"), k - 1)
    up = (rem > half) | ((rem == half) & (q.bitwiseAND(F.lit(1)) == 1))
    return q + up.cast("long")


def format_1f(x) -> Column:
    """``'%.1f' % x``: round half-even on the exact binary value of the double.

    Spark's ``format_string`` and double->decimal casts work from the
    shortest decimal text (0.35 -> "0.35" -> 0.4) while the stored value is
    0.34999999999999997... (-> 0.3); ``_scaled_half_even`` rounds the
    stored value.  Values >= 2**52 are integers; values < 2e-3 print 0.0.
    """
    x = _c(x).cast("double")
    ax = F.abs(x)
    j = _scaled_half_even(ax, 1)
    small = F.concat(F.call_function("div", j, F.lit(10)).cast("string"), F.lit("."),
                     F.pmod(j, F.lit(10)).cast("string"))
    big = F.concat(ax.cast("decimal(38,0)").cast("string"), F.lit(".0"))
    body = F.when(ax >= F.lit(2.0 ** 52), big).when(ax < F.lit(2e-3), F.lit("0.0")).otherwise(small)
    sign = F.when((x < 0) | ((x == 0) & (F.lit(1.0) / x < 0)), F.lit("-")).otherwise(F.lit(""))
    return F.when(x.isNull() | F.isnan(x), F.lit(None)).otherwise(F.concat(sign, body))


def bround2_exact(x) -> Column:
    """Python ``round(v, 2)`` on a double (half-even on the binary value)."""
    x = _c(x).cast("double")
    ax = F.abs(x)
    r = (_scaled_half_even(ax, 2) / F.lit(100.0))
    r = F.when(ax >= F.lit(2.0 ** 52), ax).when(ax < F.lit(2e-3), F.lit(0.0)).otherwise(r)
    return F.when(x < 0, -r).otherwise(r)


def avg_round2_exact(total, n) -> Column:
    """round(total / n, 2), half-even on the exact rational (like rounding a
    NUMERIC average): integer quotient and remainder of 100 * total / n."""
    t = _c(total).cast("decimal(38,0)")
    d = _c(n).cast("decimal(38,0)")
    num = F.abs(t) * F.lit(100)
    j = F.floor(num / d).cast("decimal(38,0)")
    rem = num - j * d
    j = (F.when(rem * 2 > d, j + 1).when((rem * 2 == d) & (F.pmod(j, F.lit(2)) == 1), j + 1).otherwise(j))
    r = j.cast("double") / F.lit(100.0)
    return F.when(d == 0, F.lit(None)).when(t < 0, -r).otherwise(r)


def year_from_date_string(d) -> Column:
    """Year is the text before the first '-' of an ISO date string."""
    return F.substring_index(_c(d), "-", 1).try_cast("int")


#: Date, or date and time with seconds, both padded; a fraction and an offset may follow.
ISO_TIMESTAMP = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
                 r"(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]{3}(?:[0-9]{3})?)?)?(?:[+-][0-9]{2}:[0-9]{2})?)?$")


def published_ts(published_at) -> Column:
    """An ISO-8601 timestamp; null if the text isn't one from end to end (the
    cast alone would also take blanks around it, a bare year or one-digit parts)."""
    s = F.regexp_replace(_c(published_at), "Z$", "+00:00")
    return F.when(s.rlike(ISO_TIMESTAMP), s.try_cast("timestamp"))


def published_year(published_at) -> Column:
    """Year of an ISO-8601 timestamp in its own offset; null if unparsable."""
    return F.when(published_ts(published_at).isNotNull(), F.substring(_c(published_at), 1, 4).try_cast("int"))


def is_valid_url(url) -> Column:
    return _c(url).rlike(L.URL_PATTERN)


# Date strings accepted by the validator (strptime accepts unpadded fields,
# hence single-letter Spark fields).
DATE_FORMATS = ("yyyy-M-d", "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s'Z'")


def is_valid_date_string(d) -> Column:
    d = _c(d)
    parsed = F.coalesce(*[F.try_to_timestamp(d, F.lit(f)) for f in DATE_FORMATS])
    return parsed.isNotNull()


def year_batch_start(year, lo: int, size: int) -> Column:
    """Start of the fixed-size year batch that contains ``year``."""
    y = _c(year)
    return (F.lit(lo) + F.floor((y - F.lit(lo)) / F.lit(size)) * F.lit(size)).cast("int")


def year_batches(lo: int, hi: int, size: int) -> Column:
    """Array of (batch_start, batch_end) structs covering [lo, hi]."""
    return F.transform(
        F.sequence(F.lit(lo), F.lit(hi), F.lit(size)),
        lambda x: F.struct(x.alias("batch_start"), F.least(x + size - 1, F.lit(hi)).alias("batch_end")),
    )

"""Native text-extraction kit.

Every function maps Column -> Column with built-in expressions (regex,
``split``, higher-order array functions), so extraction runs on executors in
the JVM.  Keyword lists are parameters; defaults are the fixed lists in
``histevents.lexicons``.  Keyword tests are unrolled into ``contains``
expressions so they stay in generated code.

Regex notes: the behaviour being reproduced uses Unicode ``\\s``/``\\w``/``\\b``;
Java's are ASCII, so explicit classes are used (``WS``, ``WORD``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from histevents import lexicons as L

# Unicode whitespace (str.split / \s in Python).
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_]"
NONWORD = r"[^\p{L}\p{N}_]"
# \b before a word character, written as a consumed non-word char or start.
BOUNDARY = r"(?:^|" + NONWORD + r")"
CAP_WORD = r"[A-Z][a-z]+"

# FIXED VALUES: the patterns of years, sections, sentences, places, people and
# news fields.  They are put together from the classes above because the engine's
# own \s, \w and \b know ASCII only.
YEAR_TOKEN = r"(?<![\p{L}\p{N}_])(1[0-9]{3}|20[0-9]{2})(?![\p{L}\p{N}_])"
SECTION_HEADER = r"=+" + WS + r"*([^=]+?)" + WS + r"*=+"
BULLET = r"^[•\-*]" + WS + r"*"
SENTENCE_BREAK = r"[.!?]+" + WS + r"+(?=[A-Z])"

LOCATION_PATTERNS = (
    BOUNDARY + r"in" + WS + r"+(" + CAP_WORD + r"(?:" + WS + r"+" + CAP_WORD + r")*)",
    BOUNDARY + r"at" + WS + r"+(" + CAP_WORD + r"(?:" + WS + r"+" + CAP_WORD + r")*)",
    r"(" + CAP_WORD + r"(?:" + WS + r"+" + CAP_WORD + r")*)" + WS + r"+(?:is|was|becomes?)",
)
PARTICIPANT_PATTERNS = (
    r"(" + CAP_WORD + WS + r"+" + CAP_WORD + r")",
    r"(" + CAP_WORD + r"(?:" + WS + r"+" + CAP_WORD + r")*" + WS
    + r"+(?:Empire|Kingdom|Republic|Nation|Army|Forces?))",
)
NEWS_LOCATION_PATTERNS = (
    BOUNDARY + r"in" + WS + r"+(" + CAP_WORD + r"(?:" + WS + r"+" + CAP_WORD + r")?)",
    r"(" + CAP_WORD + r"(?:" + WS + r"+" + CAP_WORD + r")?)" + WS
    + r"+(?:government|president|prime minister)",
    r"(" + CAP_WORD + r"(?:" + WS + r"+" + CAP_WORD + r")?)" + WS + r"+(?:capital|city|country)",
)
NEWS_PERSON_PATTERN = BOUNDARY + r"(" + CAP_WORD + WS + r"+" + CAP_WORD + r")(?![\p{L}\p{N}_])"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lits(words: Iterable[str]) -> list[Column]:
    return [F.lit(w) for w in words]


def strip_ws(x) -> Column:
    """Python ``str.strip()``: trim Unicode whitespace at both ends."""
    return F.regexp_replace(_c(x), r"^" + WS + r"+|" + WS + r"+$", "")


def lower_text(*parts) -> Column:
    """lower(' '.join(parts)) with null parts as empty strings."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(_c(p), F.lit("")) for p in parts]))


def any_contains(text, words: Iterable[str]) -> Column:
    t = _c(text)
    out = None
    for w in words:
        e = t.contains(w)
        out = e if out is None else (out | e)
    return F.coalesce(out, F.lit(False)) if out is not None else F.lit(False)


def count_contains(text, words: Iterable[str]) -> Column:
    """Keyword hit score: how many of ``words`` occur as substrings."""
    t = _c(text)
    terms = [F.when(t.contains(w), 1).otherwise(0) for w in words]
    if not terms:
        return F.lit(0)
    out = terms[0]
    for e in terms[1:]:
        out = out + e
    return out.cast("int")


# ---------------------------------------------------------------- cleaning

def clean_text(text) -> Column:
    """Collapse whitespace, drop characters outside word/space/.,!?;:-(), trim.

    Null or empty -> ''.  Double spaces may reappear after removal and
    apostrophes vanish, exactly as the rule reads.
    """
    t = _c(text)
    collapsed = F.trim(F.regexp_replace(t, WS + r"+", " "))
    kept = F.regexp_replace(collapsed, r"[^\p{L}\p{N}_ .,!?;:\-()]", "")
    return F.coalesce(F.trim(kept), F.lit(""))


def description_fallback(description, content, title) -> Column:
    """strip(description + ' ' + content), else the title."""
    joined = strip_ws(F.concat_ws(" ", F.coalesce(_c(description), F.lit("")),
                                  F.coalesce(_c(content), F.lit(""))))
    return F.coalesce(F.nullif(joined, F.lit("")), _c(title))


# ---------------------------------------------------------------- years

def first_year(text) -> Column:
    """First standalone 1xxx/20xx number; null if none or if it is > 2025."""
    y = F.nullif(F.regexp_extract(_c(text), YEAR_TOKEN, 1), F.lit("")).try_cast("int")
    return F.when(y <= L.YEAR_RANGE[1], y)


def all_years(text) -> Column:
    return F.transform(F.regexp_extract_all(_c(text), F.lit(YEAR_TOKEN), 1), lambda s: s.cast("int"))


def nearest_year(title, content, around) -> Column:
    """Title year if within 50 of ``around``; else the content year nearest to
    it (first wins ties) if within 50; else null."""
    a = _c(around)
    ty = first_year(title)
    years = F.filter(all_years(content), lambda y: (y >= L.YEAR_RANGE[0]) & (y <= L.YEAR_RANGE[1]))
    best = F.array_min(F.transform(years, lambda y, i: F.struct(F.abs(y - a).alias("d"), i.alias("i"), y.alias("y"))))
    content_year = F.when(best["d"] <= L.NEAR_YEAR_WINDOW, best["y"])
    return F.when(ty.isNotNull() & (F.abs(ty - a) <= L.NEAR_YEAR_WINDOW), ty).otherwise(content_year)


# ---------------------------------------------------------------- structure

def split_sections(content) -> Column:
    """Array<struct<idx, title, body>> of '== Header ==' sections.

    No header -> one ('Main content', content) section; text before the first
    header is dropped; empty sections are dropped; idx is the header ordinal.
    """
    c = _c(content)
    titles = F.regexp_extract_all(c, F.lit(SECTION_HEADER), 1)
    bodies = F.slice(F.split(c, SECTION_HEADER, -1), 2, F.greatest(F.size(titles), F.lit(1)))
    zipped = F.zip_with(titles, bodies, lambda t, b: F.struct(
        strip_ws(t).alias("title"), strip_ws(b).alias("body")))
    indexed = F.transform(zipped, lambda s, i: F.struct(
        (i + 1).alias("idx"), s["title"].alias("title"), s["body"].alias("body")))
    with_headers = F.filter(indexed, lambda s: s["body"] != "")
    single = F.array(F.struct(F.lit(0).alias("idx"), F.lit("Main content").alias("title"), c.alias("body")))
    empty = F.filter(single, lambda s: F.lit(False))
    return (F.when(c.isNull() | (c == ""), empty)
            .when(F.size(titles) == 0, single)
            .otherwise(with_headers))


def split_sentences(content, min_length: int = L.MIN_SENTENCE_LENGTH) -> Column:
    """Lines -> strip -> drop one leading bullet -> split at sentence ends
    followed by a capital -> strip -> keep length > min_length."""
    lines = F.split(_c(content), "\n", -1)
    pieces = F.transform(lines, lambda line: F.transform(
        F.split(F.regexp_replace(strip_ws(line), BULLET, ""), SENTENCE_BREAK, -1),
        lambda s: strip_ws(s)))
    return F.filter(F.flatten(pieces), lambda s: F.length(s) > min_length)


# ---------------------------------------------------------------- fields

def event_title(sentence, max_len: int = L.TITLE_MAX) -> Column:
    """Text up to the first comma; if longer than 50: first 50 cut at the
    last space, plus '...'."""
    head = F.substring_index(_c(sentence), ",", 1)
    cut = F.concat(F.regexp_replace(F.substring(head, 1, max_len), " [^ ]*$", ""), F.lit("..."))
    return strip_ws(F.when(F.length(head) > max_len, cut).otherwise(head))


def extract_location(sentence, non_locations: Iterable[str] = L.NON_LOCATIONS) -> Column:
    s = _c(sentence)
    bad = list(non_locations)
    # each pattern needs a literal; the regex runs only where it occurs
    guards = (s.contains("in"), s.contains("at"),
              s.contains("is") | s.contains("was") | s.contains("become"))
    picks = []
    for p, guard in zip(LOCATION_PATTERNS, guards):
        g = F.when(guard, F.regexp_extract(s, p, 1)).otherwise(F.lit(""))
        picks.append(F.when((g != "") & ~g.isin(bad), g))
    return F.coalesce(*picks)


def extract_participants(sentence, limit: int = L.MAX_PARTICIPANTS) -> Column:
    """Capitalised name pairs, then '... Empire/Kingdom/...' names; distinct in
    first-appearance order; first ``limit`` joined by ', '; null if none."""
    s = _c(sentence)
    names, groups = PARTICIPANT_PATTERNS
    # the group pattern needs one of its literal nouns; skip the regex otherwise
    has_noun = any_contains(s, ("Empire", "Kingdom", "Republic", "Nation", "Army", "Force"))
    found = F.concat(F.regexp_extract_all(s, F.lit(names), 1),
                     F.when(has_noun, F.regexp_extract_all(s, F.lit(groups), 1))
                     .otherwise(F.array().cast("array<string>")))
    picked = F.slice(F.array_distinct(found), 1, limit)
    return F.nullif(F.array_join(picked, ", "), F.lit(""))


def extract_tags(sentence, category, lexicon: Mapping[str, Iterable[str]] = L.TAG_KEYWORDS) -> Column:
    """[category] + the category's keywords contained in lower(sentence), distinct."""
    low = F.lower(_c(sentence))
    cat = _c(category)
    items = [cat]
    for name, words in lexicon.items():
        for w in words:
            items.append(F.when((cat == name) & low.contains(w), F.lit(w)))
    return F.array_distinct(F.array_compact(F.array(*items)))


def categorize_key(text, lexicon: Mapping[str, Iterable[str]] = L.HISTORICAL_CATEGORIES) -> Column:
    """Arg-max key (hits, -position), maximised: most hits first, then the
    earlier category.  Each category's score appears once, so the expression
    stays small, for any number of categories."""
    t = _c(text)
    keys = [F.struct(count_contains(t, lexicon[n]).cast("int").alias("hits"), F.lit(-i).alias("place"))
            for i, n in enumerate(lexicon)]
    return F.greatest(*keys) if len(keys) > 1 else keys[0]


def category_from_key(key, lexicon: Mapping[str, Iterable[str]] = L.HISTORICAL_CATEGORIES,
                      default: str = "political") -> Column:
    k = _c(key)
    names = F.array(*[F.lit(n) for n in lexicon])
    return F.when(k["hits"] < 1, F.lit(default)).otherwise(F.element_at(names, F.lit(1) - k["place"]))


def categorize(text, lexicon: Mapping[str, Iterable[str]] = L.HISTORICAL_CATEGORIES,
               default: str = "political") -> Column:
    """Category with most keyword hits in ``text`` (already lower-cased);
    earlier categories win ties; no hit -> ``default``."""
    return category_from_key(categorize_key(text, lexicon), lexicon, default)


def estimate_severity(title, description) -> Column:
    """Tiered keyword severity of lower(title + ' ' + description): 5/4/3, else 2."""
    t = lower_text(title, description)
    return (F.when(any_contains(t, L.GLOBAL_KEYWORDS), 5)
            .when(any_contains(t, L.CONTINENTAL_KEYWORDS), 4)
            .when(any_contains(t, L.NATIONAL_KEYWORDS), 3)
            .otherwise(2).cast("int"))


def news_severity(title, content) -> Column:
    t = lower_text(title, content)
    return (F.when(any_contains(t, L.NEWS_HIGH_SEVERITY), 4)
            .when(any_contains(t, L.NEWS_MEDIUM_SEVERITY), 3)
            .otherwise(2).cast("int"))


def news_location(title, content, known: Iterable[str] = L.NEWS_KNOWN_LOCATIONS) -> Column:
    """First known place (list order) contained case-insensitively, else the
    first match of three capitalised-name patterns (length > 2)."""
    low = lower_text(title, content)
    raw = F.concat_ws(" ", F.coalesce(_c(title), F.lit("")), F.coalesce(_c(content), F.lit("")))
    known_pick = None
    for k in known:
        known_pick = (F.when(low.contains(k.lower()), F.lit(k)) if known_pick is None
                      else known_pick.when(low.contains(k.lower()), F.lit(k)))
    picks = [known_pick]
    for p in NEWS_LOCATION_PATTERNS:
        g = F.regexp_extract(raw, p, 1)
        picks.append(F.when(F.length(g) > 2, g))
    return F.coalesce(*picks)


def news_participants(title, content, non_persons: Iterable[str] = L.NEWS_NON_PERSONS,
                      limit: int = L.MAX_PARTICIPANTS) -> Column:
    """Capitalised name pairs minus known non-persons; first ``limit``
    (duplicates kept) joined by ', '; null if none."""
    raw = F.concat_ws(" ", F.coalesce(_c(title), F.lit("")), F.coalesce(_c(content), F.lit("")))
    found = F.regexp_extract_all(raw, F.lit(NEWS_PERSON_PATTERN), 1)
    bad = F.array(*_lits(non_persons))
    kept = F.filter(found, lambda x: ~F.array_contains(bad, x))
    return F.nullif(F.array_join(F.slice(kept, 1, limit), ", "), F.lit(""))


# ---------------------------------------------------------------- similarity

def trigrams(text) -> Column:
    """Distinct trigram set: lower-case, split on non-alphanumerics, pad each
    word with two leading and one trailing space, all 3-character windows."""
    words = F.filter(F.split(F.lower(_c(text)), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1),
        lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, 3)))
    return F.array_distinct(F.flatten(grams))


def _trigram_text(padded: pd.Series) -> pd.Series:
    def one(text: str | None) -> str | None:
        if not (text and text.strip(" ")):  # no word
            return None
        c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        # a window over the end of a word has blanks in its last two places, a word's own never
        own = (c[1:-1] != 32) | (c[2:] != 32)
        grams = np.unique((c[:-2] << 42 | c[1:-1] << 21 | c[2:])[own])
        return np.stack([grams >> 42, grams >> 21 & 0x1FFFFF, grams & 0x1FFFFF], 1).astype("<u4").tobytes().decode("utf-32-le")
    return padded.map(one)


def trigram_text(text) -> Column:
    """The ``trigrams`` in code point order as one string, three characters each;
    null if there is none."""
    words = F.array_distinct(F.filter(F.split(F.lower(_c(text)), r"[^\p{L}\p{N}]+", -1), lambda w: w != ""))
    # no condition on the words: they would be made twice
    padded = F.concat(F.lit("  "), F.array_join(words, "   "), F.lit(" "))
    return F.pandas_udf(_trigram_text, "string")(padded)


def trigram_similarity(a, b) -> Column:
    """|A ∩ B| / |A ∪ B| of trigram sets; null when both are empty."""
    ta, tb = trigrams(a), trigrams(b)
    inter = F.size(F.array_intersect(ta, tb))
    union = F.size(ta) + F.size(tb) - inter
    return F.try_divide(inter.cast("double"), union.cast("double"))

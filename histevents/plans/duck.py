"""DuckDB SQL snippets mirroring the Spark column functions.

Used only to write the correctness-oracle SQL (``oracle_sql()``).  DuckDB's
regex engine (RE2) has no look-around, so a few rules are written in an
equivalent token form here.
"""

from __future__ import annotations

from histevents import lexicons as L
from histevents.functions import text as T
from histevents.lexicons import URL_PATTERN


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def droot(y: str) -> str:
    return f"CAST(CASE WHEN {y} <= 9 THEN {y} ELSE 1 + (({y} - 1) % 9) END AS INT)"


def root_meaning(r: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {q(v)}" for k, v in L.DIGITAL_ROOT_CYCLES.items())
    return f"CASE {r} {cases} END"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + T.WS + '+|' + T.WS + '+$')}, '', 'g')"


def clean_text(x: str) -> str:
    collapsed = f"trim(regexp_replace({x}, {q(T.WS + '+')}, ' ', 'g'))"
    kept = f"regexp_replace({collapsed}, {q(r'[^\p{L}\p{N}_ .,!?;:\-()]')}, '', 'g')"
    return f"coalesce(trim({kept}), '')"


def lower_text(*parts: str) -> str:
    return "lower(concat_ws(' ', " + ", ".join(f"coalesce({p}, '')" for p in parts) + "))"


def any_contains(t: str, words) -> str:
    return "(" + " OR ".join(f"contains({t}, {q(w)})" for w in words) + ")"


def count_contains(t: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({t}, {q(w)}) AS INT)" for w in words) + ")"


def categorize(t: str, lexicon=L.HISTORICAL_CATEGORIES, default: str = "political") -> str:
    scores = {n: count_contains(t, ws) for n, ws in lexicon.items()}
    best = "greatest(" + ", ".join(scores.values()) + ")"
    whens = " ".join(f"WHEN {s} = {best} THEN {q(n)}" for n, s in scores.items())
    return f"CASE WHEN {best} <= 0 THEN {q(default)} {whens} END"


def estimate_severity(title: str, desc: str) -> str:
    t = lower_text(title, desc)
    return (f"CAST(CASE WHEN {any_contains(t, L.GLOBAL_KEYWORDS)} THEN 5 "
            f"WHEN {any_contains(t, L.CONTINENTAL_KEYWORDS)} THEN 4 "
            f"WHEN {any_contains(t, L.NATIONAL_KEYWORDS)} THEN 3 ELSE 2 END AS INT)")


def news_severity(title: str, content: str) -> str:
    t = lower_text(title, content)
    return (f"CAST(CASE WHEN {any_contains(t, L.NEWS_HIGH_SEVERITY)} THEN 4 "
            f"WHEN {any_contains(t, L.NEWS_MEDIUM_SEVERITY)} THEN 3 ELSE 2 END AS INT)")


def trigrams(x: str) -> str:
    words = f"list_filter(regexp_split_to_array(lower({x}), {q(r'[^\p{L}\p{N}]+')}), lambda w: w <> '')"
    grams = (f"list_transform({words}, lambda w: list_transform(range(1, length(w) + 2), "
             f"lambda i: substr('  ' || w || ' ', i, 3)))")
    return f"list_distinct(flatten({grams}))"


def is_valid_url(u: str) -> str:
    return f"regexp_matches({u}, {q(URL_PATTERN)})"


def is_valid_date(d: str) -> str:
    fmts = ("%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ")
    return "(" + " OR ".join(f"try_strptime({d}, {q(f)}) IS NOT NULL" for f in fmts) + ")"


def format_1f(x: str) -> str:
    return f"printf('%.1f', {x})"


def year_tokens(x: str) -> str:
    """All standalone 1xxx/20xx numbers as INT, in order."""
    toks = f"regexp_split_to_array({x}, {q('[^\\p{L}\\p{N}_]+')})"
    return (f"list_transform(list_filter({toks}, lambda s: regexp_full_match(s, '(1[0-9]{{3}}|20[0-9]{{2}})')), "
            f"lambda s: CAST(s AS INT))")


def first_year(x: str) -> str:
    y = f"{year_tokens(x)}[1]"
    return f"CASE WHEN {y} <= {L.YEAR_RANGE[1]} THEN {y} END"


def ordered_distinct(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def event_title(s: str) -> str:
    head = f"split_part({s}, ',', 1)"
    cut = f"regexp_replace(substr({head}, 1, {L.TITLE_MAX}), ' [^ ]*$', '') || '...'"
    return strip_ws(f"CASE WHEN length({head}) > {L.TITLE_MAX} THEN {cut} ELSE {head} END")


def extract_location(s: str) -> str:
    bad = ", ".join(q(w) for w in L.NON_LOCATIONS)
    picks = []
    for p in T.LOCATION_PATTERNS:
        g = f"regexp_extract({s}, {q(p)}, 1)"
        picks.append(f"CASE WHEN {g} <> '' AND {g} NOT IN ({bad}) THEN {g} END")
    return "coalesce(" + ", ".join(picks) + ")"


def extract_participants(s: str) -> str:
    found = "list_concat(" + ", ".join(f"regexp_extract_all({s}, {q(p)}, 1)" for p in T.PARTICIPANT_PATTERNS) + ")"
    return f"nullif(array_to_string(({ordered_distinct(found)})[1:{L.MAX_PARTICIPANTS}], ', '), '')"


def extract_tags(s: str, cat: str) -> str:
    """Tags as a ', '-joined string (category first, then lexicon order)."""
    low = f"lower({s})"
    items = [cat] + [f"CASE WHEN {cat} = {q(n)} AND contains({low}, {q(w)}) THEN {q(w)} END"
                     for n, ws in L.TAG_KEYWORDS.items() for w in ws]
    lst = "list_filter([" + ", ".join(items) + "], lambda x: x IS NOT NULL)"
    return f"array_to_string({ordered_distinct(lst)}, ', ')"


def split_sentences(x: str, min_length: int = L.MIN_SENTENCE_LENGTH) -> str:
    """Lines -> strip -> drop bullet -> split at sentence ends before a capital
    (RE2 has no look-ahead: the capital is kept by re-inserting it after a
    chr(1) marker) -> strip -> keep length > min_length."""
    brk = "[.!?]+" + T.WS + "+([A-Z])"
    line = (f"regexp_replace(regexp_replace({strip_ws('l')}, {q(T.BULLET)}, ''), {q(brk)}, "
            f"chr(1) || '\\1', 'g')")
    pieces = f"list_transform(string_split({line}, chr(1)), lambda s: {strip_ws('s')})"
    return (f"list_filter(flatten(list_transform(string_split({x}, chr(10)), lambda l: {pieces})), "
            f"lambda s: length(s) > {min_length})")


def section_titles(x: str) -> str:
    return f"regexp_extract_all({x}, {q(T.SECTION_HEADER)}, 1)"


def section_pieces(x: str) -> str:
    return f"regexp_split_to_array({x}, {q(T.SECTION_HEADER)})"


def description_fallback(desc: str, content: str, title: str) -> str:
    joined = strip_ws(f"concat_ws(' ', coalesce({desc}, ''), coalesce({content}, ''))")
    return f"coalesce(nullif({joined}, ''), {title})"


def news_location(title: str, content: str) -> str:
    low = lower_text(title, content)
    raw = f"concat_ws(' ', coalesce({title}, ''), coalesce({content}, ''))"
    known = " ".join(f"WHEN contains({low}, {q(k.lower())}) THEN {q(k)}" for k in L.NEWS_KNOWN_LOCATIONS)
    picks = [f"CASE {known} END"]
    for p in T.NEWS_LOCATION_PATTERNS:
        g = f"regexp_extract({raw}, {q(p)}, 1)"
        picks.append(f"CASE WHEN length({g}) > 2 THEN {g} END")
    return "coalesce(" + ", ".join(picks) + ")"


def news_participants(title: str, content: str) -> str:
    raw = f"concat_ws(' ', coalesce({title}, ''), coalesce({content}, ''))"
    pat = T.BOUNDARY + "(" + T.CAP_WORD + T.WS + "+" + T.CAP_WORD + ")(?:$|" + T.NONWORD + ")"
    bad = ", ".join(q(w) for w in L.NEWS_NON_PERSONS)
    kept = f"list_filter(regexp_extract_all({raw}, {q(pat)}, 1), lambda x: x NOT IN ({bad}))"
    return f"nullif(array_to_string(({kept})[1:{L.MAX_PARTICIPANTS}], ', '), '')"


def nearest_year(title: str, content: str, around: str) -> str:
    ty = first_year(title)
    ys = f"list_filter({year_tokens(content)}, lambda y: y BETWEEN {L.YEAR_RANGE[0]} AND {L.YEAR_RANGE[1]})"
    best = f"list_min(list_transform({ys}, lambda y, i: {{'d': abs(y - ({around})), 'i': i, 'y': y}}))"
    content_year = f"CASE WHEN ({best}).d <= {L.NEAR_YEAR_WINDOW} THEN ({best}).y END"
    return (f"CASE WHEN {ty} IS NOT NULL AND abs({ty} - ({around})) <= {L.NEAR_YEAR_WINDOW} THEN {ty} "
            f"ELSE {content_year} END")

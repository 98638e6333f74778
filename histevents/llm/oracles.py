"""DuckDB SQL for the operators that SQL can express.

The SQL says what a result is in plain terms (all windows, all pairs, all
quotients) and shares nothing with the operators' methods.  None for op2, op5,
op7 and op9: parsing html, fitting a model, a tokenizer's vocabulary and XXH64
are beyond it; tests/llm holds those against brute force."""

from __future__ import annotations

#: op1: runs of 1, 2, 3, ... lines that occur more than once, each from the runs
#: of one line less; the later copies of those with 16 words or more go.
OP1 = """
with recursive l as (
  select doc_id, unnest(range(len(x))) as pos, unnest(x) as line
  from (select doc_id, string_split(text, chr(10)) as x from documents where text is not null)),
l1 as (select doc_id, pos, line, md5(line) as id, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) as words from l),
runs as (
  select * from (select 1 as n, doc_id, pos, id as run, words, count(*) over (partition by id) as copies,
    row_number() over (partition by id order by doc_id, pos) as copy from l1) where copies > 1
  union all
  select * from (select n + 1 as n, runs.doc_id, runs.pos, md5(runs.run || l1.id) as run, runs.words + l1.words as words,
    count(*) over (partition by md5(runs.run || l1.id)) as copies,
    row_number() over (partition by md5(runs.run || l1.id) order by runs.doc_id, runs.pos) as copy
    from runs join l1 on l1.doc_id = runs.doc_id and l1.pos = runs.pos + runs.n) where copies > 1),
gone as (select distinct doc_id, unnest(range(pos, pos + n)) as pos from runs where copy > 1 and words >= 16),
left_ as (select l1.*, gone.pos is not null as removed from l1 left join gone on l1.doc_id = gone.doc_id and l1.pos = gone.pos)
select d.doc_id, coalesce(x.n_lines, 0)::bigint as n_lines, coalesce(x.n_removed, 0)::bigint as n_removed,
  sha256(coalesce(x.kept, '')) as kept_sha256
from documents d left join (
  select doc_id, count(*) as n_lines, count(*) filter (removed) as n_removed,
    string_agg(line, chr(10) order by pos) filter (not removed) as kept
  from left_ group by doc_id) x on d.doc_id = x.doc_id"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
with d as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
starts as (select item_id, w, unnest(range(1, greatest(len(w) - 11, 2))) as k from b where len(w) > 0),
patterns as (select distinct item_id, array_to_string(w[k:k + 12], ' ') as p, least(len(w), 13) as m from starts),
places as (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, (select distinct m from patterns) where len(w) >= m),
hits as (select doc_id, i, places.m, item_id from places
  join patterns on patterns.m = places.m and p = array_to_string(w[i:i + places.m - 1], ' ')),
covered as (select doc_id, count(distinct x) as n from (select doc_id, unnest(range(i, i + m)) as x from hits) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item_id::varchar as item from hits where item_id is not null) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(covered.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(covered.n, 0) > 0 and 20 * coalesce(covered.n, 0) >= len(w) as contaminated
from d left join covered on d.doc_id = covered.doc_id left join items on d.doc_id = items.doc_id"""

OP8 = """
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
places as (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35),
windows as (select doc_id, i, count(*) over (partition by md5(array_to_string(w[i:i + 34], ' '))) as n from places),
gone as (select distinct doc_id, unnest(range(i, i + 35)) as i from windows where n > 1),
each as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from d),
left_ as (select each.*, gone.i is not null as removed from each left join gone on each.doc_id = gone.doc_id and each.i = gone.i),
kept as (select doc_id, count(*) filter (removed) as n, string_agg(word, ' ' order by i) filter (not removed) as t
  from left_ group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(kept.n, 0)::bigint as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
from d left join kept on d.doc_id = kept.doc_id"""

OP4 = """
with sized as (
  select doc_id, source is null as s_null, coalesce(source, '') as s,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    md5('mix-1:' || coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))) as key
  from documents),
src as (select s_null, s, sum(size)::bigint as source_size from sized group by s_null, s),
weighed as (select *, [5, 2, 1][((row_number() over (order by s_null, s) - 1) % 3 + 1)::int] as w from src),
ratios as (select *, source_size * 2 as cap, (source_size * 2)::double / w as ratio from weighed),
levels as (
  select *, (sum(source_size) over ())::double * 1.5::double - coalesce(sum(cap) over before, 0)::double as rest,
    (sum(w) over () - coalesce(sum(w) over before, 0))::double as weight, row_number() over (order by ratio, s_null, s) as rank
  from ratios window before as (order by ratio, s_null, s rows between unbounded preceding and 1 preceding)),
level as (select rank, rest / weight as level from levels where cap * weight >= rest * w order by rank limit 1),
targets as (select s_null, s, source_size, greatest(1, ceil(source_size / 500000.0))::bigint as shards,
  case when l.rank < v.rank then cap::double else least(cap::double, v.level * w) end as target from levels l, level v),
total as (select sum(target) as t, count(*) as n, greatest(1, round(sum(target) / 32))::bigint as k from targets),
quotients as (select s_null, s, target / (2 * j + 1) as q, j from (
  select s_null, s, target, unnest(range(0, (ceil(k * target / t) + n + 2)::bigint)) as j from targets, total where target > 0)),
taken_blocks as (select s_null, s, count(*) as blocks from (
  select s_null, s, row_number() over (order by q desc, s_null, s, j) as r from quotients), total where r <= k group by s_null, s),
placed as (select z.*, source_size, target, coalesce(blocks, 0) as blocks,
    ('0x' || substr(key, 1, 8))::bigint % shards as shard
  from sized z join targets t on z.s_null = t.s_null and z.s = t.s left join taken_blocks b on z.s_null = b.s_null and z.s = b.s),
shard as (select s_null, s, shard, sum(size)::bigint as shard_size, any_value(blocks) as blocks, sum(sum(size)) over (
    partition by s_null, s) as whole, count(*) over (partition by s_null, s) as n from placed group by s_null, s, shard),
shard_quotients as (select s_null, s, shard, blocks, shard_size::double / (2 * j + 1) as q, j from (
  select *, unnest(range(0, (ceil(blocks * shard_size / whole) + n + 2)::bigint)) as j from shard where shard_size > 0)),
shard_blocks as (select s_null, s, shard, count(*) as own from (
  select *, row_number() over (partition by s_null, s order by q desc, shard, j) as r from shard_quotients) where r <= blocks
  group by s_null, s, shard),
quotas as (select x.s_null, x.s, x.shard, shard_size, least(coalesce(own, 0) * 32, shard_size * 2)::bigint as quota,
    ('0x' || substr(md5('mix-1:' || x.s_null::varchar || ':' || x.s || ':' || x.shard::varchar), 1, 8))::bigint
      % greatest(1, ceil(shard_size / 32.0))::bigint * 32 as first
  from shard x left join shard_blocks y on x.s_null = y.s_null and x.s = y.s and x.shard = y.shard),
ring as (select p.*, shard_size, quota, first, coalesce(sum(size) over (partition by p.s_null, p.s, p.shard
      order by key, size rows between unbounded preceding and 1 preceding), 0)::bigint as pos,
    case when shard_size > 0 then quota // shard_size else 0 end as rounds
  from placed p join quotas q on p.s_null = q.s_null and p.s = q.s and p.shard = q.shard),
cut as (select *, quota - rounds * shard_size as more from ring)
select doc_id, size, source_size, target, (rounds * size
  + greatest(0, least(pos + size, least(first + more, shard_size)) - greatest(pos, first))
  + greatest(0, least(pos + size, first + more - shard_size) - pos))::bigint as taken
from cut"""

OP6 = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as u, b.vec_id as v from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  and len(a.e) = len(b.e) where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach as (select vec_id as u, vec_id as w from embeddings union select reach.u, links.v from reach join links on reach.w = links.u),
least_ as (select u, min(w) as c from reach group by u), n as (select u, count(*) as n from links group by u)
select vec_id, coalesce(n.n, 0)::bigint as n_links, c as component_id, vec_id = c as kept
from embeddings e join least_ on e.vec_id = least_.u left join n on e.vec_id = n.u"""


def _personal() -> str:
    """All matches of the contract's patterns and of the two added ones, with
    their places from the lengths of matches and gaps."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
        "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(len({digits})), lambda i: case when i % 2 = 0 "
            f"then substr({digits}, (len({digits}) - i)::int, 1)::int "
            f"else 2 * substr({digits}, (len({digits}) - i)::int, 1)::int "
            f"- case when substr({digits}, (len({digits}) - i)::int, 1)::int > 4 then 9 else 0 end end)) % 10 = 0")
    plain = "replace(m, ' ', '')"
    mod = (f"list_reduce(list_concat([0], list_transform(string_split(substr({plain}, 5) || substr({plain}, 1, 4), ''), "
           "lambda c: case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end)), "
           "lambda a, x: (a * (case when x > 9 then 100 else 10 end) + x) % 97) = 1")
    alone = "not regexp_matches(case when start > 0 then substr(text, start::int, 1) else '' end || substr(text, stop::int + 1, 1), '[A-Za-z0-9]')"
    near = "lower(substr(text, (greatest(start - 40, 0) + 1)::int, (stop - greatest(start - 40, 0) + 40)::int))"
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 or coalesce(try_cast(ltrim(x, '0') as int), 0) > 255)) = 0",
        "card": f"len({digits}) between 14 and 19 and {luhn}",
        "phone": f"len({digits}) between 10 and 15",
        "iban": f"len({plain}) between 15 and 34 and {mod} and {alone}",
        "ssn": f"{alone} and regexp_matches({near}, 'ssn|social|security|taxpayer')",
    }
    parts = ["d as (select doc_id, coalesce(text, '') as text from documents)"]
    for k, (kind, p) in enumerate(patterns.items()):
        parts.append(f"""{kind}_m as (select doc_id, text, unnest(range(len(x))) as i, unnest(x) as m,
    unnest(string_split_regex(text, '{p}')[:len(x)]) as gap
  from (select doc_id, text, regexp_extract_all(text, '{p}') as x from d) where len(x) > 0),
{kind}_s as (select *, stop - len(m) as start from (select *, sum(len(gap) + len(m)) over (
    partition by doc_id order by i) as stop from {kind}_m)),
{kind} as (select doc_id, {k} as k, '{kind}' as kind, start, '{kind}:' || start || ':' || stop as span from {kind}_s where {valid[kind]})""")
    every = " union all ".join(f"select * from {kind}" for kind in patterns)
    counts = ", ".join(f"count(*) filter (kind = '{kind}') as n_{kind}" for kind in list(patterns)[:4])
    given = ", ".join(f"coalesce(n_{kind}, 0)::bigint as n_{kind}" for kind in list(patterns)[:4])
    return "with " + ",\n".join(parts) + f""",
found as (select doc_id, {counts}, string_agg(span, ',' order by start, k) filter (k < 4) as base,
  string_agg(span, ',' order by start, k) as spans from ({every}) group by doc_id)
select d.doc_id, {given}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join found on d.doc_id = found.doc_id"""


OP11 = """
with words as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from documents),
tf as (select doc_id, term, count(*)::bigint as tf from words group by doc_id, term),
len as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
total as (select count(*)::bigint as docs, sum(n)::bigint as l from len),
asked as (select distinct item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
  from (select term, count(*)::bigint as df from tf group by term), total),
scores as (select item_id, tf.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // l))))::bigint as score
  from asked join tf using (term) join weights using (term) join len on len.doc_id = tf.doc_id, total group by item_id, tf.doc_id)
select item_id, rank::int as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0) where rank <= 10"""

OP12 = """
with p as (select page_id, coalesce(html, '') as html from pages),
r as (select page_id, strlen(html)::bigint as payload_bytes, sha256(html) as payload_digest,
  min(page_id) over (partition by html) as first from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes < 100 or page_id = first then 'response' else 'revisit' end as record_type,
  case when payload_bytes < 100 or page_id = first then null else first end as refers_to from r"""

OP13 = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same,
    list_dot_product(a.e, b.e)::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.e) = len(b.e)),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from (
  select *, row_number() over (partition by anchor_id order by score desc, vec_id) as r from s where same) where r <= 5)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from (
  select anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id) as rank
  from positives join s using (anchor_id)
  where not same and 80 * positive_score <= 100 * s.score and s.score <= positive_score) where rank <= 5"""


ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": OP1,
    "op3_decontamination": OP3,
    "op4_mixing": OP4,
    "op6_cap_neardup": OP6,
    "op8_substring_dedup": OP8,
    "op10_pii": _personal(),
    "op11_lexical_search": OP11,
    "op12_warc_archive": OP12,
    "op13_hard_negatives": OP13,
}

"""Operators on documents against brute force, with nulls, empty and very long
texts, ties, repeated rows, empty tables and clashing column names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from histevents.llm import decontaminate, line_dedup, mixing, pii, simhash, substring_dedup
from tests.llm import brute
from tests.llm.conftest import by_id

random.seed(5)
WORDS = [f"w{i}" for i in range(300)]


def prose(n, pool=WORDS):
    return " ".join(random.choices(pool, k=n))


PASSAGE = prose(60)
ITEM = prose(20)
TEXTS = [
    prose(200), f"{prose(50)} {PASSAGE} {prose(30)}", f"{PASSAGE}\n{prose(90)}", PASSAGE, PASSAGE,
    "", None, "   \n\t ", "one", f"{prose(80)} {ITEM.upper()} {prose(10)}", f"{prose(700)} {ITEM}", ITEM,
    "a b c " * 50, prose(5000) + " " + PASSAGE + " " + prose(3000), "é è\u00a0ê ß 中文 " * 12,
]
ROWS = [(i, t, None if i % 5 == 0 else f"src{i % 3}") for i, t in enumerate(TEXTS)]


def test_decontamination(spark, documents):
    items = [(1, ITEM), (2, ITEM), (3, "Short ITEM here"), (4, None), (5, ""), (None, prose(13)), (6, PASSAGE)]
    rows = ROWS + [(90, "x short item, HERE y", "s"), (91, "short item", "s")]
    docs = documents(rows)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = brute.contamination([r[1] for r in rows], items)
    # one pass, and as many as there are patterns
    for block in (10_000, 40):
        got = by_id(decontaminate.contamination(docs, bench, block_patterns=block).select(
            "doc_id", "hits.*", F.sha2(F.array_join("hits.items", ","), 256).alias("sha")))
        assert [(g.n_words, g.n_hit, len(g["items"]), g.sha, g.contaminated) for g in (got[r[0]] for r in rows)] == expected
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r, e in zip(rows, expected) if not e[4]}
    assert decontaminate.contamination(docs, bench.limit(0)).filter("hits.n_hit > 0 or hits.contaminated").isEmpty()
    assert decontaminate.clean(docs.limit(0), bench).isEmpty()
    clash = docs.withColumn("_hit", F.lit(1)).withColumn("_contamination", F.lit(2))
    assert decontaminate.clean(clash, bench).columns == clash.columns


def test_decontamination_broadcasts_no_item_lists(spark, documents):
    """A passage in many items: what goes to the driver has one number a pattern."""
    items = [(i, f"{PASSAGE} {prose(3)}") for i in range(300)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    patterns, members = decontaminate.patterns_of(decontaminate.windows_of(bench))
    assert dict(patterns.dtypes) == {"pattern": "string", "number": "bigint"}
    # the passage's own windows have one set of items between them
    assert patterns.where(F.lit(PASSAGE).contains(F.col("pattern"))).select("number").distinct().count() == 1
    assert members.groupBy("number").count().where("count = 300").count() == 1
    got = by_id(decontaminate.contamination(documents(ROWS), bench).select("doc_id", "hits.*"))
    expected = brute.contamination([r[1] for r in ROWS], items)
    assert [(g.n_words, g.n_hit, len(g["items"]), brute.sha(",".join(g["items"])), g.contaminated)
            for g in (got[r[0]] for r in ROWS)] == expected


@pytest.mark.parametrize("chunk", [2_000_000, 3_000])
def test_substring_dedup(documents, chunk):
    rows = ROWS + [(7, TEXTS[2], "s"), (None, TEXTS[1], "s")]
    expected = brute.repeats([r[1] for r in rows])
    got = substring_dedup.remove_repeats(documents(rows), chunk_bytes=chunk).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha")).collect()
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(((r[0], *e) for r, e in zip(rows, expected)), key=key)
    assert substring_dedup.remove_repeats(documents([])).isEmpty()


def test_difference_covers():
    for v, cover in substring_dedup.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


def test_line_dedup(documents):
    long = prose(20)
    texts = [f"{long}\nhead\n\n{PASSAGE}", f"x\n{long}\ny", f"{long}\nhead\n\n{PASSAGE}\nz", "a\nb\nc\nd\n" * 6, "", None,
             "\n\n\n", long, f"{prose(9)}\n{prose(3)}", "p q r s\n" * 9, "a\nb\nc\nd\n" * 6]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    expected = brute.lines(texts)
    got = by_id(line_dedup.dedup_lines(documents(rows)).withColumn("sha", F.sha2("kept", 256)))
    assert [(got[i].n_lines, got[i].n_removed, got[i].sha) for i in range(len(texts))] == expected
    assert sum(e[1] for e in expected) > 10
    assert line_dedup.dedup_lines(documents([])).isEmpty()
    clash = documents(rows).withColumns({c: F.lit(7) for c in ("row", "at", "rank", "k1", "first", "starts", "kept")})
    assert sorted(r.n_removed for r in line_dedup.dedup_lines(clash).collect()) == sorted(e[1] for e in expected)
    # null ids come last, so theirs are the later copies
    got = line_dedup.dedup_lines(documents([(None, long, "s"), (5, long, "s"), (5, long, "s")])).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 0), (False, 1), (True, 1)]


def test_line_runs_of_all_lengths(documents):
    """Runs that reach the words as a whole only, with blank and short lines at
    their ends, copied whole, in part and more than twice."""
    rng = random.Random(17)
    one_word = [f"a{i}" for i in range(200)]
    six = ["l1 b c d e f", "l2 b c d e f", "l3 b c d e f"]
    mixed = ["", "x y", prose(10), prose(6), "p q r", "", "s t u", ""]
    texts = ["\n".join(one_word), "\n".join(["new", *one_word]), "\n".join(["begin", *six, "end"]), "\n".join(["other", *six, "close"]),
             "\n".join(mixed), "\n".join(["k", *mixed, "m"]), "\n".join(mixed[1:6]), "\n".join(mixed[2:]), "\n".join(one_word[50:90])]
    pool = [prose(rng.choice([0, 1, 3, 5, 20])) for _ in range(12)]
    texts += ["\n".join(rng.choices(pool, k=rng.randint(1, 40))) for _ in range(40)]
    expected = brute.lines(texts)
    got = by_id(line_dedup.dedup_lines(documents([(i, t, "s") for i, t in enumerate(texts)])).withColumn("sha", F.sha2("kept", 256)))
    assert [(got[i].n_lines, got[i].n_removed, got[i].sha) for i in range(len(texts))] == expected
    assert [e[1] for e in expected[:4]] == [0, 200, 0, 3]


def test_line_parts_cover_runs():
    """A line of a run of enough words lies in one of the parts inside the run."""
    rng = random.Random(19)
    for _ in range(300):
        sizes = [rng.choice([0, 0, 1, 2, 5, 16, 40]) for _ in range(rng.randint(0, 14))]
        ahead, behind, need = line_dedup.parts(np.array(sizes, np.int64), 16)
        found = {(i, i + int(m)) for i, m in enumerate(ahead) if m} | {(i + 1 - int(m), i + 1) for i, m in enumerate(behind) if m}
        for s, e in found:
            assert sum(sizes[s:e]) >= 16 and all(need[x] >= e - x for x in range(s, e))
        for i in range(len(sizes)):
            for j in range(i + 1, len(sizes) + 1):
                if sum(sizes[i:j]) >= 16:
                    inside = [p for p in found if i <= p[0] and p[1] <= j]
                    assert {x for s, e in inside for x in range(s, e)} == set(range(i, j))


def test_line_dedup_of_a_long_document(documents):
    """60,000 lines, copied: walked once."""
    lines = [f"{i} b c d e f g h i j k l m n o p q" for i in range(60_000)]
    got = by_id(line_dedup.dedup_lines(documents([(1, "\n".join(lines), "s"), (2, "\n".join(["new"] + lines), "s")])))
    assert (got[1].n_removed, got[2].n_removed, got[2].kept) == (0, 60_000, "new")


def test_simhash(spark, documents):
    base = prose(400).split()
    near = [" ".join(base[:k] + ["changed"] + base[k + 1:]) for k in range(0, 400, 10)]
    rows = [(100 + i, t, "s") for i, t in enumerate(near)] + [(i, t, s) for i, t, s in ROWS] + [(None, None, "s")]
    docs = documents(rows)
    fps = [brute.simhash(r[1]) for r in rows]
    roots = brute.groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    got = simhash.fingerprints(docs.select("doc_id", "text")).collect()
    assert sorted(r.fp & (2 ** 64 - 1) for r in got) == sorted(fps)
    kept = simhash.keep_one(docs)
    least = {r: min(rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None) for r in set(roots)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())
    assert kept.columns == docs.columns and len(set(roots[:40])) < 40
    assert simhash.keep_one(docs.limit(0)).isEmpty()
    clash = docs.withColumn("_row", F.lit(1)).withColumn("_fp", F.lit(2))
    assert simhash.keep_one(clash).columns == clash.columns


def test_simhash_blocks(spark):
    """Links of fingerprints near one another, also where a key is dealt in blocks."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(300)} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
                                                          for _ in range(300)}
    values = sorted(values)
    signed = [v - 2 ** 64 if v >> 63 else v for v in values]
    roots = brute.groups(len(values), [(i, j) for i in range(len(values)) for j in range(i)
                                       if (values[i] ^ values[j]).bit_count() <= 3])
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for block in (4096, 16):
        edges = [(r.u, r.v) for r in simhash.links(fps, block).collect()]
        place = {v: i for i, v in enumerate(signed)}
        assert all((values[place[u]] ^ values[place[v]]).bit_count() <= 24 for u, v in edges)
        assert brute.groups(len(values), [(place[u], place[v]) for u, v in edges]) == roots


def test_mixing(spark, documents):
    rows = [(i, prose(random.randint(0, 400)), f"s{i % 4}" if i % 9 else None) for i in range(400)]
    rows += [(7, rows[7][1], "s3"), (None, prose(50), "s0"), (900, None, "s1"), (901, "", "empty")]
    docs = documents(rows)
    sizes = mixing.sized(docs, ["doc_id"])
    out = mixing.allocate(sizes, ["doc_id"], shard_words=5_000).collect()
    again = mixing.allocate(sizes.repartition(3), ["doc_id"], shard_words=5_000).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    size = {s: sum(len(brute.words(t)) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    weights = dict(zip(sorted(size, key=lambda s: (s is None, s or "")), [5, 2, 1] * 3))
    target, share = {s: 0.0 for s in size}, 1.5 * sum(size.values())
    while share > 1e-9:
        free = [s for s in size if target[s] < 2 * size[s]]
        total, left = sum(weights[s] for s in free), 0.0
        for s in free:
            target[s] += share * weights[s] / total
            left += max(0.0, target[s] - 2 * size[s])
            target[s] = min(target[s], 2.0 * size[s])
        share = left
    of = {r[0]: r[2] for r in rows}
    taken = {s: 0 for s in size}
    for r in out:
        assert abs(r.target - target[of[r.doc_id]]) < 1e-6 and r.source_size == size[of[r.doc_id]]
        assert 0 <= r.taken <= 2 * r.size
        taken[of[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 64 for s in size)
    mixed = mixing.mix(docs.withColumn("_row", F.lit(0)))
    assert mixed.columns == [*docs.columns, "_row"]
    words = {s: 0 for s in size}
    for r in mixed.collect():
        words[r.source] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    assert all(abs(words[s] - target[s]) <= 64 for s in size)
    assert mixing.mix(docs.limit(0)).isEmpty()
    assert mixing.mix(documents([(1, None, None), (2, "", "a")])).isEmpty()


def test_mixing_deals_no_empty_rows(documents):
    """Rows of no words are in the result, but in no ring, so no round passes them."""
    rows = [(i, prose(20), "a") for i in range(30)] + [(100 + i, "" if i % 2 else None, "a") for i in range(500)]
    got = by_id(mixing.allocate(mixing.sized(documents(rows), ["doc_id"]), ["doc_id"]))
    assert len(got) == 530 and all(got[100 + i].taken == got[100 + i].rounds == 0 for i in range(500))
    assert all(r.source_size == 600 and r.target == 900 for r in got.values())
    assert max(got[i].rounds for i in range(30)) == 1 and abs(sum(r.taken for r in got.values()) - 900) <= 32


def test_apportionment_is_sainte_lague(spark):
    rng = random.Random(8)
    for _ in range(4):
        votes = [(0, i, float(rng.choice([0, 1, 3, rng.randint(1, 50), rng.randint(1, 10_000)]))) for i in range(40)]
        n = rng.randint(1, 300)
        df = spark.createDataFrame(votes, "g int, party int, votes double").withColumn("n", F.lit(n))
        got = {r.party: r.seats for r in mixing.seats(df, "n", ["g"], ["party"], "votes", "seats").collect()}
        expected = dict.fromkeys(got, 0)
        for _ in range(n):
            best = min((i for _, i, v in votes if v > 0), key=lambda i: (-votes[i][2] / (2 * expected[i] + 1), i))
            expected[best] += 1
        assert got == expected


def test_pii_base(documents):
    parts = ["a.b@c.de", "a@b.com_x@y.z", "x@y", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.2.3.255", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+1 (415) 555-2671", "+49 30 901820", "+1", "++12345678901", "5500000000000004", "é", "中",
             "1 2 3", ".", "@", "+", "-", " ", "x", "7"]
    rng = random.Random(1)
    texts = ["", None, "7" * 200_000, "a" * 200_000, "1 " * 30_000, "a.b@c.de " * 3_000, "x@" + "y." * 30_000 + "z"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(400)]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    found = pii.find_spans(documents(rows).withColumn("pii", F.lit(0)))
    got = {r.doc_id: [f"{s.kind}:{s.start}:{s.end}" for s in r.pii if s.kind in pii.BASE] for r in found.collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute.personal(t, pii.CONTRACT), t
    assert pii.find_spans(documents([])).isEmpty()


def test_pii_added(documents):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 ok", "GB82WEST12345698765432", "GB83WEST12345698765432", "xGB82WEST12345698765432",
             "my ssn is 123-45-6789.", "part 123-45-6789", "social security 123-45-67890"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = by_id(pii.find_spans(documents(rows)))
    spans = [[(s.kind, texts[i][s.start:s.end]) for s in got[i].pii if s.kind in pii.ADDED] for i in range(len(texts))]
    assert spans == [[("iban", "GB82 WEST 1234 5698 7654 32")], [("iban", "GB82WEST12345698765432")], [], [],
                     [("ssn", "123-45-6789")], [], []]

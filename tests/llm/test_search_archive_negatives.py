"""Lexical search, WARC archive and hard negatives against brute force, with
nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from histevents.llm import hard_negatives, lexical_search, warc_archive
from histevents.llm.lexical_search import op11_lexical_search
from histevents.llm.warc_archive import op12_warc_archive
from histevents.llm.hard_negatives import op13_hard_negatives

from pyspark.sql import functions as F

random.seed(11)
WORDS = [f"w{i}" for i in range(200)] + ["É", "中文", "naïve", "A1"]


def prose(n):
    return " ".join(random.choices(WORDS, weights=range(len(WORDS), 0, -1), k=n))


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, best=10):
    counts = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(TERM.findall((text or "").translate(LOWER))) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        found.sort(key=lambda x: x[:3])
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(found[:best], 1)]
    return sorted(out, key=repr)


DOCS = ([(i, prose(random.choice([3, 20, 60, 300]))) for i in range(120)]
        + [(200, None), (201, ""), (202, " .,\n"), (None, prose(30)), (203, prose(40_000)), (204, "w3 " * 400)]
        + [(i, "w1 w150 naïve É w199") for i in (305, 303, 301, 302, 304, 300, 300, 306, 307, 308, 309, 310, 311)])
ITEMS = [(1, prose(8)), (2, "w150 W199 w199"), (3, None), (4, ""), (None, prose(5)), (2, "w150 W199 w199"),
         (5, "nowhere"), (6, prose(3000)), (7, "É é NAÏVE")]


@pytest.mark.parametrize("terms", [50_000, 4])
def test_lexical_search(spark, monkeypatch, terms):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", terms)  # one pass, and one for each long query
    monkeypatch.setattr(lexical_search, "PARTIAL", 50)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in DOCS], "doc_id bigint, text string, row int, term string")
    items = spark.createDataFrame([(i, t, 2) for i, t in ITEMS], "item_id bigint, text string, query int").coalesce(1)
    got = lexical_search.search(docs.repartition(3), items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(DOCS, ITEMS)


def test_lexical_search_of_nothing(spark, table_dir):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text is null"), items)):
        assert op11_lexical_search(spark, table_dir(documents=a, benchmark=b)).collect() == []


def test_sketch_bounds(spark):
    """A sketch never says less than the document's count."""
    for n in (1, 5, 300, 70_000):
        counts = Counter({f"t{i}".encode(): random.choice([1, 2, 250, 255, 256, 9000]) for i in range(n)})
        dense = lexical_search.unfold(lexical_search.sketch(counts))
        for t, c in list(counts.items())[:2000]:
            assert dense[lexical_search.zlib.crc32(t) & (len(dense) - 1)] >= min(c, 255)


PAGES = [(3, "http://b", "a" * 200), (1, "http://a/\r\nX-No: 1", "a" * 200), (None, None, "a" * 200), (4, "u", None),
         (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "é" * 50), (9, "u", "é" * 49 + "e"), (10, "u", "é" * 50),
         (11, "u", "x" * 99), (12, "u", "x" * 99), (13, "u", "x" * 100), (13, "u", "x" * 100), (14, "u", "\r\n\r\nWARC/1.1\r\n" * 9),
         (None, "u", "n" * 300), (None, "u", "n" * 300), (15, "u", "long " * 200_000), (16, "u", "long " * 200_000)]
PAGES += [(100 + i, "u", "the same page " * 10) for i in range(40)]


def archived(pages):
    first = {}
    for i, _, html in pages:
        body = (html or "").encode()
        if body not in first or first[body] is None or (i is not None and i < first[body]):
            first[body] = i
    told, out = set(), []
    for i, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        body = (html or "").encode()
        response = len(body) < 100 or body not in told
        told.add(body)
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if response else "revisit",
                    None if response else first[body]))
    return sorted(out, key=repr)


def test_warc_archive(spark, tmp_path, table_dir):
    pages = spark.createDataFrame([(*p, b"h", 1, "d") for p in PAGES],
                                  "page_id bigint, url string, html string, header binary, row int, digest string")
    got = op12_warc_archive(spark, table_dir(pages=pages.repartition(3)))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == archived(PAGES)
    assert op12_warc_archive(spark, table_dir(pages=pages.limit(0))).collect() == []

    # payloads once, exact records back, through plain WARC files as well
    warc_archive.write_archive(*warc_archive.page_records(pages), f"{tmp_path}/a")
    stored = spark.read.parquet(f"{tmp_path}/a/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len({p[2] or "" for p in PAGES})
    archive = warc_archive.read_archive(spark, f"{tmp_path}/a")
    rows = sorted((bytes(r.header), r.digest, bytes(r.payload), r.whole) for r in archive.collect())
    assert all(hashlib.sha256(p).hexdigest() == d for _, d, p, _ in rows)
    assert not any(b"\r\nX-No" in h for h, _, _, _ in rows)
    warc_archive.write_warc(archive, f"{tmp_path}/w", 500_000)
    files = f"{tmp_path}/w/*.txt"
    content = b"".join(r.content for r in spark.read.format("binaryFile").load(files).collect())
    assert len(content) == sum(len(h) + 2 + len(p) * w + 4 for h, _, p, w in rows)
    assert spark.read.format("binaryFile").load(files).count() > 1
    warc_archive.write_archive(*warc_archive.read_warc(spark, files), f"{tmp_path}/b")
    again = warc_archive.read_archive(spark, f"{tmp_path}/b").collect()
    assert sorted((bytes(r.header), r.digest, bytes(r.payload), r.whole) for r in again) == rows


def test_warc_archive_faults(spark, tmp_path):
    heads, payloads = warc_archive.page_records(spark.createDataFrame(PAGES, "page_id bigint, url string, html string"))
    wrong = payloads.withColumn("payload", F.when(F.col("size") == 5, F.lit(b"other")).otherwise(F.col("payload")))
    warc_archive.write_archive(heads, wrong, f"{tmp_path}/a")
    with pytest.raises(Exception, match="differ from their digest"):
        warc_archive.read_archive(spark, f"{tmp_path}/a").collect()
    warc_archive.write_archive(heads, payloads.where("size <> 5"), f"{tmp_path}/b")
    with pytest.raises(ValueError, match="without their payload"):
        warc_archive.read_archive(spark, f"{tmp_path}/b")
    with pytest.raises(Exception, match="different payloads"):
        warc_archive.write_archive(*(x.withColumn("digest", F.lit("d")) for x in (heads, payloads)), f"{tmp_path}/c")
    broken = tmp_path / "broken.warc"
    broken.write_bytes(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort")
    with pytest.raises(Exception, match="cut off"):
        warc_archive.read_warc(spark, str(broken))


def mined(rows, anchor=lambda i: i % 100 == 0, relabel=True, k=5, low=80):
    own = []
    for n, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if relabel and i is not None and i % 7 == 0 else label
        own.append((n, i, [int(math.floor(256 * x)) for x in v], label))
    out = []
    for n, i, v, label in own:
        if i is None or not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, l) for m, j, w, l in own if m != n and len(w) == len(v))
        for p in [s for s in scored if s[4] == label][:k]:
            fits = [s for s in scored if s[4] != label and 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:k]
            out += [(i, None if p[1] else p[2], r, None if s[1] else s[2], -p[0], -s[0]) for r, s in enumerate(fits, 1)]
    return sorted(out, key=repr)


def vectors(n, d, seed, spread=0.3):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((6, d))
    return [[float(np.float32(x)) for x in centres[i % 6] + spread * r.standard_normal(d)] for i in range(n)]


ROWS = [(i, v, i % 3) for i, v in enumerate(vectors(360, 8, 1))]
ROWS += [(i, v, i % 10) for i, v in enumerate(vectors(120, 4, 2), 400)]  # another length
ROWS += [(600, [1.0] * 8, 1), (601, [1.0] * 8, 2), (602, [1.0] * 8, 1), (603, [1.0] * 8, 3), (700, [0.0] * 8, 1), (701, [0.0] * 8, 2)]
ROWS += [(800, None, 1), (801, [1.0] * 8, None), (802, [1.0, None] * 4, 1), (803, [float("nan")] * 8, 1), (900, [float("inf")] * 8, 1)]
ROWS += [(None, [1.0] * 8, 2), (600, [1.0] * 8, 1), (1000, [], 1), (1001, [], 1), (1002, [], 2), (1100, [-3.0] * 8, 7), (1101, [3.0] * 8, 7)]
SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("anchors,rows", [(128, 8192), (4, 32)])
def test_hard_negatives(spark, table_dir, monkeypatch, anchors, rows):
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "ROWS", rows)
    table = spark.createDataFrame([(*r, 5, 6.0) for r in ROWS], SCHEMA + ", row int, place double")
    got = op13_hard_negatives(spark, table_dir(embeddings=table.repartition(3)))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == mined(ROWS)
    assert op13_hard_negatives(spark, table_dir(embeddings=table.limit(0))).collect() == []


def test_hard_negatives_of_large_numbers_and_many_anchors(spark):
    rows = [(i, [x * 1e6 for x in v], i % 2) for i, v in enumerate(vectors(60, 5, 3))]
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"),
                                        F.col("vec_id") % 3 == 0, F.col("label"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == mined(rows, lambda i: i % 3 == 0, False)


def test_tree_bounds_skip_candidates(spark, monkeypatch):
    """Close anchors score few candidates again; a tree's edges are the shortest."""
    x = np.array(vectors(50, 6, 4))
    order, parent, edge = hard_negatives.spanning_tree(x)
    assert sorted(order.tolist()) == list(range(50)) and parent[order[0]] == order[0]
    seen = set()
    for i in order.tolist():
        assert i == order[0] or parent[i] in seen
        seen.add(i)
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    left, total = {0}, 0.0
    while len(left) < 50:
        w, j = min((d[i, j], j) for i in left for j in range(50) if j not in left)
        left.add(j)
        total += w
    assert math.isclose(edge.sum(), total)
    scored = []
    scores = hard_negatives._scores
    monkeypatch.setattr(hard_negatives, "_scores", lambda x, a, safe: scored.append(len(x)) or scores(x, a, safe))
    near = np.floor(256 * (np.ones((20, 6)) + 0.01 * np.random.default_rng(5).standard_normal((20, 6))))
    rows = np.floor(256 * np.random.default_rng(6).standard_normal((3000, 6))).astype(np.int32)
    n = len(rows)
    c = hard_negatives._Chunk([(np.arange(n), np.arange(n), np.zeros(n, bool), np.ones(n, np.int64), rows)], 6)
    best = hard_negatives._walk(c, 1, near, hard_negatives.spanning_tree(near), np.full(20, -1), None, 80, 5)
    assert sum(scored) < 0.2 * 20 * n
    for a, (b,) in zip(near, best):
        assert b.score.tolist() == sorted((rows @ a).astype(int).tolist(), reverse=True)[:5]

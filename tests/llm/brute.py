"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def groups(n, linked):
    """Smallest member of each member's group, by union of linked pairs."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def contamination(texts, items, window=13):
    cut = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    patterns = {}
    for i, t in items:
        w = cut.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            patterns.setdefault(tuple(w[k:k + window]), set()).update([] if i is None else [str(i)])
    out = []
    for t in texts:
        w = cut.findall((t or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for m in {len(p) for p in patterns}:
            for k in range(len(w) - m + 1):
                ids = patterns.get(tuple(w[k:k + m]))
                if ids is not None:
                    found |= ids
                    hit[k:k + m] = [True] * m
        n = sum(hit)
        out.append((len(w), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(w)))
    return out


def repeats(texts, window=35):
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def simhash(text, shingle=3):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def lines(texts, least_words=16):
    """(n_lines, n_removed, hash of what is kept), texts in corpus order: runs of
    any length, as long as any run of that length occurs twice."""
    split = [t.split("\n") if t is not None else [] for t in texts]
    sizes = [[len(words(x)) for x in ls] for ls in split]
    gone = [set() for _ in texts]
    n, repeated = 1, True
    while repeated:
        repeated, seen = False, set()
        for d, ls in enumerate(split):
            for i in range(len(ls) - n + 1):
                run = tuple(ls[i:i + n])
                if run in seen:
                    repeated = True
                    if sum(sizes[d][i:i + n]) >= least_words:
                        gone[d].update(range(i, i + n))
                seen.add(run)
        n += 1
    return [(len(ls), len(g), sha("\n".join(x for i, x in enumerate(ls) if i not in g)))
            for ls, g in zip(split, gone)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text, patterns):
    found = []
    for k, (kind, p) in enumerate(patterns.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]:
                found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def cosine_groups(vectors, labels, least=0.93):
    """(links, smallest row reached) of each row; None where a vector links with nothing."""
    ok = [v is not None and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
          for v, l in zip(vectors, labels)]
    links, pairs = [0] * len(vectors), []
    for i in range(len(vectors)):
        for j in range(i):
            if ok[i] and ok[j] and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    pairs.append((i, j))
    return links, groups(len(vectors), pairs)

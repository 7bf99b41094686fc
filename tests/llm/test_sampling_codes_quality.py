"""Importance resampling, vector codes and quality rules against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from quipu.llm import importance, quality_rules, vector_codes

SCHEMA = "doc_id long, text string, lang string, source string, weight long"


def key(rows):
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    some = "alpha Beta gamma_delta épsilon zeta-eta θeta iota42 KAPPA ｗｉｄｅ".split()

    def prose(n):
        return " ".join(rng.choice(some) + str(rng.randrange(40)) for _ in range(n))

    rows = [(i, prose(rng.randrange(10, 90))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "-_- !!"), (None, prose(30)), (None, None), (104, "x" * 3000 + " y"),
             (105, "é" * 500 + " " + "ab " * 40), (106, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (107, prose(6000)),
             (108, ("line one is here\n" * 30) + "last"), (109, "a b c " * 60), (110, prose(60) + " " + rows[5][1] + "\n" + rows[5][1]),
             (111, "\x00a\x0bb\x1fc"), (112, "# * $ % & | < >"), (113, (prose(70) + "\n") * 2)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", 1) for i, t in texts], SCHEMA).withColumnsRenamed({"lang": "run", "source": "segment"}).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------------------- resampling
def plain_features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in w] + [zlib.crc32(f"{a} {b}".encode()) % 10000 for a, b in zip(w, w[1:])]


def plain_resample(texts, target):
    s, t = collections.Counter(), collections.Counter()
    found = [(i, *plain_features(x)) for i, x in texts]
    for *_, f in found:
        s.update(f)
    for x in target:
        t.update(plain_features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows, pool = [], []
    for i, n, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None])
        if n >= 20:
            pool.append(rows[-1])
    pool.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(pool[:25 * len(pool) // 100], 1):
        r[4] = rank
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("block,run", [(1 << 22, 1 << 20), (300, 7)])
def test_resample(spark, docs, texts, monkeypatch, block, run):
    monkeypatch.setattr(importance, "BLOCK", block)
    monkeypatch.setattr(importance, "RUN", run)
    target = [t for _, t in texts[:9]] + [None, ""]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = [tuple(r) for r in importance.resample(docs, frame).collect()]
    assert key(got) == key(plain_resample(texts, target))


def test_resample_ties(spark):
    """Equal keys at every splitter: ranks stay distinct and gapless."""
    rows = [(7, "one two " * 15)] * 500 + [(8, "three four " * 12)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = importance.resample(docs, docs, per_cent=60).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 481))
    by_rank = sorted((r["rank"], -r["score"], r["doc_id"]) for r in got if r["rank"])
    assert [r[1:] for r in by_rank] == sorted(r[1:] for r in by_rank)


def test_resample_empty(spark, empty, docs):
    assert importance.resample(empty, docs).collect() == []
    assert {r["rank"] is None for r in importance.resample(docs.limit(2), empty).collect()} == {True}


# ---------------------------------------------------------------------------- vector codes
def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, lab, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, lab, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for *_, v in kept), default=0) // parts))
    kept = [(i, lab, v + [0] * (width * parts - len(v))) for i, lab, v in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for *_, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = collections.defaultdict(list)
            for c in cut:
                got[near(c[p], books[p])[1]].append(c[p])
            for k, xs in got.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], collections.Counter()
    for (i, lab, _), c in zip(kept, cut, strict=True):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        total[lab] += out[-1][3]
    return [(i, lab, code, e, total[lab], digest) for i, lab, code, e in out]


@pytest.mark.parametrize("entries,labels", [(256, 100_000), (16, 2)])
def test_codes(spark, monkeypatch, entries, labels):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", labels)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    rows = [(i, int(i % 3) if i % 7 else None, (centres[i % 12] + rng.normal(scale=0.1, size=8)).astype(np.float32).tolist()) for i in range(330)]
    rows += [(1000, 1, None), (1001, 1, [1.0, None] * 4), (1002, 0, [float("nan")] * 8), (1003, 2, [float("inf")] + [0.0] * 7),
             (1004, 2, [0.5, -0.5]), (1005, None, []), (1006, 0, rows[5][2]), (1007, 0, [0.0] * 8), (1008, 0, [0.0] * 8)]
    frame = spark.createDataFrame([(i, lab, v, 5, 6) for i, lab, v in rows], "vec_id long, label int, embedding array<float>, code int, far int").repartition(5)
    got = [tuple(r) for r in vector_codes.compress(frame, entries=entries).collect()]
    assert key(got) == key(plain_codes(rows, entries=entries))


def test_codes_edges(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert vector_codes.compress(spark.createDataFrame([], schema)).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, 1, None)], schema)).collect() == []
    huge = spark.createDataFrame([(1, 1, [3e38] * 4), (2, 1, [-3e38] * 4), (2, None, [-3e38] * 4), (None, 1, [0.0] * 4)], schema)
    got = vector_codes.compress(huge, entries=2).collect()
    assert len(got) == 4 and all(0 <= r.error < 1 << 62 for r in got)


def test_bounds_prune():
    """Fewer distances than all are evaluated, and the nearest entry is never pruned."""
    rng = np.random.default_rng(1)
    entries = rng.integers(-900, 900, (256, 4))
    x = entries[rng.integers(0, 256, 4000)] + rng.integers(-9, 9, (4000, 4))
    pivots = vector_codes.choose_pivots(entries, vector_codes.PIVOTS)
    code, best, evaluated = vector_codes.nearest(x, np.sqrt(vector_codes.distances(x, pivots)), entries, np.sqrt(vector_codes.distances(entries, pivots)))
    all_ = vector_codes.distances(x, entries)
    assert (best == all_.min(1)).all() and (code == all_.argmin(1)).all()
    assert evaluated < all_.size / 10


# ---------------------------------------------------------------------------- quality rules
def plain_quality(text, least, most, longest):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(w)

    def windows(size):
        seen = collections.defaultdict(list)
        for i in range(n - size + 1):
            seen[tuple(w[i:i + size])].append(i)
        return [v for v in seen.values() if len(v) > 1]

    def marked(size):
        return {j for v in windows(size) for i in v for j in range(i, i + size)}

    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeat = len(marked(3))
    chars = sum(map(len, w))
    failed = n < 50 or 100 * repeat > 50 * n
    gone = marked(least)
    lo = max((s for s in range(least, n) if windows(s)), default=0) if n < 500 or gone else 0
    inside = sum(len(w[i]) for i in gone)
    return (n, chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat, failed,
            not failed and 100 * inside <= most * chars and lo <= longest, inside, lo)


@pytest.mark.parametrize("least,most,longest,block", [(10, 20, 50, 1 << 22), (3, 60, 20, 500)])
def test_quality(docs, texts, least, most, longest, block):
    got = [tuple(r)[:10] for r in quality_rules.quality(docs, least=least, most_covered=most, longest=longest, block=block).collect()]
    assert key(got) == key([(i, *plain_quality(t, least, most, longest)) for i, t in texts])


def test_quality_catches(spark, empty):
    assert quality_rules.quality(empty).collect() == []
    rng = random.Random(2)
    w = [f"w{rng.randrange(10 ** 6)}" for _ in range(500)]
    rows = [(1, " ".join(w)), (2, " ".join(w + w[:51])), (3, " ".join(w + w[:49])), (4, " ".join(w + w[:45] + ["x"] + w[100:145]))]
    got = {r.doc_id: (r.base_failed, r.kept, r.longest_repeat) for r in
           quality_rules.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (False, True, 0), 2: (False, False, 51), 3: (False, True, 49), 4: (False, False, 45)}


def test_maximal_repeats():
    """Every maximal repeated substring of random sequences, once, with all its occurrences."""
    rng = random.Random(3)
    for _ in range(200):
        seq = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        n = len(seq)
        want = {}
        for size in range(1, n):
            for i in range(n - size + 1):
                at = [j for j in range(n - size + 1) if seq[j:j + size] == seq[i:i + size]]
                if len(at) > 1 and len({seq[j - 1] if j else "^" for j in at}) > 1 and len({seq[j + size] if j + size < n else "$" for j in at}) > 1:
                    want[tuple(seq[i:i + size])] = len(at)
        symbol = np.array([x + 1 for x in seq], np.uint64)
        sa, lcp = quality_rules.suffix_array(symbol, np.zeros(n, np.int64), np.full(n, n))
        before = np.append(np.uint64(99), symbol[:-1])
        got = {tuple(seq[sa[a]:sa[a] + size]): b - a for size, a, b in quality_rules.maximal_repeats(sa, lcp, before, 1)}
        assert got == want

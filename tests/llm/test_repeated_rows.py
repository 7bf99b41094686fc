"""Thousands of equal rows, very long runs of blanks, and a corpus without labels."""

import hashlib
import random

import corpus_pipeline
from quipu.llm import byte_dedup, ngram_join, packing, queries, span_dedup

EMPTY = hashlib.sha256(b"").hexdigest()


def prose(n, seed=1):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_byte_dedup_of_equal_rows(spark):
    long, short, other = prose(700), prose(20), prose(700, 2)
    mixed = other[:2000] + long[1000:3000] + other[2000:]
    rows = [(None, long)] * 2000 + [(None, short)] * 500 + [(None, None)] * 3 + [(5, mixed), (6, "x")]
    got = {}
    for r in byte_dedup.remove_repeats(frame(spark, rows)).collect():
        got.setdefault((r.doc_id, r.n_bytes), set()).add((r.n_removed, r.n_spans, r.kept_sha256))
        got[r.doc_id, r.n_bytes, "n"] = got.get((r.doc_id, r.n_bytes, "n"), 0) + 1
    n, m = len(long), len(mixed)
    assert got[None, n] == {(n, 1, EMPTY)} and got[None, n, "n"] == 2000
    assert got[None, len(short)] == {(0, 0, hashlib.sha256(short.encode()).hexdigest())} and got[None, len(short), "n"] == 500
    assert got[None, 0] == {(0, 0, EMPTY)} and got[None, 0, "n"] == 3
    assert got[5, m] == {(2000, 1, hashlib.sha256(other.encode()).hexdigest())}
    assert got[6, 1] == {(0, 0, hashlib.sha256(b"x").hexdigest())}


def test_byte_dedup_in_slices(spark, monkeypatch):
    """One rank of many strings, compared a few at a time, gives what one comparison gives."""
    shared, tail = prose(60, 5)[:420], prose(60, 6)
    rows = [(i, prose(90, 100 + i)[:500 + i] + shared[: 300 + i] + (tail if i % 3 else prose(60, 500 + i))) for i in range(90)]
    want = sorted(tuple(r)[:5] for r in byte_dedup.remove_repeats(frame(spark, rows)).collect())
    assert any(r[2] for r in want) and not all(r[2] for r in want)
    monkeypatch.setattr(byte_dedup, "STRINGS", 50)
    assert sorted(tuple(r)[:5] for r in byte_dedup.remove_repeats(frame(spark, rows)).collect()) == want
    assert sorted(tuple(r)[:5] for r in byte_dedup.remove_repeats(frame(spark, rows), hot=3).collect()) == want


def test_span_dedup_of_equal_rows(spark):
    text = prose(400)
    own = prose(100, 3)
    rows = [(1, text)] + [(9, own + " " + text)] * 1500 + [(9, own)] * 2
    got = span_dedup.remove_repeats(frame(spark, rows)).groupBy("doc_id", "n_words", "n_removed", "kept_sha256").count().collect()
    kept = hashlib.sha256(own.encode()).hexdigest()
    assert sorted(tuple(r) for r in got) == sorted([(1, 400, 0, hashlib.sha256(text.encode()).hexdigest(), 1), (9, 500, 400, kept, 1500), (9, 100, 0, kept, 2)])


def test_ngram_join_of_equal_rows(spark):
    a, b = prose(300), prose(300, 4)
    rows = [(None, a)] * 1500 + [(4, a + " tail"), (5, b), (5, b)]
    got = ngram_join.similarity_classes(frame(spark, rows)).groupBy("doc_id", "n_shingles", "component_id").count().collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(None, 296, 4, 1500), (4, 297, 4, 1), (5, 296, 5, 2)]))


def test_packing_of_long_blank_runs(spark):
    from tokenizers import Tokenizer
    path = queries.tokenizer_path("byte_bpe_50k.json")
    rows = [(1, " " * 1_200_000), (2, "\n" * 1_200_000), (3, "a word")]
    got = {r.doc_id: r.n for r in packing.token_pieces(frame(spark, rows), path).groupBy("doc_id").agg({"length": "sum"})
           .withColumnRenamed("sum(length)", "n").collect()}
    made = Tokenizer.from_file(path)
    assert got == {i: len(made.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}


def test_language_stage_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 34", None), (3, None, None), (4, "é", None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()) == [1, 4]
    few = spark.createDataFrame([(i, "the small house by the river", "en") for i in range(20)] + [(50, "zzz", None), (51, "7", None)], docs.schema)
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, few, "").collect()) == [*range(20), 50]

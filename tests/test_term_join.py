"""Term tables against texts: every pair compared in plain Python, and a table of 200,000 terms."""
import random

import pytest
from pyspark.sql import functions as F

from quipu.operators import term_join as TJ


def _texts(rng):
    words = ["ab", "abc", "zebra", "Öl", "naïve", "the", "😀x", "x.y", "[oc]", "a"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "s", "!"]) for _ in range(rng.randrange(0, 300)))) for i in range(40)]
    return rows + [(100, None), (101, ""), (102, "q" * 2000 + "needle" + "q" * 2000), (103, "ab\nthe\tab"), (104, "NEEDLE")]


@pytest.mark.parametrize("limits", [{}, {"BROADCAST_TERMS": 0, "CHUNK": 7, "PROBE": 20}])
def test_pairs_equal_plain_python(spark, monkeypatch, limits):
    for name, x in limits.items():
        monkeypatch.setattr(TJ, name, x)
    rng = random.Random(8)
    rows = _texts(rng)
    terms = ["a", "ab", "Zebra", "needle", "abs", "the", "öl", "😀", "[oc]", "b\nt", "missing", "", None, "the", "THE", "q" * 150, "q" * 2000 + "n",
             rows[5][1][3:60], rows[6][1][:700] or "x", "ab " * 5, "x.y!", "!"]
    texts = spark.createDataFrame(rows, "id long, text string").repartition(3)
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    low = {t.lower() for t in terms if t}
    want = sorted((i, t) for i, x in rows if x is not None for t in low if t in x.lower())
    got = sorted(tuple(r) for r in TJ.term_matches(texts, table, "id").distinct().collect())
    assert got == want
    counts = {r["id"]: (r["n_terms"], r["first_term"]) for r in TJ.count_terms(texts, table, "id").collect()}
    assert counts == {i: (len([t for j, t in want if j == i]), min(t for j, t in want if j == i)) for i in {i for i, _ in want}}
    hit = {i for i, _ in want}
    assert {r["id"] for r in TJ.with_any_term(texts, table, "id").collect()} == hit
    assert {r["id"] for r in TJ.without_any_term(texts, table, "id").collect()} == {i for i, _ in rows} - hit


def test_no_terms(spark):
    texts = spark.createDataFrame([(1, "a"), (2, None)], "id long, text string")
    none = spark.createDataFrame([], "term string")
    assert TJ.with_any_term(texts, none, "id").collect() == []
    assert TJ.without_any_term(texts, none, "id").count() == 2


def test_large_table_without_nested_loop(spark):
    """200,000 terms: no nested-loop join, no cap, and the planted ones are found."""
    terms = spark.range(200_000).select(F.concat(F.lit("term "), F.conv(F.col("id") * 7919, 10, 36), F.lit(" end")).alias("term"))
    texts = spark.range(3000).select("id", F.concat(F.lit("some text before TERM "), F.conv(F.col("id") * 7919 * 71, 10, 36),
                                                    F.when(F.col("id") % 3 == 0, " end").otherwise(" and"), F.lit(" and after it")).alias("text"))
    keys = TJ.matching_keys(texts, terms, "id")
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted(r["id"] for r in keys.collect()) == [i for i in range(3000) if i % 3 == 0 and i * 71 < 200_000]


def test_grams_are_not_rows(spark):
    """Only grams that pass the bitmap become rows: no row for each character of a text."""
    texts = spark.createDataFrame([(1, "some needle here"), (2, "x" * 1000)], "id long, text string")
    terms = spark.createDataFrame([("needle",)], "term string")
    found = TJ.term_matches(texts, terms, "id")
    assert "sequence(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [(1, "needle")]

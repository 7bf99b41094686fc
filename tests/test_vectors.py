"""Context vectors looked up in place and by regrouping give the same."""
import pytest
from pyspark.errors import PySparkException

from quipu.operators import vectors as VE


def _tables(spark):
    windows = spark.createDataFrame([(1, 0, [0, 1, 2]), (1, 1, [1, 2, 0]), (2, 0, [2, 2, 2])], "doc_key long, pos int, ctx array<int>")
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "token_id int, vector array<float>")
    return windows, vectors


def test_in_place_equals_regrouped(spark):
    windows, vectors = _tables(spark)
    for f in (VE.context_vectors_flat, VE.context_vectors_seq):
        place, grouped = f(windows, vectors, 2, max_rows=3, width=3), f(windows, vectors, 2)
        assert sorted(map(str, place.collect())) == sorted(map(str, grouped.collect()))
    assert "Exchange hashpartitioning" not in VE.context_vectors_flat(windows, vectors, 2, max_rows=3, width=3)._jdf.queryExecution().executedPlan().toString()


def test_missing_ids(spark):
    windows, vectors = _tables(spark)
    fewer = vectors.filter("token_id <> 1")
    got = {(r["doc_key"], r["pos"]): r["steps"] for r in VE.context_vectors_seq(windows, fewer, 2, max_rows=3, width=3).collect()}
    assert got[1, 0] == [[1.0, 2.0], [0.0, 0.0], [5.0, 6.0]]
    with pytest.raises(PySparkException):
        VE.context_vectors_flat(windows, fewer, 2, max_rows=3, width=3).collect()


def test_training_holds_nothing_on_the_driver(spark, monkeypatch):
    """No Spark ML model, whose table is the driver's; words of the same surroundings get near vectors."""
    import random

    import numpy as np
    from pyspark.ml import feature

    def refuse(*args, **kwargs):
        raise AssertionError("trained on the driver")
    monkeypatch.setattr(feature, "Word2Vec", refuse)
    rng = random.Random(5)
    themes = [["cat", "dog", "pet", "fur"], ["sun", "rain", "wind", "snow"]]
    rows = [(i, [rng.choice(themes[i % 2]) for _ in range(12)]) for i in range(2000)] + [(3000, ["rare", "rare", "cat"]), (3001, None), (3002, [])]
    docs = spark.createDataFrame(rows, "id long, tokens array<string>").repartition(3)
    for rounds in (1, 2):
        got = {r["word"]: np.array(r["vector"]) for r in VE.train_word_vectors(docs, dim=16, max_iter=rounds, partitions=2).collect()}
        assert set(got) == {w for t in themes for w in t}
        assert all(len(v) == 16 and np.isfinite(v).all() for v in got.values())

        def near(a, b, got=got):
            return got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])
        assert min(near(a, b) for t in themes for a in t for b in t) > max(near(a, b) for a in themes[0] for b in themes[1])

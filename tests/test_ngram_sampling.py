"""Invariants of the n-gram model and of the distribution operators."""
import math

from pyspark.sql import functions as F

from quipu.operators import ngram as NG
from quipu.operators import sampling as S
from quipu.operators import vocab as VO


def _model(spark):
    seqs = [[1, 1, 2, 3, 4, 2, 3, 5], [1, 1, 2, 3, 4, 6], [1, 1, 5, 2, 3]]
    rows, key = [], 0
    for d, s in enumerate(seqs):
        for i in range(len(s) - 2):
            rows.append((d, i, s[i:i + 2], s[i + 2]))
    w = spark.createDataFrame(rows, "doc_key long, pos int, ctx array<int>, label int")
    return NG.fit_ngram_model(w, 3, vocab_size=8)


def test_probabilities_sum_to_one(spark):
    m = _model(spark)
    for ctx in ([2, 3], [9, 9], [1, 1]):
        probe = spark.createDataFrame([(0, lab, ctx, lab) for lab in range(8)],
                                      "doc_key long, pos int, ctx array<int>, label int")
        total = NG.score_windows(probe, m, lambdas=(0.4,)).agg(F.sum("p")).first()[0]
        assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_predict_highest_order(spark):
    m = _model(spark)
    probe = spark.createDataFrame([(0, 0, [2, 3], 4)], "doc_key long, pos int, ctx array<int>, label int")
    assert NG.score_windows(probe, m).first()["pred"] == 4   # after (2, 3): 4 twice, 5 once


def test_model_table_schema(spark):
    t = _model(spark).table()
    assert [f.name for f in t.schema.fields] == ["k", "ctx", "label", "n", "ctx_n", "best"]
    row = t.filter("k = 2 AND label = 4").first()
    assert row["ctx"] == [2, 3] and row["n"] == 2 and row["ctx_n"] == 3


def _dist(spark):
    return spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.3), ("a", 3, 0.2), ("b", 7, 1.0)],
                                 "ctx_key string, token_id int, p double")


def test_temperature_and_filters_normalize(spark):
    for out in (S.apply_temperature(_dist(spark), 0.5), S.top_k(_dist(spark), 2), S.top_p(_dist(spark), 0.7)):
        for r in out.groupBy("ctx_key").agg(F.sum("p").alias("s")).collect():
            assert math.isclose(r["s"], 1.0)
    assert S.top_k(_dist(spark), 2).filter("ctx_key = 'a'").count() == 2
    assert S.top_p(_dist(spark), 0.7).filter("ctx_key = 'a'").count() == 2
    assert S.apply_temperature(_dist(spark), 0).filter("ctx_key = 'a'").first()["token_id"] == 1


def test_no_repeat_and_penalty(spark):
    d = _dist(spark).withColumn("hist", F.array(F.lit(9), F.lit(2), F.lit(9)))
    banned = {r["token_id"] for r in S.no_repeat_ngram(d, "hist", 2).filter("ctx_key = 'a'").collect()}
    assert banned == {1, 3}
    pen = {r["token_id"]: r["p"] for r in S.repetition_penalty(d, "hist", 2.0).filter("ctx_key = 'a'").collect()}
    assert pen[2] < 0.3


def test_sampling_deterministic_and_valid(spark):
    a = {r["ctx_key"]: r["token_id"] for r in S.sample_categorical(_dist(spark), 5).collect()}
    b = {r["ctx_key"]: r["token_id"] for r in S.sample_categorical(_dist(spark), 5).collect()}
    assert a == b and a["b"] == 7 and a["a"] in (1, 2, 3)


def test_predict_batch_user_model(spark):
    import numpy as np

    from quipu.operators.generate import predict_batch

    def make_fn():
        def predict(texts: np.ndarray) -> np.ndarray:
            return np.array([float(len(t.split())) for t in texts])
        return predict

    df = spark.createDataFrame([("a b c",), ("one",)], "text string")
    got = [r["prediction"] for r in predict_batch(df, make_fn, "text").collect()]
    assert got == [3.0, 1.0]


def test_prompt_grid_shape(spark):
    from quipu.operators.generate import prompt_grid
    g = prompt_grid(spark.createDataFrame([(1, "why")], "seq_id long, prompt string"))
    assert sorted((r["mode"], r["temperature"]) for r in g.collect()) == [
        ("beam", None), ("sample", 0.7), ("sample", 1.0), ("sample", 1.3)]


def test_salted_scoring_equals_plain(spark):
    m = _model(spark)
    probe = spark.createDataFrame([(d, i, [1, 1], lab) for d in range(3) for i, lab in enumerate([2, 5, 7])],
                                  "doc_key long, pos int, ctx array<int>, label int")
    plain = {(r["doc_key"], r["pos"]): (r["p"], r["pred"]) for r in NG.score_windows(probe, m).collect()}
    salted = {(r["doc_key"], r["pos"]): (r["p"], r["pred"])
              for r in NG.score_windows(probe, m, hot_min_count=1, salt_fanout=4).collect()}
    assert plain.keys() == salted.keys()
    for key, (p, pred) in plain.items():
        assert math.isclose(p, salted[key][0], rel_tol=1e-12) and pred == salted[key][1]


def test_fit_shuffles_its_windows_once_and_writes_one_table(spark):
    """All orders agree with counts by hand, for contexts that pack and that don't, and the
    pinned table is read by its bucket column without an exchange."""
    from collections import Counter
    docs = [[2, 2, 3, 4, 5, 3, 4, 5], [2, 3, 4, 3, 4, 5, 5], [1, 2, 3, 4]]
    encoded = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_key long, ids array<int>")
    wanted = Counter()
    for d in docs:
        for i in range(3, len(d)):
            wanted.update((k, tuple(d[i - k:i]), d[i]) for k in range(4))
    for size in (8, 1 << 40):
        m = NG.fit_ngram_model(VO.windows(encoded, 4), 4, size)
        rows = m.table().collect()
        assert {(r["k"], tuple(r["ctx"]), r["label"]): r["n"] for r in rows} == wanted and len(rows) == len(wanted)
        for r in rows:
            mine = {x: n for (k, c, x), n in wanted.items() if (k, c) == (r["k"], tuple(r["ctx"]))}
            assert r["ctx_n"] == sum(mine.values()) and r["best"] == min(mine, key=lambda x: (-mine[x], x))
        assert m.contexts.count() == len({(k, c) for k, c, _ in wanted})
        plan = m.rows.groupBy("home").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan

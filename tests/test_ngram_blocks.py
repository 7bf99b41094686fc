"""The packed model as blocks: counts, scores and generation never make its rows a table."""
from collections import Counter

from pyspark.sql import functions as F

from quipu.operators import generate as GE
from quipu.operators import ngram as NG
from quipu.operators import ngram_blocks as NB
from quipu.operators import vocab as VO


def _encoded(spark):
    docs = [[2, 2, 2, *[3 + (i * i + j * (i % 3 + 1)) % 7 for j in range(5 + i % 6)], 2] for i in range(40)]
    return docs, spark.createDataFrame(list(enumerate(docs)), "doc_key long, ids array<int>")


def test_blocks_hold_every_count(spark, monkeypatch):
    """Parts and blocks of a few rows give the counts by hand: a context is whole, its labels in order."""
    monkeypatch.setattr(NB, "PART_ROWS", 7)
    monkeypatch.setattr(NB, "BLOCK_ROWS", 3)
    docs, encoded = _encoded(spark)
    model = NG.fit_ngram_model(VO.windows(encoded, 4), 4, 12)
    assert model.blocks is not None and model.table_rows is None
    wanted = Counter((k, tuple(d[i - k:i]), d[i]) for d in docs for i in range(3, len(d)) for k in range(4))
    rows = model.table().collect()
    assert {(r["k"], tuple(r["ctx"]), r["label"]): r["n"] for r in rows} == wanted and len(rows) == len(wanted)
    assert model.order_rows(2).count() == sum(k == 2 for k, _, _ in wanted)
    assert model.contexts.count() == len({(k, c) for k, c, _ in wanted})


def test_scores_and_generation_read_blocks_alone(spark):
    """As by the rows of the model, but no table of its rows is written."""
    _, encoded = _encoded(spark)
    windows = VO.windows(encoded, 4).filter("pos % 3 = 0")
    model = NG.fit_ngram_model(VO.windows(encoded.filter("doc_key % 4 > 0"), 4), 4, 12)
    got = {(r["doc_key"], r["pos"]): r for r in NG.score_windows(windows, model, (0.3, 0.6), (2, 4)).collect()}
    prompts = encoded.filter("doc_key < 6").select(F.col("doc_key").alias("seq_id"), F.slice("ids", 1, 5).alias("ids"))
    made = [GE.generate_sampled(prompts, model, [2], 3, max_steps=5), GE.generate_beam(prompts, model, [2], 2, 5, repetition=1.2, no_repeat=2)]
    made = [{r["seq_id"]: (r["ids"], r["n_new"], r["done"]) for r in x.collect()} for x in made]
    assert model.table_rows is None
    plain = NG.NgramModel(model.rows, 4, 12, model.bits)
    want = {(r["doc_key"], r["pos"]): r for r in NG.score_windows(windows, plain, (0.3, 0.6), (2, 4)).collect()}
    assert got.keys() == want.keys()
    for key, r in got.items():
        assert r["pred"] == want[key]["pred"] and all(abs(r[f"p_{i}"] - want[key][f"p_{i}"]) < 1e-12 for i in range(4))
    other = [GE.generate_sampled(prompts, plain, [2], 3, max_steps=5), GE.generate_beam(prompts, plain, [2], 2, 5, repetition=1.2, no_repeat=2)]
    assert made == [{r["seq_id"]: (r["ids"], r["n_new"], r["done"]) for r in x.collect()} for x in other]


def test_distributions_shuffle_numbers_alone(spark, tmp_path):
    """Windows are shuffled once, by the packed context; texts are made of what comes out."""
    from quipu.plans import catalog as K
    text = "the cat sat on the mat and the dog sat on the cat and the mat"
    docs = spark.createDataFrame([(i, text[i:], "en", "web", len(text) - i) for i in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("repetition_penalty", "no_repeat_ngram"):
        q = K.QUERIES[name](spark, str(tmp_path))
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(ctx_key" not in plan and plan.count("Exchange hashpartitioning(ctx#") == 1
        for r in q.groupBy("ctx_key").agg(F.sum("p").alias("s")).collect():
            assert abs(r["s"] - 1) < 1e-6

"""Alias tables hold every id's exact count, and draws follow the distribution."""
import random
from collections import Counter

from pyspark.sql import functions as F

from quipu.operators import alias as AL


def _rows(rng):
    out = []
    for c in range(120):
        for label in rng.sample(range(2, 400), rng.randrange(1, 30)):
            out.append((c % 4, c, label, rng.choice([1, 1, 2, 3, 50, 1000])))
    return out + [(0, 900, 5, 7), (0, 901, 5, 0), (0, 902, None, 3)] + [(1, 903, i, 4) for i in range(10)]


def test_tables_hold_exact_counts(spark):
    rows = _rows(random.Random(6))
    tables = AL.alias_tables(spark.createDataFrame(rows, "k int, ctx long, label int, n long").repartition(5)).collect()
    units, slots = Counter(), Counter()
    for r in tables:
        assert 0 <= r.threshold <= r.total and (r.alias_id is not None or r.threshold == r.total)
        units[r.k, r.ctx, r.token_id] += r.threshold
        if r.alias_id is not None:
            units[r.k, r.ctx, r.alias_id] += r.total - r.threshold
        slots[r.k, r.ctx] += 1
    m = Counter((k, c) for k, c, label, n in rows if n and label is not None)
    assert slots == m
    assert {x: v for x, v in units.items() if v} == {(k, c, label): n * m[k, c] for k, c, label, n in rows if n and label is not None}


def test_draws_follow_the_distribution(spark):
    counts = spark.createDataFrame([(1, 7, 10, 60), (1, 7, 11, 30), (1, 7, 12, 9), (1, 7, 13, 1), (2, 8, 5, 1)], "k int, ctx long, label int, n long")
    tables = AL.alias_tables(counts)
    asked = spark.range(20000).select("id", F.lit(1).alias("k"), F.lit(7).cast("long").alias("ctx")).unionByName(
        spark.range(5).select("id", F.lit(2).alias("k"), F.lit(8).cast("long").alias("ctx"))).unionByName(
        spark.range(5).select("id", F.lit(3).alias("k"), F.lit(8).cast("long").alias("ctx")))
    once = AL.alias_draws(asked, tables, ["id", "k"], seed=3)
    got = Counter((r.k, r.token_id) for r in once.collect())
    assert got[2, 5] == 5 and sum(got.values()) == 20005
    for label, share in ((10, 0.6), (11, 0.3), (12, 0.09), (13, 0.01)):
        assert abs(got[1, label] / 20000 - share) < 0.015
    again = AL.alias_draws(asked.repartition(7), tables, ["id", "k"], seed=3)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_no_frame_shrinks_towards_its_end(spark):
    """A frame from the next row to the last is read again for every row: quadratic in a context."""
    counts = spark.createDataFrame([("a", i, 1 + i % 7) for i in range(50)], "ctx string, label int, n long")
    plan = AL.alias_tables(counts, ["ctx"])._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe(RowFrame, 1, unboundedfollowing" not in plan

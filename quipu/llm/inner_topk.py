"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped into bands of like length.  Each query has a lower bound for its k-th
score from the longest vectors; a band whose greatest length cannot reach it is never
visited.  In a band the bound becomes a local cosine threshold.  Where that is high, the
query's two largest coordinates bound the coordinates of a candidate (coordinate pruning),
else candidates are cut by their own length (length pruning).  What is left is verified by
exact integer products.

How it scales.  Queries and bands meet in blocks of bounded size: a band is dealt over groups
of ``GROUP`` vectors, queries over blocks of ``QUERIES``, whatever share of rows a band has.
Only lengths and counts of the bands, and ``SEED`` vectors for the first bounds, reach the
driver.  The k best of each block are merged by a window over queries.

Defined results: vectors without id, null, or with null or non-finite components take no
part; shorter vectors count as filled up with zeros; a query's own id is no candidate; a
score beyond a long is clamped; a repeated row is a candidate, or a query, of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.common import matrix_of, table_of, vectors_of
from quipu.operators.corpus import pin_table

GROUP, QUERIES, SEED = 4096, 1024, 512
BAND = 1.05            # lengths of a band differ by this factor at most
HIGH_COSINE = 0.3      # from here on coordinates prune better than lengths
SLACK = 1 + 1e-9
LONG = np.iinfo(np.int64)
_ROWS = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("norm", pa.float64())])


def scaled_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, v, norm) of all rows that take part; v holds floor(scale * x) as doubles."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("vec_id").to_pylist(), vectors_of(batch.column("v"))
            kept = [(i, np.floor(scale * x)) for i, x in zip(ids, rows, strict=True) if x is not None and i is not None]
            yield table_of({"vec_id": [i for i, _ in kept], "v": [x.astype("<f8").tobytes() for _, x in kept],
                            "norm": [float(np.sqrt(x @ x)) for _, x in kept]}, _ROWS)

    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
            .mapInArrow(run, "vec_id long, v binary, norm double"))


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while all sums stay below 2^53, else in Python's integers."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, rows.shape[1])
    if most < 2.0 ** 53:
        return (rows @ query).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, query, strict=True)) for r in rows]
    return np.array([min(max(x, LONG.min), LONG.max) for x in exact], np.int64)


def pick(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def candidates(unit: np.ndarray, norms: np.ndarray, query: np.ndarray, size: float, least: float) -> np.ndarray:
    """Places of a band's vectors, longest first, that may reach a score of ``least``."""
    if least <= 0 or not len(norms):
        return np.arange(len(norms))
    n = int(np.searchsorted(-norms, -least / (size * SLACK), "right")) if size else 0
    cosine = least / (size * norms[0] * SLACK) if size * norms[0] > 0 else 2.0
    if n == 0 or cosine > 1:
        return np.arange(0)
    if cosine < HIGH_COSINE:
        return np.arange(n)
    fits = np.ones(n, bool)
    reach = np.arccos(min(1.0, cosine))
    for f in np.argsort(-np.abs(query))[:2]:
        angle = np.arccos(np.clip(query[f] / size, -1, 1))
        low = np.cos(min(np.pi, angle + reach)) - 1e-9
        high = np.cos(max(0.0, angle - reach)) + 1e-9
        fits &= (unit[:n, f] >= low) & (unit[:n, f] <= high)
    return np.flatnonzero(fits)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query.  ``is_query`` is a
    condition on the column vec_id."""
    rows = pin_table(scaled_vectors(vectors, id_col, vec_col, scale), "vectors")
    band = F.when(F.col("norm") > 0, F.floor(F.log("norm") / np.log(BAND))).otherwise(-100_000).cast("int")
    bands = rows.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.max("norm").alias("top")).collect()
    seed = rows.orderBy(F.desc("norm"), "vec_id").limit(SEED).select("vec_id", "v").collect()
    seed_ids, seeds = np.array([r["vec_id"] for r in seed], np.int64), matrix_of([bytes(r["v"]) for r in seed])
    asked = rows.filter(is_query).withColumn("row", F.monotonically_increasing_id())
    n_blocks = max(1, -(-asked.count() // QUERIES))

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                query = np.frombuffer(v, "<f8")
                d = max(len(query), seeds.shape[1])
                wide = np.pad(seeds, ((0, 0), (0, d - seeds.shape[1])))
                got = np.sort(products(wide, np.pad(query, (0, d - len(query))))[seed_ids != i])
                least.append(float(got[-k]) if len(got) >= k else -np.inf)
            yield batch.append_column("least", pa.array(least, pa.float64()))

    asked = asked.mapInArrow(bound, "vec_id long, v binary, norm double, row long, least double")
    table = F.array(*[F.struct(F.lit(b["band"]).alias("band"), F.lit(-(-b["n"] // GROUP)).alias("groups"),
                               F.lit(float(b["top"])).alias("top")) for b in bands])
    groups = F.element_at(F.create_map(*[F.lit(x) for b in bands for x in (b["band"], -(-b["n"] // GROUP))]), F.col("band"))
    schema = "query_id long, row long, vec_id long, score long"
    if not bands:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # a band that can't reach the bound is left out here
    visits = (asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int"))
              .select("*", F.explode(F.filter(table, lambda b: b["top"] * F.col("norm") * SLACK >= F.col("least"))).alias("to"))
              .select("*", "to.band", F.explode(F.sequence(F.lit(0), F.col("to.groups") - 1)).alias("group")).drop("to"))
    held = (rows.withColumn("band", band)
            .withColumn("group", F.pmod(F.xxhash64("vec_id", F.lit(7)), groups).cast("int"))
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")))

    def best(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "row": [], "vec_id": [], "score": []}
        held = held.sort_values("norm", ascending=False)
        x, q = matrix_of(held["v"].tolist()), matrix_of(asked["v"].tolist())
        d = max(x.shape[1], q.shape[1])
        x, q = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (x, q))
        norms, ids = held["norm"].to_numpy(), held["vec_id"].to_numpy()
        unit = x / np.maximum(norms, 1e-300)[:, None]
        for i, row, size, least, query in zip(asked["vec_id"], asked["row"], asked["norm"], asked["least"], q, strict=True):
            at = candidates(unit, norms, query, size, least)
            at = at[ids[at] != i]
            score = products(x[at], query)
            top = pick(score, ids[at], k)
            for name, values in (("query_id", [i] * len(top)), ("row", [row] * len(top)),
                                 ("vec_id", ids[at][top].tolist()), ("score", score[top].tolist())):
                out[name] += values
        return pd.DataFrame(out).astype("int64")

    keys = ["band", "group", "block"]
    found = visits.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(best, schema)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

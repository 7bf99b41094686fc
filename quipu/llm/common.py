"""Helpers shared by the operators of this subpackage.

Row identity: ids may be null or repeated, so rows are joined on ``row_key``, a 64-bit
hash of (id, text).  Two rows with the same id and text share a key and get the same
result, once for each row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.operators.corpus import pin_table

U64 = np.uint64
MIX1, MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * MIX1
    x = (x ^ (x >> U64(27))) * MIX2
    return x ^ (x >> U64(31))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that no other column
    of the input can clash with a column made here."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def one_of_each(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a row key ``rk`` as (one row of each key, with a flag ``repeated``; all rows of
    the keys that have several).  Counts are pre-aggregated, and only repeated rows move."""
    several = pin_table(rows.groupBy("rk").count().filter("count > 1").select("rk"), "repeated")
    if several.isEmpty():
        return rows.withColumn("repeated", F.lit(False)), rows.limit(0)
    repeats = rows.join(several, "rk", "left_semi")
    single = rows.join(several, "rk", "left_anti").withColumn("repeated", F.lit(False))
    return single.unionByName(repeats.dropDuplicates(["rk"]).withColumn("repeated", F.lit(True))), repeats


def byte_list(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as bytes."""
    return column.cast(pa.large_binary()).to_pylist()


def table_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def cut_rows(batches: Iterator[pa.RecordBatch], text_col: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``most`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(text_col).cast(pa.large_binary())
        lengths = np.diff(np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset:sizes.offset + len(sizes) + 1])
        group = np.cumsum(lengths) // most
        starts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition as links of each node with the smallest it is connected with here."""
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while (up := root.setdefault(i, i)) != i:
            root[i] = root[up]
            i = root[i]
        return i

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            if a is not None and b is not None and (x := find(a)) != (y := find(b)):
                root[max(x, y)] = min(x, y)
    nodes = [i for i in root if find(i) != i]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(i) for i in nodes], pa.int64())], names=["a", "b"])


def connected(edges: DataFrame, name: str = "links") -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (node, component), component
    being the smallest node reached; nodes without an edge have no row.

    Alternating large-star and small-star rounds: each round is two aggregates that combine
    map-side and two joins on the node, which adaptive execution splits where a node is hot.
    Each partition first turns its own links into stars, which spares rounds.  The number of
    rounds is logarithmic; each round is written to the shared folder.
    """
    pairs = pin_table(edges.select("a", "b").mapInArrow(_stars, "a long, b long"), name)
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        pairs = pin_table(small, name)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    # stars by now: a node has one link, to the smallest
    return (pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))


def vectors_of(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector of a list column; None if it is null or holds a null or non-finite value."""
    bounds = column.offsets.to_numpy()
    values = column.values
    x = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    valid = np.asarray(column.is_valid())
    return [x[a:b] if ok and bad[a] == bad[b] else None
            for a, b, ok in zip(bounds[:-1].tolist(), bounds[1:].tolist(), valid.tolist(), strict=True)]


def matrix_of(rows: list[bytes], dtype: str = "<f8") -> np.ndarray:
    """Vectors from bytes, shorter ones filled up with zeros."""
    vectors = [np.frombuffer(r, dtype) for r in rows]
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


_BASE = 0x9E3779B97F4A7C15 | 5
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, U64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


class RunHashes:
    """64-bit hashes of any run of a sequence of 64-bit symbols, from one prefix sum."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        power, self.inverse = _powers(n + 1)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(symbols * power[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def all(self, size: int) -> np.ndarray:
        """Of every run of ``size`` symbols."""
        if len(self.sums) <= size:
            return np.zeros(0, U64)
        return mix64((self.sums[size:] - self.sums[:-size]) * self.inverse[:len(self.sums) - size])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value in each window of ``width``, of equals the leftmost.  Values
    are told apart by their upper 32 bits, so equal windows agree on the place."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    packed = np.full(-(-n // width) * width, ~U64(0), U64)
    packed[:n] = (values & U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=U64)
    blocks = packed.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n - width + 1], ahead[width - 1:n]) & U64(0xFFFFFFFF)).astype(np.int64)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of n places that lie in any [start, end)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.subtract.at(step, ends, 1)
    return np.cumsum(step[:-1]) > 0


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that agree in ``keys``, from batches in which they come together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        new = np.zeros(batch.num_rows - 1, bool)
        for c in cols:
            new |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)

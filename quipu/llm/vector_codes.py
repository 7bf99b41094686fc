"""Vector code compression: product codebooks learned with LAESA pivots.

Components become integers (floor of ``SCALE`` times the value) and each vector is cut into
``PARTS`` equal parts.  Each part position has a codebook, at first the parts of the vectors of
smallest ids; ``ROUNDS`` times every part goes to its nearest entry and every entry becomes the
floored mean of its parts; then all parts are assigned again.

Nearest entries are found by the linear approximating and eliminating search algorithm
(LAESA): the distances of each part to ``PIVOTS`` fixed pivots are computed once, and stored
with the part.  In each round the distances from pivots to entries give a lower bound for every
(part, entry), the largest difference |d(part, pivot) - d(pivot, entry)|.  Entries are
evaluated in the order of their bounds, in exact integers, until the next bound is beyond the
best distance found.  Bounds are doubles and are widened by more than their rounding, so no
nearest entry is ever pruned; ties go to the lower index.

How it scales.  Vectors are read once and written as integers with their pivot distances;
each round reads that table and gives one sum for each (entry, component) and task, which
Spark adds up.  Codebooks (``PARTS * ENTRIES`` entries) are all that reaches the driver.
Errors by label are pre-aggregated; the join back is a broadcast if there are at most
``BROADCAST_LABELS`` labels, else salted, so a label of a third of all rows is spread.

Defined results: rows whose vector is null or holds a null or non-finite component are
dropped; a shorter vector is filled up with zeros, and so is the longest up to a multiple of
``PARTS``; null ids come after all others; rows of one id are ordered by components; fewer
than ``ENTRIES`` vectors give as many entries.  Components beyond what keeps a squared
distance below 2^60 (2^27 for 16-component parts) are cut to that.  Sums beyond 64 bits are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import vectors_of
from quipu.operators.corpus import pin_table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
PIVOTS = 8
BROADCAST_LABELS = 100_000
SALTS = 32
_AT_ONCE = 1024     # vectors compared together
_FEW = 8            # entries evaluated before bounds are looked at again


def widest(width: int) -> int:
    """The largest component for which squared distances of a part stay below 2^60."""
    doublings = (width - 1).bit_length()    # width <= 2^doublings
    return 1 << (29 - -(-doublings // 2))


def integers_of(vector: np.ndarray, dims: int, scale: int, limit: int) -> np.ndarray:
    out = np.zeros(dims, np.int64)
    out[:len(vector)] = np.clip(np.floor(vector * float(scale)), -limit, limit).astype(np.int64)
    return out


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``y``."""
    d = x[:, None, :] - y[None, :, :]
    return np.einsum("abi,abi->ab", d, d)


def choose_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Entries far from each other: the first, then always the farthest from those chosen."""
    chosen, far = [0], distances(entries, entries[:1])[:, 0]
    while len(chosen) < min(n, len(entries)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, from_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each part the index of the nearest entry, its exact squared distance, and the
    number of distances evaluated for all of them.

    ``to_pivots`` are the parts' distances to the pivots, ``from_pivots`` the entries'."""
    n, m = len(x), len(entries)
    bound = np.zeros((n, m))
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - from_pivots[None, :, p]), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, 1)
    slack = 1e-9 + 1e-12 * max(to_pivots.max(initial=0), from_pivots.max(initial=0))
    best, code = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    live, evaluated = np.arange(n), 0
    for at in range(0, m, _FEW):
        if at:
            live = live[bound[live, at] <= np.sqrt(best[live].astype(np.float64)) * (1 + 1e-12) + slack]
        if not len(live):
            break
        some = order[live, at:at + _FEW]
        d = x[live, None, :] - entries[some]
        d = np.einsum("abi,abi->ab", d, d)
        evaluated += d.size
        least = d.min(1)
        index = np.where(d == least[:, None], some, m).min(1)
        better = (least < best[live]) | ((least == best[live]) & (index < code[live]))
        best[live[better]], code[live[better]] = least[better], index[better]
    return code, best, evaluated


class Codebooks:
    """Entries of each part position, and the distances of the pivots to them."""

    def __init__(self, entries: np.ndarray, pivots: list[np.ndarray]) -> None:
        self.entries, self.pivots = entries, pivots     # entries: part x entry x component
        self.from_pivots = [np.sqrt(distances(e, p).astype(np.float64)) for e, p in zip(entries, pivots, strict=True)]

    def assign(self, x: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared distances (vector x part) of vectors cut into parts."""
        code, error = np.empty(x.shape[:2], np.int64), np.empty(x.shape[:2], np.int64)
        at = 0
        for p, entries in enumerate(self.entries):
            width = self.pivots[p].shape[0]
            code[:, p], error[:, p], _ = nearest(x[:, p], to_pivots[:, at:at + width], entries, self.from_pivots[p])
            at += width
        return code, error

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _blocks(batch: pa.RecordBatch, parts: int, dims: int, n_pivots: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    for a in range(0, batch.num_rows, _AT_ONCE):
        some = slice(a, min(a + _AT_ONCE, batch.num_rows))
        part = batch.slice(some.start, some.stop - some.start)
        x = np.frombuffer(b"".join(part.column("integers").to_pylist()), np.int64).reshape(-1, parts, dims // parts)
        far = np.frombuffer(b"".join(part.column("far").to_pylist()), np.float64).reshape(-1, n_pivots)
        yield some, x, far


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks, dims: int, n_pivots: int) -> Iterator[pa.RecordBatch]:
    """Sums and counts of the parts of each entry, as (cell, value): the sum of component j of
    entry e of part p is cell (p * entries + e) * (width + 1) + j, the count comes last."""
    parts, m, width = books.entries.shape
    total = np.zeros((parts, m, width + 1), np.int64)
    for batch in batches:
        for _, x, far in _blocks(batch, parts, dims, n_pivots):
            code, _ = books.assign(x, far)
            for p in range(parts):
                np.add.at(total[p, :, :width], code[:, p], x[:, p])
                total[p, :, width] += np.bincount(code[:, p], minlength=m)
    used = np.flatnonzero(np.repeat(total[:, :, width].ravel() > 0, width + 1))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total.ravel()[used])], names=["cell", "value"])


def _moved(books: Codebooks, table: DataFrame, dims: int, n_pivots: int) -> Codebooks:
    """Codebooks whose entries are the floored means of the parts assigned to them."""
    parts, m, width = books.entries.shape
    sums = table.select("integers", "far").mapInArrow(lambda x: _sums(x, books, dims, n_pivots), "cell long, value long")
    sums = sums.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    total = [[0] * (width + 1) for _ in range(parts * m)]
    for cell, value in sums.collect():      # one row for each component of an entry at most
        total[cell // (width + 1)][cell % (width + 1)] = int(value)
    entries = books.entries.reshape(-1, width).copy()
    for e, (*s, n) in enumerate(total):
        if n:
            entries[e] = [v // n for v in s]
    return Codebooks(entries.reshape(parts, m, width), books.pivots)


def _with_label_errors(codes: DataFrame) -> DataFrame:
    """Add the sum of ``error`` over the rows of the same ``label``, nulls together."""
    sums = pin_table(codes.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors")
    names = ("same_label", "label_error")
    if sums.count() <= BROADCAST_LABELS:
        right = F.broadcast(sums.toDF(*names))
        return codes.join(right, F.col("label").eqNullSafe(F.col("same_label")), "left").drop("same_label")
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    right = sums.toDF(*names).withColumn("same_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    both = F.col("label").eqNullSafe(F.col("same_label")) & (F.col("salt") == F.col("same_salt"))
    return salted.join(right, both, "left").drop("same_label", "salt", "same_salt")


def learn_codebooks(rows: DataFrame, parts: int, entries: int, rounds: int, scale: int,
                    pivots: int) -> tuple[Codebooks, DataFrame, int, int] | None:
    """Codebooks of ``rows`` (vec_id, label, vector), the pinned table of their integers and
    pivot distances, the number of components and of pivots; None without a vector."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = vectors_of(batch.column("vector"))
            ok = [v is not None for v in found]
            kept = batch.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("vec_id"), kept.column("label"),
                                              pa.array([v.astype("<f8").tobytes() for v in found if v is not None], pa.binary())],
                                             names=["vec_id", "label", "vector"])

    label_type = rows.schema["label"].dataType.simpleString()
    head = f"vec_id long, label {label_type}"
    kept = rows.mapInArrow(keep, f"{head}, vector binary")
    longest = kept.agg(F.max(F.octet_length("vector"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-(longest // 8) // parts))
    dims, limit = width * parts, widest(width)

    def to_integers(column: pa.Array) -> list[np.ndarray]:
        return [integers_of(np.frombuffer(v, "<f8"), dims, scale, limit) for v in column.to_pylist()]

    first = [integers_of(np.frombuffer(bytes(r.vector), "<f8"), dims, scale, limit)
             for r in kept.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()]
    start = np.stack(first).reshape(len(first), parts, width).transpose(1, 0, 2)
    fixed = [choose_pivots(e, pivots) for e in start]
    n_pivots = sum(map(len, fixed))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            integers = to_integers(batch.column("vector"))
            x = np.array(integers, np.int64).reshape(-1, parts, width)
            far = np.empty((len(x), n_pivots))
            for a in range(0, len(x), _AT_ONCE):
                far[a:a + _AT_ONCE] = np.concatenate([np.sqrt(distances(x[a:a + _AT_ONCE, p], f).astype(np.float64))
                                                      for p, f in enumerate(fixed)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([v.tobytes() for v in x], pa.binary()),
                 pa.array([v.tobytes() for v in far], pa.binary())], names=["vec_id", "label", "integers", "far"])

    table = pin_table(kept.mapInArrow(measure, f"{head}, integers binary, far binary"), "parts")
    books = Codebooks(np.ascontiguousarray(start), fixed)
    for _ in range(rounds):
        books = _moved(books, table, dims, n_pivots)
    return books, table, dims, n_pivots


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             pivots: int = PIVOTS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256): one row for each vector
    that is kept.  ``code`` holds each part's entry as two hex digits (more where there are
    more than 256 entries)."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    label_type = rows.schema["label"].dataType.simpleString()
    head = f"vec_id long, label {label_type}, code string, error long"
    learned = learn_codebooks(rows, parts, entries, rounds, scale, pivots)
    if learned is None:
        return rows.sparkSession.createDataFrame([], f"{head}, label_error long, codebooks_sha256 string")
    books, table, dims, n_pivots = learned
    digits = max(2, len(f"{entries - 1:x}"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for _, x, far in _blocks(batch, parts, dims, n_pivots):
                code, error = books.assign(x, far)
                codes += ["".join(f"{c:0{digits}x}" for c in row) for row in code.tolist()]
                errors.append(error.sum(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                 pa.array(np.concatenate(errors) if errors else np.zeros(0, np.int64))], names=["vec_id", "label", "code", "error"])

    codes = pin_table(table.mapInArrow(encode, head), "codes")
    return _with_label_errors(codes).withColumn("codebooks_sha256", F.lit(books.sha256()))

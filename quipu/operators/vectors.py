"""Word vectors: training and lookups.

The vector table has one row per vocabulary entry (bounded by the vocabulary
cap).  When rows x dims is under a checked budget it is broadcast, and each
place of a context is looked up where it stands, without an exchange; else
context ids are exploded, joined by shuffle and regrouped per window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.operators.corpus import pin_table

BROADCAST_FLOATS_MAX = 64_000_000      # rows * dims (~256 MB of floats)
DEFAULT_DIM = 100
BLOCK = 4_000_000               # tokens trained in one task
STEP, SHARED, NEGATIVE = 4096, 64, 5    # words at once, words drawn for them, negative words a pair
CALM = 16
RATE, LAST_RATE = 0.025, 0.0001


def _noise(n: int, dim: int, hashes: np.ndarray, seed: int) -> np.ndarray:
    """Start vectors: components in (-0.5, 0.5) / dim, told by the word's hash."""
    x = hashes.view(np.uint64)[:, None] + np.uint64(seed) + np.arange(1, dim + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    unit = (x >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
    return (unit - np.float32(0.5)) / np.float32(dim)


def _add_rows(table: np.ndarray, at: np.ndarray, grads: np.ndarray) -> None:
    """Add each row's gradient; a row that occurs often in a step gets as much as ``CALM`` mean ones."""
    order = np.argsort(at, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(at[order]) != 0))
    times = np.diff(np.append(first, len(at)))
    sums = np.add.reduceat(grads[order], first, axis=0)
    table[at[order][first]] += sums * np.minimum(1, CALM / times)[:, None].astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _train_block(ids: np.ndarray, owner: np.ndarray, n: np.ndarray, centres: np.ndarray, contexts: np.ndarray,
                 window: int, rates: tuple[float, float], rng: np.random.Generator) -> None:
    """Skip-gram with negative sampling over the words of a block, ``STEP`` words at once: every
    pair of words at most a drawn reach apart, against ``SHARED`` words drawn for the step."""
    chance = np.cumsum(n.astype(np.float64) ** 0.75)
    reach = rng.integers(1, window + 1, len(ids))
    for at in range(0, len(ids), STEP):
        rate = np.float32(rates[0] + (rates[1] - rates[0]) * at / len(ids))
        x, doc, far = (v[at:at + STEP + window] for v in (ids, owner, reach))
        m = min(STEP, len(x))       # pairs belong to the step of their first word
        h, o = centres[x], contexts[x]
        gh, go, pairs = np.zeros_like(h), np.zeros_like(o), np.zeros(len(x), np.float32)
        for d in range(1, window + 1):
            last = min(m, len(x) - d)
            if last <= 0:
                break
            left, right = slice(0, last), slice(d, last + d)
            together = doc[left] == doc[right]
            for a, b in ((left, right), (right, left)):
                on = (together & (far[a] >= d)).astype(np.float32)
                g = (rate * on * (1 - _sigmoid(np.einsum("ij,ij->i", h[a], o[b]))))[:, None]
                gh[a] += g * o[b]
                go[b] += g * h[a]
                pairs[a] += on
        drawn = np.minimum(np.searchsorted(chance, rng.random(SHARED) * chance[-1], "right"), len(n) - 1)
        other = contexts[drawn]
        g = -rate * _sigmoid(h @ other.T) * (pairs * (NEGATIVE / SHARED))[:, None].astype(np.float32)
        g[x[:, None] == drawn[None, :]] = 0
        gh += g @ other
        _add_rows(centres, x, gh)
        _add_rows(contexts, np.concatenate([x, drawn]), np.concatenate([go, g.T @ h]))


def _trainer(dim: int, window: int, seed: int, epoch: int, epochs: int):
    """Trains the words of one block (cogrouped with what is held of them) -> (word, n, v0, v1)."""
    def run(key: tuple[pa.Scalar, ...], texts: pa.Table, held: pa.Table) -> pa.Table:
        columns = {f: pa.array([], t) for f, t in (("word", pa.string()), ("n", pa.int64()), ("v0", pa.list_(pa.float32())), ("v1", pa.list_(pa.float32())))}
        if not texts.num_rows or not held.num_rows:
            return pa.table(columns)
        held = held.combine_chunks()
        words, tokens = held.column("word").combine_chunks(), texts.column("tokens").combine_chunks()
        sizes = np.diff(tokens.offsets.to_numpy())
        found = pc.index_in(tokens.flatten(), value_set=words).fill_null(-1).to_numpy(zero_copy_only=False)
        owner, known = np.repeat(np.arange(len(sizes)), sizes), found >= 0
        ids = found[known].astype(np.int64)
        if epoch:
            centres, contexts = (held.column(c).combine_chunks().flatten().to_numpy().reshape(-1, dim).copy() for c in ("v0", "v1"))
        else:
            centres = _noise(len(words), dim, held.column("hash").to_numpy().copy(), seed)
            contexts = np.zeros((len(words), dim), np.float32)
        rates = tuple(RATE - (RATE - LAST_RATE) * e / epochs for e in (epoch, epoch + 1))
        _train_block(ids, owner[known], held.column("n").to_numpy(), centres, contexts, window, rates,
                     np.random.default_rng([seed, epoch, key[0].as_py()]))
        here = np.bincount(ids, minlength=len(words))

        def lists(x: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * dim), pa.array(x.ravel()))

        last = epoch + 1 == epochs      # context vectors are needed by a further epoch only
        v1 = pa.nulls(len(words), pa.list_(pa.float32())) if last else lists(contexts)
        return pa.table({"word": words, "n": pa.array(here), "v0": lists(centres), "v1": v1})
    return run


def train_word_vectors(docs: DataFrame, tokens_col: str = "tokens", dim: int = DEFAULT_DIM,
                       window: int = 5, min_count: int = 3, seed: int = 42,
                       max_iter: int = 1, partitions: int = 1) -> DataFrame:
    """Skip-gram vectors with negative sampling -> (word, vector array<float>), one row for
    each word that occurs ``min_count`` times or more.

    Documents are dealt at random to blocks of about ``BLOCK`` tokens (``partitions`` at least).
    In each of ``max_iter`` rounds a block is trained in one task, together with the vectors of
    its own words; the blocks' vectors of a word are then averaged, weighted by how often it
    occurs there.  Vocabulary and vectors are tables: nothing of them is held on the driver,
    and a task holds the words of its block.
    """
    tokens = docs.select(F.col(tokens_col).alias("tokens"), F.rand(seed).alias("u"))
    texts = pin_table(tokens.filter("tokens is not null"), "texts")
    blocks = max(partitions, -(-int(texts.agg(F.sum(F.size("tokens").cast("long"))).first()[0] or 0) // BLOCK))
    texts = texts.select(F.floor(F.col("u") * blocks).cast("int").alias("block"), "tokens")
    each = texts.select("block", F.explode("tokens").alias("word")).groupBy("block", "word").agg(F.count("*").alias("here"))
    each = pin_table(each, "block-words")
    vocab = each.groupBy("word").agg(F.sum("here").alias("n")).filter((F.col("n") >= min_count) & F.col("word").isNotNull())
    state = pin_table(vocab.select("word", "n", F.xxhash64("word").alias("hash")), "words")
    for epoch in range(max_iter):
        held = each.select("block", "word").join(state, "word")
        trained = texts.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(
            _trainer(dim, window, seed, epoch, max_iter), "word string, n long, v0 array<float>, v1 array<float>")
        wide = [F.sum(F.col(v)[i] * F.col("n")).alias(f"{v}_{i}") for v in ("v0", "v1")[:1 if epoch + 1 == max_iter else 2] for i in range(dim)]
        means = trained.groupBy("word").agg(F.sum("n").alias("n"), *wide)
        vectors = [F.array(*[(F.col(f"{v}_{i}") / F.col("n")).cast("float") for i in range(dim)]).alias(v) for v in ("v0", "v1") if f"{v}_0" in means.columns]
        state = pin_table(means.select("word", "n", *vectors), "vectors")
    return state.select("word", F.col("v0").alias("vector"))


def _fits(dim: int, max_rows: int | None) -> bool:
    return max_rows is not None and max_rows * dim <= BROADCAST_FLOATS_MAX


def _vector_side(vectors: DataFrame, dim: int, max_rows: int | None) -> DataFrame:
    """Vectors of ids below ``max_rows``; broadcast only if that many fit."""
    if max_rows is None:
        return vectors
    vectors = vectors.filter(F.col("token_id").between(0, max_rows - 1))
    return F.broadcast(vectors) if _fits(dim, max_rows) else vectors


def _by_slot(windows: DataFrame, vectors: DataFrame, keys: list[str], width: int) -> tuple[DataFrame, list[tuple[Column, Column]]]:
    """Each of the ``width`` context ids looked up in the broadcast table where it stands: no
    row is exploded, moved or regrouped.  Returns the rows and (id, vector) of each place."""
    out, found = windows.select(*keys, "ctx"), []
    for t in range(width):
        side = vectors.select(F.col("token_id").alias(f"_id{t}"), F.col("vector").alias(f"_v{t}"))
        out = out.withColumn(f"_id{t}", F.get("ctx", F.lit(t))).join(side, f"_id{t}", "left")
        found.append((F.col(f"_id{t}"), F.col(f"_v{t}")))
    return out, found


# --- J1 ---------------------------------------------------------------------
def vocab_vectors(vocab: DataFrame, vectors: DataFrame, word_col: str = "word") -> DataFrame:
    """Inner join vocabulary x vectors on the word -> (token_id, token, vector)."""
    v = vectors.withColumnRenamed(word_col, "token")
    return vocab.join(v, "token").select("token_id", "token", "vector")


def _explode_ctx(windows: DataFrame, keys: list[str]) -> DataFrame:
    return (windows.select(*keys, F.posexplode_outer("ctx").alias("t", "token_id"))
                   .filter(F.col("t").isNotNull()))


# --- J2 ---------------------------------------------------------------------
def _required(token_id: Column, vector: Column) -> Column:
    return F.when(vector.isNotNull(), vector).otherwise(
        F.raise_error(F.concat(F.lit("no vector for id "), token_id.cast("string"))).cast("array<float>"))


def context_vectors_flat(windows: DataFrame, id_vectors: DataFrame, dim: int,
                         max_rows: int | None = None, keys=("doc_key", "pos"), width: int | None = None) -> DataFrame:
    """Concatenate the vectors of each context id into one vector; an id with
    no vector fails the job (as the reference's dictionary lookup does).  With ``width``, the
    number of ids of every context, a table that fits is looked up in place."""
    keys = list(keys)
    vec = _vector_side(id_vectors.select("token_id", "vector"), dim, max_rows)
    if width and _fits(dim, max_rows):
        rows, found = _by_slot(windows, vec, keys, width)
        return rows.select(*keys, F.concat(*[_required(i, v) for i, v in found]).alias("features"))
    j = _explode_ctx(windows, keys).join(vec, "token_id", "left")
    checked = _required(F.col("token_id"), F.col("vector"))
    return j.groupBy(*keys).agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("t", checked.alias("v")))),
                              lambda s: s["v"])).alias("features"))


# --- J3 ---------------------------------------------------------------------
def context_vectors_seq(windows: DataFrame, id_vectors: DataFrame, dim: int,
                        max_rows: int | None = None, keys=("doc_key", "pos"), width: int | None = None) -> DataFrame:
    """Keep the time axis: array of per-id vectors; a missing id gets a zero
    vector of the table's dimension (``dim``).  ``width`` as in :func:`context_vectors_flat`."""
    keys = list(keys)
    vec = _vector_side(id_vectors.select("token_id", "vector"), dim, max_rows)
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    if width and _fits(dim, max_rows):
        rows, found = _by_slot(windows, vec, keys, width)
        return rows.select(*keys, F.array(*[F.coalesce(v, zero) for _, v in found]).alias("steps"))
    j = _explode_ctx(windows, keys).join(vec, "token_id", "left")
    v = F.coalesce(F.col("vector"), zero)
    return j.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("t", v.alias("v")))), lambda s: s["v"]).alias("steps"))

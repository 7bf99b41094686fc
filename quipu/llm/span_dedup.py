"""Substring dedup on words by de Bruijn compaction.

A window of ``WINDOW`` words is removed from a document if it also starts in a document with
a smaller id.  Token k-mers of ``K`` words are the graph's edges.  A sparse graph is enough:
only the k-mer of the smallest hash among the ``WINDOW - K + 1`` of each window is kept, so
equal windows keep the same k-mer at the same place, and neighbours that are kept overlap or
touch.

1. k-mers that occur in one document only are dropped (aggregate, join).
2. A step from a k-mer to the next is nonbranching if both and the step itself occur equally
   often (aggregate, join on steps): all their occurrences then go together.  Repeated
   nonbranching paths are compacted to one span with one smallest document.
3. Windows inside a span need no more work.  Windows that stick out of one are verified by
   source coordinates: the hash of all their words, smallest document by hash.
4. What is covered is removed; a document without a repeated k-mer is finished in step 2's
   join and its text moves no further.

How it scales.  About 2 / (WINDOW - K + 2) of the words give a row, of five numbers.  Counts
are pre-aggregated map-side, so a passage in a third of all documents gives one row for each
task; adaptive execution splits the joins of hot k-mers.  Nothing reaches the driver.

Hashes have 64 bits.  Defined results: null text has no words; rows of a null id are kept
whole and remove nothing elsewhere; repeated rows of one id don't remove each other.  Rows of
the same id and text are counted first and one of them stands for all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import RunHashes, byte_list, covered, cut_rows, mix64, one_of_each, row_key, runs_of, table_of, window_minima
from quipu.operators.corpus import pin_table

WINDOW, K = 50, 26
_KMERS = pa.schema([("rk", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("kmer", pa.int64()), ("step", pa.int64())])
_STATE = pa.schema([("rk", pa.int64()), ("doc_id", pa.int64()), ("text", pa.binary()), ("n_words", pa.int64()),
                    ("kept_sha256", pa.string()), ("from", pa.list_(pa.int32())), ("to", pa.list_(pa.int32())),
                    ("pos", pa.list_(pa.int32())), ("hash", pa.list_(pa.int64()))])
_DONE = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                   ("kept", pa.binary())])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def kept_kmers(runs: RunHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window the place of its k-mer; the distinct places; their k-mers' hashes."""
    grams = runs.all(K)
    place = window_minima(grams, WINDOW - K + 1)
    pos = np.unique(place)
    return place, pos, grams[pos]


def _kmers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut_rows(batches, "text"):
        out: dict[str, list] = {f.name: [] for f in _KMERS}
        for rk, doc, text in zip(batch.column("rk").to_pylist(), batch.column("doc_id").to_pylist(),
                                 byte_list(batch.column("text")), strict=True):
            words = text.split()
            if len(words) < WINDOW:
                continue
            _, pos, kmer = kept_kmers(RunHashes(word_hashes(words)))
            step = np.zeros(len(pos), np.uint64)
            step[:-1] = mix64(kmer[:-1] ^ mix64(kmer[1:] + np.diff(pos).astype(np.uint64)))
            for name, x in (("rk", np.full(len(pos), rk)), ("doc_id", np.full(len(pos), doc)), ("pos", pos.astype(np.int32)),
                            ("kmer", kmer.view(np.int64)), ("step", step.view(np.int64))):
                out[name].append(x)
        if out["rk"]:
            yield table_of({k: np.concatenate(v) for k, v in out.items()}, _KMERS)


def _compact(batches: Iterable[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Spans of each document, the windows in them that repeat an earlier document, and the
    hashes of the windows that stick out; a document without a repeated k-mer gets its digest
    and, with ``texts``, keeps its text."""
    for batch in cut_rows(batches, "text"):
        out: dict[str, list] = {f.name: [] for f in _STATE}
        for rk, doc, text, found in zip(batch.column("rk").to_pylist(), batch.column("doc_id").to_pylist(),
                                        byte_list(batch.column("text")), batch.column("found").to_pylist(), strict=True):
            words = (text or b"").split()
            row = dict.fromkeys(out) | {"rk": rk, "doc_id": doc, "n_words": len(words)}
            if not found:
                row |= {"kept_sha256": hashlib.sha256(b" ".join(words)).hexdigest(), "text": text if texts else None}
            else:
                runs = RunHashes(word_hashes(words))
                place, _, _ = kept_kmers(runs)
                pos, often, first, steps = (np.array(x) for x in zip(*sorted({(f["pos"], f["often"], f["first"], f["steps"]) for f in found}), strict=True))
                joined = (steps[:-1] == often[:-1]) & (often[1:] == often[:-1])
                path = np.concatenate([[0], np.cumsum(~joined)])
                start, end = pos[np.searchsorted(path, path)], pos[np.searchsorted(path, path, "right") - 1] + K
                k = np.searchsorted(pos, place)
                k[k == len(pos)] = 0
                s = np.arange(len(place))
                repeated = pos[k] == place
                inside = repeated & (s >= start[k]) & (s + WINDOW <= end[k])
                a, b = runs_of(inside & (first[k] < doc))
                at = np.flatnonzero(repeated & ~inside)
                row |= {"text": text, "from": a.tolist(), "to": (b + WINDOW - 1).tolist(), "pos": at.tolist(),
                        "hash": runs.of(at, at + WINDOW).view(np.int64).tolist()}
            for name in out:
                out[name].append(row[name])
        yield table_of(out, _STATE).append_column("extra", batch.column("extra"))


def _remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut_rows(batches, "text"):
        out: dict[str, list] = {f.name: [] for f in _DONE}
        cols = [batch.column(c).to_pylist() for c in ("doc_id", "text", "from", "to", "again")]
        for doc, text, a, b, again in zip(*cols, strict=True):
            words = text.split()
            again = np.array(again or [], np.int64)
            gone = covered(len(words), np.concatenate([np.array(a, np.int64), again]),
                           np.concatenate([np.array(b, np.int64), again + WINDOW]))
            kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
            row = (doc, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept if gone.any() else text)
            for name, x in zip(out, row, strict=True):
                out[name].append(x)
        yield table_of(out, _DONE).append_column("extra", batch.column("extra"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                   texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): one row for each row of ``docs``.
    ``kept`` holds as bytes the words left, joined by one space, or the text as it was where
    nothing was removed (without ``texts``: null there).  ``extra``: a struct of the columns in
    ``keep`` as they are."""
    extra = F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(1)])
    whole_rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), extra.alias("extra"))
    rows, repeats = one_of_each(whole_rows.withColumn("rk", row_key()))
    # a row that stands for several brings its key to the result
    rows = rows.withColumn("extra", F.struct("extra", F.when(F.col("repeated"), F.col("rk")).alias("rk"))).drop("repeated")
    kmers = pin_table(rows.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("rk", "doc_id", "text")
                      .mapInArrow(_kmers, "rk long, doc_id long, pos int, kmer long, step long"), "kmers")
    repeated = (kmers.groupBy("kmer").agg(F.count("*").alias("often"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                .filter("first < last").drop("last"))
    edges = pin_table(kmers.join(repeated, "kmer").select("rk", "pos", "step", "often", "first"), "edges")
    steps = edges.filter("step <> 0").groupBy("step").agg(F.count("*").alias("steps")).filter("steps > 1")
    found = (edges.join(steps, "step", "left").groupBy("rk")
             .agg(F.collect_list(F.struct("pos", "often", "first", F.coalesce("steps", F.lit(0)).alias("steps"))).alias("found")))
    carried = f"extra {rows.schema['extra'].dataType.simpleString()}"
    state = rows.join(found.hint("shuffle_hash"), "rk", "left").select("rk", "doc_id", "text", "found", "extra").mapInArrow(
        lambda x: _compact(x, texts), "rk long, doc_id long, text binary, n_words long, kept_sha256 string, from array<int>, to array<int>, "
                  f"pos array<int>, hash array<long>, {carried}")
    state = pin_table(state, "spans")
    open_rows = state.filter("kept_sha256 is null")
    windows = open_rows.select("rk", "doc_id", F.explode(F.arrays_zip("pos", "hash")).alias("w")).select("rk", "doc_id", "w.pos", "w.hash")
    earlier = (windows.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
               .filter("first < last").drop("last"))
    again = windows.join(earlier, "hash").filter("first < doc_id").groupBy("rk").agg(F.collect_set("pos").alias("again"))
    cut = (open_rows.join(again.hint("shuffle_hash"), "rk", "left").select("doc_id", "text", "from", "to", "again", "extra")
           .mapInArrow(_remove, f"doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary, {carried}"))
    whole = state.filter("kept_sha256 is not null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256",
                                                           F.col("text").alias("kept"), "extra")
    done = cut.unionByName(whole)
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    single = done.filter("extra.rk is null").select(*cols, F.col("extra.extra").alias("extra"))
    again = repeats.select("rk", "extra").join(done.filter("extra.rk is not null").select(*cols, F.col("extra.rk").alias("rk")), "rk")
    return single.unionByName(again.select(*cols, "extra")).drop(*[] if keep else ["extra"])

"""Importance resampling of documents towards a target distribution.

Features are all runs of 1 to ``longest`` words, hashed (crc32) to ``buckets``.  A bucket's
gain is the floored 1000-fold logarithm of its smoothed share in the target over its smoothed
share in the documents; a document's weight is the floored mean of its features' gains.
Seeded Gumbel noise is added, and the documents with the highest scores are drawn: a sample
without replacement, in proportion to the weights' exponentials.

1. Bucket counts of both tables: an array of counts for each task, summed by Spark.
2. Array-scored weights: features of about ``BLOCK`` bytes of texts at a time are hashed and
   scored in arrays.  The rows of a task are written as locally sorted runs of ``RUN`` rows.
3. Parallel sorting by regular sampling: every ``step``-th row of each run, from a place that
   differs by run, is a sample; the sorted samples give regular splitters.  Segments between
   splitters are counted (prefix counts are their first ranks), those that can hold a drawn
   rank are exchanged, each is merged in its task, and rank = prefix count + place.

How it scales.  Texts are read twice and never move; of each document five numbers are
written, and only those of segments that reach the draw are shuffled.  The driver holds the
``buckets`` gains, ``SAMPLES`` samples (and one more for each run at most) and the count of
each segment.  The sort key ends in the row's run and place, so no two keys are equal and a
run of ties splits like any other.

Defined results: a null text has no words; a null id is hashed as an empty one and sorts after
all others of its score; repeated rows are ranked one by one; without features the weight is
0; an empty target has no counts (T = 0).  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import id_text, table_of
from quipu.llm.words import LOWER, PLAIN, Words, batches_of, words_of
from quipu.operators.corpus import pin_table

BUCKETS, LONGEST_RUN, LEAST_WORDS, SEED = 10_000, 2, 20, 7
BLOCK = 4 << 20         # bytes of text hashed at once
RUN = 1 << 20           # rows of a locally sorted run
SAMPLES = 1 << 16       # regular samples over all runs
LONG_WORD = 64          # bytes beyond it are hashed one word at a time
_ALL = np.uint32(0xFFFFFFFF)
_COUNTS = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
_SCORED = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_features", "weight", "score", "run", "place")])
_RESULT = "doc_id long, n_features long, weight long, score long, rank long"


def _crc_steps() -> np.ndarray:
    """The effect of each byte on the crc register (reflected polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_STEPS = _crc_steps()


def _after(register: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _STEPS[(register ^ byte) & np.uint32(0xFF)] ^ (register >> np.uint32(8))


def _feed(register: np.ndarray, words: Words, which: np.ndarray) -> np.ndarray:
    """Crc registers after the bytes of the words ``which``, one byte of all words at a time."""
    order = words.by_length(which, LONG_WORD + 1)
    start = words.starts[which][order]
    length = words.ends[which][order] - start
    reg = register[order]
    n_long = int(np.searchsorted(-length.clip(max=LONG_WORD + 1), -LONG_WORD, "left"))
    for i in range(n_long):
        word = words.data[start[i]:start[i] + length[i]].tobytes()
        reg[i] = zlib.crc32(word, int(reg[i] ^ _ALL)) ^ int(_ALL)
    live = np.searchsorted(-length[n_long:], -np.arange(LONG_WORD), "left") + n_long
    for j in range(LONG_WORD):
        if live[j] == n_long:
            break
        part = slice(n_long, live[j])
        reg[part] = _after(reg[part], words.data[start[part] + j])
    out = np.empty_like(reg)
    out[order] = reg
    return out


def features(words: Words, buckets: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every run of words: those of one word, then of two, and so on."""
    n = len(words.starts)
    which = np.arange(n)
    register = _feed(np.full(n, _ALL), words, which)
    yield words.owner, ((register ^ _ALL) % np.uint32(buckets)).astype(np.int64)
    blank = np.uint8(0x20)
    for _ in range(1, longest):
        # run i grows by the word after it, while that belongs to the same text
        follow = which + 1
        ok = follow < n
        ok[ok] = words.owner[follow[ok]] == words.owner[which[ok]]
        which, register = follow[ok], _after(register[ok], blank)
        register = _feed(register, words, which)
        yield words.owner[which], ((register ^ _ALL) % np.uint32(buckets)).astype(np.int64)


def _plain_words(data: np.ndarray, bounds: np.ndarray) -> Words:
    return words_of(LOWER[data], bounds, PLAIN)


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features of a column ``text`` by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, data, bounds in batches_of(batches, BLOCK):
            for _, bucket in features(_plain_words(data, bounds), buckets, longest):
                total += np.bincount(bucket, minlength=buckets)
        found = np.flatnonzero(total)
        yield table_of({"bucket": found, "n": total[found]}, _COUNTS)

    out = np.zeros(buckets, np.int64)
    rows = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in rows.collect():        # at most one row for each bucket
        out[bucket] = n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets)))) of each bucket, in doubles."""
    n, big_s, big_t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (big_s + n) / ((s + 1) * (big_t + n))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise_of(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _sort_keys(doc_id: pa.Array) -> np.ndarray:
    return doc_id.fill_null(np.iinfo(np.int64).max).to_numpy()


def _sorted_runs(rows: list[pa.RecordBatch], part: int, number: int) -> pa.RecordBatch:
    """Rows with ``run`` set, in order and with their places; the others after them."""
    table = pa.Table.from_batches(rows).combine_chunks()
    cols = {c: table[c].combine_chunks() for c in table.column_names}
    in_run = cols["run"].is_valid().to_numpy(zero_copy_only=False)
    order = np.lexsort((_sort_keys(cols["doc_id"]), -cols["score"].to_numpy(), ~in_run))
    n, k = len(order), int(in_run.sum())
    out = {c: cols[c].take(pa.array(order)) for c in ("doc_id", "n_features", "weight", "score")}
    mask = np.arange(n) >= k
    out["run"] = pa.array(np.full(n, (part << 24) + number), pa.int64(), mask=mask)
    out["place"] = pa.array(np.arange(n), pa.int64(), mask=mask)
    return table_of(out, _SCORED)


def scored_runs(docs: DataFrame, gains: np.ndarray, longest: int, least_words: int, seed: int) -> DataFrame:
    """(doc_id, n_features, weight, score, run, place): the documents of ``least_words`` words
    or more as sorted runs; the others have neither run nor place."""
    buckets = len(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch, data, bounds in batches_of(batches, BLOCK):
            words = _plain_words(data, bounds)
            n_features, total = np.zeros(words.n_texts, np.int64), np.zeros(words.n_texts, np.int64)
            for text, bucket in features(words, buckets, longest):
                n_features += np.bincount(text, minlength=words.n_texts)
                # sums of integers below 2^53 are exact in doubles
                total += np.bincount(text, gains[bucket], words.n_texts).astype(np.int64)
            weight = total // np.maximum(n_features, 1)
            noise = np.array([noise_of(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            eligible = np.diff(words.firsts()) >= least_words
            held.append(table_of({"doc_id": batch.column("doc_id"), "n_features": n_features, "weight": weight, "score": weight + noise,
                                  "run": pa.array(np.zeros(len(eligible)), pa.int64(), mask=~eligible),
                                  "place": pa.nulls(len(eligible), pa.int64())}, _SCORED))
            size += len(eligible)
            if size >= RUN:
                yield _sorted_runs(held, part, number)
                number, held, size = number + 1, [], 0
        if held:
            yield _sorted_runs(held, part, number)

    return docs.mapInArrow(score, "doc_id long, n_features long, weight long, score long, run long, place long")


def ranked(runs: DataFrame, draw: int, total: int) -> DataFrame:
    """The rows of sorted ``runs`` with their exact ranks by (score descending, doc_id), null
    beyond ``draw``; ``total`` is the number of rows that have a run."""
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = max(1, total // SAMPLES)
    picked = runs.filter(F.col("run").isNotNull() & (F.pmod(F.col("place") + F.pmod(F.xxhash64("run"), F.lit(step)), F.lit(step)) == 0))
    last_id = F.coalesce("doc_id", F.lit(int(np.iinfo(np.int64).max)))
    keys = [(-F.col("score")).alias("low"), last_id.alias("id"), "run", "place"]
    samples = sorted(tuple(r) for r in picked.select(*keys).collect())
    splitters = np.array([samples[i * len(samples) // parts] for i in range(1, parts)] if samples else [], np.int64).reshape(-1, 4)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The segment of each row: the number of splitters up to it."""
        m = len(splitters)
        for batch in batches:
            own = [-batch.column("score").to_numpy(), _sort_keys(batch.column("doc_id")),
                   *(batch.column(c).to_numpy() for c in ("run", "place"))]
            order = np.lexsort([np.concatenate([splitters[:, c], own[c]]) for c in (3, 2, 1, 0)])
            before = np.empty(len(order), np.int64)
            before[order] = np.cumsum(order < m)
            yield batch.append_column("segment", pa.array(before[m:]))

    marked = runs.filter("run is not null").mapInArrow(
        mark, "doc_id long, n_features long, weight long, score long, run long, place long, segment long")
    counts = dict(marked.groupBy("segment").count().collect())      # at most one row for each segment
    first, at = {}, 0
    for segment in sorted(counts):
        first[segment] = at
        at += counts[segment]
    last = max((s for s, r in first.items() if r < draw), default=-1)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place = None, 0
        for batch in batches:
            segment = batch.column("segment").to_numpy()
            rank = np.empty(len(segment), np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(segment)) + 1).tolist(), len(segment)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    if segment[a] != now:
                        now, place = segment[a], first[int(segment[a])]
                    rank[a:b] = place + 1 + np.arange(b - a)
                    place += b - a
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_features", "weight", "score")),
                                              pa.array(rank, pa.int64(), mask=rank > draw)],
                                             names=["doc_id", "n_features", "weight", "score", "rank"])

    result = ["doc_id", "n_features", "weight", "score"]
    merged = (marked.filter(F.col("segment") <= last).repartitionById(parts, F.col("segment").cast("int"))
              .sortWithinPartitions("segment", F.desc("score"), F.asc_nulls_last("doc_id"), "run", "place").mapInArrow(number, _RESULT))
    rest = marked.filter(F.col("segment") > last).select(*result).unionByName(runs.filter("run is null").select(*result))
    return merged.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, per_cent: int = 25, buckets: int = BUCKETS, longest: int = LONGEST_RUN,
             least_words: int = LEAST_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank): one row for each row of ``docs``; of those of
    ``least_words`` words or more, ``per_cent`` per cent (floored) are drawn and have a rank,
    from 1 by (score descending, doc_id)."""
    rows = id_text(docs, id_col, text_col)
    source = bucket_counts(rows.select("text"), buckets, longest)
    wanted = bucket_counts(target.select(F.col(target_col).cast("string").alias("text")), buckets, longest)
    runs = pin_table(scored_runs(rows, gains_of(source, wanted), longest, least_words, seed), "runs")
    total = runs.filter("run is not null").count()
    return ranked(runs, per_cent * total // 100, total)

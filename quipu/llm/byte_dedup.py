"""Suffix-array dedup on bytes by prefix doubling over sampled positions.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else.
Suffixes need not be ranked at every byte: only the place of the smallest hash of ``K`` bytes
in each string of ``LENGTH`` is a position, so equal strings hold the same position at the
same offset.  That is about 2 / (LENGTH - K + 2) of all bytes.

1. Prefix doubling.  Positions are ranked by their first ``DEPTHS[0]`` bytes; in every round
   the pair of a position's rank and the rank of the bytes at the doubled offset gives its new
   rank.  Spark groups the pairs and joins them back, and a position whose rank is unique
   leaves.  After the last round ``K`` bytes agree.
2. One more pair reaches from a position to the next sampled one.  Where both and the pair
   occur equally often, all occurrences go on alike; such positions form a span, and every
   string inside it is repeated.
3. Strings that stick out of a span are compared past the threshold: within a rank, by the
   hash of the bytes around the position.  Ranks of up to ``HOT`` positions are compared one
   after the other, some ``STRINGS`` strings at once (a rank of more in slices by their
   hashes), in the task that holds them, others as rows of (string hash) with a map-side count; both give the same result.
4. The union of all repeated strings is cut out.  A document without a repeated position is
   finished in step 2's join and its text moves no further.

How it scales.  Rows are numbers for a hundredth of the bytes; the text of documents with
repeats moves once more.  Long texts are hashed in pieces of ``CHUNK`` bytes.  Nothing reaches
the driver.  Ranks are class ids (64-bit hashes); the order between classes isn't needed.

Defined results: null text is empty; null ids and repeated rows are rows like others, so two
equal rows of 400 bytes or more remove each other.  Rows of the same id and text are counted
first: one of them stands for all in the search, and their own result is known at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import U64, RunHashes, byte_list, cut_rows, id_text, mix64, one_of_each, row_key, table_of, window_minima
from quipu.operators.corpus import pin_table

LENGTH, K = 400, 201
DEPTHS = (50, 100, K)
CHUNK, HOT = 1 << 22, 100_000
STRINGS = 1 << 20       # strings compared at once
SYMBOL = mix64(np.arange(1, 257, dtype=U64))
_POSITIONS = pa.schema([("rk", pa.int64()), ("pos", pa.int32()), ("rank", pa.int64()),
                        *((f"next{i}", pa.int64()) for i in range(1, len(DEPTHS))), ("step", pa.int64())])
_STATE = pa.schema([("rk", pa.int64()), ("doc_id", pa.int64()), ("text", pa.binary()), ("n_bytes", pa.int64()), ("kept_sha256", pa.string()),
                    ("repeated", pa.bool_())])
_EDGES = pa.schema([("rank", pa.int64()), ("often", pa.int64()), ("rk", pa.int64()), ("from", pa.int32()), ("to", pa.int32()),
                    ("offset", pa.int32()), ("around", pa.binary())])
_DONE = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                   ("kept_sha256", pa.string()), ("spans", pa.list_(pa.list_(pa.int32())))])


def pieces(text: bytes) -> Iterator[tuple[int, RunHashes, np.ndarray, np.ndarray]]:
    """(offset, hashes, grams, place of the position of each string) of a text, piece by piece."""
    for offset in range(0, len(text) - LENGTH + 1, CHUNK):
        runs = RunHashes(SYMBOL[np.frombuffer(text, np.uint8, min(CHUNK + LENGTH - 1, len(text) - offset), offset)])
        grams = runs.all(K)
        yield offset, runs, grams, window_minima(grams, LENGTH - K + 1)


def _positions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut_rows(batches, "text"):
        out: dict[str, list] = {f.name: [] for f in _POSITIONS}
        for rk, text in zip(batch.column("rk").to_pylist(), byte_list(batch.column("text")), strict=True):
            last = -1
            for offset, runs, grams, place in pieces(text):
                pos = place[np.append(True, place[1:] != place[:-1])]
                nxt = np.append(pos[1:], -1)
                step = mix64(grams[pos] ^ mix64(grams[nxt] + (nxt - pos).astype(U64)))
                step[-1] = 0
                keep = pos + offset > last  # the last of a piece may be the first of the next
                last = int(pos[-1]) + offset
                pos, step = pos[keep], step[keep]
                out["rk"].append(np.full(len(pos), rk))
                out["pos"].append((pos + offset).astype(np.int32))
                out["step"].append(step.view(np.int64))
                for i, depth in enumerate(DEPTHS):
                    h = runs.of(pos + (DEPTHS[i - 1] if i else 0), pos + depth)
                    out[f"next{i}" if i else "rank"].append(h.view(np.int64))
        if out["rk"]:
            yield table_of({k: np.concatenate(v) for k, v in out.items()}, _POSITIONS)


def double(positions: DataFrame) -> DataFrame:
    """(rk, pos, rank, often, step) of the positions whose first K bytes start elsewhere too."""
    alive, keys = positions, ["rank"]
    for i in range(len(DEPTHS)):
        pairs = alive.groupBy(*keys).agg(F.count("*").alias("often")).filter("often > 1")
        alive = pin_table(alive.drop("often").join(pairs, keys).withColumn("rank", F.xxhash64(*keys))
                          .drop(*keys[1:]), f"rank{i}")
        keys = ["rank", f"next{i + 1}"]
    return alive


def _split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A result for documents without a repeated position, the text of all others."""
    for batch in cut_rows(batches, "text"):
        texts = [t or b"" for t in byte_list(batch.column("text"))]
        found = np.asarray(batch.column("found").is_valid()).tolist()
        yield pa.RecordBatch.from_arrays([
            batch.column("rk"), batch.column("doc_id"),
            pa.array([t if f else None for t, f in zip(texts, found, strict=True)], pa.binary()),
            pa.array(map(len, texts), pa.int64()),
            pa.array([None if f else hashlib.sha256(t).hexdigest() for t, f in zip(texts, found, strict=True)], pa.string()),
            batch.column("repeated"), batch.column("found")], names=[*(f.name for f in _STATE), "found"])


def _edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of strings: inside a span (no rank), or sticking out of one, with the bytes around
    the position that tell them apart."""
    for batch in cut_rows(batches, "text"):
        out: dict[str, list] = {f.name: [] for f in _EDGES}

        def add(*row: object, out: dict[str, list] = out) -> None:
            for name, x in zip(out, row, strict=True):
                out[name].append(x)

        for rk, text, found in zip(batch.column("rk").to_pylist(), byte_list(batch.column("text")), batch.column("found"), strict=True):
            table = np.array(sorted({tuple(f.values()) for f in found.as_py()}), dtype=np.int64)
            pos, rank, often, steps = table.T
            joined = (steps[:-1] == often[:-1]) & (often[1:] == often[:-1])
            path = np.concatenate([[0], np.cumsum(~joined)])
            start, end = pos[np.searchsorted(path, path)], pos[np.searchsorted(path, path, "right") - 1] + K
            for offset, _, _, place in pieces(text):
                first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                at, lo, hi = place[first] + offset, first + offset, np.append(first[1:], len(place)) + offset
                k = np.searchsorted(pos, at)
                k[k == len(pos)] = 0
                hit = np.flatnonzero(pos[k] == at)
                for i, j in zip(hit.tolist(), k[hit].tolist(), strict=True):
                    a, b, p = int(lo[i]), int(hi[i]), int(at[i])
                    s, e = int(start[j]), int(end[j]) - LENGTH + 1  # strings from s, before e lie inside the span
                    inner, outer = (max(a, s), min(b, e)), [(a, min(b, s)), (max(a, e, s), b)]
                    if e <= s:
                        inner, outer = (0, 0), [(a, b)]
                    if inner[0] < inner[1]:
                        add(None, None, rk, *inner, None, None)
                    for x, y in outer:
                        if x < y:
                            add(int(rank[j]), int(often[j]), rk, x, y, p - x, text[x:p] + text[p + K:y + LENGTH - 1])
        if out["rk"]:
            yield table_of(out, _EDGES)


def _string_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all strings in rows of ``_edges``: the key (rank, offset, bytes), the row, the start."""
    a, b = (batch.column(c).to_numpy().astype(np.int64) for c in ("from", "to"))
    offset, rank = batch.column("offset").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
    around = byte_list(batch.column("around"))
    runs = RunHashes(SYMBOL[np.frombuffer(b"".join(around), np.uint8)])
    base = np.cumsum([0, *map(len, around)])[:-1]
    n = b - a
    row = np.repeat(np.arange(len(n)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = base[row] + nth
    key = mix64(runs.of(at, at + LENGTH - K) ^ mix64(rank.view(U64)[row] + (offset[row] - nth).astype(U64)))
    return key, row, a[row] + nth


def _runs(rk: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring strings of a document, as the bytes they cover."""
    order = np.lexsort((start, rk))
    rk, start = rk[order], start[order]
    new = np.append(True, (rk[1:] != rk[:-1]) | (start[1:] > start[:-1] + 1))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(rk) - 1)
    return rk[new], start[new], start[last] + LENGTH


def _repeated(held: list[pa.RecordBatch], strings: int, at_once: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings among rows that hold whole ranks.  Where they are many more than
    ``at_once``, keys are compared slice by slice of their range."""
    batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    slices = max(1, strings // at_once)
    rks, starts = [], []
    for part in range(slices):
        found = []
        for some in cut_rows([batch], "around", 1 << 20):
            key, row, start = _string_keys(some)
            rk = some.column("rk").to_numpy()[row]
            if slices > 1:
                mine = (key >> U64(32)) % U64(slices) == U64(part)
                key, rk, start = key[mine], rk[mine], start[mine]
            found.append((key, rk, start))
        key, rk, start = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(key):
            continue
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = order[np.append(same, False) | np.append(False, same)]
        rks.append(rk[twice])
        starts.append(start[twice])
    if rks and sum(map(len, rks)):
        rk, start = np.concatenate(rks), np.concatenate(starts)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _runs(rk, start)], names=["rk", "from", "to"])


def _compare(batches: Iterable[pa.RecordBatch], at_once: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings among rows sorted by rank: whole ranks of about ``at_once`` strings together."""
    held: list[pa.RecordBatch] = []
    strings, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rank = batch.column("rank").to_numpy()
        size = np.cumsum(batch.column("to").to_numpy().astype(np.int64) - batch.column("from").to_numpy())
        ends = np.flatnonzero(np.append(rank[1:] != rank[:-1], False)) + 1
        at = 0
        if held and rank[0] != last and strings >= at_once:
            yield from _repeated(held, strings, at_once)
            held, strings = [], 0
        for end in ends.tolist():
            more = int(size[end - 1] - (size[at - 1] if at else 0))
            if strings + more >= at_once:
                yield from _repeated([*held, batch.slice(at, end - at)], strings + more, at_once)
                held, strings, at = [], 0, end
        held.append(batch.slice(at))
        strings += int(size[-1] - (size[at - 1] if at else 0))
        last = rank[-1]
    if held:
        yield from _repeated(held, strings, at_once)


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut_rows(batches, "around", 1 << 20):
        key, row, start = _string_keys(batch)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(batch.column("rk").to_numpy()[row]), pa.array(start)],
                                         names=["key", "rk", "from"])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut_rows(batches, "text"):
        out: dict[str, list] = {f.name: [] for f in _DONE}
        for doc, text, found in zip(batch.column("doc_id").to_pylist(), byte_list(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            spans: list[list[int]] = []
            for f in sorted(found or [], key=lambda f: f["from"]):
                if spans and f["from"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], f["to"])
                else:
                    spans.append([f["from"], f["to"]])
            digest, at = hashlib.sha256(), 0
            for a, b in spans:
                digest.update(text[at:a])
                at = b
            digest.update(text[at:])
            row = (doc, len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), spans)
            for name, x in zip(out, row, strict=True):
                out[name].append(x)
        yield table_of(out, _DONE)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans): one row for each row of
    ``docs``; spans are the byte ranges removed."""
    rows, repeats = one_of_each(id_text(docs, id_col, text_col).withColumn("rk", row_key()))
    schema = ", ".join(["rk long", "pos int", "rank long", *(f"next{i} long" for i in range(1, len(DEPTHS))), "step long"])
    positions = pin_table(rows.filter("text is not null").select("rk", "text").mapInArrow(_positions, schema), "positions")
    alive = double(positions)
    steps = alive.filter("step <> 0").groupBy("step").agg(F.count("*").alias("steps")).filter("steps > 1")
    found = (alive.join(steps, "step", "left").groupBy("rk")
             .agg(F.collect_list(F.struct("pos", "rank", "often", F.coalesce("steps", F.lit(0)).alias("steps"))).alias("found")))
    state = pin_table(rows.join(found.hint("shuffle_hash"), "rk", "left").select("rk", "doc_id", "text", "repeated", "found").mapInArrow(
        _split, "rk long, doc_id long, text binary, n_bytes long, kept_sha256 string, repeated boolean, "
                "found array<struct<pos:int,rank:long,often:long,steps:long>>"), "texts")
    held = state.filter("text is not null")
    edges = pin_table(held.select("rk", "text", "found").mapInArrow(
        _edges, "rank long, often long, rk long, from int, to int, offset int, around binary"), "edges")
    inside = edges.filter("rank is null").select("rk", F.col("from").cast("long").alias("from"), (F.col("to") + LENGTH - 1).cast("long").alias("to"))
    outside = edges.filter("rank is not null")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = outside.filter(F.col("often") <= hot).repartition(parts, "rank").sortWithinPartitions("rank").mapInArrow(
        lambda x: _compare(x, STRINGS), "rk long, from long, to long")
    keyed = outside.filter(F.col("often") > hot).mapInArrow(_keyed, "key long, rk long, from long")
    many = (keyed.join(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key")
            .select("rk", "from", (F.col("from") + LENGTH).alias("to")))
    spans = inside.unionByName(few).unionByName(many).groupBy("rk").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    cut = held.filter("not repeated").select("rk", "doc_id", "text").join(spans.hint("shuffle_hash"), "rk", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<int>>")
    whole = state.filter("text is null and not repeated").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                                                "kept_sha256", F.array().cast("array<array<int>>").alias("spans"))
    # the other copies of a row, and the one that stood for them
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    gone = size >= LENGTH
    again = repeats.select(
        "doc_id", size.alias("n_bytes"), F.when(gone, size).otherwise(0).alias("n_removed"), gone.cast("long").alias("n_spans"),
        F.sha2(F.when(gone, F.lit("")).otherwise(F.coalesce("text", F.lit(""))).cast("binary"), 256).alias("kept_sha256"),
        F.when(gone, F.array(F.array(F.lit(0), size.cast("int")))).otherwise(F.array().cast("array<array<int>>")).alias("spans"))
    return cut.unionByName(whole).unionByName(again)

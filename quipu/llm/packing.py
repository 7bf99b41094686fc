"""Best-fit packing: cut documents into token pieces and pack the pieces into as few
sequences of at most ``capacity`` tokens as best-fit decreasing finds.

How it scales.  Tokenizing is one narrow pass that keeps only a row of numbers for each
piece.  Best-fit decreasing treats pieces of one length alike, so it needs only how many
pieces there are of each length: at most ``capacity`` rows, whatever the corpus.  The
planner walks the lengths from long to short; a segment tree over the remaining capacities
finds the tightest open bin in logarithmic time, and all bins alike take their pieces in
one step.  Its plan says, for each length, which run of ranks goes to which run of bins.
Every piece then finds its place from its rank among the pieces of its length; ranks come
from a distributed sort of (length, id, piece) keys.

Defined results: null text is empty (one piece, the closing id alone); a repeated row is
packed again; a null id stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import cut_rows, id_text, table_of
from quipu.operators.corpus import global_index, pin_table

SPECIAL = "<|endoftext|>"
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64()), ("row", pa.int64())])


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function text -> ids, equal to ``tokenizers`` on the file at ``path``.

    When the file is a byte-level BPE whose merge order is its id order, tiktoken runs the
    same merges about three times as fast; any other file, and any text that tiktoken's regex
    gives up on (runs of a million blanks), is run by ``tokenizers``.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    ranks = _byte_ranks(model) if model.get("type") == "BPE" else None
    plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and not model.get("ignore_merges"))
    if ranks is not None and plain:
        import public_tokenizers
        import tiktoken
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        made = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> list[int]:
            try:
                return made.encode(text, allowed_special="all")
            except (ValueError, RuntimeError):      # its regex gives up on very long runs of blanks
                return _by_tokenizers(path)(text)

        return encode
    return _by_tokenizers(path)


@lru_cache(maxsize=2)
def _by_tokenizers(path: str):
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(path)
    return lambda text: made.encode(text, add_special_tokens=False).ids


def _byte_ranks(model: dict) -> dict[bytes, int] | None:
    """Bytes -> id of a byte-level vocabulary, or None if ids don't follow the merge order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in shown}
    chars |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {k for k in model["vocab"] if any(c not in chars for c in k)}
    ranks = {bytes(chars[c] for c in k): v for k, v in model["vocab"].items() if k not in special and k != SPECIAL}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"].get(a + b, -1) for a, b in merges]
    return ranks if ids == list(range(256, 256 + len(ids))) and len(ranks) == 256 + len(ids) else None


def cut_points(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids: the first takes what is left
    over, all others are full, so a long document leaves one open piece at most."""
    first = n - (n - 1) // capacity * capacity
    yield 0, first
    for start in range(first, n, capacity):
        yield start, capacity


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """One row for each piece of each document: (doc_id, piece, start, length, ids_crc32, row)."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in cut_rows(batches, "text"):
            out: dict[str, list] = {f.name: [] for f in PIECES}
            for doc, text, row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "row")), strict=True):
                ids = np.asarray([*encode(text or ""), end_id], "<u4")
                for i, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    for k, v in zip(out, (doc, i, start, length, crc, row), strict=True):
                        out[k].append(v)
            yield table_of(out, PIECES)

    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, row long")


class CapacityTree:
    """Segment tree over the remaining capacities 0..capacity: which have open bins, and
    the smallest of at least a given size, each in logarithmic time."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def put(self, capacity: int, is_open: bool) -> None:
        k = capacity + self.size
        self.open[k] = is_open
        while k > 1:
            k //= 2
            self.open[k] = self.open[2 * k] or self.open[2 * k + 1]

    def tightest(self, least: int) -> int | None:
        k = least + self.size
        if self.open[k]:
            return least
        while k > 1:
            if k % 2 == 0 and self.open[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.open[2 * k] else 2 * k + 1
                return k - self.size
            k //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing on counts by length.  Runs (length, first rank, pieces to a bin,
    first bin, offset): rank r of that length goes to bin first_bin + (r - first) // pieces,
    at offset + (r - first) % pieces * length, up to the next run."""
    tree, bins, runs, made = CapacityTree(capacity), {}, [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                fits = capacity // length
                bins[capacity] = [(made, -(-left // fits))]
                made += -(-left // fits)
                tree.put(room := capacity, True)
            first, n = bins[room].pop()
            if not bins[room]:
                tree.put(room, False)
            each = room // length
            full, rest = min(n, left // each), 0
            if full < n and left - full * each:
                rest = left - full * each
            runs.append((length, rank, each, first, capacity - room))
            for start, much, after in ((first, full, room - each * length),
                                       (first + full, 1 if rest else 0, room - rest * length),
                                       (first + full + (1 if rest else 0), n - full - (1 if rest else 0), room)):
                if much:
                    bins.setdefault(after, []).append((start, much))
                    tree.put(after, True)
            rank += full * each + rest
            left -= full * each + rest
    return runs


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to a pinned table of pieces (see ``token_pieces``)."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    keys = ["length", "row", "piece"]
    ranked = global_index(pieces, keys, "idx")
    plan = best_fit(counts, capacity)
    before, at = {}, 0
    for length in sorted(counts):
        before[length] = at
        at += counts[length]
    runs = sorted((before[length] + first, each, bin_id, offset, length) for length, first, each, bin_id, offset in plan)
    starts, each, bin_id, offset, size = (np.array(x, np.int64) for x in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 5
    names = [f.name for f in pieces.schema if f.name != "row"]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx = batch.column("idx").to_numpy()
            k = np.searchsorted(starts, idx, "right") - 1
            nth = idx - starts[k]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(bin_id[k] + nth // each[k]),
                 pa.array(offset[k] + nth % each[k] * size[k])], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "row")
    if not runs:
        return spark.createDataFrame([], f"{schema}, sequence_id long, offset long")
    return pieces.join(ranked, keys).select(*names, "idx").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Tokenize, cut and pack; one row for each piece."""
    return pack(pin_table(token_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity)

"""Words of many texts at once, as places in one array of bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from quipu.llm.common import U64, RunHashes, cut_rows, mix64

_BYTES = np.arange(256)
# bytes that separate words: blank and the controls 9 to 13
BLANK = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
# bytes of words of letters and digits: 0-9, a-z and every byte of a character beyond ASCII
PLAIN = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


@dataclass
class Words:
    """Texts as one array of bytes, text t being ``data[bounds[t]:bounds[t + 1]]``, and their
    words: word w is ``data[starts[w]:ends[w]]`` and belongs to text ``owner[w]``."""
    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.bounds) - 1

    def firsts(self) -> np.ndarray:
        """The first word of each text, and the number of words at the end."""
        return np.searchsorted(self.owner, np.arange(self.n_texts + 1))

    def by_length(self, which: np.ndarray, most: int) -> np.ndarray:
        """Order of the words ``which``, longest first; beyond ``most`` bytes alike."""
        lengths = np.minimum(self.ends[which] - self.starts[which], most)
        return np.argsort((most - lengths).astype(np.uint16), kind="stable")


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; null texts are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    return whole, bounds - bounds[0]


def words_of(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> Words:
    """The runs of bytes that the mask ``inside`` (of 256) allows, cut at the texts' bounds."""
    n = len(data)
    mask = inside[data]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    begin, end = bounds[:-1][bounds[:-1] < n], bounds[1:][bounds[1:] > 0] - 1
    first[begin], last[end] = mask[begin], mask[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(data, bounds, starts, ends, np.searchsorted(bounds, starts, "right") - 1)


MULTIPLIER = U64(0x9E3779B97F4A7C15)


def symbols(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    n = len(words.starts)
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    runs = RunHashes((words.data.astype(np.uint64) + U64(1)) * MULTIPLIER)
    return mix64(runs.of(words.starts, words.ends) ^ (words.ends - words.starts).astype(np.uint64))


def batches_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Arrow batches cut to about ``most`` bytes of text, with their texts."""
    for batch in cut_rows(batches, "text", most):
        yield batch, *texts_of(batch.column("text"))

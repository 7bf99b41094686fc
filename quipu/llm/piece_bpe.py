"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

No piece of the model holds a word-start mark after another character, so merges never
cross from one word (its run of marks and what follows) to the next.  A task encodes the
words that are new to it together: one flat array of symbols, and in every round the
smallest pair rank of each word (``np.minimum.reduceat``), one leftmost merge in every word
at once, and a compaction that closes the gaps and takes finished words out.  One merge for
each word and round is what makes the result equal to the library's, which always takes the
best pair and of equals the leftmost: merging all equal pairs at once could use up a symbol
that a better new pair claims first.  Words of more than ``LONG`` symbols would need as many
rounds, so they take the same merges from a heap, in n log n.

How it scales: one narrow pass over whole texts.  Memory is bounded by a cut of text, and a
word cache that is emptied beyond ``CACHE`` words.

Defined results: null text is empty, without ids; null ids and repeated rows are kept.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quipu.llm.common import cut_rows, id_text, table_of

MARK = "▁"
LONG, CACHE = 256, 600_000
NONE = np.iinfo(np.int32).max
WORDS = re.compile(f"{MARK}+[^{MARK}]*")
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])
ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


class PieceModel:
    """The tables of a model file: pieces, byte pieces, and the pairs that may merge."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
        normal = {p: i for i, p in enumerate(self.pieces) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece of this model spans words; its words can't be encoded apart")
        # characters that only occur inside longer pieces are symbols too, with ids beyond the pieces
        self.symbol = dict(normal)
        for p in normal:
            for c in p:
                self.symbol.setdefault(c, len(self.pieces) + len(self.symbol))
        order = sorted(normal, key=lambda p: (-sp.get_score(normal[p]), normal[p]))
        rank = {p: r for r, p in enumerate(order)}
        pairs = {}
        for p in normal:
            for i in range(1, len(p)):
                a, b = self.symbol.get(p[:i]), self.symbol.get(p[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (rank[p], normal[p])
        self.pair_of = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.by_rank = np.array([normal[p] for p in order], np.int32)
        self.n_pieces = n
        self.symbol_of = np.full(0x110000, -1, np.int32)  # by code point
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        self.number = [str(i) for i in range(n)]
        self.plain = {i: p.replace(MARK, " ") for i, p in enumerate(self.pieces)
                      if i not in self.byte_of and i not in self.control}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, NONE where they don't merge."""
        key = left.astype(np.int64) << 32 | right
        k = np.searchsorted(self.keys, key)
        k[k == len(self.keys)] = 0
        return np.where((self.keys[k] == key) & (left >= 0) & (right >= 0), self.ranks[k], NONE)

    def _ids(self, symbol: int, text: str) -> list[int]:
        return [symbol] if 0 <= symbol < self.n_pieces else [self.bytes[b] for b in text.encode()] if self.bytes else [0]

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """Ids of each word, a word being its marks and what follows."""
        out: list[list[int]] = [[] for _ in words]
        short = [i for i, w in enumerate(words) if len(w) <= LONG]
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._encode_long(w)
        if not short:
            return out
        text = np.frombuffer("".join([words[i] for i in short]).encode("utf-32-le"), np.uint32)
        sym = self.symbol_of[text]
        sym[sym < 0] = -1 - np.flatnonzero(sym < 0)  # an unknown character: its place in the text
        word, sizes = np.arange(len(short)), np.array([len(words[i]) for i in short])
        ends = np.cumsum(sizes)
        rank = self._pairs(sym, np.append(sym[1:], -1))
        rank[ends - 1] = NONE
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            # the smallest pair rank of each word, of equals the leftmost
            best = np.minimum.reduceat((rank.astype(np.int64) << 32) | np.arange(len(rank)), ends - sizes)
            at, done = best & 0xFFFFFFFF, best >> 32 == NONE
            keep = np.ones(len(sym), bool)
            if done.any():
                over = np.repeat(done, sizes)
                ended.append((np.repeat(word[done], sizes[done]), sym[over]))
                keep = ~over
                at, word, sizes = at[~done], word[~done], sizes[~done]
            sym[at] = self.by_rank[rank[at]]
            keep[at + 1] = False
            place = np.cumsum(keep)[at] - 1
            sym, rank, sizes = sym[keep], rank[keep], sizes - 1
            if not len(word):
                break
            ends = np.cumsum(sizes)
            first, last = place == ends - sizes, place == ends - 1
            rank[place] = np.where(last, NONE, self._pairs(sym[place], sym[np.where(last, place, place + 1)]))
            left = place[~first] - 1
            rank[left] = self._pairs(sym[left], sym[left + 1])
        word, sym = (np.concatenate(x) for x in zip(*ended, strict=True))
        order = np.argsort(word, kind="stable")
        word, sym = word[order], sym[order]
        bounds = np.searchsorted(word, np.arange(len(short) + 1)).tolist()
        flat = sym.tolist()
        odd = set(word[(sym < 0) | (sym >= self.n_pieces)].tolist())  # words with characters that aren't pieces
        for k, i in enumerate(short):
            ids = flat[bounds[k]:bounds[k + 1]]
            out[i] = ids if k not in odd else [x for s in ids for x in self._ids(s, self._char(s, text))]
        return out

    def _char(self, symbol: int, text: np.ndarray) -> str:
        """The character of a symbol that isn't a piece."""
        if symbol < 0:
            return chr(text[-1 - symbol])
        return "" if symbol < self.n_pieces else next(c for c, s in self.symbol.items() if s == symbol)

    def _encode_long(self, word: str) -> list[int]:
        sym = [self.symbol.get(c, -1) for c in word]
        text = list(word)
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if i >= 0 and j < n and sym[i] >= 0 and sym[j] >= 0 and (hit := self.pair_of.get(sym[i] << 32 | sym[j])):
                heapq.heappush(heap, (hit[0], i, sym[i], sym[j]))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if gone[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i] = self.pair_of[a << 32 | b][1]
            gone[j], nxt[i] = True, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        return [x for i in range(n) if not gone[i] for x in self._ids(sym[i], text[i])]

    def word_text(self, ids: Sequence[int]) -> str:
        """The text of ids, marks as spaces; runs of byte pieces that aren't UTF-8 become U+FFFD."""
        try:
            return "".join([self.plain[i] for i in ids])
        except KeyError:  # bytes or control ids among them
            parts, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                parts.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if i not in self.control:
                parts.append(self.pieces[i].replace(MARK, " "))
        if run:
            parts.append(run.decode("utf-8", "replace"))
        return "".join(parts)

    def decode(self, ids: Sequence[int]) -> str:
        """The text of a whole document's ids: without the space that encoding puts first."""
        text = self.word_text(ids)
        first = next((i for i in ids if i not in self.control), None)
        return text[1:] if first is not None and first not in self.byte_of and self.pieces[first].startswith(MARK) else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def split_words(text: str) -> list[str]:
    """Words of a text, each without the mark it starts with."""
    if not text:
        return []
    marked = MARK + text.replace(" ", MARK)
    if MARK * 2 in marked:
        return [w[1:] for w in WORDS.findall(marked)]
    return marked.split(MARK)[1:]


class WordCache:
    """(ids joined by commas, number of ids, text) of each word met so far."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.ids: dict[str, str] = {}
        self.counts: dict[str, int] = {}
        self.texts: dict[str, str] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.ids) > CACHE:
            for d in (self.ids, self.counts, self.texts):
                d.clear()
        new = [w for w in words if w not in self.ids]
        number = self.model.number
        for w, ids in zip(new, self.model.encode_words([MARK + w for w in new]), strict=True):
            self.ids[w] = ",".join([number[i] for i in ids])
            self.counts[w] = len(ids)
            self.texts[w] = self.model.word_text(ids)


def _encoded(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[list[str]], WordCache]]:
    cache = WordCache(piece_model(path))
    for batch in cut_rows(batches, "text", 4 << 20):
        words = [split_words(t or "") for t in batch.column("text").to_pylist()]
        cache.learn(set().union(*words))
        yield batch, words, cache


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the ids of each whole text and the text decoded from them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, cache in _encoded(batches, model):
            ids = [[int(x) for w in ws for x in cache.ids[w].split(",")] for ws in words]
            yield table_of({"doc_id": batch.column("doc_id"), "ids": ids,
                            "decoded": [cache.model.decode(x) for x in ids]}, ENCODED)

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) without building the lists of ids."""
    def digest(x: str) -> str:
        return hashlib.sha256(x.encode()).hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, cache in _encoded(batches, model):
            ids, counts, texts = cache.ids.__getitem__, cache.counts.__getitem__, cache.texts.__getitem__
            yield table_of({
                "doc_id": batch.column("doc_id"), "n_tokens": [sum(map(counts, ws)) for ws in words],
                "ids_sha256": [digest(",".join(map(ids, ws))) for ws in words],
                # the first word's text starts with the space that encoding puts there
                "decoded_sha256": [digest("".join(map(texts, ws))[1:]) for ws in words]}, DIGESTS)

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.  The
probability of a word is the sum, over all ways to cut the word into pieces, of the product
of their probabilities (forward algorithm); a text's score is the sum of its words' logs.
Piece probabilities are learned by expectation maximisation over the same lattice.

How it scales.  Learning uses a bounded sample: the ``per_lang`` labelled documents of each
language with the smallest hash of their id, whole texts.  Their word counts are made by
Spark and only those of the sample reach the driver.  Scoring is one narrow pass over whole
texts: a task runs the forward algorithm once for each word that is new to it, all new words
and all languages together in numpy, and looks up the rest.

Defined results: a null text, or one without a letter, is ``und`` with score 0; the same
holds for all texts if there is nothing to learn from.  Rows of a null id are scored too,
never learned from, and their ``held_out`` is null.  Repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.common import U64, cut_rows, mix64, table_of

MARK = "▁"
MAX_WORD = 32          # a longer run without white space counts as words of this many characters
SCALE = 100.0          # for each character, so that products stay within a double
FLOOR = 1e-7           # the least probability of a piece, and that of a character in no piece
CACHE = 400_000
TOGETHER = 8_000       # words whose lattices are held together
UND = "und"
FOLDS = 5


def is_held_out(id_col: str = "doc_id", folds: int = FOLDS, fold: int = 0) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % folds == fold


def words_of(text: str) -> list[str]:
    words = text.lower().split()
    if max(map(len, words), default=0) > MAX_WORD:
        return [w[i:i + MAX_WORD] for w in words for i in range(0, len(w), MAX_WORD)]
    return words


class Lattice:
    """All pieces that fit into given words, at each place and length."""

    def __init__(self, vocabulary: list[str]) -> None:
        self.pieces = [p for p in vocabulary if p]
        self.longest = max(map(len, self.pieces), default=1)
        hashes = np.array([self._hash(p) for p in self.pieces], U64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.maybe = np.zeros(1 << 22, bool)  # by the upper bits of a hash: spares most searches
        self.maybe[hashes >> U64(42)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        h = np.zeros(1, U64)
        for c in piece:
            h = mix64(h + U64(ord(c) + 1))
        return int(h[0])

    def arcs(self, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Sizes of the marked words, longest first expected, and for each piece length a
        matrix [word, start] of piece numbers, -1 where no piece fits."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        wide = int(sizes[0])
        codes = np.zeros((len(words), wide + self.longest), U64)
        flat = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(len(words)), sizes)
        codes[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat + U64(1)
        h, out = np.zeros((len(words), wide), U64), []
        for n in range(1, self.longest + 1):
            h = mix64(h + codes[:, n - 1:n - 1 + wide])
            piece = np.full(h.shape, -1, np.int32)
            at = np.nonzero(self.maybe[(h >> U64(42)).astype(np.int64)] & (np.arange(wide) + n <= sizes[:, None]))
            k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
            piece[at] = np.where(self.hashes[k] == h[at], self.order[k], -1)
            out.append(piece)
        return sizes, out


def _probabilities(piece: np.ndarray, p: np.ndarray, n: int) -> np.ndarray:
    """[.., language] of arcs of length n; a character in no piece has FLOOR in every language."""
    got = p[piece] * SCALE ** n
    got[piece < 0] = FLOOR * SCALE if n == 1 else 0.0
    return got


def forward(words: list[str], lattice: Lattice, p: np.ndarray) -> np.ndarray:
    """log probability [word, language] of words sorted from long to short: the sum over
    all segmentations.  p: [piece, language]."""
    sizes, arcs = lattice.arcs(words)
    wide = int(sizes[0])
    alpha = np.zeros((wide + 1, len(words), p.shape[1]))
    alpha[0] = 1.0
    for end in range(1, wide + 1):
        live = int(np.searchsorted(-sizes, -end, "right"))
        for n in range(1, min(end, lattice.longest) + 1):
            piece = arcs[n - 1][:live, end - n]
            some = np.flatnonzero(piece >= 0) if n > 1 else np.arange(live)
            if len(some):
                alpha[end, some] += alpha[end - n, some] * _probabilities(piece[some], p, n)
    return np.log(alpha[sizes, np.arange(len(words))]) - sizes[:, None] * np.log(SCALE)


def expected_counts(words: list[str], weights: np.ndarray, lattice: Lattice, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (one language: p [piece, 1]) in words of given counts."""
    sizes, arcs = lattice.arcs(words)
    wide, n_words = int(sizes[0]), len(words)
    alpha, beta = np.zeros((wide + 1, n_words)), np.zeros((wide + 1, n_words))
    alpha[0], beta[sizes, np.arange(n_words)] = 1.0, 1.0
    prob = [_probabilities(a, p, n + 1)[:, :, 0] for n, a in enumerate(arcs)]
    for end in range(1, wide + 1):
        for n in range(1, min(end, lattice.longest) + 1):
            alpha[end] += alpha[end - n] * prob[n - 1][:, end - n]
    for start in range(wide - 1, -1, -1):
        for n in range(1, min(wide - start, lattice.longest) + 1):
            beta[start] += beta[start + n] * prob[n - 1][:, start]
    share = weights / beta[0]
    counts = np.zeros(len(lattice.pieces))
    for n in range(1, lattice.longest + 1):
        use = (alpha[:wide - n + 1] * beta[n:]).T * prob[n - 1][:, :wide - n + 1] * share[:, None] if n <= wide else None
        if use is not None:
            piece = arcs[n - 1][:, :wide - n + 1]
            counts += np.bincount(piece[piece >= 0], use[piece >= 0], len(counts))
    return counts


def fit_pieces(counts: dict[str, int], lattice: Lattice, rounds: int = 4, prior: float = 0.05) -> np.ndarray:
    """Piece probabilities of one language from its word counts."""
    words = sorted(counts, key=len, reverse=True)
    weights = np.array([counts[w] for w in words], float)
    p = np.full((len(lattice.pieces), 1), 1 / len(lattice.pieces))
    for _ in range(rounds):
        use = np.zeros(len(lattice.pieces))
        for i in range(0, len(words), 20_000):
            use += expected_counts(words[i:i + 20_000], weights[i:i + 20_000], lattice, p)
        p = np.maximum((use + prior) / (use.sum() + prior * len(use)), FLOOR)[:, None]
    return p


@dataclass
class LanguageModel:
    languages: list[str]
    vocabulary: list[str]
    p: np.ndarray  # [piece, language]


def vocabulary_of(path: str, longest: int = 8) -> list[str]:
    """Pieces of a public SentencePiece model of at most ``longest`` characters."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [p for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))
            and len(p := sp.id_to_piece(i)) <= longest]


def learn(docs: DataFrame, vocabulary: list[str], per_lang: int = 400, rounds: int = 4) -> LanguageModel:
    """Fit on at most ``per_lang`` documents of each language among those not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    # the sample is chosen on ids alone; only its texts are read then
    known = rows.filter(~is_held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (known.select("doc_id", "lang").withColumn("nth", F.row_number().over(order))
              .filter(F.col("nth") <= per_lang).select("doc_id", "lang"))
    sample = known.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"])
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter
        for batch in cut_rows(batches, "text"):
            seen: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text))
            flat = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
            if flat:
                yield table_of(dict(zip(("lang", "word", "n"), zip(*flat, strict=True), strict=True)), schema)

    counted = (sample.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
               .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    got = counted.toArrow().to_pydict()
    by_lang: dict[str, dict[str, int]] = {}
    for lang, word, n in zip(got["lang"], got["word"], got["n"], strict=True):
        by_lang.setdefault(lang, {})[word] = n
    lattice, languages = Lattice(vocabulary), sorted(by_lang)
    p = [fit_pieces(by_lang[x], lattice, rounds) for x in languages]
    return LanguageModel(languages, vocabulary, np.hstack(p) if p else np.zeros((len(lattice.pieces), 0)))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", id_col: str = "doc_id",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row, and ``kept``, a struct of the
    columns in ``keep`` as they are."""
    # a text that is kept as it is goes to the task once
    carried = text_col in keep and docs.schema[text_col].dataType.simpleString() == "string"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col).alias("held_out"),
                       *([] if carried else [F.col(text_col).cast("string").alias("text")]),
                       F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(1)]).alias("kept"))

    def with_text(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("text", batch.column("kept").field(text_col)) if carried else batch

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model.vocabulary)
        place: dict[str, int] = {}
        scores = np.zeros((0, len(model.languages)))
        for batch in cut_rows(with_text(batches), "text", 1 << 20):
            texts = batch.column("text").to_pylist()
            words = [words_of(t) if t and any(map(str.isalpha, t)) and model.languages else [] for t in texts]
            if len(place) > CACHE:
                place, scores = {}, scores[:0]
            new = sorted(set().union(*words) - place.keys(), key=len, reverse=True)
            parts = [forward(new[i:i + TOGETHER], lattice, model.p) for i in range(0, len(new), TOGETHER)]
            place.update(zip(new, range(len(scores), len(scores) + len(new)), strict=True))
            scores = np.concatenate([scores, *parts])
            pred, score = [], []
            for ws in words:
                if not ws:
                    pred.append(UND)
                    score.append(0.0)
                    continue
                total = scores[np.fromiter(map(place.__getitem__, ws), np.int64, len(ws))].sum(0)
                best = int(total.argmax())
                pred.append(model.languages[best])
                score.append(float(1 / np.exp(total - total[best]).sum()))
            made = {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                    "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())}
            yield pa.RecordBatch.from_arrays([*made.values(), batch.column("kept")], names=[*made, "kept"])

    schema = f"doc_id long, held_out boolean, lang_pred string, score double, kept {rows.schema['kept'].dataType.simpleString()}"
    return rows.mapInArrow(run, schema).drop(*[] if keep else ["kept"])

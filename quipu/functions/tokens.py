"""Token-array Column functions.

All of them are built from Spark's higher-order array functions
(``transform``, ``slice``, ``sequence``...), so they run per row inside
generated code without exploding the arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quipu.functions.text import WS_BODY

# Boundary and unknown tokens of the reference.
SENTENCE_BEGIN = "<s>"
SENTENCE_END = "</s>"
UNK = "<UNK>"
UNK_ID = 1
PAD_ID = 0

# Documented subset of Treebank word tokenization (no sentence model):
# split contractions off their stem, then take words (with inner hyphens),
# clitics, and any other single non-space character.
CONTRACTION_PATTERN = r"([a-z])(n't|'s|'re|'ve|'ll|'d|'m)"
WORD_TOKEN_PATTERN = (r"n't|'[a-z]+|[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*|[^"
                      + WS_BODY + r"\p{L}\p{N}]")
# T4: characters the default Keras-style text tokenizer turns into separators.
SIMPLE_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'


def tokenize_words(c: Column) -> Column:
    """T1 on (already lowercased) text -> array<string>."""
    spaced = F.regexp_replace(c, CONTRACTION_PATTERN, "$1 $2")
    return F.regexp_extract_all(spaced, F.lit(WORD_TOKEN_PATTERN), 0)


def tokenize_chars(c: Column, space_char: str = " ") -> Column:
    """One token per code point, spaces replaced; '' -> []."""
    s = F.replace(c, F.lit(" "), F.lit(space_char)) if space_char != " " else c
    return F.when(F.char_length(s) == 0, F.array().cast("array<string>")).otherwise(F.split(s, ""))


def pad_boundaries(tokens: Column, n: int, begin: str = SENTENCE_BEGIN, end: str = SENTENCE_END) -> Column:
    """n == 1 -> one marker each side, else n-1 each side."""
    k = 1 if n == 1 else n - 1
    return F.concat(F.array_repeat(F.lit(begin), k), tokens, F.array_repeat(F.lit(end), k))


def tokenize_simple(c: Column) -> Column:
    """T4: lowercase, filtered characters -> space, split on space, drop empties."""
    s = F.translate(F.lower(c), SIMPLE_FILTERS, " " * len(SIMPLE_FILTERS))
    return F.filter(F.split(s, " "), lambda x: x != "")


def encode_fixed(ids: Column, eos_id: int, max_len: int = 192) -> Column:
    """Append the end id, truncate on the right -> struct(input_ids, attention_mask)."""
    full = F.slice(F.concat(ids, F.array(F.lit(eos_id))), 1, max_len)
    return F.struct(full.alias("input_ids"), F.transform(full, lambda _: F.lit(1)).alias("attention_mask"))


def ngram_windows(ids: Column, n: int) -> Column:
    """All contiguous length-n slices; none when the array is shorter than n."""
    size = F.size(ids)
    starts = F.sequence(F.lit(1), size - n + 1)
    return F.when(size >= n, F.transform(starts, lambda i: F.slice(ids, i, n))).otherwise(
        F.array().cast("array<array<int>>"))


def split_label(window: Column, n: int) -> tuple[Column, Column]:
    """(context, label); n == 1 -> context is the whole window."""
    if n == 1:
        return window, F.element_at(window, 1)
    return F.slice(window, 1, n - 1), F.element_at(window, -1)


def fix_context(ids: Column, length: int, pad_id: int = UNK_ID) -> Column:
    """Last ``length`` ids, left-padded with ``pad_id`` when shorter."""
    size = F.size(ids)
    tail = F.when(size > 0, F.slice(ids, F.greatest(size - length, F.lit(0)) + 1, length)).otherwise(
        F.array().cast("array<int>"))
    return F.concat(F.array_repeat(F.lit(pad_id), F.greatest(F.lit(length) - size, F.lit(0))), tail)

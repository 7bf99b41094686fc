"""Quality rules on repetition inside a document, by suffix arrays.

Each document's words get a suffix array by prefix doubling: suffixes are ranked by one word,
then by two, four and so on, from the ranks at i and at i + k, and only suffixes that still
share a rank go on.  The longest common prefixes of neighbours (LCP) give the intervals of the
suffix tree: an interval whose occurrences have unlike words before them is a maximal repeated
substring.  The union of the spans of those of ``LEAST`` words or more is what repeats; the
rules limit the fraction of the text that it covers and the length of the longest.  A 3-word
window is found twice just where a suffix shares three words with a neighbour, so the base
count comes from the same array.

Rules: a document of fewer than 50 words, or with more than half of its words in repeated
3-word windows, fails the base.  It is kept if it does not, if at most ``MOST_COVERED`` per
cent of the characters of its words lie in repeats of ``LEAST`` words or more, and if no
repeat is longer than ``LONGEST`` words.

How it scales.  One pass without a shuffle; the documents of about ``BLOCK`` bytes are ranked
together in arrays.  Work is n log n in a document's words and memory linear in its size; a
document is never split, so the longest one must fit a task.

Words are compared by 64-bit hashes.  Defined results: a null text has no words; rows are
independent, so repeated rows and null ids get the row's own result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quipu.llm.common import U64, RunHashes, covered, id_text, mix64, runs_of, table_of
from quipu.llm.words import BLANK, Words, batches_of, symbols, words_of

LEAST, MOST_COVERED, LONGEST = 10, 20, 50
WINDOW, FEWEST, MOST_REPEATED = 3, 50, 50
BLOCK = 4 << 20
SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_OUT = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                  ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("repeated_chars", pa.int64()), ("longest_repeat", pa.int64()),
                  ("n_repeats", pa.int64()), ("from", pa.list_(pa.int64())), ("to", pa.list_(pa.int64()))])


def suffix_array(symbol: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and LCPs of many sequences at once.

    ``symbol`` holds the sequences one after the other, ``owner`` the sequence of each place
    and ``ends`` the place after it.  Returns (sa, lcp): in ``sa`` the suffixes of a sequence
    that share a symbol are neighbours, in an order by symbols; ``lcp[s]`` is the length of the
    common prefix of ``sa[s - 1]`` and ``sa[s]`` (0 for those of different sequences).
    """
    n = len(symbol)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = mix64(symbol + mix64(owner.astype(np.uint64) + U64(1)))
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    new = np.ones(n + 1, bool)
    new[1:n] = ordered[1:] != ordered[:-1]
    apart = np.zeros(n, np.int64)       # the doubled length at which a neighbour was told apart
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new[:n], np.arange(n), 0))
    slots = np.flatnonzero(~(new[:n] & new[1:]))
    k = 1
    while len(slots):
        at = sa[slots]
        follow = np.where(at + k < ends[at], rank[np.minimum(at + k, n - 1)] + 1, 0)
        pair = rank[at] * (n + 1) + follow
        order = np.argsort(pair, kind="stable")
        at, pair = at[order], pair[order]
        sa[slots] = at
        split = np.zeros(len(slots), bool)
        split[1:] = pair[1:] != pair[:-1]
        split[0] = True
        fresh = slots[split & ~new[slots]]
        apart[fresh] = k
        new[fresh] = True
        rank[at] = np.maximum.accumulate(np.where(new[slots], slots, 0))
        slots = slots[~(new[slots] & new[slots + 1])]
        k *= 2
    # they agree in the first k words and not in the first 2 k: search between
    lcp, runs = apart, RunHashes(symbol)
    s = np.flatnonzero(apart > 1)
    a, b = sa[s - 1], sa[s]
    low, high = apart[s].copy(), np.minimum(2 * apart[s] - 1, np.minimum(ends[a] - a, ends[b] - b))
    while len(s):
        mid = (low + high + 1) // 2
        same = runs.of(a, a + mid) == runs.of(b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        done = low >= high
        lcp[s[done]] = low[done]
        s, a, b, low, high = (x[~done] for x in (s, a, b, low, high))
    return sa, lcp


def maximal_repeats(sa: np.ndarray, lcp: np.ndarray, before: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first slot, last slot + 1) of each maximal repeated substring of ``least``
    symbols or more: the intervals of the LCPs that can't be extended to the left either, as
    the symbols before their occurrences (``before``, unlike everything at a start) differ."""
    n = len(sa)
    change = np.ones(n + 1, np.int64)
    change[1:n] = before[sa[1:]] != before[sa[:-1]]
    change = np.cumsum(change)
    out: list[tuple[int, int, int]] = []
    for a, b in zip(*runs_of(lcp >= least), strict=True):     # suffixes a - 1 to b - 1
        open_: list[tuple[int, int]] = []
        for s, v in enumerate(lcp[a:b].tolist() + [0], int(a)):
            left = s - 1
            while open_ and open_[-1][0] > v:
                length, left = open_.pop()
                if change[s - 1] > change[left]:
                    out.append((length, left, s))
            if v >= least and (not open_ or open_[-1][0] < v):
                open_.append((v, left))
    return out


def _longest_at(sa: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place the longest prefix of its suffix that starts elsewhere too."""
    out = np.empty(len(sa), np.int64)
    out[sa] = np.maximum(lcp, np.append(lcp[1:], 0))
    return out


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _judge(words: Words, least: int, most_covered: int, longest: int) -> dict[str, object]:
    first = words.firsts()
    n_words = np.diff(first)
    chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80, dtype=np.int64)])
    size = chars[words.ends] - chars[words.starts]
    total = np.concatenate([[0], np.cumsum(size)])
    n = len(words.starts)
    symbol = symbols(words)
    sa, lcp = suffix_array(symbol, words.owner, first[words.owner + 1] if n else first)
    reach = _longest_at(sa, lcp)
    short = np.flatnonzero(reach >= WINDOW)
    again = covered(n, short, short + WINDOW)
    n_repeat = _sums(again, first)
    before = np.empty(n, np.uint64)
    before[1:] = symbol[:-1]
    starts = first[:-1][n_words > 0]
    before[starts] = mix64(starts.astype(np.uint64) + U64(1))
    # the union of the spans of all maximal repeats
    repeats = maximal_repeats(sa, lcp, before, least)
    n_repeats = np.bincount(words.owner[sa[[left for _, left, _ in repeats]]] if repeats else np.zeros(0, np.int64),
                            minlength=words.n_texts)
    long = np.flatnonzero(reach >= least)
    inside = covered(n, long, long + reach[long])
    length = np.zeros(words.n_texts, np.int64)
    np.maximum.at(length, words.owner[long], reach[long])
    covered_chars = _sums(np.where(inside, size, 0), first)
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | (words.owner[1:] != words.owner[:-1])
    end[:-1] &= ~inside[1:] | (words.owner[1:] != words.owner[:-1])
    starts_of: list[list[int]] = [[] for _ in range(words.n_texts)]
    ends_of: list[list[int]] = [[] for _ in range(words.n_texts)]
    for x, y in zip(np.flatnonzero(begin).tolist(), np.flatnonzero(end).tolist(), strict=True):
        t = words.owner[x]
        starts_of[t].append(x - first[t])
        ends_of[t].append(y + 1 - first[t])
    word_chars = total[first[1:]] - total[first[:-1]]
    failed = (n_words < FEWEST) | (100 * n_repeat > MOST_REPEATED * n_words)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": _sums(SYMBOL[words.data], words.bounds),
            "n_repeat_words": n_repeat, "base_failed": failed,
            "kept": ~failed & (100 * covered_chars <= most_covered * word_chars) & (length <= longest),
            "repeated_chars": covered_chars, "longest_repeat": length, "n_repeats": n_repeats, "from": starts_of, "to": ends_of}


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
            most_covered: int = MOST_COVERED, longest: int = LONGEST, block: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept; repeated_chars (characters of words in repeats of
    ``least`` words or more), longest_repeat (words, 0 if none), n_repeats (maximal repeated
    substrings), and the spans of words covered, as lists ``from`` and ``to``."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in batches_of(batches, block):
            found = _judge(words_of(data, bounds, BLANK == 0), least, most_covered, longest)
            whole = data.tobytes()
            found["doc_id"] = batch.column("doc_id")
            found["n_dup_lines"] = [dup_lines(whole[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield table_of(found, _OUT)

    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
              "kept boolean, repeated_chars long, longest_repeat long, n_repeats long, from array<long>, to array<long>")
    return id_text(docs, id_col, text_col).mapInArrow(judge, schema)

"""Substring match of texts against a term table of any size.

``matches_any`` tests each term of a parameter list on each text.  Here the terms are a table:

1. Every term is lowercased and gets an *anchor*, the rarest ``GRAM``-gram of its first
   ``PROBE`` characters (a term shorter than that is its own anchor).  Rarity is counted on a
   sample of the texts; it only decides which gram is looked up, never what matches.
2. Texts are cut into chunks that carry the characters around them.  In a task, the first
   ``PREFIX`` bytes of every gram of many chunks are tested at once, as integers, against a
   bitmap of the anchors' first bytes; only grams that pass become rows.
3. Those rows meet the terms of their anchor in an equi-join, and ``contains`` verifies the
   term on the chunk.  Of a term longer than ``PROBE`` the chunk shows the beginning; what
   passes is joined to its text, which shows the whole.

How it scales.  Texts are scanned once for the match and sampled once for rarity.  The bitmap
holds 16 bits for each anchor, at most ``MAX_BITS``; beyond that it lets more grams through
and stays right.  The anchored terms are broadcast if there are at most ``BROADCAST_TERMS`` of
them and they hold at most ``BROADCAST_CHARS`` characters; else both sides are shuffled by
anchor, where adaptive execution splits the texts of a hot anchor.  Matches are
pre-aggregated by (row, term) or by row before they move.  No term count or length is refused.

Matching is by substrings of the lowercased text, as in :func:`quipu.functions.verdict.matches_any`;
null and empty terms match nothing, a null text matches nothing, repeated terms count once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.operators.corpus import pin_table

GRAM = 4
CHUNK = 128                     # characters of a chunk at least, without those around it
PROBE = 512                     # characters of a term that are verified on a chunk
BITS_PER_ANCHOR, MAX_BITS = 16, 1 << 26
BROADCAST_TERMS, BROADCAST_CHARS = 500_000, 1 << 25
RARITY_SAMPLE = 64              # one chunk of so many is counted for rarity
PREFIX = 4                      # bytes of a gram that the bitmap tells apart
BATCH_BYTES = 4 << 20           # text of chunks that are tested at once
MULTIPLIER = 1640531527         # spreads 32 bits over the bitmap; products stay below 2^63


def _chunks(texts: DataFrame, key: str, text_col: str, around: int) -> DataFrame:
    """(key, chunk, lead, own): the lowercased text in chunks of ``own`` characters, with up to
    ``around`` characters before (``lead`` of them) and after."""
    size = max(CHUNK, around)
    parts = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(f"(?s).{{1,{size}}}"), 0)
    whole = texts.select(key, F.inline(F.array(F.struct(parts.alias("parts")))))
    each = whole.select(key, "parts", F.posexplode_outer("parts").alias("i", "part")).filter(F.col("part").isNotNull())

    def near(i: Column) -> Column:
        return F.coalesce(F.get("parts", i), F.lit(""))

    before, after = F.right(near(F.col("i") - 1), F.lit(around)), F.left(near(F.col("i") + 1), F.lit(around))
    return each.select(key, F.concat(before, "part", after).alias("chunk"), F.char_length(before).alias("lead"),
                       F.char_length("part").alias("own"), F.octet_length(before).alias("lead_bytes"), F.octet_length("part").alias("own_bytes"))


def _grams(chunks: DataFrame, carried: list[str], lengths: list[int]) -> DataFrame:
    """(carried, gram): the grams of each of the ``lengths`` that start in a chunk's own part."""
    at = chunks.select(*dict.fromkeys([*carried, "chunk"]), F.explode_outer(F.sequence(F.col("lead") + 1, F.col("lead") + F.col("own"))).alias("at"))
    cut = [F.substring(F.col("chunk"), F.col("at"), F.lit(n)) for n in lengths]
    if len(cut) == 1:
        return at.select(*carried, cut[0].alias("gram"))
    return at.select(*carried, F.explode_outer(F.array(*cut)).alias("gram"))


def _bitmap(grams: DataFrame, n: int) -> Column:
    """A test whether the column ``gram`` may be one of ``grams``."""
    bits = 64
    while bits < min(MAX_BITS, BITS_PER_ANCHOR * max(n, 1)):
        bits *= 2
    spot = F.xxhash64("gram").bitwiseAND(bits - 1)
    words = grams.select(spot.alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("s").bitwiseAND(63).cast("int"))).alias("b"))
    table = ["0"] * (bits // 64)
    for w, b in words.collect():        # one row for each word of the bitmap at most
        table[w] = str(b)
    # folded to one array literal before the plan runs
    word = F.element_at(F.split(F.lit(",".join(table)), ",").cast("array<long>"), F.shiftright(spot, 6).cast("int") + 1)
    return F.call_function("getbit", word, spot.bitwiseAND(63).cast("int")) == 1


def _prefixes(anchors: DataFrame, n: int) -> tuple[dict[int, np.ndarray], int]:
    """For each length of up to ``PREFIX`` bytes a bitmap of what anchors begin with, and its size
    as a power of two."""
    power = 16
    while power < 32 and (1 << power) < min(MAX_BITS, BITS_PER_ANCHOR * n):
        power += 1
    head = F.substring(F.encode("gram", "utf-8"), 1, PREFIX)
    value = F.conv(F.hex(head), 16, 10).cast("long")
    spot = F.shiftright((value * MULTIPLIER).bitwiseAND(0xFFFFFFFF), 32 - power)
    words = anchors.select(F.octet_length(head).alias("size"), F.shiftright(spot, 6).alias("w"),
                           F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(63).cast("int")).alias("b"))
    maps: dict[int, np.ndarray] = {}
    for size, w, b in words.groupBy("size", "w").agg(F.bit_or("b")).collect():   # a row for each word of the bitmap at most
        maps.setdefault(size, np.zeros((1 << power) // 64, np.uint64))[w] = b & 0xFFFFFFFFFFFFFFFF
    return maps, power


def _passing(data: np.ndarray, size: int, bitmap: np.ndarray, power: int) -> np.ndarray:
    """Whether the ``size`` bytes from each place of ``data`` may begin an anchor."""
    n = len(data)
    value = np.zeros(n, np.uint32)
    for i in range(size):
        value <<= np.uint32(8)
        value[:n - i] |= data[i:]
    spot = (value * np.uint32(MULTIPLIER)) >> np.uint32(32 - power)
    return (bitmap[spot >> np.uint32(6)] >> (spot & np.uint32(63)).astype(np.uint64)) & np.uint64(1) == 1


def _passed(maps: dict[int, np.ndarray], power: int, lengths: list[int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, chunk, gram) of the grams that start in a chunk's own part and may be anchors."""
    def some(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = batch.column("chunk").cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        begin = bounds[:-1] + batch.column("lead_bytes").to_numpy()
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, begin, 1)
        np.subtract.at(edge, begin + batch.column("own_bytes").to_numpy(), 1)
        own = (np.cumsum(edge[:-1]) > 0) & ((data & 0xC0) != 0x80)   # a gram starts where a character does
        hit = np.zeros(len(data), bool)
        for size, bitmap in maps.items():
            hit |= _passing(data, size, bitmap, power)
        at = np.flatnonzero(hit & own)
        row = np.searchsorted(bounds, at, "right") - 1
        whole, most = data.tobytes(), 4 * lengths[-1]
        rows, grams = [], []
        for i, r, end in zip(at.tolist(), row.tolist(), bounds[row + 1].tolist(), strict=True):
            gram = whole[i:min(i + most, end)].decode("utf-8", "ignore")
            for length in lengths:
                rows.append(r)
                grams.append(gram[:length])
        if not rows:
            return None
        taken = batch.select(["key", "chunk"]).take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([*taken.columns, pa.array(grams, pa.string())], names=["key", "chunk", "gram"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes = 0, np.cumsum(pc.binary_length(batch.column("chunk")).to_numpy(zero_copy_only=False).astype(np.int64))
            while at < batch.num_rows:
                base = sizes[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, base + BATCH_BYTES, "right")))
                if (found := some(batch.slice(at, end - at))) is not None:
                    yield found
                at = end

    return run


def anchored_terms(texts: DataFrame, terms: DataFrame, text_col: str = "text", term_col: str = "term", gram: int = GRAM,
                   rarity_sample: int = RARITY_SAMPLE) -> DataFrame:
    """(term, gram): each distinct lowercased term with its rarest gram (ties: the smallest)."""
    low = F.lower(F.col(term_col))
    each = pin_table(terms.select(low.alias("term")).filter("term <> ''").distinct(), "terms")
    probe = F.substring(F.col("term"), 1, PROBE)
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(probe) - (gram - 1), F.lit(1)))
    own = each.select("term", F.explode(F.array_distinct(F.transform(starts, lambda i: F.substring(probe, i, F.lit(gram))))).alias("gram"))
    own = pin_table(own, "term-grams")
    several = own.groupBy("term").agg(F.count("*").alias("c")).filter("c > 1").select("term")
    wanted = own.join(several, "term").select("gram").distinct()
    picked = _chunks(texts.select(F.lit(0).alias("k"), text_col), "k", text_col, gram).filter(
        F.pmod(F.xxhash64("chunk"), F.lit(rarity_sample)) == 0)
    found = _grams(picked, [], [gram]).filter(_bitmap(wanted, wanted.count())).groupBy("gram").agg(F.count("*").alias("often"))
    ranked = own.join(found, "gram", "left").select("term", F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram").alias("g"))
    return ranked.groupBy("term").agg(F.min("g").alias("g")).select("term", "g.gram")


def term_matches(texts: DataFrame, terms: DataFrame, key: str, text_col: str = "text", term_col: str = "term",
                 gram: int = GRAM) -> DataFrame:
    """(key, term): each term with each row whose text contains it, once for each chunk that
    shows it; group by what is needed.  ``key`` tells the rows of ``texts`` apart."""
    anchors = pin_table(anchored_terms(texts, terms, text_col, term_col, gram), "anchors")
    n, longest, chars = anchors.agg(F.count("*"), F.max(F.char_length("term")), F.sum(F.char_length("term"))).first()
    lengths = sorted(r[0] for r in anchors.select(F.char_length("gram")).distinct().collect()) or [gram]
    rows = texts.select(F.col(key).alias("key"), F.col(text_col).alias("text"))
    maps, power = _prefixes(anchors, n)
    chunks = _chunks(rows, "key", "text", min(longest or 1, PROBE)).select("key", "chunk", "lead_bytes", "own_bytes")
    hits = chunks.mapInArrow(_passed(maps, power, lengths), f"key {rows.schema['key'].dataType.simpleString()}, chunk string, gram string")
    if n <= BROADCAST_TERMS and (chars or 0) <= BROADCAST_CHARS:
        anchors = F.broadcast(anchors)
    found = hits.join(anchors, "gram").filter(F.contains("chunk", F.substring("term", 1, PROBE))).select("key", "term")
    if (longest or 0) > PROBE:
        cut = F.char_length("term") > PROBE
        whole = found.filter(cut).distinct().join(rows, "key").filter(F.contains(F.lower("text"), "term")).select("key", "term")
        found = found.filter(~cut).unionByName(whole)
    return found.select(F.col("key").alias(key), "term")


def count_terms(texts: DataFrame, terms: DataFrame, key: str, text_col: str = "text", term_col: str = "term",
                gram: int = GRAM) -> DataFrame:
    """(key, n_terms, first_term): the number of distinct terms in each row's text that has
    one, and the smallest."""
    pairs = term_matches(texts, terms, key, text_col, term_col, gram).distinct()
    return pairs.groupBy(key).agg(F.count("*").alias("n_terms"), F.min("term").alias("first_term"))


def matching_keys(texts: DataFrame, terms: DataFrame, key: str, text_col: str = "text", term_col: str = "term",
                  gram: int = GRAM) -> DataFrame:
    """(key): the rows whose text contains any term."""
    return term_matches(texts, terms, key, text_col, term_col, gram).select(key).distinct()


def with_any_term(texts: DataFrame, terms: DataFrame, key: str, text_col: str = "text", term_col: str = "term") -> DataFrame:
    """J6, semi: the rows whose text contains any term."""
    return texts.join(matching_keys(texts, terms, key, text_col, term_col), key, "left_semi")


def without_any_term(texts: DataFrame, terms: DataFrame, key: str, text_col: str = "text", term_col: str = "term") -> DataFrame:
    """J6, anti: the rows whose text contains no term (a null text contains none)."""
    return texts.join(matching_keys(texts, terms, key, text_col, term_col), key, "left_anti")

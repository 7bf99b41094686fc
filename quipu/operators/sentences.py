"""Sentence boundaries learned from the corpus (T1), after Kiss and Strunk (2006).

Nothing is given but the texts.  A word that nearly always carries a period, is short and
rarely occurs without one is an abbreviation; whether its period also ends a sentence is
decided by the word after it: whether the two are a collocation, whether that word often
starts sentences, and how it is written elsewhere.  All of it comes from one aggregate over
the corpus, the counts of neighbouring word types (``pair_counts``).

How it scales.  Texts are read once to learn and once to split, and never shuffled.  Pairs are
counted map-side before they move; every further statistic is an aggregate of that table.  To
split, only words with a period are exploded and meet the table of pairs that don't end a
sentence, broadcast if it has at most ``BROADCAST_PAIRS`` rows, else by a shuffled join on the
pair; each document's few inner periods then come back to its text by its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.functions import tokens as TK
from quipu.functions.text import WS
from quipu.operators import corpus as C

# Fixed values of the published method.
ABBREVIATION, COLLOCATION, STARTER = 0.3, 7.88, 30.0
ALWAYS = 0.99               # a true abbreviation's chance of its period
BROADCAST_PAIRS = 1_000_000
BEFORE, BEHIND = "\"'([{“‘«", "\"')]}”’»"
AROUND = "^[\"'(\\[{“‘«]+|[\"')\\]}”’»]+$"
NUMBER, NUMBER_TYPE = "^[+-]?[0-9][0-9.,]*$", "##number##"
INNER = ""            # stands for a period that doesn't end a sentence
WORDS = (r"n't|'[a-z]+|[\p{L}\p{N}]+(?:[-" + INNER + r"][\p{L}\p{N}]+)*" + INNER + "?|" + TK.WORD_TOKEN_PATTERN.rsplit("|", 1)[1])


def blank_tokens(text: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(text, WS + "+"), lambda x: x != "")


def core(token: Column) -> Column:
    """Without the quotes and brackets around it."""
    return F.rtrim(F.ltrim(token, F.lit(BEFORE)), F.lit(BEHIND))


def type_of(word: Column) -> Column:
    """Lowercased, without its last period; numbers are one type."""
    bare = F.lower(F.when(F.endswith(word, F.lit(".")), F.left(word, F.char_length(word) - 1)).otherwise(word))
    # what begins a number sorts before a colon
    return F.when((bare < ":") & F.regexp_like(bare, F.lit(NUMBER)), F.lit(NUMBER_TYPE)).otherwise(bare)


def _starts(word: Column, first: str, last: str, pattern: str) -> Column:
    """Whether a word starts with a letter of a class; an ASCII one is told by its place."""
    return F.when(word < "\u0080", (word >= first) & (word < chr(ord(last) + 1))).otherwise(F.regexp_like(word, F.lit(pattern)))


def _capital(word: Column) -> Column:
    return _starts(word, "A", "Z", r"^\p{Lu}")


def _strong(word: Column) -> Column:
    return F.endswith(word, F.lit("!")) | F.endswith(word, F.lit("?"))


def pair_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(type, low, dot, strong, next, next_cap, n): how often a type, written with a small
    letter or not, with a period or a strong mark after it, comes before a type, capitalized
    or not (null at the end of a text)."""
    words = F.transform(blank_tokens(F.col(text_col)), core)
    held = docs.select(F.inline(F.array(F.struct(words.alias("words")))))
    each = held.select("words", F.posexplode_outer("words").alias("pos", "word")).filter(F.col("pos").isNotNull())
    p = each.select("word", F.get("words", F.col("pos") + 1).alias("next"))
    word, after = F.col("word"), F.col("next")
    return p.select(
        type_of(word).alias("type"), _starts(word, "a", "z", r"^\p{Ll}").alias("low"), F.endswith(word, F.lit(".")).alias("dot"),
        _strong(word).alias("strong"), type_of(after).alias("next"), _capital(after).alias("next_cap"),
    ).groupBy("type", "low", "dot", "strong", "next", "next_cap").agg(F.count("*").alias("n"))


def _likely(k: Column, n: Column, p: Column) -> Column:
    """k ln p + (n - k) ln (1 - p), where 0 ln 0 = 0."""
    return (F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(n > k, (n - k) * F.log(1 - p)).otherwise(0.0))


def _dunning(both: Column, first: Column, second: Column, total: Column) -> Column:
    """Log-likelihood ratio of ``both`` joint occurrences against independence."""
    p, p1, p2 = second / total, both / first, (second - both) / (total - first)
    return -2 * (_likely(both, first, p) + _likely(second - both, total - first, p)
                 - _likely(both, first, p1) - _likely(second - both, total - first, p2))


class SentenceModel:
    """Pinned tables: ``types`` (type, n, n_dot, n_low, score, is_abbreviation), ``starters``
    (type, n_after, n_upper, ratio, is_starter), ``collocations`` (type, next, n, ratio,
    is_collocation) and ``inner`` (type, next, next_cap): periods that don't end a sentence."""

    def __init__(self, types: DataFrame, starters: DataFrame, collocations: DataFrame, inner: DataFrame) -> None:
        self.types, self.starters, self.collocations, self.inner = types, starters, collocations, inner


def learn(docs: DataFrame, text_col: str = "text") -> SentenceModel:
    """Statistics of all texts; null texts have no words."""
    pairs = C.pin_table(pair_counts(docs, text_col), "pair-counts")
    n, dot = F.col("n"), F.col("dot")
    counts = pairs.groupBy("type").agg(F.sum("n").alias("n"), F.sum(F.when(dot, n).otherwise(0)).alias("n_dot"),
                                       F.sum(F.when(F.col("low"), n).otherwise(0)).alias("n_low"))
    counts = C.pin_table(counts, "type-counts")
    total, dots = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_dot"), F.lit(0))).first()
    p = F.lit(min(max(dots / total if total else 0.0, 1e-9), 1 - 1e-9))
    bare = F.col("n") - F.col("n_dot")
    inside = F.char_length("type") - F.char_length(F.replace("type", F.lit("."), F.lit("")))
    size = F.char_length("type") - inside
    ratio = -2 * (_likely(F.col("n_dot"), F.col("n"), p) - _likely(F.col("n_dot"), F.col("n"), F.lit(ALWAYS)))
    score = ratio * F.exp(-size) * (inside + 1) * F.exp(-bare * F.log(F.greatest(size, F.lit(1))))
    scored = F.when((F.col("n_dot") > 0) & F.regexp_like("type", F.lit(r"\p{L}")), score).otherwise(F.lit(0.0))
    types = counts.select("*", scored.alias("score")).withColumn("is_abbreviation", F.col("score") >= ABBREVIATION)

    # few types are abbreviations: the pairs are read in place and never written again
    short = C.pin_table(types.filter("is_abbreviation").select("type", F.lit(True).alias("abbreviation")), "abbreviations")
    short = F.broadcast(short) if short.count() <= BROADCAST_PAIRS else short
    marked = pairs.join(short, "type", "left").withColumn("abbreviation", F.coalesce("abbreviation", F.lit(False)))
    ends = F.col("strong") | (F.col("dot") & ~F.col("abbreviation"))
    after = marked.filter("next is not null").groupBy(F.col("next").alias("type")).agg(
        F.sum(F.when(ends, n).otherwise(0)).alias("n_after"), F.sum(F.when(~ends & F.col("next_cap"), n).otherwise(0)).alias("n_upper"))
    after = C.pin_table(after, "follows")
    breaks = F.lit(int(after.agg(F.coalesce(F.sum("n_after"), F.lit(0))).first()[0]))
    whole = F.lit(int(total))
    likely = _dunning(F.col("n_after"), breaks, F.col("n"), whole)
    starts = ((F.col("n_after") > 0) & F.regexp_like("type", F.lit(r"^\p{L}")) & (F.col("n_after") / breaks > F.col("n") / whole))
    starters = types.select("type", "n", "n_low").join(after, "type").withColumn("ratio", F.when(starts, likely).otherwise(F.lit(0.0)))
    starters = C.pin_table(starters.withColumn("is_starter", F.col("ratio") >= STARTER), "starters")

    seen = C.pin_table(marked.filter("dot and abbreviation and next is not null").groupBy("type", "next", "next_cap").agg(F.sum("n").alias("n")), "seen-pairs")
    joint = seen.groupBy("type", "next").agg(F.sum("n").alias("n"))
    joint = (joint.join(types.select("type", F.col("n_dot").alias("n_first")), "type")
             .join(starters.select(F.col("type").alias("next"), F.col("n").alias("n_second"), "is_starter"), "next"))
    fast = (F.col("n") > 1) & (F.col("n") / F.col("n_first") > F.col("n_second") / whole) & ~F.col("is_starter")
    likely = F.when(fast, _dunning(F.col("n"), F.col("n_first"), F.col("n_second"), whole)).otherwise(F.lit(0.0))
    collocations = joint.select("type", "next", "n", likely.alias("ratio")).withColumn("is_collocation", F.col("ratio") >= COLLOCATION)
    collocations = C.pin_table(collocations, "collocations")

    seen = (seen.select("type", "next", "next_cap").join(collocations.select("type", "next", "is_collocation"), ["type", "next"])
            .join(starters.select(F.col("type").alias("next"), "is_starter", "n_low", "n_upper"), "next"))
    begins = F.col("next_cap") & (F.col("is_starter") | ((F.col("n_low") > 0) & (F.col("n_upper") == 0)))
    inner = C.pin_table(seen.filter(F.col("is_collocation") | ~begins).select("type", "next", "next_cap"), "inner-periods")
    return SentenceModel(types, starters, collocations, inner)


def _with_inner(docs: DataFrame, model: SentenceModel, key: str, text_col: str) -> DataFrame:
    """(key, tokens, inner): the words between white space, and the places of those whose period
    doesn't end a sentence."""
    held = docs.select(key, F.inline(F.array(F.struct(blank_tokens(F.coalesce(text_col, F.lit(""))).alias("tokens")))))
    dotted = F.array_compact(F.transform("tokens", lambda x, i: F.when(F.endswith(core(x), F.lit(".")), i)))
    spots = held.select(key, "tokens", F.explode_outer(dotted).alias("pos")).filter(F.col("pos").isNotNull())
    pairs = spots.select(key, "pos", core(F.get("tokens", F.col("pos"))).alias("word"), core(F.get("tokens", F.col("pos") + 1)).alias("next"))
    met = pairs.filter(F.col("next").isNotNull()).select(key, "pos", type_of(F.col("word")).alias("type"), type_of(F.col("next")).alias("next"),
                                                         _capital(F.col("next")).alias("next_cap"))
    side = F.broadcast(model.inner) if model.inner.count() <= BROADCAST_PAIRS else model.inner
    places = met.join(side, ["type", "next", "next_cap"]).groupBy(key).agg(F.collect_list("pos").alias("inner"))
    return held.join(places, key, "left").select(key, "tokens", F.coalesce("inner", F.array().cast("array<int>")).alias("inner"))


def split_sentences(docs: DataFrame, model: SentenceModel, key: str = "doc_key", text_col: str = "text") -> DataFrame:
    """(key, sentences array<string>): each text cut after words that end a sentence (a period
    that isn't inner, ``!`` or ``?``), words joined by one space.  A text without words, or a null
    one, has no sentences.  ``key`` tells the rows apart."""
    def ends(word: Column, i: Column) -> Column:
        return _strong(word) | (F.endswith(word, F.lit(".")) & ~F.array_contains("inner", i))

    def mark(x: Column, end: Column) -> Column:
        return F.concat(x, F.when(end, F.lit("\n")).otherwise(F.lit(" ")))

    rows = _with_inner(docs, model, key, text_col)
    marked = F.array_join(F.zip_with("tokens", F.transform(F.transform("tokens", core), ends), mark), "")
    return rows.select(key, F.transform(F.filter(F.split(marked, "\n"), lambda x: F.trim(x) != ""), lambda x: F.trim(x)).alias("sentences"))


def tokenize_sentences(docs: DataFrame, model: SentenceModel, key: str = "doc_key", text_col: str = "text") -> DataFrame:
    """(key, tokens array<string>): T1's word rules after the sentence model: a period that
    doesn't end a sentence stays with its word (``mr.``), a final one is a token."""
    def keep(x: Column, i: Column) -> Column:
        return F.when(F.array_contains("inner", i), F.replace(x, F.lit("."), F.lit(INNER))).otherwise(x)

    rows = _with_inner(docs, model, key, text_col)
    joined = F.lower(F.array_join(F.transform("tokens", keep), " "))
    spaced = F.regexp_replace(joined, TK.CONTRACTION_PATTERN, "$1 $2")
    words = F.regexp_extract_all(spaced, F.lit(WORDS), 0)
    return rows.select(key, F.transform(words, lambda x: F.replace(x, F.lit(INNER), F.lit("."))).alias("tokens"))

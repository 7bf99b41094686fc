"""Q0 ``curate_corpus``: sources -> join -> score -> redaction -> clean -> non-empty
-> union -> length -> dedup -> head.

Input frames carry ``(pos, score, raw_text)`` (readers build ``raw_text`` with
their own null policy).  All row filters are one fused projection/filter stage;
the only shuffle is the dedup aggregate on the cleaned text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.functions import text as T
from quipu.operators import corpus as C

MIN_SCORE = 10
MIN_LEN = 20
MAX_LEN = 400


def curate_raw(raw: DataFrame, names: Sequence[str], min_score: float = MIN_SCORE,
               lo: int = MIN_LEN, hi: int = MAX_LEN, max_docs: int | None = None) -> DataFrame:
    """``raw``: (doc_key, score, raw_text).  Returns (doc_key, corpus, text)."""
    text = T.collapse_ws(T.strip_entities_lm(F.col("raw_text")))   # 'lm' profile; '' dropped below
    pre = (raw.select("doc_key", "score", "raw_text")
              .filter(F.col("score") >= F.lit(min_score))        # pushed to the scan
              .filter(~T.is_redacted(F.col("raw_text"))))
    kept = (C.compute_once(pre, ["doc_key"], text=text)
              .filter(F.col("text") != "")
              .filter(T.length_between(F.col("text"), lo, hi)))
    out = C.dedup_exact(kept, "text", "doc_key", names)
    if max_docs is not None:
        out = C.head(out, max_docs)
    return out.select("doc_key", "corpus", "text")


def funnel(raw: DataFrame, names: Sequence[str], min_score: float = MIN_SCORE, lo: int = MIN_LEN, hi: int = MAX_LEN) -> DataFrame:
    """A0 over ``raw`` (doc_key, corpus, score, raw_text): every text is read and cleaned once,
    and only if it gets as far as cleaning.  The stage outcomes, with the texts that pass all
    of them, are one narrow table, from which both the counts and the dedup are aggregated
    (counts observed while a job runs would be counted again for tasks run again)."""
    score = F.coalesce(F.col("score") >= F.lit(min_score), F.lit(False))
    unredacted = F.coalesce(~T.is_redacted(F.col("raw_text")), F.lit(False))
    once = C.compute_once(raw, ["doc_key", "corpus"], ok_score=score, ok_unredacted=unredacted,
                          text=F.when(score & unredacted, T.clean(F.col("raw_text"), "lm")))
    length = F.coalesce(T.length_between(F.col("text"), lo, hi), F.lit(False))
    flags = once.select("doc_key", "corpus", "ok_score", "ok_unredacted", F.col("text").isNotNull().alias("ok_nonempty"), length.alias("ok_length"),
                        F.when(length, F.col("text")).alias("text"))
    flags = C.pin_table(flags, "stage-flags")
    return C.curation_funnel(flags, C.dedup_exact(flags.filter("ok_length"), "text", "doc_key", names), "corpus")


def posts_to_raw(posts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Post table (post_id, corpus, title, selftext, score) -> raw rows keyed by
    source rank and post id; title/body joined with the null -> '' policy."""
    rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("corpus")) - 1
    return posts.select(
        (rank.cast("long") * F.lit(1 << C.RANK_SHIFT) + F.col("post_id")).alias("doc_key"),
        F.col("corpus"),
        F.col("score").cast("double").alias("score"),
        T.join_title_body(F.col("title"), F.col("selftext"), "empty").alias("raw_text"))


def curate_corpus(frames: Sequence[tuple[str, DataFrame]], **kw) -> DataFrame:
    """Frames in source order, each with (pos, score, raw_text)."""
    names = [n for n, _ in frames]
    raw = C.union_corpora(frames, "pos")
    return curate_raw(raw, names, **kw)

"""Rule-based acceptance of candidate texts.

Term matching is *substring* matching on the lowercased text, as in the
reference: short terms also hit inside harmless words.  Term lists here are small
parameters (tens to a few hundred phrases); each becomes one ``contains`` test
in a single generated predicate, so the check is a pure projection with no
join and no Python.  Term tables of any size are matched by
:mod:`quipu.operators.term_join`.  The explicit-content list is caller-supplied; only the
boilerplate list (neutral meta phrases) ships as fixed values.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quipu.functions import text as T

# ---------------------------------------------------------------------------
# The reference's meta/boilerplate phrases, in its order.
# ---------------------------------------------------------------------------
BOILERPLATE_TERMS = (
    "edit:", "edit!", "edit 2", "edit 3", "*edit",
    "thanks for the gold", "thanks for the silver", "thanks for the award",
    "thank you for", "thanks everyone", "thanks guys", "thanks for reading",
    "thanks for nothing", "thanks stranger",
    "i'll see myself out", "i'll show myself out", "see myself out",
    "wow this blew up", "this blew up", "blew up",
    "first time posting", "first post", "my first",
    "hope this helps", "hope you like", "hope you enjoy",
    "let me know", "let us know",
    "sorry for", "sorry if", "i'm sorry", "im sorry", "apologies",
    "not sure if", "i'm not sure", "im not sure",
    "original post", "originally posted", "was posted",
    "x-post", "xpost", "crosspost", "cross post",
    "repost", "re-post", "taken from", "stolen from",
    "credit to", "credits to", "credit:", "credits:",
    "source:", "sauce:",
    "tl;dr", "tldr", "tl:dr",
    "[removed]", "[deleted]", "[nsfw]", "[nsfl]", "[oc]", "[long]",
    "/u/", "/r/", "r/", "u/",
    "upvote", "downvote", "karma",
    "reddit", "subreddit", "redditor",
    "gold!", "silver!", "platinum!",
    "good luck!", "good luck everyone",
    "*note:", "note:", "*note",
    "i know this is", "i know it's",
    "i'd like to", "i would like to",
    "aww,", "aww ", "lol", "lmao", "rofl",
    ":)", ":(", ":d", ";)", ":p", "<3",
    "haha", "hehe", "hihi",
)

# Reason codes, in rule order (fixed values).
REASON_TOO_SHORT = "too short"
REASON_EXPLICIT = "explicit"
REASON_BOILERPLATE = "reddit garbage"
REASON_NO_END_PUNCT = "no ending punctuation"
REASON_PARENS = "unclosed parens"
REASON_QUOTES = "unclosed quotes"
REASON_GOOD = "good"

MAX_TERMS = 5000   # a term list is a parameter, not data; refuse unbounded lists


def _terms(terms: Iterable[str]) -> list[str]:
    out = [t.lower() for t in terms if t]
    if len(out) > MAX_TERMS:
        raise ValueError(f"term list has {len(out)} entries (> {MAX_TERMS}); "
                         "match it as a table with quipu.operators.term_join instead")
    return out


def matches_any(c: Column, terms: Iterable[str]) -> Column:
    """lowercased text contains any term (substring)."""
    lowered = F.lower(c)
    pred = F.lit(False)
    for t in _terms(terms):
        pred = pred | lowered.contains(t)
    return pred


def quality_verdict(c: Column, explicit_terms: Iterable[str] = (),
                    boilerplate_terms: Iterable[str] = BOILERPLATE_TERMS,
                    min_len: int = 20) -> Column:
    """first failing rule wins -> ``struct<ok:boolean, reason:string>``."""
    return verdict_of(c, matches_any(c, explicit_terms), matches_any(c, boilerplate_terms), min_len)


def verdict_of(c: Column, explicit: Column, boilerplate: Column, min_len: int = 20) -> Column:
    """F12 where whether the text matches either term list is known already, as for lists
    that are tables (:mod:`quipu.operators.term_join`)."""
    reason = (F.when(~T.min_length(c, min_len), F.lit(REASON_TOO_SHORT))
              .when(explicit, F.lit(REASON_EXPLICIT))
              .when(boilerplate, F.lit(REASON_BOILERPLATE))
              .when(~T.ends_with_punctuation(c), F.lit(REASON_NO_END_PUNCT))
              .when(~T.balanced_parens(c), F.lit(REASON_PARENS))
              .when(~T.even_quotes(c), F.lit(REASON_QUOTES))
              .otherwise(F.lit(REASON_GOOD)))
    return F.struct((reason == REASON_GOOD).alias("ok"), reason.alias("reason"))

"""SQL (DuckDB dialect) spellings of the text rules, for the correctness oracle.

They use the same fixed patterns as :mod:`quipu.functions.text`; RE2 differs
from Java only in flag syntax (``(?i)`` for ``(?iu)``), replacement syntax
(``\\1`` for ``$1``) and the ``'g'`` flag for replace-all.
"""

from __future__ import annotations

from quipu.functions import text as T
from quipu.functions import verdict as V


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(e: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({e}, {lit(pattern)}, {lit(repl)}, 'g')"


def strip_ws(e: str) -> str:
    return rx(e, "^" + T.WS + "+|" + T.WS + "+$")


def collapse_ws(e: str) -> str:
    return f"trim({rx(e, T.WS + '+', ' ')})"


def clean_lm(e: str) -> str:
    out = collapse_ws(rx(e, T.LM_ENTITY_PATTERN))
    return f"nullif({out}, '')"


def clean_rnn(e: str, hex_mode: str = "reference") -> str:
    out = rx(e, T.HEX_ENTITY_PATTERN[hex_mode])
    out = rx(out, T.NAMED_ENTITY_PATTERN)
    out = rx(out, T.KEEP_ASCII_PATTERN)
    return f"lower({collapse_ws(out)})"


def clean_tsv(e: str) -> str:
    return f"lower({strip_ws('translate(' + e + ', ' + lit(chr(9) + chr(13) + chr(10)) + ', ' + lit('') + ')')})"


def clean_toy(e: str) -> str:
    out = rx(f"lower({e})", T.URL_PATTERN)
    return collapse_ws(rx(out, T.KEEP_ASCII_LOWER_PATTERN, " "))


def clean_generated(e: str) -> str:
    words = "|".join(T.META_PAREN_WORDS)
    out = rx(e, r"(?i)\([^)]*(?:" + words + r")[^)]*\)")
    out = rx(out, r"\[[^\]]*\]")
    for prefix in ("/u/", "u/", "/r/", "r/"):
        out = rx(out, prefix + T.WORD + "+")
    out = rx(out, "(?i)" + T.EMOTICON_PATTERN)
    out = rx(out, "[" + T.EMOJI_CHARS + "]")
    out = rx(out, r"\*[^*]+\*")
    out = rx(out, r"\^\^\^[^\n]*")
    out = rx(out, r"\^\([^\n]*?\)")
    out = rx(out, r"\^" + T.NON_WS + "+")
    out = collapse_ws(out)
    out = rx(out, T.WS + "+([.,!?])", r"\1")
    out = rx(out, r"\.{4,}", "...")
    out = rx(out, "!{2,}", "!")
    out = rx(out, r"\?{2,}", "?")
    return strip_ws(out)


def is_redacted(e: str) -> str:
    return f"(contains({e}, '[removed]') OR contains({e}, '[deleted]'))"


def matches_any(e: str, terms) -> str:
    terms = [t.lower() for t in terms if t]
    if not terms:
        return "FALSE"
    return "(" + " OR ".join(f"contains(lower({e}), {lit(t)})" for t in terms) + ")"


def ends_with_punct(e: str) -> str:
    s = strip_ws(e)
    return f"(length({s}) > 0 AND right({s}, 1) IN ('.', '!', '?'))"


def count_char(e: str, ch: str) -> str:
    return f"(length({e}) - length(replace({e}, {lit(ch)}, '')))"


def verdict_reason(e: str, explicit=(), boilerplate=V.BOILERPLATE_TERMS, min_len: int = 20) -> str:
    return (f"CASE WHEN length({e}) < {min_len} THEN {lit(V.REASON_TOO_SHORT)} "
            f"WHEN {matches_any(e, explicit)} THEN {lit(V.REASON_EXPLICIT)} "
            f"WHEN {matches_any(e, boilerplate)} THEN {lit(V.REASON_BOILERPLATE)} "
            f"WHEN NOT {ends_with_punct(e)} THEN {lit(V.REASON_NO_END_PUNCT)} "
            f"WHEN {count_char(e, '(')} <> {count_char(e, ')')} THEN {lit(V.REASON_PARENS)} "
            f"WHEN {count_char(e, chr(34))} % 2 <> 0 THEN {lit(V.REASON_QUOTES)} "
            f"ELSE {lit(V.REASON_GOOD)} END")


def rank_case(col: str, names) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {lit(n)} THEN {i}" for i, n in enumerate(names)) + " END"


def name_case(rank_expr: str, names) -> str:
    return "CASE " + " ".join(f"WHEN {rank_expr} = {i} THEN {lit(n)}" for i, n in enumerate(names)) + " END"

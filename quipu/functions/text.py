"""Column-level text cleaning and predicates.

All patterns use *explicit* character classes so that Spark (Java regex) and the
SQL oracle (RE2) agree, and so both agree with the reference's Python ``re``:

* ``WS`` is exactly the set of code points for which ``str.isspace()`` is true,
  i.e. what Python's Unicode ``\\s`` matches.  Java's ``\\s`` is ASCII-only.
* ``WORD`` is ``[\\p{L}\\p{N}_]``, Python's Unicode ``\\w``.
* ``.`` is written ``[^\\n]`` because Java's dot also stops at ``\\r``, U+0085,
  U+2028 and U+2029 while Python's stops only at ``\\n``.

Every function here takes and returns a ``Column``; they compose into one
projection that stays inside whole-stage code generation.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F



def class_ranges(chars: str) -> str:
    """Character-class body with consecutive code points folded into ranges
    (Java evaluates one predicate per class item, so ranges are cheaper)."""
    cps = sorted({ord(c) for c in chars})
    out, i = [], 0
    while i < len(cps):
        j = i
        while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
            j += 1
        out.append(chr(cps[i]) if i == j else chr(cps[i]) + "-" + chr(cps[j]))
        i = j + 1
    return "".join(out)


# Derived by rule: the code points Python treats as whitespace.
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WS_BODY = class_ranges(WS_CHARS)
WS = "[" + WS_BODY + "]"
NON_WS = "[^" + WS_BODY + "]"
WORD = r"[\p{L}\p{N}_]"

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results).
# ---------------------------------------------------------------------------
REDACTION_MARKERS = ("[removed]", "[deleted]")
# Entity alternation of the language-model cleaner, in the reference's order.
LM_ENTITY_PATTERN = r"&amp;|&#x200B;|#x200B;|&[a-zA-Z]+;"
# Hex-entity stripper of the n-gram cleaner ('reference' damages words such as
# "xbox"; 'safe' only removes well-formed "&#x...;" references).
HEX_ENTITY_PATTERN = {"reference": r"&?#?x[0-9a-fA-F]+;?", "safe": r"&#x[0-9a-fA-F]+;"}
NAMED_ENTITY_PATTERN = r"&[a-zA-Z]+;"
KEEP_ASCII_PATTERN = "[^a-zA-Z0-9" + WS_BODY + r".,!?;:'" + '"' + "-]"
KEEP_ASCII_LOWER_PATTERN = "[^a-z0-9" + WS_BODY + ".,!?']"
URL_PATTERN = "http" + NON_WS + "+"


def latin_class(chars: str) -> str:
    """The Latin-1 characters among ``chars``, each written out: Java tests such a class by one
    table look-up, but one made of ranges or negated by a call for every range."""
    return "[" + "".join(f"\\x{ord(c):02x}" for c in chars if ord(c) < 256) + "]"


def _dropped(kept: str) -> tuple[str, str]:
    """Two patterns that together match what isn't in ``kept``: Latin-1 characters, then others,
    which alone pass the look-ahead and meet the ranges."""
    latin = latin_class("".join(chr(i) for i in range(256) if chr(i) not in kept))
    return latin, r"(?=[^\x00-\xff])[^" + class_ranges("".join(c for c in kept if ord(c) > 255)) + "]"


# The same characters as KEEP_ASCII_PATTERN, KEEP_ASCII_LOWER_PATTERN and WS match.
DROP_ASCII = _dropped(string.ascii_letters + string.digits + WS_CHARS + ".,!?;:'\"-")
DROP_ASCII_LOWER = _dropped(string.ascii_lowercase + string.digits + WS_CHARS + ".,!?'")
WS_WIDE = r"(?=[^\x00-\xff])[" + class_ranges("".join(c for c in WS_CHARS if ord(c) > 255)) + "]"
WS_LATIN = latin_class(WS_CHARS)
# Meta words whose parenthesised span is dropped from generated text.
META_PAREN_WORDS = ("sorry", "thanks", "credit", "original", "repost", "post", "reddit",
                    "edit", "note", "aww", "first", "hope", "luck", "know", "sure",
                    "guess", "think")
EMOTICON_PATTERN = r":\)|:\(|:D|;\)|:P|:-\)|:-\(|:-D|<3|:'|;\("
EMOJI_CHARS = "😊😂🤣😄😁🙂😉😅😆🤔😎👍🎉💀😭🙄😏😤😢😩😫🤷💩👎🔥❤️"
END_PUNCT = ".!?"


def _strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(c, "^" + WS + "+|" + WS + "+$", "")


# --- P1: join title and body under three null policies ----------------------
def join_title_body(title: Column, body: Column, null: str = "empty") -> Column:
    """``title + ' ' + body``.

    null='empty' : null -> ''   (CSV path of the LM loader)
    null='nan'   : null -> 'nan' (n-gram loaders, pandas astype(str))
    null='json'  : SQL null -> '' (key missing); use :func:`json_field_text` for
                   the JSON-null -> 'None' distinction, which needs the variant.
    """
    fill = {"empty": "", "nan": "nan", "json": ""}[null]
    return F.concat(F.coalesce(title, F.lit(fill)), F.lit(" "), F.coalesce(body, F.lit(fill)))


# --- P2..P8 ---------------------------------------------------------------
def strip_hex_entities(c: Column, mode: str = "reference") -> Column:
    return F.regexp_replace(c, HEX_ENTITY_PATTERN[mode], "")


def strip_named_entities(c: Column) -> Column:
    return F.regexp_replace(c, NAMED_ENTITY_PATTERN, "")


def strip_entities_lm(c: Column) -> Column:
    return F.regexp_replace(c, LM_ENTITY_PATTERN, "")


def keep_ascii_text(c: Column) -> Column:
    latin, others = DROP_ASCII
    return F.regexp_replace(F.regexp_replace(c, latin + "+", ""), others, "")


def blank_non_ascii_text(c: Column) -> Column:
    latin, others = DROP_ASCII_LOWER
    return F.regexp_replace(F.regexp_replace(c, latin, " "), others, " ")


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL_PATTERN, "")


def collapse_ws(c: Column) -> Column:
    """Whitespace run -> one space, then strip (collapse first: ``trim`` only strips U+0020)."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, WS_WIDE, " "), WS_LATIN + "+", " "))


def lowercase(c: Column) -> Column:
    return F.lower(c)


def delete_tabs_newlines(c: Column) -> Column:
    """Tab/CR/LF are deleted (words fuse), then Unicode strip."""
    return _strip_ws(F.translate(c, "\t\r\n", ""))


# --- P9: cleaning profiles; order is fixed by the profile --------------------
def clean(c: Column, profile: str = "lm", hex_mode: str = "reference") -> Column:
    if profile == "lm":
        out = collapse_ws(strip_entities_lm(c))
        return F.when(out != "", out)          # empty -> null
    if profile == "rnn":
        out = strip_hex_entities(c, hex_mode)
        out = strip_named_entities(out)
        out = keep_ascii_text(out)
        return lowercase(collapse_ws(out))
    if profile == "tsv":
        return lowercase(delete_tabs_newlines(c))
    if profile == "toy":
        out = strip_urls(lowercase(c))
        return collapse_ws(blank_non_ascii_text(out))
    raise ValueError(f"unknown cleaning profile {profile!r}")


# --- P10: cleaning of generated text ------------------------------------------
def drop_meta_parens(c: Column) -> Column:
    words = "|".join(META_PAREN_WORDS)
    return F.regexp_replace(c, r"(?iu)\([^)]*(?:" + words + r")[^)]*\)", "")


def drop_brackets(c: Column) -> Column:
    return F.regexp_replace(c, r"\[[^\]]*\]", "")


def drop_mentions(c: Column, mode: str = "reference") -> Column:
    """Four passes in the reference's order.  'reference' is unanchored, so
    ``her/his`` loses ``r/his``; 'safe' requires a non-word character (or the
    start) before the mention."""
    lead = "" if mode == "reference" else r"(?<![\p{L}\p{N}_/])"
    out = c
    for prefix in ("/u/", "u/", "/r/", "r/"):
        out = F.regexp_replace(out, lead + prefix + WORD + "+", "")
    return out


def drop_emoticons_emoji(c: Column) -> Column:
    out = F.regexp_replace(c, "(?iu)" + EMOTICON_PATTERN, "")
    return F.regexp_replace(out, "[" + EMOJI_CHARS + "]", "")


def drop_starred(c: Column) -> Column:
    return F.regexp_replace(c, r"\*[^*]+\*", "")


def drop_superscript(c: Column) -> Column:
    out = F.regexp_replace(c, r"\^\^\^[^\n]*", "")
    out = F.regexp_replace(out, r"\^\([^\n]*?\)", "")
    return F.regexp_replace(out, r"\^" + NON_WS + "+", "")


def tidy_punct(c: Column) -> Column:
    out = F.regexp_replace(c, WS + "+([.,!?])", "$1")
    out = F.regexp_replace(out, r"\.{4,}", "...")
    out = F.regexp_replace(out, "!{2,}", "!")
    return F.regexp_replace(out, r"\?{2,}", "?")


def clean_generated(c: Column, mention_mode: str = "reference") -> Column:
    out = drop_meta_parens(c)
    out = drop_brackets(out)
    out = drop_mentions(out, mention_mode)
    out = drop_emoticons_emoji(out)
    out = drop_starred(out)
    out = drop_superscript(out)
    out = collapse_ws(out)
    out = tidy_punct(out)
    return _strip_ws(out)


def strip_prompt(text: Column, prompt: Column) -> Column:
    """When the prompt occurs, remove every occurrence and strip."""
    return F.when(F.instr(text, prompt) > 0,
                  _strip_ws(F.replace(text, prompt, F.lit("")))).otherwise(text)


# --- F1..F5, F8..F11 ---------------------------------------------------------
def has_text(*cols: Column) -> Column:
    """none of the texts is null (apply before a null is joined as text)."""
    out = cols[0].isNotNull()
    for c in cols[1:]:
        out = out & c.isNotNull()
    return out


def is_redacted(c: Column) -> Column:
    return c.contains(REDACTION_MARKERS[0]) | c.contains(REDACTION_MARKERS[1])


def length_between(c: Column, lo: int = 20, hi: int = 400) -> Column:
    return F.char_length(c).between(lo, hi)


def ends_with_punctuation(c: Column) -> Column:
    s = _strip_ws(c)
    return (F.char_length(s) > 0) & F.substring(s, -1, 1).isin(*END_PUNCT)


def balanced_parens(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\(")) == F.regexp_count(c, F.lit(r"\)"))


def even_quotes(c: Column) -> Column:
    return F.regexp_count(c, F.lit('"')) % 2 == 0


def min_length(c: Column, n: int = 20) -> Column:
    return F.char_length(c) >= n

"""Literal-row tests for the cleaning rules and their traps."""
from pyspark.sql import functions as F

from quipu.functions import text as T
from quipu.functions import verdict as V


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "s string").select(expr(F.col("s")).alias("o")).first()["o"]


def test_hex_entity_reference_mode_damages_words(spark):
    assert one(spark, lambda c: T.strip_hex_entities(c, "reference"), "xbox") == "ox"
    assert one(spark, lambda c: T.strip_hex_entities(c, "reference"), "exact") == "et"
    assert one(spark, lambda c: T.strip_hex_entities(c, "safe"), "xbox &#x200B;a") == "xbox a"


def test_lm_entities_single_pass(spark):
    assert one(spark, T.strip_entities_lm, "a &amp;lt; b") == "a lt; b"
    assert one(spark, T.strip_entities_lm, "it&#39;s") == "it&#39;s"
    assert one(spark, T.strip_entities_lm, "x#x200B;y&#x200B;z") == "xyz"


def test_unicode_whitespace_collapse_matches_python(spark):
    s = "a   b\x1c\tc  　"
    assert one(spark, T.collapse_ws, s) == " ".join(s.split())


def test_clean_lm_empty_is_null(spark):
    assert one(spark, lambda c: T.clean(c, "lm"), " &amp; ") is None


def test_clean_rnn_and_tsv_profiles(spark):
    assert one(spark, lambda c: T.clean(c, "rnn"), "Hello,  Wörld! &amp; (ok)") == "hello, wrld! ok"
    assert one(spark, lambda c: T.clean(c, "tsv"), "A\tB\r\nC ") == "abc"
    assert one(spark, lambda c: T.clean(c, "toy"), "Go http://x.y/z NOW é!") == "go now !"


def test_mentions_reference_vs_safe(spark):
    assert one(spark, lambda c: T.drop_mentions(c, "reference"), "her/his /u/bob x") == "he  x"
    assert one(spark, lambda c: T.drop_mentions(c, "safe"), "her/his /u/bob x") == "her/his  x"


def test_superscript_dot_stops_only_at_newline(spark):
    # Java's '.' would stop at \r; the rule must behave like Python's.
    assert one(spark, T.drop_superscript, "a ^^^b\rc\nd") == "a \nd"


def test_clean_generated_full(spark):
    s = "Why (edit: thanks) [oc] *x* ^^^sup\nok  ... !!  /u/bob_1 :) 😂"
    out = one(spark, T.clean_generated, s)
    assert out == "Why ok...!"


def test_char_length_code_points(spark):
    assert one(spark, F.char_length, "a😀b") == 3
    assert one(spark, lambda c: T.length_between(c, 3, 3), "a😀b") is True


def test_join_title_body_null_policies(spark):
    df = spark.createDataFrame([(None, "b"), ("a", None)], "t string, b string")
    e = [r[0] for r in df.select(T.join_title_body(F.col("t"), F.col("b"), "empty")).collect()]
    n = [r[0] for r in df.select(T.join_title_body(F.col("t"), F.col("b"), "nan")).collect()]
    assert e == [" b", "a "] and n == ["nan b", "a nan"]


def test_strip_prompt_removes_every_occurrence(spark):
    df = spark.createDataFrame([("Why did the Why did the chicken ", "Why did the")], "t string, p string")
    assert df.select(T.strip_prompt(F.col("t"), F.col("p"))).first()[0] == "chicken"


def test_verdict_rule_order(spark):
    rows = [("short.",), ("a perfectly fine sentence here lol.",), ("a sentence about spam and eggs!",),
            ("a sentence without an ending mark",), ("an (unclosed parenthesis here.",),
            ('an "unclosed quote in this one.',), ("a complete and tidy sentence.",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r["v"]["reason"] for r in df.select(V.quality_verdict(F.col("s"), ["spam"]).alias("v")).collect()]
    assert got == ["too short", "reddit garbage", "explicit", "no ending punctuation",
                   "unclosed parens", "unclosed quotes", "good"]


def test_ends_with_punctuation_strips_unicode_space(spark):
    assert one(spark, T.ends_with_punctuation, "done!  ") is True
    assert one(spark, T.ends_with_punctuation, "   ") is False


def test_cleaning_drops_the_same_characters_by_look_up_classes(spark):
    """Java tests a negated class of ranges at about a microsecond a character: what is
    dropped is written as Latin-1 singles and a guarded rest, which match the same."""
    import re
    for latin, others in (T.DROP_ASCII, T.DROP_ASCII_LOWER):
        assert re.fullmatch(r"\[(\\x[0-9a-f]{2})+\]", latin) and others.startswith(r"(?=[^\x00-\xff])")
    codes = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    s = "".join(f"a{chr(c)}" for c in codes)
    df = spark.createDataFrame([(s,)], "s string")
    ws = F.trim(F.regexp_replace("s", T.WS + "+", " "))
    row = df.select(T.keep_ascii_text(F.col("s")) == F.regexp_replace("s", T.KEEP_ASCII_PATTERN, ""),
                    T.blank_non_ascii_text(F.col("s")) == F.regexp_replace("s", T.KEEP_ASCII_LOWER_PATTERN, " "),
                    T.collapse_ws(F.col("s")) == ws).first()
    assert all(row)

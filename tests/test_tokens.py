"""Token-array functions, including the sequence/slice traps."""
from pyspark.sql import functions as F

from quipu.functions import tokens as TK


def arr(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"s {typ}").select(expr(F.col("s")).alias("o")).first()["o"]


def test_tokenize_words_contractions(spark):
    assert arr(spark, TK.tokenize_words, "i don't know, it's fine... x-ray") == [
        "i", "do", "n't", "know", ",", "it", "'s", "fine", ".", ".", ".", "x-ray"]


def test_pad_boundaries(spark):
    assert arr(spark, lambda c: TK.pad_boundaries(c, 1), ["a"], "array<string>") == ["<s>", "a", "</s>"]
    assert arr(spark, lambda c: TK.pad_boundaries(c, 3), ["a"], "array<string>") == ["<s>", "<s>", "a", "</s>", "</s>"]


def test_tokenize_chars_and_simple(spark):
    assert arr(spark, lambda c: TK.tokenize_chars(c, "_"), "a b😀") == ["a", "_", "b", "😀"]
    assert arr(spark, TK.tokenize_chars, "") == []
    assert arr(spark, TK.tokenize_simple, "Hello, World! it's--ok") == ["hello", "world", "it's", "ok"]


def test_windows_none_when_short(spark):
    assert arr(spark, lambda c: TK.ngram_windows(c, 5), [1, 2, 3], "array<int>") == []
    assert arr(spark, lambda c: TK.ngram_windows(c, 2), [1, 2, 3], "array<int>") == [[1, 2], [2, 3]]


def test_fix_context(spark):
    assert arr(spark, lambda c: TK.fix_context(c, 4, 1), [7], "array<int>") == [1, 1, 1, 7]
    assert arr(spark, lambda c: TK.fix_context(c, 2, 0), [5, 6, 7], "array<int>") == [6, 7]
    assert arr(spark, lambda c: TK.fix_context(c, 2, 0), [], "array<int>") == [0, 0]


def test_encode_fixed_truncates_end_id(spark):
    out = arr(spark, lambda c: TK.encode_fixed(c, 99, 3), [1, 2, 3, 4], "array<int>")
    assert out["input_ids"] == [1, 2, 3] and out["attention_mask"] == [1, 1, 1]

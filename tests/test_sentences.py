"""The sentence model on a corpus whose boundaries are known."""
import random

import pytest

from quipu.operators import sentences as SE

NAMES = ["Smith", "Jones", "Weber", "Rossi", "Novak"]
PLACES = ["harbour", "market", "station", "garden", "library", "castle", "theatre"]
STARTS = ["The", "Then", "Later", "They"]


def _sentence(rng):
    return rng.choice([
        f"{rng.choice(STARTS)} visitors met Mr. {rng.choice(NAMES)} near the {rng.choice(PLACES)}.",
        f"{rng.choice(STARTS)} people saw fruit, etc. in the {rng.choice(PLACES)}!",
        f"{rng.choice(STARTS)} walk to the {rng.choice(PLACES)} took {rng.randrange(2, 60)} minutes on foot or by tram {rng.randrange(2, 9)}.",
        f'{rng.choice(STARTS)} guide said "go to the {rng.choice(PLACES)}."',
    ])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    docs = [(i, [_sentence(rng) for _ in range(rng.randrange(1, 12))]) for i in range(300)]
    rows = [(i, rng.choice(["  ", "\n", " "]).join(s)) for i, s in docs] + [(900, None), (901, ""), (902, " \n "), (903, "...")]
    return dict(docs), spark.createDataFrame(rows, "doc_key long, text string").repartition(3)


def test_learns_abbreviations_and_starters(corpus):
    model = SE.learn(corpus[1])
    assert {r["type"] for r in model.types.filter("is_abbreviation").collect()} == {"mr", "etc"}
    assert {r["type"] for r in model.starters.filter("is_starter").collect()} == {s.lower() for s in STARTS}


def test_splits_where_sentences_end(corpus, monkeypatch):
    model = SE.learn(corpus[1])
    for limit in (SE.BROADCAST_PAIRS, 0):
        monkeypatch.setattr(SE, "BROADCAST_PAIRS", limit)
        got = {r["doc_key"]: r["sentences"] for r in SE.split_sentences(corpus[1], model).collect()}
        assert got == corpus[0] | {900: [], 901: [], 902: [], 903: ["..."]}


def test_tokens_tell_the_periods_apart(spark, corpus):
    model = SE.learn(corpus[1])
    rows = spark.createDataFrame([(1, "They met Mr. Weber near the station. Then it didn't rain, etc. in the garden."), (2, None)], "doc_key long, text string")
    got = {r["doc_key"]: r["tokens"] for r in SE.tokenize_sentences(rows, model).collect()}
    assert got[1] == ["they", "met", "mr.", "weber", "near", "the", "station", ".", "then", "it", "did", "n't", "rain", ",", "etc.", "in", "the", "garden", "."]
    assert got[2] == []


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_key long, text string")
    model = SE.learn(docs)
    assert SE.split_sentences(docs, model).collect() == [] and model.types.count() == 0


def test_pairs_are_written_once(corpus, monkeypatch):
    """The table of pairs, the large one, is neither written again nor shuffled by type to be marked."""
    written = []
    pin = SE.C.pin_table
    monkeypatch.setattr(SE.C, "pin_table", lambda df, name: written.append((name, df.columns)) or pin(df, name))
    SE.learn(corpus[1])
    assert [name for name, columns in written if "strong" in columns] == ["pair-counts"]


def test_words_are_told_apart_without_patterns(spark):
    """Bare words, types and capitals as the patterns give them."""
    from pyspark.sql import functions as F
    words = ["\"'Hi.\"", "(12,5)", "+3.", "-x", "12a", "Éa.", "éa", "'“«”", "", "!?", "a.b.", ".", "“Ünder”", "9:", "ǅ", "7."]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    bare = F.regexp_replace("w", SE.AROUND, "")
    low = F.lower(F.regexp_replace(bare, r"\.$", ""))
    old = rows.select("w", bare, F.when(F.regexp_like(low, F.lit(SE.NUMBER)), F.lit(SE.NUMBER_TYPE)).otherwise(low), F.regexp_like("w", F.lit(r"^\p{Lu}")),
                      F.regexp_like("w", F.lit(r"^\p{Ll}")))
    new = rows.select("w", SE.core(F.col("w")), SE.type_of(SE.core(F.col("w"))), SE._capital(F.col("w")), SE._starts(F.col("w"), "a", "z", r"^\p{Ll}"))
    assert list(map(tuple, new.collect())) == list(map(tuple, old.collect()))

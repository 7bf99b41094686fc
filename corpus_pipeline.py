"""A corpus pipeline over ``documents``: four stages, each written as Parquet and read again
as the documents of the next.

1. language_id: a document without a letter goes, as no language can be found in it.  Where
   nothing could be learned (no labelled document) every one with a letter stays.
2. ngram_join: of each group of near-duplicate documents one stays, the smallest id.
3. span_dedup: windows of 50 words that an earlier document holds are cut out.
4. packing: the texts left are packed into sequences of 1024 tokens.

Stages 1 to 3 return the columns of documents; every row they keep is whole, but for the
words that stage 3 removes (n_chars then follows the new text).  Stage 4 returns a row for
each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import lang_id, ngram_join, packing, span_dedup
from quipu.llm.queries import tokenizer_path
from quipu.operators.corpus import pin_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = lang_id.learn(docs, lang_id.vocabulary_of(tokenizer_path("piece_bpe_32k.model")))
    if not model.languages:
        return docs.filter(F.regexp_like("text", F.lit(r"\p{L}")))
    found = lang_id.predict(docs, model, keep=tuple(docs.columns))
    return found.filter(F.col("lang_pred") != lang_id.UND).select("kept.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = span_dedup.remove_repeats(docs, keep=tuple(c for c in docs.columns if c != "text"))
    text = F.col("kept").cast("string")
    made = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.char_length(text).cast("long")).otherwise(F.col("extra.n_chars"))}
    return cut.select(*[made.get(c, F.col(f"extra.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("ngram_join", near_duplicates), ("span_dedup", repeated_spans), ("packing", pack)]

# Language models, connected components over hashed sets and best-fit packing aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Sinks (K1-K4): word vectors, numbered lists, vocabulary, training shards.

All writes are distributed (one file per partition); ordered outputs are
range-partitioned and sorted so part files concatenate in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_word_vectors(vectors: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite") -> None:
    """K1: (word, vector array<float>) -> text ``V D`` header + ``word v1 .. vD``
    lines (header first in part 0), or parquet."""
    if fmt == "parquet":
        vectors.write.mode(mode).parquet(path)
        return
    stats = vectors.agg(F.count(F.lit(1)).alias("v"), F.max(F.size("vector")).alias("d")).first()
    header = vectors.sparkSession.createDataFrame(
        [(0, "", f"{stats['v']} {stats['d'] or 0}")], "_o int, word string, line string")
    body = vectors.select(F.lit(1).alias("_o"), "word",
                          F.concat_ws(" ", F.col("word"),
                                      F.array_join(F.transform("vector", lambda x: x.cast("string")), " "))
                          .alias("line"))
    (header.unionByName(body).repartitionByRange("_o", "word").sortWithinPartitions("_o", "word")
           .select("line").write.mode(mode).text(path))


def write_numbered_list(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: rows (i, line) from :func:`quipu.operators.qa.numbered_lines` written in i order."""
    lines.repartitionByRange("i").sortWithinPartitions("i").select("line").write.mode(mode).text(path)


def write_vocab(vocab: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: persist the vocabulary (token, token_id, n)."""
    vocab.select("token", "token_id", "n").write.mode(mode).parquet(path)


def write_training_shards(batched: DataFrame, path: str, mode: str = "overwrite",
                          shards: int | None = None, placed: bool = False) -> None:
    """K4: samples with ``batch_id`` written once, range-partitioned by batch so
    every batch sits in one file region and shards are in batch order.  ``placed``: the
    partitions are the shards already, in order (``assign_batches`` with ``shards``)."""
    if placed:
        batched.write.mode(mode).parquet(path)
        return
    df = batched.repartitionByRange(shards, "batch_id") if shards else batched.repartitionByRange("batch_id")
    df.sortWithinPartitions("batch_id", "sample_idx").write.mode(mode).parquet(path)

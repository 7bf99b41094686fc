"""Incremental curation of arriving post files (Structured Streaming).

The reference curates a fixed set of files in one pass; this is the same job
for files that keep arriving.  Each micro-batch:

1. reads the new JSON-lines files as text and parses them with the batch
   reader's rules (:func:`quipu.sources.readers.read_posts_jsonl` logic);
2. orders rows by arrival: ``doc_key = batch_id * 2**40 + position`` where the
   position follows file path, split start and line order, so "first copy
   wins" means first to arrive;
3. applies the curation filters and the 'lm' cleaning (same Column
   expressions as the batch job) and dedups inside the batch (smallest key);
4. drops texts already kept by earlier batches with an exact anti-join on
   (hash, text) against the kept table, then appends.

The query checkpoint (``checkpointLocation``) records which files were
processed, so a restarted or retried job neither loses nor repeats a batch's
rows; the sink is append-only parquet written from ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.operators import corpus as C
from quipu.plans import curate as Q
from quipu.sources import readers as RD

KEY_SHIFT = C.RANK_SHIFT
KEPT_SCHEMA = "doc_key long, corpus string, text string, h long"


def _parse_batch(lines: DataFrame) -> DataFrame:
    """Micro-batch of raw lines (value, _file, _blk, _row) -> (pos, score, raw_text)."""
    return RD.parse_json_posts(RD._with_position(lines))


def curate_batch(lines: DataFrame, batch_id: int, kept_path: str, corpus_name: str = "json") -> DataFrame:
    """One micro-batch -> new (doc_key, corpus, text) rows not kept before."""
    spark = lines.sparkSession
    raw = _parse_batch(lines).select(
        (F.lit(batch_id).cast("long") * F.lit(1 << KEY_SHIFT) + F.col("pos")).alias("doc_key"),
        "score", "raw_text")
    fresh = Q.curate_raw(raw, [corpus_name]).withColumn("corpus", F.lit(corpus_name))
    fresh = fresh.withColumn("h", F.xxhash64("text"))
    if RD._missing_ok(spark, kept_path):   # else the first batch: nothing kept yet
        seen = spark.read.schema(KEPT_SCHEMA).parquet(kept_path).select("h", "text")
        fresh = fresh.join(seen, ["h", "text"], "left_anti")
    return fresh.select("doc_key", "corpus", "text", "h")


def start_curation_stream(spark: SparkSession, input_dir: str, kept_path: str, checkpoint_location: str,
                          available_now: bool = True, corpus_name: str = "json"):
    """Start the streaming curation; returns the StreamingQuery."""
    lines = (spark.readStream.format("text").load(input_dir)
             .select("value", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_blk")))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("_row", F.monotonically_increasing_id())
        new = curate_batch(batch, batch_id, kept_path, corpus_name)
        new.write.mode("append").parquet(kept_path)

    writer = lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()

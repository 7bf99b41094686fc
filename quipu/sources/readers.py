"""Readers for the post corpora and word vectors.

Every reader returns ``(pos, score, raw_text, ...)`` where ``pos`` is the
row's order within its source, so "first n rows", dedup order and the
positional split are well defined on any number of partitions.  ``pos`` comes
from the file order: files sorted by name, then byte offset of the line, made
dense with the distributed global index (keys only, no text moves).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.functions import text as TX
from quipu.operators import corpus as C

# Strings the reference's CSV loader (pandas defaults) reads as missing.
NA_STRINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
              "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

POST_CSV_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("selftext", T.StringType()),
    T.StructField("score", T.StringType()),
])


def _na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_STRINGS), c)


def _missing_ok(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(hpath)) and len(fs.globStatus(hpath)) > 0


def _line_order(df: DataFrame) -> DataFrame:
    """File order key: (file path, split start, id within the split)."""
    return (df.withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_blk", F.col("_metadata.file_block_start"))
              .withColumn("_row", F.monotonically_increasing_id()))


ORDER = ["_file", "_blk", "_row"]


SPLIT_BROADCAST_MAX = 5_000_000   # file splits; one offset row per split


def _with_position(df: DataFrame, order_cols: list[str] = ORDER) -> DataFrame:
    """Dense 0-based position in (file, split start, row) order.

    Rows are not moved: each file split contributes one (min row id, count)
    row, the splits' counts are prefix-summed in order, and the offsets come
    back through a broadcast join bounded by the number of splits.
    """
    f, b, r = order_cols
    splits = df.groupBy(f, b).agg(F.min(r).alias("_r0"), F.count(F.lit(1)).alias("_n"))
    offs = C.ordered_offsets(splits, [f, b], "_n", "_off")
    offs = offs.join(splits.select(f, b, "_r0"), [f, b])
    n_splits = offs.count()
    side = F.broadcast(offs) if n_splits <= SPLIT_BROADCAST_MAX else offs
    return (df.join(side, [f, b])
              .withColumn("pos", F.col("_off") + F.col(r) - F.col("_r0"))
              .drop(f, b, r, "_off", "_r0"))


def _first(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.filter(F.col("pos") < F.lit(limit))


def _numeric_score(c: Column) -> Column:
    """Python ``float`` of a CSV field: numbers parse, NA strings are null."""
    return F.trim(_na_to_null(c)).try_cast("double")


# --- S1 ---------------------------------------------------------------------
def read_posts_csv(spark: SparkSession, path: str, extra_cols: T.StructType | None = None,
                   header_schema: T.StructType = POST_CSV_SCHEMA, limit: int | None = None) -> DataFrame:
    """Header CSV with quoted multi-line bodies -> (pos, score double, title, selftext).

    NA-like strings become null like the reference's loader.  Columns are
    matched by header name (``enforceSchema=false``), so extra columns in the
    file are allowed when listed in the schema.  A missing path raises.
    ``limit``: only the first rows, in file order.
    """
    schema = header_schema if extra_cols is None else T.StructType(header_schema.fields + extra_cols.fields)
    df = (spark.read.schema(schema)
          .options(header=True, multiLine=True, quote='"', escape='"', enforceSchema=False,
                   mode="PERMISSIVE")
          .csv(path))
    df = _line_order(df)
    out = df.select(*ORDER, _numeric_score(F.col("score")).alias("score"),
                    _na_to_null(F.col("title")).alias("title"), _na_to_null(F.col("selftext")).alias("selftext"))
    return _first(_with_position(out), limit)


def posts_csv_raw(df: DataFrame) -> DataFrame:
    """CSV rows -> (pos, score, raw_text) with the null -> '' join."""
    return df.select("pos", "score", TX.join_title_body(F.col("title"), F.col("selftext"), "empty")
                     .alias("raw_text"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, value): the lines of text files in file and line order."""
    return _with_position(_line_order(spark.read.text(path)))


# --- S2 ---------------------------------------------------------------------
def read_scored_tsv(spark: SparkSession, path: str, strict: bool = False,
                    missing_ok: bool = True, limit: int | None = None) -> DataFrame:
    """``score \\t text`` lines -> (pos, score, raw_text).

    tolerant (default): split once on the first tab; keep the line only when
    there are two parts and the score parses as an integer (else skip).
    strict: every line must have a tab (else the job fails), the score is kept
    as text, the text gets the 'tsv' cleaning (tabs/newlines deleted, lowercase).
    ``limit``: only the first lines, counted before any is skipped.
    """
    if missing_ok and not _missing_ok(spark, path):
        return spark.createDataFrame([], "pos long, score double, raw_text string")
    lines = _first(_with_position(_line_order(spark.read.text(path))), limit)
    parts = F.split(F.col("value"), "\t", 2)
    if strict:
        checked = F.when(F.size(parts) == 2, parts).otherwise(
            F.raise_error(F.lit("scored TSV line without a tab")).cast("array<string>"))
        return lines.select("pos", checked.alias("_p")).select(
            "pos", F.col("_p")[0].alias("score"), TX.clean(F.col("_p")[1], "tsv").alias("raw_text"))
    return (lines.select("pos", parts.alias("_p"))
            .filter((F.size("_p") == 2) & F.trim(F.col("_p")[0]).try_cast("int").isNotNull())
            .select("pos", F.trim(F.col("_p")[0]).try_cast("int").cast("double").alias("score"),
                    F.col("_p")[1].alias("raw_text")))


# --- S3 ---------------------------------------------------------------------
def _json_text(v: Column, key: str) -> Column:
    """Field as the reference formats it: missing -> '', JSON null -> 'None',
    string -> itself, other scalars -> their JSON text."""
    f = F.try_variant_get(v, f"$.{key}", "variant")
    return (F.when(f.isNull(), F.lit(""))
             .when(F.is_variant_null(f), F.lit("None"))
             .when(F.schema_of_variant(f) == "STRING", F.variant_get(f, "$", "string"))
             .otherwise(F.to_json(f)))


def read_posts_jsonl(spark: SparkSession, path: str, missing_ok: bool = True) -> DataFrame:
    """One JSON object per line -> (pos, score, raw_text).

    Lines that are not JSON objects, and lines whose ``score`` is present but
    not a number (string, null, ...), are dropped silently; a missing score is
    0.  raw_text = ``f"{title} {selftext}"`` under the reference's formatting.
    """
    if missing_ok and not _missing_ok(spark, path):
        return spark.createDataFrame([], "pos long, score double, raw_text string")
    lines = _with_position(_line_order(spark.read.text(path)))
    return parse_json_posts(lines)


def parse_json_posts(lines: DataFrame) -> DataFrame:
    """(pos, value) JSON lines -> (pos, score, raw_text) under the reference's rules."""
    v = F.try_parse_json(F.col("value"))
    parsed = lines.select("pos", v.alias("v"))
    is_obj = F.schema_of_variant(F.col("v")).startswith("OBJECT")
    s = F.try_variant_get(F.col("v"), "$.score", "variant")
    s_type = F.schema_of_variant(s)
    numeric = s_type.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | s_type.startswith("DECIMAL")
    score = F.when(s.isNull(), F.lit(0.0)).when(numeric, F.variant_get(s, "$", "double"))
    return (parsed.filter(F.col("v").isNotNull() & is_obj)
            .select("pos", score.alias("score"),
                    F.concat(_json_text(F.col("v"), "title"), F.lit(" "),
                             _json_text(F.col("v"), "selftext")).alias("raw_text"))
            .filter(F.col("score").isNotNull()))


# --- S5 ---------------------------------------------------------------------
def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Text vectors: header ``V D`` then ``word v1 .. vD`` -> (word, vector array<float>).

    The header is recognised as a line of exactly two integer fields and dropped.
    """
    lines = spark.read.text(path).select(F.split(F.trim(F.col("value")), " ").alias("f"))
    is_header = (F.size("f") == 2) & F.col("f")[0].rlike("^[0-9]+$") & F.col("f")[1].rlike("^[0-9]+$")
    body = lines.filter(~is_header & (F.size("f") >= 2))
    return body.select(F.col("f")[0].alias("word"),
                       F.transform(F.slice(F.col("f"), 2, F.size("f") - 1), lambda x: x.cast("float"))
                       .alias("vector"))


# --- S6 ---------------------------------------------------------------------
def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("token", F.col("token_id").cast("int"), F.col("n").cast("long"))

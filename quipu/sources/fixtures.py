"""Stand-in inputs built from the driver's tables.

The driver's ``documents`` table holds whole prose texts with exact and near
copies but none of the markers the curation rules look for, and the
``conversations`` table holds short turns.  ``posts`` reshapes *whole* texts
from both into the post schema the curation job expects
``(post_id bigint, corpus string, title string, selftext string, score bigint)``:

* title    = the text up to its first newline, selftext = everything after it
  (null when there is no newline), so ``title + ' ' + selftext`` is the whole
  text with its first newline turned into a space;
* some bodies are replaced by redaction markers or null, others get a suffix
  carrying entities, meta parentheses, URLs, mentions, brackets, stars, carets,
  quotes and runs of punctuation, so every cleaning rule has something to do;
* score and corpus are arithmetic labels of the id.

Nothing here does curation work; the job must be right on any data of this
schema.  ``POSTS_SQL`` is the same view for the SQL oracle (DuckDB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONV_ID_BASE = 100_000_000_000   # keeps conversation ids apart from doc ids

SUFFIXES = (
    " &amp; &#x200B;more  text!!!",
    " (edit: thanks) http://ex.example/a1 /u/bob_1",
    " [oc] *bold* ^^^sup",
    ' said "so.... ?? xbox',
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _body(post_id: Column, rest: Column) -> Column:
    m5 = post_id % 5
    return (F.when(post_id % 17 == 0, F.lit("[removed]"))
            .when(post_id % 19 == 0, F.lit("[deleted]"))
            .when(post_id % 23 == 0, F.lit(None).cast("string"))
            .when(m5 == 0, F.concat(rest, F.lit(SUFFIXES[0])))
            .when(m5 == 1, F.concat(rest, F.lit(SUFFIXES[1])))
            .when(m5 == 2, F.concat(rest, F.lit(SUFFIXES[2])))
            .when(m5 == 3, F.concat(rest, F.lit(SUFFIXES[3])))
            .otherwise(rest))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"), "text")
    conv = load(spark, sf_dir, "conversations").select(
        (F.lit(CONV_ID_BASE) + F.col("conv_id") * 1000 + F.col("turn")).alias("post_id"), "text")
    src = docs.unionByName(conv)
    nl = F.instr(F.col("text"), "\n")
    title = F.when(nl > 0, F.expr("substring(text, 1, instr(text, '\\n') - 1)")).otherwise(F.col("text"))
    rest = F.when(nl > 0, F.expr("substring(text, instr(text, '\\n') + 1)"))
    pid = F.col("post_id")
    corpus = (F.when(pid % 4 == 0, "csv").when(pid % 4 == 1, "train")
              .when(pid % 4 == 2, "dev").otherwise("json"))
    return src.select(pid, corpus.alias("corpus"), title.alias("title"),
                      _body(pid, rest).alias("selftext"), ((pid * 7) % 40).alias("score"))


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


POSTS_SQL = f"""
posts_src AS (
  SELECT doc_id AS post_id, text FROM documents
  UNION ALL
  SELECT {CONV_ID_BASE} + conv_id * 1000 + turn AS post_id, text FROM conversations),
posts_split AS (
  SELECT post_id, text, strpos(text, chr(10)) AS nl FROM posts_src),
posts AS (
  SELECT post_id,
    CASE WHEN post_id % 4 = 0 THEN 'csv' WHEN post_id % 4 = 1 THEN 'train'
         WHEN post_id % 4 = 2 THEN 'dev' ELSE 'json' END AS corpus,
    CASE WHEN nl > 0 THEN substr(text, 1, nl - 1) ELSE text END AS title,
    CASE WHEN post_id % 17 = 0 THEN '[removed]'
         WHEN post_id % 19 = 0 THEN '[deleted]'
         WHEN post_id % 23 = 0 THEN NULL
         WHEN post_id % 5 = 0 THEN (CASE WHEN nl > 0 THEN substr(text, nl + 1) END) || {_sql_lit(SUFFIXES[0])}
         WHEN post_id % 5 = 1 THEN (CASE WHEN nl > 0 THEN substr(text, nl + 1) END) || {_sql_lit(SUFFIXES[1])}
         WHEN post_id % 5 = 2 THEN (CASE WHEN nl > 0 THEN substr(text, nl + 1) END) || {_sql_lit(SUFFIXES[2])}
         WHEN post_id % 5 = 3 THEN (CASE WHEN nl > 0 THEN substr(text, nl + 1) END) || {_sql_lit(SUFFIXES[3])}
         ELSE CASE WHEN nl > 0 THEN substr(text, nl + 1) END END AS selftext,
    (post_id * 7) % 40 AS score
  FROM posts_split)"""


# ---------------------------------------------------------------------------
# Candidate generations: one slot per conversation, one attempt per turn.
# The turn text gets one of the post suffixes so the generated-text cleaner
# and the verdict rules have meta text, brackets, stars and carets to handle.
# ---------------------------------------------------------------------------
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = load(spark, sf_dir, "conversations")
    k = (F.col("conv_id") * 1000 + F.col("turn")) % 5
    suffix = (F.when(k == 0, F.lit(SUFFIXES[0])).when(k == 1, F.lit(SUFFIXES[1]))
              .when(k == 2, F.lit(SUFFIXES[2])).when(k == 3, F.lit(SUFFIXES[3])).otherwise(F.lit("")))
    return conv.select(F.col("conv_id").alias("slot"), F.col("turn").cast("int").alias("attempt"),
                       F.concat(F.col("text"), suffix).alias("text"))


CANDIDATES_SQL = f"""
candidates AS (
  SELECT conv_id AS slot, CAST(turn AS INTEGER) AS attempt,
    text || CASE (conv_id * 1000 + turn) % 5 WHEN 0 THEN {_sql_lit(SUFFIXES[0])}
              WHEN 1 THEN {_sql_lit(SUFFIXES[1])} WHEN 2 THEN {_sql_lit(SUFFIXES[2])}
              WHEN 3 THEN {_sql_lit(SUFFIXES[3])} ELSE '' END AS text
  FROM conversations)"""


# The same candidates with marks that reach every rule: emoji and emoticons, an open
# parenthesis, an odd quote, a text that is too short.
MARKS = (
    " 😂 so good :) :-D ❤️ it was",
    " (and so it went on.",
    ' and he said "no.',
    " well (really) it ended 🤔🎉 there!",
    " <3 ;) :P \"quoted\" to the end?",
)


def marked_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = load(spark, sf_dir, "conversations")
    k = (F.col("conv_id") * 1000 + F.col("turn")) % 7
    mark = F.when(k == 0, F.lit(MARKS[0]))
    for i, m in enumerate(MARKS[1:], 1):
        mark = mark.when(k == i, F.lit(m))
    text = F.when(k == 5, F.concat(F.substring("text", 1, 9), F.lit(" 😂."))).otherwise(F.concat(F.col("text"), mark.otherwise(F.lit(""))))
    return conv.select(F.col("conv_id").alias("slot"), F.col("turn").cast("int").alias("attempt"), text.alias("text"))


MARKED_SQL = f"""
candidates AS (
  SELECT conv_id AS slot, CAST(turn AS INTEGER) AS attempt,
    CASE (conv_id * 1000 + turn) % 7 {" ".join(f"WHEN {i} THEN text || {_sql_lit(m)}" for i, m in enumerate(MARKS))}
      WHEN 5 THEN substr(text, 1, 9) || ' 😂.' ELSE text END AS text
  FROM conversations)"""


# ---------------------------------------------------------------------------
# Post files: Spark writes the posts view as the reference's three formats,
# ordered by post_id (range-partitioned, so part files concatenate in order).
# A share of TSV / JSON lines is malformed on purpose (bad score, no tab,
# not JSON, string score) so the readers' skip rules have work to do.
# ---------------------------------------------------------------------------
def tsv_line(p: DataFrame) -> Column:
    pid = F.col("post_id")
    text = F.regexp_replace(F.concat(F.coalesce(F.col("title"), F.lit("")), F.lit(" "),
                                     F.coalesce(F.col("selftext"), F.lit(""))), "[\r\n]", " ")
    return (F.when(pid % 13 == 0, F.concat(F.lit("x"), F.col("score").cast("string"), F.lit("\t"), text))
             .when(pid % 29 == 0, F.concat(F.col("score").cast("string"), F.lit(" "), text))
             .otherwise(F.concat(F.col("score").cast("string"), F.lit("\t"), text)))


def json_line(p: DataFrame) -> Column:
    pid = F.col("post_id")
    score = F.when(pid % 7 == 0, F.col("score").cast("string").cast("variant")).otherwise(
        F.col("score").cast("variant"))
    obj = F.struct(F.col("title"), F.col("selftext"), score.alias("score"))
    with_nulls = F.to_json(obj, {"ignoreNullFields": "false"})
    return (F.when(pid % 31 == 0, F.lit("{not json"))
             .when(pid % 3 == 0, with_nulls)
             .otherwise(F.to_json(obj)))


def write_whole_tsv(spark: SparkSession, sf_dir: str) -> str:
    """Every post as a well-formed ``score<TAB>text`` line, in a new folder."""
    from quipu.operators.corpus import fresh_path
    out = fresh_path(spark, "whole-tsv")
    p = posts(spark, sf_dir).repartitionByRange("post_id").sortWithinPartitions("post_id")
    text = F.regexp_replace(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("selftext", F.lit(""))), "[\r\n]", " ")
    p.select(F.concat(F.col("score").cast("string"), F.lit("\t"), text).alias("value")).write.text(out)
    return out


def write_post_files(spark: SparkSession, sf_dir: str) -> str:
    """The posts as CSV, TSV and JSON lines in a new folder of the shared checkpoint folder."""
    from quipu.operators.corpus import fresh_path
    out = fresh_path(spark, "post-files")
    p = posts(spark, sf_dir).repartitionByRange("post_id").sortWithinPartitions("post_id")
    p.select("title", "selftext", F.col("score").cast("string").alias("score")).write.mode("overwrite") \
        .options(header=True, quoteAll=True, escape='"').csv(f"{out}/csv")
    p.select(tsv_line(p).alias("value")).write.mode("overwrite").text(f"{out}/tsv")
    p.select(json_line(p).alias("value")).write.mode("overwrite").text(f"{out}/jsonl")
    return out

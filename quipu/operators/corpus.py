"""Corpus order, union, dedup, head, split and funnel counts.

Order is explicit: every row carries ``doc_key = source_rank * 2**40 + position``
assigned at ingest, so "first occurrence", "first n" and "first 95 %" mean the
same thing on any number of partitions.  Nothing here relies on partition or
file order.

Global positions (split threshold, head beyond a small n, dense ids) are
computed on the *key columns only*: the keys are range-sorted, pinned with a
reliable checkpoint (shared ``spark.checkpoint.dir``), counted per partition
(one row per partition reaches the driver) and turned into offsets.  The wide
rows are never sorted or moved for it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.session import ensure_checkpoint_dir

RANK_SHIFT = 40          # positions below 2**40 per source
TAKE_ORDERED_MAX = 100_000   # head(n) above this uses the distributed threshold


def doc_key(source_rank: int, position: Column) -> Column:
    """The global key; a position outside the source's range fails the job."""
    pos = position.cast("long")
    inside = F.when(pos.isNull() | pos.between(0, (1 << RANK_SHIFT) - 1), pos).otherwise(
        F.raise_error(F.lit(f"source {source_rank}: position outside 0 .. 2^{RANK_SHIFT} - 1")).cast("long"))
    return F.lit(source_rank).cast("long") * F.lit(1 << RANK_SHIFT) + inside


def source_rank_of(key: Column) -> Column:
    return F.shiftright(key, RANK_SHIFT).cast("int")


def corpus_name_of(key: Column, names: Sequence[str]) -> Column:
    """Recover the source name from the key (small literal array, O(1) lookup)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), source_rank_of(key) + 1)


def compute_once(df: DataFrame, keep: Sequence[str], **exprs: Column) -> DataFrame:
    """Project ``keep`` plus the named (expensive) expressions, evaluated once.

    Catalyst pushes a Filter below a Project by inlining the aliased
    expression, and FilterExec has no common-subexpression elimination, so a
    filter on a cleaned text would re-run the regex chain once per predicate.
    Emitting the values through a one-row ``inline`` generator makes them
    generator outputs, which filters cannot be pushed beneath.
    """
    packed = F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()])))
    return df.select(*keep, packed)


# --- U1 ---------------------------------------------------------------------
def union_corpora(frames: Sequence[tuple[str, DataFrame]], position_col: str = "pos") -> DataFrame:
    """Concatenate sources in the given order; each frame needs ``position_col``
    (its row order within the source).  Adds ``doc_key`` and ``corpus``."""
    out = None
    for rank, (name, df) in enumerate(frames):
        part = (df.withColumn("doc_key", doc_key(rank, F.col(position_col)))
                  .withColumn("corpus", F.lit(name)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


# --- D1 ---------------------------------------------------------------------
def dedup_exact(df: DataFrame, text_col: str = "text", key_col: str = "doc_key",
                names: Sequence[str] | None = None) -> DataFrame:
    """Keep the first occurrence (smallest key) of each exact text.

    One bigint aggregation buffer keeps this a partial + final HashAggregate,
    so a text repeated millions of times collapses map-side before the shuffle.
    The source name is recomputed from the key instead of being carried.
    """
    out = df.groupBy(text_col).agg(F.min(key_col).alias(key_col))
    if names is not None:
        out = out.withColumn("corpus", corpus_name_of(F.col(key_col), names))
    return out


# --- global positions ---------------------------------------------------------
def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (shared checkpoint dir): computed once, survives
    executor loss, cuts lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder for each call."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quipu-tables/{name}-{uuid.uuid4().hex}"


def pin_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back.  Unlike ``checkpoint()`` the result carries file-based statistics,
    so iterative jobs do not accumulate size estimates from earlier plans."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def pin_bucketed(df: DataFrame, name: str, column: str, more: Callable[[DataFrame], DataFrame | None] | None = None,
                 buckets: int | None = None, compression: str = "snappy") -> DataFrame:
    """Like :func:`pin_table`, but as a table bucketed by ``column``: joins and aggregates on it
    read it in place, without a shuffle.  ``more``, given the rows written, makes further ones,
    which are written to the same table."""
    spark = df.sparkSession
    path, table = fresh_path(spark, name), f"quipu_{uuid.uuid4().hex}"
    parts = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def written(rows: DataFrame):
        return rows.write.bucketBy(parts, column).option("path", path).option("compression", compression).format("parquet")

    written(df).saveAsTable(table)
    rest = more(spark.read.parquet(path)) if more else None
    if rest is not None:
        written(rest).mode("append").saveAsTable(table)
    return spark.table(table)


def _pinned_keys(df: DataFrame, order_cols: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    # pin the narrow key projection first so the range sampling and the sort
    # read it instead of recomputing the source
    keys = pin(df.select(*order_cols, *extra))
    return pin(keys.orderBy(*order_cols))


def _offsets_literal(totals: dict[int, int], n_parts: int) -> Column:
    acc, offs = 0, []
    for p in range(n_parts):
        offs.append(acc)
        acc += totals.get(p, 0)
    return F.array(*[F.lit(o).cast("long") for o in offs]) if offs else F.array(F.lit(0).cast("long"))


def global_index(df: DataFrame, order_cols: Sequence[str], index_col: str = "idx") -> DataFrame:
    """Return ``order_cols + [index_col]`` with the 0-based position in order.

    Only the key columns are sorted; the count per partition is the only data
    that reaches the driver.  Join the result back on the keys if needed.
    """
    pinned = _pinned_keys(df, order_cols)
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    totals = {r["p"]: r["n"] for r in pinned.groupBy(pid.alias("p")).agg(F.count("*").alias("n")).collect()}
    offs = _offsets_literal(totals, pinned.rdd.getNumPartitions())
    return pinned.select(*order_cols, (F.element_at(offs, pid + 1) + local).alias(index_col))


def ordered_offsets(df: DataFrame, order_cols: Sequence[str], weight_col: str,
                    out_col: str = "offset") -> DataFrame:
    """Exclusive prefix sum of ``weight_col`` in key order (e.g. rows before a doc).

    Per-partition running sums use an Arrow batch function over the pinned,
    sorted keys (narrow, no shuffle); partition totals become offsets.
    """
    pinned = _pinned_keys(df, order_cols, [F.col(weight_col).cast("long").alias("_w")])
    schema = T.StructType(pinned.schema.fields + [T.StructField("_pid", T.IntegerType()),
                                                  T.StructField("_local", T.LongType())])

    def local_prefix(batches):
        pid = TaskContext.get().partitionId()
        run = 0
        for pdf in batches:
            w = pdf["_w"].fillna(0).astype("int64")
            pdf["_pid"] = pid
            pdf["_local"] = run + w.cumsum() - w
            run += int(w.sum())
            yield pdf

    loc = pinned.mapInPandas(local_prefix, schema)
    totals = {r["p"]: int(r["n"] or 0) for r in
              pinned.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("_w").alias("n")).collect()}
    offs = _offsets_literal(totals, pinned.rdd.getNumPartitions())
    return loc.select(*order_cols, (F.element_at(offs, F.col("_pid") + 1) + F.col("_local")).alias(out_col))


def nth_key(df: DataFrame, key_col: str, n: int):
    """Key of the row at 0-based position ``n`` in key order (None if n >= count)."""
    row = global_index(df, [key_col]).filter(F.col("idx") == n).select(key_col).first()
    return None if row is None else row[0]


# --- L1 ---------------------------------------------------------------------
def head(df: DataFrame, n: int, key_col: str = "doc_key") -> DataFrame:
    """First ``n`` rows in key order.  Small n -> TakeOrderedAndProject (bounded
    heap per task); large n -> distributed threshold filter on the key."""
    if n <= TAKE_ORDERED_MAX:
        return df.orderBy(key_col).limit(n)
    cut = nth_key(df, key_col, n)
    return df if cut is None else df.filter(F.col(key_col) < F.lit(cut))


# --- X1 ---------------------------------------------------------------------
def split_threshold(keys: DataFrame, frac: float = 0.95, key_col: str = "doc_key"):
    """The first key of the 'eval' part: rows with key < threshold are the first
    ``int(n * frac)`` rows.  None when every row is 'train'.  Reads the key
    column only, so it can run on the source table rather than a derived one."""
    keys = pin(keys.select(key_col))
    n = keys.count()
    k = int(n * frac)
    return nth_key(keys, key_col, k) if k < n else None


def split_ordered(df: DataFrame, frac: float = 0.95, key_col: str = "doc_key",
                  split_col: str = "split") -> DataFrame:
    """Positional split: index < int(n * frac) -> 'train', else 'eval'.

    Computes one threshold key from the sorted keys; the rows themselves are
    only filtered/labelled in place (no shuffle of texts).
    """
    cut = split_threshold(df, frac, key_col)
    is_train = F.lit(True) if cut is None else (F.col(key_col) < F.lit(cut))
    return df.withColumn(split_col, F.when(is_train, "train").otherwise("eval"))


# --- A0 ---------------------------------------------------------------------
def curation_funnel(flags: DataFrame, kept: DataFrame, group_col: str = "corpus") -> DataFrame:
    """Row counts after each stage per source, in one pass over the stage flags,
    plus the rows kept by dedup (from the dedup output, grouped by source)."""
    stages = flags.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_posts"),
        F.count_if(F.col("ok_score")).alias("n_score"),
        F.count_if(F.col("ok_score") & F.col("ok_unredacted")).alias("n_unredacted"),
        F.count_if(F.col("ok_score") & F.col("ok_unredacted") & F.col("ok_nonempty")).alias("n_nonempty"),
        F.count_if(F.col("ok_score") & F.col("ok_unredacted") & F.col("ok_nonempty")
                   & F.col("ok_length")).alias("n_length"))
    kept_n = kept.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_kept"))
    return (stages.join(kept_n, group_col, "left")
            .withColumn("n_kept", F.coalesce(F.col("n_kept"), F.lit(0).cast("long"))))

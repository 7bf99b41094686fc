"""Alias tables: constant-time draws from next-id distributions (W7, G1 with several returns).

One table for each context, built by Spark for all contexts at once: a context of m ids and n
counts gets m slots of n units; a slot holds its own id up to a threshold and one other id, its
alias, above it.  A draw picks a slot and a unit and reads one row, however long the list.

The tables are built without a loop over a context, from prefix sums.  Ids whose share is below
a slot (light) lack units, the others (heavy) have units to give.  With D the running sum of
what lights lack and E that of what heavies give, both by id: a light is filled by the first
heavy whose E reaches the D before it; a heavy is used up, and filled by the next, at the first
light whose D passes its E.  Everything is in integers, so every id keeps exactly its count.

How it scales.  Two windows over (context), each bounded by the vocabulary, sorted by running
sum; draws meet the table in one equi-join on (context, slot).  A hot context's draws are spread
over its slots by the join key, and adaptive execution splits what is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quipu.operators import sampling as S


def alias_tables(counts: DataFrame, keys: Sequence[str] = ("k", "ctx"), id_col: str = "label", count_col: str = "n") -> DataFrame:
    """(keys, slot, token_id, threshold, alias_id, m, total) from (keys, id, count): slots are
    numbered by id from 0; of a slot's ``total`` units the first ``threshold`` are its own id's,
    the others its alias's.  Counts of zero or less and null ids have no slot."""
    keys = list(keys)
    own = counts.filter((F.col(count_col) > 0) & F.col(id_col).isNotNull()).select(
        *keys, F.col(id_col).alias("token_id"), F.col(count_col).cast("long").alias("w"))
    whole, by_id = W.partitionBy(*keys), W.partitionBy(*keys).orderBy("token_id")
    rows = own.select(*keys, "token_id", "w", F.count("*").over(whole).alias("m"), F.sum("w").over(whole).alias("total"),
                      (F.row_number().over(by_id) - 1).alias("slot"))
    gives = F.col("m") * F.col("w") - F.col("total")
    rows = rows.withColumn("gives", gives).withColumn("heavy", F.col("gives") >= 0)
    run = W.partitionBy(*keys, "heavy").orderBy("token_id")
    rows = rows.withColumn("sum", F.sum(F.abs("gives")).over(run)).withColumn("nth", F.row_number().over(run))
    # lights stand where the sum before them is, heavies at their own; of equals lights come first
    place = F.when(F.col("heavy"), F.col("sum")).otherwise(F.col("sum") + F.col("gives"))
    order = W.partitionBy(*keys).orderBy("place", "heavy", "nth")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("place", place).withColumn("by", F.count_if("heavy").over(upto) + 1)
    # the first light whose sum passes a heavy's: the next light in the order of the sums after them,
    # which is the last one before it in the order turned round (a frame that only grows)
    passed = W.partitionBy(*keys).orderBy(F.desc("sum"), F.desc("heavy"), F.desc("nth")).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("passed", F.last(F.when(~F.col("heavy"), F.col("sum")), ignorenulls=True).over(passed))
    used = F.col("heavy") & F.col("passed").isNotNull()
    wants = F.when(~F.col("heavy"), F.col("by")).when(used, F.col("nth") + 1)
    threshold = (F.when(~F.col("heavy"), F.col("m") * F.col("w")).when(used, F.col("total") + F.col("sum") - F.col("passed"))
                 .otherwise(F.col("total")))
    heavies = rows.filter("heavy").select(*keys, F.col("nth").alias("wants"), F.col("token_id").alias("alias_id"))
    out = rows.select(*keys, "slot", "token_id", threshold.alias("threshold"), wants.alias("wants"), "m", "total")
    return out.join(heavies, [*keys, "wants"], "left").select(*keys, "slot", "token_id", "threshold", "alias_id", "m", "total")


def alias_draws(requests: DataFrame, tables: DataFrame, seed_cols: Sequence[str], seed: int = 0, keys: Sequence[str] = ("k", "ctx"),
                out_col: str = "token_id") -> DataFrame:
    """``requests`` with one id drawn for each row from its context's table; the draw depends on
    the columns ``seed_cols`` and on ``seed`` alone.  Rows of contexts without a table drop out."""
    keys = list(keys)
    sizes = tables.filter("slot = 0").select(*keys, "m")
    named = [F.col(c) for c in seed_cols]
    asked = requests.join(sizes, keys).withColumn("slot", F.floor(S.uniform(*named, F.lit(seed), F.lit("slot")) * F.col("m")).cast("int"))
    met = asked.drop("m").join(tables.withColumnRenamed("token_id", "own_id"), [*keys, "slot"])
    unit = F.floor(S.uniform(*named, F.lit(seed), F.lit("unit")) * F.col("total"))
    drawn = F.when(unit < F.col("threshold"), F.col("own_id")).otherwise(F.col("alias_id"))
    return met.select(*requests.columns, drawn.alias(out_col))

"""Judging, selecting and reporting on candidate texts (G4, M6, J5, J5b, K2 frame).

Candidates are rows ``(slot, attempt, text)``: every attempt the reference
would make sequentially exists as a row, so selection and reporting are plain
aggregates.  A slot holds at most ``max_retries`` attempts, so per-slot groups
are bounded.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quipu.functions import text as T
from quipu.functions import verdict as V
from quipu.operators import corpus as C
from quipu.operators import sampling as S
from quipu.operators import term_join as TJ


def judge(cands: DataFrame, explicit_terms: Iterable[str] = (),
          boilerplate_terms: Iterable[str] = V.BOILERPLATE_TERMS,
          clean_first: bool = True, text_col: str = "text") -> DataFrame:
    """P10 clean (optional) then F12 verdict -> adds ``ok`` and ``reason``."""
    txt = T.clean_generated(F.col(text_col)) if clean_first else F.col(text_col)
    v = V.quality_verdict(F.col(text_col), list(explicit_terms), list(boilerplate_terms))
    return (cands.withColumn(text_col, txt)
                 .withColumn("_v", v)
                 .select("*", F.col("_v.ok").alias("ok"), F.col("_v.reason").alias("reason"))
                 .drop("_v"))


def judge_by_tables(cands: DataFrame, explicit: DataFrame, boilerplate: DataFrame, clean_first: bool = True,
                    text_col: str = "text", term_col: str = "term") -> DataFrame:
    """P10 clean (optional) then F12 verdict with both term lists given as tables of any size."""
    txt = T.clean_generated(F.col(text_col)) if clean_first else F.col(text_col)
    rest = [c for c in cands.columns if c != text_col]
    rows = C.pin_table(C.compute_once(cands, rest, **{text_col: txt}), "cleaned")
    keyed = rows.select(F.struct("slot", "attempt").alias("_key"), text_col)

    def flag(terms: DataFrame, name: str) -> DataFrame:
        return TJ.matching_keys(keyed, terms, "_key", text_col, term_col).select("_key.slot", "_key.attempt", F.lit(True).alias(name))

    v = V.verdict_of(F.col(text_col), F.coalesce("_explicit", F.lit(False)), F.coalesce("_boilerplate", F.lit(False)))
    return (rows.join(flag(explicit, "_explicit"), ["slot", "attempt"], "left").join(flag(boilerplate, "_boilerplate"), ["slot", "attempt"], "left")
                .withColumn("_v", v).select(*cands.columns, F.col("_v.ok").alias("ok"), F.col("_v.reason").alias("reason")))


def select_candidates(judged: DataFrame) -> DataFrame:
    """Per slot, the first attempt judged good, else the last attempt.

    Returns (slot, attempt, text, ok, reason, n_attempts) where n_attempts is
    how many attempts the sequential loop would have made.
    """
    first_ok = F.min(F.when(F.col("ok"), F.col("attempt")))
    chosen = F.coalesce(F.min_by(F.struct("attempt", "text", "ok", "reason"),
                                 F.when(F.col("ok"), F.col("attempt"))),
                        F.max_by(F.struct("attempt", "text", "ok", "reason"), F.col("attempt")))
    agg = judged.groupBy("slot").agg(chosen.alias("c"), F.min("attempt").alias("_a0"),
                                     first_ok.alias("_first_ok"))
    return agg.select("slot", F.col("c.attempt").alias("attempt"), F.col("c.text").alias("text"),
                      F.col("c.ok").alias("ok"), F.col("c.reason").alias("reason"),
                      (F.col("c.attempt") - F.col("_a0") + 1).cast("int").alias("n_attempts"))


def attempts_made(judged: DataFrame) -> DataFrame:
    """The attempts the sequential loop makes: up to and including the chosen one."""
    slot = W.partitionBy("slot")     # a slot holds at most its retries
    stop = F.coalesce(F.min(F.when(F.col("ok"), F.col("attempt"))).over(slot), F.max("attempt").over(slot))
    return (judged.select("slot", "attempt", "ok", "reason").withColumn("_stop", stop)
                  .filter(F.col("attempt") <= F.col("_stop")).drop("_stop"))


def rejection_report(judged: DataFrame) -> DataFrame:
    """M6: attempts per verdict reason over the attempts actually made."""
    return attempts_made(judged).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def attempt_summary(selected: DataFrame) -> DataFrame:
    """M6: total attempts, slots, average attempts per slot, slots kept despite failing."""
    return selected.agg(
        F.sum("n_attempts").cast("long").alias("total_attempts"),
        F.count(F.lit(1)).alias("n_slots"),
        F.round(F.sum("n_attempts") / F.count(F.lit(1)), 6).alias("avg_attempts"),
        F.count_if(~F.col("ok")).alias("n_kept_failing"))


def assign_prompt_cycle(slots: DataFrame, prompts: DataFrame, slot_col: str = "slot",
                        prompt_id_col: str = "prompt_id") -> DataFrame:
    """Slot i gets prompt ``i mod n`` (prompt ids dense from 0).  An
    equi-join on ``pmod``; AQE broadcasts the prompt side when it is small."""
    n = prompts.count()
    if n == 0:
        raise ValueError("empty prompt table")
    return (slots.withColumn("_pk", F.pmod(F.col(slot_col), F.lit(n)))
                 .join(prompts.withColumnRenamed(prompt_id_col, "_pk"), "_pk").drop("_pk"))


def assign_prompt_random(cands: DataFrame, prompts: DataFrame, seed: int = 0,
                         prompt_id_col: str = "prompt_id") -> DataFrame:
    """Attempt 0 keeps the slot's cycled prompt; later attempts use a
    pseudo-random prompt drawn from the md5 of (slot, attempt, seed), so a
    re-run (or a retried task) draws the same prompt."""
    n = prompts.count()
    if n == 0:
        raise ValueError("empty prompt table")
    drawn = F.floor(S.uniform(F.col("slot"), F.col("attempt"), F.lit(seed)) * F.lit(n))
    pick = F.when(F.col("attempt") == 0, F.pmod(F.col("slot"), F.lit(n))).otherwise(drawn)
    return cands.withColumn("_pk", pick).join(
        prompts.withColumnRenamed(prompt_id_col, "_pk"), "_pk").drop("_pk")


def numbered_lines(selected: DataFrame, order_col: str = "slot", text_col: str = "text") -> DataFrame:
    """K2 frame: ``"{i}. {text}\\n"`` with i from 1 in ``order_col`` order; written
    with ``write.text`` each row ends in a newline, giving the blank line."""
    idx = C.global_index(selected, [order_col])
    return (selected.join(idx, order_col)
                    .select((F.col("idx") + 1).alias("i"),
                            F.format_string("%d. %s\n", F.col("idx") + 1, F.col(text_col)).alias("line")))


# The reference's prompt list, cycled over slots.
DEFAULT_PROMPTS = (
    "Why did the",
    "What do you call a",
    "A man walks into a bar",
    "How many",
    "My wife told me",
    "What's the difference between",
    "I told my",
    "A priest, a rabbi, and",
    "Knock knock",
    "Why don't",
    "What did the",
    "How do you",
    "What happens when",
    "I asked my",
)


def prompt_table(spark, prompts=DEFAULT_PROMPTS) -> DataFrame:
    return spark.createDataFrame([(i, p) for i, p in enumerate(prompts)], "prompt_id long, prompt string")

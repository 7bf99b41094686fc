"""The loop of generation and judging against the same loop, slot by slot, in plain Python."""
import hashlib

import pytest
from pyspark.sql import functions as F

from quipu.operators import qa as QA
from quipu.operators import retry as RE

PROMPTS = ["a", "b", "c"]


def _uniform(*parts):
    return (int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)


def _text(slot, attempt, prompt):
    """Some slots are good at once, some later, some never."""
    return f"{prompt} words enough for slot {slot}" + ("." if (slot * 7 + attempt * 3 + len(prompt)) % 5 == 0 and slot % 4 else "")


def _loop(slots, retries, seed):
    made = []
    for slot in slots:
        prompt = PROMPTS[slot % len(PROMPTS)]
        for attempt in range(retries):
            if attempt:
                prompt = PROMPTS[int(_uniform(slot, attempt, seed) * len(PROMPTS))]
            text = _text(slot, attempt, prompt)
            good = text.endswith(".")
            made.append((slot, attempt, prompt, text, good, "good" if good else "no ending punctuation"))
            if good:
                break
    return made


@pytest.mark.parametrize("retries", [1, 2, 6])
def test_equals_the_loop_slot_by_slot(spark, retries):
    asked_rows = []

    def generate(asked):
        asked_rows.append(asked.count())
        tail = F.when(((F.col("slot") * 7 + F.col("attempt") * 3 + 1) % 5 == 0) & (F.col("slot") % 4 != 0), ".").otherwise("")
        return asked.withColumn("text", F.concat("prompt", F.lit(" words enough for slot "), F.col("slot").cast("string"), tail))

    slots = spark.createDataFrame([(i, "x") for i in [*range(23), 3, 3, None]], "slot long, prompt string")
    prompts = spark.createDataFrame(list(enumerate(PROMPTS)), "prompt_id long, prompt string")
    made = RE.attempts_until_good(slots, prompts, generate, max_retries=retries, seed=9)
    want = _loop(range(23), retries, 9)
    assert sorted(tuple(r) for r in made.collect()) == sorted(want)
    # only open slots generate again
    assert asked_rows == [sum(a == i for _, a, *_ in want) for i in range(len(asked_rows))]
    chosen = {r["slot"]: (r["attempt"], r["ok"], r["n_attempts"]) for r in QA.select_candidates(made).collect()}
    assert chosen == {s: (a, ok, a + 1) for s, a, _, _, ok, _ in want if (s, a) in {(s, max(b for t, b, *_ in want if t == s)) for s, *_ in want}}
    report = {r["reason"]: r["n"] for r in QA.rejection_report(made).collect()}
    assert report == {x: sum(w[5] == x for w in want) for x in {w[5] for w in want}}
    assert QA.attempt_summary(QA.select_candidates(made)).first()["total_attempts"] == len(want)


def test_ends_when_all_are_good(spark):
    prompts = spark.createDataFrame(list(enumerate(PROMPTS)), "prompt_id long, prompt string")
    slots = spark.range(5).select(F.col("id").alias("slot"))
    made = RE.attempts_until_good(slots, prompts, lambda d: d.withColumn("text", F.lit("a text of more than twenty letters.")), max_retries=50)
    assert sorted((r["slot"], r["attempt"]) for r in made.collect()) == [(i, 0) for i in range(5)]
    none = RE.attempts_until_good(slots.limit(0), prompts, lambda d: d.withColumn("text", F.lit("x")), max_retries=50)
    assert none.collect() == []

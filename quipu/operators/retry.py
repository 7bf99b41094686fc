"""Generate, clean, judge and retry until every slot has a good text (G4 with G1, P10, F12, J5, J5b).

The reference's loop, for all slots at once: a frontier of open slots shrinks round by round.
In each round every open slot draws its prompt (its own in the first, a random one after a
failure), one text is generated, cleaned and judged; slots whose text is good leave the
frontier, the others go on, up to ``max_retries`` attempts.

How it scales.  A round reads and writes the open slots alone: its attempts are one table in
the shared folder, written once and never again, so work is proportional to the attempts made
and a lost executor repeats part of one round at most.  Prompts are drawn from hashes of
(slot, attempt, seed), so a repeated task draws the same.  The driver holds a count for each round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.operators import corpus as C
from quipu.operators import generate as GE
from quipu.operators import ngram as NG
from quipu.operators import qa as QA

MAX_RETRIES = 50      # fixed value: the reference's retries
# The reference's sampling parameters for this loop.
TEMPERATURE, TOP_K, TOP_P, REPETITION, NO_REPEAT = 0.85, 50, 0.92, 1.2, 3


def attempts_until_good(slots: DataFrame, prompts: DataFrame, generate: Callable[[DataFrame], DataFrame],
                        judge: Callable[[DataFrame], DataFrame] = QA.judge, max_retries: int = MAX_RETRIES,
                        seed: int = 0) -> DataFrame:
    """(slot, attempt, prompt, text, ok, reason): every attempt made for each distinct slot.

    ``prompts`` is (prompt_id from 0, prompt).  ``generate`` takes (slot, attempt, prompt) and adds
    ``text``; ``judge`` cleans the text and adds ``ok`` and ``reason``.  A slot's attempts end with
    its first good one, or with the last of ``max_retries``.  Pass the result to
    ``qa.select_candidates``, ``qa.rejection_report`` or ``qa.attempt_summary``.
    """
    open_ = C.pin_table(slots.select("slot").filter("slot is not null").distinct(), "open-slots")
    made = None
    for attempt in range(max_retries):
        asked = QA.assign_prompt_random(open_.withColumn("attempt", F.lit(attempt)), prompts, seed)
        judged = judge(generate(asked.select("slot", "attempt", "prompt")))
        tried = C.pin_table(judged.select("slot", "attempt", "prompt", "text", "ok", "reason"), f"attempt-{attempt}")
        made = tried if made is None else made.unionByName(tried)
        open_ = tried.filter(~F.col("ok")).select("slot")
        if open_.isEmpty():
            break
    return made


def sampling_generator(model: NG.NgramModel, vocab: DataFrame, max_vocab: int | None, max_steps: int, seed: int = 0,
                       temperature: float = TEMPERATURE, k: int | None = TOP_K, p: float | None = TOP_P,
                       repetition: float | None = REPETITION, no_repeat: int | None = NO_REPEAT) -> Callable[[DataFrame], DataFrame]:
    """A ``generate`` for :func:`attempts_until_good`: sampled continuation (G1) of each
    attempt's prompt, with draws of its own for every (slot, attempt).  The model's lookup tables
    are pinned once for all rounds."""
    ready, stops, keys = GE.prepare_sampling(model), GE.stop_ids(vocab), ("slot", "attempt")

    def generate(asked: DataFrame) -> DataFrame:
        asked = C.pin_table(asked, "asked")
        keyed = asked.withColumn("seq", F.struct(*keys))
        enc = GE.encode_prompts(keyed, vocab, model.n, max_vocab, "seq").select("seq.*", "ids")
        state = GE.generate_sampled(enc, ready, stops, seed, temperature, k, p, repetition, no_repeat, max_steps, keys)
        return GE.continuation_text(state, vocab, asked, max_vocab, keys).join(asked, list(keys))

    return generate

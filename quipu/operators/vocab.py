"""Vocabulary, encoding, batching.

Token counts are a partial + final HashAggregate: the first-seen order key is
packed into one ``decimal(38,0)`` (``doc_key * 2**31 + pos``), which Spark keeps
in a fixed-width hash-aggregation buffer, so hot tokens (``<s>``, "the")
collapse map-side.  A capped vocabulary is bounded by its cap and is the only
thing broadcast; the uncapped one gets dense ids from the distributed global
index and is joined without a broadcast hint (AQE decides on real sizes).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quipu.functions import tokens as TK
from quipu.operators import corpus as C

POS_BITS = 31
BROADCAST_VOCAB_MAX = 2_000_000    # rows; a capped vocabulary above this is joined by shuffle


def first_seen_key(key_col: str, pos_col: str):
    return (F.col(key_col).cast("decimal(38,0)") * F.lit(1 << POS_BITS).cast("decimal(38,0)")
            + F.col(pos_col).cast("decimal(38,0)")).cast("decimal(38,0)")


def explode_tokens(docs: DataFrame, tokens_col: str = "tokens", key_col: str = "doc_key") -> DataFrame:
    """(key, pos, token).  ``posexplode_outer`` + a null filter instead of
    ``posexplode``: the latter makes Catalyst infer ``size(tokens) > 0`` and
    push it below the projection, recomputing the tokenizer in a Filter."""
    return (docs.select(key_col, F.posexplode_outer(tokens_col).alias("pos", "token"))
                .filter(F.col("pos").isNotNull()))


# --- T5 ---------------------------------------------------------------------
def token_counts(docs: DataFrame, tokens_col: str = "tokens", key_col: str = "doc_key") -> DataFrame:
    """(token, n, first_seen): corpus frequency and first occurrence key."""
    ex = explode_tokens(docs, tokens_col, key_col)
    return ex.groupBy("token").agg(F.count(F.lit(1)).alias("n"),
                                   F.min(first_seen_key(key_col, "pos")).alias("first_seen"))


# --- T6 / T6b ------------------------------------------------------------------
def build_vocab(counts: DataFrame, max_size: int | None = 10000, unk: str = TK.UNK) -> DataFrame:
    """(token, token_id int, n bigint).

    Capped: top ``max_size - 2`` by count desc, ties by first occurrence; ids
    from 2; ``<UNK>`` = 1; 0 stays reserved for padding.  The top-k runs as a
    bounded TakeOrderedAndProject before numbering.
    Uncapped (``max_size=None``): every token ranked, ids from 1, no ``<UNK>``.
    """
    if max_size is not None:
        top = counts.orderBy(F.desc("n"), F.asc("first_seen")).limit(max(max_size - 2, 0))
        ranked = top.select("token", (F.row_number().over(
            W.orderBy(F.desc("n"), F.asc("first_seen"))) + 1).cast("int").alias("token_id"), "n")
        unk_row = counts.sparkSession.createDataFrame([(unk, TK.UNK_ID, 0)], "token string, token_id int, n long")
        return unk_row.unionByName(ranked)
    keyed = counts.select("token", "n", (-F.col("n")).alias("_neg_n"), "first_seen")
    idx = C.global_index(keyed, ["_neg_n", "first_seen"])
    return (keyed.join(idx, ["_neg_n", "first_seen"])
                 .select("token", (F.col("idx") + 1).cast("int").alias("token_id"), "n"))


def vocab_size(vocab: DataFrame) -> int:
    """Number of ids including the reserved 0 (= max id + 1)."""
    return int(vocab.agg(F.max("token_id")).first()[0] or 0) + 1


def _vocab_side(vocab: DataFrame, max_size: int | None) -> DataFrame:
    v = vocab.select("token", "token_id")
    return F.broadcast(v) if (max_size is not None and max_size <= BROADCAST_VOCAB_MAX) else v


def _pack_pos(pos, val):
    # (pos, id) -> one bigint so the per-document reorder is a primitive sort
    return F.shiftleft(pos.cast("long"), 32) + val.cast("long")


def _unpack_low(x):
    return x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


# --- T7 ---------------------------------------------------------------------
def encode(docs: DataFrame, vocab: DataFrame, max_size: int | None = 10000,
           tokens_col: str = "tokens", key_col: str = "doc_key", oov_id: int | None = TK.UNK_ID,
           out_col: str = "ids") -> DataFrame:
    """token -> id per document, unknown -> ``oov_id`` (None drops unknowns).

    posexplode -> broadcast hash join with the (size-checked) vocabulary ->
    regroup per document.  When ``docs`` is hash-partitioned by ``key_col`` the
    regroup needs no exchange.
    """
    ex = explode_tokens(docs, tokens_col, key_col)
    j = ex.join(_vocab_side(vocab, max_size), "token", "left")
    idc = F.col("token_id") if oov_id is None else F.coalesce(F.col("token_id"), F.lit(oov_id))
    j = j.select(key_col, "pos", idc.alias("id"))   # without an id: packed to null, which the list leaves out
    return j.groupBy(key_col).agg(
        F.transform(F.array_sort(F.collect_list(_pack_pos(F.col("pos"), F.col("id")))),
                    _unpack_low).alias(out_col))


# --- T8 ---------------------------------------------------------------------
def decode(encoded: DataFrame, vocab: DataFrame, max_size: int | None = 10000, ids_col: str = "ids",
           key_col: str | Sequence[str] = "doc_key", stop_tokens=(TK.SENTENCE_BEGIN, TK.SENTENCE_END),
           space_token: str = "_") -> DataFrame:
    """id -> token; stop tokens skipped; ``space_token`` -> a space; joined by
    spaces.  ``key_col`` may be several columns; a document without words gets
    an empty text."""
    keys = [key_col] if isinstance(key_col, str) else list(key_col)
    ex = encoded.select(*keys, F.posexplode_outer(ids_col).alias("pos", "token_id"))
    j = ex.join(_vocab_side(vocab, max_size), "token_id", "left")
    word = F.when(F.col("token") == space_token, F.lit("")).otherwise(F.col("token"))
    shown = F.when(F.col("token").isNotNull() & ~F.col("token").isin(*stop_tokens), F.struct("pos", word.alias("w")))
    return j.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(shown)), lambda s: s["w"]), " ").alias("text"))


# --- T10/T11 as rows -------------------------------------------------------------
def windows(encoded: DataFrame, n: int, ids_col: str = "ids", key_col: str = "doc_key") -> DataFrame:
    """(doc_key, pos, ctx array<int>, label int): one row per n-gram window."""
    w = (encoded.select(key_col, F.posexplode_outer(TK.ngram_windows(F.col(ids_col), n)).alias("pos", "_w"))
                .filter(F.col("pos").isNotNull()))
    ctx, label = TK.split_label(F.col("_w"), n)
    return w.select(key_col, F.col("pos").cast("int").alias("pos"), ctx.alias("ctx"),
                    label.cast("int").alias("label"))


# --- T13 ---------------------------------------------------------------------
def assign_batches(encoded: DataFrame, n: int, batch_size: int = 32, ids_col: str = "ids",
                   key_col: str = "doc_key", sizes: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """Windows numbered globally in (doc_key, pos) order; batch = index // B.
    ``sizes`` (key, n_ids) spares encoding a second time for the counts; it is needed where
    keys repeat.  With ``shards`` (keys must not repeat) the result has so many partitions, each
    of whole batches in order: documents are cut where a shard ends and their ids are moved and
    sorted, a few bytes a window, before they become windows.

    The global index is built from per-document window counts (one row per
    document, prefix-summed in key order), so the windows themselves are
    never sorted globally.
    """
    if sizes is None:
        sizes = encoded.select(key_col, F.size(ids_col).alias("n_ids"))
    per_doc = sizes.select(key_col, F.greatest(F.col("n_ids") - n + 1, F.lit(0)).alias("_nw"))
    offs = C.ordered_offsets(per_doc, [key_col], "_nw", "_off")
    # attach the offset per document (one row each) before exploding windows
    with_off = encoded.join(offs, key_col).select(key_col, "_off", F.lit(0).alias("_pos"), F.col(ids_col).alias("_ids"))
    if shards:
        with_off = _cut_at_shards(with_off, n, batch_size, shards, key_col)
    w = (with_off.select(key_col, "_off", "_pos", F.posexplode_outer(TK.ngram_windows(F.col("_ids"), n)).alias("_nth", "_w"))
                 .filter(F.col("_nth").isNotNull()))
    ctx, label = TK.split_label(F.col("_w"), n)
    idx = F.col("_off") + F.col("_nth")
    w = w.withColumn("pos", F.col("_pos") + F.col("_nth"))
    return w.select(key_col, F.col("pos").cast("int").alias("pos"), ctx.alias("ctx"), label.cast("int").alias("label"),
                    idx.alias("sample_idx"), F.floor(idx / batch_size).cast("long").alias("batch_id"))


def _cut_at_shards(docs: DataFrame, n: int, batch_size: int, shards: int, key_col: str) -> DataFrame:
    """``docs`` (key, _off, _pos, _ids) cut into pieces of one shard each, shard after shard and
    in order; a piece carries the ids of its last window that lie beyond it."""
    has = F.size("_ids") - n + 1
    ends = F.col("_off") + has
    docs = docs.filter(has > 0)
    total = docs.agg(F.max(ends)).first()[0] or 0
    per = max(1, -(-(-(-total // batch_size)) // shards)) * batch_size
    first, last = F.floor(F.col("_off") / per).cast("int"), F.floor((ends - 1) / per).cast("int")
    cut = docs.select("*", F.explode(F.sequence(first, last)).alias("_shard"))
    start = F.greatest(F.col("_off"), F.col("_shard").cast("long") * per) - F.col("_off")
    stop = F.least(ends, (F.col("_shard").cast("long") + 1) * per) - F.col("_off")
    cut = cut.select("_shard", key_col, (F.col("_off") + start).alias("_off"), start.cast("int").alias("_pos"),
                     F.slice("_ids", (start + 1).cast("int"), (stop - start + n - 1).cast("int")).alias("_ids"))
    return cut.repartitionById(shards, F.col("_shard")).sortWithinPartitions("_off")


def steps_per_epoch(n_samples: int, batch_size: int = 32) -> int:
    """Tail batch is dropped from the step count (kept in the data)."""
    return n_samples // batch_size


# --- T12 ---------------------------------------------------------------------
def one_hot(df: DataFrame, label_col: str, size: int, out_col: str = "label_vec") -> DataFrame:
    """Sparse indicator vector of length ``size`` (Spark ML ``OneHotEncoder``,
    dropLast=False).  The encoder learns its width from the largest category it
    sees, so it is fitted on one row holding ``size - 1``."""
    from pyspark.ml.feature import OneHotEncoder
    enc = OneHotEncoder(inputCols=[label_col], outputCols=[out_col], dropLast=False,
                        handleInvalid="error")
    model = enc.fit(df.sparkSession.createDataFrame([(size - 1,)], f"{label_col} int"))
    return model.transform(df)


# --- T9b ---------------------------------------------------------------------
def pad_batch(fixed: DataFrame, pad_id: int, batch_col: str = "batch_id", ids_col: str = "input_ids") -> DataFrame:
    """Pad every example to the longest in its batch: ids padded with ``pad_id``,
    mask 0 on padding, labels -100 wherever the id equals the pad id (the
    causal collator's rule, so real end ids equal to the pad id are masked too)."""
    longest = F.max(F.size(ids_col)).over(W.partitionBy(batch_col))
    out = fixed.withColumn("_len", longest)
    pad = F.array_repeat(F.lit(pad_id), F.col("_len") - F.size(ids_col))
    padded = F.concat(F.col(ids_col), pad)
    mask = F.concat(F.transform(F.col(ids_col), lambda _: F.lit(1)),
                    F.array_repeat(F.lit(0), F.col("_len") - F.size(ids_col)))
    # the mask first: it needs the ids before they are padded
    return (out.withColumn("attention_mask", mask).withColumn("input_ids", padded)
               .withColumn("labels", F.transform(F.col("input_ids"),
                                                 lambda x: F.when(x == pad_id, F.lit(-100)).otherwise(x)))
               .drop("_len"))

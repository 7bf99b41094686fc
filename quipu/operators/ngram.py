"""Count-based next-token model, scoring and evaluation (M1-M5).

Re-aimed from the reference's neural models: the contract (context ids ->
next-id distribution -> loss / perplexity / accuracy) is kept, the model is an
interpolated (Jelinek-Mercer) n-gram model fitted with aggregates:

    P_-1(w)     = 1 / V
    P_k(w | c)  = lam * C(c_k, w) / C(c_k) + (1 - lam) * P_k-1(w | c)   if C(c_k) > 0
                = P_k-1(w | c)                                       otherwise

where ``c_k`` is the last k ids of the context (k = 0 is the unigram order).
Seen orders are nested (a suffix of a seen context is seen), so with m the
highest seen order the recursion unrolls to

    P = (1-lam)^m * sum_{k<=m} lam (1-lam)^-k r_k  +  (1-lam)^(m+1) / V

which is a plain ``sum`` and ``max`` per window: every aggregate stays a
fixed-width HashAggregate.  The prediction is the most frequent label at the
highest seen order (ties -> smallest id).

Shuffles: training shuffles each window once, by the last two ids of its context.  Packed
contexts are written as blocks (:mod:`ngram_blocks`): scoring sends each window to the blocks of
its last two ids, joins order 1 by (id, label) and broadcasts what the vocabulary bounds.  Other
contexts are one table; scoring explodes each window into its orders k >= 1 and joins twice
(total of ctx, count of (ctx, label)), by shuffles, hot contexts (a bounded broadcast list) salted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quipu.operators import corpus as C
from quipu.operators import ngram_blocks as NB

DEFAULT_LAMBDA = 0.5
UNIGRAM_BROADCAST_MAX = 2_000_000


def key_bits(vocab_size: int) -> int:
    return max(1, (max(vocab_size, 2) - 1).bit_length())


def packable(n: int, vocab_size: int) -> bool:
    """Contexts of n-1 ids fit one bigint when (n-1) * bits <= 62."""
    return (n - 1) * key_bits(vocab_size) <= 62


def pack_context(ctx: Column, bits: int) -> Column:
    """Context ids -> one bigint, the last id in the lowest bits."""
    return F.aggregate(ctx, F.lit(0).cast("long"), lambda acc, x: F.shiftleft(acc, bits) + x.cast("long"))


def unpack_context(key: Column, k: Column, bits: int) -> Column:
    """Inverse of :func:`pack_context` for a key holding k ids."""
    mask = F.lit((1 << bits) - 1).cast("long")
    return F.when(k == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.sequence(k - 1, F.lit(0), F.lit(-1)),
                    lambda i: F.call_function("shiftright", key, i * bits).bitwiseAND(mask).cast("int")))


def suffix(ctx: Column, k: Column, width: int, bits: int | None = None) -> Column:
    """Last k ids of a context of length ``width`` (k = 0 -> empty).

    With ``bits`` the context is a packed bigint and the suffix is a mask of
    its low ``k * bits`` bits; otherwise it is an array slice.
    """
    if bits is not None:
        return ctx.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k * bits) - 1)
    return F.when(k == 0, F.array().cast("array<int>")).otherwise(F.slice(ctx, F.lit(width) - k + 1, k))


def home_of(ctx: Column, bits: int | None) -> Column:
    """Where a context lives: its last two ids (all of it, if shorter).  Contexts of two or more
    ids live with all their suffixes down to two ids, so one shuffle serves these orders."""
    if bits is not None:
        return ctx.bitwiseAND(F.lit((1 << min(2 * bits, 62)) - 1).cast("long"))
    return F.xxhash64(F.when(F.size(ctx) <= 2, ctx).otherwise(F.slice(ctx, -2, 2)))


# --- M1 ---------------------------------------------------------------------
def packed_windows(encoded: DataFrame, n: int, vocab_size: int, ids_col: str = "ids",
                   key_col: str = "doc_key") -> DataFrame:
    """(doc_key, pos, ctx bigint, label) straight from id arrays: the packed
    key of every window is built with ``zip_with`` over n-1 shifted copies of
    the id array (O(n * L) per document, no per-window arrays).  Requires
    :func:`packable`; otherwise use :func:`quipu.operators.vocab.windows`."""
    if not packable(n, vocab_size):
        raise ValueError("contexts do not fit one bigint; use array windows")
    bits = key_bits(vocab_size)
    ids = F.col(ids_col)
    m = F.size(ids) - n + 1                       # number of windows
    shifted = [F.slice(ids, j + 1, m) for j in range(n - 1)]
    key = F.transform(shifted[0], lambda x: x.cast("long"))
    for j in range(1, n - 1):
        key = F.zip_with(key, shifted[j], lambda a, b: F.shiftleft(a, bits) + b.cast("long"))
    labels = F.slice(ids, n, m)
    pairs = F.when(m > 0, F.arrays_zip(key.alias("ctx"), labels.alias("label"))).otherwise(
        F.array().cast("array<struct<ctx:bigint,label:int>>"))
    ex = (encoded.select(key_col, F.posexplode_outer(pairs).alias("pos", "w"))
                 .filter(F.col("pos").isNotNull()))
    return ex.select(key_col, F.col("pos").cast("int").alias("pos"), F.col("w.ctx").alias("ctx"),
                     F.col("w.label").cast("int").alias("label"))


def context_key(windows: DataFrame, n: int, vocab_size: int) -> tuple[DataFrame, int | None]:
    """Replace ``ctx`` by its packed bigint when it fits (else keep the array);
    windows from :func:`packed_windows` are already packed."""
    if dict(windows.dtypes).get("ctx") == "bigint":
        return windows, key_bits(vocab_size)
    if packable(n, vocab_size):
        bits = key_bits(vocab_size)
        return windows.withColumn("ctx", pack_context(F.col("ctx"), bits)), bits
    return windows, None


@dataclass
class Packed:
    """Pinned blocks (:mod:`ngram_blocks`): ``high`` of the orders from two, ``ones`` of order 1, both
    bucketed by ``at``, ``zero`` of order 0; ``numbers`` has the buckets' numbers."""
    high: DataFrame
    ones: DataFrame
    zero: DataFrame
    numbers: list[int]


@dataclass
class NgramModel:
    """Fitted model: rows (home, k, ctx, label, n, ctx_n, best, nth); ``nth`` is a label's place
    (from 1) among those of its context, by falling count, then rising id, and ``best`` the first.
    ``ctx`` is packed when ``bits`` is set; then the model lies in ``blocks``, and ``rows`` are made
    of them, as a pinned table bucketed by ``home``, when first asked for."""
    table_rows: DataFrame | None
    n: int
    vocab_size: int
    bits: int | None
    blocks: Packed | None = None
    table_contexts: DataFrame | None = None

    @property
    def rows(self) -> DataFrame:
        if self.table_rows is None:
            self.table_rows = C.pin_bucketed(self.order_rows(), "model", "home")
        return self.table_rows

    def order_rows(self, k: int | None = None) -> DataFrame:
        """The rows, or those of one order, read once: nothing is written for them."""
        if self.table_rows is not None or self.blocks is None:
            return self.table_rows if k is None else self.table_rows.filter(F.col("k") == k)
        b = self.blocks
        blocks = b.zero if k == 0 else b.ones if k == 1 else b.high
        if k is None:
            blocks = b.high.unionByName(b.ones).unionByName(b.zero)
        elif k > 1:
            blocks = blocks.filter(F.col("k") == k)
        return NB.rows_of(blocks).select(home_of(F.col("ctx"), self.bits).alias("home"), "*")

    @property
    def counts(self) -> DataFrame:
        """(k, ctx, label, n)"""
        return self.rows.select("k", "ctx", "label", "n")

    @property
    def contexts(self) -> DataFrame:
        """(k, ctx, ctx_n, best); of blocks a pinned table, written when first asked for."""
        if self.table_rows is not None or self.blocks is None:
            return self.rows.filter("nth = 1").select("k", "ctx", "ctx_n", "best")
        if self.table_contexts is None:
            b = self.blocks
            self.table_contexts = C.pin_table(NB.contexts_of(b.high.unionByName(b.ones).unionByName(b.zero)), "contexts")
        return self.table_contexts

    def whole(self) -> tuple[int, int] | None:
        """All windows and the most frequent label: ctx_n and best of the empty context."""
        row = self.order_rows(0).filter("nth = 1").select("ctx_n", "best").first()
        return None if row is None else (int(row[0]), int(row[1]))

    def table(self) -> DataFrame:
        """Documented schema (k, ctx array<int>, label, n, ctx_n, best)."""
        t = self.order_rows()
        if self.bits is not None:
            t = t.withColumn("ctx", unpack_context(F.col("ctx"), F.col("k"), self.bits))
        return t.select("k", "ctx", "label", "n", "ctx_n", "best")


def _ranked(counts: DataFrame) -> DataFrame:
    """Each context's total, best label and order of labels, by one sort of its rows."""
    order = W.partitionBy("k", "ctx", "home").orderBy(F.desc("n"), F.asc("label"))
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return counts.select("home", F.col("k").cast("int").alias("k"), "ctx", F.col("label").cast("int").alias("label"), F.col("n").cast("long").alias("n"),
                         F.sum("n").over(whole).cast("long").alias("ctx_n"), F.first("label").over(whole).cast("int").alias("best"),
                         F.row_number().over(order).alias("nth"))


def fit_ngram_model(windows: DataFrame, n: int, vocab_size: int, pin: bool = True) -> NgramModel:
    """Counts for orders k = n-1 .. 0 from windows (ctx of n-1 ids, label).

    The windows are shuffled once, by the last two ids of their context, as rows of two
    numbers; the orders down to two are counted, totalled and ranked where they lie and
    written once.  Orders 1 and 0 are re-aggregated from the counts of order 2.  Contexts that
    pack are counted by sorting arrays and written as blocks (:mod:`ngram_blocks`).
    """
    width = n - 1
    windows, bits = context_key(windows.select("ctx", "label"), n, vocab_size)
    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    empty = F.lit(0).cast("long") if bits is not None else F.array().cast("array<int>")

    def low(rows: DataFrame, k: int) -> DataFrame:
        """Orders 1 and 0 from the rows (ctx of k ids, label, n)."""
        ones = rows.select(F.lit(0).alias("k"), empty.alias("ctx"), "label", "n")
        if k:
            ones = rows.select(suffix(F.col("ctx"), F.lit(1), k, bits).alias("ctx"), "label", "n").groupBy("ctx", "label").agg(F.sum("n").alias("n"))
            ones = ones.select("label", "n", F.inline(F.array(F.struct(F.lit(1).alias("k"), "ctx"), F.struct(F.lit(0).alias("k"), empty.alias("ctx")))))
        counts = ones.groupBy("k", "ctx", "label").agg(F.sum("n").alias("n"))
        return _ranked(counts.withColumn("home", home_of(F.col("ctx"), bits)))

    if pin and bits is not None and width >= 1:
        return NgramModel(None, n, vocab_size, bits, _packed(windows, width, bits, NB.bucket_numbers(windows.sparkSession, parts)))
    if width < 2:
        rows = low(windows.withColumn("n", F.lit(1).cast("long")), width)
        return NgramModel(C.pin_bucketed(rows, "model", "home") if pin else rows, n, vocab_size, bits)
    homed = windows.select(home_of(F.col("ctx"), bits).alias("home"), "ctx", "label").repartition(parts, "home")
    orders = F.array(*[F.struct(F.lit(k).alias("k"), suffix(F.col("ctx"), F.lit(k), width, bits).alias("ctx")) for k in range(width, 1, -1)])
    high = _ranked(homed.select("home", "label", F.inline(orders)).groupBy("home", "k", "ctx", "label").agg(F.count(F.lit(1)).alias("n")))
    if pin:
        rows = C.pin_bucketed(high, "model", "home", lambda written: low(written.filter("k = 2"), 2))
    else:
        rows = high.unionByName(low(high.filter("k = 2"), 2))
    return NgramModel(rows, n, vocab_size, bits)


def _packed(windows: DataFrame, width: int, bits: int, numbers: list[int]) -> Packed:
    home = home_of(F.col("ctx"), bits)
    high = NB.count_blocks(windows, home, range(width, 1, -1), bits, numbers, "model") if width > 1 else None
    twos = windows if high is None else NB.shortened(high.filter("k = 2"), bits)
    ones = NB.count_blocks(twos, home, (1,), bits, numbers, "model-1")
    alone = NB.shortened(ones, bits).groupBy("ctx", "label").agg(F.sum("n").alias("n"))
    zero = NB.count_blocks(alone, F.lit(0).cast("long"), (0,), bits, numbers[:1], "model-0")
    return Packed(ones.limit(0) if high is None else high, ones, zero, numbers)


# --- hot contexts ---------------------------------------------------------------
def hot_contexts(model: "NgramModel", min_count: int | None = None, fanout: int | None = None) -> DataFrame | None:
    """(k, ctx, fan) of contexts heavier than a task's fair share, or None.

    The fair share is the training windows divided by the shuffle partitions; a
    context of ``c`` windows goes to ``ceil(c / share)`` salts.  Training frequency
    predicts how many scored windows share the key.  Every order's counts add up
    to the training windows, so each order has fewer hot contexts than there are
    shuffle partitions: the list is bounded by (n - 1) x partitions and may be
    broadcast.  ``min_count`` and ``fanout`` override the share and the fan-out.
    """
    spark = model.contexts.sparkSession
    total = model.whole()
    if total is None:
        return None
    share = max(1, -(-int(total[0]) // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    fan = F.lit(fanout) if fanout else F.ceil(F.col("ctx_n") / F.lit(share))
    hot = model.contexts.filter((F.col("k") >= 1) & (F.col("ctx_n") >= F.lit(min_count or share + 1)))
    hot = hot.select("k", "ctx", fan.cast("int").alias("fan"))
    return hot if hot.limit(1).count() > 0 else None


def _with_model(probe: DataFrame, model: "NgramModel", hot: DataFrame | None, salt_cols: Sequence[str]) -> DataFrame:
    """``probe`` (.., k, ctx, label) with ctx_n, best and c_w, null where unseen.  The probe rows
    are the hashed side; Spark's default settings shuffle both sides by all keys, so the model's
    buckets aren't used here.  Rows of hot contexts are spread over their ``fan`` salts, and only those contexts' model rows are replicated."""
    side = model.rows.filter(F.col("k") >= 1)
    totals, counts = side.filter("nth = 1").select("home", "k", "ctx", "ctx_n", "best"), side.select("home", "k", "ctx", "label", F.col("n").alias("c_w"))
    at = ["home", "k", "ctx"]
    p = probe.withColumn("home", home_of(F.col("ctx"), model.bits))
    if hot is None:
        j = p.hint("shuffle_hash").join(totals, at, "left")
        return j.hint("shuffle_hash").join(counts, [*at, "label"], "left").drop("home")
    flag = F.broadcast(hot)
    cold = p.join(flag.drop("fan"), ["k", "ctx"], "left_anti")
    cold = cold.hint("shuffle_hash").join(totals, at, "left").hint("shuffle_hash").join(counts, [*at, "label"], "left").drop("home")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.col("fan")).cast("int")
    h = p.drop("home").join(flag, ["k", "ctx"]).withColumn("_salt", salt).drop("fan")

    def spread(rows: DataFrame) -> DataFrame:
        return rows.drop("home").join(flag, ["k", "ctx"]).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("fan") - 1))).drop("fan")

    h = h.join(spread(totals), ["k", "ctx", "_salt"], "left").join(spread(counts), ["k", "ctx", "label", "_salt"], "left").drop("_salt")
    return cold.unionByName(h)


def _orders_of_blocks(windows: DataFrame, model: "NgramModel", keys: list[str], combos: Sequence[tuple[float, int]]) -> DataFrame:
    """(keys, label, m_any, best_hi, _s<i>, _m<i>) of each window: orders from two are looked up in the
    blocks where their windows are sent; order 1 is joined by (id, label), and by the id with its totals, of
    which there are no more than ids."""
    b, width, bits = model.blocks, model.n - 1, model.bits
    probe = windows.select(*keys, "label", "ctx")
    high = tuple(range(width, 1, -1))
    if high:
        probe = NB.measured(probe, home_of(F.col("ctx"), bits), b.high, b.numbers, keys, high, bits)
    else:
        probe = probe.withColumns({"m_hi": F.lit(0), "best_hi": F.lit(0)})
    ones = NB.rows_of(b.ones)
    totals = ones.filter("nth = 1").select(F.col("ctx").alias("_one"), F.col("ctx_n").alias("t1"), F.col("best").alias("_best1"))
    if model.vocab_size <= UNIGRAM_BROADCAST_MAX:
        totals = F.broadcast(totals)
    probe = probe.withColumn("_one", suffix(F.col("ctx"), F.lit(1), width, bits)).join(totals, "_one", "left")
    counts = ones.select(F.col("ctx").alias("_one"), "label", F.col("n").alias("c1"))
    j = probe.join(counts, ["_one", "label"], "left")
    seen = {k: F.coalesce(F.col(f"t{k}"), F.lit(0)) > 0 for k in (1, *high)}

    def highest(most: int) -> Column:
        return F.coalesce(*[F.when(seen[k], F.lit(k)) for k in sorted(seen, reverse=True) if k <= most], F.lit(None).cast("int"))

    cols = [highest(width).alias("m_any"), F.when(F.col("m_hi") > 0, F.col("best_hi")).otherwise(F.col("_best1")).alias("best_hi")]
    for i, (lam, mo) in enumerate(combos):
        total = F.lit(0.0)
        for k in sorted(x for x in seen if x <= mo - 1):
            r = F.coalesce(F.col(f"c{k}"), F.lit(0)) / F.col(f"t{k}")
            total = total + F.when(seen[k], F.lit(lam) * F.pow(F.lit(1 - lam), F.lit(-k)) * r).otherwise(F.lit(0.0))
        cols += [total.alias(f"_s{i}"), highest(mo - 1).alias(f"_m{i}")]
    return j.select(*keys, "label", *cols)


# --- M2 / M4 -------------------------------------------------------------------
def score_windows(windows: DataFrame, model: NgramModel,
                  lambdas: Sequence[float] = (DEFAULT_LAMBDA,), max_orders: Sequence[int] | None = None,
                  key_cols: Sequence[str] = ("doc_key", "pos"), hot_min_count: int | None = None,
                  salt_fanout: int | None = None) -> DataFrame:
    """Per window: p and -ln p of its true label, and the predicted label.

    One output column pair ``p_<i>`` / ``nll_<i>`` per (lambda, max order)
    combination when several are given (grid search evaluates all of them in
    the same pass); with one combination the columns are ``p`` and ``nll``.
    """
    n, vocab_size, bits = model.n, model.vocab_size, model.bits
    width = n - 1
    keys = list(key_cols)
    windows, _ = context_key(windows, n, vocab_size)
    orders = list(max_orders) if max_orders else [n]
    combos = [(lam, mo) for mo in orders for lam in lambdas]
    for lam, _ in combos:
        if not 0.0 < lam < 1.0:
            raise ValueError("lambda must be in (0, 1)")

    # orders >= 1: explode, join (ctx, label) counts and (ctx) totals
    ex = windows.select(*keys, "label", "ctx",
                        F.explode(F.sequence(F.lit(1), F.lit(width))).alias("k")) if width >= 1 else None
    if model.blocks is not None:
        hi = _orders_of_blocks(windows, model, keys, combos)
    elif ex is not None:
        ex = ex.select(*keys, "label", F.col("k").cast("int").alias("k"),
                       suffix(F.col("ctx"), F.col("k"), width, bits).alias("ctx"))
        j = _with_model(ex, model, hot_contexts(model, hot_min_count, salt_fanout), keys)
        seen = F.col("ctx_n").isNotNull()
        r = F.coalesce(F.col("c_w"), F.lit(0)) / F.col("ctx_n")
        aggs = [F.max(F.when(seen, F.col("k"))).alias("m_any"),
                F.max_by(F.col("best"), F.when(seen, F.col("k"))).alias("best_hi")]
        for i, (lam, mo) in enumerate(combos):
            ok = seen & (F.col("k") <= mo - 1)
            aggs.append(F.sum(F.when(ok, F.lit(lam) * F.pow(F.lit(1 - lam), -F.col("k")) * r)
                              ).alias(f"_s{i}"))
            aggs.append(F.max(F.when(ok, F.col("k"))).alias(f"_m{i}"))
        hi = j.groupBy(*keys, "label").agg(*aggs)
    else:
        hi = windows.select(*keys, "label")

    # order 0: the unigram table is bounded by the vocabulary -> broadcast
    uni = model.order_rows(0).select("label", F.col("n").alias("c0"))
    if vocab_size <= UNIGRAM_BROADCAST_MAX:
        uni = F.broadcast(uni)
    n0, best0 = model.whole() or (0, 0)

    out = hi.join(uni.select("label", "c0"), "label", "left")
    r0 = (F.coalesce(F.col("c0"), F.lit(0)) / F.lit(n0)) if n0 > 0 else F.lit(0.0)
    cols = [*keys, "label"]
    pred = F.coalesce(F.col("best_hi"), F.lit(best0)) if ex is not None else F.lit(best0)
    cols.append(pred.cast("int").alias("pred"))
    for i, (lam, mo) in enumerate(combos):
        if ex is not None:
            m = F.coalesce(F.col(f"_m{i}"), F.lit(0))
            s = F.coalesce(F.col(f"_s{i}"), F.lit(0.0))
        else:
            m, s = F.lit(0), F.lit(0.0)
        p = F.pow(F.lit(1 - lam), m) * (F.lit(lam) * r0 + s) + F.pow(F.lit(1 - lam), m + 1) / F.lit(vocab_size)
        suffix_name = "" if len(combos) == 1 else f"_{i}"
        cols += [p.alias(f"p{suffix_name}"), (-F.log(p)).alias(f"nll{suffix_name}")]
    return out.select(*cols)


def predict_next(model: NgramModel) -> DataFrame:
    """M4 on the model itself: most frequent label per (k, ctx), ties -> smallest id."""
    return model.contexts.select("k", "ctx", F.col("best").alias("pred"), "ctx_n")


# --- M3 ---------------------------------------------------------------------
def eval_documents(scored: DataFrame, key_col: str = "doc_key") -> DataFrame:
    """Per document loss (mean nll), ppl = e^loss, accuracy, scored tokens."""
    return scored.groupBy(key_col).agg(
        F.avg("nll").alias("loss"), F.exp(F.avg("nll")).alias("ppl"),
        F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("num_tokens"))


def eval_corpus(per_doc: DataFrame, weight: str = "scored") -> DataFrame:
    """loss = sum(loss * tokens) / sum(tokens); perplexity = e^loss;
    accuracy over all tokens.  weight='reference' counts one more token per
    document (the reference weights by the full length while averaging one
    fewer prediction)."""
    t = F.col("num_tokens") + (F.lit(1) if weight == "reference" else F.lit(0))
    agg = per_doc.agg((F.sum(F.col("loss") * t) / F.sum(t)).alias("loss"),
                      (F.sum(F.col("accuracy") * F.col("num_tokens")) / F.sum("num_tokens")).alias("accuracy"),
                      F.sum("num_tokens").alias("num_tokens"))
    return agg.select(F.exp("loss").alias("perplexity"), "loss", "accuracy", "num_tokens")


def perplexity_batches(scored_batched: DataFrame, batch_size: int, drop_tail: bool = True) -> DataFrame:
    """e^(mean nll) over whole batches (the tail batch, which isn't full, is
    dropped as the reference's ``steps = N // B`` does), plus accuracy.  One
    pass: sums by batch, then over the batches."""
    by_batch = scored_batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("nll").alias("nll"), F.count_if(F.col("pred") == F.col("label")).alias("hits"))
    if drop_tail:
        by_batch = by_batch.filter(F.col("n") == batch_size)
    mean = F.sum("nll") / F.sum("n")
    return by_batch.agg(mean.alias("loss"), F.exp(mean).alias("perplexity"), (F.sum("hits") / F.sum("n")).alias("accuracy"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias("num_tokens"))


# --- M5 ---------------------------------------------------------------------
def grid_search(windows_eval: DataFrame, model: NgramModel,
                lambdas: Sequence[float], max_orders: Sequence[int], key_cols=("doc_key", "pos")) -> DataFrame:
    """Evaluate every (lambda, order) candidate in one scoring pass; the best is
    the lowest mean loss, ties -> the first candidate in the given order."""
    combos = [(lam, mo) for mo in max_orders for lam in lambdas]
    scored = score_windows(windows_eval, model, lambdas, max_orders, key_cols)
    means = scored.agg(*[F.avg(f"nll_{i}").alias(f"l{i}") for i in range(len(combos))]) if len(combos) > 1 \
        else scored.agg(F.avg("nll").alias("l0"))
    stacked = F.array(*[F.struct(F.coalesce(f"l{i}", F.lit(float("inf"))).alias("rank"), F.lit(i).alias("cand"), F.lit(float(lam)).alias("lam"),
                                 F.lit(int(mo)).alias("max_order"), F.col(f"l{i}").alias("loss")) for i, (lam, mo) in enumerate(combos)])
    rows = means.select(F.explode(stacked).alias("s"), F.array_min(stacked)["cand"].alias("best"))
    return rows.select("s.cand", "s.lam", "s.max_order", "s.loss", (F.col("s.cand") == F.col("best")).alias("is_best"))

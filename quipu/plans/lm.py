"""Language-model data preparation on whole documents.

documents -> 'rnn' clean -> word tokens -> boundary padding -> counts -> capped
vocabulary -> encode -> n-gram windows.  The tokenized documents are
hash-partitioned by ``doc_key`` once, so every later per-document regroup
(encode, decode, per-document evaluation) runs without another exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.functions import text as T
from quipu.functions import tokens as TK
from quipu.operators import corpus as C
from quipu.operators import vocab as VO
from quipu.plans import oracle as O
from quipu.sources import fixtures as X

NGRAM = 5
MAX_VOCAB = 10000


def doc_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenized_docs(spark: SparkSession, sf_dir: str, n: int = NGRAM, profile: str = "rnn") -> DataFrame:
    """Raw texts are hash-partitioned by doc_key *before* the regex work: one
    shuffle of raw text (cheaper than shuffling exploded tokens), after which
    cleaning and tokenizing use every core and per-doc regroups are local."""
    d = (X.load(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_key"), "text")
         .repartition(doc_partitions(spark), "doc_key"))
    toks = TK.pad_boundaries(TK.tokenize_words(T.clean(F.col("text"), profile)), n)
    return C.compute_once(d, ["doc_key"], tokens=toks)


def lm_inputs(spark: SparkSession, sf_dir: str, n: int = NGRAM, max_vocab: int = MAX_VOCAB):
    """(tokenized docs, vocabulary, encoded docs).  The tokens are pinned, bucketed by document,
    so that texts are cleaned and tokenized once and regrouped in place; the vocabulary (bounded
    by its cap) is pinned so its size and both joins reuse one counting pass."""
    docs = C.pin_bucketed(tokenized_docs(spark, sf_dir, n), "tokens", "doc_key")
    vocab = VO.build_vocab(VO.token_counts(docs), max_vocab).checkpoint(eager=True)
    encoded = VO.encode(docs, vocab, max_vocab)
    return docs, vocab, encoded


def encoded_table(spark: SparkSession, sf_dir: str, n: int = NGRAM, max_vocab: int = MAX_VOCAB):
    """(tokenized docs, vocabulary, encoded docs), the ids pinned (a few bytes a token) for
    several readers."""
    docs, vocab, encoded = lm_inputs(spark, sf_dir, n, max_vocab)
    return docs, vocab, C.pin_table(encoded, "encoded")


def token_sizes(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame | None:
    """(doc_key, n_ids) of each row where keys repeat; None where they don't, as the encoded
    documents then have the same sizes and no text is cleaned again."""
    keys = X.load(spark, sf_dir, "documents").groupBy("doc_id").count()
    return None if keys.filter("count > 1").isEmpty() else docs.select("doc_key", F.size("tokens").alias("n_ids"))


# ---------------------------------------------------------------------------
# SQL oracle pieces (DuckDB)
# ---------------------------------------------------------------------------
def sql_tokens(text_expr: str) -> str:
    spaced = O.rx(text_expr, TK.CONTRACTION_PATTERN, r"\1 \2")
    return f"regexp_extract_all({spaced}, {O.lit(TK.WORD_TOKEN_PATTERN)})"


def sql_pad(list_expr: str, n: int) -> str:
    k = 1 if n == 1 else n - 1
    return f"list_concat(repeat(['<s>'], {k}), {list_expr}, repeat(['</s>'], {k}))"


def sql_lm_ctes(n: int = NGRAM, max_vocab: int | str = MAX_VOCAB) -> str:
    return f"""
docs AS (SELECT doc_id AS doc_key, {sql_pad(sql_tokens(O.clean_rnn('text')), n)} AS tokens FROM documents),
ex AS (SELECT doc_key, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM docs),
counts AS (SELECT token, count(*) AS n,
                  min(CAST(doc_key AS HUGEINT) * {1 << VO.POS_BITS} + pos) AS first_seen
           FROM ex GROUP BY token),
ranked AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, first_seen) + 1 AS INTEGER) AS token_id, n
           FROM counts ORDER BY n DESC, first_seen LIMIT ({max_vocab} - 2)),
vocab AS (SELECT '<UNK>' AS token, 1 AS token_id, CAST(0 AS BIGINT) AS n UNION ALL SELECT * FROM ranked),
enc_ex AS (SELECT e.doc_key, e.pos, coalesce(v.token_id, 1) AS id FROM ex e LEFT JOIN vocab v ON e.token = v.token),
encoded AS (SELECT doc_key, list(id ORDER BY pos) AS ids FROM enc_ex GROUP BY doc_key),
win AS (SELECT doc_key, CAST(unnest(range(greatest(len(ids) - {n} + 1, 0))) AS INTEGER) AS pos, ids FROM encoded),
windows AS (SELECT doc_key, pos, list_slice(ids, pos + 1, pos + {n - 1}) AS ctx,
                   CAST(ids[pos + {n}] AS INTEGER) AS label FROM win)"""


def model_windows(encoded: DataFrame, vocab_size: int, n: int = NGRAM) -> DataFrame:
    """Windows for the model: packed bigint contexts when ids fit, else arrays."""
    from quipu.operators import ngram as NG
    if NG.packable(n, vocab_size):
        return NG.packed_windows(encoded, n, vocab_size)
    return VO.windows(encoded, n)


def lm_split(spark: SparkSession, sf_dir: str, encoded: DataFrame, frac: float = 0.95) -> DataFrame:
    """Label encoded docs train/eval by position; the threshold comes from the
    source's key column alone (a one-column scan), not from the encoded frame."""
    from quipu.operators import corpus as C
    keys = X.load(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_key"))
    cut = C.split_threshold(keys, frac, "doc_key")
    is_train = F.lit(True) if cut is None else F.col("doc_key") < F.lit(cut)
    return encoded.withColumn("split", F.when(is_train, "train").otherwise("eval"))


def sql_model_ctes(n: int = NGRAM, lam: float = 0.5, frac: float = 0.95) -> str:
    w = n - 1
    return f""",
ndocs AS (SELECT count(*) AS nd FROM encoded),
dsplit AS (SELECT doc_key, CASE WHEN row_number() OVER (ORDER BY doc_key) - 1
                  < CAST(floor((SELECT nd FROM ndocs) * {frac}) AS BIGINT) THEN 'train' ELSE 'eval' END AS split
           FROM encoded),
wtrain AS (SELECT w.* FROM windows w JOIN dsplit s ON w.doc_key = s.doc_key WHERE s.split = 'train'),
weval AS (SELECT w.* FROM windows w JOIN dsplit s ON w.doc_key = s.doc_key WHERE s.split = 'eval'),
tex AS (SELECT unnest(range(0, {w + 1})) AS k, ctx, label FROM wtrain),
tex2 AS (SELECT CAST(k AS INTEGER) AS k, CASE WHEN k = 0 THEN CAST([] AS INTEGER[])
                ELSE list_slice(ctx, {w} - k + 1, {w}) END AS ctx, label FROM tex),
mcounts AS (SELECT k, ctx, label, count(*) AS n FROM tex2 GROUP BY k, ctx, label),
model AS (SELECT k, ctx, label, n, sum(n) OVER (PARTITION BY k, ctx) AS ctx_n,
                 CAST(first_value(label) OVER (PARTITION BY k, ctx ORDER BY n DESC, label) AS INTEGER) AS best
          FROM mcounts),
vsize AS (SELECT max(token_id) + 1 AS v FROM vocab),
eex AS (SELECT doc_key, pos, label, ctx, unnest(range(1, {w + 1})) AS k FROM weval),
eex2 AS (SELECT doc_key, pos, label, CAST(k AS INTEGER) AS k, list_slice(ctx, {w} - k + 1, {w}) AS c FROM eex),
cx AS (SELECT k, ctx, ctx_n, best FROM model WHERE label = best AND k >= 1),
ej AS (SELECT e.doc_key, e.pos, e.label, e.k, cx.ctx_n, cx.best, m.n AS c_w FROM eex2 e
       LEFT JOIN cx ON e.k = cx.k AND e.c = cx.ctx
       LEFT JOIN model m ON m.k = e.k AND m.ctx = e.c AND m.label = e.label),
hi AS (SELECT doc_key, pos, label,
              max(k) FILTER (WHERE ctx_n IS NOT NULL) AS m,
              arg_max(best, k) FILTER (WHERE ctx_n IS NOT NULL) AS best_hi,
              sum({lam} * pow({1 - lam}, -k) * coalesce(c_w, 0) / ctx_n) FILTER (WHERE ctx_n IS NOT NULL) AS s
       FROM ej GROUP BY doc_key, pos, label),
tot AS (SELECT ctx_n AS n0, best AS best0 FROM model WHERE k = 0 AND label = best),
scored AS (SELECT h.doc_key, h.pos, h.label,
                  CAST(coalesce(h.best_hi, (SELECT best0 FROM tot)) AS INTEGER) AS pred,
                  pow({1 - lam}, coalesce(h.m, 0)) * ({lam} * coalesce(u.n, 0) / (SELECT n0 FROM tot) + coalesce(h.s, 0))
                    + pow({1 - lam}, coalesce(h.m, 0) + 1) / (SELECT v FROM vsize) AS p
           FROM hi h LEFT JOIN (SELECT label, n FROM model WHERE k = 0) u ON h.label = u.label),
scored2 AS (SELECT *, -ln(p) AS nll FROM scored),
perdoc AS (SELECT doc_key, avg(nll) AS loss, exp(avg(nll)) AS ppl,
                  avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS num_tokens
           FROM scored2 GROUP BY doc_key)"""


def sql_uniform(*parts: str) -> str:
    """U(0,1) from the first 52 bits of the md5 of the parts joined by ``|``."""
    text = " || '|' || ".join(parts)
    return (f"((CAST(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE))"
            " / 4503599627370496)")


def sql_prompt_ids(prompts: str, out: str, n: int = NGRAM, keys: str = "seq_id") -> str:
    """Prompts (keys, prompt) padded at the start, tokenized and encoded."""
    return f"""
{out}_tok AS (SELECT {keys}, list_concat(repeat(['<s>'], {n - 1}), {sql_tokens('lower(prompt)')}) AS tokens FROM {prompts}),
{out}_ex AS (SELECT {keys}, unnest(range(len(tokens))) AS pos, unnest(tokens) AS token FROM {out}_tok),
{out} AS (SELECT {keys}, list(CAST(coalesce(v.token_id, 1) AS INTEGER) ORDER BY pos) AS ids
          FROM {out}_ex p LEFT JOIN vocab v ON p.token = v.token GROUP BY {keys})"""


def sql_generated_text(gen: str, prompts: str, out: str, keys: str = "seq_id") -> str:
    """(keys, text): prompt and the words of its finished continuation."""
    return f"""
{out}_ex AS (SELECT {keys}, unnest(range(n_new)) AS pos, unnest(list_slice(ids, n_prompt + 1, n_prompt + n_new)) AS id FROM {gen} WHERE done),
{out}_words AS (SELECT {keys}, array_to_string(list(CASE WHEN v.token = '_' THEN '' ELSE v.token END ORDER BY pos), ' ') AS words
                FROM {out}_ex JOIN vocab v ON id = v.token_id GROUP BY {keys}),
{out} AS (SELECT {keys}, CASE WHEN length(coalesce(words, '')) > 0 THEN prompt || ' ' || words ELSE prompt END AS text
          FROM {prompts} LEFT JOIN {out}_words USING ({keys}))"""


def sql_sampler_ctes() -> str:
    """The fitted model as tables that every sampling step looks up."""
    return """
stops AS (SELECT list(token_id) AS l FROM vocab WHERE token IN ('<s>', '</s>')),
seen AS MATERIALIZED (SELECT k, ctx FROM model WHERE label = best),
following AS MATERIALIZED (SELECT k, ctx, label AS id, n / ctx_n AS p FROM model)"""


def sql_sampled(name: str, start: str, steps: int, seed: int, temperature: float, k: int, p: float, repetition: float,
                no_repeat: int, keys: tuple[str, ...] = ("seq_id",), n: int = NGRAM) -> str:
    """Recursive member ``name`` (keys, ids, n_prompt, n_new, done): seeded sampled continuation of
    the encoded prompts in ``start``; the candidates of the highest seen order, or all ids where
    that leaves none, through W2, W5, W6, W1, W3, W4 and W7."""
    ks, m = ", ".join(keys), no_repeat
    u = sql_uniform(*keys, "n_new", f"'{seed}'", "id")
    share = f"q / sum(q) OVER (PARTITION BY {ks})"
    return f"""
{name} AS (
  SELECT {ks}, ids, len(ids) AS n_prompt, 0 AS n_new, false AS done FROM {start}
  UNION ALL
  (WITH g AS (SELECT *, list_transform(list_filter(range(1, len(ids) - {m - 2}), lambda i: ids[i:i + {m - 2}] = ids[len(ids) - {m - 2}:]),
                                       lambda i: ids[i + {m - 1}]) AS banned FROM {name} WHERE NOT done),
  h AS (SELECT {ks}, arg_max(ctx, k) AS ctx, max(k) AS k FROM (
          SELECT {ks}, CAST(k AS INTEGER) AS k, list_slice(ids, len(ids) - k + 1, len(ids)) AS ctx FROM g, range(1, {n}) t(k))
        SEMI JOIN seen USING (k, ctx) GROUP BY {ks}),
  c AS (SELECT {ks}, id, p FROM h JOIN following USING (k, ctx)),
  x1 AS (SELECT c.*, g.n_new, list_contains(g.banned, id) AS bad, list_contains(g.ids, id) AS old FROM c JOIN g USING ({ks}) WHERE id <> 0),
  able AS (SELECT DISTINCT {ks} FROM x1 WHERE NOT bad),
  x0 AS (SELECT {ks}, id, p, n_new, list_contains(banned, id) AS bad, list_contains(ids, id) AS old
         FROM (SELECT * FROM g ANTI JOIN able USING ({ks})), following WHERE k = 0 AND id <> 0),
  x AS (SELECT * FROM x1 SEMI JOIN able USING ({ks}) UNION ALL SELECT * FROM x0),
  w2 AS (SELECT *, p / sum(p) OVER (PARTITION BY {ks}) AS q FROM x),
  w5 AS (SELECT * REPLACE ({share} AS q) FROM (SELECT * REPLACE (CASE WHEN old THEN pow(q, {repetition}) ELSE q END AS q) FROM w2)),
  w6 AS (SELECT * REPLACE ({share} AS q) FROM w5 WHERE NOT bad),
  w1 AS (SELECT * REPLACE ({share} AS q) FROM (SELECT * REPLACE (exp(ln(q + 1e-8) / {temperature}) AS q) FROM w6)),
  w3 AS (SELECT * REPLACE ({share} AS q) FROM (
           SELECT *, row_number() OVER (PARTITION BY {ks} ORDER BY q DESC, id) AS r FROM w1) WHERE r <= {k}),
  w4 AS (SELECT *, coalesce(round(sum(q) OVER (PARTITION BY {ks} ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 12), 0) AS before FROM w3),
  w7 AS (SELECT {ks}, max({{'g': ln(q) - ln(-ln({u})), 'id': id}}).id AS nxt FROM w4 WHERE before < {p} GROUP BY {ks})
  SELECT {ks}, CASE WHEN stop THEN ids ELSE list_append(ids, nxt) END, n_prompt, CASE WHEN stop THEN n_new ELSE n_new + 1 END,
         stop OR n_new + 1 >= {steps}
  FROM (SELECT g.*, w7.nxt, w7.nxt IS NULL OR list_contains((SELECT l FROM stops), w7.nxt) AS stop FROM g LEFT JOIN w7 USING ({ks}))))"""


def sql_beam(name: str, start: str, width: int, steps: int, repetition: float, no_repeat: int, digits: int, n: int = NGRAM) -> str:
    """Recursive member ``name`` (seq_id, step, beam, ids, n_prompt, n_new, score, done): the beams
    of every prompt after each step; prompts whose beams are all done aren't carried on."""
    m = no_repeat
    penalized = f"CASE WHEN list_contains(ids, id) THEN ln(p) * {repetition} ELSE ln(p) END"
    return f"""
{name} AS (
  SELECT seq_id, 0 AS step, 0::bigint AS beam, ids, len(ids) AS n_prompt, 0 AS n_new, 0::double AS score, false AS done FROM {start}
  UNION ALL
  (WITH now AS (SELECT * FROM {name} WHERE seq_id IN (SELECT seq_id FROM {name} WHERE NOT done)),
  a AS (SELECT *, list_transform(list_filter(range(1, len(ids) - {m - 2}), lambda i: ids[i:i + {m - 2}] = ids[len(ids) - {m - 2}:]),
                                 lambda i: ids[i + {m - 1}]) AS banned FROM now WHERE NOT done),
  h AS (SELECT seq_id, beam, arg_max(ctx, k) AS ctx, max(k) AS k FROM (
          SELECT seq_id, beam, CAST(k AS INTEGER) AS k, list_slice(ids, len(ids) - k + 1, len(ids)) AS ctx FROM a, range(1, {n}) t(k))
        SEMI JOIN seen USING (k, ctx) GROUP BY seq_id, beam),
  c AS (SELECT seq_id, beam, id, p FROM h JOIN following USING (k, ctx)),
  x1 AS (SELECT seq_id, beam, id, {penalized} AS lp FROM c JOIN a USING (seq_id, beam) WHERE NOT list_contains(banned, id)),
  able AS (SELECT DISTINCT seq_id, beam FROM x1),
  x0 AS (SELECT seq_id, beam, id, {penalized} AS lp FROM (SELECT * FROM a ANTI JOIN able USING (seq_id, beam)), following
         WHERE k = 0 AND NOT list_contains(banned, id)),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq_id, beam ORDER BY lp DESC, id) AS r
                          FROM (SELECT * FROM x1 UNION ALL SELECT * FROM x0)) WHERE r <= {width}),
  grown AS (SELECT a.seq_id, a.step, a.beam, a.n_prompt, a.ids, a.n_new, a.score + coalesce(lp, 0) AS score, id AS next_id,
                   id IS NULL OR list_contains((SELECT l FROM stops), id) AS stop FROM a LEFT JOIN best USING (seq_id, beam)),
  pool AS (SELECT seq_id, step, beam AS parent, NULL::integer AS next_id, ids, n_prompt, n_new, score, done FROM now WHERE done
           UNION ALL
           SELECT seq_id, step, beam, next_id, CASE WHEN stop THEN ids ELSE list_append(ids, next_id) END, n_prompt,
                  CASE WHEN stop THEN n_new ELSE n_new + 1 END, score, stop OR n_new + 1 >= {steps} FROM grown),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY round(score, {digits}) DESC, parent, next_id NULLS FIRST) - 1 AS beam FROM pool)
  SELECT seq_id, step + 1, beam, ids, n_prompt, n_new, score, done FROM ranked WHERE beam < {width}))"""

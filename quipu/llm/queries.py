"""The registered queries opN_<name>: thin wrappers that apply each operator to its whole
table and derive the result columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: word 5-grams, Jaccard similarity 0.8 or more."""
    from quipu.llm.ngram_join import similarity_classes
    return similarity_classes(_read(spark, sf_dir, "documents"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of the whole embeddings table, cosine 0.95 or more."""
    from quipu.llm.near_vectors import near_duplicates
    return near_duplicates(_read(spark, sf_dir, "embeddings"), 0.95)


def op4_inner_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every 50th vector with all others."""
    from quipu.llm.inner_topk import top_k
    return top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of every document."""
    from quipu.llm import lang_id
    docs = _read(spark, sf_dir, "documents")
    model = lang_id.learn(docs, lang_id.vocabulary_of(tokenizer_path("piece_bpe_32k.model")))
    return lang_id.predict(docs, model)


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score all documents by a model learned from those not held out."""
    from quipu.llm.pitman_yor import score_documents
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return score_documents(_read(spark, sf_dir, "documents"), held_out)


def op6_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove windows of 50 words that an earlier document holds from all documents."""
    from quipu.llm.span_dedup import remove_repeats
    return remove_repeats(_read(spark, sf_dir, "documents"), texts=False).drop("kept")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of all pages."""
    from quipu.llm.html_text import extract_text
    return extract_text(_read(spark, sf_dir, "pages"))


def op8_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove strings of 400 bytes that start elsewhere too from all documents."""
    from quipu.llm.byte_dedup import remove_repeats
    return remove_repeats(_read(spark, sf_dir, "documents")).drop("spans")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 tokens."""
    from quipu.llm.packing import pack_documents
    return pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents with the SentencePiece model."""
    from quipu.llm.piece_bpe import encode_digests
    return encode_digests(_read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draw a quarter of the documents of 20 words or more towards the benchmark's words."""
    from quipu.llm.importance import resample
    return resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-byte product codes of the whole embeddings table, with errors and the codebooks' hash."""
    from quipu.llm.vector_codes import compress
    return compress(_read(spark, sf_dir, "embeddings")).drop("label")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of all documents and the verdict of the rules on repeated substrings."""
    from quipu.llm.quality_rules import quality
    return quality(_read(spark, sf_dir, "documents")).drop("repeated_chars", "longest_repeat", "n_repeats", "from", "to")


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_near_vectors, op3_language_id, op4_inner_topk, op5_pitman_yor, op6_span_dedup, op7_html_text, op8_byte_dedup, op9_best_fit_packing, op10_sentencepiece, op11_importance_resampling, op12_vector_codes,
                                   op13_quality_rules)}


def _codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Rounds of assigning and moving, written out one after the other."""
    def assigned(name: str, book: str) -> str:
        return f"""
{name} AS MATERIALIZED (
  SELECT row, part, any_value(label) AS label, any_value(vec_id) AS vec_id, min({{'d': d, 'k': k}}) AS best, any_value(x) AS x FROM (
    SELECT p.row, p.part, p.label, p.vec_id, p.x, c.k, p.size + c.size - 2 * list_dot_product(p.x, c.x) AS d
    FROM p JOIN {book} c USING (part)) GROUP BY row, part)"""

    steps = []
    for r in range(rounds):
        steps.append(assigned(f"a{r}", f"c{r}"))
        steps.append(f"""
m{r} AS (
  SELECT part, k, list(v ORDER BY j) AS x FROM (
    SELECT part, k, j, floor(sum(v) / count(*)) AS v FROM (
      SELECT part, best.k AS k, unnest(x) AS v, unnest(range(len(x))) AS j FROM a{r}) GROUP BY part, k, j) GROUP BY part, k),
c{r + 1} AS MATERIALIZED (
  SELECT part, k, x, list_dot_product(x, x) AS size FROM (
    SELECT c.part, c.k, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (part, k)))""")
    steps.append(assigned("last", f"c{rounds}"))
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, [floor(1024 * x::double) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len([x for x in embedding if NOT isfinite(x)]) = 0),
p AS MATERIALIZED (
  SELECT row, vec_id, label, part, x, list_dot_product(x, x) AS size FROM (
    SELECT row, vec_id, label, part, e[part * len(e) // {parts} + 1:(part + 1) * len(e) // {parts}] AS x FROM v, range({parts}) t(part))),
c0 AS MATERIALIZED (SELECT part, row - 1 AS k, x, size FROM p WHERE row <= {entries}),{",".join(steps)},
digest AS (
  SELECT sha256(string_agg(v::bigint::varchar, ',' ORDER BY part, k, j)) AS h FROM (
    SELECT part, k, unnest(x) AS v, unnest(range(len(x))) AS j FROM c{rounds})),
code AS (
  SELECT row, any_value(vec_id) AS vec_id, any_value(label) AS label,
         string_agg(lower(lpad(hex(best.k), 2, '0')), '' ORDER BY part) AS code, sum(best.d)::bigint AS error FROM last GROUP BY row)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::bigint AS label_error, (SELECT h FROM digest) AS codebooks_sha256 FROM code"""


def _quality_sql(least: int = 10, most_covered: int = 20, longest: int = 50) -> str:
    """Repeats of ``least`` words or more cover what their windows of ``least`` words cover."""
    def windows(name: str, size: int) -> str:
        return f"""
w{name} AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS often FROM (
    SELECT doc_id, i, array_to_string(words[i:i + {size - 1}], ' ') AS g FROM (
      SELECT doc_id, words, unnest(range(1, len(words) - {size - 2})) AS i FROM w WHERE len(words) >= {size}))),
in{name} AS (SELECT DISTINCT doc_id, unnest(range(i, i + {size})) AS i FROM w{name} WHERE often > 1)"""
    return f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
{windows("3", 3)},{windows("_least", least)},{windows("_long", longest + 1)},
n3 AS (SELECT doc_id, count(*) AS n FROM in3 GROUP BY doc_id),
gone AS (SELECT doc_id, sum(length(words[i])) AS chars FROM in_least JOIN w USING (doc_id) GROUP BY doc_id),
long AS (SELECT DISTINCT doc_id FROM w_long WHERE often > 1),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, len(words)::bigint AS n_words, coalesce(list_sum([length(x) for x in words]), 0)::bigint AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols, coalesce(lines.n, 0)::bigint AS n_dup_lines,
         coalesce(n3.n, 0)::bigint AS n_repeat_words, coalesce(gone.chars, 0) AS chars, long.doc_id IS NOT NULL AS too_long
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN n3 USING (doc_id) LEFT JOIN gone USING (doc_id) LEFT JOIN long USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * chars <= {most_covered} * word_chars AND NOT too_long AS kept FROM judged"""


# DuckDB SQL; operators that SQL can't express are tested against brute force instead
ORACLE: dict[str, str] = {
    "op1_ngram_join": """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(words[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
ordered AS (SELECT s.doc_id, g, row_number() OVER (PARTITION BY s.doc_id ORDER BY f, g) AS k FROM s JOIN (SELECT g, count(*) AS f FROM s GROUP BY g) USING (g)),
pre AS (SELECT doc_id, g FROM ordered JOIN n USING (doc_id) WHERE k <= n - ceil(0.8 * n) + 1),
pair AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM pre a JOIN pre b ON a.g = b.g AND a.doc_id < b.doc_id),
both_ AS (SELECT a, b, count(*) AS o FROM pair JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g GROUP BY a, b),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 180 * o >= 80 * (x.n + y.n)),
sym AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN sym l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE a = d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)""",
    "op2_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, [x::double for x in embedding] AS e,
         coalesce(embedding IS NOT NULL AND list_count(embedding) = len(embedding)
                  AND len([x for x in embedding if NOT isfinite(x)]) = 0
                  AND len([x for x in embedding if x <> 0]) > 0, false) AS ok
  FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_sum([x * x for x in e])) AS size FROM v WHERE ok AND vec_id IS NOT NULL),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
part AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, part.component_id, e.vec_id = part.component_id AS kept
FROM embeddings e JOIN part USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a) n USING (vec_id)""",
    "op6_span_dedup": """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
firsts AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN firsts USING (h) WHERE first < doc_id),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(w.words)::bigint AS n_words, (len(w.words) - coalesce(kept.n, 0))::bigint AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op4_inner_topk": """
WITH v AS (
  SELECT vec_id, [floor(256 * x::double)::bigint for x in embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len([x for x in embedding if NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([x[1] * x[2] for x in list_zip(q.e, c.e)])::bigint AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5""",
    "op12_vector_codes": _codes_sql(),
    "op13_quality_rules": _quality_sql(),
    "op11_importance_resampling": """
WITH tbl AS (SELECT list(c ORDER BY i) AS steps FROM (
  SELECT i, list_reduce(list_concat([i], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::bigint) ELSE c >> 1 END) AS c
  FROM (SELECT i::bigint AS i FROM range(256) r(i)))),
texts AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark),
words AS (
  SELECT row_number() OVER () AS row, side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
feature AS MATERIALIZED (
  SELECT row, side, doc_id, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))])) AS f FROM words),
distinct_f AS (SELECT f, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t, hex(encode(f)) AS h FROM feature GROUP BY f),
crc AS MATERIALIZED (
  SELECT f, s, t, xor(list_reduce(list_concat([4294967295::bigint], [('0x' || substr(h, 2 * i + 1, 2))::bigint for i in range(0, len(h) // 2)]),
                            lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 10000 AS bucket FROM distinct_f, tbl),
buckets AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM crc GROUP BY bucket),
sums AS (SELECT sum(s)::double AS big_s, sum(t)::double AS big_t FROM buckets),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (big_s + 10000) / ((s + 1) * (big_t + 10000))))::bigint AS g FROM buckets, sums),
weighed AS (SELECT doc_id, count(*) AS n, sum(g) AS total FROM feature JOIN crc USING (f) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id),
scored AS (
  SELECT words.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(floor(total / n), 0)::bigint AS weight,
         ('0x' || substr(sha256('7:' || words.doc_id), 1, 8))::bigint AS h FROM words LEFT JOIN weighed USING (doc_id) WHERE side = 'd'),
noisy AS (SELECT doc_id, n_words, n_features::bigint AS n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint AS score FROM scored),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM noisy WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM noisy LEFT JOIN ranked USING (doc_id)""",
}

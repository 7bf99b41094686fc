"""Registered queries against their SQL oracles (DuckDB) on the smallest tables,
plus the driver smoke entry."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
FAST = ["curate_corpus", "curation_funnel", "split_ordered", "corpus_head", "clean_rnn", "clean_toy",
        "clean_tsv", "clean_lm_pages", "clean_generated", "quality_verdict", "select_candidates",
        "rejection_report", "attempt_summary", "numbered_list", "prompt_cycle", "boilerplate_match",
        "strip_prompt", "tokenize_words", "token_counts", "build_vocab", "encode", "decode", "ngram_windows",
        "assign_batches", "vocab_uncapped", "fit_ngram_model", "score_tokens", "eval_corpus",
        "read_posts_jsonl", "top_p", "no_repeat_ngram", "prompt_grid", "context_vectors_seq",
        "prompt_random", "verdict_marked", "tokenize_chars", "clean_posts_nan", "curate_missing_files", "numbered_list_file"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_key", "corpus", "text"] and df.count() > 0


def test_every_query_has_docstring():
    for name, fn in E.queries().items():
        assert fn.__doc__, name


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(srows, df.columns)[0] == digest(orows, ocols)[0]

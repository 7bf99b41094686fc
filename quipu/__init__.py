"""quipu — a Spark-native engine for curating and modelling short-text corpora.

Every operator is a Column expression or a DataFrame -> DataFrame function built
on Spark SQL, so the work is planned by Catalyst and runs distributed.

Layout
------
sources/    readers (CSV / TSV / JSON-lines / word vectors), sinks, test fixtures
functions/  Column-level text cleaning, predicates, verdicts, token-array helpers
operators/  DataFrame operators: corpus order/dedup/split, vocabulary, vectors,
            n-gram model, sampling over distributions, generation, QA selection
plans/      composed jobs (curation, language-model preparation) and the catalog
            of registered queries with their SQL oracles
streaming/  incremental curation over arriving files (Structured Streaming)
"""

from quipu.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]

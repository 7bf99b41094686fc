"""Reader edge cases on small files written to a temporary folder."""
import os

import pytest
from quipu.sources import readers as RD
from quipu.sources import sinks as SK


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_na_and_multiline(spark, tmpdir_path):
    p = f"{tmpdir_path}/csv/a.csv"
    _write(p, 'title,selftext,score\n"Hi","two\nlines",12\n"None","NA",3\nx,,7.5\n')
    rows = RD.posts_csv_raw(RD.read_posts_csv(spark, p)).orderBy("pos").collect()
    assert [(r["pos"], r["score"], r["raw_text"]) for r in rows] == [
        (0, 12.0, "Hi two\nlines"), (1, 3.0, " "), (2, 7.5, "x ")]


def test_tsv_tolerant_and_strict(spark, tmpdir_path):
    p = f"{tmpdir_path}/tsv/t.tsv"
    _write(p, "12\tGood one\n x \tbad score\nno tab here\n 7 \tA\tB\n1_000\tpython accepts this\n")
    rows = RD.read_scored_tsv(spark, p).orderBy("pos").collect()
    assert [(r["pos"], r["score"], r["raw_text"]) for r in rows] == [(0, 12.0, "Good one"), (3, 7.0, "A\tB")]
    assert RD.read_scored_tsv(spark, f"{tmpdir_path}/missing.tsv").count() == 0


def test_jsonl_rules(spark, tmpdir_path):
    p = f"{tmpdir_path}/j/j.jsonl"
    _write(p, '{"score": 15, "title": "a", "selftext": null}\n'
              '{"score": "15", "title": "b"}\n'
              '[1, 2]\n'
              'not json\n'
              '{"title": "c", "selftext": "d"}\n'
              '{"score": 11.5, "selftext": "e"}\n'
              '{"score": null, "title": "f"}\n')
    rows = RD.read_posts_jsonl(spark, p).orderBy("pos").collect()
    assert [(r["score"], r["raw_text"]) for r in rows] == [(15.0, "a None"), (0.0, "c d"), (11.5, " e")]


def test_word_vectors_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([("w1", [0.5, -1.25]), ("w2", [2.0, 3.0])], "word string, vector array<float>")
    SK.write_word_vectors(df, f"{tmpdir_path}/vec")
    back = {r["word"]: r["vector"] for r in RD.read_word_vectors(spark, f"{tmpdir_path}/vec").collect()}
    assert back == {"w1": [0.5, -1.25], "w2": [2.0, 3.0]}
    lines = spark.read.text(f"{tmpdir_path}/vec").collect()
    assert lines[0]["value"] == "2 2"


def test_strict_tsv_and_first_rows(spark, tmpdir_path):
    good, bad, csv = f"{tmpdir_path}/s/good.tsv", f"{tmpdir_path}/s/bad.tsv", f"{tmpdir_path}/s/a.csv"
    _write(good, "12\tGood One\nx\tTwo\tTabs\n3\tThird\n")
    _write(bad, "12\tGood one\nno tab here\n")
    _write(csv, "title,selftext,score\na,b,1\nc,d,2\ne,f,3\n")
    rows = RD.read_scored_tsv(spark, good, strict=True).orderBy("pos").collect()
    assert [(r["pos"], r["score"], r["raw_text"]) for r in rows] == [(0, "12", "good one"), (1, "x", "twotabs"), (2, "3", "third")]
    with pytest.raises(Exception, match="without a tab"):
        RD.read_scored_tsv(spark, bad, strict=True).collect()
    assert RD.read_scored_tsv(spark, bad, strict=True, limit=1).count() == 1
    assert sorted(r["pos"] for r in RD.read_scored_tsv(spark, good, limit=2).collect()) == [0]
    assert sorted(r["title"] for r in RD.read_posts_csv(spark, csv, limit=2).collect()) == ["a", "c"]
    assert RD.read_posts_csv(spark, csv, limit=0).count() == 0


def test_doc_key_out_of_range_fails(spark):
    from pyspark.sql import functions as F

    from quipu.operators import corpus as C
    key = C.doc_key(1, F.col("pos"))
    df = spark.createDataFrame([((1 << 40) - 1,), (None,)], "pos long")
    assert {r["k"] for r in df.select(key.alias("k")).collect()} == {(2 << 40) - 1, None}
    with pytest.raises(Exception, match="position outside"):
        spark.createDataFrame([(1 << 40,)], "pos long").select(key.alias("k")).collect()

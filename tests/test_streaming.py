"""Streaming curation: dedup across micro-batches, first arrival wins."""
import os
import uuid

from quipu.streaming.curate_stream import start_curation_stream


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_dedups_across_batches(spark, tmpdir_path):
    inp, base = f"{tmpdir_path}/in", f"{tmpdir_path}/{uuid.uuid4().hex}"
    a = '{"score": 20, "title": "A joke about cats", "selftext": "and dogs together."}'
    b = '{"score": 20, "title": "Another joke entirely", "selftext": "with a twist."}'
    low = '{"score": 2, "title": "Low score joke here", "selftext": "nobody liked it."}'
    _write(f"{inp}/1.jsonl", [a, low, a])
    q = start_curation_stream(spark, inp, f"{base}/kept", f"{base}/ckpt")
    q.awaitTermination()
    _write(f"{inp}/2.jsonl", [a, b])
    q = start_curation_stream(spark, inp, f"{base}/kept", f"{base}/ckpt")
    q.awaitTermination()
    rows = spark.read.parquet(f"{base}/kept").collect()
    texts = sorted(r["text"] for r in rows)
    assert texts == ["A joke about cats and dogs together.", "Another joke entirely with a twist."]
    first = [r for r in rows if r["text"].startswith("A joke")][0]
    assert first["doc_key"] == 0          # batch 0, first line

from __future__ import annotations

import collections
import hashlib
import random
import re

import pyarrow as pa
import pytest

from tracewright.llm.places import Places
from tracewright.llm.substring_dedup import deduplicated_documents, substring_dedup


def brute(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "cé", "dd", "e\xa0f", "g."]) + str(rng.randint(0, 60))
    passages = [[word() for _ in range(rng.randint(8, 60))] for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p))
            parts += p[cut:] if rng.random() < 0.4 else p if rng.random() < 0.4 else [word() for _ in range(rng.randint(1, 40))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    return [*texts, texts[3], None, "", "Ü, " * 200, "x" * 50_000, " ".join(word() for _ in range(20_000))]


@pytest.mark.parametrize("window", [35, 10, 3])
def test_equals_brute_force(spark, window):
    texts = corpus(window)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup(df, window=window).collect()}
    want = {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in enumerate(brute(texts, window))}
    assert got == want


def test_stage_keeps_columns_and_untouched_texts(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"head {passage} tail", "en", 5), (1, "clean\n text", "en", 5), (2, f"{passage}", None, 5), (None, None, None, None), (4, "", "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_chars long")
    out = deduplicated_documents(df, window=50)
    assert out.columns == df.columns
    assert sorted(((r["text"] or "", r["n_chars"] if r["text"] is not None else None) for r in out.collect()), key=str) == sorted([("head tail", 9), ("clean\n text", 11), ("", 0), ("", None), ("", 0)], key=str)


def test_other_partitions_change_nothing(spark):
    texts = corpus(7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    want = sorted((i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in enumerate(brute(texts, 20)))
    done = substring_dedup(df, window=20, slice_bytes=2000)
    rows = lambda d: sorted(map(tuple, d.collect()))
    none = spark.createDataFrame([(-1, 0, 0, "")], done.schema).repartition(2)
    assert rows(none.union(done)) == [(-1, 0, 0, ""), *want]
    assert rows(done.union(done)) == sorted([*want, *want])
    assert rows(done.coalesce(1)) == want
    assert rows(done.coalesce(2).repartition(3)) == want


def test_null_and_repeated_ids_and_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text, 1, "x"), (5, text, 2, "y"), (5, "other", 3, "z")], "doc_id long, text string, n_removed int, _part string")
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in substring_dedup(df).collect()) == [("5", 0), ("5", 40), ("None", 40)]
    assert deduplicated_documents(df).columns == df.columns


def test_repeated_rows_are_copies(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup(df).collect()] == [40, 40]
    assert substring_dedup(df.limit(0)).count() == 0


def test_splits_that_change_between_reads_lose_nothing(spark, tmp_path):
    rows = [(i, " ".join(f"w{i % 40}x{j}" for j in range(60))) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(f"{tmp_path}/docs")
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    try:
        found = substring_dedup(spark.read.parquet(f"{tmp_path}/docs"))
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        assert [r["n_removed"] for r in found.collect()] == [60] * 80
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_a_slice_that_does_not_come_back_fails():
    known = Places.__new__(Places)
    known.part, known.batches = 0, iter(())
    known.next = pa.RecordBatch.from_arrays([pa.array([3]), pa.array([0])], names=["shard", "at"])
    with pytest.raises(RuntimeError, match="slice 3"):
        known.of(4)
    with pytest.raises(RuntimeError, match="slice 3"):
        known.end()

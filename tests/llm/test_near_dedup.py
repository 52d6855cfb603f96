from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from tracewright.llm.components import components
from tracewright.llm.minhash_core import shingle_set, super_min_hash
from tracewright.llm.near_dedup import _sets, near_duplicates, without_near_duplicates

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    k = min(width, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, width, percent=80):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    return {rows[i][0]: (len(sets[i]), min(r[0] for k, r in enumerate(rows) if find(k) == find(i))) for i in range(len(rows))}


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, len(copy) // 15)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += ["", " \n\t ", "one", "ONE", "one two", "One\x0btwo", "one\xa0two", "x" * 100_000, "y " * 30_000]
    return list(enumerate(rows, 5))


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_brute_force(spark, width):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, width=width).collect()}
    assert got == brute(rows, width)


def test_nulls_repeats_and_clashes(spark):
    rows = [(1, "a b c d e", 0, "k"), (1, "a b c d e", 0, "k"), (2, None, 1, "k"), (3, "", 1, None), (None, "a b c d e", 2, "k"), (None, "lonely words stand here alone", 2, "k"), (None, "lonely words stand here alone", 2, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, node string")
    got = sorted(((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in near_duplicates(df).collect()))
    assert got == [(-1, -1, True), (-1, -1, True), (-1, 1, False), (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True)]
    kept = without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"] or -1, r["text"] or "") for r in kept.collect())) == [(-1, "lonely words stand here alone"), (1, "a b c d e"), (2, ""), (3, "")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0
    assert without_near_duplicates(df).count() == 0


def test_large_family_with_unlike_members(spark):
    """Members far from the best connected one still find each other."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(1, 9)):
            copy[rng.randrange(100)] = f"n{rng.random()}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, width=4).collect()}
    assert got == brute(rows, 4)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[400:2400])
    sig = super_min_hash([a, b, np.zeros(0, np.uint64), a[:3]], 256)
    assert abs((sig[0] == sig[1]).mean() - 1600 / 2400) < 0.1
    assert np.isinf(sig[2]).all()
    assert np.isfinite(sig[3]).all()
    assert len(np.unique(sig[3].astype(int))) > 50  # a small set needs many steps


def test_signature_is_a_plain_minimum():
    """Early stopping changes nothing: the same as offering every step of every element."""
    m = 16
    sets = [np.arange(k, k + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for k, n in ((1, 1), (5, 4), (9, 200))]
    together = super_min_hash(sets, m)
    for i, s in enumerate(sets):
        alone = np.minimum.reduce([super_min_hash([s[j : j + 1]], m)[0] for j in range(len(s))])
        assert (alone == together[i]).all()


def test_shingles_are_bytes_based():
    assert len(shingle_set("a\xa0b c", 4)) == 1
    assert (shingle_set("ÀB x", 2) != shingle_set("àb x", 2)).any()


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 50)] + [(200, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 100 for i in range(100, 141)} | {i: 1 for i in range(1, 50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_splits_that_change_between_reads_lose_nothing(spark, tmp_path):
    rows = [(i, " ".join(f"w{i % 40}x{j}" for j in range(30))) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(f"{tmp_path}/docs")
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    try:
        kept = without_near_duplicates(spark.read.parquet(f"{tmp_path}/docs"))
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(40))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_a_set_that_does_not_come_back_fails(spark):
    docs = spark.createDataFrame([("a b c d e f", 1)], "text string, row long")
    wanted = spark.createDataFrame([(2,)], "node long")
    with pytest.raises(RuntimeError, match="0 of 1 sets"):
        _sets(docs, wanted, 4)


def test_hot_and_mixed_buckets_equal_brute_force(spark, monkeypatch):
    """Families around bases that share half their words, hot buckets, blocks of a few rows."""
    from tracewright.llm import hot, near_dedup

    monkeypatch.setattr(hot, "HOT_KEYS", 300)
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    rng = random.Random(11)
    shared = [f"s{i}" for i in range(120)]
    rows = []
    for family in range(5):
        base = shared + [f"f{family}x{i}" for i in range(30)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randint(1, 5)):
                copy[rng.randrange(len(copy))] = f"n{rng.random()}"
            rows.append(" ".join(copy))
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 4)
    for sigmas in (near_dedup.SIGMAS, None):
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, width=4, sigmas=sigmas).collect()} == want


def test_results_in_unions_and_other_partitions(spark):
    rows = corpus(8)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    done = without_near_duplicates(df)
    want = sorted(map(str, done.collect()))
    assert sorted(map(str, done.union(done).coalesce(1).collect())) == sorted([*want, *want])
    assert {r["doc_id"] for r in done.collect()} >= {i for i, (_, c) in brute(rows, 5).items() if i == c and i < 10_000}



from __future__ import annotations

import pandas as pd

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.toPandas()[out.columns], out.schema)
        seen[name] = docs.toPandas()
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id")["quality"]
    kept = set(seen["quality_classifier"]["doc_id"])
    right = [(d in kept) == bool(q) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.8  # some 70 rows to learn from here
    assert len(seen["minhash_near_dedup"]) < len(seen["quality_classifier"])
    assert set(seen["secret_scan"]["doc_id"]) == set(seen["substring_dedup"]["doc_id"]) == set(seen["minhash_near_dedup"]["doc_id"])
    assert set(seen["best_fit_packing"]["doc_id"]) == set(seen["secret_scan"]["doc_id"])


def test_run_gives_packed_rows(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF)
    assert rows.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048


def test_stages_take_odd_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, "a few words that stand alone here", "en", None, None, "x"), (1, "a few words that stand alone here", "en", None, None, "x"), (2, None, None, None, None, "x"), (3, "", "en", "s", 0, "y"), (None, "no id but text of its own, password=abcdefgh", "en", "s", 44, None),
        (4, f"one {passage}", "en", "s", 1, "z"), (5, f"{passage} other end of a longer text with " + " ".join(f"q{i}" for i in range(90)), "en", "s", 1, "z"), (6, "x" * 100_000, "en", "s", 100_000, "z"), (7, " ".join(f"v{i * i}" for i in range(500_000)), "en", "s", 1, "z"),
    ]
    schema = "doc_id long, text string, lang string, _row string, n_chars long, _text string"
    docs = spark.createDataFrame(rows, schema)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"stage{number}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{number}"))
        if name == "secret_scan":
            got = {(r["doc_id"], r["text"]) for r in docs.collect()}
            assert (None, "no id but text of its own, [SECRET]") in got
            assert (4, "one") in got
            assert {(2, None), (3, "")} <= got
            assert len(got) == docs.count() == 8
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        none = stage(spark, spark.createDataFrame([], schema), str(tmp_path))
        assert none.count() == 0, name

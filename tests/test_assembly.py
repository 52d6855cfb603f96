from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tracewright.operators import adjudicate, assemble, rewrite, telemetry, training
from tracewright.sources import tables


def test_combine_laws(spark):
    rows = [(f"p{p}", f"id{i}", "success", p * 10 + i) for p in range(3) for i in range(5)]
    df = spark.createDataFrame(rows, "_source string, sample_id string, status string, _ord long")
    row = assemble.combine_summary(df).first().asDict()
    assert (row["final_records"], row["cross_source_ids"], row["deduped"]) == (15, 5, 0)


def test_scoped_dedup(spark):
    rows = [("p", "a", "success", 1), ("p", "b", "failed", 2), ("p", "a", "failed", 3), ("p", None, None, 4), ("p", "", "success", 5), ("p", "", "success", 5)]
    df = spark.createDataFrame(rows, "_source string, sample_id string, status string, _ord long")
    got = sorted(tuple(r) for r in assemble.combined(df).select("_keyed", "_ord", F.coalesce("sample_id", F.lit("-")), assemble.route(F.col("status"))).collect())
    assert got == [(False, 4, "-", "failed"), (False, 5, "", "success"), (False, 5, "", "success"), (True, 1, "a", "failed"), (True, 2, "b", "failed")]


def test_merge(spark):
    schema = "sample_id string, status string, judge_failure string, _ord long"
    run = spark.createDataFrame([("a", "success", None, 1), ("b", "failed", None, 2), ("c", "failed", None, 3), ("d", "failed", None, 4), (None, "failed", None, 5), (None, "failed", None, 6), ("e", "failed", None, 7)], schema)
    judged = spark.createDataFrame([("b", "success", None, 1), ("a", "failed", None, 2), ("c", "failed", None, 3), ("x", "failed", None, 4), ("e", "success", None, 1), ("e", "failed", "terminal_error", 9), ("", "success", None, 5)], schema)
    got = assemble.merge_summary(run, judged).first().asDict()
    assert got == {"run_success": 1, "run_failed": 6, "judged_overturned": 1, "judged_upheld": 1, "judged_error": 1, "untouched_failed": 3, "final_success": 2, "final_failed": 5, "collision": 1, "orphaned": 1, "duplicate_run_failed_ids": 1, "duplicate_judged_ids": 1}


def test_verdicts(spark):
    pairs = [("a", "1", "2"), ("b", "x", None)]
    replies = {
        "all": '{"verdicts": [{"field": "a", "match": true}, {"field": "b", "match": true}]}',
        "one": '{"verdicts": [{"field": "a", "match": true}, {"field": "b", "match": false}]}',
        "gap": '{"verdicts": [{"field": "a", "match": true}]}',
        "text": '{"verdicts": [{"field": "a", "match": "true"}, {"field": "b", "match": true}]}',
        "first": '{"verdicts": [{"field": "a", "match": true}, {"field": "a", "match": false}, {"field": "b", "match": true}]}',
        "junk": "nothing",
        "key": '{"verdict": []}',
        "list": '{"verdicts": {}}',
        "odd": '{"verdicts": ["x", null, {"match": true}, {"field": 7, "match": true}, {"field": "a", "match": true}, [1], {"field": "b", "match": true}]}',
        "one1": '{"verdicts": [{"field": "a", "match": 1}, {"field": "b", "match": true}]}',
    }
    df = spark.createDataFrame([(k, "failed", [dict(zip(("field", "predicted", "ground_truth"), p, strict=True)) for p in pairs], v, "OK") for k, v in replies.items()], "sample_id string, status string, differences array<struct<field: string, predicted: string, ground_truth: string>>, content string, outcome string")
    got = {r["sample_id"]: (r["judge_result"]["overturned"], r["judge_result"]["failure"], r["status"]) for r in adjudicate.apply_verdicts(adjudicate.judgeable(df)).collect()}
    bad = (False, "judge_parse_failed", "failed")
    assert got == {"all": (True, None, "success"), "one": (False, None, "failed"), "gap": (False, None, "failed"), "text": (False, None, "failed"), "first": (True, None, "success"), "junk": bad, "key": bad, "list": bad, "odd": (True, None, "success"), "one1": (False, None, "failed")}


def test_polish_compares_with_prediction(spark):
    rows = [("same", '{"cot": " c ", "answer": {"a": "x,y"}}'), ("norm", '{"cot": "c", "answer": {"a": "x , y"}}'), ("new", '{"cot": "c", "answer": {"a": "z"}}'), ("bad", '{"cot": 5, "answer": {"a": "x"}}'), ("none", "no"), ("deep", '{"cot": 5, "answer": {"a": "x,y"}, "x": {"cot": "y"}}'), ("text", '{"cot": "c", "answer": "x"}'), ("empty", '{"cot": "  ", "answer": {"a": "x,y"}}')]
    df = spark.createDataFrame([(k, '{"a": "x,y"}', c, "OK") for k, c in rows], "sample_id string, predicted_json string, content string, outcome string")
    got = {r["sample_id"]: (r["polish_result"]["applied"], r["polish_result"]["failure"], r["polish_result"]["polished_cot"]) for r in rewrite.applied(df, rewrite.POLISH).collect()}
    assert got == {"same": (True, None, "c"), "norm": (True, None, "c"), "new": (False, None, "c"), "bad": (False, "parse_failed", None), "none": (False, "parse_failed", None), "deep": (False, "parse_failed", None), "text": (False, "parse_failed", None), "empty": (True, None, "")}


def test_flags(spark):
    texts = ["ask", "ask\n/no_think\n", "a\r\n /think \nb", "", "a\n\nb"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    on = [r[1] for r in sorted(df.select("i", training.with_flag(F.col("t"), "/think")).collect())]
    assert on == ["ask\n/think", "ask\n/think", "a\nb\n/think", "/think", "a\n\nb\n/think"]
    off = [r[1] for r in sorted(df.select("i", training.with_flag(F.col("t"), "")).collect())]
    assert off == ["ask", "ask\n/no_think", "a\n /think \nb", "", "a\n\nb"]
    odd = df.select("i", training.with_flag(F.col("t"), "/think", ("/think", "", "/no_think"))).collect()
    assert sorted(odd)[4][1] == "a\nb\n/think"


def test_training_rows(spark):
    schema = "sample_id string, _ord long, human string, images array<string>, reply string, reasoning string, polished_cot string, polished_answer string, predicted_json string"
    rows = [
        ("a", 1, "q", ["i"], 'because\n```json\n{"x": 1}\n```', None, None, None, '{"x": 1}'),
        ("b", 2, "q", [], '{"x": 1}', None, None, None, '{"x": 1}'),
        ("c", 3, "q", [], "text", " channel ", None, '{"y": 2}', '{"x": 1}'),
        ("d", 4, "q", [], "text", None, None, None, None),
    ]
    got = {r["sample_id"]: (r["human"], r["gpt"]) for r in training.training_rows(spark.createDataFrame(rows, schema)).collect()}
    assert got["a"] == ("<image>\nq\n/think", '<think>because</think>\n<answer>{\n  "x": 1\n}</answer>')
    assert got["b"] == ("q\n/no_think", '<answer>{\n  "x": 1\n}</answer>')
    assert got["c"] == ("q\n/think", '<think>channel</think>\n<answer>{\n  "y": 2\n}</answer>')
    assert "d" not in got
    raw = {r["sample_id"]: r["gpt"] for r in training.training_rows(spark.createDataFrame(rows, schema), "raw", fences=True).collect()}
    assert raw["a"] == 'because\n{"x": 1}\n'


def test_sanitized(spark):
    rows = [([("human", "q\n/think"), ("gpt", "<thinking>x</thinking>\n<think>y\n</think><answer> a </answer>"), ("gpt", "<think>only</think>"), ("system", "s")],)]
    df = spark.createDataFrame(rows, "conversations array<struct<`from`: string, value: string>>")
    assert [t["value"] for t in training.sanitized(df).first()[0]] == ["q\n/no_think", "<answer>a</answer>", "<think>only</think>", "s"]


@pytest.mark.parametrize(("ratio", "blocks"), [(1.0, (3, 2, 1)), (0.5, (3, 1, 0)), (10.0, (3, 2, 4)), (0.0, (3, 0, 0))])
def test_budget(spark, ratio, blocks):
    one = lambda p, n: spark.createDataFrame([(f"{p}{i}",) for i in range(n)], "sample_id string")
    rows = training.assembled(one("c", 3), one("f", 2), one("x", 4), ratio)
    got = training.convert_summary(rows).first()
    assert tuple(got)[:3] == blocks
    assert got["total_samples"] == sum(blocks)


def test_buckets(spark):
    rows = [(0.0, 5.0, "OK"), (1.0, 2.0, "OK"), (2.0, 12.0, "API_ERROR"), (31.0, 32.0, "OK")]
    df = spark.createDataFrame(rows, "started double, finished double, outcome string")
    got = [tuple(r) for r in telemetry.buckets(df, [], 10).orderBy("bucket").collect()]
    assert got == [(0, 0.0, 3, 2, 0, 2, 18.0), (1, 10.0, 0, 1, 1, 0, 0.0), (2, 20.0, 0, 0, 0, 0, 0.0), (3, 30.0, 1, 1, 0, 1, 6.0)]


def test_pacing_matches_recurrence(spark):
    arrivals = [0.0, 0.1, 5.0, 5.1, 5.2, 9.0]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrivals)], "i int, at double")
    got = [r["granted"] for r in telemetry.paced(df, [], "at", ["at", "i"], 60).orderBy("i").collect()]
    want, last = [], float("-inf")
    for a in arrivals:
        last = max(a, last + 1)
        want.append(last)
    assert got == pytest.approx(want)


def test_sources_round_trip(spark, tmp_path):
    success = [{"sample_id": "a", "status": "success", "ground_truth": {"b": 1, "a": [2]}}]
    (tmp_path / "success_samples.json").write_text(json.dumps(success))
    rows = tables.read_dataset(spark, str(tmp_path))
    assert [(r["sample_id"], json.loads(r["ground_truth"])) for r in rows.collect()] == [("a", {"b": 1, "a": [2]})]
    (tmp_path / "failed_samples.json").write_text("not json")
    assert tables.read_dataset(spark, str(tmp_path)).count() == 1
    assert tables.read_dataset(spark, str(tmp_path), only="failed").count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_required(spark, str(tmp_path / "none.json"), tables.RECORDS)
    out = str(tmp_path / "out.json")
    tables.export_array(spark.createDataFrame([(2, "é"), (1, "x")], "_ord int, v string"), out, ["_ord"])
    with open(out, encoding="utf-8") as f:
        assert json.load(f) == [{"v": "x"}, {"v": "é"}]
    tables.write_records(rows, str(tmp_path / "table"))
    assert [r[0] for r in tables.processed_ids(spark, str(tmp_path / "table")).collect()] == ["a"]
    lines = tmp_path / "x.jsonl"
    lines.write_text('{"conversations": [{"from": "human", "value": "q"}], "images": []}\n\n{"conversations": [], "images": ["i"]}\n')
    assert tables.read_array(spark, str(lines), tables.SHAREGPT).count() == 2


def test_rewritten_answers_keep_order_and_digits(spark):
    df = spark.createDataFrame([("a", '{"z":1}', 'so {"cot": "c", "answer": {"z": 1.5, "a": 12345678901234567890}}', "OK")], "sample_id string, predicted_json string, content string, outcome string")
    assert rewrite.applied(df, rewrite.REPAIR).first()["polish_result"]["polished_answer"] == '{"z": 1.5, "a": 12345678901234567890}'


def test_places_and_running_maxima_over_ranges(spark):
    import random

    from tracewright.operators.ordering import in_order, running_max

    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), i, rng.randint(0, 1000)) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_max(in_order(df, ["k"], ["i"]), ["k"], "v", "most").collect()
        alone = sorted((r["_place"], r["i"]) for r in in_order(df, [], ["i"]).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for k in {r[0] for r in rows}:
        most = -1
        for place, (_, i, v) in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: r[1])):
            most = max(most, v)
            want.append((str(k), i, place, most))
    assert sorted((str(r["k"]), r["i"], r["_place"], r["most"]) for r in got) == sorted(want)
    assert alone == [(i, i) for i in range(800)]


def test_grants_at_slice_edges(spark):
    seconds = [0, 59, 60, 60, 61, 119, 120, 180, 239, 240, 600]
    df = spark.createDataFrame([(i, s * 1_000_000) for i, s in enumerate(seconds)], "i int, us long")
    got = [r["recent"] for r in sorted(telemetry.grants_in_window(df, [], "us", 60).collect())]
    assert got == [sum(s - 60 < x <= s for x in seconds) for s in seconds]


def test_exports_replace_whole_files_and_nest_values(spark, tmp_path):
    path = str(tmp_path / "out.json")
    for n in (1, 2):
        rows = spark.createDataFrame([(i, '{"b": [1, {"a": "é"}]}', "plain") for i in range(n)], "_ord int, predicted_json string, cot_response string")
        tables.export_array(rows, path, ["_ord"], nested=tables.NESTED)
    with open(path, encoding="utf-8") as f:
        text = f.read()
    assert json.loads(text) == [{"predicted_json": {"b": [1, {"a": "é"}]}, "cot_response": "plain"}] * 2
    assert text.startswith('[\n  {\n    "predicted_json": {') and text.endswith("\n]\n")
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["out.json"]


def test_many_picked_rows_are_the_same_as_few(spark, monkeypatch):
    df = spark.range(500).repartition(5)
    few = sorted(r[0] for r in training.seeded_pick(df, 120, "id").collect())
    monkeypatch.setattr(training, "FEW", 10)
    assert sorted(r[0] for r in training.seeded_pick(df, 120, "id").collect()) == few
    assert len(few) == 120
    assert training.seeded_pick(df, 900, "id").count() == 500


def test_large_arrays_are_written_and_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """No row passes through the driver, and files cut before their elements give what whole reading does."""
    monkeypatch.setattr(type(spark.range(0)), "toLocalIterator", None)
    n, path = 3000, str(tmp_path / "rows.json")
    texts = ["plain", 'é "q" \\ [,\n  {', '{"b": [1.50, {"a": "ü\\n  {"}], "c": {}}', "[]", None]
    rows = spark.createDataFrame([(i, f"s{i}" if i % 9 else None, texts[i % 5], texts[(i + 2) % 5]) for i in range(n)], "_ord int, sample_id string, ground_truth string, error string").repartition(7)
    tables.export_array(rows, path, ["_ord"], nested=tables.NESTED)
    with open(path, encoding="utf-8") as f:
        text = f.read()
    held = json.loads(text)
    assert [r.get("sample_id") for r in held] == [f"s{i}" if i % 9 else None for i in range(n)]
    assert text == json.dumps(held, ensure_ascii=False, indent=2) + "\n"

    def read(where: str, start: int) -> list[tuple]:
        monkeypatch.setattr(tables, "SPLIT_FROM", start)
        return sorted((r["_ord"], r["sample_id"], r["ground_truth"], r["error"]) for r in tables.read_array(spark, where, tables.RECORDS).collect())

    whole = read(path, 1 << 40)
    assert [r[0] for r in whole] == [i for i in range(n) if held[i]]
    for size in ("4099", "20000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert read(path, 0) == whole
            cut = tables._in_pieces(spark, path, tables.RECORDS)
            assert cut is not None
            assert size == "128m" or spark.read.option("lineSep", tables._ELEMENT).text(path).rdd.getNumPartitions() > 8
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    odd = {
        "broken": text[:-9], "typed": text.replace('"s7"', '"s7",\n    "attempts": "x"'), "joined": text.replace('},\n  {\n    "sample_id": "s7"', '}, {\n    "sample_id": "s7"'),
        "null": text.replace('\n  {\n    "sample_id": "s7"', '\n  null,\n  {\n    "sample_id": "s7"'), "deep": json.dumps([[{"sample_id": "s"}]], indent=1), "tight": json.dumps(held), "empty": "[]\n", "lists": '[\n  {"sample_id": "a",\n  "error": [\n  {}\n  ]}\n]',
    }
    for name, changed in odd.items():
        (tmp_path / f"{name}.json").write_text(changed, encoding="utf-8")
        assert read(str(tmp_path / f"{name}.json"), 0) == read(str(tmp_path / f"{name}.json"), 1 << 40), name

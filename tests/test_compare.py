from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.functions import jsonx
from tracewright.functions.compare import compare_first, comparison, field_verdicts, long_form, rank
from tracewright.functions.textnorm import DEFAULT, LEGACY
from tracewright.operators import verdicts
from tracewright.plans.queries import compare_first_generation


def compared(spark, pairs, config=DEFAULT):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, pred string, gt string")
    flat = df.select("i", jsonx.flatten_json("pred").alias("p"), jsonx.flatten_json("gt").alias("g"))
    done = flat.withColumn("f", field_verdicts(F.col("p"), F.col("g"), config)).withColumn("c", comparison(F.col("f"), F.col("g")))
    return [r["c"] for r in sorted(done.collect(), key=lambda r: r["i"])]


def levels(spark, pairs, config=DEFAULT):
    return [c["match_level"] for c in compared(spark, pairs, config)]


def test_levels(spark):
    pairs = [
        ('{"a": "x"}', '{"a": "x"}'),
        ('{"a": "ｘ , y"}', '{"a": "x,y"}'),
        ('{"a": "X"}', '{"a": "x"}'),
        ('{"a": 5}', '{"a": 5.0}'),
        ('{"a": 5.83}', '{"a": "5.83"}'),
        ('{"a": null}', '{"a": "None"}'),
        ('{"a": true}', '{"a": 1}'),
        ('{"a": null}', '{"a": null}'),
        ('{"a": []}', "{}"),
        ("{}", '{"a": 1}'),
        ('{"a": 1, "b": 2}', '{"a": 1}'),
        ('{"k": [{"a": 1}, {"a": 2}]}', '{"k": [{"a": 1}]}'),
        ('{"a": 9007199254740993}', '{"a": 9007199254740992}'),
    ]
    assert levels(spark, pairs) == ["STRICT", "NORMALIZED_MATCH", "MISMATCH", "STRICT", "MISMATCH", "MISMATCH", "MISMATCH", "STRICT", "STRICT", "MISMATCH", "MISMATCH", "MISMATCH", "MISMATCH"]


def test_score_ignores_missing_and_extra(spark):
    one, two, three = compared(spark, [('{"a": 1}', '{"a": 1, "b": 2}'), ("{}", '{"a": 1}'), ('{"a": 1, "b": 3, "x": 1}', '{"a": 1, "b": 2, "y": 1}')])
    assert (one["match_score"], one["is_match"], one["is_partial"], one["missing_fields"], one["total_fields"]) == (1.0, False, True, 1, 2)
    assert (two["match_score"], two["missing_fields"]) == (0.0, 1)
    assert (three["match_score"], three["extra_fields"], three["missing_fields"], three["mismatched_fields"]) == (0.5, 1, 1, 1)
    assert [(d["field"], d["type"]) for d in three["differences"]] == [("b", "mismatch"), ("x", "extra"), ("y", "missing")]


def test_lenient_preset(spark):
    pairs = [('{"a": 5}', '{"a": "5"}'), ('{"a": true}', '{"a": 1}'), ('{"a": "X  y", "b": ""}', '{"a": "x y"}'), ('{"a": "€5"}', '{"a": "EUR5"}'), ('{"a": "1,000"}', '{"a": "1000"}')]
    assert levels(spark, pairs, LEGACY) == ["NORMALIZED_MATCH", "STRICT", "NORMALIZED_MATCH", "MISMATCH", "NORMALIZED_MATCH"]


def test_both_shapes_agree(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x", "c": null}', '{"a": 1, "b": "y", "d": 1}')], "k int, pred string, gt string")
    flat = df.select("k", jsonx.flatten_json("pred").alias("p"), jsonx.flatten_json("gt").alias("g"))
    wide = flat.select("k", F.explode(field_verdicts(F.col("p"), F.col("g"))).alias("f")).select("k", "f.field", "f.level")
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, long_form(flat, "k", "p", "g").select("k", "field", "level").collect()))


def test_aggregates(spark):
    cs = spark.createDataFrame([("STRICT",), ("MISMATCH",)], "match_level string")
    assert dict(map(tuple, verdicts.level_counts(cs).collect())) == {"STRICT": 1, "NORMALIZED_MATCH": 0, "MISMATCH": 1}
    rows = spark.createDataFrame([("a", "MISMATCH"), ("a", "STRICT"), ("b", "NORMALIZED"), ("c", "KEY_MISSING_IN_GT")], "field string, level string")
    assert list(map(tuple, verdicts.field_distribution(rows).collect())) == [("a", 1, 2, 0.5)]
    assert tuple(verdicts.cross_check(rows).first()) == (4, 0.25, 0, 1)
    assert tuple(verdicts.cross_check(rows.limit(0)).first()) == (0, 0.0, 0, 0)


def test_nearest_rank(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (10, 20, 30, 40)] + [("b", 1.0)] * 5, "k string, v double")
    got = {r["k"]: (r["n"], r["p50"], r["p100"]) for r in verdicts.nearest_rank(df, ["k"], "v", [50, 100]).collect()}
    assert got == {"a": (4, 30.0, 40.0), "b": (5, 1.0, 1.0)}


def test_rank_orders_levels(spark):
    df = spark.createDataFrame([("STRICT",), ("NORMALIZED_MATCH",), ("MISMATCH",)], "l string")
    assert [r[0] for r in df.select(rank(F.col("l"))).collect()] == [2, 1, 0]


def test_quality_windows_and_summary(spark):
    df = spark.createDataFrame([(i, 1.0 if i < 10 else None if i == 10 else 0.5) for i in range(23)], "i int, match_score double")
    got = sorted(map(tuple, verdicts.quality_windows(df, ["i"]).collect()))
    assert got == [(0, 10, 1.0), (1, 10, 0.5), (2, 2, 0.5)]
    assert tuple(verdicts.quality_summary(df).first()) == (0.7273, 22, 1)


def test_first_generation_compares_nested_values_too(spark):
    """Four top-level keys, one of them a list; the reference counts all of them."""
    pairs = [('{"a": 1, "items": [{"b": 2}]}', '{"a": 1, "items": [{"b": 2}]}'), ('{"a": 1, "items": [{"b": 3}]}', '{"a": 1, "items": [{"b": 2}]}'), ('{"a.b": 1, "c": {}}', '{"a": {"b": 1}, "c": {}}'), ("[1]", "{}")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, pred string, gt string")
    df = df.select("i", jsonx.top_level_json("pred").alias("p"), jsonx.top_level_json("gt").alias("g"))
    got = sorted(map(tuple, df.select("i", compare_first(F.col("p"), F.col("g")).alias("c")).select("i", "c.is_match", "c.match_score", "c.missing_fields", "c.extra_fields").collect()))
    assert got == [(0, True, 1.0, 0, 0), (1, False, 0.5, 0, 0), (2, False, 1.0, 2, 1), (3, False, 0.0, 0, 0)]
    scores = {r["match_score"] for r in compare_first_generation(spark, "/root/testdata/sf0.001").collect() if r["k"] % 7 == 2}
    assert scores == {0.75}


def test_sides_meet_by_path_whatever_their_order(spark):
    import json
    import random

    rng = random.Random(2)
    pairs = []
    for _ in range(30):
        sides = [{f"k{rng.randint(0, 8)}": rng.choice(["x", "X", 1, None, [1, {"z": "y"}], {}]) for _ in range(rng.randint(0, 8))} for _ in range(2)]
        pairs.append(tuple(map(json.dumps, sides)))
    for (pred, gt), c in zip(pairs, compared(spark, pairs), strict=True):
        p, g = (jsonx.leaves(json.loads(x)) for x in (pred, gt))
        assert [f["field"] for f in c["fields"]] == sorted({*p, *g})
        for f in c["fields"]:
            want = "KEY_MISSING_IN_PRED" if f["field"] not in p else "KEY_MISSING_IN_GT" if f["field"] not in g else "STRICT" if p[f["field"]] == g[f["field"]] else "MISMATCH"
            assert f["level"] == want


def test_wide_objects_cost_no_more_a_leaf(spark):
    import time

    def seconds(leaves, rows):
        one = "{" + ", ".join(f'"k{i:05d}": "v{i}"' for i in range(leaves)) + "}"
        df = spark.createDataFrame([(one, one)] * rows, "pred string, gt string").select(jsonx.flatten_json("pred").alias("p"), jsonx.flatten_json("gt").alias("g"))
        start = time.perf_counter()
        df.select(field_verdicts(F.col("p"), F.col("g")).alias("f")).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(100, 4)
    assert seconds(4_000, 4) < 40 * seconds(100, 4) + 3

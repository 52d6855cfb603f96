from __future__ import annotations

from pyspark.sql import functions as F

from tracewright.operators import lifecycle
from tracewright.operators.lifecycle import Budgets

LEVEL = {"match": ("OK", "STRICT"), "near": ("OK", "NORMALIZED_MATCH"), "miss": ("OK", "MISMATCH"), "junk": ("OK", None), "net": ("NETWORK_ERROR", None), "rate": ("RATE_LIMITED", None), "gate": ("GATEWAY_ERROR", None), "api": ("API_ERROR", None), "empty": ("EMPTY_RESPONSE", None), "long": ("LENGTH_TRUNCATED", None)}


def log(spark, scripts):
    rows = [(name, i + 1, *LEVEL[step.split(":")[0]], int(step.split(":")[1]) if ":" in step else 0) for name, script in scripts.items() for i, step in enumerate(script.split())]
    return spark.createDataFrame(rows, "sample_id string, attempt_no int, outcome string, match_level string, matched int")


def test_scripts(spark):
    scripts = {
        "a": "match", "b": "miss miss miss miss", "c": "net net net net net net", "d": "miss net miss rate miss", "e": "net match", "f": "api match", "g": "empty", "h": "long", "i": "gate gate gate gate gate",
        "j": "junk", "k": "miss:1 miss:5 miss:5", "l": "miss:2 gate gate gate", "m": "miss api", "n": "miss net", "o": "near miss",
    }
    got = {r["sample_id"]: (r["status"], r["attempts"], r["error_type"], r["match_level"], r["kept_attempt"]) for r in lifecycle.outcomes(log(spark, scripts)).collect()}
    assert got == {
        "a": ("success", 1, None, "STRICT", 1), "b": ("failed", 3, "MISMATCH", "MISMATCH", 1), "c": ("failed", 5, "NETWORK_ERROR", None, None), "d": ("failed", 5, "MISMATCH", "MISMATCH", 1),
        "e": ("success", 2, None, "STRICT", 2), "f": ("failed", 1, "API_ERROR", None, None), "g": ("failed", 1, "EMPTY_RESPONSE", None, None), "h": ("failed", 1, "LENGTH_TRUNCATED", None, None),
        "i": ("failed", 3, "GATEWAY_ERROR", None, None), "j": ("failed", 1, "JSON_PARSE_ERROR", None, None), "k": ("failed", 3, "MISMATCH", "MISMATCH", 2), "l": ("failed", 4, "MISMATCH", "MISMATCH", 1),
        "m": ("failed", 2, "API_ERROR", None, None), "n": ("open", 2, None, None, None), "o": ("success", 1, None, "NORMALIZED_MATCH", 1),
    }


def test_network_budget_of_two(spark):
    got = lifecycle.outcomes(log(spark, {"a": "gate gate gate"}), Budgets(network=2, gateway=10)).first()
    assert (got["status"], got["attempts"]) == ("failed", 2)


def test_conservation_and_quota(spark):
    scripts = {"a": "match", "b": "miss net miss rate miss", "c": "net match"}
    rows = lifecycle.folded(log(spark, scripts))
    quota = dict(map(tuple, lifecycle.quota_counts(rows).collect()))
    assert quota == {"initial": 3, "retry_quality": 2, "retry_network": 3}
    assert sum(quota.values()) == sum(r["attempts"] for r in lifecycle.outcomes(log(spark, scripts)).collect())


def test_rounds_end_within_bound(spark):
    samples = spark.createDataFrame([("a",), ("b",), ("c",)], "sample_id string")

    def call(open_, number):
        outcome = F.when(F.col("sample_id") == "b", "NETWORK_ERROR").otherwise("OK")
        level = F.when(F.col("sample_id") == "a", "STRICT").when(F.col("sample_id") == "c", F.lit("MISMATCH") if number < 3 else F.lit("NORMALIZED_MATCH"))
        return open_.select("sample_id", outcome.alias("outcome"), level.alias("match_level"), F.lit(1).alias("matched"))

    records, attempts = lifecycle.generate(samples, call)
    assert {r["sample_id"]: (r["status"], r["attempts"]) for r in records.collect()} == {"a": ("success", 1), "b": ("failed", 5), "c": ("success", 3)}
    assert attempts.count() == 9


def test_sample_parts(spark):
    df = spark.createDataFrame([(None, [("user", "<image> hi"), ("assistant", "gt")], None), ("x", [("user", "<image>")], [("human", "q"), ("gpt", "v")])], "id string, messages array<struct<role: string, content: string>>, conversations array<struct<`from`: string, value: string>>")
    got = df.select(lifecycle.ground_truth_text(F.col("messages"), F.col("conversations")), lifecycle.request_text(F.col("messages"), F.col("conversations")), lifecycle.sample_id(F.col("id"), F.lit("7"))).collect()
    assert list(map(tuple, got)) == [("gt", "hi", "sample_7"), ("v", "<image>", "x")]

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tracewright.operators import lifecycle, telemetry
from tracewright.operators.model import Faults, Pacer, model_calls, stand_in
from tracewright.streaming import flows


def test_pacer_spaces_calls():
    now, slept = [100.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    p = Pacer(50, clock=lambda: now[0], sleep=sleep)
    times = [p.admit() for _ in range(4)]
    assert times == pytest.approx([100.0, 101.2, 102.4, 103.6])
    now[0] += 60
    assert p.admit() == pytest.approx(now[0])


def test_stand_in_is_stable_and_classified(spark):
    faults = Faults(network=0.2, rate_limited=0.1, gateway=0.1, api=0.1, empty=0.1, truncated=0.1)
    model = stand_in(lambda k, u: f"reply {k}", faults)
    df = spark.createDataFrame([(f"s{i}", 1) for i in range(400)], "sample_id string, attempt_no int")
    one = model_calls(df, model)
    two = model_calls(df.repartition(3), model)
    pick = lambda d: sorted(map(tuple, d.select("sample_id", "outcome", F.coalesce("content", F.lit("-"))).collect()))
    assert pick(one) == pick(two)
    counts = {r["outcome"]: r["count"] for r in one.groupBy("outcome").count().collect()}
    assert set(counts) == {"OK", "NETWORK_ERROR", "RATE_LIMITED", "GATEWAY_ERROR", "API_ERROR", "EMPTY_RESPONSE", "LENGTH_TRUNCATED"}
    assert 40 < counts["NETWORK_ERROR"] < 120
    assert {r[0] for r in one.filter("outcome = 'RATE_LIMITED'").select("retry_after").distinct().collect()} == {1.5}


def test_rounds_with_a_model_conserve_calls(spark):
    model = stand_in(lambda k, u: "good" if u < 0.5 else "bad", Faults(network=0.3))
    samples = spark.createDataFrame([(f"s{i}",) for i in range(60)], "sample_id string")

    def call(open_, number):
        said = model_calls(open_.withColumn("attempt_no", F.lit(number)), model)
        level = F.when(F.col("content") == "good", "STRICT").when(F.col("content") == "bad", "MISMATCH")
        return said.select("sample_id", "outcome", level.alias("match_level"), F.lit(1).alias("matched"))

    records, attempts = lifecycle.generate(samples, call)
    rows = records.collect()
    assert len(rows) == 60
    assert {r["status"] for r in rows} <= {"success", "failed"}
    assert sum(r["attempts"] for r in rows) == attempts.count()
    assert max(r["attempts"] for r in rows) <= 7


def test_upserts_keep_the_last_and_repeat_safely(spark, tmp_path):
    one = spark.createDataFrame([("a", 1), ("b", 1)], "sample_id string, n int")
    two = spark.createDataFrame([("a", 3), ("c", 2)], "sample_id string, n int")
    path = str(tmp_path)
    for number, batch in ((0, one), (1, two), (1, two)):
        flows.upsert(batch, number, path, ["sample_id"], "n")
    assert sorted(map(tuple, flows.newest(spark, path).select("sample_id", "n").collect())) == [("a", 3), ("b", 1), ("c", 2)]


def test_upserts_build_on_the_newest_version_there_is(spark, tmp_path):
    """Numbers may be missing, buckets that a batch doesn't touch stay, and old ones go."""
    path = f"{tmp_path}/table"
    frame = lambda rows: spark.createDataFrame(rows, "sample_id string, n int")
    flows.upsert(frame([(f"s{i}", 1) for i in range(50)]), 0, path, ["sample_id"], "n", 8)
    for number in (3, 4, 7):
        flows.upsert(frame([("s1", number), (f"new{number}", 1)]), number, path, ["sample_id"], "n", 8)
    got = dict(map(tuple, flows.newest(spark, path).select("sample_id", "n").collect()))
    assert got == {f"s{i}": 1 for i in range(50)} | {"s1": 7, "new3": 1, "new4": 1, "new7": 1}
    assert len([p for p in (tmp_path / "table" / "versions").iterdir() if p.suffix == ".json"]) == 2
    kept = {f"{p.parent.name}/{p.name}" for p in (tmp_path / "table").glob("data-*/_bucket=*")}
    assert len(kept) <= 8 + 4  # each bucket's newest folder, and what the version before named


def test_pauses_follow_the_server(spark):
    from tracewright.operators.model import backing_off, replies

    slept: list[float] = []
    model = stand_in(lambda k, u: "x", Faults(rate_limited=1.0))
    calls = replies(spark.createDataFrame([("a",)], "sample_id string"), model, network=4, pause=backing_off(0.5, 1.6, slept.append))
    assert calls.count() == 4
    assert slept == [1.5, 1.5, 1.6]


def test_budget_state_equals_the_batch_fold(spark, tmp_path):
    steps = [("a", 1, "OK", "MISMATCH"), ("a", 2, "OK", "MISMATCH"), ("a", 3, "OK", "MISMATCH"), ("b", 1, "GATEWAY_ERROR", None), ("b", 2, "GATEWAY_ERROR", None), ("b", 3, "GATEWAY_ERROR", None), ("c", 1, "NETWORK_ERROR", None), ("c", 2, "OK", "STRICT"), ("d", 1, "OK", "MISMATCH")]
    log = spark.createDataFrame([(*s, 1) for s in steps], "sample_id string, attempt_no int, outcome string, match_level string, matched int")
    for i, part in enumerate((log.filter("attempt_no = 1"), log.filter("attempt_no > 1"))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
        q = flows.budget_stream(stream).writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out"))
        q.awaitTermination()
        assert i in (0, 1)
    got = {r["sample_id"]: (r["attempts"], r["status"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r["sample_id"]: (r["attempts"], r["status"]) for r in lifecycle.outcomes(log).filter("status <> 'open'").collect()}
    assert got == want


def test_backoff_and_uniform(spark):
    df = spark.createDataFrame([(n,) for n in range(8)], "n int")
    flat = [r[0] for r in df.select(telemetry.backoff_delay(F.col("n"), 1.0, 30.0, 0.0, F.lit(0.3))).collect()]
    assert flat == [1, 2, 4, 8, 16, 30, 30, 30]
    spread = df.select(telemetry.stable_uniform("n").alias("u")).agg(F.min("u"), F.max("u")).first()
    assert 0 <= spread[0] <= spread[1] < 1


@pytest.mark.parametrize("budgets", [lifecycle.Budgets(), lifecycle.Budgets(None, 2, None), lifecycle.Budgets(1, 4, 0)])
def test_budget_state_by_buckets_equals_a_fold_of_each_sample(spark, tmp_path, budgets):
    """Over batches; ids, levels and outcomes may be null or unknown. The state is one row a bucket, not one a sample."""
    import random

    rng = random.Random(5)
    outcomes = ["OK"] * 4 + ["NETWORK_ERROR", "RATE_LIMITED", "GATEWAY_ERROR"] * 3 + ["API_ERROR", "LENGTH_TRUNCATED", "strange", None]
    ids = [f"s{i}" for i in range(300)] + ["", None, "é"]
    log = [(s, n, rng.choice(outcomes), rng.choice(["STRICT", "MISMATCH", "MISMATCH", "MISMATCH", None, "other"])) for s in ids for n in range(1, rng.randint(2, 12))]
    frame = lambda rows: spark.createDataFrame(rows, "sample_id string, attempt_no int, outcome string, match_level string")
    want = {}
    for s in ids:
        mm = nw = gw = 0
        for _, n, outcome, level in [r for r in log if r[0] == s]:
            done = ""
            if outcome == "OK":
                mm += level not in ("STRICT", "NORMALIZED_MATCH", None)
                done = "success" if level == "STRICT" else "failed" if level is None or (budgets.sample is not None and mm >= budgets.sample) else ""
            elif outcome in lifecycle.NETWORK_CLASS:
                nw, gw = nw + 1, gw + (outcome == "GATEWAY_ERROR")
                done = "failed" if nw >= budgets.network or (budgets.gateway is not None and outcome == "GATEWAY_ERROR" and gw > budgets.gateway) else ""
            elif outcome in lifecycle.TERMINAL_CLASS:
                done = "failed"
            if done:
                want[s] = (n, done, outcome)
                break
    for low, high in ((0, 2), (2, 3), (3, 20)):
        part = [r for r in log if low < r[1] <= high]
        rng.shuffle(part)
        frame(part).repartition(3).write.mode("append").parquet(str(tmp_path / "log"))
        ended = flows.budget_stream(spark.readStream.schema(frame([]).schema).parquet(str(tmp_path / "log")), budgets, buckets=8)
        q = ended.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out"))
        q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["sample_id"]: (r["attempts"], r["status"], r["last_outcome"]) for r in rows} == want
    assert len(rows) == len(want) > 200

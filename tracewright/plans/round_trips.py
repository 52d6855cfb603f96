"""Registered queries of sources, sinks, model calls, batches and tools: tables are written, read
again or called over, and the result is held against SQL on the tables they came from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonx
from ..operators import assemble, batches, lifecycle, rewrite, training, verdicts
from ..operators import telemetry as timing
from ..operators.model import Faults, model_calls, stand_in
from ..operators.ordering import in_order
from ..sources import tables
from ..streaming import flows
from .registry import query
from .session import ensure_checkpoints
from .views import CHATS_SQL, RUNS_SQL, TELEMETRY_SQL, chats, judged, outcome_sql, rewritable, runs, stripped_sql, table, telemetry


def folder_of(spark: SparkSession, name: str) -> str:
    """A new folder's name below the one that all executors share."""
    ensure_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their place from 0 in file order."""
    return in_order(rows, [], ["_ord"]).withColumn("place", F.col("_place").cast("long")).drop("_place", "_part", "_ord")


# --- sources ---


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input samples of both dialects, from customers: every seventh has no id."""
    k = F.col("c_custkey")
    truth = F.concat(F.lit('{"name": "'), "c_name", F.lit('"}'))
    turns = lambda who, what, a, b: F.array(*(F.struct(F.lit(w).alias(who), t.alias(what)) for w, t in zip(a, b, strict=True)))
    texts = (F.concat(F.lit("<image> read "), k.cast("string")), truth)
    even = k % 2 == 0
    return table(spark, sf_dir, "customer").select(
        F.when(k % 7 > 0, F.concat(F.lit("c"), k.cast("string"))).alias("id"),
        F.when(even, turns("role", "content", ("user", "assistant"), texts)).alias("messages"),
        F.when(~even, turns("from", "value", ("human", "gpt"), texts)).alias("conversations"),
        F.array(F.concat(F.lit("i"), (k % 3).cast("string"), F.lit(".jpg"))).alias("images"),
        k.alias("_ord"),
    )


def _samples_file(spark: SparkSession, sf_dir: str) -> str:
    path = f"{folder_of(spark, 'samples')}/samples.json"
    tables.export_array(_samples(spark, sf_dir), path, ["_ord"])
    return path


_SAMPLES_SQL = "samples AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 > 0 THEN 'c' || c_custkey ELSE 'sample_' || (row_number() OVER (ORDER BY c_custkey) - 1) END AS sample_id, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer)"


@query(f"WITH {_SAMPLES_SQL} SELECT sample_id FROM samples ORDER BY md5('42:' || sample_id), place LIMIT 40")
def samples_picked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_samples(spark, _samples_file(spark, sf_dir), 40).select("sample_id")


@query(f"WITH {_SAMPLES_SQL} SELECT sample_id, '{{\"name\": \"' || c_name || '\"}}' AS truth, 'read ' || k AS asked FROM samples")
def sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read_samples(spark, _samples_file(spark, sf_dir))
    ids = lifecycle.sample_id(F.col("id"), F.col("_ord").cast("string"))
    return rows.select(ids.alias("sample_id"), lifecycle.ground_truth_text(F.col("messages"), F.col("conversations")).alias("truth"), lifecycle.request_text(F.col("messages"), F.col("conversations")).alias("asked"))


def _dataset(spark: SparkSession, rows: DataFrame, name: str) -> str:
    path = folder_of(spark, name)
    tables.write_dataset(rows, path, ["_ord"])
    return path


def _run_folder(spark: SparkSession, sf_dir: str) -> str:
    return _dataset(spark, runs(spark, sf_dir).select("sample_id", "status", "_ord"), "run")


@query(f"WITH {RUNS_SQL} SELECT sample_id, status, row_number() OVER (ORDER BY status DESC, ord) - 1 AS place FROM runs")
def dataset_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Success rows, then failed ones, each in their own order."""
    return _placed(tables.read_dataset(spark, _run_folder(spark, sf_dir)).select("sample_id", "status", "_ord"))


@query(f"WITH {RUNS_SQL} SELECT 'success' AS part, sample_id FROM runs WHERE status = 'success' UNION ALL SELECT 'failed', sample_id FROM runs WHERE status <> 'success' UNION ALL SELECT 'file', sample_id FROM runs WHERE status <> 'success'")
def status_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _run_folder(spark, sf_dir)
    part = lambda name, df: df.select(F.lit(name).alias("part"), "sample_id")
    scans = [part(only, tables.read_dataset(spark, path, only=only)) for only in ("success", "failed")]
    return scans[0].unionByName(scans[1]).unionByName(part("file", tables.read_dataset(spark, f"{path}/failed_samples.json")))


@query("SELECT n_nationkey AS k, n_name AS name, true AS missing_is_error FROM nation")
def optional_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that is there, and one that isn't: no rows where it is optional, else an error."""
    folder = folder_of(spark, "optional")
    tables.export_array(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name")), f"{folder}/there.json", ["k"])
    kind = "k long, name string"
    rows = tables.read_optional(spark, f"{folder}/there.json", kind).unionByName(tables.read_optional(spark, f"{folder}/gone.json", kind))
    try:
        tables.read_required(spark, f"{folder}/gone.json", kind)
        failed = False
    except FileNotFoundError:
        failed = True
    return rows.select("k", "name", F.lit(failed).alias("missing_is_error"))


@query("WITH chat AS (SELECT conv_id, count(*) AS turns, arg_min(text, turn) AS first FROM conversations GROUP BY conv_id) SELECT f AS suffix, row_number() OVER (PARTITION BY f ORDER BY conv_id) - 1 AS place, turns, first FROM chat, (SELECT unnest(['json', 'jsonl']) AS f)")
def sharegpt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = folder_of(spark, "sharegpt")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("_ord")).agg(turns.alias("t"))
    rows = rows.select("_ord", F.transform("t", lambda t: F.struct(t["role"].alias("from"), t["text"].alias("value"))).alias("conversations"), F.array().cast("array<string>").alias("images"))
    out = None
    for suffix in ("json", "jsonl"):
        path = f"{folder}/chat.{suffix}"
        tables.export_array(rows, path, ["_ord"], as_lines=suffix == "jsonl")
        read = _placed(tables.read_array(spark, path, tables.SHAREGPT).select("conversations", "_ord"))
        part = read.select(F.lit(suffix).alias("suffix"), "place", F.size("conversations").cast("long").alias("turns"), F.element_at("conversations", 1)["value"].alias("first"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"WITH {RUNS_SQL} SELECT sample_id FROM (SELECT * FROM runs ORDER BY status DESC, ord LIMIT 60)")
def head_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.head(tables.read_dataset(spark, _run_folder(spark, sf_dir)), 60).select("sample_id")


_CALL_TEXT = """'[{"role":"system","content":"look"},{"role":"user","content":[' || CASE WHEN url IS NULL THEN '' ELSE '{"type":"image_url","image_url":{"url":"' || url || '"}},' END || '{"type":"text","text":"read ' || k || '"}]}]'"""


@query(f"""WITH {_SAMPLES_SQL}, urls AS (SELECT sample_id, k, CASE k % 3 WHEN 2 THEN NULL ELSE 'data:image/jpeg;base64,' || base64(encode('picture ' || (k % 3))) END AS url FROM samples) SELECT sample_id, url AS image_url, {_CALL_TEXT} AS messages FROM urls""")
def image_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with the first image as a data URL; a file that isn't there is left out."""
    folder = folder_of(spark, "images")
    for i in (0, 1):
        tables.export_text(spark, f"{folder}/i{i}.jpg", f"picture {i}")
    samples = tables.read_samples(spark, _samples_file(spark, sf_dir))
    found = batches.with_image(samples, folder).select("sample_id", "_source", "_ord", "image_url")
    asked = batches.requests(samples, "look", folder).select("_ord", "messages")
    return found.join(asked, "_ord").select("sample_id", "image_url", "messages")


# --- sinks ---


@query(f"WITH {RUNS_SQL} SELECT sample_id FROM runs WHERE sample_id NOT IN (SELECT sample_id FROM runs WHERE status = 'success')")
def resume_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder_of(spark, "done")
    every = runs(spark, sf_dir)
    tables.write_records(every.filter("status = 'success'"), path)
    return assemble.pending(every, tables.processed_ids(spark, path)).select("sample_id")


@query("SELECT 'c' || c_custkey AS sample_id FROM customer WHERE c_custkey % 5 <> 0")
def tolerant_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are cut short, blank, or of another kind are left out, and so is a broken file."""
    folder = folder_of(spark, "broken")
    k = F.col("c_custkey")
    good = F.concat(F.lit('{"sample_id": "c'), k.cast("string"), F.lit('"}'))
    line = F.when(k % 5 > 0, good).when(k % 3 == 0, F.substring(good, 1, 12)).when(k % 3 == 1, F.lit("[1, 2]")).otherwise(F.lit(""))
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(f"{folder}/lines")
    tables.export_text(spark, f"{folder}/array.json", '[{"sample_id": "x"}, {"sample')
    read = lambda path, lines: tables.read_array(spark, path, "sample_id string", lines=lines).select("sample_id")
    return read(f"{folder}/lines", True).unionByName(read(f"{folder}/array.json", False))


@query("SELECT p_partkey AS k, p_name || ' é' AS name, '{\"size\": ' || p_size || ', \"a\": [1, null]}' AS ground_truth FROM part")
def atomic_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that is replaced as a whole; columns of JSON text hold values in it."""
    path = f"{folder_of(spark, 'export')}/records.json"
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.concat("p_name", F.lit(" é")).alias("name"), F.concat(F.lit('{"size":'), F.col("p_size").cast("string"), F.lit(',"a":[1,null]}')).alias("ground_truth"))
    tables.export_array(rows.limit(1), path, ["k"], nested=("ground_truth",))
    tables.export_array(rows.withColumn("_ord", F.col("k")), path, ["_ord"], nested=("ground_truth",))
    return tables.read_array(spark, path, "k long, name string, ground_truth string").select("k", "name", jsonx.extract_json(F.col("ground_truth")).alias("ground_truth"))


@query(f"WITH {CHATS_SQL} SELECT f AS suffix, row_number() OVER (PARTITION BY f ORDER BY k) - 1 AS place, CASE WHEN k % 3 = 0 THEN '<image>' || chr(10) ELSE '' END || human || chr(10) || '/think' AS human, reply AS gpt FROM chats, (SELECT unnest(['json', 'jsonl']) AS f) WHERE human IS NOT NULL AND reply <> ''")
def training_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = folder_of(spark, "training")
    rows = training.as_chat(training.training_rows(chat_records(spark, sf_dir), "raw"))
    out = None
    for suffix in ("json", "jsonl"):
        path = f"{folder}/train.{suffix}"
        tables.export_array(rows.select("_ord", F.to_json(F.struct("conversations", "images")).alias("j")), path, ["_ord"], as_lines=suffix == "jsonl", json_column="j")
        read = _placed(tables.read_array(spark, path, tables.SHAREGPT).select("conversations", "_ord"))
        turn = lambda i: F.element_at("conversations", i)["value"]
        part = read.select(F.lit(suffix).alias("suffix"), "place", turn(1).alias("human"), turn(2).alias("gpt"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT event_id, count(*) AS lines FROM (SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_type = 'error') GROUP BY event_id")
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh log replaces what was there; a resumed one goes on with it."""
    path = folder_of(spark, "log")
    rows = telemetry(spark, sf_dir).select("event_id", "outcome", F.to_json(F.struct("event_id", "sample_id", "rtt")).alias("value"))
    tables.append_events(rows.limit(3).select("value"), path, fresh=True)
    tables.append_events(rows.select("value"), path, fresh=True)
    tables.append_events(rows.filter("outcome <> 'OK'").select("value"), path)
    return spark.read.schema("event_id long").json(path).groupBy("event_id").agg(F.count("*").alias("lines"))


@query(f"WITH {RUNS_SQL} SELECT count(*) AS total_in, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status <> 'success') AS failed, CAST(NULL AS VARCHAR) AS note FROM runs")
def summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{folder_of(spark, 'summary')}/summary.json"
    good = F.count_if(F.col("status") == "success")
    tables.export_summary(runs(spark, sf_dir).agg(F.count("*").alias("total_in"), good.alias("success"), (F.count("*") - good).alias("failed"), F.lit(None).cast("string").alias("note")), path)
    return spark.read.schema("total_in long, success long, failed long, note string").option("multiLine", "true").json(path)


# --- model calls and batches ---

FAULTS = Faults(network=0.2, rate_limited=0.1, gateway=0.1, api=0.05, empty=0.05, truncated=0.05)


def share_sql(*parts: str) -> str:
    """The stand-in's number in 0..1 for some parts, in SQL."""
    text = " || ':' || ".join(["'42'", *parts])
    return f"(('0x' || substr(md5({text}), 1, 12))::BIGINT / 281474976710656)"


def fault_sql(u: str) -> str:
    edges, at = [], 0.0
    for share, name in ((0.2, "NETWORK_ERROR"), (0.1, "RATE_LIMITED"), (0.1, "GATEWAY_ERROR"), (0.05, "API_ERROR"), (0.05, "EMPTY_RESPONSE"), (0.05, "LENGTH_TRUNCATED")):
        at += share
        edges.append(f"WHEN {u} < {at!r} THEN '{name}'")
    return f"CASE {' '.join(edges)} ELSE 'OK' END"


@query(f"WITH calls AS (SELECT c_custkey AS k, n, {share_sql('c_custkey', 'n')} AS u FROM customer, (SELECT unnest([1, 2]) AS n)), said AS (SELECT *, {fault_sql('u')} AS outcome FROM calls) SELECT k, CAST(n AS INTEGER) AS attempt_no, outcome, CASE WHEN outcome = 'RATE_LIMITED' THEN 1.5 END::DOUBLE AS retry_after, CASE outcome WHEN 'OK' THEN 'reply ' || k WHEN 'EMPTY_RESPONSE' THEN '' WHEN 'LENGTH_TRUNCATED' THEN '' END AS content FROM said")
def model_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each call of the stand-in once, whatever partitions it is made in."""
    model = stand_in(lambda k, u: f"reply {k}", FAULTS)
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt_no"))
    return model_calls(rows.repartition(3), model).select(F.col("sample_id").alias("k"), "attempt_no", "outcome", "retry_after", "content")


_GENERATED = f"""attempts AS (SELECT 's' || c_custkey AS sample_id, n AS attempt_no, {share_sql("'s' || c_custkey", 'n')} AS u, {share_sql("'s' || c_custkey", 'n', "'answer'")} AS v FROM customer, (SELECT unnest(range(1, 8)) AS n) WHERE c_custkey % 10 > 0),
 named AS (SELECT sample_id, attempt_no, {fault_sql('u')} AS outcome, CASE WHEN {fault_sql('u')} = 'OK' THEN CASE WHEN v < 0.3 THEN 'STRICT' WHEN v < 0.9 THEN 'MISMATCH' END END AS match_level, CASE WHEN {fault_sql('u')} = 'OK' AND v < 0.9 THEN CASE WHEN v < 0.3 THEN 2 WHEN v < 0.6 THEN 1 ELSE 0 END END AS matched FROM attempts)"""
_RECORDS = outcome_sql(_GENERATED, "named")


@query(f"WITH records AS ({_RECORDS}) SELECT sample_id, status, CAST(attempts AS INTEGER) AS attempts, error_type, match_level, status <> 'open' AND (match_level IS NOT NULL OR error_type IN ('JSON_PARSE_ERROR', 'NETWORK_ERROR', 'RATE_LIMITED', 'GATEWAY_ERROR')) AS has_truth FROM records UNION ALL SELECT 's' || c_custkey, 'failed', 1, 'JSON_PARSE_ERROR', NULL, false FROM customer WHERE c_custkey % 10 = 0")
def generated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples to records over the stand-in: rounds, budgets, best replies, unusable ground truth."""
    run = _generated(spark, sf_dir)
    return run.records.select("sample_id", "status", "attempts", "error_type", "match_level", F.col("ground_truth").isNotNull().alias("has_truth"))


def _generated(spark: SparkSession, sf_dir: str, done: DataFrame | None = None) -> batches.Batch:
    ensure_checkpoints(spark)

    def answer(k: str, u: float) -> str:
        if u < 0.3:
            return '{"a": "x", "b": 1}'
        return f'so {{"a": "x", "b": {int(u * 10)}}}' if u < 0.6 else '{"a": "y", "b": 5}' if u < 0.9 else "no object"

    k = F.col("c_custkey")
    truth = F.when(k % 20 == 0, "{}").when(k % 10 == 0, "none").otherwise('{"a": "x", "b": 1}')
    message = lambda who, text: F.struct(F.lit(who).alias("role"), text.alias("content"))
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("s"), k.cast("string")).alias("id"), F.array(message("user", F.lit("q")), message("assistant", truth)).alias("messages"), F.lit(None).cast("array<struct<from: string, value: string>>").alias("conversations"), F.array().cast("array<string>").alias("images"), F.lit("customer").alias("_source"), k.alias("_ord")
    )
    return batches.generated(rows.withColumn("sample_id", F.col("id")), stand_in(answer, FAULTS), done=done)


@query(f"WITH records AS ({_RECORDS}), n AS (SELECT count(*) AS n FROM customer WHERE c_custkey % 10 = 0), kept AS (SELECT * FROM records WHERE CAST(substr(sample_id, 2) AS BIGINT) % 2 = 1) SELECT (SELECT count(*) FROM customer) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status <> 'success') AS failed, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS skipped, count(*) FILTER (status = 'success') / count(*) AS success_rate FROM kept")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that goes on after every second sample is done."""
    done = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("sample_id"))
    run = _generated(spark, sf_dir, done)
    return verdicts.run_counters(run.records, run.skipped["skipped"])


_ROUNDS = f"""calls AS (SELECT o_orderkey AS k, n, {share_sql("'j' || o_orderkey", 'n')} AS u FROM orders, (SELECT unnest(range(1, 6)) AS n)),
 named AS (SELECT k, n, {fault_sql('u')} AS outcome FROM calls),
 ends AS (SELECT k, CASE WHEN count(*) FILTER (outcome NOT IN ('NETWORK_ERROR', 'RATE_LIMITED', 'GATEWAY_ERROR')) = 0 THEN 5 ELSE min(n) FILTER (outcome NOT IN ('NETWORK_ERROR', 'RATE_LIMITED', 'GATEWAY_ERROR')) END AS attempts FROM named GROUP BY k),
 final AS (SELECT e.k, e.attempts, c.outcome, {share_sql("'j' || e.k", 'e.attempts', "'answer'")} AS v FROM ends e JOIN named c ON e.k = c.k AND e.attempts = c.n),
 told AS (SELECT *, CASE WHEN outcome IN ('NETWORK_ERROR', 'RATE_LIMITED', 'GATEWAY_ERROR') THEN 'network_exhausted' WHEN outcome <> 'OK' THEN 'terminal_error' WHEN v >= 0.8 THEN 'parse' END AS failure FROM final)"""


def _failed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed records from orders: most have a difference, every sixth has none."""
    k = F.col("o_orderkey")
    one = F.struct(F.lit("total").alias("field"), F.lit("mismatch").alias("type"), F.lit("1").alias("ground_truth"), F.lit("2").alias("predicted"), F.lit("1").alias("gt_normalized"), F.lit("2").alias("pred_normalized"))
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("j"), k.cast("string")).alias("sample_id"), F.lit("failed").alias("status"), F.when(k % 6 > 0, F.array(one)).otherwise(F.array().cast("array<struct<field: string, type: string, ground_truth: string, predicted: string, gt_normalized: string, pred_normalized: string>>")).alias("d"), F.lit("orders").alias("_source"), k.alias("_ord"))
    comparison = F.struct(*((F.col("d") if f.name == "differences" else F.lit(None).cast(f.dataType)).alias(f.name) for f in spark.createDataFrame([], tables.COMPARISON).schema))
    return batches.record_columns(rows.withColumn("comparison_result", comparison))


@query(f"WITH {_ROUNDS} SELECT 'j' || k AS sample_id, CAST(attempts AS INTEGER) AS attempts, CASE failure WHEN 'parse' THEN 'judge_parse_failed' ELSE failure END AS failure, failure IS NULL AND v < 0.5 AS overturned, CASE WHEN failure IS NULL AND v < 0.5 THEN 'success' ELSE 'failed' END AS status FROM told WHERE k % 6 > 0")
def judged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second opinions over the stand-in: only the network is tried again, five calls at the most."""
    run = _judged(spark, sf_dir)
    return run.records.select("sample_id", "judge_result.attempts", "judge_result.failure", "judge_result.overturned", "status")


def _judged(spark: SparkSession, sf_dir: str, done: DataFrame | None = None) -> batches.Batch:
    ensure_checkpoints(spark)
    said = lambda u: '{"verdicts": [5, {"field": "total", "match": true}]}' if u < 0.5 else '{"verdicts": [{"field": "total", "match": "true"}]}' if u < 0.8 else '{"verdicts": {}}'
    return batches.judged(_failed_records(spark, sf_dir), stand_in(lambda k, u: said(u), FAULTS), done=done)


@query(f"WITH {_ROUNDS}, asked AS (SELECT * FROM told WHERE k % 6 > 0 AND k % 4 > 0) SELECT count(*) AS judged, count(*) FILTER (failure IS NULL AND v < 0.5) AS overturned, count(*) FILTER (failure IS NULL AND v >= 0.5) AS upheld, count(*) FILTER (failure = 'parse') AS judge_parse_failed, count(*) FILTER (failure = 'network_exhausted') AS network_exhausted, count(*) FILTER (failure = 'terminal_error') AS terminal_error, (SELECT count(*) FROM orders WHERE o_orderkey % 6 = 0) AS skipped_no_differences, (SELECT count(*) FROM orders WHERE o_orderkey % 6 > 0 AND o_orderkey % 4 = 0) AS skipped_resume, count(*) FILTER (failure IS NULL AND v < 0.5) / count(*) AS overturn_rate, CAST(sum(attempts) AS BIGINT) AS calls FROM asked")
def judged_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge that goes on after every fourth record is done."""
    from ..operators import adjudicate

    done = _failed_records(spark, sf_dir).filter("_ord % 4 = 0")
    run = _judged(spark, sf_dir, done)
    return adjudicate.judge_summary(run.records, **run.skipped).join(timing.call_metrics(run.calls).select(F.col("total_http_requests").alias("calls")))


@query(f"WITH {_ROUNDS} SELECT 'j' || k AS sample_id, CAST(attempts AS INTEGER) AS attempts, CASE failure WHEN 'parse' THEN 'parse_failed' ELSE failure END AS failure, failure IS NULL AND v < 0.5 AS applied, CASE WHEN failure IS NULL THEN CASE WHEN v < 0.5 THEN 'NORMALIZED_MATCH' ELSE 'MISMATCH' END END AS match_level, CASE WHEN failure IS NULL THEN 'c' END AS polished_cot FROM told WHERE k % 5 > 0")
def polished_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoints(spark)
    k = F.col("o_orderkey")
    sample = F.concat(F.lit('{"messages": [{"role": "user", "content": "q '), k.cast("string"), F.lit('"}]}'))
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("j"), k.cast("string")).alias("sample_id"), F.lit("success").alias("status"), F.when(k % 5 > 0, sample).otherwise(F.lit('{"messages": []}')).alias("original_sample"), F.lit('because {"a": "x,y"}').alias("cot_response"), F.lit('{"a": "x,y"}').alias("predicted_json"), F.lit("orders").alias("_source"), k.alias("_ord")
    )
    said = lambda u: '{"cot": " c ", "answer": {"a": "x , y"}}' if u < 0.5 else '{"cot": "c", "answer": {"a": "z"}}' if u < 0.8 else '{"cot": 1, "answer": {"a": "z", "cot": "y"}}'
    run = batches.rewritten(batches.record_columns(rows), stand_in(lambda k, u: said(u), FAULTS))
    result = lambda n: F.col(f"polish_result.{n}")
    return run.records.select("sample_id", *(result(n) for n in ("attempts", "failure", "applied", "match_level", "polished_cot")))


@query("""SELECT p_partkey AS sample_id, 'question:' || chr(10) || 'What is ' || p_brand || chr(10) || chr(10) || CASE WHEN p_partkey % 10 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN 'reasoning:' || chr(10) || 'it is' || chr(10) || chr(10) ELSE 'reasoning:' || chr(10) || 'because' || chr(10) || chr(10) END || 'answer:' || chr(10) || '{"name": "' || CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END || '", "size": ' || p_size || '}' AS prompt FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 6 <> 0""")
def rewrite_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rewrite.material(rewritable(spark, sf_dir), rewrite.REPAIR)
    return rows.select("sample_id", rewrite.prompt(rewrite.REPAIR, F.col("question"), F.col("cot"), F.col("answer")).alias("prompt"))


@query(f"WITH {RUNS_SQL} SELECT sample_id, count(*) AS n FROM judged WHERE judge_failure IS NOT NULL GROUP BY sample_id")
def judged_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(spark, sf_dir).withColumn("judge_result", F.when(F.col("judge_failure").isNotNull(), F.struct("judge_failure")))
    return assemble.judged_only(rows).groupBy("sample_id").agg(F.count("*").alias("n"))


# --- training rows ---


def chat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = chats(spark, sf_dir).filter("human is not null")
    return rows.select("*", none.alias("reasoning"), none.alias("polished_cot"), none.alias("polished_answer"), F.concat(F.lit('{"k": '), F.col("sample_id").cast("string"), F.lit("}")).alias("predicted_json"))


def _answer_sql(value: str) -> str:
    return f"""'<answer>{{' || chr(10) || '  "k": ' || {value} || chr(10) || '}}</answer>'"""


@query(f"WITH {CHATS_SQL} SELECT k AS sample_id, CASE WHEN k % 3 = 0 THEN '<image>' || chr(10) ELSE '' END || human || chr(10) || '/no_think' AS human, {_answer_sql('k')} AS gpt FROM chats WHERE human IS NOT NULL")
def training_rows_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.training_rows(chat_records(spark, sf_dir), "json").select("sample_id", "human", "gpt")


@query(f"WITH {CHATS_SQL}, said AS (SELECT *, CASE k % 3 WHEN 0 THEN 'polished' WHEN 1 THEN 'channel' ELSE CASE WHEN reply IS NULL THEN '' ELSE {stripped_sql('reply')} END END AS cot FROM chats WHERE human IS NOT NULL) SELECT k AS sample_id, CASE WHEN cot = '' THEN '' ELSE '<why>' || cot || '</why>' || chr(10) END || replace({_answer_sql('CASE WHEN k % 3 = 0 THEN -k ELSE k END')}, 'answer>', 'out>') AS gpt, right(human, 0) || CASE WHEN cot = '' THEN '/fast' ELSE '/slow' END AS flag FROM said")
def training_rows_polished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rewritten chain, else the reasoning channel, else the reply; flags and tags of one's own."""
    three = F.col("sample_id") % 3
    rows = chat_records(spark, sf_dir).withColumn("polished_cot", F.when(three == 0, " polished\n").when(three == 1, "  ")).withColumn("reasoning", F.when(three < 2, "\tchannel ").otherwise(" "))
    rows = rows.withColumn("polished_answer", F.when(three == 0, F.concat(F.lit('{"k": '), (-F.col("sample_id")).cast("string"), F.lit("}"))))
    done = training.training_rows(rows, think_flag="/slow", no_think_flag="/fast", think_tag="why", answer_tag="out")
    return done.select("sample_id", "gpt", F.element_at(F.split("human", "\n"), -1).alias("flag"))


@query("SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'plain ' || o_orderstatus WHEN 1 THEN 'one' || chr(10) || chr(10) || o_orderstatus WHEN 2 THEN 'said ' || o_orderstatus WHEN 3 THEN '' ELSE '' END AS x FROM orders")
def human_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain messages, messages of parts, conversations, neither, and content that is no text."""
    five, state = F.col("o_orderkey") % 5, F.col("o_orderstatus")
    parts = F.concat(F.lit('[{"type": "text", "text": "one"}, {"type": "image"}, {"text": "'), state, F.lit('"}]'))
    content = F.when(five == 0, F.concat(F.lit("plain "), state)).when(five == 1, parts)
    messages = F.when(five.isin(0, 1, 4), F.array(F.struct(F.lit("user").alias("role"), content.alias("content")))).otherwise(F.array().cast("array<struct<role: string, content: string>>"))
    said = F.when(five == 2, F.array(F.struct(F.lit("human").alias("from"), F.concat(F.lit("said "), state).alias("value"))))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), training.human_text(messages, said).alias("x"))


@query("SELECT o_orderkey AS k, s AS source FROM orders, (SELECT unnest(['upheld', 'mismatch', 'all']) AS s) WHERE s = 'all' OR (s = 'mismatch' AND o_orderkey % 2 = 0) OR (s = 'upheld' AND o_orderkey % 4 = 1)")
def failed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    result = F.when(k % 4 > 0, F.struct((k % 4 == 2).alias("overturned"), F.when(k % 4 == 3, "terminal_error").alias("failure")))
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), result.alias("judge_result"), F.when(k % 2 == 0, F.array(F.lit("d"))).otherwise(F.array().cast("array<string>")).alias("differences"))
    part = lambda s: rows.filter(training.failed_eligible(s)).select("k", F.lit(s).alias("source"))
    return part("upheld").unionByName(part("mismatch")).unionByName(part("all"))


# --- telemetry and tools ---

_EVENTS_SQL = f"WITH {TELEMETRY_SQL}, ranked AS (SELECT list_sort(list(rtt)) AS r, count(*) AS n FROM requests)"


def _pick_sql(q: int) -> str:
    return f"round_even(r[CAST(round_even(CAST({q} AS DOUBLE) / 100 * (n - 1), 0) AS BIGINT) + 1], 2)"


@query(f"{_EVENTS_SQL}, sums AS (SELECT sum(wait_limiter) AS l, sum(wait_slot) AS s, sum(rtt) AS t FROM requests) SELECT n AS total_requests, " + ", ".join(f"{_pick_sql(q)} AS rtt_p{q}" for q in (50, 95, 99)) + ", round_even(l, 2) AS wait_limiter, round_even(t / (l + s + t), 4) AS rtt_share, CAST(0 AS DOUBLE) AS backoff FROM ranked, sums")
def performance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report in one row; the backoff of request events doesn't count."""
    report = timing.performance(telemetry(spark, sf_dir), 21600.0)
    total, part = F.col("phase_totals"), F.col("phase_shares")
    return report.select("total_requests", "rtt_p50", "rtt_p95", "rtt_p99", total["wait_limiter"].alias("wait_limiter"), part["rtt"].alias("rtt_share"), total["backoff"].alias("backoff"))


@query(f"{_EVENTS_SQL}, last AS (SELECT max(started) AS t, count(DISTINCT sample_id) AS c FROM requests), recent AS (SELECT count(*) AS m FROM requests, last WHERE started >= t - 86400) SELECT CAST(7 AS INTEGER) AS in_flight, m * CAST(60.0 / 86400 AS DOUBLE) AS effective_qpm, c AS completed, {_pick_sql(50)} AS rtt_p50 FROM ranked, last, recent")
def progress_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry(spark, sf_dir)
    now = rows.agg(F.max("started")).first()[0]
    return timing.progress(rows, now, 86400.0, 7, 0).select("in_flight", "effective_qpm", "completed", F.bround("rtt_p50", 2).alias("rtt_p50"))


@query(f"""WITH {RUNS_SQL}, kept AS (SELECT r.sample_id, CASE WHEN r.status = 'success' OR i.status = 'success' THEN 'success' ELSE 'failed' END AS status, r.ord FROM runs r LEFT JOIN ids i ON r.sample_id = i.sample_id AND r.status <> 'success') SELECT sample_id, status, count(*) AS n FROM kept GROUP BY sample_id, status""")
def merge_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command line's merge over dataset folders."""
    from .. import cli

    failure = F.struct(F.lit(False).alias("overturned"), F.col("judge_failure").alias("failure"))
    opinions = judged(spark, sf_dir).withColumn("judge_result", failure).drop("judge_failure")
    out = folder_of(spark, "merged")
    args = cli.parser().parse_args(["merge", "--run", _run_folder(spark, sf_dir), "--judge", _dataset(spark, opinions, "judged"), "--output", out])
    args.run_tool(spark, args)
    return tables.read_dataset(spark, out).groupBy("sample_id", "status").agg(F.count("*").alias("n"))


@query("SELECT user_id, arg_max(event_type, ts) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that stops, and goes on from its checkpoint when more has come."""
    folder = folder_of(spark, "resumed")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts")
    for part in (0, 1, 2):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{folder}/in")
        rows = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        flows.upsert_stream(rows, f"{folder}/table", f"{folder}/state", ["user_id"], "ts").awaitTermination()
    return flows.newest(spark, f"{folder}/table").select("user_id", "event_type", "event_id")


@query(f"""WITH {CHATS_SQL}, kept AS (SELECT * FROM chats WHERE human IS NOT NULL), good AS (SELECT count(*) AS n, count(*) FILTER (k % 5 > 0) AS made FROM kept WHERE k % 2 = 0), bad AS (SELECT count(*) AS n FROM kept WHERE k % 2 = 1 AND k % 4 = 1),
b AS (SELECT CAST(floor(0.9 * made) AS BIGINT) AS budget FROM good), mix AS (SELECT count(DISTINCT conv_id) AS n FROM conversations)
SELECT good.n AS total_records, made AS converted, good.n - made AS skipped, budget AS no_cot_budget, least(budget, bad.n) AS failed_used, least(budget, bad.n) AS failed_gt_recovered, least(budget - least(budget, bad.n), mix.n) AS mixed_in, made + least(budget, bad.n) + least(budget - least(budget, bad.n), mix.n) AS total_samples, 'thinking' AS gpt_mode, 'upheld' AS include_failed, 'jsonl' AS format FROM good, bad, b, mix""")
def convert_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command line's convert, with hard examples and external rows, and its summary."""
    from .. import cli

    k = F.col("sample_id")
    text = F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.col("human").alias("content")), F.struct(F.lit("assistant").alias("role"), F.lit('{"t": 1}').alias("content"))).alias("messages")))
    rows = chats(spark, sf_dir).filter("human is not null").select(
        k.cast("string").alias("sample_id"), F.when(k % 2 == 0, "success").otherwise("failed").alias("status"), text.alias("original_sample"), F.col("reply").alias("cot_response"), F.when(k % 5 > 0, F.lit('{"a": 1}')).alias("predicted_json"),
        F.when(k % 4 == 1, F.struct(F.lit(False).alias("overturned"))).when(k % 4 == 3, F.struct(F.lit(True).alias("overturned"))).alias("judge_result"), "_ord",
    )
    folder = folder_of(spark, "convert")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    mix = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("_ord")).agg(turns.alias("t"))
    mix = mix.select("_ord", F.transform("t", lambda t: F.struct(t["role"].alias("from"), t["text"].alias("value"))).alias("conversations"))
    tables.export_array(mix, f"{folder}/mix.jsonl", ["_ord"], as_lines=True)
    argv = ["convert", "--input", _dataset(spark, rows, "records"), "--output", f"{folder}/train.jsonl", "--include-failed", "--mix", f"{folder}/mix.jsonl", "--mix-ratio", "0.9"]
    args = cli.parser().parse_args(argv)
    args.run_tool(spark, args)
    counts = ["total_records", "converted", "skipped", "no_cot_budget", "failed_used", "failed_gt_recovered", "mixed_in", "total_samples"]
    told = spark.read.schema(", ".join([*(f"{c} long" for c in counts), "gpt_mode string", "include_failed string", "format string"])).option("multiLine", "true").json(f"{folder}/convert_summary.json")
    n = tables.read_array(spark, f"{folder}/train.jsonl", tables.SHAREGPT).count()
    return told.filter(F.col("total_samples") == n)

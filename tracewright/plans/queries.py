"""Registered queries of the engine's own operators, each with its counterpart in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonx
from ..functions.compare import classify_first, compare_first, comparison, difference_report, differences, field_verdicts, long_form
from ..functions.textnorm import DEFAULT, LEGACY, normalize, normalize_diagnostic, normalize_first
from ..operators import adjudicate, assemble, lifecycle, rewrite, training, verdicts
from ..operators import telemetry as telemetry_module
from ..streaming import flows
from .registry import ORACLE_SQL, QUERIES, query
from .round_trips import chat_records, folder_of
from .session import ensure_checkpoints
from .views import (
    ATTEMPTS_SQL, CHATS_SQL, FIELDS_SQL, FOLD_SQL, LEVELS_SQL, RUNS_SQL, SOURCES_SQL, TELEMETRY_SQL,
    answers, attempts, chats, first_sql, judged, legacy_sql, normalized_sql, outcome_sql, rewritable, runs, sources, stripped_sql, table, telemetry,
)

__all__ = ["ORACLE_SQL", "QUERIES"]

# --- text ---

_NOISY = "CASE c_custkey % 4 WHEN 0 THEN '  ' || c_name || ' ： ' || c_mktsegment WHEN 1 THEN '（' || c_name || '），￥１，２３４' WHEN 2 THEN 'A  B ' || c_mktsegment || '… € 5' ELSE '《' || lower(c_name) || '》 — £1,234,567 ' END"


def _noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.expr(_NOISY).alias("x"))


@query(f"SELECT c_custkey AS k, {normalized_sql(_NOISY)} AS x FROM customer")
def norm_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noisy(spark, sf_dir).select("k", normalize(F.col("x"), DEFAULT).alias("x"))


@query(f"SELECT c_custkey AS k, {legacy_sql(_NOISY)} AS x FROM customer")
def norm_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noisy(spark, sf_dir).select("k", normalize(F.col("x"), LEGACY).alias("x"))


@query(f"SELECT c_custkey AS k, {first_sql(_NOISY)} AS x FROM customer")
def norm_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noisy(spark, sf_dir).select("k", normalize_first(F.col("x")).alias("x"))


@query(f"SELECT c_custkey AS k, trim(replace(replace(translate({_NOISY}, '(),', '（），'), ' ', ''), '¥', '')) AS x FROM customer")
def norm_diagnostic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noisy(spark, sf_dir).select("k", normalize_diagnostic(F.col("x")).alias("x"))


# --- JSON in text ---

_PRED_SQL = f"""WITH {FIELDS_SQL},
wide AS (SELECT k, max(CASE field WHEN 'name' THEN p END) AS name, max(CASE field WHEN 'segment' THEN p END) AS seg, max(CASE field WHEN 'nation' THEN CASE pt WHEN 'str' THEN '"' || p || '"' ELSE p END END) AS n,
 max(CASE field WHEN 'items[0].balance' THEN p END) AS bal, k % 7 = 5 AS noted FROM fields GROUP BY k),
preds AS (SELECT k, '{{"name": "' || name || '"' || CASE WHEN seg IS NULL THEN '' ELSE ', "segment": "' || seg || '"' END || ', "nation": ' || n || ', "items": [{{"balance": ' || bal || '}}]' || CASE WHEN noted THEN ', "note": null' ELSE '' END || '}}' AS pred FROM wide)"""


@query(f"{_PRED_SQL} SELECT k, pred AS found FROM preds")
def extract_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(spark, sf_dir).select("k", jsonx.extract_json(F.col("reply")).alias("found"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(jsonx.extract_json(F.concat(F.lit("props: "), "props", F.lit("."))), "$.k").cast("long").alias("k"))


@query(f"{_PRED_SQL} SELECT k, CAST(CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 26 WHEN 2 THEN 20 ELSE 8 END AS INTEGER) AS start, CAST(CASE k % 4 WHEN 0 THEN 2 WHEN 1 THEN 26 WHEN 2 THEN 20 ELSE 8 END + length(pred) AS INTEGER) AS stop FROM preds")
def reply_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = jsonx.json_span(F.col("reply"))
    return answers(spark, sf_dir).select("k", span.alias("s")).select("k", "s.start", "s.stop")


@query(f"{_PRED_SQL} SELECT k, pred AS found FROM preds")
def extract_first_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(spark, sf_dir).select("k", jsonx.extract_json_first(F.concat(F.lit("```json\n"), "pred", F.lit("\n```"))).alias("found"))


@query(f"WITH {FIELDS_SQL} SELECT k, field AS path, pt AS kind, CASE WHEN pt = 'null' THEN 'None' ELSE p END AS shown FROM fields WHERE pt IS NOT NULL")
def flatten_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = answers(spark, sf_dir).select("k", F.explode(jsonx.flatten_json(F.col("pred"))).alias("x"))
    return rows.select("k", "x.path", "x.kind", F.col("x.pystr").alias("shown"))


@query("""SELECT n_nationkey AS k, '{' || chr(10) || '  "name": "' || n_name || '",' || chr(10) || '  "tags": [' || chr(10) || '    ' || n_regionkey || ',' || chr(10) || '    1.50' || chr(10) || '  ]' || chr(10) || '}' AS shown FROM nation""".replace("1.50", "1.5"))
def pretty_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('{"name":"'), "n_name", F.lit('","tags":['), F.col("n_regionkey").cast("string"), F.lit(",1.50]}"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), jsonx.pretty_json(text).alias("shown"))


@query(f"{_PRED_SQL} SELECT k, 'Reading' || chr(10) || pred || chr(10) AS x FROM preds")
def fences_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(spark, sf_dir).select("k", jsonx.strip_fences(F.concat(F.lit("Reading\n```json\n"), "pred", F.lit("\n```"))).alias("x"))


# --- comparison ---


def _compared(spark: SparkSession, sf_dir: str, config=DEFAULT) -> DataFrame:  # noqa: ANN001
    rows = answers(spark, sf_dir).select("k", "nation", jsonx.flatten_json(jsonx.extract_json(F.col("reply"))).alias("p"), jsonx.flatten_json(F.col("gt")).alias("g"))
    fields = rows.withColumn("fields", field_verdicts(F.col("p"), F.col("g"), config))
    return fields.withColumn("c", comparison(F.col("fields"), F.col("g")))


_FIELDS = f"WITH {LEVELS_SQL} SELECT k, field, level FROM verdicts"


@query(_FIELDS)
def field_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).select("k", F.explode("fields").alias("f")).select("k", "f.field", "f.level")


@query(_FIELDS)
def field_levels_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = answers(spark, sf_dir).select("k", jsonx.flatten_json(F.col("pred")).alias("p"), jsonx.flatten_json(F.col("gt")).alias("g"))
    return long_form(rows, "k", "p", "g").select("k", "field", "level")


_SAMPLE = "k, match_level, match_score, match_level <> 'MISMATCH' AS is_match, match_level = 'MISMATCH' AND match_score >= 0.95 AS is_partial, matched AS matched_fields, mismatched AS mismatched_fields, extra AS extra_fields, missing AS missing_fields"


@query(f"WITH {LEVELS_SQL} SELECT {_SAMPLE}, CAST(4 AS BIGINT) AS total_fields FROM levels")
def sample_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("match_level", "match_score", "is_match", "is_partial", "matched_fields", "mismatched_fields", "extra_fields", "missing_fields", "total_fields")
    return _compared(spark, sf_dir).select("k", *(f"c.{n}" for n in names))


@query(f"WITH {LEVELS_SQL} SELECT {_SAMPLE}, CAST(4 AS BIGINT) AS total_fields, CAST(mismatched + missing + extra AS INTEGER) AS differences, CAST(NULL AS VARCHAR) AS error, matched AS matched_field_count, total AS total_field_count, CAST(total AS INTEGER) AS fields FROM levels")
def comparison_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys of a comparison, its two lists by their lengths."""
    sizes = [F.size("c.differences").alias("differences"), F.size("c.fields").alias("fields")]
    rest = ("is_match", "match_score", "is_partial", "total_fields", "matched_fields", "mismatched_fields", "extra_fields", "missing_fields", "error", "match_level", "matched_field_count", "total_field_count")
    return _compared(spark, sf_dir).select("k", *(f"c.{n}" for n in rest), *sizes)


@query(
    f"WITH {LEVELS_SQL} SELECT k, field, CASE level WHEN 'MISMATCH' THEN 'mismatch' WHEN 'KEY_MISSING_IN_PRED' THEN 'missing' ELSE 'extra' END AS type, CASE WHEN level = 'MISMATCH' THEN {normalized_sql('g')} END AS gt_normalized, "
    f"CASE WHEN level = 'MISMATCH' THEN {normalized_sql('p')} END AS pred_normalized FROM verdicts WHERE level NOT IN ('STRICT', 'NORMALIZED')"
)
def field_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).select("k", F.explode(differences(F.col("fields"))).alias("d")).select("k", "d.field", "d.type", "d.gt_normalized", "d.pred_normalized")


@query(
    f"WITH {LEVELS_SQL} SELECT k, string_agg(CASE level WHEN 'MISMATCH' THEN 'mismatch' WHEN 'KEY_MISSING_IN_PRED' THEN 'missing' ELSE 'extra' END || ' ' || field || ' ' || CASE WHEN g IS NULL THEN '-' ELSE g END || ' <> ' || "
    "CASE WHEN level = 'KEY_MISSING_IN_GT' THEN 'None' WHEN p IS NULL THEN '-' ELSE p END, chr(10) ORDER BY field) AS report FROM verdicts WHERE level NOT IN ('STRICT', 'NORMALIZED') GROUP BY k"
)
def difference_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).select("k", difference_report(differences(F.col("fields"))).alias("report")).filter("report <> ''")


_LENIENT = f"""WITH {FIELDS_SQL},
kept AS (SELECT * FROM fields WHERE NOT (pt IS NOT NULL AND pt = 'null')),
verdicts AS (SELECT k, CASE WHEN pt IS NULL THEN 'KEY_MISSING_IN_PRED' WHEN pt = gt AND p = g THEN 'STRICT' WHEN {legacy_sql('p')} = {legacy_sql('g')} THEN 'NORMALIZED' ELSE 'MISMATCH' END AS level FROM kept)
SELECT k, CASE WHEN bool_and(level = 'STRICT') THEN 'STRICT' WHEN bool_and(level IN ('STRICT', 'NORMALIZED')) THEN 'NORMALIZED_MATCH' ELSE 'MISMATCH' END AS match_level FROM verdicts GROUP BY k"""


@query(_LENIENT)
def legacy_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir, LEGACY).select("k", "c.match_level")


def _shown_first(side: str) -> str:
    return f"CASE {side}t WHEN 'str' THEN {first_sql(side)} ELSE {side} END"


@query(
    f"WITH {FIELDS_SQL}, counted AS (SELECT k, count(*) FILTER (pt IS NOT NULL AND gt IS NOT NULL) AS common, count(*) FILTER (pt IS NOT NULL AND gt IS NOT NULL AND {_shown_first('p')} = {_shown_first('g')}) AS equal, 2 * count(*) FILTER (pt IS NULL) AS missing, count(*) FILTER (gt IS NULL) AS extra FROM fields GROUP BY k) "
    "SELECT k, equal = common AND missing = 0 AND extra = 0 AS is_match, equal / common AS match_score, CAST(missing AS BIGINT) AS missing_fields, CAST(extra AS BIGINT) AS extra_fields FROM counted"
)
def compare_first_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = F.replace("pred", F.lit("null"), F.lit('"x"'))
    rows = answers(spark, sf_dir).select("k", jsonx.top_level_json(pred).alias("p"), jsonx.top_level_json(F.col("gt")).alias("g"))
    rows = rows.select("k", compare_first(F.col("p"), F.col("g")).alias("c"))
    return rows.select("k", "c.is_match", "c.match_score", "c.missing_fields", "c.extra_fields")


@query(
    f"WITH {LEVELS_SQL}, whole AS (SELECT k, bool_and(p IS NOT NULL AND g IS NOT NULL AND p = g AND pt = gt) AS strict, bool_and(pt IS NOT NULL AND gt IS NOT NULL AND replace(replace(translate(p, '(),', '（），'), ' ', ''), '¥', '') = replace(replace(translate(g, '(),', '（），'), ' ', ''), '¥', '')) AS alike FROM fields GROUP BY k) "
    "SELECT k, CASE WHEN strict THEN 'STRICT_MATCH' WHEN alike THEN 'NORMALIZED_MATCH' ELSE 'MISMATCH' END AS match_level, CAST(CASE WHEN strict THEN 1 WHEN alike THEN 0.8 ELSE 0 END AS DOUBLE) AS match_score FROM whole"
)
def classify_first_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = answers(spark, sf_dir).select("k", classify_first(jsonx.flatten_json(F.col("pred")), jsonx.flatten_json(F.col("gt"))).alias("c"))
    return rows.select("k", "c.match_level", "c.match_score")


# --- aggregates over verdicts ---


def _exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).select("k", F.explode("fields").alias("f")).select("k", "f.field", "f.level")


_LEVEL_COUNTS = f"WITH {LEVELS_SQL}, names AS (SELECT unnest(['STRICT', 'NORMALIZED_MATCH', 'MISMATCH']) AS match_level) SELECT match_level, count(k) AS n FROM names LEFT JOIN levels USING (match_level) GROUP BY match_level"


@query(_LEVEL_COUNTS)
def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.level_counts(_compared(spark, sf_dir).select("c.match_level"))


@query(f"WITH {LEVELS_SQL} SELECT field, count(*) FILTER (level = 'MISMATCH') AS mismatch, count(*) AS total, count(*) FILTER (level = 'MISMATCH') / count(*) AS rate FROM verdicts GROUP BY field HAVING count(*) FILTER (level = 'MISMATCH') > 0")
def field_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.field_distribution(_exploded(spark, sf_dir))


@query(f"WITH {LEVELS_SQL} SELECT count(*) AS total_fields, count(*) FILTER (level = 'NORMALIZED') / count(*) AS normalized_field_ratio, count(*) FILTER (level = 'KEY_MISSING_IN_PRED') AS missing_in_pred, count(*) FILTER (level = 'KEY_MISSING_IN_GT') AS missing_in_gt FROM verdicts")
def cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.cross_check(_exploded(spark, sf_dir))


_SCORED = f"WITH {LEVELS_SQL}, scored AS (SELECT k, nation, CASE WHEN k % 10 <> 3 THEN match_score END AS match_score FROM levels)"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).select("k", "nation", F.when(F.col("k") % 10 != 3, F.col("c.match_score")).alias("match_score"))


@query(f"{_SCORED}, placed AS (SELECT *, (row_number() OVER (PARTITION BY nation ORDER BY k) - 1) // 10 AS window_no FROM scored WHERE match_score IS NOT NULL) SELECT nation, window_no, count(*) AS n, round_even(avg(match_score), 4) AS mean_score FROM placed GROUP BY nation, window_no")
def quality_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.quality_windows(_scored(spark, sf_dir), ["k"], ["nation"])


@query(f"{_SCORED} SELECT round_even(avg(match_score), 4) AS mean_score, count(match_score) AS scored, count(*) FILTER (match_score IS NULL) AS unscored FROM scored")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.quality_summary(_scored(spark, sf_dir))


@query("SELECT event_type, count(*) AS n, " + ", ".join(f"list_sort(list(value))[CAST(round_even(CAST({q} AS DOUBLE) / 100 * (count(*) - 1), 0) AS BIGINT) + 1] AS p{q}" for q in (50, 95, 99)) + " FROM events GROUP BY event_type")
def nearest_rank_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.nearest_rank(table(spark, sf_dir, "events"), ["event_type"], "value", [50, 95, 99])


# --- lifecycle ---


_OUTCOME = outcome_sql(ATTEMPTS_SQL)


@query(_OUTCOME)
def lifecycle_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.outcomes(attempts(spark, sf_dir)).withColumn("kept_attempt", F.coalesce("kept_attempt", F.lit(0)).cast("long"))


@query(f"WITH {FOLD_SQL}, names AS (SELECT unnest(['initial', 'retry_quality', 'retry_network']) AS quota) SELECT quota, count(sample_id) AS n FROM names LEFT JOIN folded USING (quota) GROUP BY quota")
def quota_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.quota_counts(lifecycle.folded(attempts(spark, sf_dir)))


@query(f"WITH {ATTEMPTS_SQL} SELECT outcome, count(*) AS calls, CAST(sum(CASE WHEN prompt_tokens IS NULL THEN 0 ELSE prompt_tokens END) AS BIGINT) AS prompt_tokens, CAST(sum(CASE WHEN completion_tokens IS NULL THEN 0 ELSE completion_tokens END) AS BIGINT) AS completion_tokens, count(prompt_tokens) AS with_usage FROM attempts GROUP BY outcome")
def client_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.client_counters(attempts(spark, sf_dir))


@query(f"WITH {FOLD_SQL} SELECT count(*) AS requests, count(DISTINCT sample_id) AS processed, round_even(count(*) / count(DISTINCT sample_id), 6) AS amplification FROM folded")
def amplification(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lifecycle.folded(attempts(spark, sf_dir)).groupBy("sample_id").agg(F.count("*").alias("n"))
    return rows.agg(F.sum("n").alias("requests"), F.count("*").alias("processed"), F.bround(F.sum("n") / F.count("*"), 6).alias("amplification"))


@query(f"WITH {ATTEMPTS_SQL}, placed AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY CASE match_level WHEN 'STRICT' THEN 2 WHEN 'NORMALIZED_MATCH' THEN 1 ELSE 0 END DESC, matched DESC, attempt_no) AS place FROM attempts WHERE match_level IS NOT NULL) SELECT sample_id, attempt_no, match_level, matched FROM placed WHERE place = 1")
def best_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.best_attempt(attempts(spark, sf_dir)).select("sample_id", F.col("attempt_no").cast("long").alias("attempt_no"), "match_level", "matched")


_CALLED = """attempts AS (SELECT c_custkey AS sample_id, n AS attempt_no, (c_custkey * 7 + n * n * 3) % 11 AS r FROM customer, (SELECT unnest(range(1, 8)) AS n)),
 named AS (SELECT sample_id, attempt_no, CASE WHEN r < 5 THEN 'OK' WHEN r IN (5, 6) THEN 'NETWORK_ERROR' WHEN r = 7 THEN 'RATE_LIMITED' WHEN r IN (8, 9) THEN 'GATEWAY_ERROR' ELSE 'API_ERROR' END AS outcome,
 CASE WHEN r = 0 THEN 'STRICT' WHEN r IN (1, 2, 3) THEN 'MISMATCH' END AS match_level, CAST(r AS BIGINT) AS matched FROM attempts)"""


@query(outcome_sql(_CALLED, "named"))
def generate_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of calls over the samples that are still open; a live lifecycle."""
    ensure_checkpoints(spark)
    samples = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"))

    def call(open_: DataFrame, number: int) -> DataFrame:
        r = (F.col("sample_id") * 7 + number * number * 3) % 11
        outcome = F.when(r < 5, "OK").when(r.isin(5, 6), "NETWORK_ERROR").when(r == 7, "RATE_LIMITED").when(r.isin(8, 9), "GATEWAY_ERROR").otherwise("API_ERROR")
        return open_.select("sample_id", outcome.alias("outcome"), F.when(r == 0, "STRICT").when(r.isin(1, 2, 3), "MISMATCH").alias("match_level"), r.alias("matched"))

    return lifecycle.generate(samples, call)[0].withColumn("kept_attempt", F.coalesce("kept_attempt", F.lit(0)).cast("long"))


@query("""SELECT l_orderkey AS k, l_linenumber AS line, CASE WHEN l_partkey % 9 = 0 THEN 'NETWORK_ERROR' WHEN l_partkey % 9 < 4 AND l_suppkey % 4 > 0 THEN 'OK' WHEN l_partkey % 9 < 4 AND l_returnflag = 'R' THEN 'LENGTH_TRUNCATED' WHEN l_partkey % 9 < 4 THEN 'EMPTY_RESPONSE'
 WHEN l_partkey % 9 IN (4, 5) THEN 'RATE_LIMITED' WHEN l_partkey % 9 IN (6, 7) THEN 'GATEWAY_ERROR' ELSE 'API_ERROR' END AS outcome, count(*) AS n, sum(CASE WHEN l_partkey % 9 = 4 THEN CAST(l_suppkey % 7 AS DOUBLE) END) AS asked FROM lineitem GROUP BY ALL""")
def outcome_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nine = F.col("l_partkey") % 9
    status = F.when(nine < 4, 200).when(nine == 4, 429).when(nine == 5, 403).when(nine == 6, 502).when(nine == 7, 504).otherwise(400)
    content = F.when(F.col("l_suppkey") % 4 > 0, "text").otherwise("")
    reason = F.when(F.col("l_returnflag") == "R", "length").otherwise("stop")
    header = F.when(nine == 4, (F.col("l_suppkey") % 7).cast("string")).otherwise("soon")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), lifecycle.classify_outcome(status, content, reason, nine == 0).alias("outcome"), lifecycle.retry_after(status, header).alias("w"))
    return rows.groupBy("k", "line", "outcome").agg(F.count("*").alias("n"), F.sum("w").alias("asked"))


@query("SELECT conv_id AS k, CASE WHEN max(turn) > 0 THEN arg_min(text, turn) FILTER (turn > 0) ELSE '' END AS truth, replace(arg_min(text, turn), '<image>', '') AS asked FROM conversations GROUP BY conv_id")
def sample_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("t"))
    rows = rows.select(F.col("conv_id").alias("k"), F.transform("t", lambda x: F.struct(x["role"].alias("role"), F.concat(F.when(x["turn"] == 0, F.lit("<image>")).otherwise(F.lit("")), x["text"]).alias("content"))).alias("messages"))
    none = F.array().cast("array<struct<from: string, value: string>>")
    return rows.select("k", lifecycle.ground_truth_text(F.col("messages"), none).alias("truth"), lifecycle.request_text(F.col("messages"), none).alias("asked"))


# --- adjudication ---


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    pair = lambda f, p, g: F.struct(F.lit(f).alias("field"), p.alias("predicted"), g.alias("ground_truth"))
    diffs = F.when(k % 6 == 5, F.array().cast("array<struct<field: string, predicted: string, ground_truth: string>>")).otherwise(F.array(pair("total", F.lit("1,5"), F.lit("1.5")), pair("status", F.col("o_orderstatus"), F.lit(None).cast("string"))))
    one = '"odd", {"field": "total", "match": true, "reason": "a"}, 7'
    two = F.when(k % 4 == 0, ', {"field": "status", "match": true, "reason": "b"}, {"field": "status", "match": false, "reason": "late"}').when(k % 4 == 1, ', {"field": "status", "match": "true", "reason": "b"}').when(k % 4 == 2, "")
    content = F.when(k % 4 == 3, F.when(k % 8 == 3, "no object").otherwise('{"verdicts": 5}')).otherwise(F.concat(F.lit(f'Here: ```json\n{{"verdicts": [{one}'), two, F.lit("]}\n```")))
    rows = table(spark, sf_dir, "orders").select(k.cast("string").alias("sample_id"), F.lit("failed").alias("status"), diffs.alias("differences"), content.alias("content"), F.when(k % 5 == 4, "RATE_LIMITED").when(k % 35 == 3, "API_ERROR").otherwise("OK").alias("outcome"))
    return adjudicate.judgeable(rows)


_JUDGED = """WITH judged AS (SELECT CAST(o_orderkey AS VARCHAR) AS sample_id, CASE WHEN o_orderkey % 5 = 4 THEN 'network_exhausted' WHEN o_orderkey % 35 = 3 THEN 'terminal_error' WHEN o_orderkey % 4 = 3 THEN 'judge_parse_failed' END AS failure, o_orderkey % 4 = 0 AS yes
 FROM orders WHERE o_orderkey % 6 <> 5 AND o_orderkey <> 0)"""


@query(f"{_JUDGED} SELECT sample_id, failure, failure IS NULL AND yes AS overturned, CASE WHEN failure IS NULL AND yes THEN 'success' ELSE 'failed' END AS status FROM judged")
def judge_overturn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adjudicate.apply_verdicts(_asked(spark, sf_dir)).select("sample_id", "judge_result.failure", "judge_result.overturned", "status")


@query(
    f"{_JUDGED} SELECT count(*) AS judged, count(*) FILTER (failure IS NULL AND yes) AS overturned, count(*) FILTER (failure IS NULL AND NOT yes) AS upheld, " + ", ".join(f"count(*) FILTER (failure = '{n}') AS {n}" for n in ("judge_parse_failed", "network_exhausted", "terminal_error"))
    + ", CAST(3 AS BIGINT) AS skipped_no_differences, CAST(0 AS BIGINT) AS skipped_resume, count(*) FILTER (failure IS NULL AND yes) / count(*) AS overturn_rate FROM judged"
)
def judge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adjudicate.judge_summary(adjudicate.apply_verdicts(_asked(spark, sf_dir)), 3)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS sample_id, '1. field: total' || chr(10) || '   predicted: \"1,5\"' || chr(10) || '   expected: \"1.5\"' || chr(10) || '2. field: status' || chr(10) || '   predicted: \"' || o_orderstatus || '\"' || chr(10) || '   expected: null' AS prompt FROM orders WHERE o_orderkey % 6 <> 5 AND o_orderkey <> 0")
def judge_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked(spark, sf_dir).select("sample_id", adjudicate.judge_prompt(F.col("pairs")).alias("prompt"))


# --- rewriting ---


_POLISHED = """WITH rows AS (SELECT p_partkey AS sample_id, CASE WHEN p_partkey % 7 = 6 THEN 'network_exhausted' WHEN p_partkey % 4 = 3 THEN 'parse_failed' END AS failure,
 CASE p_partkey % 4 WHEN 0 THEN 'STRICT' WHEN 1 THEN CASE WHEN contains(p_name, ' ') THEN 'NORMALIZED_MATCH' ELSE 'STRICT' END ELSE CASE WHEN upper(p_name) = p_name THEN 'STRICT' ELSE 'MISMATCH' END END AS level, 'it says ' || p_type AS cot FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 10 <> 0)"""


@query(f"{_POLISHED} SELECT sample_id, failure, failure IS NULL AND level <> 'MISMATCH' AS applied, CASE WHEN failure IS NULL THEN level END AS match_level, CASE WHEN failure IS NULL THEN cot END AS polished_cot FROM rows")
def polish_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rewrite.applied(rewrite.material(rewritable(spark, sf_dir), rewrite.POLISH), rewrite.POLISH)
    return rows.select("sample_id", *(f"polish_result.{n}" for n in ("failure", "applied", "match_level", "polished_cot")))


@query(f"{_POLISHED} SELECT count(*) AS processed, count(*) FILTER (failure IS NULL AND level <> 'MISMATCH') AS applied, count(*) FILTER (failure IS NULL AND level = 'MISMATCH') AS answer_changed, " + ", ".join(f"count(*) FILTER (failure = '{n}') AS {n}" for n in ("parse_failed", "network_exhausted", "terminal_error")) + ", CAST(0 AS BIGINT) AS skipped_no_material, CAST(0 AS BIGINT) AS skipped_resume, count(*) FILTER (failure IS NULL AND level <> 'MISMATCH') / count(*) AS applied_rate FROM rows")
def polish_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rewrite.rewrite_summary(rewrite.applied(rewrite.material(rewritable(spark, sf_dir), rewrite.POLISH), rewrite.POLISH))


@query("""SELECT p_partkey AS sample_id, 'What is ' || p_brand AS question, CASE WHEN p_partkey % 10 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN 'it is' ELSE 'because' END AS cot, '{"name": "' || CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END || '", "size": ' || p_size || '}' AS answer FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 6 <> 0""")
def repair_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rewrite.material(rewritable(spark, sf_dir), rewrite.REPAIR).select("sample_id", "question", "cot", "answer")


@query("""SELECT p_partkey AS sample_id, p_partkey % 7 <> 6 AND p_partkey % 4 <> 3 AS applied, CASE WHEN p_partkey % 7 <> 6 AND p_partkey % 4 <> 3 THEN 'success' ELSE 'failed' END AS status FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 6 <> 0""")
def repair_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rewrite.applied(rewrite.material(rewritable(spark, sf_dir), rewrite.REPAIR), rewrite.REPAIR)
    return rows.select("sample_id", "polish_result.applied", "status")


# --- merging and combining ---

_ROUTES = f"""WITH {RUNS_SQL} SELECT r.sample_id, r.ord, CASE WHEN r.status = 'success' OR i.status = 'success' THEN 'success' ELSE 'failed' END AS merged_status,
 CASE WHEN r.status = 'success' THEN 'run_success' WHEN i.status IS NULL THEN 'untouched_failed' WHEN i.status = 'success' THEN 'judged_overturned' WHEN i.failure <> '' THEN 'judged_error' ELSE 'judged_upheld' END AS origin
 FROM runs r LEFT JOIN ids i ON r.sample_id = i.sample_id AND r.status <> 'success'"""


@query(_ROUTES)
def merge_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = runs(spark, sf_dir).withColumn("ord", F.col("_ord"))
    return assemble.merged(run, judged(spark, sf_dir)).select("sample_id", "ord", "merged_status", "origin")


@query(
    f"WITH routes AS ({_ROUTES}), {RUNS_SQL} SELECT " + ", ".join(f"(SELECT count(*) FROM routes WHERE origin = '{o}') AS {o}" for o in ("run_success", "judged_overturned", "judged_upheld", "judged_error", "untouched_failed"))
    + ", (SELECT count(*) FROM routes WHERE origin <> 'run_success') AS run_failed, (SELECT count(*) FROM routes WHERE merged_status = 'success') AS final_success, (SELECT count(*) FROM routes WHERE merged_status = 'failed') AS final_failed"
    ", (SELECT count(*) FROM ids WHERE sample_id IN (SELECT sample_id FROM runs WHERE status = 'success')) AS collision, (SELECT count(*) FROM ids WHERE sample_id NOT IN (SELECT sample_id FROM runs)) AS orphaned"
    ", (SELECT count(*) - count(DISTINCT sample_id) FROM runs WHERE status <> 'success') AS duplicate_run_failed_ids, (SELECT CAST(sum(n - 1) AS BIGINT) FROM ids) AS duplicate_judged_ids"
)
def merge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.merge_summary(runs(spark, sf_dir), judged(spark, sf_dir))


@query(f"WITH {SOURCES_SQL} SELECT source, sample_id, CASE WHEN status = 'success' THEN 'success' ELSE 'failed' END AS status, ord, true AS keyed FROM keyed UNION ALL SELECT source, sample_id, CASE WHEN status IS NOT NULL AND status = 'success' THEN 'success' ELSE 'failed' END, ord, false FROM records WHERE sample_id IS NULL")
def combine_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assemble.combined(sources(spark, sf_dir))
    return rows.select(F.col("_source").alias("source"), "sample_id", assemble.route(F.col("status")).alias("status"), F.col("_ord").alias("ord"), F.col("_keyed").alias("keyed"))


@query(
    f"WITH {SOURCES_SQL}, lone AS (SELECT * FROM records WHERE sample_id IS NULL) SELECT (SELECT count(*) FROM records) AS total_in, (SELECT count(*) FROM lone) AS no_sample_id, (SELECT CAST(sum(n - 1) AS BIGINT) FROM keyed) AS deduped, "
    "(SELECT count(*) FROM (SELECT sample_id FROM keyed GROUP BY sample_id HAVING count(*) > 1)) AS cross_source_ids, (SELECT count(*) FROM keyed) + (SELECT count(*) FROM lone) AS final_records, "
    "(SELECT count(*) FROM keyed WHERE status = 'success') + (SELECT count(*) FROM lone WHERE status = 'success') AS final_success, "
    "(SELECT count(*) FROM keyed WHERE status <> 'success') + (SELECT count(*) FROM lone WHERE status IS NULL OR status <> 'success') AS final_failed"
)
def combine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.combine_summary(sources(spark, sf_dir))


@query(f"WITH {SOURCES_SQL} SELECT sample_id, count(*) AS sources FROM keyed GROUP BY sample_id HAVING count(*) > 1")
def combine_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.shared_ids(sources(spark, sf_dir))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.pending(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query(f"WITH {SOURCES_SQL} SELECT source, count(*) FILTER (status IS NOT NULL AND status = 'success') AS success, count(*) FILTER (status IS NULL OR status <> 'success') AS failed FROM records GROUP BY source")
def status_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = sources(spark, sf_dir).withColumn("part", assemble.route(F.col("status")))
    return routed.groupBy(F.col("_source").alias("source")).agg(F.count_if(F.col("part") == "success").alias("success"), F.count_if(F.col("part") == "failed").alias("failed"))


@query(f"WITH {RUNS_SQL} SELECT sample_id, arg_max(status, ord) AS status, min(ord) AS ord FROM runs GROUP BY sample_id")
def compacted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.compacted(runs(spark, sf_dir).select("sample_id", "status", "_ord")).select("sample_id", "status", F.col("_ord").alias("ord"))


@query("SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 25")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.seeded_pick(table(spark, sf_dir, "documents").select("doc_id"), 25, "doc_id")


# --- training rows ---

_MARKED = "CASE WHEN k % 3 = 0 THEN '<image>' || chr(10) ELSE '' END || human"


@query(f"""WITH {CHATS_SQL}, said AS (SELECT k, human, CASE WHEN reply IS NULL THEN NULL ELSE {stripped_sql("reply")} END AS cot FROM chats WHERE human IS NOT NULL)
SELECT k AS sample_id, {_MARKED} || chr(10) || CASE WHEN cot IS NULL OR cot = '' THEN '/no_think' ELSE '/think' END AS human,
 CASE WHEN cot IS NULL OR cot = '' THEN '' ELSE '<think>' || cot || '</think>' || chr(10) END || '<answer>{{' || chr(10) || '  "k": ' || k || chr(10) || '}}</answer>' AS gpt FROM said""")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.training_rows(chat_records(spark, sf_dir)).select("sample_id", "human", "gpt")


@query(f"WITH {CHATS_SQL} SELECT k AS sample_id, {_MARKED} || chr(10) || '/think' AS human, reply AS gpt FROM chats WHERE human IS NOT NULL AND reply <> ''")
def training_rows_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.training_rows(chat_records(spark, sf_dir), "raw").select("sample_id", "human", "gpt")


@query(f"""WITH {CHATS_SQL} SELECT k AS sample_id, {_MARKED} || chr(10) || '/no_think' AS human, '<answer>{{' || chr(10) || '  "t": ' || k || chr(10) || '}}</answer>' AS gpt, k % 2 = 1 AS recovered FROM chats WHERE human IS NOT NULL AND k % 4 <> 3""")
def hard_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("sample_id")
    truth = F.concat(F.lit('{"t": '), k.cast("string"), F.lit("}"))
    rows = chats(spark, sf_dir).filter("human is not null").withColumn("ground_truth", F.when(k % 2 == 0, truth)).withColumn("ground_truth_text", F.when(k % 4 == 1, F.concat(F.lit("see "), truth)).otherwise("none"))
    return training.hard_examples(rows).select("sample_id", "human", "gpt", "recovered")


@query(f"""SELECT conv_id, turn, CASE role WHEN 'assistant' THEN '<answer>' || {stripped_sql("text")} || '</answer>' WHEN 'user' THEN text || chr(10) || '/no_think' ELSE text END AS value FROM conversations""")
def sanitize_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    speaker = F.when(F.col("role") == "assistant", "gpt").when(F.col("role") == "user", "human").otherwise(F.col("role"))
    value = F.when(F.col("role") == "assistant", F.concat(F.lit("<think>some\nthoughts</think>\n<thinking>more</thinking> <answer> "), "text", F.lit("</answer>"))).when(F.col("role") == "user", F.concat("text", F.lit("\n /think ")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", training.sanitized_turn(speaker, F.coalesce(value, F.col("text"))).alias("value"))


@query("SELECT doc_id, regexp_replace(text, chr(10) || '$', '') || chr(10) || '/think' AS x FROM documents")
def think_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.replace("text", F.lit("\n"), F.lit("\r\n /no_think\n"))
    return table(spark, sf_dir, "documents").select("doc_id", training.with_flag(noisy, training.THINK_FLAG).alias("x"))


_BUDGET = """WITH converted AS (SELECT conv_id AS k FROM conversations GROUP BY conv_id), budget AS (SELECT CAST(floor(0.67 * count(*)) AS BIGINT) AS b FROM converted),
failed AS (SELECT n_nationkey AS k, row_number() OVER (ORDER BY md5('42:' || n_nationkey), n_nationkey) AS place FROM nation), rest AS (SELECT greatest(b - 25, 0) AS r FROM budget), pool AS (SELECT doc_id AS k, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS place FROM documents)
SELECT CAST(0 AS INTEGER) AS block, k FROM converted UNION ALL SELECT 1, k FROM failed, budget WHERE place <= b UNION ALL SELECT 2, k FROM pool, rest WHERE place <= r"""


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("k")).distinct()
    failed = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    external = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"))
    return training.assembled(converted, failed, external, 0.67, "k")


@query(_BUDGET)
def no_cot_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assembled(spark, sf_dir).select(F.col("_block").alias("block"), "k")


@query(f"WITH rows AS ({_BUDGET}) SELECT count(*) FILTER (block = 0) AS converted, count(*) FILTER (block = 1) AS failed_used, count(*) FILTER (block = 2) AS mixed_in, count(*) AS total_samples, CAST(floor(0.67 * count(*) FILTER (block = 0)) AS BIGINT) AS no_cot_budget FROM rows")
def convert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.convert_summary(_assembled(spark, sf_dir), total_records=0, ratio=0.67).drop("failed_gt_recovered", "total_records", "skipped")


# --- telemetry ---

_SIX_HOURS = 21600
_BUCKETS = f"""WITH {TELEMETRY_SQL},
span AS (SELECT kind_of, min(started) AS base, max(finished) AS last FROM requests GROUP BY kind_of),
every AS (SELECT kind_of, base, unnest(range(CAST(floor((last - base) / {_SIX_HOURS}) AS BIGINT) + 1)) AS bucket FROM span),
points AS (SELECT kind_of, started AS t, 1 AS d, 0 AS e FROM requests UNION ALL SELECT kind_of, finished, -1, CASE WHEN outcome <> 'OK' THEN 1 ELSE 0 END FROM requests),
placed AS (SELECT p.*, CAST(floor((t - base) / {_SIX_HOURS}) AS BIGINT) AS bucket FROM points p JOIN span USING (kind_of)),
level AS (SELECT *, sum(d) OVER (PARTITION BY kind_of, bucket ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS level FROM placed),
counted AS (SELECT kind_of, bucket, count(*) FILTER (d = 1) AS started, count(*) FILTER (d = -1) AS finished, CAST(sum(e) AS BIGINT) AS errors, CAST(greatest(max(level), 0) AS BIGINT) AS peak FROM level GROUP BY kind_of, bucket),
buckets AS (SELECT kind_of, bucket, CAST(bucket * {_SIX_HOURS} AS DOUBLE) AS bucket_start, coalesce(started, 0) AS started, coalesce(finished, 0) AS finished, coalesce(errors, 0) AS errors, coalesce(peak, 0) AS peak_in_flight,
 round_even(coalesce(started, 0) * CAST(60 AS DOUBLE) / {_SIX_HOURS}, 2) AS effective_qpm FROM every LEFT JOIN counted USING (kind_of, bucket))"""


@query(f"{_BUCKETS} SELECT * FROM buckets")
def tele_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_buckets(spark, sf_dir)


def telemetry_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_module.buckets(telemetry(spark, sf_dir), ["kind_of"], _SIX_HOURS)


@query(f"{_BUCKETS} SELECT kind_of, round_even(avg(effective_qpm), 2) AS qpm_mean, min(effective_qpm) AS qpm_min FROM buckets WHERE started > 0 GROUP BY kind_of")
def tele_qpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_module.qpm_summary(telemetry_buckets(spark, sf_dir), ["kind_of"])


@query(
    f"WITH {TELEMETRY_SQL}, long AS (" + " UNION ALL ".join(f"SELECT kind_of, '{p}' AS phase, {p} AS t FROM requests" for p in ("wait_limiter", "wait_slot", "rtt", "backoff"))
    + "), sums AS (SELECT kind_of, phase, sum(t) AS total FROM long GROUP BY kind_of, phase) SELECT kind_of, phase, round_even(total, 2) AS total, round_even(total / sum(total) OVER (PARTITION BY kind_of), 4) AS share FROM sums"
)
def tele_phase_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_module.phase_shares(telemetry(spark, sf_dir), ["kind_of"])


@query(f"""WITH {TELEMETRY_SQL}, points AS (SELECT sample_id, started AS t, 1 AS d FROM requests UNION ALL SELECT sample_id, finished, -1 FROM requests),
level AS (SELECT sample_id, sum(d) OVER (PARTITION BY sample_id ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS l FROM points) SELECT sample_id, CAST(greatest(max(l), 0) AS BIGINT) AS peak FROM level GROUP BY sample_id""")
def tele_sample_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_module.peak_per_sample(telemetry(spark, sf_dir))


_PACE = 0.05


@query(f"""WITH {TELEMETRY_SQL}, placed AS (SELECT *, row_number() OVER (PARTITION BY kind_of ORDER BY started, event_id) - 1 AS i FROM requests)
SELECT event_id, round_even(max(started - i * (CAST(60 AS DOUBLE) / CAST({_PACE} AS DOUBLE))) OVER (PARTITION BY kind_of ORDER BY started, event_id ROWS UNBOUNDED PRECEDING) + i * (CAST(60 AS DOUBLE) / CAST({_PACE} AS DOUBLE)), 3) AS granted FROM placed""")
def paced_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = telemetry_module.paced(telemetry(spark, sf_dir), ["kind_of"], "started", ["started", "event_id"], _PACE)
    return rows.select("event_id", F.bround("granted", 3).alias("granted"))


@query("SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 7199999999 PRECEDING AND CURRENT ROW) AS recent FROM events")
def grants_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return telemetry_module.grants_in_window(rows, ["event_type"], "us", 7200).select("event_id", "recent")


@query("SELECT event_id, round_even(greatest(least(CAST(2 AS DOUBLE) * pow(2, user_id % 6), CAST(30 AS DOUBLE)) * (1 + CAST(0.2 AS DOUBLE) * (2 * ((event_id % 100) / CAST(100 AS DOUBLE)) - 1)), CASE WHEN event_id % 5 = 0 THEN CAST(20 AS DOUBLE) ELSE 0 END), 6) AS delay FROM events")
def backoff_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = (F.col("event_id") % 100) / F.lit(100.0)
    asked = F.when(F.col("event_id") % 5 == 0, F.lit(20.0))
    delay = telemetry_module.backoff_delay(F.col("user_id") % 6, 2.0, 30.0, 0.2, u, asked)
    return table(spark, sf_dir, "events").select("event_id", F.bround(delay, 6).alias("delay"))


@query("SELECT event_id, CAST(user_id AS VARCHAR) AS sample_id, round_even(value, 4) AS rtt, round_even(epoch_us(ts) / 1e6, 4) AS ts FROM events")
def events_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as log lines and read again."""
    rows = telemetry(spark, sf_dir).select("event_id", "sample_id", "kind", "outcome", F.col("event_id").cast("string").alias("quota_kind"), F.col("started").alias("ts"), (F.col("rtt") / 60.0).alias("rtt"), F.lit(0.0).alias("wait_limiter"), F.lit(0.0).alias("wait_slot"), F.lit(0.0).alias("backoff"))
    lines = telemetry_module.events_logged(rows)
    read = lines.select(F.from_json("value", "ts double, sample_id string, kind string, outcome string, quota_kind string, wait_limiter double, wait_slot double, rtt double, backoff double").alias("e")).select("e.*")
    return telemetry_module.events_read(read).select(F.col("quota_kind").cast("long").alias("event_id"), "sample_id", "rtt", "ts")


# --- streams ---


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{sf_dir}/events.parquet*")


@query("SELECT user_id, arg_max(event_type, ts) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, by a stream that merges its batches into a table."""
    folder = folder_of(spark, "upsert")
    rows = _event_stream(spark, sf_dir).select("user_id", "event_type", "event_id", "ts")
    flows.upsert_stream(rows, f"{folder}/table", f"{folder}/state", ["user_id"], "ts").awaitTermination()
    return flows.newest(spark, f"{folder}/table").select("user_id", "event_type", "event_id")


@query("SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS bucket_start, count(*) AS started, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1")
def stream_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows over a stream with a watermark; the last batch's table is complete."""
    folder = folder_of(spark, "buckets")
    rows = _event_stream(spark, sf_dir).select("ts", F.when(F.col("event_type") == "error", "API_ERROR").otherwise("OK").alias("outcome"))
    counts = flows.event_buckets(rows, "6 hours")

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/table")

    counts.writeStream.outputMode("complete").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(store).start().awaitTermination()
    return spark.read.parquet(f"{folder}/table").select(F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"), "started", "errors")


@query(f"WITH fold AS ({_OUTCOME}) SELECT CAST(sample_id AS VARCHAR) AS sample_id, CAST(attempts AS INTEGER) AS attempts, status FROM fold WHERE status <> 'open'")
def stream_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ended samples by per-sample state over a stream of attempts."""
    folder = folder_of(spark, "budgets")
    log = attempts(spark, sf_dir).select(F.col("sample_id").cast("string").alias("sample_id"), "attempt_no", "outcome", "match_level")
    log.write.parquet(f"{folder}/log")
    stream = spark.readStream.schema(log.schema).parquet(f"{folder}/log")
    ended = flows.budget_stream(stream)
    ended.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).format("parquet").start(f"{folder}/out").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("sample_id", "attempts", "status")

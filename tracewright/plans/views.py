"""Base views over the driver's tables: what stands in for samples, replies, attempts and events.

The tables hold no model replies, so they are made from keys, alike in Spark and in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.textnorm import width_table

WIDE_DIGITS = "０１２３４５６７８９"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, nation, gt, pred, reply): ground truth, one of seven predictions, one of four replies."""
    k = F.col("c_custkey")
    name = F.concat("c_name", F.lit(","), "c_mktsegment")
    seven = k % 7
    said = F.when(seven == 1, F.translate(name, "0123456789", WIDE_DIGITS)).when(seven == 2, F.replace(name, F.lit(","), F.lit(" , "))).when(seven == 3, F.lower(name)).otherwise(name)
    segment = F.concat(F.lit(', "segment": "'), "c_mktsegment", F.lit('"'))
    nation = F.col("c_nationkey").cast("string")
    items = F.concat(F.lit(', "items": [{"balance": '), F.col("c_acctbal").cast("string"), F.lit("}]"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    gt = F.concat(F.lit('{"name": '), quoted(name), segment, F.lit(', "nation": '), nation, items, F.lit("}"))
    pred = F.concat(
        F.lit('{"name": '),
        quoted(said),
        F.when(seven == 4, F.lit("")).otherwise(segment),
        F.lit(', "nation": '),
        F.when(seven == 6, quoted(nation)).otherwise(nation),
        items,
        F.when(seven == 5, F.lit(', "note": null')).otherwise(F.lit("")),
        F.lit("}"),
    )
    rows = table(spark, sf_dir, "customer").select(k.alias("k"), F.col("c_nationkey").alias("nation"), gt.alias("gt"), pred.alias("pred"))
    return rows.withColumn("reply", _reply(F.col("k"), F.col("pred")))


def _reply(k: Column, pred: Column) -> Column:
    four = k % 4
    literal = F.replace(F.replace(pred, F.lit("null"), F.lit("None")), F.lit('"'), F.lit("'"))
    return (
        F.when(four == 0, F.concat(F.lit("  "), pred, F.lit("\n")))
        .when(four == 1, F.concat(F.lit("Reading it twice.\n```json\n"), pred, F.lit("\n```\nDone.")))
        .when(four == 2, F.concat(F.lit("Some {loose} words: "), pred, F.lit(" and more")))
        .otherwise(F.concat(F.lit("As text "), literal))
    )


#: Field pairs of `answers` in SQL: (k, nation, field, p, g, pt, gt), values and their types.
FIELDS_SQL = f"""
base AS (SELECT c_custkey AS k, c_nationkey AS nation, c_name || ',' || c_mktsegment AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS n, CAST(c_acctbal AS VARCHAR) AS bal, c_custkey % 7 AS v FROM customer),
fields AS (
 SELECT k, nation, 'name' AS field, CASE v WHEN 1 THEN translate(name, '0123456789', '{WIDE_DIGITS}') WHEN 2 THEN replace(name, ',', ' , ') WHEN 3 THEN lower(name) ELSE name END AS p, name AS g, 'str' AS pt, 'str' AS gt FROM base
 UNION ALL SELECT k, nation, 'segment', CASE WHEN v <> 4 THEN segment END, segment, CASE WHEN v <> 4 THEN 'str' END, 'str' FROM base
 UNION ALL SELECT k, nation, 'nation', n, n, CASE v WHEN 6 THEN 'str' ELSE 'num' END, 'num' FROM base
 UNION ALL SELECT k, nation, 'items[0].balance', bal, bal, 'num', 'num' FROM base
 UNION ALL SELECT k, nation, 'note', NULL, NULL, 'null', NULL FROM base WHERE v = 5
)"""


def normalized_sql(x: str) -> str:
    """Default normalisation in DuckDB's SQL."""
    pairs = width_table()
    text = lambda s: "'" + s.replace("'", "''") + "'"
    wide = f"replace(translate({x}, {text(''.join(pairs))}, {text(''.join(pairs.values()))}), '…', '...')"
    tight = rf"""regexp_replace({wide}, '[\s\p{{Z}}]*([,.:;?!()\[\]"''/-])[\s\p{{Z}}]*', '\1', 'g')"""
    return stripped_sql(tight)


def stripped_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def legacy_sql(x: str) -> str:
    """The lenient preset's normalisation in DuckDB's SQL."""
    pairs = width_table()
    text = lambda s: "'" + s.replace("'", "''") + "'"
    wide = f"replace(translate({x}, {text(''.join(pairs))}, {text(''.join(pairs.values()))}), '…', '...')"
    named = rf"replace(replace(regexp_replace(lower({wide}), '[\s\p{{Z}}]+', ' ', 'g'), '€', 'EUR'), '£', 'GBP')"
    plain = rf"regexp_replace(regexp_replace({named}, '(\d),(\d)', '\1\2', 'g'), '(\d),(\d)', '\1\2', 'g')"
    return stripped_sql(plain)


def first_sql(x: str) -> str:
    """The first generation's normalisation in DuckDB's SQL, of the letters that the views make wide."""
    plain = f"trim(lower(translate({x}, 'ＡＢＣ０１２３４５６７８９', 'ABC0123456789')))"
    named = rf"translate(replace(replace(regexp_replace({plain}, '\s+', ' ', 'g'), '€', 'EUR'), '£', 'GBP'), '￥，：（）《》', '¥,:()<>')"
    return rf"trim(regexp_replace(regexp_replace({named}, '(\d),(\d)', '\1\2', 'g'), '(\d),(\d)', '\1\2', 'g'))"


LEVELS_SQL = f"""{FIELDS_SQL},
verdicts AS (
 SELECT k, nation, field, p, g, CASE WHEN pt IS NULL THEN 'KEY_MISSING_IN_PRED' WHEN gt IS NULL THEN 'KEY_MISSING_IN_GT'
  WHEN pt = gt AND p = g THEN 'STRICT' WHEN pt = 'str' AND gt = 'str' AND {normalized_sql("p")} = {normalized_sql("g")} THEN 'NORMALIZED' ELSE 'MISMATCH' END AS level
 FROM fields),
samples AS (
 SELECT k, nation, count(*) FILTER (level IN ('STRICT', 'NORMALIZED')) AS matched, count(*) FILTER (level = 'MISMATCH') AS mismatched, count(*) FILTER (level = 'KEY_MISSING_IN_PRED') AS missing,
  count(*) FILTER (level = 'KEY_MISSING_IN_GT') AS extra, count(*) FILTER (level = 'STRICT') AS strict, count(*) AS total FROM verdicts GROUP BY k, nation),
levels AS (
 SELECT *, CASE WHEN strict = total THEN 'STRICT' WHEN matched = total THEN 'NORMALIZED_MATCH' ELSE 'MISMATCH' END AS match_level,
  CASE WHEN matched + mismatched > 0 THEN matched / (matched + mismatched) WHEN missing = 0 THEN 1.0 ELSE 0.0 END AS match_score FROM samples)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of attempts: sample = order, outcomes by part; order numbers are made here."""
    from pyspark.sql import Window

    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    ten, three = F.col("l_partkey") % 10, F.col("l_suppkey") % 3
    outcome = (
        F.when(ten.isin(0, 1, 2, 3, 4, 8), "OK").when(ten == 5, "NETWORK_ERROR").when(ten == 6, "RATE_LIMITED").when(ten == 7, "GATEWAY_ERROR").when(three == 0, "API_ERROR").when(three == 1, "EMPTY_RESPONSE").otherwise("LENGTH_TRUNCATED")
    )
    level = F.when(ten == 0, "STRICT").when(ten == 1, "NORMALIZED_MATCH").when(ten.isin(2, 3, 4), "MISMATCH")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sample_id"),
        F.row_number().over(order).alias("attempt_no"),
        outcome.alias("outcome"),
        level.alias("match_level"),
        F.col("l_quantity").cast("long").alias("matched"),
        F.when(ten < 8, F.col("l_partkey") % 1000).alias("prompt_tokens"),
        F.when(ten < 8, F.col("l_suppkey") % 100).alias("completion_tokens"),
    )


ATTEMPTS_SQL = """
attempts AS (
 SELECT l_orderkey AS sample_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS attempt_no,
  CASE WHEN l_partkey % 10 IN (0, 1, 2, 3, 4, 8) THEN 'OK' WHEN l_partkey % 10 = 5 THEN 'NETWORK_ERROR' WHEN l_partkey % 10 = 6 THEN 'RATE_LIMITED' WHEN l_partkey % 10 = 7 THEN 'GATEWAY_ERROR'
   WHEN l_suppkey % 3 = 0 THEN 'API_ERROR' WHEN l_suppkey % 3 = 1 THEN 'EMPTY_RESPONSE' ELSE 'LENGTH_TRUNCATED' END AS outcome,
  CASE WHEN l_partkey % 10 = 0 THEN 'STRICT' WHEN l_partkey % 10 = 1 THEN 'NORMALIZED_MATCH' WHEN l_partkey % 10 IN (2, 3, 4) THEN 'MISMATCH' END AS match_level,
  CAST(l_quantity AS BIGINT) AS matched, CASE WHEN l_partkey % 10 < 8 THEN l_partkey % 1000 END AS prompt_tokens, CASE WHEN l_partkey % 10 < 8 THEN l_suppkey % 100 END AS completion_tokens
 FROM lineitem)"""


def fold_sql(attempts_sql: str, name: str = "attempts") -> str:
    """The rest of a WITH part that folds the log `name`."""
    return f"""{attempts_sql},
running AS (
 SELECT *, count(*) FILTER (match_level = 'MISMATCH') OVER w AS mm, count(*) FILTER (outcome IN ('NETWORK_ERROR', 'RATE_LIMITED', 'GATEWAY_ERROR')) OVER w AS nw,
  count(*) FILTER (outcome = 'GATEWAY_ERROR') OVER w AS gw, lag(outcome) OVER (PARTITION BY sample_id ORDER BY attempt_no) AS was FROM {name}
 WINDOW w AS (PARTITION BY sample_id ORDER BY attempt_no ROWS UNBOUNDED PRECEDING)),
stated AS (
 SELECT *, CASE WHEN outcome = 'OK' AND match_level IS NULL THEN 'failed' WHEN match_level IN ('STRICT', 'NORMALIZED_MATCH') THEN 'success' WHEN match_level = 'MISMATCH' AND mm >= 3 THEN 'exhausted'
  WHEN outcome = 'GATEWAY_ERROR' AND gw > 2 THEN 'exhausted' WHEN outcome IN ('NETWORK_ERROR', 'RATE_LIMITED', 'GATEWAY_ERROR') AND nw >= 5 THEN 'exhausted'
  WHEN outcome IN ('API_ERROR', 'EMPTY_RESPONSE', 'LENGTH_TRUNCATED') THEN 'failed' ELSE 'open' END AS state,
  CASE WHEN was IS NULL THEN 'initial' WHEN was = 'OK' THEN 'retry_quality' ELSE 'retry_network' END AS quota FROM running),
stop AS (SELECT sample_id, min(attempt_no) FILTER (state <> 'open') AS stop FROM stated GROUP BY sample_id),
folded AS (SELECT s.* FROM stated s JOIN stop USING (sample_id) WHERE stop IS NULL OR attempt_no <= stop)"""


FOLD_SQL = fold_sql(ATTEMPTS_SQL)


def outcome_sql(attempts_sql: str, name: str = "attempts") -> str:
    """Records of a log in SQL, from a WITH part that names it."""
    return f"""WITH {fold_sql(attempts_sql, name)},
scored AS (SELECT sample_id, attempt_no, match_level AS level, row_number() OVER (PARTITION BY sample_id ORDER BY CASE match_level WHEN 'STRICT' THEN 2 WHEN 'NORMALIZED_MATCH' THEN 1 ELSE 0 END DESC, matched DESC, attempt_no) AS place FROM folded WHERE match_level IS NOT NULL),
last AS (SELECT sample_id, max(attempt_no) AS attempts, arg_max(state, attempt_no) AS state, arg_max(outcome, attempt_no) AS outcome, arg_max(CASE WHEN match_level IS NULL THEN '' ELSE match_level END, attempt_no) AS own FROM folded GROUP BY sample_id)
SELECT sample_id, CASE state WHEN 'open' THEN 'open' WHEN 'success' THEN 'success' ELSE 'failed' END AS status, attempts,
 CASE WHEN state IN ('open', 'success') THEN NULL WHEN state = 'exhausted' AND b.level IS NOT NULL THEN 'MISMATCH' WHEN outcome = 'OK' THEN 'JSON_PARSE_ERROR' ELSE outcome END AS error_type,
 CASE state WHEN 'exhausted' THEN b.level WHEN 'success' THEN own END AS match_level, CASE WHEN state = 'exhausted' AND b.attempt_no IS NOT NULL THEN b.attempt_no WHEN state = 'success' THEN attempts ELSE 0 END AS kept_attempt
FROM last LEFT JOIN (SELECT * FROM scored WHERE place = 1) b USING (sample_id)"""


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests from events: times in seconds, keyed by event type and user."""
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("sample_id"),
        F.col("event_type").alias("kind_of"),
        F.lit("request").alias("kind"),
        F.when(F.col("event_type") == "error", "API_ERROR").otherwise("OK").alias("outcome"),
        seconds.alias("started"),
        (F.col("value") * 60.0).alias("rtt"),
        (F.col("user_id") % 7).cast("double").alias("wait_limiter"),
        (F.col("user_id") % 3).cast("double").alias("wait_slot"),
        F.when(F.col("event_type") == "error", F.lit(2.5)).otherwise(0.0).alias("backoff"),
    )
    return rows.withColumn("finished", F.col("started") + F.col("rtt"))


TELEMETRY_SQL = """
requests AS (
 SELECT event_id, CAST(user_id AS VARCHAR) AS sample_id, event_type AS kind_of, CASE WHEN event_type = 'error' THEN 'API_ERROR' ELSE 'OK' END AS outcome, epoch_us(ts) / 1e6 AS started,
  epoch_us(ts) / 1e6 + value * CAST(60.0 AS DOUBLE) AS finished, value * CAST(60.0 AS DOUBLE) AS rtt, CAST(user_id % 7 AS DOUBLE) AS wait_limiter, CAST(user_id % 3 AS DOUBLE) AS wait_slot,
  CASE WHEN event_type = 'error' THEN CAST(2.5 AS DOUBLE) ELSE 0 END AS backoff FROM events)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's records from orders: id, status, place; ids repeat among every 97th."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(k % 97 == 0, F.concat(F.lit("dup"), (k % 5).cast("string"))).otherwise(F.concat(F.lit("s"), k.cast("string"))).alias("sample_id"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"),
        F.lit(None).cast("string").alias("judge_failure"),
        k.alias("_ord"),
    )


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge's records on every third order and on some that no run knows, successes first."""
    k = F.col("o_orderkey")
    status = F.when(k % 4 == 0, "success").otherwise("failed")
    own = table(spark, sf_dir, "orders").filter(k % 3 == 0).select(
        F.when(k % 51 == 0, F.concat(F.lit("orphan"), (k % 9).cast("string"))).when(k % 97 == 0, F.concat(F.lit("dup"), (k % 5).cast("string"))).when(k % 33 == 0, F.lit("")).otherwise(F.concat(F.lit("s"), k.cast("string"))).alias("sample_id"),
        status.alias("status"),
        F.when(k % 4 == 1, "terminal_error").alias("judge_failure"),
        F.when(k % 4 == 0, k).otherwise(k + F.lit(1 << 40)).alias("_ord"),
    )
    return own


RUNS_SQL = """
runs AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'dup' || (o_orderkey % 5) ELSE 's' || o_orderkey END AS sample_id, CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'failed' END AS status, o_orderkey AS ord FROM orders),
judged AS (SELECT CASE WHEN o_orderkey % 51 = 0 THEN 'orphan' || (o_orderkey % 9) WHEN o_orderkey % 97 = 0 THEN 'dup' || (o_orderkey % 5) WHEN o_orderkey % 33 = 0 THEN '' ELSE 's' || o_orderkey END AS sample_id,
  CASE WHEN o_orderkey % 4 = 0 THEN 'success' ELSE 'failed' END AS status, CASE WHEN o_orderkey % 4 = 1 THEN 'terminal_error' END AS judge_failure, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey ELSE o_orderkey + 1099511627776 END AS ord
 FROM orders WHERE o_orderkey % 3 = 0),
ids AS (SELECT sample_id, count(*) AS n, arg_max(status, ord) AS status, arg_max(CASE WHEN judge_failure IS NULL THEN '' ELSE judge_failure END, ord) AS failure FROM judged WHERE sample_id <> '' GROUP BY sample_id)"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of many sources whose ids collide; some have none."""
    k = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("_source"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("id"), (k % 7).cast("string"))).alias("sample_id"),
        F.when(k % 2 == 0, "success").when(k % 13 == 0, F.lit(None)).otherwise("failed").alias("status"),
        k.alias("_ord"),
    )


SOURCES_SQL = """
records AS (SELECT source, CASE WHEN doc_id % 11 <> 0 THEN 'id' || (doc_id % 7) END AS sample_id, CASE WHEN doc_id % 2 = 0 THEN 'success' WHEN doc_id % 13 <> 0 THEN 'failed' END AS status, doc_id AS ord FROM documents),
keyed AS (SELECT source, sample_id, arg_max(CASE WHEN status IS NULL THEN 'none' ELSE status END, ord) AS status, min(ord) AS ord, count(*) AS n FROM records WHERE sample_id IS NOT NULL GROUP BY source, sample_id)"""


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, _ord, human, reply, images): a conversation's first question and its answer."""
    rows = table(spark, sf_dir, "conversations")
    first = lambda role: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn")))
    return rows.groupBy("conv_id").agg(first("user").alias("human"), first("assistant").alias("reply")).select(F.col("conv_id").alias("sample_id"), F.col("conv_id").alias("_ord"), "human", "reply", F.when(F.col("conv_id") % 3 == 0, F.array(F.lit("a.jpg"))).otherwise(F.array().cast("array<string>")).alias("images"))


CHATS_SQL = """
chats AS (SELECT conv_id AS k, arg_min(text, turn) FILTER (role = 'user') AS human, arg_min(text, turn) FILTER (role = 'assistant') AS reply FROM conversations GROUP BY conv_id)"""


def rewritable(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    name = lambda c: F.concat(F.lit('{"name": "'), c, F.lit('", "size": '), F.col("p_size").cast("string"), F.lit("}"))
    changed = F.when(k % 4 == 1, F.replace("p_name", F.lit(" "), F.lit(" ， "))).when(k % 4 == 2, F.upper("p_name")).otherwise(F.col("p_name"))
    base = F.when(k % 4 == 1, F.replace("p_name", F.lit(" "), F.lit(","))).otherwise(F.col("p_name"))
    content = F.when(k % 4 == 3, F.concat(F.lit('{"cot": 5, "answer": '), name(F.col("p_name")), F.lit(', "x": {"cot": "y"}}'))).otherwise(F.concat(F.lit('So: {"cot": " it says '), "p_type", F.lit(' ", "answer": '), name(changed), F.lit("}")))
    return table(spark, sf_dir, "part").select(
        k.alias("sample_id"), F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("What is "), "p_brand")).alias("human"), F.when(k % 5 == 0, F.lit(None)).otherwise("  because  ").alias("reasoning"), F.when(k % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("it is "), name(base))).alias("reply"),
        name(base).alias("predicted_json"), F.when(k % 3 == 0, F.lit(None)).otherwise(name(F.col("p_name"))).alias("ground_truth"), F.when(k % 6 == 0, "none").otherwise(F.concat(F.lit("truth "), name(F.upper("p_name")))).alias("ground_truth_text"), content.alias("content"), F.when(k % 7 == 6, "GATEWAY_ERROR").otherwise("OK").alias("outcome"),
    )

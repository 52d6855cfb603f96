"""Rewriting chains: what goes to the model, and which rewrites are applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.compare import field_verdicts, is_accepted, sample_level
from ..functions.jsonx import extract_json, flatten_json, rewrite_in
from ..functions.textnorm import DEFAULT, MatchConfig
from .lifecycle import request_messages
from .training import reasoning_text

POLISH, REPAIR = "polish", "repair"
PROMPTS = {
    POLISH: "Rewrite the reasoning so that it reads clearly. Keep the answer as it is. Reply with one JSON object: cot (text) and answer (object).",
    REPAIR: "Write reasoning that leads from the question to the given answer. Reply with one JSON object: cot (text) and answer (object).",
}


def material(records: DataFrame, mode: str) -> DataFrame:
    """Records that can be rewritten, with question, cot and answer.

    Polishing needs all three, repairing a question and ground truth, which the sample's text
    may supply. Earlier rewrites are ignored.
    """
    cot = reasoning_text(F.lit(None).cast("string"), F.col("reasoning"), F.col("reply"))
    answer = F.col("predicted_json") if mode == POLISH else F.coalesce("ground_truth", extract_json(F.col("ground_truth_text")))
    ready = records.withColumn("question", F.col("human")).withColumn("cot", cot).withColumn("answer", answer)
    ready = ready.filter((F.coalesce("question", F.lit("")) != "") & F.col("answer").isNotNull())
    return ready.filter("cot <> ''") if mode == POLISH else ready


def prompt(mode: str, question: Column, cot: Column, answer: Column) -> Column:
    part = lambda name, c: F.concat(F.lit(f"{name}:\n"), c)
    return F.concat_ws("\n\n", part("question", question), F.when(F.coalesce(cot, F.lit("")) != "", part("reasoning", cot)), part("answer", answer))


def rewrite_messages(mode: str) -> Column:
    """The whole request as JSON text, from the columns that `material` adds."""
    return request_messages(F.lit(PROMPTS[mode]), prompt(mode, F.col("question"), F.col("cot"), F.col("answer")), F.lit(None).cast("string"))


def applied(replies: DataFrame, mode: str, config: MatchConfig = DEFAULT, content: str = "content", outcome: str = "outcome", calls: str | None = None) -> DataFrame:
    """Adds polish_result and the status after it. The reply must hold a text `cot` and an object
    `answer`, which stays as JSON text in its key order.

    A polished answer must agree with the original prediction, not the ground truth; one that
    doesn't is kept but not applied. A repaired one needs the right structure alone.
    """
    ok = F.col(outcome) == "OK"
    network = F.col(outcome).isin("NETWORK_ERROR", "RATE_LIMITED", "GATEWAY_ERROR")
    said = replies.withColumn("_new", F.when(ok, rewrite_in(F.col(content))))
    parsed = F.col("_new.answer").isNotNull()
    if mode == POLISH:
        said = said.withColumn("_level", sample_level(field_verdicts(flatten_json(F.col("_new.answer")), flatten_json(F.col("predicted_json")), config)))
    else:
        said = said.withColumn("_level", F.lit(None).cast("string"))
    failure = F.when(network, "network_exhausted").when(~ok, "terminal_error").when(~F.coalesce(parsed, F.lit(False)), "parse_failed")
    good = is_accepted(F.col("_level")) if mode == POLISH else F.lit(True)
    attempts = F.col(calls).cast("int") if calls else F.lit(None).cast("int")
    result = F.struct(
        F.lit(mode).alias("mode"),
        F.coalesce(failure.isNull() & good, F.lit(False)).alias("applied"),
        attempts.alias("attempts"),
        F.when(failure.isNull(), F.col("_new.cot")).alias("polished_cot"),
        F.when(failure.isNull(), F.col("_new.answer")).alias("polished_answer"),
        F.when(failure.isNull(), F.col("_level")).alias("match_level"),
        F.when(ok, F.col(content)).alias("content"),
        F.when(~ok, F.col(outcome)).when(failure.isNotNull(), "output_unparseable").alias("error"),
        failure.alias("failure"),
    )
    out = said.withColumn("polish_result", result)
    return out.drop("_new", "_level").withColumn("status", F.when(F.col("polish_result.applied"), "success").otherwise("failed"))


def rewrite_summary(rows: DataFrame, skipped_no_material: int = 0, skipped_resume: int = 0) -> DataFrame:
    """One row: processed, applied, answer_changed, three failures, skips and the applied rate."""
    result = lambda n: F.col(f"polish_result.{n}")
    good = F.count_if(result("applied"))
    return rows.agg(
        F.count("*").alias("processed"),
        good.alias("applied"),
        F.count_if(~result("applied") & result("failure").isNull()).alias("answer_changed"),
        *(F.count_if(result("failure") == n).alias(n) for n in ("parse_failed", "network_exhausted", "terminal_error")),
        F.lit(skipped_no_material).cast("long").alias("skipped_no_material"),
        F.lit(skipped_resume).cast("long").alias("skipped_resume"),
        F.coalesce(F.try_divide(good, F.count("*")), F.lit(0.0)).alias("applied_rate"),
    )

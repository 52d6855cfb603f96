"""Second opinions on differences: what is asked, and what verdicts decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import verdicts_in
from .assemble import has_id
from .lifecycle import Budgets, request_messages

#: Judging knows network budgets alone.
JUDGE_BUDGETS = Budgets(sample=None, network=5, gateway=None)
PROMPT = "Decide for each numbered field whether the two values mean the same. Answer with one JSON object: a list `verdicts` of objects with field, match (true or false) and reason."


def judge_pairs(diffs: Column) -> Column:
    """array<struct<field, predicted, ground_truth>>; null where there is nothing to judge."""
    pairs = F.transform(diffs, lambda d: F.struct(d["field"].alias("field"), d["predicted"].alias("predicted"), d["ground_truth"].alias("ground_truth")))
    return F.when(F.size(diffs) > 0, pairs)


def judgeable(records: DataFrame, diffs: str = "differences") -> DataFrame:
    """Records with an id and differences, with their pairs; nothing else goes to the model."""
    return records.withColumn("pairs", judge_pairs(F.col(diffs))).filter(F.col("pairs").isNotNull() & has_id(F.col("sample_id")))


def judge_messages(pairs: Column) -> Column:
    """The whole request as JSON text."""
    return request_messages(F.lit(PROMPT), judge_prompt(pairs), F.lit(None).cast("string"))


def judge_prompt(pairs: Column) -> Column:
    """A numbered list of fields with both values as JSON."""
    value = lambda v: F.when(v.isNull(), "null").otherwise(F.regexp_extract(F.to_json(F.struct(v.alias("v"))), r"(?s)^\{.v.:(.*)\}$", 1))
    lines = F.transform(pairs, lambda p, i: F.concat((i + 1).cast("string"), F.lit(". field: "), p["field"], F.lit("\n   predicted: "), value(p["predicted"]), F.lit("\n   expected: "), value(p["ground_truth"])))
    return F.array_join(lines, "\n")


def overturned(pairs: Column, verdicts: Column) -> Column:
    """Every pair has a verdict, the first one of its field, whose match is exactly true."""
    first = lambda field: F.try_element_at(F.filter(verdicts, lambda v: v["field"] == field), F.lit(1))
    return F.forall(pairs, lambda p: F.coalesce(first(p["field"])["match"], F.lit(False)))


def apply_verdicts(asked: DataFrame, content: str = "content", outcome: str = "outcome", calls: str | None = None) -> DataFrame:
    """Adds judge_result and the status after it.

    Replies that can't be used, exhausted networks and terminal errors are failures, and nothing
    is overturned by them. Elements of the verdict list that are no objects are passed over.
    """
    ok = F.col(outcome) == "OK"
    network = F.col(outcome).isin("NETWORK_ERROR", "RATE_LIMITED", "GATEWAY_ERROR")
    said = asked.withColumn("_said", F.when(ok, verdicts_in(F.col(content))))
    items = F.col("_said.items")
    failure = F.when(network, "network_exhausted").when(~ok, "terminal_error").when(items.isNull(), "judge_parse_failed")
    turned = F.coalesce(failure.isNull() & overturned(F.col("pairs"), items), F.lit(False))
    error = F.when(~ok, F.col(outcome)).when(items.isNull(), "verdict_unparseable")
    attempts = F.col(calls).cast("int") if calls else F.lit(None).cast("int")
    result = F.struct(
        turned.alias("overturned"), F.col("pairs"), attempts.alias("attempts"), F.col("_said.raw").alias("verdicts"),
        F.when(ok, F.col(content)).alias("content"), error.alias("error"), failure.alias("failure"),
    )
    return said.withColumn("judge_result", result).withColumn("status", F.when(turned, "success").otherwise("failed")).drop("_said")


def judge_summary(judged: DataFrame, skipped_no_differences: int = 0, skipped_resume: int = 0) -> DataFrame:
    """One row: how many were judged, the five outcomes, skips, and the overturn rate."""
    fail = lambda name: F.count_if(F.col("judge_result.failure") == name)
    turned = F.count_if(F.col("judge_result.overturned"))
    return judged.agg(
        F.count("*").alias("judged"),
        turned.alias("overturned"),
        F.count_if(~F.col("judge_result.overturned") & F.col("judge_result.failure").isNull()).alias("upheld"),
        *(fail(n).alias(n) for n in ("judge_parse_failed", "network_exhausted", "terminal_error")),
        F.lit(skipped_no_differences).cast("long").alias("skipped_no_differences"),
        F.lit(skipped_resume).cast("long").alias("skipped_resume"),
        F.coalesce(F.try_divide(turned, F.count("*")), F.lit(0.0)).alias("overturn_rate"),
    )

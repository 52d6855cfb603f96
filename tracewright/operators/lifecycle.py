"""Generation: classification of calls, and the fold of attempt logs into one record a sample."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.compare import is_accepted, rank

# Outcome classes.
OK, NETWORK, RATE, GATEWAY, API, EMPTY, LENGTH = "OK", "NETWORK_ERROR", "RATE_LIMITED", "GATEWAY_ERROR", "API_ERROR", "EMPTY_RESPONSE", "LENGTH_TRUNCATED"
NETWORK_CLASS, TERMINAL_CLASS = (NETWORK, RATE, GATEWAY), (API, EMPTY, LENGTH)
PARSE_ERROR, MISMATCH_ERROR = "JSON_PARSE_ERROR", "MISMATCH"


@dataclass(frozen=True)
class Budgets:
    """Calls that may end in a mismatch, in a network-class error, and gateway retries."""

    sample: int | None = 3
    network: int = 5
    gateway: int | None = 2


def classify_outcome(status: Column, content: Column, finish_reason: Column, failed: Column) -> Column:
    """The outcome class of a call; `failed` marks exceptions and timeouts."""
    empty = F.coalesce(content, F.lit("")) == ""
    return (
        F.when(failed, NETWORK)
        .when((status == 200) & ~empty, OK)
        .when((status == 200) & (finish_reason == "length"), LENGTH)
        .when(status == 200, EMPTY)
        .when(status.isin(403, 429), RATE)
        .when(status.isin(502, 503, 504), GATEWAY)
        .otherwise(API)
    )


def retry_after(status: Column, header: Column) -> Column:
    """Seconds asked for by a rejected call; a header that is no number is none."""
    return F.when(status.isin(403, 429), header.try_cast("double"))


def ground_truth_text(messages: Column, conversations: Column) -> Column:
    """The second message's content, else the second turn's value, else empty."""
    said = F.try_element_at(conversations, F.lit(2))["value"]
    return F.when(F.size(messages) > 1, F.element_at(messages, 2)["content"]).otherwise(F.coalesce(said, F.lit("")))


def request_text(messages: Column, conversations: Column) -> Column:
    """The user's text without image marks; the untouched text if nothing else is left."""
    asked = F.coalesce(F.try_element_at(messages, F.lit(1))["content"], F.try_element_at(conversations, F.lit(1))["value"], F.lit(""))
    plain = F.trim(F.replace(asked, F.lit("<image>"), F.lit("")))
    return F.when(plain == "", asked).otherwise(plain)


def request_messages(system: Column, text: Column, image_url: Column) -> Column:
    """Request messages as JSON text: system prompt, then text and, if there is one, an image."""
    part = lambda kind, name, value: F.to_json(F.struct(F.lit(kind).alias("type"), value.alias(name)))
    image = F.when(image_url.isNotNull(), part("image_url", "image_url", F.struct(image_url.alias("url"))))
    user = F.concat(F.lit("["), F.concat_ws(",", image, part("text", "text", text)), F.lit("]"))
    first = F.to_json(F.struct(F.lit("system").alias("role"), system.alias("content")))
    return F.concat(F.lit("["), first, F.lit(',{"role":"user","content":'), user, F.lit("}]"))


def sample_id(id_: Column, position: Column) -> Column:
    return F.coalesce(id_, F.concat(F.lit("sample_"), position))


def folded(attempts: DataFrame, budgets: Budgets = Budgets()) -> DataFrame:
    """Every attempt up to its sample's terminal one, with running counts, quota and state.

    Attempts have sample_id, attempt_no, outcome, match_level (null unless scored) and
    matched. A scored attempt without a level is a reply that couldn't be parsed. The state is
    success, failed or exhausted on the terminal row, and open before it.
    """
    by = Window.partitionBy("sample_id").orderBy("attempt_no")
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    mismatched = (F.col("outcome") == OK) & F.col("match_level").isNotNull() & ~is_accepted(F.col("match_level"))
    marked = attempts.withColumn("_mm", mismatched.cast("int")).withColumn("_nw", F.col("outcome").isin(*NETWORK_CLASS).cast("int")).withColumn("_gw", (F.col("outcome") == GATEWAY).cast("int"))
    counted = marked.select("*", *(F.sum(c).over(upto).alias(n) for c, n in (("_mm", "mm"), ("_nw", "nw"), ("_gw", "gw"))), F.lag("outcome").over(by).alias("_last"))
    state = F.when((F.col("outcome") == OK) & F.col("match_level").isNull(), "failed").when((F.col("outcome") == OK) & is_accepted(F.col("match_level")), "success")
    if budgets.sample is not None:
        state = state.when((F.col("_mm") == 1) & (F.col("mm") >= budgets.sample), "exhausted")
    if budgets.gateway is not None:
        state = state.when((F.col("_gw") == 1) & (F.col("gw") > budgets.gateway), "exhausted")
    state = state.when((F.col("_nw") == 1) & (F.col("nw") >= budgets.network), "exhausted").when(F.col("outcome").isin(*TERMINAL_CLASS), "failed").otherwise("open")
    quota = F.when(F.col("_last").isNull(), "initial").when(F.col("_last") == OK, "retry_quality").otherwise("retry_network")
    stated = counted.withColumn("state", state).withColumn("quota", quota)
    ended = F.coalesce(F.max((F.col("state") != "open").cast("int")).over(before), F.lit(0))
    return stated.withColumn("_ended", ended).filter("_ended = 0").drop("_mm", "_nw", "_gw", "_last", "_ended")


def best_attempt(attempts: DataFrame) -> DataFrame:
    """The best scored attempt of each sample: level, then matched fields, then the earliest."""
    order = Window.partitionBy("sample_id").orderBy(F.desc(rank(F.col("match_level"))), F.desc("matched"), "attempt_no")
    return attempts.filter("match_level is not null").withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def outcomes(attempts: DataFrame, budgets: Budgets = Budgets()) -> DataFrame:
    """One record a sample: status, attempts, error_type, match_level, best attempt.

    Exhausted samples take their best scored attempt and its mismatch, or the last error class
    if none was scored. Failed ones keep their own class and nothing of earlier attempts. Samples
    without a terminal attempt are open.
    """
    rows = folded(attempts, budgets)
    scored = F.when(F.col("match_level").isNotNull(), F.struct(rank(F.col("match_level")).alias("r"), F.col("matched").alias("m"), (-F.col("attempt_no")).alias("no"), F.col("match_level").alias("level")))
    ends = rows.groupBy("sample_id").agg(F.max("attempt_no").alias("attempts"), F.max_by(F.struct("state", "outcome", "match_level", "matched"), "attempt_no").alias("end"), F.max(scored).alias("best"))
    exhausted = F.col("end.state") == "exhausted"
    error = (
        F.when(F.col("end.state").isin("success", "open"), F.lit(None))
        .when(exhausted & F.col("best").isNotNull(), MISMATCH_ERROR)
        .when(F.col("end.outcome") == OK, PARSE_ERROR)
        .otherwise(F.col("end.outcome"))
    )
    return ends.select(
        "sample_id",
        F.when(F.col("end.state") == "open", "open").when(F.col("end.state") == "success", "success").otherwise("failed").alias("status"),
        F.col("attempts").cast("long").alias("attempts"),
        error.alias("error_type"),
        F.when(exhausted, F.col("best.level")).when(F.col("end.state") == "success", F.col("end.match_level")).alias("match_level"),
        F.when(exhausted, -F.col("best.no")).when(F.col("end.state") == "success", F.col("attempts")).cast("long").alias("kept_attempt"),
    )


def quota_counts(rows: DataFrame) -> DataFrame:
    """(quota, n): the three usual buckets, zeros included, and any other."""
    usual = rows.sparkSession.createDataFrame([("initial",), ("retry_quality",), ("retry_network",)], "quota string")
    return rows.groupBy("quota").agg(F.count("*").alias("n")).join(usual, "quota", "full_outer").select("quota", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def client_counters(attempts: DataFrame) -> DataFrame:
    """(outcome, calls, prompt_tokens, completion_tokens, with_usage)."""
    return attempts.groupBy("outcome").agg(
        F.count("*").alias("calls"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"),
        F.count(F.coalesce("prompt_tokens", "completion_tokens")).alias("with_usage"),
    )


def generate(samples: DataFrame, call: Callable[[DataFrame, int], DataFrame], budgets: Budgets = Budgets(), rounds: int | None = None, pause: Callable[[DataFrame, int], None] | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, attempts) by bounded rounds over the samples that are still open.

    `call` gets the open samples and the attempt number, and returns sample_id, outcome,
    match_level and matched for each; it may run a model in mapInPandas. Its result is
    checkpointed at once, so no call is made again. No sample needs more rounds than its
    budgets add up to. `pause` gets a round's calls before the next one.
    """
    limit = rounds or (budgets.sample or 1) + budgets.network - 1
    attempts, open_ = None, samples
    for number in range(1, limit + 1):
        made = call(open_, number).withColumn("attempt_no", F.lit(number)).checkpoint()
        attempts = made if attempts is None else attempts.unionByName(made)
        still = outcomes(attempts, budgets).filter("status = 'open'").select("sample_id")
        open_ = samples.join(still, "sample_id", "left_semi")
        if open_.isEmpty():
            break
        if pause:
            pause(made, number)
    return outcomes(attempts, budgets), attempts

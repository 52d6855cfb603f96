"""Batches over a model: generating, judging and rewriting records, resumed where they stopped.

Every batch drops what is done before any call, runs rounds of calls over what is left, and gives
its records and its calls; what is written, and where, is the caller's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compare import comparison, field_verdicts
from ..functions.jsonx import extract_json, flatten_json
from ..functions.textnorm import DEFAULT, MatchConfig
from ..sources.tables import RECORDS, read_images
from . import adjudicate, lifecycle, rewrite, training
from .assemble import has_id, pending
from .lifecycle import Budgets
from .model import ModelFunction, model_calls, replies

PROMPT = "Read the document and reason step by step. Close with one JSON object that holds the fields asked for."
Pause = Callable[[DataFrame, int], None] | None


@dataclass(frozen=True)
class Batch:
    """New records with the columns of RECORDS, _source and _ord; all calls; and counts of inputs
    that were passed over."""

    records: DataFrame
    calls: DataFrame
    skipped: dict[str, int] = field(default_factory=dict)


def record_columns(df: DataFrame) -> DataFrame:
    """The columns of RECORDS, nulls where there are none, with _source and _ord."""
    want = df.sparkSession.createDataFrame([], RECORDS).schema
    return df.select(*((F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in want), "_source", "_ord")


def with_image(samples: DataFrame, folder: str | None) -> DataFrame:
    """Adds image_url, the first image as a data URL; null where there is none or it can't be read.

    Images are named by paths below `folder`, which is read once; without it none is sent.
    """
    none = F.lit(None).cast("string")
    if folder is None:
        return samples.withColumn("image_url", none)
    base = F.regexp_replace(F.lit(folder.rstrip("/")), "^file:/*", "/")
    files = read_images(samples.sparkSession, folder).select(F.regexp_replace("path", "^file:/*", "/").alias("_path"), F.col("url").alias("image_url"))
    first = F.trim(F.try_element_at("images", F.lit(1)))
    path = F.when(first.startswith("/"), first).otherwise(F.concat(base, F.lit("/"), first))
    return samples.withColumn("_path", path).join(files, "_path", "left").drop("_path")


def requests(samples: DataFrame, prompt: str = PROMPT, images: str | None = None) -> DataFrame:
    """(sample_id, _source, _ord, original_sample, ground_truth, messages): what is asked, and what
    is right; ground truth without any field counts as none."""
    truth = extract_json(lifecycle.ground_truth_text(F.col("messages"), F.col("conversations")))
    said = samples.withColumn("original_sample", F.to_json(F.struct("id", "messages", "conversations", "images")))
    asked = with_image(said, images).withColumn("_truth", truth)
    text = lifecycle.request_text(F.col("messages"), F.col("conversations"))
    return asked.select(
        "sample_id", "_source", "_ord", "original_sample", F.nullif("_truth", F.lit("{}")).alias("ground_truth"), lifecycle.request_messages(F.lit(prompt), text, F.col("image_url")).alias("messages")
    )


def scored(calls: DataFrame, config: MatchConfig = DEFAULT) -> DataFrame:
    """Calls with predicted_json, comparison_result, match_level and matched; nulls where the
    reply holds no object, or one without any field."""
    found = calls.withColumn("predicted_json", F.nullif(extract_json(F.when(F.col("outcome") == lifecycle.OK, F.col("content"))), F.lit("{}")))
    sides = found.withColumn("_p", flatten_json(F.col("predicted_json"))).withColumn("_g", flatten_json(F.col("ground_truth")))
    fields = sides.withColumn("_f", field_verdicts(F.col("_p"), F.col("_g"), config))
    done = fields.withColumn("comparison_result", F.when(F.col("_f").isNotNull(), comparison(F.col("_f"), F.col("_g")).dropFields("fields")))
    return done.withColumn("match_level", F.col("comparison_result.match_level")).withColumn("matched", F.coalesce("comparison_result.matched_fields", F.lit(0))).drop("_p", "_g", "_f")


def generated(samples: DataFrame, model: ModelFunction, *, budgets: Budgets = Budgets(), config: MatchConfig = DEFAULT, prompt: str = PROMPT, images: str | None = None, done: DataFrame | None = None, per_minute: float | None = None, partitions: int = 1, pause: Pause = None) -> Batch:
    """Samples to records, by rounds of calls within each sample's budgets.

    Samples whose ground truth holds no object fail without any call. A sample that runs out of
    budget keeps its best reply.
    """
    total = samples.count()
    left = samples if done is None else pending(samples, done)
    asked = requests(left, prompt, images).checkpoint()
    fit = asked.filter("ground_truth is not null")
    unfit = asked.filter("ground_truth is null")

    def call(open_: DataFrame, number: int) -> DataFrame:
        said = model_calls(open_.select("sample_id", "messages", "ground_truth").withColumn("attempt_no", F.lit(number)), model, per_minute=per_minute, partitions=partitions)
        return scored(said, config).drop("messages", "ground_truth", "attempt_no")

    ends, calls = lifecycle.generate(fit, call, budgets, pause=pause)
    kept = calls.select("sample_id", "attempt_no", "content", "response", "predicted_json", "comparison_result")
    ended = F.greatest("kept_attempt", F.when(F.col("error_type") != lifecycle.MISMATCH_ERROR, F.col("attempts")))
    picked = ends.withColumn("attempt_no", ended).join(kept, ["sample_id", "attempt_no"], "left").join(fit, "sample_id")
    parsed = F.col("error_type").isNull() | (F.col("error_type") == lifecycle.MISMATCH_ERROR)
    read = parsed | (F.col("error_type") == lifecycle.PARSE_ERROR)
    level = F.col("comparison_result.match_level")
    error = (
        F.when(F.col("status") == "success", F.lit(None))
        .when(F.col("error_type") == lifecycle.MISMATCH_ERROR, F.concat(F.lit(f"no match in {budgets.sample} attempts, best level "), level))
        .when(F.col("error_type") == lifecycle.PARSE_ERROR, "no JSON object in the reply")
        .otherwise(F.concat(F.lit("calls failed: "), F.col("error_type")))
    )
    good = picked.select(
        "sample_id", "status", F.col("attempts").cast("int").alias("attempts"), "original_sample", F.when(read, F.col("content")).alias("cot_response"), F.col("response").alias("full_api_response"),
        F.when(parsed, F.col("predicted_json")).alias("predicted_json"), F.when(read | F.col("error_type").isin(*lifecycle.NETWORK_CLASS), F.col("ground_truth")).alias("ground_truth"), F.when(parsed, level).alias("match_level"), error.alias("error"), "error_type",
        F.when(parsed, F.col("comparison_result")).alias("comparison_result"), "_source", "_ord",
    )
    bad = unfit.select("sample_id", F.lit("failed").alias("status"), F.lit(1).alias("attempts"), "original_sample", F.lit("the ground truth holds no JSON object").alias("error"), F.lit(lifecycle.PARSE_ERROR).alias("error_type"), "_source", "_ord")
    records = record_columns(good).unionByName(record_columns(bad)).checkpoint()
    return Batch(records, lifecycle.folded(calls, budgets).withColumnRenamed("quota", "quota_kind"), {"skipped": total - asked.count()})


def judged(records: DataFrame, model: ModelFunction, *, network: int = 5, done: DataFrame | None = None, per_minute: float | None = None, partitions: int = 1, pause: Pause = None) -> Batch:
    """Failed records with a second opinion on their differences; only these are sent."""
    fit = adjudicate.judgeable(records.withColumn("differences", F.col("comparison_result.differences"))).drop("judge_result", "differences")
    left = fit if done is None else pending(fit, done)
    asked = left.checkpoint()
    n = fit.count()
    skipped = {"skipped_no_differences": records.count() - n, "skipped_resume": n - asked.count()}
    calls = replies(asked.select("_ord", "sample_id", adjudicate.judge_messages(F.col("pairs")).alias("messages")), model, network=network, kind="judge", per_minute=per_minute, partitions=partitions, pause=pause)
    final = calls.filter("last").select("_ord", "content", "outcome", F.col("attempt_no").alias("_calls"))
    told = adjudicate.apply_verdicts(asked.join(final, "_ord"), calls="_calls")
    return Batch(record_columns(told).checkpoint(), calls, skipped)


def material(records: DataFrame) -> DataFrame:
    """Records with what training rows and rewrites are made of: human, images, reply, reasoning,
    the applied rewrite, the sample's own ground truth, and the differences."""
    from ..sources.tables import SAMPLES

    sample = F.from_json("original_sample", SAMPLES)
    applied = F.coalesce(F.col("polish_result.applied"), F.lit(False))
    rows = records.withColumn("_s", sample)
    return rows.select(
        "*",
        training.human_text(F.col("_s.messages"), F.col("_s.conversations")).alias("human"),
        F.coalesce("_s.images", F.array().cast("array<string>")).alias("images"),
        F.col("cot_response").alias("reply"),
        training.reasoning_channel(F.col("full_api_response")).alias("reasoning"),
        F.when(applied, F.col("polish_result.polished_cot")).alias("polished_cot"),
        F.when(applied, F.col("polish_result.polished_answer")).alias("polished_answer"),
        lifecycle.ground_truth_text(F.col("_s.messages"), F.col("_s.conversations")).alias("ground_truth_text"),
        F.col("comparison_result.differences").alias("differences"),
    ).drop("_s")


def rewritten(records: DataFrame, model: ModelFunction, mode: str = rewrite.POLISH, *, config: MatchConfig = DEFAULT, network: int = 5, done: DataFrame | None = None, per_minute: float | None = None, partitions: int = 1, pause: Pause = None) -> Batch:
    """Records with a rewritten chain, of successes, or of failures from their ground truth."""
    fit = rewrite.material(material(records), mode).filter(has_id(F.col("sample_id"))).drop("polish_result")
    left = fit if done is None else pending(fit, done)
    asked = left.checkpoint()
    n = fit.count()
    skipped = {"skipped_no_material": records.count() - n, "skipped_resume": n - asked.count()}
    calls = replies(asked.select("_ord", "sample_id", rewrite.rewrite_messages(mode).alias("messages")), model, network=network, kind=mode, per_minute=per_minute, partitions=partitions, pause=pause)
    final = calls.filter("last").select("_ord", "content", "outcome", F.col("attempt_no").alias("_calls"))
    told = rewrite.applied(asked.join(final, "_ord"), mode, config, calls="_calls")
    return Batch(record_columns(told).checkpoint(), calls, skipped)


def call_events(calls: DataFrame) -> DataFrame:
    """Calls as request events; times that the model didn't tell are 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return calls.select(
        "sample_id", F.lit("request").alias("kind"), "outcome", "quota_kind", (zero("started") + zero("rtt")).alias("ts"), zero("rtt").alias("rtt"), F.lit(0.0).alias("wait_limiter"), F.lit(0.0).alias("wait_slot"), F.lit(0.0).alias("backoff"), zero("started").alias("started")
    )

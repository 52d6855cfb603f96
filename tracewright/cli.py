"""Command line: python -m tracewright.cli <tool> ...

The tools read dataset folders or JSON files and write the same, so each one's output is the
next one's input: generate, judge, merge, combine, polish, convert. Calls go to a chat completion
service; judge and polish also take replies from a file.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import jsonx
from .functions.compare import comparison, field_verdicts
from .functions.textnorm import DEFAULT, LEGACY
from .operators import adjudicate, assemble, batches, lifecycle, rewrite, telemetry, training, verdicts
from .operators.model import Endpoint, ModelFunction, backing_off, http_model
from .plans.session import build, ensure_checkpoints
from .sources import tables


def compare(spark: SparkSession, a: argparse.Namespace) -> None:
    """Replies against ground truth, field by field."""
    rows = spark.read.json(a.input)
    config = LEGACY if a.legacy else DEFAULT
    flat = rows.select("sample_id", jsonx.flatten_json(jsonx.extract_json(F.col("reply"))).alias("p"), jsonx.flatten_json(jsonx.extract_json(F.col("ground_truth"))).alias("g"))
    done = flat.withColumn("f", field_verdicts(F.col("p"), F.col("g"), config)).select("sample_id", comparison(F.col("f"), F.col("g")).alias("comparison"))
    done.write.mode("overwrite").parquet(a.output)


def fold(spark: SparkSession, a: argparse.Namespace) -> None:
    """An attempt log to one record a sample."""
    budgets = lifecycle.Budgets(a.sample_budget, a.network_budget, a.gateway_budget)
    lifecycle.outcomes(spark.read.parquet(a.input), budgets).write.mode("overwrite").parquet(a.output)


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    """A run and a judge's records of it."""
    if a.output.rstrip("/") == a.run.rstrip("/"):
        sys.exit("the output must not be the run itself")
    failure = F.col("judge_result.failure").alias("judge_failure")
    run, judged = (tables.read_dataset(spark, p).select("*", failure) for p in (a.run, a.judge))
    rows = assemble.merged(run, judged).withColumn("status", F.col("merged_status")).drop("merged_status", "origin", "judge_failure", "_source")
    tables.write_dataset(tables.stored(rows), a.output, ["_ord"])
    tables.export_summary(assemble.merge_summary(run, judged), f"{a.output}/merge_summary.json")


def combine(spark: SparkSession, a: argparse.Namespace) -> None:
    """Several runs in one."""
    if a.output.rstrip("/") in [p.rstrip("/") for p in a.inputs]:
        sys.exit("the output must not be one of the inputs")
    rows = None
    for number, path in enumerate(a.inputs):
        part = tables.read_dataset(spark, path).withColumn("_source", F.lit(path)).withColumn("_ord", F.col("_ord") + F.lit(number) * F.lit(1 << 61).cast("decimal(38,0)"))
        rows = part if rows is None else rows.unionByName(part)
    tables.write_dataset(assemble.combined(rows).drop("_source"), a.output, ["_keyed", "_ord"])
    tables.export_summary(assemble.combine_summary(rows), f"{a.output}/combine_summary.json")


def convert(spark: SparkSession, a: argparse.Namespace) -> None:
    """Records to training rows, with hard examples and external rows within the budget."""
    names = {"think_flag": a.think_flag, "no_think_flag": a.no_think_flag, "answer_tag": a.answer_tag}
    records = tables.read_dataset(spark, a.input, only="success")
    good = training.as_chat(training.training_rows(batches.material(records), a.mode, fences=a.strip_fences, think_tag=a.think_tag, **names))
    bad = outside = good.limit(0)
    if a.include_failed:
        folder = tables.is_folder(spark, a.input)
        beside = a.input if folder else f"{a.input.rpartition('/')[0] or '.'}/{dict(tables.PARTS)['failed']}"
        failed = tables.read_dataset(spark, a.input, only="failed") if folder else tables.read_optional(spark, beside, tables.RECORDS)
        hard = training.hard_examples(batches.material(failed), a.include_failed, **names)
        bad = training.as_chat(hard, "recovered")
    if a.mix:
        mixed = training.sanitized(tables.read_array(spark, a.mix, tables.SHAREGPT), **names)
        outside = mixed.select(F.col("_ord").cast("string").alias("sample_id"), "_ord", "conversations", "images")
    ratio = a.mix_ratio if (a.include_failed or a.mix) else 0.0
    rows = training.assembled(good, bad, outside, ratio)
    chat = F.to_json(F.struct("conversations", "images"))
    lines = a.format == "jsonl" if a.format else a.output.endswith(".jsonl")
    shown = chat if lines else jsonx.nested_json(())(chat)
    tables.export_array(rows.select("_block", "_ord", shown.alias("j")), a.output, ["_block", "_ord"], as_lines=lines, json_column="j")
    given = {"input": a.input, "output": a.output, "gpt_mode": a.mode, "format": "jsonl" if lines else "json", "strip_fences": a.strip_fences, "think_tag": a.think_tag, **names, "include_failed": a.include_failed, "mix_source": a.mix}
    summary = training.convert_summary(rows, total_records=records.count(), ratio=ratio)
    tables.export_summary(summary.select(*(F.lit(v).alias(k) for k, v in given.items()), "*"), f"{a.output.rpartition('/')[0] or '.'}/convert_summary.json")


def _endpoint(a: argparse.Namespace) -> Endpoint:
    return Endpoint(a.api_endpoint, a.api_key, a.model, a.max_tokens, a.temperature, a.top_p, a.top_k, a.presence_penalty, not a.no_thinking, a.request_timeout, a.connect_timeout, a.max_concurrent)


def _calling(a: argparse.Namespace) -> dict:
    return {"per_minute": a.qpm_limit, "pause": backing_off(a.backoff_base, a.backoff_cap)}


def _config(a: argparse.Namespace) -> list:
    """What a summary tells about a run's settings; never the key."""
    told = ["model", "qpm_limit", "max_concurrent", "network_max_attempts", "request_timeout", "connect_timeout", "max_tokens", "temperature", "top_p", "top_k", "presence_penalty"]
    return [F.struct(*(F.lit(getattr(a, n)).alias(n) for n in told), F.lit(not a.no_thinking).alias("enable_thinking")).alias("config")]


def _recorded(spark: SparkSession, path: str) -> ModelFunction:
    """A model that gives the replies of a JSON file: sample_id, content and outcome, one row each.

    Rows without a reply fail as a call that the service refuses; the file must fit in memory.
    """
    known = {r["sample_id"]: (r["content"], r["outcome"]) for r in spark.read.schema("sample_id string, content string, outcome string").json(path).collect()}
    status = {"OK": 200, "EMPTY_RESPONSE": 200, "RATE_LIMITED": 429, "GATEWAY_ERROR": 502}

    def model(frame):  # noqa: ANN001, ANN202
        import pandas as pd

        said = [known.get(i, (None, "API_ERROR")) for i in frame["sample_id"]]
        return pd.DataFrame({"status": [status.get(o, 400) for _, o in said], "content": [c for c, _ in said], "failed": [o == "NETWORK_ERROR" for _, o in said]})

    return model


def _model(spark: SparkSession, a: argparse.Namespace) -> ModelFunction:
    if a.replies:
        return _recorded(spark, a.replies)
    if not (a.api_endpoint and a.model):
        sys.exit("name a service by --api-endpoint and --model, or a file by --replies")
    return http_model(_endpoint(a))


def _done(spark: SparkSession, path: str) -> DataFrame | None:
    """Records that an earlier, interrupted call of a tool left; None without any."""
    there = any(tables.exists(spark, f"{path.rstrip('/')}/{file}") for _, file in tables.PARTS)
    return tables.read_dataset(spark, path) if there else None


def _store(new: DataFrame, old: DataFrame | None, path: str) -> None:
    """Old records, then new ones; of an id the last one, where its first one stood."""
    behind = new.withColumn("_ord", F.col("_ord").cast("decimal(38,0)") + (F.lit(1 << 62).cast("decimal(38,0)") if old is not None else F.lit(0)))
    every = behind if old is None else old.withColumn("_ord", F.col("_ord").cast("decimal(38,0)")).unionByName(behind)
    # copied, as the files it is read from are replaced now
    tables.write_dataset(assemble.compacted(every).drop("_source").checkpoint(), path, ["_ord"])


def generate(spark: SparkSession, a: argparse.Namespace) -> None:
    """Samples to records, by calls within each sample's budgets."""
    budgets = lifecycle.Budgets(a.max_sample_attempts, a.network_max_attempts, a.gateway_max_attempts)
    config = LEGACY if a.legacy else DEFAULT
    samples = tables.read_samples(spark, a.input, a.sample_size)
    old = _done(spark, a.output)
    prompt = "\n".join(r[0] for r in spark.read.text(a.prompt_file).collect()) if a.prompt_file else batches.PROMPT
    run = batches.generated(samples, _model(spark, a), budgets=budgets, config=config, prompt=prompt, images=a.images, done=old, **_calling(a))
    _store(run.records, old, a.output)
    events = batches.call_events(run.calls)
    tables.append_events(telemetry.events_logged(events), f"{a.output}/metrics.jsonl", fresh=old is None)
    counters = verdicts.run_counters(run.records, run.skipped["skipped"])
    metrics = telemetry.call_metrics(run.calls).join(telemetry.performance(events, a.metrics_interval).select(F.struct("*").alias("performance")))
    amplified = F.coalesce(F.try_divide("total_http_requests", F.col("success") + F.col("failed")), F.lit(0.0))
    quality = verdicts.quality_summary(run.records.select("comparison_result.match_score"))
    summary = counters.join(metrics).join(quality.select(F.struct("*").alias("quality")))
    tables.export_summary(summary.select("*", amplified.alias("amplification"), *_config(a)), f"{a.output}/summary.json")


def judge(spark: SparkSession, a: argparse.Namespace) -> None:
    """Second opinions on failed records."""
    records = tables.read_dataset(spark, a.input, only="failed")
    records = tables.head(records, a.limit) if a.limit else records
    old = _done(spark, a.output)
    run = batches.judged(records, _model(spark, a), network=a.network_max_attempts, done=old, **_calling(a))
    _store(run.records, old, a.output)
    summary = adjudicate.judge_summary(run.records, **run.skipped).join(telemetry.call_metrics(run.calls))
    tables.export_summary(summary.select(F.lit(records.count()).alias("total_records"), "*", *_config(a)), f"{a.output}/judge_summary.json")


def polish(spark: SparkSession, a: argparse.Namespace) -> None:
    """Rewritten chains of successes, or of failures from their ground truth."""
    only = "success" if a.mode == rewrite.POLISH else "failed"
    records = tables.read_dataset(spark, a.input, only=only)
    records = tables.head(records, a.limit) if a.limit else records
    old = _done(spark, a.output)
    run = batches.rewritten(records, _model(spark, a), a.mode, network=a.network_max_attempts, done=old, **_calling(a))
    _store(run.records, old, a.output)
    summary = rewrite.rewrite_summary(run.records, **run.skipped).join(telemetry.call_metrics(run.calls))
    tables.export_summary(summary.select(F.lit(records.count()).alias("total_records"), F.lit(a.mode).alias("mode"), "*", *_config(a)), f"{a.output}/polish_summary.json")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tracewright", description=__doc__)
    sub = p.add_subparsers(required=True)

    def tool(f, *names: str) -> argparse.ArgumentParser:  # noqa: ANN001
        t = sub.add_parser(f.__name__, help=f.__doc__)
        t.set_defaults(run_tool=f)
        for n in names:
            t.add_argument(f"--{n}", required=True)
        return t

    def calls(t: argparse.ArgumentParser) -> argparse.ArgumentParser:
        for name, kind, default in (
            ("api-endpoint", str, None), ("api-key", str, ""), ("model", str, None), ("qpm-limit", float, 50.0), ("max-concurrent", int, 4), ("network-max-attempts", int, 5), ("request-timeout", float, 120.0), ("connect-timeout", float, 30.0), ("backoff-base", float, 5.0),
            ("backoff-cap", float, 60.0), ("max-tokens", int, 32768), ("temperature", float, 0.6), ("top-p", float, 0.95), ("top-k", int, 20), ("presence-penalty", float, 0.0), ("replies", str, None),
        ):
            t.add_argument(f"--{name}", type=kind, default=default)
        t.add_argument("--no-thinking", action="store_true")
        return t

    tool(compare, "input", "output").add_argument("--legacy", action="store_true")
    t = tool(fold, "input", "output")
    t.add_argument("--sample-budget", type=int, default=3)
    t.add_argument("--network-budget", type=int, default=5)
    t.add_argument("--gateway-budget", type=int, default=2)
    tool(merge, "run", "judge", "output")
    tool(combine, "output").add_argument("inputs", nargs="+")
    t = tool(convert, "input", "output")
    t.add_argument("--mode", "--gpt-mode", choices=training.MODES, default="thinking")
    t.add_argument("--format", choices=("json", "jsonl"))
    t.add_argument("--strip-fences", action="store_true")
    t.add_argument("--include-failed", nargs="?", const="upheld", choices=("upheld", "mismatch", "all"))
    t.add_argument("--mix")
    t.add_argument("--mix-ratio", type=float, default=1.0)
    for name, default in (("think-flag", training.THINK_FLAG), ("no-think-flag", training.NO_THINK_FLAG), ("think-tag", training.THINK_TAG), ("answer-tag", training.ANSWER_TAG)):
        t.add_argument(f"--{name}", default=default)
    t = calls(tool(generate, "input", "output"))
    t.add_argument("--sample-size", type=int, default=0)
    t.add_argument("--max-sample-attempts", type=int, default=3)
    t.add_argument("--gateway-max-attempts", type=int, default=2)
    t.add_argument("--metrics-interval", type=float, default=10.0)
    t.add_argument("--prompt-file")
    t.add_argument("--images", help="the folder that the samples' images stand in")
    t.add_argument("--legacy", action="store_true")
    calls(tool(judge, "input", "output")).add_argument("--limit", type=int)
    t = calls(tool(polish, "input", "output"))
    t.add_argument("--limit", type=int)
    t.add_argument("--mode", choices=(rewrite.POLISH, rewrite.REPAIR), default=rewrite.POLISH)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build()
    ensure_checkpoints(spark)
    args.run_tool(spark, args)


if __name__ == "__main__":
    main()

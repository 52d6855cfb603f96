"""Merging judged runs, combining sources, deduplication, resuming and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_id(c: Column) -> Column:
    """Null, empty and zero ids count as none."""
    text = c.cast("string")
    return F.coalesce((text != "") & (text != "0"), F.lit(False))


def is_success(status: Column) -> Column:
    """Everything else, null too, is failed."""
    return F.coalesce(status == "success", F.lit(False))


def route(status: Column) -> Column:
    return F.when(is_success(status), "success").otherwise("failed")


def last_by(df: DataFrame, keys: list[str], order: str = "_ord") -> DataFrame:
    """The last row of each key with its columns, at its first row's place `_first`."""
    rest = [c for c in df.columns if c not in keys]
    found = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"), F.min(order).alias("_first"), F.count("*").alias("_copies"))
    return found.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest), "_first", "_copies")


def compacted(records: DataFrame) -> DataFrame:
    """Each id's last record at its first place; records without id stay as they are."""
    keyed = last_by(records.filter(has_id(F.col("sample_id"))), ["sample_id"]).drop("_ord", "_copies").withColumnRenamed("_first", "_ord")
    return keyed.unionByName(records.filter(~has_id(F.col("sample_id"))))


def combined(records: DataFrame) -> DataFrame:
    """Records of many sources: within a source an id's last record, at its first place.

    Rows need _source and _ord. Ids in several sources all stay; rows without id come last,
    marked by `_keyed` = false.
    """
    named = has_id(F.col("sample_id"))
    keyed = last_by(records.filter(named), ["_source", "sample_id"]).drop("_ord", "_copies").withColumnRenamed("_first", "_ord")
    return keyed.withColumn("_keyed", F.lit(True)).unionByName(records.filter(~named).withColumn("_keyed", F.lit(False)))


def combine_summary(records: DataFrame) -> DataFrame:
    """One row: rows in, removed copies, rows without id, ids in several sources, rows by status."""
    named = has_id(F.col("sample_id"))
    keys = records.filter(named).groupBy("sample_id", "_source").agg(F.count("*").alias("n"))
    ids = keys.groupBy("sample_id").agg(F.sum(F.col("n") - 1).alias("deduped"), F.count("*").alias("sources"))
    counts = ids.agg(F.coalesce(F.sum("deduped"), F.lit(0)).alias("deduped"), F.count_if(F.col("sources") > 1).alias("cross_source_ids"))
    total = records.agg(F.count("*").alias("total_in"), F.count_if(~named).alias("no_sample_id"))
    final = combined(records).agg(F.count("*").alias("final_records"), F.count_if(is_success(F.col("status"))).alias("final_success"), F.count_if(~is_success(F.col("status"))).alias("final_failed"))
    return total.join(counts).join(final)


def merged(run: DataFrame, judged: DataFrame) -> DataFrame:
    """Run records with failed ones replaced by their judged record, and where each one went.

    `judged` rows are the judge's success rows, then its failed ones, ordered by _ord; an id's
    last one counts. Both sides need sample_id, status and `judge_failure` (null unless judging
    failed). Columns: those of the run, `merged_status` and `origin`: run_success,
    judged_overturned, judged_upheld, judged_error or untouched_failed.
    """
    last = last_by(judged.filter(has_id(F.col("sample_id"))), ["sample_id"]).drop("_first", "_copies")
    own = run.columns
    other = [c for c in own if c in last.columns and c != "sample_id"]
    side = last.select("sample_id", F.struct(*other, *(c for c in ("judge_failure",) if c not in other)).alias("_judged"))
    failed = run.filter(~is_success(F.col("status"))).join(side, "sample_id", "left")
    hit = F.col("_judged").isNotNull()
    overturned = hit & is_success(F.col("_judged.status"))
    origin = F.when(~hit, "untouched_failed").when(overturned, "judged_overturned").when(F.col("_judged.judge_failure").isNotNull(), "judged_error").otherwise("judged_upheld")
    taken = [F.when(hit, F.col(f"_judged.{c}")).otherwise(F.col(c)).alias(c) if c in other else F.col(c) for c in own]
    merged_failed = failed.select(*taken, F.when(overturned, "success").otherwise("failed").alias("merged_status"), origin.alias("origin"))
    good = run.filter(is_success(F.col("status"))).select(*own, F.lit("success").alias("merged_status"), F.lit("run_success").alias("origin"))
    return good.unionByName(merged_failed)


def merge_diagnostics(run: DataFrame, judged: DataFrame) -> DataFrame:
    """One row: collisions with run successes, orphans, and repeated ids on both sides.

    Null ids count as one value among the run's failed records.
    """
    ids = judged.filter(has_id(F.col("sample_id"))).groupBy("sample_id").agg(F.count("*").alias("n"))
    good = run.filter(is_success(F.col("status"))).select("sample_id").distinct()
    bad = run.filter(~is_success(F.col("status")))
    collision = ids.join(good, "sample_id", "left_semi").agg(F.count("*").alias("collision"))
    orphans = ids.join(run.select("sample_id").distinct(), "sample_id", "left_anti").agg(F.count("*").alias("orphaned"))
    repeated = bad.groupBy("sample_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_run_failed_ids"))
    overwritten = ids.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_judged_ids"))
    return collision.join(orphans).join(repeated).join(overwritten)


def merge_summary(run: DataFrame, judged: DataFrame) -> DataFrame:
    """One row of all reconciliation counts; final_success = run_success + judged_overturned."""
    rows = merged(run, judged)
    count = lambda *names: F.count_if(F.col("origin").isin(*names))
    counts = rows.agg(
        count("run_success").alias("run_success"),
        (F.count("*") - count("run_success")).alias("run_failed"),
        count("judged_overturned").alias("judged_overturned"),
        count("judged_upheld").alias("judged_upheld"),
        count("judged_error").alias("judged_error"),
        count("untouched_failed").alias("untouched_failed"),
        F.count_if(F.col("merged_status") == "success").alias("final_success"),
        F.count_if(F.col("merged_status") == "failed").alias("final_failed"),
    )
    return counts.join(merge_diagnostics(run, judged))


def pending(inputs: DataFrame, done: DataFrame, key: str = "sample_id") -> DataFrame:
    """Inputs whose id hasn't been processed; put it before any model call."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def shared_ids(records: DataFrame) -> DataFrame:
    """(sample_id, sources) of ids that stand in several sources."""
    return records.filter(has_id(F.col("sample_id"))).groupBy("sample_id").agg(F.count_distinct("_source").alias("sources")).filter("sources > 1")


def judged_only(records: DataFrame) -> DataFrame:
    return records.filter(F.col("judge_result").isNotNull())

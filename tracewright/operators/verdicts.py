"""Aggregates over verdicts: levels, fields, counters, quality windows, percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.compare import MISMATCH, MISSING_IN_GT, MISSING_IN_PRED, NORMALIZED, NORMALIZED_MATCH, STRICT
from .ordering import in_order

LEVELS = (STRICT, NORMALIZED_MATCH, MISMATCH)


def level_counts(samples: DataFrame, level: str = "match_level") -> DataFrame:
    """(match_level, n): three rows, zeros included."""
    spark = samples.sparkSession
    names = spark.createDataFrame([(x,) for x in LEVELS], "match_level string")
    got = samples.groupBy(F.col(level).alias("match_level")).agg(F.count("*").alias("n"))
    return names.join(got, "match_level", "left").select("match_level", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def field_distribution(fields: DataFrame) -> DataFrame:
    """(field, mismatch, total, rate) of fields with mismatches, from rows (field, level)."""
    stat = fields.groupBy("field").agg(F.count_if(F.col("level") == MISMATCH).alias("mismatch"), F.count("*").alias("total"))
    return stat.filter("mismatch > 0").withColumn("rate", F.col("mismatch") / F.col("total"))


def cross_check(fields: DataFrame) -> DataFrame:
    """One row: all fields, the share of normalised ones, and missing keys in both directions."""
    count = lambda level: F.count_if(F.col("level") == level)
    return fields.agg(
        F.count("*").alias("total_fields"),
        F.coalesce(F.try_divide(count(NORMALIZED), F.count("*")), F.lit(0.0)).alias("normalized_field_ratio"),
        count(MISSING_IN_PRED).alias("missing_in_pred"),
        count(MISSING_IN_GT).alias("missing_in_gt"),
    )


def run_counters(records: DataFrame, skipped: int = 0) -> DataFrame:
    """One row: processed, success, failed, skipped and the success rate of those processed."""
    good = F.count_if(F.col("status") == "success")
    return records.agg(
        (F.count("*") + F.lit(skipped)).alias("total"),
        good.alias("success"),
        (F.count("*") - good).alias("failed"),
        F.lit(skipped).cast("long").alias("skipped"),
        F.coalesce(F.try_divide(good, F.count("*")), F.lit(0.0)).alias("success_rate"),
    )


def quality_windows(scored: DataFrame, order: list[str], partition: list[str] | None = None, size: int = 10) -> DataFrame:
    """(partition..., window_no, n, mean_score): means of each `size` rows in completion order.

    Rows are numbered by ranges, so neither a hot partition nor a total order is one task's work.
    """
    keys = partition or []
    numbered = in_order(scored.filter("match_score is not null"), keys, order).withColumn("window_no", F.floor(F.col("_place") / size))
    return numbered.groupBy(*keys, "window_no").agg(F.count("*").alias("n"), F.bround(F.avg("match_score"), 4).alias("mean_score"))


def quality_summary(records: DataFrame) -> DataFrame:
    """One row: the mean score, four places, and how many records have one."""
    return records.agg(
        F.bround(F.avg("match_score"), 4).alias("mean_score"),
        F.count("match_score").alias("scored"),
        F.count_if(F.col("match_score").isNull()).alias("unscored"),
    )


def nearest_rank(df: DataFrame, keys: list[str], value: str, percents: list[float]) -> DataFrame:
    """(keys..., n, p<q>...): the value at place q / 100 * (n - 1), halves to even; 0.0 of none.

    Rows are counted by value first, so a hot group is its distinct values; the value at a
    place is the first whose running count goes beyond it.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_m"))
    over = Window.partitionBy(*keys)
    upto = over.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("_upto", F.sum("_m").over(upto)).withColumn("_n", F.sum("_m").over(over))
    place = lambda q: F.least(F.greatest(F.bround(F.lit(q / 100) * (F.col("_n") - 1)), F.lit(0)), F.col("_n") - 1)
    picks: list[Column] = [F.min(F.when(F.col("_upto") > place(q), F.col(value))).alias(f"p{q:g}") for q in percents]
    return placed.groupBy(*keys).agg(F.max("_n").alias("n"), *picks)


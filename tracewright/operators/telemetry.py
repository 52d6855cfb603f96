"""Telemetry over request events, and schedules: buckets, peaks, shares, pacing, backoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import in_order, running_max
from .verdicts import nearest_rank

PHASES = ("wait_limiter", "wait_slot", "rtt", "backoff")


def events_read(raw: DataFrame) -> DataFrame:
    """Events as they are logged, missing numbers as 0 and text as empty, with `started`."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    out = raw.select(F.col("ts").cast("double").alias("ts"), text("sample_id"), text("kind"), text("outcome"), text("quota_kind"), *map(zero, PHASES))
    return out.withColumn("started", F.col("ts") - F.col("rtt"))


def events_logged(events: DataFrame) -> DataFrame:
    """One JSON line an event: a request has outcome and times, a backoff its delay alone."""
    r = lambda c: F.bround(c, 4).alias(c)
    request = F.to_json(F.struct(r("ts"), "sample_id", "kind", "outcome", "quota_kind", r("wait_limiter"), r("wait_slot"), r("rtt")))
    backoff = F.to_json(F.struct(r("ts"), "sample_id", "kind", r("backoff")))
    return events.select(F.when(F.col("kind") == "request", request).otherwise(backoff).alias("value"))


def buckets(requests: DataFrame, keys: list[str], interval: float) -> DataFrame:
    """(keys..., bucket, bucket_start, started, finished, errors, peak_in_flight, effective_qpm).

    Requests have started, finished and outcome. Buckets begin at a key's earliest start, and
    empty ones are there too. The peak counts from 0 in each bucket, ends before starts at
    one moment. One expansion to start and end points, one shuffle.
    """
    span = requests.groupBy(*keys).agg(F.min("started").alias("_base"), F.max("finished").alias("_end"))
    ends = F.explode(F.array(F.struct(F.col("started").alias("t"), F.lit(1).alias("d"), F.lit(0).alias("e")), F.struct(F.col("finished").alias("t"), F.lit(-1).alias("d"), (F.col("outcome") != "OK").cast("int").alias("e"))))
    points = requests.select(*keys, ends.alias("p")).join(span, keys) if keys else requests.select(ends.alias("p")).join(F.broadcast(span))
    number = lambda t: F.floor((t - F.col("_base")) / F.lit(float(interval)))
    points = points.select(*keys, number(F.col("p.t")).alias("bucket"), "p.t", "p.d", "p.e")
    moments = points.groupBy(*keys, "bucket", "t", "d").agg(F.count("*").alias("n"), F.sum("e").alias("e"))
    running = Window.partitionBy(*keys, "bucket").orderBy("t", "d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level = moments.withColumn("level", F.sum(F.col("n") * F.col("d")).over(running))
    counted = level.groupBy(*keys, "bucket").agg(
        F.sum(F.when(F.col("d") == 1, F.col("n")).otherwise(0)).alias("started"),
        F.sum(F.when(F.col("d") == -1, F.col("n")).otherwise(0)).alias("finished"),
        F.sum("e").alias("errors"),
        F.greatest(F.max("level"), F.lit(0)).alias("peak_in_flight"),
    )
    every = span.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), number(F.col("_end")))).alias("bucket"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    qpm = F.bround(F.coalesce("started", F.lit(0)) * F.lit(60.0) / F.lit(float(interval)), 2)
    return every.join(counted, [*keys, "bucket"], "left").select(*keys, "bucket", F.bround(F.col("bucket") * F.lit(float(interval)), 2).alias("bucket_start"), zero("started"), zero("finished"), zero("errors"), zero("peak_in_flight"), qpm.alias("effective_qpm"))


def phase_shares(events: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., phase, total, share) of time; shares of no time are 0."""
    one = F.explode(F.array(*(F.struct(F.lit(p).alias("phase"), F.coalesce(F.col(p), F.lit(0.0)).alias("t")) for p in PHASES)))
    rows = events.select(*keys, one.alias("x")).groupBy(*keys, "x.phase").agg(F.sum("x.t").alias("total"))
    whole = F.sum("total").over(Window.partitionBy(*keys))
    return rows.select(*keys, "phase", F.bround("total", 2).alias("total"), F.coalesce(F.bround(F.try_divide(F.col("total"), whole), 4), F.lit(0.0)).alias("share"))


def qpm_summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., qpm_mean, qpm_min) over buckets in which something started."""
    return rows.filter("started > 0").groupBy(*keys).agg(F.bround(F.avg("effective_qpm"), 2).alias("qpm_mean"), F.bround(F.min("effective_qpm"), 2).alias("qpm_min"))


def _mapped(rows: DataFrame, key: str, *values: str) -> DataFrame:
    """One row with a map a value column; for the few rows of a summary."""
    entry = lambda v: F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, v)))).alias(v)
    return rows.agg(*map(entry, values))


def performance(events: DataFrame, interval: float = 10.0) -> DataFrame:
    """One row: requests, percentiles of their times, phase totals and shares, effective calls a
    minute over buckets that aren't empty, and the buckets. Events are as events_read gives them,
    with `started`."""
    requests = events.filter("kind = 'request'").withColumn("finished", F.col("started") + F.col("rtt"))
    count = requests.agg(F.count("*").alias("total_requests"))
    ranks = nearest_rank(requests.select("rtt"), [], "rtt", [50, 95, 99])
    ranks = ranks.select(*(F.bround(F.coalesce(f"p{q}", F.lit(0.0)), 2).alias(f"rtt_p{q}") for q in (50, 95, 99)))
    spent = events.select(*(F.when((F.col("kind") == "request") == (p != "backoff"), F.col(p)).otherwise(0.0).alias(p) for p in PHASES))
    phases = _mapped(phase_shares(spent, []), "phase", "total", "share").toDF("phase_totals", "phase_shares")
    every = buckets(requests, [], interval)
    qpm = qpm_summary(every, []).select(F.coalesce("qpm_mean", F.lit(0.0)).alias("effective_qpm_mean"), F.coalesce("qpm_min", F.lit(0.0)).alias("effective_qpm_min"))
    listed = every.agg(F.array_sort(F.collect_list(F.struct("bucket", "bucket_start", "started", "finished", "errors", "peak_in_flight", "effective_qpm"))).alias("buckets"))
    return count.join(ranks).join(phases).join(qpm).join(listed)


def call_metrics(attempts: DataFrame) -> DataFrame:
    """One row: calls, calls by quota kind, by outcome, and tokens over calls that told them."""
    tokens = F.struct(F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"), F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"), F.count(F.coalesce("prompt_tokens", "completion_tokens")).alias("responses_with_usage"))
    whole = attempts.agg(F.count("*").alias("total_http_requests"), tokens.alias("token_usage"))
    by = lambda c, name: _mapped(attempts.groupBy(c).agg(F.count("*").alias("n")), c, "n").withColumnRenamed("n", name)
    return whole.join(by("quota_kind", "quota")).join(by("outcome", "outcomes"))


def progress(events: DataFrame, now: float, interval: float, in_flight: int, total: int) -> DataFrame:
    """One row (in_flight, effective_qpm, completed, total, rtt_p50, line): calls that started in
    the last `interval` seconds, a minute, and the median time of all."""
    requests = events.filter("kind = 'request'")
    recent = F.count_if(F.col("started").between(now - interval, now)) * F.lit(60.0 / interval)
    counts = requests.agg(recent.alias("effective_qpm"), F.count_distinct("sample_id").alias("completed"))
    median = nearest_rank(requests.select("rtt"), [], "rtt", [50]).select(F.coalesce("p50", F.lit(0.0)).alias("rtt_p50"))
    row = counts.join(median).select(F.lit(in_flight).alias("in_flight"), "effective_qpm", "completed", F.lit(total).alias("total"), "rtt_p50")
    return row.withColumn("line", F.format_string("in flight %d, %.1f a minute, %d of %d, median %.1f s", "in_flight", "effective_qpm", "completed", "total", "rtt_p50"))


def paced(arrivals: DataFrame, keys: list[str], at: str, order: list[str], per_minute: float) -> DataFrame:
    """Adds `granted`: each arrival waits for 60 / per_minute seconds after the one before.

    The recurrence max(arrival, last + step) is a running maximum of arrival - i * step, plus
    i * step; each key is a limiter of its own, whose rows are worked on by ranges.
    """
    step = F.lit(60.0 / per_minute)
    placed = in_order(arrivals, keys, order).withColumn("_lead", F.col(at) - F.col("_place") * step)
    return running_max(placed, keys, "_lead", "_most").select(*arrivals.columns, (F.col("_most") + F.col("_place") * step).alias("granted"))


def grants_in_window(grants: DataFrame, keys: list[str], at: str, seconds: int = 60) -> DataFrame:
    """Adds `recent`: grants in the `seconds` up to each one, the far edge left out.

    `at` is in whole microseconds. A window lies in two slices of that length, so each grant is
    entered in its own and in the next one, and a group is two slices of a key.
    """
    span = seconds * 1_000_000
    own = F.floor(F.col(at) / span)
    dealt = grants.withColumn("_own", own).withColumn("_slice", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    by = Window.partitionBy(*keys, "_slice").orderBy(at).rangeBetween(-span + 1, Window.currentRow)
    return dealt.withColumn("recent", F.count("*").over(by)).filter("_slice = _own").drop("_own", "_slice")


def backoff_delay(n: Column, base: float, cap: float, jitter: float, u: Column, asked: Column | None = None) -> Column:
    """min(base * 2^n, cap), spread by `u` in 0..1, and what the server asked for if that is more."""
    nominal = F.least(F.lit(base) * F.pow(F.lit(2.0), n), F.lit(cap))
    delay = nominal * (F.lit(1.0) + F.lit(jitter) * (F.lit(2.0) * u - F.lit(1.0)))
    return delay if asked is None else F.greatest(delay, F.coalesce(asked, F.lit(0.0)))


def stable_uniform(*columns: str) -> Column:
    """A number in 0..1 from a row's values, the same each time."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def peak_per_sample(requests: DataFrame) -> DataFrame:
    """(sample_id, peak): the most requests that were in flight at once for each sample."""
    ends = F.explode(F.array(F.struct(F.col("started").alias("t"), F.lit(1).alias("d")), F.struct(F.col("finished").alias("t"), F.lit(-1).alias("d"))))
    points = requests.select("sample_id", ends.alias("p")).groupBy("sample_id", "p.t", "p.d").agg(F.sum("p.d").alias("n"))
    running = Window.partitionBy("sample_id").orderBy("t", "d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return points.withColumn("level", F.sum("n").over(running)).groupBy("sample_id").agg(F.greatest(F.max("level"), F.lit(0)).alias("peak"))

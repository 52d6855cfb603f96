"""Streams: records that arrive, event buckets, retry budgets as state."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.compare import is_accepted
from ..operators.assemble import last_by
from ..operators.lifecycle import GATEWAY, NETWORK, NETWORK_CLASS, OK, RATE, TERMINAL_CLASS, Budgets
from ..sources.tables import exists, export_text


def event_buckets(events: DataFrame, interval: str = "10 seconds", late: str = "1 minute") -> DataFrame:
    """Started requests and errors in tumbling windows with a watermark; `ts` is a timestamp."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    grouped = timed.groupBy(F.window("at", interval).alias("w"))
    return grouped.agg(F.count("*").alias("started"), F.count_if(F.col("outcome") != "OK").alias("errors")).select(F.col("w.start").alias("bucket_start"), "started", "errors")


def _manifest(spark, path: str, before: int | None = None) -> tuple[int, dict[str, str]]:  # noqa: ANN001
    """The newest whole version, below `before` if it is given, and its folder of each bucket."""
    if not exists(spark, f"{path}/versions"):
        return -1, {}
    rows = spark.read.schema("version long, folders map<string, string>").json(f"{path}/versions")
    rows = rows.filter("version is not null" if before is None else F.col("version") < before)
    found = rows.agg(F.max_by(F.struct("version", "folders"), "version")).first()[0]
    return (found["version"], found["folders"]) if found else (-1, {})


def upsert(batch: DataFrame, batch_id: int, path: str, keys: list[str], order: str, buckets: int = 64) -> None:
    """Merges a batch into a versioned table: an id's last row by `order` stays.

    The table stands in buckets by key; a batch reads and writes anew those that its keys fall
    in, and then a version that names the folder of every bucket. It builds on the newest
    version before it, so a repeated batch gives the same table and a missing number costs
    nothing. Folders that neither this version nor the one before names are deleted.
    """
    spark = batch.sparkSession
    number, folders = _manifest(spark, path, batch_id)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    rows = batch.withColumn("_bucket", bucket).persist()
    try:
        touched = sorted(str(r[0]) for r in rows.select("_bucket").distinct().collect())  # `buckets` numbers at the most
        held = [folders[b] for b in touched if b in folders]
        every = spark.read.parquet(*(f"{path}/{f}" for f in held)).withColumn("_bucket", bucket).unionByName(rows) if held else rows
        last = last_by(every, [*keys, "_bucket"], order).drop("_first", "_copies")
        last.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/data-{batch_id}")
    finally:
        rows.unpersist()
    new = folders | {b: f"data-{batch_id}/_bucket={b}" for b in touched}
    export_text(spark, f"{path}/versions/{batch_id:012d}.json", json.dumps({"version": batch_id, "folders": new}))
    _expire(spark, path, {*folders.values(), *new.values()}, {number, batch_id})


def _expire(spark, path: str, named: set[str], versions: set[int]) -> None:  # noqa: ANN001
    """Deletes the buckets and versions of earlier batches that are named no more."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for data in files.listStatus(at(path)):
        name = data.getPath().getName()
        if name.startswith("data-"):
            for one in files.listStatus(data.getPath()):
                bucket = one.getPath().getName()
                if bucket.startswith("_bucket=") and f"{name}/{bucket}" not in named:
                    files.delete(one.getPath(), True)
    for one in files.listStatus(at(f"{path}/versions")):
        stem = one.getPath().getName().removesuffix(".json")
        if stem.isdigit() and int(stem) < min(versions):
            files.delete(one.getPath(), False)


def upsert_stream(rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: str) -> StreamingQuery:
    """Runs through what is there and stops; resumed from its checkpoint, it goes on."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, number: upsert(batch, number, path, keys, order)).start()


def newest(spark, path: str) -> DataFrame:  # noqa: ANN001
    """The table of the newest version."""
    version, folders = _manifest(spark, path)
    if version < 0:
        raise FileNotFoundError(f"{path} holds no version")
    return spark.read.parquet(*(f"{path}/{f}" for f in sorted(folders.values())))


STATE = "held binary"
FOLDED = "sample_id string, attempts int, status string, last_outcome string"
#: What a call can be, by its place here: a reply that is accepted, can't be parsed or mismatches; the network class, gateway
#: errors first; the terminal class; anything else, which counts as a call and no more.
_STEPS = (OK, OK, OK, GATEWAY, NETWORK, RATE, *TERMINAL_CLASS, None)
_ACCEPTED, _UNPARSED, _MISMATCHED, _GATEWAY, _LAST_NETWORK, _LAST_TERMINAL, _OTHER = 0, 1, 2, 3, 5, len(_STEPS) - 2, len(_STEPS) - 1
_COUNTS = ("mm", "nw", "gw", "calls", "done")


def _step(outcome: Column, level: Column) -> Column:
    said = F.when(level.isNull(), _UNPARSED).when(is_accepted(level), _ACCEPTED).otherwise(_MISMATCHED)
    found = F.when(outcome == OK, said)
    for place, name in enumerate(_STEPS):
        if place >= _GATEWAY and name:
            found = found.when(outcome == name, place)
    return found.otherwise(_OTHER).cast("tinyint")


def _packed(ids: np.ndarray, counts: dict[str, np.ndarray]) -> bytes:
    batch = pa.record_batch([pa.array(ids, pa.string()), *(pa.array(counts[c]) for c in _COUNTS)], names=["id", *_COUNTS])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    table = pa.ipc.open_stream(pa.py_buffer(bytes(held))).read_all()
    return table["id"].to_numpy(), {c: table[c].to_numpy() for c in _COUNTS}


def budget_stream(attempts: DataFrame, budgets: Budgets = Budgets(), buckets: int = 1024) -> DataFrame:
    """Ended samples from a stream of attempts, with budgets as state.

    Rows come in attempt order within a sample; a sample gives one row when it ends. Samples are
    folded by buckets of their ids, whose counts are one state: all of a bucket's rows at a time by
    array operations, as a call of Python for every sample takes longer than anything else. A
    batch rewrites the buckets that its ids fall in. A checkpoint goes on with its own number of
    buckets only.
    """

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("attempt_no", kind="stable")
        before, old = _unpacked(state.get[0]) if state.exists else (np.array([], object), {})
        who, ids = pd.factorize(np.concatenate([before, rows["sample_id"].to_numpy(object)]), use_na_sentinel=False)
        held = {c: np.concatenate([old.get(c, np.array([], "int32")), np.zeros(len(ids) - len(before), "int32")]) for c in _COUNTS}
        who, step = who[len(before) :], rows["_step"].to_numpy()
        order = np.argsort(who, kind="stable")
        order = order[held["done"][who[order]] == 0]
        if not len(order):
            return
        who, step = who[order], step[order]
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        last = np.r_[first[1:], len(who)] - 1
        sample = who[first]

        def running(counted: np.ndarray, name: str) -> np.ndarray:
            upto = np.cumsum(counted)
            return upto + np.repeat(held[name][sample] - upto[first] + counted[first], last - first + 1)

        mismatched, gateway, network = step == _MISMATCHED, step == _GATEWAY, (step >= _GATEWAY) & (step <= _LAST_NETWORK)
        mm, nw, gw = running(mismatched, "mm"), running(network, "nw"), running(gateway, "gw")
        ends = (step <= _UNPARSED) | ((step > _LAST_NETWORK) & (step <= _LAST_TERMINAL)) | (network & (nw >= budgets.network))
        if budgets.sample is not None:
            ends |= mismatched & (mm >= budgets.sample)
        if budgets.gateway is not None:
            ends |= gateway & (gw > budgets.gateway)
        at = np.minimum.reduceat(np.where(ends, np.arange(len(who)), len(who)), first)
        done = at <= last
        at = np.minimum(at, last)
        held["mm"][sample], held["nw"][sample], held["gw"][sample], held["done"][sample] = mm[at], nw[at], gw[at], done
        held["calls"][sample] += (at - first + 1).astype("int32")
        ids = np.where(pd.isna(ids), None, ids)
        state.update((_packed(ids, held),))
        if done.any():
            ended, how = sample[done], step[at[done]]
            status = np.where(how == _ACCEPTED, "success", "failed")
            yield pd.DataFrame({"sample_id": ids[ended], "attempts": held["calls"][ended], "status": status, "last_outcome": np.array(_STEPS, object)[how]})

    bucket = F.pmod(F.xxhash64("sample_id"), F.lit(buckets)).cast("int")
    steps = attempts.select("sample_id", "attempt_no", _step(F.col("outcome"), F.col("match_level")).alias("_step"), bucket.alias("_bucket"))
    return steps.groupBy("_bucket").applyInPandasWithState(fold, FOLDED, STATE, "append", GroupStateTimeout.NoTimeout)


class Progress(StreamingQueryListener):
    """Keeps the latest figures of running queries: rows a second and rows so far."""

    def __init__(self) -> None:
        self.latest: dict[str, tuple[float, int]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        self.latest[str(event.id)] = (0.0, 0)

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        p = event.progress
        before = self.latest.get(str(p.id), (0.0, 0))[1]
        self.latest[str(p.id)] = (float(p.processedRowsPerSecond or 0.0), before + int(p.numInputRows or 0))

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        pass

    def line(self) -> str:
        return "; ".join(f"{i[:8]}: {rate:.1f} rows/s, {n} rows" for i, (rate, n) in self.latest.items())

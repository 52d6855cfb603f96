"""Helpers shared by the training-data operators.

Every operator first selects the columns it needs, so extra input columns, whatever their
names, never reach its plan.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text that a Python worker handles at once; a single longer row makes a slice of its own.
SLICE_BYTES = 2 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only if unset."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        import tempfile

        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='tracewright-')}"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder's name under the shared root, below one of this application's own, which goes
    when the application ends: results read from there are to be written elsewhere."""
    own = f"{shared_root(spark).rstrip('/')}/tracewright-{spark.sparkContext.applicationId}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        files.mkdirs(place)
        files.deleteOnExit(place)
    return f"{own}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """A copy in the shared folder: lineage ends there, and a lost executor costs nothing."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def steady(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions and order at each read, however executors come and go.

    Every read shares one RDD, whose file splits are set here once; a new plan would take them
    from the cores of its moment. Nothing is stored, but plans with a shuffle are, and those
    that say of themselves that they aren't deterministic.
    """
    execution = df._jdf.queryExecution()
    if "Exchange" in execution.executedPlan().toString() or not execution.optimizedPlan().deterministic():
        return cut(df)
    rows = execution.toRdd()
    rows.getNumPartitions()
    rows.setName(execution.executedPlan().toString())  # job infos still say which files are read
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)


def scan_partitions(df: DataFrame) -> int:
    """How many partitions the rows of a plan without a shuffle come in."""
    return df._jdf.queryExecution().toRdd().getNumPartitions()


_held: tuple[str, Callable[[], None]] | None = None


def give_back() -> None:
    """Returns memory that this worker has freed; workers stay for later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def holds(owner: str, forget: Callable[[], None]) -> None:
    """Says what this worker now remembers between tasks; what another operator left goes."""
    global _held
    if _held is not None and _held[0] != owner:
        _held[1]()
        give_back()
    _held = (owner, forget)


def slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about `limit` bytes at most."""
    for batch in batches:
        texts = batch.column(column)
        if batch.num_rows == 0:
            continue
        sizes = np.asarray(pc.binary_length(texts).fill_null(0)).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
            give_back()


def texts_of(batch: pa.RecordBatch, column: int) -> list[str]:
    """The column's texts, nulls as empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def spare_name(df: DataFrame, name: str) -> str:
    """The name, or a longer one, that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

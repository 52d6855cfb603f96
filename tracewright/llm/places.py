"""Row numbers that operators hand from one read of a table to the next, as side files.

A row's number is made by Spark below any Python step, so it depends on the scan partition alone
and not on the task that works on it: unions and coalesced partitions change nothing. A scan
partition has one file, which the next read of that partition opens.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KIND = pa.schema([("shard", pa.int64()), ("at", pa.int64())])


_SHARD_BITS = 32


def _stored(folder: str):
    def store(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (key, at), ordered by the part and shard in their keys, to one file a part, whole
        or not there at all."""
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        part, out, writer, n = None, None, None, 0

        def close() -> None:
            writer.close()
            out.close()
            name = f"{root}/{part}"
            if files.get_file_info(name).type == fs.FileType.File:  # of a task that was lost later
                files.delete_file(name)
            files.move(f"{name}.{attempt}", name)

        for batch in batches:
            keys, at = (np.asarray(c) for c in batch.columns)
            edges = np.flatnonzero(np.diff(keys, prepend=-1)).tolist()
            for low, high in zip(edges, [*edges[1:], len(keys)], strict=True):
                own, shard = divmod(int(keys[low]), 1 << _SHARD_BITS)
                if part != own:
                    if writer:
                        close()
                    part = own
                    out = files.open_output_stream(f"{root}/{part}.{attempt}")
                    writer = pa.ipc.new_stream(out, _KIND)
                writer.write_batch(pa.RecordBatch.from_arrays([pa.array(np.full(high - low, shard)), pa.array(at[low:high])], schema=_KIND))
            n += len(keys)
        if writer:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return store


def store_places(rows: DataFrame, folder: str, parts: int) -> int:
    """Writes rows (part, shard, at), all longs, of `parts` scan partitions, and tells how many.

    A task has the rows of one scan partition, as many as its rows or words at the most, which
    Spark orders by shard, spilling if need be; a shard's places come in any order.
    """
    key = F.shiftleft(F.col("part"), _SHARD_BITS).bitwiseOR(F.col("shard"))
    dealt = rows.select(key.alias("key"), "at").repartitionById(max(1, parts), F.shiftright("key", _SHARD_BITS).cast("int"))
    return dealt.sortWithinPartitions("key").mapInArrow(_stored(folder), "n long").agg(F.sum("n")).first()[0] or 0


class Places:
    """A scan partition's stored places, shard by shard."""

    def __init__(self, folder: str, part: int):
        files, root = fs.FileSystem.from_uri(folder)
        path = f"{root}/{part}"
        there = files.get_file_info(path).type == fs.FileType.File
        self.part = part
        self.batches = iter(pa.ipc.open_stream(files.open_input_stream(path))) if there else iter(())
        self.next = next(self.batches, None)

    def of(self, shard: int) -> np.ndarray:
        out = []
        while self.next is not None and self.next.column(0)[0].as_py() <= shard:
            if self.next.column(0)[0].as_py() < shard:
                self.lost()
            out.append(np.asarray(self.next.column(1)))
            self.next = next(self.batches, None)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def end(self) -> None:
        if self.next is not None:
            self.lost()

    def lost(self) -> None:
        raise RuntimeError(f"slice {self.next.column(0)[0].as_py()} of part {self.part} didn't come back: the documents changed between two reads")

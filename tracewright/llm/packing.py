"""Best-fit packing of token sequences with swap-based local search."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import holds, slices, texts_of
from .tokens import SLICE_BYTES, id_encoder

#: Documents that are packed together: large enough that a shard's one open bin doesn't count.
SHARD_ROWS = 25_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes: longest first, each to the fullest bin that still has room."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has r free places
    for i in order:
        need = lengths[i]
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(i)
        else:
            room, at = capacity, len(bins)
            bins.append([i])
        left = room - need
        if left:
            by_room.setdefault(left, []).append(at)
            rooms |= 1 << left
    return bins


class _Partners:
    """Open bins by what they can give back: for each number of tokens, in one document or in
    two of a bin, the bin with the most room that holds as many.

    A bin has few different lengths, as they add up to its fill, so its entries are bounded by
    the capacity however many documents it holds.
    """

    def __init__(self, bins: list[list[int]], fill: list[int], lengths: list[int], capacity: int):
        self.bins, self.fill, self.lengths, self.capacity = bins, fill, lengths, capacity
        self.version = [0] * len(bins)
        # [0]: nothing or one document comes back, [1]: two do
        self.heaps: list[dict[int, list[tuple[int, int, int]]]] = [{}, {}]
        self.room = np.full((2, capacity + 1), -1, np.int64)
        self.held: dict[int, tuple[set[int], set[int]]] = {}

    def enter(self, at: int) -> None:
        """Lists a bin as a partner, if it has room."""
        room = self.capacity - self.fill[at]
        if room <= 0:
            return
        count = Counter(self.lengths[i] for i in self.bins[at])
        own = sorted(count)
        pairs = {x + y for k, x in enumerate(own) for y in own[k + (count[x] < 2) :] if x + y < self.capacity}
        self.held[at] = ({0, *own}, pairs)
        for kind, sums in enumerate(self.held[at]):
            for x in sums:
                heapq.heappush(self.heaps[kind].setdefault(x, []), (-room, at, self.version[at]))
                self.room[kind, x] = max(self.room[kind, x], room)

    def leave(self, at: int) -> None:
        self.version[at] += 1
        for kind, sums in enumerate(self.held.pop(at, ())):
            for x in sums:
                heap = self.heaps[kind][x]
                while heap and heap[0][2] != self.version[heap[0][1]]:
                    heapq.heappop(heap)
                self.room[kind, x] = -heap[0][0] if heap else -1

    def best(self, a: int, least: int) -> tuple[int, list[int]] | None:
        """Where a document of `a` tokens goes for the fewest that come back, and which do. The
        bin then holds more than `least` tokens."""
        for back, kind in np.argwhere(self.room[:, :a].T >= a - np.arange(a)[:, None]).tolist():
            at = self.heaps[kind][back][0][1]
            if self.fill[at] + a - back <= least:
                continue
            if back == 0:
                return at, []
            by_length = {}
            for i in self.bins[at]:
                by_length.setdefault(self.lengths[i], []).append(i)
            if kind == 0:
                return at, [by_length[back][0]]
            for x, mine in by_length.items():
                other = by_length.get(back - x, [])
                if 2 * x != back and other:
                    return at, [mine[0], other[0]]
                if 2 * x == back and len(mine) > 1:
                    return at, mine[:2]
        return None


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Moves documents, or exchanges one for one or two for one, from emptier bins into fuller
    ones while that increases the squared fills; emptied bins go.

    Every open bin is tried as giver, the emptiest first, and every other one can be its partner.
    Rounds end when one finds no exchange, or when no packing can have fewer bins.
    """
    bins = [list(b) for b in bins]
    fill = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    n = len(bins)
    partners = _Partners(bins, fill, lengths, capacity)
    if n > least:
        for at in range(n):
            partners.enter(at)
    better = True
    while n > least and better:
        better = False
        for give in sorted((at for at in range(len(bins)) if 0 < fill[at] < capacity), key=lambda at: fill[at]):
            if n == least or not 0 < fill[give] < capacity:
                continue
            partners.leave(give)
            moved = True
            while bins[give] and moved:
                moved = False
                for a in sorted({lengths[i] for i in bins[give]}, reverse=True):
                    found = partners.best(a, fill[give])
                    if found:
                        at, back = found
                        i = next(i for i in bins[give] if lengths[i] == a)
                        partners.leave(at)
                        bins[give].remove(i)
                        bins[at] = [j for j in bins[at] if j not in back] + [i]
                        bins[give] += back
                        gain = a - sum(lengths[j] for j in back)
                        fill[at] += gain
                        fill[give] -= gain
                        partners.enter(at)
                        moved = better = True
                        break
            if bins[give]:
                partners.enter(give)
            else:
                n -= 1
    return [b for b in bins if b]


def token_pieces(docs: DataFrame, path: str, *, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The documents' token sequences, each closed by `end_id`, cut into pieces of `capacity`."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("ids", id_encoder.cache_clear)
        encoder, end = id_encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, 1, SLICE_BYTES):
            rows: list[tuple] = []
            flat, stops = encoder.ids(texts_of(batch, 1))
            data, begin = flat.tobytes(), 0
            for doc, stop in zip(batch.column(0).to_pylist(), (4 * stops).tolist(), strict=True):
                ids, begin = data[begin:stop] + end, stop
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        encoder.rest()

    return docs.mapInArrow(encode, _PIECES)


def _packer(capacity: int, most: int):
    def packed(shard: int, first: int, rows: pa.Table) -> tuple[pa.Table, int]:
        lengths = rows.column("length").to_pylist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for number, members in enumerate(bins, first):
            at = 0
            for i in members:
                sequence[i], offset[i] = (shard << 32) + number, at
                at += lengths[i]
        return rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)), len(bins)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order with their shard in front; one shard's are together, in one task or not."""
        shard, first, held, n = -1, 0, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal first, held, n
            if held:
                out, used = packed(shard, first, pa.Table.from_batches(held))
                first, held, n = first + used, [], 0
                yield from out.to_batches(max_chunksize=10_000)

        for given in batches:
            shards = np.asarray(given.column(0))
            edges = np.flatnonzero(np.diff(shards, prepend=-1)).tolist()
            rows = given.drop_columns(["shard"])
            for low, high in zip(edges, [*edges[1:], len(shards)], strict=True):
                if shards[low] != shard:
                    yield from close()
                    shard, first = int(shards[low]), 0
                while low < high:
                    take = min(high - low, most - n)
                    held.append(rows.slice(low, take))
                    low, n = low + take, n + take
                    if n == most:
                        yield from close()
        yield from close()

    return pack


def pack_documents(docs: DataFrame, path: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every document's pieces with the sequence and the offset they are packed at.

    A document's tokens, closed by `end_id`, stay together unless they are more than `capacity`;
    then they are cut into pieces of that many. Pieces are dealt round-robin to shards, one for
    `shard_rows` documents, whatever their ids, texts or sources. Each shard is packed on its own;
    one that long documents give more than twice as many pieces, in parts of that many.
    Null and empty texts give one piece with the end id alone. Null or repeated ids pass
    through, each row packed by itself. An empty table gives no rows; other columns are
    ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = max(1, -(-docs.count() // shard_rows))
    pieces = token_pieces(docs, path, capacity=capacity, end_id=end_id).repartition(shards)
    # numbered below the Python step, so a task that works on several shards tells them apart;
    # in one order whatever order the rows came in, so a repeated task packs the same
    names = [c.split(" ")[0] for c in _PIECES.split(", ")]
    dealt = pieces.select(F.spark_partition_id().alias("shard"), *names).sortWithinPartitions("ids_crc32", *names[:4])
    return dealt.mapInArrow(_packer(capacity, 2 * shard_rows), _PACKED)

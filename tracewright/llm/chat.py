"""Chat formatting as packed prefix trees.

Conversations that begin with the same turns share them: every shard of the output is one
sequence of units, the depth-first walk of a prefix tree, in which a shared turn stands
once. Each turn carries the position its first unit has in its conversation and the intervals
of the sequence that it may attend to besides itself: those of its ancestors.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_folder

OPEN, CLOSE = "<s>", "</s>"
#: Control strings of this template and of common ones; a backslash more tells a text's own apart.
_ESCAPE = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
_SEGMENT = re.compile(r"<s>([^\n]*)\n(.*)</s>", re.DOTALL)
#: Conversations of an output sequence, at the most about.
SHARD_CONVERSATIONS = 4_000
_KEY = 16
NODE, END = 0, 1
TREE = (
    "shard int, ord long, kind int, conv_id long, depth int, offset long, length long, position long, "
    "mask_start int, mask_end int, intervals array<struct<start: long, stop: long>>, segment string, ids array<int>, learnt_from int, learnt_to int"
)
_TREE = pa.schema(
    [
        ("shard", pa.int32()), ("ord", pa.int64()), ("kind", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int32()), ("offset", pa.int64()), ("length", pa.int64()), ("position", pa.int64()),
        ("mask_start", pa.int32()), ("mask_end", pa.int32()), ("intervals", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("segment", pa.string()),
        ("ids", pa.list_(pa.int32())), ("learnt_from", pa.int32()), ("learnt_to", pa.int32()),
    ]
)
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(text: str) -> str:
    """The text without any control string; unescape gives it back."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn's segment, and where its text stands in it."""
    head = f"{OPEN}{escape(role.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n"
    body = escape(text)
    return f"{head}{body}{CLOSE}", len(head), len(head) + len(body)


def parse_turn(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    found = _SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError("not a turn")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(found[1]))
    return role, unescape(found[2])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batched(rows: Iterable[tuple], schema: pa.Schema, text: int | None = None) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + (len(row[text] or "") if text is not None else 0)
        if size > 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to (conv_id, i, role, text, key): i counts a conversation's turns, and the
    key digests them so far. One row is held at a time, however long a conversation is."""

    def walk() -> Iterator[tuple]:
        last: object = object()
        i, chain = 0, b""
        for conv, role, text in _rows(batches):
            if conv != last:
                last, i, chain = conv, 0, b""
            role, text = role or "", text or ""
            state = xxhash.xxh3_128(chain)
            data = role.encode("utf-8", "surrogatepass")
            state.update(b"%d:" % len(data) + data + text.encode("utf-8", "surrogatepass"))
            chain = state.digest()
            yield conv, i, role, text, chain
            i += 1

    yield from _batched(walk(), pa.schema([("conv_id", pa.int64()), ("i", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("chain", pa.binary())]), 3)


def _keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, i, chain) in order to (conv_id, key): the digests of all its beginnings."""

    def walk() -> Iterator[tuple]:
        last: object = None
        key: bytearray | None = None
        for conv, i, chain in _rows(batches):
            if i == 0:
                if key is not None:
                    yield last, bytes(key)
                last, key = conv, bytearray()
            key += chain
        if key is not None:
            yield last, bytes(key)

    yield from _batched(walk(), pa.schema([("conv_id", pa.int64()), ("key", pa.binary())]), 1)


def _placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (conv_id, key) to (conv_id, shard, pos, shared, n): turns shared with the one before."""
    shard = TaskContext.get().partitionId()

    def walk() -> Iterator[tuple]:
        before = b""
        for pos, (conv, key) in enumerate(_rows(batches)):
            low, high = 0, min(len(before), len(key)) // _KEY
            while low < high:  # equal up to some turn and never after it
                mid = (low + high + 1) // 2
                at = (mid - 1) * _KEY
                low, high = (mid, high) if before[at : at + _KEY] == key[at : at + _KEY] else (low, mid - 1)
            yield conv, shard, pos, low, len(key) // _KEY
            before = key

    yield from _batched(walk(), pa.schema([("conv_id", pa.int64()), ("shard", pa.int32()), ("pos", pa.int64()), ("shared", pa.int32()), ("n", pa.int32())]))


@lru_cache(maxsize=2)
def _tokenizer(path: str):  # noqa: ANN202
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _units(segment: str, learnt: tuple[int, int] | None, path: str | None) -> tuple[int, list[int] | None, int | None, int | None]:
    """A segment's number of units, its token ids, and which units are learnt: those that lie in
    the learnt text, whole."""
    if path is None:
        return len(segment), None, *(learnt or (None, None))
    coded = _tokenizer(path).encode(segment, add_special_tokens=False)
    if learnt is None:
        return len(coded.ids), coded.ids, None, None
    inside = [i for i, (a, b) in enumerate(coded.offsets) if learnt[0] <= a and b <= learnt[1]]
    return len(coded.ids), coded.ids, *((inside[0], inside[-1] + 1) if inside else (0, 0))


def _built(path: str | None):  # noqa: ANN202
    """Rows (shard, pos, i, conv_id, role, text), ends with null role, to the tree's rows."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        last: object = None
        for shard, _, i, conv, role, text in _rows(batches):
            if shard != last:
                last, at, order = shard, 0, 0
                above: list[tuple[int, int, list]] = []  # end of position ids, end in the sequence, intervals with itself
            del above[i:]
            position, intervals = (above[-1][0], above[-1][2]) if above else (0, [])
            if role is None:
                yield shard, order, END, conv, i, at, 0, position, None, None, intervals, None, None, None, None
            else:
                segment, start, stop = format_turn(role, text)
                learnt = (start, stop) if role == "assistant" else None
                size, ids, first, end = _units(segment, learnt, path)
                yield shard, order, NODE, None, i, at, size, position, *(learnt or (None, None)), intervals, segment, ids, first, end
                own = {"start": at, "stop": at + size}
                if intervals and intervals[-1]["stop"] == at:
                    with_own = [*intervals[:-1], {"start": intervals[-1]["start"], "stop": own["stop"]}]
                else:
                    with_own = [*intervals, own]
                above.append((position + size, own["stop"], with_own))
                at = own["stop"]
            order += 1

    return lambda batches: _batched(walk(batches), _TREE, 11)


def _read_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tree's rows in order to one row a conversation; a stack holds the current path."""

    def walk() -> Iterator[tuple]:
        last: object = None
        for shard, _, kind, conv, depth, start, stop, segment in _rows(batches):
            if shard != last:
                last = shard
                path = [(hashlib.sha256(), hashlib.sha256(), 0, 0)]
            del path[depth + 1 :]
            turns, loss, chars, formatted = path[-1]
            if kind == END:
                yield conv, depth, turns.hexdigest(), chars, loss.hexdigest(), formatted
                continue
            role, text = parse_turn(segment)
            turns, loss = turns.copy(), loss.copy()
            turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if start is not None:
                learnt = unescape(segment[start:stop])
                loss.update(learnt.encode("utf-8", "surrogatepass"))
                chars += len(learnt)
            path.append((turns, loss, chars, formatted + len(segment)))

    yield from _batched(walk(), _READ)


def prefix_trees(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """The packed trees of all conversations, columns as in TREE.

    A node row is a turn: its segment, where it stands in its shard's sequence, the position id
    of its first unit, the intervals it attends to and, for assistants, the span of the segment
    that is learnt, in code points and in units. With the `path` of a tokenizer, units are its
    tokens, whose ids stand in the row; a conversation's ids are those of its turns, one behind the
    other. An end row names a conversation that ends at the last node above it with
    one turn less depth than its own. Conversations sharing all turns share all nodes.

    Turns go by turn number; ties by role, then text, repeated rows as turns of their own. Null
    roles and texts are empty; null turn numbers come first; null ids make one conversation. An
    empty table gives no rows; other columns are ignored. Long conversations and large families
    are streamed: no task holds more than one path's keys and one batch.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    numbered = cut(ordered.mapInArrow(_numbered, "conv_id long, i int, role string, text string, chain binary"))
    chains = numbered.select("conv_id", "i", "chain").repartition("conv_id").sortWithinPartitions("conv_id", "i")
    keys = cut(chains.mapInArrow(_keys, "conv_id long, key binary"))
    shards = max(1, -(-keys.count() // SHARD_CONVERSATIONS))
    placed = keys.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    placed = cut(placed.mapInArrow(_placed, "conv_id long, shard int, pos long, shared int, n int"))
    own = placed.withColumnRenamed("conv_id", "c")
    nodes = numbered.drop("chain").join(own, F.col("conv_id").eqNullSafe(F.col("c"))).filter("i >= shared").select("shard", "pos", "i", "conv_id", "role", "text")
    ends = placed.select("shard", "pos", F.col("n").alias("i"), "conv_id", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return nodes.unionByName(ends).repartition("shard").sortWithinPartitions("shard", "pos", "i").mapInArrow(_built(path), TREE)


def read_trees(trees: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars from trees."""
    ordered = trees.select("shard", "ord", "kind", "conv_id", "depth", "mask_start", "mask_end", "segment").repartition("shard").sortWithinPartitions("shard", "ord")
    return ordered.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_formatting(conversations: DataFrame) -> DataFrame:
    """Writes the conversations' trees to the shared folder and reads the digests back from it."""
    spark = conversations.sparkSession
    folder = shared_folder(spark, "chat")
    prefix_trees(conversations).write.parquet(folder)
    return read_trees(spark.read.parquet(folder))

"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

The model merges byte pairs, whose result isn't the best path by piece scores. It is, however,
the one path through the lattice of pieces in which every two neighbours are compatible: merging
their joined text gives the two of them. With a weight of 0 for compatible neighbours and
minus infinity for others, encoding is a max-plus shortest path. A chunk's transfer matrix tells
which piece over its left edge leads to which piece over its right edge; the matrices compose
associatively, up a tree, and with both edges known each chunk is traced back by itself. As all weights
are 0 or minus infinity, a row of a matrix is a bit mask.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, holds, slices, steady, texts_of

#: Characters from which a document is giant, and those of a chunk.
GIANT, CHUNK = 65_536, 16_384
#: Chunks that one task works on, about, and matrices that are composed in one place.
TASK_CHUNKS, FAN = 8, 64
SPACE = "▁"
State = tuple[int, str]  # where a piece begins, before the edge, and its text


class Model:
    """A byte-pair SentencePiece model, with the lattice's rules."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.table: list[bytes] = []
        self.score: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.bytes = [0] * 256
        for i in range(n):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.table.append(bytes([int(piece[3:5], 16)]))
            elif self.library.is_control(i):
                self.table.append(b"")
            elif self.library.is_unknown(i):
                self.table.append(b" \xe2\x81\x87 ")
            else:
                self.table.append(piece.replace(SPACE, " ").encode())
                if not self.library.is_unused(i):
                    self.score[piece], self.number[piece] = self.library.get_score(i), i
        self.longest = max(map(len, self.score))
        self.stable: dict[str, bool] = {}
        self.fits: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The text's pieces by merging: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def is_stable(self, piece: str) -> bool:
        known = self.stable.get(piece)
        if known is None:
            known = self.stable[piece] = piece in self.score and self.merged(piece) == [piece]
        return known

    def compatible(self, a: str, b: str) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            known = self.fits[a, b] = self.merged(a + b) == [a, b]
        return known

    def pieces_from(self, text: str, at: int) -> list[str]:
        """Stable pieces that begin here; a character that is no piece stands for its bytes."""
        out = [text[at]]
        out += [p for p in (text[at : at + n] for n in range(2, min(self.longest, len(text) - at) + 1)) if p in self.score and self.is_stable(p)]
        return out

    def entries(self, text: str, edge: int) -> list[State]:
        """Pieces that hold the character before the edge."""
        return [(s - edge, p) for s in range(max(0, edge - self.longest), edge) for p in self.pieces_from(text, s) if s + len(p) >= edge]

    def walk(self, text: str, left: int, right: int, last: bool, begin: list[tuple[State, int]], trace: bool) -> tuple[dict[State, int], dict]:
        """Masks of the pieces over the right edge, from masks of those over the left one.

        With `trace` it keeps where each piece was reached from.
        """
        nodes: dict[int, dict[str, int]] = {}
        back: dict[tuple[int, str], tuple[int, str]] = {}
        out: dict[State, int] = {}
        for (start, piece), mask in begin:
            nodes.setdefault(left + start + len(piece) if piece else left, {})[piece] = mask
        for at in range(left, right):
            before = nodes.pop(at, None)
            if not before:
                continue
            for piece in self.pieces_from(text, at):
                mask = 0
                for a, m in before.items():
                    if not a or self.compatible(a, piece):
                        mask |= m
                        if trace:
                            back[at + len(piece), piece] = (at, a)
                if mask:
                    end = at + len(piece)
                    if end < right:
                        nodes.setdefault(end, {})[piece] = mask
                    elif end == right or not last:
                        out[at - right, piece] = mask
        return out, back

    def transfer(self, text: str, left: int, right: int, first: bool, last: bool) -> tuple[list[State], list[State], list[int]]:
        """The chunk's matrix: states on both edges, and for each right state a mask of left ones."""
        start = [(0, "")] if first else self.entries(text, left)
        out, _ = self.walk(text, left, right, last, [(s, 1 << i) for i, s in enumerate(start)], False)
        return start, list(out), list(out.values())

    def traced(self, text: str, left: int, right: int, last: bool, start: State, end: State) -> list[str]:
        """The pieces behind the start state up to and with the end state."""
        _, back = self.walk(text, left, right, last, [(start, 1)], True)
        out, at, piece = [], right + end[0] + len(end[1]), end[1]
        stop = (left + start[0] + len(start[1]) if start[1] else left, start[1])
        while (at, piece) != stop:
            out.append(piece)
            at, piece = back[at, piece]
        return out[::-1]

    def ids_of(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.number.get(p)
            if i is None:
                out += [self.bytes[b] for b in p.encode("utf-8", "surrogatepass")]
            else:
                out.append(i)
        return out

    def decoded(self, ids: Iterable[int]) -> bytes:
        """The bytes of ids, with the space that encoding puts before a text."""
        return b"".join(map(self.table.__getitem__, ids))


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def compose(a: tuple[list[State], list[State], list[int]], b: tuple[list[State], list[State], list[int]]) -> tuple[list[State], list[State], list[int]]:
    """The matrix of two neighbouring chunks; associative."""
    reach = dict(zip(a[1], a[2], strict=True))
    masks = [reach.get(s, 0) for s in b[0]]
    ends, rows = [], []
    for end, mask in zip(b[1], b[2], strict=True):
        through = 0
        for i, m in enumerate(masks):
            if mask >> i & 1:
                through |= m
        if through:
            ends.append(end)
            rows.append(through)
    return a[0], ends, rows


Matrix = tuple[list[State], list[State], list[int]]


def composed(matrices: list[Matrix]) -> Matrix:
    """The matrix of a row of chunks, by halves."""
    while len(matrices) > 1:
        matrices = [compose(*pair) if len(pair) > 1 else pair[0] for pair in (matrices[i : i + 2] for i in range(0, len(matrices), 2))]
    return matrices[0]


def solve(matrices: list[Matrix], begin: State = (0, ""), end: State | None = None) -> list[tuple[State, State]] | None:
    """The states that the one path has on each chunk's edges: masks forth, then back.

    `begin` is the state on the first edge, `end` that on the last one, of which there is one
    alone if none is given. None if there isn't exactly one path.
    """
    alive, forth = {begin}, []
    for left, right, masks in matrices:
        reach = sum(1 << i for i, s in enumerate(left) if s in alive)
        forth.append(alive)
        alive = {s for s, m in zip(right, masks, strict=True) if m & reach}
    if end is None:
        if len(alive) != 1:
            return None
        end = next(iter(alive))
    out = []
    for (left, right, masks), before in zip(reversed(matrices), reversed(forth), strict=True):
        mask = dict(zip(right, masks, strict=True)).get(end, 0)
        start = [s for i, s in enumerate(left) if mask >> i & 1 and s in before]
        if len(start) != 1:
            return None
        out.append((start[0], end))
        end = start[0]
    return out[::-1]


def spans_of(n: int, chunk: int, longest: int) -> list[tuple[int, int]]:
    """Where the chunks of n characters begin and end; a rest shorter than a piece may be goes to the last."""
    edges = [*range(0, n, chunk), n]
    if len(edges) > 2 and edges[-1] - edges[-2] < longest:
        del edges[-2]
    return list(zip(edges, edges[1:], strict=False))


def encode_by_chunks(m: Model, text: str, chunk: int = CHUNK) -> list[int]:
    """The ids of one text by the scan; as Spark does it, but in one place. A text without
    exactly one path, which no text is known to be, goes to the library."""
    if not text:
        return []
    marked = SPACE + text.replace(" ", SPACE)
    n = len(marked)
    spans = spans_of(n, max(chunk, m.longest), m.longest)
    states = solve([m.transfer(marked, a, b, a == 0, b == n) for a, b in spans])
    if states is None:
        return m.library.encode(text)
    return m.ids_of([p for (a, b), (s, e) in zip(spans, states, strict=True) for p in m.traced(marked, a, b, b == n, s, e)])


def _pack(states: list[State]) -> list[dict]:
    return [{"s": s, "p": p} for s, p in states]


_STATES = pa.list_(pa.struct([("s", pa.int32()), ("p", pa.string())]))
_ONE = pa.struct([("s", pa.int32()), ("p", pa.string())])
_CODED = "doc_id long, row long, chunk int, ids array<int>"


def _whole(path: str):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = model(path).library
        for batch in slices(batches, 2):
            ids = library.encode(texts_of(batch, 2), num_threads=1)
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate([np.zeros(0, np.int32), *(np.array(x, np.int32) for x in ids)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.zeros(len(ids), np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))], names=["doc_id", "row", "chunk", "ids"])

    return encode


def _chunked(chunk: int, longest: int):
    def cut_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Giant documents (doc_id, row, text) to their chunks, each with what stands around it;
        a document is cut once, from front to back."""
        for batch in slices(batches, 2):
            for doc, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marked = SPACE + text.replace(" ", SPACE)
                n = len(marked)
                spans = spans_of(n, chunk, longest)
                for first in range(0, len(spans), FAN):
                    part = spans[first : first + FAN]
                    lows = [max(0, a - longest) for a, _ in part]
                    size = len(part)
                    columns = [
                        pa.array([doc] * size, pa.int64()), pa.array([row] * size, pa.int64()), pa.array(np.arange(first, first + size, dtype=np.int32)), pa.array([len(spans)] * size, pa.int32()),
                        pa.array([marked[low : min(n, b + longest)] for low, (_, b) in zip(lows, part, strict=True)], pa.string()), pa.array([a - low for low, (a, _) in zip(lows, part, strict=True)], pa.int32()), pa.array([b - a for a, b in part], pa.int32()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "chunk", "chunks", "text", "low", "size"])

    return cut_up


_CHUNKS = "doc_id long, row long, chunk int, chunks int, text string, low int, size int"
_STATE = "struct<s: int, p: string>"
_MATRIX = f"row long, chunk int, left array<{_STATE}>, right array<{_STATE}>, masks array<binary>"


def _matrix_rows(rows: list[tuple[int, int, Matrix]]) -> list[pa.Array]:
    packed = lambda masks, n: [x.to_bytes(-(-n // 8), "little") for x in masks]
    return [
        pa.array([r for r, _, _ in rows], pa.int64()), pa.array([c for _, c, _ in rows], pa.int32()), pa.array([_pack(m[0]) for _, _, m in rows], _STATES), pa.array([_pack(m[1]) for _, _, m in rows], _STATES),
        pa.array([packed(m[2], len(m[0])) for _, _, m in rows], pa.list_(pa.binary())),
    ]


_MATRIX_NAMES = ["row", "chunk", "left", "right", "masks"]


def _matrices(path: str):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("pieces", model.cache_clear)
        m = model(path)
        for batch in slices(batches, 3):
            for row, chunk, chunks, text, low, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = m.transfer(text, low, low + size, chunk == 0, chunk == chunks - 1)
                yield pa.RecordBatch.from_arrays(_matrix_rows([(row, chunk, found)]), names=_MATRIX_NAMES)

    return find


def _matrices_of(group: pa.Table) -> list[Matrix]:
    states = lambda c: [[(x["s"], x["p"]) for x in row] for row in group.column(c).to_pylist()]
    masks = [[int.from_bytes(x, "little") for x in row] for row in group.column("masks").to_pylist()]
    return list(zip(states("left"), states("right"), masks, strict=True))


def _joined(fan: int):
    def join(group: pa.Table) -> pa.Table:
        """The matrices of `fan` neighbouring chunks to one, numbered by their place."""
        group = group.sort_by("chunk")
        row, first = group.column("row")[0].as_py(), group.column("chunk")[0].as_py()
        return pa.table(_matrix_rows([(row, first // fan, composed(_matrices_of(group)))]), names=_MATRIX_NAMES)

    return join


_EDGES = f"row long, chunk int, begin {_STATE}, end {_STATE}"


def _edges(group: pa.Table, found: list[tuple[State, State]] | None) -> pa.Table:
    found = found or []
    kept = group.slice(0, len(found))
    return pa.table({"row": kept.column("row"), "chunk": kept.column("chunk"), "begin": pa.array(_pack([s for s, _ in found]), _ONE), "end": pa.array(_pack([e for _, e in found]), _ONE)})


def _solved(group: pa.Table) -> pa.Table:
    """A document's matrices, a fan of them at the most, to the states on their edges; none if unsolved."""
    group = group.sort_by("chunk")
    return _edges(group, solve(_matrices_of(group)))


def _solved_between(group: pa.Table) -> pa.Table:
    """As above, of neighbouring chunks whose outer states are known, as columns b and e."""
    group = group.sort_by("chunk")
    state = lambda c: (lambda x: (x["s"], x["p"]))(group.column(c)[0].as_py())
    return _edges(group, solve(_matrices_of(group), state("b"), state("e")))


def _states(matrices: DataFrame, most: int, fan: int) -> DataFrame:
    """The states on all chunks' edges. Matrices are composed `fan` by `fan` up a tree, whose root
    is solved, and the states of each node's edges go down to those below it."""
    if most <= fan:
        return matrices.groupBy("row").applyInArrow(_solved, _EDGES)
    block = F.floor(F.col("chunk") / fan).cast("int")
    matrices = cut(matrices)
    above = matrices.withColumn("block", block).groupBy("row", "block").applyInArrow(_joined(fan), _MATRIX)
    known = _states(above, -(-most // fan), fan).select("row", F.col("chunk").alias("block"), F.col("begin").alias("b"), F.col("end").alias("e"))
    return matrices.withColumn("block", block).join(known, ["row", "block"]).groupBy("row", "block").applyInArrow(_solved_between, _EDGES)


def _traces(path: str):
    def trace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in slices(batches, 4):
            for doc, row, chunk, chunks, text, low, size, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pieces = m.traced(text, low, low + size, chunk == chunks - 1, (begin["s"], begin["p"]), (end["s"], end["p"]))
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([row]), pa.array([chunk], pa.int32()), pa.array([m.ids_of(pieces)], pa.list_(pa.int32()))], names=["doc_id", "row", "chunk", "ids"])

    return trace


def _encoded(docs: DataFrame, path: str, giant: int, chunk: int, fan: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows of documents in one piece, and rows of chunks of giant ones."""
    longest = model(path).longest
    chunk = max(chunk, 2 * longest)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = steady(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    small = docs.filter(F.char_length("text") <= giant).mapInArrow(_whole(path), _CODED)
    big = docs.filter(F.char_length("text") > giant)
    parts = cut(big.mapInArrow(_chunked(chunk, longest), _CHUNKS))
    count, most = parts.agg(F.count("*"), F.max("chunks")).first()
    if not count:
        return small, parts.select("doc_id", "row", "chunk", F.array().cast("array<int>").alias("ids"))
    # so many tasks as there are chunks for, which adaptive execution leaves alone
    tasks = -(-count // TASK_CHUNKS)
    dealt = parts.repartition(tasks, "row", "chunk")
    matrices = dealt.select("row", "chunk", "chunks", "text", "low", "size").mapInArrow(_matrices(path), _MATRIX)
    states = cut(_states(matrices, most, fan))
    known = parts.join(states, ["row", "chunk"]).select("doc_id", "row", "chunk", "chunks", "text", "low", "size", "begin", "end")
    traced = known.repartition(tasks, "row", "chunk").mapInArrow(_traces(path), _CODED)
    # a document in which the scan found no path, or several: the library encodes it as a whole
    solved = states.groupBy("row").agg(F.count("*").alias("n"))
    rest = parts.select("row", "chunks").distinct().join(solved, "row", "left").filter("n is null or n < chunks").select("row")
    if rest.isEmpty():
        return small, traced
    rest = cut(rest)
    return small, traced.join(rest, "row", "left_anti").unionByName(big.join(rest, "row", "left_semi").select("doc_id", "row", "text").mapInArrow(_whole(path), _CODED))


def encoded(docs: DataFrame, path: str, *, giant: int = GIANT, chunk: int = CHUNK, fan: int = FAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, chunk, ids): the library's ids of every row, giant documents in chunks.

    `row` numbers the rows; a document's ids are its chunks' in order. Null texts are empty and
    have no ids. Ids, null or repeated, pass through; an empty table gives no rows; other
    columns are ignored.
    """
    small, traced = _encoded(docs, path, giant, chunk, fan, id_col, text_col)
    return small.unionByName(traced)


def _digests(path: str):
    """Rows in order of (row, chunk) to one a document: digests of its ids and of their text."""
    kind = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_bytes", pa.int64()), ("decoded_sha256", pa.string())])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        last, held, state = None, [], None

        def close() -> None:
            doc, n, ids, size, text = state
            held.append((doc, n, ids.hexdigest(), size, text.hexdigest()))

        for batch in batches:
            for doc, row, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if row != last:
                    if state:
                        close()
                    state, last = [doc, 0, hashlib.sha256(), 0, hashlib.sha256()], row
                got = np.asarray(ids.values, np.int32)
                text = m.decoded(got.tolist())
                text = text[1:] if state[1] == 0 else text
                state[1] += len(got)
                state[2].update(got.astype("<u4").tobytes())
                state[3] += len(text)
                state[4].update(text)
            if len(held) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kind.types, strict=True)], schema=kind)
                held.clear()
        if state:
            close()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kind.types, strict=True)], schema=kind)

    return digest


def token_digests(coded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (little-endian unsigned 32-bit ids), decoded_bytes and
    decoded_sha256 of rows from `encoded` that stand in order; the text is decoded from the ids."""
    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_bytes long, decoded_sha256 string"
    return coded.select("doc_id", "row", "ids").mapInArrow(_digests(path), kind)


def sentencepiece_digests(docs: DataFrame, path: str, *, giant: int = GIANT, chunk: int = CHUNK, fan: int = FAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every row, decodes its ids and gives the digests of both, as in token_digests.

    Chunks of giant documents are brought together in order and streamed; other documents are
    not shuffled.
    """
    small, traced = _encoded(docs, path, giant, chunk, fan, id_col, text_col)
    return token_digests(small, path).unionByName(token_digests(traced.repartition("row").sortWithinPartitions("row", "chunk"), path))

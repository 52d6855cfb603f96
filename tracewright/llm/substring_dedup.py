"""Substring dedup: repeated-phrase automata find every passage that stands twice.

Texts are read three times and never shuffled. Each read works on slices of a scan partition,
which are the same in every read, and gets what it needs to know about them from side files:

1. each window of words picks its lowest-hashed phrase; phrases picked in two places recur;
2. automata of recurring phrases locate them in all documents, and the windows around them are
   counted;
3. automata locate the phrases once more; the windows around them that stand in two places or
   more cover the words to remove.

The automata are sharded by slice: a shard holds the recurring phrases that occur in its slice, so
a document needs to stream through one automaton, that of its slice, to meet every recurring
phrase it holds. One that held other slices' phrases too would report nothing more.

Equal windows pick equal phrases, so no repeated window is missed; counts compare 96-bit hashes
of windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, holds, scan_partitions, shared_folder, steady, texts_of
from .minhash_core import mix, word_hashes
from .places import Places, store_places

PHRASE = 8
#: Text of a slice, whose phrases make one automaton.
SLICE_BYTES = 3 << 20
#: Text bytes for which one task compares hashes: at most about one row a word.
COMPARE_BYTES = 24 << 20
_BASE_A, _BASE_B = np.uint64(0xD1342543DE82EF95), np.uint64(0x2545F4914F6CDD1D)
_FOUND = pa.schema([("h", pa.int64()), ("g", pa.int32()), ("part", pa.int32()), ("shard", pa.int32()), ("at", pa.int32()), ("twice", pa.bool_())])
_ROWS = "h long, g int, part int, shard int, at int, twice boolean"


class Slice:
    """The words of some documents, one behind the other."""

    def __init__(self, texts: list[str]):
        self.words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.counts)])
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def only(self, docs: list[int]) -> Slice:
        """A slice of some of its documents."""
        out = Slice([])
        out.words = [self.words[i] for i in docs]
        out.counts = self.counts[docs]
        out.begins = np.concatenate([[0], np.cumsum(out.counts)])
        out.doc = np.repeat(np.arange(len(docs)), out.counts)
        return out

    def hashes(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *(word_hashes(b" ".join(w)) for w in self.words)])

    def starts(self, width: int) -> np.ndarray:
        """Whether `width` words from each place on are of one document."""
        n = len(self.doc)
        out = np.zeros(n, bool)
        if n >= width:
            out[: n - width + 1] = self.doc[: n - width + 1] == self.doc[width - 1 :]
        return out


def run_hashes(h: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """Polynomial hashes, mod 2^64, of every `width` consecutive word hashes, well mixed."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    with np.errstate(over="ignore"):
        down = np.cumprod(np.full(len(h), inverse, np.uint64))
        up = np.cumprod(np.full(n, base, np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * down, dtype=np.uint64)])
        return mix((total[width:] - total[:-width]) * up)


def picked_phrases(h: np.ndarray, valid: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all phrases, and the places of those that some valid window picks: of its
    lowest-hashed ones the first."""
    p = run_hashes(h, phrase, _BASE_A)
    many = window - phrase + 1
    if not valid.any():
        return p, np.zeros(0, np.int64)
    at, span = np.arange(len(p)), 1
    better = lambda a, b: np.where(p[b] < p[a], b, a)
    while span * 2 <= many:
        at = better(at[:-span], at[span:])
        span *= 2
    rest = many - span
    if rest:
        at = better(at[:-rest], at[rest:])
    return p, np.unique(at[np.flatnonzero(valid[: len(at)])])


def _distinct(h: np.ndarray, g: np.ndarray, at: np.ndarray, part: int, shard: int) -> pa.RecordBatch:
    """A row for each different hash of a slice: its first place, and whether there are more."""
    _, first, counts = np.unique(h, return_index=True, return_counts=True)
    n = len(first)
    return pa.RecordBatch.from_arrays(
        [pa.array(h[first].view(np.int64)), pa.array(g[first].astype(np.uint32).view(np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, shard, np.int32)), pa.array(at[first].astype(np.int32)), pa.array(counts > 1)],
        schema=_FOUND,
    )


def _slices(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Rows (text, part, ...) by scan partition and slice, numbered by the text bytes before them.

    Slices don't depend on how rows come in batches, which more columns may change, nor on how
    many scan partitions one task works on.
    """
    holds("passages", lambda: None)
    part, before, number, pending = -1, 0, 0, []

    def whole() -> pa.RecordBatch:
        return pending[0] if len(pending) == 1 else pa.Table.from_batches(pending).combine_chunks().to_batches()[0]

    for given in batches:
        parts = np.asarray(given.column(1))
        bounds = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
        for low, high in zip(bounds, [*bounds[1:], len(parts)], strict=True):
            batch = given.slice(low, high - low)
            if parts[low] != part:
                if pending:
                    yield part, number, whole()
                    pending = []
                    give_back()
                part, before = int(parts[low]), 0
            sizes = np.asarray(pc.binary_length(batch.column(0)).fill_null(0)).astype(np.int64)
            numbers = (before + np.cumsum(sizes) - sizes) // limit
            before += int(sizes.sum())
            edges = np.flatnonzero(np.diff(numbers, prepend=-1)).tolist()
            for begin, end in zip(edges, [*edges[1:], len(numbers)], strict=True):
                if pending and numbers[begin] != number:
                    yield part, number, whole()
                    pending = []
                    give_back()
                number = int(numbers[begin])
                pending.append(batch.slice(begin, end - begin))
    if pending:
        yield part, number, whole()
    give_back()


class _Known:
    """Side files of the parts that a task meets, each opened at its first slice."""

    def __init__(self, folder: str):
        self.folder = folder
        self.places: Places | None = None

    def of(self, part: int, shard: int) -> np.ndarray:
        if self.places is None or self.places.part != part:
            self.end()
            self.places = Places(self.folder, part)
        return self.places.of(shard)

    def end(self) -> None:
        if self.places:
            self.places.end()


def _phrases(window: int, phrase: int, limit: int) -> Callable:
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, shard, batch in _slices(batches, limit):
            part = Slice(texts_of(batch, 0))
            p, at = picked_phrases(part.hashes(), part.starts(window), window, phrase)
            yield _distinct(p[at], np.zeros(len(at), np.uint32), at, number, shard)

    return find


def locate(part: Slice, places: np.ndarray, phrase: int) -> dict[int, np.ndarray]:
    """Where the phrases that stand at `places` occur, by document, by an Aho-Corasick automaton.

    A phrase is its words, a space before each and one behind, so it matches whole words alone.
    Bytes are taken as characters one by one.
    """
    import ahocorasick

    automaton = ahocorasick.Automaton()
    docs = part.doc[places]
    for doc, at in zip(docs.tolist(), (places - part.begins[docs]).tolist(), strict=True):
        pattern = f" {b' '.join(part.words[doc][at : at + phrase]).decode('latin-1')} "
        automaton.add_word(pattern, len(pattern) - 1)
    automaton.make_automaton()
    out = {}
    for doc in np.flatnonzero(part.counts >= phrase).tolist():
        words = part.words[doc]
        found = [stop - size for stop, size in automaton.iter(f" {b' '.join(words).decode('latin-1')} ")]
        if found:
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            out[doc] = np.searchsorted(np.cumsum(sizes) - sizes, np.array(found, np.int64))
    return out


def occurrences(part: Slice, places: np.ndarray, window: int, phrase: int) -> tuple[list[int], Slice, np.ndarray, np.ndarray, np.ndarray]:
    """The documents that hold some phrase that stands at `places`, a slice of them alone, the
    windows there that hold one, and two hashes of each of those."""
    found = locate(part, places, phrase)
    docs = list(found)
    some = part.only(docs)
    change = np.zeros(len(some.doc) + 1, np.int64)
    for i, doc in enumerate(docs):
        first = some.begins[i]
        np.add.at(change, np.maximum(found[doc] - (window - phrase), 0) + first, 1)
        np.add.at(change, found[doc] + 1 + first, -1)
    starts = np.flatnonzero((np.cumsum(change)[:-1] > 0) & some.starts(window))
    h = some.hashes()
    return docs, some, starts, run_hashes(h, window, _BASE_A)[starts], run_hashes(h, window, _BASE_B)[starts]


def _windows(phrases: str, window: int, phrase: int, limit: int) -> Callable:
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(phrases)
        for number, shard, batch in _slices(batches, limit):
            places = known.of(number, shard)
            if len(places):
                docs, some, starts, a, b = occurrences(part := Slice(texts_of(batch, 0)), places, window, phrase)
                # places of the whole slice, though only some documents were hashed
                at = starts - some.begins[some.doc[starts]] + part.begins[np.array(docs, np.int64)[some.doc[starts]]]
                yield _distinct(a, b, at, number, shard)
        known.end()

    return find


def _removed(phrases: str, windows: str, window: int, phrase: int, limit: int, digest: bool) -> Callable:
    def gone_of(part: Slice, places: np.ndarray, repeated: np.ndarray) -> dict[int, np.ndarray]:
        """Which words go, by document, for those that lose some."""
        docs, some, starts, a, b = occurrences(part, places, window, phrase)
        # the stored places are one of each window here; its other places have the same hashes
        owner = part.doc[repeated]
        within = dict(zip(docs, range(len(docs)), strict=True))
        first = some.begins[[within[d] for d in owner.tolist()]] + repeated - part.begins[owner]
        of = np.searchsorted(starts, first)
        if not np.array_equal(starts[of], first):
            raise RuntimeError("a window didn't come back: the documents changed between two reads")
        low, at = np.unique(a[of], return_index=True)
        near = np.minimum(np.searchsorted(low, a), len(low) - 1)
        hits = starts[(low[near] == a) & (b[of][at][near].astype(np.uint32) == b.astype(np.uint32))]
        change = np.zeros(len(some.doc) + 1, np.int64)
        change[hits] += 1
        np.subtract.at(change, hits + window, 1)
        gone = np.cumsum(change)[:-1] > 0
        cut = np.unique(some.doc[hits]).tolist()
        return {docs[i]: gone[some.begins[i] : some.begins[i + 1]] for i in cut}

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_windows = _Known(phrases), _Known(windows)
        for number, shard, batch in _slices(batches, limit):
            places, repeated = known.of(number, shard), known_windows.of(number, shard)
            part = Slice(texts_of(batch, 0))
            gone = gone_of(part, places, repeated) if len(repeated) else {}
            n_removed, kept = [], []
            for i, words in enumerate(part.words):
                out = gone.get(i)
                n_removed.append(0 if out is None else int(out.sum()))
                text = b" ".join(words if out is None else [w for w, o in zip(words, out.tolist(), strict=True) if not o])
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(part.counts), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), batch.column(2)], names=["n_words", "n_removed", "kept", "_row"])
        known.end()
        known_windows.end()

    return remove


def repeated_passages(docs: DataFrame, *, window: int = 35, text_col: str = "text", carry: list[str] | None = None, digest: bool = False, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """n_words, n_removed, kept and _row, a struct of the columns `carry`, for every row.

    Words are runs without bytes 0x20 and 0x09-0x0D, unchanged. Every word that a window of
    `window` words covers goes if the window's words also start anywhere else, in the same text
    or another; windows are judged on the input. `kept` is the rest joined by one space, or its
    SHA-256. Each of several equal passages goes, the first one too.

    Null and empty texts have no words. Repeated rows are copies, so their windows repeat. An
    empty table gives no rows; columns that aren't carried are ignored. All reads share one
    set of splits, or a stored copy if the plan has a shuffle; a slice that doesn't come back
    fails the task. The result may be coalesced, or part of a union, like any other.
    """
    spark = docs.sparkSession
    phrase = min(PHRASE, window)
    carried = F.struct(*(f"`{c}`" for c in carry or [])) if carry else F.lit(None).cast("int")
    # numbered below any Python step: the scan partition's own number, whatever task works on it
    given = steady(docs.select(F.col(text_col).alias("_text"), carried.alias("_row"))).select("_text", F.spark_partition_id().alias("_part"), "_row")
    texts = given.select("_text", "_part")
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // COMPARE_BYTES))
    parts = scan_partitions(texts)
    root = shared_folder(spark, "passages")

    def confirmed(found: DataFrame, folder: str) -> None:
        """Stores the places of hashes that stand in two slices, or twice in one. A hash has one
        row a slice at most; Spark sorts and counts them, spilling what memory doesn't hold."""
        same = Window.partitionBy("h", "g")
        again = found.repartition(tasks, "h", "g").withColumn("n", F.count("*").over(same)).filter("n > 1 or twice")
        long = lambda c: F.col(c).cast("long").alias(c)
        store_places(again.select(long("part"), long("shard"), long("at")), folder, parts)

    phrases, windows = f"{root}/phrases", f"{root}/windows"
    confirmed(texts.mapInArrow(_phrases(window, phrase, slice_bytes), _ROWS), phrases)
    confirmed(texts.mapInArrow(_windows(phrases, window, phrase, slice_bytes), _ROWS), windows)
    schema = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), given.schema["_row"]])
    return given.mapInArrow(_removed(phrases, windows, window, phrase, slice_bytes, digest), schema)


def substring_dedup(docs: DataFrame, *, window: int = 35, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row, as in repeated_passages."""
    found = repeated_passages(docs, window=window, text_col=text_col, carry=[id_col], digest=True, slice_bytes=slice_bytes)
    return found.select(F.col("_row").getField(id_col).cast("long").alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def deduplicated_documents(docs: DataFrame, *, window: int = 35, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns; texts with repeated passages hold what is left, others are unchanged."""
    found = repeated_passages(docs, window=window, text_col=text_col, carry=docs.columns)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("_row").getField(text_col))
    changed = {text_col: text, chars_col: F.char_length(text).cast("long")}
    return found.select(*(changed.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))

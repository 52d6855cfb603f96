"""Token counts and token ids with public tokenizers, batched by bytes in Arrow functions."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, holds, slices, texts_of

#: Bytes of text that one encode_batch call gets, and the longest piece whose result is kept.
BATCH_BYTES, KEEP_CHARS = 256 << 10, 16
#: Kept pieces of a worker, and their characters; beyond either they are forgotten, which only costs time.
KEEP_PIECES, KEEP_TOTAL = 250_000, 16_000_000
#: Text whose pieces are told apart at once; more of it repeats more of them.
SLICE_BYTES = 4 << 20
#: Long texts of tokenizers that keep white space are cut before a lone space and a letter.
_CUT = re.compile(r"(?<=\S) (?=[^\W\d_])")
CUT_CHARS = 8192


class PieceEncoder:
    """Encodes texts piece by piece; equal pieces are encoded once while they are remembered.

    A tokenizer that drops white space never joins what stands on two sides of a space, so its
    pieces are the texts between spaces and line feeds. For others a text is one piece, or,
    beyond CUT_CHARS, pieces cut at places where every such tokenizer ends a token.

    Where the model marks word ends, new words of letters alone are encoded as one long text
    and told apart by the marks. There, ASCII punctuation between a letter and a space is apart
    from the letter, and so a piece. Where case makes no difference, A-Z are lower-cased first.
    """

    def __init__(self, path: str, as_bytes: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.as_bytes = as_bytes
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}
        self.size = 0
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        self.by_word = ids(" ") == [] and all(ids(f"{a} {b}") == ids(a) + ids(b) for a, b in (("x", "y"), ("the", "'s"), ("1", "2"), ("!", "?")))
        self.marks = {t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.lower = all(ids(t) == ids(t.lower()) for t in ("The", "ABC", "x'S", "Q1"))
        self.last: np.ndarray | None = None
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if self.by_word and suffix and all(ids(f"the{p}") == ids("the") + ids(p) for p in (".", ",", "!!", "***", "'", "')")):
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def value(self, ids: list[int]) -> object:
        return np.array(ids, "<u4").tobytes() if self.as_bytes else len(ids)

    def pieces(self, texts: list[str]) -> pa.ListArray:
        """The texts' pieces, one at least each."""
        if self.by_word:
            column = pc.replace_substring(pa.array(texts, pa.string()), "\n", " ")
            # special strings are matched as they stand in the text, so nothing may change around them
            if not any(mark in t for t in texts for mark in self.marks):
                if self.last is not None:
                    column = pc.replace_substring_regex(column, r"(\p{L})([!-/:-@\[-`{-~]+) ", r"\1 \2 ")
                if self.lower:
                    column = pc.ascii_lower(column)
            return pc.split_pattern(column, " ")
        return pa.array([self._long_pieces(t) for t in texts], pa.list_(pa.string()))

    @staticmethod
    def _long_pieces(text: str) -> list[str]:
        if len(text) <= CUT_CHARS:
            return [text]
        out, start = [], 0
        for m in _CUT.finditer(text):
            if m.start() - start >= CUT_CHARS // 2:
                out.append(text[start : m.start()])
                start = m.start()
        return [*out, text[start:]]

    def _batches(self, pieces: list[str]) -> Iterator[list[str]]:
        """The pieces in parts of about BATCH_BYTES of UTF-8; a longer piece is in one by itself."""
        if not pieces:
            return
        sizes = np.asarray(pc.binary_length(pa.array(pieces, pa.string()))).astype(np.int64)
        part = (np.cumsum(sizes) - sizes) // BATCH_BYTES
        edges = np.flatnonzero((np.diff(part, prepend=-1) > 0) | (sizes > BATCH_BYTES)).tolist()
        for low, high in zip(edges, [*edges[1:], len(pieces)], strict=True):
            yield pieces[low:high]

    def _words(self, words: list[str]) -> None:
        """Learns words of letters; a batch that isn't one marked end a word goes one by one."""
        for batch in self._batches(words):
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(batch)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(batch):
                self._one_by_one(batch)
            elif self.as_bytes:
                data, at = ids.tobytes(), [0, *(4 * ends).tolist()]
                self.known.update(zip(batch, [data[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))
            else:
                self.known.update(zip(batch, np.diff(ends, prepend=0).tolist(), strict=True))

    def _one_by_one(self, pieces: list[str]) -> None:
        for batch in self._batches(pieces):
            for piece, got in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False), strict=True):
                self.known[piece] = self.value(got.ids)

    def _learn(self, pieces: list[str]) -> None:
        if self.older:
            self.known.update((p, self.older[p]) for p in pieces if p in self.older)
            pieces = [p for p in pieces if p not in self.known]
        if self.last is None:
            self._one_by_one(pieces)
            return
        words = [p for p in pieces if p.isalpha()]
        self._words(words)
        self._one_by_one([*set(pieces).difference(words)])

    def encode(self, texts: list[str]) -> tuple[list[object], np.ndarray, np.ndarray]:
        """Values of the different pieces, each piece's number among them, each text's end."""
        parts = self.pieces(texts)
        coded = parts.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if len(self.known) > KEEP_PIECES or self.size > KEEP_TOTAL:
            self.older, self.known, self.size = {k: v for k, v in self.known.items() if len(k) <= KEEP_CHARS}, {}, 0
        new = [p for p in pieces if p not in self.known]
        self.size += sum(map(len, new))
        self._learn(new)
        return [*map(self.known.__getitem__, pieces)], coded.indices.to_numpy(), parts.offsets.to_numpy()[1:]

    def rest(self) -> None:
        """Forgets the older half; this worker may stay idle while others work."""
        self.older = {}
        give_back()

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        values, index, ends = self.encode(texts)
        total = np.cumsum(np.array(values, np.int64)[index])
        return np.diff(total[ends - 1], prepend=0)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids one behind the other, and each text's end among them."""
        values, index, ends = self.encode(texts)
        flat = np.frombuffer(b"".join(values), "<u4")
        sizes = np.array([*map(len, values)], np.int64) // 4
        size = sizes[index]
        total = np.cumsum(size)
        place = np.repeat((np.cumsum(sizes) - sizes)[index] - (total - size), size) + np.arange(total[-1])
        return flat[place], total[ends - 1]


@lru_cache(maxsize=4)
def counter(path: str) -> PieceEncoder:
    return PieceEncoder(path, False)


@lru_cache(maxsize=4)
def id_encoder(path: str) -> PieceEncoder:
    """Values are little-endian unsigned 32-bit ids, as bytes."""
    return PieceEncoder(path, True)


def token_counts(docs: DataFrame, path: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) for every row.

    Only lengths leave the Python workers. No begin, end or added special tokens; special
    strings inside texts count as the tokenizer's default has it; nothing is truncated. Null
    texts count as empty: 0 bytes, 0 tokens. Ids, null or repeated, pass through; an empty
    table gives no rows; other columns are ignored.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("counts", counter.cache_clear)
        encoder = counter(path)
        for batch in slices(batches, 1, SLICE_BYTES):
            texts = texts_of(batch, 1)
            n = encoder.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )
        encoder.rest()

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

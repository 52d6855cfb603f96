"""Quality classifier: naive Bayes ratios scale n-gram indicators, a linear hinge-loss model
fitted by dual coordinate descent weighs them, and a sigmoid turns margins into scores."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import holds, slices, texts_of
from .minhash_core import mix

#: Places for hashed n-grams of token shapes, and all places; the rest is for words.
SHAPES, PLACES = 1 << 16, 1 << 18
#: Labelled rows that a model is fitted on at most: those whose ids hash lowest.
SAMPLE_ROWS = 6_000
#: Bytes of text that these rows hold at most, but for the last one; later rows are left out.
SAMPLE_BYTES = 96 << 20
SLICE_BYTES = 1 << 20
_REPEAT = np.uint64(0x7265706561747321)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Character classes: 0 space, 1 lower, 2 upper, 3 digit, 4 other letter, 5 other; ASCII
    punctuation marks have classes of their own."""
    out = np.full(0x10000, 5, np.uint8)
    for i in range(0x10000):
        c = chr(i)
        kind = unicodedata.category(c)
        if c.isspace():
            out[i] = 0
        elif kind == "Ll":
            out[i] = 1
        elif kind == "Lu":
            out[i] = 2
        elif kind[0] == "N":
            out[i] = 3
        elif kind[0] in "LM":
            out[i] = 4
        elif i < 128:
            out[i] = 8 + i % 120
    return out


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of all distinct features, sorted by document.

    A token's shape is its runs of character classes, those from the sixteenth on as a set; a
    token that repeats the one before it has a shape of its own. Features are shape n-grams of one
    to three tokens, and words.
    """
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
    kinds = _classes()[np.minimum(codes, 0xFFFF)]
    kinds[codes > 0xFFFF] = 5
    inside = kinds > 0
    before = np.concatenate([[0], kinds[:-1]]).astype(np.uint8)
    starts = np.flatnonzero(inside & (before == 0))
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.searchsorted(begins, starts, side="right") - 1
    chars = np.flatnonzero(inside)
    word = np.searchsorted(starts, chars, side="right") - 1
    with np.errstate(over="ignore"):
        words = np.add.reduceat(mix(codes[chars].astype(np.uint64) + ((chars - starts[word]).astype(np.uint64) << np.uint64(32))), np.searchsorted(chars, starts))
        runs = np.flatnonzero(inside & (kinds != before))
        first = np.searchsorted(runs, starts)
        owner = np.searchsorted(starts, runs, side="right") - 1
        rank = np.minimum(np.arange(len(runs)) - first[owner], 15)
        shape = mix(np.add.reduceat(mix(kinds[runs].astype(np.uint64) * np.uint64(64) + rank.astype(np.uint64)), first))
        same = np.zeros(len(starts), bool)
        same[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
        shape[same] = _REPEAT
        found = [(doc, shape % np.uint64(SHAPES)), (doc, SHAPES + mix(words) % np.uint64(PLACES - SHAPES))]
        gram = shape
        for n in (1, 2):
            gram = mix(gram[:-1] * np.uint64(31) + shape[n:])
            within = doc[n:] == doc[:-n]
            found.append((doc[n:][within], (gram % np.uint64(SHAPES))[within]))
    keys = np.unique(np.concatenate([d * PLACES + p.astype(np.int64) for d, p in found]))
    return keys // PLACES, keys % PLACES


@dataclass
class Model:
    """weights has a value for each place; score = 1 / (1 + exp(-(slope * margin + shift)))."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, texts: list[str]) -> np.ndarray:
        doc, place = features(texts)
        return np.bincount(doc, self.weights[place], len(texts)) / np.sqrt(np.maximum(np.bincount(doc, minlength=len(texts)), 1)) + self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """log of the smoothed shares that each feature has in the two classes; 0, which is no
    evidence, for features that fewer than three rows have."""
    counts = [np.full(PLACES, alpha), np.full(PLACES, alpha)]
    for x, label in zip(rows, y, strict=True):
        counts[int(label > 0)][x] += 1
    neg, pos = (c / (2 * alpha + (y == s).sum()) for c, s in zip(counts, (-1, 1), strict=True))
    ratio = np.log(pos / neg)
    ratio[counts[0] + counts[1] < 2 * alpha + 3] = 0  # too rare to tell
    return ratio


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, c: np.ndarray, epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """min 1/2 |w|^2 + sum c_i max(0, 1 - y_i w.x_i) by its dual, one row at a time; x has a 1 behind."""
    rng = np.random.default_rng(seed)
    w, b = np.zeros(PLACES), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([v @ v + 1.0 for v in values])
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            x, v, s = rows[i], values[i], y[i]
            gradient = s * (w[x] @ v + b) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), c[i])
            step = (new - alpha[i]) * s
            if step:
                worst = max(worst, abs(new - alpha[i]) * square[i])
                w[x] += step * v
                b += step
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, b


def _sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make scores probabilities, by Newton steps on smoothed targets."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    z = np.stack([margins, np.ones_like(margins)])
    at = np.array([1.0, np.log((pos + 1) / (neg + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ z, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)) @ z.T + 1e-6 * np.eye(2), z @ (target - p))
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def _weights(rows: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the indicators themselves, ratios multiplied in, and the bias."""
    ratio = log_count_ratios(rows, y)
    values = [ratio[x] / np.sqrt(max(len(x), 1)) for x in rows]
    share = {s: len(y) / (2 * max(1, (y == s).sum())) for s in (-1, 1)}
    w, b = dual_coordinate_descent(rows, values, y, np.array([share[s] for s in y.tolist()]))
    return w * ratio, b


def fit(texts: list[str], labels: list[int], folds: int = 4) -> Model:
    """A model from rows with labels 0 and 1. The sigmoid is fitted to margins that each row
    gets from a model of the other folds.

    With too few rows of one class, every score is the smoothed share of label 1.
    """
    y = np.where(np.asarray(labels, np.int64) > 0, 1, -1) if labels else np.zeros(0, np.int64)
    pos, neg = int((y > 0).sum()), int((y < 0).sum())
    if min(pos, neg) < folds:
        return Model(np.zeros(PLACES), 0.0, 1.0, float(np.log((pos + 1) / (neg + 1))))
    rows: list[np.ndarray] = []
    for start in range(0, len(texts), 200):
        part = texts[start : start + 200]
        doc, place = features(part)
        rows += np.split(place, np.searchsorted(doc, np.arange(1, len(part))))
    fold = np.zeros(len(y), np.int64)
    for s in (-1, 1):
        fold[y == s] = np.arange((y == s).sum()) % folds
    margins = np.zeros(len(y))
    for f in range(folds):
        w, b = _weights([x for x, g in zip(rows, fold, strict=True) if g != f], y[fold != f])
        for i in np.flatnonzero(fold == f):
            margins[i] = w[rows[i]].sum() / np.sqrt(max(len(rows[i]), 1)) + b
    return Model(*_weights(rows, y), *_sigmoid(margins, y))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int, sample_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[int]]:
    """Texts and labels of at most `sample_rows` rows; ids with crc32 mod 5 = 0 are left out.

    The ids that hash lowest are taken, one row each, while their texts hold `sample_bytes` at
    most; so the same rows each time. Only their table, of bounded size, is broadcast; documents
    are not shuffled.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("key"), F.col(label).cast("int").alias("y")).dropna()
    known = known.filter(F.crc32(F.col("key").cast("string").cast("binary")) % 5 != 0).groupBy("key").agg(F.max("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    got = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("key")).groupBy("key", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    # of `sample_rows` rows at the most
    before = Window.orderBy(F.xxhash64("key"), "key").rowsBetween(Window.unboundedPreceding, -1)
    got = got.withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0))).filter(F.col("before") < sample_bytes)
    rows = sorted((r["key"], r["text"], r["y"]) for r in got.collect())
    return [r[1] for r in rows], [int(r[2] > 0) for r in rows]


def quality_scores(docs: DataFrame, labels: DataFrame, *, label: str = "quality", threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted and _kept for every row: a struct of the columns `keep`.

    The model sees texts alone. Null texts are empty; an empty text has the score of a document
    without features. Null ids are not held out; repeated rows are scored alike; without usable
    labels every score is 0.5; an empty table gives no rows; other columns are ignored.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_rows(plain, labels, label, sample_rows)))
    kept = [f"`{c}`" for c in keep or []]
    given = docs.select(F.col(text_col).alias("_text"), F.col(id_col).cast("long").alias("_id"), F.struct(*kept).alias("_kept") if kept else F.lit(None).cast("int").alias("_kept"))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("quality", _classes.cache_clear)
        for batch in slices(batches, 0, SLICE_BYTES):
            s = model.value.scores(texts_of(batch, 0))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32)), batch.column(2)], names=["_id", "_score", "_predicted", "_kept"])

    schema = T.StructType([T.StructField("_id", T.LongType()), T.StructField("_score", T.DoubleType()), T.StructField("_predicted", T.IntegerType()), T.StructField("_kept", given.schema["_kept"].dataType)])
    scored = given.mapInArrow(score, schema)
    held_out = F.coalesce(F.crc32(F.col("_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select(F.col("_id").alias("doc_id"), held_out.alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"), "_kept")


def quality_filter(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """The rows that the classifier accepts, with all their columns."""
    scored = quality_scores(docs, labels, threshold=threshold, keep=docs.columns)
    return scored.filter("predicted = 1").select(*(F.col("_kept").getField(c).alias(c) for c in docs.columns))

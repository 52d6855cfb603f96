"""MinHash near-dedup: SuperMinHash signatures, banding, verification, union-find grouping."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, holds, scan_partitions, shared_folder, slices, spare_name, steady, texts_of
from .components import components
from .hot import beside, dealt, limit_of, marked
from .minhash_core import band_keys, digest, shingle_set, super_min_hash
from .places import Places, store_places

BANDS, ROWS = 24, 4
#: Register values are kept as 32-bit numbers: 7 bits before the point, 25 behind.
_SCALE = 2.0**25
#: Registers that must agree before two sets are compared in a mixed bucket. At a similarity
#: of 0.8 fewer of 96 agree in one case of ten million; lower settings scale in the same way.
SIGMAS = 5.2
BLOCK = 512

_SIGNED = "doc_id long, row long, n_shingles long, d1 long, d2 long, sig binary"
#: Row numbers hold the scan partition above so many bits, and the place in it below.
_PLACE_BITS = 33


def _signer(width: int) -> Callable:
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("shingles", lambda: None)
        for batch in slices(batches, 1):
            sets = [shingle_set(t, width) for t in texts_of(batch, 1)]
            sig = super_min_hash(sets, BANDS * ROWS)
            full = [len(s) > 0 for s in sets]
            packed = np.zeros(sig.shape, np.uint32)
            packed[full] = (sig[full] * _SCALE).astype(np.uint32)
            digests = [digest(s) if f else (None, None) for s, f in zip(sets, full, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.array([x.tobytes() if f else None for x, f in zip(packed, full, strict=True)], pa.binary()),
                ],
                names=["doc_id", "row", "n_shingles", "d1", "d2", "sig"],
            )

    return sign


def _bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sig) to (key, node), a row a band."""
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
            keys = band_keys(sig.astype(np.uint64), BANDS, ROWS).reshape(-1)
            nodes = np.repeat(np.asarray(batch.column(0)), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], names=["key", "node"])


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles, n) of the wanted nodes, which are the numbers of the rows to read.

    Texts are read again and never shuffled; each scan partition finds its wanted rows in a file.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "wanted")
    place = F.col("node").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    rows = wanted.select(F.shiftright("node", _PLACE_BITS).alias("part"), F.lit(0).cast("long").alias("shard"), place.alias("at"))
    asked = store_places(rows, folder, scan_partitions(docs))

    def again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = -1, np.zeros(0, np.int64)
        for batch in slices(batches, 0):
            row = np.asarray(batch.column(1))
            keep = np.zeros(len(row), bool)
            for one in np.unique(row >> _PLACE_BITS).tolist():
                if one != part:
                    part, held = one, Places(folder, one).of(0)
                keep |= (row >> _PLACE_BITS == part) & np.isin(row & ((1 << _PLACE_BITS) - 1), held)
            batch = batch.filter(pa.array(keep))
            sets = [shingle_set(t, width) for t in texts_of(batch, 0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array([len(s) for s in sets], pa.int32())], names=["node", "shingles", "n"])

    found = docs.select("text", "row").mapInArrow(again, "node long, shingles array<long>, n int")
    # dealt by node, the copy keeps that partitioning, so the joins to come needn't deal sets again
    sets = cut(found.repartition("node"))
    came = sets.count()
    if came != asked:
        raise RuntimeError(f"{came} of {asked} sets came back: the documents changed between two reads")
    return sets


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    sizes = sets.select("node", "n")
    close = (
        pairs.join(sizes.toDF("a", "na"), "a")
        .join(sizes.toDF("b", "nb"), "b")
        .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    )
    one = close.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return two.filter(common * 100 >= (F.col("na") + F.col("nb") - common) * percent).select("a", "b")


def _comparer(percent: int, sigmas: float | None) -> Callable:
    """Within a block pair: rows (key, i, j, side, node, comp, n, data) to links, or to nodes.

    By signatures, given `sigmas`, it names the nodes that may have a link outside their
    component; by sets, without, it gives the links themselves. No pair leaves a task unless it
    is a link.
    """
    need = percent / 100
    by_signature = sigmas is not None
    least = BANDS * ROWS * need - (sigmas or 0) * (BANDS * ROWS * need * (1 - need)) ** 0.5

    def similar(data: list, sizes: np.ndarray) -> np.ndarray:
        if by_signature:
            sig = np.frombuffer(b"".join(data), np.uint32).reshape(len(data), -1)
            same = np.zeros((len(data), len(data)), np.int16)
            for r in range(sig.shape[1]):
                same += sig[:, r, None] == sig[None, :, r]
            return same >= least
        sets = [np.asarray(x) for x in data]
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        values = values[counts > 1]
        common = np.zeros((len(sets), len(sets)), np.int64)
        for start in range(0, len(values), 4096):
            part = values[start : start + 4096]
            held = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                at = np.searchsorted(part, s)
                at[at == len(part)] = 0
                held[i, at[part[at] == s]] = 1
            common += (held @ held.T).astype(np.int64)
        return 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)

    def compare(group: pa.Table) -> pa.Table:
        node, comp, n = (np.asarray(group.column(c)) for c in ("node", "comp", "n"))
        side = np.asarray(group.column("side"))
        alone = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        hit = np.zeros((len(node), len(node)), bool)
        if len(node) > 1 and (comp != comp[0]).any():
            hit = similar(group.column("data").to_pylist(), n) & (comp[:, None] != comp[None, :])
            hit &= np.minimum(n[:, None], n[None, :]) * 100 >= percent * np.maximum(n[:, None], n[None, :])
            hit &= np.triu(np.ones_like(hit), 1) if alone else (side[:, None] < side[None, :])
        x, y = np.nonzero(hit)
        if by_signature:
            x = np.unique(np.concatenate([x, y]))
            return pa.table({"a": pa.array(node[x], pa.int64()), "b": pa.array(node[x], pa.int64())})
        return pa.table({"a": pa.array(node[x], pa.int64()), "b": pa.array(node[y], pa.int64())})

    return compare


def _blocked(rows: DataFrame, hot: DataFrame, data: DataFrame, percent: int, sigmas: float | None) -> DataFrame:
    """Compares the rows (key, hot, node, comp, main) of each key in block pairs of bounded size.

    Rows of the main component are compared with the others alone, which are fewer as a rule.
    """
    apart = F.col("comp") != F.col("main")
    sizes = rows.groupBy("key").agg(F.count_if(apart).alias("others"), F.count_if(~apart).alias("mains"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    spread = lambda c: F.pmod(F.xxhash64("node", "key"), F.greatest(blocks(c), F.lit(1))).cast("int")
    # the others' blocks come first, the main component's behind them
    own = F.when(apart, spread("others")).otherwise(blocks("others") + spread("mains"))
    last = F.when(apart, blocks("others") + blocks("mains")).otherwise(blocks("others")) - 1
    dealt = beside(rows, sizes, hot).filter("others > 0").withColumn("own", own).withColumn("last", last).join(data, "node")
    dealt = dealt.select("key", "node", "comp", "n", "data", "own", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "comp", "n", "data")
    return dealt.groupBy("key", "i", "j").applyInArrow(_comparer(percent, sigmas), "a long, b long")


def _mixed_links(entries: DataFrame, hot: DataFrame, comps: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, sigmas: float | None) -> DataFrame | None:
    """Links (a, b) that buckets' best connected nodes leave: those between the components of
    buckets that hold several; None if there are no such buckets."""
    member = entries.filter("size > 2").join(comps, "node", "left").withColumn("comp", F.coalesce("root", "node"))
    mixed = cut(member.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max_by("comp", "pop").alias("main")).filter("low <> high").select("key", "main"))
    if mixed.isEmpty():
        return None
    member = cut(beside(member.select("key", "hot", "node", "comp"), mixed, hot))
    if sigmas is not None:
        signatures = nodes.join(member.select("node").distinct(), "node", "left_semi").select("node", "n", F.col("sig").alias("data"))
        may = _blocked(member, hot, signatures, percent, sigmas).select(F.col("a").alias("node")).distinct()
        member = cut(member.join(may, "node", "left_semi"))
    return cut(_blocked(member, hot, sets.select("node", "n", F.col("shingles").alias("data")), percent, None))


def _grouped(docs: DataFrame, width: int, percent: int, sigmas: float | None) -> DataFrame:
    """(doc_id, row, n_shingles, root, component_id) for every row; no root without shingles.

    Rows with equal sets, by digests of 128 bits, are one node, named by its smallest row number.
    """
    signed = cut(docs.mapInArrow(_signer(width), _SIGNED))
    nodes = cut(signed.filter("d1 is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.min("row").alias("node"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")))
    banded = cut(nodes.select("node", "sig").mapInArrow(_bands, "key long, node long"))
    sizes = cut(banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
    hot = sizes.filter(F.col("size") > limit_of(banded.count()))
    multi = cut(beside(marked(banded, hot), sizes, hot))
    popular = multi.groupBy("node").agg(F.sum("size").alias("pop"))
    entries = cut(multi.join(popular, "node"))
    hubs = cut(entries.groupBy("key").agg(F.max_by("node", "pop").alias("b")))
    pairs = cut(beside(entries, hubs, hot).filter("node <> b").select(F.col("node").alias("a"), "b").distinct())
    sets = _sets(docs, entries.select("node").distinct(), width)
    links = cut(_verified(pairs, sets, percent))
    comps = cut(components(links))
    more = _mixed_links(entries, hot, comps, nodes, sets, percent, sigmas)
    if more is not None and not more.isEmpty():
        # components of components: the few new links between the roots alone
        root = lambda c: comps.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
        between = more.join(root("a"), "a", "left").join(root("b"), "b", "left")
        joined = cut(components(between.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))).toDF("root", "now"))
        roots = comps.select("root").distinct().join(joined, "root", "left").select("root", F.coalesce("now", "root").alias("now"))
        known = dealt(comps, cut(roots), "root").select("node", F.col("now").alias("root"))
        # nodes that had no link before
        new = joined.join(comps.select(F.col("node").alias("root")), "root", "left_anti").select(F.col("root").alias("node"), F.col("now").alias("root"))
        comps = cut(known.unionByName(new))

    named = nodes.select("d1", "d2", "node", "rep").join(comps, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = dealt(named, cut(named.groupBy("root").agg(F.min("rep").alias("component_id"))), "root").select("d1", "d2", "root", "component_id")
    rows = signed.filter("d1 is not null").select("doc_id", "row", "n_shingles", "d1", "d2")
    full = rows.hint("merge").join(cut(named), ["d1", "d2"]).select("doc_id", "row", "n_shingles", "root", "component_id")
    empty = signed.filter("d1 is null").select("doc_id", "row", "n_shingles", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, sigmas: float | None = SIGMAS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of the documents.

    Words are lower-cased in A-Z and split at bytes 0x20 and 0x09-0x0D; a document's set holds
    its distinct `width`-word shingles. Documents with 100 * intersection >= `percent` * union
    are linked; component_id is the smallest id reachable and kept marks that document.

    Equal sets are one node of the link graph. Nodes that share a band of their SuperMinHash
    signatures meet in a bucket. Each bucket compares all its nodes with its best connected
    one, on full sets. Buckets that still hold several components are then compared block by
    block, so a bucket's links don't depend on that choice; those whose signatures agree on too
    few registers are left out there, which loses a link in one case of ten million, unless
    `sigmas` is None.

    Null and empty texts have no shingles and link with nothing. Rows repeated in full are
    copies of each other. Among tied or null ids the smallest that isn't null names the
    component; a component without any id has none and keeps all its rows. An empty table gives
    no rows. Other columns are ignored.
    """
    found = _grouped(_numbered(steady(docs.select(id_col, text_col)), id_col, text_col), width, percent, sigmas).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, sigmas: float | None = SIGMAS) -> DataFrame:
    """One row of each component, that of the smallest id, and all rows without shingles.

    Rows are told apart by their place in the table, so repeated ids and rows do no harm.
    """
    docs = steady(docs)
    found = _grouped(_numbered(docs, id_col, text_col), width, percent, sigmas)
    first = found.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"))
    place = spare_name(docs, "_row")
    kept = first.select(F.col("first.row").alias(place)).unionByName(found.filter("root is null").select(F.col("row").alias(place)))
    return docs.withColumn(place, F.monotonically_increasing_id()).join(kept, place, "left_semi").select(*(f"`{c}`" for c in docs.columns))

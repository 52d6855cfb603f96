"""Document fingerprints: SimHash and permuted block tables, in DataFrame functions alone."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BITS = 64
#: A document by its id, null or not, and two hashes of its text; nothing in it is ever null.
KEY = ["nul", "k", "h1", "h2"]
#: Equal rows that one task writes out.
COPIES = 10_000
#: Words longer than this weigh no more.
HEAVIEST = 12
SPACES = r"[\x20\x09-\x0D]+"
_PAIR = (1 << 32) + 1


def simhash(rows: DataFrame, keys: list[str], words: str) -> DataFrame:
    """The keys, each kept once, and `fp`: the 64-bit SimHash of an array of words.

    A word votes on each bit with the weight of its length. A sum carries the votes of two bits,
    32 places apart, in the halves of one long. Rows without words have fingerprint 0. Where
    the rows are already partitioned by one of the keys, nothing is shuffled.
    """
    exploded = rows.select(*keys, F.explode(words).alias("word"))
    weighed = exploded.select(*keys, F.xxhash64("word").alias("h"), F.least(F.char_length("word"), F.lit(HEAVIEST)).cast("long").alias("w"))
    votes = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_PAIR)) * F.col("w")).alias(f"v{i}") for i in range(BITS // 2)]
    summed = weighed.groupBy(*keys).agg(F.sum("w").alias("total"), *votes)
    fp = F.lit(0).cast("long")
    for i in range(BITS // 2):
        for bit, count in ((i, F.col(f"v{i}").bitwiseAND(F.lit((1 << 32) - 1))), (i + 32, F.shiftrightunsigned(f"v{i}", 32))):
            fp = fp.bitwiseOR(F.when(count * 2 > F.col("total"), F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, fp.alias("fp"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """The share of equal bits of two fingerprints."""
    x = (F.col(a) if isinstance(a, str) else a).bitwiseXOR(F.col(b) if isinstance(b, str) else b)
    return F.lit(1.0) - F.bit_count(x) / F.lit(float(BITS))


def block_masks(radius: int, spare: int = 3) -> list[int]:
    """Masks of `spare` blocks out of radius + spare: fingerprints that differ in at most
    `radius` bits agree on all bits of one mask at least."""
    n = radius + spare
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(blocks, spare)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, other, ...) for every query fingerprint and every other one within the radius.

    Both sides are distinct values in a column `fp`; further columns of the index stay. Each is
    entered in a table for each mask; two that meet are compared at once, and kept in the first
    table they share alone.
    """
    masks = block_masks(radius)
    entries = F.explode(F.array(*(F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks))))
    more = [c for c in index.columns if c != "fp"]
    left = queries.select("fp", entries.alias("e")).select("fp", "e.table", "e.key")
    right = index.select(F.col("fp"), *more, entries.alias("e")).select(F.col("fp").alias("other"), *more, F.col("e.table").alias("table"), F.col("e.key").alias("key"))
    x = F.col("fp").bitwiseXOR(F.col("other"))
    first = F.lit(len(masks))
    for i in reversed(range(len(masks))):
        first = F.when(x.bitwiseAND(F.lit(masks[i])) == 0, F.lit(i)).otherwise(first)
    l, r = left.alias("l"), right.alias("r")
    on = (F.col("l.table") == F.col("r.table")) & (F.col("l.key") == F.col("r.key")) & (F.bit_count(x) <= radius) & (F.col("fp") != F.col("other")) & (F.col("l.table") == first)
    return l.hint("merge").join(r, on).select("fp", "other", *more)  # both sides grow with the input


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(id_.isNull().alias("nul"), F.coalesce(id_, F.lit(0)).alias("k"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"), text.alias("text"))


def next_keys(rows: DataFrame) -> DataFrame:
    """(KEY, copies, half, then) for each different document: how often it stands there, half its
    code points, and the key of the next one by descending id, null ids last, ties by hashes.

    Keys are sorted by Spark's own range partitioning, whatever ids there are; texts are not. A
    document's next one has the place behind its own, or is the head of the next partition.
    """
    half = F.floor(F.char_length("text") / 2).cast("int")
    groups = rows.select(*KEY, half.alias("half")).groupBy(*KEY).agg(F.count("*").alias("copies"), F.max("half").alias("half"))
    ordered = groups.orderBy("nul", *(F.desc(c) for c in KEY[1:]))
    placed = cut(ordered.withColumn("place", F.monotonically_increasing_id()))
    behind = placed.select((F.col("place") - 1).alias("place"), F.struct(*KEY).alias("own"))
    # one row a partition: the places of each begin anew in the lowest 33 bits
    part = F.shiftright("place", 33)
    heads = placed.filter(F.pmod("place", F.lit(1 << 33)) == 0).select(part.alias("part"), F.struct(*KEY).alias("head"))
    order = Window.orderBy("part")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(order), F.first("head").over(every)).alias("head"))
    linked = placed.hint("merge").join(behind, "place", "left").join(F.broadcast(heads), part == F.col("part"))
    return linked.select(*KEY, "copies", "half", F.coalesce("own", "head").alias("then"))


def with_edited(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(KEY, copies, text, edited, repeated) for each different document.

    `edited` ends with the beginning of the next document; `repeated`, null without copies, with
    that of the same one, as it is for all copies but the last. Texts are dealt by key, copies
    together, and once more as far as another document's edited text needs them.
    """
    texts = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    asked = links.filter("half > 0").select(*(F.col(f"then.{c}").alias(c) for c in KEY), F.struct(*KEY).alias("of"), F.col("half").alias("n"))
    begin = lambda n: F.substring(F.col("text"), F.lit(1), n)
    added = texts.hint("merge").join(asked, KEY).select(*(F.col(f"of.{c}").alias(c) for c in KEY), begin(F.col("n")).alias("added"))
    whole = texts.hint("merge").join(links.drop("then"), KEY).hint("merge").join(added, KEY, "left")
    first = begin(F.char_length("text") - F.col("half"))
    return whole.select(*KEY, "copies", "text", F.concat(first, F.coalesce("added", F.lit(""))).alias("edited"), F.when(F.col("copies") > 1, F.concat(first, begin(F.col("half")))).alias("repeated"))


def _written_out(rows: DataFrame) -> DataFrame:
    """Each row `copies` times, numbered from 1 in `copy`; many copies are dealt to many tasks."""
    few = rows.filter(F.col("copies") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    many = rows.filter(F.col("copies") > COPIES).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(COPIES).cast("long"))))
    last = F.least(F.col("copies"), F.col("copy") + (COPIES - 1))
    return few.unionByName(many.repartition("copy", "h1").withColumn("copy", F.explode(F.sequence(F.col("copy"), last))))


def document_fingerprints(docs: DataFrame, *, radius: int = 3, every: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    and n_within for every row.

    The edited text is the text with its last half, rounded down, replaced by as many first
    code points, or all, of the next document by descending id. n_within counts the other rows
    whose fingerprints lie within `radius` bits, for rows with ids divisible by `every`; other
    rows have null.

    Null and empty texts have no words and fingerprint 0. Ids may be any longs, null, last in
    order, or repeated, ordered by hashes of the text; of rows equal in both, all but the last
    have an equal next one. A single row is its own next. An empty table gives no rows; other
    columns are ignored. Rows equal in both are worked on once.
    """
    rows = _keyed(docs, id_col, text_col)
    links = cut(next_keys(rows))
    texts = with_edited(rows, links)
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    keys = [*KEY, "copies", "n_chars", "edited_sha256", "repeated_sha256"]
    which = F.filter(F.array(*(F.struct(F.lit(i).alias("which"), F.col(c).alias("t")) for i, c in enumerate(("text", "edited", "repeated")))), lambda x: x["t"].isNotNull())
    exploded = texts.select(*KEY, "copies", F.char_length("text").cast("long").alias("n_chars"), digest("edited").alias("edited_sha256"), digest("repeated").alias("repeated_sha256"), F.explode(which).alias("x"))
    prints = simhash(exploded.select(*keys, "x.which", F.split("x.t", SPACES).alias("words")), [*keys, "which"], "words")
    fp = lambda i: F.max(F.when(F.col("which") == i, F.col("fp")))
    own = cut(prints.groupBy(*keys).agg(fp(0).alias("fp"), fp(1).alias("edited_fp"), fp(2).alias("repeated_fp")))

    after = own.select(F.struct(*KEY).alias("then"), F.col("fp").alias("next_fp"))
    after = links.select(*KEY, "then").hint("merge").join(after, "then").select(*KEY, "next_fp")
    values = own.groupBy("fp").agg(F.sum("copies").alias("n"))
    asks = (F.col("k") % every == 0) & ~F.col("nul")
    queries = own.filter(asks).select("fp").distinct()
    others = within_radius(queries, values, radius).groupBy("fp").agg(F.sum("n").alias("near"))
    counts = queries.join(values, "fp").join(others, "fp", "left").select("fp", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_within"))
    asked = own.filter(asks).join(counts, "fp")
    rest = own.filter(~asks).withColumn("n_within", F.lit(None).cast("long"))
    every_one = _written_out(asked.unionByName(rest).hint("merge").join(after, KEY))
    is_last = F.col("copy") == F.col("copies")
    last = lambda a, b: F.when(is_last, F.col(a)).otherwise(F.col(b))
    text = lambda c: F.lpad(F.hex(c), 16, "0")
    return every_one.select(
        F.when(~F.col("nul"), F.col("k")).alias("doc_id"),
        "n_chars",
        last("edited_sha256", "repeated_sha256").alias("edited_sha256"),
        text("fp").alias("fingerprint"),
        text(last("edited_fp", "repeated_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), last("edited_fp", "repeated_fp")).alias("near_edited"),
        likeness(F.col("fp"), last("next_fp", "fp")).alias("near_next"),
        "n_within",
    )

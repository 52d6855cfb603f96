from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracewright.llm import chat, fingerprints, media
from tracewright.llm.common import shared_folder

TEXTS = [None, "", "a", "x" * 191, "é" * 96, "y" * 193, "long " * 60_000, "same", "same"]


def test_media_round_trip(spark):
    df = spark.createDataFrame([(i if i != 3 else None, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, payload int")
    rows = media.media_columns(df).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        data = (TEXTS[3 if r["doc_id"] is None else r["doc_id"]] or "").encode()
        payload = data + b" " * (-len(data) % 192 or (0 if data else 192))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(payload[-16:])
    same = [r for r in rows if r["doc_id"] in (7, 8)]
    assert len({tuple(r)[1:] for r in same}) == 1
    assert media.media_columns(df.limit(0)).count() == 0


def test_features_are_those_of_the_payload(spark):
    """Mean, deviation, and which of 8 x 8 cells are as bright as their mean, sample by sample."""
    import statistics

    texts = ["some words " * 300, "", "é" * 700, "ABC " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in media.media_columns(df).collect():
        data = texts[r["doc_id"]].encode()
        payload = data + b" " * (-len(data) % 192 or (0 if data else 192))
        rows = [payload[i : i + 192] for i in range(0, len(payload), 192)]
        cells = []
        for a in range(8):
            low, high = int(len(rows) * a / 8), int(len(rows) * (a + 1) / 8)
            part = rows[min(low, len(rows) - 1) : max(high, low + 1)]
            cells += [statistics.fmean(v for row in part for v in row[24 * b : 24 * b + 24]) for b in range(8)]
        bits = sum((c >= statistics.fmean(cells) - 1e-9) << (63 - i) for i, c in enumerate(cells))
        mean, deviation, shown = r["feature"].split(":")
        assert float(mean) == pytest.approx(statistics.fmean(payload), abs=1e-4)
        assert float(deviation) == pytest.approx(statistics.pstdev(payload), abs=1e-4)
        assert bin(int(shown, 16) ^ bits).count("1") <= 1  # a cell at the mean itself


def test_ranges_and_leftovers(spark):
    folder = shared_folder(spark, "media-test")
    df = spark.createDataFrame([(i, f"text {i} " * i) for i in range(200)], "doc_id long, text string").repartition(3)
    media.write_archives(df, folder)
    here = Path(folder.removeprefix("file://").removeprefix("file:"))
    (here / "left-behind.tar").write_bytes(b"junk of a lost task")
    whole = sorted(map(tuple, media.read_archives(spark, folder).collect()))
    parts = media.read_archives(spark, folder, range_bytes=1024)
    assert parts.rdd.getNumPartitions() > 50
    assert sorted(map(tuple, parts.collect())) == whole
    assert [r[0] for r in whole] == list(range(200))


def test_members_are_tried_again_and_damage_is_told(tmp_path):
    writer = media._Writer(f"file://{tmp_path}")
    import pyarrow as pa

    message = writer.write(iter([pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one", "two"])], names=["doc_id", "text"])]))
    writer.commit([message])
    reader = media._Reader(f"file://{tmp_path}", 1 << 20, 2)
    tries = []
    real = media.from_png

    def flaky(data):
        tries.append(1)
        if len(tries) in (1, 2):
            raise ValueError("flaky")
        return real(data)

    media.from_png = flaky
    try:
        got = [b for p in reader.partitions() for b in reader.read(p)]
    finally:
        media.from_png = real
    assert [x for b in got for x in b.column(0).to_pylist()] == [1, 2]
    path = tmp_path / message.archive
    data = bytearray(path.read_bytes())
    data[540] ^= 1
    path.write_bytes(bytes(data))
    with pytest.raises(media.MemberError):
        [b for p in reader.partitions() for b in reader.read(p)]


def test_edited_texts_and_order(spark):
    rng = random.Random(2)
    rows = [(i * i - 50, " ".join(rng.choice(["aa", "bé", "ccc"]) + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(7_000_000, "far \U0001f600 away")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bucket int")
    got = {r["doc_id"]: r for r in fingerprints.document_fingerprints(df, every=5).collect()}
    ordered = sorted(rows, reverse=True)
    for k, (i, t) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[1][:half]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        apart = bin(int(got[i]["fingerprint"], 16) ^ int(got[after[0]]["fingerprint"], 16)).count("1")
        assert got[i]["near_next"] == pytest.approx(1 - apart / 64)
        near = sum(bin(int(got[i]["fingerprint"], 16) ^ int(got[j]["fingerprint"], 16)).count("1") <= 3 for j, _ in rows) - 1
        assert got[i]["n_within"] == (near if i % 5 == 0 else None)


def xxh64_int(word):
    """Spark's xxhash64 of one string, as an unsigned number."""
    import xxhash

    return xxhash.xxh64_intdigest(word.encode(), 42)


def simhash_of(text):
    """Signed votes of whole texts, bit by bit: + the weight for a one, - the weight for a zero."""
    votes = [0] * 64
    for word in re.split(r"[\x20\x09-\x0D]+", text):
        h, weight = xxh64_int(word), min(len(word), 12)
        for bit in range(64):
            votes[bit] += weight if h >> bit & 1 else -weight
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


WIDE = [-(1 << 63), (1 << 63) - 1, -(1 << 63) + 1, (1 << 62) + 7, 0, -1, 1, 50, 1 << 40]


def ids_of(kind):
    rng = random.Random(5)
    if kind == "full range":
        return [*WIDE, *(rng.randint(-(1 << 63), (1 << 63) - 1) for _ in range(150))]
    if kind == "positive":
        return [rng.randint(0, (1 << 63) - 1) for _ in range(150)]
    if kind == "one far":
        return [*range(200), (1 << 63) - 1]
    return [7] * 150 + [None] * 20 + [8]


@pytest.mark.parametrize("kind", ["full range", "positive", "one far", "one id"])
def test_fingerprints_equal_an_independent_simhash(spark, kind):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["aa", "bé", "ccc", "\U0001f600", "averyverylongword"]) + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 30)))) for i in ids_of(kind)]
    rows += rows[:20]  # copies
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = fingerprints.document_fingerprints(df, every=5).collect()
    assert len(got) == len(rows)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    import xxhash

    h1 = lambda t: signed(xxhash.xxh64_intdigest(t.encode(), 42))
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -h1(r[1])))
    want = []
    for n, (i, t) in enumerate(ordered):
        after = ordered[(n + 1) % len(ordered)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = simhash_of(t), simhash_of(edited), simhash_of(after)
        near = sum(bin(a ^ simhash_of(u)).count("1") <= 3 for _, u in rows) - 1
        want.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016X}", f"{b:016X}", 1 - bin(a ^ b).count("1") / 64, 1 - bin(a ^ c).count("1") / 64, near if i is not None and i % 5 == 0 else -1))
    assert sorted((str(r["doc_id"]), *tuple(r)[1:7], -1 if r["n_within"] is None else r["n_within"]) for r in got) == sorted(want)


def test_one_id_in_very_many_rows(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "COPIES", 100)
    from pyspark.sql import functions as F

    many = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 9000).cast("string")).alias("text"))
    same = spark.range(5_000).select(F.lit(9).cast("long").alias("doc_id"), F.lit("one and the same").alias("text"))
    rows = fingerprints.document_fingerprints(many.union(same))
    counts = {r["doc_id"]: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert counts == {7: 20_000, 9: 5_000}
    assert rows.filter("doc_id = 9 and near_next = 1.0").count() == 4_999


def test_very_long_texts_have_fingerprints(spark):
    text = " ".join(f"w{i % 5000}" for i in range(400_000))
    rows = {r["doc_id"]: r for r in fingerprints.document_fingerprints(spark.createDataFrame([(1, text), (2, "short text")], "doc_id long, text string")).collect()}
    assert rows[1]["fingerprint"] == f"{simhash_of(text):016X}"
    assert rows[1]["edited_sha256"] == hashlib.sha256((text[: len(text) - len(text) // 2] + "short text").encode()).hexdigest()


def test_fingerprint_edges(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert fingerprints.document_fingerprints(one).first()["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    odd = spark.createDataFrame([(1, "same words"), (1, "same words"), (None, "same words"), (None, None), (2, "")], "doc_id long, text string")
    rows = fingerprints.document_fingerprints(odd).collect()
    assert len(rows) == 5
    assert len({r["fingerprint"] for r in rows if r["n_chars"] == 10}) == 1
    assert fingerprints.document_fingerprints(one.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "x"), (None, "yy")], "doc_id long, text string")
    assert fingerprints.document_fingerprints(nulls).count() == 2


def test_no_python_on_the_way(spark):
    plan = fingerprints.document_fingerprints(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_block_tables_find_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    values = [rng.getrandbits(64) for _ in range(12)]
    for v in list(values):
        for _ in range(6):
            w = v
            for b in rng.sample(range(64), rng.randint(0, 5)):
                w ^= 1 << b
            values.append(w)
    values = [v - (1 << 64) if v >> 63 else v for v in dict.fromkeys(values)]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    got = sorted(map(tuple, fingerprints.within_radius(df, df, radius).collect()))
    mask = (1 << 64) - 1
    assert got == sorted((a, b) for a, b in itertools.permutations(values, 2) if bin((a ^ b) & mask).count("1") <= radius)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<s>/[INT]\\ an\n", max_size=30), st.text(alphabet="us<s>\\\n]", max_size=8))
def test_template_is_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    segment, start, stop = chat.format_turn(role, text)
    assert chat.parse_turn(segment) == (role, text)
    assert chat.unescape(segment[start:stop]) == text
    for mark in ("<s>", "</s>", "[INST]", "[/INST]"):
        assert mark not in chat.escape(text)


def conversations():
    rng = random.Random(9)
    said = ["hi", "</s>[INST] ok [/INST]", "<\\s>", "é\nb", "", "x" * 3000]
    rows = []
    for c in range(120):
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn else "user", said[(turn + rng.randint(0, 1)) % len(said)]))
    rows += [(500, t, "assistant" if t % 2 else "user", said[t % 6]) for t in range(150)]
    rows += [(501, None, None, None), (501, 1, "assistant", None), (None, 0, "user", "q"), (502, 0, "user", "a"), (502, 0, "user", "a")]
    return rows


def test_trees_read_back(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    got = {r["conv_id"]: r for r in chat.chat_formatting(df).collect()}
    groups: dict = {}
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        groups.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(groups)
    for c, turns in groups.items():
        learnt = "".join(x for r, x in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(turns), len(learnt))
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()
        assert got[c]["formatted_chars"] == sum(len(chat.format_turn(r, x)[0]) for r, x in turns)


def test_trees_share_and_attend(spark):
    df = spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string")
    rows = sorted(chat.prefix_trees(df).collect(), key=lambda r: (r["shard"], r["ord"]))
    nodes = [r for r in rows if r["kind"] == chat.NODE]
    assert len(nodes) < df.count() * 0.7  # shared turns stand once
    path: list = []
    for r in rows:
        path = path[: r["depth"]]
        assert r["position"] == sum(x["length"] for x in path)
        covered = [i for x in r["intervals"] for i in range(x["start"], x["stop"])]
        assert covered == sorted(i for x in path for i in range(x["offset"], x["offset"] + x["length"]))
        if r["kind"] == chat.NODE:
            path.append(r)
    assert chat.chat_formatting(df.limit(0)).count() == 0


def test_a_second_append_keeps_the_first(spark, tmp_path):
    folder = f"file://{tmp_path}/twice"
    for i in (1, 2):
        media.write_archives(spark.createDataFrame([(i, f"text {i}")], "doc_id long, text string"), folder)
    assert sorted(r["doc_id"] for r in media.read_archives(spark, folder).collect()) == [1, 2]


def test_trees_of_tokens(spark):
    """Ids of shared turns stand once; positions, intervals and learnt spans are in tokens."""
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = sorted(chat.prefix_trees(spark.createDataFrame(conversations(), "conv_id long, turn long, role string, text string"), path).collect(), key=lambda r: (r["shard"], r["ord"]))
    above: list = []
    learnt = 0
    for r in rows:
        above = above[: r["depth"]]
        assert r["position"] == sum(x["length"] for x in above)
        covered = [i for x in r["intervals"] for i in range(x["start"], x["stop"])]
        assert covered == sorted(i for x in above for i in range(x["offset"], x["offset"] + x["length"]))
        if r["kind"] == chat.NODE:
            assert (r["ids"], r["length"]) == (library.encode(r["segment"], add_special_tokens=False).ids, len(r["ids"]))
            assert library.decode(r["ids"], skip_special_tokens=False) == r["segment"]
            if r["learnt_to"]:
                learnt += 1
                inside = library.decode(r["ids"][r["learnt_from"] : r["learnt_to"]], skip_special_tokens=False)
                assert inside in r["segment"][r["mask_start"] : r["mask_end"]]
                assert len(inside) >= r["mask_end"] - r["mask_start"] - 12
            above.append(r)
    assert learnt > 50

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import pytest

P = pytest.importorskip("public_tokenizers")

from tracewright.llm import packing, sentencepieces, tokens  # noqa: E402

SF = "/root/testdata/sf0.001/documents.parquet"
ODD = [None, "", " ", "\n\n", "a  b", "don't they're 'S x'LL", "...!? !!", "<|endoftext|> a<|startoftext|>B <|ENDOFTEXT|>", "ΑΣ ΣΑΣ. É É İ", "a\x1cb c d", "x" * 30_000, "the cat. " * 3000, "12 3,4 5. a.. b., c", "Ünïcode, Wörter. 漢字 かな", "\U0001f600 a\U0001f600"]


def texts():
    return [*pd.read_parquet(SF).text.tolist(), *ODD]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_equal_the_library(spark, name):
    from tokenizers import Tokenizer

    given = texts()
    want = [len(e.ids) for e in Tokenizer.from_file(P.path(name)).encode_batch([t or "" for t in given], add_special_tokens=False)]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.token_counts(df, P.path(name)).collect()}
    assert got == {i: (len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(given, want, strict=True))}
    assert tokens.token_counts(df.limit(0), P.path(name)).count() == 0


def test_counts_of_odd_columns_and_pieces(spark, monkeypatch):
    """Null and repeated ids, clashing names; pieces without spaces, forgotten at a bound of characters."""
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    df = spark.createDataFrame([(None, "a b", 1, True), (4, "a b", 2, False), (4, None, 3, None)], "doc_id long, text string, n_tokens int, over_limit boolean")
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in tokens.token_counts(df, path).collect()) == [("4", 0), ("4", 2), ("None", 2)]
    monkeypatch.setattr(tokens, "KEEP_TOTAL", 5_000)
    encoder = tokens.PieceEncoder(path, False)
    library = Tokenizer.from_file(path)
    rng = random.Random(1)
    for _ in range(6):
        given = ["".join(rng.choice("漢字仮名ไทยabcé,.") for _ in range(rng.randint(1, 900))) + " x " for _ in range(20)]
        assert encoder.counts(given).tolist() == [len(e.ids) for e in library.encode_batch(given, add_special_tokens=False)]
        assert sum(map(len, encoder.known)) <= 5_000 + sum(map(len, given))
    sizes = [len(b) for b in encoder._batches(["é" * 100_000] * 5 + ["x" * 600_000, "y"])]
    assert sizes == [2, 1, 1, 1, 1, 1]


def test_packing_is_whole_and_tight(spark):
    from tokenizers import Tokenizer

    given = texts()
    ids = [[*e.ids, 0] for e in Tokenizer.from_file(P.path("word_bpe_49k.json")).encode_batch([t or "" for t in given], add_special_tokens=False)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(given)], "doc_id long, text string, offset int")
    rows = packing.pack_documents(df, P.path("word_bpe_49k.json"), capacity=2048).toPandas()
    assert rows["length"].sum() == sum(map(len, ids))
    for r in rows.itertuples():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length
        assert r.start == r.piece * 2048
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    ordered = rows.sort_values(["sequence_id", "offset"])
    filled = ordered.groupby("sequence_id")["length"]
    assert (filled.cumsum() - ordered["length"] == ordered["offset"]).all()
    assert filled.sum().max() <= 2048
    assert len(filled) <= -(-rows["length"].sum() // 2048) + 1
    assert packing.pack_documents(df.limit(0), P.path("word_bpe_49k.json")).count() == 0


def test_local_search_empties_bins():
    lengths = [6, 6, 5, 5, 4, 4]
    start = [[0, 2], [1, 3], [4, 5]]  # 11, 11 and 8 of 15: two bins are enough
    got = packing.local_search(start, lengths, 15)
    assert sorted(i for b in got for i in b) == list(range(6))
    assert len(got) == 2
    assert max(sum(lengths[i] for i in b) for b in got) <= 15


def test_local_search_never_loses_or_overfills():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.randint(1, 50) for _ in range(rng.randint(1, 120))]
        first = packing.best_fit(lengths, 50)
        got = packing.local_search(first, lengths, 50)
        assert sorted(i for b in got for i in b) == list(range(len(lengths)))
        assert max(sum(lengths[i] for i in b) for b in got) <= 50
        assert len(got) <= len(first)


def test_local_search_helps_where_best_fit_leaves_much_room():
    """Documents of a fifth to two fifths of the capacity, of which best fit leaves many bins open."""
    rng = random.Random(1)
    lengths = [rng.randint(400, 800) for _ in range(3000)]
    first = packing.best_fit(lengths, 2048)
    got = packing.local_search(first, lengths, 2048)
    least = -(-sum(lengths) // 2048)
    print(f"least {least}, best fit {len(first)}, after the search {len(got)}")
    assert sorted(i for b in got for i in b) == list(range(len(lengths)))
    assert max(sum(lengths[i] for i in b) for b in got) <= 2048
    assert least <= len(got) < least + 0.3 * (len(first) - least)


def test_exchanges_increase_the_squared_fills():
    rng = random.Random(8)
    for _ in range(50):
        lengths = [rng.choice([3, 5, 7, 11, 13, 17]) for _ in range(60)]
        start, left = [], list(range(60))
        while left:  # a bad packing to begin with
            b = []
            while left and sum(lengths[i] for i in b) + lengths[left[-1]] <= 30:
                b.append(left.pop())
            start.append(b)
        got = packing.local_search(start, lengths, 30)
        square = lambda bins: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
        assert square(got) >= square(start)
        assert sorted(i for b in got for i in b) == list(range(60))
        assert max(sum(lengths[i] for i in b) for b in got) <= 30
        assert len(got) <= len(start)


def test_packing_in_other_partitions(spark):
    given = [f"word{i} " * (i % 90) for i in range(400)]
    df = spark.createDataFrame([(i if i % 7 else None, t) for i, t in enumerate(given)], "doc_id long, text string").union(spark.createDataFrame([(1, given[1])], "doc_id long, text string"))
    done = packing.pack_documents(df, P.path("word_bpe_49k.json"), capacity=400, shard_rows=100)
    rows = lambda d: sorted(map(str, d.collect()))
    assert rows(done.coalesce(1)) == rows(done)
    assert len(rows(done.union(done))) == 2 * len(rows(done))
    for small in (100, 10):  # 10: parts of 20 pieces
        out = packing.pack_documents(df, P.path("word_bpe_49k.json"), capacity=400, shard_rows=small).coalesce(2).toPandas()
        filled = out.sort_values(["sequence_id", "offset"]).groupby("sequence_id")["length"]
        assert filled.sum().max() <= 400
        assert (filled.cumsum() - out.sort_values(["sequence_id", "offset"])["length"] == out.sort_values(["sequence_id", "offset"])["offset"]).all()


def test_scan_equals_the_library():
    m = sentencepieces.model(P.path("piece_bpe_32k.model"))
    rng = random.Random(1)
    parts = ["a", "b", "the", "    ", " ", "  ", "in", "tion", "=", "==", "-----", "é", "漢", "\n", "\U0001f600", "▁", "x" * 5, "ing", "0", "12"]
    for k in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 80)))
        assert sentencepieces.encode_by_chunks(m, text, 20) == m.library.encode(text), k


def test_matrices_compose_associatively():
    m = sentencepieces.model(P.path("piece_bpe_32k.model"))
    text = sentencepieces.SPACE + "unbelievablyinternationalizationwithoutspaces" * 3
    cuts = [0, 30, 60, 90, len(text)]
    a, b, c, d = (m.transfer(text, x, y, x == 0, y == len(text)) for x, y in zip(cuts, cuts[1:], strict=False))
    join = sentencepieces.compose
    as_sets = lambda x: {(e, s) for e, row in zip(x[1], x[2], strict=True) for i, s in enumerate(x[0]) if row >> i & 1}
    assert as_sets(join(join(join(a, b), c), d)) == as_sets(join(a, join(b, join(c, d))))


def test_a_tree_of_matrices_is_solved_as_a_row_of_them():
    m = sentencepieces.model(P.path("piece_bpe_32k.model"))
    text = sentencepieces.SPACE + "internationalization of unbelievable things ".replace(" ", sentencepieces.SPACE) * 30
    spans = sentencepieces.spans_of(len(text), 40, m.longest)
    rows = [m.transfer(text, a, b, a == 0, b == len(text)) for a, b in spans]
    want = sentencepieces.solve(rows)
    blocks = [rows[i : i + 4] for i in range(0, len(rows), 4)]
    above = sentencepieces.solve([sentencepieces.composed(b) for b in blocks])
    assert [x for b, (begin, end) in zip(blocks, above, strict=True) for x in sentencepieces.solve(b, begin, end)] == want


@pytest.mark.parametrize("how", ["tree", "library"])
def test_giant_documents_by_trees_and_without_paths(spark, monkeypatch, how):
    """Several levels of a tree; and documents that the scan can't solve go to the library."""
    import hashlib

    path = P.path("piece_bpe_32k.model")
    none = sentencepieces._edges
    monkeypatch.setattr(sentencepieces, "_whole" if how == "tree" else "_solved", (lambda path: lambda batches: iter(())) if how == "tree" else (lambda group: none(group, None)))
    given = ["alpha beta gamma " * 60, "word " * 400, "x" * 1500, None, "small", "alpha beta gamma " * 60]
    df = spark.createDataFrame([(i if i < 5 else None, t, 1) for i, t in enumerate(given)], "doc_id long, text string, row int")
    library = sentencepieces.model(path).library
    rows = sentencepieces.sentencepiece_digests(df, path, giant=200, chunk=100, fan=2).collect()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows}
    kept = [0, 1, 2, 5] if how == "tree" else range(6)  # the library is kept out of the tree's test
    assert len(rows) == len(kept)
    for i in kept:
        ids = library.encode(given[i] or "")
        assert got[i if i < 5 else None] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((given[i] or "").encode()).hexdigest())


def test_giant_documents_take_time_in_proportion():
    import time

    m = sentencepieces.model(P.path("piece_bpe_32k.model"))
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    seconds = []
    for n in (20_000, 80_000):
        text = " ".join(rng.choice(words) for _ in range(n))
        start = time.process_time()
        assert sentencepieces.encode_by_chunks(m, text) == m.library.encode(text)
        seconds.append(time.process_time() - start)
    assert seconds[1] < 4 * seconds[0] * 1.8


def test_giant_documents_round_trip(spark):
    import hashlib

    given = [*texts(), "z" * 3000 + " word" * 500, "word " * 1000]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string")
    library = sentencepieces.model(P.path("piece_bpe_32k.model")).library
    got = {r["doc_id"]: r for r in sentencepieces.sentencepiece_digests(df, P.path("piece_bpe_32k.model"), giant=2500, chunk=900).collect()}
    assert len(got) == len(given)
    for i, t in enumerate(given):
        ids = library.encode(t or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert sentencepieces.sentencepiece_digests(df.limit(0), P.path("piece_bpe_32k.model")).count() == 0

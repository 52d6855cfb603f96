from __future__ import annotations

import random
import pytest
from pyspark.sql import functions as F

from tracewright.functions import jsonx
from tracewright.functions.textnorm import DEFAULT, LEGACY, FirstConfig, MatchConfig, normalize, normalize_diagnostic, normalize_first


def normalized(spark, texts, config=DEFAULT):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", normalize(F.col("t"), config)).collect())]


def test_width_punctuation_and_ends(spark):
    given = ["ＡＢＣａｂｃ", "０１２", "　x　", "￥１００", "【a】《b》", "a、b。c", "x…", "a — b", "LAU, LAI", "x : 100", "J　S", None, ""]
    assert normalized(spark, given) == ["ABCabc", "012", "x", "¥100", "[a]<b>", "a,b.c", "x...", "a-b", "LAU,LAI", "x:100", "J S", None, ""]


def test_default_keeps_meaning(spark):
    for a, b in [("Ab", "ab"), ("¥5", "5"), ("a b", "ab"), ("5.83", "5.830"), ("1,000", "1000"), ("™", "TM")]:
        x, y = normalized(spark, [a, b])
        assert x != y


def test_unicode_space_and_separators(spark):
    assert normalized(spark, [" \x1cx ", "a ,\x1fb"]) == ["x", "a,b"]


def test_lenient_switches(spark):
    assert normalized(spark, ["A  B", "1,234,567", "€5", "£5 ,x"], LEGACY) == ["a b", "1234567", "EUR5", "GBP5 ,x"]
    assert normalized(spark, ["A B"], MatchConfig(lower_case=True)) == ["a b"]
    assert normalized(spark, ["1,2"], DEFAULT.but(plain_numbers=True)) == ["12"]


def test_first_generation(spark):
    df = spark.createDataFrame([("Ａ（１）  ￥1,000 €",)], "t string")
    assert df.select(normalize_first(F.col("t"))).first()[0] == "a(1) ¥1000 EUR"
    assert df.select(normalize_first(F.col("t"), FirstConfig(case_insensitive=False, normalize_numbers=False))).first()[0] == "A(1) ¥1,000 EUR"
    assert spark.createDataFrame([("¥ a(b), c",)], "t string").select(normalize_diagnostic(F.col("t"))).first()[0] == "a（b），c"


CASES = [
    ('{"a": 1}', '{"a": 1}'),
    ('  {"a": 1}\n', '{"a": 1}'),
    ("[1, 2]", None),
    ("5", None),
    ('text ```json\n{"a": 1}\n``` end', '{"a": 1}'),
    ('text ```\n{"a": {"b": 2}}\n```', '{"a": {"b": 2}}'),
    ('say {"a": {"b": [1]}} now', '{"a": {"b": [1]}}'),
    ('x {"a": "}{"} y', '{"a": "}{"}'),
    ('x {"a": "q\\"}"} y', '{"a": "q\\"}"}'),
    ('x {bad} {"a": 1}', '{"a": 1}'),
    ("", None),
    (None, None),
    ("no object", None),
    ('{"a": 1', None),
    ("{'a': 'b', 'c': True, 'd': None}", '{"a": "b", "c": true, "d": null}'),
    ("it is {'a': {'b': \"c\"}}.", '{"a": {"b": "c"}}'),
    ('{"b": 1, "a": 1.50, "b": 2}', '{"b": 2, "a": 1.5}'),
    ('{ {"a": 1}', '{"a": 1}'),
    ('```json\nnothing``` later {"a": 3}', '{"a": 3}'),
]


def test_extract_json(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = [r[1] for r in sorted(df.select("i", jsonx.extract_json(F.col("t"))).collect(), key=lambda r: r[0])]
    assert got == [e for _, e in CASES]


def test_span_counts_code_points(spark):
    df = spark.createDataFrame([("é\U0001f600 {'a': 1} z",)], "t string").select(jsonx.json_span(F.col("t")).alias("s"), "t")
    row = df.select("s.start", "s.stop", F.expr("substring(t, s.start + 1, s.stop - s.start)")).first()
    assert tuple(row) == (3, 11, "{'a': 1}")


def test_flatten_and_pretty(spark):
    text = '{"a": {"b": [1, {"c": null}]}, "e": [], "f": {}, "a.b[0]": "x", "t": true, "d": 5.0, "": "r"}'
    df = spark.createDataFrame([(text,), ("[1]",), (None,)], "t string")
    rows = [r[0] for r in df.select(jsonx.flatten_json(F.col("t"))).collect()]
    assert {r["path"]: (r["kind"], r["pystr"]) for r in rows[0]} == {"a.b[0]": ("str", "x"), "a.b[1].c": ("null", "None"), "t": ("bool", "True"), "d": ("num", "5.0"), "": ("str", "r")}
    assert rows[1:] == [None, None]
    assert df.select(jsonx.pretty_json(F.lit('{"b":[1,"é"],"a":{}}'))).first()[0] == '{\n  "b": [\n    1,\n    "é"\n  ],\n  "a": {}\n}'


@pytest.mark.parametrize(("text", "found"), [("```json\n{'a': 1}\n```", '{"a": 1}'), ("[1]", "[1]"), ("x {'a': 'b', 'c': 'd'} y", '{"a": "b", "c": "d"}'), ("nothing", None)])
def test_first_generation_parser(spark, text, found):
    assert spark.createDataFrame([(text,)], "t string").select(jsonx.extract_json_first(F.col("t"))).first()[0] == found


def test_braces_are_scanned_once():
    import time

    from tracewright.functions.jsonx import Braces, balanced_end, locate

    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice('{}{}"\\a ') for _ in range(rng.randint(1, 40)))
        braces = Braces(text)
        starts = [i for i, c in enumerate(text) if c == "{"]
        rng.shuffle(starts)
        assert [braces.end(i) for i in starts] == [balanced_end(text, i) for i in starts]
    seconds = []
    for n in (20_000, 80_000):
        start = time.process_time()
        assert locate("{ " * n + '{"a": 1}')[2] == {"a": 1}
        seconds.append(time.process_time() - start)
    assert seconds[1] < 4 * seconds[0] * 4 + 0.5

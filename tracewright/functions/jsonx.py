"""JSON objects in free text: Arrow functions for what no built-in expression can parse.

Built-in JSON functions reorder keys, accept trailing text or single quotes, and treat equal
keys differently, so objects stay raw JSON text here, in source order, the last of equal keys.
"""

from __future__ import annotations

import ast
import json
import re
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FENCE = re.compile(r"```(?:json)?\s*", re.IGNORECASE)
_TOKEN = re.compile(r'"(?:\\.|[^"\\])*(?P<closed>")?|[{}]', re.DOTALL)
#: Types as objects: workers import this module and can't parse type strings.
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
LEAF = T.StructType([T.StructField(n, T.DoubleType() if n == "num" else T.StringType()) for n in ("path", "kind", "s", "num", "pystr")])
LEAVES = T.ArrayType(LEAF)


class Braces:
    """Where the objects of a text end; quoted braces don't count.

    A scan from one brace tells the ends of all others that it meets outside quotes, so a text
    is scanned once for each way its quotes can pair, not once a brace.
    """

    def __init__(self, text: str):
        self.text = text
        self.ends: dict[int, int | None] = {}

    def end(self, start: int) -> int | None:
        """The place behind the brace that closes the one at `start`."""
        if start not in self.ends:
            open_: list[int] = []
            for token in _TOKEN.finditer(self.text, start):
                mark = token[0]
                if mark == "{":
                    open_.append(token.start())
                elif mark == "}":
                    self.ends[open_.pop()] = token.end()
                    if not open_:
                        break
                elif not token["closed"]:
                    break
            self.ends.update(dict.fromkeys(open_))
        return self.ends[start]


def balanced_end(text: str, start: int) -> int | None:
    return Braces(text).end(start)


def strict_object(text: str) -> dict | None:
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def literal_object(text: str) -> dict | None:
    """A Python literal that is a dict: single quotes, True, None."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            value = ast.literal_eval(text)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def any_object(text: str) -> dict | None:
    found = strict_object(text)
    return literal_object(text) if found is None else found


def _candidates(text: str) -> Iterator[tuple[int, int, Callable[[str], dict | None]]]:
    """Places to try in order of preference, with the parser for each."""
    core = text.strip()
    lead = len(text) - len(text.lstrip())
    yield lead, lead + len(core), any_object
    braces = Braces(text)
    for fence in _FENCE.finditer(text):
        brace = text.find("{", fence.end())
        end = braces.end(brace) if brace >= 0 else None
        if end is not None:
            yield brace, end, strict_object
    brace = text.find("{")
    while brace >= 0:
        end = braces.end(brace)
        if end is not None:
            yield brace, end, any_object
        brace = text.find("{", brace + 1 if end is None else end)


def locate(text: str | None) -> tuple[int, int, dict] | None:
    """Start, end and value of the first object: the whole text, else in a fenced block, else
    anywhere. A balanced part that can't be parsed is skipped as a whole."""
    text = text if isinstance(text, str) else ""
    for start, end, parse in _candidates(text):
        value = parse(text[start:end])
        if value is not None:
            return start, end, value
    return None


def dump(value: object) -> str:
    """Compact JSON text in key order; values that JSON lacks become their text."""
    return json.dumps(value, ensure_ascii=False, default=str)


def leaf(value: object) -> tuple[str, str | None, float | None, str]:
    """(kind, text, number, text as Python prints it) of a leaf."""
    if value is None:
        return "null", None, None, "None"
    if isinstance(value, bool):
        return "bool", str(value).lower(), float(value), str(value)
    if isinstance(value, (int, float)):
        try:
            number = float(value)
        except OverflowError:
            number = float("inf") if value > 0 else float("-inf")
        exact = isinstance(value, int) or value.is_integer()
        return "num", str(int(value)) if exact and abs(number) != float("inf") else repr(value), number, str(value)
    if isinstance(value, str):
        return "str", value, None, value
    return "other", repr(value), None, str(value)


def leaves(value: object) -> dict[str, object]:
    """Leaf values by path, a.b[0].c; later ones win; empty containers have none."""
    found: dict[str, object] = {}
    todo: list[tuple[str, object]] = [("", value)]
    while todo:
        path, item = todo.pop()
        if isinstance(item, dict):
            todo += [(f"{path}.{k}" if path else str(k), v) for k, v in reversed(item.items())]
        elif isinstance(item, list):
            todo += [(f"{path}[{i}]", v) for i, v in reversed(list(enumerate(item)))]
        else:
            found[path] = item
    return found


@F.pandas_udf(T.StringType())
def extract_json(texts: pd.Series) -> pd.Series:
    """The first object of a text as JSON text; null without one."""
    return pd.Series([dump(found[2]) if (found := locate(t)) else None for t in texts], dtype=object)


@F.pandas_udf(SPAN)
def json_span(texts: pd.Series) -> pd.DataFrame:
    """Where the first object stands, in code points from 0; nulls without one."""
    found = [locate(t) for t in texts]
    return pd.DataFrame({"start": pd.Series([f[0] if f else None for f in found], dtype="Int32"), "stop": pd.Series([f[1] if f else None for f in found], dtype="Int32")})


@F.pandas_udf(LEAVES)
def flatten_json(texts: pd.Series) -> pd.Series:
    """Leaves of an object's JSON text, each path once, paths in order; null if it is none."""

    def rows(text: str | None) -> list[dict] | None:
        value = strict_object(text) if isinstance(text, str) else None
        if value is None:
            return None
        return [dict(zip(("path", "kind", "s", "num", "pystr"), (p, *leaf(v)), strict=True)) for p, v in sorted(leaves(value).items())]

    return pd.Series([rows(t) for t in texts], dtype=object)


@F.pandas_udf(LEAVES)
def top_level_json(texts: pd.Series) -> pd.Series:
    """An object's own keys as leaves, in order; nested values as Python prints them, of kind
    other. Null if the text is no object."""

    def rows(text: str | None) -> list[dict] | None:
        value = strict_object(text) if isinstance(text, str) else None
        if value is None:
            return None
        return [dict(zip(("path", "kind", "s", "num", "pystr"), (k, *leaf(v)), strict=True)) for k, v in sorted(value.items())]

    return pd.Series([rows(t) for t in texts], dtype=object)


@F.pandas_udf(T.StringType())
def pretty_json(texts: pd.Series) -> pd.Series:
    """An object's JSON text with two spaces a level, in key order; null if it is none."""
    found = [strict_object(t) if isinstance(t, str) else None for t in texts]
    return pd.Series([None if f is None else json.dumps(f, ensure_ascii=False, indent=2) for f in found], dtype=object)


VERDICTS = T.StructType([T.StructField("raw", T.StringType()), T.StructField("items", T.ArrayType(T.StructType([T.StructField("field", T.StringType()), T.StructField("match", T.BooleanType())])))])
REWRITE = T.StructType([T.StructField("cot", T.StringType()), T.StructField("answer", T.StringType())])


@F.pandas_udf(VERDICTS)
def verdicts_in(texts: pd.Series) -> pd.DataFrame:
    """The list `verdicts` of a text's first object: as JSON text, and its objects' fields with
    whether their match is the JSON value true. Other elements are passed over; nulls without a list."""
    raw, items = [], []
    for t in texts:
        found = locate(t)
        listed = found[2].get("verdicts") if found else None
        ok = isinstance(listed, list)
        raw.append(dump(listed) if ok else None)
        items.append([{"field": v["field"] if isinstance(v["field"], str) else None, "match": v.get("match") is True} for v in listed if isinstance(v, dict) and "field" in v] if ok else None)
    return pd.DataFrame({"raw": pd.Series(raw, dtype=object), "items": pd.Series(items, dtype=object)})


@F.pandas_udf(REWRITE)
def rewrite_in(texts: pd.Series) -> pd.DataFrame:
    """The text `cot`, stripped, and the object `answer` of a text's first object; nulls if
    either is missing or of another kind."""
    found = [(f[2].get("cot"), f[2].get("answer")) if (f := locate(t)) else (None, None) for t in texts]
    good = [(c.strip(), dump(a)) if isinstance(c, str) and isinstance(a, dict) else (None, None) for c, a in found]
    return pd.DataFrame({"cot": pd.Series([c for c, _ in good], dtype=object), "answer": pd.Series([a for _, a in good], dtype=object)})


def indented(value: object, before: str = "\n") -> str:
    """json.dumps(value, ensure_ascii=False, indent=2) of what json.loads gave, by the compiled encoder."""
    if isinstance(value, str):
        return json.encoder.encode_basestring(value)
    if isinstance(value, (dict, list)) and value:
        inner = f"{before}  "
        if isinstance(value, dict):
            parts = [f"{json.encoder.encode_basestring(k)}: {indented(v, inner)}" for k, v in value.items()]
            return f"{{{inner}{f',{inner}'.join(parts)}{before}}}"
        return f"[{inner}{f',{inner}'.join([indented(v, inner) for v in value])}{before}]"
    return json.dumps(value)


def nested_json(columns: tuple[str, ...]):  # noqa: ANN201
    """A function of rows' JSON text that puts the values of some columns, kept as JSON text, in
    its place: `a` or, in a nested object, `a.b`. Two spaces a level."""
    paths = [c.split(".") for c in columns]

    @F.pandas_udf(T.StringType())
    def nest(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            if text is None:
                return None
            row = json.loads(text)
            for *above, name in paths:
                holder = row
                for part in above:
                    holder = holder.get(part) if isinstance(holder, dict) else None
                if isinstance(holder, dict) and isinstance(holder.get(name), str):
                    try:
                        holder[name] = json.loads(holder[name])
                    except ValueError:
                        continue
            return indented(row)

        return pd.Series([one(t) for t in texts], dtype=object)

    return nest


# How the first generation found and repaired quoted keys and values.
_FIRST_OUTER = re.compile(r"\{.*\}", re.DOTALL)
_FIRST_KEY = (re.compile(r"'([^'\\\"]+)'\s*:\s*"), r'"\1": ')
_FIRST_VALUE = (re.compile(r":\s*'([^']*?)'\s*([,}])"), r': "\1"\2')


@F.pandas_udf(T.StringType())
def extract_json_first(texts: pd.Series) -> pd.Series:
    """As the first generation parsed: fences off, JSON of any type, a literal dict, else the
    outermost braces with their quotes repaired. JSON text; null if nothing parses."""

    def parse(text: str | None) -> object:
        text = text.strip() if isinstance(text, str) else ""
        if text.startswith("```"):
            text = re.sub(r"\s*```$", "", re.sub(r"^```(?:json)?\s*", "", text)).strip()
        outer = _FIRST_OUTER.search(text)
        repaired = _FIRST_VALUE[0].sub(_FIRST_VALUE[1], _FIRST_KEY[0].sub(_FIRST_KEY[1], outer[0])) if outer else ""
        for attempt in (lambda: json.loads(text), lambda: literal_object(text), lambda: json.loads(repaired)):
            try:
                found = attempt()
            except ValueError:
                continue
            if found is not None:
                return found
        return None

    found = [parse(t) for t in texts]
    return pd.Series([None if f is None else dump(f) for f in found], dtype=object)


def strip_fences(c: Column) -> Column:
    """Without code fence marks; what they enclose stays."""
    return F.regexp_replace(c, r"```[A-Za-z]*(?U:\s*)", "")

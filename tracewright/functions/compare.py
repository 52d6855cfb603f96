"""Field by field comparison of two objects, row-local: leaves meet by path without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textnorm import DEFAULT, FirstConfig, MatchConfig, normalize, normalize_diagnostic, normalize_first

# Names of levels.
STRICT, NORMALIZED, MISMATCH = "STRICT", "NORMALIZED", "MISMATCH"
MISSING_IN_PRED, MISSING_IN_GT = "KEY_MISSING_IN_PRED", "KEY_MISSING_IN_GT"
NORMALIZED_MATCH, STRICT_MATCH = "NORMALIZED_MATCH", "STRICT_MATCH"
PARTIAL_SCORE = 0.95
#: Doubles below this hold every integer.
EXACT = float(1 << 53)


def leaf_level(p: Column, g: Column, config: MatchConfig = DEFAULT) -> Column:
    """The level of two present leaves (path, kind, s, num, pystr)."""
    kinds = lambda *k: p["kind"].isin(*k) & g["kind"].isin(*k)
    number = (p["num"] == g["num"]) & ((F.abs(p["num"]) < EXACT) | (p["s"] == g["s"]))
    same = (p["kind"] == g["kind"]) & (p["s"].eqNullSafe(g["s"]))
    if config.any_type:
        raw = F.when(kinds("num", "bool"), number).otherwise(same)
        text = lambda x: F.when(x["kind"] == "str", normalize(x["s"], config)).otherwise(x["pystr"])
        close = text(p) == text(g)
    else:
        raw = F.when(kinds("num"), number).otherwise(same)
        close = kinds("str") & (normalize(p["s"], config) == normalize(g["s"], config))
    return F.when(raw, STRICT).when(close, NORMALIZED).otherwise(MISMATCH)


def _once(value: Column, use) -> Column:  # noqa: ANN001
    """`use` of a value that is computed once, however often it is used, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def joined(pred: Column, gt: Column) -> Column:
    """array<struct<path, p, g>> of two sides' leaves by path; a side that lacks one is null.

    Both sides are sorted together, a predicted leaf before the other one of its path, and
    neighbours meet: no lookups, so wide objects cost no more a leaf than narrow ones.
    """
    side = lambda c, n: F.transform(c, lambda x: F.struct(x["path"].alias("path"), F.lit(n).alias("side"), x.alias("leaf")))

    def meet(rows: Column) -> Column:
        alike = lambda x, i: F.coalesce(F.get(rows, i)["path"] == x["path"], F.lit(False))
        pairs = F.transform(
            rows,
            lambda x, i: F.struct(
                x["path"].alias("path"),
                F.when(x["side"] == 0, x["leaf"]).alias("p"),
                F.when(x["side"] == 1, x["leaf"]).when(alike(x, i + 1), F.get(rows, i + 1)["leaf"]).alias("g"),
                ((x["side"] == 1) & alike(x, i - 1)).alias("met"),
            ),
        )
        return F.filter(pairs, lambda x: ~x["met"])

    return _once(F.sort_array(F.concat(side(pred, 0), side(gt, 1))), meet)


def field_verdicts(pred: Column, gt: Column, config: MatchConfig = DEFAULT) -> Column:
    """array<struct<field, level, pred_value, gt_value, gt_normalized, pred_normalized>> by path.

    Both sides are arrays of leaves as flatten_json gives them; values are as Python prints
    them. Null for a null side.
    """
    if config.drop_empty:
        pred = F.filter(pred, lambda x: (x["kind"] != "null") & ~((x["kind"] == "str") & (x["s"] == "")))
    shown = lambda x: F.when(x["kind"] == "str", normalize(x["s"], config)).otherwise(x["pystr"])
    level = lambda x: F.when(x["p"].isNull(), MISSING_IN_PRED).when(x["g"].isNull(), MISSING_IN_GT).otherwise(leaf_level(x["p"], x["g"], config))

    def verdict(x: Column) -> Column:
        differs = x["level"] == MISMATCH
        return F.struct(
            x["pair"]["path"].alias("field"),
            x["level"].alias("level"),
            x["pair"]["p"]["pystr"].alias("pred_value"),
            x["pair"]["g"]["pystr"].alias("gt_value"),
            F.when(differs, shown(x["pair"]["g"])).alias("gt_normalized"),
            F.when(differs, shown(x["pair"]["p"])).alias("pred_normalized"),
        )

    levels = F.transform(joined(pred, gt), lambda x: F.struct(x.alias("pair"), level(x).alias("level")))
    return F.transform(levels, verdict)


def _count(fields: Column, *levels: str) -> Column:
    return F.size(F.filter(fields, lambda f: f["level"].isin(*levels))).cast("long")


def sample_level(fields: Column) -> Column:
    """All strict, or nothing to compare: STRICT; nothing wrong: NORMALIZED_MATCH; else MISMATCH."""
    bad = F.exists(fields, lambda f: ~f["level"].isin(STRICT, NORMALIZED))
    return F.when(F.forall(fields, lambda f: f["level"] == STRICT), STRICT).when(bad, MISMATCH).otherwise(NORMALIZED_MATCH)


def is_accepted(level: Column) -> Column:
    return level.isin(STRICT, NORMALIZED_MATCH)


def score(matched: Column, mismatched: Column, missing: Column) -> Column:
    """Missing and extra fields don't lower it, unless nothing else is left."""
    return F.when(matched + mismatched > 0, matched / (matched + mismatched)).when(missing == 0, 1.0).otherwise(0.0)


def differences(fields: Column) -> Column:
    """array<struct<field, type, ground_truth, predicted, gt_normalized, pred_normalized>>."""
    kind = lambda f: F.when(f["level"] == MISMATCH, "mismatch").when(f["level"] == MISSING_IN_PRED, "missing").otherwise("extra")
    wrong = F.filter(fields, lambda f: ~f["level"].isin(STRICT, NORMALIZED))
    return F.transform(wrong, lambda f: F.struct(f["field"].alias("field"), kind(f).alias("type"), f["gt_value"].alias("ground_truth"), f["pred_value"].alias("predicted"), f["gt_normalized"].alias("gt_normalized"), f["pred_normalized"].alias("pred_normalized")))


def comparison(fields: Column, gt: Column) -> Column:
    """The whole verdict: the first generation's ten keys, and four diagnostic ones."""
    matched, mismatched = _count(fields, STRICT, NORMALIZED), _count(fields, MISMATCH)
    missing, extra = _count(fields, MISSING_IN_PRED), _count(fields, MISSING_IN_GT)
    level = sample_level(fields)
    value = score(matched, mismatched, missing)
    return F.struct(
        is_accepted(level).alias("is_match"),
        value.alias("match_score"),
        (~is_accepted(level) & (value >= PARTIAL_SCORE)).alias("is_partial"),
        F.size(gt).cast("long").alias("total_fields"),
        matched.alias("matched_fields"),
        mismatched.alias("mismatched_fields"),
        extra.alias("extra_fields"),
        missing.alias("missing_fields"),
        differences(fields).alias("differences"),
        F.lit(None).cast("string").alias("error"),
        level.alias("match_level"),
        matched.alias("matched_field_count"),
        F.size(fields).cast("long").alias("total_field_count"),
        fields.alias("fields"),
    )


def rank(level: Column) -> Column:
    return F.when(level == STRICT, 2).when(level == NORMALIZED_MATCH, 1).otherwise(0)


def long_form(df: DataFrame, key: str, pred: str, gt: str, config: MatchConfig = DEFAULT) -> DataFrame:
    """(key, field, level, pred_value, gt_value): a row a field, by a full outer join on paths.

    For analytics over many wide objects; gives what field_verdicts gives.
    """
    side = lambda c, x: df.select(key, F.explode(c).alias(x)).withColumn("field", F.col(f"{x}.path"))
    p, g = side(pred, "p"), side(gt, "g")
    if config.drop_empty:
        p = p.filter("p.kind <> 'null' and not (p.kind = 'str' and p.s = '')")
    level = F.when(F.col("p").isNull(), MISSING_IN_PRED).when(F.col("g").isNull(), MISSING_IN_GT).otherwise(leaf_level(F.col("p"), F.col("g"), config))
    return p.join(g, [key, "field"], "full_outer").select(key, "field", level.alias("level"), F.col("p.pystr").alias("pred_value"), F.col("g.pystr").alias("gt_value"))


# --- the first generation's comparators; both see top-level keys alone ---


def compare_first(pred: Column, gt: Column, config: FirstConfig | None = None) -> Column:
    """The first acceptance comparator over arrays that top_level_json gives; missing counts twice.

    Null sides, which didn't parse, give an error and nothing else.
    """
    on = config or FirstConfig()
    text = lambda x: F.when(x["kind"] == "str", normalize_first(x["s"], on)).otherwise(x["pystr"])
    if on.trim_empty_fields:
        pred_kept = F.filter(pred, lambda x: (x["kind"] != "null") & ~((x["kind"] == "str") & (text(x) == "")))
    else:
        pred_kept = pred
    pairs = joined(pred_kept, gt)
    count = lambda test: F.size(F.filter(pairs, test)).cast("long")
    both = lambda x: x["p"].isNotNull() & x["g"].isNotNull()
    equal = count(lambda x: both(x) & (text(x["p"]) == text(x["g"])))
    mismatched = count(both) - equal
    missing = F.lit(2) * count(lambda x: x["p"].isNull())
    extra = count(lambda x: x["g"].isNull())
    value = score(equal, mismatched, missing)
    match = (mismatched == 0) & (missing == 0) & (extra == 0)
    partial = ~match & (value >= on.partial_match_threshold) if on.report_partial_match else F.lit(False)
    failed = F.when(pred.isNull(), "prediction can't be parsed").when(gt.isNull(), "ground truth can't be parsed")
    ok = failed.isNull()
    zero = lambda c: F.when(ok, c).otherwise(F.lit(0).cast("long"))
    return F.struct(
        F.coalesce(ok & match, F.lit(False)).alias("is_match"),
        F.when(ok, value).otherwise(0.0).alias("match_score"),
        F.coalesce(ok & partial, F.lit(False)).alias("is_partial"),
        zero(F.size(gt).cast("long")).alias("total_fields"),
        zero(equal).alias("matched_fields"),
        zero(mismatched).alias("mismatched_fields"),
        zero(extra).alias("extra_fields"),
        zero(missing).alias("missing_fields"),
        failed.alias("error"),
    )


def classify_first(pred: Column, gt: Column) -> Column:
    """struct<match_level, match_score> of the first diagnostic matcher over whole objects."""
    shown = lambda c: F.array_sort(F.transform(c, lambda x: F.struct(x["path"], normalize_diagnostic(x["pystr"]))))
    raw = lambda c: F.array_sort(F.transform(c, lambda x: F.struct(x["path"], F.when(x["kind"] == "bool", "num").otherwise(x["kind"]), F.coalesce(x["num"].cast("string"), x["s"]))))
    level = F.when(raw(pred) == raw(gt), STRICT_MATCH).when(shown(pred) == shown(gt), NORMALIZED_MATCH).otherwise(MISMATCH)
    return F.struct(level.alias("match_level"), F.when(level == STRICT_MATCH, 1.0).when(level == NORMALIZED_MATCH, 0.8).otherwise(0.0).alias("match_score"))


def difference_report(diffs: Column) -> Column:
    """A line a difference: type, field, and both values."""
    return F.array_join(F.transform(diffs, lambda d: F.concat_ws(" ", d["type"], d["field"], F.concat(F.coalesce(d["ground_truth"], F.lit("-")), F.lit(" <> "), F.coalesce(d["predicted"], F.lit("-"))))), "\n")

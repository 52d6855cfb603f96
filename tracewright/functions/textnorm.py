"""Text normalisation as column expressions: width, case, spaces, currency, punctuation, numbers."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and what they become. Full-width ASCII follows a rule instead.
FULLWIDTH_FIRST, FULLWIDTH_LAST, FULLWIDTH_SHIFT = 0xFF01, 0xFF5E, 0xFEE0
SPACE_AND_CURRENCY = {"　": " ", "￥": "¥", "￡": "£"}
PUNCTUATION = {
    "，": ",", "：": ":", "；": ";", "？": "?", "！": "!",
    "（": "(", "）": ")", "【": "[", "】": "]",
    "“": '"', "”": '"', "‘": "'", "’": "'",
    "、": ",", "。": ".", "—": "-", "·": ".",
    "《": "<", "》": ">", "／": "/",
}
ELLIPSIS = ("…", "...")
CURRENCY_NAMES = {"€": "EUR", "£": "GBP"}
TIGHT_PUNCTUATION = r",.:;?!()\[\]\"'/\-"
# Unicode white space; the four separators at the end are not in Java's class.
SPACE = r"[\s\x1c-\x1f]"


@dataclass(frozen=True)
class MatchConfig:
    """Switches of normalisation and comparison; the default is strict about meaning."""

    lower_case: bool = False
    single_spaces: bool = False
    plain_numbers: bool = False
    currency_names: bool = False
    any_type: bool = False
    drop_empty: bool = False
    tight_punctuation: bool = True

    def but(self, **changes: bool) -> MatchConfig:
        return replace(self, **changes)


DEFAULT = MatchConfig()
LEGACY = MatchConfig(lower_case=True, single_spaces=True, plain_numbers=True, currency_names=True, any_type=True, drop_empty=True, tight_punctuation=False)


def width_table() -> dict[str, str]:
    """All one-to-one replacements of half-width normalisation."""
    ascii_ = {chr(c): chr(c - FULLWIDTH_SHIFT) for c in range(FULLWIDTH_FIRST, FULLWIDTH_LAST + 1)}
    return ascii_ | SPACE_AND_CURRENCY | PUNCTUATION


def _translated(c: Column, table: dict[str, str]) -> Column:
    return F.translate(c, "".join(table), "".join(table.values()))


def half_width(c: Column) -> Column:
    return F.replace(_translated(c, width_table()), F.lit(ELLIPSIS[0]), F.lit(ELLIPSIS[1]))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+$", "")


def single_spaces(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U){SPACE}+", " ")


def currency_names(c: Column) -> Column:
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), CURRENCY_NAMES.items(), c)


def tight_punctuation(c: Column) -> Column:
    """No white space on either side of a punctuation mark."""
    return F.regexp_replace(c, f"(?U){SPACE}*([{TIGHT_PUNCTUATION}]){SPACE}*", "$1")


def plain_numbers(c: Column) -> Column:
    """No comma between two digits."""
    return F.regexp_replace(c, r"(?U)(?<=\d),(?=\d)", "")


def normalize(c: Column, config: MatchConfig = DEFAULT) -> Column:
    """The steps that the configuration asks for, in their one valid order; null stays null."""
    steps = [
        (True, half_width),
        (config.lower_case, F.lower),
        (config.single_spaces, single_spaces),
        (config.currency_names, currency_names),
        (config.tight_punctuation, tight_punctuation),
        (config.plain_numbers, plain_numbers),
        (True, strip),
    ]
    return reduce(lambda x, step: step[1](x) if step[0] else x, steps, c)


# --- the first generation's normalisations, for reconciliation ---

FIRST_PUNCTUATION = {k: v for k, v in PUNCTUATION.items() if k not in "—·"}
SPREAD_PUNCTUATION = {"(": "（", ")": "）", ",": "，"}


@dataclass(frozen=True)
class FirstConfig:
    """Switches of the first generation's comparator, all on but leading zeros, which nothing reads."""

    case_insensitive: bool = True
    strip_whitespace: bool = True
    normalize_internal_spaces: bool = True
    unify_currency: bool = True
    normalize_punctuation: bool = True
    normalize_numbers: bool = True
    strip_leading_zeros: bool = False
    full_width_alpha: bool = True
    full_width_digit: bool = True
    trim_empty_fields: bool = True
    report_partial_match: bool = True
    partial_match_threshold: float = 0.95


def normalize_first(c: Column, config: FirstConfig | None = None) -> Column:
    """A string value as the first acceptance comparator normalised it."""
    on = config or FirstConfig()
    wide = lambda a, b: {chr(x): chr(x - FULLWIDTH_SHIFT) for x in range(ord(a), ord(b) + 1)}
    steps = [
        (on.full_width_alpha, lambda x: _translated(x, wide("Ａ", "Ｚ") | wide("ａ", "ｚ"))),
        (on.full_width_digit, lambda x: _translated(x, wide("０", "９"))),
        (on.case_insensitive, F.lower),
        (on.strip_whitespace, strip),
        (on.normalize_internal_spaces, single_spaces),
        (on.unify_currency, lambda x: currency_names(F.translate(x, "￥", "¥"))),
        (on.normalize_punctuation, lambda x: _translated(x, FIRST_PUNCTUATION)),
        (on.normalize_numbers, plain_numbers),
        (on.strip_whitespace, strip),
    ]
    return reduce(lambda x, step: step[1](x) if step[0] else x, steps, c)


def normalize_diagnostic(c: Column) -> Column:
    """As the first diagnostic matcher: wide brackets and commas, no spaces, no yen sign."""
    return strip(F.translate(_translated(c, SPREAD_PUNCTUATION), " ¥", ""))

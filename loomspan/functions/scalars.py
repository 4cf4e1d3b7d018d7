"""Column expressions: ratios without errors, codes, numbers written by accountants, dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(a, b)


def only_between(x: Column, low: float, high: float) -> Column:
    """x, null outside [low, high]."""
    return F.when(x.between(low, high), x)


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """x kept in [low, high]; null stays null."""
    out = x if low is None else F.when(x < low, F.lit(low)).otherwise(x)
    return out if high is None else F.when(out > high, F.lit(high)).otherwise(out)


def half_even(x: Column, digits: int = 0) -> Column:
    """Rounded in binary, halves to even; never a negative zero."""
    return F.rint(x * 10.0**digits) / 10.0**digits + 0.0


def coded(x: Column, width: int) -> Column:
    """A number as a zero-padded code."""
    return F.lpad(x.cast("long").cast("string"), width, "0")


def replacement(code: Column, other: Column) -> Column:
    """code, unless other names one to use instead (null and OK do not)."""
    return F.when(other.isNull() | (other == "OK"), code).otherwise(other)


def ladder(steps: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """The value of the first condition that holds."""
    (c, v), *rest = steps
    return reduce(lambda w, s: w.when(s[0], F.lit(s[1])), rest, F.when(c, F.lit(v))).otherwise(F.lit(otherwise))


def accounting(text: Column) -> Column:
    """(1,234) is negative, -- is nothing, commas group thousands."""
    bare = F.regexp_replace(F.trim(text), "[,()]", "")
    sign = F.when(F.trim(text).startswith("("), -1.0).otherwise(1.0)
    return sign * bare.try_cast("double")


def decimal_comma(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def snake(text: Column) -> Column:
    """camelCase to snake_case."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, "(.)([A-Z][a-z]+)", "$1_$2"), "([a-z0-9])([A-Z])", "$1_$2"))


def header(text: Column) -> Column:
    """A column header: upper case, slashes and spaces to underscores, nothing else but letters and digits."""
    return F.upper(F.regexp_replace(F.regexp_replace(F.trim(text), "[/ ]+", "_"), "[^A-Za-z0-9_]", ""))


def key_digest(*parts: Column) -> Column:
    """SHA-1 of the parts as text, one after the other."""
    return F.sha1(F.concat(*(p.cast("string") for p in parts)))


def decay(days: Column, middle: float, slope: float) -> Column:
    """A logistic weight that falls with age."""
    return 1 / (1 + F.exp((days - middle) / slope))


def fade(days: Column, half_life: float) -> Column:
    return F.exp(-F.log(F.lit(2.0)) * days / half_life)


def round_to(ts: Column, seconds: int) -> Column:
    """A timestamp rounded to the nearest multiple, halves up."""
    return F.timestamp_seconds(F.floor((F.unix_timestamp(ts) + seconds // 2) / seconds) * seconds)


def first_match(text: Column, pairs: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The label of the first substring found."""
    return ladder([(text.contains(k), v) for k, v in pairs], otherwise)


def intrinsic_value(cash: Column, growth: Column, equity: Column, years: int = 10) -> Column:
    """Ten years of cash flows whose growth fades by 0.85 a year, discounted at 10 %, and 0.85 of equity; null
    unless positive."""
    flows = F.aggregate(
        F.sequence(F.lit(0), F.lit(years - 1)), F.lit(0.0),
        lambda acc, i: acc + cash * F.pow(1 + growth * F.pow(F.lit(0.85), i) / 100, i) / F.pow(F.lit(1.1), i),
    )
    total = flows + 0.85 * equity
    return F.when(total > 0, total)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = [F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x)) for v in (a, b)]
    return F.try_divide(dot, norm[0] * norm[1])

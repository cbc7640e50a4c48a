"""Coercions, guards and formatting of single values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Words read as true.
TRUE_WORDS = ("true", "yes", "y", "1")
SWITCH_WORDS = TRUE_WORDS + ("on",)


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def blank_to_null(c: ColumnLike) -> Column:
    return F.nullif(F.trim(as_col(c).cast("string")), F.lit(""))


def safe_double(c: ColumnLike) -> Column:
    """Number or null: text that does not parse, NaN and infinities become null."""
    number = as_col(c).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def exact_sum(c: ColumnLike) -> Column:
    """Sum that does not depend on row order; an empty or all-null group gives 0.

    Twelve decimals of each value are summed exactly.  Values and sums too
    large for that are added as doubles, so nothing is lost.
    """
    value = as_col(c).cast("double")
    exact = as_col(c).try_cast("decimal(38,12)")
    fits = F.coalesce(F.try_sum(exact).cast("double"), F.sum(F.when(exact.isNotNull(), value)), F.lit(0.0))
    return fits + F.coalesce(F.sum(F.when(exact.isNull(), value)), F.lit(0.0))


def to_bool(c: ColumnLike) -> Column:
    text = F.upper(F.trim(as_col(c).cast("string")))
    return F.when(text == "TRUE", F.lit(True)).when(text == "FALSE", F.lit(False))


def is_truthy(c: ColumnLike, numeric: bool = False) -> Column:
    """Truth of a switch in a payload; ``numeric`` columns are true when non-zero."""
    value = as_col(c)
    if numeric:
        return F.coalesce(value != 0, F.lit(False))
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def boolish(c: ColumnLike) -> Column:
    return F.coalesce(F.lower(F.trim(as_col(c).cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def parse_bool(c: ColumnLike, default: bool = False) -> Column:
    return F.coalesce(F.lower(F.trim(as_col(c).cast("string"))).isin(*SWITCH_WORDS), F.lit(default))


def repair_timestamp(c: ColumnLike) -> Column:
    """Timestamp from text whose UTC offset may be written without a colon."""
    return F.try_to_timestamp(F.regexp_replace(as_col(c).cast("string"), r"\+0000$", "+00:00"))


def null_pct(c: ColumnLike) -> Column:
    """Percentage from a null ratio; a ratio above one is already a percentage."""
    ratio = F.nanvl(as_col(c).cast("double"), F.lit(None).cast("double"))
    return F.when(ratio > 1, ratio / 100).otherwise(ratio) * 100


def run_key(c: ColumnLike) -> Column:
    """Day of a run id that reads as a time, else its first ten characters."""
    text = blank_to_null(c)
    return F.coalesce(F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd"), F.substring(text, 1, 10))


def tag_at(tags: ColumnLike, index: int) -> Column:
    return F.nullif(F.trim(F.get(as_col(tags), F.lit(index))), F.lit(""))


def composite_id(*parts: ColumnLike) -> Column:
    """Dotted name, null as soon as one part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("."), as_col(part).cast("string")]
    return F.concat(*pieces[1:])


def quality_ratio(score: ColumnLike) -> Column:
    return (F.lit(100) - as_col(score).try_cast("double")) / 100


def severity(c: ColumnLike, critical: float, high: float) -> Column:
    value = safe_double(c)
    return F.when(value >= critical, "Critical").when(value >= high, "High").otherwise("Medium")


def severity_from_percent(c: ColumnLike) -> Column:
    return severity(c, 10.0, 1.0)


def severity_from_total(c: ColumnLike) -> Column:
    return severity(c, 20.0, 10.0)


def fixed(number: Column, digits: int) -> Column:
    """A number with fixed decimals, rounded from its exact binary value (printf rounds so, ``format_string`` does not)."""
    return F.call_function("format_number", number, F.lit("0." + "0" * digits))


def fmt_pct(c: ColumnLike, digits: int = 2) -> Column:
    number = safe_double(c)
    return F.when(number.isNull(), F.lit("NA")).otherwise(F.concat(fixed(number, digits), F.lit("%")))


def _strip_zeros(text: Column) -> Column:
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def fmt_significant(c: ColumnLike, digits: int = 6, commas: bool = False) -> Column:
    """General format with a number of significant digits; plain between 1e-4 and 10^digits."""
    number = safe_double(c)

    def written(x: Column) -> Column:
        number, scientific, exponent = x["number"], x["scientific"], x["exponent"]
        places = F.greatest(F.lit(digits - 1) - exponent, F.lit(0))
        form = F.concat(F.lit("#,##0" if commas else "0"), F.when(places > 0, F.concat(F.lit("."), F.repeat(F.lit("0"), places))).otherwise(""))
        plain = F.call_function("format_number", number, form)
        mantissa = _strip_zeros(F.substring_index(scientific, "E", 1))
        power = F.concat(F.when(exponent < 0, "e").otherwise("e+"), F.substring_index(scientific, "E", -1))
        return F.when(exponent.between(-4, digits - 1), let(plain, _strip_zeros)).otherwise(F.concat(mantissa, power))

    scientific = F.call_function("format_number", number, F.lit("0." + "0" * (digits - 1) + "E00"))
    # The scientific form and its exponent are used many times, and made once.
    first = let(scientific, lambda s: F.struct(number.alias("number"), s.alias("scientific"), F.substring_index(s, "E", -1).cast("int").alias("exponent")))
    return F.when(number.isNull(), F.lit(None).cast("string")).when(number == 0, F.lit("0")).otherwise(let(first, written))


def fmt_num(c: ColumnLike) -> Column:
    number = safe_double(c)
    whole = F.abs(number - F.round(number)) < 1e-9
    return (
        F.when(number.isNull(), F.lit("NA"))
        .when(whole, F.round(number).cast("decimal(38,0)").cast("string"))
        .otherwise(fmt_significant(number, commas=True))
    )


def break_summary(count: ColumnLike, percent: ColumnLike, decimals: int = 4) -> Column:
    number = as_col(count).try_cast("bigint")
    share = safe_double(percent)
    return (
        F.when(number.isNull(), F.lit("_No breaking records._"))
        .when(share.isNull(), F.concat(number.cast("string"), F.lit(" (-)")))
        .otherwise(F.concat(number.cast("string"), F.lit(" ("), fixed(share, decimals), F.lit("%)")))
    )

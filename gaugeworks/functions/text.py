"""Text rules: labels, titles, break names, signals, redaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coerce import ColumnLike, as_col, blank_to_null, let

# Ticket states that count as open work.
ACTIVE_STATUSES = ("Open", "To Do", "In Progress", "Reopened")

# Dimension -> wording of the title with and without a column name.
DIMENSION_TITLES = (
    ("COMPLETENESS", "NULL", "Completeness: NULL values"),
    ("VALIDITY", "Invalid", "Validity: Invalid values"),
    ("CONSISTENCY", "Inconsistent", "Consistency: Inconsistencies"),
    ("ACCURACY", "Inaccurate", "Accuracy: Inaccurate values"),
    ("UNIQUENESS", "Duplicates", "Uniqueness: Duplicates"),
    ("TIMELINESS", "Out-of-date", "Timeliness: Out-of-date values"),
)


def squeeze(c: ColumnLike) -> Column:
    """Trimmed lower-case text with single spaces; null reads as empty."""
    text = F.coalesce(as_col(c).cast("string"), F.lit(""))
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def labels_to_array(c: ColumnLike) -> Column:
    """Lower-case labels from list text (single or double quotes) or comma text."""
    text = F.trim(as_col(c))
    listed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
    parts = F.coalesce(F.when(text.startswith("["), listed), F.split(text, ","))
    clean = F.transform(parts, lambda x: F.lower(F.trim(x)))
    return F.coalesce(F.filter(clean, lambda x: x != ""), F.array().cast("array<string>"))


def column_of_rule(rule: ColumnLike) -> Column:
    """What a rule named ``if_<column>_is_<check>`` checks; null for other names."""
    name = as_col(rule)
    named = F.substring(name, F.lit(4), F.length(name))
    check = F.substring_index(named, "_is_", -1)
    column = F.substring(named, F.lit(1), F.length(named) - F.length(check) - 4)
    whole = name.startswith("if_") & named.contains("_is_") & ~F.array_contains(F.split(column, "_"), "")
    return F.when(whole, column)


def rule_title(
    rule: ColumnLike,
    value: ColumnLike,
    dimension: ColumnLike,
    name_rules: Sequence[tuple[str, str, str]] = (),
) -> Column:
    """Ticket title of a failed rule.

    ``name_rules`` lists (text in the rule name, title with ``{}`` for the
    column, title without a column); they are tried before the dimension.
    """
    name = F.coalesce(as_col(rule), F.lit(""))
    lowered = F.lower(F.trim(name))
    dim = F.upper(F.trim(as_col(dimension)))
    column = F.coalesce(blank_to_null(value), column_of_rule(lowered))
    title = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, with_column, without in name_rules:
        filled = F.replace(F.lit(with_column), F.lit("{}"), column) if "{}" in with_column else F.lit(with_column)
        title = title.when(lowered.contains(pattern), F.coalesce(filled, F.lit(without)))
    for word, suffix, bare in DIMENSION_TITLES:
        title = title.when(
            dim == word,
            F.coalesce(F.concat(column, F.lit(f": {suffix}")), F.concat(F.lit(f"{bare} "), name)),
        )
    return title.otherwise(
        F.coalesce(F.concat(column, F.lit(": "), lowered), F.concat(lowered, F.lit(": Issue")))
    )


def title_value(column: ColumnLike, value: ColumnLike, rule: ColumnLike, max_len: int | None = None) -> Column:
    """The column, else the rule's value (not one longer than ``max_len``, if that is given), else its name."""
    trimmed = blank_to_null(value)
    return F.coalesce(
        blank_to_null(column),
        trimmed if max_len is None else F.when(F.length(trimmed) <= max_len, trimmed),
        F.trim(F.coalesce(as_col(rule), F.lit(""))),
    )


def dimension_labels(dimension: ColumnLike) -> Column:
    dim = blank_to_null(dimension)
    capital = F.concat(F.upper(F.substring(dim, 1, 1)), F.lower(F.substring(dim, F.lit(2), F.length(dim))))
    return F.array_compact(F.array(capital, F.lit("Data"), F.lit("Rule")))


def derive_labels(base: Sequence[str], dimension: ColumnLike, extra: ColumnLike | None = None) -> Column:
    """Ordered distinct labels: base, then the lower-cased dimension, then an extra array."""
    own = F.array(*[F.lit(x) for x in base], F.lower(F.trim(as_col(dimension))))
    both = own if extra is None else F.concat(own, F.coalesce(as_col(extra), F.array().cast("array<string>")))
    return F.array_distinct(F.filter(F.array_compact(both), lambda x: x != ""))


def break_type(kind: ColumnLike, key: ColumnLike) -> Column:
    """Upper-cased type, else what follows the first double underscore of the key."""
    after = F.when(as_col(key).contains("__"), F.trim(F.get(F.split(as_col(key), "__", 2), F.lit(1))))
    return F.upper(F.coalesce(blank_to_null(kind), after, F.lit("")))


def is_row_count(kind: ColumnLike, key: ColumnLike, name: ColumnLike, key_mark: str = "ROW_COUNT") -> Column:
    def upper(c: ColumnLike) -> Column:
        return F.upper(F.trim(F.coalesce(as_col(c), F.lit(""))))

    return upper(kind).contains("ROW_COUNT") | upper(key).contains(key_mark) | (upper(name) == "ROW COUNT")


def item_name(name: ColumnLike, key: ColumnLike) -> Column:
    """Name of the broken item, else the key up to its first double underscore."""
    return F.coalesce(blank_to_null(name), blank_to_null(F.get(F.split(as_col(key), "__", 2), F.lit(0))))


def split_break_key(key: ColumnLike) -> tuple[Column, Column]:
    """(item, metric) around the first double underscore; both null without one."""
    trimmed = F.trim(as_col(key))
    parts = F.split(trimmed, "__", 2)
    has = trimmed.contains("__")
    return F.when(has, F.get(parts, F.lit(0))), F.when(has, F.get(parts, F.lit(1)))


DASHES = ("\u2014", "\u2013")


def raised_breaks(text: ColumnLike) -> Column:
    """Distinct ``column__TYPE`` names written as ``*column* — *type*`` lines."""

    def of_line(line: Column) -> Column:
        # Between bold marks every second part is bold text: item, dash, type in a row make a name.
        def named(parts: Column) -> Column:
            starts = F.when(F.size(parts) > 4, F.sequence(F.lit(1), F.size(parts) - 4)).otherwise(F.array().cast("array<int>"))
            full = F.filter(
                starts,
                lambda i: F.trim(F.get(parts, i + 1)).isin(*DASHES) & (F.trim(F.get(parts, i)) != "") & (F.trim(F.get(parts, i + 2)) != ""),
            )
            return F.transform(full, lambda i: F.concat(single_spaced(F.get(parts, i)), F.lit("__"), F.upper(single_spaced(F.get(parts, i + 2)))))

        return let(F.split(F.replace(line, F.lit("**"), F.lit("*")), r"\*"), named)

    found = F.flatten(F.transform(F.split(as_col(text), "\n"), of_line))
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def single_spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def after_first(text: Column, mark: str) -> Column:
    """What follows the first ``mark`` in any case; null without it."""
    at = F.instr(F.lower(text), mark.lower())
    return F.when(at > 0, F.substring(text, at + len(mark), F.length(text)))


def noted_breaks(text: ColumnLike, tag: str, lead: str = "invalidated:") -> Column:
    """Distinct break names listed after ``lead`` in a note that carries ``tag``."""
    listed = after_first(after_first(as_col(text), tag), lead)
    tokens = F.filter(F.split(listed, r"[, \n\r\t]+"), lambda x: x.contains("__"))
    return F.coalesce(F.array_distinct(tokens), F.array().cast("array<string>"))


def redact(text: ColumnLike) -> Column:
    """User mentions (``[~name]``, with or without an at sign) and e-mail addresses replaced by placeholders."""

    def joined(done: Column, part: Column) -> Column:
        closes = F.instr(part, "]")
        mention = F.concat(F.when(done.endswith("@"), F.substring(done, F.lit(1), F.length(done) - 1)).otherwise(done), F.lit("[USER]"), F.substring(part, closes + 1, F.length(part)))
        return F.when(closes > 1, mention).otherwise(F.concat(done, F.lit("[~"), part))

    def without_mentions(parts: Column) -> Column:
        return F.aggregate(F.slice(parts, 2, F.size(parts)), F.get(parts, F.lit(0)), joined)

    hidden = F.when(as_col(text).contains("[~"), let(F.split(as_col(text), r"\[~"), without_mentions)).otherwise(as_col(text))
    return F.regexp_replace(hidden, r"[\w.%+-]+@(?:[\w-]+\.)+\p{Alpha}{2,}", "[EMAIL]")


def valid_email(c: ColumnLike, domains: Sequence[str] = ()) -> Column:
    """One name, one at sign, and a domain of two or more parts that ends in letters."""
    address = F.trim(as_col(c))
    sides = F.split(address, "@")
    labels = F.split(F.get(sides, F.lit(1)), r"\.")
    letters = F.forall(labels, lambda x: x.rlike(r"^[A-Za-z0-9-]+$")) & (F.size(labels) > 1) & F.element_at(labels, -1).rlike(r"^\p{Alpha}{2,}$")
    shaped = (F.size(sides) == 2) & F.get(sides, F.lit(0)).rlike(r"^[\w.%+-]+$") & letters
    if domains:
        shaped = shaped & F.lower(F.substring_index(address, "@", -1)).isin(*[d.lower() for d in domains])
    return F.coalesce(shaped, F.lit(False))


def merge_section(text: ColumnLike, block: ColumnLike, marker: str) -> Column:
    """Text before the marker, a blank line, then the new block."""
    whole = F.coalesce(as_col(text), F.lit(""))
    kept = F.when(
        whole.contains(marker), F.regexp_replace(F.substring_index(whole, marker, 1), r"\s+$", "")
    ).otherwise(whole)
    gap = F.when((kept == "") | kept.endswith("\n"), F.lit("")).otherwise(F.lit("\n\n"))
    return F.concat(kept, gap, as_col(block))

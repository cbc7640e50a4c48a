"""Ticket candidates from failed rules, adaptive breaks, patterns and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import (
    boolish,
    composite_id,
    exact_sum,
    fmt_num,
    fmt_pct,
    safe_double,
    severity_from_percent,
    severity_from_total,
)
from ..functions.text import blank_to_null, break_type, dimension_labels, is_row_count, item_name, rule_title, squeeze, title_value
from ..session import materialize
from .history import row_history
from .matching import drop_matched
from .relational import PART_LINES, first_row, join_null_safe, shuffled, text_of_lines, text_parts, top_n, whole_text
from .tickets import active_subtasks, stable_titles

# Numeric columns of an adaptive finding, labels of the profile sources.
ADAPTIVE_NUMBERS = ("stndDev", "zscore", "mean", "value", "score", "perChange", "lbAbs", "ubAbs")
SOURCE_LABELS = {
    "adaptive": ("dq", "adaptive", "profile-change", "end-users"),
    "pattern": ("dq", "pattern", "end-users"),
    "dupes": ("dq", "dupes", "end-users"),
}


def filter_reference(df: DataFrame, reference: DataFrame, key: str, include: bool) -> DataFrame:
    """Rows whose key is in the reference list, or all others (null keys among them)."""
    return df.join(reference.select(key), key, "left_semi" if include else "left_anti")


def _labels(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _optional(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast("string") for n in missing}) if missing else df


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"*{label}:* "), F.coalesce(value.cast("string"), F.lit("")))


def _join_lines(*lines: Column) -> Column:
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


RULE_COLUMNS = ("ruleType", "ruleValue", "dimName", "Project", "columnName", "businessDesc", "db_nm", "table_nm")


def custom_candidates(
    rules: DataFrame,
    breaks: DataFrame,
    tickets: DataFrame,
    name_rules: Sequence[tuple[str, str, str]] = (),
    threshold: float = 0.72,
) -> DataFrame:
    """Failed, scheduled custom rules that no open ticket of their dataset already describes.

    ``tickets`` are prepared tickets with a column ``ord`` that gives their order.
    """
    measured = [c for c in ("breakMsg", "score", "perc", "exception") if c in breaks.columns]
    keys = ["dataset", "runId", "ruleNm"]
    failing = F.upper("breakMsg") == "BREAKING" if "breakMsg" in breaks.columns else safe_double("perc") > 0
    broken = breaks.filter(failing & (safe_double("perc") > 0)).select(*keys, *measured)
    full = _optional(rules.drop(*measured), *RULE_COLUMNS)
    merged = join_null_safe(full, shuffled(broken), keys, "inner")
    if "jobSchedule" in merged.columns:
        merged = merged.filter(boolish("jobSchedule"))
    titled = merged.withColumn(
        "suggested_title", rule_title("ruleNm", title_value("columnName", "ruleValue", "ruleNm"), "dimName", name_rules)
    )
    # The matching and the candidates both use the failed rules: the wide joins run once.
    titled = materialize(titled.select(*keys, *RULE_COLUMNS, "score", "perc", "suggested_title"), "failed-rules")
    existing = active_subtasks(tickets).select(F.col("parent_summary").alias("dataset"), "title", "ord")
    fresh = drop_matched(titled, existing, "suggested_title", threshold)
    table = composite_id("db_nm", "table_nm")
    about = blank_to_null("businessDesc")
    description = _join_lines(
        _line("Dataset", F.col("dataset")),
        F.concat(F.lit("*DataTable:* "), F.coalesce(table, F.lit("NA"))),
        _line("RunId", F.col("runId")),
        _line("Project", F.col("Project")),
        _line("Rule", F.col("ruleNm")),
        _line("Dimension", F.col("dimName")),
        F.concat(F.lit("*Affected percentage:* "), fmt_pct("perc")),
        F.concat(F.lit("*Column:* "), F.col("columnName")),
        F.concat(F.lit("\n"), about),
    )
    return fresh.select(
        "dataset",
        table.alias("table_name"),
        "runId",
        "ruleNm",
        "ruleType",
        "ruleValue",
        "dimName",
        "score",
        "perc",
        F.col("Project").alias("business_unit"),
        F.col("columnName").alias("violation_columns"),
        "suggested_title",
        dimension_labels("dimName").alias("suggested_labels"),
        severity_from_percent("perc").alias("suggested_priority"),
        description.alias("jira_description"),
    )


def ordered_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates from the largest affected share down: the order of the report."""
    return candidates.orderBy(F.desc("perc"), F.asc("dataset"), F.asc("suggested_title"))


def classify_breaks(df: DataFrame, key_mark: str = "ROW_COUNT") -> DataFrame:
    """Type, item name and row-count flag of each break."""
    return df.withColumns(
        {
            "break_type": break_type("type", "key"),
            "is_row_count": is_row_count("type", "key", "name", key_mark),
            "item": item_name("name", "key"),
        }
    )


def clean_adaptive(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Breaking findings of datasets outside the reference list, with finite numbers or nulls."""
    kept = df.filter(F.lower("status") == "breaking") if "status" in df.columns else df
    numbers = {c: safe_double(c) for c in ADAPTIVE_NUMBERS if c in df.columns}
    return filter_reference(kept, reference, "dataset", include=False).withColumns(numbers)


def suggest_titles(breaks: DataFrame, keys: Sequence[str], tie: Sequence[Column | str]) -> DataFrame:
    """Title per run: its two highest-scoring items and what the row count did."""
    by_score = [F.desc_nulls_last("score"), *tie]
    items = breaks.filter(~F.col("is_row_count") & F.col("item").isNotNull())
    named = top_n(first_row(items, [*keys, "item"], by_score), keys, by_score, 2, rank="__n")
    columns = named.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__n", "item"))), lambda x: x["item"]), ", ").alias("__columns")
    )
    counted = first_row(breaks.filter("is_row_count"), keys, by_score)
    value, mean, change = F.col("value"), F.col("mean"), F.col("perChange")
    suffix = (
        F.when(value != mean, F.when(value > mean, "Row Count Increased").otherwise("Row Count Dropped"))
        .when(change != 0, F.when(change > 0, "Row Count Increased").otherwise("Row Count Dropped"))
        .otherwise("Row Count Changed")
    )
    runs = breaks.select(*keys).distinct()
    joined = join_null_safe(runs, columns, keys, "left")
    joined = join_null_safe(joined, counted.select(*keys, suffix.alias("__suffix")), keys, "left")
    title = F.concat(F.coalesce("__columns", F.lit("Row Count")), F.lit(": "), F.coalesce("__suffix", F.lit("Profile Change")))
    return joined.select(*keys, title.alias("suggested_title"))


def break_lines(breaks: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The whole break list as a table: one text block per break, ordered by score within its run."""
    full = _optional(breaks, "verbose", "zscore", "lbAbs", "ubAbs", "assignmentId")
    block = _join_lines(
        F.concat(F.lit("- *"), F.coalesce("item", F.lit("")), F.lit("* — *"), F.col("break_type"), F.lit("*")),
        F.concat(F.lit("  - Anomaly: "), blank_to_null("verbose")),
        F.concat(
            F.lit("  - Past (mean): "), fmt_num("mean"), F.lit(" | Current (value): "), fmt_num("value"),
            F.lit(" | Z-score: "), fmt_num("zscore"),
        ),
        F.concat(
            F.lit("  - Bands: ["), fmt_num("lbAbs"), F.lit(", "), fmt_num("ubAbs"), F.lit("] | % change: "),
            fmt_pct("perChange"), F.lit(" | Score impact: "), fmt_pct("score"),
        ),
        F.concat(F.lit("  - assignmentId: "), blank_to_null("assignmentId")),
    )
    return full.select(*keys, "score", *tie, block.alias("line"))


BREAKS_HEAD = "*Adaptive profile changes detected in this run:*\n\n"


def render_breaks(breaks: DataFrame, keys: Sequence[str], tie: Sequence[str], part_lines: int = PART_LINES) -> DataFrame:
    """Break list of a run as one text, its first part if it is long; ``break_parts`` holds all parts."""
    lines = break_lines(breaks, keys, tie)
    body = text_of_lines(lines, keys, [F.desc_nulls_last("score"), *tie], "line", "breaks_text", "\n\n", part_lines)
    return body.withColumn("breaks_text", F.concat(F.lit(BREAKS_HEAD), "breaks_text"))


def break_parts(breaks: DataFrame, keys: Sequence[str], tie: Sequence[str], part_lines: int = PART_LINES) -> DataFrame:
    """The whole break list of every run in numbered parts."""
    return text_parts(break_lines(breaks, keys, tie), keys, [F.desc_nulls_last("score"), *tie], "line", "\n\n", part_lines)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def adaptive_candidates(
    findings: DataFrame,
    tickets: DataFrame,
    history: DataFrame,
    reference: DataFrame,
    tie: Sequence[str],
    zone: str,
    zone_label: str,
    time_col: str = "run_date",
    history_tie: str = "run_id",
    rows: str = "row_cnt",
    labels: Sequence[str] = SOURCE_LABELS["adaptive"],
    link_base: str | None = None,
) -> DataFrame:
    """One candidate per (dataset, run) with breaking adaptive findings.

    ``findings`` carries the run's time in ``time_col``; ``history`` holds the
    runs of each dataset.  The title of an open adaptive ticket of the dataset
    wins over the suggested one.  Row metrics come from the run's row-count
    break, and from history only if the run has none.
    """
    keys = ["dataset", "runId"]
    breaks = classify_breaks(_optional(clean_adaptive(findings, reference), "db_nm", "table_nm", "Project", "key"))
    # Five branches below use the breaks: the findings are scanned once, each branch reads its own columns.
    breaks = materialize(breaks.filter(F.col("dataset").isNotNull() & F.col("runId").isNotNull()), "breaks")
    order = F.struct(*tie)
    named = F.col("name") == "Row Count"
    first_count = F.struct("value", "mean", "perChange")
    runs = breaks.groupBy(*keys).agg(
        exact_sum("score").alias("score"),
        F.bool_or("is_row_count").alias("__counted"),
        F.min_by(F.struct("db_nm", "table_nm", "Project"), order).alias("__first"),
        F.min_by(F.when(named, first_count), F.when(named, order)).alias("__rows"),
        F.max(time_col).alias("__at"),
    )
    titles = suggest_titles(breaks, keys, list(tie))
    texts = render_breaks(breaks, keys, list(tie))
    uncounted = runs.filter(~F.col("__counted")).select(*keys, "__at")
    past = row_history(history, uncounted, "dataset", time_col, history_tie, rows, "__at", zone, zone_label).drop("__at")
    joined = runs.join(titles, keys).join(texts, keys).join(past, keys, "left")
    joined = joined.withColumn("dataset_norm", squeeze("dataset")).join(stable_titles(tickets), "dataset_norm", "left")
    table = composite_id("__first.db_nm", "__first.table_nm")
    project = blank_to_null("__first.Project")
    description = _join_lines(
        _line("Dataset", F.col("dataset")),
        _line("DataTable", table),
        _line("RunId (runDate)", F.col("runId")),
        F.concat(F.lit("*Project:* "), project),
        F.concat(F.lit("*Total adaptive score impact:* "), fmt_pct("score")),
        F.concat(F.lit("\n"), F.col("history_text")),
        F.concat(F.lit("\n"), F.col("breaks_text"), F.lit("\n")),
        F.concat(F.lit(f"*Findings:* {link_base}"), F.col("dataset")) if link_base else F.lit(None).cast("string"),
    )

    def metric(from_break: str, from_history: str) -> Column:
        return F.when(F.col("__counted"), F.col(f"__rows.{from_break}")).otherwise(F.col(from_history).cast("double"))

    return joined.select(
        "dataset",
        table.alias("table_name"),
        "runId",
        project.alias("business_unit"),
        F.coalesce(blank_to_null("stable_title"), "suggested_title").alias("suggested_title"),
        severity_from_total("score").alias("suggested_priority"),
        _labels(labels).alias("suggested_labels"),
        "score",
        metric("value", "rows_current").alias("rows_current"),
        metric("mean", "rows_prev").alias("rows_prev"),
        metric("perChange", "rows_pct_change_vs_prev").alias("rows_pct_change_vs_prev"),
        _strip(description).alias("jira_description"),
    )


def _scheduled(df: DataFrame) -> DataFrame:
    return df.filter(F.upper(F.col("jobSchedule").cast("string")) == "TRUE") if "jobSchedule" in df.columns else df


def _heads(df: DataFrame, keys: Sequence[str], score: str, tie: Sequence[str]) -> DataFrame:
    first = ("db_nm", "table_nm", "Project")
    total = exact_sum(safe_double(score)).alias("score")
    if not set(first) & set(df.columns):  # sums alone need no sort
        none = F.struct(*[F.lit(None).cast("string").alias(c) for c in first])
        return df.groupBy(*keys).agg(total).withColumn("__first", none)
    return _optional(df, *first).groupBy(*keys).agg(total, F.min_by(F.struct(*first), F.struct(*tie)).alias("__first"))


def _head_text(label: str) -> Column:
    return _join_lines(
        _line("Dataset", F.col("dataset")),
        _line("DataTable", composite_id("__first.db_nm", "__first.table_nm")),
        _line("RunId (runDate)", F.col("runId")),
        F.concat(F.lit("*Project:* "), blank_to_null("__first.Project")),
        F.concat(F.lit(f"*Total {label} score impact:* "), fmt_pct("score")),
    )


def _source_row(joined: DataFrame, title: Column, labels: Sequence[str], description: Column) -> DataFrame:
    return joined.select(
        "dataset",
        composite_id("__first.db_nm", "__first.table_nm").alias("table_name"),
        "runId",
        blank_to_null("__first.Project").alias("business_unit"),
        title.alias("suggested_title"),
        severity_from_total("score").alias("suggested_priority"),
        _labels(labels).alias("suggested_labels"),
        "score",
        _strip(description).alias("jira_description"),
    )


def pattern_lines(patterns: DataFrame, observations: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Sample tables of each pattern as lines: header, the odd record with its count, the usual ones.

    ``observations`` has dataset, runId, obsKey, ord and ``record``, an ordered
    map of column to text; its lowest ``ord`` per key is the odd record.
    """
    keys = ["dataset", "runId", "pattern"]
    seen = first_row(patterns.filter(F.col("obsKey").isNotNull()), [*keys, "obsKey"], list(tie))
    seen = seen.select(*keys, "obsKey", F.struct(*tie).alias("key_order"), F.col("owlRank").cast("string").alias("__rank_text"))
    place = ["dataset", "runId", "obsKey"]
    # The least order comes from the same shuffle as the join.
    records = observations.withColumn("__odd", F.min("ord").over(Window.partitionBy(*place)))
    met = records.join(seen, place)
    is_odd = F.col("ord") == F.col("__odd")
    header = F.concat(F.lit("| "), F.concat_ws(" | ", F.lit("PatternCount"), F.map_keys("record")), F.lit(" |"))
    label = F.when(is_odd, F.col("__rank_text")).otherwise("Majority Pattern")
    row = F.concat(F.lit("| "), F.concat_ws(" | ", label, F.map_values("record")), F.lit(" |"))
    line = F.when(is_odd, F.concat(header, F.lit("\n"), row)).otherwise(row)
    return met.select(*keys, "key_order", "obsKey", "ord", is_odd.alias("starts"), line.alias("line"))


PATTERN_ORDER = ("key_order", "obsKey", "ord")


def _spaced(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line", F.when(F.col("starts"), F.concat(F.lit("\n"), "line")).otherwise(F.col("line")))


def pattern_parts(patterns: DataFrame, observations: DataFrame, tie: Sequence[str], part_lines: int = PART_LINES) -> DataFrame:
    """All sample tables of every pattern in numbered parts."""
    keys = ["dataset", "runId", "pattern"]
    split = split_pattern(_scheduled(patterns)).dropna(subset=keys)
    return text_parts(_spaced(pattern_lines(split, observations, tie)), keys, PATTERN_ORDER, "line", part_lines=part_lines)


def split_pattern(df: DataFrame) -> DataFrame:
    parts = F.split("obs", " ~~ ", 2)
    return df.withColumns({"title": F.get(parts, F.lit(0)), "pattern": F.get(parts, F.lit(1))})


def pattern_candidates(patterns: DataFrame, observations: DataFrame, tie: Sequence[str], labels: Sequence[str] = SOURCE_LABELS["pattern"]) -> DataFrame:
    """One candidate per (dataset, run, pattern) of the scheduled findings, with all its sample tables."""
    keys = ["dataset", "runId", "pattern"]
    split = split_pattern(_scheduled(patterns)).dropna(subset=keys)
    heads = _heads(split, keys, "obsScore", tie)
    lines = pattern_lines(split, observations, tie)
    texts = whole_text(_spaced(lines), keys, PATTERN_ORDER, "line", "samples")
    joined = heads.join(texts, keys, "left")
    description = _join_lines(
        _head_text("pattern"),
        F.concat(F.lit("\n*Pattern: "), F.col("pattern"), F.lit("*")),
        F.col("samples"),
    )
    return _source_row(joined, F.concat(F.lit("Anti-Pattern: "), "pattern"), labels, description)


def duplicate_lines(dupes: DataFrame, observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(columns per run, distinct sample records per run) of duplicate findings.

    ``observations`` has dataset, runId, obsKey, ord and ``record``, an ordered
    map of column to text.  Columns keep their first place; ``occurs`` ends.
    A run's column list is as long as its tables are wide.
    """
    run = ["dataset", "runId"]
    place = [*run, "obsKey"]
    # Two branches below use the records, and few kinds of records make up the columns of a run.
    records = materialize(observations.select(*place, "ord", "record").join(dupes.select(*place), place, "left_semi").drop("obsKey"), "records")
    kinds = records.groupBy(*run, F.map_keys("record").alias("kind")).agg(F.min("ord").alias("ord"))
    spots = kinds.select(*run, "ord", F.posexplode("kind").alias("at", "name"))
    names = spots.groupBy(*run, "name").agg(F.min(F.struct("ord", "at")).alias("spot"))
    last = F.when(F.col("name") == "occurs", 1).otherwise(0)
    placed = F.sort_array(F.collect_list(F.struct(last.alias("last"), "spot", "name")))
    headers = materialize(names.groupBy(*run).agg(F.transform(placed, lambda x: x["name"]).alias("names")), "headers")
    cells = records.join(shuffled(headers), run).select(
        *run, "ord", F.transform("names", lambda n: F.coalesce(F.try_element_at("record", n), F.lit("nan"))).alias("cells")
    )
    rows = cells.groupBy(*run, "cells").agg(F.min("ord").alias("ord"))
    return headers, rows.select(*run, "ord", F.concat(F.lit("| "), F.array_join("cells", " | "), F.lit(" |")).alias("line"))


def unseen_keys(dupes: DataFrame, headers: DataFrame, tie: Sequence[str]) -> DataFrame:
    """The keys of runs without any sample record, one row each."""
    run = ["dataset", "runId"]
    bare = dupes.filter(F.col("obsKey").isNotNull()).join(shuffled(headers.select(*run)), run, "left_anti")
    return first_row(bare, [*run, "obsKey"], list(tie))


def duplicate_candidates(
    dupes: DataFrame,
    observations: DataFrame,
    include_keys: DataFrame,
    tie: Sequence[str],
    labels: Sequence[str] = SOURCE_LABELS["dupes"],
) -> DataFrame:
    """One candidate per (dataset, run) of the scheduled duplicate findings.

    ``include_keys`` gives, per dataset, the configured key columns
    (``columns``, an array) used when no sample record exists.
    """
    run = ["dataset", "runId"]
    scheduled = _scheduled(dupes).dropna(subset=run)
    heads = _heads(scheduled, run, "owlRank", tie)
    headers, lines = duplicate_lines(scheduled, observations)
    texts = whole_text(lines, run, ["ord", "line"], "line", "samples")
    unseen = whole_text(unseen_keys(scheduled, headers, tie), run, list(tie), "obsKey", "unseen", ", ")
    joined = heads.join(shuffled(headers), run, "left").join(texts, run, "left").join(unseen, run, "left").join(include_keys, "dataset", "left")
    found = F.col("names").isNotNull()
    key_columns = F.when(found, F.filter("names", lambda n: n != "occurs")).otherwise(F.coalesce("columns", F.array().cast("array<string>")))
    table = F.concat(F.lit("\n| "), F.array_join("names", " | "), F.lit(" |\n"), F.col("samples"))
    none = F.concat(F.lit("No details found for obs keys: "), F.coalesce("unseen", F.lit("")))
    description = _join_lines(_head_text("dupes"), F.lit("\n*Dupes Records:*"), F.when(found, table).otherwise(none))
    return _source_row(joined, F.concat(F.lit("Dupes: "), F.array_join(key_columns, ",")), labels, description)


def duplicate_parts(dupes: DataFrame, observations: DataFrame, tie: Sequence[str], part_lines: int = PART_LINES) -> DataFrame:
    """All sample records of every run's duplicates in numbered parts, and all keys of runs without any record.

    ``kind`` is ``samples`` or ``unseen``.
    """
    run = ["dataset", "runId"]
    scheduled = _scheduled(dupes).dropna(subset=run)
    headers, lines = duplicate_lines(scheduled, observations)
    samples = text_parts(lines, run, ["ord", "line"], "line", part_lines=part_lines)
    unseen = text_parts(unseen_keys(scheduled, headers, tie), run, list(tie), "obsKey", ", ", part_lines)
    return samples.withColumn("kind", F.lit("samples")).unionByName(unseen.withColumn("kind", F.lit("unseen")))

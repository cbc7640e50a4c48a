"""Ticket planning: union, thresholds, routing, samples, descriptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import blank_to_null, break_summary, safe_double
from .relational import first_row, join_null_safe, top_n, union_all


def union_candidates(by_source: Mapping[str, DataFrame]) -> DataFrame:
    """All candidate lists in one table, tagged with their source."""
    return union_all([df.withColumn("ticket_source", F.lit(name)) for name, df in by_source.items()])


def above_threshold(candidates: DataFrame, overrides: DataFrame, default: float = 1.0) -> DataFrame:
    """Candidates whose score exceeds the threshold of their dataset."""
    side = overrides.select("dataset", F.col("threshold").cast("double").alias("__t"))
    joined = candidates.join(side, "dataset", "left").withColumn("jira_dq_threshold", F.coalesce("__t", F.lit(float(default))))
    return joined.withColumn("score", safe_double("score")).filter(F.col("score") > F.col("jira_dq_threshold")).drop("__t")


def capability(unit: Column) -> Column:
    """Upper-cased part after the first " - " of a unit name, else the whole name."""
    parts = F.split(blank_to_null(unit), " - ", 2)
    return F.upper(F.trim(F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))))


def unit_region(unit: Column) -> Column:
    return F.upper(F.trim(F.get(F.split(unit, " - "), F.lit(0))))


def route_by_words(unit: Column, rules: Sequence[tuple[Sequence[str], str]], default: str | None) -> Column:
    """Value of the first rule whose words all occur in the capability of the unit.

    Rules are configuration, a short ordered list that travels inside the expression.
    """
    named = capability(unit)
    spaced = F.translate(named, "_-", "  ")
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for words, value in rules:
        hit = F.lit(True)
        for word in words:
            hit = hit & (named.contains(word) | spaced.contains(word))
        chosen = chosen.when(F.coalesce(hit, F.lit(False)), F.lit(value))
    return chosen.otherwise(F.lit(default).cast("string"))


def route_units(
    candidates: DataFrame,
    mapping: DataFrame,
    rules: Mapping[str, Sequence[tuple[Sequence[str], str]]],
    defaults: Mapping[str, str | None],
    order_by: Sequence[Column | str],
) -> DataFrame:
    """Unit of each candidate (first mapping of its dataset, else its own) and where it routes.

    ``rules`` names one ordered rule list per output column.
    """
    side = first_row(mapping, ["dataset"], order_by).select("dataset", F.col("business_unit").alias("__unit"), F.lit(True).alias("__known"))
    joined = join_null_safe(candidates, side, ["dataset"], "left")
    unit = F.when(F.col("__known"), F.col("__unit")).otherwise(F.col("business_unit"))
    out = {"unit": unit, "unit_region": unit_region(unit)}
    out |= {name: route_by_words(unit, ordered, defaults.get(name)) for name, ordered in rules.items()}
    return joined.withColumns(out).drop("__unit", "__known")


def exclude_routed(df: DataFrame, components: Sequence[str], column: str = "component") -> DataFrame:
    return df.filter(~F.coalesce(F.col(column).isin(*components), F.lit(False)))


# Columns a sample leaves out, and the column it always shows.
SAMPLE_DROPPED = ("dataset", "runId", "ruleName", "owl_id")
SAMPLE_ENSURED = ("linkId",)
NO_SAMPLE = "_No sample breaking records returned._"


def _cell(value: Column, max_len: int | None) -> Column:
    text = F.trim(F.replace(F.coalesce(value, F.lit("None")), F.lit("\n"), F.lit(" ")))
    cut = text if max_len is None else F.when(F.length(text) > max_len, F.concat(F.substring(text, 1, max_len - 3), F.lit("..."))).otherwise(text)
    return F.replace(cut, F.lit("|"), F.lit("\\|"))


def sample_records(
    records: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    max_rows: int,
    break_columns: str | None = None,
    max_cols: int | None = None,
    max_cell_len: int | None = None,
    output: str = "table",
) -> DataFrame:
    """Text sample of the first ``max_rows`` records of each key, as a table or as bullets.

    All columns and whole cells are shown unless the caller limits them.

    ``records`` carries ``record``, an ordered map of column to text.  With
    ``break_columns``, a column of ``records`` naming the broken column, that
    one is always shown; else the link id is.
    """
    first = top_n(records, keys, order_by, max_rows, rank="__n")
    broken = blank_to_null(break_columns) if break_columns else F.lit(None).cast("string")
    shown = F.when(broken.isNotNull(), F.array(broken)).otherwise(F.array(*[F.lit(c) for c in SAMPLE_ENSURED]))
    held = first.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col("__n").alias("n"), F.map_entries("record").alias("entries"), shown.alias("shown"), broken.alias("broken")))).alias("rows")
    )
    head = F.col("rows")[0]
    hidden = F.array(*[F.lit(c) for c in SAMPLE_DROPPED])
    names = F.transform(head["entries"], lambda e: e["key"])
    dynamic = F.filter(names, lambda c: ~F.array_contains(head["shown"], c) & ~F.array_contains(hidden, c))
    dynamic = dynamic if max_cols is None else F.slice(dynamic, 1, max_cols)
    staged = held.withColumns({"cols": F.concat(head["shown"], dynamic), "broken": head["broken"]})

    def value(row: Column, column: Column) -> Column:
        return _cell(F.get(F.filter(row["entries"], lambda e: e["key"] == column), F.lit(0))["value"], max_cell_len)

    title = F.concat(F.lit("*Break column(s):* "), F.col("broken"))
    if output == "bullets":
        blocks = F.transform(
            "rows",
            lambda r: F.concat(
                F.lit("- *#"), r["n"].cast("string"), F.lit("*\n"),
                F.array_join(F.transform("cols", lambda c: F.concat(F.lit("  - *"), c, F.lit("*: "), value(r, c))), "\n"),
            ),
        )
        lines = F.concat(F.array(title), blocks)
    else:
        header = F.concat(F.lit("| # | "), F.array_join("cols", " | "), F.lit(" |"))
        rule = F.concat(F.lit("|---|"), F.array_join(F.transform("cols", lambda c: F.lit("---")), "|"), F.lit("|"))
        body = F.transform(
            "rows",
            lambda r: F.concat(
                F.lit("| "), r["n"].cast("string"), F.lit(" | "), F.array_join(F.transform("cols", lambda c: value(r, c)), " | "), F.lit(" |")
            ),
        )
        lines = F.concat(F.array(title, header, rule), body)
    return staged.select(*keys, F.array_join(F.array_compact(lines), "\n").alias("sample"))


def table_identity(df: DataFrame, reports: DataFrame, sources: DataFrame, report_order: Sequence[Column | str]) -> DataFrame:
    """Kind, name, database, host and path of each dataset's table: from its report, else its source.

    ``reports``: dataset, db_nm, table_nm, host.  ``sources``: dataset, filePath, connectionName.
    """
    report = first_row(reports, ["dataset"], report_order).select(
        "dataset", F.col("db_nm").alias("r_db"), blank_to_null("table_nm").alias("r_name"), "host", F.lit(True).alias("reported")
    )
    source = sources.select("dataset", blank_to_null("filePath").alias("s_path"), F.col("connectionName").alias("s_connection"))
    joined = df.join(report, "dataset", "left").join(source, "dataset", "left")
    from_file = F.col("r_name").isNull() & F.col("s_path").isNotNull()
    kind = (
        F.when(F.col("r_name").isNotNull(), "Table")
        .when(from_file, "File")
        .when(F.col("reported"), "Table/View")
        .otherwise("Unknown")
    )
    database = F.coalesce(blank_to_null("r_db"), F.when(F.col("r_name").isNull(), F.col("s_connection")))
    return joined.withColumns(
        {
            "table_kind": kind,
            "table_label": F.coalesce("r_name", F.when(from_file, F.element_at(F.split("s_path", "/"), -1))),
            "table_db": database,
            "table_host": F.col("host"),
            "table_path": F.when(from_file, F.col("s_path")),
        }
    ).drop("r_db", "r_name", "host", "reported", "s_path", "s_connection")


def _section(title: str, *body: Column) -> list[Column]:
    return [F.lit(f"h3. {title}\n"), *body]


def render_description(candidates: DataFrame, samples: DataFrame, keys: Sequence[str], link_base: str) -> DataFrame:
    """Description of a custom-rule ticket.

    ``candidates`` carry the identity columns of ``table_identity`` beside
    ruleNm, ruleValue, score, perc, dimName and violation_count.
    """
    joined = join_null_safe(candidates, samples, keys, "left")

    def item(label: str, value: Column, quote: bool = False) -> Column:
        mark = "`" if quote else ""
        return F.concat(F.lit(f"- *{label}*: {mark}"), value, F.lit(mark))

    def field(label: str, value: Column, unit: str = "") -> Column:
        return F.concat(F.lit(f"*{label}:* "), value.cast("string"), F.lit(unit))

    header = [
        field("Dataset", F.col("dataset")),
        field("Run ID", F.col("runId")),
        field("Rule Name", F.col("ruleNm")),
        field("Rule Value", F.nullif(F.col("ruleValue"), F.lit(""))),
        field("Penalty Score", F.col("score")),
        field("Perc", F.col("perc"), "%"),
        field("Dimension", F.nullif(F.col("dimName"), F.lit(""))),
    ]
    is_file = F.col("table_kind") == "File"
    table = [
        item("Type", F.col("table_kind")),
        F.when(is_file, item("Path", F.col("table_path"), True)),
        F.when(~is_file, item("DB", F.col("table_db"), True)),
        F.when(~is_file, item("Object", F.col("table_label"), True)),
        F.when(~is_file, item("Host", F.col("table_host"), True)),
    ]
    gap = F.lit("")
    lines = [
        *_section("Description", *header), gap, F.lit("---"), gap,
        *_section("Table / View / File", *table), gap,
        *_section("Invalid Sample Data", F.coalesce("sample", F.lit(NO_SAMPLE))), gap,
        *_section("Breaking Records", break_summary("violation_count", "perc")), gap,
        *_section("Investigation", F.lit("_Owner to add investigation notes here_")), gap,
        *_section("Expected Outcome / Solution", F.lit("_Owner to propose fix / logic change / data correction_")), gap,
        *_section("Status / Next Steps", F.lit("None")), gap,
        *_section("Links", F.concat(F.lit(f"- *Dataset*: {link_base}"), F.col("dataset"))), gap,
        *_section("Comments", F.lit("None")),
    ]
    return joined.withColumn("jira_description", F.array_join(F.array_compact(F.array(*lines)), "\n")).drop("sample")

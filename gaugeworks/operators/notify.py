"""Notifications: recipients, grouping, break lists, message tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import split_break_key, valid_email
from ..session import materialize
from ..sources.readers import Source, read_first_available
from .relational import PART_LINES, first_row, list_rows, text_parts, union_all


def load_notifications(spark: SparkSession, primary: Source, legacy: Source) -> DataFrame:
    """The notification list, else the older invalidation list; a missing type means an invalidated break."""
    df = read_first_available(spark, [primary, legacy])
    kind = F.lit("invalidated_break")
    return df.withColumn("notification_type", F.coalesce("notification_type", kind) if "notification_type" in df.columns else kind)


def recipients(keys: DataFrame, tickets: DataFrame, people: DataFrame, extras: DataFrame, domains: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Addresses per ticket, one row each.

    Assignees of the ticket list and the extra addresses of its project come
    first; tickets without any fall back to assignee and reporter of ``people``.
    """
    wanted = keys.select("issue_key").filter(F.col("issue_key").isNotNull()).distinct()
    held = tickets.withColumnRenamed("key", "issue_key")
    project = first_row(held, ["issue_key"], order_by).select("issue_key", F.trim("project").alias("project"))
    listed = [
        held.select("issue_key", F.trim("assignee_email").alias("email"), F.lit(0).alias("__tier")).filter(valid_email("email", domains)),
        project.join(extras.select("project", "email"), "project").select("issue_key", "email", F.lit(0).alias("__tier")),
        people.select(F.col("key").alias("issue_key"), F.explode(F.array("assignee_email", "reporter_email")).alias("email"))
        .select("issue_key", F.trim("email").alias("email"), F.lit(1).alias("__tier")).filter(valid_email("email", domains)),
    ]
    # Dealt by ticket once: the join, the distinct addresses and the first tier of each ticket share it.
    found = union_all(listed).join(wanted, "issue_key", "left_semi").groupBy("issue_key", "email").agg(F.min("__tier").alias("__tier"))
    first = found.withColumn("__first", F.min("__tier").over(Window.partitionBy("issue_key")))
    return first.filter(F.col("__tier") == F.col("__first")).select("issue_key", "email")


def note_recipients(notes: DataFrame, by_ticket: DataFrame, distribution: Sequence[str], domains: Sequence[str]) -> DataFrame:
    """Distinct valid addresses per dataset: those of its tickets and the distribution list."""
    keys = notes.select("dataset", F.trim("issue_key").alias("issue_key")).filter(F.col("dataset").isNotNull())
    own = keys.distinct().join(by_ticket, "issue_key").select("dataset", "email")
    if distribution:
        listed = notes.select("dataset").dropna().distinct().withColumn("email", F.explode(F.array(*[F.lit(d.strip()) for d in distribution])))
        own = own.unionByName(listed)
    return own.filter(valid_email("email", domains)).distinct()


def group_notifications(
    notes: DataFrame, by_ticket: DataFrame, distribution: Sequence[str], domains: Sequence[str], order_by: Sequence[str], part_lines: int = PART_LINES
) -> DataFrame:
    """Notifications per dataset with type, tickets and sorted recipients; datasets without recipients are skipped.

    A row holds up to ``part_lines`` tickets and recipients; longer lists go on
    in rows of the same dataset with a higher ``part``.
    """
    heads = notes.filter(F.col("dataset").isNotNull()).groupBy("dataset").agg(
        F.min_by("notification_type", F.struct(*order_by)).alias("notification_type")
    )
    addresses = note_recipients(notes, by_ticket, distribution, domains)
    emails = list_rows(addresses, ["dataset"], ["email"], "email", "recipients", ";", part_lines)
    keys = notes.select("dataset", F.trim("issue_key").alias("issue_key")).dropna().distinct()
    told = heads.join(emails.filter("part = 0").select("dataset"), "dataset", "left_semi")
    issues = list_rows(keys, ["dataset"], ["issue_key"], "issue_key", "issue_keys", ";", part_lines)
    rows = emails.join(issues, ["dataset", "part"], "full")
    return told.join(rows, "dataset").select("dataset", "part", "notification_type", "issue_keys", "recipients")


def unpack_breaks(notes: DataFrame, order_by: Sequence[str], alert_breaks: DataFrame | None = None) -> DataFrame:
    """Distinct break names per dataset: those of its alerts (else a title), keys of invalidations.

    ``alert_breaks`` (dataset, break_key) gives the names of alerts as rows;
    without it they are read from the list cells of the notes.
    """
    cell = F.split("detected_breaks", r"\|") if alert_breaks is None else F.array().cast("array<string>")
    heads = notes.filter(F.col("dataset").isNotNull()).groupBy("dataset").agg(
        F.min_by(F.struct("notification_type", "suggested_title"), F.struct(*order_by)).alias("__h"),
        F.coalesce(F.bool_or(F.exists(cell, lambda x: F.trim(x) != "")), F.lit(False)).alias("__named"),
    ).select("dataset", "__h.notification_type", F.col("__h.suggested_title").alias("__title"), "__named")
    typed = notes.drop("notification_type").join(heads, "dataset")
    alert = F.col("notification_type") == "high_score_ticket"
    parts = F.when(alert, cell).otherwise(F.array("break_key"))
    rows = typed.select("dataset", F.explode_outer(parts).alias("break_key"))
    bare = heads.filter(alert & ~F.col("__named"))
    if alert_breaks is not None:
        told = alert_breaks.select("dataset", "break_key").join(heads.filter(alert).select("dataset"), "dataset", "left_semi")
        rows = rows.unionByName(told)
        bare = bare.join(alert_breaks.filter(F.trim("break_key") != "").select("dataset").distinct(), "dataset", "left_anti")
    rows = rows.select("dataset", F.trim("break_key").alias("break_key"))
    rows = rows.filter(F.col("break_key") != "").distinct()
    titles = bare.select("dataset", F.coalesce("__title", F.lit("No breaks detected")).alias("break_key"))
    return rows.unionByName(titles)


def issue_status(notes: DataFrame) -> DataFrame:
    """Closed or Updated per (dataset, ticket); alerts are always updates."""
    closes = F.coalesce(F.col("should_close"), F.lit(False)) & (F.col("notification_type") != "high_score_ticket")
    keyed = notes.withColumn("issue_key", F.trim("issue_key")).dropna(subset=["dataset", "issue_key"])
    return keyed.groupBy("dataset", "issue_key").agg(F.when(F.bool_or(closes), "Closed").otherwise("Updated").alias("status"))


# Wording of the two messages.
SUBJECTS = {
    "high_score_ticket": ("[Data Quality] High-score rule breaks detected - ", " requires attention"),
    "invalidated_break": ("[Data Quality] Adaptive rule invalidated, no further action needed - ", ""),
}
OPENINGS = {
    "high_score_ticket": ("High-score rule breaks detected and require attention.", "Detected breaks:"),
    "invalidated_break": ("Data quality rule breaks for Adaptive rules have been invalidated.", "Invalidated breaks:"),
}
CLOSINGS = {
    "high_score_ticket": (
        "Action Required:\n"
        "These high-score rule breaks have been detected with high confidence score (>10).\n"
        "Please review the dataset changes and assess whether these represent genuine\n"
        "data quality issues that need to be addressed."
    ),
    "invalidated_break": (
        "Reason:\n"
        "DQ data profile changes persisted across multiple runs while row count\n"
        "remained within normal fluctuation."
    ),
}


def break_list(breaks: DataFrame) -> DataFrame:
    item, metric = split_break_key("break_key")
    shown = F.coalesce(F.concat(F.lit("- "), item, F.lit(" ("), metric, F.lit(")")), F.concat(F.lit("- "), F.col("break_key")))
    return breaks.select("dataset", "break_key", shown.alias("line"))


def message_parts(breaks: DataFrame, part_lines: int = PART_LINES) -> DataFrame:
    """The whole break list of every message in numbered parts."""
    return text_parts(break_list(breaks), ["dataset"], ["break_key"], "line", part_lines=part_lines)


def render_messages(grouped: DataFrame, breaks: DataFrame, statuses: DataFrame, link_base: str, ticket_base: str = "", part_lines: int = PART_LINES) -> DataFrame:
    """Subject and message per notification; the output is a table, nothing is sent.

    Lists too long for one row go on in messages of the same dataset with a
    higher ``part``; a list that has ended says so there.
    """
    grouped = materialize(grouped, "grouped")
    broken = list_rows(break_list(breaks), ["dataset"], ["break_key"], "line", "break_text", part_lines=part_lines)
    prefix = f"{ticket_base}/browse/" if ticket_base else ""
    logged = statuses.select("dataset", "issue_key", F.concat(F.lit(f"- {prefix}"), F.col("issue_key"), F.lit(" ("), F.col("status"), F.lit(")")).alias("line"))
    issues = list_rows(logged, ["dataset"], ["issue_key"], "line", "issue_text", part_lines=part_lines)
    kinds = grouped.select("dataset", F.col("notification_type").alias("kind")).distinct()
    rows = grouped.join(broken, ["dataset", "part"], "full").join(issues, ["dataset", "part"], "full")
    joined = rows.join(kinds, "dataset").withColumn("notification_type", F.col("kind"))
    alert = F.col("notification_type") == "high_score_ticket"

    def choose(texts: dict, index: int | None = None) -> Column:
        def get(kind: str) -> Column:
            return F.lit(texts[kind] if index is None else texts[kind][index])

        return F.when(alert, get("high_score_ticket")).otherwise(get("invalidated_break"))

    none = F.when(F.col("part") == 0, "- None").otherwise("- None further")
    body = F.concat_ws(
        "\n",
        choose(OPENINGS, 0), F.lit(""), F.lit("Dataset:"), F.col("dataset"), F.concat(F.lit(f"- {link_base}"), F.col("dataset")), F.lit(""),
        choose(OPENINGS, 1), F.coalesce("break_text", none), F.lit(""), F.lit("Tickets:"), F.coalesce("issue_text", none), F.lit(""),
        choose(CLOSINGS),
    )
    return joined.select(
        "dataset", "part", "notification_type", "recipients",
        F.concat(choose(SUBJECTS, 0), F.col("dataset"), choose(SUBJECTS, 1)).alias("subject"),
        body.alias("message"),
    )


"""Ticket inventory: preparation, stable titles, choice of a ticket, planned actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ACTIVE_STATUSES, labels_to_array, squeeze
from .relational import first_row, union_all


def nested(df: DataFrame, path: str, kind: str = "string") -> Column:
    """Value at a struct path of the schema, null when the schema lacks it."""
    at: T.DataType = df.schema
    for step in path.split("."):
        if not isinstance(at, T.StructType) or step not in at.fieldNames():
            return F.lit(None).cast(kind)
        at = at[step].dataType
    return F.col(path)


def day_of(c: Column) -> Column:
    """Calendar day as written, whatever offset follows it."""
    return F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")


def prepare_tickets(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sub-tasks under a dataset, dataset tasks, and epics, with the report columns of each."""

    def get(path: str) -> Column:
        return nested(raw, f"fields.{path}")

    def first_of(path: str, name: str) -> Column:
        found = nested(raw, f"fields.{path}", f"array<struct<{name}:string>>")
        return F.get(found, F.lit(0))[name]

    staged = raw.select(
        get("assignee.displayName").alias("assignee"),
        get("assignee.emailAddress").alias("assignee_email"),
        first_of("components", "name").alias("project"),
        day_of(get("created")).alias("date_created"),
        day_of(get("updated")).alias("date_updated"),
        get("labels").alias("labels"),
        get("parent.fields.summary").alias("parent_summary"),
        get("parent.key").alias("parent_key"),
        get("priority.name").alias("priority"),
        get("reporter.displayName").alias("reporter"),
        get("resolution.name").alias("resolution_name"),
        day_of(get("resolutiondate")).alias("date_resolved"),
        get("status.name").alias("status"),
        get("summary").alias("title"),
        get("issuetype.name").alias("issue_type"),
        first_of("versions", "name").alias("version_name"),
        first_of("versions", "description").alias("market"),
        nested(raw, "key").alias("key"),
    )
    out = staged.withColumns(
        {
            "date_created_yyyymm": F.date_format("date_created", "yyyy-MM"),
            "issue_duration_days": F.datediff("date_updated", "date_created"),
            "date_updated_yyyymm": F.date_format("date_updated", "yyyy-MM"),
            "date_resolved_yyyymm": F.date_format("date_resolved", "yyyy-MM"),
            "report_date": F.date_format("date_updated", "yyyy-MM"),
        }
    ).filter(~F.col("version_name").eqNullSafe("DELETED"))
    subtasks = out.filter((F.col("issue_type") == "Sub-task") & F.col("parent_summary").startswith("ds_"))
    tasks = out.filter((F.col("issue_type") == "Task") & F.col("title").startswith("ds_"))
    return subtasks, tasks, out.filter(F.col("issue_type") == "Epic")


def active_subtasks(tickets: DataFrame) -> DataFrame:
    return tickets.filter((F.lower("issue_type") == "sub-task") & F.col("status").isin(*ACTIVE_STATUSES))


def stable_titles(tickets: DataFrame, tie: str = "key", label: str = "adaptive") -> DataFrame:
    """Title of the latest-updated active labelled sub-task per normalised dataset."""
    labelled = active_subtasks(tickets).withColumn("dataset_norm", squeeze("parent_summary")).filter(
        (F.col("dataset_norm") != "") & F.array_contains(labels_to_array("labels"), label)
    )
    latest = first_row(labelled, ["dataset_norm"], [F.desc_nulls_last("date_updated"), F.asc(tie)])
    return latest.select("dataset_norm", F.col("title").alias("stable_title"))


def pick_ticket(datasets: DataFrame, tickets: DataFrame, new_tickets: DataFrame, tie: str = "key", new_tie: str = "SUBTASK") -> DataFrame:
    """One ticket per dataset: latest active sub-task, else latest sub-task, else a newly logged one."""
    wanted = datasets.select("dataset").filter(F.trim("dataset") != "").distinct()
    subtasks = tickets.filter(F.lower("issue_type") == "sub-task").select(
        F.col("parent_summary").alias("dataset"),
        F.when(F.col("status").isin(*ACTIVE_STATUSES), 0).otherwise(1).alias("tier"),
        F.col("date_updated").alias("at"),
        F.col("key").alias("issue_key"),
        F.col(tie).cast("string").alias("tie"),
    )
    logged = new_tickets.select(
        "dataset", F.lit(2).alias("tier"), F.lit(None).cast(subtasks.schema["at"].dataType).alias("at"),
        F.col("SUBTASK").alias("issue_key"), F.col(new_tie).cast("string").alias("tie"),
    )
    choices = union_all([subtasks, logged]).join(wanted, "dataset", "left_semi")
    picked = first_row(choices, ["dataset"], ["tier", F.desc_nulls_last("at"), F.asc("tie")])
    return wanted.join(picked.select("dataset", "issue_key"), "dataset", "left")


def plan_ticket_actions(
    candidates: DataFrame, tickets: DataFrame, sources: Sequence[str] = ("adaptive", "dupes", "pattern"), tie: str = "key"
) -> DataFrame:
    """What to do for each candidate: a table of actions, no side effects.

    The parent is the task titled like the dataset.  Profile sources look for
    an open sub-task that carries their label and keep its title; other
    sources look for the newest sub-task with the suggested title.
    """
    tasks = tickets.filter(F.lower("issue_type") == "task").select(
        F.col("title").alias("dataset"), F.col("key").alias("parent_key"), F.col(tie).alias("__tie")
    )
    parents = first_row(tasks, ["dataset"], ["__tie"]).drop("__tie")
    subtasks = tickets.filter(F.lower("issue_type") == "sub-task").select(
        "parent_key",
        F.col("key").alias("sub_key"),
        F.col("title").alias("sub_title"),
        F.col("status").isin(*ACTIVE_STATUSES).alias("sub_open"),
        labels_to_array("labels").alias("sub_labels"),
        F.col("date_updated").alias("updated"),
        F.col("date_created").alias("created"),
        F.col(tie).alias("__tie"),
    )
    by_label = subtasks.filter("sub_open").select(
        "parent_key", F.explode(F.array_intersect("sub_labels", F.array(*[F.lit(s) for s in sources]))).alias("ticket_source"),
        "sub_key", "sub_title", "updated", "__tie",
    )
    labelled = first_row(by_label, ["parent_key", "ticket_source"], [F.desc_nulls_last("updated"), F.asc("__tie")]).select(
        "parent_key", "ticket_source", F.col("sub_key").alias("label_key"), F.col("sub_title").alias("label_title")
    )
    titled = first_row(
        subtasks.withColumn("title_norm", squeeze("sub_title")), ["parent_key", "title_norm"], [F.desc_nulls_last("created"), F.asc("__tie")]
    ).select("parent_key", "title_norm", F.col("sub_key").alias("title_key"), F.col("sub_open").alias("title_open"))

    joined = (
        candidates.filter(F.trim("dataset") != "")
        .withColumn("title_norm", squeeze("suggested_title"))
        .join(parents, "dataset", "left")
        .join(labelled, ["parent_key", "ticket_source"], "left")
        .join(titled, ["parent_key", "title_norm"], "left")
    )
    profile = F.col("ticket_source").isin(*sources)
    existing = F.when(profile, F.col("label_key")).otherwise(F.col("title_key"))
    action = (
        F.when(existing.isNull(), "create")
        .when(F.col("ticket_source") == "adaptive", "comment")
        .when(profile | F.col("title_open"), "update-description")
        .otherwise("reopen-comment")
    )
    status = F.when(action == "create", "New").when(action == "reopen-comment", "Reopened").otherwise("Old")
    title = F.when(profile, F.coalesce(F.nullif(F.trim("label_title"), F.lit("")), F.col("suggested_title"))).otherwise(F.col("suggested_title"))
    return joined.select(
        *[F.col(f"`{c}`") for c in candidates.columns],
        "parent_key",
        existing.alias("existing_key"),
        title.alias("title"),
        action.alias("action"),
        status.alias("SUBTASK_STATUS"),
    )

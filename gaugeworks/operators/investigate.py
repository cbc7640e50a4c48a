"""Break investigation: persistence over runs, heuristics, invalidation, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import fixed, fmt_significant, safe_double
from ..functions.text import break_type, noted_breaks, raised_breaks
from ..session import materialize
from .relational import PART_LINES, first_row, join_null_safe, list_rows, union_all

# Runs a break must persist, tolerated row change, types that count as profile breaks.
PERSIST_RUNS = 3
ROW_CHANGE_PCT = 20.0
PROFILE_TYPES = ("MIN VALUE", "MAX VALUE", "CARDINALITY", "DATA_TYPE", "UNIQUE", "UNIQUENESS")


def parse_assignment(df: DataFrame, col: str) -> DataFrame:
    """Assignment id and uuid from a struct, JSON text or quoted literal; rows lacking one are dropped."""
    kind = T.StructType([T.StructField("id", T.LongType()), T.StructField("uuid", T.StringType())])
    c = F.col(col)
    parsed = c if isinstance(df.schema[col].dataType, T.StructType) else F.from_json(c, kind, {"allowSingleQuotes": "true"})
    named = df.withColumn("__a", parsed)
    return named.withColumns({"assignment_id": F.col("__a.id"), "assignment_uuid": F.col("__a.uuid")}).drop("__a").dropna(
        subset=["assignment_id", "assignment_uuid"]
    )


def breaking_keys(findings: DataFrame, run_col: str) -> DataFrame:
    """Distinct (dataset, run, key) of breaking findings of past runs."""
    return findings.filter(F.lower("status") == "breaking").select("dataset", run_col, "key").distinct()


BITS = 62  # runs that one number of a set holds


def run_lists(runs: DataFrame, run_col: str, run_order: Sequence[Column]) -> DataFrame:
    """The checked runs of each dataset in order: dataset, ``__runs``."""
    numbered = runs.withColumn("__n", F.row_number().over(Window.partitionBy("dataset").orderBy(*run_order)))
    entry = F.struct(F.col("__n").alias("n"), F.col(run_col).alias("run"))
    return numbered.groupBy("dataset").agg(F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["run"]).alias("__runs"))


def persistence(
    breaks: DataFrame, runs: DataFrame, keys_by_run: DataFrame, run_col: str, run_order: Sequence[Column], min_runs: int = PERSIST_RUNS, most_runs: int | None = None
) -> DataFrame:
    """In how many of a dataset's checked runs each break's key breaks, and in which.

    ``runs`` holds the few checked runs of each dataset, so the lists are as
    short as that; ``breaks`` carries ``break_key``.  Each run of a dataset is
    one bit; the runs in which a key breaks are one bitwise sum, so a key may
    come any number of times per run.  Without ``most_runs``, the most runs of
    any dataset, they are counted first.
    """
    lists = run_lists(runs, run_col, run_order)
    most = most_runs or lists.agg(F.max(F.size("__runs"))).first()[0] or 1
    words = list(range(-(-most // BITS)))
    one = F.lit(1).cast("bigint")
    hits = keys_by_run.join(lists, "dataset").withColumn("__at", (F.array_position("__runs", F.col(run_col)) - 1).cast("int")).filter("__at >= 0")
    bits = [F.bit_or(F.when(F.floor(F.col("__at") / BITS) == w, F.call_function("shiftleft", one, F.col("__at") % BITS))).alias(f"__w{w}") for w in words]
    sets = hits.groupBy("dataset", F.col("key").alias("break_key")).agg(*bits)
    joined = breaks.join(sets, ["dataset", "break_key"], "left").join(lists, "dataset", "left")

    def held(w: int) -> Column:
        return F.coalesce(f"__w{w}", F.lit(0).cast("bigint"))

    def broke(run: Column, i: Column) -> Column:
        found = F.lit(False)
        for w in words:
            found = F.when(F.floor(i / BITS) == w, F.call_function("shiftright", held(w), i - w * BITS).bitwiseAND(one) == 1).otherwise(found)
        return found

    def listed(names: Column) -> Column:
        return F.coalesce(F.array_join(F.transform(names, lambda x: x.cast("string")), ", "), F.lit(""))

    count = sum((F.bit_count(held(w)) for w in words[1:]), F.bit_count(held(0)))
    return joined.withColumns(
        {
            "persist_cnt": count,
            "persist_ok": count >= min_runs,
            "persist_runs": listed(F.filter("__runs", broke)),
            "checked_runs": listed(F.col("__runs")),
        }
    ).drop("__runs", *[f"__w{w}" for w in words])


def any_in_group(df: DataFrame, keys: Sequence[str], flag: str, out: str, source: DataFrame | None = None) -> DataFrame:
    """Whether the flag is set anywhere in the group; counted before the join, so a large group stays spread out.

    ``source`` holds the same rows before other columns were joined to them, so that those joins are not computed twice.
    """
    groups = (df if source is None else source).dropna(subset=list(keys)).groupBy(*keys).agg(F.bool_or(flag).alias(out))
    return join_null_safe(df, groups, keys, "left")


def row_change(breaks: DataFrame, history: DataFrame, tie: Sequence[str], source: DataFrame | None = None) -> DataFrame:
    """Row change per break: the first row-count break of its dataset decides, else the run in history.

    ``history`` has dataset, run_key, row_pct_change, row_cnt and rows_prev, one row per run day; ``source`` is as in ``any_in_group``.
    """
    counted = first_row((breaks if source is None else source).filter(F.upper("type") == "ROW_COUNT"), ["dataset"], list(tie)).select(
        "dataset", F.lit(True).alias("__found"), F.col("perChange").alias("__p"), F.col("value").alias("__v"), F.col("mean").alias("__m")
    )
    past = history.filter(F.col("run_key").isNotNull()).select(
        "dataset", "run_key", F.col("row_pct_change").alias("__hp"), F.col("row_cnt").cast("double").alias("__hv"), F.col("rows_prev").cast("double").alias("__hm")
    )
    joined = breaks.join(counted, "dataset", "left").join(past, ["dataset", "run_key"], "left")

    def pick(found: str, else_: str) -> Column:
        return F.when(F.col("run_key").isNotNull(), F.when(F.col("__found"), F.col(found)).otherwise(F.col(else_)))

    return joined.withColumns(
        {"row_pct_change": pick("__p", "__hp"), "rows_current": pick("__v", "__hv"), "rows_prev": pick("__m", "__hm")}
    ).drop("__found", "__p", "__v", "__m", "__hp", "__hv", "__hm")


def heuristics(df: DataFrame, pct: float = ROW_CHANGE_PCT, profile_types: Sequence[str] = PROFILE_TYPES) -> DataFrame:
    """Reasons to set a persistent break aside, and the decision."""
    small = F.coalesce(F.abs(safe_double("row_pct_change")) < pct, F.lit(False))
    row_ok = F.when(~F.col("has_row_count_break"), F.lit(True)).otherwise(small)
    flagged = df.withColumn("row_ok", row_ok).withColumns(
        {
            "h_rc_small_change": F.col("is_row_count") & small,
            "h_null_reduces": F.col("break_type").contains("NULL") & F.coalesce(safe_double("perChange") < 0, F.lit(False)) & F.col("row_ok"),
            "h_profile_with_row_ok": F.col("break_type").isin(*profile_types) & F.col("row_ok"),
        }
    )
    any_reason = F.col("h_rc_small_change") | F.col("h_null_reduces") | F.col("h_profile_with_row_ok")
    return flagged.withColumn("to_invalidate", F.col("persist_ok") & any_reason)


def annotate(df: DataFrame, min_runs: int = PERSIST_RUNS, pct: float = ROW_CHANGE_PCT) -> DataFrame:
    band = f"±{pct:.0f}%"

    def shown(name: str, digits: int) -> Column:
        return F.coalesce(fmt_significant(name, digits), F.lit("NA"))

    def percent(name: str) -> Column:
        number = safe_double(name)
        return F.when(number.isNull(), F.lit("NA")).otherwise(fixed(number, 2))

    reasons = [
        F.concat(F.lit("persist_cnt="), F.col("persist_cnt").cast("string"), F.lit(f"/{min_runs} across runs ["), F.col("checked_runs"), F.lit("]")),
        F.when(F.col("h_null_reduces"), F.concat(F.lit("NULL% reduced (perChange="), percent("perChange"), F.lit(f"%) and row_ok ({band})"))),
        F.when(F.col("h_profile_with_row_ok"), F.concat(F.col("break_type"), F.lit(f" break but row_ok ({band})"))),
        F.when(F.col("h_rc_small_change"), F.concat(F.lit(f"ROW_COUNT change within {band} (row_pct_change="), percent("row_pct_change"), F.lit("%)"))),
        F.concat(F.lit("mean="), shown("mean", 6), F.lit(", value="), shown("value", 6), F.lit(", z="), shown("zscore", 3)),
    ]
    return df.withColumn("annotation", F.concat_ws(" | ", *reasons))


# Columns of the invalidation list, in order.
INVALIDATION_COLUMNS = (
    "dataset", "runId", "break_key", "break_type", "assignment_id", "assignment_uuid", "includeKey", "annotation",
    "persist_cnt", "persist_runs", "checked_runs", "row_pct_change", "rows_current", "rows_prev",
)


def invalidation_list(investigated: DataFrame) -> DataFrame:
    chosen = annotate(investigated.filter("to_invalidate")).withColumn("includeKey", F.lit(True))
    return chosen.select(*INVALIDATION_COLUMNS)


def breaks_in_text(df: DataFrame, keys: Sequence[str], col: str, note_tag: str | None = None) -> DataFrame:
    """Distinct break names per key found in ticket text, or in notes that carry ``note_tag``."""
    names = raised_breaks(col) if note_tag is None else noted_breaks(col, note_tag)
    return df.select(*keys, F.explode_outer(names).alias("break_key")).filter(F.col("break_key").isNotNull()).distinct()


def outstanding(raised: DataFrame, already: DataFrame, now: DataFrame, key: str = "issue_key") -> DataFrame:
    """Per ticket: how many breaks were raised, set aside before, set aside now, and are left; close when none is left."""
    tagged = union_all([df.select(key, "break_key", F.lit(tag).alias("tag")) for tag, df in (("raised", raised), ("already", already), ("now", now))])

    def has(tag: str) -> Column:
        return F.bool_or(F.col("tag") == tag)

    flags = tagged.groupBy(key, "break_key").agg(has("raised").alias("r"), has("already").alias("a"), has("now").alias("n"))
    left = F.col("r") & ~F.col("a") & ~F.col("n")
    counts = flags.groupBy(key).agg(
        F.count_if("r").alias("raised_breaks_cnt"), F.count_if("a").alias("already_invalidated_cnt"),
        F.count_if("n").alias("newly_invalidated_cnt"), F.count_if(left).alias("outstanding_cnt"),
    )
    return counts.withColumn("should_close", (F.col("raised_breaks_cnt") > 0) & (F.col("outstanding_cnt") == 0))


def _high(tickets: DataFrame, invalidated: DataFrame, threshold: float) -> DataFrame:
    high = tickets.withColumn("score", safe_double("score")).filter(F.col("score") > threshold)
    return high.join(invalidated.select("dataset").distinct(), "dataset", "left_anti")


def alert_breaks(tickets: DataFrame, breaks: DataFrame, invalidated: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Every (dataset, runId, break_key) that an alert tells of, as a table."""
    keys = ["dataset", "runId"]
    named = join_null_safe(breaks, _high(tickets, invalidated, threshold).select(*keys), keys, "left_semi")
    return named.select(*keys, F.col("key").alias("break_key")).filter(F.col("break_key").isNotNull()).distinct()


def high_score_alerts(tickets: DataFrame, breaks: DataFrame, invalidated: DataFrame, threshold: float = 10.0, part_lines: int = PART_LINES) -> DataFrame:
    """High-scoring new tickets of datasets without invalidations, with the break names of their run.

    A row holds up to ``part_lines`` names; a longer list goes on in rows of the
    same ticket with a higher ``part``.  ``alert_breaks`` has one row per name.
    """
    high = materialize(_high(tickets, invalidated, threshold), "high-tickets")
    keys = ["dataset", "runId"]
    named = join_null_safe(breaks, high.select(*keys), keys, "left_semi").select(
        *keys, F.col("key").alias("detected_breaks"), F.nullif(break_type("type", "key"), F.lit("")).alias("break_types")
    )
    named = materialize(named, "alert-breaks")
    lists = None
    for column in ("detected_breaks", "break_types"):
        values = named.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
        texts = list_rows(values, keys, [column], column, "__text", " | ", part_lines).withColumnRenamed("__text", column)
        lists = texts if lists is None else join_null_safe(lists, texts, [*keys, "part"], "left")  # no more types than names
    joined = join_null_safe(high, lists, keys, "left").withColumn("part", F.coalesce("part", F.lit(0)))
    issue = F.col("SUBTASK") if "SUBTASK" in tickets.columns else F.lit(None).cast("string")
    extra = [c for c in ("business_unit", "rows_current", "rows_prev", "rows_pct_change_vs_prev") if c in tickets.columns]
    return joined.select(
        *keys, "part", "score", "suggested_title", "suggested_priority", "detected_breaks", "break_types",
        F.lit("high_score_ticket").alias("notification_type"),
        F.lit("High-Scoring Tickets Requiring Attention").alias("notification_title"),
        issue.alias("issue_key"), *extra,
    )


def notifications(invalidated: DataFrame, alerts: DataFrame) -> DataFrame:
    """Both notification lists in one table; columns of one side only are null in the other."""
    tagged = invalidated.withColumns(
        {"notification_type": F.lit("invalidated_break"), "notification_title": F.lit("Adaptive Rules Invalidated")}
    )
    return tagged.unionByName(alerts, allowMissingColumns=True)

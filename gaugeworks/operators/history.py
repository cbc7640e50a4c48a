"""History of runs: consolidation, monthly snapshots, newest runs and their changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import fmt_num, fmt_pct, repair_timestamp, run_key, to_bool
from .relational import first_row, ordering, top_n
from .report import literal_map
from .state import ensure_columns, merge_insert_only, new_rows


def normalize_history(df: DataFrame, markets: Mapping[str, str], run_col: str = "runId", market_col: str = "Market") -> DataFrame:
    """Run ids cut to their day, market names unescaped and mapped where known."""
    market = F.replace(F.trim(F.col(market_col)), F.lit("&AMP;"), F.lit("&"))
    return df.withColumns(
        {
            run_col: F.substring(F.col(run_col).cast("string"), 1, 10),
            market_col: F.coalesce(F.try_element_at(literal_map(markets), market), market),
        }
    )


def union_keep_last(history: DataFrame, current: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """History and current rows with one row per key; current wins, then ``order_by``."""
    both = history.withColumn("__src", F.lit(0)).unionByName(current.withColumn("__src", F.lit(1)), allowMissingColumns=True)
    return first_row(both, keys, [F.desc("__src"), *order_by]).drop("__src")


def append_new(history: DataFrame, merged: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """History plus the merged rows whose key it lacks."""
    return merge_insert_only(history, new_rows(merged, history, keys), keys, order_by)


def monthly_snapshot(
    merged: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    merged_order: Sequence[Column],
    history_order: Sequence[Column],
    period: str = "report_time",
    drop: Sequence[str] = (),
) -> DataFrame:
    """Last row per dataset and period, from history as a whole if its latest period is fuller.

    The choice is made by scalar subqueries inside the plan.
    """
    by = [*keys, period]
    monthly = first_row(merged.drop(*drop), by, merged_order)
    past = first_row(history.drop(*drop), by, history_order)
    latest = history.select(F.max(period))

    def kept_in_latest(df: DataFrame) -> Column:
        """Rows the period keeps, one per key: only its own rows are read, nothing is ranked for the count."""
        return df.filter(F.col(period) == latest.scalar()).select(F.count_distinct(F.struct(*keys))).scalar()

    fuller = kept_in_latest(history) > kept_in_latest(merged)
    return monthly.filter(~fuller).unionByName(past.filter(fuller), allowMissingColumns=True)


def project_for_sink(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order: switches, repaired timestamps, nulls for absent ones."""
    full = ensure_columns(df, schema)
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = to_bool(c)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and isinstance(full.schema[f.name].dataType, T.StringType):
            c = repair_timestamp(c).cast(f.dataType)
        else:
            c = c.cast(f.dataType)
        out.append(c.alias(f.name))
    return full.select(*out)


def last_n_runs(runs: DataFrame, datasets: DataFrame | None, n: int, key: str, time_col: str, tie: str) -> DataFrame:
    """Newest ``n`` runs per dataset; runs without a time come first, as the database orders them."""
    wanted = runs if datasets is None else runs.join(datasets.select(key), key, "left_semi")
    return top_n(wanted, [key], [F.desc_nulls_first(time_col), F.desc(tie)], n)


def change_vs_previous(runs: DataFrame, newest: int, key: str, time_col: str, tie: str, rows: str) -> DataFrame:
    """Previous rows and percentage change among the newest runs of a dataset; a zero predecessor gives null."""
    window = Window.partitionBy(key).orderBy(*ordering([time_col, tie]))
    recent = last_n_runs(runs, None, newest, key, time_col, tie)
    previous = recent.withColumn("rows_prev", F.lag(rows).over(window))
    change = F.try_divide(F.col(rows) - F.col("rows_prev"), F.col("rows_prev")) * 100.0
    return previous.withColumns({"row_pct_change": change, "run_key": run_key(F.col(time_col))})


def newest_runs(runs: DataFrame, n: int, key: str, time_col: str, tie: str) -> DataFrame:
    return top_n(runs, [key], [F.desc_nulls_last(time_col), F.desc(tie)], n)


def _recent_runs(runs: DataFrame, n: int, key: str, time_col: str, tie: str, rows: str, extra: Sequence[str]) -> DataFrame:
    """One row per dataset with its newest runs, oldest first, and the padded change of each."""
    window = Window.partitionBy(key).orderBy(*ordering([time_col, tie]))
    padded = F.last(rows, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))
    recent = last_n_runs(runs, None, n, key, time_col, tie).withColumn("__filled", padded)
    previous = F.lag("__filled").over(window)
    change = (F.try_divide(F.col("__filled").cast("double"), previous.cast("double")) - 1) * 100.0
    run = F.struct(F.col(time_col).alias("at"), F.col(tie).alias("tie"), F.col(rows).alias("rows"), F.col("__pct").alias("pct"), *extra)
    return recent.withColumn("__pct", change).groupBy(key).agg(F.sort_array(F.collect_list(run)).alias("__runs"))


def history_lines(runs: Column, zone: str, label: str, n: int, scores: Sequence[str]) -> Column:
    """Table of the newest runs, newest first, with times shown in a zone."""
    header = [f"*Row count history (last {n} runs)*", "", "| runDate | rows | % change vs prev | behaviorScore | DQScore |", "|---|---:|---:|---:|---:|"]

    def line(run: Column) -> Column:
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), run["at"].cast("timestamp_ntz"))
        shown = F.coalesce(F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit(f" {label}")), F.lit("NA"))
        cells = [shown, fmt_num(run["rows"]), fmt_pct(run["pct"]), *[fmt_num(run[s]) for s in scores]]
        return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))

    return F.array_join(F.concat(F.array(*[F.lit(h) for h in header]), F.transform(F.reverse(runs), line)), "\n")


def row_history(
    runs: DataFrame,
    wanted: DataFrame,
    key: str,
    time_col: str,
    tie: str,
    rows: str,
    at: str,
    zone: str,
    label: str,
    scores: Sequence[str] = ("behaviorScore", "DQScore"),
    n: int = 7,
) -> DataFrame:
    """Row counts at each wanted (dataset, time): current, previous, change, and a history table.

    The table shows times in ``zone`` with ``label`` behind them.

    Without a run at that time the latest run answers.  At most ``n`` runs per
    dataset are kept together.
    """
    held = _recent_runs(runs.join(wanted.select(key), key, "left_semi"), n, key, time_col, tie, rows, scores)
    joined = wanted.join(held, key, "left")
    at_run = F.filter("__runs", lambda r: r["at"] == F.col(at))
    before = F.filter("__runs", lambda r: r["at"] < F.col(at))
    matched = F.size(at_run) > 0
    current = F.when(matched, F.try_element_at(at_run, F.lit(-1))).otherwise(F.try_element_at("__runs", F.lit(-1)))
    previous = F.when(matched, F.try_element_at(before, F.lit(-1))).otherwise(F.try_element_at("__runs", F.lit(-2)))
    text = F.coalesce(
        history_lines(F.col("__runs"), zone, label, n, scores),
        F.lit(f"*Row count history (last {n} runs):* NA (no history found)"),
    )
    return joined.withColumns({"__current": current, "__previous": previous}).select(
        *[F.col(f"`{c}`") for c in wanted.columns],
        F.col("__current.rows").alias("rows_current"),
        F.col("__previous.rows").alias("rows_prev"),
        F.col("__current.pct").alias("rows_pct_change_vs_prev"),
        text.alias("history_text"),
    )

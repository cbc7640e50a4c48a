"""Dataset catalogue: names, owners, regions, latest runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import as_col, blank_to_null
from .relational import first_row, union_all


def filter_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.filter(F.col(col).startswith(prefix))


def resolve_names(
    mapping: DataFrame, names: DataFrame, key: str, id_col: str, name_col: str, order_by: Sequence[Column | str]
) -> DataFrame:
    """Key -> name over an id; the last mapping of a key wins, unknown or blank names are null."""
    last = first_row(mapping, [key], order_by)
    known = names.select(F.col(id_col), blank_to_null(name_col).alias(name_col))
    return last.join(known, id_col, "left").select(key, id_col, name_col)


def parse_unit(df: DataFrame, col: str) -> DataFrame:
    """Market, Project and CDE from a unit name cut at its first " - "."""
    text = blank_to_null(as_col(col))
    parts = F.split(text, " - ", 2)
    market = F.nullif(F.trim(F.get(parts, F.lit(0))), F.lit(""))
    project = F.nullif(F.trim(F.get(parts, F.lit(1))), F.lit(""))
    flag = F.when(F.upper(project) == "CDE", "Yes").otherwise("No")
    return df.withColumns({"Market": market, "Project": project, "CDE": flag})


def union_regions(frames_by_region: dict[str, DataFrame]) -> DataFrame:
    return union_all([df.withColumn("region", F.lit(name)) for name, df in frames_by_region.items()])


def latest_run(runs: DataFrame, key: str, run_col: str, time_col: str) -> DataFrame:
    """Newest run per key; equal times resolve to the larger run id."""
    newest = F.max(F.struct(F.col(time_col), F.col(run_col)))
    return runs.filter(F.col(time_col).isNotNull()).groupBy(key).agg(newest.alias("__n")).select(
        key, F.col(f"__n.{run_col}").alias(run_col), F.col(f"__n.{time_col}").alias(time_col)
    )

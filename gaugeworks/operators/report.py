"""Quarterly report by domain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import as_col, composite_id, quality_ratio
from .relational import first_row, join_null_safe

# Columns of the domain report, in order.
DOMAIN_COLUMNS = (
    "Domain", "System or Platform", "Applicable Critical Data Element", "ID", "Name", "Rule", "DQ Dimension",
    "Data Quality Score", "Number of Records", "DQ Trigger", "Market", "Project", "jobSchedule", "Data Domain", "dataset",
)


def runs_in_window(runs: DataFrame, datasets: DataFrame, as_of: Column, days: int, key: str, time_col: str) -> DataFrame:
    """Runs of the last ``days`` days per dataset; datasets without runs count zero."""
    recent = runs.filter(F.col(time_col) >= F.date_sub(as_of, days).cast("timestamp_ntz"))
    counts = recent.groupBy(key).agg(F.count("*").alias("__n"))
    wanted = datasets.select(key).filter(F.col(key).isNotNull()).distinct()
    return wanted.join(counts, key, "left").select(key, F.coalesce("__n", F.lit(0)).cast("bigint").alias("run_count"))


def lookup_distinct(df: DataFrame, lookup: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Values for each key that occurs, looked up once per distinct key."""
    wanted = df.select(*keys).distinct()
    side = first_row(lookup.join(wanted, list(keys), "left_semi"), keys, order_by).select(*keys, *columns)
    return join_null_safe(df, side, keys, "left")


def literal_map(values: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def split_clean(text: Column, sep: str) -> Column:
    return F.filter(F.transform(F.split(text, sep), lambda x: F.trim(x)), lambda x: x != "")


def map_multi(col: Column | str, mapping: Mapping[str, str], sep: str = ",") -> Column:
    """Codes of a list text replaced through a mapping: unknown ones stay, blank targets vanish.

    The mapping is configuration and travels inside the expression.
    """
    table = literal_map(mapping)
    codes = split_clean(F.coalesce(as_col(col), F.lit("")), sep)
    named = F.transform(codes, lambda x: F.coalesce(F.try_element_at(table, x), x))
    return F.array_join(F.flatten(F.transform(named, lambda x: split_clean(x, sep))), sep)


def map_default(df: DataFrame, col: str, mapping: DataFrame, key: str, value: str, default: str, out: str) -> DataFrame:
    side = mapping.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    joined = df.join(side, F.col(col) == F.col("__k"), "left")
    return joined.withColumn(out, F.coalesce("__v", F.lit(default))).drop("__k", "__v")


def flag_member(df: DataFrame, reference: DataFrame, key: str, out: str) -> DataFrame:
    side = reference.select(F.col(key)).distinct().withColumn("__in", F.lit(True))
    return df.join(side, key, "left").withColumn(out, F.when(F.col("__in"), "Yes").otherwise("No")).drop("__in")


def explode_domains(
    df: DataFrame, mapping: Mapping[str, str], systems: DataFrame, triggers: DataFrame, default_system: str
) -> DataFrame:
    """One row per mapped domain of each rule; rows without a domain are dropped.

    ``systems`` has ``connectionName`` and ``system``; ``triggers`` has ``dataset``.
    Lookups run before the explode, on the narrower rows.
    """
    known = df.filter(map_multi("subDomain", mapping) != "")
    named = map_default(known, "connectionName", systems, "connectionName", "system", default_system, "System or Platform")
    flagged = flag_member(named, triggers, "dataset", "DQ Trigger")
    shaped = flagged.withColumns(
        {
            "Applicable Critical Data Element": F.col("columnName"),
            "ID": composite_id("db_nm", "table_nm"),
            "Name": F.col("ruleNm"),
            "Rule": F.col("businessDesc"),
            "DQ Dimension": F.col("dimName"),
            "Data Quality Score": quality_ratio("score"),
            "Number of Records": F.coalesce(F.col("run_count").try_cast("bigint"), F.lit(0)),
            "System or Platform": F.nullif(F.col("System or Platform"), F.lit("")),
            "Domain": F.explode(F.split(map_multi("subDomain", mapping), ",")),
        }
    )
    return shaped.select(*[F.col(f"`{c}`") for c in DOMAIN_COLUMNS])


def split_by_domain(df: DataFrame, groups: Mapping[str, str], column: str = "Domain") -> dict[str, DataFrame]:
    """One output per group; the filters reach the scan of a table partitioned by the column."""
    return {name: df.filter(F.col(column) == value) for name, value in groups.items()}

"""Keyed tables: insert-only, change-aware and partial merges, pruning, sync, checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .relational import first_row, join_null_safe, renamed, union_all


def _require_unique_columns(df: DataFrame) -> None:
    repeated = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if repeated:
        raise ValueError(f"column names occur more than once: {repeated}")


def ensure_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Absent columns of the schema added as nulls; other columns untouched."""
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *missing)


def conform(df: DataFrame, schema: StructType, primary_key: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns and types of the schema; with a key, duplicates and null keys raise."""
    shaped = ensure_columns(df, schema).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    return assert_primary_key(shaped, primary_key) if primary_key else shaped


def _null_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])


def assert_primary_key(df: DataFrame, keys: Sequence[str], problem: str | None = None) -> DataFrame:
    """The same rows; evaluating them raises on a null or repeated key.

    Keys are counted by a plain aggregate, which combines copies of a key
    before the shuffle; for unique keys its groups are the rows.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(True)
    grouped = df.groupBy(*keys).agg(F.count("*").alias("__copies"), F.first(row).alias("__row"))
    message = F.lit(problem or f"key {list(keys)} is null or repeated")
    broken = _null_key(keys) | (F.col("__copies") > 1)
    checked = grouped.filter(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns])


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(_null_key(keys) | (F.col("copies") > 1))


def snapshot_replace(new: DataFrame, old: DataFrame) -> DataFrame:
    """New rows under the union of both schemas: old columns first, absent ones null."""
    _require_unique_columns(new)
    return old.filter(F.lit(False)).unionByName(new, allowMissingColumns=True)


def new_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key, null included, is not among the existing keys."""
    return join_null_safe(df, existing.select(*keys), keys, "left_anti")


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Target plus the first source row of every key the target lacks."""
    missing = [c for c in target.columns if c not in source.columns]
    shaped = source.select(
        *[F.col(f"`{c}`") for c in source.columns],
        *[F.lit(None).cast(target.schema[c].dataType).alias(c) for c in missing],
    )
    fresh = first_row(new_rows(shaped, target, keys), keys, order_by)
    return target.unionByName(fresh.select(*[F.col(f"`{c}`") for c in target.columns]))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    change_columns: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Target after an upsert, with ``_action`` = insert, update or keep.

    A stored row changes only if one of ``change_columns`` differs (nulls
    compare as values); then every written column refreshes.  Without non-key
    columns to write, this is the insert-only merge.  A null key on either side
    raises, and so does a key that occurs twice in the source.
    """
    written = [c for c in (columns or target.columns) if c not in keys and c in source.columns]
    if not written:
        merged = merge_insert_only(target, source, keys, order_by or keys)
        return merged.withColumn("_action", F.lit("keep"))
    tracked = [c for c in (change_columns if change_columns is not None else written) if c in written]
    incoming = assert_primary_key(source.select(*keys, *written), keys, "source key is null or occurs twice").withColumn("__in", F.lit(True))
    side = renamed(incoming, keys)
    stored_key = F.when(_null_key(keys), F.raise_error(F.lit("stored key is null")).cast("boolean")).otherwise(F.lit(True))
    base = target.filter(stored_key).withColumn("__stored", F.lit(True))
    # No key is null on either side, so plain equality does: the join reuses the partitioning of the key check.
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col("__r_" + k) for k in keys])
    joined = base.join(side, on, "full_outer")
    arrives = F.col("__r___in")
    stored = F.col("__stored")
    differs = reduce(lambda a, b: a | b, [~F.col(f"`{c}`").eqNullSafe(F.col(f"`__r_{c}`")) for c in tracked], F.lit(False))
    action = (
        F.when(stored.isNull() & arrives, "insert")
        .when(stored & arrives & differs, "update")
        .otherwise("keep")
    )
    joined = joined.withColumn("_action", action)
    take = F.col("_action") != "keep"
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.when(stored.isNull(), F.col(f"`__r_{c}`")).otherwise(F.col(f"`{c}`")).alias(c))
        elif c in written:
            out.append(F.when(take, F.col(f"`__r_{c}`")).otherwise(F.col(f"`{c}`")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return joined.select(*out, "_action")


def merge_partial(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert of only the columns the source has; the others keep their stored values."""
    absent = [k for k in keys if k not in source.columns]
    if absent:
        raise ValueError(f"source lacks key columns {absent}")
    present = [c for c in target.columns if c in source.columns]
    return merge_upsert(target, source, keys, present)


def prune_stale(target: DataFrame, source: DataFrame, group_columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Target without rows whose key left a group that the source covers.

    Groups the source does not mention stay whole, and so do null keys.
    """
    groups = source.select(*group_columns).distinct().withColumn("__group", F.lit(True))
    present = source.select(*group_columns, *keys).distinct().withColumn("__present", F.lit(True))
    marked = join_null_safe(target, groups, group_columns, "left")
    marked = join_null_safe(marked, present, [*group_columns, *keys], "left")
    null_key = _null_key(keys)
    keep = F.col("__group").isNull() | F.col("__present").isNotNull() | null_key
    return marked.filter(keep).drop("__group", "__present")


def seed(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Reference rows written over the stored ones of the same key."""
    return merge_upsert(target, rows, [key]).drop("_action")


def sync_table(source: DataFrame, target: DataFrame, keys: Sequence[str], update_existing: bool, order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Target after a one-way sync: missing keys arrive, existing ones update on request, none leave."""
    if source.columns != target.columns:
        raise ValueError("source and target need the same columns in the same order")
    if not update_existing:
        return merge_insert_only(target, source, keys, order_by or keys)
    return merge_upsert(target, source, keys).drop("_action")


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns on one side only, or at another place; no rows when compatible."""
    rows = []
    for i, c in enumerate(a.columns):
        if c not in b.columns:
            rows.append((c, "source_only", i))
        elif b.columns.index(c) != i:
            rows.append((c, "order", i))
    rows += [(c, "target_only", i) for i, c in enumerate(b.columns) if c not in a.columns]
    return a.sparkSession.createDataFrame(rows, "column string, side string, ordinal int")


def sync_check(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Everything that forbids a sync: schema differences and keys that are null or repeated."""
    issues = schema_diff(source, target).select("column", "side", F.col("ordinal").cast("bigint").alias("n"))
    for side, df in (("source_key", source), ("target_key", target)):
        bad = key_violations(df, keys).agg(F.count("*").alias("n")).filter("n > 0")
        issues = issues.unionByName(bad.select(F.lit(",".join(keys)).alias("column"), F.lit(side).alias("side"), "n"))
    return issues


def reconcile_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of both sides per table, and whether they match."""
    frames = []
    for name, (a, b) in pairs.items():
        left = a.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit("a").alias("side"), "n")
        right = b.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), F.lit("b").alias("side"), "n")
        frames += [left, right]
    counts = union_all(frames).groupBy("table_name").agg(
        F.max(F.when(F.col("side") == "a", F.col("n"))).alias("source_rows"),
        F.max(F.when(F.col("side") == "b", F.col("n"))).alias("target_rows"),
    )
    return counts.withColumn("matches", F.col("source_rows") == F.col("target_rows"))

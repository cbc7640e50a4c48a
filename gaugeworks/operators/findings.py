"""Findings: unpacking of payloads, enrichment joins, scorecards, rule templates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import blank_to_null
from .relational import first_row, join_null_safe

# Keys under which a service wraps a list, in order of preference.
LIST_WRAPPERS = ("data", "items", "content", "results")


def unwrap_envelope(df: DataFrame, payload: str, first_wrapper: str, out: str = "record") -> DataFrame:
    """One row per object of a payload that is a list, or that holds one under a known key."""
    parsed = df.withColumn("__p", F.try_parse_json(F.col(payload)))
    paths = ["$"] + [f"$.{w}" for w in (first_wrapper, *LIST_WRAPPERS)]
    lists = F.coalesce(*[F.try_variant_get("__p", p, "array<variant>") for p in paths])
    rows = parsed.withColumn(out, F.explode_outer(lists)).drop("__p")
    return rows.filter(F.schema_of_variant(out).startswith("OBJECT"))


def first_record(df: DataFrame, payload: str, fields: dict[str, str], whole: bool = True) -> DataFrame:
    """Fields of the first record: list head, head of a wrapped list, else the object itself."""
    parsed = df.withColumn("__p", F.try_parse_json(F.col(payload)))
    heads = ["$[0]"] + [f"$.{w}[0]" for w in LIST_WRAPPERS]
    candidates = [F.try_variant_get("__p", p, "variant") for p in heads]
    if whole:
        listed = reduce(lambda a, b: a | b, [F.try_variant_get("__p", f"$.{w}", "array<variant>").isNotNull() for w in LIST_WRAPPERS])
        candidates.append(F.when(~listed, F.col("__p")))
    record = parsed.withColumn("__r", F.coalesce(*candidates))
    values = {name: F.try_variant_get("__r", f"$.{name}", kind) for name, kind in fields.items()}
    return record.withColumns(values).drop("__p", "__r")


def path_get(col: Column | str, path: str, kind: str, default: object = None) -> Column:
    """Value at a dotted path of JSON text, or the default."""
    value = F.try_variant_get(F.try_parse_json(F.col(col) if isinstance(col, str) else col), f"$.{path}", kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def explode_findings(df: DataFrame, keys: Sequence[str], array_col: str, skip: Column | None = None) -> DataFrame:
    """One row per finding of an array; ``skip`` leaves out rows of an excluded region."""
    source = df if skip is None else df.filter(~F.coalesce(skip, F.lit(False)))
    return source.select(*keys, F.explode(array_col).alias("__f")).select(*keys, "__f.*")


def explode_items(df: DataFrame, keys: Sequence[str], map_col: str, skip: Column | None = None) -> DataFrame:
    """One row per entry of a keyed item map, the entry's key included."""
    source = df if skip is None else df.filter(~F.coalesce(skip, F.lit(False)))
    return source.select(*keys, F.explode(map_col).alias("key", "__f")).select(*keys, "key", "__f.*")


def stringify(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """List columns as JSON text, everything else unchanged."""
    lists = {f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    return df.withColumns({c: F.to_json(c) for c in columns if c in lists})


def route_region(df: DataFrame, regional: DataFrame, key: str, inside: str, outside: str) -> DataFrame:
    members = regional.select(F.col(key)).distinct().withColumn("__in", F.lit(True))
    joined = df.join(members, key, "left")
    return joined.withColumn("region", F.when(F.col("__in"), inside).otherwise(outside)).drop("__in")


def _truthy(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        return c
    if isinstance(kind, T.NumericType):
        return c != 0
    if isinstance(kind, T.StringType):
        return c != ""
    return c.isNotNull()


def attach_truthy(df: DataFrame, attributes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join of attributes that keeps a value only when it is truthy."""
    kept = attributes.select(key, *[F.when(_truthy(attributes, c), F.col(f"`{c}`")).alias(c) for c in columns])
    return df.join(kept, key, "left")


def connection_name(load: Column, pushdown: Column) -> Column:
    return F.coalesce(blank_to_null(load), pushdown)


def enrich_override(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Left join of the first right row per key; its values win over the stored ones."""
    side = first_row(right, [key], order_by).select(F.col(key), *[F.col(f"`{c}`").alias("__n_" + c) for c in columns])
    joined = join_null_safe(left, side, [key], "left")
    out = []
    for c in left.columns:
        out.append(F.coalesce(F.col(f"`__n_{c}`"), F.col(f"`{c}`")).alias(c) if c in columns else F.col(f"`{c}`"))
    out += [F.col(f"`__n_{c}`").alias(c) for c in columns if c not in left.columns]
    return joined.select(*out)


def enrich_missing(left: DataFrame, right: DataFrame, key: str, order_by: Sequence[Column | str]) -> DataFrame:
    """Left join that adds only the columns the left side lacks."""
    extra = [c for c in right.columns if c != key and c not in left.columns]
    side = first_row(right, [key], order_by).select(key, *[F.col(f"`{c}`") for c in extra])
    return join_null_safe(left, side, [key], "left")


def composite_score(df: DataFrame, columns: Sequence[str], out: str = "DQScore", start: float = 100) -> DataFrame:
    """Start minus the sub-scores; null and absent ones count as zero."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns if c in df.columns]
    return df.withColumn(out, F.lit(float(start)) - reduce(lambda a, b: a + b, parts, F.lit(0.0)))


def scorecard(details: DataFrame, domains: DataFrame, key: str, columns: Sequence[str], domain_columns: Sequence[str], as_of: Column, order_by: Sequence[Column | str]) -> DataFrame:
    """Existing score columns with the domain columns of their dataset and the report month."""
    present = [c for c in columns if c in details.columns]
    wanted = [c for c in domain_columns if c in domains.columns and c != key]
    side = first_row(domains, [key], order_by).select(key, *[F.col(f"`{c}`") for c in wanted])
    joined = join_null_safe(details.select(*[F.col(f"`{c}`") for c in present]), side, [key], "left")
    return joined.withColumn("report_time", F.date_format(as_of, "yyyy-MM"))


def coalesce_name(df: DataFrame, candidates: Sequence[Column | str], out: str) -> DataFrame:
    """First non-empty candidate; rows whose choice is blank are dropped."""
    columns = [F.col(c) if isinstance(c, str) else c for c in candidates]
    chosen = F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])
    return df.withColumn(out, chosen).filter(F.trim(out) != "")


def merge_deltas(definitions: DataFrame, deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of measured values onto their placeholder columns; keys compare as text."""
    values = [c for c in deltas.columns if c not in keys]
    left = definitions.drop(*values).withColumns({k: F.col(f"`{k}`").cast("string") for k in keys})
    right = deltas.withColumns({k: F.col(f"`{k}`").cast("string") for k in keys})
    return join_null_safe(left, right, keys, "left")


def enrich_definitions(definitions: DataFrame, mapping: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Mapping columns that exist, added to the definitions of their dataset."""
    wanted = [c for c in columns if c in mapping.columns and c != key]
    first = first_row(mapping, [key], order_by).select(key, *[F.col(f"`{c}`") for c in wanted])
    return join_null_safe(definitions.drop(*wanted), first, [key], "left")


def keep_observed(df: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    return df.join(observed.select(key), key, "left_semi")


def template_lookup(templates: DataFrame, name: str, group: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Last template per non-blank name."""
    return first_row(templates.filter(blank_to_null(name).isNotNull()), [*group, name], order_by)


def apply_templates(rules: DataFrame, templates: DataFrame, overwrite: bool = True) -> DataFrame:
    """Custom rules completed from the template of their region that their repository names.

    ``templates`` holds one row per (region, name) with ``value`` and
    ``description``.  The rule value becomes the template with its column
    placeholder filled: always with ``overwrite``, else only when blank.
    """
    side = templates.select(
        F.col("region").alias("__t_region"),
        F.col("name").alias("__t_name"),
        F.col("value").alias("__t_value"),
        F.col("description").alias("__t_description"),
    )
    on = (
        F.col("region").eqNullSafe(F.col("__t_region"))
        & (F.col("ruleRepo") == F.col("__t_name"))
        & (F.upper("ruleType") == "CUSTOM")
    )
    joined = rules.join(side, on, "left")
    column = F.nullif(F.col("columnName"), F.lit(""))
    template = F.nullif(F.col("__t_value"), F.lit(""))
    filled = F.coalesce(F.replace(template, F.lit("$colNm"), column), template)
    stored = F.nullif(F.col("ruleValue"), F.lit(""))
    value = F.coalesce(filled, F.col("ruleValue")) if overwrite else F.coalesce(stored, filled, F.col("ruleValue"))
    about = F.nullif(F.col("__t_description"), F.lit(""))
    description = F.coalesce(F.nullif(F.col("businessDesc"), F.lit("")), about, F.col("businessDesc"))
    return joined.withColumns({"ruleValue": value, "businessDesc": description}).drop(
        "__t_region", "__t_name", "__t_value", "__t_description"
    )


def latest_metrics(rules: DataFrame, metrics: DataFrame, keys: Sequence[str], values: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """Rules with the newest measured values of their key; stored values of the same name are dropped."""
    newest = first_row(metrics, keys, order_by).select(*keys, *values)
    return join_null_safe(rules.drop(*[v for v in values if v not in keys]), newest, keys, "left")


def backfill(df: DataFrame, lookup: DataFrame, key: str, column: str, lookup_column: str) -> DataFrame:
    """Null cells of a column filled from a lookup with one row per key."""
    side = lookup.select(F.col(key), F.col(lookup_column).alias("__fill"))
    joined = join_null_safe(df, side, [key], "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.col("__fill"))).drop("__fill")


def order_columns(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    first = [c for c in preferred if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in first + [c for c in df.columns if c not in first]])

"""Table writers and the shaping that sinks need."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

COMPLEX = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def normalize_for_sink(df: DataFrame) -> DataFrame:
    """Nested cells as JSON text, NaN as null."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, COMPLEX):
            c = F.to_json(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def sql_type(data_type: T.DataType) -> str:
    """SQL column type a sink declares for a Spark type."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "double precision"
    if isinstance(data_type, T.DecimalType):
        return f"numeric({data_type.precision},{data_type.scale})"
    if isinstance(data_type, T.TimestampType):
        return "timestamptz"
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return "timestamp"
    return "text"


def bi_export(df: DataFrame) -> DataFrame:
    """Zoned timestamps as naive UTC and nested cells as text, nulls kept."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))
        elif isinstance(f.dataType, COMPLEX):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """One column per leaf, named by its path and sorted; arrays stay arrays."""
    leaves: list[tuple[str, str]] = []

    def walk(fields: Sequence[T.StructField], path: str, name: str) -> None:
        for f in fields:
            here = f"{path}.`{f.name}`" if path else f"`{f.name}`"
            label = f"{name}{sep}{f.name}" if name else f.name
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType.fields, here, label)
            else:
                leaves.append((label, here))

    walk(df.schema.fields, "", "")
    return df.select(*[F.col(path).alias(label) for label, path in sorted(leaves)])


def one_line(c: Column) -> Column:
    """Backslashes and line breaks of a text as escapes, so that a row stays on one line."""
    whole = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(whole, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def write_csv(df: DataFrame, path: str) -> None:
    """One line per row, null as ``\\N``; ``read_csv`` brings line breaks in texts, nulls and empty texts back."""
    flat = normalize_for_sink(df)
    texts = {f.name for f in flat.schema.fields if isinstance(f.dataType, T.StringType)}
    rows = flat.select(*[(one_line(F.col(f"`{c}`")) if c in texts else F.col(f"`{c}`")).alias(c) for c in flat.columns])
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": "\\N"}
    rows.write.mode("overwrite").option("header", True).option("escape", '"').options(**spaces).csv(path)


def write_replace(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a catalog table with its schema; the schema (database) is made on demand."""
    spark = df.sparkSession
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_version(df: DataFrame, name: str, location: str) -> str:
    """Replace what readers of ``name`` see in one step, and tell the folder of the new version.

    The rows are written to a folder of their own below ``location``; when they
    are complete, the catalog's view of that name is switched to them.  A reader
    that began before the switch keeps reading the old folder, which stays until
    ``drop_versions``; a failing write leaves the view as it was.  A table of
    that name must not exist.
    """
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    folder = f"{location.rstrip('/')}/{sanitize_name(name)}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(folder)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return folder


def current_version(spark: SparkSession, name: str) -> str | None:
    """The folder that readers of ``name`` are sent to; null before the first version."""
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'View Text'").first()
    return text.data_type.split("`")[1] if text else None


def drop_versions(spark: SparkSession, name: str, location: str) -> list[str]:
    """Delete the folders of ``name`` below ``location`` that no reader is sent to any more; call it when no query runs."""
    current = current_version(spark, name)
    if current is None:
        return []
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(location)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept, prefix, gone = current.rsplit("/", 1)[1], f"{sanitize_name(name)}-", []
    for entry in files.listStatus(root):
        folder = entry.getPath().getName()
        if folder != kept and folder.startswith(prefix) and len(folder) == len(prefix) + 32:
            files.delete(entry.getPath(), True)
            gone.append(folder)
    return sorted(gone)


@dataclass(frozen=True)
class WritePolicy:
    """How an output reaches the database: ``snapshot``, ``upsert`` or ``skip``."""

    kind: str
    table: str
    keys: tuple[str, ...] = ()


# Outputs that do not follow the snapshot rule.
POLICY_KINDS = {"business_unit_mapping": ("upsert", ("dataset",)), "dataset_definitions": ("skip", ())}


def sanitize_name(name: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()


def policy_for(name: str, prefix: str, overrides: dict[str, str] | None = None) -> WritePolicy:
    """How an output is written, and to which table: an override, else the prefix and the name."""
    kind, keys = POLICY_KINDS.get(name, ("snapshot", ()))
    table = (overrides or {}).get(name) or sanitize_name(prefix + name)
    return WritePolicy(kind, table, keys)


@dataclass(frozen=True)
class Target:
    """One place an output goes: ``csv`` under a folder, ``table`` in the catalog, or ``jdbc`` with writer options."""

    kind: str
    location: str = ""
    options: dict[str, str] = field(default_factory=dict)


def _stored(spark: SparkSession, policy: WritePolicy) -> DataFrame | None:
    return spark.read.table(policy.table) if spark.catalog.tableExists(policy.table) else None


def write_table(df: DataFrame, policy: WritePolicy, location: str = "") -> None:
    """Write one output to its catalog table by its policy.

    ``upsert`` merges by key and keeps the columns and rows the frame lacks;
    ``snapshot`` replaces all rows under the columns of both.  With a location
    the new content becomes a version that readers see in one step.  Without
    one it is staged in the shared folder first, so a failing query leaves the
    table as it was, but readers may meet it half replaced.
    """
    from ..operators.state import assert_primary_key, merge_partial, snapshot_replace

    spark = df.sparkSession
    rows, old = normalize_for_sink(df), _stored(spark, policy)
    if policy.kind == "upsert":
        new = assert_primary_key(rows, policy.keys) if old is None else merge_partial(old, rows, policy.keys).drop("_action")
    else:
        new = rows if old is None else snapshot_replace(rows, old)
    if location and (old is None or current_version(spark, policy.table)):
        write_version(new, policy.table, location)
        return
    staged = materialize(new, "staged")
    path = f"{location.rstrip('/')}/{policy.table}-{uuid.uuid4().hex}" if location else None
    write_replace(staged, policy.table, path)


def write_output(df: DataFrame, name: str, targets: Sequence[Target], prefix: str, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Write one output to every target by its policy and tell where it went.

    With several targets the frame is written once to the shared folder
    instead of being computed again.
    """
    policy = policy_for(name, prefix, overrides)
    shared = materialize(df, "output") if len(targets) > 1 else df
    written: dict[str, str] = {}
    for target in targets:
        if target.kind == "csv":
            path = f"{target.location.rstrip('/')}/{sanitize_name(name)}"
            write_csv(shared, path)
            written["csv"] = path
        elif target.kind == "table":
            if policy.kind == "skip":
                continue
            write_table(shared, policy, target.location)
            written["table"] = policy.table
        elif target.kind == "jdbc":
            if policy.kind == "skip":
                continue
            if policy.kind == "upsert":
                raise ValueError(f"{policy.table} is merged by key, which a JDBC target cannot do; stage the rows in another table and merge them in the database")
            normalize_for_sink(shared).write.format("jdbc").options(**(target.options | {"dbtable": policy.table, "truncate": "true"})).mode("overwrite").save()
            written["jdbc"] = policy.table
        else:
            raise ValueError(f"unknown target {target.kind!r}")
    return written

"""Table readers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import materialize

MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND")


@dataclass(frozen=True)
class Source:
    """Where a table can be read: a catalog name, or a format with options."""

    table: str | None = None
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    schema: StructType | None = None


CSV_OPTIONS = {"header": True, "escape": '"', "nullValue": "\\N", "multiLine": False}


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows written by ``write_csv``: one line each, so that files can be split; line breaks in texts come back."""
    return _texts_back(spark.read.schema(schema).options(**CSV_OPTIONS).csv(path), schema)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined lines with their file): lines that are too short, too long or hold a value of another type.

    The files are parsed once and written to the shared folder; every line is
    in one of the two tables.
    """
    line = "__line"
    marked = StructType([*schema.fields, StructField(line, StringType())])
    rows = spark.read.schema(marked).options(**(CSV_OPTIONS | {"header": header}), mode="PERMISSIVE", columnNameOfCorruptRecord=line).csv(path)
    parsed = materialize(rows.withColumn("__file", F.col("_metadata.file_path")), "checked-csv")
    good = parsed.filter(F.col(line).isNull()).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    bad = parsed.filter(F.col(line).isNotNull()).select(F.col("__file").alias("file"), F.col(line).alias("line"))
    return _texts_back(good, schema), bad


def _texts_back(rows: DataFrame, schema: StructType) -> DataFrame:
    """Escapes of ``write_csv`` in text columns as the characters they stand for."""

    def restored(name: str) -> Column:
        parts = F.transform(F.split(F.col(f"`{name}`"), r"\\\\", -1), lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
        return F.array_join(parts, "\\")

    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
    return rows.select(*[restored(c).alias(c) if c in texts else F.col(f"`{c}`") for c in rows.columns])


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_source(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str],
    columns: Sequence[str] | None = None,
    query: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Whole table, chosen columns, or a pushed-down query of a format (JDBC included).

    Column choice and later filters reach the scan; ``query`` is passed to
    formats that take one, so the remote side evaluates it.  A JDBC read has
    one partition unless ``options`` bound it: ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` split it by ranges.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if query is not None:
        reader = reader.option("query", query)
    df = reader.load()
    return df.select(*columns) if columns else df


def read_any(spark: SparkSession, source: Source) -> DataFrame:
    if source.table is not None:
        return read_table(spark, source.table)
    options = dict(source.options)
    if source.fmt == "csv" and source.schema is not None:
        return read_csv(spark, options["path"], source.schema)
    return read_source(spark, source.fmt, options, schema=source.schema)


def _is_missing(error: AnalysisException) -> bool:
    condition = error.getCondition() or ""
    return any(condition.startswith(m) for m in MISSING)


def read_first_available(spark: SparkSession, sources: Sequence[Source]) -> DataFrame:
    """First source that exists; only "not found" moves on to the next one."""
    last: AnalysisException | None = None
    for source in sources:
        try:
            return read_any(spark, source)
        except AnalysisException as error:
            if not _is_missing(error):
                raise
            last = error
    if last is None:
        raise ValueError("no source given")
    raise last


def read_or_empty(spark: SparkSession, source: Source, schema: StructType) -> DataFrame:
    """The source, or no rows with ``schema`` when it does not exist; any other error is raised."""
    try:
        df = read_any(spark, source)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return spark.createDataFrame([], schema)
    return df.select(
        *[
            (F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )

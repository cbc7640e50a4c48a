"""Building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

RANK = "__rank"
PART_LINES = 999  # up to a rank of 1000 Spark cuts a ranked window before the shuffle


def ordering(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]


def top_n(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per key.

    The rank filter sits directly on the window, so up to 1000 rows per key
    every map task keeps at most ``n`` of them before the shuffle and a hot key
    stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*ordering(order_by))
    name = rank or RANK
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def first_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    return top_n(df, keys, order_by, 1)


def shuffled(df: DataFrame) -> DataFrame:
    """The frame as a join side that is dealt by key and never sent whole to every task.

    For sides that grow with the data: the size Spark estimates from compressed
    files may be a small part of what the driver would have to hold.
    """
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt over as many tasks as a shuffle has.

    For long work per row on small files: Spark reads them in as few tasks as
    their bytes ask for, however long the work on a row takes.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def renamed(df: DataFrame, keys: Sequence[str], prefix: str = "__r_") -> DataFrame:
    """Prefix every column so that a self-derived side joins without ambiguity."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where null meets null; right key columns are dropped."""
    side = renamed(right, keys)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("__r_" + k)) for k in keys])
    joined = left.join(side, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    keep = [F.col(f"`{c}`") for c in left.columns]
    keep += [F.col(f"`__r_{c}`").alias(c) for c in right.columns if c not in keys]
    return joined.select(*keep)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def numbered(lines: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], out: str = "n") -> DataFrame:
    """Lines with their number within the key, from 0.

    Lines are ranged by key and order, so a long group is spread over several
    ranges; a line's number is its place in the range plus the lines of the
    key in earlier ranges.
    """
    order = ordering(order_by)
    ranged = lines.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("__range", F.spark_partition_id())
    ranged = materialize(ranged, "ranged-lines")
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys, "__range").agg(F.count("*").alias("__held"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__held").over(earlier), F.lit(0))).drop("__held")
    placed = ranged.withColumn("__place", F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(*order)) - 1)
    joined = join_null_safe(placed, before, [*keys, "__range"], "inner")
    return joined.withColumn(out, F.col("__before") + F.col("__place")).drop("__range", "__place", "__before")


# Keys with up to so many lines are numbered in one task; a longer one is spread over ranges.
LONG_KEY = 200_000


def text_parts(
    lines: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    line: str,
    separator: str = "\n",
    part_lines: int = PART_LINES,
    long_key: int = LONG_KEY,
) -> DataFrame:
    """The whole text of every key in numbered parts of ``part_lines`` lines: keys, part (from 0), text.

    The lines are made once and written.  Keys of usual length are dealt by key
    and numbered in place; only keys of more than ``long_key`` lines are ranged.
    """
    held = materialize(lines, "lines")
    long = held.groupBy(*keys).count().filter(F.col("count") > long_key).select(*keys)

    def numbered_whole(short: DataFrame) -> DataFrame:
        return short.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering(order_by))).cast("bigint") - 1)

    if long.isEmpty():
        return _grouped_parts(numbered_whole(held), keys, line, separator, part_lines)
    short = join_null_safe(held, long, keys, "left_anti")
    ranged = numbered(join_null_safe(held, long, keys, "left_semi"), keys, order_by, "__n")
    return union_all([_grouped_parts(df, keys, line, separator, part_lines) for df in (numbered_whole(short), ranged)])


def _grouped_parts(placed: DataFrame, keys: Sequence[str], line: str, separator: str, part_lines: int) -> DataFrame:
    parted = placed.withColumn("part", F.floor(F.col("__n") / part_lines).cast("int"))
    grouped = parted.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(F.struct(F.col("__n").alias("n"), F.col(line).alias("t")))).alias("__lines"))
    return grouped.select(*keys, "part", F.array_join(F.transform("__lines", lambda x: x["t"]), separator).alias("text"))


def list_rows(
    lines: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    line: str,
    out: str,
    separator: str = "\n",
    part_lines: int = PART_LINES,
) -> DataFrame:
    """The whole list of every key, over as many rows as it needs: keys, part (from 0), ``out``.

    First parts come from a ranked window that Spark cuts before the shuffle;
    only keys with more lines are numbered in full.
    """
    kept = top_n(lines, keys, order_by, part_lines + 1, rank=RANK)
    cells = F.sort_array(F.collect_list(F.struct(F.col(RANK).alias("n"), F.col(line).alias("t"))))
    grouped = materialize(kept.groupBy(*keys).agg(cells.alias("__lines")), "first-parts")
    text = F.array_join(F.transform(F.slice("__lines", 1, part_lines), lambda x: x["t"]), separator)
    first = grouped.select(*keys, F.lit(0).alias("part"), text.alias(out))
    long = grouped.filter(F.size("__lines") > part_lines).select(*keys)
    if long.isEmpty():
        return first
    rest = text_parts(join_null_safe(lines, long, keys, "left_semi"), keys, order_by, line, separator, part_lines)
    return first.unionByName(rest.filter("part > 0").withColumnRenamed("text", out))


CONTINUED = "(continued in further parts)"


def text_of_lines(
    lines: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    line: str,
    out: str,
    separator: str = "\n",
    part_lines: int = PART_LINES,
) -> DataFrame:
    """The first part of the text of every key, as one cell.

    A cell holds at most ``part_lines`` lines, so no task ever holds an
    unbounded group; one that has more says so at its end, and ``text_parts``
    of the same lines holds every part.
    """
    kept = top_n(lines, keys, order_by, part_lines + 1, rank=RANK)
    grouped = kept.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(RANK).alias("n"), F.col(line).alias("t")))).alias("__lines")
    )
    first = F.transform(F.slice("__lines", 1, part_lines), lambda x: x["t"])
    more = F.when(F.size("__lines") > part_lines, F.array(F.lit(CONTINUED))).otherwise(F.array().cast("array<string>"))
    return grouped.select(*keys, F.array_join(F.concat(first, more), separator).alias(out))


def whole_text(
    lines: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    line: str,
    out: str,
    separator: str = "\n",
    part_lines: int = PART_LINES,
) -> DataFrame:
    """The whole text of every key, as one cell, whatever its length.

    One shuffle by key; its sort spills.  Lines are collected ``part_lines`` at
    a time and a key's parts are joined last, so a task holds a long key's
    lines as text only: about the cell itself, which no task can do without.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering(order_by)))
    placed = lines.select(*keys, F.col(line).alias("__line"), place.alias("__n"))
    parted = placed.withColumn("__part", F.floor((F.col("__n") - 1) / part_lines))

    def joined(df: DataFrame, by: Sequence[str], n: str, text: str) -> DataFrame:
        cells = F.sort_array(F.collect_list(F.struct(F.col(n).alias("n"), F.col(text).alias("t"))))
        whole = F.array_join(F.transform(cells, lambda x: x["t"]), separator)
        return df.groupBy(*by).agg(F.when(F.count(text) > 0, whole).alias(text))  # null lines leave no separator

    parts = joined(parted, [*keys, "__part"], "__n", "__line")
    return joined(parts, keys, "__part", "__line").select(*keys, F.coalesce("__line", F.lit("")).alias(out))

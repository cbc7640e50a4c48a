"""Keyed tables in files, dealt by key, of which a merge rewrites only the parts that change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .state import merge_insert_only, merge_partial, merge_upsert, new_rows, prune_stale

PART = "key_part"


class KeyedTable:
    """A parquet table dealt into ``parts`` folders by a hash of its key.

    A merge finds the parts its source rows belong to, at most ``parts`` numbers,
    reads only those, and overwrites only those in which a row arrives, changes
    or leaves.  The new content of these parts is staged in the shared folder
    and then takes their place by dynamic partition overwrite; a failing query
    leaves the table as it was.  One writer at a time; a reader should not run
    across a merge.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], parts: int = 64):
        self.spark, self.path, self.keys, self.parts = spark, path, list(keys), parts

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.parts)).cast("int")

    def _write(self, df: DataFrame, mode: str) -> None:
        # A part with a third of all rows is written by several tasks.
        dealt = df.hint("rebalance", F.col(PART))
        dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)

    def create(self, df: DataFrame) -> None:
        if df.isEmpty():  # a file without rows keeps the columns
            df.limit(0).write.mode("errorifexists").parquet(f"{self.path}/{PART}=0")
        else:
            self._write(df.withColumn(PART, self.part()), "errorifexists")

    def read(self, parts: Sequence[int] | None = None) -> DataFrame:
        """The rows, of the given parts only if any are given."""
        rows = self.spark.read.parquet(self.path)
        return (rows if parts is None else rows.filter(F.col(PART).isin(list(parts)))).drop(PART)

    def parts_of(self, df: DataFrame) -> list[int]:
        """Numbers of the parts that hold the rows' keys; at most ``parts`` of them."""
        return sorted(r[0] for r in df.select(self.part().alias(PART)).distinct().collect())

    def _replace(self, merged: DataFrame, changed: list[int]) -> list[int]:
        """Put merged rows in place of the changed parts; parts that end up empty keep a file without rows."""
        if changed:
            staged = materialize(merged.withColumn(PART, self.part()).filter(F.col(PART).isin(changed)), "merged-parts")
            left = {r[0] for r in staged.select(PART).distinct().collect()}
            self._write(staged, "overwrite")
            for part in sorted(set(changed) - left):
                staged.drop(PART).limit(0).write.mode("overwrite").parquet(f"{self.path}/{PART}={part}")
        return changed

    def _merged(self, merged: DataFrame) -> list[int]:
        """Rewrite the parts in which a row's ``_action`` is not to keep it."""
        merged = materialize(merged, "merged")
        return self._replace(merged.drop("_action"), self.parts_of(merged.filter("_action <> 'keep'")))

    def upsert(self, source: DataFrame, columns: Sequence[str] | None = None, change_columns: Sequence[str] | None = None) -> list[int]:
        """Change-aware upsert of unique keys; the numbers of the rewritten parts."""
        return self._merged(merge_upsert(self.read(self.parts_of(source)), source, self.keys, columns, change_columns))

    def upsert_partial(self, source: DataFrame) -> list[int]:
        """Upsert of only the columns the source has."""
        return self._merged(merge_partial(self.read(self.parts_of(source)), source, self.keys))

    def insert_only(self, source: DataFrame, order_by: Sequence[Column | str]) -> list[int]:
        """Add the first source row of every key the table lacks."""
        target = self.read(self.parts_of(source))
        added = merge_insert_only(target.limit(0), new_rows(source, target, self.keys), self.keys, order_by)
        fresh = materialize(added, "added")
        changed = self.parts_of(fresh)
        return self._replace(self.read(changed).unionByName(fresh), changed) if changed else []

    def sync(self, source: DataFrame, update_existing: bool, order_by: Sequence[Column | str] | None = None) -> list[int]:
        """One-way sync: missing keys arrive, existing ones update on request, none leave."""
        return self.upsert(source) if update_existing else self.insert_only(source, order_by or self.keys)

    def prune(self, source: DataFrame, group_columns: Sequence[str]) -> list[int]:
        """Drop rows whose key left a group that the source covers; only group and key columns are read to find them."""
        held = self.spark.read.parquet(self.path).select(*dict.fromkeys([*group_columns, *self.keys]), PART)
        kept = prune_stale(held, source, group_columns, self.keys)
        before, after = (df.groupBy(PART).agg(F.count("*").alias("n")) for df in (held, kept))
        gone = before.join(after.withColumnRenamed("n", "left"), PART, "left").filter("n > coalesce(left, 0)")
        changed = sorted(r[0] for r in gone.select(PART).collect())
        return self._replace(prune_stale(self.read(changed), source, group_columns, self.keys), changed) if changed else []

    def merge_latest(self, delta: DataFrame, order_by: Sequence[str]) -> list[int]:
        """Keep the newest row of each key: the greatest in ``order_by``, nulls lowest; of equals the stored one, then any.

        The table is the state of all earlier deltas, so a run reads its own
        delta and the parts it touches and never the history.
        """
        order = F.struct(*[F.col(f"`{c}`") for c in order_by])
        columns = self.read().columns
        whole = F.struct(*[F.col(f"`{c}`") for c in columns])
        newest = delta.groupBy(*self.keys).agg(F.max_by(whole, order).alias("row")).select("row.*")
        held = self.read(self.parts_of(newest)).withColumn("__age", F.lit(0))
        both = held.unionByName(newest.withColumn("__age", F.lit(1)))
        rank = F.struct(order.alias("at"), (-F.col("__age")).alias("stored"))
        merged = both.groupBy(*self.keys).agg(F.max_by(F.struct(whole.alias("row"), F.col("__age").alias("age")), rank).alias("m"))
        action = F.when(F.col("m.age") == 1, "update").otherwise("keep").alias("_action")
        return self._merged(merged.select("m.row.*", action))

    def checksums(self, columns: Sequence[str], parts: Sequence[int] | None = None, fan: int = 1) -> DataFrame:
        """Per part, and ``fan`` places within it by key, the number of rows and two sums of row hashes that no order changes."""
        rows = self.spark.read.parquet(self.path)
        rows = rows if parts is None else rows.filter(F.col(PART).isin(list(parts)))
        row = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in columns])
        place = F.pmod(F.xxhash64(F.lit(1), *[F.col(f"`{k}`") for k in self.keys]), F.lit(fan)).cast("int")
        hashed = rows.select(F.col(PART).alias("part"), place.alias("place"), row.alias("h"))
        return hashed.groupBy("part", "place").agg(
            F.count("*").alias("n"), F.bit_xor("h").alias("bits"), F.sum(F.pmod("h", F.lit(1 << 31))).alias("total")
        )


def differing_keys(a: KeyedTable, b: KeyedTable, fan: int = 64) -> DataFrame:
    """Keys whose rows differ between two tables dealt alike, with ``state``: only_a, only_b or changed.

    Checksums are compared from the top: only parts with different sums are
    read again, place by place, and only rows of different places are compared.
    At most ``parts * fan`` numbers reach the driver.
    """
    if (a.keys, a.parts) != (b.keys, b.parts):
        raise ValueError("both tables need the same keys and parts")
    columns = a.read().columns
    if sorted(columns) != sorted(b.read().columns):
        raise ValueError("both tables need the same columns")

    def differing(parts: Sequence[int] | None, fan: int) -> list[tuple[int, int]]:
        sums = [t.checksums(columns, parts, fan) for t in (a, b)]
        other = sums[1].select(F.col("part").alias("p"), F.col("place").alias("q"), F.struct("n", "bits", "total").alias("theirs"))
        joined = sums[0].withColumn("ours", F.struct("n", "bits", "total")).join(other, (F.col("part") == F.col("p")) & (F.col("place") == F.col("q")), "full")
        open_ = joined.filter(~F.col("ours").eqNullSafe(F.col("theirs")))
        return [tuple(r) for r in open_.select(F.coalesce("part", "p"), F.coalesce("place", "q")).collect()]

    parts = sorted({p for p, _ in differing(None, 1)})
    places = differing(parts, fan) if parts else []
    found = {p * fan + q for p, q in places}

    def rows(t: KeyedTable, name: str) -> DataFrame:
        place = F.pmod(F.xxhash64(F.lit(1), *[F.col(f"`{k}`") for k in t.keys]), F.lit(fan))
        held = t.read(sorted({p for p, _ in places})).filter((t.part() * fan + place).isin(sorted(found)) if found else F.lit(False))
        return held.select(F.struct(*[F.col(f"`{k}`") for k in t.keys]).alias(f"{name}_key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias(name))

    joined = rows(a, "a").join(rows(b, "b"), F.col("a_key").eqNullSafe(F.col("b_key")), "full").filter(~F.col("a").eqNullSafe(F.col("b")))
    state = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").otherwise("changed")
    return joined.select(F.coalesce("a_key", "b_key").alias("key"), state.alias("state")).select("key.*", "state")

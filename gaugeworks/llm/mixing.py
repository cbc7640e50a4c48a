"""Mixing sources to target weights with whole documents.

Method: each document gets a hash-random key, documents are ranged by key
within their source, running sums of their sizes come from sums per range plus
a running sum within the range, and each source is cut where the running sum
is nearest its budget.  A target above the source's size takes whole epochs
first and cuts the last one.  Everything is DataFrame operations.

A range of keys holds about ``RANGE_ROWS`` rows whatever the source's size, so
a source with a third of all rows is spread over as many tasks as its size asks.

Defined results: a null source is a source of its own, last in order; a null
or empty text has size 0 and takes nothing; a null id is an id like others.
The key is drawn from id, size and a hash of the text.  Rows alike in all of
these stand for each other: they are counted per part of the input, so that a
third of all rows being alike makes a row per part, and the cut may lie between
any two of them.  An empty table gives an empty result.  Targets stop at ``CAP`` times a source's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .quality import BREAKS

CAP = 3
CYCLE = 3  # weights 1, 2, 3, repeating in order of source
SEED = 20
RANGE_ROWS = 2048


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(BREAKS.replace("[", "[^", 1))), F.lit(0)).cast("long")


def targets(per_source: DataFrame, cap: int = CAP) -> DataFrame:
    """``target`` of each source from ``source_size`` and ``weight``.

    All sizes are shared by weight; a source never gets more than ``cap`` times
    its own size, and what it cannot take goes to the others by weight.  In
    order of size over weight the sources that reach their cap come first, so
    one pass finds the level at which the rest share.  One row per source: this
    table does not grow with the documents of a source.
    """
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("place"))
    everything = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = rising.rowsBetween(Window.unboundedPreceding, -1)
    total, weights = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    left = total - F.coalesce(F.lit(cap) * F.sum("source_size").over(earlier), F.lit(0))
    share = left / (weights - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    open_ = F.when(share * F.col("weight") <= F.lit(cap) * F.col("source_size"), share)
    level = F.first(open_, ignorenulls=True).over(everything)
    leveled = per_source.withColumn("level", level)
    capped = F.least((F.lit(cap) * F.col("source_size")).cast("double"), F.col("weight") * F.col("level"))
    return leveled.withColumn("target", F.coalesce(capped, (F.lit(cap) * F.col("source_size")).cast("double"))).drop("level")


def mix(sized: DataFrame, key: str = "doc_id", cycle: int = CYCLE, cap: int = CAP, seed: int = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``sized`` holds one row per document: ``key``, ``source``, ``size``, ``mark`` (a hash of its text;
    without it rows of one key and size stand for each other).

    Returns key, source, size, source_size, target, ``copies`` (times the whole
    document is taken) and ``taken`` (words).
    """
    plan = planned(sized, key, cycle, cap, seed, range_rows)
    alike = plan.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.when(F.col("number") <= F.col("extra"), 1).otherwise(0)).otherwise(0).cast("long")
    return alike.select(F.col("id").alias(key), "source", "size", "source_size", "target", copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def planned(sized: DataFrame, key: str, cycle: int = CYCLE, cap: int = CAP, seed: int = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per group of rows alike in one part of the input: id, source, size, mark, their number ``n``, source_size, target,
    ``epochs`` (times all are taken) and ``extra`` (how many are taken once more)."""
    mark = F.col("mark") if "mark" in sized.columns else F.lit(0)
    rows = sized.select(F.col(f"`{key}`").alias("id"), "source", F.col("size").cast("long").alias("size"), mark.alias("mark"), F.spark_partition_id().alias("part"))
    rows = rows.groupBy("id", "source", "size", "mark", "part").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("draw", F.xxhash64(F.lit(seed), "id", "size", "mark"))
    per_source = rows.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    placed = per_source.withColumn("place", F.row_number().over(in_order)).withColumn("weight", ((F.col("place") - 1) % cycle + 1).cast("long"))
    known = targets(placed, cap).select(
        F.col("source").alias("of_source"), "source_size", "target",
        F.greatest(F.ceil(F.col("n_rows") / range_rows), F.lit(1)).cast("long").alias("n_ranges"),
    )
    # The draw is uniform, so equal stretches of its values hold about equally many rows.
    stretch = F.floor((F.col("draw") / F.lit(float(1 << 63)) + 1.0) / 2.0 * F.col("n_ranges")).cast("long")
    ranged = rows.join(known, F.col("source").eqNullSafe(F.col("of_source")), "left").withColumn("range", F.least(stretch, F.col("n_ranges") - 1))
    sums = ranged.groupBy("of_source", "range").agg(F.sum(F.col("n") * F.col("size")).alias("range_size"))
    by_range = Window.partitionBy("of_source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col("of_source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("range_size").over(by_range), F.lit(0)).alias("before"))
    joined = ranged.join(before, F.col("of_source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")), "left")
    within = Window.partitionBy("of_source", "range").orderBy("draw", "id", "size", "mark", "part").rowsBetween(Window.unboundedPreceding, -1)
    from_here = F.col("before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(within), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    # The nearest cut: a document is in when most of it lies before the budget.
    fitting = F.floor((rest - F.col("from")) / F.col("size") + 0.5).cast("long")
    extra = F.when((F.col("size") > 0) & (rest > 0) & (F.col("epochs") < cap), F.greatest(F.lit(0), F.least(fitting, F.col("n")))).otherwise(F.lit(0))
    return joined.withColumn("from", from_here).withColumn("epochs", epochs).select(
        "id", F.col("of_source").alias("source"), "size", "mark", "n", "source_size", "target", "epochs", extra.cast("long").alias("extra")
    )


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("mark"))


def query(spark, sf_dir: str) -> DataFrame:
    """Every document with its source's size and target and the words the mix takes."""
    return mix(sizes(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def numbered(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows with their ``number`` within ``by``, from counts per part and numbers within a part."""
    kept = materialize(rows.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "alike")
    earlier = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = kept.groupBy(*by, "part").agg(F.count(F.lit(1)).alias("here")).withColumn("before", F.coalesce(F.sum("here").over(earlier), F.lit(0)))
    offsets = counts.select(*[F.col(c).alias(f"of_{c}") for c in by], F.col("part").alias("of_part"), "before")
    inside = F.row_number().over(Window.partitionBy(*by, "part").orderBy("at"))
    same = F.col("part") == F.col("of_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return kept.withColumn("inside", inside).join(offsets, same).withColumn("number", F.col("before") + F.col("inside"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents, each as many times as the mix takes it.

    Rows alike in id, source and text are numbered only where the cut lies
    between them, which is one such group per source at most.
    """
    by = ["mix_id", "mix_source", "mix_mark"]
    plan = planned(sizes(docs), "doc_id").filter("size > 0")
    groups = plan.groupBy(F.col("id").alias("g_id"), F.col("source").alias("g_source"), F.col("mark").alias("g_mark")).agg(
        F.sum("n").alias("n"), F.first("epochs").alias("epochs"), F.sum("extra").alias("extra")
    )
    taken = materialize(groups.filter((F.col("epochs") > 0) | (F.col("extra") > 0)), "taken")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(own, F.col("doc_id").alias("mix_id"), F.col("source").alias("mix_source"), F.xxhash64("text").alias("mix_mark"))

    def of(which: str) -> DataFrame:
        same = F.col("mix_id").eqNullSafe(F.col("g_id")) & F.col("mix_source").eqNullSafe(F.col("g_source")) & (F.col("mix_mark") == F.col("g_mark"))
        return rows.join(taken.filter(which), same)

    whole = of("extra = 0 or extra = n").select("row", (F.col("epochs") + F.when(F.col("extra") > 0, 1).otherwise(0)).alias("copies"))
    if not taken.filter("extra > 0 and extra < n").isEmpty():
        cut = numbered(of("extra > 0 and extra < n"), by)
        whole = whole.unionByName(cut.select("row", (F.col("epochs") + F.when(F.col("number") <= F.col("extra"), 1).otherwise(0)).alias("copies")))
    many = whole.filter("copies > 0")
    return many.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")

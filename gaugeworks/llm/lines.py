"""Removal of lines that many sites share.

Method.  Every line is hashed; a HyperLogLog sketch of the sites that hold it
is built per hash and merged by aggregation, so a line on every page of a site
leaves a task as one small sketch.  Lines whose estimate is clear of the
threshold by several standard errors are decided by it; the lines near it get
their exact number of distinct sites.  Lines on ``MIN_SITES`` sites or more are
boilerplate and go from every document.  DataFrame functions only.

A line is compared without the white space around it; lines without a word
stay where they are.

Defined results: a null text stays null, with no lines; an empty text has
none that counts.  A null site is a site of its own.  Rows of one id and text
are treated alike; a null id is an id like others.  Other columns than id,
text and site are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .quality import SPACES

MIN_SITES = 5
LG_K = 12
ERRORS = 6  # standard errors within which a line is counted exactly


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def line_code(line: Column) -> Column:
    return F.xxhash64(F.trim(line, F.lit(SPACES)))


def boilerplate(sites: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """Codes of lines on ``min_sites`` sites or more; ``sites`` holds (code, site), repeats allowed."""
    sketched = sites.groupBy("code").agg(F.hll_sketch_agg(F.xxhash64("site"), F.lit(lg_k)).alias("sketch"))
    counted = materialize(sketched.select("code", F.hll_sketch_estimate("sketch").alias("estimate")).filter(f"estimate > {min_sites} * 0.5"), "line_sites")
    margin = max(1.0, ERRORS * 1.04 / (1 << lg_k) ** 0.5 * min_sites)
    near = counted.filter(F.abs(F.col("estimate") - min_sites) <= margin).select(F.col("code").alias("near"))
    exact = sites.distinct().join(near, F.col("code") == F.col("near"), "left_semi").groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    sure = counted.filter(F.col("estimate") > min_sites + margin).select("code")
    return sure.unionByName(exact.filter(F.col("n") >= min_sites).select("code"))


def remove_shared(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """Per row: doc_id, n_lines (with a word), n_removed, text without shared lines."""
    texts = docs.select("doc_id", "text", F.col(site).alias("site"), F.xxhash64("text").alias("text_code"))
    solid = F.filter(lines_of(F.col("text")), lambda line: F.trim(line, F.lit(SPACES)) != "")
    coded = texts.select("doc_id", "text_code", "site", F.array_distinct(F.transform(solid, line_code)).alias("codes"))
    held = materialize(coded.select("doc_id", "text_code", "site", F.explode("codes").alias("code")), "lines")
    shared = materialize(boilerplate(held.select("code", F.coalesce("site", F.lit("\0none")).alias("site")), min_sites, lg_k), "shared_lines")
    marked = held.join(shared, "code").groupBy(F.col("doc_id").alias("of_id"), F.col("text_code").alias("of_text")).agg(F.collect_set("code").alias("gone"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_code") == F.col("of_text"))
    joined = texts.join(marked, same, "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<bigint>")))
    blank_or_kept = lambda line: (F.trim(line, F.lit(SPACES)) == "") | ~F.array_contains(F.col("gone"), line_code(line))
    kept = F.filter(lines_of(F.col("text")), blank_or_kept)
    n_lines = F.coalesce(F.size(solid), F.lit(0))
    out = joined.select("doc_id", "text", "gone", F.when(F.col("text").isNotNull(), n_lines).otherwise(0).cast("long").alias("n_lines"), F.when(F.size("gone") > 0, kept).alias("kept"))
    left = F.filter("kept", lambda line: F.trim(line, F.lit(SPACES)) != "")
    n_removed = F.when(F.col("kept").isNotNull(), F.col("n_lines") - F.size(left)).otherwise(0)
    return out.select("doc_id", "n_lines", n_removed.cast("long").alias("n_removed"), F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n")).otherwise(F.col("text")).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many sources share."""
    return remove_shared(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    trim = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return f"""
WITH d AS (SELECT doc_id, text, source, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS ls FROM documents),
l AS (SELECT DISTINCT source, {trim.format("x")} AS line FROM (SELECT source, unnest(ls) AS x FROM d)),
shared AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(*) >= {MIN_SITES}),
rows AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) AS n FROM d),
kept AS (SELECT r.doc_id, count(*) FILTER (WHERE {trim.format("x")} <> '') AS n_lines, count(s.line) AS n_removed,
                coalesce(string_agg(x, chr(10) ORDER BY n) FILTER (WHERE s.line IS NULL), '') AS text
         FROM rows r LEFT JOIN shared s ON {trim.format("x")} = s.line GROUP BY r.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE kept.text END AS text
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

"""Token counts by source, language and tokenizer version, kept current by signed deltas.

Method.  A batch of events (insert, revise, delete) is compared with the ledger
of the batches before it: what an event replaces counts with a minus, what it
brings with a plus.  The sums per (source, language, tokenizer) are the batch's
deltas; the rollup is the sum of all deltas, so no document is counted again.
A batch's ledger rows and deltas live in folders of the batch's number and
depend on earlier batches only: committing a batch again, after a crash or by
mistake, writes the same folders anew and changes nothing.

Defined results: insert and revise both set a document's count, delete drops
it and does nothing to a document not there.  Of several events of one batch
for one document and tokenizer the last by ``at`` holds, then the one with
most tokens.  Null ids, sources, languages and tokenizers are values like
others; a null count is 0.  Other columns are not read.  An empty batch leaves
the totals as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .mixing import n_words

DIMENSIONS = ("source", "lang", "tokenizer")
KEY = ("doc_id", "tokenizer")
ENTRY = "doc_id long, tokenizer string, source string, lang string, n_tokens long, live boolean"
TOTALS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
PIECE = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"


class Rollups:
    """Ledger and deltas below one folder, one sub-folder per batch number."""

    def __init__(self, spark: SparkSession, root: str, batches: tuple[int, ...] = ()):
        self.spark, self.root, self.batches = spark, root.rstrip("/"), sorted(set(batches))

    def _read(self, kind: str, batches: list[int], schema: str) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], f"{schema}, batch int")
        paths = [f"{self.root}/{kind}/batch={b}" for b in batches]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*paths)

    def ledger(self, before: int | None = None) -> DataFrame:
        """The newest entry of every document and tokenizer, from batches below ``before``."""
        rows = self._read("ledger", [b for b in self.batches if before is None or b < before], ENTRY)
        newest = rows.groupBy(*KEY).agg(F.max_by(F.struct("source", "lang", "n_tokens", "live"), "batch").alias("now"))
        return newest.select(*KEY, "now.*")

    def commit(self, batch: int, events: DataFrame) -> None:
        """Record a batch: doc_id, tokenizer, source, lang, n_tokens, kind (insert, revise, delete) and at."""
        rank = F.struct(F.col("at"), F.coalesce("n_tokens", F.lit(0)))
        entry = F.struct("source", "lang", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), (F.col("kind") != "delete").alias("live"))
        last = events.groupBy(*KEY).agg(F.max_by(entry, rank).alias("next")).select(*KEY, "next.*")
        new = f"{self.root}/ledger/batch={batch}"
        last.select("doc_id", "tokenizer", "source", "lang", "n_tokens", "live").write.mode("overwrite").parquet(new)
        now = self.spark.read.schema(ENTRY).parquet(new)
        was = self.ledger(batch).select(*[F.col(c).alias(f"was_{c}") for c in ("doc_id", "tokenizer", "source", "lang", "n_tokens", "live")])
        same = F.col("doc_id").eqNullSafe(F.col("was_doc_id")) & F.col("tokenizer").eqNullSafe(F.col("was_tokenizer"))
        replaced = now.select(*KEY).join(was, same).filter("was_live")
        minus = replaced.select(F.col("was_source").alias("source"), F.col("was_lang").alias("lang"), "tokenizer", F.lit(-1).alias("sign"), F.col("was_n_tokens").alias("n_tokens"))
        plus = now.filter("live").select("source", "lang", "tokenizer", F.lit(1).alias("sign"), "n_tokens")
        signed = plus.unionByName(minus).groupBy(*DIMENSIONS).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
        signed.write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch}")
        self.batches = sorted({*self.batches, batch})

    def totals(self) -> DataFrame:
        """n_docs and n_tokens of every source, language and tokenizer that has documents."""
        sums = self._read("deltas", self.batches, TOTALS).groupBy(*DIMENSIONS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0")


def counts(text: Column) -> Column:
    """Counts of the two tokenizers: runs between white space, and runs of letters and digits or single marks."""
    pieces = F.coalesce(F.regexp_count(text, F.lit(PIECE)), F.lit(0)).cast("long")
    return F.array(F.struct(F.lit("words/1").alias("tokenizer"), n_words(text).alias("n_tokens")), F.struct(F.lit("pieces/1").alias("tokenizer"), pieces.alias("n_tokens")))


def events_of(held: DataFrame, counted: str, kind: str, at: int) -> DataFrame:
    rows = held.select("doc_id", "source", "lang", F.explode(counted).alias("count"))
    return rows.select("doc_id", "count.tokenizer", "source", "lang", "count.n_tokens", F.lit(kind).alias("kind"), F.lit(at).alias("at"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after loading all documents, recounting those with repeated lines, dropping exact copies, and a replay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = F.split("text", "\n")
    once = F.array_join(F.array_distinct(lines), "\n")
    held = materialize(
        docs.select(
            "doc_id", "source", "lang", F.md5("text").alias("code"), counts(F.col("text")).alias("loaded"),
            F.when(F.size(F.array_distinct(lines)) < F.size(lines), counts(once)).alias("revised"),
        ),
        "counted",
    )
    first = held.filter("code is not null").groupBy(F.col("code").alias("of")).agg(F.min("doc_id").alias("first_id"))
    copies = held.join(first, F.col("code") == F.col("of")).filter("doc_id > first_id")
    rollups = Rollups(spark, scratch_path(spark, "rollups"))
    revised = events_of(held.filter("revised is not null"), "revised", "revise", 2)
    rollups.commit(1, events_of(held, "loaded", "insert", 1))
    rollups.commit(2, revised)
    rollups.commit(3, events_of(copies, "loaded", "delete", 3))
    rollups.commit(2, revised)
    return rollups.totals()


def oracle() -> str:
    return f"""
WITH d AS (SELECT doc_id, source, lang, text FROM documents QUALIFY text IS NULL OR row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1),
l AS (SELECT DISTINCT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line FROM d),
c AS (SELECT doc_id, source, lang, sum(len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))) AS words, sum(len(regexp_extract_all(line, '{PIECE}'))) AS pieces FROM l GROUP BY ALL)
SELECT d.source, d.lang, t.tokenizer, count(*) AS n_docs, CAST(sum(coalesce(CASE t.tokenizer WHEN 'words/1' THEN words ELSE pieces END, 0)) AS BIGINT) AS n_tokens
FROM d LEFT JOIN c ON d.doc_id = c.doc_id CROSS JOIN (VALUES ('words/1'), ('pieces/1')) t(tokenizer) GROUP BY d.source, d.lang, t.tokenizer"""

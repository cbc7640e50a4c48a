"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Method: every measure is a Column expression over the text, every rule a
comparison of two measures with a threshold, and the whole table becomes one
``select``.  No user function, no shuffle: a row is judged where it is read.

Defined results: a null text has no words and all counts 0, so it fails the
length rule; an empty or blank text likewise.  Rows are judged one by one, so
ties, repeated rows and null ids need no rule, and an empty table gives an
empty result.  Only the id and text columns are read, whatever else there is
and however it is named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = "[ \\t-\\r]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RUN = 8

# Function words of the languages at hand; plain prose of any length uses several of them.
STOP_WORDS = {
    "en": "the of and to in that is it for on with as be was are this by from or at",
    "de": "der die und das ist nicht ein eine mit von den sich auf für im dem als auch es an",
    "fr": "le la les de des et un une est que qui en dans du pour sur pas au par avec",
    "es": "el la los las de del y que en un una es por con para no se lo su al",
}


@dataclass(frozen=True)
class Rule:
    """A document is rejected when ``measure`` is below ``low`` or above ``high`` times ``per``."""

    name: str
    measure: str
    per: str = "one"
    low: float | None = None
    high: float | None = None


# The base rules decide base_failed; the others only the verdict.
BASE = (
    Rule("too_short", "n_words", low=20),
    Rule("repeated_runs", "n_repeat_words", "n_words", high=0.30),
)
THRESHOLDS = BASE + (
    Rule("word_length", "word_chars", "n_words", low=2, high=12),
    Rule("symbols", "n_symbols", "n_words", high=0.10),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.50),
    Rule("shouting", "n_upper", "n_letters", high=0.50),
    Rule("no_letters", "n_letters", "word_chars", low=0.50),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BREAKS), lambda w: w != "")


def run_codes(codes: Column, run: int) -> Column:
    """One hash per ``run`` consecutive values, for arrays that are longer than that.

    Hashes of neighbours are combined to pairs, pairs to fours and so on, so a
    run of eight costs three steps.
    """
    if run & (run - 1):
        return F.transform(F.sequence(F.lit(1), F.size(codes) - run + 1), lambda i: F.xxhash64(F.slice(codes, i, run)))

    def doubled(x: Column, step: int) -> Column:
        later = F.slice(x, F.lit(step + 1), F.greatest(F.size(x) - step, F.lit(0)))
        return F.zip_with(x, later, lambda a, b: F.xxhash64(a, b))

    out, step = codes, 1
    while step < run:
        out, step = bound(out, lambda x, step=step: doubled(x, step)), 2 * step
    return F.slice(out, F.lit(1), F.size(codes) - run + 1)  # what follows lacks words


def repeated_run_words(codes: Column, run: int = RUN) -> Column:
    """Words inside a run of ``run`` words that is found twice or more, the first one included.

    ``codes`` holds one hash per word.  Only where a run repeats at all are
    runs sorted by hash and position; equal neighbours mark both positions; the
    marked positions in order then cover ``min(run, distance to the next one)``
    words each.
    """

    def marked(placed: Column) -> Column:
        pairs = F.zip_with(
            F.slice(placed, F.lit(1), F.greatest(F.size(placed) - 1, F.lit(0))),
            F.slice(placed, F.lit(2), F.greatest(F.size(placed) - 1, F.lit(0))),
            lambda a, b: F.when(a["code"] == b["code"], F.array(a["at"], b["at"])),
        )
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

    def covered(at: Column) -> Column:
        following = F.concat(F.slice(at, F.lit(2), F.greatest(F.size(at) - 1, F.lit(0))), F.array(F.lit(1 << 30)))
        return F.aggregate(F.zip_with(at, following, lambda a, b: F.least(b - a, F.lit(run))), F.lit(0), lambda total, x: total + x)

    def counted(held: Column) -> Column:
        placed = F.transform(held, lambda code, i: F.struct(code.alias("code"), i.alias("at")))
        return F.when(F.size(F.array_distinct(held)) < F.size(held), bound(bound(F.sort_array(placed), marked), covered)).otherwise(0)

    return F.when(F.size(codes) > run, bound(run_codes(codes, run), counted)).otherwise(0)


def line_counts(text: Column) -> Column:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.translate(line, SPACES, "") != "")
    return bound(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))


def measures(text: Column, stop_words: dict[str, str] = STOP_WORDS) -> dict[str, Column]:
    """Every measure a rule may name, as a struct of word measures, one of line measures and plain counts."""
    known = sorted({w for ws in stop_words.values() for w in ws.split()})
    whole = F.coalesce(text, F.lit(""))
    letters = F.regexp_replace(whole, "[^\\p{L}]+", "")
    return {
        "of_words": bound(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                bound(F.transform(w, lambda x: F.xxhash64(x)), repeated_run_words).cast("long").alias("n_repeat_words"),
                F.size(F.filter(w, lambda x: F.rtrim(F.lower(x), F.lit(".,;:!?")).isin(*known))).cast("long").alias("n_stop_words"),
            ),
        ),
        "of_lines": line_counts(text),
        "word_chars": F.length(F.translate(whole, SPACES, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "of_letters": bound(letters, lambda x: F.struct(F.length(x).cast("long").alias("n_letters"), F.length(F.regexp_replace(x, "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"))),
    }


def breaks(rule: Rule) -> Column:
    value, per = F.col(rule.measure).cast("double"), F.lit(1.0) if rule.per == "one" else F.col(rule.per).cast("double")
    broken = F.lit(False)
    if rule.low is not None:
        broken = broken | (value < F.lit(float(rule.low)) * per)
    if rule.high is not None:
        broken = broken | (value > F.lit(float(rule.high)) * per)
    return broken


def judge(docs: DataFrame, text: str = "text", carry: list[str] | None = None, rules: tuple[Rule, ...] = THRESHOLDS, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """The carried columns with all measures, ``base_failed``, ``kept`` and the names of broken rules."""
    carry = ["doc_id"] if carry is None else carry
    carried = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    wide = docs.select(*carried, *[c.alias(name) for name, c in measures(F.col(text)).items()])
    flat = wide.select(
        *[f"carried_{i}" for i in range(len(carry))],
        "of_words.n_words", "word_chars", "n_symbols", "of_lines.n_dup_lines", "of_words.n_repeat_words",
        "of_lines.n_lines", "of_words.n_stop_words", "of_letters.n_letters", "of_letters.n_upper",
    )
    base_failed = F.lit(False)
    for rule in base:
        base_failed = base_failed | breaks(rule)
    broken = F.concat_ws(",", *[F.when(breaks(r), F.lit(r.name)) for r in rules])
    named = [F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)]
    found = [c for c in flat.columns if not c.startswith("carried_")]
    judged = flat.select(*named, *found, base_failed.alias("base_failed"), broken.alias("broken_rules"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("broken_rules") == ""))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows that break no rule, with their own columns only."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    return judge(rows, carry=["row"]).filter("kept").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document with its measures and verdict."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws.split()}))

    def broken(rule: Rule) -> str:
        per = "" if rule.per == "one" else f" * {rule.per}"
        tests = [f"{rule.measure} {sign} CAST({limit} AS DOUBLE){per}" for sign, limit in (("<", rule.low), (">", rule.high)) if limit is not None]
        return "(" + " OR ".join(tests) + ")"

    base, rules = " OR ".join(map(broken, BASE)), ", ".join(f"CASE WHEN {broken(r)} THEN '{r.name}' END" for r in THRESHOLDS)
    return f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
         regexp_replace(coalesce(text, ''), '[^\\p{{L}}]+', '', 'g') AS letters
  FROM documents),
runs AS (
  SELECT doc_id, unnest(range(1, len(ws) - {RUN} + 2)) AS pos, ws FROM w WHERE len(ws) >= {RUN}),
keyed AS (SELECT doc_id, pos, array_to_string(list_slice(ws, pos, pos + {RUN} - 1), ' ') AS k FROM runs),
twice AS (SELECT doc_id, pos FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
spans AS (SELECT doc_id, least({RUN}, coalesce(lead(pos) OVER (PARTITION BY doc_id ORDER BY pos) - pos, {RUN})) AS n FROM twice),
cover AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM spans GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(list_filter(ws, lambda x: rtrim(lower(x), '.,;:!?') IN ({stops}))) AS BIGINT) AS n_stop_words,
         CAST(length(letters) AS BIGINT) AS n_letters, CAST(length(regexp_replace(letters, '[^\\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_upper
  FROM w LEFT JOIN cover ON w.doc_id = cover.doc_id),
j AS (SELECT *, ({base}) AS base_failed, concat_ws(',', {rules}) AS broken_rules FROM m)
SELECT *, NOT base_failed AND broken_rules = '' AS kept FROM j"""

"""Fuzzy matching of suggested titles against the open tickets of a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squeeze
from ..session import materialize
from .relational import first_row, shuffled

# Weights of the blend, sizes of the grams.
WEIGHTS = {"char": 0.35, "word": 0.35, "tokens": 0.20, "columns": 0.10}
CHAR_SIZES = (3, 4, 5)
BITS = 62  # places of a text that one number holds; sums of two stay below 2**63


def word_grams(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit(r"(?U)(\w+)"), F.lit(1))
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, F.filter(pairs, lambda p: p.isNotNull()))


def title_terms(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Term counts of both spaces per title: keys, space, term, tf.

    Space w holds single words and pairs of neighbours.  Space c holds the
    character grams of each blank-padded word; a word no longer than a size
    yields that size once and no larger ones.  Grams are cut by exploding
    sizes and positions, which stays in generated code.  A term is the 64-bit
    hash of its space and text, so that joins and vectors carry no strings.
    """
    norm = squeeze("title")
    padded = F.transform(F.filter(F.split(norm, " "), lambda w: w != ""), lambda w: F.struct(F.lit("c").alias("space"), F.concat(F.lit(" "), w, F.lit(" ")).alias("unit")))
    grams = F.transform(word_grams(norm), lambda g: F.struct(F.lit("w").alias("space"), g.alias("unit")))
    units = docs.select(*keys, F.explode_outer(F.concat(padded, grams)).alias("u")).select(*keys, "u.space", "u.unit", F.length("u.unit").alias("len"))
    low, high = CHAR_SIZES[0], CHAR_SIZES[-1]
    first = F.when(F.col("space") == "w", F.col("len")).otherwise(F.lit(low))
    last = F.when(F.col("space") == "w", F.col("len")).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), F.col("len"))))
    sized = units.filter("len > 0").withColumn("size", F.explode(F.sequence(first, last)))
    placed = sized.withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("len") - F.col("size") + 1))))
    term = F.xxhash64("space", F.substring(F.col("unit"), F.col("at"), F.col("size")))
    return placed.select(*keys, "space", term.alias("term")).groupBy(*keys, "space", "term").agg(F.count("*").alias("tf"))


def column_tokens(text: Column) -> Column:
    """Distinct lower-case tokens that look like column names."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9_]+)"), F.lit(1))
    return F.array_distinct(F.filter(tokens, lambda t: t.contains("_") | t.endswith("id") | t.endswith("code")))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _powers(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n)


def _places(chars: Column) -> Column:
    """For every character the places it has, as bits of a number."""

    def bits(ch: Column) -> Column:
        return F.aggregate(F.transform(chars, lambda x, i: F.when(x == ch, _powers(i)).otherwise(F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda s, x: s + x)

    return F.map_from_entries(F.transform(F.array_distinct(chars), lambda ch: F.struct(ch.alias("ch"), bits(ch).alias("at"))))


def _one_number(short: Column, long: Column) -> Column:
    """Common subsequence length; the rows of the usual table are kept as the bits of one number."""

    def walk(held: Column) -> Column:
        def step(row: Column, ch: Column) -> Column:
            hit = row.bitwiseAND(F.coalesce(F.try_element_at(held["places"], ch), F.lit(0).cast("bigint")))
            return (row + hit).bitwiseOR(row - hit).bitwiseAND(held["full"])

        return F.size(short) - F.bit_count(F.aggregate(long, held["full"], step))

    return bound(F.struct(_places(short).alias("places"), (_powers(F.size(short)) - 1).alias("full")), walk)


def _several_numbers(short: Column, long: Column) -> Column:
    """The same with as many numbers as the shorter text needs; sums carry from one to the next."""
    count = F.ceil(F.size(short) / BITS).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda w: F.slice(short, w * BITS + 1, F.lit(BITS)))
    held = F.transform(blocks, lambda b: F.struct(_places(b).alias("places"), (_powers(F.size(b)) - 1).alias("full")))
    empty = F.array().cast("array<bigint>")

    def walk(parts: Column) -> Column:
        def step(rows: Column, ch: Column) -> Column:
            def add(acc: Column, w: Column) -> Column:
                part, row = F.get(parts, w), F.get(rows, w)
                hit = row.bitwiseAND(F.coalesce(F.try_element_at(part["places"], ch), F.lit(0).cast("bigint")))
                total = row + hit + acc["carry"]
                new = total.bitwiseOR(row - hit).bitwiseAND(part["full"])
                return F.struct(F.concat(acc["rows"], F.array(new)).alias("rows"), F.call_function("shiftright", total, F.lit(BITS)).alias("carry"))

            start = F.struct(empty.alias("rows"), F.lit(0).cast("bigint").alias("carry"))
            return F.aggregate(F.sequence(F.lit(0), F.size(parts) - 1), start, add)["rows"]

        rows = F.aggregate(long, F.transform(parts, lambda p: p["full"]), step)
        return F.size(short) - F.aggregate(rows, F.lit(0), lambda s, x: s + F.bit_count(x))

    return bound(held, walk)


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts."""

    def of(pair: Column) -> Column:
        first = F.size(pair["a"]) <= F.size(pair["b"])
        ordered = F.struct(F.when(first, pair["a"]).otherwise(pair["b"]).alias("short"), F.when(first, pair["b"]).otherwise(pair["a"]).alias("long"))

        def chosen(o: Column) -> Column:
            return F.when(F.size(o["short"]) == 0, 0).when(F.size(o["short"]) <= BITS, _one_number(o["short"], o["long"])).otherwise(_several_numbers(o["short"], o["long"]))

        return bound(ordered, chosen)

    return bound(F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b")), of)


def title_words(title: Column) -> Column:
    """Distinct words of a title in order."""
    return F.array_sort(F.array_distinct(F.filter(F.split(title, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")))


def token_parts(x: Column, y: Column) -> Column:
    """What two word sets share and have alone, as texts, with bounds of their similarity that need no comparison of characters."""
    texts = F.struct(
        F.array_join(F.array_intersect(x, y), " ").alias("shared"), F.array_join(F.array_except(x, y), " ").alias("left"), F.array_join(F.array_except(y, x), " ").alias("right")
    )

    def bounds(p: Column) -> Column:
        gap = F.when(p["shared"] != "", 1).otherwise(0)
        base, left, right = F.length(p["shared"]), F.length(p["left"]), F.length(p["right"])
        n_left, n_right = base + gap + left, base + gap + right
        nothing = (F.size(x) == 0) | (F.size(y) == 0)
        within = (gap > 0) & ((left == 0) | (right == 0))
        cheap = F.when(gap > 0, F.greatest(1 - (gap + left) / (base + n_left), 1 - (gap + right) / (base + n_right))).otherwise(0.0)
        most = F.greatest(cheap, 1 - F.abs(left - right) / (n_left + n_right))
        return F.struct(
            p["left"].alias("left"), p["right"].alias("right"), (n_left + n_right).alias("both"),
            F.when(nothing, 0.0).when(within, 1.0).otherwise(cheap).alias("low"), F.when(nothing, 0.0).when(within, 1.0).otherwise(most).alias("high"),
        )

    return bound(texts, bounds)


def token_set_ratio(parts: Column) -> Column:
    """Similarity of two titles as sets of words, 0 to 1, from their ``token_parts``."""
    apart = F.length(parts["left"]) + F.length(parts["right"]) - 2 * common_length(parts["left"], parts["right"])
    return F.when(parts["low"] == parts["high"], parts["low"]).otherwise(F.greatest(parts["low"], 1 - apart / parts["both"]))


def _unit(terms: Column, space: str, norm: Column) -> Column:
    """Unit vector of one space, rarest term first."""
    own = F.filter(terms, lambda x: x["space"] == space)
    return F.transform(own, lambda x: F.struct(x["term"].alias("term"), (x["w"] / norm).alias("w")))


# Distinct titles whose terms one task holds, and from how many on a dataset's terms are dealt by themselves.
TASK_TITLES = 20_000


def distinct_titles(candidates: DataFrame, tickets: DataFrame) -> DataFrame:
    """Both sides as one table of distinct titles, written once: id, ds (a hash of the dataset), dataset, title, side (c or t), copies, ord."""
    titles = tickets.filter(squeeze("title") != "").groupBy("dataset", "title").agg(F.count("*").alias("copies"), F.min("ord").alias("ord"))
    wanted = candidates.select("dataset", "title").filter(F.col("title").isNotNull()).distinct()
    wanted = wanted.join(shuffled(tickets.select("dataset")), "dataset", "left_semi")
    both = titles.withColumn("side", F.lit("t")).unionByName(
        wanted.withColumns({"side": F.lit("c"), "copies": F.lit(0).cast("bigint"), "ord": F.lit(None).cast(titles.schema["ord"].dataType)})
    )
    return materialize(both.withColumns({"id": F.monotonically_increasing_id(), "ds": F.xxhash64("dataset")}), "distinct-titles")


def _weighed_in_place(both: DataFrame, tasks: int) -> DataFrame:
    """Terms with their weights where only titles are shuffled: a dataset's titles meet in one task and are cut into terms there.

    Terms are numbered within their dataset.
    """
    dealt = both.select("ds", "id", "copies", "title").repartition(tasks, "ds")
    sized = dealt.withColumn("n", F.sum("copies").over(Window.partitionBy("ds")))
    met = Window.partitionBy("ds", "term")
    terms = title_terms(sized, ["ds", "id", "copies", "n"]).withColumn("df", F.sum("copies").over(met)).filter("df > 0")
    numbered = terms.withColumn("term", F.dense_rank().over(Window.partitionBy("ds").orderBy("term")).cast("bigint"))
    idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
    return numbered.select("ds", "id", "copies", "space", "term", idf.alias("idf"), (F.col("tf") * idf).alias("w"))


def _weighed_apart(both: DataFrame) -> DataFrame:
    """The same for datasets of very many titles: terms are dealt by dataset and term, so no task holds a dataset."""
    # One text is the title of many datasets: it is cut into terms once.
    texts = title_terms(both.select("title").distinct(), ["title"]).groupBy("title").agg(F.collect_list(F.struct("space", "term", "tf")).alias("terms"))
    held = both.join(shuffled(texts), "title").select("id", "ds", "copies", F.explode("terms").alias("t"))
    terms = held.select("id", "ds", "copies", "t.space", "t.term", "t.tf")
    total = both.groupBy("ds").agg(F.sum("copies").alias("n"))
    frequency = terms.filter("copies > 0").groupBy("ds", "term").agg(F.sum("copies").alias("df"))
    idf = frequency.join(shuffled(total), "ds").select("ds", "term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    return terms.join(shuffled(idf), ["ds", "term"]).select("ds", "id", "copies", "space", "term", "idf", (F.col("tf") * F.col("idf")).alias("w"))


def _vectors(both: DataFrame, limit: float) -> DataFrame:
    """The TF-IDF vectors of ``distinct_titles``.

    Columns: ds, id, side, keys (the leading terms of both spaces for cosines
    of ``limit`` or more), and terms and weights as two arrays, the ``n_char``
    of the characters first.  The frequencies come from the ticket titles
    alone, copies included; terms no ticket title has are dropped.  A vector
    holds the terms of one title, so the lists stay as short as titles.  Terms
    travel with numbers in place of titles and datasets.
    """
    entry = F.struct((-F.col("idf")).alias("rarity"), "space", "term", "w")

    def norm_of(space: str) -> Column:
        return F.sqrt(F.sum(F.when(F.col("space") == space, F.col("w") * F.col("w"))))

    def flat(weighed: DataFrame) -> DataFrame:
        lists = weighed.groupBy("ds", "id").agg(
            F.max("copies").alias("copies"), F.sort_array(F.collect_list(entry)).alias("terms"), norm_of("c").alias("char_norm"), norm_of("w").alias("word_norm")
        )
        units = lists.select("ds", "id", "copies", _unit(F.col("terms"), "c", F.col("char_norm")).alias("char"), _unit(F.col("terms"), "w", F.col("word_norm")).alias("word"))
        every = F.concat("char", "word")
        return units.select(
            "ds", "id", F.when(F.col("copies") > 0, "t").otherwise("c").alias("side"),
            F.concat(_prefix(F.col("char"), limit), _prefix(F.col("word"), limit)).alias("keys"), F.size("char").alias("n_char"),
            F.transform(every, lambda x: x["term"]).alias("terms"), F.transform(every, lambda x: x["w"]).alias("weights"),
        )

    tasks = max(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-both.count() // TASK_TITLES))
    large = both.groupBy("ds").count().filter(F.col("count") > TASK_TITLES).select("ds")
    if large.isEmpty():
        return flat(_weighed_in_place(both, tasks))
    usual, rest = (both.join(shuffled(large), "ds", how) for how in ("left_anti", "left_semi"))
    return flat(_weighed_in_place(usual, tasks)).unionByName(flat(_weighed_apart(rest)))


def title_vectors(candidates: DataFrame, tickets: DataFrame, limit: float) -> DataFrame:
    """The vectors of both sides' distinct titles; see ``_vectors``."""
    return _vectors(distinct_titles(candidates, tickets), limit)


def _prefix(vec: Column, bound: float) -> Column:
    """Leading (rarest) terms that two vectors with a cosine of ``bound`` or more must share one of.

    A term belongs while the squared weight from it to the end is at least
    bound^2: what follows is too light to reach the bound alone.
    """
    limit = bound * bound - 1e-9
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("light"))

    def add(acc: Column, w: Column) -> Column:
        total = acc["sum"] + w * w
        return F.struct(total.alias("sum"), F.when(total < limit, acc["light"] + 1).otherwise(acc["light"]).alias("light"))

    light = F.aggregate(F.reverse(F.transform(vec, lambda x: x["w"])), start, add)["light"]
    return F.transform(F.slice(vec, 1, F.size(vec) - light), lambda x: x["term"])


def _cosines() -> Column:
    """The weighted sum of both cosines of a pair's vectors."""
    products = F.zip_with("c_terms", "c_weights", lambda term, w: w * F.coalesce(F.try_element_at("t_map", term), F.lit(0.0)))

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0.0), lambda s, x: s + x)

    def blended(p: Column) -> Column:
        char, word = F.slice(p, F.lit(1), F.col("n_char")), F.slice(p, F.col("n_char") + 1, F.size(p))
        return WEIGHTS["char"] * total(char) + WEIGHTS["word"] * total(word)

    return bound(products, blended)


def _best_overlap(pairs: DataFrame, titles: DataFrame) -> DataFrame:
    """Largest number of shared column names between a candidate's set and any title of its dataset.

    Works on distinct column sets, and only for candidate sets of which a
    title shares a part but not the whole.
    """
    open_sets = pairs.filter((F.col("shared") > 0) & (F.col("shared") < F.size("c_cols"))).select("dataset", "c_cols").distinct()
    sets = titles.select("dataset", F.array_sort(column_tokens(F.col("title"))).alias("t_cols")).filter(F.size("t_cols") > 0).distinct()
    left = open_sets.select("dataset", "c_cols", F.explode("c_cols").alias("token"))
    right = sets.select("dataset", "t_cols", F.explode("t_cols").alias("token"))
    met = left.join(shuffled(right), ["dataset", "token"]).select("dataset", "c_cols", F.size(F.array_intersect("c_cols", "t_cols")).alias("n"))
    return met.groupBy("dataset", "c_cols").agg(F.max("n").alias("best_shared"))


def match_titles(candidates: DataFrame, tickets: DataFrame, threshold: float = 0.72) -> DataFrame:
    """Best existing title per distinct (dataset, title) candidate that reaches the threshold.

    ``tickets`` holds the open titles as (dataset, title, ord).  The score
    blends two TF-IDF cosines fitted on all titles of the dataset, a token-set
    ratio and the overlap of column names.

    A pair can reach the threshold only if one of its cosines reaches
    ``(threshold - 0.3) / 0.7``: only pairs that share one of the rarest terms
    needed for that are formed, so no dataset is compared all against all and
    no pair that counts is missed.  Copies of a title are compared once.  Of a
    candidate's pairs only those whose upper bound reaches the best lower bound
    are compared character by character.

    Every side grows with the titles, and files of hashes are many times larger
    in memory, so no join here sends a side through the driver.
    """
    limit = (threshold - WEIGHTS["tokens"] - WEIGHTS["columns"]) / (WEIGHTS["char"] + WEIGHTS["word"])
    if limit <= 0:
        raise ValueError("threshold must exceed 0.3 so that a shared term is required")
    both = distinct_titles(candidates, tickets)
    vectors = materialize(_vectors(both, limit), "titles")

    def side(name: str) -> DataFrame:
        return vectors.filter(F.col("side") == name)

    def titles(name: str) -> DataFrame:
        return both.filter(F.col("side") == name)

    def keyed(name: str) -> DataFrame:
        return side(name).select("ds", F.col("id").alias(f"{name}_id"), F.explode("keys").alias("key"))

    left = side("c").select(F.col("id").alias("c_id"), F.col("terms").alias("c_terms"), F.col("weights").alias("c_weights"), "n_char")
    right = side("t").select(F.col("id").alias("t_id"), F.map_from_arrays("terms", "weights").alias("t_map"))
    pairs = keyed("c").join(shuffled(keyed("t")), ["ds", "key"]).select("c_id", "t_id").distinct()
    scored = pairs.join(shuffled(left), "c_id").join(shuffled(right), "t_id").select("c_id", "t_id", _cosines().alias("cosines"))
    close = scored.filter(F.col("cosines") + WEIGHTS["tokens"] + WEIGHTS["columns"] >= threshold - 1e-9)
    named = close.join(shuffled(titles("c").select(F.col("id").alias("c_id"), "dataset", F.col("title").alias("c"))), "c_id")
    named = named.join(shuffled(titles("t").select(F.col("id").alias("t_id"), F.col("title").alias("t"), "ord")), "t_id")
    near = named.withColumns(
        {
            "parts": token_parts(title_words(F.col("c")), title_words(F.col("t"))),
            "c_cols": F.array_sort(column_tokens(F.col("c"))),
            "shared": F.size(F.array_intersect(column_tokens(F.col("c")), column_tokens(F.col("t")))),
        }
    )
    high = F.col("cosines") + WEIGHTS["tokens"] * F.col("parts.high") + F.when(F.col("shared") > 0, WEIGHTS["columns"]).otherwise(0.0)
    near = materialize(near.withColumn("high", high).filter(F.col("high") >= threshold - 1e-9), "near-titles")
    low = near.groupBy("c_id").agg(F.max(F.col("cosines") + WEIGHTS["tokens"] * F.col("parts.low")).alias("best_low"))
    near = near.join(shuffled(low), "c_id").filter(F.col("high") >= F.col("best_low") - 1e-9).withColumn("tokens", token_set_ratio(F.col("parts")))
    near = near.join(shuffled(_best_overlap(near, titles("t"))), ["dataset", "c_cols"], "left")
    overlap = F.when(F.col("shared") == 0, 0.0).otherwise(F.col("shared") / F.coalesce("best_shared", F.size("c_cols")))
    blended = F.col("cosines") + WEIGHTS["tokens"] * F.col("tokens") + WEIGHTS["columns"] * overlap
    found = near.withColumn("score", F.round(blended, 12)).filter(F.col("score") >= threshold)
    best = first_row(found, ["dataset", "c"], [F.desc("score"), F.asc("ord")])
    return best.select("dataset", F.col("c").alias("title"), F.col("t").alias("matched_title"), "score")


def drop_matched(candidates: DataFrame, tickets: DataFrame, title: str, threshold: float = 0.72) -> DataFrame:
    """Candidates without a near-equal open title in their dataset."""
    named = candidates.select("dataset", F.col(title).alias("title"))
    matched = match_titles(named, tickets, threshold).select("dataset", F.col("title").alias(title))
    return candidates.join(shuffled(matched), ["dataset", title], "left_anti")

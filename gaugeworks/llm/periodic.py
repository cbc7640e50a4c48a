"""Periodic runs of words: stretches that repeat a passage back to back.

Method.  Texts are turned into word numbers and searched scale by scale.  Scale
k looks for periods from 2**k up to below 2**(k + 1).  A run of such a period
contains a whole block of the text's grid that occurs again one period later.
Every block is therefore correlated with the window that follows it: the sum
of squared differences of word numbers at each distance is an exact integer,
taken by number-theoretic transforms modulo as many primes as its bound needs,
and is zero just where the block occurs.  Each such distance seeds a run, which
is extended word by word to both sides.  Adjacent blocks with one distance are
one seed.

Blocks that cannot occur again in their window, because one of their words does
not, are left out before the transforms, and so are blocks whose whole window
lies in a run already known with a period no longer than the block: there every
occurrence is a multiple of that period and leads to the same run.  Scales go
upwards, so the smallest period of a stretch is met first.

Rows are judged one by one where they are read, in batches of bounded size;
transforms take a bounded number of blocks at a time.  Nothing is shuffled.

Defined results: a null or empty text has no words and no runs.  Null ids,
repeated rows and other columns need no rule; only the id and text columns are
read.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import by_size

LEAST = 12
BATCH_BYTES = 4 << 20
CELLS = 1 << 21  # numbers in one transform
# Primes below 2**29 that are one more than a multiple of 2**23, each with a generator of its units.
PRIMES = ((469762049, 3), (167772161, 3), (377487361, 7))


def modulo(x: np.ndarray, p: int) -> np.ndarray:
    """x % p by a division through a constant, which numpy does fast."""
    return x - x // np.uint64(p) * np.uint64(p)


def twiddles(p: int, generator: int, size: int) -> list[np.ndarray]:
    """For each stage of a transform of ``size`` the powers of its root, largest stage first."""
    out = []
    while size > 1:
        root, half = pow(generator, (p - 1) // size, p), size // 2
        powers = np.ones(half, np.uint64)
        done = 1
        while done < half:
            more = min(done, half - done)
            powers[done : done + more] = modulo(powers[:more] * np.uint64(pow(root, done, p)), p)
            done += more
        out.append(powers)
        size = half
    return out


def transform(rows: np.ndarray, p: int, stages: list[np.ndarray]) -> np.ndarray:
    """The transform of each row, values below p, in bit-reversed order."""
    n = rows.shape[1]
    x = rows
    for powers in stages:
        half = len(powers)
        x = x.reshape(len(rows), n // (2 * half), 2, half)
        low, high = x[:, :, 0, :], x[:, :, 1, :]
        new = np.empty_like(x)
        new[:, :, 0, :] = modulo(low + high, p)
        new[:, :, 1, :] = modulo((low + (np.uint64(p) - high)) * powers, p)
        x = new
    return x.reshape(len(rows), n)


def untransform(rows: np.ndarray, p: int, generator: int) -> np.ndarray:
    """What ``transform`` was applied to."""
    n = rows.shape[1]
    x = rows
    for powers in reversed(twiddles(p, pow(generator, -1, p), n)):
        half = len(powers)
        x = x.reshape(len(rows), n // (2 * half), 2, half)
        low, high = x[:, :, 0, :], modulo(x[:, :, 1, :] * powers, p)
        new = np.empty_like(x)
        new[:, :, 0, :] = modulo(low + high, p)
        new[:, :, 1, :] = modulo(low + (np.uint64(p) - high), p)
        x = new
    return modulo(x.reshape(len(rows), n) * np.uint64(pow(n, -1, p)), p)


def zero_distances(blocks: np.ndarray, windows: np.ndarray, bound: int) -> np.ndarray:
    """For every row and offset whether the block equals the window from that offset on.

    ``bound`` is not less than any sum of squared differences; primes are taken
    until their product is larger, so a sum that is zero modulo all is zero.
    """
    b, offsets = blocks.shape[1], windows.shape[1] - blocks.shape[1] + 1
    size = 1 << max(1, int(windows.shape[1] - 1).bit_length())
    equal, product = np.ones((len(blocks), offsets), bool), 1
    for p, generator in PRIMES:
        if product > bound:
            break
        product *= p
        stages = twiddles(p, generator, size)
        x, y = np.zeros((len(blocks), size), np.uint64), np.zeros((len(blocks), size), np.uint64)
        x[:, (-np.arange(b)) % size] = blocks  # reversed, so that the product correlates
        y[:, : windows.shape[1]] = windows
        cross = untransform(modulo(transform(x, p, stages) * transform(y, p, stages), p), p, generator)[:, :offsets]
        squares = np.cumsum(modulo(windows * windows, p), axis=1)
        inside = squares[:, b - 1 :].copy()
        inside[:, 1:] -= squares[:, : offsets - 1]
        own = modulo(blocks * blocks, p).sum(axis=1)[:, None]
        equal &= modulo(own + inside + np.uint64(2 * p) - np.uint64(2) * cross, p) == 0
    if product <= bound:
        raise ValueError("a text has more different words than the transforms can tell apart")
    return equal


def block_words(k: int, least: int) -> int:
    """The longest block of a grid that every run of scale k holds one of, a period before the run's end."""
    low, high = 1 << k, 2 << k
    return (min(max(least - p, p) for p in range(low, min(high, max(low + 1, least)))) + 1) // 2 if low < least else (low + 1) // 2


class Texts:
    """Word numbers of several texts one after the other; ``codes`` tell words of different texts apart."""

    def __init__(self, numbers: list[np.ndarray]):
        sizes = np.array([len(x) for x in numbers], np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.small = np.concatenate([*numbers, np.zeros(0, np.int64)]).astype(np.uint64)
        distinct = np.array([int(x.max()) + 1 if len(x) else 0 for x in numbers], np.int64)
        self.distinct = distinct
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.codes = self.small.astype(np.int64) + np.repeat(np.cumsum(distinct) - distinct, sizes)
        self.n = len(self.codes)
        self.ends = self.first[1:][self.row] if self.n else np.zeros(0, np.int64)
        # Beyond the last and before the first word nothing equals anything.
        self.padded = np.concatenate([[-1], self.codes, [-2]])
        self.order = np.argsort(self.codes, kind="stable")
        self.keys = self.codes[self.order] * (self.n + 1) + self.order

    def again(self, low: int, high: int) -> np.ndarray:
        """Whether each word occurs again at a distance from ``low`` to ``high - 1``."""
        out = np.zeros(self.n, bool)
        some = np.flatnonzero(self.first[1:][self.row[self.order]] - self.order > low) if self.n else np.zeros(0, np.int64)
        key = self.keys[some]
        at = np.searchsorted(self.keys, key + low)
        found = self.keys[np.minimum(at, self.n - 1)]
        out[self.order[some]] = (at < self.n) & (found < key + high) & (found // (self.n + 1) == key // (self.n + 1))
        return out

    def extend(self, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
        """How many words from ``at`` on, or backwards from ``at - 1``, equal the word at the distance."""
        out, open_, chunk = np.zeros(len(at), np.int64), np.arange(len(at)), 4
        while len(open_):
            for a in range(0, len(open_), max(1, CELLS // chunk)):
                some = open_[a : a + max(1, CELLS // chunk)]
                move = np.arange(chunk) if step > 0 else -1 - np.arange(chunk)
                place = at[some, None] + step * out[some, None] + move
                low = np.clip(place + 1, 0, self.n + 1)
                high = np.clip(place + distance[some, None] + 1, 0, self.n + 1)
                differ = self.padded[low] != self.padded[high]
                outside = (place < 0) | (place + distance[some, None] >= self.n)
                stop = differ | outside
                found = stop.any(axis=1)
                out[some] += np.where(found, stop.argmax(axis=1), chunk)
                open_[a : a + len(some)] = np.where(found, -1, some)
            open_, chunk = open_[open_ >= 0], chunk * 2
        return out


def runs_of(numbers: list[np.ndarray], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, by text, start and period; ``numbers`` are dense from 0 in each text."""
    texts = Texts(numbers)
    found = [np.zeros((0, 3), np.int64)]  # start, end, period over all texts
    longest = int(np.diff(texts.first).max()) if len(numbers) else 0
    k = 0
    while 2 << k <= longest or k == 0 and longest >= least:
        low, high = 1 << k, 2 << k
        b = block_words(k, least)
        known = np.concatenate(found)
        again = np.concatenate([[0], np.cumsum(texts.again(low, high))])
        sizes = np.diff(texts.first)
        grid = np.where(sizes >= max(least, 2 * low), sizes // b, 0)
        row = np.repeat(np.arange(len(sizes)), grid)
        at = texts.first[:-1][row] + (np.arange(len(row)) - np.repeat(np.cumsum(grid) - grid, grid)) * b
        ok = again[at + b] - again[at] == b
        at, row = at[ok], row[ok]
        ok = covering_period(known[known[:, 2] <= b], at, at + high - 1 + b) == 0
        at, row = at[ok], row[ok]
        seeds = []
        width = high - low + b - 1
        bounds = 1.001 * b * texts.distinct[row].astype(float) ** 2
        for primes in range(1, len(PRIMES) + 1):  # texts with few words need fewer primes
            under = [math.prod(p for p, _ in PRIMES[:m]) for m in (primes - 1, primes)]
            group = np.flatnonzero(((bounds >= under[0]) | (primes == 1)) & ((bounds < under[1]) | (primes == len(PRIMES))))
            most = max(1, CELLS // (1 << max(1, int(width - 1).bit_length())))
            for i in range(0, len(group), most):
                some = group[i : i + most]
                place = at[some, None] + low + np.arange(width)
                outside = place >= texts.ends[at[some], None]
                other = texts.distinct[row[some], None].astype(np.uint64)  # a number no word of the text has
                windows = np.where(outside, other, texts.small[np.minimum(place, texts.n - 1)])
                blocks = texts.small[at[some, None] + np.arange(b)]
                which, offset = np.nonzero(zero_distances(blocks, windows, int(bounds[some].max())))
                seeds.append(np.stack([at[some][which], low + offset], axis=1))
        if seeds:
            found.append(grown(texts, np.concatenate(seeds), known, b, least))
        k += 1
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    row = texts.row[every[:, 0]] if len(every) else np.zeros(0, np.int64)
    return row, every[:, 0] - texts.first[row], every[:, 1] - every[:, 0], every[:, 2]


def covering_period(known: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The period of a known run that holds the stretch, or 0."""
    if not len(known):
        return np.zeros(len(start), np.int64)
    known = known[np.argsort(known[:, 0], kind="stable")]
    reach = np.maximum.accumulate(known[:, 1])
    which = np.maximum.accumulate(np.where(known[:, 1] == reach, np.arange(len(known)), 0))
    before = np.searchsorted(known[:, 0], start, side="right") - 1
    held = (before >= 0) & (reach[np.maximum(before, 0)] >= end)
    return np.where(held, known[which[np.maximum(before, 0)], 2], 0)


def grown(texts: Texts, seeds: np.ndarray, known: np.ndarray, b: int, least: int) -> np.ndarray:
    """New runs from (block, distance) pairs."""
    # A run that holds block and copy and whose period divides the distance is what the seed would grow to.
    period = covering_period(known, seeds[:, 0], seeds.sum(axis=1) + b)
    seeds = seeds[(period == 0) | (seeds[:, 1] % np.maximum(period, 1) != 0)]
    seeds = seeds[np.lexsort((seeds[:, 0], seeds[:, 1]))]
    if not len(seeds):
        return np.zeros((0, 3), np.int64)
    chained = (seeds[1:, 1] == seeds[:-1, 1]) & (seeds[1:, 0] == seeds[:-1, 0] + b)
    heads, tails = seeds[np.append(True, ~chained)], seeds[np.append(~chained, True)]
    distance = heads[:, 1]
    left = texts.extend(heads[:, 0], distance, -1)
    right = texts.extend(tails[:, 0] + b, distance, 1)
    start, end = heads[:, 0] - left, tails[:, 0] + b + right + distance
    ok = end - start >= np.maximum(least, 2 * distance)
    new = np.unique(np.stack([start, end, distance], axis=1)[ok], axis=0)
    new = new[np.append(True, (new[1:, :2] != new[:-1, :2]).any(axis=1))] if len(new) else new  # the smallest period of a stretch
    if len(known) and len(new):
        span = np.int64(texts.n + 1)
        new = new[~np.isin(new[:, 0] * span + new[:, 1], known[:, 0] * span + known[:, 1])]
    return new


FOUND = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def detect_rows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", BATCH_BYTES):
            parts = [(text or "").encode().split() for text in batch.column("text").to_pylist()]
            numbers = []
            for words in parts:
                index = {w: i for i, w in enumerate(dict.fromkeys(words))}
                numbers.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
            row, start, length, period = runs_of(numbers, least)
            edges = np.searchsorted(row, np.arange(len(parts) + 1))
            texts = []
            for i, words in enumerate(parts):
                a, z = edges[i], edges[i + 1]
                if a < z:
                    gone = np.zeros(len(words) + 1, np.int64)
                    np.add.at(gone, start[a:z] + period[a:z], 1)
                    np.add.at(gone, start[a:z] + length[a:z], -1)
                    words = compress(words, (np.cumsum(gone[:-1]) == 0).tolist())
                texts.append(b" ".join(words).decode())
            runs = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start, length, period)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in parts], pa.int64()), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), runs), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Per row: doc_id, n_words, all runs of at least ``least`` words, and the words without repetitions, joined by one space."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(detect_rows(least), f"doc_id long, {FOUND}")


# --- the registered query


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or with a tenth of the ids a text whose tail repeats one passage; a null id leaves the text as it is."""
    h = F.crc32(doc_id.cast("string"))
    g = (h / 10).cast("long")
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(at, lambda i: F.get(w, i)), " ")

    whole = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit(""))), 1)
    return F.when(doc_id.isNotNull() & (h % 10 == 0), whole).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Per row the longest run and checksums of all runs and of the collapsed text."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, with a tenth of the documents made periodic."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(detect(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))))

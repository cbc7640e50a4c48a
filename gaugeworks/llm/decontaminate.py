"""Benchmark decontamination by templates: a question with other numbers or names is still the question.

Method.  Words are canonicalised: numbers, names and units become typed
placeholders, other words lose case and outer punctuation, and bare
punctuation drops out.  The windows of the benchmark's templates are hashed
and looked up from every window of every document, and once more with names as
plain lower-case words, since letter case and place decide what is a name.  A
window that even then has fewer than ``LEAST_WORDS`` plain words is looked up
with the values in its slots.  A hit fixes where an item would lie in the
document, and there all its words are compared; two words agree as templates or
in lower case.  A document is contaminated by an item when on one alignment a
stretch of ``LEAST_RUN`` template words, or the whole item if it is shorter,
agrees and either has a window of ``LEAST_WORDS`` plain words and consistent
slots or is verbatim.  Slots are consistent when no value is replaced by two
other values; a value that stays, or two values replaced by one, is no conflict.
A stretch with a conflict is not cut at it: only its verbatim parts count.

A name is a capitalised word that does not begin a sentence or a line.  A text
in capitals has no names; its words count in lower case.

The benchmark's windows are the only thing sent to the tasks, at most
``INDEX_WINDOWS`` at a time: a larger benchmark is looked up block by block, all
documents each time, so nothing is left out and the size sent is bounded.

Defined results: a null, empty or blank text or item matches nothing.  An item
of fewer than ``LEAST_ITEM`` template words is too plain to be told from chance
and matches nothing; one with placeholders only matches verbatim copies.  Ids may be null or
repeated; rows are judged one by one.  Other columns are not read.  Empty
tables give an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import by_size, runs

WINDOW = 8
LEAST_RUN = 13
LEAST_ITEM = 5
LEAST_WORDS = 3  # plain words a window needs besides placeholders unless its values are the same
INDEX_WINDOWS = 1 << 20
BATCH_BYTES = 2 << 20
CACHE_WORDS = 300_000

UNITS = frozenset(
    "% $ € £ ° mm cm m km in ft yd mi mile miles inch inches foot feet meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes ml l liter liters litre litres s ms sec second seconds min "
    "minute minutes h hr hrs hour hours day days week weeks month months year years usd eur gbp dollar dollars euro euros pound pounds "
    "cent cents percent kmh mph kw kwh watt watts volt volts amp amps degree degrees hz khz mhz ghz kb mb gb tb".split()
)
NUMBER = re.compile(r"[+-]?\d[\d.,:/]*")
NUMBER_UNIT = re.compile(r"([$€£]?)([+-]?\d[\d.,:/]*)([^\W\d_]*|%|°)")
OUTER = re.compile(r"^[^\w$€£%°+-]+|[^\w%°€£$]+$|^[+-]+(?!\d)")
LINE = "\ue000"  # stands for a line break among the words
DROP, PLAIN, NUM, UNIT, QUANTITY = range(5)
PLACEHOLDERS = {NUM: 11, UNIT: 12, QUANTITY: 13, "name": 14}


def hashed(value: str) -> int:
    return int.from_bytes(blake2b(value.encode(), digest_size=8).digest(), "little")


def word_code(word: str) -> tuple[int, int, bool, bool, int]:
    """(kind, hash of the lower-case form, capitalised, ends a sentence, hash of the slot's value)."""
    if word == LINE:
        return DROP, 0, False, True, 0
    core = OUTER.sub("", word)
    ends = bool(core) and any(c in ".!?:;" for c in word[word.rfind(core) + len(core) :])
    if not core or core == "_":
        if word in UNITS:
            return UNIT, 0, False, False, hashed(word)
        return DROP, 0, False, any(c in ".!?|" for c in word), 0
    low = core.lower()
    if NUMBER.fullmatch(core):
        return NUM, 0, False, ends, hashed(core.rstrip(".,:/"))
    if (m := NUMBER_UNIT.fullmatch(low)) and (m[1] or not m[3] or m[3] in UNITS):
        return QUANTITY, 0, False, ends, hashed(low)
    if low in UNITS and len(low) > 1:
        return UNIT, 0, False, ends, hashed(low)
    value = hashed(low)
    return PLAIN, value, core[0].isupper() and not (len(core) > 1 and core.isupper()), ends, value


class Coded(NamedTuple):
    """Kept words: template codes, the same without names, codes of the values, and whether each is a slot in either form."""

    code: np.ndarray
    lower: np.ndarray
    value: np.ndarray
    slot: np.ndarray
    typed: np.ndarray

    def part(self, a: int, b: int) -> Coded:
        return Coded(*(x[a:b] for x in self))


class Templates:
    """Words of several texts as template codes; codes met before are kept, up to ``CACHE_WORDS`` of them."""

    def __init__(self):
        self.reset()

    def reset(self):
        self.ids: dict[str, int] = {}
        self.kind, self.code, self.cap, self.ends, self.value = (np.zeros(0, t) for t in (np.int8, np.uint64, bool, bool, np.uint64))

    def of(self, texts: list[str | None]) -> tuple[Coded, np.ndarray]:
        """The kept words of all texts, and the first word of each text (one more at the end)."""
        if len(self.ids) > CACHE_WORDS:
            self.reset()
        ids = self.ids
        split = [(text or "").replace("\n", f" {LINE} ").split() for text in texts]
        new = list(set().union(*split) - ids.keys())
        if new:
            ids.update(zip(new, range(len(ids), len(ids) + len(new))))
            columns = zip(("kind", "code", "cap", "ends", "value"), zip(*map(word_code, new)))
            for name, column in columns:
                held = getattr(self, name)
                setattr(self, name, np.concatenate([held, np.array(column, held.dtype)]))
        flat = np.fromiter((ids[w] for words in split for w in words), np.int64, sum(map(len, split)))
        lens = np.array([len(words) for words in split], np.int64)
        first = np.concatenate([[0], np.cumsum(lens)])
        kind, code = self.kind[flat], self.code[flat]
        begins = np.ones(len(flat), bool)
        if len(flat):
            begins[1:] = self.ends[flat][:-1]
            begins[first[:-1][lens > 0]] = True
        # A dropped mark between words passes on whether a sentence begins.
        solid = kind != DROP
        since = np.maximum.accumulate(np.where(solid | begins, np.arange(len(flat)), 0)) if len(flat) else flat
        passed = np.zeros(len(flat), bool)
        passed[1:] = ~solid[:-1] & begins[since[:-1]] if len(flat) else passed[1:]
        name = (kind == PLAIN) & self.cap[flat] & ~begins & ~passed
        for k in (NUM, UNIT, QUANTITY):
            code[kind == k] = PLACEHOLDERS[k]
        lower, typed = code.copy(), kind > PLAIN
        code[name] = PLACEHOLDERS["name"]
        value = self.value[flat]
        kept = Coded(*(x[solid] for x in (code, lower, value, name | typed, typed)))
        return kept, np.concatenate([[0], np.cumsum(solid)])[first]


def item_windows(items: list[tuple[int, str]], window: int):
    """Templates of the items and their windows: hash, item's place in the list, offset, length."""
    words, first = Templates().of([text for _, text in items])
    held, found = [], defaultdict(list)
    for i, (item, _) in enumerate(items):
        own = words.part(int(first[i]), int(first[i + 1]))
        held.append((item, own))
        n = len(own.code)
        if n < LEAST_ITEM:
            continue
        # A short item must agree as a whole, so a window less long leaves a word to be compared in either form.
        w = min(window, n - 1)
        for hashes, asked in look_ups(own, w):
            found[w] += [(int(hashes[at]), i, at) for at in np.flatnonzero(asked).tolist()]
    return held, dict(found)


def look_ups(words: Coded, w: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the windows as templates, without names and with values, each with the windows it is for."""
    least, named = min(LEAST_WORDS, w), sums(words.slot & ~words.typed, w)
    plain = sums(~words.typed, w)
    return [
        (runs(words.code, w), plain - named >= least),
        (runs(words.lower, w), (plain >= least) & (named > 0)),
        (runs(words.value, w), plain < least),
    ]


def sums(flags: np.ndarray, w: int) -> np.ndarray:
    """How many flags each run of w holds."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[w:] - total[: max(0, len(total) - w)]


class Index:
    """Sorted window hashes of one length with the items they come from, and a small table that rules most look-ups out."""

    BITS = 22

    def __init__(self, rows: list[tuple[int, int, int]]):
        rows = sorted(rows)
        self.hash = np.array([r[0] for r in rows], np.uint64)
        self.item = np.array([r[1] for r in rows], np.int64)
        self.at = np.array([r[2] for r in rows], np.int64)
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[(self.hash >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Positions asked for whose hash is in the index."""
        near = np.flatnonzero(asked & self.maybe[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hash, hashes[near]), len(self.hash) - 1)
        return near[self.hash[at] == hashes[near]]

    def alignments(self, hashes: np.ndarray, asked: np.ndarray, w: int, first: np.ndarray) -> set[tuple[int, int, int]]:
        """(row, item, place of the item's first word) of every hit of a window asked for within its row."""
        hits = self.find(hashes, asked)
        rows = np.searchsorted(first, hits, side="right") - 1
        inside = hits + w <= first[rows + 1]
        hits, rows = hits[inside], rows[inside]
        low, high = (np.searchsorted(self.hash, hashes[hits], side=side) for side in ("left", "right"))
        n = high - low
        place = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return set(zip(np.repeat(rows, n).tolist(), self.item[place].tolist(), (np.repeat(hits, n) - self.at[place]).tolist()))


def consistent(ours: np.ndarray, theirs: np.ndarray) -> bool:
    """Whether no value is replaced by two other values."""
    there = {}
    return all(there.setdefault(a, b) == b for a, b in zip(ours.tolist(), theirs.tolist()) if a != b)


def stretches(flags: np.ndarray) -> list[list[int]]:
    """Start and end of every stretch of set flags."""
    return np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]))).reshape(-1, 2).tolist()


def copied(own: Coded, theirs: Coded, w: int, least: int) -> int:
    """Length of the longest stretch of at least ``least`` words that is a template copy or verbatim; 0 for none."""
    word = own.lower == theirs.lower
    same, fixed, best = (own.code == theirs.code) | word, word & ~own.typed, 0
    for a, b in stretches(same):
        if b - a >= max(least, best + 1) and (sums(fixed[a:b], w) >= min(LEAST_WORDS, w)).any():
            slots = a + np.flatnonzero(own.slot[a:b])
            if consistent(own.value[slots], theirs.value[slots]):
                best = b - a
    for a, b in stretches(own.value == theirs.value):
        if b - a >= max(least, best + 1):
            best = b - a
    return best


def match_rows(items: list[tuple[int, str]], window: int, least_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = item_windows(items, window)
        indexes = {w: Index(rows) for w, rows in found.items()}
        templates = Templates()
        for batch in by_size(batches, "text", BATCH_BYTES):
            words, first = templates.of(batch.column("text").to_pylist())
            matched: dict[tuple[int, int], int] = {}
            for w, index in indexes.items():
                if len(words.code) < w:
                    continue
                lines = set().union(*(index.alignments(hashes, asked, w, first) for hashes, asked in look_ups(words, w)))
                for row, item, start in lines:
                    own = held[item][1]
                    n = len(own.code)
                    a, b = max(0, int(first[row]) - start), min(n, int(first[row + 1]) - start)
                    length = copied(own.part(a, b), words.part(start + a, start + b), w, min(least_run, n))
                    if length > matched.get((row, item), 0):
                        matched[row, item] = length
            keys = sorted(matched)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array([r for r, _ in keys], pa.int64())),
                    pa.array([held[i][0] for _, i in keys], pa.int64()),
                    pa.array([matched[k] for k in keys], pa.int64()),
                    pa.array([len(held[i][1].code) for _, i in keys], pa.int64()),
                ],
                ["doc_id", "item_id", "n_matched", "n_item"],
            )

    return run


def item_blocks(benchmark: DataFrame, limit: int = INDEX_WINDOWS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``limit`` words, read one after the other."""
    block, words = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        n = len((text or "").split())
        if block and words + n > limit:
            yield block
            block, words = [], 0
        block.append((item, text))
        words += n
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_run: int = LEAST_RUN, limit: int = INDEX_WINDOWS) -> DataFrame:
    """Pairs (doc_id, item_id) with the template words matched in a row and the item's length."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, n_matched long, n_item long"
    found = texts.limit(0).mapInArrow(match_rows([], window, least_run), schema)
    for block in item_blocks(benchmark, limit):
        found = found.unionByName(texts.mapInArrow(match_rows(block, window, least_run), schema))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_run: int = LEAST_RUN) -> DataFrame:
    """Contaminated documents only: doc_id, item_ids, n_items and the most words matched in a row."""
    pairs = matches(docs, benchmark, window, least_run)
    return pairs.groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.countDistinct("item_id").alias("n_items"), F.max("n_matched").alias("n_matched")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark question, and which."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def clean_rows(items: list[tuple[int, str]], window: int, least_run: int):
    match = match_rows(items, window, least_run)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", BATCH_BYTES):
            rows = pa.array(np.arange(batch.num_rows, dtype=np.int64))
            asked = pa.RecordBatch.from_arrays([rows, batch.column("text")], ["doc_id", "text"])
            bad = {r for found in match(iter([asked])) for r in found.column("doc_id").to_pylist()}
            yield batch.filter(pa.array([i not in bad for i in range(batch.num_rows)]))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_run: int = LEAST_RUN) -> DataFrame:
    """The rows that hold no benchmark question, judged row by row without a shuffle."""
    kept = docs
    for block in item_blocks(benchmark):
        kept = kept.mapInArrow(clean_rows(block, window, least_run), docs.schema)
    return kept

"""Phrases whose words keep together more than chance would have it.

Method.  Texts are read where they lie, level by level.  At level k a counting
sketch over hashes of k-word phrases is summed over all tasks; a phrase is a
candidate when its bucket and, at higher levels, the buckets of both its parts
of k - 1 words reach the least count.  A bucket never counts less than a
phrase in it, so every frequent phrase is a candidate.  Distinct candidates
and their single words are dealt into blocks of a fixed number of phrases, and
each block becomes a double-array trie over the digits of its own word
numbers, built by a task.  ``AT_ONCE`` blocks at a time are broadcast.  In each task
numpy moves the states of all text positions at once, digit by digit and word
by word, counts the accepting states by ``bincount``, and the counts of all
tasks are summed.

What is sent to tasks: one bit per bucket, at most ``MOST_BUCKETS / 8`` bytes,
and ``AT_ONCE`` tries of about ``BLOCK`` phrases.  These sizes are fixed
whatever the input; a corpus with more candidates takes more passes over the
texts.  An overfull sketch only lets more candidates through.

Words are known by 64-bit hashes that include the language.  Defined results:
a null or empty text has no words; a null language is ``und``.  Repeated rows
count as often as they are there.  Ids and other columns are not read.
Numbers are decimals of 38 digits where they are multiplied, so scores are
exact up to 10 million million occurrences.  An empty table gives no phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import LOWER, Words, by_size, mix, words_of

LEAST = 10
MOST_WORDS = 3
TOP = 2000
PERCENT = 50
BATCH_BYTES = 1 << 20
FEWEST_BUCKETS = 1 << 18
MOST_BUCKETS = 1 << 28
RANGE_BITS = 16
BLOCK = 350_000
AT_ONCE = 2  # tries per pass
HELD = 1 << 20  # buckets a task holds before it sends them
SEEN = 2 << 20  # hashes of phrases a task remembers to have sent
SALTS = 64

BREAK = np.zeros(256, bool)
BREAK[[*range(10, 14), *b".,;:!?"]] = True
GAP = BREAK.copy()
GAP[[32, 9]] = True
STEP = np.uint64(0x9E3779B97F4A7C15)
MARGIN = 256  # slots before and after those in use, so that no digit leads outside


def lang_code(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


class Positions:
    """Words of a batch, a code for each that includes the language, and whether the next word is in the same piece."""

    def __init__(self, batch: pa.RecordBatch):
        column = batch.column("text").cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        held = column.buffers()[2]
        data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        solid = ~GAP[data]
        before, after = np.ones(len(data) + 1, bool), np.ones(len(data) + 1, bool)
        before[1:-1], after[:-1] = ~solid[:-1], ~solid
        before[offsets] = after[offsets] = True
        starts, ends = np.flatnonzero(solid & before[:-1]), np.flatnonzero(solid & after[1:]) + 1
        self.words = Words(data, starts, ends, np.searchsorted(starts, offsets))
        self.langs = batch.column("lang").fill_null("und").to_pylist()
        self.row = self.words.rows()
        known = {lang: lang_code(lang) for lang in set(self.langs)}
        of_row = np.array([known[lang] for lang in self.langs], np.uint64)
        self.codes = mix(self.words.hashes(lower=True) ^ of_row[self.row])
        breaks = np.cumsum(BREAK[data], dtype=np.int64)
        self.link = np.zeros(len(starts), bool)
        self.link[:-1] = (self.row[1:] == self.row[:-1]) & (breaks[starts[1:]] == breaks[starts[:-1]])

    def totals(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for lang, n in zip(self.langs, self.words.counts.tolist()):
            out[lang] = out.get(lang, 0) + n
        return out

    def levels(self, most: int, tests: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For k from 2 to ``most``: first words of the k-word phrases whose parts pass the tests of their levels, and the phrases' hashes."""
        at = np.flatnonzero(self.link)
        hashed = mix(self.codes[at] * STEP + self.codes[at + 1])
        for k in range(2, most + 1):
            yield k, at, hashed
            if k == most:
                return
            if k - 2 < len(tests):
                ok = tests[k - 2](hashed)
                at, hashed = at[ok], hashed[ok]
            both = (at[1:] == at[:-1] + 1) if len(at) else np.zeros(0, bool)  # the phrase without its first word passes too
            at, hashed = at[:-1][both], hashed[:-1][both]
            hashed = mix(hashed * STEP + self.codes[at + k])

    def phrases(self, at: np.ndarray, k: int) -> list[str]:
        """The words from each position as text, parted by one space."""
        low, starts, ends = LOWER[self.words.data].tobytes(), self.words.starts, self.words.ends
        plain = np.ones(len(at), bool)
        for j in range(k - 1):
            gap = ends[at + j]
            plain &= (starts[at + j + 1] == gap + 1) & (self.words.data[gap] == 32)
        out = []
        for i, a, b, one in zip(at.tolist(), starts[at].tolist(), ends[at + k - 1].tolist(), plain.tolist()):
            out.append((low[a:b] if one else b" ".join(low[starts[j] : ends[j]] for j in range(i, i + k))).decode())
        return out


def bucket_test(bits: np.ndarray, log: int):
    def test(hashed: np.ndarray) -> np.ndarray:
        bucket = hashed >> np.uint64(64 - log)
        return (bits[bucket >> np.uint64(3)] >> (bucket & np.uint64(7)).astype(np.uint8)) & 1 == 1

    return test


def summed(keys: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their counts, never more than ``least``."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[begin], np.minimum(np.add.reduceat(counts, begin) if len(begin) else counts, least)


SKETCH = "span int, places binary, counts binary"


def count_buckets(k: int, log: int, least: int, sent: list):
    """Per task and range of buckets: which buckets its k-word phrases fall into and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests, held, size = [bucket_test(b.value, log) for b in sent], [], 0

        def flush():
            keys, counts = summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]), least)
            spans = keys >> np.uint32(RANGE_BITS)
            edges = np.flatnonzero(np.append(True, spans[1:] != spans[:-1]))
            rows = [(int(spans[a]), keys[a:b].astype("<u2").tobytes(), counts[a:b].astype("<u4" if least > 255 else "u1").tobytes()) for a, b in zip(edges, np.append(edges[1:], len(keys)))]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["span", "places", "counts"])

        for batch in by_size(batches, "text", BATCH_BYTES):
            for level, _, hashed in Positions(batch).levels(k, tests):
                if level == k and len(hashed):
                    keys, counts = np.unique((hashed >> np.uint64(64 - log)).astype(np.uint32), return_counts=True)
                    held.append((keys, np.minimum(counts, least).astype(np.uint32)))
                    size += len(keys)
            if size > HELD:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def add_ranges(log: int, least: int, last: bool):
    """Sum the counts of one range of buckets, batch by batch; at last keep a bit per bucket that reaches ``least``."""
    width, kind = 1 << min(RANGE_BITS, log), "<u4" if least > 255 else "u1"

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            for places, counts in zip(batch.column("places").to_pylist(), batch.column("counts").to_pylist()):
                at = np.frombuffer(places, "<u2")
                total[at] = np.minimum(total[at] + np.frombuffer(counts, kind), least)
        at = np.flatnonzero(total)
        held = [np.packbits(total >= least, bitorder="little").tobytes(), b""] if last else [at.astype("<u2").tobytes(), total[at].astype(kind).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array(held[:1], pa.binary()), pa.array(held[1:], pa.binary())], ["span", "places", "counts"])

    return run


def frequent_buckets(texts: DataFrame, k: int, log: int, least: int, sent: list) -> np.ndarray:
    """One bit per bucket: whether at least ``least`` k-word phrases fall into it."""
    counted = texts.mapInArrow(count_buckets(k, log, least, sent), SKETCH)
    salted = counted.withColumn("salt", F.spark_partition_id() % SALTS)
    parts = salted.groupBy("span", "salt").applyInArrow(add_ranges(log, least, False), SKETCH)
    spans = parts.groupBy("span").applyInArrow(add_ranges(log, least, True), SKETCH)
    bits = np.zeros(max(1, (1 << log) // 8), np.uint8)
    width = max(1, (1 << min(RANGE_BITS, log)) // 8)
    for row in spans.select("span", "places").toLocalIterator():  # one bit per bucket in all
        bits[row.span * width : (row.span + 1) * width] = np.frombuffer(row.places, np.uint8)
    return bits


def distinct_phrases(most: int, log: int, sent: list):
    """The phrases that pass all tests, each about once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests, seen = [bucket_test(b.value, log) for b in sent], np.zeros(0, np.uint64)
        for batch in by_size(batches, "text", BATCH_BYTES):
            positions = Positions(batch)
            for k, at, hashed in positions.levels(most, tests):
                ok = tests[k - 2](hashed)
                hashed, first = np.unique(hashed[ok], return_index=True)
                seen = seen if len(seen) < SEEN else seen[:0]
                place = np.searchsorted(seen, hashed)
                new = seen[np.minimum(place, len(seen) - 1)] != hashed if len(seen) else np.ones(len(hashed), bool)
                at = at[ok][first[new]]
                seen = np.insert(seen, place[new], hashed[new])
                if len(at):
                    langs = [positions.langs[r] for r in positions.row[at].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(positions.phrases(at, k), pa.string())], ["lang", "phrase"])

    return run


def candidates(texts: DataFrame, least: int, most: int, log: int) -> DataFrame:
    """Distinct (lang, phrase) of up to ``most`` words that may be frequent, and the single words in them."""
    sent = []
    for k in range(2, most + 1):
        sent.append(texts.sparkSession.sparkContext.broadcast(frequent_buckets(texts, k, log, least, sent)))
    longer = materialize(texts.mapInArrow(distinct_phrases(most, log, sent), "lang string, phrase string").distinct(), "phrases")
    for bits in sent:
        bits.unpersist()
    words = longer.select("lang", F.explode(F.split("phrase", " ")).alias("phrase")).distinct()
    return longer.unionByName(words)


# --- the double-array trie


def free_first(sizes: np.ndarray, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, int]:
    """A base for every parent so that base + code is another slot for every child, and the slots in use.

    Parents with many children get a window of their own.  Those with a few are
    laid into gaps in rounds: each proposes a place for its first child, and
    those whose slots are free and claimed by no earlier parent stay.  Those
    with one child fill what is free.
    """
    n = len(sizes)
    base = np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    large = int((sizes >= 24).sum())
    base[order[:large]] = np.arange(large) * 256
    end = large * 256
    taken = np.zeros(end + 256, bool)

    def slots(parents):
        reps = sizes[parents]
        own = np.repeat(np.arange(len(parents)), reps)
        inside = np.arange(len(own)) - np.repeat(np.cumsum(reps) - reps, reps)
        return own, codes[np.repeat(first[parents], reps) + inside]

    own, code = slots(order[:large])
    taken[base[order[:large]][own] + code] = True
    several, single = order[large : int((sizes > 1).sum())], order[int((sizes > 1).sum()) : int((sizes > 0).sum())]
    for attempt in range(24):
        if not len(several):
            break
        need = max(256, int(sizes[several].sum()) * 2)
        if (~taken).sum() < need:
            taken = np.concatenate([taken, np.zeros(need, bool)])
        free = np.flatnonzero(~taken)
        place = free[(np.arange(len(several)) * (len(free) // len(several)) + attempt * 7) % len(free)]
        proposed = place - codes[first[several]]
        own, code = slots(several)
        slot = proposed[own] + code
        short = int(slot.max()) + 1 - len(taken)
        if short > 0:
            taken = np.concatenate([taken, np.zeros(short + 256, bool)])
        bad = taken[np.maximum(slot, 0)] | (slot < 0)
        claim = np.unique(slot, return_index=True)[1]
        earliest = np.ones(len(slot), bool)
        earliest[claim] = False
        refused = np.zeros(len(several), bool)
        np.logical_or.at(refused, own[bad | earliest], True)
        base[several[~refused]] = proposed[~refused]
        taken[slot[~refused[own]]] = True
        several = several[refused]
    if len(several):  # each of the rest in a window of its own
        start = len(taken)
        base[several] = start + np.arange(len(several)) * 256
        taken = np.concatenate([taken, np.zeros(len(several) * 256 + 256, bool)])
        own, code = slots(several)
        taken[base[several][own] + code] = True
    free = np.flatnonzero(~taken)
    if len(free) < len(single):
        free = np.concatenate([free, np.arange(len(taken), len(taken) + len(single) - len(free))])
    base[single] = free[: len(single)] - codes[first[single]]
    return base, int(max(len(taken), free[len(single) - 1] + 1 if len(single) else 0))


class Trie:
    """A double array over digits of word numbers: a state's child by digit d is base + d if that slot names the state as its parent."""

    def __init__(self, words: np.ndarray, digits: int, base: np.ndarray, check: np.ndarray, accept: np.ndarray, root: int):
        self.words, self.digits, self.base, self.check, self.accept, self.root = words, digits, base, check, accept, root
        # Where the words of each leading bits begin; with eight times as many stretches as words most are empty.
        log = min(24, max(1, (8 * len(words)).bit_length()))
        self.shift = np.uint64(64 - log)
        self.begins = np.concatenate([[0], np.cumsum(np.bincount((words >> self.shift).astype(np.int64), minlength=1 << log))]).astype(np.int32)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """The number of each word code, or -1."""
        out, stretch = np.full(len(codes), -1, np.int32), (codes >> self.shift).astype(np.int64)
        at, end = self.begins[stretch], self.begins[stretch + 1]
        open_ = np.flatnonzero(end > at)
        at, end = at[open_], end[open_]
        while len(open_):
            hit = self.words[at] == codes[open_]
            out[open_[hit]] = at[hit]
            left = ~hit & (at + 1 < end)
            open_, at, end = open_[left], at[left] + 1, end[left]
        return out

    @classmethod
    def of(cls, symbols: np.ndarray, lengths: np.ndarray) -> Trie:
        """From word codes of distinct phrases, one phrase after the other; a phrase's number is its place."""
        words, number = np.unique(symbols, return_inverse=True)
        digits = max(1, -(-max(1, int(len(words) - 1).bit_length()) // 8))
        most = int(lengths.max())
        begin = np.cumsum(lengths) - lengths
        node = np.zeros(len(lengths), np.int64)  # the node each phrase has come to
        parents, codes, depth_end, total = [], [], np.zeros(len(lengths), np.int64), 1
        for level in range(most * digits):
            word, shift = divmod(level, digits)
            on = np.flatnonzero(lengths > word)
            digit = (number[begin[on] + word] >> (8 * (digits - 1 - shift))) & 255
            edge, back = np.unique(node[on] * 256 + digit, return_inverse=True)
            node[on] = total + back
            parents.append(edge >> 8)
            codes.append(edge & 255)
            total += len(edge)
            done = on[lengths[on] == word + 1]
            depth_end[done] = node[done]
        parent, code = np.concatenate(parents), np.concatenate(codes)
        order = np.argsort(parent, kind="stable")  # children of one parent together
        sizes = np.bincount(parent, minlength=total)
        first = np.cumsum(sizes) - sizes
        base, used = free_first(sizes, np.append(code[order], 0), first)
        slot = np.zeros(total, np.int64)
        slot[1:] = base[parent] + code + MARGIN
        root = used + MARGIN
        slot[0] = root
        size = root + 1 + MARGIN
        arrays = [np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)]
        arrays[0][slot] = np.where(sizes > 0, base + MARGIN, 0)
        arrays[1][slot[1:]] = slot[parent]
        arrays[2][slot[depth_end]] = np.arange(len(lengths))
        return cls(words, digits, *arrays, root)

    def packed(self) -> bytes:
        head = np.array([len(self.words), self.digits, len(self.base), self.root], "<i8").tobytes()
        return head + self.words.tobytes() + self.base.tobytes() + self.check.tobytes() + self.accept.tobytes()

    @classmethod
    def unpacked(cls, held: bytes) -> Trie:
        n, digits, size, root = np.frombuffer(held, "<i8", 4).tolist()
        at = 32 + 8 * n
        arrays = [np.frombuffer(held, "<i4", size, at + 4 * size * i) for i in range(3)]
        return cls(np.frombuffer(held, "<u8", n, 32), digits, *arrays, root)

    def count(self, codes: np.ndarray, link: np.ndarray, out: np.ndarray) -> None:
        """Add to ``out`` how often each phrase begins at any position of a text of word codes."""
        place = self.numbers(codes)
        known = place >= 0
        at = np.flatnonzero(known)
        state = np.full(len(at), self.root, np.int32)
        word = 0
        while len(at):
            symbol = place[at + word]
            for shift in range(self.digits - 1, -1, -1):
                step = self.base[state] + ((symbol >> (8 * shift)) & 255).astype(np.int32)
                ok = self.check[step] == state
                at, state, symbol = at[ok], step[ok], symbol[ok]
            found = self.accept[state]
            out += np.bincount(found[found >= 0], minlength=len(out))
            on = link[at + word]
            at, state = at[on], state[on]
            word += 1
            on = known[at + word]
            at, state = at[on], state[on]


def build_tries(table: pa.Table) -> pa.Table:
    """The trie of one block; phrases are numbered by ``idx``."""
    table = table.sort_by("idx")
    phrases = table.column("phrase").combine_chunks()
    words = words_of(phrases)
    known = {lang: lang_code(lang) for lang in set(table.column("lang").to_pylist())}
    of_row = np.array([known[lang] for lang in table.column("lang").to_pylist()], np.uint64)
    trie = Trie.of(mix(words.hashes(lower=True) ^ of_row[words.rows()]), words.counts)
    return pa.table({"block": table.column("block").slice(0, 1), "n": pa.array([table.num_rows], pa.int32()), "trie": pa.array([trie.packed()], pa.binary())})


COUNTED = "of_block int, idx int, of_lang string, n long"


def count_phrases(sent: list, with_totals: bool):
    """Per task: how often each phrase of the tries occurs, and on demand all words per language under idx -1.

    ``sent`` holds (number of the block, its phrases, its trie as a broadcast).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [(block, Trie.unpacked(held.value), np.zeros(n, np.int64)) for block, n, held in sent]
        totals: dict[str, int] = {}
        for batch in by_size(batches, "text", BATCH_BYTES):
            positions = Positions(batch)
            for _, trie, counts in tries:
                trie.count(positions.codes, positions.link, counts)
            for lang, m in positions.totals().items() if with_totals else ():
                totals[lang] = totals.get(lang, 0) + m
        names = ["of_block", "idx", "of_lang", "n"]
        for block, _, counts in tries:
            found = np.flatnonzero(counts)
            columns = [pa.array(np.full(len(found), block, np.int32)), pa.array(found.astype(np.int32)), pa.nulls(len(found), pa.string()), pa.array(counts[found])]
            yield pa.RecordBatch.from_arrays(columns, names)
        none = pa.array([-1] * len(totals), pa.int32())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], names)

    return run


def counted_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most: int = MOST_WORDS, block: int = BLOCK, buckets: int | None = None) -> tuple[DataFrame, DataFrame] | None:
    """Counts of all phrases that may be frequent (lang, phrase, f) and of all words (lang, n); None without any."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = buckets or min(MOST_BUCKETS, max(FEWEST_BUCKETS, total // 24))  # about four words a bucket
    found = candidates(texts, least, most, max(3, int(wanted - 1).bit_length()))
    blocks = -(-found.count() // block)
    if not blocks:
        return None
    dealt = found.withColumn("block", F.pmod(F.xxhash64("lang", "phrase"), F.lit(blocks)).cast("int"))
    order = F.row_number().over(Window.partitionBy("block").orderBy("lang", "phrase")) - 1  # a block has a fixed size
    numbered = materialize(dealt.withColumn("idx", order), "phrase_blocks")
    tries = materialize(numbered.groupBy("block").applyInArrow(build_tries, "block int, n int, trie binary"), "tries")
    parts = []
    for b in range(0, blocks, AT_ONCE):
        sent = []
        for row in tries.filter(F.col("block").between(b, b + AT_ONCE - 1)).toLocalIterator():
            sent.append((row.block, row.n, spark.sparkContext.broadcast(bytes(row.trie))))
        counted = texts.mapInArrow(count_phrases(sent, not parts), COUNTED)
        parts.append(materialize(counted.groupBy("of_block", "idx", "of_lang").agg(F.sum("n").alias("f")), "phrase_counts"))
        for _, _, held in sent:
            held.unpersist()
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    same = (F.col("block") == F.col("of_block")) & (numbered["idx"] == sums["idx"])
    phrases = numbered.join(sums.filter("idx >= 0"), same).select("lang", "phrase", "f")
    return phrases, sums.filter("idx < 0").select(F.col("of_lang").alias("lang"), F.col("f").alias("n"))


RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most: int = MOST_WORDS, top: int = TOP, percent: int = PERCENT, block: int = BLOCK, buckets: int | None = None) -> DataFrame:
    """The first ``top`` phrases of each language by the score of their weakest cut."""
    counted = counted_phrases(docs, text, lang, least, most, block, buckets)
    if counted is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    phrases = materialize(counted[0].filter(F.col("f") >= least), "frequent_phrases")
    words = F.split("phrase", " ")
    long = phrases.select("lang", "phrase", F.col("f").alias("a"), words.alias("words")).filter(F.size("words") > 1)

    cuts = long.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    first, rest = F.array_join(F.slice("words", F.lit(1), F.col("cut")), " "), F.array_join(F.expr("slice(words, cut + 1, size(words) - cut)"), " ")
    cuts = cuts.select("lang", "phrase", "a", "cut", first.alias("first"), rest.alias("rest"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("CAST(CAST(1000000 * CAST(a AS DECIMAL(38, 0)) AS DECIMAL(38, 0)) * CAST(a AS DECIMAL(20, 0)) div (CAST(l AS DECIMAL(20, 0)) * CAST(r AS DECIMAL(18, 0))) AS BIGINT)")
    worst = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("cut"))

    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), k -> transform(sequence(1, size(words) - k + 1), i -> array_join(slice(words, i, k), ' '))))")
    inside = long.filter(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    hidden = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = worst.join(hidden, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(counted[1], "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language of all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, {MOST_WORDS + 1})) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, cut, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(ws, 1, cut), ' ')
         JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(ws, cut + 1, c.k), ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, array_to_string(list_slice(ws, i, i + 1), ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, f, string_split(phrase, ' ') AS ws, unnest(range(1, 3)) AS i FROM f WHERE k = 3) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < {PERCENT} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}"""

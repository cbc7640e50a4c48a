"""Removal of passages of many words that occur more than once.

Method: fixed-block anchors.  With windows of ``w`` words the block length is
``b = (w + 1) // 2``, so every window holds a whole block of its document's own
grid.  The non-overlapping blocks of all documents are the index; every rolling
run of b words of every document probes it.  A block that some other place
holds too is a hit.  A hit is extended to both sides: the windows that hold the
block are counted exactly, by 96-bit hashes, and a window found at two places
or more is covered.  Consecutive covered windows make up a maximal exact
repeat; all of its words go.

Documents are dealt into chunks of about ``CHUNK_BYTES`` by a hash of the whole
row, and chunks exchange packed arrays of hashes with buckets of the hash
space.  A chunk sends each hash once, so a passage that a third of all rows
share reaches its bucket once per chunk.  A probe sends the bucket number and
32 further bits; buckets grow in number with the input, so the share of false
hits stays the same, and the exact count removes them.  Nothing is dropped or
capped.

Defined results: a null text has no words; n_removed is 0 and kept_sha256 that
of the empty text.  Windows are judged on the input.  Repeated rows are two
places like any others.  Ids may be null or repeated and only label the rows.
Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import Words, runs, starts_of_runs, words_of

WINDOW = 35
CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 2 << 20
LEAST_PARTS = 16
LOW = np.uint64(0xFFFFFFFF)
SENT = "bucket int, chunk int, step int, keys binary, more binary, flags binary"
ANSWER = "chunk int, bucket int, step int, found binary"


def block_words(window: int) -> int:
    return (window + 1) // 2


class Chunk:
    """Rows of a chunk in a fixed order, with what both rounds derive from their words."""

    def __init__(self, table: pa.Table, window: int, buckets: int):
        table = table.combine_chunks()
        order = pa.compute.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")])
        self.table, self.window, self.buckets = table.take(order), window, np.uint64(buckets)
        column = self.table.column("text")
        self.words: Words = words_of(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
        self.hashes = self.words.hashes()

    def probes(self):
        """Rolling runs of block length: bucket and key, ascending and distinct, with their number (2 for more) and whether one is a block."""
        b = block_words(self.window)
        ok = starts_of_runs(self.words.first, b)
        ok[max(0, len(ok) - b + 1) :] = False
        at = np.flatnonzero(ok)
        code = runs(self.hashes, b)[at]
        packed = ((code >> np.uint64(32)) % self.buckets << np.uint64(32)) | (code & LOW)
        inside = at - np.repeat(self.words.first[:-1], self.words.counts)[at]
        block = inside % b == 0
        order = np.argsort(packed, kind="stable")
        packed, block_sorted = packed[order], block[order]
        new = np.ones(len(packed), bool)
        new[1:] = packed[1:] != packed[:-1]
        begin = np.flatnonzero(new)
        times = np.diff(np.append(begin, len(packed)))
        is_block = np.logical_or.reduceat(block_sorted, begin) if len(begin) else new
        which = np.empty(len(packed), np.int64)
        which[order] = np.cumsum(new) - 1
        return packed[begin], times > 1, is_block, at[block], which[block]

    def candidates(self, hit_blocks: np.ndarray):
        """Windows that hold a hit block of their own grid: first words, two hashes, place in the distinct ascending keys."""
        b, n = block_words(self.window), len(self.hashes)
        mark = np.zeros(n + 1, np.int32)
        np.add.at(mark, np.maximum(hit_blocks - (self.window - b), 0), 1)
        np.add.at(mark, hit_blocks + 1, -1)
        ok = (np.cumsum(mark[:-1]) > 0) & starts_of_runs(self.words.first, self.window)
        ok[max(0, n - self.window + 1) :] = False
        at = np.flatnonzero(ok)
        one, two = (runs(self.hashes, self.window, which)[at] if len(at) else np.zeros(0, np.uint64) for which in (0, 1))
        packed = ((one >> np.uint64(32)) % self.buckets << np.uint64(32)) | (one & LOW)
        order = np.lexsort((two, packed))
        packed, two = packed[order], two[order]
        new = np.ones(len(packed), bool)
        new[1:] = (packed[1:] != packed[:-1]) | (two[1:] != two[:-1])
        which = np.empty(len(packed), np.int64)
        which[order] = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        return at, which, packed[begin], two[begin], np.diff(np.append(begin, len(packed))) > 1

    def stretches(self, packed: np.ndarray):
        """(bucket, from, to) of ascending keys, for buckets that have any."""
        buckets = (packed >> np.uint64(32)).astype(np.int64)
        begin = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])) if len(buckets) else np.zeros(0, np.int64)
        return [(int(buckets[x]), int(x), int(y)) for x, y in zip(begin, np.append(begin[1:], len(buckets)))]


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(held: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(held, np.uint8), count=n).astype(bool)


def sent(rows: list[tuple]) -> pa.Table:
    names = ["bucket", "chunk", "step", "keys", "more", "flags"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(zip(names, kinds))})


def probe_index(window: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        chunk, number = Chunk(table, window, buckets), table.column("chunk")[0].as_py()
        packed, many, block, _, _ = chunk.probes()
        low = (packed & LOW).astype("<u4")
        return sent([(k, number, 1, low[a:b].tobytes(), b"", bits(np.concatenate([many[a:b], block[a:b]]))) for k, a, b in chunk.stretches(packed)])

    return run


def answer(table: pa.Table) -> pa.Table:
    """For every row of a bucket which of its keys are found: blocks that another place holds too, or windows held twice."""
    keys, more, flags = (table.column(c).to_pylist() for c in ("keys", "more", "flags"))
    step = table.column("step")[0].as_py()
    sizes = [len(k) // 4 for k in keys]
    ends = np.cumsum(sizes)
    key = np.concatenate([np.frombuffer(k, "<u4") for k in keys])
    if step == 1:
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.append(True, sorted_key[1:] != sorted_key[:-1])
        both = [unbits(f, 2 * n) for f, n in zip(flags, sizes)]
        many = np.concatenate([f[:n] for f, n in zip(both, sizes)])
        block = np.concatenate([f[n:] for f, n in zip(both, sizes)])
    else:
        second = np.concatenate([np.frombuffer(m, "<u8") for m in more])
        order = np.lexsort((second, key))
        sorted_key, sorted_second = key[order], second[order]
        new = np.append(True, (sorted_key[1:] != sorted_key[:-1]) | (sorted_second[1:] != sorted_second[:-1]))
        many = np.concatenate([unbits(f, n) for f, n in zip(flags, sizes)])
        block = np.ones(len(key), bool)
    begin = np.flatnonzero(new)
    places = np.add.reduceat(1 + many[order].astype(np.int64), begin)
    indexed = np.logical_or.reduceat(block[order], begin)
    found = np.empty(len(key), bool)
    found[order] = np.repeat((places > 1) & indexed, np.diff(np.append(begin, len(key))))
    replies = []
    for a, b in zip(np.append(0, ends[:-1]), ends):
        replies.append(bits(found[a:b][block[a:b]]))
    return pa.table(
        {
            "chunk": table.column("chunk"),
            "bucket": table.column("bucket"),
            "step": table.column("step"),
            "found": pa.array(replies, pa.binary()),
        }
    )


def gathered(chunk: Chunk, packed: np.ndarray, asked: np.ndarray, replies: pa.Table, step: int) -> np.ndarray:
    """The answers as one flag for each ascending key; False for keys not asked about."""
    held = {b: f for b, s, f in zip(replies.column("bucket").to_pylist(), replies.column("step").to_pylist(), replies.column("found").to_pylist()) if s == step}
    out = np.zeros(len(packed), bool)
    for k, a, b in chunk.stretches(packed):
        own = asked[a:b]
        out[np.flatnonzero(own) + a] = unbits(held[k], int(own.sum()))
    return out


def hit_blocks(chunk: Chunk, replies: pa.Table) -> np.ndarray:
    packed, _, block, places, which = chunk.probes()
    return places[gathered(chunk, packed, block, replies, 1)[which]]


def extend_hits(window: int, buckets: int):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return sent([])
        chunk, number = Chunk(table, window, buckets), table.column("chunk")[0].as_py()
        _, _, packed, two, many = chunk.candidates(hit_blocks(chunk, replies))
        low, two = (packed & LOW).astype("<u4"), two.astype("<u8")
        return sent([(k, number, 2, low[a:b].tobytes(), two[a:b].tobytes(), bits(many[a:b])) for k, a, b in chunk.stretches(packed)])

    return run


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def cover(window: int, buckets: int, with_text: bool):
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: 5 if with_text else 4]
        if not table.num_rows:
            return pa.table([pa.nulls(0, k) for k in [pa.int64()] * 3 + [pa.string()] * (len(names) - 3)], names)
        chunk = Chunk(table, window, buckets)
        at, which, packed, _, _ = chunk.candidates(hit_blocks(chunk, replies))
        twice = gathered(chunk, packed, np.ones(len(packed), bool), replies, 2)
        starts = at[twice[which]]
        n = len(chunk.hashes)
        mark = np.zeros(n + 1, np.int32)
        np.add.at(mark, starts, 1)
        np.add.at(mark, np.minimum(starts + window, n), -1)
        keep = np.cumsum(mark[:-1]) == 0
        first = chunk.words.first
        kept_before = np.concatenate([[0], np.cumsum(keep)])
        removed = chunk.words.counts - (kept_before[first[1:]] - kept_before[first[:-1]])
        sums, texts = [], []
        for text, a, b, gone in zip(chunk.table.column("text").to_pylist(), first[:-1].tolist(), first[1:].tolist(), removed.tolist()):
            parts = (text or "").encode().split()
            left = b" ".join(parts if not gone else compress(parts, keep[a:b].tolist()))
            sums.append(hashlib.sha256(left).hexdigest())
            if with_text:
                texts.append(left.decode())
        columns = [chunk.table.column("doc_id"), pa.array(chunk.words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(sums, pa.string())]
        return pa.table(columns + ([pa.array(texts, pa.string())] if with_text else []), names)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False, chunk_bytes: int = CHUNK_BYTES, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, and ``kept_text`` if asked for."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = LEAST_PARTS + total // chunk_bytes
    buckets = LEAST_PARTS + total // (6 * bucket_keys)  # a word and its space take about six bytes
    base = texts.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "doc_id", "text")
    by_chunk = base.groupBy("chunk")
    hits = by_chunk.applyInArrow(probe_index(window, buckets), SENT).groupBy("bucket").applyInArrow(answer, ANSWER)
    windows = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(extend_hits(window, buckets), SENT)
    counted = windows.groupBy("bucket").applyInArrow(answer, ANSWER)
    replies = hits.unionByName(counted)
    schema = RESULT + (", kept_text string" if with_text else "")
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(cover(window, buckets, with_text), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words, the words removed and a checksum of what is kept."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    w = WINDOW
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {w} + 2)) AS i FROM w WHERE len(ws) >= {w}),
keyed AS (SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + {w} - 1), ' ')) AS k FROM places),
twice AS (SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY k) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + {w})) AS p FROM twice)),
counted AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
word AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p WHERE gone.p IS NULL GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN counted ON counted.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id"""

"""Token ids of documents in ORC files, written in document order and read back.

Method: documents are ranged and sorted by id, encoded, and written as ORC.
The writer run-length encodes the integers, keeps a row index per stripe and a
Bloom filter on ``doc_id``; stripes are read in parallel, and a look-up of ids
skips the stripes and row groups whose statistics or filter rule them out.

Defined results: a null or empty text has the end id only.  Null ids sort
first.  Rows of one id are ordered by text, null first; rows alike in both are
interchangeable.  An empty table gives files without rows.  Only the id and
text columns are read.

A file holds ``doc_id``, ``part`` and ``pos`` (the order of rows over all
files and within one), and ``ids``.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .words import ONE, Words, by_size, mix, words_of

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BATCH_BYTES = 4 << 20
CACHE_PIECES = 2_000_000
JOINED_PIECES = 16_384
FILE_OPTIONS = {
    "orc.compress": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "10000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}

def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


class Pieces:
    """Ids of text pieces met before, in arrays: a piece takes some 40 bytes, and a batch is looked up at once.

    A piece is known by two independent 64-bit hashes.
    """

    def __init__(self, most: int):
        self.most = most
        self.mask = np.uint64((1 << (2 * most).bit_length()) - 1)
        self.clear()

    def clear(self):
        self.keys, self.at = np.zeros(int(self.mask) + 1, np.uint64), np.zeros(int(self.mask) + 1, np.int32)
        self.checks, self.starts, self.ids = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], [np.zeros(0, np.uint32)]
        self.count = self.total = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each piece, or -1."""
        out, slot, open_ = np.full(len(keys), -1, np.int64), keys & self.mask, np.arange(len(keys))
        while len(open_):
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.at[slot[open_[hit]]]
            open_ = open_[~hit & (held != 0)]
            slot[open_] = (slot[open_] + ONE) & self.mask
        return out

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """New, distinct pieces with their ids one after the other."""
        slot, open_ = keys & self.mask, np.arange(len(keys))
        while len(open_):
            free = open_[self.keys[slot[open_]] == 0]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.at[slot[first]] = keys[first], self.count + first
            open_ = open_[self.keys[slot[open_]] != keys[open_]]
            slot[open_] = (slot[open_] + ONE) & self.mask
        self.checks.append(checks)
        self.starts.append(self.total + np.cumsum(sizes))
        self.ids.append(ids)
        self.count, self.total = self.count + len(keys), self.total + len(ids)

    def flat(self):
        for name in ("checks", "starts", "ids"):
            setattr(self, name, [np.concatenate(getattr(self, name))])
        return self.checks[0], self.starts[0], self.ids[0]


def regular_rows(words: Words, ends: np.ndarray) -> np.ndarray:
    """Rows whose words are parted by one space or line break each, with no other white space anywhere.

    There the byte-level splitter begins a piece at every space and line
    break, so pieces can be encoded on their own.
    """
    data, first = words.data, words.first
    bad = np.zeros(len(ends), np.int64)
    begins = np.append(0, ends[:-1])

    def blame(places: np.ndarray):
        np.add.at(bad, np.searchsorted(ends, places, side="right"), 1)

    some = words.counts > 0
    bad[~some] += 1
    bad[some] += words.starts[first[:-1][some]] != begins[some]
    bad[some] += words.ends[first[1:][some] - 1] != ends[some]
    inner = np.ones(len(words.starts), bool)
    inner[first[:-1][some]] = False
    inner = np.flatnonzero(inner)
    apart = words.starts[inner] - words.ends[inner - 1]
    mark = data[words.starts[inner] - 1]
    blame(words.starts[inner[(apart != 1) | ((mark != 32) & (mark != 10))]])
    blame(np.flatnonzero((data >= 0x1C) & (data <= 0x1F)))
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    if len(lead):
        padded = np.append(data, [0, 0])
        a, b, c = padded[lead], padded[lead + 1], padded[lead + 2]
        wide = (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)
        blame(lead[(a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & wide | (a == 0xE3) & (b == 0x80) & (c == 0x80)])
    return bad == 0


def encoder(path: str):
    """A function from a string column to (ids, number of ids of each row).

    Pieces met before are not encoded again; a worker keeps up to
    ``CACHE_PIECES`` of them and then starts over.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    held = vars(tokenizers).setdefault("_pieces_by_file", {})
    if path not in held:
        tokenizer = tokenizers.Tokenizer.from_file(path)
        vocabulary = tokenizer.get_vocab()
        n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a byte-level token has one character per byte
        n_bytes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        held[path] = (tokenizer, n_bytes, Pieces(CACHE_PIECES))
    tokenizer, n_bytes, known = held[path]

    def ids(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(words: Words, marks: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> None:
        """Encode pieces as one text, which is quicker than one by one, and part the ids by their bytes."""
        whole, spans = words.data.tobytes(), list(zip(words.starts.tolist(), words.ends.tolist()))
        after = np.flatnonzero(marks > 0)
        for i in range(0, len(after), JOINED_PIECES):
            some = after[i : i + JOINED_PIECES]
            pieces = [whole[spans[j][0] - 1 : spans[j][1]] for j in some.tolist()]
            joined = ids([b"".join(pieces).decode()])[0]
            ends = np.searchsorted(np.cumsum(n_bytes[joined]), np.cumsum([len(x) for x in pieces])) + 1
            known.add(keys[some], checks[some], joined, np.diff(ends, prepend=0))
        alone = np.flatnonzero(marks == 0)  # at the start of a text
        if len(alone):
            parts = ids([whole[slice(*spans[j])].decode() for j in alone.tolist()])
            known.add(keys[alone], checks[alone], np.concatenate(parts), np.array([len(x) for x in parts]))

    def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if known.count > CACHE_PIECES // 2:
            known.clear()
        column = column.fill_null("")
        words = words_of(column)
        ends = np.cumsum(pa.compute.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        regular = regular_rows(words, ends)
        taken, take = np.where(regular, words.counts, 0), np.repeat(regular, words.counts)
        chosen = Words(words.data, words.starts[take], words.ends[take], words.first)
        marks = np.where(np.isin(chosen.starts, np.append(0, ends)), 0, words.data[chosen.starts - 1]).astype(np.uint64) if len(chosen.starts) else np.zeros(0, np.uint64)
        keys, checks = mix(chosen.hashes() + marks), mix(chosen.hashes(seed=8) + marks)
        keys[keys == 0] = ONE
        at = known.find(keys)
        unseen, first = np.unique(keys[at < 0], return_index=True)
        if len(unseen):
            new = np.flatnonzero(at < 0)[first]
            learn(Words(words.data, chosen.starts[new], chosen.ends[new], words.first), marks[new], keys[new], checks[new])
            at = known.find(keys)
        held_checks, starts, held_ids = known.flat()
        regular[np.unique(words.rows()[take][held_checks[at] != checks])] = False  # two pieces of one hash
        sizes = starts[at + 1] - starts[at]
        before = np.concatenate([[0], np.cumsum(sizes)])
        flat = held_ids[np.arange(before[-1]) + np.repeat(starts[at] - before[:-1], sizes)]
        word_first = np.concatenate([[0], np.cumsum(taken)])
        counts = before[word_first[1:]] - before[word_first[:-1]]
        odd = np.flatnonzero(~regular)
        if not len(odd):
            return flat, counts
        coded = dict(zip(odd.tolist(), ids(column.take(pa.array(odd)).to_pylist())))
        rows = [coded[r] if r in coded else flat[before[word_first[r]] : before[word_first[r + 1]]] for r in range(len(column))]
        return np.concatenate(rows), np.array([len(r) for r in rows], np.int64)

    return encode


def encode_rows(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pos = encoder(path), 0
        for batch in by_size(batches, "text", BATCH_BYTES):
            flat, counts = encode(batch.column("text"))
            offsets = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int32)
            values = np.full(offsets[-1], end_id, np.int32)
            values[np.arange(len(flat)) + np.repeat(np.arange(len(counts)), counts)] = flat
            places = pa.array(np.arange(pos, pos + len(counts), dtype=np.int64))
            pos += len(counts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), places, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["doc_id", "pos", "ids"])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, options: dict[str, str] | None = None) -> None:
    """Encode ``doc_id``, ``text`` and write the ids as ORC files in ascending order of id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    coded = ordered.mapInArrow(encode_rows(tokenizer or default_tokenizer(), end_id), "doc_id long, pos long, ids array<int>")
    numbered = coded.select("doc_id", F.spark_partition_id().alias("part"), "pos", "ids")
    numbered.write.options(**(FILE_OPTIONS | (options or {}))).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; with ``doc_ids`` only theirs, found by statistics and Bloom filters."""
    rows = spark.read.orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("pos"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
            ["doc_id", "part", "pos", "n_tokens", "ids_crc32"],
        )


def index_of(rows: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    sums = rows.select("doc_id", "part", "pos", "ids").mapInArrow(checksums, "doc_id long, part int, pos long, n_tokens long, ids_crc32 long")
    per_part = sums.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = per_part.select(F.col("part").alias("of_part"), F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("part_start"))
    before = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.join(starts, F.col("part") == F.col("of_part"))
    start = F.col("part_start") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    return placed.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def write_and_index(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents' ids to the shared folder and return the index read back from the files."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return index_of(read_tokens(spark, path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the token files."""
    return write_and_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Byte-pair encoding by a table of last tokens, and decoding.

Method.  Two tokens are compatible when merging their joined bytes gives just
the two back.  A sequence of tokens is the encoding of its bytes exactly when
all neighbours are compatible, so every byte prefix of a piece has one valid
last token: the one that ends there and is compatible with the last token of
the prefix before it.  ``Prefix`` keeps that token for every prefix.  The
encoding is read off backwards; appending bytes fills in more of the table; an
edit keeps the table before it and refills it from there until, for the length
of the longest token, it agrees with the old table shifted.

Texts are split into pieces by the tokenizer's pattern, and a piece that is a
token as a whole is that token.  ``Tables`` fills the tables of all new pieces
of a batch together, and ``Encoder`` remembers a fixed number of pieces.  ``append_ids`` encodes a text that has grown from the
first piece that the new end can change.

Rows are encoded one by one where they are read, nothing is shuffled.  The
pattern's classes are those of the installed ``regex``, which knows letters of
newer Unicode versions than tiktoken does (such as U+323B0 to U+33479).  Defined
results: a null or empty text has no ids.  Null ids, repeated rows and other
columns need no rule; only the id and text columns are read.  An empty table
gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .phrases import Trie
from .words import ONE, by_size, mix

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
BATCH_BYTES = 4 << 20
BATCH_IDS = 1 << 20  # ids decoded together
HELD = 500_000  # pieces and words that a worker remembers, besides those of one batch
PAIRS = 1_000_000  # token pairs it remembers
TOGETHER = 64  # bytes of the longest piece that is encoded together with others
LOOK_AHEAD = 3  # characters from its start on that can decide how a piece ends


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens of a rank file, and which of them may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[int, bool] = {}
        self.made_by: dict[int, list[tuple[int, bytes, bytes]]] = {}
        self.sizes = {rank: len(token) for rank, token in self.tokens.items()}
        # Only tokens that merging can make of their own bytes occur inside a piece; -1 stands for ends of such tokens.
        made = {token: rank for token, rank in ranks.items() if self.merged(token) == [rank]}
        self.ends = {token[i:]: -1 for token in made for i in range(1, len(token))} | made

    def merges(self, data: bytes) -> list[tuple[int, bytes, bytes]]:
        """Merge the neighbours of lowest rank, the first of equals, until none are left to merge; for short texts.

        Per merge its rank and the first and last part after it, before all merges at rank -1.
        """
        parts, ranks, none = [data[i : i + 1] for i in range(len(data))], self.ranks, len(self.ranks) << 1
        steps = [(-1, parts[0], parts[-1])]
        while len(parts) > 1:
            best, at = min((ranks.get(a + b, none), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == none:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((best, parts[0], parts[-1]))
        self.parts = parts
        return steps

    def merged(self, data: bytes) -> list[int]:
        if not data:
            return []
        self.merges(data)
        return [self.ranks[p] for p in self.parts]

    def steps(self, token: int) -> list[tuple[int, bytes, bytes]]:
        known = self.made_by.get(token)
        if known is None:
            known = self.made_by[token] = self.merges(self.tokens[token])
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both never merges across their border."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = not self.crossed(self.steps(a), self.steps(b))
        return known

    def crossed(self, left: list[tuple[int, bytes, bytes]], right: list[tuple[int, bytes, bytes]]) -> bool:
        """Run the merges of both sides in their common order and watch the pair at the border."""
        ranks, none, i, j = self.ranks, len(self.ranks) << 1, 0, 0
        while True:
            next_left = left[i + 1][0] if i + 1 < len(left) else none
            next_right = right[j + 1][0] if j + 1 < len(right) else none
            across = ranks.get(left[i][2] + right[j][1], none)
            if across < next_left and across <= next_right:
                return True
            if next_left == none and next_right == none:
                return False
            if next_left <= next_right:
                i += 1
            else:
                j += 1


class Prefix:
    """The bytes of a piece with the last token of each prefix."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def fill(self, begin: int, stop: int, last: list[int]) -> list[int]:
        """``last``, which holds the prefixes shorter than ``begin``, up to the prefix of length ``stop``.

        The token that ends a prefix is the one that is compatible with what the
        prefix before it ends in; ends are tried from the shortest on, as long as
        a token has them.
        """
        data, ends, pairs, compatible = self.data, self.vocabulary.ends.get, self.vocabulary.pairs.get, self.vocabulary.compatible
        for end in range(begin, stop + 1):
            for start in range(end - 1, -1, -1):
                token = ends(data[start:end])
                if token is None:
                    raise ValueError("the rank file lacks a single byte")
                if token >= 0:
                    if not start:
                        break
                    before = last[start]
                    fits = pairs(before << 32 | token)
                    if compatible(before, token) if fits is None else fits:
                        break
            last.append(token)
        return last

    def append(self, data: bytes) -> None:
        begin, self.data = len(self.data) + 1, self.data + data
        self.last = self.fill(begin, len(self.data), self.last)

    def edit(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` in place of the bytes from ``start`` to ``stop``; how many entries were made anew."""
        old, shift = self.last, len(data) - (stop - start)
        self.data = self.data[:start] + data + self.data[stop:]
        self.last, alike = old[: start + 1], 0
        for end in range(start + 1, len(self.data) + 1):
            token = self.fill(end, end, self.last)[end]
            alike = alike + 1 if end - shift > stop and token == old[end - shift] else 0
            if alike > self.vocabulary.longest:  # all that later entries depend on is as before
                self.last += old[end - shift + 1 :]
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        out, end, last, sizes = [], len(self.data), self.last, self.vocabulary.sizes
        while end:
            out.append(last[end])
            end -= sizes[last[end]]
        return out[::-1]


class Pairs:
    """What is known of token pairs, in arrays: whether they are compatible."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.mask = np.uint64((1 << (2 * PAIRS).bit_length()) - 1)
        self.clear()

    def clear(self):
        self.keys, self.fits, self.count = np.zeros(int(self.mask) + 1, np.uint64), np.zeros(int(self.mask) + 1, bool), 0

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Where each key is, or the free slot where it would be."""
        slot, open_ = mix(keys) & self.mask, np.arange(len(keys))
        while len(open_):
            held = self.keys[slot[open_]]
            open_ = open_[(held != 0) & (held != keys[open_])]
            slot[open_] = (slot[open_] + ONE) & self.mask
        return slot

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) + ONE
        slot = self.slots(keys)
        unseen = np.unique(keys[self.keys[slot] == 0])
        if len(unseen):
            if self.count + len(unseen) > PAIRS:
                self.clear()
                unseen = np.unique(keys)
            steps, crossed = self.vocabulary.steps, self.vocabulary.crossed
            fits = [not crossed(steps(key >> 32), steps(key & 0xFFFFFFFF)) for key in (unseen - ONE).tolist()]
            fits, open_ = np.array(fits), np.arange(len(unseen))
            while len(open_):
                slot = self.slots(unseen[open_])
                one = np.unique(slot, return_index=True)[1]
                self.keys[slot[one]], self.fits[slot[one]] = unseen[open_[one]], fits[open_[one]]
                open_ = np.delete(open_, one)
            self.count += len(unseen)
            slot = self.slots(keys)
        return self.fits[slot]


class Tables:
    """The tables of last tokens of many pieces, filled together, one prefix length after the other."""

    def __init__(self, vocabulary: Vocabulary):
        made = [token for token, rank in vocabulary.ends.items() if rank >= 0]
        # Tokens from their last byte to the first: walking back from the end of a prefix meets all that end there.
        codes = np.frombuffer(b"".join(token[::-1] for token in made), np.uint8).astype(np.uint64)
        self.trie = Trie.of(codes, np.array([len(token) for token in made], np.int64))
        self.rank = np.array([vocabulary.ranks[token] for token in made], np.int64)
        self.size = np.zeros(int(self.rank.max()) + 1, np.int64)
        self.size[self.rank] = [len(token) for token in made]
        self.pairs = Pairs(vocabulary)

    def last_tokens(self, data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The last token of every prefix of pieces in descending order of size, at the place of the prefix's last byte."""
        trie, last = self.trie, np.full(len(data), -1, np.int64)
        for end in range(1, int(sizes[0]) + 1):
            at = np.arange(int(np.searchsorted(-sizes, -end, side="right")))
            state, size = np.full(len(at), trie.root, np.int32), 0
            while len(at):
                if size == end:
                    raise ValueError("the rank file lacks a single byte")
                size += 1
                step = trie.base[state] + data[first[at] + end - size]
                ok = trie.check[step] == state
                at, state = at[ok], step[ok]
                found = np.flatnonzero(trie.accept[state] >= 0)
                token = self.rank[trie.accept[state[found]]]
                if size < end and len(found):
                    fits = self.pairs.compatible(last[first[at[found]] + end - size - 1], token)
                    found, token = found[fits], token[fits]
                last[first[at[found]] + end - 1] = token
                left = np.ones(len(at), bool)
                left[found] = False
                at, state = at[left], state[left]
        return last

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit integers; pieces in descending order of size."""
        if not pieces:
            return []
        sizes = np.array([len(p) for p in pieces], np.int64)
        first = np.cumsum(sizes) - sizes
        last = self.last_tokens(np.frombuffer(b"".join(pieces), np.uint8).astype(np.int32), first, sizes)
        begins, end, open_ = np.zeros(len(last), bool), sizes.copy(), np.arange(len(sizes))
        while len(open_):  # read back from the end: each token's place is its last byte
            place = first[open_] + end[open_] - 1
            begins[place] = True
            end[open_] -= self.size[last[place]]
            open_ = open_[end[open_] > 0]
        counts = np.add.reduceat(begins, first)
        flat, edges = last[begins].astype("<u4").tobytes(), np.concatenate([[0], 4 * np.cumsum(counts)]).tolist()
        return [flat[a:z] for a, z in zip(edges, edges[1:])]


class Encoder:
    """Ids of texts, as bytes of little-endian 32-bit integers; pieces and words met before are remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary = Vocabulary(ranks)
        self.tables = Tables(self.vocabulary)
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        """Encode new pieces: whole tokens, short ones together, long ones one by one."""
        several = []
        for piece in pieces:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            if whole is not None:
                self.pieces[piece] = np.array([whole], "<u4").tobytes()
            elif len(data) > TOGETHER:
                self.pieces[piece] = np.array(Prefix(self.vocabulary, data).ids(), "<u4").tobytes()
            else:
                several.append((data, piece))
        several.sort(key=lambda x: -len(x[0]))
        self.pieces.update(zip([piece for _, piece in several], self.tables.ids([data for data, _ in several])))

    def by_pieces(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Texts whose words are parted by single spaces are looked up word by word, others piece by piece.

        A word with the one space before it begins and ends with pieces of its
        own if neither it nor the word before ends or begins with white space.
        """
        if len(self.words) > HELD:
            self.words.clear()
        if len(self.pieces) > HELD:
            self.pieces.clear()
            self.words.clear()
        parts: list[tuple[str, list[str]]] = []
        for text in texts:
            cut = text.find(" ", 1)
            plain = 0 < cut and not text[cut - 1].isspace()
            parts.append((text[:cut], text[cut + 1 :].split(" ")) if plain else (text, []))
        new = set().union(*(words for _, words in parts)) - self.words.keys()
        odd = {w for w in new if not w or w[0].isspace() or w[-1].isspace()}
        if odd:
            parts = [(text, []) if not odd.isdisjoint(words) else part for text, part, words in zip(texts, parts, (w for _, w in parts))]
            new -= odd
        heads = [self.pattern.findall(head) for head, _ in parts]
        of_word = {word: self.pattern.findall(" " + word) for word in new}
        self.learn(set().union(*heads, *of_word.values()) - self.pieces.keys())
        for word, pieces in of_word.items():
            self.words[word] = self.by_pieces(pieces)
        return [self.by_pieces(head) + b"".join(map(self.words.__getitem__, words)) for head, (_, words) in zip(heads, parts)]

    def append_ids(self, text: str, ids: list[int], tail: str) -> list[int]:
        """The ids of ``text + tail``; ``ids`` are those of ``text``."""
        start = 0
        for m in self.pattern.finditer(text):
            if max(m.end() + 1, m.start() + LOOK_AHEAD) > len(text):
                break
            start = m.end()
        cut, size = len(ids), len(text[start:].encode())
        while size > 0:  # pieces begin where tokens do
            cut -= 1
            size -= len(self.vocabulary.tokens[ids[cut]])
        return list(ids[:cut]) + np.frombuffer(self.encode([text[start:] + tail])[0], "<u4").tolist()


def held_encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this worker for a rank file; it stays for later tasks."""
    import regex

    held = vars(regex).setdefault("_encoders_by_file", {})
    if (path, pattern) not in held:
        held[path, pattern] = Encoder(read_ranks(path), pattern)
    return held[path, pattern]


def id_arrays(coded: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(x) // 4 for x in coded]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4")))


def encode_rows(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held_encoder(path, pattern)
        for batch in by_size(batches, "text", BATCH_BYTES):
            coded = encoder.encode([text or "" for text in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), id_arrays(coded)], ["doc_id", "ids"])

    return run


def append_rows(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held_encoder(path, pattern)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "ids", "tail")))
            coded = [np.array(encoder.append_ids(text or "", ids or [], tail or ""), "<u4").tobytes() for text, ids, tail in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), id_arrays(coded)], ["doc_id", "ids"])

    return run


def by_ids(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` ids, one row at least."""
    for batch in batches:
        counts = pa.compute.fill_null(pa.compute.list_value_length(batch.column("ids")), 0)
        sizes = np.cumsum(counts.to_numpy(zero_copy_only=False), dtype=np.int64)
        a = 0
        while a < len(sizes):
            done = int(sizes[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(sizes, done + limit, side="right")))
            yield batch.slice(a, b - a)
            a = b


def decoder(path: str):
    """A function from lists of ids to the bytes they stand for."""
    tokens = {rank: token for token, rank in read_ranks(path).items()}
    vocabulary = pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.large_binary())

    def decoded(ids: pa.ListArray) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        parts = vocabulary.take(ids.flatten())
        offsets = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1] if len(parts) else np.zeros(1, np.int64)
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets[ends].tobytes()), parts.buffers()[2]])
        return whole.cast(pa.binary())

    return decoded


def decode_rows(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = decoder(path)
        for batch in by_ids(batches, BATCH_IDS):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), decoded(batch.column("ids"))], ["doc_id", "bytes"])

    return run


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row: doc_id and the ids of its whole text."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(encode_rows(tokenizer or default_tokenizer(), pattern or default_pattern()), "doc_id long, ids array<int>")


def append(coded: DataFrame, tokenizer: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row of doc_id, text, its ids and a tail: doc_id and the ids of text and tail together."""
    rows = coded.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "ids", "tail")
    return rows.mapInArrow(append_rows(tokenizer or default_tokenizer(), pattern or default_pattern()), "doc_id long, ids array<int>")


def decode(coded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per row of doc_id, ids: doc_id and the bytes the ids stand for."""
    return coded.select("doc_id", "ids").mapInArrow(decode_rows(tokenizer or default_tokenizer()), "doc_id long, bytes binary")


def digest_rows(path: str):
    """Number of ids, their checksum as text, and the checksum of the decoded bytes."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoded = decoder(path)
        for batch in by_ids(batches, BATCH_IDS):
            ids = batch.column("ids")
            joined = pa.compute.binary_join(ids.cast(pa.list_(pa.string())), ",").cast(pa.binary())
            columns = [[hashlib.sha256(x.as_buffer()).hexdigest() for x in column] for column in (joined, decoded(ids))]
            counts = pa.compute.list_value_length(ids).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, *[pa.array(c, pa.string()) for c in columns]], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def one_after_the_other(first, second):
    """Both steps in one worker: in two, each worker in turn takes either step, and all come to hold an encoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return second(first(batches))

    return run


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of ids, and checksums of the ids and of what they decode to."""
    path = default_tokenizer()
    digests = one_after_the_other(encode_rows(path, default_pattern()), digest_rows(path))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

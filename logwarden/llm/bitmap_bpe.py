"""Byte-level BPE by rank, with a hierarchical bitmap as the queue of merges.

A pre-token is a linked list of byte positions. Every pair of neighbours that forms a known token
is filed under that token's rank: one heap of positions per rank, one bit per rank in a word of 256
ranks, one bit per word in a summary. The lowest set bit of the summary and then of the word gives
the next rank in constant time; its leftmost position is merged and the two new neighbours filed.
Entries whose pair has changed since are skipped when they surface. A pre-token of n bytes costs
O(n log n) at worst, with no search through the parts, so very long pre-tokens stay cheap.

Defined cases: null text counts as empty and gives no ids; repeated rows are encoded one by one;
special tokens in a text are ordinary text; other columns of the input are not touched.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from logwarden.llm.tables import small_batches

WORD_BITS = 8  # ranks per bitmap word: 256
CACHED = 400_000  # pre-tokens kept per generation and worker
LONGEST_CACHED = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


class Bits:
    """Per rank its word, its bit there and the word's bit in the summary."""

    def __init__(self, ranks: int):
        self.word = [rank >> WORD_BITS for rank in range(ranks)]
        self.bit = [1 << (rank & (1 << WORD_BITS) - 1) for rank in range(ranks)]
        self.top = [1 << (rank >> WORD_BITS) for rank in range(ranks)]


def merge(piece: bytes, ranks: dict[bytes, int], bits: Bits) -> list[int]:
    """The ids of one pre-token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after = list(range(1, n + 1))  # where the token that starts here ends
    before = list(range(-1, n - 1))
    pair = [-1] * n  # rank of the pair that starts here, as last filed
    heaps: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    summary = 0
    rank_of, word_of, bit_of, top_of = ranks.get, bits.word, bits.bit, bits.top

    for at in range(n - 1):
        rank = rank_of(piece[at:at + 2])
        if rank is not None:
            pair[at] = rank
            if rank in heaps:
                heaps[rank].append(at)
            else:
                heaps[rank] = [at]
                block = word_of[rank]
                words[block] = words.get(block, 0) | bit_of[rank]
                summary |= top_of[rank]
    while summary:
        block = (summary & -summary).bit_length() - 1
        word = words[block]
        rank = block << WORD_BITS | (word & -word).bit_length() - 1
        heap = heaps[rank]
        at = heappop(heap)
        if not heap:
            del heaps[rank]
            word &= word - 1
            words[block] = word
            if not word:
                summary &= summary - 1
        if pair[at] != rank:
            continue  # stale
        second = after[at]
        end = after[second]
        after[at] = end
        pair[second] = -1
        left = before[at]
        if end < n:
            before[end] = at
            rank = rank_of(piece[at:after[end]])
            if rank is None:
                pair[at] = -1
            else:
                pair[at] = rank
                if rank in heaps:
                    heappush(heaps[rank], at)
                else:
                    heaps[rank] = [at]
                    block = word_of[rank]
                    words[block] = words.get(block, 0) | bit_of[rank]
                    summary |= top_of[rank]
        else:
            pair[at] = -1
        if left >= 0:
            rank = rank_of(piece[left:end])
            if rank is None:
                pair[left] = -1
            else:
                pair[left] = rank
                if rank in heaps:
                    heappush(heaps[rank], left)
                else:
                    heaps[rank] = [left]
                    block = word_of[rank]
                    words[block] = words.get(block, 0) | bit_of[rank]
                    summary |= top_of[rank]
    out, at = [], 0
    while at < n:
        end = after[at]
        out.append(ranks[piece[at:end]])
        at = end
    return out


class Codec(dict):
    """Encodes and decodes texts; remembers the ids of short pre-tokens in two bounded generations."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.bits = Bits(len(self.bytes_of))
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            found = merge(piece.encode(), self.ranks, self.bits)
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process and vocabulary."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` (binary, little-endian unsigned 32-bit) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            ids = [own.encode(text) if text else b"" for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select(docs["doc_id"], docs["text"]).mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` (bytes) from ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            texts = [own.decode(ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "decoded"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the encoding and of its decoding, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            sizes, ids_hex, text_hex = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py() or "")
                sizes.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return small_batches(docs).select(docs["doc_id"], docs["text"]).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

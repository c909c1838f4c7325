"""Packing of documents into training windows by lexical retrieval.

Documents are tokenised once and their ids written. Document frequencies over the whole corpus, one
number per vocabulary entry, give the BM25 weights. Documents are dealt into shards by content: of
the ``SKETCH`` terms of each document that come first in a fixed random order, a min-hash weighted by
these picks a telling one; terms lie on a line as long as
their documents together, and the line is cut into shards of about ``shard_tokens``, so documents
with the same term meet and a term of any share of the corpus spreads over as many shards as it
needs. Each shard holds an inverted index of its documents. A window
starts with a seed document; the index returns the unused documents nearest to it, which fill the
window in order of their score. The document that no longer fits is cut, and its rest is the next
seed. Where nothing similar is left, the next unused document is taken, so windows are full; what
remains at the end of a shard is written as sequences whose lengths are powers of two.

A seed asks with its ``QUERY_TERMS`` most telling terms; the ``POOL`` best documents are scored
again over all their terms, and any others with a score follow in the order of the first.

Defined cases: null text counts as empty and is packed as its end token alone; a document longer
than a window fills windows of its own, and its rest is packed like any document; repeated rows are
packed one by one, and spread over shards by their places in the table; an empty table gives no
rows; other columns of the input are not touched.
"""

from __future__ import annotations

import math
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.common import work_path
from logwarden.llm.tables import small_batches, whole_text

WINDOW = 4096
END = 2
SHARD_TOKENS = 1 << 23
ROW_SHARE = 32  # what a row adds to a shard beside its ids, so short rows are not too many
QUERY_TERMS = 24
POOL = 64
SKETCH = 16  # terms kept of a document to choose the telling one from
SHARPNESS = 2.0  # the power of the inverse document frequency that weighs the min-hash
K1, B = 1.2, 0.75
CACHED = 600_000  # chunks kept per generation and worker
LONGEST_CACHED = 48
STRETCH = 1 << 23  # bytes of text encoded at once
STRETCH_ROWS = 1 << 12
# Lower-case letters whose bytes and upper-case forms are the same in every version of Unicode; that of ß is SS.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ"
MARKS = ",.!?:;#$%&*"
LEARNT = 4096  # new words handed to the merges at once
PLAIN = re.compile(f"[{LETTERS}{LETTERS.upper()}]+").fullmatch
LOWER = re.compile(f"[{LETTERS}]+").fullmatch
PIECE = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")


def gathered(flat: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` in the given order, each as often as it is named, and where they end."""
    wanted = sizes[order]
    ends = np.cumsum(wanted)
    spots = np.repeat((np.cumsum(sizes) - sizes)[order] - ends + wanted, wanted)
    spots += np.arange(len(spots))
    return flat[spots], ends


class Tokens(dict):
    """A tokenizer that remembers the ids of chunks between blanks and line ends, in two bounded generations.

    The tokenizer never joins characters across white space, so chunks can be encoded alone. A chunk of
    plain letters is handed to the tokenizer's merges directly, many at once; ``MARKS`` that follow
    them are looked up apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.end = array(self.code, [END]).tobytes()
        self.old: dict[str, bytes] = {}
        # How the tokenizer writes the bytes of a letter, as told by itself.
        self.letters = {}
        for letter in LETTERS:
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(letter) if self.tokenizer.pre_tokenizer else []
            self.letters[ord(letter)] = found[0][0] if len(found) == 1 else letter
        self.same = all(self.letters[ord(c)] == c for c in LETTERS if c.isascii())
        self.tokenize = self.tokenizer.model.tokenize
        # The merges alone, for words that are in the tokenizer's form; the id at the end of a word tells them apart.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = Split(" ", "removed")
        suffix, self.last = getattr(self.tokenizer.model, "end_of_word_suffix", None), np.zeros(self.size, bool)
        if suffix:
            self.last[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        probes = [*LETTERS, *LETTERS.upper(), "hello", "WORLD", "Élève", LETTERS]
        self.direct = all(self._letters(p.lower()) == self._whole(p) for p in probes) and all(
            self._letters("hello") + self._whole(m) == self._whole("hello" + m) for m in [*MARKS, MARKS, ".***"])

    def _whole(self, chunk: str) -> bytes:
        return array(self.code, self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        # A native array; ids are little-endian where Spark runs today, as numpy's kinds above say.
        if not (self.same and word.isascii()):
            word = word.translate(self.letters)
        return array(self.code, [t.id for t in self.tokenize(word)]).tobytes()

    def _ids(self, chunk: str) -> bytes:
        if not self.direct:
            return self._whole(chunk)
        word = chunk.rstrip(MARKS)
        if not (word.isalpha() if word.isascii() else PLAIN(word)):
            return self._whole(chunk)
        lower, marks = word.lower(), chunk[len(word):]
        ids = self._letters(lower) if not marks and lower == word else self[lower]
        return ids + self[marks] if marks else ids

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self._ids(chunk) if chunk else b""
        self._keep(chunk, ids)
        return ids

    def _keep(self, chunk: str, ids: bytes) -> None:
        if len(chunk) <= LONGEST_CACHED:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[chunk] = ids

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of different new words of lower-case letters."""
        text = " ".join(words)
        text = text if self.same and text.isascii() else text.translate(self.letters)
        ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        ends = (np.flatnonzero(self.last[ids]) + 1) * self.kind.itemsize
        if len(ends) == len(words) and ends[-1] == ids.nbytes:
            raw, at = ids.tobytes(), 0
            for word, end in zip(words, ends.tolist()):
                self._keep(word, raw[at:end])
                at = end

    def _all(self, chunks: list[str]) -> list[bytes]:
        """Ids of different chunks."""
        found = list(map(self.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        if self.direct:
            words = [chunks[i] for i in new if chunks[i] not in self.old and len(chunks[i]) <= LONGEST_CACHED and LOWER(chunks[i])]
            for some in ([w for w in words if w.isascii()], [w for w in words if not w.isascii()]):
                for at in range(0, len(some), LEARNT):
                    self._learn(some[at:at + LEARNT])
        for i in new:
            found[i] = self[chunks[i]]
        return found

    def _parted(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray, list[bytes]]:
        """Words of plain letters in lower case without the marks behind them, other chunks as they are;
        the number of the marks of each, and the ids of these marks, none first."""
        words, sizes = pc.ascii_rtrim(chunks, MARKS), pc.binary_length(chunks)
        marks = pc.subtract(sizes, pc.binary_length(words)).to_numpy()
        plain = pc.ascii_is_alpha(words).to_numpy(zero_copy_only=False)
        wide = np.flatnonzero(~pc.string_is_ascii(words).to_numpy(zero_copy_only=False))
        plain[wide] = pc.match_substring_regex(words.take(pa.array(wide)), f"^[{LETTERS}{LETTERS.upper()}]+$").to_numpy(zero_copy_only=False)
        marked = np.flatnonzero(plain & (marks > 0))
        tails = [c[-n:] for c, n in zip(chunks.take(pa.array(marked)).to_numpy(zero_copy_only=False).tolist(), marks[marked].tolist())]
        place = {tail: i for i, tail in enumerate(dict.fromkeys(tails), 1)}
        which = np.zeros(len(chunks), np.int64)
        which[marked] = list(map(place.__getitem__, tails))
        return pc.if_else(pa.array(plain), pc.utf8_lower(words), chunks), which, [b"", *map(self.__getitem__, place)]

    def encode(self, text: str) -> bytes:
        """Ids of a text and the end token, as little-endian integers of ``kind``."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end token, and their numbers.

        Arrow cuts the texts and numbers the different chunks, so each is looked up once, however often it occurs.
        """
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        named = cut.flatten().dictionary_encode()
        words, mark, marks = self._parted(named.dictionary) if self.direct else (named.dictionary, np.zeros(len(named.dictionary), np.int64), [b""])
        words = words.dictionary_encode()
        found = marks + self._all(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat, sizes = np.frombuffer(b"".join(found), self.kind), np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        both = np.stack([words.indices.to_numpy() + len(marks), mark], 1)
        flat, _ = gathered(flat, sizes, both.ravel())
        flat, ends = gathered(flat, sizes[both].sum(1), named.indices.to_numpy())
        at = np.append(0, ends)[cut.offsets.to_numpy()]
        return np.insert(flat, at[1:], END), np.diff(at) + 1


_tokens: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def forget() -> None:
    """Free this worker's memory of chunks; it has done its work once the ids are written."""
    _tokens.clear()


def term_order(idf: np.ndarray, sharpness: float = SHARPNESS) -> np.ndarray:
    """The place of every term in one random order in which telling terms tend to come first.

    The first term of a document in this order is its weighted min-hash: two documents have it in common
    with the chance that is the weighted share of their common terms. The end token comes last.
    """
    mixed = (np.arange(len(idf), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    drawn = ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) + 1
    weight = np.maximum(idf.astype(np.float64), 0) ** sharpness
    weight[END] = 0
    late = np.divide(-np.log(drawn / 2.0**53), weight, out=np.full(len(idf), np.inf), where=weight > 0)
    places = np.empty(len(idf), np.int32)
    late[END] = np.inf
    places[np.lexsort((np.arange(len(idf)) == END, late))] = np.arange(len(idf), dtype=np.int32)
    return places


def stretches(batches: Iterator[pa.RecordBatch], texts: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``STRETCH`` bytes of text or one row, and ``STRETCH_ROWS`` rows at most."""
    held, size, rows = [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(texts)).to_numpy(), dtype=np.int64)
        at, done = 0, 0
        while at < len(ends):
            end = min(int(np.searchsorted(ends, done + STRETCH - size, "right")), at + STRETCH_ROWS - rows)
            end = max(end, at if held else at + 1)
            if end > at:
                held.append(batch.slice(at, end - at))
                size, rows, at, done = size + int(ends[end - 1]) - done, rows + end - at, end, int(ends[end - 1])
            if at < len(ends):
                yield pa.concat_batches(held)
                held, size, rows = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Neighbouring values as one binary a row, without a copy."""
    offsets = (np.append(0, np.cumsum(sizes)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def tokenised(docs: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, place, ids, n_tokens, sketch`` of every row, and per task how many documents hold each id, both read from the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(path)
        width = own.kind.itemsize
        seen = np.zeros(own.size, np.int64)
        drawn = term_order(np.ones(own.size))
        back = np.argsort(drawn).astype(own.kind)
        # Pairs (document, id) as one number, the document of a stretch in the upper bits.
        low = (own.size - 1).bit_length()
        drawn, bare = drawn.astype(np.uint32 if STRETCH_ROWS << low < 1 << 32 else np.int64), (1 << low) - 1
        kind = None
        for part in stretches(batches, 2):
            kind = part.column(0).type
            ids, sizes = own.encode_all(part.column(2))
            # Every (document, id) once, in the random order.
            both = np.repeat(np.arange(len(sizes), dtype=drawn.dtype) << low, sizes)
            both += drawn[ids]
            both.sort()
            fresh = both[np.append(True, both[1:] != both[:-1])]
            seen += np.bincount(fresh & bare, minlength=own.size)
            starts = np.searchsorted(fresh, np.arange(len(sizes) + 1, dtype=drawn.dtype) << low)
            kept = np.minimum(np.diff(starts), SKETCH)
            ends = np.cumsum(kept)
            terms = back[fresh[np.arange(ends[-1]) + np.repeat(starts[:-1] - ends + kept, kept)] & bare]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), binaries(ids, sizes), pa.array(sizes, pa.int64()), binaries(terms, kept),
                 pa.nulls(len(sizes), pa.binary())], ["doc_id", "place", "ids", "n_tokens", "sketch", "seen"])
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([seen[drawn].tobytes()], pa.binary())], ["doc_id", "place", "ids", "n_tokens", "sketch", "seen"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, place bigint, ids binary, n_tokens bigint, sketch binary, seen binary"
    place = work_path(docs.sparkSession, "tokens")
    texts = small_batches(docs).select(docs["doc_id"], F.monotonically_increasing_id().alias("place"), whole_text(docs).alias("t"))
    texts.mapInArrow(run, shape).write.option("compression", "zstd").parquet(place)
    found = docs.sparkSession.read.schema(shape).parquet(place)
    return found.where("seen is null").drop("seen"), found.where("seen is not null").select("seen")


def corpus_weights(rows: DataFrame, seen: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """Inverse document frequencies of the whole corpus, and the mean length of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for one in batch.column(0):
                total += np.frombuffer(one.as_py(), np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["id", "docs"])

    counted = seen.mapInArrow(run, "id bigint, docs bigint").groupBy("id").agg(F.sum("docs").alias("docs"))
    # One row per vocabulary entry at most, whatever the corpus.
    found = counted.toPandas()
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t")).first()
    n, ids = total["n"], total["t"] or 0
    idf = np.zeros(size, np.float32)
    docs = found["docs"].to_numpy(np.float64)
    idf[found["id"].to_numpy(np.int64)] = np.log1p((n - docs + 0.5) / (docs + 0.5))
    return idf, ids / max(n, 1)


class Index:
    """BM25 postings of one shard: per term the documents and what the term adds to their score."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n = len(docs)
        long = np.array([len(ids) for ids in docs])
        # (document, id) pairs in order; the end token tells nothing.
        both = np.repeat(np.arange(self.n, dtype=np.uint64), long)
        both <<= np.uint64(32)
        both |= np.concatenate(docs)
        both.sort()
        fresh = np.append(True, both[1:] != both[:-1])
        cuts = np.flatnonzero(fresh)
        tf = np.diff(cuts, append=len(both)).astype(np.float32)
        both = both[fresh]
        del cuts, fresh
        own, term = (both >> np.uint64(32)).astype(np.int32), both.astype(np.uint32).astype(np.int32)
        del both
        norm = (K1 * (1 - B + B * long / max(mean, 1.0))).astype(np.float32)
        gain = idf[term] * tf * np.float32(K1 + 1)
        tf += norm[own]
        gain /= tf
        del tf
        gain[term == END] = 0
        # The terms that tell most about a document ask for its neighbours.
        self.bounds = np.searchsorted(own, np.arange(self.n + 1))
        self.term, self.worth = term, gain
        order = np.argsort(term.astype(np.uint16) if len(idf) <= 1 << 16 else term, kind="stable")
        self.docs, self.gain = own[order], gain[order]
        self.starts = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def query(self, doc: int) -> np.ndarray:
        at = slice(self.bounds[doc], self.bounds[doc + 1])
        worth, k = self.worth[at], min(QUERY_TERMS, self.bounds[doc + 1] - self.bounds[doc])
        return self.term[at][np.argpartition(-worth, k - 1)[:k]] if k else np.empty(0, np.int32)

    def scores(self, doc: int) -> np.ndarray:
        cuts = [slice(self.starts[t], self.starts[t + 1]) for t in self.query(doc)]
        if not cuts:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.docs[c] for c in cuts]),
                           weights=np.concatenate([self.gain[c] for c in cuts]), minlength=self.n)

    def whole_scores(self, doc: int, others: np.ndarray) -> np.ndarray:
        """Scores of ``others`` over every term of ``doc``."""
        cuts = [slice(self.bounds[o], self.bounds[o + 1]) for o in others]
        asked = np.zeros(len(self.starts), np.float32)
        asked[self.term[self.bounds[doc]:self.bounds[doc + 1]]] = 1
        gains = asked[np.concatenate([self.term[c] for c in cuts])] * np.concatenate([self.worth[c] for c in cuts])
        # Every document has its end token, so no cut is empty.
        return np.add.reduceat(gains, np.cumsum([0, *(c.stop - c.start for c in cuts[:-1])]))

    def nearest(self, doc: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a telling term with ``doc``, nearest first."""
        score = self.scores(doc)
        found = np.flatnonzero((score > 0) & unused)
        if not len(found):
            return
        if len(found) > POOL:
            parted = np.argpartition(-score[found], POOL - 1)
            found, rest = found[parted[:POOL]], found[parted[POOL:]]
        else:
            rest = found[:0]
        yield from found[np.lexsort((found, -self.whole_scores(doc, found)))].tolist()
        yield from rest[np.lexsort((rest, -score[rest]))].tolist()


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of one shard."""
    index = Index(docs, idf, mean)
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    rest = np.array([len(d) % window for d in docs])
    for doc, ids in enumerate(docs):
        for start in range(0, len(ids) - rest[doc], window):
            out.append((doc, start, window, sequence, 0))
            sequence += 1
    unused = rest > 0
    order = np.flatnonzero(unused)
    spot = 0
    current: list[tuple[int, int, int]] = []  # document, start, length
    filled = 0
    carried: tuple[int, int, int] | None = None

    def ahead(most: int) -> Iterator[int]:
        # Read only once the nearest are used up; each document has an id at least.
        left = order[spot:]
        yield from left[unused[left]][:most].tolist()

    while True:
        if carried is None:
            while spot < len(order) and not unused[order[spot]]:
                spot += 1
            if spot == len(order):
                break
            seed = int(order[spot])
            unused[seed] = False
            carried = (seed, len(docs[seed]) - int(rest[seed]), int(rest[seed]))
        seed = carried[0]
        current, filled, carried = [carried], carried[2], None
        if filled < window:
            for doc in chain(index.nearest(seed, unused), ahead(window - filled)):
                if not unused[doc]:
                    continue
                unused[doc] = False
                start, size = len(docs[doc]) - int(rest[doc]), int(rest[doc])
                taken = min(size, window - filled)
                current.append((doc, start, taken))
                filled += taken
                if taken < size:
                    carried = (doc, start + taken, size - taken)
                if filled == window:
                    break
        if filled < window:
            break
        offset = 0
        for doc, start, size in current:
            out.append((doc, start, size, sequence, offset))
            offset += size
        sequence += 1
        current, filled = [], 0
    # What is left is shorter than a window: sequences of powers of two, longest first.
    room, offset = 0, 0
    for doc, start, size in current:
        while size:
            if not room:
                room, offset = 1 << (filled.bit_length() - 1), 0
                filled -= room
            taken = min(size, room)
            out.append((doc, start, taken, sequence, offset))
            start, size, room, offset = start + taken, size - taken, room - taken, offset + taken
            if not room:
                sequence += 1
    return out


def first_places(ids: pa.Array, places: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The least place of the terms of every sketch; each holds a term at least."""
    forget()
    wide = np.int64 if pa.types.is_large_binary(ids.type) else np.int32
    starts = np.frombuffer(ids.buffers()[1], wide)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64) // kind.itemsize
    flat = np.frombuffer(ids.buffers()[2], kind, count=int(starts[-1]))[starts[0]:]
    return np.minimum.reduceat(places[flat], starts[:-1] - starts[0]) if len(ids) else np.empty(0, np.int32)


def dealt(rows: DataFrame, idf: np.ndarray, kind: np.dtype, shard_tokens: int) -> DataFrame:
    """``rows`` with ``shard``: documents of one telling term side by side, shards of nearly equal size."""
    places = rows.sparkSession.sparkContext.broadcast(term_order(idf))

    @F.arrow_udf("int")
    def term(ids: pa.Array) -> pa.Array:
        return pa.array(first_places(ids, places.value, kind), pa.int32())

    size = F.col("n_tokens") + ROW_SHARE
    # One row per vocabulary entry at most, whatever the corpus.
    found = rows.select(term("sketch").alias("term"), size.alias("size")).groupBy("term").agg(F.sum("size").alias("size")).toPandas()
    sizes = np.zeros(len(idf), np.float64)
    sizes[found["term"].to_numpy(np.int64)] = found["size"].to_numpy(np.float64)
    total = sizes.sum()
    shards = max(1, math.ceil(total / shard_tokens))
    line = rows.sparkSession.sparkContext.broadcast((np.cumsum(sizes) - sizes, sizes))

    @F.arrow_udf("bigint")
    def shard(ids: pa.Array, along: pa.Array) -> pa.Array:
        found = first_places(ids, places.value, kind)
        starts, lengths = line.value
        spot = starts[found] + lengths[found] * along.to_numpy(zero_copy_only=False)
        return pa.array(np.minimum((spot * (shards / total)).astype(np.int64), shards - 1), pa.int64())

    # Where a row lies among those of its term; equal rows are told apart by their written places.
    along = F.pmod(F.xxhash64("doc_id", "ids", "place"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return rows.withColumn("shard", shard("sketch", along))


def pack(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for every piece of every document."""
    rows, seen = tokenised(docs, path)
    idf, mean = corpus_weights(rows, seen, tokens(path).size)
    weights = docs.sparkSession.sparkContext.broadcast(idf)
    kind, width = docs.schema["doc_id"].dataType.simpleString(), tokens(path).kind

    def run(table: pa.Table) -> pa.Table:
        forget()
        shard = table.column("shard")[0].as_py()
        names, raw = table.column("doc_id"), table.column("ids").to_pylist()
        keyed = sorted(range(len(raw)), key=lambda i: (str(names[i].as_py()), raw[i]))
        ids = [np.frombuffer(raw[i], width) for i in keyed]
        pieces = pack_shard(ids, weights.value, mean, window)
        doc, start, length, sequence, offset = (list(c) for c in zip(*pieces))
        crc = [crc32(ids[d][s:s + n].astype("<u4").tobytes()) for d, s, n in zip(doc, start, length)]
        whole = [len(ids[d]) for d in doc]
        return pa.table({
            "doc_id": names.take(pa.array([keyed[d] for d in doc])), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(whole, pa.int64()),
            "sequence_id": pa.array([(shard << 32) + s for s in sequence], pa.int64()), "offset": pa.array(offset, pa.int64())})

    parts = dealt(rows, idf, width, shard_tokens).select("doc_id", "ids", "shard")
    return parts.groupBy("shard").applyInArrow(run, f"doc_id {kind}, {PIECE}")

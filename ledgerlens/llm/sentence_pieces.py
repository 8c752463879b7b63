"""SentencePiece encoding and decoding in vectorised merge rounds.

Symbols of many words lie in flat numpy arrays.  In each round every word finds the least rank
among its neighbouring pairs (a segmented minimum), merges all leftmost non-overlapping pairs of
that rank at once, and the arrays are compacted; a word without a pair is done and leaves.

Merging all pairs of a rank at once equals merging one after another unless a merge makes a new
pair, with the neighbours it then has, of the same or a lesser rank.  So in a round the merges of a
word are taken up to the first that does, and the rest waits for the next round.

A stretch of over ``LONG`` characters without a space (a script without spaces, an encoded image) is
cut, in each round, between symbols that lie side by side in no piece of the model: no merge will
ever cross there.  Its parts then go through the rounds like words of their own, so that the time
follows the length.  Where rounds hardly get on because merges wait for each other (a run of
thousands of spaces, whose pieces are all of one rank), what is left is merged from a heap.

Covers BPE models with byte fallback whose normaliser changes nothing but spaces (checked when a
model is loaded).  Defined results: a null or empty text has no ids, no ids decode to an empty
text, null ids decode to null; texts of any length are encoded whole.  Repeated rows, null ids and empty tables need no special case;
columns of the input stay, and the added column replaces one of its name.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import cache, cached_property
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import free_name, session_of
from ledgerlens.llm.segments import SegmentCache, ranges

SPACE = "▁"
NONE = np.iinfo(np.int64).max
#: Stands for a symbol that was merged into the one before; -1 is a character of no piece.
GONE = -2
#: Characters of segments that go through the rounds at once, and of a segment that is cut.
CHARS_AT_ONCE = 2_000_000
LONG = 200
#: Symbols for each merge of a round from which on the rest of a batch goes to the heap.
WAITING = 1000


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte", _each_byte)


class PairTable:
    """Hash table in two arrays from pairs of symbols to the merged piece."""

    def __init__(self, pairs: dict[tuple[int, int], int], width: int):
        self.width = np.uint64(width)
        self.bits = max(4, int(len(pairs) * 5).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size + 1, NONE, np.uint64)
        self.pieces = np.full(size + 1, -1, np.int64)
        for (left, right), piece in pairs.items():
            key = left * width + right
            at = int(self.slot(np.array([key], np.uint64))[0])
            while self.pieces[at] >= 0:
                at = (at + 1) & (size - 1)
            self.keys[at], self.pieces[at] = key, piece

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged piece of each pair, -1 where there is none."""
        keys = left.astype(np.uint64) * self.width + right.astype(np.uint64)
        at = self.slot(keys)
        out = np.where(self.keys[at] == keys, self.pieces[at], -1)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.pieces[at] >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there, keys_there = at[open_], self.keys[at[open_]]
            hit = keys_there == keys[open_]
            out[open_[hit]] = self.pieces[there[hit]]
            open_ = open_[~hit & (self.pieces[there] >= 0)]
        return out


class PieceModel:
    """Tables of a model, read once for each worker."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_file=path)
        probe = "  éﬁ　A\t "
        if lib.decode(lib.encode(probe)) != probe:
            raise ValueError("the model's normaliser changes texts")
        n = lib.vocab_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        byte_ids = [i for i in range(n) if lib.is_byte(i)]
        special = {i for i in range(n) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i)}
        normal = {p: i for i, p in enumerate(pieces) if i not in special}
        self.size = n
        self.byte_ids = np.array(byte_ids, np.int64)
        scores = np.array([lib.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)

        symbols = dict(normal)
        for p in normal:
            for c in p:
                symbols.setdefault(c, len(pieces) + len(symbols) - len(normal))
        self.char_symbol = np.full(0x110000, -1, np.int64)
        for s, i in symbols.items():
            if len(s) == 1:
                self.char_symbol[ord(s)] = i
        self.normal, self.symbols = normal, symbols
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                if p[:k] in symbols and p[k:] in symbols:
                    pairs[symbols[p[:k]], symbols[p[k:]]] = i
        self.piece_of = pairs
        self.pairs = PairTable(pairs, max(symbols.values()) + 1)
        self.one_by_one = np.zeros(n, bool)
        for (left, right), i in pairs.items():
            for part in (left, right):
                if part < n and self.rank[i] <= self.rank[part]:
                    self.one_by_one[part] = True

        inner = any(SPACE in p.lstrip(SPACE) for p in normal)
        newline = any("\n" in p for p in normal)
        if inner or newline:
            raise ValueError("a piece spans words or lines")
        self.segment = re.compile(f"{SPACE}+[^{SPACE}\\n]*|\\n|[^{SPACE}\\n]+")

        self.spaced = {i for p, i in normal.items() if p[0] == SPACE}
        self.bytes_of = [p.replace(SPACE, " ").encode() for p in pieces]
        for i in special:
            self.bytes_of[i] = b""
        for i in byte_ids:
            self.bytes_of[i] = bytes([int(pieces[i][3:5], 16)])
        self.bytes_of[lib.unk_id()] = " ⁇ ".encode()
        order = sorted(byte_ids, key=lambda i: self.bytes_of[i])
        self.byte_ids = np.array(order, np.int64)
        self.cache = SegmentCache(self.encode_segments)

    def segments(self, text: str | None) -> list[str]:
        return self.segment.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, lengths, at, chars = [], [], 0, 0
        for k, s in enumerate(segments, 1):
            chars += len(s)
            if chars >= CHARS_AT_ONCE or k == len(segments):
                ids, counts = self.merge(segments[at:k])
                flat.append(ids)
                lengths.append(counts)
                at, chars = k, 0
        return np.concatenate(flat), np.concatenate(lengths)

    @cached_property
    def side_by_side(self) -> np.ndarray:
        """Sorted keys of the pairs of symbols that lie side by side in a piece."""
        inside = {p[i:j] for p in self.normal for i in range(len(p)) for j in range(i + 2, len(p) + 1)}
        at, width = self.symbols, int(self.pairs.width)
        keys = [at[t[:k]] * width + at[t[k:]] for t in inside for k in range(1, len(t)) if t[:k] in at and t[k:] in at]
        return np.unique(np.array(keys, np.uint64))

    def meet(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether a merge may ever cross the place between two symbols."""
        known = (left >= 0) & (right >= 0)
        keys = np.where(known, left, 0).astype(np.uint64) * self.pairs.width + np.where(known, right, 0).astype(np.uint64)
        at = np.minimum(np.searchsorted(self.side_by_side, keys), len(self.side_by_side) - 1)
        return known & (self.side_by_side[at] == keys)

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The merge rounds."""
        points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.array([len(s) for s in segments], np.int64)
        word = np.repeat(np.arange(len(segments)), sizes)
        long = np.repeat(sizes > LONG, sizes)
        first = np.arange(len(points))
        symbol = self.char_symbol[points]
        joined = word[:-1] == word[1:]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbol):
            if long.any():
                look = np.flatnonzero(joined & long[:-1])
                joined[look] = self.meet(symbol[look], symbol[look + 1])
            at = np.flatnonzero(joined & (symbol[:-1] >= 0) & (symbol[1:] >= 0))
            piece = np.full(len(symbol), -1, np.int64)
            piece[at] = self.pairs.find(symbol[at], symbol[at + 1])
            rank = np.where(piece >= 0, self.rank[piece], NONE)
            begins = np.concatenate([[True], ~joined])
            starts = np.flatnonzero(begins)
            part = np.cumsum(begins) - 1
            least_here = np.minimum.reduceat(rank, starts)[part]
            rest = least_here != NONE
            done.append((word[~rest], first[~rest], symbol[~rest]))

            chosen = np.flatnonzero((rank == least_here) & rest)
            if len(chosen):
                chosen = self.in_order(chosen, symbol, piece, rank, part)
                if len(symbol) > WAITING * len(chosen):
                    kept, left = self.from_heap(symbol[rest].tolist(), part[rest].tolist())
                    done.append((word[rest][kept], first[rest][kept], left))
                    break
                symbol[chosen] = piece[chosen]
                # The place after the second symbol of a pair is now the place after the new one.
                joined[chosen] = np.append(joined, False)[chosen + 1]
                rest[chosen + 1] = False
            joined = joined[rest[:-1]] if rest[-1] else np.append(joined, False)[rest][:-1]
            word, first, symbol, long = word[rest], first[rest], symbol[rest], long[rest]
        word, first, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(first, kind="stable")
        return self.to_ids(word[order], points[first[order]], symbol[order], len(segments))

    def from_heap(self, symbol: list[int], part: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Places and symbols that are left when pairs are merged one after another."""
        n, rank, piece_of = len(symbol), self.rank.tolist(), self.piece_of
        after = [i + 1 if i + 1 < n and part[i + 1] == part[i] else -1 for i in range(n)]
        before = [i - 1 if i and part[i - 1] == part[i] else -1 for i in range(n)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            pair = symbol[i], symbol[after[i]]
            if pair in piece_of:
                heappush(heap, (rank[piece_of[pair]], i, *pair))

        for i in range(n):
            if after[i] >= 0:
                offer(i)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue  # a merge took one of the two
            symbol[i], symbol[j] = piece_of[left, right], GONE
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        left = np.array(symbol, np.int64)
        kept = np.flatnonzero(left != GONE)
        return kept, left[kept]

    def in_order(self, chosen: np.ndarray, symbol: np.ndarray, piece: np.ndarray, rank: np.ndarray, part: np.ndarray) -> np.ndarray:
        """The merges of a round, out of all pairs of the least rank: leftmost ones that do not
        overlap, in each part up to the first that makes a pair of the same or a lesser rank."""
        fresh = np.concatenate([[True], np.diff(chosen) != 1])
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(chosen)), 0))
        chosen = chosen[(np.arange(len(chosen)) - run) % 2 == 0]
        wary = np.flatnonzero(self.one_by_one[piece[chosen]])
        if not len(wary):
            return chosen
        at, new, bound = chosen[wary], piece[chosen[wary]], rank[chosen[wary]]
        after = np.zeros(len(symbol) + 3, np.int64)
        after[:-3] = symbol
        parts = np.concatenate([part, np.full(3, -1)])
        makes = np.zeros(len(at), bool)
        # What stands before is the piece of the merge before, where that is next to this one.
        previous = np.where(wary > 0, chosen[wary - 1], -9) == at - 2
        left = np.where(previous, piece[at - 2], after[at - 1])
        for there, pair in (
            ((at > 0) & (parts[at - 1] == parts[at]) & (left >= 0), (left, new)),
            ((parts[at + 2] == parts[at]) & (after[at + 2] >= 0), (new, after[at + 2])),
        ):
            k = np.flatnonzero(there)
            made = self.pairs.find(pair[0][k], pair[1][k])
            makes[k] |= (made >= 0) & (self.rank[made] <= bound[k])
        stops = np.zeros(len(chosen), np.int64)
        stops[wary] = makes
        before = np.cumsum(stops) - stops
        begins = np.concatenate([[True], np.diff(part[chosen]) != 0])
        start = np.maximum.accumulate(np.where(begins, np.arange(len(chosen)), 0))
        return chosen[before == before[start]]

    def to_ids(self, word, point, symbol, n_words) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary are single characters and become their bytes."""
        odd = (symbol < 0) | (symbol >= self.size)
        if not odd.any():
            return symbol, np.bincount(word, minlength=n_words)
        width = np.ones(len(symbol), np.int64)
        p = point[odd]
        width[odd] = 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)
        out = np.repeat(symbol, width)
        encoded = "".join(map(chr, p.tolist())).encode("utf-8", "surrogatepass")
        starts = np.cumsum(width) - width
        out[ranges(starts[odd], width[odd])] = self.byte_ids[np.frombuffer(encoded, np.uint8)]
        return out, np.bincount(np.repeat(word, width), minlength=n_words)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of ids of each."""
        return self.cache.encode([self.segments(t) for t in texts])

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, ids))
        if ids and ids[0] in self.spaced:
            raw = raw[1:]
        return raw.decode("utf-8", "each_byte")


@cache
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as an array."""
    session_of(docs)

    @F.arrow_udf("array<int>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            flat, counts = model(path).encode(texts.to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))

    return docs.withColumn(ids, pieces(F.col(text)))


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text that the ids of each spell."""
    session_of(rows)

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            own = model(path)
            yield pa.array([None if x is None else own.decode(x) for x in lists.to_pylist()], pa.string())

    return rows.withColumn(text, texts(F.col(ids)))


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and the ``decoded`` text that these ids spell; one worker does both."""
    session_of(docs)

    @F.arrow_udf("ids array<int>, decoded string")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            own = model(path)
            flat, counts = own.encode(texts.to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            spelt = [own.decode(flat[a:z].tolist()) for a, z in zip(offsets, offsets[1:], strict=False)]
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            yield pa.StructArray.from_arrays([ids, pa.array(spelt, pa.string())], ["ids", "decoded"])

    at = free_name(docs, "coded")
    out = docs.withColumn(at, both(F.col(text)))
    return out.withColumns({"ids": F.col(at)["ids"], "decoded": F.col(at)["decoded"]}).drop(at)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document: the number of ids, and hashes of the ids and of the decoded text."""
    coded = round_trip(docs.select("doc_id", "text"), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )

"""Byte-level BPE encoding and decoding on padded numpy matrices."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphlake.llm.common import pieces, sha256_hex

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Upper widths of the length buckets; rows of longer pieces lie end to end instead of padded.
WIDTHS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128)
#: Bytes of long pieces that are merged side by side.
ROW_BYTES = 1 << 18
#: Rows of one matrix.
MATRIX_ROWS = 1 << 14
#: Bytes of pieces and ids, about, that a worker remembers before it starts anew, and those of the longest piece remembered.
REMEMBERED, LONGEST = 32 << 20, 64
_NONE = np.int32(2**31 - 1)


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of their merge.

    As the ranks are the ids, the smallest merged id is the smallest rank.
    """

    def __init__(self, vocabulary: dict[bytes, int]):
        pairs = {}
        for token, rank in vocabulary.items():
            for i in range(1, len(token)):
                a, b = vocabulary.get(token[:i]), vocabulary.get(token[i:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        key = np.fromiter(pairs, np.int64, len(pairs))
        value = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot, self.probes = self._slot(key), 0
        left = np.arange(len(key))
        while len(left):
            self.probes += 1
            at = slot[left]
            free = self.keys[at] == -1
            self.keys[at[free]] = key[left[free]]  # of those on one slot the last stays
            self.values[at[free]] = value[left[free]]
            left = left[self.keys[at] != key[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The table as a dict, for one pair at a time; workers do not need it."""
        used = self.keys >= 0
        return dict(zip(self.keys[used].tolist(), self.values[used].tolist(), strict=True))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged id of each pair, a large number where there is none (also for padding, -1)."""
        key = ((a.astype(np.int64) << 32) | b.astype(np.int64)).ravel()
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.values[slot], _NONE)
        left = np.flatnonzero((found != key) & (found != -1))
        for _ in range(self.probes):
            if not len(left):
                break
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[left]]
            hit = found == key[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found != -1)]
        out[(a.ravel() < 0) | (b.ravel() < 0)] = _NONE
        return out.reshape(a.shape)


class Codec:
    """Encodes pieces and decodes ids for one file of ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.vocabulary = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = [b""] * (max(self.vocabulary.values()) + 1)
        for token, rank in self.vocabulary.items():
            self.tokens[rank] = token
        self.numerals = [str(i) for i in range(len(self.tokens))]
        self.ints = list(range(len(self.tokens)))  # one object an id, shared by all remembered pieces
        self.table = PairTable(self.vocabulary)
        self.bytes = np.array([self.vocabulary[bytes([i])] for i in range(256)], np.int32)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def _matrix(self, rows: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Every row merges its leftmost pair of minimum rank each round; finished rows leave the matrix."""
        n = len(rows)
        ids = np.full((n, width), -1, np.int32)
        flat = self.bytes[np.frombuffer(b"".join(rows), np.uint8)]
        lengths = np.fromiter(map(len, rows), np.int64, n)
        ids[np.arange(width) < lengths[:, None]] = flat
        ranks = np.full((n, width), _NONE, np.int32)
        ranks[:, :-1] = self.table.ranks(ids[:, :-1], ids[:, 1:])
        out: list = [None] * n
        owner, columns = np.arange(n), np.arange(width)
        while len(owner):
            at = ranks.argmin(axis=1)
            row = np.arange(len(owner))
            best = ranks[row, at]
            done = best == _NONE
            if done.any():
                ended, ends = ids[done], (ids[done] >= 0).sum(axis=1)
                for o, line, end in zip(owner[done].tolist(), ended.tolist(), ends.tolist(), strict=True):
                    out[o] = tuple(map(self.ints.__getitem__, line[:end]))
                keep = ~done
                ids, ranks, owner, at, best = ids[keep], ranks[keep], owner[keep], at[keep], best[keep]
                row = np.arange(len(owner))
                if not len(owner):
                    break
            # the pair becomes one id, everything behind it moves up
            ids[row, at] = best
            move = columns + (columns > at[:, None])
            last = move[:, -1] == width
            move[:, -1] = width - 1
            ids = np.take_along_axis(ids, move, 1)
            ranks = np.take_along_axis(ranks, move, 1)
            ids[last, -1] = -1
            ranks[last, -1] = _NONE
            after = np.where(at + 1 < width, ids[row, np.minimum(at + 1, width - 1)], -1)
            ranks[row, at] = self.table.ranks(best, after)
            before = at > 0
            ranks[row[before], at[before] - 1] = self.table.ranks(ids[row[before], at[before] - 1], best[before])
        return out

    def _rows(self, rows: list[bytes]) -> list[tuple[int, ...]]:
        """The same rounds for long pieces: rows of one flat array, compacted where pairs merged.

        Each round every row merges all places of its minimum-rank pair, from
        the left, which is what merging its leftmost one again and again
        gives, as long as no merge makes a pair of smaller rank; a row stops
        its round behind the first merge that does. So a row takes about as
        many rounds as it has distinct merges, however long it is.
        """
        ids = self.bytes[np.frombuffer(b"".join(rows), np.uint8)]
        lengths, owner = np.fromiter(map(len, rows), np.int64, len(rows)), np.arange(len(rows))
        out: list = [None] * len(rows)

        def pair_ranks(at: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at places; none across the end of a row."""
            right = np.minimum(at + 1, len(ids) - 1)
            return np.where(row[at] == row[right], self.table.ranks(ids[at], np.where(at + 1 < len(ids), ids[right], -1)), _NONE)

        row = np.repeat(np.arange(len(rows)), lengths)
        ranks = pair_ranks(np.arange(len(ids)))
        while len(owner):
            starts = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(ranks, starts)
            done = best == _NONE
            if done.any():
                for i in np.flatnonzero(done).tolist():
                    out[owner[i]] = tuple(map(self.ints.__getitem__, ids[starts[i] : starts[i] + lengths[i]].tolist()))
                keep = np.repeat(~done, lengths)
                ids, ranks = ids[keep], ranks[keep]
                owner, lengths, best = owner[~done], lengths[~done], best[~done]
                row = np.repeat(np.arange(len(owner)), lengths)
                continue
            at = np.flatnonzero(ranks == best[row])
            # of pairs that overlap, every other one from the left
            run = np.concatenate([[True], np.diff(at) > 1])
            at = at[(at - np.maximum.accumulate(np.where(run, at, 0))) % 2 == 0]
            mine, merged = row[at], best[row[at]]
            left = np.where((at > 0) & (row[np.maximum(at - 1, 0)] == mine), ids[np.maximum(at - 1, 0)], -1)
            touching = np.concatenate([[False], (np.diff(at) == 2) & (mine[1:] == mine[:-1])])
            left[touching] = merged[touching]
            behind = np.minimum(at + 2, len(ids) - 1)
            right = np.where((at + 2 < len(ids)) & (row[behind] == mine), ids[behind], -1)
            early = (self.table.ranks(left, merged) < merged) | (self.table.ranks(merged, right) < merged)
            if early.any():
                before = np.cumsum(early) - early
                first = np.searchsorted(mine, mine)
                at = at[before == before[first]]
                mine = row[at]
            ids[at] = best[mine]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            ids, row, ranks = ids[keep], row[keep], ranks[keep]
            lengths = np.bincount(row, minlength=len(owner))
            fresh = np.unique(np.concatenate([place, place[place > 0] - 1]))
            ranks[fresh] = pair_ranks(fresh)
        return out

    def _heap(self, piece: bytes) -> tuple[int, ...]:
        """The same merges for one piece through a heap of (rank, position): what the tests hold the matrices against."""
        ids, n = self.bytes[np.frombuffer(piece, np.uint8)].tolist(), len(piece)
        after, before, pair = [*range(1, n), -1], list(range(-1, n - 1)), self.table.pairs.get
        heap = [(r, i) for i in range(n - 1) if (r := pair((ids[i] << 32) | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or pair((ids[i] << 32) | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                if (r := pair((rank << 32) | ids[after[i]])) is not None:
                    heappush(heap, (r, i))
            if before[i] >= 0 and (r := pair((ids[before[i]] << 32) | rank)) is not None:
                heappush(heap, (r, before[i]))
        return tuple(i for i in ids if i >= 0)

    def learn(self, texts: set[str]) -> dict[str, tuple[int, ...]]:
        """Encode pieces not met before, in length buckets, and remember the short ones."""
        new = [(t, t.encode("utf-8", "surrogatepass")) for t in texts if t not in self.known]
        new.sort(key=lambda x: len(x[1]))
        fresh: dict[str, tuple[int, ...]] = {}
        start = 0
        for width in WIDTHS:
            while start < len(new) and len(new[start][1]) <= width:
                stop = start
                while stop < len(new) and len(new[stop][1]) <= width and stop - start < MATRIX_ROWS:
                    stop += 1
                fresh.update(zip((t for t, _ in new[start:stop]), self._matrix([b for _, b in new[start:stop]], width), strict=True))
                start = stop
        while start < len(new):
            stop, size = start, 0
            while stop < len(new) and (stop == start or size + len(new[stop][1]) <= ROW_BYTES):
                size += len(new[stop][1])
                stop += 1
            fresh.update(zip((t for t, _ in new[start:stop]), self._rows([b for _, b in new[start:stop]]), strict=True))
            start = stop
        for text, data in new:
            if len(data) > LONGEST:
                break
            self.known[text] = fresh[text]
            self.held += 200 + 4 * len(data) + 8 * len(fresh[text])  # the objects and their place in the dict
        return fresh

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; each match of the pattern is encoded by itself."""
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        cut = [self.split(t) for t in texts]
        unseen: set[str] = set()
        for c in cut:
            unseen.update(c)
        fresh = self.learn(unseen)
        known = self.known
        for c in cut:
            ids: list[int] = []
            for piece in c:
                ids += known[piece] if piece in known else fresh[piece]
            yield ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decimal(self, ids: list[int]) -> str:
        return " ".join(map(self.numerals.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec a worker process and vocabulary."""
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, columns: list[str] | None = None, decoded: bool = True) -> DataFrame:
    """``docs`` with ``ids array<int>`` and ``decoded binary``, the round trip of the whole text.

    ``path`` must be readable by every worker (vocabularies are installed
    files, never copied). ``columns`` names the input columns that stay (all).
    Without ``decoded`` the bytes do not leave the worker: it decodes the ids
    and fails if they do not give the text back. Null text counts as empty: no
    ids, no bytes. Input columns named ``ids`` or ``decoded`` are replaced.
    Special tokens do not exist: their strings are ordinary text. Memory per
    worker is bounded by pieces of batches and the bytes of remembered short pieces.
    """
    added = ["ids", "decoded"] if decoded else ["ids"]
    kept = [c for c in (docs.columns if columns is None else columns) if c not in added]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], *([] if "text" in kept else ["text"]))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).selectExpr("*", "cast(null as array<int>) ids", *(["cast(null as binary) decoded"] if decoded else [])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in pieces(batches, "text", 2 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = list(own.encode(texts))
            more = [pa.array(ids, pa.list_(pa.int32()))]
            if decoded:
                more.append(pa.array(map(own.decode, ids), pa.binary(), size=len(ids)))
            elif any(own.decode(i) != t.encode("utf-8", "surrogatepass") for i, t in zip(ids, texts, strict=True)):
                raise ValueError("decoded ids differ from the text")
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *more], names=[*kept, *added])

    return source.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of the decoded bytes; see :func:`encode`.

    The digests are taken where the ids are made, so that ids never leave the worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in pieces(batches, "text", 2 << 20):
            counts, ids_hex, decoded_hex = [], [], []
            for ids in own.encode([t or "" for t in batch.column("text").to_pylist()]):
                counts.append(len(ids))
                ids_hex.append(sha256_hex(own.decimal(ids).encode()))
                decoded_hex.append(sha256_hex(own.decode(ids)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex), pa.array(decoded_hex)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)

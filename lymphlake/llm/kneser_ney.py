"""Language-model scores: an interpolated modified Kneser-Ney bigram model, counted in Spark."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphlake.llm.common import id_crc32, pieces
from lymphlake.plans.tables import scratch

SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
#: Training text per shard of the sorted arrays; a task holds one shard at a time.
SHARD_BYTES = 24 << 20
#: A counting task hands on its sums when it holds so many keys; a worker forgets words beyond so many.
HELD_KEYS, REMEMBERED = 4_000_000, 300_000
#: Arrays that a worker keeps open: mapped files, or whole copies where the shared folder is not mounted.
MAPPED, COPIED = 4096, 64
#: Hash of the end token; no word hashes to it but by the chance of a 64-bit collision.
END = xxhash.xxh3_64_intdigest(b"\0end of text\0")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased words; bytes.split cuts at exactly the six code points."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class _WordHashes(dict):
    """Hashes of words; only short words are remembered, so that so many of them are bounded in bytes."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_hashes = _WordHashes()


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts with an end after each, and the number of tokens of each text."""
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    out, sizes = [], []
    for text in texts:
        words = words_of(text)
        out += map(_hashes.__getitem__, words)
        out.append(END)
        sizes.append(len(words) + 1)
    return np.array(out, np.uint64), np.array(sizes, np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each key, by its mixed high bits."""
    return ((((keys * _MIX) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _packed(keys: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """One row a shard that occurs: sorted keys and counts as bytes, so that Spark moves few, dense rows, and never more rows than keys."""
    order, parts = _by_shard(shard_of(keys, shards))
    keys, counts = keys[order], counts[order]
    small = counts.max(initial=0) < 1 << 32
    for shard, a, b in parts:
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([keys[a:b].tobytes()], pa.binary()), pa.array([counts[a:b].astype(np.uint32 if small else np.uint64).tobytes()], pa.binary()), pa.array([small])], names=["shard", "keys", "counts", "small"])


def _by_shard(where: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that puts shards together and keeps the rest, and each shard that occurs with its range in that order."""
    order = np.argsort(where, kind="stable")
    found, first = np.unique(where[order], return_index=True)
    return order, list(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(where)], strict=True))


PACKED = "shard int, keys binary, counts binary, small boolean"


def _counted(docs: DataFrame, keys_of, shards: int) -> DataFrame:
    """Packed sums of ``keys_of(texts)`` over a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in pieces(batches, "text", 4 << 20):
            found = keys_of(batch.column("text").to_pylist())
            k, c = _summed(found, np.ones(len(found), np.int64))
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > HELD_KEYS:
                k, c = _summed(np.concatenate(keys), np.concatenate(counts))
                if len(k) > HELD_KEYS // 2:
                    yield from _packed(k, c, shards)
                    keys, counts, held = [], [], 0
                else:
                    keys, counts, held = [k], [c], len(k)
        if keys:
            yield from _packed(*_summed(np.concatenate(keys), np.concatenate(counts)), shards)

    return docs.select("text").mapInArrow(run, PACKED)


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sums of one shard's packed rows.

    Sums of like size are added first, so a key is sorted about log2(rows)
    times, and what is held stays near twice the shard's size.
    """
    runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add() -> None:
        (k2, c2), (k1, c1) = runs.pop(), runs.pop()
        runs.append(_summed(np.concatenate([k1, k2]), np.concatenate([c1, c2])))

    for k, c, small in zip(table.column("keys"), table.column("counts"), table.column("small").to_pylist(), strict=True):
        runs.append((np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(c.as_buffer(), np.uint32 if small else np.uint64).astype(np.int64)))
        while len(runs) > 1 and len(runs[-2][0]) <= 2 * len(runs[-1][0]):
            add()
    while len(runs) > 1:
        add()
    return runs[0] if runs else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _save(folder: str, **arrays: np.ndarray) -> None:
    """Write arrays to the shared folder, each under its final name in one step; a retried task writes the same bytes."""
    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    for name, values in arrays.items():
        part, head = f"{root}/.{name}-{uuid.uuid4().hex}", io.BytesIO()
        np.lib.format.write_array_header_1_0(head, np.lib.format.header_data_from_array_1_0(values))
        with system.open_output_stream(part) as out:
            out.write(head.getvalue())
            if values.size:
                out.write(pa.py_buffer(np.ascontiguousarray(values)))
        system.move(part, f"{root}/{name}.npy")


def _load(folder: str, name: str) -> tuple[np.ndarray | None, bool]:
    """An array of the shared folder, memory-mapped where the folder is mounted, and whether it is; None if it was not written."""
    system, root = _open(folder)
    path, mounted = f"{root}/{name}.npy", isinstance(system, fs.LocalFileSystem)
    if system.get_file_info(path).type != fs.FileType.File:
        return None, mounted
    if mounted:
        return np.load(path, mmap_mode="r"), True
    with system.open_input_file(path) as f:
        return np.load(io.BytesIO(f.read())), False


@dataclass(frozen=True)
class Model:
    """Where the arrays lie, and the few numbers that are not arrays.

    A word's id is its place in its shard's sorted array times the number of
    shards, plus the shard; so ids need no table of offsets, and a context's
    numbers lie at the word's own place.
    """

    folder: str
    shards: int
    height: int  # words of the fullest shard
    types: int  # V: distinct training tokens
    tokens: int  # N
    bigram_types: int = 0
    discounts: tuple[float, float, float] = (0, 0, 0)
    word_discounts: tuple[float, float, float] = (0, 0, 0)
    word_left: float = 1.0  # mass that the words' discounts leave to the uniform distribution

    @property
    def begin(self) -> int:
        """The id of a text's begin, behind those of all words."""
        return self.height * self.shards


class Arrays:
    """Sorted arrays of a model, opened as they are needed: lookups of words, bigrams, contexts."""

    def __init__(self, model: Model):
        self.model = model
        self.held: dict[tuple[int, str], np.ndarray] = {}
        self.most = MAPPED

    def array(self, shard: int, name: str) -> np.ndarray:
        found = self.held.get((shard, name))
        if found is None:
            if len(self.held) >= self.most:
                self.held.clear()
            found, mounted = _load(f"{self.model.folder}/{shard}", name)
            self.most = MAPPED if mounted else COPIED
            found = self.held[shard, name] = np.empty(0, np.uint64) if found is None else found
        return found

    def _found(self, names: tuple[str, str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shard, position (-1 if absent) and count of each of the sorted keys."""
        shard = shard_of(keys, self.model.shards)
        position, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        order, parts = _by_shard(shard)
        for i, a, b in parts:
            sorted_keys = self.array(i, names[0])
            if len(sorted_keys):
                mine = order[a:b]
                at = np.minimum(np.searchsorted(sorted_keys, keys[mine]), len(sorted_keys) - 1)
                hit = sorted_keys[at] == keys[mine]
                position[mine[hit]] = at[hit]
                count[mine[hit]] = self.array(i, names[1])[at[hit]]
        return shard, position, count

    def word_ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1 if unknown) and training counts of word hashes."""
        distinct, inverse = np.unique(hashes, return_inverse=True)
        shard, position, count = self._found(("words", "word_counts"), distinct)
        ids = np.where(position >= 0, position * self.model.shards + shard, -1)
        return ids[inverse], count[inverse]

    def bigram_counts(self, keys: np.ndarray) -> np.ndarray:
        distinct, inverse = np.unique(keys, return_inverse=True)
        return self._found(("bigrams", "bigram_counts"), distinct)[2][inverse]

    def context(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Total, back-off mass and continuation count of ids."""
        distinct, inverse = np.unique(ids, return_inverse=True)
        total, left, follows = np.zeros(len(distinct)), np.ones(len(distinct)), np.zeros(len(distinct))
        order, parts = _by_shard(np.where(distinct >= 0, distinct % self.model.shards, -1))
        for i, a, b in parts:
            if i >= 0:
                mine = order[a:b]
                row = distinct[mine] // self.model.shards
                total[mine], left[mine], follows[mine] = (self.array(i, name)[row] for name in ("totals", "backoffs", "continuations"))
        return total[inverse], left[inverse], follows[inverse]


@lru_cache(maxsize=2)
def arrays(model: Model) -> Arrays:
    return Arrays(model)


def _discounts(ones: list[int]) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of keys counted 1, 2, 3, 4 times, with usual values where those give none."""
    n1, n2, n3, n4 = ones
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, (3 - 4 * y * n4 / n3) if n3 else 2.0
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))


def _taken(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    """The discount of each count; nothing from 0."""
    return np.array([0.0, *discounts])[np.minimum(counts, 3).astype(np.int64)]


def train(docs: DataFrame) -> Model:
    """Count the texts of ``docs`` and write the model's arrays to the shared folder.

    Three Spark jobs: distinct tokens, distinct bigrams of token ids (tasks
    hand on packed sums per shard; the ids of a bigram make one 64-bit key),
    and the sums by context and by word over bigram types. Keys are dealt by
    a hash of the whole bigram, so a frequent word fills no shard. What is
    counted grows with the input; Spark adds up what shards report, and the
    driver gets one row of numbers a job. More ids than 32 bits hold raise an
    error. Null texts count as empty and give one end token.
    """
    root = scratch(docs.sparkSession, "bigrams")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(12, -(-size // SHARD_BYTES))

    def keep_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words, counts = _merged(table)
        _save(f"{root}/{key[0].as_py()}", words=words, word_counts=counts)
        return pa.table({"types": [len(words)], "tokens": [int(counts.sum())]})

    counted = _counted(docs, lambda texts: token_hashes(texts)[0], shards)
    height, types, tokens = counted.groupBy("shard").applyInArrow(keep_words, "types long, tokens long").agg(F.max("types"), F.sum("types"), F.sum("tokens")).first()
    words = Model(root, shards, height or 0, types or 0, tokens or 0)
    if not tokens:
        return words
    if words.begin > int(_LOW):
        raise OverflowError(f"{types} distinct tokens: ids of bigrams hold 32 bits each")

    def bigram_keys(texts: list[str | None]) -> np.ndarray:
        hashes, sizes = token_hashes(texts)
        return bigrams(arrays(words).word_ids(hashes)[0], sizes, words.begin)

    def keep_bigrams(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        found, counts = _merged(table)
        _save(f"{root}/{key[0].as_py()}", bigrams=found, bigram_counts=counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64))
        return pa.table({"types": [len(found)], **_counts_of_counts(counts)})

    found = _counted(docs, bigram_keys, shards).groupBy("shard").applyInArrow(keep_bigrams, f"types long, {_COUNTS_OF_COUNTS}")
    bigram_types, *ones, _ = found.agg(F.sum("types"), *map(F.sum, _NAMES)).first()
    discounts = _discounts(ones)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per target shard of ids: partial sums over the bigrams of one shard; no more rows than sums."""
        for batch in batches:
            for i in batch.column("id").to_pylist():
                (keys, _), (counts, _) = (_load(f"{root}/{i}", n) for n in ("bigrams", "bigram_counts"))
                if keys is None or not len(keys):
                    continue
                first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & _LOW).astype(np.int64)
                context, where = np.unique(first, return_inverse=True)
                sums = np.stack([np.bincount(where, x, len(context)) for x in (counts, counts == 1, counts == 2, counts >= 3)])
                word, follows = np.unique(second, return_counts=True)
                order, parts = _by_shard(context % shards)
                for shard, a, b in parts:
                    mine = order[a:b]
                    yield _partial(shard, context[mine], sums[:, mine], word[:0], follows[:0])
                order, parts = _by_shard(word % shards)
                for shard, a, b in parts:
                    mine = order[a:b]
                    yield _partial(shard, context[:0], sums[:, :0], word[mine], follows[mine])

    def keep_contexts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        columns = [table.column(c) for c in ("context", "sums", "word", "follows")]
        parts = [[np.frombuffer(x.as_buffer(), t) for x, t in zip(r, (np.int64, np.float64, np.int64, np.int64), strict=True)] for r in zip(*columns, strict=True)]
        n = max(int(ids.max(initial=-1)) for p in parts for ids in (p[0], p[2])) // shards + 1
        sums, follows = np.zeros((4, n)), np.zeros(n, np.int64)
        for context, part, word, times in parts:
            sums[:, context // shards] += part.reshape(4, -1)
            follows[word // shards] += times
        total = sums[0]
        left = np.where(total > 0, (np.array(discounts) @ sums[1:]) / np.maximum(total, 1), 1.0)
        _save(f"{root}/{key[0].as_py()}", totals=total, backoffs=left, continuations=follows)
        return pa.table(_counts_of_counts(follows))

    each = docs.sparkSession.range(0, shards, 1, shards).mapInArrow(split, "shard int, context binary, sums binary, word binary, follows binary")
    *ones, more = each.groupBy("shard").applyInArrow(keep_contexts, _COUNTS_OF_COUNTS).agg(*map(F.sum, _NAMES)).first()
    word_discounts = _discounts(ones)
    left = (word_discounts[0] * ones[0] + word_discounts[1] * ones[1] + word_discounts[2] * more) / bigram_types
    return Model(root, shards, height, types, tokens, bigram_types, discounts, word_discounts, left)


_NAMES = ("n1", "n2", "n3", "n4", "more")
_COUNTS_OF_COUNTS = ", ".join(f"{n} long" for n in _NAMES)


def _counts_of_counts(counts: np.ndarray) -> dict[str, list[int]]:
    """How many keys were counted 1, 2, 3, 4 times, and 3 times or more."""
    return {**{f"n{k}": [int((counts == k).sum())] for k in range(1, 5)}, "more": [int((counts >= 3).sum())]}


def _partial(shard: int, context: np.ndarray, sums: np.ndarray, word: np.ndarray, follows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (context, sums, word, follows)]], names=["shard", "context", "sums", "word", "follows"])


def bigrams(ids: np.ndarray, sizes: np.ndarray, begin: int) -> np.ndarray:
    """Key of each token: the id before it (``begin`` at a text's start) in the high half, its own in the low."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(sizes) - sizes] = begin
    return (before.astype(np.uint64) << np.uint64(32)) | (ids.astype(np.uint64) & _LOW)


def log10_probabilities(model: Model, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 p(token | token before), interpolated down to the uniform distribution over V + 1 tokens."""
    own = arrays(model)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(sizes) - sizes] = model.begin
    follows = own.context(ids)[2]
    word = (follows - _taken(follows, model.word_discounts)) / model.bigram_types + model.word_left / (model.types + 1)
    total, left, _ = own.context(before)
    both = (ids >= 0) & (before >= 0)
    count = np.zeros(len(ids), np.int64)
    if both.any():
        count[both] = own.bigram_counts((before[both].astype(np.uint64) << np.uint64(32)) | ids[both].astype(np.uint64))
    seen = np.where(total > 0, (count - _taken(count, model.discounts)) / np.maximum(total, 1), 0.0)
    return np.log10(seen + np.where(total > 0, left, 1.0) * word)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of every whole text, see ``SCHEMA``; needs ``doc_id, held_out, text``.

    ``base_score`` is the add-one unigram score, ``score`` the model's log10
    probability of the text with its end; perplexity is 10^(-score / n_tokens).
    Null and empty texts hold the end token only. An empty model (no training
    text) gives every token the probability 1 / (V + 1) = 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = arrays(model)
        for batch in pieces(batches, "text", 4 << 20):
            hashes, sizes = token_hashes(batch.column("text").to_pylist())
            ids, counts = own.word_ids(hashes)
            base = np.log10((counts + 1) / (model.tokens + model.types + 1))
            logs = log10_probabilities(model, ids, sizes) if model.bigram_types else np.zeros(len(ids))
            starts = np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(sizes), pa.array(np.add.reduceat((counts > 0).astype(np.int64), starts)), pa.array(np.full(len(sizes), model.tokens)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(logs, starts))],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SCHEMA)


def score_held_out(docs: DataFrame, folds: int = 7, out: int = 2) -> DataFrame:
    """Train on documents whose crc32(doc_id) mod ``folds`` is not ``out`` and score all; a null id counts as the empty text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_crc32(F.col("doc_id")) % folds == out).alias("held_out"), F.col("text").cast("string").alias("text"))
    return score(rows, train(rows.where(~F.col("held_out"))))

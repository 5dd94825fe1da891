"""Near-duplicates: MinHash bands propose, Bayesian bounds prune, full sets confirm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lymphlake.llm.common import pieces
from lymphlake.operators.graph import components
from lymphlake.plans.tables import written

#: Five words a shingle; documents link at 100 * intersection >= 75 * union.
WORDS, PERCENT = 5, 75
#: Signature of BANDS * ROWS values. A pair at the threshold shares no band with probability (1 - .75^3)^32 = 2e-8.
BANDS, ROWS = 32, 3
HASHES = BANDS * ROWS
#: Signature values per comparison step, and the chance to drop a pair that does reach the threshold.
STEP, MISS = 16, 1e-6
#: Members of a bucket that one task compares with so many others at a time.
CHUNK = 512
#: Pairs that are compared at a time.
TOGETHER = 1 << 15
_SEED = np.random.default_rng(20240607)
_A = (_SEED.integers(1, 2**31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_B = _SEED.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
_P = _SEED.integers(1, 2**62, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    """Hashes of words; only short words are remembered, so that so many of them are bounded in bytes."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_words = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles; fewer than five words form one, none the empty set."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > 150_000:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = len(h)
    if n < WORDS:
        return _mixed(np.array([(h * _P[:n]).sum() + np.uint64(n)], np.uint64))
    total = np.full(n - WORDS + 1, WORDS, np.uint64)
    for i in range(WORDS):
        total += h[i : n - WORDS + 1 + i] * _P[i]
    return np.unique(_mixed(total))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum of each hash function over each non-empty set, sets x HASHES."""
    out = np.empty((len(sets), HASHES), np.uint32)
    start = 0
    while start < len(sets):
        stop, n = start + 1, len(sets[start])
        while stop < len(sets) and n + len(sets[stop]) <= 1 << 15:
            n += len(sets[stop])
            stop += 1
        low = (np.concatenate(sets[start:stop]) >> np.uint64(32)).astype(np.uint32)
        at = np.cumsum([0, *map(len, sets[start : stop - 1])])
        v, w = np.empty_like(low), np.empty_like(low)
        for k in range(HASHES):
            np.multiply(low, _A[k], out=v)
            v += _B[k]
            np.right_shift(v, 15, out=w)
            v ^= w
            v *= _A[HASHES - 1 - k]
            out[start:stop, k] = np.minimum.reduceat(v, at)
        start = stop
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s)]
        sketch: list = [None] * len(sets)
        for i, row in zip(full, signatures([sets[i] for i in full]) if full else (), strict=True):
            sketch[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) for s in sets], pa.binary()),
                pa.array(sketch, pa.binary()),
            ],
            names=["doc_id", "key", "n_shingles", "class", "sketch"],
        )


@lru_cache(maxsize=8)
def fewest_matches(threshold: float = PERCENT / 100, miss: float = MISS) -> tuple[int, ...]:
    """For 16, 32, ... compared values, the fewest matches with which a pair stays.

    With a uniform prior the similarity after m of n matches is
    Beta(m + 1, n - m + 1); a pair goes when its chance to reach the threshold
    is below ``miss``. The tail is summed on a fine grid.
    """
    x = np.linspace(0, 1, 20_001)[1:-1]
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(x) + (n - m) * np.log1p(-x) + lgamma(n + 2) - lgamma(m + 1) - lgamma(n - m + 1)
            if np.exp(log)[x >= threshold].sum() / len(x) >= miss:
                out.append(m)
                break
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of the pairs of signature rows that no step prunes."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, least in enumerate(fewest_matches()):
        part = slice(i * STEP, (i + 1) * STEP)
        matches = matches + (a[left, part] == b[left, part]).sum(axis=1)
        keep = matches >= least
        left, matches = left[keep], matches[keep]
    return left


def _rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sketch = _rows(batch.column("sketch")).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        key = np.broadcast_to(key, sketch.shape[:2])
        for i in range(ROWS):
            key = _mixed(key + sketch[:, :, i])
        node = pa.array(batch.column("class")).take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
        band = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(band), node], names=["bucket", "band", "node"])


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keep = survivors(_rows(batch.column("sa")), _rows(batch.column("sb")))
            yield batch.select(["a", "b"]).take(pa.array(keep))


def overlaps(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of every set of ``first`` with every set of ``second`` (positions in ``sets``).

    Values that only one set holds are left out; the others make the columns
    of 0/1 matrices, block by block, whose product counts the shared ones.
    """
    used = np.concatenate([first, second])
    sizes = [len(sets[i]) for i in used]
    values, column, count = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    row, column = np.repeat(np.arange(len(used)), sizes)[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(first), len(second)), np.float32)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, 2048):
        a, b = np.searchsorted(column, [start, start + 2048])
        matrix = np.zeros((len(used), 2048), np.float32)
        matrix[row[a:b], column[a:b] - start] = 1
        total += matrix[: len(first)] @ matrix[len(first) :].T
    return total.astype(np.int64)


class _Chunks:
    """One pair of chunks of a bucket: its rows, and the pairs across components that signatures and sizes leave."""

    def __init__(self, band: int, lo: int, hi: int, rows: list[tuple]):
        self.nodes, components, chunk, sketch, sizes = (list(c) for c in zip(*(r[:5] for r in rows), strict=True))
        self.sketch = np.frombuffer(b"".join(sketch), np.uint32).reshape(-1, HASHES)
        self.sizes, self.band = np.array(sizes), band
        number: dict[bytes, int] = {}
        self.component = np.array([number.setdefault(c, len(number)) for c in components])
        self.first, self.second = (np.flatnonzero(np.array(chunk) == side) for side in (lo, hi))
        self.same = lo == hi

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of pairs, some thousands at a time; a pair that shares several bands is met in the first of them only."""
        rows = max(1, TOGETHER // max(1, len(self.second)))
        for start in range(0, len(self.first), rows):
            i, j = (x.ravel() for x in np.meshgrid(self.first[start : start + rows], self.second, indexing="ij"))
            keep = (self.component[i] != self.component[j]) & (100 * np.minimum(self.sizes[i], self.sizes[j]) >= PERCENT * np.maximum(self.sizes[i], self.sizes[j]))
            if self.same:
                keep &= i < j
            i, j = i[keep], j[keep]
            if len(i):
                left = survivors(self.sketch[i], self.sketch[j])
                i, j = i[left], j[left]
            if len(i):
                mine = (self.sketch[i] == self.sketch[j]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == self.band
                i, j = i[mine], j[mine]
            if len(i):
                yield i, j


def _by_chunks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each (bucket, band, lo, hi) of a sorted stream; one group is held at a time."""
    held: list[tuple] = []
    last = None
    for batch in batches:
        for bucket, band, lo, hi, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "band", "lo", "hi")), *(batch.column(c).to_pylist() if c != "shingles" else batch.column(c) for c in columns), strict=True):
            if last != (bucket, band, lo, hi):
                if held:
                    yield last, held
                held, last = [], (bucket, band, lo, hi)
            held.append(tuple(row))
    if held:
        yield last, held


_MEMBER = ("node", "component", "chunk", "sketch", "size")
_PLACE = "bucket long, band int, lo int, hi int, node binary, component binary, chunk int"


def _chunk_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of each chunk pair that some pair across components still needs: only their sets travel on."""
    for (bucket, band, lo, hi), rows in _by_chunks(batches, _MEMBER):
        found = [np.concatenate(ij) for ij in _Chunks(band, lo, hi, rows).candidates()]
        if found:
            wanted = [rows[i] for i in np.unique(np.concatenate(found)).tolist()]
            n = len(wanted)
            values = ([bucket] * n, [band] * n, [lo] * n, [hi] * n, *([r[i] for r in wanted] for i in range(3)))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=[x.split()[0] for x in _PLACE.split(", ")])


def _chunk_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links across components, confirmed on full sets of 64-bit shingles.

    Components that are linked count as one from then on, so at most one link
    less than there are components is emitted.
    """
    for (_, band, lo, hi), rows in _by_chunks(batches, (*_MEMBER, "shingles")):
        pairs = _Chunks(band, lo, hi, rows)
        sets, component, out = [r[5].values.to_numpy() for r in rows], pairs.component, []
        for i, j in pairs.candidates():
            ui, vi = np.unique(i, return_inverse=True)
            uj, vj = np.unique(j, return_inverse=True)
            shared = overlaps(sets, ui, uj)[vi, vj]
            linked = 100 * shared >= PERCENT * (pairs.sizes[i] + pairs.sizes[j] - shared)
            for x, y in zip(i[linked], j[linked], strict=True):
                if component[x] != component[y]:
                    component[component == component[y]] = component[x]
                    out.append(sorted((pairs.nodes[x], pairs.nodes[y])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in out], pa.binary()), pa.array([e[1] for e in out], pa.binary())], names=["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the rows that stand for a class; of a class with several rows a task gives one."""
    given: set[bytes] = set()
    for batch in pieces(batches, "text"):
        classes, copied = batch.column("class").to_pylist(), batch.column("copied").to_pylist()
        keep = []
        for i, (c, several) in enumerate(zip(classes, copied, strict=True)):
            if not several or c not in given:
                keep.append(i)
            if several:
                given.add(c)
        some = batch.take(pa.array(keep, pa.int64()))
        sets = [shingles(t).view(np.int64) for t in some.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([some.column("class"), some.column("copied"), pa.array(sets, pa.list_(pa.int64()))], names=["class", "copied", "shingles"])


def _digest(shingle_set: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest() if len(shingle_set) else None


def _confirmed(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    one, two = (sets.select(F.col("class").alias(k), F.col("shingles").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    both = F.size(F.array_intersect("x", "y"))
    held = pairs.join(one, "a").join(two, "b")
    return written(held.where(100 * both >= PERCENT * (F.size("x") + F.size("y") - both)).select("a", "b").distinct(), f"{name}-links")


def link(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    Needs ``doc_id, text``. Equal sets form one class, and the work is on
    classes. Every bucket of a band first links its members to its hub, the
    member that shares most buckets with others; candidates are pruned by the posterior similarity of their
    signatures (16 values a step) and the rest confirmed on full sets. Then
    only buckets that still hold several components matter. Members outside a
    bucket's largest component are compared with all others of it across
    components, in chunks of about 512, so no bucket is capped and no pair
    within a component is ever made. Signatures go first; sets travel only for
    members that a signature leaves.

    Null and empty texts: 0 shingles, a component of their own, kept. Repeated
    rows are one class and share ids. Null ids take part in links; a component
    of null ids only has a null component_id and ``kept`` true. An empty table
    gives an empty result.
    """
    id_: Column = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return _grouped(docs).select("doc_id", "n_shingles", id_.alias("component_id"), F.col("doc_id").eqNullSafe(id_).alias("kept"))


def _key(text: Column) -> Column:
    """What tells the rows of one id apart: 128 bits of the text, null for null."""
    return F.unhex(F.md5(text.cast("string")))


def _grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n_shingles, class`` of every row and, null without shingles, its component's ``component_id`` and ``best``.

    ``best`` is the smallest (no id, doc_id, key) of the component's rows; it
    is found by class and then by component, so a large group is summed before
    each shuffle.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = written(docs.select("doc_id", "text", _key(F.col("text")).alias("key")).mapInArrow(_sketch, "doc_id long, key binary, n_shingles long, class binary, sketch binary"), "near-sketch")
    best = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    per_class = (F.min("doc_id").alias("first_id"), F.min(best).alias("best"), F.count(F.lit(1)).alias("rows"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("size"))
    classes = written(sketched.where(F.col("class").isNotNull()).groupBy("class").agg(*per_class), "near-classes")

    keys = classes.select("class", "sketch").mapInArrow(_bands, "bucket long, band int, node binary")
    shared = written(keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(F.col("bucket").alias("k"), "n"), "near-buckets")
    members = written(keys.join(shared, F.col("bucket") == F.col("k")).drop("k"), "near-members")
    # a text that others were copied from meets most members: its weight is largest
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    sketches = written(weights.join(classes, F.col("node") == F.col("class")).select(F.col("node").alias("c"), "weight", "best", "rows", "sketch", "size"), "near-open")
    # the row that stands for a class is found by id and text digest, so that repeated or missing ids meet only their own text
    wanted = sketches.select(F.col("c").alias("class"), F.col("best.doc_id").alias("_id"), F.col("best.key").alias("_key"), (F.col("rows") > 1).alias("copied"))
    stand = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (_key(F.col("text")) == F.col("_key"))).select("class", "copied", "text")
    found = written(stand.mapInArrow(_sets, "class binary, copied boolean, shingles array<long>"), "near-sets")
    sets = found.where(~F.col("copied")).unionByName(written(found.where("copied").dropDuplicates(["class"]), "near-copied")).select("class", "shingles")
    weighed = members.join(sketches.select("c", "weight"), F.col("node") == F.col("c"))
    hubs = written(weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node"))["node"].alias("hub")).select(F.col("bucket").alias("k"), "hub"), "near-hubs")

    stars = members.join(hubs, F.col("bucket") == F.col("k")).where(F.col("node") != F.col("hub")).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    stars = _with(_with(stars, sketches, "a", "sa"), sketches, "b", "sb")
    links = _confirmed(written(stars.mapInArrow(_pruned, "a binary, b binary"), "near-stars"), sets, "near-first")
    found = components(links).select(F.col("node").alias("c"), "component")

    placed = written(members.where(F.col("n") > 2).join(found, F.col("node") == F.col("c"), "left").select("bucket", "band", "node", F.coalesce("component", "node").alias("component")), "near-placed")
    per = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"))
    in_chunks = lambda n: F.ceil(n / CHUNK).cast("int")
    mixed = per.where(F.col("main.n") < F.col("n")).select(F.col("bucket").alias("k"), F.col("main.component").alias("main"), in_chunks(F.col("n") - F.col("main.n")).alias("aside"), in_chunks(F.col("main.n")).alias("central"))
    open_ = placed.join(written(mixed, "near-mixed"), F.col("bucket") == F.col("k"))
    # chunks of the members aside come first; those of the largest component only meet these
    own, hashed = F.col("component") == F.col("main"), F.xxhash64("node")
    chunk = F.when(own, F.col("aside") + F.pmod(hashed, F.col("central"))).otherwise(F.pmod(hashed, F.col("aside"))).cast("int")
    others = F.sequence(F.lit(0), F.col("aside") + F.when(own, 0).otherwise(F.col("central")) - 1)
    dealt = open_.select("bucket", "band", "node", "component", chunk.alias("chunk"), F.explode(others).alias("other"))
    dealt = dealt.select("bucket", "band", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "node", "component", "chunk")
    sketch = sketches.select("c", "sketch", "size")
    dealt = dealt.join(sketch, F.col("node") == F.col("c")).drop("c").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "band", "lo", "hi")
    needed = written(dealt.mapInArrow(_chunk_open, _PLACE), "near-needed")
    if needed.take(1):
        full = needed.join(sketch, F.col("node") == F.col("c")).drop("c").join(sets.withColumnRenamed("class", "c"), F.col("node") == F.col("c")).drop("c")
        full = full.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "band", "lo", "hi")
        links = links.unionByName(written(full.mapInArrow(_chunk_links, "a binary, b binary").distinct(), "near-second"))
        found = components(links).select(F.col("node").alias("c"), "component")

    grouped = classes.select("class", "first_id", "best").join(found, F.col("class") == F.col("c"), "left").select("class", "first_id", "best", F.coalesce("component", "class").alias("component"))
    smallest = written(grouped.groupBy("component").agg(F.min("first_id").alias("component_id"), F.min("best").alias("best")).withColumnRenamed("component", "g"), "near-groups")
    of_class = written(grouped.drop("best").join(smallest, F.col("component") == F.col("g")).select(F.col("class").alias("c"), "component_id", "best"), "near-ids")
    return sketched.join(of_class, F.col("class") == F.col("c"), "left").select("doc_id", "key", "n_shingles", "class", "component_id", "best")


def _with(left: DataFrame, sketches: DataFrame, key: str, name: str) -> DataFrame:
    return left.join(sketches.select("c", F.col("sketch").alias(name)), F.col(key) == F.col("c")).drop("c")


def keep_first(docs: DataFrame, once: bool = False) -> DataFrame:
    """``docs`` without those that are not the first of their near-duplicate group; all columns stay.

    Each row is judged by its id and text: of a group stays the row of the
    smallest id, of equal ids the one of the smallest text digest. Rows without
    id come after those with one; of a group without any id one row stays.
    Rows that repeat both id and text are one document: they stay or go
    together, or with ``once`` a single one stays, that of the smallest hash of
    all its columns. Texts without words are no copies of each other and stay.
    """
    judged = _grouped(docs).where(F.col("class").isNotNull())
    first = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("key") == F.col("best.key"))
    rows = judged.groupBy("doc_id", "key").agg(F.max(~first).alias("gone"), F.count(F.lit(1)).alias("n"))
    repeated = (F.col("n") > 1) & (F.lit(once) | F.col("doc_id").isNull())
    marked = written(rows.where(F.col("gone") | repeated).select(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), "gone"), "near-marked")
    # rows travel whole in one column, so that no name of theirs can clash
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), _key(F.col("text")).alias("key"))
    mine = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key"))
    # a join by shuffle at every size: what goes grows with the documents
    kept = whole.join(marked.hint("merge"), mine, "left_anti").select("row.*")
    if not marked.where(~F.col("gone")).take(1):
        return kept
    order = F.xxhash64(*[F.col(f"row.`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    again = whole.join(marked.where(~F.col("gone")), mine, "left_semi")
    one = again.groupBy("id", "key").agg(F.min_by("row", order).alias("row"))
    return kept.unionByName(one.select("row.*"))

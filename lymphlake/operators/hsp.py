"""Local hits of reads in a germline library, several of one allele where an insertion or deletion is long.

Exact seeds are merged to stretches per diagonal, stretches grow without gaps
until their score drops, and chains of stretches on several diagonals, gaps
paid for, are the hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.functions.seq import revcomp
from lymphlake.operators.align import COSTS, HIT_SCHEMA, IDENTITIES, WORD_SIZES, spread
from lymphlake.operators.hits import seed_votes

#: How far an ungapped extension, and a chain in one gap, may fall below their best before they end.
X_DROP, GAP_DROP = 10, 50


def _turned(strand: Column, seq: Column) -> Column:
    return F.when(strand == "plus", F.upper(seq)).otherwise(revcomp(F.upper(seq)))


#: Bytes of places that are compared at once, few enough for a core's cache, and pairs at once.
BLOCK_PLACES, BLOCK_PAIRS = 1 << 19, 64


def _letters(seqs: list[str], dtype: type) -> np.ndarray:
    """One row a sequence, ends padded by 0, which no sequence holds."""
    return np.array(seqs).view(np.uint32).reshape(len(seqs), -1).astype(dtype)


def shared_runs(reads: list[str], genes: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(pair, qstart, diagonal, length)`` of the longest runs of equal places of reads with their alleles, of at least ``k`` places, in that order.

    All diagonals of some pairs are compared at once; long pairs are cut into ranges of diagonals.
    """
    dtype = np.uint8 if all(map(str.isascii, reads)) and all(map(str.isascii, genes)) else np.uint32
    x, y = _letters(reads, dtype), _letters(genes, dtype)
    n, wide = x.shape
    x = np.concatenate([x, np.zeros((n, 1), dtype)], axis=1)
    x[x == 0] = np.iinfo(dtype).max  # the ends of reads equal no place, so no run goes on in the next row
    padded = np.zeros((n, y.shape[1] + 2 * wide + 1), dtype)
    padded[:, wide : wide + y.shape[1]] = y
    lowest, highest = k - y.shape[1], wide - k
    each = max(1, BLOCK_PLACES // (n * (wide + 1)))
    found = []
    for low in range(lowest, highest + 1, each):
        many = min(each, highest + 1 - low)
        others = np.lib.stride_tricks.as_strided(padded[:, wide - low :], (n, many, wide + 1), (padded.strides[0], -padded.itemsize, padded.itemsize))
        word, size = (x[:, None, :] == others).ravel(), 1
        while size < k:  # words of ``size`` equal places from each place on
            step = min(size, k - size)
            word, size = word[:-step] & word[step:], size + step
        at = np.flatnonzero(word)
        if len(at):
            breaks = np.flatnonzero(np.diff(at) != 1)
            begin, end = at[np.concatenate([[0], breaks + 1])], at[np.concatenate([breaks, [len(at) - 1]])]
            row, qstart = np.divmod(begin, wide + 1)
            found.append((row // many, qstart, row % many + low, end - begin + k))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    pair, qstart, diagonal, length = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((diagonal, qstart, pair))
    return pair[order], qstart[order], diagonal[order], length[order]


def packed_stretches(pairs: DataFrame, germline: DataFrame, k: int) -> DataFrame:
    """``pairs`` (``id, allele, strand, seq`` and any other columns) with ``gene`` and ``all``: their stretches ``(qstart, diagonal, length)`` in order.

    Pairs without one are left out. A pair's stretches are found in its own
    row, on all diagonals of many pairs at once, so that no word travels.
    """
    library = germline.select(F.col("allele").alias("_a"), F.upper("seq").alias("gene")).where(F.length("gene") >= k)
    rows = pairs.where(F.length("seq") >= k).withColumn("_turned", _turned(F.col("strand"), F.col("seq"))).join(library, F.col("allele") == F.col("_a")).drop("_a")
    names = [c for c in rows.columns if c != "_turned"]
    stretch = pa.struct([("qstart", pa.int32()), ("diagonal", pa.int32()), ("length", pa.int32())])
    kind = "array<struct<qstart:int,diagonal:int,length:int>>"
    schema = rows.select(*names, F.lit(None).cast(kind).alias("all")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reads, genes = batch.column("_turned").to_pylist(), batch.column("gene").to_pylist()
            keep, sizes, parts = [], [], []
            order = sorted(range(len(reads)), key=lambda i: len(reads[i]))
            for at in range(0, len(order), BLOCK_PAIRS):
                own = order[at : at + BLOCK_PAIRS]
                pair, *values = shared_runs([reads[i] for i in own], [genes[i] for i in own], k)
                n = np.bincount(pair, minlength=len(own))
                some = np.flatnonzero(n)
                keep += [own[i] for i in some]
                sizes.append(n[some])
                parts.append(values)
            if keep:
                values = [pa.array(np.concatenate(c).astype(np.int32)) for c in zip(*parts, strict=True)]
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(values, fields=list(stretch)))
                kept = batch.take(pa.array(keep, pa.int64()))
                yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in names), lists], names=[*names, "all"])

    return rows.mapInArrow(run, schema)


def seed_stretches(reads: DataFrame | None, germline: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """``id, allele, strand, diagonal, qstart, length``: the longest runs of shared words on one diagonal, of at least ``k`` places.

    ``pairs`` has ``id, allele, strand``: what is looked at; with ``seq`` as well
    (``reads`` None) nothing has to be joined. On the minus strand places are
    those of the reverse complement. Places count from 0.
    """
    if reads is not None:
        pairs = pairs.select("id", "allele", "strand").join(reads.select(F.col("id").alias("_i"), "seq"), F.col("id") == F.col("_i")).drop("_i")
    found = packed_stretches(pairs.select("id", "allele", "strand", "seq"), germline, k).select("id", "allele", "strand", F.explode("all").alias("s"))
    return found.select("id", "allele", "strand", "s.diagonal", "s.qstart", "s.length")


def seed_chains(stretches: DataFrame, costs: tuple[int, int, int] = COSTS) -> DataFrame:
    """``id, allele, strand, score, stretches``: the best chain of exact stretches of each pair, and how many stretches it was found among.

    ``stretches`` has one row a stretch, or one a pair with all of them
    (:func:`packed_stretches`), which needs no shuffle.
    In a chain each stretch lies behind the one before in the read and in the
    allele; where they overlap, the later one gives the overlap up. Between two
    diagonals a gap is paid for, and places that no stretch covers, in the
    read or the allele, whichever are fewer, count as mismatches.
    """
    rows = stretches if "all" in stretches.columns else stretches.groupBy("id", "allele", "strand").agg(F.array_sort(F.collect_list(F.struct("qstart", "diagonal", "length"))).alias("all"))
    mismatch, opened, place = costs

    def ends(x: Column) -> tuple[Column, Column, Column, Column]:
        return x["qstart"], x["qstart"] + x["length"], x["qstart"] - x["diagonal"], x["qstart"] - x["diagonal"] + x["length"]

    def step(chains: Column, x: Column) -> Column:
        q0, q1, s0, s1 = ends(x)

        def behind(c: Column) -> Column:
            over = F.greatest(F.lit(0), c["q"] - q0, c["s"] - s0)
            apart = F.abs(x["diagonal"] - c["diagonal"])
            cost = F.when(apart > 0, opened + place * apart).otherwise(0) + mismatch * F.least(F.greatest(q0 - c["q"], F.lit(0)), F.greatest(s0 - c["s"], F.lit(0)))
            return F.when((q1 > c["q"]) & (s1 > c["s"]) & (over < x["length"]), c["score"] - cost - over).otherwise(0)

        best = F.coalesce(F.array_max(F.transform(chains, behind)), F.lit(0))
        return F.concat(chains, F.array(F.struct(q1.cast("int").alias("q"), s1.cast("int").alias("s"), x["diagonal"].cast("int").alias("diagonal"), (x["length"] + F.greatest(best, F.lit(0))).cast("int").alias("score"))))

    none = F.array().cast("array<struct<q:int,s:int,diagonal:int,score:int>>")
    chains = F.aggregate("all", none, step)
    return rows.select("id", "allele", "strand", F.array_max(F.transform(chains, lambda c: c["score"])).alias("score"), F.size("all").alias("stretches"))


def _extended(x: np.ndarray, y: np.ndarray, q: int, length: int, diagonal: int, mismatch: int) -> tuple[int, int]:
    """Where an exact stretch ends to both sides once it has grown without gaps: its begin and end in the read."""
    low, high = max(0, diagonal), min(len(x), len(y) + diagonal)

    def grown(same: np.ndarray) -> int:
        gain = np.cumsum(np.where(same, 1, -mismatch))
        if not len(gain):
            return 0
        best = np.maximum.accumulate(np.maximum(gain, 0))
        stop = np.flatnonzero(best - gain > X_DROP)
        gain = gain[: stop[0]] if len(stop) else gain
        return int(gain.argmax()) + 1 if len(gain) and gain.max() > 0 else 0

    left = (x[low:q] == y[low - diagonal : q - diagonal])[::-1]
    right = x[q + length : high] == y[q + length - diagonal : high - diagonal]
    return q - grown(left), q + length + grown(right)


def local_hits(read: bytes, gene: bytes, stretches: list[tuple[int, int, int]], costs: tuple[int, int, int] = COSTS, least: float = 1) -> list[tuple[int, ...]]:
    """Hits of a read in an allele from their exact stretches ``(qstart, diagonal, length)``, best first.

    A hit is ``(q0, q1, s0, s1, matches, mismatches, gaps, score)``, half-open
    from 0. No place of the allele belongs to two hits: what a better one
    holds is cut from the stretches that are left.
    """
    mismatch, opened, place = costs
    x, y = np.frombuffer(read, np.uint8), np.frombuffer(gene, np.uint8)
    grown: dict[int, list[tuple[int, int]]] = {}
    for q, d, n in sorted(stretches):
        if not any(a <= q and q + n <= b for a, b in grown.get(d, ())):
            grown.setdefault(d, []).append(_extended(x, y, q, n, d, mismatch))
    left = sorted({(a, b, d) for d, some in grown.items() for a, b in some})
    out = []
    while left:
        q0, q1, d = (np.array(v, np.int64) for v in zip(*left, strict=True))
        sums = [np.concatenate([[0], np.cumsum(np.where(x[a:b] == y[a - k : b - k], 1, -mismatch))]) for a, b, k in left]
        score, back, cut = np.array([s[-1] for s in sums], np.int64), np.full(len(left), -1), np.zeros(len(left), np.int64)
        for i in range(1, len(left)):
            a, b, k = left[i]
            over = np.maximum(0, np.maximum(q1[:i] - a, (q1[:i] - d[:i]) - (a - k)))
            fits = (over < b - a) & (q1[:i] < b) & (q1[:i] - d[:i] < b - k)
            apart = np.abs(d[:i] - k)
            between = np.minimum(np.maximum(a - q1[:i], 0), np.maximum((a - k) - (q1[:i] - d[:i]), 0))
            cost = np.where(apart > 0, opened + place * apart, 0) + mismatch * between
            gain = score[:i] + sums[i][-1] - sums[i][np.minimum(over, b - a)] - cost
            gain[~fits | (cost > GAP_DROP)] = -(10**9)
            j = int(gain.argmax())
            if gain[j] > score[i]:
                score[i], back[i], cut[i] = gain[j], j, over[j]
        i = int(score.argmax())
        total = int(score[i])
        if total < least:
            break
        chain = []
        while i >= 0:
            chain.append(i)
            i = int(back[i])
        chain.reverse()
        matches = mismatches = gaps = 0
        for c, i in enumerate(chain):
            a, b, k = left[i]
            a += int(cut[i])
            same = int((x[a:b] == y[a - k : b - k]).sum())
            matches, mismatches = matches + same, mismatches + (b - a - same)
            if c:
                p = chain[c - 1]
                gaps += abs(int(d[p]) - k)
                mismatches += int(min(a - q1[p], (a - k) - (q1[p] - d[p])))
        begin, end = left[chain[0]], left[chain[-1]]
        s0, s1 = begin[0] - begin[2], end[1] - end[2]
        out.append((begin[0], end[1], s0, s1, matches, mismatches, gaps, total))
        rest = []
        for i, (a, b, k) in enumerate(left):
            if i in chain or (a >= begin[0] and b <= end[1]):
                continue
            before, after = s0 - (a - k), (b - k) - s1
            if min(b - k, s1) > max(a - k, s0):  # keeps the larger side of what the hit does not hold
                a, b = (a, a + before) if before >= after else (b - after, b)
            if b > a:
                rest.append((a, b, k))
        left = rest
    return out


def local_hit_table(reads: DataFrame, germline: DataFrame, segment: str = "V", evalue: float = 1e-3, keep: int = 10) -> DataFrame:
    """A hit table by the rules of a segment, one row a hit, best first; an allele may have several hits in a read.

    ``reads`` has ``id, seq``, ``germline`` ``allele, seq``. The ``keep`` best
    alleles by shared words are looked at. Costs, word sizes, the constant
    segment's identity and the expected number by chance (m n exp(-s ln 3) / 3)
    are those of ``align.segment_hits``. Equal reads are searched once. Null
    and empty reads, and those without a hit, are not in the table.
    """
    once = reads.where(F.length("seq") > 0).groupBy(F.upper("seq").alias("seq")).agg(F.min("id").alias("id"))
    k = WORD_SIZES[segment]
    pairs = seed_votes(once, germline, k, keep).select("id", "allele", "strand").join(once.select(F.col("id").alias("_i"), "seq"), F.col("id") == F.col("_i")).drop("_i")
    rows = packed_stretches(spread(pairs), germline, k).select("id", "allele", "strand", _turned(F.col("strand"), F.col("seq")).alias("read"), "gene", F.col("all").alias("stretches"))
    library = germline.agg(F.sum(F.length("seq"))).first()[0] or 0
    kinds = (pa.string(), pa.string(), pa.float64(), *[pa.int32()] * 7, pa.float64(), pa.string())
    names = [x.split()[0] for x in HIT_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, allele, strand, read, gene, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                least = np.log(max(len(read) * library, 1) / 3 / evalue) / np.log(3)
                for q0, q1, s0, s1, matches, mismatches, gaps, score in local_hits(read.encode(), gene.encode(), [(s["qstart"], s["diagonal"], s["length"]) for s in some], COSTS, least):
                    n = matches + mismatches + gaps
                    q, s = (q0 + 1, q1), (s0 + 1, s1)
                    if strand == "minus":
                        q, s = (len(read) - q1 + 1, len(read) - q0), (s1, s0 + 1)
                    out.append((name, allele, 100.0 * matches / n, n, mismatches, gaps, *q, *s, float(score), strand))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    best = F.max("score").over(Window.partitionBy("qid", "sid"))
    hits = rows.mapInArrow(run, HIT_SCHEMA).where(F.col("identity") >= IDENTITIES.get(segment, 0.0)).withColumn("_best", best)
    ranked = hits.withColumn("_identity", F.max("identity").over(Window.partitionBy("qid", "sid")))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("_best"), F.desc("_identity"), "sid", F.desc("score"), "qstart"))
    ranked = ranked.withColumn("hit_rank", rank).drop("_best", "_identity")
    equal = reads.select(F.col("id").alias("_of"), F.upper("seq").alias("_s")).join(once, F.col("_s") == F.col("seq")).select("_of", F.col("id").alias("_first"))
    return ranked.join(equal, F.col("qid") == F.col("_first")).select(F.col("_of").alias("qid"), *ranked.columns[1:])

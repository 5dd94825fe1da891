"""Barcodes, UMI groups and consensus sequences."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.functions.seq import min_phred_ok, revcomp


def barcode_split(reads: DataFrame, cell: tuple[int, int], umi: tuple[int, int], umi2: tuple[int, int] | None = None) -> DataFrame:
    """Adds ``cell, umi`` from 0-based half-open slices and cuts the read behind them.

    ``umi2`` lies at the other end: it is taken from the reverse complement,
    appended to the UMI and cut too.
    """
    n = F.length("seq")
    out = reads.withColumn("cell", F.substring("seq", cell[0] + 1, cell[1] - cell[0])).withColumn("umi", F.substring("seq", umi[0] + 1, umi[1] - umi[0]))
    rest = F.substr("seq", F.lit(max(cell[1], umi[1]) + 1))
    if umi2 is not None:
        out = out.withColumn("umi", F.concat("umi", F.substring(revcomp(F.col("seq")), umi2[0] + 1, umi2[1] - umi2[0])))
        rest = F.substr("seq", F.lit(max(cell[1], umi[1]) + 1), n - max(cell[1], umi[1]) - umi2[1])
    return out.withColumn("seq", rest)


def quality_barcodes(reads: DataFrame, start: int, stop: int, least: int = 20) -> DataFrame:
    """Reads whose barcode bases all reach ``least``."""
    return reads.where(min_phred_ok(F.substring("qual", start + 1, stop - start), least))


def whitelisted(reads: DataFrame, whitelist: DataFrame, column: str = "cell") -> tuple[DataFrame, DataFrame]:
    """Reads whose barcode is listed, and the others."""
    listed = whitelist.select(F.col(whitelist.columns[0]).alias("_w")).distinct()
    on = F.col(column) == F.col("_w")
    return reads.join(listed, on, "left_semi"), reads.join(listed, on, "left_anti")


def read_pairs(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """``id, seq1, seq2``, and ``qual1, qual2`` if both have qualities: mates joined by id without /1 and /2; unmatched reads are left out."""
    name = F.regexp_replace(F.split_part("id", F.lit(" "), F.lit(1)), "/[12]$", "")
    marks = [c for c in ("qual",) if c in r1.columns and c in r2.columns]
    a, b = (r.select(name.alias(key), *[F.col(c).alias(f"{c}{i}") for c in ("seq", *marks)]) for i, key, r in ((1, "id", r1), (2, "_id", r2)))
    return a.join(b, F.col("id") == F.col("_id")).drop("_id")


def unpaired_reads(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """``id, mate``: reads of either file whose mate is missing; one row means that the files do not belong together."""
    name = F.regexp_replace(F.split_part("id", F.lit(" "), F.lit(1)), "/[12]$", "")
    sides = r1.select(name.alias("id"), F.lit(1).alias("mate")).unionByName(r2.select(name.alias("id"), F.lit(2).alias("mate")))
    return sides.groupBy("id").agg(F.min("mate").alias("mate"), F.max("mate").alias("_last")).where(F.col("mate") == F.col("_last")).select("id", "mate")


def _error(qual: np.ndarray) -> np.ndarray:
    return np.power(10.0, -qual / 10)


def combined_quality(same: np.ndarray, q1: np.ndarray, q2: np.ndarray, most: int = 41) -> np.ndarray:
    """Quality of a base that two reads report, by the chance that it is wrong (published posterior rule for overlapping reads)."""
    good, bad = _error(np.maximum(q1, q2)), _error(np.minimum(q1, q2))
    agreed = good * bad / 3 / (1 - good - bad + 4 * good * bad / 3)
    differed = good * (1 - bad / 3) / (good + bad - 4 * good * bad / 3)
    return np.clip(np.floor(-10 * np.log10(np.where(same, agreed, differed)) + 0.5), 0, most).astype(np.int64)


def merge_batch(x: np.ndarray, y: np.ndarray, qx: np.ndarray | None, qy: np.ndarray | None, least_length: int, least_overlap: int, most_diffs: int, most_percent: float) -> list[tuple[bytes | None, bytes | None]]:
    """Merged bases and qualities of pairs of one shape (rows of ``x`` and ``y``, mates in one direction).

    Every overlap is tried on all pairs at once; the one of the smallest share
    of differences wins, of equally good ones the longest. Where mates differ
    the base of better quality stays, the first mate's if they are equal.
    """
    count, best, size = len(x), np.full(len(x), np.inf), np.zeros(len(x), np.int64)
    for n in range(min(x.shape[1], y.shape[1]), max(least_overlap, 1) - 1, -1):
        diffs = (x[:, x.shape[1] - n :] != y[:, :n]).sum(axis=1)
        better = (diffs <= most_diffs) & (diffs * 100 <= most_percent * n) & (diffs / n < best)
        best[better], size[better] = diffs[better] / n, n
    out: list[tuple[bytes | None, bytes | None]] = [(None, None)] * count
    for n in np.unique(size[size > 0]).tolist():
        if x.shape[1] + y.shape[1] - n < least_length:
            continue
        rows = np.flatnonzero(size == n)
        head, left, right, tail = x[rows, : x.shape[1] - n], x[rows, x.shape[1] - n :], y[rows, :n], y[rows, n:]
        if qx is None or qy is None:
            made, marks = np.concatenate([head, left, tail], axis=1), [None] * len(rows)
        else:
            q1, q2 = qx[rows, x.shape[1] - n :].astype(np.int64) - 33, qy[rows, :n].astype(np.int64) - 33
            made = np.concatenate([head, np.where(q2 > q1, right, left), tail], axis=1)
            middle = (combined_quality(left == right, q1, q2) + 33).astype(np.uint8)
            marks = [r.tobytes() for r in np.concatenate([qx[rows, : x.shape[1] - n], middle, qy[rows, n:]], axis=1)]
        for row, bases, mark in zip(rows.tolist(), made, marks, strict=True):
            out[row] = (bases.tobytes(), mark)
    return out


def merge_pairs(pairs: DataFrame, least_length: int = 350, least_overlap: int = 10, most_diffs: int = 100, most_percent: float = 25.0) -> DataFrame:
    """``id, merged``, and ``qual`` if the pairs have ``qual1, qual2``: mates joined over their best overlap, null when none fits the limits.

    Pairs are dealt with in batches of one shape; see :func:`merge_batch`. A
    null mate, or qualities of another length than the bases, give null.
    """
    marked = {"qual1", "qual2"} <= set(pairs.columns)
    names = ["seq1", "seq2", *(["qual1", "qual2"] if marked else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[None if v is None else v.encode() for v in batch.column(c).to_pylist()] for c in names]
            shapes: dict[tuple[int, int], list[int]] = {}
            for i, row in enumerate(zip(*columns, strict=True)):
                if all(v is not None for v in row) and (not marked or (len(row[0]), len(row[1])) == (len(row[2]), len(row[3]))):
                    shapes.setdefault((len(row[0]), len(row[1])), []).append(i)
            found: list = [(None, None)] * batch.num_rows
            for shape, rows in shapes.items():
                part = [np.frombuffer(b"".join(c[i] for i in rows), np.uint8).reshape(len(rows), shape[k % 2]) for k, c in enumerate(columns)]
                for i, made in zip(rows, merge_batch(*part, *([] if marked else [None, None]), least_length, least_overlap, most_diffs, most_percent), strict=True):
                    found[i] = made
            out = [pa.array([None if v is None else v.decode() for v in c], pa.string()) for c in zip(*found, strict=True)] or [pa.array([], pa.string())] * 2
            yield pa.RecordBatch.from_arrays([batch.column("id"), *out[: 1 + marked]], names=["id", "merged", "qual"][: 2 + marked])

    turned = [F.reverse("qual2").alias("qual2")] if marked else []
    rows = pairs.select("id", "seq1", revcomp(F.col("seq2")).alias("seq2"), *(["qual1"] if marked else []), *turned)
    return rows.mapInArrow(run, "id string, merged string" + (", qual string" if marked else ""))


def umi_stats(reads: DataFrame) -> DataFrame:
    return reads.groupBy("cell", "umi").agg(F.count(F.lit(1)).alias("count"))


def majority_consensus(reads: DataFrame, least: int = 3) -> DataFrame:
    """``cell, umi, n, consensus``: column majority of a UMI's reads of one length; groups under ``least`` are dropped.

    Counted per (UMI, place, base) before the shuffle, so even a giant UMI is
    never gathered: what travels is bounded by places times bases. Ties go to
    the first letter.
    """
    n = umi_stats(reads).where(F.col("count") >= least).select(F.col("cell").alias("_c"), F.col("umi").alias("_u"), F.col("count").alias("n"))
    places = reads.select("cell", "umi", F.posexplode(F.split("seq", "")).alias("pos", "base")).groupBy("cell", "umi", "pos", "base").agg(F.count(F.lit(1)).alias("k"))
    best = places.groupBy("cell", "umi", "pos").agg(F.min(F.struct((-F.col("k")).alias("k"), "base"))["base"].alias("base"))
    joined = best.groupBy("cell", "umi").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "base"))), lambda s: s["base"]), "").alias("consensus"))
    return joined.join(n, (F.col("cell") == F.col("_c")) & (F.col("umi") == F.col("_u"))).select("cell", "umi", "n", "consensus")


def star_consensus(centre: str, members: list[str], weights: list[int], plain: float = 0.9) -> str:
    """Column majority of members aligned to their centre; columns that are mostly gaps go.

    A member of the centre's length that agrees in ``plain`` of its places needs no gaps.
    A member votes where it reaches: its ends do not vote for gaps. What most
    of the weight has inserted behind a place is taken over, by the heaviest
    insertion. Ties go to the first letter, and to a letter rather than a gap.
    """
    from lymphlake.operators.batch_align import align_batch

    columns, inserted, total = [Counter() for _ in centre], [Counter() for _ in range(len(centre) + 1)], sum(weights)
    different = [m for m in members if len(m) != len(centre) or sum(a == b for a, b in zip(m, centre, strict=True)) < plain * len(centre) - 1e-9]
    paths = dict(zip(different, align_batch(different, [centre] * len(different), 1, 1), strict=True))
    for member, weight in zip(members, weights, strict=True):
        own, other = paths.get(member, (member, centre))
        begin, end = len(own) - len(own.lstrip("-")), len(own.rstrip("-"))
        place, more = 0, ""
        for i, (base, at) in enumerate(zip(own, other, strict=True)):
            if at == "-":
                more += base
                continue
            if more:
                inserted[place][more] += weight
                more = ""
            if begin <= i < end:
                columns[place][base] += weight
            place += 1
        if more:
            inserted[place][more] += weight
    out = []
    for place in range(len(centre) + 1):
        if sum(inserted[place].values()) * 2 > total:
            out.append(min(inserted[place], key=lambda s: (-inserted[place][s], s)))
        if place < len(centre) and columns[place]:
            best = min(columns[place], key=lambda b: (-columns[place][b], b == "-", b))
            out.append("" if best == "-" else best)
    return "".join(out)


def largest_cluster(reads: DataFrame, least: int = 3, identity: float = 0.95, band: int = 2) -> DataFrame:
    """``cell, umi, n, multi, size, consensus`` of the UMI's largest cluster of similar reads.

    Distinct sequences with their counts, most frequent first, are clustered
    greedily, with up to ``band`` gaps; the other clusters are counted in
    ``multi``. The largest one is aligned to its centroid (:func:`star_consensus`),
    so that reads with an insertion or deletion vote too. A single read
    passes as it is if ``least`` is 1. The groups hold distinct sequences, not
    reads: copies are counted before the shuffle.
    """
    counted = reads.groupBy("cell", "umi", "seq").agg(F.count(F.lit(1)).alias("k"))
    groups = counted.groupBy("cell", "umi").agg(F.sum("k").alias("n"), F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("k"), "seq"))).alias("seqs")).where(F.col("n") >= least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lymphlake.operators.clones import greedy_centroids

        for batch in batches:
            out = []
            for seqs in batch.column("seqs").to_pylist():
                names = greedy_centroids([(s["seq"], s["seq"]) for s in seqs], identity, band)
                sizes: Counter = Counter()
                for s, c in zip(seqs, names, strict=True):
                    sizes[c] -= s["k"]
                best = min(sizes, key=lambda c: (-sizes[c], c))
                mine = [s for s, c in zip(seqs, names, strict=True) if c == best]
                out.append((len(sizes) - 1, sizes[best], star_consensus(best, [s["seq"] for s in mine], [-s["k"] for s in mine], identity)))
            yield pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("umi"), batch.column("n"), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.string())], names=["cell", "umi", "n", "multi", "size", "consensus"])

    return groups.mapInArrow(run, "cell string, umi string, n long, multi long, size long, consensus string").where(F.col("size") >= least)


def cell_consensus(umis: DataFrame, least_umis: int = 1, identity: float = 0.99, band: int = 2) -> DataFrame:
    """``sequence_id, cell, sequence, duplicate_count, consensus_count``: all clusters of a cell's UMI consensuses, with up to ``band`` gaps.

    ``umis`` has ``cell, umi, size, consensus``. Clusters of fewer than
    ``least_umis`` UMIs are dropped; ids are cell.n by size; duplicate_count
    counts UMIs, consensus_count reads.
    """
    from lymphlake.operators.clones import cluster_blocks

    rows = umis.withColumn("_id", F.concat_ws(":", "cell", "umi"))
    order = [(-F.col("size")).alias("a"), F.col("_id").alias("b")]
    found = cluster_blocks(rows, [F.col("cell")], "_id", "consensus", order, identity, band).select(F.col("_id").alias("_i"), "centroid")
    joined = rows.join(found, F.col("_id") == F.col("_i"))
    groups = joined.groupBy("cell", "centroid").agg(F.count(F.lit(1)).alias("duplicate_count"), F.sum("size").alias("consensus_count"), F.min_by("consensus", F.struct((-F.col("size")).alias("a"), "_id")).alias("sequence")).where(F.col("duplicate_count") >= least_umis)
    n = F.row_number().over(Window.partitionBy("cell").orderBy(F.desc("duplicate_count"), F.desc("consensus_count"), "centroid"))
    return groups.select(F.concat_ws(".", "cell", n.cast("string")).alias("sequence_id"), "cell", "sequence", "duplicate_count", "consensus_count")

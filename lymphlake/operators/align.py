"""Pairwise alignment in numpy, mapped over rows that Spark has paired."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphlake.operators.batch_align import MATCH, MISMATCH, align_batch

_NONE = -(10**8)


def align_pair(a: str, b: str, gap_open: int = 0, gap_extend: int = 2) -> tuple[str, str]:
    """Global alignment of two sequences; gaps at the ends are free. One pair at a time: what tests hold ``align_batch`` against.

    A gap of n places costs ``gap_open + n * gap_extend``. Row by row; gaps
    along the row are a cumulative maximum, so each row is a few numpy
    operations.
    """
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    n, m = len(x), len(y)
    score, down, along = np.zeros((n + 1, m + 1), np.int32), np.full((n + 1, m + 1), _NONE, np.int32), np.full((n + 1, m + 1), _NONE, np.int32)
    ramp = np.arange(m + 1) * gap_extend
    first = gap_open + gap_extend
    for i in range(1, n + 1):
        down[i, 1:] = np.maximum(down[i - 1, 1:] - gap_extend, score[i - 1, 1:] - first)
        row = np.zeros(m + 1, np.int32)
        row[1:] = np.maximum(down[i, 1:], score[i - 1, :-1] + np.where(y == x[i - 1], MATCH, MISMATCH))
        along[i, 1:] = np.maximum.accumulate(row + ramp)[:-1] - ramp[1:] - gap_open
        score[i] = np.maximum(row, along[i])
    i, j = (n, int(score[n].argmax())) if score[n].max() >= score[:, m].max() else (int(score[:, m].argmax()), m)
    out_a, out_b = [a[i:][::-1] + "-" * (m - j)], ["-" * (n - i) + b[j:][::-1]]
    gap = None  # the matrix that the path runs in: None, down or along
    while i > 0 and j > 0:
        if gap is None:
            if score[i, j] == score[i - 1, j - 1] + (MATCH if x[i - 1] == y[j - 1] else MISMATCH):
                i, j = i - 1, j - 1
                out_a.append(a[i])
                out_b.append(b[j])
                continue
            gap = "down" if score[i, j] == down[i, j] else "along"
        if gap == "down":
            gap = None if down[i, j] == score[i - 1, j] - first else gap
            i -= 1
            out_a.append(a[i])
            out_b.append("-")
        else:
            gap = None if along[i, j] == score[i, j - 1] - first else gap
            j -= 1
            out_a.append("-")
            out_b.append(b[j])
    out_a += [a[:i][::-1], "-" * j]
    out_b += ["-" * i, b[:j][::-1]]
    return "".join(out_a)[::-1], "".join(out_b)[::-1]


def banded_identity(a: str, b: str, band: int) -> float:
    """Matches over the shorter length of the best alignment with at most ``band`` gaps to either side."""
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    width = 2 * band + 1
    best = np.zeros(width, np.int32)
    for i in range(len(x)):
        j = i + np.arange(width) - band
        ok = (j >= 0) & (j < len(y))
        same = np.zeros(width, np.int32)
        same[ok] = x[i] == y[j[ok]]
        best = np.maximum(best + same, np.concatenate([best[1:], [0]]))
        best = np.maximum.accumulate(best)
    return int(best.max()) / max(1, min(len(x), len(y)))


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over all shuffle partitions: few bytes, but much work each, so they must not be coalesced by size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def aligned(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with ``a_aln, b_aln``. Equal pairs should be made distinct before: the alignment is the costly step."""
    schema = pairs.selectExpr("*", "cast(null as string) a_aln", "cast(null as string) b_aln").schema
    names = [*pairs.columns, "a_aln", "b_aln"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(a).to_pylist(), batch.column(b).to_pylist()
            full = [i for i, (p, q) in enumerate(zip(left, right, strict=True)) if p is not None and q is not None]
            rows: list = [(None, None)] * len(left)
            for i, found in zip(full, align_batch([left[i] for i in full], [right[i] for i in full]), strict=True):
                rows[i] = found
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=names)

    return spread(pairs).mapInArrow(run, schema)


HIT_SCHEMA = "qid string, sid string, identity double, alignment int, mismatches int, gaps int, qstart int, qend int, sstart int, send int, score double, strand string"


# Word sizes by segment, the constant segment's identity, and what a mismatch, a gap and each of its places cost.
WORD_SIZES = {"V": 7, "D": 5, "J": 5, "C": 5}
IDENTITIES = {"C": 100.0}
COSTS = (1, 5, 2)


def segment_hits(reads: DataFrame, germline: DataFrame, segment: str, evalue: float = 1e-3, keep: int = 10) -> DataFrame:
    """:func:`germline_hits` with the word size, costs and identity rule of a segment and hits up to an expected number by chance.

    A score s by chance is expected m n exp(-s ln 3) / 3 times among m bases
    of a read and n of the library (uniform bases, match 1, mismatch -1).
    """
    n = germline.agg(F.sum(F.length("seq"))).first()[0] or 0
    hits = germline_hits(reads, germline, WORD_SIZES[segment], keep, 1.0, IDENTITIES.get(segment, 0.0), COSTS)
    sizes = reads.select(F.col("id").alias("_i"), F.length("seq").alias("_m"))
    expected = F.col("_m") * n * F.exp(-F.log(F.lit(3.0)) * F.col("score")) / 3
    return hits.join(sizes, F.col("qid") == F.col("_i")).where(expected <= evalue).drop("_i", "_m")


def germline_hits(reads: DataFrame, germline: DataFrame, k: int = 11, keep: int = 10, least: float = 20.0, least_identity: float = 0.0, costs: tuple[int, int, int] | None = None) -> DataFrame:
    """Hits of each read in a germline library, best first: the columns of a hit table and ``hit_rank``.

    ``reads`` has ``id, seq``, ``germline`` ``allele, seq``. Alleles that share
    most k-mers on a diagonal are aligned with the read (its reverse
    complement on the minus strand); a score is a match more and three less
    for a mismatch or a gap's place, or what ``costs`` take for a mismatch, a
    gap and each of its places; hits under ``least``, or under
    ``least_identity`` percent, are dropped. Subject ends come in falling
    order on the minus strand; query ends refer to the read as given. Equal
    reads are searched and aligned once.
    """
    from pyspark.sql import Window

    from lymphlake.functions.seq import revcomp
    from lymphlake.operators.hits import seed_votes

    once = reads.groupBy(F.upper("seq").alias("seq")).agg(F.min("id").alias("id"))
    votes = seed_votes(once, germline, k, keep)
    rows = votes.join(once.select(F.col("id").alias("_i"), F.col("seq").alias("read")), F.col("id") == F.col("_i")).join(germline.select(F.col("allele").alias("_a"), F.upper("seq").alias("gene")), F.col("allele") == F.col("_a"))
    rows = rows.select("id", "allele", "strand", F.when(F.col("strand") == "plus", F.col("read")).otherwise(revcomp(F.col("read"))).alias("read"), "gene")

    mismatch, opened, place = costs or (3, 0, 3)
    gaps_of_path = {} if costs is None else {"gap_open": opened, "gap_extend": place}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            paths = align_batch(columns[3], columns[4], **gaps_of_path)
            for name, allele, strand, read, path in zip(*columns[:4], paths, strict=True):
                a, b = (np.frombuffer(x.encode(), np.uint8) for x in path)
                both = np.flatnonzero((a != 45) & (b != 45))
                if not len(both):
                    continue
                part = slice(both[0], both[-1] + 1)
                same, gap = a[part] == b[part], (a[part] == 45) | (b[part] == 45)
                # the best stretch of the path
                opens = gap & ~np.concatenate([[False], gap[:-1]])
                gain = np.cumsum(np.where(same, 1, np.where(gap, -place, -mismatch)) - opened * opens)
                low = np.minimum.accumulate(np.concatenate([[0], gain[:-1]]))
                end = int((gain - low).argmax())
                begin = int(np.concatenate([[0], gain[:-1]])[: end + 1].argmin())
                s = slice(part.start + begin, part.start + end + 1)
                n, gaps, matches = end + 1 - begin, int(gap[begin : end + 1].sum()), int(same[begin : end + 1].sum())
                q0, s0 = int((a[: s.start] != 45).sum()) + 1, int((b[: s.start] != 45).sum()) + 1
                q1, s1 = int((a[: s.stop] != 45).sum()), int((b[: s.stop] != 45).sum())
                if strand == "minus":
                    q0, q1, s0, s1 = len(read) - q1 + 1, len(read) - q0 + 1, s1, s0
                out.append((name, allele, 100.0 * matches / n, n, n - matches - gaps, gaps, q0, q1, s0, s1, float((gain - low)[end]), strand))
            kinds = (pa.string(), pa.string(), pa.float64(), *[pa.int32()] * 7, pa.float64(), pa.string())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in HIT_SCHEMA.split(", ")])

    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), F.desc("identity"), "sid"))
    hits = spread(rows).mapInArrow(run, HIT_SCHEMA).where((F.col("score") >= least) & (F.col("identity") >= least_identity)).withColumn("hit_rank", rank)
    equal = reads.select(F.col("id").alias("_of"), F.upper("seq").alias("_s")).join(once, F.col("_s") == F.col("seq")).select("_of", F.col("id").alias("_first"))
    return hits.join(equal, F.col("qid") == F.col("_first")).select(F.col("_of").alias("qid"), *hits.columns[1:])


def identity_divergence(reads: DataFrame, germline: DataFrame, antibodies: DataFrame, most_antibodies: int = 500) -> DataFrame:
    """``sequence_id, referent, identity, coverage``: each read against its germline and every known antibody.

    ``reads`` has ``sequence_id, v_call, seq``, ``germline`` ``allele, seq``,
    ``antibodies`` ``name, seq``: a donor's antibodies, a list that every read
    is held against; more than ``most_antibodies`` are an error.
    Distinct (seq, target) pairs are aligned once and joined back.
    """
    from lymphlake.functions.seq import identity

    own = reads.join(germline.select(F.col("allele").alias("_a"), F.col("seq").alias("target")), F.split_part("v_call", F.lit(","), F.lit(1)) == F.col("_a")).select("sequence_id", "seq", F.lit("germline").alias("referent"), "target")
    known = antibodies.select("name", "seq").limit(most_antibodies + 1).collect()
    if len(known) > most_antibodies:
        raise ValueError(f"more than {most_antibodies} known antibodies")
    rows = own
    if known:
        listed = F.array(*[F.struct(F.lit(r["name"]).alias("name"), F.lit(r["seq"]).alias("seq")) for r in known])
        others = reads.select("sequence_id", "seq", F.explode(listed).alias("k"))
        rows = own.unionByName(others.select("sequence_id", "seq", F.col("k.name").alias("referent"), F.col("k.seq").alias("target")))
    found = aligned(rows.select(F.col("seq").alias("_s"), F.col("target").alias("_t")).distinct(), "_s", "_t")
    found = found.select("_s", "_t", identity(F.col("a_aln"), F.col("b_aln"), internal_gaps=True).alias("i"))
    return rows.join(found, (F.col("seq") == F.col("_s")) & (F.col("target") == F.col("_t"))).select("sequence_id", "referent", F.round(F.col("i.identity") * 100, 4).alias("identity"), F.round(F.col("i.aligned") / F.length("target") * 100, 4).alias("coverage"))


def neighbour_joining(names: list[str], distance: np.ndarray) -> list[tuple[str | int, str | int]]:
    """Merges of neighbour joining in order; merge i makes node i of later merges."""
    nodes: list = list(names)
    d = distance.astype(np.float64).copy()
    merges = []
    while len(nodes) > 2:
        n = len(nodes)
        total = d.sum(axis=1)
        q = (n - 2) * d - total[:, None] - total[None, :]
        np.fill_diagonal(q, np.inf)
        i, j = divmod(int(q.argmin()), n)
        i, j = min(i, j), max(i, j)
        new = (d[i] + d[j] - d[i, j]) / 2
        keep = [k for k in range(n) if k not in (i, j)]
        merges.append((nodes[i], nodes[j]))
        d = np.block([[d[np.ix_(keep, keep)], new[keep][:, None]], [new[keep][None, :], np.zeros((1, 1))]])
        nodes = [nodes[k] for k in keep] + [len(merges) - 1]
    merges.append((nodes[0], nodes[-1]))
    return merges


def near_antibodies(names: list[str], seqs: list[str], natives: set[str], root: str) -> set[str]:
    """Leaves of the smallest subtree that holds all natives, in a tree by k-mer distance that is rooted on ``root``."""
    grams = [{s[i : i + 6] for i in range(max(1, len(s) - 5))} for s in seqs]
    column = {g: i for i, g in enumerate(sorted(set().union(*grams)))}
    has = np.zeros((len(seqs), len(column)), np.float32)
    for i, found in enumerate(grams):
        has[i, [column[g] for g in found]] = 1
    both, sizes = has @ has.T, has.sum(axis=1)
    merges = neighbour_joining(names, 1 - both / np.maximum(1, sizes[:, None] + sizes[None, :] - both))
    near: dict = {}
    for i, (a, b) in enumerate(merges):
        for x in (a, b) if i + 1 < len(merges) else ():
            near.setdefault(("n", i), set()).add(("n", x) if isinstance(x, int) else ("l", x))
    adjacent: dict = {}
    for a, bs in near.items():
        for b in bs:
            adjacent.setdefault(a, set()).add(b)
            adjacent.setdefault(b, set()).add(a)
    a, b = (("n", x) if isinstance(x, int) else ("l", x) for x in merges[-1])
    adjacent.setdefault(a, set()).add(b)
    adjacent.setdefault(b, set()).add(a)

    best: set[str] = set(names)
    stack, order, parent = [("l", root)], [], {("l", root): None}
    while stack:
        node = stack.pop()
        order.append(node)
        for x in adjacent.get(node, ()):
            if x not in parent:
                parent[x] = node
                stack.append(x)
    below: dict = {}
    for node in reversed(order):
        leaves = {node[1]} if node[0] == "l" else set()
        for x in adjacent.get(node, ()):
            if parent.get(x) == node:
                leaves |= below[x]
        below[node] = leaves
        if natives <= leaves and len(leaves) < len(best):
            best = leaves
    return best - {root}


def sieve(reads: DataFrame, natives: DataFrame, germline: tuple[str, str], batch: int = 250, rounds: int = 15, enough: float = 0.95, seed: int = 0, most_natives: int = 500) -> DataFrame:
    """Reads that stay with the known antibodies: repeated trees over shuffled batches.

    ``reads`` and ``natives`` have ``id, seq``. Each round deals the reads to
    batches of about ``batch`` by a hash, adds all natives and the germline,
    and keeps the leaves of the smallest subtree with all natives. It stops
    when a round keeps ``enough`` of its reads. A round is written to the
    shared folder; a batch is small, so a task holds one tree at a time.
    Every tree holds all natives, so more than ``most_natives`` are an error.
    """
    from lymphlake.plans.tables import written

    known = [(r["id"], r["seq"]) for r in natives.select("id", "seq").limit(most_natives + 1).collect()]
    if len(known) > most_natives:
        raise ValueError(f"more than {most_natives} known antibodies")
    known.sort()

    def keep(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, seqs = table.column("id").to_pylist(), table.column("seq").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        ids, seqs = [ids[i] for i in order], [seqs[i] for i in order]
        found = near_antibodies([*ids, *[k for k, _ in known], germline[0]], [*seqs, *[s for _, s in known], germline[1]], {k for k, _ in known}, germline[0])
        kept = [i for i, name in enumerate(ids) if name in found]
        return pa.table({"id": pa.array([ids[i] for i in kept], pa.string()), "seq": pa.array([seqs[i] for i in kept], pa.string())})

    left = written(reads.select(F.col("id").cast("string").alias("id"), "seq"), "sieve")
    n = left.count()
    for r in range(rounds):
        batches = max(1, -(-n // batch))
        dealt = left.withColumn("_b", F.pmod(F.xxhash64("id", F.lit(seed + r)), F.lit(batches)))
        left = written(dealt.groupBy("_b").applyInArrow(keep, "id string, seq string"), "sieve")
        kept = left.count()
        if kept == 0 or kept >= enough * n:
            break
        n = kept
    return left

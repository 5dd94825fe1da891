"""Substitution profiles of genes and their comparison."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.functions.seq import AMINO_ACIDS, jsd, letters, shannon, sub_label, translate_gapped, translate_nt
from lymphlake.operators.align import aligned
from lymphlake.plans.tables import written


def residues_from_reads(reads: DataFrame, germline: DataFrame) -> DataFrame:
    """``vgene, prof, read_id, pos, aa, germ_aa`` of reads, by places of their germline.

    ``reads`` has ``vgene, prof, read_id, seq``, ``germline`` ``vgene, seq`` (from
    the first base of a codon): nucleotides. Each read is aligned to its
    germline, ends free; what it has inserted is dropped, and a codon counts
    only if the read has all of its bases: three gaps are a gap, one or two an
    X. Equal pairs are aligned once. Genes that the library lacks and reads
    without a sequence have no residues.
    """
    genes = germline.select(F.col("vgene").alias("_v"), F.upper("seq").alias("_g"))
    rows = reads.select("vgene", "prof", "read_id", F.upper("seq").alias("_s")).join(genes, F.col("vgene") == F.col("_v"))
    pairs = aligned(rows.select(F.col("_s").alias("s"), F.col("_g").alias("g")).where(F.length("s") > 0).distinct(), "s", "g")
    at_germline = F.array_join(F.zip_with(letters(F.col("a_aln")), letters(F.col("b_aln")), lambda x, y: F.when(y != "-", x)), "")
    pairs = written(pairs.select("s", "g", translate_gapped(at_germline).alias("aa"), translate_nt(F.col("g")).alias("germ")), "aligned-pairs")  # a table of known size, for all that read the residues
    found = rows.join(pairs, (F.col("_s") == F.col("s")) & (F.col("_g") == F.col("g"))).where(F.length("aa") > 0)
    places = found.select("vgene", "prof", "read_id", "germ", F.posexplode(letters(F.col("aa"))).alias("_i", "aa"))
    return places.select("vgene", "prof", "read_id", (F.col("_i") + 1).alias("pos"), "aa", F.substr("germ", F.col("_i") + 1, F.lit(1)).alias("germ_aa"))


def build_profiles(residues: DataFrame, least: int = 300, mask: int = 0) -> DataFrame:
    """``vgene, prof, pos, germ, freq, profile`` from residues aligned to germline.

    ``residues`` has ``vgene, prof, read_id, pos, aa, germ_aa``. Gaps and X do
    not count; ``freq`` is the share of mutated residues, null where fewer
    than ``least`` are left or the position is masked (both are rounded to five
    digits, halves up); ``profile`` the shares
    of the 20 amino acids among the mutated. Counts per residue come first, so
    only at most 20 rows a position are shuffled again.
    """
    counts = residues.where(~F.col("aa").isin("-", "X")).groupBy("vgene", "prof", "pos", "aa", "germ_aa").agg(F.count(F.lit(1)).alias("n"))
    mutated = F.when(F.col("aa") != F.col("germ_aa"), F.col("n")).otherwise(0)
    out = counts.groupBy("vgene", "prof", "pos").agg(
        F.array_sort(F.collect_set("germ_aa")).alias("germ"),
        F.sum("n").alias("depth"),
        F.sum(mutated).alias("mutated"),
        *[F.sum(F.when(F.col("aa") == a, mutated).otherwise(0)).alias(f"_{a}") for a in AMINO_ACIDS],
    )
    shares = F.array(*[F.when(F.col("mutated") > 0, F.round(F.col(f"_{a}") / F.col("mutated") + 1e-9, 5)).otherwise(0.0) for a in AMINO_ACIDS])
    freq = F.when((F.col("pos") > mask) & (F.col("depth") >= least), F.round(F.col("mutated") / F.col("depth") + 1e-9, 5))
    return out.select("vgene", "prof", "pos", "germ", freq.alias("freq"), shares.alias("profile"))


def long_form(profiles: DataFrame) -> DataFrame:
    """``vgene, prof, pos, germ, freq, aa, p``."""
    return profiles.select("vgene", "prof", "pos", "germ", "freq", F.posexplode("profile").alias("_i", "p")).withColumn("aa", F.substr(F.lit(AMINO_ACIDS), F.col("_i") + 1, F.lit(1))).drop("_i")


def rarity(profiles: DataFrame) -> DataFrame:
    """``vgene, pos, aa, mean, std``: 1 - freq p over the profiles of a gene, germline residues left out."""
    rows = long_form(profiles.where(F.col("freq").isNotNull())).where(~F.array_contains("germ", F.col("aa")))
    value = 1 - F.col("freq") * F.col("p")
    return rows.groupBy("vgene", "pos", "aa").agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def average_profile(profiles: DataFrame) -> DataFrame:
    """``vgene, pos, freq, profile``: means over profiles, masked ones left out; a position masked in all has no freq."""
    return profiles.groupBy("vgene", "pos").agg(F.avg("freq").alias("freq"), F.array(*[F.coalesce(F.avg(F.when(F.col("freq").isNotNull(), F.col("profile")[i])), F.lit(0.0)) for i in range(20)]).alias("profile"))


def entropy(profiles: DataFrame) -> DataFrame:
    """``vgene, entropy``: base-2 entropy of positions, weighted by their freq."""
    rows = profiles.where(F.col("freq").isNotNull())
    return rows.groupBy("vgene").agg((F.sum(F.col("freq") * shannon(F.col("profile"))) / F.sum("freq")).alias("entropy"))


def _divergences(f1: np.ndarray, x: np.ndarray, f2: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weighted base-2 Jensen-Shannon divergences of one profile with many: ``f1`` positions, ``x`` positions x residues, ``f2`` and ``y`` with a first axis more; NaN marks a missing position."""

    def entropy(p: np.ndarray) -> np.ndarray:
        return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(axis=-1)

    both = ~np.isnan(f1) & ~np.isnan(f2)
    weight = np.where(both, (np.nan_to_num(f1) + np.nan_to_num(f2)) / 2, 0.0)
    jsd = entropy((x + y) / 2) - (entropy(x) + entropy(y)) / 2
    total = weight.sum(axis=1)
    return np.where(both.any(axis=1) & (total > 0), (weight * jsd).sum(axis=1) / np.where(total > 0, total, 1.0), np.nan)


def _dense(table: pa.Table, width: int) -> tuple[list[str], list[int], np.ndarray, np.ndarray]:
    """Freqs (NaN where missing) and normalised residues of a block's profiles by position."""
    n = table.num_rows
    freq, shares = np.full((n, width), np.nan), np.zeros((n, width, len(AMINO_ACIDS)))
    for i, (pos, f, p) in enumerate(zip(table.column("pos").to_pylist(), table.column("freq").to_pylist(), table.column("profile").to_pylist(), strict=True)):
        freq[i, pos] = f
        shares[i, pos] = p
    total = shares.sum(axis=2, keepdims=True)
    shares = np.where(total > 0, shares / np.where(total > 0, total, 1.0), 1.0 / len(AMINO_ACIDS))
    return table.column("vgene").to_pylist(), table.column("prof").to_pylist(), freq, shares


def _block_divergences(left: DataFrame, right: DataFrame, block: int = 64) -> DataFrame:
    """``v1, p1, v2, p2, d`` of all pairs of profiles that share a position: blocks of about ``block`` profiles meet, a pair of blocks in a task.

    Each profile is one row and is sent once to every block of the other side.
    """

    def packed(profiles: DataFrame) -> DataFrame:
        one = profiles.where(F.col("freq").isNotNull()).groupBy("vgene", "prof").agg(F.array_sort(F.collect_list(F.struct("pos", "freq", "profile"))).alias("all"))
        return written(one.select("vgene", F.col("prof").cast("long").alias("prof"), F.col("all.pos").alias("pos"), F.col("all.freq").alias("freq"), F.col("all.profile").alias("profile")), "profiles")

    def dealt(one: DataFrame, own: str, other: str, blocks: int, others: int) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        return one.select(F.pmod(F.xxhash64("vgene", "prof"), F.lit(blocks)).alias(own), each.alias(other), "vgene", "prof", "pos", "freq", "profile")

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        kinds = [("v1", pa.string()), ("p1", pa.int64()), ("v2", pa.string()), ("p2", pa.int64()), ("d", pa.float64())]
        if not a.num_rows or not b.num_rows:
            return pa.schema(kinds).empty_table()
        width = 1 + max(max(p) for t in (a, b) for p in t.column("pos").to_pylist())
        v1, p1, f1, x = _dense(a, width)
        v2, p2, f2, y = _dense(b, width)
        d = np.array([_divergences(f1[i], x[i], f2, y) for i in range(len(v1))])
        i, j = np.nonzero(~np.isnan(d))
        columns = [[v1[k] for k in i], [p1[k] for k in i], [v2[k] for k in j], [p2[k] for k in j], d[i, j]]
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])

    one = packed(left)
    two = packed(right)  # a table of its own even for equal sides: a cogroup needs columns that are told apart
    counts = [max(1, -(-p.count() // block)) for p in (one, two)]
    a, b = dealt(one, "b1", "b2", *counts), dealt(two, "b2", "b1", *counts[::-1])
    return a.groupBy("b1", "b2").cogroup(b.groupBy("b1", "b2")).applyInArrow(compare, "v1 string, p1 long, v2 string, p2 long, d double")


def compare_profiles(left: DataFrame, right: DataFrame, indels: DataFrame | None = None) -> DataFrame:
    """``v1, v2, jsd``: freq-weighted Jensen-Shannon divergence of all gene pairs, averaged over pairs of profiles.

    Genes times genes is the stated product, dealt with block by block
    (:func:`_block_divergences`); pairs without a common position are left out. With ``indels (gene, ins, dels)`` the positions that only one gene
    of a pair has are left out and the others renumbered first; a pair with a
    gene that is not listed has null.
    """
    a = left.where(F.col("freq").isNotNull()).select(F.col("vgene").alias("v1"), F.col("prof").alias("p1"), "pos", F.col("freq").alias("f1"), F.col("profile").alias("x"))
    b = right.where(F.col("freq").isNotNull()).select(F.col("vgene").alias("v2"), F.col("prof").alias("p2"), F.col("pos").alias("pos2"), F.col("freq").alias("f2"), F.col("profile").alias("y"))
    if indels is not None:
        # numbering of a position against one partner: skip what only one of the two has
        one = indels.select(F.col("gene").alias("g1"), F.col("ins").alias("i1"), F.col("dels").alias("d1"))
        two = indels.select(F.col("gene").alias("g2"), F.col("ins").alias("i2"), F.col("dels").alias("d2"))
        pairs = one.join(two, how="cross").select("g1", "g2", F.array_union(F.array_except("i1", "i2"), F.array_except("d2", "d1")).alias("cut1"), F.array_union(F.array_except("i2", "i1"), F.array_except("d1", "d2")).alias("cut2"))

        def renumbered(c, cut):
            return F.when(~F.array_contains(cut, F.col(c)), F.col(c) - F.size(F.filter(cut, lambda i: i < F.col(c))))

        a = a.join(pairs, F.col("v1") == F.col("g1")).withColumn("pos", renumbered("pos", F.col("cut1"))).where(F.col("pos").isNotNull()).select("v1", "p1", "pos", "f1", "x", F.col("g2").alias("to"))
        b = b.join(pairs, F.col("v2") == F.col("g2")).withColumn("pos2", renumbered("pos2", F.col("cut2"))).where(F.col("pos2").isNotNull()).select("v2", "p2", "pos2", "f2", "y", F.col("g1").alias("from"))
        rows = a.join(b, (F.col("pos") == F.col("pos2")) & (F.col("to") == F.col("v2")) & (F.col("from") == F.col("v1")))
    else:
        return _block_divergences(left, right).groupBy("v1", "v2").agg(F.avg("d").alias("jsd"))
    weight = (F.col("f1") + F.col("f2")) / 2
    per = rows.groupBy("v1", "v2", "p1", "p2").agg((F.sum(weight * jsd(F.col("x"), F.col("y"))) / F.sum(weight)).alias("d"))
    return per.groupBy("v1", "v2").agg(F.avg("d").alias("jsd"))


def jsd_matrix(profiles: DataFrame, genes: list[str]) -> DataFrame:
    """One row a gene and one column a gene: divergences, 0 on the diagonal."""
    long = compare_profiles(profiles, profiles)
    value = F.when(F.col("v1") == F.col("v2"), 0.0).otherwise(F.col("jsd"))
    return long.groupBy("v1").agg(*[F.max(F.when(F.col("v2") == g, value)).alias(g) for g in genes])


def rare_substitutions(residues: DataFrame, table: DataFrame, least: float = 0.995) -> DataFrame:
    """``vgene, read_id, pos, sub``: residues whose rarity reaches ``least``; genes without a profile have none.

    The rarity table has a few thousand rows a gene set at most; it is written,
    so that the planner decides by its size whether to broadcast it, and no
    residue is dealt by a place that all reads share.
    """
    rare = written(table.where(F.col("mean") >= least).select(F.col("vgene").alias("_v"), F.col("pos").alias("_p"), F.col("aa").alias("_a")), "rare")
    rows = residues.where(~F.col("aa").isin("-", "X")).join(rare, (F.col("vgene") == F.col("_v")) & (F.col("pos") == F.col("_p")) & (F.col("aa") == F.col("_a")))
    return rows.select("vgene", "read_id", "pos", sub_label(F.col("germ_aa"), F.col("pos"), F.col("aa")).alias("sub")).distinct()


def common_rare(rare: DataFrame, reads: DataFrame, percent: float = 5.0) -> DataFrame:
    """``vgene, pos, sub, n, percent`` of rare substitutions in at least ``percent`` of a gene's scored reads."""
    total = reads.groupBy(F.col("vgene").alias("_v")).agg(F.countDistinct("read_id").alias("_n"))
    counts = rare.groupBy("vgene", "pos", "sub").agg(F.countDistinct("read_id").alias("n"))
    return counts.join(total, F.col("vgene") == F.col("_v")).select("vgene", "pos", "sub", "n", (F.col("n") * 100.0 / F.col("_n")).alias("percent")).where(F.col("percent") >= percent)


def logo_heights(profiles: DataFrame) -> DataFrame:
    """``vgene, prof, pos, aa, height, y_limit``: 100 freq p; masked positions are left out; the limit rounds up to tens."""
    rows = long_form(profiles.where(F.col("freq").isNotNull())).withColumn("height", 100 * F.col("freq") * F.col("p"))
    total = F.sum("height").over(Window.partitionBy("vgene", "prof", "pos"))
    limit = F.ceil(F.round(F.max(total).over(Window.partitionBy("vgene", "prof")), 6) / 10) * 10
    return rows.select("vgene", "prof", "pos", "aa", "height", limit.cast("long").alias("y_limit")).where(F.col("p") > 0)


def sub_profiles(reads: DataFrame, draws: int, n: int, seed: int = 0) -> DataFrame:
    """``vgene, draw, read_id``: ``draws`` samples of ``n`` of each gene's distinct reads without replacement.

    The order of a draw is the md5 of id, draw and seed. Its first n are below
    a bound that follows from the gene's number of reads, since an md5 is even:
    only rows below it are made distinct and sorted. A gene that has fewer than
    n of them in a draw takes a bound eight times as high, up to all of its rows.
    """
    rows = reads.select("vgene", "read_id").withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    rows = rows.withColumn("_md5", F.md5(F.concat_ws(":", F.col("read_id").cast("string"), F.col("draw").cast("string"), F.lit(str(seed)))))
    place = F.conv(F.substring("_md5", 1, 8), 16, 10).cast("double") / 2.0**32
    rank = F.row_number().over(Window.partitionBy("vgene", "draw").orderBy("_md5", "read_id"))
    genes = reads.groupBy(F.col("vgene").alias("_v")).agg(F.approx_count_distinct("read_id").alias("_reads"))
    bounds = written(genes.select("_v", F.least(F.lit(1.0), (4 * n + 100) / F.greatest(F.col("_reads"), F.lit(1))).alias("_bound")), "draw-bounds")
    out = None
    while True:
        below = rows.join(bounds, F.col("vgene").eqNullSafe(F.col("_v"))).where(place < F.col("_bound")).select("vgene", "draw", "read_id", "_md5").distinct()
        found = written(below.withColumn("_n", rank).where(F.col("_n") <= n).select("vgene", "draw", "read_id"), "draws")
        full = found.groupBy("vgene", "draw").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == n).groupBy("vgene").agg(F.count(F.lit(1)).alias("_full")).where(F.col("_full") == draws).select(F.col("vgene").alias("_g"))
        short = bounds.where(F.col("_bound") < 1.0).join(full, F.col("_v").eqNullSafe(F.col("_g")), "left_anti")
        short = written(short.select("_v", F.least(F.lit(1.0), F.col("_bound") * 8).alias("_bound")), "draw-bounds")
        done = found.join(short.select(F.col("_v").alias("_s")), F.col("vgene").eqNullSafe(F.col("_s")), "left_anti")
        out = done if out is None else out.unionByName(done)
        if not short.take(1):
            return out.select("vgene", "read_id", "draw")
        bounds = short


def group_consensus(residues: DataFrame, group: str, pos: str, aa: str) -> DataFrame:
    """``group, consensus``: the most frequent residue of each place, ties to the first letter."""
    counts = residues.groupBy(group, pos, aa).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(group, pos).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(aa).alias("a")))["a"].alias("a"))
    return best.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), "a"))), lambda s: s["a"]), "").alias("consensus"))

"""Time points, replicates and the distances within a group of sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphlake.functions.seq import hamming


def union_repertoires(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables with ids made unique as ``id===source``; columns that a table lacks are null."""
    out = None
    for source, table in tables.items():
        mine = table.withColumns({"source_repertoire": F.lit(source), "sequence_id": F.concat("sequence_id", F.lit(f"==={source}"))})
        out = mine if out is None else out.unionByName(mine, allowMissingColumns=True)
    return out


def union_timepoints(table: DataFrame) -> DataFrame:
    """Ids prefixed by their time point's label."""
    return table.withColumn("sequence_id", F.concat(F.col("timepoint").cast("string"), F.lit("-"), F.col("sequence_id")))


def merged_timepoints(table: DataFrame, least: int = 1) -> DataFrame:
    """``junction`` with observations, time points, first and latest (ordinal), persistence and the birthday label."""
    out = table.groupBy("junction").agg(
        F.count(F.lit(1)).alias("n_observed"),
        F.countDistinct("time_ord").alias("n_timepoints"),
        F.min("time_ord").alias("first_ord"),
        F.max("time_ord").alias("last_ord"),
        F.min_by("label", F.struct("time_ord", "label")).alias("birthday"),
    )
    return out.withColumn("persist", F.col("last_ord") - F.col("first_ord") + 1).where(F.col("n_timepoints") >= least)


def persistence_labels(members: DataFrame) -> DataFrame:
    """``cluster, label``: earliest and latest time label of a cluster's members, one label if they are the same."""
    out = members.groupBy("cluster").agg(F.min_by("label", F.struct("time_ord", "label")).alias("a"), F.max_by("label", F.struct("time_ord", "label")).alias("b"))
    return out.select("cluster", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.concat("a", F.lit("-"), "b")).alias("label"))


def replicate_overlap(table: DataFrame, least: int = 2) -> DataFrame:
    """Sequences found in at least ``least`` replicates, with their abundance in all."""
    return table.groupBy("junction").agg(F.countDistinct("source_repertoire").alias("n_replicates"), F.sum("duplicate_count").alias("abundance")).where(F.col("n_replicates") >= least)


def replicate_correlation(table: DataFrame, replicates: list[str]) -> DataFrame:
    """``a, b, r``: Pearson correlation of abundances over unique sequences, 0 where one is absent."""
    wide = table.groupBy("junction").agg(*[F.sum(F.when(F.col("source_repertoire") == s, F.col("duplicate_count")).otherwise(0)).cast("double").alias(f"_r{i}") for i, s in enumerate(replicates)])
    pairs = [(i, j) for i in range(len(replicates)) for j in range(i + 1, len(replicates))]
    one = wide.agg(*[F.corr(f"_r{i}", f"_r{j}").alias(f"_c{i}_{j}") for i, j in pairs])
    return one.select(F.explode(F.array(*[F.struct(F.lit(replicates[i]).alias("a"), F.lit(replicates[j]).alias("b"), F.col(f"_c{i}_{j}").alias("r")) for i, j in pairs])).alias("p")).select("p.*")


def pair_identity(members: DataFrame) -> DataFrame:
    """``cluster, a, b, identity`` for all pairs of distinct sequences of a cluster; a is before b.

    Sequences of one length are compared place by place, others by edit
    distance over the longer length; of an empty sequence with itself there is no pair.
    ``members`` has ``cluster, id, seq``. A stated product within clusters:
    meant for the representatives of a branch, of which there are few. Equal
    sequences are one; the smallest id stands for them.
    """
    one = members.groupBy("cluster", "seq").agg(F.min("id").alias("id"))
    other = one.select(F.col("cluster").alias("_c"), F.col("id").alias("b"), F.col("seq").alias("_s"))
    pairs = one.join(other, (F.col("cluster") == F.col("_c")) & (F.col("id") < F.col("b")))
    apart = F.when(F.length("seq") == F.length("_s"), hamming(F.col("seq"), F.col("_s"))).otherwise(F.levenshtein("seq", "_s"))
    return pairs.select("cluster", F.col("id").alias("a"), "b", (1 - apart / F.greatest(F.length("seq"), F.length("_s"))).alias("identity"))


def medoids(pairs: DataFrame) -> DataFrame:
    """``cluster, id, total``: the member with the largest summed identity to the others; ties to the smaller id."""
    both = pairs.select("cluster", F.col("a").alias("id"), "identity").unionByName(pairs.select("cluster", F.col("b").alias("id"), "identity"))
    sums = both.groupBy("cluster", "id").agg(F.round(F.sum("identity"), 9).alias("total"))
    return sums.groupBy("cluster").agg(F.min(F.struct((-F.col("total")).alias("t"), F.col("id").alias("i"))).alias("m")).select("cluster", F.col("m.i").alias("id"), (-F.col("m.t")).alias("total"))

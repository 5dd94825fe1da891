"""Dereplication, clusters and clones, and what is reported of them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lymphlake.functions.seq import gene_of, hamming
from lymphlake.operators.order import ranked
from lymphlake.plans.tables import written


def dereplicate(reads: DataFrame, id_column: str = "id", seq_column: str = "seq", size_column: str = "size", least: int = 1) -> DataFrame:
    """``seq, size, n, id``: equal sequences (case aside) with summed size; the representative is the most abundant, then the smallest id."""
    out = reads.groupBy(F.upper(seq_column).alias("seq")).agg(
        F.sum(size_column).alias("size"),
        F.count(F.lit(1)).alias("n"),
        F.min_by(id_column, F.struct(-F.col(size_column), F.col(id_column))).alias("id"),
    )
    return out.where(F.col("size") >= least)


def greedy_centroids(block: list[tuple[str, str]], least: float, band: int = 0) -> list[str]:
    """Centroid id of each (id, seq) of a block in its given order.

    A sequence joins the first centroid that it matches in ``least`` of the
    places; with ``band`` 0 lengths must be equal and places are compared one
    by one, else a banded alignment with all centroids at once allows that many gaps.
    """
    from lymphlake.operators.batch_align import banded_identities

    centroids: list[str] = []
    by_length: dict[int, tuple[np.ndarray, list[int]]] = {}
    out = []
    for name, seq in block:
        codes = np.frombuffer(seq.encode(), np.uint8)
        found = None
        if band == 0:
            known = by_length.get(len(codes))
            if known is not None and len(known[1]):
                same = (known[0][: len(known[1])] == codes).mean(axis=1) if len(codes) else np.ones(len(known[1]))
                hit = np.flatnonzero(same >= least - 1e-9)
                found = centroids[known[1][hit[0]]] if len(hit) else None
        else:
            near = []  # the first centroid within the band, over the lengths that it allows
            for n in range(len(codes) - band, len(codes) + band + 1):
                rows, places = by_length.get(n, (None, []))
                if places:
                    hit = np.flatnonzero(banded_identities(rows[: len(places)], codes, band) >= least - 1e-9)
                    near += [places[hit[0]]] if len(hit) else []
            found = centroids[min(near)] if near else None
        if found is None:
            found = name
            centroids.append(name)
            rows, places = by_length.get(len(codes), (np.empty((8, len(codes)), np.uint8), []))
            if len(places) == len(rows):
                rows = np.concatenate([rows, np.empty_like(rows)])
            rows[len(places)] = codes
            by_length[len(codes)] = (rows, [*places, len(centroids) - 1])
        out.append(found)
    return out


#: Distinct sequences of a block that one task clusters; larger blocks are clustered by rounds over all tasks.
BLOCK_ROWS = 4096


def greedy_rounds(rows: DataFrame, least: float) -> DataFrame:
    """``block, seq, centroid`` of greedy clusters without gaps: what :func:`greedy_centroids` gives for each block, over many tasks.

    ``rows`` has ``block, seq, first`` (its place in the order: a struct that
    ends in ``_id``); a block's sequences have one length. Sequences of n
    places that agree in ``least`` of them agree in one of floor((1 - least) n)
    + 1 pieces, so they share a bucket. A sequence that is the first open one
    in all of its buckets has no earlier neighbour that could be a centroid,
    and is one. The new centroids meet the open members of their buckets:
    those near one are no centroids and leave. In the end each of these gets
    the first centroid that it is near to. Only centroids meet members, so a
    dense group costs its size, and no bucket is capped. A round at least
    settles the first open sequence of every block.
    """
    n = F.length("seq")
    cuts = F.floor(n * (1 - least) + 1e-9).cast("int") + 1
    edge = lambda i: F.floor(i * n / cuts).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), cuts - 1), lambda i: F.struct(i.alias("at"), F.substr("seq", edge(i) + 1, edge(i + 1) - edge(i)).alias("piece")))
    all_rows = written(rows.select("block", "seq", "first", F.xxhash64("block", "seq").alias("k")), "greedy-rows")
    buckets = written(all_rows.select("block", "seq", "first", F.explode_outer(pieces).alias("p")).select("block", "seq", "first", F.xxhash64("block", "p").alias("bucket")), "greedy-buckets")
    same = (F.col("block") == F.col("_b")) & (hamming(F.col("seq"), F.col("_s")) <= (1 - least) * F.length("seq") + 1e-9)

    def near(members: DataFrame, centres: DataFrame) -> DataFrame:
        """Members with the centroids of their buckets that they are near to."""
        c = buckets.join(centres, ["block", "seq"], "left_semi").select(F.col("bucket").alias("_k"), F.col("block").alias("_b"), F.col("seq").alias("_s"), F.col("first").alias("_f"))
        return members.join(c, F.col("bucket") == F.col("_k")).where(same)

    open_, centres = buckets, None
    while open_.take(1):
        heads = open_.groupBy("bucket").agg(F.min("first").alias("head"))
        leads = open_.join(heads.withColumnRenamed("bucket", "_k"), F.col("bucket") == F.col("_k")).groupBy("block", "seq").agg(F.min((F.col("first") == F.col("head")).cast("int")).alias("leads"))
        new = written(leads.where("leads = 1").select("block", "seq"), "greedy-centroids")
        centres = new if centres is None else centres.unionByName(new)
        gone = near(open_, new).select("block", "seq").distinct()  # the centroids themselves among them
        open_ = written(open_.join(gone, ["block", "seq"], "left_anti"), "greedy-open")
    if centres is None:
        return rows.select("block", "seq", F.lit(None).cast("string").alias("centroid"))
    best = near(buckets, centres).groupBy("block", "seq").agg(F.min("_f").alias("best"))
    own = centres.withColumn("_own", F.lit(True))
    return best.join(all_rows.select("block", "seq", "first"), ["block", "seq"]).join(own, ["block", "seq"], "left").select("block", "seq", F.when(F.col("_own"), F.col("first._id")).otherwise(F.col("best._id")).alias("centroid"))


def cluster_blocks(table: DataFrame, keys: list[Column], id_column: str, seq_column: str, order: list[Column], least: float, band: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``sequence, id, centroid`` per block of ``keys``, greedy in ``order``; see :func:`greedy_centroids`.

    Equal sequences of a block are clustered once: only distinct ones enter
    the blocks, and the result is joined back, so copies never fill a task.
    The keys should split losslessly: for band 0 the length belongs to them.
    Rows without a sequence are left out. A block of up to ``block_rows`` distinct sequences is clustered in one
    task; without gaps larger ones go through :func:`greedy_rounds`, with the
    same result.
    """
    named = {f"_k{i}": k for i, k in enumerate(keys)}
    rows = table.select(*[k.alias(n) for n, k in named.items()], F.col(id_column).alias("_id"), F.col(seq_column).alias("_seq"), F.struct(*order).alias("_order")).where(F.col("_seq").isNotNull())
    names = list(named)
    distinct = rows.groupBy(*names, "_seq").agg(F.min(F.struct("_order", "_id")).alias("_first"))
    ordered = distinct.select(F.struct(*names).alias("_block"), "_seq", "_first")
    large = None
    if band == 0:
        ordered = written(ordered, "blocks")
        sizes = written(ordered.groupBy(F.col("_block").alias("_large")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows).select("_large"), "blocks-large")
        if sizes.take(1):
            is_large = F.col("_block") == F.col("_large")
            large = greedy_rounds(ordered.join(sizes, is_large, "left_semi").select(F.to_json("_block").alias("block"), F.col("_seq").alias("seq"), F.col("_first").alias("first")), least)
            ordered = ordered.join(sizes, is_large, "left_anti")
    dealt = ordered.repartition("_block").sortWithinPartitions("_block", "_first").select(F.to_json("_block").alias("_block"), "_seq", F.col("_first._id").alias("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def flush() -> pa.RecordBatch:
            found = greedy_centroids([(i, s) for s, i in held], least, band)
            return pa.RecordBatch.from_arrays([pa.array([last] * len(held)), pa.array([s for s, _ in held]), pa.array(found)], names=["_b", "_s", "centroid"])

        for batch in batches:
            for block, seq, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != last:
                    if held:
                        yield flush()
                    last, held = block, []
                held.append((seq, name))
        if held:
            yield flush()

    found = dealt.mapInArrow(run, "_b string, _s string, centroid string")
    if large is not None:
        found = found.unionAll(large)
    mine = rows.withColumn("_m", F.to_json(F.struct(*names)))
    return mine.join(found, (F.col("_m") == F.col("_b")) & (F.col("_seq") == F.col("_s"))).select(F.col("_id").alias(id_column), F.col("_seq").alias(seq_column), "centroid")


def clone_clusters(table: DataFrame, least: float = 0.9, lookup: DataFrame | None = None) -> DataFrame:
    """``sequence_id, junction, centroid``: junctions clustered within V gene, J gene and length.

    Without gaps and with fixed ends only junctions of one length can join,
    so the length is a lossless block key. Centroids are taken in order of
    duplicate_count, then id. With ``lookup (allele, cluster)`` the V alleles
    are grouped by it and J does not matter.
    """
    order = [(-F.col("duplicate_count")).alias("a"), F.col("sequence_id").alias("b")]
    if lookup is not None:
        table = gene_clusters(table, lookup)
        keys = [F.col("gene_cluster"), F.length("junction")]
    else:
        keys = [gene_of(F.col("v_call")), gene_of(F.col("j_call")), F.length("junction")]
    return cluster_blocks(table, keys, "sequence_id", "junction", order, least)


def gene_clusters(table: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds ``gene_cluster``: the lookup's cluster of the first V allele, else its gene. One row an allele in the lookup."""
    first = F.split_part("v_call", F.lit(","), F.lit(1))
    small = lookup.select(F.col("allele").alias("_a"), F.col("cluster").alias("_c"))
    return table.withColumn("_v", first).join(small, F.col("_v") == F.col("_a"), "left").withColumn("gene_cluster", F.coalesce("_c", gene_of(F.col("v_call")))).drop("_v", "_a", "_c")


def exact_clones(table: DataFrame) -> DataFrame:
    """``v_gene, j_gene, junction`` with rows, abundance, samples and time points: clones of equal junctions."""
    return table.groupBy(gene_of(F.col("v_call")).alias("v_gene"), gene_of(F.col("j_call")).alias("j_gene"), "junction").agg(
        F.count(F.lit(1)).alias("clone_count"),
        F.sum("duplicate_count").alias("abundance"),
        F.countDistinct("source_repertoire").alias("n_sources"),
        F.countDistinct("timepoint").alias("n_timepoints"),
        F.min("sequence_id").alias("centroid"),
    )


def numbered(clones: DataFrame, size: str = "clone_count", centroid: str = "centroid", first: int = 1) -> DataFrame:
    """Adds ``clone_id``: rank by size, then centroid, as five digits or, from 100,000 on, more.

    The clones are written first, so that the reads are aggregated once. The
    order is cut into ranges of (size, centroid), so a size that most clones
    share fills no task.
    """
    out = ranked(written(clones, "clones"), [F.desc(size), F.asc(centroid)], "_rank", first)
    return out.withColumn("clone_id", F.format_string("%05d", "_rank")).drop("_rank")


def numbered_keeping(clones: DataFrame, old: DataFrame, size: str = "clone_count") -> DataFrame:
    """As :func:`numbered`, but clones whose centroid is in ``old (centroid, clone_id)`` keep that id; new ones follow the largest."""
    last = old.agg(F.max(F.col("clone_id").cast("long"))).first()[0] or 0
    kept = clones.join(old.select(F.col("centroid").alias("_c"), "clone_id"), F.col("centroid") == F.col("_c")).drop("_c")
    new = clones.join(old.select(F.col("centroid").alias("_c")), F.col("centroid") == F.col("_c"), "left_anti")
    return kept.unionByName(numbered(new, size, first=int(last) + 1))


def two_step_sizes(level_one: DataFrame, level_two: DataFrame, least: int = 2) -> DataFrame:
    """``sequence_id, centroid, cluster_count``: the centroid of the centroid, with the first level's as fallback.

    ``level_one`` has ``sequence_id, centroid, size``, ``level_two`` ``sequence_id,
    centroid`` of first-level centroids. ``cluster_count`` is the total size on
    the final centroid's own row, if it reaches ``least``; else null.
    """
    up = level_two.select(F.col("sequence_id").alias("_s"), F.col("centroid").alias("_up"))
    rows = level_one.join(up, F.col("centroid") == F.col("_s"), "left").select("sequence_id", F.coalesce("_up", "centroid").alias("centroid"), "size")
    totals = rows.groupBy(F.col("centroid").alias("_t")).agg(F.sum("size").alias("_total"))
    joined = rows.join(totals, F.col("centroid") == F.col("_t"))
    return joined.select("sequence_id", "centroid", F.when((F.col("sequence_id") == F.col("centroid")) & (F.col("_total") >= least), F.col("_total")).alias("cluster_count"))


def source_breakdown(members: DataFrame, sources: list[str]) -> DataFrame:
    """Members per clone in all and per source as ``a:b:c`` in the given order, and the number of sources that have any."""
    counts = [F.count(F.when(F.col("source_repertoire") == s, 1)) for s in sources]
    out = members.groupBy("clone").agg(F.count(F.lit(1)).alias("clone_count"), F.array(*counts).alias("_per"))
    return out.select("clone", "clone_count", F.array_join(F.transform("_per", lambda n: n.cast("string")), ":").alias("per_source"), F.size(F.filter("_per", lambda n: n > 0)).alias("n_sources"))


def write_back(table: DataFrame, assigned: DataFrame) -> DataFrame:
    """Every input row with its ``clone_id, clone_count``; rows without a clone have nulls."""
    mine = assigned.select(F.col("sequence_id").alias("_s"), F.col("clone_id").alias("_id"), F.col("clone_count").alias("_n"))
    return table.drop("clone_id", "clone_count").join(mine, F.col("sequence_id") == F.col("_s"), "left").withColumnsRenamed({"_id": "clone_id", "_n": "clone_count"}).drop("_s")


def functional_lineages(table: DataFrame) -> DataFrame:
    """``clone, kind, functional_size, n_good``: functional, mixed or nonproductive lineages.

    Sizes count cluster_count, or 1 where there is none; the functional size
    leaves out rows that are not good.
    """
    size = F.coalesce(F.col("cluster_count"), F.lit(1)) if "cluster_count" in table.columns else F.lit(1)
    bad = F.col("status") == "nonproductive"
    good = F.col("status") == "good"
    return table.groupBy("clone").agg(
        F.when(F.min(bad.cast("int")) == 1, "nonproductive").when(F.max(bad.cast("int")) == 1, "mixed").otherwise("functional").alias("kind"),
        F.sum(F.when(good, size).otherwise(0)).cast("long").alias("functional_size"),
        F.count(F.when(good, 1)).alias("n_good"),
    )


def clone_filter(clones: DataFrame, least: int) -> DataFrame:
    return clones.where(F.col("clone_count") >= least)


def largest_clusters(members: DataFrame, least: float = 0.97, weight: str = "duplicate_count") -> DataFrame:
    """The members of each clone's largest cluster, by summed ``weight``; ties go to the smaller centroid.

    Distinct sequences of a clone and length are clustered greedily at
    ``least``, the most abundant first.
    """
    order = [(-F.col(weight)).alias("a"), F.col("sequence_id").alias("b")]
    found = cluster_blocks(members, [F.col("clone"), F.length("junction")], "sequence_id", "junction", order, least)
    named = members.join(found.select(F.col("sequence_id").alias("_s"), F.col("centroid").alias("_c")), F.col("sequence_id") == F.col("_s")).drop("_s")
    sizes = named.groupBy("clone", "_c").agg(F.sum(weight).alias("w"))
    best = sizes.groupBy(F.col("clone").alias("_k")).agg(F.min(F.struct((-F.col("w")).alias("w"), F.col("_c").alias("c")))["c"].alias("_best"))
    return named.join(best, (F.col("clone") == F.col("_k")) & (F.col("_c") == F.col("_best"))).drop("_k", "_c", "_best")


def near_identical(table: DataFrame, most: float = 0.1) -> DataFrame:
    """``a, b``: pairs of distinct junctions of one V and J gene and length that differ in at most ``most`` of their places.

    ``table`` has ``v, j, junction, id``. A junction of n places is cut into
    floor(most n) + 1 pieces; a pair within the limit agrees in one of them, so
    the join is on pieces and loses no pair. A pair that agrees in several is
    kept at the first.
    """
    n = F.length("junction")
    cuts = F.floor(n * most + 1e-9).cast("int") + 1
    edge = lambda i: F.floor(i * n / cuts).cast("int")
    cut = F.transform(F.sequence(F.lit(0), cuts - 1), lambda i: F.substr("junction", edge(i) + 1, edge(i + 1) - edge(i)))
    # written once: both sides read it, and the filter that Spark derives for the pieces stays behind the aggregate
    rows = written(table.select("v", "j", "id", "junction"), "junctions").select("v", "j", "id", "junction", cut.alias("pieces"))
    one = rows.select("v", "j", F.length("junction").alias("n"), F.col("id").alias("a"), F.col("junction").alias("x"), F.col("pieces").alias("p"), F.posexplode("pieces").alias("at", "piece"))
    two = one.select(*[F.col(c).alias(f"_{c}") for c in ("v", "j", "n", "at", "piece")], F.col("a").alias("b"), F.col("x").alias("y"), F.col("p").alias("q"))
    same = [F.col(c) == F.col(f"_{c}") for c in ("v", "j", "n", "at", "piece")]
    pairs = one.join(two, reduce(lambda x, y: x & y, same) & (F.col("a") < F.col("b")))
    first = F.array_position(F.transform(F.arrays_zip("p", "q"), lambda z: z["p"] == z["q"]), F.lit(True)) - 1
    return pairs.where((first == F.col("at")) & (hamming(F.col("x"), F.col("y")) <= most * F.col("n") + 1e-9)).select("a", "b")


def representatives(members: DataFrame, weight: str = "duplicate_count") -> DataFrame:
    """``clone, sequence_id, score``: the member of each clone that agrees most with the weighted residues of its places.

    Members of a clone have one length. Each place's residues are weighted by
    abundance; a member's score is the sum over its places; ties go to the
    smaller id. Equal members of a clone have one score, so they are summed
    before the shuffle and only distinct ones are taken apart. The weights of a
    clone, at most its length times the letters, are one row, which meets its
    distinct members whole: no place of a member is shuffled to be scored.
    """
    distinct = members.where(F.col("clone").isNotNull() & F.col("junction").isNotNull()).groupBy("clone", "junction").agg(F.min("sequence_id").alias("sequence_id"), F.sum(weight).alias("w"))
    distinct = written(distinct, "clone-members")
    letters = F.split("junction", "")
    weights = distinct.select("clone", "w", F.posexplode(letters).alias("pos", "aa")).groupBy("clone", "pos", "aa").agg(F.sum("w").alias("weight"))
    places = weights.groupBy("clone", "pos").agg(F.map_from_entries(F.collect_list(F.struct("aa", "weight"))).alias("of"))
    profile = places.groupBy(F.col("clone").alias("_c")).agg(F.map_from_entries(F.collect_list(F.struct("pos", "of"))).alias("of"))
    parts = F.filter(F.transform(letters, lambda aa, i: F.col("of")[i][aa]), lambda x: x.isNotNull())
    score = F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0).cast(weights.schema["weight"].dataType), lambda a, x: a + x))
    scored = distinct.join(profile, F.col("clone") == F.col("_c")).select("clone", "sequence_id", score.alias("score"))
    best = scored.groupBy("clone").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("sequence_id").alias("i"))).alias("b"))
    return best.select("clone", F.col("b.i").alias("sequence_id"), (-F.col("b.s")).alias("score"))

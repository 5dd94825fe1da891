"""Single cells: demultiplexing, chains per cell, cell status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lymphlake.plans.tables import written

PRODUCTIVE = ("good", "unique")
LOCI = ("IGH", "IGK", "IGL")
#: All statuses of a cell, in report order; fixed values.
CELL_STATUSES = ("canonical_pair", "heavy_only", "light_only", "possible_inclusion", "multi_light", "multi_heavy", "probable_multiplet", "none_productive")


def demultiplex(reads: DataFrame, oligos: DataFrame, most_oligos: int = 1000) -> DataFrame:
    """``cell, hash_sample, n_umis``: sample of each cell by the oligos that its UMIs' reads contain.

    ``oligos`` has ``place, oligo, sample``: one row an oligo of the kit; more
    than ``most_oligos`` are an error. The first oligo by place that a read
    contains names it. No sample is unknown, several are ambiguous.
    """
    kit = oligos.select("place", "oligo", "sample").orderBy("place", "oligo", "sample").limit(most_oligos + 1).collect()
    if len(kit) > most_oligos:
        raise ValueError(f"more than {most_oligos} oligos")
    pieces = F.array(*[F.struct(F.lit(r["oligo"]).alias("oligo"), F.lit(r["sample"]).alias("sample")) for r in kit])
    first = F.get(F.filter(pieces, lambda o: F.contains(F.col("seq"), o["oligo"])), F.lit(0))["sample"] if kit else F.lit(None).cast("string")
    named = reads.select("cell", "umi", first.alias("sample"))
    per = named.groupBy("cell").agg(F.countDistinct("sample").alias("n"), F.min("sample").alias("one"), F.countDistinct(F.when(F.col("sample").isNotNull(), F.col("umi"))).alias("n_umis"))
    return per.select("cell", F.when(F.col("n") > 1, "ambiguous").when(F.col("n") == 1, F.col("one")).otherwise("unknown").alias("hash_sample"), "n_umis")


def feature_counts(reads: DataFrame, names: list[str]) -> DataFrame:
    """Distinct UMIs per cell and feature, one column a feature, zeros filled; names are given so that one pass is enough."""
    return reads.groupBy("cell").agg(*[F.countDistinct(F.when(F.col("feature") == f, F.col("umi"))).alias(f) for f in sorted(names)])


def collapse_redundant(table: DataFrame, least: float = 0.97) -> DataFrame:
    """Merge redundant chains of a cell: counts go to the chain that is kept.

    Within a cell and locus, chains stand by duplicate_count (largest first)
    and id; a chain joins the first kept one of the same V and J gene whose
    junction of equal length agrees in at least ``least`` of its places. Equal
    junctions of the same genes always go together, so they are summed before
    the cells meet, and only distinct ones are clustered
    (:func:`clones.cluster_blocks`): a cell with many copies costs its distinct
    chains. Rows without a cell, gene or junction are like no other: each stays as it is.
    """
    from lymphlake.functions.seq import gene_of
    from lymphlake.operators.clones import cluster_blocks

    keys = ("cell_id", "locus", "v", "j", "junction")
    chains = table.select("cell_id", "locus", gene_of(F.col("v_call")).alias("v"), gene_of(F.col("j_call")).alias("j"), "junction", "sequence_id", "status", "duplicate_count")
    whole = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in ("cell_id", "v", "j", "junction")])
    first = F.min(F.struct((-F.col("duplicate_count")).alias("order"), "sequence_id", "status")).alias("first")
    equal = chains.where(whole).groupBy(*keys).agg(first, F.sum("duplicate_count").alias("total"), F.count(F.lit(1)).alias("n"))
    equal = written(equal.withColumn("k", F.monotonically_increasing_id().cast("string")), "cell-chains")
    block = [F.col("cell_id"), F.col("locus"), F.col("v"), F.col("j"), F.length("junction")]
    found = cluster_blocks(equal, block, "k", "junction", [F.col("first.order").alias("a"), F.col("first.sequence_id").alias("b")], least)
    sums = equal.select(F.col("k").alias("_k"), "total", "n").join(found.select("k", "centroid"), F.col("_k") == F.col("k")).groupBy("centroid").agg(F.sum("total").alias("duplicate_count"), F.sum("n").cast("int").alias("n_merged"))
    kept = equal.join(sums, F.col("k") == F.col("centroid")).select("cell_id", "locus", "first.sequence_id", "first.status", "junction", "duplicate_count", "n_merged")
    alone = chains.where(~whole).select("cell_id", "locus", "sequence_id", "status", "junction", "duplicate_count", F.lit(1).alias("n_merged"))
    return kept.unionByName(alone)


def chain_summary(table: DataFrame) -> DataFrame:
    """One row a cell: productive and all chains per locus, junctions, and the cell's status. Rows without a cell are left out."""
    good = F.col("status").isin(*PRODUCTIVE)
    counted = F.col("status").isin("good", "indel", "stop", "nonproductive", "unique")
    aggs = []
    for locus in LOCI:
        here = F.col("locus") == locus
        aggs += [
            F.count(F.when(here & good, 1)).alias(f"p_{locus}"),
            F.count(F.when(here & counted, 1)).alias(f"t_{locus}"),
            F.array_join(F.array_sort(F.collect_list(F.when(here & good, F.col("junction")))), ";").alias(f"junctions_{locus}"),
        ]
    cells = table.where(F.col("cell_id").isNotNull()).groupBy("cell_id").agg(*aggs)
    return cells.withColumn("cell_status", cell_status({x: F.col(f"p_{x}") for x in LOCI}, {x: F.col(f"t_{x}") for x in LOCI}))


def cell_status(p: dict[str, Column], t: dict[str, Column]) -> Column:
    """Status of a cell by its productive (p) and all (t) chains per locus."""
    light = p["IGK"] + p["IGL"]
    one = F.when(light == 0, "heavy_only").when(light == 1, "canonical_pair").when(light == 2, "possible_inclusion").otherwise("probable_multiplet")
    none = F.when(light == 0, "none_productive").when(light == 1, "light_only").otherwise("multi_light")
    return F.when((t["IGH"] > 2) | (t["IGK"] > 2) | (t["IGL"] > 2), "probable_multiplet").when(p["IGH"] == 0, none).when(p["IGH"] == 1, one).otherwise("multi_heavy")


def status_by_sample(cells: DataFrame) -> DataFrame:
    """Cells per sample and status, one column a status; samples without cells are not there."""
    return cells.groupBy("hash_sample").agg(*[F.count(F.when(F.col("cell_status") == s, 1)).alias(s) for s in CELL_STATUSES])


def saved_cells(cells: DataFrame, which: str = "good", multiplets: bool = False) -> DataFrame:
    """Cells that are kept: ``all``, ``good`` or ``paired``; those of ambiguous sample only along with multiplets."""
    keep = {"all": F.col("cell_status") != "none_productive", "good": F.col("cell_status").isin("canonical_pair", "heavy_only", "light_only", "possible_inclusion"), "paired": F.col("cell_status") == "canonical_pair"}
    rows = cells.where(keep[which])
    return rows if multiplets or "hash_sample" not in cells.columns else rows.where(F.coalesce("hash_sample", F.lit("unknown")) != "ambiguous")


def with_samples(cells: DataFrame, samples: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Cells with their sample (missing: unknown) and feature counts (missing: 0)."""
    out = cells.join(samples.select(F.col("cell").alias("_c"), "hash_sample"), F.col("cell_id") == F.col("_c"), "left").drop("_c").withColumn("hash_sample", F.coalesce("hash_sample", F.lit("unknown")))
    if features is not None:
        names = [c for c in features.columns if c != "cell"]
        out = out.join(features.withColumnRenamed("cell", "_c"), F.col("cell_id") == F.col("_c"), "left").drop("_c").fillna(0, subset=names)
    return out


def chain_edges(chains: DataFrame) -> DataFrame:
    """``a, b, n_cells``: pairs of chain clusters seen in one cell, the smaller first, with the number of such cells.

    The pairs of a cell are made from its array of distinct clusters, so the
    shuffle is by cell and no cell is joined with itself. Rows without a cell are left out.
    """
    cells = chains.where(F.col("cell_id").isNotNull()).select("cell_id", "cluster").distinct().groupBy("cell_id").agg(F.array_sort(F.collect_list("cluster")).alias("c"))
    pairs = F.flatten(F.transform("c", lambda x: F.transform(F.filter("c", lambda y: y > x), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return cells.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n_cells"))


def cells_with_clones(inputs: dict[str, DataFrame], clones: DataFrame) -> DataFrame:
    """Cell tables of several inputs one under the other, with ``source`` and each cell's ``clone``; cells without one have null.

    ``clones`` has ``source, cell_id, clone``. Columns that an input lacks are null.
    """
    out = None
    for source, cells in inputs.items():
        mine = cells.withColumn("source", F.lit(source))
        out = mine if out is None else out.unionByName(mine, allowMissingColumns=True)
    found = clones.select(F.col("source").alias("_s"), F.col("cell_id").alias("_c"), "clone")
    return out.join(found, (F.col("source") == F.col("_s")) & (F.col("cell_id") == F.col("_c")), "left").drop("_s", "_c")


def joint_clones(chains: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """``cell_id, clone``: clones of cells by heavy and light chains together.

    ``chains`` has ``cell_id, cluster``. Clusters seen in one cell are linked;
    a cell belongs to the only maximal clique that holds its whole chain set,
    a lone cluster is its own clone, any other cell stays without (null).
    Rows without a cell are left out.

    No clique is enumerated. A chain set is a clique itself; the maximal one
    around it is unique exactly if the clusters linked to all of its members
    are linked to each other, and consists of the set and of these. The common
    neighbours come from those of the member with the fewest links. Sets with
    the same whole are checked once, and only if each cluster has links
    enough; links are counted from the end that has fewer.
    """
    chains = chains.where(F.col("cell_id").isNotNull())
    edges = written(chain_edges(chains) if edges is None else edges, "cell-edges").select("a", "b")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = written(both.groupBy(F.col("a").alias("n")).agg(F.count(F.lit(1)).alias("degree")), "cell-degrees")
    sets = written(chains.select("cell_id", "cluster").distinct().groupBy("cell_id").agg(F.array_sort(F.collect_list("cluster")).alias("own")), "cell-sets")
    owns = written(sets.select("own").distinct().withColumn("o", F.monotonically_increasing_id()), "cell-chains")

    members = owns.select("o", F.size("own").alias("size"), F.explode("own").alias("m")).join(degree, F.col("m") == F.col("n"), "left").select("o", "size", "m", F.coalesce("degree", F.lit(0)).alias("degree"))
    members = written(members, "cell-members")
    fewest = members.groupBy("o", "size").agg(F.min(F.struct("degree", "m"))["m"].alias("lead"))
    near = fewest.join(both, F.col("lead") == F.col("a")).select("o", "size", "lead", F.col("b").alias("n"))
    near = near.join(members.select(F.col("o").alias("_o"), "m"), (F.col("o") == F.col("_o")) & (F.col("n") == F.col("m")), "left_anti")
    rest = near.where("size > 1").join(members.select(F.col("o").alias("_o"), "m"), (F.col("o") == F.col("_o")) & (F.col("m") != F.col("lead")))
    linked = rest.join(both, (F.col("m") == F.col("a")) & (F.col("n") == F.col("b"))).groupBy("o", "size", "n").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") == F.col("size") - 1)
    common = near.where("size = 1").select("o", "n").unionByName(linked.select("o", "n")).join(degree.withColumnRenamed("n", "_n"), F.col("n") == F.col("_n")).select("o", "n", "degree")
    whole = written(common.unionByName(members.select("o", F.col("m").alias("n"), "degree")), "cell-wholes")

    # equal wholes are told by their size and two hashes, so that none has to be gathered before it is known to be a clique
    marks = [F.bit_xor(F.xxhash64("n")).alias("h1"), F.bit_xor(F.xxhash64("n", F.lit(1))).alias("h2")]
    shapes = whole.groupBy("o").agg(F.count(F.lit(1)).alias("c"), F.min("degree").alias("least"), *marks).where(F.col("least") >= F.col("c") - 1)
    shapes = written(shapes, "cell-shapes")
    first = shapes.groupBy(*[F.col(x).alias(f"_{x}") for x in ("c", "h1", "h2")]).agg(F.min("o").alias("kind"))
    kinds = written(shapes.join(first, (F.col("c") == F.col("_c")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).select("o", "c", "kind"), "cell-kinds")
    once = whole.join(kinds.where("o = kind").select(F.col("o").alias("_o"), "c"), F.col("o") == F.col("_o")).select("o", "c", "n", "degree")
    from_fewer = both.join(degree.select(F.col("n").alias("_a"), F.col("degree").alias("da")), F.col("a") == F.col("_a")).join(degree.select(F.col("n").alias("_b"), F.col("degree").alias("db")), F.col("b") == F.col("_b"))
    from_fewer = from_fewer.where(F.struct("da", "a") < F.struct(F.col("db").alias("da"), F.col("b").alias("a"))).select("a", "b")
    inside = once.join(from_fewer, F.col("n") == F.col("a")).select("o", "b").join(once.select(F.col("o").alias("_o"), "n"), (F.col("o") == F.col("_o")) & (F.col("b") == F.col("n")), "left_semi")
    links = inside.groupBy(F.col("o").alias("_o")).agg(F.count(F.lit(1)).alias("links"))
    full = kinds.where("o = kind").join(links, F.col("o") == F.col("_o"), "left").where(F.coalesce("links", F.lit(0)) * 2 == F.col("c") * (F.col("c") - 1)).select(F.col("o").alias("_k"))
    named = once.join(full, F.col("o") == F.col("_k"), "left_semi").groupBy(F.col("o").alias("_k")).agg(F.array_join(F.array_sort(F.collect_list("n")), "+").alias("clone"))
    found = owns.join(kinds.select(F.col("o").alias("_o"), "kind"), F.col("o") == F.col("_o"), "left").join(named, F.col("kind") == F.col("_k"), "left").select(F.col("own").alias("_own"), "clone")
    return sets.join(found, F.col("own") == F.col("_own"), "left").select("cell_id", "clone")


def maximal_cliques(near: dict) -> list[set]:
    """Maximal cliques of a small graph, each once (recursion with a pivot): what tests hold :func:`joint_clones` against."""
    out: list[set] = []

    def grow(clique: set, open_: set, done: set) -> None:
        if not open_ and not done:
            out.append(clique)
            return
        pivot = max(sorted(open_ | done), key=lambda v: len(near[v] & open_))
        for v in sorted(open_ - near[pivot]):
            grow(clique | {v}, open_ & near[v], done & near[v])
            open_ = open_ - {v}
            done = done | {v}

    grow(set(), set(near), set())
    return out

"""Clones, clusters, longitudinal and replicate queries."""

from pyspark.sql import functions as F

from lymphlake.catalog.greedy import distinct_rows, greedy
from lymphlake.catalog.registry import query
from lymphlake.catalog.scalars import _translated
from lymphlake.functions.seq import gene_of, translate_nt
from lymphlake.operators import clones as C, longitudinal as L
from lymphlake.operators.graph import components
from lymphlake.plans.views import view

_EXACT = """x AS (SELECT split_part(v_call, '*', 1) AS v_gene, split_part(j_call, '*', 1) AS j_gene, junction, count(*) AS clone_count, CAST(sum(duplicate_count) AS BIGINT) AS abundance,
  count(DISTINCT source_repertoire) AS n_sources, count(DISTINCT timepoint) AS n_timepoints, min(sequence_id) AS centroid FROM rearrangements WHERE status = 'good' AND length(junction) >= 15 GROUP BY ALL)"""


def _exact(spark, d):
    from lymphlake.operators.rules import clone_input, junction_sane

    return C.exact_clones(junction_sane(clone_input(view(spark, d, "rearrangements"))))


@query("rearrangements", ctes_more=_EXACT, sql="SELECT *, printf('%05d', row_number() OVER (ORDER BY clone_count DESC, centroid)) AS clone_id FROM x")
def clone_ranking(spark, d):
    """Largest clones, and in how many samples and time points they were seen."""
    return C.numbered(_exact(spark, d))


@query(
    "rearrangements", ctes_more=_EXACT,
    sql="""SELECT centroid, clone_count, CASE WHEN CAST(centroid AS BIGINT) % 5 = 0 THEN printf('%05d', CAST(centroid AS BIGINT) % 90000)
      ELSE printf('%05d', (SELECT max(CAST(centroid AS BIGINT) % 90000) FROM x WHERE CAST(centroid AS BIGINT) % 5 = 0) + row_number() OVER (PARTITION BY CAST(centroid AS BIGINT) % 5 = 0 ORDER BY clone_count DESC, centroid)) END AS clone_id FROM x""",
)
def clone_ids_kept(spark, d):
    x = _exact(spark, d).select("centroid", "clone_count")
    n = F.col("centroid").cast("long")
    old = x.where(n % 5 == 0).select("centroid", F.format_string("%05d", n % 90000).alias("clone_id"))
    return C.numbered_keeping(x, old).select("centroid", "clone_count", "clone_id")


@query("rearrangements", sql="SELECT upper(junction) AS seq, CAST(sum(duplicate_count) AS BIGINT) AS size, count(*) AS n, arg_min(sequence_id, (-duplicate_count, sequence_id)) AS id FROM rearrangements GROUP BY ALL HAVING sum(duplicate_count) >= 10")
def dereplicate(spark, d):
    return C.dereplicate(view(spark, d, "rearrangements"), "sequence_id", "junction", "duplicate_count", 10)


@query(
    "rearrangements",
    sql="""SELECT a.sequence_id AS a, b.sequence_id AS b FROM u a JOIN u b ON a.v = b.v AND a.j = b.j AND length(a.junction) = length(b.junction) AND a.sequence_id < b.sequence_id
      WHERE hamming(a.junction, b.junction) <= 0.1 * length(a.junction)""",
    ctes_more="u AS (SELECT min(sequence_id) AS sequence_id, split_part(v_call, '*', 1) AS v, split_part(j_call, '*', 1) AS j, junction FROM rearrangements GROUP BY ALL)",
)
def near_identical_junctions(spark, d):
    """Edges of clone clustering: distinct junctions of a V/J group within 10 % of their places."""
    u = view(spark, d, "rearrangements").groupBy(gene_of(F.col("v_call")).alias("v"), gene_of(F.col("j_call")).alias("j"), "junction").agg(F.min("sequence_id").alias("id"))
    return C.near_identical(u)


_VJ = "split_part(v_call, '*', 1) || '|' || split_part(j_call, '*', 1) || '|' || length(junction)"
_V = "split_part(v_call, '*', 1) || '|' || length(junction)"
_CLUSTER = r"regexp_replace(v_call, '-\d\*.*', '') || '|' || length(junction)"
_LINEAGE = "CAST(length(junction) AS VARCHAR) || v_call"


@query("rearrangements", ctes_more=greedy(distinct_rows(_VJ), 0.9), sql=f"SELECT sequence_id, junction, centroid FROM rearrangements JOIN g ON g.block = {_VJ} AND g.seq = junction")
def clone_clustering(spark, d):
    """Greedy centroids at 90 % within V gene, J gene and length."""
    return C.clone_clusters(view(spark, d, "rearrangements"))


@query("rearrangements", ctes_more=greedy(distinct_rows(_CLUSTER), 0.9), sql=f"SELECT sequence_id, junction, centroid FROM rearrangements JOIN g ON g.block = {_CLUSTER} AND g.seq = junction")
def clone_clustering_by_gene_cluster(spark, d):
    t = view(spark, d, "rearrangements")
    lookup = t.select(F.col("v_call").alias("allele"), F.regexp_replace("v_call", r"-\d\*.*", "").alias("cluster")).distinct()
    return C.clone_clusters(t, lookup=lookup)


@query("rearrangements", sql="SELECT sequence_id, CASE WHEN regexp_matches(v_call, 'V[1-3]-') THEN 'c' || v_call[5:5] ELSE split_part(v_call, '*', 1) END AS gene_cluster FROM rearrangements")
def gene_cluster_lookup(spark, d):
    t = view(spark, d, "rearrangements")
    lookup = t.where(F.col("v_call").rlike("V[1-3]-")).select(F.col("v_call").alias("allele"), F.concat(F.lit("c"), F.substring("v_call", 5, 1)).alias("cluster")).distinct()
    return C.gene_clusters(t, lookup).select("sequence_id", "gene_cluster")


@query(
    "rearrangements",
    sql="""SELECT sequence_id, c AS centroid, CASE WHEN sequence_id = c AND t >= 40 THEN t END AS cluster_count FROM (SELECT *, CAST(sum(duplicate_count) OVER (PARTITION BY c) AS BIGINT) AS t FROM (
      SELECT sequence_id, duplicate_count, coalesce(b, a) AS c FROM (SELECT *, min(sequence_id) OVER (PARTITION BY junction) AS a FROM rearrangements)
      LEFT JOIN (SELECT a AS k, min(a) OVER (PARTITION BY p) AS b FROM (SELECT min(sequence_id) AS a, substr(junction, 1, 12) AS p FROM rearrangements GROUP BY junction) WHERE CAST(a AS BIGINT) % 10 <> 0) ON k = a))""",
)
def two_step_clusters(spark, d):
    t = view(spark, d, "rearrangements")
    one = t.groupBy("junction").agg(F.min("sequence_id").alias("centroid"))
    level_one = t.join(one.withColumnRenamed("junction", "_j"), F.col("junction") == F.col("_j")).select("sequence_id", "centroid", F.col("duplicate_count").alias("size"))
    kept = one.where(F.col("centroid").cast("long") % 10 != 0)
    two = kept.groupBy(F.substring("junction", 1, 12).alias("_p")).agg(F.min("centroid").alias("_m"))
    level_two = kept.join(two, F.substring("junction", 1, 12) == F.col("_p")).select(F.col("centroid").alias("sequence_id"), F.col("_m").alias("centroid"))
    return C.two_step_sizes(level_one, level_two, 40)


@query("rearrangements", sql="""SELECT junction AS clone, count(*) AS clone_count, count(*) FILTER (source_repertoire = 'src0') || ':' || count(*) FILTER (source_repertoire = 'src1') || ':' || count(*) FILTER (source_repertoire = 'src2') AS per_source,
  CAST(count(DISTINCT source_repertoire) AS INT) AS n_sources FROM rearrangements GROUP BY junction""")
def source_breakdown(spark, d):
    return C.source_breakdown(view(spark, d, "rearrangements").withColumn("clone", F.col("junction")), ["src0", "src1", "src2"])


@query("rearrangements", ctes_more=_EXACT, sql=f"""SELECT c.clone_id, x.centroid, r.v_call, r.j_call, length(r.junction) AS junction_length, {_translated('r.junction')} AS junction_aa, x.clone_count FROM x JOIN (SELECT centroid, printf('%05d', row_number() OVER (ORDER BY clone_count DESC, centroid)) AS clone_id FROM x) c USING (centroid) JOIN rearrangements r ON r.sequence_id = x.centroid""")
def lineage_table(spark, d):
    r = view(spark, d, "rearrangements").select(F.col("sequence_id").alias("_s"), "v_call", "j_call", F.length("junction").alias("junction_length"), translate_nt(F.col("junction")).alias("junction_aa"))
    return C.numbered(_exact(spark, d)).join(r, F.col("centroid") == F.col("_s")).select("clone_id", "centroid", "v_call", "j_call", "junction_length", "junction_aa", "clone_count")


@query("rearrangements", ctes_more=_EXACT, sql="""SELECT sequence_id, status, clone_id, clone_count FROM rearrangements LEFT JOIN (SELECT *, printf('%05d', row_number() OVER (ORDER BY clone_count DESC, centroid)) AS clone_id FROM x) x
  ON status = 'good' AND length(rearrangements.junction) >= 15 AND x.junction = rearrangements.junction AND x.v_gene = split_part(v_call, '*', 1) AND x.j_gene = split_part(j_call, '*', 1)""")
def clone_write_back(spark, d):
    from lymphlake.operators.rules import clone_input, junction_sane

    t = view(spark, d, "rearrangements")
    x = C.numbered(_exact(spark, d)).select("v_gene", "j_gene", F.col("junction").alias("_j"), "clone_id", "clone_count")
    members = junction_sane(clone_input(t)).join(x, (F.col("junction") == F.col("_j")) & (gene_of(F.col("v_call")) == F.col("v_gene")) & (gene_of(F.col("j_call")) == F.col("j_gene")))
    return C.write_back(t, members.select("sequence_id", "clone_id", "clone_count")).select("sequence_id", "status", "clone_id", "clone_count")


@query("rearrangements", sql="""SELECT junction AS clone, CASE WHEN bool_and(status = 'nonproductive') THEN 'nonproductive' WHEN bool_or(status = 'nonproductive') THEN 'mixed' ELSE 'functional' END AS kind,
  CAST(coalesce(sum(coalesce(cc, 1)) FILTER (status = 'good'), 0) AS BIGINT) AS functional_size, count(*) FILTER (status = 'good') AS n_good FROM (SELECT *, CASE WHEN duplicate_count > 3 THEN duplicate_count END AS cc FROM rearrangements) GROUP BY junction""")
def functional_lineages(spark, d):
    t = view(spark, d, "rearrangements").withColumns({"clone": F.col("junction"), "cluster_count": F.when(F.col("duplicate_count") > 3, F.col("duplicate_count"))})
    return C.functional_lineages(t)


@query("rearrangements", ctes_more=_EXACT, sql="SELECT centroid, clone_count FROM x WHERE clone_count >= 8")
def lineage_min_size(spark, d):
    return C.clone_filter(_exact(spark, d), 8).select("centroid", "clone_count")


@query(
    "rearrangements",
    sql="""SELECT clone, arg_min(sequence_id, (-score, sequence_id)) AS sequence_id, max(score) AS score FROM (SELECT p.clone, p.sequence_id, CAST(sum(w.weight) AS BIGINT) AS score FROM p JOIN w ON p.clone = w.clone AND p.pos = w.pos AND p.aa = w.aa GROUP BY ALL) GROUP BY clone""",
    ctes_more="""m AS (SELECT CAST(length(junction) AS VARCHAR) || v_call AS clone, * FROM rearrangements), p AS (SELECT clone, sequence_id, duplicate_count, i AS pos, substr(junction, CAST(i AS INT) + 1, 1) AS aa FROM (SELECT *, unnest(range(0, length(junction))) AS i FROM m)),
      w AS (SELECT clone, pos, aa, sum(duplicate_count) AS weight FROM p GROUP BY ALL)""",
)
def lineage_representative(spark, d):
    return C.representatives(view(spark, d, "rearrangements").withColumn("clone", F.concat(F.length("junction").cast("string"), F.col("v_call"))))


@query(
    "rearrangements",
    ctes_more=greedy(distinct_rows(_LINEAGE), 0.97) + f""", k AS (SELECT {_LINEAGE} AS clone, r.*, g.centroid FROM rearrangements r JOIN g ON g.block = {_LINEAGE} AND g.seq = junction),
      z AS (SELECT clone, arg_min(centroid, (-w, centroid)) AS centroid FROM (SELECT clone, centroid, sum(duplicate_count) AS w FROM k GROUP BY ALL) GROUP BY clone), m AS (SELECT k.* FROM k JOIN z ON z.clone = k.clone AND z.centroid = k.centroid),
      p AS (SELECT clone, sequence_id, duplicate_count, i AS pos, substr(junction, CAST(i AS INT) + 1, 1) AS aa FROM (SELECT *, unnest(range(0, length(junction))) AS i FROM m)), w AS (SELECT clone, pos, aa, sum(duplicate_count) AS weight FROM p GROUP BY ALL)""",
    sql="SELECT clone, arg_min(sequence_id, (-score, sequence_id)) AS sequence_id, max(score) AS score FROM (SELECT p.clone, p.sequence_id, CAST(sum(w.weight) AS BIGINT) AS score FROM p JOIN w ON p.clone = w.clone AND p.pos = w.pos AND p.aa = w.aa GROUP BY ALL) GROUP BY clone",
)
def largest_cluster_representative(spark, d):
    """Within each lineage's largest cluster at 97 %, the member that agrees most with its weighted residues."""
    members = view(spark, d, "rearrangements").withColumn("clone", F.concat(F.length("junction").cast("string"), F.col("v_call")))
    return C.representatives(C.largest_clusters(members))


def _timed(spark, d):
    return view(spark, d, "rearrangements").withColumns({"time_ord": F.col("timepoint") - 1990, "label": F.concat(F.lit("y"), F.col("timepoint").cast("string"))})


@query("rearrangements", sql="""SELECT junction, count(*) AS n_observed, count(DISTINCT timepoint) AS n_timepoints, min(timepoint) - 1990 AS first_ord, max(timepoint) - 1990 AS last_ord, 'y' || min(timepoint) AS birthday, max(timepoint) - min(timepoint) + 1 AS persist
  FROM rearrangements GROUP BY junction HAVING count(DISTINCT timepoint) >= 3""")
def merged_timepoints(spark, d):
    return L.merged_timepoints(_timed(spark, d), 3)


@query("rearrangements", sql="SELECT v_call || j_call AS cluster, CASE WHEN min(timepoint) = max(timepoint) THEN 'y' || min(timepoint) ELSE 'y' || min(timepoint) || '-y' || max(timepoint) END AS label FROM rearrangements GROUP BY 1")
def persistence_labels(spark, d):
    return L.persistence_labels(_timed(spark, d).withColumn("cluster", F.concat("v_call", "j_call")))


@query("rearrangements", sql="SELECT junction, count(DISTINCT source_repertoire) AS n_replicates, CAST(sum(duplicate_count) AS BIGINT) AS abundance FROM rearrangements GROUP BY junction HAVING count(DISTINCT source_repertoire) >= 2")
def replicate_overlap(spark, d):
    return L.replicate_overlap(view(spark, d, "rearrangements"))


@query(
    "rearrangements", ctes_more="w AS (SELECT junction, coalesce(sum(duplicate_count) FILTER (source_repertoire = 'src0'), 0) AS a, coalesce(sum(duplicate_count) FILTER (source_repertoire = 'src1'), 0) AS b, coalesce(sum(duplicate_count) FILTER (source_repertoire = 'src2'), 0) AS c FROM rearrangements GROUP BY junction)",
    sql="SELECT 'src0' AS a, 'src1' AS b, corr(a, b) AS r FROM w UNION ALL SELECT 'src0', 'src2', corr(a, c) FROM w UNION ALL SELECT 'src1', 'src2', corr(b, c) FROM w", rounded=("r",))
def replicate_correlation(spark, d):
    return L.replicate_correlation(view(spark, d, "rearrangements"), ["src0", "src1", "src2"])


@query("rearrangements", sql="SELECT source_repertoire, sequence_id || '===' || source_repertoire AS sequence_id FROM rearrangements WHERE source_repertoire IN ('src0', 'src2')")
def repertoire_union(spark, d):
    t = view(spark, d, "rearrangements")
    parts = {s: t.where(F.col("source_repertoire") == s).drop("source_repertoire") for s in ("src0", "src2")}
    return L.union_repertoires(parts).select("source_repertoire", "sequence_id")


@query("rearrangements", sql="SELECT timepoint || '-' || sequence_id AS sequence_id FROM rearrangements")
def timepoint_union(spark, d):
    return L.union_timepoints(view(spark, d, "rearrangements")).select("sequence_id")


_PAIRS = """u AS (SELECT split_part(v_call, '-', 1) AS cluster, junction AS seq, min(sequence_id) AS id FROM rearrangements GROUP BY ALL),
 q AS (SELECT a.cluster, a.id AS a, b.id AS b, 1 - CASE WHEN length(a.seq) = length(b.seq) THEN hamming(a.seq, b.seq) ELSE levenshtein(a.seq, b.seq) END / CAST(greatest(length(a.seq), length(b.seq)) AS DOUBLE) AS identity FROM u a JOIN u b ON a.cluster = b.cluster AND a.id < b.id)"""


def _pairs(spark, d):
    """Junctions of a V family, of several lengths."""
    return L.pair_identity(view(spark, d, "rearrangements").select(F.split_part("v_call", F.lit("-"), F.lit(1)).alias("cluster"), F.col("sequence_id").alias("id"), F.col("junction").alias("seq")))


@query("rearrangements", ctes_more=_PAIRS, sql="SELECT * FROM q")
def cdr3_pair_identity(spark, d):
    return _pairs(spark, d)


@query("rearrangements", ctes_more=_PAIRS, sql="SELECT cluster, arg_min(id, (-total, id)) AS id, max(total) AS total FROM (SELECT cluster, id, round(sum(identity), 9) AS total FROM (SELECT cluster, a AS id, identity FROM q UNION ALL SELECT cluster, b, identity FROM q) GROUP BY ALL) GROUP BY cluster")
def cluster_medoid(spark, d):
    return L.medoids(_pairs(spark, d))


@query(
    "rearrangements",
    ctes_more="""u AS (SELECT min(sequence_id) AS id, split_part(v_call, '*', 1) AS v, split_part(j_call, '*', 1) AS j, junction FROM rearrangements GROUP BY ALL),
      e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM u a JOIN u b ON a.v = b.v AND a.j = b.j AND length(a.junction) = length(b.junction) AND a.id <> b.id WHERE hamming(a.junction, b.junction) <= 0.1 * length(a.junction)),
      r AS (SELECT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach)""",
    sql="SELECT node, min(reach) AS component FROM r GROUP BY node",
)
def junction_components(spark, d):
    """Single-linkage clusters: components of near-identical junctions."""
    e = near_identical_junctions(spark, d)
    return components(e)


@query()
def length_order_clustering(spark, d):
    """Across time, longest first, up to two gaps: rows only; the invariants are tested."""
    t = view(spark, d, "rearrangements")
    order = [(-F.length("junction")).alias("a"), F.col("timepoint").alias("b"), F.col("sequence_id").alias("c")]
    return C.cluster_blocks(t, [gene_of(F.col("v_call")), gene_of(F.col("j_call"))], "sequence_id", "junction", order, 0.9, band=2)


@query("rearrangements", ctes_more=greedy(distinct_rows(_V), 0.99), sql=f"SELECT sequence_id, junction, centroid FROM rearrangements JOIN g ON g.block = {_V} AND g.seq = junction")
def abundance_clustering(spark, d):
    """Dereplicated reads clustered at 99 % within a V gene and length, most abundant first."""
    t = view(spark, d, "rearrangements")
    order = [(-F.col("duplicate_count")).alias("a"), F.col("sequence_id").alias("b")]
    return C.cluster_blocks(t, [gene_of(F.col("v_call")), F.length("junction")], "sequence_id", "junction", order, 0.99)

"""Single-cell and barcode queries."""

from pyspark.sql import functions as F

from lymphlake.catalog.greedy import greedy
from lymphlake.catalog.registry import query
from lymphlake.operators import barcodes as B, cells as S
from lymphlake.plans.views import view

_CELLS = """k AS (SELECT cell_id, count(*) FILTER (locus = 'IGH' AND status = 'good') AS ph, count(*) FILTER (locus = 'IGK' AND status = 'good') AS pk, count(*) FILTER (locus = 'IGL' AND status = 'good') AS pl,
  count(*) FILTER (locus = 'IGH' AND status IN ('good', 'indel', 'stop', 'nonproductive')) AS th, count(*) FILTER (locus = 'IGK' AND status IN ('good', 'indel', 'stop', 'nonproductive')) AS tk,
  count(*) FILTER (locus = 'IGL' AND status IN ('good', 'indel', 'stop', 'nonproductive')) AS tl,
  coalesce(string_agg(junction, ';' ORDER BY junction) FILTER (locus = 'IGH' AND status = 'good'), '') AS jh FROM rearrangements GROUP BY cell_id),
 c AS (SELECT *, CASE WHEN th > 2 OR tk > 2 OR tl > 2 THEN 'probable_multiplet' WHEN ph = 0 THEN CASE WHEN pk + pl = 0 THEN 'none_productive' WHEN pk + pl = 1 THEN 'light_only' ELSE 'multi_light' END
   WHEN ph = 1 THEN CASE WHEN pk + pl = 0 THEN 'heavy_only' WHEN pk + pl = 1 THEN 'canonical_pair' WHEN pk + pl = 2 THEN 'possible_inclusion' ELSE 'probable_multiplet' END ELSE 'multi_heavy' END AS cell_status FROM k)"""


@query("rearrangements", ctes_more=_CELLS, sql='SELECT cell_id, cell_status, ph AS "p_IGH", pk AS "p_IGK", pl AS "p_IGL", th AS "t_IGH", jh AS "junctions_IGH" FROM c')
def cell_summary(spark, d):
    return S.chain_summary(view(spark, d, "rearrangements")).select("cell_id", "cell_status", "p_IGH", "p_IGK", "p_IGL", "t_IGH", "junctions_IGH")


_BY_SAMPLE = ", ".join(f"count(*) FILTER (cell_status = '{s}') AS {s}" for s in S.CELL_STATUSES)


@query("rearrangements", ctes_more=_CELLS, sql=f"SELECT 'sample' || CAST(replace(cell_id, 'cell', '') AS INT) % 3 AS hash_sample, {_BY_SAMPLE} FROM c GROUP BY 1")
def cell_status_by_sample(spark, d):
    cells = S.chain_summary(view(spark, d, "rearrangements")).withColumn("hash_sample", F.concat(F.lit("sample"), (F.replace("cell_id", F.lit("cell"), F.lit("")).cast("int") % 3).cast("string")))
    return S.status_by_sample(cells)


@query("rearrangements", ctes_more=_CELLS, sql="SELECT cell_id, cell_status FROM c WHERE cell_status <> 'none_productive'")
def saved_cells(spark, d):
    return S.saved_cells(S.chain_summary(view(spark, d, "rearrangements")), "all").select("cell_id", "cell_status")


_KIT = "(VALUES (1, 'ACGT', 's1'), (2, 'TTAG', 's2'), (3, 'GGCA', 's3')) o(place, oligo, sample)"


@query(
    "umi_reads", ctes_more=f"n AS (SELECT r.cell, r.umi, (SELECT arg_min(sample, place) FROM {_KIT} WHERE contains(r.seq, oligo)) AS sample FROM umi_reads r)",
    sql="SELECT cell, CASE WHEN count(DISTINCT sample) > 1 THEN 'ambiguous' WHEN count(DISTINCT sample) = 1 THEN min(sample) ELSE 'unknown' END AS hash_sample, count(DISTINCT umi) FILTER (sample IS NOT NULL) AS n_umis FROM n GROUP BY cell",
)
def hash_demultiplex(spark, d):
    kit = spark.createDataFrame([(1, "ACGT", "s1"), (2, "TTAG", "s2"), (3, "GGCA", "s3")], "place int, oligo string, sample string")
    return S.demultiplex(view(spark, d, "umi_reads"), kit)


@query("umi_reads", sql="SELECT cell, count(DISTINCT umi) FILTER (feature = 'click') AS click, count(DISTINCT umi) FILTER (feature = 'purchase') AS purchase, count(DISTINCT umi) FILTER (feature = 'view') AS view FROM umi_reads GROUP BY cell")
def feature_counts(spark, d):
    return S.feature_counts(view(spark, d, "umi_reads"), ["view", "click", "purchase"])


@query(
    "rearrangements", "umi_reads", ctes_more=_CELLS,
    sql="SELECT c.cell_id, CASE WHEN u.cell IS NULL THEN 'unknown' ELSE 'a' END AS hash_sample, coalesce(u.n, 0) AS click FROM c LEFT JOIN (SELECT cell, count(DISTINCT umi) FILTER (feature = 'click') AS n FROM umi_reads GROUP BY cell) u ON u.cell = c.cell_id",
)
def cells_with_samples(spark, d):
    u = view(spark, d, "umi_reads")
    cells = S.chain_summary(view(spark, d, "rearrangements")).select("cell_id")
    return S.with_samples(cells, u.select("cell", F.lit("a").alias("hash_sample")).distinct(), S.feature_counts(u, ["click"]))


_CHAINS = """SELECT cell_id || '|' || locus || '|' || split_part(v_call, '*', 1) || '|' || split_part(j_call, '*', 1) || '|' || length(junction) AS block, junction AS seq, sequence_id AS id,
  row_number() OVER (PARTITION BY cell_id, locus, split_part(v_call, '*', 1), split_part(j_call, '*', 1), length(junction) ORDER BY duplicate_count DESC, sequence_id) AS rn FROM rearrangements"""


@query(
    "rearrangements", ctes_more=greedy(_CHAINS, 0.97),
    sql="""SELECT k.cell_id, k.locus, k.sequence_id, k.status, k.junction, t.duplicate_count, t.n_merged FROM (SELECT g.centroid, CAST(sum(r.duplicate_count) AS BIGINT) AS duplicate_count, CAST(count(*) AS INT) AS n_merged FROM g JOIN rearrangements r ON r.sequence_id = g.id GROUP BY g.centroid) t
      JOIN rearrangements k ON k.sequence_id = t.centroid""",
)
def redundancy_collapse(spark, d):
    """Merged chains of cells."""
    return S.collapse_redundant(view(spark, d, "rearrangements"))


@query("rearrangements", ctes_more="k AS (SELECT DISTINCT cell_id, split_part(v_call, '*', 1) AS cluster FROM rearrangements)", sql="SELECT a.cluster AS a, b.cluster AS b, count(*) AS n_cells FROM k a JOIN k b ON a.cell_id = b.cell_id AND a.cluster < b.cluster GROUP BY ALL")
def chain_pair_edges(spark, d):
    from lymphlake.functions.seq import gene_of

    return S.chain_edges(view(spark, d, "rearrangements").select("cell_id", gene_of(F.col("v_call")).alias("cluster")))


@query(
    "rearrangements",
    ctes_more="""s AS MATERIALIZED (SELECT cell_id, list_sort(list(DISTINCT locus || ':' || junction)) AS own FROM rearrangements WHERE status = 'good' GROUP BY cell_id), o AS (SELECT DISTINCT own FROM s),
      k AS (SELECT cell_id, unnest(own) AS c FROM s), e AS MATERIALIZED (SELECT DISTINCT a.c AS a, b.c AS b FROM k a JOIN k b ON a.cell_id = b.cell_id AND a.c <> b.c),
      n AS (SELECT own, b FROM (SELECT own, unnest(own) AS m FROM o) x JOIN e ON e.a = x.m GROUP BY own, b HAVING count(*) = len(own) AND NOT list_contains(own, b)),
      u AS MATERIALIZED (SELECT o.own, list_sort(list_concat(o.own, coalesce(list(n.b) FILTER (n.b IS NOT NULL), []))) AS whole FROM o LEFT JOIN n ON n.own = o.own GROUP BY o.own),
      v AS (SELECT whole, unnest(whole) AS m FROM (SELECT DISTINCT whole FROM u)),
      q AS (SELECT w.whole, coalesce(l.n, 0) = len(w.whole) * (len(w.whole) - 1) AS ok FROM (SELECT DISTINCT whole FROM u) w LEFT JOIN (SELECT v.whole, count(*) AS n FROM v JOIN e ON e.a = v.m JOIN v w ON w.whole = v.whole AND w.m = e.b GROUP BY v.whole) l ON l.whole = w.whole)""",
    sql="SELECT s.cell_id, CASE WHEN q.ok THEN array_to_string(u.whole, '+') END AS clone FROM s JOIN u ON u.own = s.own JOIN q ON q.whole = u.whole",
)
def joint_clones(spark, d):
    """Clones of cells by heavy and light chains."""
    t = view(spark, d, "rearrangements").where("status = 'good'")
    return S.joint_clones(t.select("cell_id", F.concat("locus", F.lit(":"), "junction").alias("cluster")))


@query(
    "rearrangements",
    sql="""SELECT source, c.cell_id, n_chains, n_loci, clone FROM (SELECT source_repertoire AS source, cell_id, count(*) AS n_chains, CASE WHEN source_repertoire = 'src1' THEN count(DISTINCT locus) END AS n_loci FROM rearrangements WHERE source_repertoire IN ('src0', 'src1') GROUP BY source_repertoire, cell_id) c
      LEFT JOIN (SELECT source_repertoire AS s, cell_id, min(junction) AS clone FROM rearrangements WHERE status = 'good' GROUP BY ALL) k ON k.s = c.source AND k.cell_id = c.cell_id""",
)
def cells_with_clones(spark, d):
    """Cells of two inputs, of which one has a column more, with their clones."""
    t = view(spark, d, "rearrangements")
    of = lambda s: t.where(F.col("source_repertoire") == s).groupBy("cell_id")
    inputs = {"src0": of("src0").agg(F.count(F.lit(1)).alias("n_chains")), "src1": of("src1").agg(F.count(F.lit(1)).alias("n_chains"), F.countDistinct("locus").alias("n_loci"))}
    clones = t.where("status = 'good'").groupBy(F.col("source_repertoire").alias("source"), "cell_id").agg(F.min("junction").alias("clone"))
    return S.cells_with_clones(inputs, clones).select("source", "cell_id", "n_chains", "n_loci", "clone")


@query("umi_reads", sql="SELECT cell, umi, count(*) AS count FROM umi_reads GROUP BY ALL")
def umi_stats(spark, d):
    return B.umi_stats(view(spark, d, "umi_reads"))


@query(
    "umi_reads",
    ctes_more="b AS (SELECT cell, umi, i, substr(seq, CAST(i AS INT), 1) AS base FROM (SELECT *, unnest(range(1, 32)) AS i FROM umi_reads)), m AS (SELECT cell, umi, i, base FROM (SELECT cell, umi, i, base, count(*) AS k FROM b GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY cell, umi, i ORDER BY k DESC, base) = 1)",
    sql="SELECT m.cell, m.umi, any_value(n.n) AS n, string_agg(base, '' ORDER BY i) AS consensus FROM m JOIN (SELECT cell, umi, count(*) AS n FROM umi_reads GROUP BY ALL) n ON n.cell = m.cell AND n.umi = m.umi WHERE n.n >= 3 GROUP BY m.cell, m.umi",
)
def umi_majority(spark, d):
    return B.majority_consensus(view(spark, d, "umi_reads"))


def _consensus(umi: str) -> str:
    """Tables up to ``u``: ``cell, umi, n, multi, size, consensus`` of the largest cluster of each molecule of ``umi_reads``."""
    source = f"SELECT cell, {umi} AS umi, cell || '|' || {umi} AS block, seq, seq AS id, count(*) AS k, row_number() OVER (PARTITION BY cell, {umi} ORDER BY count(*) DESC, seq) AS rn FROM umi_reads GROUP BY cell, {umi}, seq"
    return greedy(source, 0.95) + """,
 z AS (SELECT g.block, g.centroid, sum(k) AS size FROM g JOIN gs ON gs.block = g.block AND gs.seq = g.seq GROUP BY ALL),
 b AS (SELECT block, arg_min(centroid, (-size, centroid)) AS centroid, max(size) AS size, count(*) - 1 AS multi, sum(size) AS n FROM z GROUP BY block),
 f AS (SELECT block, i, base FROM (SELECT block, i, substr(seq, CAST(i AS INT), 1) AS base, sum(k) AS w FROM (SELECT g.block, g.seq, gs.k, unnest(range(1, length(g.seq) + 1)) AS i FROM g JOIN b ON b.block = g.block AND b.centroid = g.centroid JOIN gs ON gs.block = g.block AND gs.seq = g.seq) GROUP BY ALL)
   QUALIFY row_number() OVER (PARTITION BY block, i ORDER BY w DESC, base) = 1),
 u AS MATERIALIZED (SELECT x.cell, x.umi, CAST(b.n AS BIGINT) AS n, b.multi, CAST(b.size AS BIGINT) AS size, s.consensus FROM b JOIN (SELECT DISTINCT block, cell, umi FROM gs) x ON x.block = b.block
   JOIN (SELECT block, string_agg(base, '' ORDER BY i) AS consensus FROM f GROUP BY block) s ON s.block = b.block WHERE b.n >= 3 AND b.size >= 3)"""


_OF_CELL = greedy("""SELECT block, seq, id, row_number() OVER (PARTITION BY block ORDER BY size DESC, id) AS rn FROM (SELECT cell || '|' || length(consensus) AS block, consensus AS seq, max(size) AS size, arg_min(cell || ':' || umi, (-size, cell || ':' || umi)) AS id FROM u GROUP BY ALL)""", 0.99, "h") + """,
 c AS (SELECT u.cell, h.centroid, count(*) AS duplicate_count, CAST(sum(u.size) AS BIGINT) AS consensus_count, arg_min(u.consensus, (-u.size, u.cell || ':' || u.umi)) AS sequence FROM u JOIN h ON h.block = u.cell || '|' || length(u.consensus) AND h.seq = u.consensus GROUP BY ALL)"""
_CELL_SQL = "SELECT cell || '.' || row_number() OVER (PARTITION BY cell ORDER BY duplicate_count DESC, consensus_count DESC, centroid) AS sequence_id, cell, sequence, duplicate_count, consensus_count FROM c"


@query("umi_reads", ctes_more=_consensus("umi"), sql="SELECT * FROM u")
def umi_consensus(spark, d):
    """Largest cluster of each UMI."""
    return B.largest_cluster(view(spark, d, "umi_reads"))


@query("umi_reads", ctes_more=_consensus("umi") + "," + _OF_CELL, sql=_CELL_SQL)
def cell_consensus(spark, d):
    return B.cell_consensus(B.largest_cluster(view(spark, d, "umi_reads")).select("cell", "umi", "size", "consensus"))


@query("umi_reads", ctes_more=_consensus("cell") + "," + _OF_CELL, sql=_CELL_SQL)
def cells_only_consensus(spark, d):
    """Without UMIs the cell stands for them."""
    t = view(spark, d, "umi_reads").withColumn("umi", F.col("cell"))
    return B.cell_consensus(B.largest_cluster(t, least=3).select("cell", "umi", "size", "consensus"))


@query("umi_reads", sql="SELECT event_id, substr(seq, 1, 6) AS cell, substr(seq, 7, 4) || substr(reverse(translate(seq, 'ACGT', 'TGCA')), 1, 3) AS umi, substr(seq, 11, 18) AS seq FROM umi_reads")
def barcode_split(spark, d):
    return B.barcode_split(view(spark, d, "umi_reads").select("event_id", "seq"), (0, 6), (6, 10), (0, 3)).select("event_id", "cell", "umi", "seq")


@query("umi_reads", sql="SELECT event_id, cell IN ('cell1', 'cell2', 'cell3') AS listed FROM umi_reads")
def whitelist_join(spark, d):
    u = view(spark, d, "umi_reads")
    kept, rest = B.whitelisted(u, u.where("cell in ('cell1', 'cell2', 'cell3')").select("cell").distinct())
    return kept.select("event_id", F.lit(True).alias("listed")).unionByName(rest.select("event_id", F.lit(False).alias("listed")))


@query("umi_reads", sql="SELECT 'r' || event_id AS id, seq AS seq1, reverse(seq) AS seq2 FROM umi_reads WHERE event_id % 7 <> 0")
def read_pair_join(spark, d):
    u = view(spark, d, "umi_reads")
    a = u.select(F.concat(F.lit("r"), "event_id", F.lit("/1 x=1")).alias("id"), "seq")
    b = u.where("event_id % 7 <> 0").select(F.concat(F.lit("r"), "event_id", F.lit("/2")).alias("id"), F.reverse("seq").alias("seq"))
    return B.read_pairs(a, b)


@query("umi_reads", sql="SELECT 'r' || event_id AS id, CASE WHEN event_id % 7 = 0 THEN 1 ELSE 2 END AS mate FROM umi_reads WHERE event_id % 7 = 0 OR event_id % 11 = 0 AND event_id % 7 <> 0")
def unpaired_reads(spark, d):
    u = view(spark, d, "umi_reads")
    a = u.where("event_id % 11 <> 0 or event_id % 7 = 0").select(F.concat(F.lit("r"), "event_id", F.lit("/1 x=1")).alias("id"), "seq")
    b = u.where("event_id % 7 <> 0").select(F.concat(F.lit("r"), "event_id", F.lit("/2")).alias("id"), "seq")
    return B.unpaired_reads(a, b)


@query("umi_reads", sql="SELECT 'r' || event_id AS id, seq || repeat('AC', 10) AS merged FROM umi_reads WHERE length(seq) = 31")
def merge_read_pairs(spark, d):
    """Mates cut from one sequence, so the merge must give it back."""
    from lymphlake.functions.seq import revcomp

    whole = F.concat("seq", F.repeat(F.lit("AC"), F.lit(10)))
    pairs = view(spark, d, "umi_reads").select(F.concat(F.lit("r"), "event_id").alias("id"), F.substring(whole, 1, 31).alias("seq1"), revcomp(F.substr(whole, F.lit(12))).alias("seq2"))
    return B.merge_pairs(pairs, least_length=20, least_overlap=20, most_diffs=0)


#: In place p of the merged read the first mate has another base, of low quality.
_MATES = """w AS (SELECT event_id, seq || repeat('AC', 10) AS whole, 13 + event_id % 17 AS p FROM umi_reads),
 c AS (SELECT event_id, whole, i, CASE WHEN i = p THEN 5 ELSE 30 + i % 7 END AS a, 12 + i % 9 AS b, i = p AS differs FROM (SELECT *, unnest(range(1, 52)) AS i FROM w)),
 e AS (SELECT *, pow(10, -greatest(a, b) / 10.0) AS x, pow(10, -least(a, b) / 10.0) AS y FROM c),
 q AS (SELECT *, CASE WHEN i < 12 THEN a WHEN i > 31 THEN b ELSE least(41, floor(-10 * log10(CASE WHEN differs THEN x * (1 - y / 3) / (x + y - 4 * x * y / 3) ELSE x * y / 3 / (1 - x - y + 4 * x * y / 3) END) + 0.5)) END AS m FROM e)"""


@query("umi_reads", ctes_more=_MATES, sql="SELECT 'r' || event_id AS id, any_value(whole) AS merged, string_agg(chr(CAST(33 + m AS INT)), '' ORDER BY i) AS qual FROM q GROUP BY event_id")
def merge_pairs_by_quality(spark, d):
    """Mates of which the first has a wrong base of low quality: the merge gives the sequence back."""
    from lymphlake.functions.seq import revcomp

    n, p = F.col("event_id"), (13 + F.col("event_id") % 17).cast("int")
    whole = F.concat("seq", F.repeat(F.lit("AC"), F.lit(10)))
    wrong = F.concat(F.substr(whole, F.lit(1), p - 1), F.translate(F.substr(whole, p, F.lit(1)), "ACGT", "CATG"), F.substr(whole, p + 1, 31 - p))
    marks = lambda of, low, high: F.array_join(F.transform(F.sequence(F.lit(low), F.lit(high)), lambda i: F.char(33 + of(i))), "")
    qual1, qual2 = marks(lambda i: F.when(i == p, 5).otherwise(30 + i % 7), 1, 31), marks(lambda i: 12 + i % 9, 12, 51)
    pairs = view(spark, d, "umi_reads").select(F.concat(F.lit("r"), n).alias("id"), wrong.alias("seq1"), revcomp(F.substr(whole, F.lit(12))).alias("seq2"), qual1.alias("qual1"), F.reverse(qual2).alias("qual2"))
    return B.merge_pairs(pairs, least_length=20, least_overlap=20)

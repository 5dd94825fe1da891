"""Filters, hit selection and the annotation of reads."""

from pyspark.sql import functions as F

from lymphlake.catalog.registry import query
from lymphlake.catalog.scalars import _translated
from lymphlake.operators import annotate, hits as H, rules as R
from lymphlake.plans.tables import dealt
from lymphlake.plans.views import view

V = view


@query("rearrangements", sql="SELECT sequence_id, length(junction) AS n FROM rearrangements WHERE length(junction) BETWEEN 26 AND 32")
def read_length_filter(spark, d):
    return R.length_filter(V(spark, d, "rearrangements"), 26, 32, "junction").select("sequence_id", F.length("junction").alias("n"))


@query("rearrangements", sql="SELECT sequence_id FROM rearrangements WHERE regexp_matches(v_call, 'V[12]-') AND status <> 'noJ' AND v_identity >= 0.8 AND duplicate_count < 7 AND NOT regexp_matches(j_call, 'J4')")
def rule_filter_all(spark, d):
    return R.filter_rules(V(spark, d, "rearrangements"), ["v_call,=~,V[12]-", "status,ne,noJ", "v_identity,>=,0.8", "duplicate_count,<,7", "j_call,!~,J4"]).select("sequence_id")


@query("rearrangements", sql="SELECT sequence_id FROM rearrangements WHERE status = 'stop' OR duplicate_count = 9 OR duplicate_count > timepoint - 1990")
def rule_filter_any(spark, d):
    t = V(spark, d, "rearrangements").withColumn("since", F.col("timepoint") - 1990)
    return R.filter_rules(t, ["status,eq,stop", "duplicate_count,==,9", "duplicate_count,>,`since`"], any_rule=True).select("sequence_id")


@query("rearrangements", sql="SELECT sequence_id FROM rearrangements WHERE duplicate_count <> 1 AND status = 'good'")
def rule_filter_truth(spark, d):
    t = V(spark, d, "rearrangements").withColumns({"good": F.col("status") == "good", "single": F.col("duplicate_count") == 1})
    return R.filter_rules(t, ["good,is,", "single,not,"]).select("sequence_id")


@query("rearrangements", "umi_reads", sql="SELECT sequence_id FROM rearrangements WHERE cell_id IN (SELECT cell FROM umi_reads) AND cell_id NOT IN (SELECT cell FROM umi_reads WHERE cell LIKE 'cell%7')")
def rule_filter_lists(spark, d):
    u = V(spark, d, "umi_reads")
    lists = {"keep": u.select("cell"), "drop": u.where("cell like 'cell%7'").select("cell")}
    return R.filter_rules(V(spark, d, "rearrangements"), ["cell_id,-,keep", "cell_id,!-,drop"], lists).select("sequence_id")


@query("rearrangements", sql="SELECT id FROM (SELECT sequence_id AS id, v_call || ' ' || status AS description FROM rearrangements) WHERE regexp_matches(description, 'IGLV2.*good') OR regexp_matches(description, 'IGKV1.*stop') ORDER BY id LIMIT 100")
def annotation_search(spark, d):
    t = V(spark, d, "rearrangements").select(F.col("sequence_id").alias("id"), F.concat_ws(" ", "v_call", "status").alias("description"))
    return R.annotation_search(t, ["IGLV2.*good", "IGKV1.*stop"], 100).select("id")


@query("rearrangements", sql="SELECT sequence_id, v_call FROM rearrangements WHERE split_part(v_call, '*', 1) = 'IGHV1-1'")
def v_gene_filter(spark, d):
    return R.v_gene_filter(V(spark, d, "rearrangements"), "IGHV1-1").select("sequence_id", "v_call")


@query("rearrangements", sql="SELECT 'all' AS subset, count(*) AS n FROM rearrangements UNION ALL SELECT 'orf', count(*) FROM rearrangements WHERE status = 'good' UNION ALL SELECT 'unique', count(*) FROM rearrangements WHERE duplicate_count > 4")
def statistic_subsets(spark, d):
    t = V(spark, d, "rearrangements").withColumn("cluster_count", F.when(F.col("duplicate_count") > 4, F.col("duplicate_count")))
    out = None
    for s in ("all", "orf", "unique"):
        n = R.statistic_subset(t, s).agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("subset"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("rearrangements", sql="SELECT sequence_id FROM rearrangements WHERE status = 'good' AND length(junction) >= 29")
def clone_input_filter(spark, d):
    return R.junction_sane(R.clone_input(V(spark, d, "rearrangements"), "good"), 29).select("sequence_id")


_CELL_STATUS = "CASE CAST(substr(cell_id, 5) AS INT) % 7 WHEN 0 THEN 'canonical_pair' WHEN 1 THEN 'heavy_only' WHEN 2 THEN 'multi_light' WHEN 3 THEN 'none_productive' WHEN 4 THEN 'probable_multiplet' WHEN 5 THEN 'possible_inclusion' END"
_SINGLE = " AND cell_status NOT LIKE '%multi%' AND cell_status NOT LIKE '%none%'"
_MODES = (("all", "junction <> ''"), ("good", "status = 'good'"), ("unique", "centroid = sequence_id"), ("paired", "cell_status = 'canonical_pair'"))


@query(
    "rearrangements",
    ctes_more=f"t AS (SELECT *, {_CELL_STATUS} AS cell_status, min(sequence_id) OVER (PARTITION BY junction) AS centroid FROM rearrangements)",
    sql=" UNION ALL ".join(f"SELECT '{m}' AS which, {c} AS single_cell, count(*) AS n, min(sequence_id) AS first_id FROM t WHERE {rule}{_SINGLE if c == 'true' and m != 'paired' else ''}" for m, rule in _MODES for c in ("false", "true")),
)
def clone_input_modes(spark, d):
    """What each filter of clone input keeps, in bulk and of single cells."""
    first = V(spark, d, "rearrangements").groupBy(F.col("junction").alias("_j")).agg(F.min("sequence_id").alias("centroid"))
    t = V(spark, d, "rearrangements").withColumn("cell_status", F.expr(_CELL_STATUS)).join(first, F.col("junction") == F.col("_j"))
    out = None
    for which, _ in _MODES:
        for cells in (False, True):
            n = R.clone_input(t, which, cells).agg(F.count(F.lit(1)).alias("n"), F.min("sequence_id").alias("first_id"))
            n = n.select(F.lit(which).alias("which"), F.lit(cells).alias("single_cell"), "n", "first_id")
            out = n if out is None else out.unionByName(n)
    return out


@query("hits", "umi_reads", sql="SELECT event_id, CASE WHEN event_id % 2 = 0 THEN substr(seq, 5) ELSE reverse(translate(substr(seq, 1, 20), 'ACGT', 'TGCA')) END AS rest FROM umi_reads WHERE event_id % 2 = 0 OR 20 > 22")
def v_remainder(spark, d):
    t = V(spark, d, "umi_reads").select("event_id", "seq", F.when(F.col("event_id") % 2 == 0, "plus").otherwise("minus").alias("strand"), F.lit(21).alias("qstart"), F.lit(4).alias("qend"))
    return R.v_remainder(t, 22).select("event_id", "rest")


@query("umi_reads", sql="SELECT event_id FROM umi_reads WHERE event_id % 3 <> 1")
def frameshift_filter(spark, d):
    """One read in three has a single gap, another a whole codon's."""
    k = F.col("event_id") % 3
    gap = F.when(k == 1, F.lit("-")).when(k == 2, F.lit("---")).otherwise("")
    t = V(spark, d, "umi_reads").select("event_id", F.concat(F.lit("--"), F.substring("seq", 1, 12), gap, F.substr("seq", F.lit(13))).alias("query_aln"), F.col("seq").alias("germ_aln"))
    return R.frameshift_free(t).select("event_id")


@query("aligned_residues", sql="SELECT read_id, count(*) AS n_mutations FROM aligned_residues WHERE aa NOT IN ('X', '-') AND aa <> germ_aa GROUP BY read_id")
def mutation_filter(spark, d):
    return R.mutated(V(spark, d, "aligned_residues"))


@query("iddiv", sql="SELECT sequence_id, referent, germ_div, identity FROM iddiv WHERE (referent = 0 AND germ_div > 5 AND germ_div < 35 AND identity > 60 AND identity < 90) OR (referent = 1 AND identity - 40 > germ_div AND identity < 95 AND germ_div > 0)")
def island_filter(spark, d):
    polygons = spark.sql("""SELECT 0 AS referent, array(named_struct('x', 5D, 'y', 60D), named_struct('x', 35D, 'y', 60D), named_struct('x', 35D, 'y', 90D), named_struct('x', 5D, 'y', 90D)) AS vertices
      UNION ALL SELECT 1, array(named_struct('x', 0.0001D, 'y', 40.0001D), named_struct('x', 55D, 'y', 95D), named_struct('x', 0.0001D, 'y', 95D))""")
    return R.in_polygon(V(spark, d, "iddiv"), polygons).select("sequence_id", "referent", "germ_div", "identity")


@query("hits", sql="SELECT qid, sid, score, strand FROM hits QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1")
def top_hit(spark, d):
    return H.top_hits(V(spark, d, "hits")).select("qid", "sid", "score", "strand")


@query("hits", sql="SELECT qid, sid, score FROM hits WHERE strand = 'plus' QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1")
def top_hit_plus(spark, d):
    return H.top_hits(V(spark, d, "hits"), "plus").select("qid", "sid", "score")


@query(
    "hits",
    sql="""SELECT qid, string_agg(sid, ',' ORDER BY hit_rank) AS calls FROM (
      SELECT *, row_number() OVER (PARTITION BY qid, split_part(sid, '*', 1) ORDER BY hit_rank) AS once FROM (
        SELECT *, first_value(score) OVER (PARTITION BY qid ORDER BY hit_rank) AS best FROM hits) WHERE score >= best - 3) WHERE once = 1 GROUP BY qid""",
)
def tied_calls(spark, d):
    return H.tied_calls(V(spark, d, "hits"))


@query(
    "hits",
    sql="""SELECT qid, min_by(a, hit_rank) AS sid, min_by(st, hit_rank) AS strand,
      CAST(least(min(s0), coalesce(min(CASE WHEN before THEN sstart END), 2147483647)) AS INT) AS sstart, CAST(greatest(max(e0), coalesce(max(CASE WHEN after THEN send END), -1)) AS INT) AS send,
      CAST(count(*) FILTER (before OR after) AS BIGINT) AS n_parts FROM (
      SELECT *, sid = a AND strand = st AND greatest(sstart, send) < least(s0, e0) AS before, sid = a AND strand = st AND least(sstart, send) > greatest(s0, e0) AS after FROM (
        SELECT *, first_value(sid) OVER w AS a, first_value(strand) OVER w AS st, first_value(sstart) OVER w AS s0, first_value(send) OVER w AS e0 FROM h WINDOW w AS (PARTITION BY qid ORDER BY hit_rank))) GROUP BY qid""",
    ctes_more="h AS (SELECT qid, 'IGHV' || CAST(qstart % 2 AS VARCHAR) AS sid, strand, hit_rank, CAST(sstart + 20 * (hit_rank - 1) AS INT) AS sstart, CAST(sstart + 20 * (hit_rank - 1) + 15 AS INT) AS send FROM hits)",
)
def split_alignment_merge(spark, d):
    t = V(spark, d, "hits").select("qid", F.concat(F.lit("IGHV"), (F.col("qstart") % 2).cast("string")).alias("sid"), "strand", "hit_rank", "qstart", "qend", (F.col("sstart") + 20 * (F.col("hit_rank") - 1)).alias("sstart"), (F.col("sstart") + 20 * (F.col("hit_rank") - 1) + 15).alias("send"))
    return H.merged_hits(t).select("qid", "sid", "strand", "sstart", "send", "n_parts")


@query("hits", sql="SELECT qid, sid, qstart FROM (SELECT *, first_value(qstart) OVER w AS s, row_number() OVER w AS n FROM hits WINDOW w AS (PARTITION BY qid ORDER BY hit_rank)) WHERE n = 1 OR (score >= 35 AND qstart < s) QUALIFY row_number() OVER (PARTITION BY qid ORDER BY qstart, hit_rank) = 1")
def double_j_choice(spark, d):
    return H.nearest_j(V(spark, d, "hits")).select("qid", "sid", "qstart")


@query(
    "hits",
    sql="""SELECT qid, sid, hit_rank FROM (SELECT h.*, max(CASE WHEN j.js IS NULL OR h.qend <= j.js THEN 1 ELSE 0 END) OVER (PARTITION BY h.qid ORDER BY hit_rank ROWS UNBOUNDED PRECEDING) AS k
      FROM hits h LEFT JOIN (SELECT DISTINCT qid, 203 AS js FROM hits WHERE CAST(qid AS BIGINT) % 3 = 0) j ON h.qid = j.qid) WHERE k = 1""",
)
def d_before_j(spark, d):
    t = view(spark, d, "hits", sorted_rows=True)
    j = V(spark, d, "hits").where(F.col("qid").cast("long") % 3 == 0).select("qid", F.lit(203).alias("qstart"), F.lit(250).alias("qend")).distinct()
    return H.bounded_hits(t, j, "D").select("qid", "sid", "hit_rank")


@query("hits", "germline", sql="SELECT qid, sid, seq AS germline_seq FROM hits JOIN germline ON sid = allele QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1")
def hit_with_germline(spark, d):
    return H.with_germline(H.top_hits(V(spark, d, "hits")), V(spark, d, "germline")).select("qid", "sid", "germline_seq")


@query(
    "rearrangements", "hits",
    sql="""SELECT r.sequence_id AS read_id, v.sid AS v_call, j.sid AS j_call, CASE WHEN v.sid IS NULL THEN 'noV' WHEN j.sid IS NULL THEN 'noJ' END AS status FROM rearrangements r
      LEFT JOIN (SELECT * FROM hits WHERE strand = 'plus' QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1) v ON v.qid = r.sequence_id
      LEFT JOIN (SELECT * FROM hits WHERE strand = 'minus' QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1) j ON j.qid = r.sequence_id""",
)
def assigned_reads(spark, d):
    t, h = V(spark, d, "rearrangements").select(F.col("sequence_id").alias("read_id")), V(spark, d, "hits")
    return H.assigned(t, H.top_hits(h, "plus"), H.top_hits(h, "minus")).select("read_id", "v_call", "j_call", "status")


_J_TOP = "jt AS (SELECT qid, qstart AS js, qend AS je FROM hits WHERE strand = 'minus' QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1)"
_D_HITS = _J_TOP + """, dh AS (SELECT qid, sid, hit_rank, max(CASE WHEN js IS NULL OR e <= js THEN 1 ELSE 0 END) OVER (PARTITION BY qid ORDER BY hit_rank ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT h.*, h.qstart + 1 AS e, js FROM hits h LEFT JOIN jt ON jt.qid = h.qid))"""
_C_HITS = """ch AS (SELECT qid, sid, hit_rank, max(CASE WHEN je IS NULL OR s >= je THEN 1 ELSE 0 END) OVER (PARTITION BY qid ORDER BY hit_rank ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT h.*, h.qstart + 198 AS s, je FROM hits h LEFT JOIN jt ON jt.qid = h.qid))"""


def _bounded(spark, d):
    """D hits moved near the J hits' starts, C hits near their ends, and the J hits."""
    h = view(spark, d, "hits", sorted_rows=True)
    j = H.top_hits(dealt(h, h.count(), "qid"), "minus")
    return H.bounded_hits(h.withColumn("qend", F.col("qstart") + 1), j, "D"), H.bounded_hits(h.withColumn("qstart", F.col("qstart") + 198), j, "C"), j


@query("hits", ctes_more=_J_TOP + ", " + _C_HITS, sql="SELECT qid, sid, hit_rank FROM ch WHERE k = 1")
def c_after_j(spark, d):
    return _bounded(spark, d)[1].select("qid", "sid", "hit_rank")


@query(
    "rearrangements", "hits", ctes_more=_D_HITS + ", " + _C_HITS,
    sql="""SELECT r.sequence_id AS read_id, v.sid AS v_call, j.sid AS j_call, CASE WHEN v.sid IS NOT NULL AND j.sid IS NOT NULL THEN d.sid END AS d_call, CASE WHEN v.sid IS NOT NULL AND j.sid IS NOT NULL THEN c.sid END AS c_call,
      CASE WHEN v.sid IS NULL THEN 'noV' WHEN j.sid IS NULL THEN 'noJ' END AS status FROM rearrangements r
      LEFT JOIN (SELECT * FROM hits WHERE strand = 'plus' QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1) v ON v.qid = r.sequence_id
      LEFT JOIN (SELECT * FROM hits WHERE strand = 'minus' QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1) j ON j.qid = r.sequence_id
      LEFT JOIN (SELECT * FROM dh WHERE k = 1 QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1) d ON d.qid = r.sequence_id
      LEFT JOIN (SELECT * FROM ch WHERE k = 1 QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1) c ON c.qid = r.sequence_id""",
)
def annotated_reads(spark, d):
    """Reads with V, J, D and C calls."""
    t, h = V(spark, d, "rearrangements").select(F.col("sequence_id").alias("read_id")), V(spark, d, "hits")
    dh, ch, j = _bounded(spark, d)
    return H.assigned(t, H.top_hits(h, "plus"), j, H.top_hits(dh), H.top_hits(ch)).select("read_id", "v_call", "j_call", "d_call", "c_call", "status")


@query(
    "germline",
    sql="""SELECT id, allele, votes FROM (SELECT r.id, g.allele, r.strand, r.p - g.p AS diagonal, count(*) AS votes FROM r JOIN g ON r.k = g.k GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY id, allele ORDER BY votes DESC, strand, diagonal) = 1""",
    ctes_more="""s AS (SELECT allele AS id, 'plus' AS strand, substr(seq, 1 + CAST(length(allele) % 3 AS INT), 30) AS s FROM germline),
      o AS (SELECT * FROM s UNION ALL SELECT id, 'minus', reverse(translate(s, 'ACGT', 'TGCA')) FROM s),
      r AS (SELECT id, strand, p, substr(s, CAST(p AS INT) + 1, 11) AS k FROM (SELECT *, unnest(range(0, length(s) - 10)) AS p FROM o)),
      g AS (SELECT allele, p, substr(seq, CAST(p AS INT) + 1, 11) AS k FROM (SELECT *, unnest(range(0, length(seq) - 10)) AS p FROM germline))""",
)
def seed_votes(spark, d):
    g = V(spark, d, "germline")
    reads = g.select(F.col("allele").alias("id"), F.substr("seq", 1 + F.length("allele") % 3, F.lit(30)).alias("seq"))
    return H.seed_votes(reads, g, keep=10_000).select("id", "allele", "votes")


@query("germline", sql="""SELECT allele, list_max([i for i in range(0, length(seq), 3) if regexp_matches(substr(seq, i + 1, 3), '^TG[TCN]$')]) AS cys FROM germline""")
def germline_anchors(spark, d):
    return annotate.germline_anchors(V(spark, d, "germline")).select("allele", F.col("cys").cast("long").alias("cys"))


def _placed(spark, d):
    """Germline joined to a synthetic J, with hit coordinates derived from the reads' ids."""
    g = annotate.germline_anchors(V(spark, d, "germline")).select(F.col("allele").alias("_a"), F.col("seq").alias("v_germline"), "cys")
    t = H.top_hits(V(spark, d, "hits")).select("qid", "sid", "hit_rank").join(g, F.col("sid") == F.col("_a")).drop("_a")
    n = F.col("qid").cast("long")
    j = F.lit("ACTACTGGGGCCAG")
    lead = (n % 4).cast("int")
    core = F.concat(F.substr("v_germline", lead + 1), F.lit("GCA"), j, F.lit("CCTCC"))
    v_len = F.length("v_germline") - lead
    return t.select(
        "qid", "v_germline", "cys", F.lit(5).alias("j_motif"), F.concat(F.lit("AA"), core).alias("seq"), F.lit("plus").alias("v_strand"),
        F.lit(3).alias("v_qstart"), (v_len + 2).alias("v_qend"), (lead + 1).alias("v_sstart"), F.length("v_germline").alias("v_send"),
        F.lit(4).alias("j_qstart"), F.lit(16).alias("j_qend"), F.lit(1).alias("j_sstart"), F.lit(13).alias("j_send"), F.lit(14).alias("j_length"), F.lit(0).alias("j_gaps"),
        F.lit("IGH").alias("v_locus"), F.when(n % 11 == 0, "IGK").otherwise("IGH").alias("j_locus"),
    )


_PLACED = """p AS (SELECT qid, seq AS g, CAST(CAST(qid AS BIGINT) % 4 AS INT) AS lead FROM hits JOIN germline ON sid = allele QUALIFY row_number() OVER (PARTITION BY qid ORDER BY hit_rank) = 1)"""


@query("hits", "germline", sql="SELECT qid, substr(g, lead + 1) || 'GCAACTACTGGGGCCAG' AS trimmed, 'CCTCC' AS const_seq FROM p", ctes_more=_PLACED)
def trim_vdj(spark, d):
    return annotate.trim_vdj(_placed(spark, d)).select("qid", "trimmed", "const_seq")


@query("hits", "germline", sql="SELECT qid, substr(g, 1, lead) || substr(g, lead + 1) || 'GCAACTACTGGGGCCAG' AS trimmed, lead AS added5 FROM p", ctes_more=_PLACED)
def trim_vdj_germline(spark, d):
    return annotate.trim_vdj(_placed(spark, d), "germline").select("qid", "trimmed", "added5")


@query("hits", "germline", sql="SELECT qid, repeat('A', least(lead, 2)) || substr(g, lead + 1) || 'GCAACTACTGGGGCCAG' AS trimmed, least(lead, 2) AS added5 FROM p", ctes_more=_PLACED)
def trim_vdj_extend(spark, d):
    return annotate.trim_vdj(_placed(spark, d), "extend").select("qid", "trimmed", "added5")


@query("hits", "germline", sql="SELECT qid, lead = 0 AS complete_vdj, CASE WHEN lead > 0 THEN true ELSE false END AS missing_nterm FROM p", ctes_more=_PLACED)
def complete_vdj(spark, d):
    """Whether V begins at its first base and J reaches its end; with ``discard`` the others are marked."""
    rows = annotate.flagged(annotate.cdr3_borders(annotate.trim_vdj(_placed(spark, d), "discard")), "discard")
    return rows.select("qid", "complete_vdj", annotate.df_flags("discard")["missingNterm"].alias("missing_nterm"))


_BORDERS = _PLACED + """, b AS (SELECT *, list_max([i for i in range(0, length(g), 3) if regexp_matches(substr(g, i + 1, 3), '^TG[TCN]$')]) AS cys, length(g) - lead AS v_len FROM p),
 e AS (SELECT *, CAST(v_len - (length(g) - cys) AS INT) AS cdr3_start, CAST(v_len + 4 + 5 - 1 + 3 AS INT) AS cdr3_end FROM b)"""


@query("hits", "germline", sql="SELECT qid, coalesce(cdr3_start, -1) AS cdr3_start, cdr3_end FROM e", ctes_more=_BORDERS)
def cdr3_borders(spark, d):
    return annotate.cdr3_borders(annotate.trim_vdj(_placed(spark, d))).select("qid", "cdr3_start", "cdr3_end")


@query(
    "hits", "germline", ctes_more=_BORDERS,
    sql=f"""SELECT qid, junction, vj_in_frame, stop_codon, CASE WHEN chimera THEN 'chimera' WHEN s < 0 OR cdr3_end <= s THEN 'noCDR3' WHEN NOT vj_in_frame THEN 'nonproductive'
      WHEN indels THEN 'indel' WHEN stop_codon THEN 'stop' ELSE 'good' END AS status FROM (
      SELECT *, length(junction) % 3 = 0 AS vj_in_frame, contains({_translated("framed")}, '*') AS stop_codon, CAST(qid AS BIGINT) % 11 = 0 AS chimera,
        length(junction) % 3 = 0 AND (((lead + 1) % 3 + (v_len + 3) % 3) % 3 <> (3 - ((4 % 3 + 3) % 3)) % 3) AS indels FROM (
        SELECT *, coalesce(cdr3_start, -1) AS s, repeat('N', CAST((lead % 3 + 3) % 3 AS INT)) || substr(g, lead + 1) || 'GCAACTACTGGGGCCAG' AS framed,
          CASE WHEN coalesce(cdr3_start, -1) >= 0 AND cdr3_end > cdr3_start THEN substr(substr(g, lead + 1) || 'GCAACTACTGGGGCCAG', cdr3_start + 1, cdr3_end - cdr3_start) ELSE '' END AS junction FROM e))""",
)
def rearrangement_status(spark, d):
    return annotate.flagged(annotate.cdr3_borders(annotate.trim_vdj(_placed(spark, d)))).select("qid", "junction", "vj_in_frame", "stop_codon", "status")


@query(
    "rearrangements",
    sql="""SELECT segment, gene, n, round(n * 100.0 / sum(n) OVER (PARTITION BY segment), 2) AS percent FROM (
      SELECT 'V' AS segment, split_part(v_call, '*', 1) AS gene, count(*) AS n FROM rearrangements GROUP BY ALL UNION ALL SELECT 'J', split_part(j_call, '*', 1), count(*) FROM rearrangements GROUP BY ALL)""",
)
def gene_usage(spark, d):
    return annotate.gene_usage(V(spark, d, "rearrangements"))


@query(
    "rearrangements",
    sql="""SELECT count(*) AS n_raw, count(*) AS n_v, count(*) FILTER (status <> 'noJ') AS n_j, count(*) FILTER (status NOT IN ('noJ', 'noCDR3')) AS n_cdr3, count(*) FILTER (status NOT IN ('noJ', 'noCDR3', 'nonproductive')) AS n_in_frame,
      count(*) FILTER (status IN ('good', 'stop')) AS n_no_indel, count(*) FILTER (status = 'good') AS n_good FROM rearrangements""",
)
def status_funnel(spark, d):
    return annotate.status_funnel(V(spark, d, "rearrangements"))


@query(
    "rearrangements",
    sql=f"""SELECT tier, sequence_id, junction, {_translated('junction')} AS junction_aa FROM (SELECT 'allV' AS tier, * FROM rearrangements UNION ALL SELECT 'allJ', * FROM rearrangements WHERE status <> 'noJ'
      UNION ALL SELECT 'allCDR3', * FROM rearrangements WHERE status NOT IN ('noJ', 'noCDR3') UNION ALL SELECT 'goodVJ', * FROM rearrangements WHERE status = 'good' UNION ALL SELECT 'goodCDR3', * FROM rearrangements WHERE status = 'good')""",
)
def output_tiers(spark, d):
    return annotate.tiers(V(spark, d, "rearrangements"))


@query("rearrangements", sql="SELECT '>' || sequence_id || ' v_call=' || v_call || ' duplicate_count=' || duplicate_count || chr(10) || junction AS value FROM rearrangements")
def fasta_records(spark, d):
    return annotate.to_fasta(V(spark, d, "rearrangements"), attributes=("v_call", "duplicate_count"))


@query("rearrangements", sql="SELECT sequence_id, v_call, status FROM rearrangements WHERE status = 'good' ORDER BY sequence_id LIMIT 50")
def sorted_by_id(spark, d):
    return V(spark, d, "rearrangements").where("status = 'good'").orderBy("sequence_id").limit(50).select("sequence_id", "v_call", "status")


@query("rearrangements", sql="SELECT DISTINCT sequence_id FROM rearrangements WHERE (v_identity > 0.9 AND locus = 'IGH') OR (v_identity > 0.95)")
def distinct_id_union(spark, d):
    t = V(spark, d, "rearrangements")
    return t.where("v_identity > 0.9 and locus = 'IGH'").select("sequence_id").union(t.where("v_identity > 0.95").select("sequence_id")).distinct()


@query("rearrangements", sql="SELECT junction FROM rearrangements WHERE source_repertoire = 'src0' INTERSECT SELECT junction FROM rearrangements WHERE source_repertoire = 'src1'")
def replicate_intersection(spark, d):
    t = V(spark, d, "rearrangements")
    return t.where("source_repertoire = 'src0'").select("junction").intersect(t.where("source_repertoire = 'src1'").select("junction"))


@query("rearrangements", sql="SELECT sequence_id FROM rearrangements WHERE cell_id NOT IN (SELECT cell_id FROM rearrangements WHERE status = 'stop')")
def except_by_list(spark, d):
    t = V(spark, d, "rearrangements")
    bad = t.where("status = 'stop'").select(F.col("cell_id").alias("_c")).distinct()
    return t.join(bad, F.col("cell_id") == F.col("_c"), "left_anti").select("sequence_id")



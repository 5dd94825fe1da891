"""Substitution profile queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lymphlake.catalog.registry import query
from lymphlake.catalog.scalars import _translated
from lymphlake.functions.seq import AMINO_ACIDS
from lymphlake.operators import profiles as P
from lymphlake.plans.tables import written
from lymphlake.plans.views import view

LEAST = 100

_LONG = f"""s AS (SELECT vgene, prof, pos, germ_aa AS germ, count(*) AS depth, count(*) FILTER (aa <> germ_aa) AS mutated FROM aligned_residues WHERE aa NOT IN ('-', 'X') GROUP BY ALL),
 a AS (SELECT unnest(string_split('{AMINO_ACIDS}', '')) AS aa),
 c AS (SELECT vgene, prof, pos, aa, count(*) AS n FROM aligned_residues WHERE aa NOT IN ('-', 'X') AND aa <> germ_aa GROUP BY ALL),
 l AS (SELECT s.vgene, s.prof, s.pos, s.germ, CASE WHEN s.pos > 1 AND depth >= {LEAST} THEN round(mutated / CAST(depth AS DOUBLE) + 1e-9, 5) END AS freq, a.aa, CASE WHEN mutated > 0 THEN round(coalesce(c.n, 0) / CAST(mutated AS DOUBLE) + 1e-9, 5) ELSE 0.0 END AS p
   FROM s CROSS JOIN a LEFT JOIN c ON c.vgene = s.vgene AND c.prof = s.prof AND c.pos = s.pos AND c.aa = a.aa)"""


def _profiles(spark, d):
    return P.build_profiles(view(spark, d, "aligned_residues"), LEAST, 1)


@query("aligned_residues", ctes_more=_LONG, sql="SELECT vgene, prof, pos, germ, freq, aa, p FROM l")
def substitution_profile(spark, d):
    return P.long_form(_profiles(spark, d)).withColumn("germ", F.array_join("germ", ","))


_RARITY = _LONG + ", r AS (SELECT vgene, pos, aa, avg(1 - freq * p) AS mean, stddev_pop(1 - freq * p) AS std FROM l WHERE freq IS NOT NULL AND aa <> germ GROUP BY ALL)"


@query("aligned_residues", ctes_more=_RARITY, sql="SELECT * FROM r", rounded=("mean", "std"), digits=7)
def rarity(spark, d):
    return P.rarity(_profiles(spark, d))


@query("aligned_residues", ctes_more=_LONG, sql="SELECT vgene, pos, avg(freq) AS freq, aa, coalesce(avg(p) FILTER (freq IS NOT NULL), 0) AS p FROM l GROUP BY vgene, pos, aa", rounded=("freq", "p"))
def average_profile(spark, d):
    rows = P.average_profile(_profiles(spark, d)).select("vgene", "pos", "freq", F.posexplode("profile").alias("i", "p"))
    return rows.select("vgene", "pos", "freq", F.substr(F.lit(AMINO_ACIDS), F.col("i") + 1, F.lit(1)).alias("aa"), "p")


@query("aligned_residues", ctes_more=_LONG, sql="SELECT vgene, sum(freq * e) / sum(freq) AS entropy FROM (SELECT vgene, prof, pos, freq, -sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END) AS e FROM l WHERE freq IS NOT NULL GROUP BY ALL) GROUP BY vgene", rounded=("entropy",))
def profile_entropy(spark, d):
    return P.entropy(_profiles(spark, d))


_JSD = (
    _LONG
    + """, m AS (SELECT *, CASE WHEN t > 0 THEN p / t ELSE 0.05 END AS q FROM (SELECT *, sum(p) OVER (PARTITION BY vgene, prof, pos) AS t FROM l WHERE freq IS NOT NULL)),
 h AS (SELECT vgene, prof, pos, freq, -sum(CASE WHEN q > 0 THEN q * log2(q) ELSE 0 END) AS e FROM m GROUP BY ALL),
 j AS (SELECT x.vgene AS v1, y.vgene AS v2, x.prof AS p1, y.prof AS p2, x.pos, -sum(CASE WHEN x.q + y.q > 0 THEN (x.q + y.q) / 2 * log2((x.q + y.q) / 2) ELSE 0 END) AS mixed FROM m x JOIN m y ON x.pos = y.pos AND x.aa = y.aa GROUP BY ALL),
 d AS (SELECT v1, v2, avg(dd) AS jsd FROM (SELECT v1, v2, p1, p2, sum((a.freq + b.freq) / 2 * (mixed - (a.e + b.e) / 2)) / sum((a.freq + b.freq) / 2) AS dd FROM j JOIN h a ON a.vgene = v1 AND a.prof = p1 AND a.pos = j.pos JOIN h b ON b.vgene = v2 AND b.prof = p2 AND b.pos = j.pos GROUP BY ALL) GROUP BY ALL)"""
)


@query("aligned_residues", ctes_more=_JSD, sql="SELECT * FROM d", rounded=("jsd",))
def profile_comparison(spark, d):
    p = _profiles(spark, d)
    return P.compare_profiles(p, p)


@query("aligned_residues", ctes_more=_JSD, sql="SELECT v1, max(CASE WHEN v2 = v1 AND v2 = 'IGHV1' THEN 0 WHEN v2 = 'IGHV1' THEN jsd END) AS \"IGHV1\", max(CASE WHEN v2 = v1 AND v2 = 'IGHV2' THEN 0 WHEN v2 = 'IGHV2' THEN jsd END) AS \"IGHV2\" FROM d GROUP BY v1", rounded=("IGHV1", "IGHV2"))
def jsd_matrix(spark, d):
    return P.jsd_matrix(_profiles(spark, d), ["IGHV1", "IGHV2"])


@query("aligned_residues", ctes_more=_RARITY, sql="SELECT DISTINCT a.vgene, a.read_id, a.pos, a.germ_aa || a.pos || a.aa AS sub FROM aligned_residues a JOIN r ON r.vgene = a.vgene AND r.pos = a.pos AND r.aa = a.aa WHERE r.mean >= 0.96 AND a.aa NOT IN ('-', 'X')")
def rare_substitutions(spark, d):
    return P.rare_substitutions(view(spark, d, "aligned_residues"), P.rarity(_profiles(spark, d)), 0.96)


@query(
    "aligned_residues", ctes_more=_RARITY,
    sql="""SELECT * FROM (SELECT x.vgene, x.pos, x.sub, x.n, x.n * 100.0 / t.n AS percent FROM (SELECT a.vgene, a.pos, a.germ_aa || a.pos || a.aa AS sub, count(DISTINCT read_id) AS n FROM aligned_residues a JOIN r ON r.vgene = a.vgene AND r.pos = a.pos AND r.aa = a.aa
      WHERE r.mean >= 0.96 AND a.aa NOT IN ('-', 'X') GROUP BY ALL) x JOIN (SELECT vgene, count(DISTINCT read_id) AS n FROM aligned_residues GROUP BY vgene) t ON t.vgene = x.vgene) WHERE percent >= 0.5""",
)
def lineage_rare_substitutions(spark, d):
    r = view(spark, d, "aligned_residues")
    return P.common_rare(P.rare_substitutions(r, P.rarity(_profiles(spark, d)), 0.96), r, 0.5)


@query(
    "aligned_residues", ctes_more=_LONG,
    sql="SELECT vgene, prof, pos, aa, height, CAST(max(ceil(round(t, 6) / 10) * 10) OVER (PARTITION BY vgene, prof) AS BIGINT) AS y_limit FROM (SELECT *, 100 * freq * p AS height, sum(100 * freq * p) OVER (PARTITION BY vgene, prof, pos) AS t FROM l WHERE freq IS NOT NULL) WHERE p > 0",
)
def logo_heights(spark, d):
    return P.logo_heights(_profiles(spark, d))


@query("aligned_residues", sql="SELECT vgene, draw, read_id FROM (SELECT DISTINCT vgene, read_id FROM aligned_residues), (SELECT unnest([1, 2, 3]) AS draw) QUALIFY row_number() OVER (PARTITION BY vgene, draw ORDER BY md5(read_id || ':' || draw || ':0'), read_id) <= 50")
def random_sub_profiles(spark, d):
    return P.sub_profiles(view(spark, d, "aligned_residues").select("vgene", "read_id"), 3, 50)


@query("aligned_residues", ctes_more="b AS (SELECT vgene, pos, aa FROM (SELECT vgene, pos, aa, count(*) AS k FROM aligned_residues GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY vgene, pos ORDER BY k DESC, aa) = 1)", sql="SELECT vgene, string_agg(aa, '' ORDER BY pos) AS consensus FROM b GROUP BY vgene")
def group_consensus(spark, d):
    return P.group_consensus(view(spark, d, "aligned_residues"), "vgene", "pos", "aa")


@query("aligned_residues", sql="SELECT DISTINCT pos, aa, CASE WHEN aa IN ('X', '-') THEN 0.0 ELSE 1.0 END AS total FROM aligned_residues")
def letter_profiles(spark, d):
    from lymphlake.functions.seq import letter_profile

    return view(spark, d, "aligned_residues").select("pos", "aa").distinct().select("pos", "aa", F.aggregate(letter_profile(F.col("aa")), F.lit(0.0), lambda a, x: a + x).alias("total"))


#: Reads of ``umi_reads`` with an allele by their number, two bases changed, and every other one without its first codon.
_MADE = f"""a AS (SELECT allele, seq, row_number() OVER (ORDER BY allele) - 1 AS place FROM germline),
 m AS (SELECT allele, event_id, a.seq AS gene, 11 + event_id % 20 AS p, 36 + event_id % 25 AS q, substr('ACGT', 1 + CAST(event_id % 4 AS INT), 1) AS b FROM umi_reads JOIN a ON event_id % (SELECT count(*) FROM a) = place),
 n AS (SELECT *, substr(gene, 1, CAST(p - 1 AS INT)) || b || substr(gene, CAST(p + 1 AS INT), CAST(q - p - 1 AS INT)) || b || substr(gene, CAST(q + 1 AS INT)) AS seq FROM m),
 made AS (SELECT allele AS vgene, CAST(1 + event_id % 3 AS INT) AS prof, event_id AS read_id, CAST(pos AS INT) AS pos, CASE WHEN pos = 1 AND event_id % 2 = 1 THEN '-' ELSE substr(t, CAST(pos AS INT), 1) END AS aa, substr(u, CAST(pos AS INT), 1) AS germ_aa
   FROM (SELECT *, unnest(range(1, length(u) + 1)) AS pos FROM (SELECT *, {_translated("seq")} AS t, {_translated("gene")} AS u FROM n)))"""
_FEW = 3


def _made_residues(spark, d):
    g = written(view(spark, d, "germline").select(F.col("allele").alias("vgene"), "seq"), "germline")  # small: the planner sees its size
    placed = g.withColumn("place", F.row_number().over(Window.orderBy("vgene")) - 1)
    n, p, q = F.col("event_id"), (11 + F.col("event_id") % 20).cast("int"), (36 + F.col("event_id") % 25).cast("int")
    base = F.substr(F.lit("ACGT"), (1 + n % 4).cast("int"), F.lit(1))
    seq = F.concat(F.substr("seq", F.lit(1), p - 1), base, F.substr("seq", p + 1, q - p - 1), base, F.substr("seq", q + 1))
    reads = view(spark, d, "umi_reads").select("event_id").join(placed, n % g.count() == F.col("place"))
    reads = reads.select("vgene", (1 + n % 3).cast("int").alias("prof"), n.alias("read_id"), F.substr(seq, F.when(n % 2 == 1, 4).otherwise(1)).alias("seq"))
    return P.residues_from_reads(reads, g)


@query("umi_reads", "germline", ctes_more=_MADE, sql="SELECT * FROM made")
def residues_from_reads(spark, d):
    """Residues of reads by places of their germline."""
    return _made_residues(spark, d)


_MADE_LONG = _MADE + ", " + _LONG.replace("aligned_residues", "made").replace(f">= {LEAST}", f">= {_FEW}").replace("s.pos > 1 AND", "s.pos > 0 AND").replace(" s AS", " s AS").replace(" a AS (SELECT unnest", " aas AS (SELECT unnest").replace("a.aa, CASE", "aas.aa, CASE").replace("CROSS JOIN a LEFT", "CROSS JOIN aas LEFT").replace("c.aa = a.aa", "c.aa = aas.aa")


@query("umi_reads", "germline", ctes_more=_MADE_LONG, sql="SELECT vgene, prof, pos, germ, freq, aa, p FROM l")
def profile_from_reads(spark, d):
    """Substitution profiles from reads."""
    return P.long_form(P.build_profiles(_made_residues(spark, d), _FEW)).withColumn("germ", F.array_join("germ", ","))


@query(
    "umi_reads", "germline", ctes_more=_MADE_LONG + ", r AS (SELECT vgene, pos, aa, avg(1 - freq * p) AS mean FROM l WHERE freq IS NOT NULL AND aa <> germ GROUP BY ALL)",
    sql="SELECT DISTINCT m.vgene, m.read_id, m.pos, m.germ_aa || m.pos || m.aa AS sub FROM made m JOIN r ON r.vgene = m.vgene AND r.pos = m.pos AND r.aa = m.aa WHERE r.mean >= 0.9 AND m.aa NOT IN ('-', 'X')",
)
def rare_substitutions_from_reads(spark, d):
    """Rare substitutions scored on reads."""
    residues = _made_residues(spark, d)
    return P.rare_substitutions(residues, P.rarity(P.build_profiles(residues, _FEW)), 0.9)


@query("umi_reads", "germline", ctes_more=_MADE, sql="SELECT read_id, count(*) AS n_mutations FROM made WHERE aa NOT IN ('-', 'X') AND aa <> germ_aa GROUP BY read_id")
def mutated_reads(spark, d):
    """Reads that differ from their germline."""
    from lymphlake.operators.rules import mutated

    return mutated(_made_residues(spark, d))

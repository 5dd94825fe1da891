"""Scalar functions over derived sequences (projections; nothing is shuffled)."""

from pyspark.sql import functions as F

from lymphlake.catalog.registry import query
from lymphlake.functions import seq as S
from lymphlake.plans.tables import table
from lymphlake.plans.views import view

_CODONS = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in S.CODONS.items()) + "}"


def _translated(s: str) -> str:
    return f"array_to_string([coalesce({_CODONS}[upper(substr({s}, i * 3 + 1, 3))], 'X') for i in range(0, CAST(floor(length({s}) / 3) AS BIGINT))], '')"


@query("rearrangements", sql=f"SELECT sequence_id, {_translated('junction')} AS junction_aa FROM rearrangements")
def translate_nt(spark, d):
    return view(spark, d, "rearrangements").select("sequence_id", S.translate_nt(F.col("junction")).alias("junction_aa"))


@query("rearrangements", sql=f"SELECT sequence_id, CASE WHEN n % 4 = 0 THEN '-' ELSE '' END || {_translated('substr(junction, 4)')} AS aa FROM (SELECT *, CAST(sequence_id AS BIGINT) AS n FROM rearrangements)")
def translate_gapped(spark, d):
    """Every fourth junction has its first codon gapped."""
    gapped = F.when(F.col("sequence_id").cast("long") % 4 == 0, F.concat(F.lit("---"), F.substr("junction", F.lit(4)))).otherwise(F.substr("junction", F.lit(4)))
    return view(spark, d, "rearrangements").select("sequence_id", S.translate_gapped(gapped).alias("aa"))


@query("rearrangements", sql=f"SELECT sequence_id, CASE WHEN CAST(sequence_id AS BIGINT) % 5 <> 0 THEN {_translated('junction')} END AS aa FROM rearrangements")
def translate_strict(spark, d):
    """Every fifth junction carries an N behind its first codon."""
    with_n = F.when(F.col("sequence_id").cast("long") % 5 == 0, F.concat(F.substring("junction", 1, 3), F.lit("N"), F.substr("junction", F.lit(5)))).otherwise(F.col("junction"))
    return view(spark, d, "rearrangements").select("sequence_id", S.translate_strict(with_n).alias("aa"))


@query("rearrangements", sql="SELECT sequence_id, reverse(translate(junction, 'ACGT', 'TGCA')) AS rc FROM rearrangements")
def reverse_complement(spark, d):
    return view(spark, d, "rearrangements").select("sequence_id", S.revcomp(F.col("junction")).alias("rc"))


@query("rearrangements", sql="SELECT sequence_id, replace(v_call, '-', '') AS v, replace(junction, 'G', '') AS j FROM rearrangements")
def degap(spark, d):
    return view(spark, d, "rearrangements").select("sequence_id", S.degap(F.col("v_call")).alias("v"), S.degap(F.translate("junction", "G", "-")).alias("j"))


@query("rearrangements", sql="SELECT sequence_id, junction FROM rearrangements WHERE regexp_matches(junction, '^TGT[AG][CT]')")
def iupac_prefix(spark, d):
    return view(spark, d, "rearrangements").where(F.col("junction").rlike("^" + S.iupac_to_regex("TGTRY").replace("[UT]", "T").replace("[CT]", "[CT]"))).select("sequence_id", "junction")


@query("rearrangements", sql="SELECT sequence_id, split_part(v_call, '*', 1) AS v_gene, split_part(j_call, '*', 1) AS j_gene, CASE WHEN locus = 'IGH' THEN 'IGH' WHEN locus = 'IGL' THEN 'IGL' ELSE 'IGK' END AS v_locus FROM rearrangements")
def gene_and_locus(spark, d):
    calls = F.concat("v_call", F.lit(",IGHV9-9*01"))
    return view(spark, d, "rearrangements").select("sequence_id", S.gene_of(calls).alias("v_gene"), S.gene_of(F.col("j_call")).alias("j_gene"), S.locus_of(F.col("v_call")).alias("v_locus"))


@query(
    "rearrangements",
    sql="""SELECT sequence_id, CASE WHEN contains(g, locus) THEN g END AS c_call FROM (SELECT *, CASE WHEN t[1:2] IN ('CC', 'CT') THEN 'IGHG' WHEN t[1:3] = 'GGA' THEN 'IGHM'
      WHEN t[1:3] = 'CAT' THEN 'IGHA' WHEN t[1:3] = 'CAC' THEN 'IGHD' WHEN t[1:3] = 'CGA' THEN 'IGKC' WHEN t[1:3] = 'GGT' THEN 'IGLC' END AS g FROM (SELECT *, substr(junction, 4) AS t FROM rearrangements))""",
)
def isotype_fallback(spark, d):
    return view(spark, d, "rearrangements").select("sequence_id", S.isotype_fallback(F.substr("junction", F.lit(4)), F.col("locus")).alias("c_call"))


@query("rearrangements", sql="SELECT sequence_id, len(regexp_extract_all(j, '(?i)[KR]')) - len(regexp_extract_all(j, '(?i)[DE]')) AS charge FROM (SELECT sequence_id, " + _translated("junction") + " AS j FROM rearrangements)")
def cdr3_charge(spark, d):
    return view(spark, d, "rearrangements").select("sequence_id", S.cdr3_charge(S.translate_nt(F.col("junction"))).alias("charge"))


@query("rearrangements", sql="SELECT sequence_id, CASE WHEN status = 'indel' AND duplicate_count > 5 THEN 'both' WHEN status = 'indel' THEN 'in-del' WHEN duplicate_count > 5 THEN 'stop' ELSE 'orf' END AS feature, 100 * (1 - v_identity) AS divergence FROM rearrangements")
def features_and_divergence(spark, d):
    return view(spark, d, "rearrangements").select("sequence_id", S.features(F.col("status") == "indel", F.col("duplicate_count") > 5).alias("feature"), S.divergence(F.col("v_identity")).alias("divergence"))


@query(
    sql="""SELECT o_orderkey, year(o_orderdate) + least((dayofyear(o_orderdate) - CASE WHEN month(o_orderdate) > 2 AND year(o_orderdate) % 4 = 0 AND (year(o_orderdate) % 100 <> 0 OR year(o_orderdate) % 400 = 0) THEN 1 ELSE 0 END) / 365.0, 0.99999) AS t FROM orders"""
)
def decimal_year(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.decimal_year(F.col("o_orderdate").cast("date")).cast("double").alias("t"))


@query("rearrangements", sql="SELECT sequence_id, substr(junction, 1, 3) || substr(junction, 7, 4) || substr(junction, 16) AS fw, substr(junction, 4, 3) || substr(junction, 11, 5) AS cdr FROM rearrangements")
def split_regions(spark, d):
    r = S.split_regions(F.col("junction"), [3, 6, 10, 15])
    return view(spark, d, "rearrangements").select("sequence_id", r["fw"].alias("fw"), r["cdr"].alias("cdr"))


@query("rearrangements", sql="SELECT sequence_id, array_to_string([substr(junction, i * 3 + 1, 2) for i in range(0, length(junction) // 3)], '') AS first_two, array_to_string([substr(junction, i * 3 + 3, 1) for i in range(0, length(junction) // 3)], '') AS third FROM rearrangements")
def codon_positions(spark, d):
    c = S.codon_positions(F.col("junction"))
    return view(spark, d, "rearrangements").select("sequence_id", c["first_two"].alias("first_two"), c["third"].alias("third"))


@query("rearrangements", sql="SELECT DISTINCT v_call, CASE WHEN regexp_matches(v_call, '^IGHV4-4\\*0[78]') THEN 'IGHV4-59' ELSE split_part(v_call, '*', 1) END AS gene FROM rearrangements")
def gene_alias(spark, d):
    return view(spark, d, "rearrangements").select("v_call", S.gene_alias(F.col("v_call")).alias("gene")).distinct()


@query("rearrangements", sql="SELECT sequence_id, CASE WHEN p > 0 THEN length(junction) - p - 1 END AS start FROM (SELECT *, instr(reverse(junction), 'GT') AS p FROM rearrangements)")
def last_motif(spark, d):
    """Place of the last TG."""
    return view(spark, d, "rearrangements").select("sequence_id", S.last_match(F.col("junction"), "TG")["start"].cast("long").alias("start"))


@query("rearrangements", sql="""SELECT sequence_id, CAST(len([i for i in range(1, length(junction) - 1) if regexp_matches(substr(junction, i, 3), '^[AT][AG]C$')]) AS BIGINT) AS n, len([i for i in range(1, length(junction) - 1) if regexp_matches(substr(junction, i, 3), '^[AT][AG]C$')]) / length(junction) AS per_base FROM rearrangements""")
def motif_frequency(spark, d):
    m = S.motif_frequency(F.col("junction"), "WRC")
    return view(spark, d, "rearrangements").select("sequence_id", m["n"].cast("long").alias("n"), m["per_base"].alias("per_base"))


@query("umi_reads", sql="""SELECT event_id, CAST(len([i for i in range(1, 32) if substr(seq, i, 1) <> substr(r, i, 1)]) AS BIGINT) AS distance FROM (SELECT *, reverse(seq) AS r FROM umi_reads)""")
def sequence_distance(spark, d):
    return view(spark, d, "umi_reads").select("event_id", S.gap_aware_distance(F.col("seq"), F.reverse("seq"))["distance"].cast("long").alias("distance"))


@query("umi_reads", sql="SELECT event_id, len([i for i in range(1, 29) if substr(seq, i, 1) = substr(seq, i + 1, 1)]) / 28.0 AS identity FROM umi_reads")
def aligned_identity(spark, d):
    """Identity of a read with itself moved by one base, end gaps not counted."""
    a, b = F.concat(F.substring("seq", 1, 28), F.lit("--")), F.concat(F.substring("seq", 2, 28), F.lit("--"))
    return view(spark, d, "umi_reads").select("event_id", S.identity(a, b)["identity"].alias("identity"))


@query("aligned_residues", sql="SELECT read_id, pos, aa, germ_aa || pos || aa AS sub FROM aligned_residues WHERE aa <> germ_aa")
def substitution_label(spark, d):
    return view(spark, d, "aligned_residues").where("aa <> germ_aa").select("read_id", "pos", "aa", S.sub_label(F.col("germ_aa"), F.col("pos"), F.col("aa")).alias("sub"))


@query("umi_reads", sql="SELECT event_id, CASE WHEN q >= 20 THEN true ELSE false END AS ok FROM (SELECT event_id, least(ascii(chr(CAST(33 + event_id % 40 AS INT))) - 33, 30) AS q FROM umi_reads)")
def barcode_quality(spark, d):
    q = F.concat(F.lit("?????"), F.char(33 + F.col("event_id") % 40))
    return view(spark, d, "umi_reads").select("event_id", S.min_phred_ok(q).alias("ok"))


@query("umi_reads", sql="SELECT event_id, substr(seq, 1, CAST(least(31, floor(5.0 / pow(10, -q / 10.0) + 1e-9)) AS INT)) AS kept FROM (SELECT *, 1 + event_id % 20 AS q FROM umi_reads)")
def truncate_by_error(spark, d):
    """All bases of a read have one quality, so the prefix has a closed form."""
    q = F.repeat(F.char(34 + F.col("event_id") % 20), F.length("seq"))
    return view(spark, d, "umi_reads").select("event_id", S.truncate_by_error(F.col("seq"), q, 5.0 + 1e-9).alias("kept"))

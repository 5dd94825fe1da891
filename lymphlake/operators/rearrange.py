"""Reads to rearrangements in one plan: germline hits per segment, calls, trimming, junction, status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphlake.operators.annotate import cdr3_borders, flagged, germline_anchors, trim_vdj
from lymphlake.operators.hits import bounded_hits, merged_hits, nearest_j, tied_calls, top_hits
from lymphlake.operators.hsp import local_hit_table
from lymphlake.operators.rules import v_remainder
from lymphlake.plans.tables import written

#: What a row of :func:`rearranged` holds besides the read.
COLUMNS = (
    "v_call", "d_call", "j_call", "c_call", "v_identity", "n_parts", "locus", "rev_comp", "sequence_vdj", "junction", "junction_length",
    "complete_vdj", "vj_in_frame", "stop_codon", "indels", "productive", "status",
)


def rearranged(reads: DataFrame, v: DataFrame, j: DataFrame, d: DataFrame | None = None, c: DataFrame | None = None, nterm: str = "truncate") -> DataFrame:
    """``sequence_id`` and :data:`COLUMNS` of every read.

    ``reads`` has ``id, seq``, the libraries ``allele, seq``. V hits of the
    whole read are merged over long insertions; J, D and C are looked for in
    what follows V, D before J and C behind it. Each segment's hits are
    written, so that a lost executor costs one search. Reads without V (``noV``)
    or J (``noJ``) keep the calls that they have; their other columns are null.
    Null and empty reads have no V. What a read gets depends on its sequence
    only, so equal reads are annotated once, and a read meets its row by sequence.
    """
    rows = reads.select(F.col("id").alias("sequence_id"), F.upper("seq").alias("_s"))
    once = written(rows.where(F.length("_s") > 0).select(F.col("_s").alias("seq")).distinct().withColumn("id", F.monotonically_increasing_id().cast("string")), "reads-once")
    found = written(_rearranged(once, v, j, d, c, nterm).join(once, F.col("sequence_id") == F.col("id")).select("seq", *COLUMNS), "reads-found")
    none = {"status": F.coalesce("status", F.lit("noV"))}
    return rows.join(found, F.col("_s") == F.col("seq"), "left").withColumns(none).select("sequence_id", *COLUMNS)


def _rearranged(reads: DataFrame, v: DataFrame, j: DataFrame, d: DataFrame | None, c: DataFrame | None, nterm: str) -> DataFrame:
    """:func:`rearranged` of distinct reads with ids of their own."""
    v_hits = written(local_hit_table(reads, v, "V"), "hits-v")
    best = merged_hits(v_hits).select(F.col("qid"), F.col("sid").alias("v_sid"), F.col("strand").alias("v_strand"), "n_parts", *[F.col(x).alias(f"v_{x}") for x in ("qstart", "qend", "sstart", "send")])
    best = best.join(top_hits(v_hits).select(F.col("qid").alias("_q"), F.col("identity").alias("v_identity")), F.col("qid") == F.col("_q")).drop("_q")
    with_v = written(reads.select("id", F.upper("seq").alias("seq")).join(best, F.col("id") == F.col("qid")).drop("qid"), "reads-v")
    rest = v_remainder(with_v.select(F.col("id"), "seq", F.col("v_strand").alias("strand"), F.col("v_qstart").alias("qstart"), F.col("v_qend").alias("qend"))).select("id", F.col("rest").alias("seq"))
    rest = written(rest, "reads-rest")
    j_hits = written(local_hit_table(rest, j, "J"), "hits-j")
    plus = j_hits.where("strand = 'plus'")
    j_best = nearest_j(plus)
    calls = {"v_call": tied_calls(v_hits), "j_call": tied_calls(plus)}
    for name, library, segment in (("d_call", d, "D"), ("c_call", c, "C")):
        if library is not None:
            hits = written(local_hit_table(rest, library, segment), f"hits-{segment.lower()}").where("strand = 'plus'")
            calls[name] = tied_calls(bounded_hits(hits, j_best, segment))

    anchors = germline_anchors(v.unionByName(j)).select("allele", "seq", "cys", "j_motif")
    v_of = anchors.select(F.col("allele").alias("_v"), F.col("seq").alias("v_germline"), "cys")
    j_of = anchors.select(F.col("allele").alias("_j"), "j_motif", F.length("seq").alias("j_length"))
    placed = j_best.select(F.col("qid").alias("_q"), F.col("sid").alias("j_sid"), F.col("gaps").alias("j_gaps"), *[F.col(x).alias(f"j_{x}") for x in ("qstart", "qend", "sstart", "send")])
    both = with_v.join(v_of, F.col("v_sid") == F.col("_v")).join(placed, F.col("id") == F.col("_q")).join(j_of, F.col("j_sid") == F.col("_j"))
    both = both.withColumns({"v_locus": F.substring("v_sid", 1, 3), "j_locus": F.substring("j_sid", 1, 3)})
    flags = flagged(cdr3_borders(trim_vdj(both, nterm)), nterm)
    made = flags.select(F.col("id").alias("_m"), F.col("v_locus").alias("locus"), F.col("trimmed").alias("sequence_vdj"), "junction", "junction_length", "complete_vdj", "vj_in_frame", "stop_codon", "indels", "productive", F.col("status").alias("_status"))

    out = reads.select(F.col("id").alias("sequence_id")).join(with_v.select(F.col("id").alias("_i"), "v_identity", "n_parts", (F.col("v_strand") == "minus").alias("rev_comp")), F.col("sequence_id") == F.col("_i"), "left")
    for name in ("v_call", "j_call", "d_call", "c_call"):
        if name in calls:
            out = out.join(calls[name].select(F.col("qid").alias("_q"), F.col("calls").alias(name)), F.col("sequence_id") == F.col("_q"), "left").drop("_q")
        else:
            out = out.withColumn(name, F.lit(None).cast("string"))
    out = out.join(made, F.col("sequence_id") == F.col("_m"), "left")
    whole = F.col("v_call").isNotNull() & F.col("j_call").isNotNull()
    out = out.withColumns({x: F.when(whole, F.col(x)) for x in ("d_call", "c_call")})
    status = F.when(F.col("v_call").isNull(), "noV").when(F.col("j_call").isNull(), "noJ").otherwise(F.col("_status"))
    return out.withColumn("status", status).select("sequence_id", *COLUMNS)

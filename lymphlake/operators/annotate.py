"""From hits to rearrangements: trimming, junction borders, flags, status, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.functions.seq import degap, gene_of, has_stop, revcomp, translate_nt

# Motifs of the conserved positions.
CYS, CYS_LAMBDA, CYS_HV1C = "TG[TCN]", "TGCTGC", "TATGC"
CXRK = "TG[TC]...(?:CG.|AG[AG]|AA[AG])"
J_MOTIF = "TGGGG|TT[CT][GA]G"
#: Statuses from worst to best, as the report lists them.
STATUSES = ("noV", "noJ", "noCDR3", "nonproductive", "indel", "stop", "missingNterm", "chimera", "good")


def germline_anchors(library: DataFrame) -> DataFrame:
    """``allele, cys, j_motif``: 0-based place of the last in-frame Cys codon and of the J motif; null if absent.

    One row an allele: computed once per library, not once per read.
    """
    pattern = F.when(F.col("allele").rlike("^IGLV2-(11|23)"), CYS_LAMBDA).when(F.col("allele").rlike("^IGHV1-C"), CYS_HV1C).otherwise(CYS)
    seq = F.upper("seq")
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.length(seq) - 1, F.lit(0)), F.lit(3)), lambda i: F.regexp_like(F.substr(seq, i + 1), F.concat(F.lit("^(?:"), pattern, F.lit(")"))))
    j = F.regexp_instr(seq, F.lit(J_MOTIF))
    return library.select("allele", "seq", F.when(F.size(places) > 0, F.element_at(places, -1)).alias("cys"), F.when(j > 0, j - 1).alias("j_motif"))


def trim_vdj(reads: DataFrame, nterm: str = "truncate") -> DataFrame:
    """Adds ``v_len, vdj_len, added5, added3, trimmed, const_seq`` to reads joined with their V and J hits.

    Needs ``seq, v_strand, v_qstart, v_qend, v_sstart, v_send, v_germline,
    j_qend, j_send, j_length``. J is completed at its 3' end where the read is
    long enough. What precedes the V hit is cut (``truncate``, ``discard``),
    taken from the read as far as it goes (``extend``) or from the germline.
    """
    plus = F.col("v_strand") == "plus"
    n = F.length("seq")
    v_len = F.col("v_qend") - F.col("v_qstart") + 1
    missing = F.col("j_length") - F.col("j_send")
    room = F.when(plus, F.col("v_qstart") + v_len + F.col("j_qend") + missing <= n).otherwise(F.col("v_qend") - (v_len + F.col("j_qend") + missing) >= 0)
    added3 = F.when((missing > 0) & room, missing).otherwise(0)
    df = reads.withColumns({"v_len": v_len, "added3": added3}).withColumn("vdj_len", F.col("v_len") + F.col("j_qend") + F.col("added3"))
    lead = F.when(plus, F.col("v_sstart") - 1).otherwise(F.col("v_send") - 1)
    have = F.when(plus, F.col("v_qstart") - 1).otherwise(n - F.col("v_qend"))
    added5 = F.when(lead <= 0, 0).otherwise(F.least(lead, have) if nterm == "extend" else lead if nterm == "germline" else F.lit(0))
    df = df.withColumn("added5", added5)
    from_read = F.col("added5") if nterm == "extend" else F.lit(0)
    body = F.when(plus, F.substr("seq", F.col("v_qstart") - from_read, F.col("vdj_len") + from_read)).otherwise(
        revcomp(F.substr("seq", F.greatest(F.col("v_qend") - F.col("vdj_len"), F.lit(0)) + 1, F.least(F.col("vdj_len"), F.col("v_qend")) + from_read))
    )
    if nterm == "germline":
        body = F.concat(F.substr("v_germline", F.lit(1), F.col("added5")), body)
    after = F.when(plus, F.substr("seq", F.col("v_qstart") + F.col("vdj_len"))).otherwise(revcomp(F.substr("seq", F.lit(1), F.greatest(F.col("v_qend") - F.col("vdj_len"), F.lit(0)))))
    return df.withColumns({"trimmed": body, "const_seq": after})


def cdr3_borders(df: DataFrame) -> DataFrame:
    """Adds ``cdr3_start, cdr3_end`` (0-based within the part behind ``added5``, -1 if not found).

    Needs ``v_len, vdj_len, added5, trimmed, v_sstart, v_send, cys, j_motif,
    j_sstart, j_qstart, j_gaps``. If the V hit ends before its Cys, the CxR/K
    motif behind V is looked for; with gaps in J, the last J motif of the read
    moves the end by up to a codon.
    """
    read = F.substr("trimmed", F.col("added5") + 1)
    start = F.coalesce(F.col("v_len") - (F.greatest("v_sstart", "v_send") - F.col("cys")), F.lit(-1))
    rescue = F.regexp_instr(F.substr(read, F.col("v_len") + 1), F.lit(f"(?i){CXRK}"))
    start = F.when(start > F.col("v_len"), F.when(rescue > 0, F.col("v_len") + rescue - 1).otherwise(-1)).otherwise(start)
    end = F.coalesce(F.col("v_len") + F.col("j_qstart") + F.col("j_motif") - F.col("j_sstart") + 3, F.lit(-1))
    df = df.withColumns({"cdr3_start": start.cast("int"), "_end": end.cast("int")})
    behind = F.when(F.col("cdr3_start") >= 0, F.substr(read, F.col("cdr3_start") + 1)).otherwise(F.substr(read, F.length(read)))
    pieces = F.split(behind, J_MOTIF)
    found = F.regexp_extract_all(behind, F.lit(J_MOTIF), F.lit(0))
    last = F.length(behind) - F.length(F.element_at(pieces, -1)) - F.length(F.element_at(found, -1)) + 3 + F.greatest("cdr3_start", F.lit(0))
    moved = F.when((F.col("j_gaps") > 0) & (F.size(found) > 0) & (F.abs(last - F.col("_end")) <= 3), last).otherwise(F.col("_end"))
    return df.withColumn("cdr3_end", moved.cast("int")).drop("_end")


def flagged(df: DataFrame, nterm: str = "truncate") -> DataFrame:
    """Adds ``junction, junction_length, complete_vdj, vj_in_frame, stop_codon, indels, status, productive``.

    Needs the columns of :func:`trim_vdj` and :func:`cdr3_borders`, and
    ``v_locus, j_locus, v_qstart, v_qend, j_sstart, j_send, j_qend``.
    """
    s, e = F.col("cdr3_start"), F.col("cdr3_end")
    first = F.least("v_sstart", "v_send")
    junction = F.when((s >= 0) & (e > s), F.substr("trimmed", F.col("added5") + s + 1, e - s)).otherwise("")
    v_frame = F.pmod(first - F.col("added5"), F.lit(3))
    shift = F.pmod(F.col("v_len") + F.col("j_qstart") + F.col("added5") - 1, F.lit(3))
    j_frame = 3 - F.pmod(F.coalesce(F.col("j_motif"), F.lit(-1)) - F.col("j_sstart"), F.lit(3))
    uneven = (F.pmod(F.abs(F.col("v_send") - F.col("v_sstart")) - (F.col("v_qend") - F.col("v_qstart")), F.lit(3)) != 0) | (F.pmod((F.col("j_send") - F.col("j_sstart")) - (F.col("j_qend") - F.col("j_qstart")), F.lit(3)) != 0)
    framed = F.concat(F.repeat(F.lit("N"), F.pmod(v_frame - 1, F.lit(3))), F.col("trimmed"))
    df = df.withColumns({"junction": junction, "complete_vdj": (first + F.col("added5") == 1) & (F.greatest("j_sstart", "j_send") + F.col("added3") >= F.col("j_length") - 1)})
    df = df.withColumns(
        {
            "junction_length": F.length("junction"),
            "vj_in_frame": F.length("junction") % 3 == 0,
            "stop_codon": has_stop(framed),
            "indels": (F.length("junction") % 3 == 0) & ((F.pmod(v_frame + shift, F.lit(3)) != F.pmod(j_frame, F.lit(3))) | uneven),
        }
    )
    return df.withColumn("status", status(df_flags(nterm))).withColumn("productive", F.col("status") == "good")


def df_flags(nterm: str) -> dict[str, Column]:
    """The conditions of a status, from the columns of :func:`flagged`."""
    s, e = F.col("cdr3_start"), F.col("cdr3_end")
    return {
        "chimera": ~F.col("v_locus").eqNullSafe(F.col("j_locus")),
        "noCDR3": (e <= s) | (e > F.col("vdj_len")) | (s < 0),
        "nonproductive": ~F.col("vj_in_frame"),
        "indel": F.col("indels"),
        "stop": F.col("stop_codon"),
        "missingNterm": (F.lit(nterm) == "discard") & (F.least("v_sstart", "v_send") > 1),
    }


def status(conditions: dict[str, Column]) -> Column:
    """The first condition that holds, in the given order, else good."""
    return F.coalesce(*[F.when(c, name) for name, c in conditions.items()], F.lit("good"))


def gene_usage(table: DataFrame) -> DataFrame:
    """``segment, gene, n, percent`` per segment present: V over all rows with V, the others over rows with J."""
    calls = [(s, c) for s, c in (("V", "v_call"), ("J", "j_call"), ("D", "d_call"), ("C", "c_call")) if c in table.columns]
    named = F.filter(F.array(*[F.when(F.col(c).isNotNull() & (F.col(c) != "") & (F.lit(s == "V") | F.col("j_call").isNotNull()), F.struct(F.lit(s).alias("segment"), gene_of(F.col(c)).alias("gene"))) for s, c in calls]), lambda x: x.isNotNull())
    counts = table.select(F.explode(named).alias("g")).groupBy("g.segment", "g.gene").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("segment"))
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 2))


def status_funnel(table: DataFrame) -> DataFrame:
    """One row: how many rows have V, J, a CDR3, are in frame, without indel, good."""
    lost: list[str] = []
    out = [F.count(F.lit(1)).alias("n_raw")]
    for name, more in (("n_v", ["noV"]), ("n_j", ["noJ"]), ("n_cdr3", ["noCDR3"]), ("n_in_frame", ["nonproductive"]), ("n_no_indel", ["indel"]), ("n_good", ["stop", "missingNterm", "chimera"])):
        lost = lost + more
        out.append(F.count(F.when(~F.col("status").isin(*lost), 1)).alias(name))
    return table.agg(*out)


def tiers(table: DataFrame) -> DataFrame:
    """Rows once per tier that they belong to: ``tier, sequence_id, junction, junction_aa``.

    allV takes in allJ, that allCDR3; goodVJ and goodCDR3 are the good rows.
    """
    s = F.col("status")
    names = F.array(
        F.when(s != "noV", F.lit("allV")),
        F.when(~s.isin("noV", "noJ"), F.lit("allJ")),
        F.when(~s.isin("noV", "noJ", "noCDR3"), F.lit("allCDR3")),
        F.when(s == "good", F.lit("goodVJ")),
        F.when(s == "good", F.lit("goodCDR3")),
    )
    return table.select(F.explode(F.filter(names, lambda t: t.isNotNull())).alias("tier"), "sequence_id", "junction", translate_nt(F.col("junction")).alias("junction_aa"))


def to_fasta(table: DataFrame, field: str = "junction", id_column: str = "sequence_id", attributes: tuple[str, ...] = (), translated: bool = False) -> DataFrame:
    """``value``: one FASTA record a row, attributes as key=value; rows without a sequence are left out."""
    seq = degap(F.col(field))
    seq = translate_nt(seq) if translated else seq
    more = [F.when(F.col(a).isNotNull() & (F.col(a).cast("string") != ""), F.concat(F.lit(f" {a}="), F.col(a).cast("string"))).otherwise("") for a in attributes]
    return table.where(F.coalesce(F.col(field), F.lit("")) != "").select(F.concat(F.lit(">"), F.col(id_column), *more, F.lit("\n"), seq).alias("value"))

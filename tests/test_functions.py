"""Hand-computed rows for each branch of the sequence functions and flags."""

import datetime

import pytest
from pyspark.sql import functions as F

from lymphlake.functions import seq as S
from lymphlake.operators import annotate, cells


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()
    return row["x"]


@pytest.mark.parametrize(
    ("name", "seq", "want"),
    [
        ("translate_nt", "ATGTAAGGNC", "M*X"),
        ("translate_nt", "", ""),
        ("translate_nt", "AT", ""),
        ("translate_nt", None, None),
        ("translate_gapped", "ATG---A-GTTT", "M-XF"),
        ("translate_strict", "ATGANG", None),
        ("translate_strict", "NTGAAG", "XK"),
        ("revcomp", "AACGN", "NCGTT"),
        ("degap", "A-C.G+T", "ACGT"),
        ("gene_of", "IGHV1-2*02,IGHV3-3*01", "IGHV1-2"),
        ("locus_of", "ighv1-2*02", "IGH"),
        ("locus_of", "IGLJ1*01", "IGL"),
        ("locus_of", "kappa7", "IGK"),
        ("locus_of", "XX", None),
        ("cdr3_charge", "KRDEEk", 0),
        ("gene_alias", "IGHV4-4*07", "IGHV4-59"),
        ("gene_alias", "IGKV1D-39*01", "IGKV1-39"),
    ],
)
def test_text_functions(spark, name, seq, want):
    assert one(spark, getattr(S, name)(F.col("s").cast("string")), s=seq) == want


def test_iupac():
    assert S.iupac_to_regex("ARTN") == "A[AG][UT][ACGTU]"


@pytest.mark.parametrize(("day", "want"), [("2000-12-31", 2000.99999), ("2001-12-31", 2001.99999), ("2000-03-01", 2000 + 60 / 365), ("1999-01-01", 1999 + 1 / 365)])
def test_decimal_year(spark, day, want):
    assert one(spark, S.decimal_year(F.col("d")), d=datetime.date.fromisoformat(day)) == pytest.approx(want)


def test_last_match_and_motifs(spark):
    m = one(spark, S.last_match(F.col("s"), "TG[TC]"), s="TGTAATGCC")
    assert (m["start"], m["stop"], m["match"]) == (5, 8, "TGC")
    assert one(spark, S.last_match(F.col("s"), "Z"), s="TG") is None
    assert one(spark, S.motif_frequency(F.col("s"), "AA")["n"], s="AAAA") == 3


def test_identity_and_gaps(spark):
    inner = one(spark, S.identity(F.col("a"), F.col("b")), a="--ACGTN", b="TTACCTA")
    assert (inner["matches"], inner["aligned"]) == (3, 4)
    ends = one(spark, S.identity(F.col("a"), F.col("b"), terminal_gaps=True), a="--AC", b="TTAC")
    assert (ends["matches"], ends["aligned"]) == (2, 4)
    inside = one(spark, S.identity(F.col("a"), F.col("b"), internal_gaps=True), a="A-C", b="ATC")
    assert (inside["matches"], inside["aligned"]) == (2, 3)
    d = one(spark, S.gap_aware_distance(F.col("a"), F.col("b")), a="A-CGN", b="ATTGA")
    assert (d["distance"], d["compared"], list(d["positions"])) == (1, 3, [2])


def test_profiles(spark):
    assert one(spark, S.shannon(F.array(F.lit(0.5), F.lit(0.5), F.lit(0.0)))) == pytest.approx(1)
    assert one(spark, S.jsd(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(3.0)))) == pytest.approx(1)
    assert one(spark, S.jsd(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))) == pytest.approx(0)


def test_quality(spark):
    assert one(spark, S.min_phred_ok(F.col("q")), q="5II") is True
    assert one(spark, S.min_phred_ok(F.col("q")), q="4II") is False
    assert one(spark, S.truncate_by_error(F.col("s"), F.col("q"), 0.15), s="ACGT", q="+5II") == "ACGT"
    assert one(spark, S.truncate_by_error(F.col("s"), F.col("q"), 0.05), s="ACGT", q="+5II") == ""


@pytest.mark.parametrize(
    ("p", "t", "want"),
    [
        ((1, 1, 0), (1, 1, 0), "canonical_pair"),
        ((1, 0, 0), (1, 0, 0), "heavy_only"),
        ((0, 1, 0), (0, 1, 0), "light_only"),
        ((1, 1, 1), (1, 1, 1), "possible_inclusion"),
        ((1, 2, 1), (1, 2, 1), "probable_multiplet"),
        ((0, 1, 1), (0, 1, 1), "multi_light"),
        ((2, 1, 0), (2, 1, 0), "multi_heavy"),
        ((1, 1, 0), (3, 1, 0), "probable_multiplet"),
        ((0, 0, 0), (1, 0, 0), "none_productive"),
    ],
)
def test_cell_status(spark, p, t, want):
    loci = ("IGH", "IGK", "IGL")
    c = cells.cell_status({x: F.lit(n) for x, n in zip(loci, p, strict=True)}, {x: F.lit(n) for x, n in zip(loci, t, strict=True)})
    assert one(spark, c) == want


@pytest.mark.parametrize(("after", "locus", "want"), [("CCTA", "IGH", "IGHG"), ("GGAG", "IGH", "IGHM"), ("CATC", "IGH", "IGHA"), ("CACC", "IGH", "IGHD"), ("CGAA", "IGK", "IGKC"), ("GGTC", "IGL", "IGLC"), ("CGAA", "IGH", None), ("TTTT", "IGH", None)])
def test_isotype(spark, after, locus, want):
    assert one(spark, S.isotype_fallback(F.col("a"), F.col("v")), a=after, v=locus) == want


def read(spark, **more):
    """A read with V (plus strand, Cys at 24) and J, in frame."""
    v = "GCA" * 8 + "TGTGCG"
    j = "ACTACTGGGGCCAG"
    base = {"seq": "AA" + v + "GCA" + j + "CCTCC", "v_germline": v, "cys": 24, "j_motif": 5, "v_strand": "plus", "v_qstart": 3, "v_qend": 32, "v_sstart": 1, "v_send": 30, "j_qstart": 4, "j_qend": 17, "j_sstart": 1, "j_send": 14, "j_length": 14, "j_gaps": 0, "v_locus": "IGH", "j_locus": "IGH"} | more
    kinds = {k: "int" if isinstance(v, int) else "string" for k, v in base.items()} | {"cys": "int", "j_motif": "int"}
    return spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} {t}" for k, t in kinds.items()))


def annotated(spark, nterm="truncate", **more):
    return annotate.flagged(annotate.cdr3_borders(annotate.trim_vdj(read(spark, **more), nterm)), nterm).first()


def test_status_branches(spark):
    good = annotated(spark)
    assert (good["trimmed"], good["const_seq"]) == ("GCA" * 8 + "TGTGCGGCAACTACTGGGGCCAG", "CCTCC")
    assert (good["cdr3_start"], good["junction"], good["status"], good["complete_vdj"]) == (24, "TGTGCGGCAACTACTGG", "nonproductive", True)
    assert annotated(spark, j_motif=6)["junction_length"] == 18
    assert annotated(spark, cys=None)["status"] == "noCDR3"
    assert annotated(spark, j_locus="IGK")["status"] == "chimera"
    assert annotated(spark, j_motif=None)["status"] == "noCDR3"


def test_nterm_modes(spark):
    cut = {"v_qstart": 6, "v_sstart": 4}
    assert annotated(spark, "truncate", **cut)["trimmed"].startswith("GCA" * 7 + "TGT")
    assert annotated(spark, "extend", **cut)["trimmed"].startswith("GCA" * 8 + "TGT")
    assert annotated(spark, "germline", **cut)["trimmed"].startswith("GCA" * 8 + "TGT")
    short = annotated(spark, "extend", seq="GCA" * 7 + "TGTGCGGCAACTACTGGGGCCAGCC", v_qstart=1, v_qend=27, v_sstart=4)
    assert short["added5"] == 0


def test_minus_strand(spark):
    row = read(spark).first()
    n = len(row["seq"])
    flipped = S.revcomp(F.lit(row["seq"]))
    seq = spark.range(1).select(flipped.alias("s")).first()["s"]
    minus = annotated(spark, seq=seq, v_strand="minus", v_qstart=n - 32 + 1, v_qend=n - 2, v_sstart=30, v_send=1)
    assert minus["trimmed"] == annotated(spark)["trimmed"]
    assert minus["const_seq"] == "CCTCC"


def test_j_recovery(spark):
    row = annotated(spark, j_qend=14, j_send=11)
    assert row["added3"] == 3 and row["trimmed"].endswith("GGGGCCAG")
    row = annotated(spark, j_qend=14, j_send=11, seq=read(spark).first()["seq"][:-6])
    assert row["added3"] == 0

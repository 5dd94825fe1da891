"""Rearrangement tables as tab-separated files, lists and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphlake.functions.seq import degap

#: Fields of a rearrangement file and their types; others stay strings.
TYPES = {"complete_vdj": "boolean", "vj_in_frame": "boolean", "stop_codon": "boolean", "productive": "boolean", "rev_comp": "boolean", "indels": "boolean", "junction_length": "int", "length_raw": "int", "length_trimmed": "int", "duplicate_count": "long", "consensus_count": "long", "cluster_count": "long", "clone_count": "long", "v_identity": "double", "blast_identity": "double", "timepoint": "int"}
REQUIRED = ("sequence_id", "v_call", "j_call", "junction")


def read_airr(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Typed rearrangements: T and F are booleans, empty and NA are null. A missing required field is an error."""
    raw = spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False)
    absent = [c for c in required if c not in raw.columns]
    if absent:
        raise ValueError(f"missing fields: {', '.join(absent)}")
    value = {c: F.when(~F.col(f"`{c}`").isin("", "NA"), F.col(f"`{c}`")) for c in raw.columns}
    typed = [F.when(F.upper(v).isin("T", "TRUE"), True).when(F.upper(v).isin("F", "FALSE"), False) if TYPES.get(c) == "boolean" else v.cast(TYPES.get(c, "string")) for c, v in value.items()]
    return raw.select(*[t.alias(c) for c, t in zip(value, typed, strict=True)])


def write_airr(table: DataFrame, path: str) -> None:
    """Tab-separated with a header; booleans as T and F, null as empty."""
    out = [F.when(F.col(c), "T").when(~F.col(c), "F").alias(c) if t == "boolean" else F.col(c) for c, t in table.dtypes]
    table.select(*out).write.csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """``id, rest``: one id a line, gzip or not; what follows it is kept."""
    words = F.split(F.trim("value"), r"\s+", 2)
    return spark.read.text(path).where(F.trim("value") != "").select(words[0].alias("id"), F.coalesce(F.get(words, F.lit(1)), F.lit("")).alias("rest"))


def from_list(reads: DataFrame, listed: DataFrame, reverse: bool = False) -> DataFrame:
    """Listed reads with the rest of their line added to the description, or with ``reverse`` all the others."""
    ids = listed.select(F.col("id").alias("_i"), F.col("rest").alias("_r")).dropDuplicates(["_i"])
    if reverse:
        return reads.join(ids, F.col("id") == F.col("_i"), "left_anti")
    more = F.when(F.col("_r") != "", F.concat("description", F.lit(" "), "_r")).otherwise(F.col("description"))
    return reads.join(ids, F.col("id") == F.col("_i")).withColumn("description", more).drop("_i", "_r")


def germline_library(libraries: DataFrame, species: str, locus: str, segment: str) -> DataFrame:
    """Alleles of a species, locus and segment; light chains have no D segment."""
    if segment == "D" and locus in ("IGK", "IGL"):
        return libraries.limit(0)
    keep = (F.col("locus") == locus) & (F.col("segment") == segment)
    return libraries.where(keep & (F.col("species") == species) if "species" in libraries.columns else keep)


def legacy_table(stats: DataFrame, raw: DataFrame, trimmed: DataFrame, junctions: DataFrame) -> DataFrame:
    """Old statistics rows joined to their sequences, under rearrangement names.

    ``stats`` has ``id, v, j, status, divergence`` (percent), ``cdr3_length``
    (amino acids excluding the borders, in bases); ``wrong_length`` rows and those
    without a sequence are left out.
    """
    r, t, c = (x.select(F.col("id").alias(f"_{n}"), F.col("seq").alias(n)) for x, n in ((raw, "sequence"), (trimmed, "sequence_alignment"), (junctions, "junction")))
    rows = stats.where(F.col("status") != "wrong_length").join(r, F.col("id") == F.col("_sequence")).join(t, F.col("id") == F.col("_sequence_alignment"), "left").join(c, F.col("id") == F.col("_junction"), "left")
    return rows.select(F.col("id").alias("sequence_id"), F.col("v").alias("v_call"), F.col("j").alias("j_call"), "status", (1 - F.col("divergence") / 100).alias("v_identity"), (F.col("cdr3_length") + 6).alias("junction_length"), "sequence", degap(F.col("sequence_alignment")).alias("sequence_alignment"), "junction")


def subject_chains(master: DataFrame, subject: str) -> DataFrame:
    """Heavy and light chain rows of one subject's antibodies: ``sequence_id, cell_id, locus, v_call, junction``.

    The light CDR3's bases are cut from the light sequence at the place where
    its amino acids stand in the translation, times three.
    """
    rows = master.where(F.col("subject") == subject)
    at = F.position(F.col("l_cdr3_aa"), F.col("l_aa"))
    light = F.when(at > 0, F.substr("l_nt", (at - 1) * 3 + 1, F.length("l_cdr3_aa") * 3))
    chains = F.array(
        F.struct(F.concat("name", F.lit("_H")).alias("sequence_id"), F.col("name").alias("cell_id"), F.lit("IGH").alias("locus"), F.col("h_v").alias("v_call"), F.col("h_cdr3_nt").alias("junction")),
        F.struct(F.concat("name", F.lit("_L")).alias("sequence_id"), F.col("name").alias("cell_id"), F.substring("l_v", 1, 3).alias("locus"), F.col("l_v").alias("v_call"), light.alias("junction")),
    )
    return rows.select(F.explode(chains).alias("c")).select("c.*")

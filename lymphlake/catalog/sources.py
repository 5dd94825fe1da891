"""Sources and sinks: tables are written in a format of sequencing, read back and compared."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lymphlake.catalog.registry import query
from lymphlake.functions.seq import translate_nt
from lymphlake.operators.annotate import to_fasta
from lymphlake.plans.tables import scratch
from lymphlake.plans.views import view
from lymphlake.sources import airr, sequences


@query("rearrangements", sql="SELECT sequence_id AS id, sequence_id || ' v_call=' || v_call || ' duplicate_count=' || duplicate_count AS description, junction AS seq, v_call, duplicate_count FROM rearrangements")
def fasta_round_trip(spark, d):
    path = scratch(spark, "fasta")
    to_fasta(view(spark, d, "rearrangements"), attributes=("v_call", "duplicate_count")).write.text(path)
    reads = sequences.read_fasta(spark, path)
    more = sequences.attributes(F.col("description"))
    return reads.select("id", "description", "seq", more["v_call"].alias("v_call"), more["duplicate_count"].cast("long").alias("duplicate_count"))


@query("umi_reads", sql="SELECT 'r' || event_id AS id, seq, repeat('@', 31) AS qual FROM umi_reads")
def fastq_round_trip(spark, d):
    """Qualities start with @, so that record borders have to be told from quality lines."""
    path = scratch(spark, "fastq")
    nl = F.lit("\n")
    view(spark, d, "umi_reads").select(F.concat(F.lit("@r"), "event_id", nl, "seq", nl, F.lit("+"), nl, F.repeat(F.lit("@"), F.length("seq"))).alias("value")).write.text(path)
    return sequences.read_fastq(spark, path, rangeBytes=100_000).select("id", "seq", "qual")


@query("rearrangements", sql="SELECT source_repertoire, count(*) AS n FROM rearrangements GROUP BY ALL")
def folder_source(spark, d):
    """Files of a folder with the part of their path that names the source."""
    path = scratch(spark, "folder")
    to_fasta(view(spark, d, "rearrangements"), attributes=("source_repertoire",)).withColumn("s", F.regexp_extract("value", "source_repertoire=(\\w+)", 1)).write.partitionBy("s").text(path)
    return sequences.read_fasta(spark, path, source=r"/s=(\w+)/").groupBy(F.col("source_file").alias("source_repertoire")).agg(F.count(F.lit(1)).alias("n"))


@query("rearrangements", sql="SELECT sequence_id, CASE WHEN duplicate_count % 3 = 0 THEN 7 ELSE duplicate_count END AS duplicate_count, CASE WHEN duplicate_count % 3 <> 0 AND duplicate_count % 2 = 0 THEN 3 END AS consensus_count, CASE WHEN duplicate_count % 3 <> 0 THEN cell_id END AS cell_id FROM rearrangements")
def definition_line_lookup(spark, d):
    t = view(spark, d, "rearrangements")
    n = F.col("duplicate_count")
    size = F.when(n % 3 == 0, ";size=7").otherwise("")
    text = F.concat(F.lit("x cell_id="), "cell_id", F.lit(" duplicate_count="), n.cast("string"), F.lit(" consensus_count="), F.when(n % 2 == 0, "3").otherwise("NA"), size)
    return t.select("sequence_id", sequences.read_lookup(text).alias("l")).select("sequence_id", "l.duplicate_count", "l.consensus_count", "l.cell_id")


@query("rearrangements", sql="SELECT sequence_id, v_call, j_call, junction, duplicate_count, v_identity, status = 'good' AS productive, CASE WHEN status <> 'noJ' THEN status END AS status FROM rearrangements")
def airr_round_trip(spark, d):
    t = view(spark, d, "rearrangements").select("sequence_id", "v_call", "j_call", "junction", "duplicate_count", "v_identity", (F.col("status") == "good").alias("productive"), F.when(F.col("status") != "noJ", F.col("status")).alias("status"))
    path = scratch(spark, "airr")
    airr.write_airr(t, path)
    return airr.read_airr(spark, path)


@query("rearrangements", sql="SELECT sequence_id, v_call, length(junction) AS junction_length FROM rearrangements")
def airr_derive(spark, d):
    t = view(spark, d, "rearrangements").select("sequence_id", "v_call", "j_call", "junction")
    path = scratch(spark, "airr")
    airr.write_airr(t.withColumn("junction_length", F.length("junction")), path)
    return airr.read_airr(spark, path).select("sequence_id", "v_call", "junction_length")


@query("germline", sql="SELECT allele, seq FROM germline WHERE locus = 'IGH' AND segment = 'V'")
def germline_lookup(spark, d):
    return airr.germline_library(view(spark, d, "germline"), "human", "IGH", "V").select("allele", "seq")


@query("rearrangements", sql="SELECT sequence_id AS id, CASE WHEN CAST(sequence_id AS BIGINT) % 2 = 0 THEN 'd n=' || sequence_id ELSE 'd' END AS description FROM rearrangements WHERE CAST(sequence_id AS BIGINT) % 3 = 0")
def list_with_rest(spark, d):
    t = view(spark, d, "rearrangements")
    path = scratch(spark, "list")
    n = F.col("sequence_id").cast("long")
    t.where(n % 3 == 0).select(F.when(n % 2 == 0, F.concat("sequence_id", F.lit("\tn="), "sequence_id")).otherwise(F.col("sequence_id")).alias("value")).write.option("compression", "gzip").text(path)
    reads = t.select(F.col("sequence_id").alias("id"), F.lit("d").alias("description"))
    return airr.from_list(reads, airr.read_list(spark, path))


@query("rearrangements", sql="SELECT sequence_id AS id FROM rearrangements WHERE CAST(sequence_id AS BIGINT) % 3 <> 0")
def list_reverse(spark, d):
    t = view(spark, d, "rearrangements").select(F.col("sequence_id").alias("id"), F.lit("d").alias("description"))
    listed = t.where(F.col("id").cast("long") % 3 == 0).select("id", F.lit("").alias("rest"))
    return airr.from_list(t, listed, reverse=True).select("id")


@query("rearrangements", sql="SELECT sequence_id, v_call, j_call, status, 1 - (duplicate_count * 2) / 100.0 AS v_identity, length(junction) + 6 AS junction_length, junction AS sequence, junction FROM rearrangements WHERE status <> 'noJ' AND duplicate_count <> 4")
def legacy_table(spark, d):
    t = view(spark, d, "rearrangements")
    stats = t.select(F.col("sequence_id").alias("id"), F.col("v_call").alias("v"), F.col("j_call").alias("j"), F.when(F.col("status") == "noJ", "wrong_length").otherwise(F.col("status")).alias("status"), (F.col("duplicate_count") * 2.0).alias("divergence"), F.length("junction").alias("cdr3_length"))
    seqs = t.select(F.col("sequence_id").alias("id"), F.col("junction").alias("seq"))
    return airr.legacy_table(stats, seqs.join(t.where("duplicate_count <> 4").select(F.col("sequence_id").alias("_s")), F.col("id") == F.col("_s"), "left_semi"), seqs, seqs).drop("sequence_alignment")


@query(
    "rearrangements",
    sql="""SELECT cell_id || sequence_id || '_H' AS sequence_id, 'IGH' AS locus, v_call, junction FROM rearrangements WHERE source_repertoire = 'src1'
      UNION ALL SELECT cell_id || sequence_id || '_L', 'IGK', 'IGKV1-1', substr(junction, 1, 18) FROM rearrangements WHERE source_repertoire = 'src1'""",
)
def subject_chains(spark, d):
    t = view(spark, d, "rearrangements")
    light = F.concat(F.lit("ATGTGGTGG"), "junction")
    aa = translate_nt(light)
    master = t.select(F.col("source_repertoire").alias("subject"), F.concat("cell_id", "sequence_id").alias("name"), F.col("v_call").alias("h_v"), F.col("junction").alias("h_cdr3_nt"), F.lit("IGKV1-1").alias("l_v"), light.alias("l_nt"), aa.alias("l_aa"), F.substring(aa, 4, 6).alias("l_cdr3_aa"))
    return airr.subject_chains(master, "src1").select("sequence_id", "locus", "v_call", "junction")


@query("rearrangements", sql="SELECT sequence_id AS id FROM rearrangements WHERE status = 'good'")
def id_list(spark, d):
    path = scratch(spark, "fasta")
    to_fasta(view(spark, d, "rearrangements").where("status = 'good'")).write.text(path)
    return sequences.read_fasta(spark, path).select("id")


@query("umi_reads", sql="SELECT event_id, printf('%08d', row_number() OVER (ORDER BY id)) AS read_id FROM (SELECT event_id, lpad(CAST(event_id AS VARCHAR), 9, '0') AS id FROM umi_reads)")
def sequential_read_ids(spark, d):
    t = view(spark, d, "umi_reads").select("event_id", F.lpad(F.col("event_id").cast("string"), 9, "0").alias("id"))
    return sequences.numbered_reads(t).select("event_id", "read_id")


def one_allele_each(reads, germline, *by):
    """``reads`` with ``allele`` and ``seq`` of exactly one allele each, by a hash of ``by`` and the number of alleles."""
    numbered = germline.select("allele", "seq", (F.row_number().over(Window.orderBy("allele", "seq")) - 1).alias("_place"))
    return reads.join(numbered, F.pmod(F.xxhash64(*by), F.lit(germline.count())) == F.col("_place")).drop("_place")


@query()
def germline_alignment(spark, d):
    """Reads against their germline and two antibodies: rows only; alignments are tested."""
    from lymphlake.operators.align import identity_divergence

    g = view(spark, d, "germline")
    t = view(spark, d, "rearrangements").select("sequence_id", "junction")
    reads = one_allele_each(t, g, "junction").select("sequence_id", F.col("allele").alias("v_call"), F.col("junction").alias("seq"))
    known = g.orderBy("allele").limit(2).select(F.col("allele").alias("name"), "seq")
    return identity_divergence(reads, g, known)


@query()
def antibody_sieve(spark, d):
    """Known-antibody sieve on all distinct junctions; the three natives are the donor's antibodies here. Rows only; that natives attract their kin is tested."""
    from lymphlake.operators.align import sieve

    t = view(spark, d, "rearrangements").groupBy(F.col("junction").alias("seq")).agg(F.min("sequence_id").alias("id"))
    natives = t.orderBy("seq").limit(3).select(F.concat(F.lit("native"), "id").alias("id"), "seq")
    return sieve(t.select("id", "seq"), natives, ("germline", "TGT" + "ACGT" * 7))


@query()
def germline_assignment(spark, d):
    """Seed votes and alignment of reads cut from alleles, by the rules of V segments, the only ones in this library: rows only; that the source allele wins is tested."""
    from lymphlake.operators.align import segment_hits

    g = view(spark, d, "germline").where("segment = 'V'").select("allele", "seq")
    u = view(spark, d, "umi_reads").select("event_id", "umi", "cell")
    reads = one_allele_each(u, g, "umi", "cell").select(F.concat(F.lit("r"), "event_id").alias("id"), F.concat(F.substring("umi", 1, 5), F.substr("seq", F.lit(6), F.lit(50))).alias("seq"))
    return segment_hits(reads, g, "V")


@query("umi_reads", sql="SELECT n, count(*) AS reads, sum(e) / count(*) AS mean_error FROM (SELECT length(seq) AS n, length(seq) * pow(10, -(1 + event_id % 20) / 10.0) AS e FROM umi_reads) GROUP BY n", rounded=("mean_error",))
def length_and_error(spark, d):
    """Reads per length and their mean expected errors."""
    from lymphlake.functions.seq import phred

    q = F.repeat(F.char(34 + F.col("event_id") % 20), F.length("seq"))
    errors = F.aggregate(phred(q), F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), -x / 10.0))
    return view(spark, d, "umi_reads").groupBy(F.length("seq").cast("long").alias("n")).agg(F.count(F.lit(1)).alias("reads"), (F.sum(errors) / F.count(F.lit(1))).alias("mean_error"))

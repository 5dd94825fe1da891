"""Choosing germline hits of reads, and putting the calls together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lymphlake.functions.seq import gene_of
from lymphlake.plans.tables import dealt

def _per_read() -> WindowSpec:
    return Window.partitionBy("qid").orderBy("hit_rank")


def top_hits(hits: DataFrame, strand: str | None = None) -> DataFrame:
    """The first listed hit of each read, of one strand if asked for."""
    rows = hits if strand is None else hits.where(F.col("strand") == strand)
    return rows.withColumn("_n", F.row_number().over(_per_read())).where("_n = 1").drop("_n")


def bounded_hits(hits: DataFrame, j_top: DataFrame, segment: str) -> DataFrame:
    """D hits that end before J starts, or C hits that start after J ends, up to the first kept hit of a read.

    Reads without a J hit are not bounded; ``j_top`` has one a read. Once a hit
    is kept, the later ones of its read stay as they are. A read's bound goes
    before its hits in one window, so the rows are dealt and sorted once. They
    are dealt to as many tasks as their number asks for.
    """
    bound = j_top.where(F.col("qid").isNotNull()).select("qid", F.col("qstart").alias("_js"), F.col("qend").alias("_je"), F.lit(0).alias("_hit"))
    rows = dealt(hits.withColumn("_hit", F.lit(1)).unionByName(bound, allowMissingColumns=True), hits.count(), "qid")
    order = Window.partitionBy("qid").orderBy("_hit", "hit_rank").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({c: F.max(c).over(order) for c in ("_js", "_je")})
    fits = F.coalesce(F.col("qend") <= F.col("_js"), F.lit(True)) if segment == "D" else F.coalesce(F.col("qstart") >= F.col("_je"), F.lit(True))
    kept = F.max(F.when(F.col("_hit") == 1, fits.cast("int"))).over(order) == 1
    return rows.withColumn("_keep", kept).where("_keep AND _hit = 1").select(hits.columns)


def tied_calls(hits: DataFrame, slack: float = 3.0) -> DataFrame:
    """``qid, calls``: the first hit's allele and, after it, alleles of other genes within ``slack`` of its score.

    Each gene is named once, in order of the hits.
    """
    rows = hits.withColumn("_gene", gene_of(F.col("sid"))).withColumn("_best", F.first("score").over(_per_read())).withColumn("_first", F.first("_gene").over(_per_read()))
    rows = rows.where(F.col("score") >= F.col("_best") - slack)
    once = F.row_number().over(Window.partitionBy("qid", "_gene").orderBy("hit_rank"))
    rows = rows.withColumn("_once", once).where("_once = 1")
    ordered = F.sort_array(F.collect_list(F.struct("hit_rank", "sid")))
    return rows.groupBy("qid").agg(F.array_join(F.transform(ordered, lambda h: h["sid"]), ",").alias("calls"))


def merged_hits(hits: DataFrame) -> DataFrame:
    """Top hits whose ranges take in the other parts of a split alignment.

    Parts are later hits of the same allele and strand whose subject range
    does not overlap the first's; they extend the subject range and the query
    range on the side that the strand says.
    """
    first = {c: F.first(c).over(_per_read()) for c in ("sid", "strand", "sstart", "send", "qstart", "qend")}
    rows = hits
    for c, w in first.items():
        rows = rows.withColumn(f"_{c}", w)
    low, high = F.least("sstart", "send"), F.greatest("sstart", "send")
    part = (F.col("sid") == F.col("_sid")) & (F.col("strand") == F.col("_strand"))
    before = part & (high < F.least("_sstart", "_send"))
    after = part & (low > F.greatest("_sstart", "_send"))
    plus = F.col("_strand") == "plus"
    agg = rows.groupBy("qid").agg(
        F.min_by("_sid", "hit_rank").alias("sid"),
        F.min_by("_strand", "hit_rank").alias("strand"),
        F.least(F.min("_sstart"), F.min(F.when(before, F.col("sstart")))).alias("sstart"),
        F.greatest(F.max("_send"), F.max(F.when(after, F.col("send")))).alias("send"),
        F.least(F.min("_qstart"), F.min(F.when((before & plus) | (after & ~plus), F.col("qstart")))).alias("qstart"),
        F.greatest(F.max("_qend"), F.max(F.when((after & plus) | (before & ~plus), F.col("qend")))).alias("qend"),
        F.count(F.when(before | after, 1)).alias("n_parts"),
    )
    return agg


def nearest_j(hits: DataFrame, least: float = 35.0) -> DataFrame:
    """The first hit, or of those scoring ``least`` and starting before it the one that starts first."""
    start = F.first("qstart").over(_per_read())
    rows = hits.withColumn("_n", F.row_number().over(_per_read())).withColumn("_s", start)
    rows = rows.where((F.col("_n") == 1) | ((F.col("score") >= least) & (F.col("qstart") < F.col("_s"))))
    order = Window.partitionBy("qid").orderBy("qstart", "hit_rank")
    return rows.withColumn("_o", F.row_number().over(order)).where("_o = 1").drop("_n", "_s", "_o")


def with_germline(top: DataFrame, germline: DataFrame) -> DataFrame:
    """Hits with the called allele's sequence. The library has one row an allele; the planner broadcasts it if it is small."""
    return top.join(germline.select(F.col("allele").alias("_a"), F.col("seq").alias("germline_seq")), F.col("sid") == F.col("_a")).drop("_a")


def assigned(reads: DataFrame, v: DataFrame, j: DataFrame, d: DataFrame | None = None, c: DataFrame | None = None) -> DataFrame:
    """Reads with their V and J calls, and those of D and C if given; ``status`` is noV, noJ or null.

    Each of the tables has one hit a read. D and C hits are used of reads with
    V and J only, as the others are not annotated any further.
    """
    v = v.select(F.col("qid").alias("_v"), F.col("sid").alias("v_call"), F.col("identity").alias("v_identity"))
    j = j.select(F.col("qid").alias("_j"), F.col("sid").alias("j_call"))
    out = reads.join(v, F.col("read_id") == F.col("_v"), "left").join(j, F.col("read_id") == F.col("_j"), "left").drop("_v", "_j")
    for name, hits in (("d_call", d), ("c_call", c)):
        if hits is not None:
            out = out.join(hits.select(F.col("qid").alias("_q"), F.col("sid").alias("_call")), F.col("read_id") == F.col("_q"), "left")
            out = out.withColumn(name, F.when(F.col("v_call").isNotNull() & F.col("j_call").isNotNull(), F.col("_call"))).drop("_q", "_call")
    return out.withColumn("status", F.when(F.col("v_call").isNull(), "noV").when(F.col("j_call").isNull(), "noJ"))


def seed_votes(reads: DataFrame, germline: DataFrame, k: int = 11, keep: int = 10, step: int = 1) -> DataFrame:
    """``id, allele, diagonal, strand, votes``: the ``keep`` best alleles by shared k-mers on one diagonal.

    k-mers of both strands of the reads meet all of the library's k-mers in an
    equi join. Votes are summed per (read, allele, diagonal) before the
    shuffle, so only sums travel.
    """
    from lymphlake.functions.seq import revcomp

    def kmers(df: DataFrame, seq: Column, every: int, *names: str) -> DataFrame:
        at = F.when(F.length(seq) >= k, F.sequence(F.lit(0), F.length(seq) - k, F.lit(every)))
        return df.select(*names, F.explode(at).alias("at"), seq.alias("_s")).select(*names, "at", F.substr("_s", F.col("at") + 1, F.lit(k)).alias("kmer"))

    library = kmers(germline, F.upper("seq"), 1, "allele").withColumnRenamed("at", "place")
    strands = reads.select("id", F.explode(F.array(F.struct(F.lit("plus").alias("strand"), F.upper("seq").alias("s")), F.struct(F.lit("minus").alias("strand"), revcomp(F.upper("seq")).alias("s")))).alias("o"))
    own = kmers(strands.select("id", "o.strand", "o.s"), F.col("s"), step, "id", "strand")
    votes = own.join(library.withColumnRenamed("kmer", "_w"), F.col("kmer") == F.col("_w")).groupBy("id", "allele", "strand", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.count(F.lit(1)).alias("votes"))
    best = F.row_number().over(Window.partitionBy("id", "allele").orderBy(F.desc("votes"), "strand", "diagonal"))
    top = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("votes"), "allele"))
    return votes.withColumn("_b", best).where("_b = 1").withColumn("_t", top).where(F.col("_t") <= keep).select("id", "allele", "diagonal", "strand", "votes")

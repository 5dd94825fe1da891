"""Repertoire tables derived from the given ones by SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lymphlake.plans.tables import dealt, table


def _dna(key: str) -> str:
    return f"translate(md5({key}), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def _letter(letters: str, at: str) -> str:
    return f"substr('{letters}', CAST({at} AS INT), 1)"


#: name -> (tables and views it reads, SQL with those in braces)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "rearrangements": (
        ("orders",),
        f"""SELECT lpad(CAST(o_orderkey AS STRING), 8, '0') AS sequence_id, 'cell' || CAST(o_orderkey % 2000 AS STRING) AS cell_id,
  'src' || CAST(o_orderkey % 3 AS STRING) AS source_repertoire, CAST(year(o_orderdate) AS INT) AS timepoint, locus,
  locus || 'V' || CAST(1 + g % 7 AS STRING) || '-' || CAST(1 + g % 5 AS STRING) || '*0' || CAST(1 + o_orderkey % 2 AS STRING) AS v_call,
  locus || 'J' || CAST(1 + g % 4 AS STRING) || '*01' AS j_call,
  'TGT' || substr({_dna("CAST(g AS STRING)")}, 1, CAST(15 + 3 * (g % 5) AS INT)) || {_letter("ACGT", "1 + o_orderkey % 4")} || 'GTGG' AS junction,
  CASE WHEN o_orderkey % 20 < 12 THEN 'good' WHEN o_orderkey % 20 < 14 THEN 'stop' WHEN o_orderkey % 20 < 16 THEN 'indel'
       WHEN o_orderkey % 20 < 18 THEN 'nonproductive' WHEN o_orderkey % 20 = 18 THEN 'noCDR3' ELSE 'noJ' END AS status,
  CAST(1 + o_orderkey % 9 AS BIGINT) AS duplicate_count, CAST(700 + o_orderkey % 300 AS DOUBLE) / 1000 AS v_identity
FROM (SELECT *, o_custkey % 300 AS g, CASE WHEN (o_custkey % 300) % 10 < 6 THEN 'IGH' WHEN (o_custkey % 300) % 10 < 8 THEN 'IGK' ELSE 'IGL' END AS locus FROM {{orders}})""",
    ),
    "hits": (
        ("lineitem",),
        """SELECT lpad(CAST(l_orderkey AS STRING), 8, '0') AS qid,
  'IGHV' || CAST(1 + l_partkey % 7 AS STRING) || '-' || CAST(1 + l_suppkey % 9 AS STRING) || '*0' || CAST(1 + l_linenumber % 3 AS STRING) AS sid,
  CAST(100.0 - l_discount * 100 AS DOUBLE) AS identity, CAST(l_quantity AS DOUBLE) AS score, CAST(1 + l_linenumber AS INT) AS qstart, CAST(200 + l_linenumber AS INT) AS qend,
  CAST(1 + l_suppkey % 20 AS INT) AS sstart, CAST(200 + l_suppkey % 90 AS INT) AS send, CASE WHEN l_returnflag = 'R' THEN 'minus' ELSE 'plus' END AS strand,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS hit_rank
FROM {lineitem}""",
    ),
    "germline": (
        ("hits",),
        f"""SELECT allele, split_part(allele, '*', 1) AS gene, 'IGH' AS locus, 'V' AS segment, {_dna("allele")} || {_dna("'b' || allele")} || 'TGTGCG' AS seq
FROM (SELECT DISTINCT sid AS allele FROM {{hits}})""",
    ),
    "aligned_residues": (
        ("lineitem",),
        f"""SELECT 'IGHV' || CAST(1 + l_suppkey % 7 AS STRING) AS vgene, l_orderkey AS read_id, CAST(l_linenumber AS INT) AS pos,
  {_letter("ACDEFGHIKLMNPQRSTVWYX-", "1 + l_partkey % 22")} AS aa, {_letter("ACDEFGHIKLMNPQRSTVWY", "1 + (l_linenumber * 3 + 1 + l_suppkey % 7) % 20")} AS germ_aa,
  CAST(1 + l_orderkey % 3 AS INT) AS prof FROM {{lineitem}}""",
    ),
    "iddiv": (
        ("lineitem",),
        """SELECT l_orderkey * 10 + l_linenumber AS sequence_id, CAST(l_partkey % 3 AS INT) AS referent, CAST(l_discount * 600 AS DOUBLE) AS germ_div,
  CAST(40 + l_quantity * 1.2 AS DOUBLE) AS identity, CAST(year(l_shipdate) AS INT) AS timepoint FROM {lineitem}""",
    ),
    "umi_reads": (
        ("events",),
        f"""SELECT event_id, 'cell' || CAST(user_id % 30 AS STRING) AS cell, substr({_dna("CAST(event_id % 50 AS STRING)")}, 1, 8) AS umi,
  substr({_dna("'s' || CAST(event_id % 50 AS STRING)")}, 1, 30) || {_letter("ACGT", "1 + event_id % 4")} AS seq, event_type AS feature FROM {{events}}""",
    ),
    "mcmc_log": (("orders",), "SELECT o_orderkey AS sample, CAST(o_totalprice / 1000000 AS DOUBLE) AS rate FROM {orders}"),
}


#: Views whose windows sort their whole input: view -> (table, key of the windows).
SORTED = {"hits": ("lineitem", "l_orderkey")}


def view(spark: SparkSession, sf_dir: str, name: str, sorted_rows: bool = False) -> DataFrame:
    """A derived table as a lazy plan over the given ones.

    With ``sorted_rows`` the input of a view's windows is dealt by their key to
    as many tasks as its rows ask for; only for queries that need what the windows give.
    """
    reads, sql = VIEWS[name]
    inputs = {r: view(spark, sf_dir, r) if r in VIEWS else table(spark, sf_dir, r) for r in reads}
    if sorted_rows and name in SORTED:
        r, key = SORTED[name]
        inputs[r] = dealt(inputs[r], inputs[r].count(), key)
    return spark.sql(sql, **inputs)


def ctes(*names: str) -> str:
    """``name AS (...)`` clauses for DuckDB, in an order that resolves them."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        reads, sql = VIEWS[name]
        for r in reads:
            if r in VIEWS:
                add(r)
        done[name] = f"{name} AS (\n{sql.format(**{r: r for r in reads})}\n)"

    for name in names:
        add(name)
    return ",\n".join(done.values())

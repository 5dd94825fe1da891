"""Row filters: rule texts become Column trees, lists become semi joins."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lymphlake.functions.seq import all_of, any_of, gene_of

_NUMERIC = {"==": "__eq__", "!=": "__ne__", ">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__"}


def rule_column(df: DataFrame, rule: str) -> Column:
    """Condition of one rule ``COLUMN,OP,VALUE``.

    ``=~ !~`` regular expression; ``eq ne`` strings; ``is not`` truth of the
    column (VALUE is ignored); ``== != > >= < <=`` numbers. A VALUE in
    backticks is another column. Nulls never fit, except for ``not``.
    """
    name, op, value = [*rule.split(",", 2), ""][:3]
    if name not in df.columns:
        raise ValueError(f"no column {name}")
    left, other = F.col(f"`{name}`"), re.fullmatch(r"`(.+)`", value)
    right = F.col(f"`{other[1]}`") if other else F.lit(value)
    if op in ("=~", "!~"):
        found = F.regexp_like(left.cast("string"), right.cast("string"))
        return found if op == "=~" else ~found
    if op in ("eq", "ne"):
        same = left.cast("string") == right.cast("string")
        return same if op == "eq" else ~same
    if op in ("is", "not"):
        true = F.coalesce(~F.lower(left.cast("string")).isin("", "f", "false", "0", "0.0"), F.lit(False))
        return true if op == "is" else ~true
    if op in _NUMERIC:
        return getattr(left.cast("double"), _NUMERIC[op])(right.cast("double"))
    raise ValueError(f"unknown operator {op}")


def filter_rules(df: DataFrame, rules: list[str], lists: dict[str, DataFrame] | None = None, any_rule: bool = False) -> DataFrame:
    """Rows that fit all rules (or any); ``COLUMN,-,NAME`` and ``COLUMN,!-,NAME`` keep or drop by a one-column list.

    Lists are joined, never collected; the planner broadcasts those that are small.
    """
    tests = []
    for i, rule in enumerate(rules):
        name, op, value = [*rule.split(",", 2), ""][:3]
        if op in ("-", "!-"):
            ids = lists[value].select(F.col(lists[value].columns[0]).cast("string").alias(f"_l{i}")).distinct()
            if not any_rule:
                df = df.join(ids, F.col(f"`{name}`").cast("string") == F.col(f"_l{i}"), "left_semi" if op == "-" else "left_anti")
                continue
            df = df.join(ids, F.col(f"`{name}`").cast("string") == F.col(f"_l{i}"), "left")
            tests.append(F.col(f"_l{i}").isNotNull() if op == "-" else F.col(f"_l{i}").isNull())
        else:
            tests.append(rule_column(df, rule))
    if tests:
        df = df.where(any_of(tests) if any_rule else all_of(tests))
    return df.drop(*[c for c in df.columns if re.fullmatch(r"_l\d+", c)])


def length_filter(reads: DataFrame, least: int = 300, most: int = 600, column: str = "seq") -> DataFrame:
    return reads.where(F.length(column).between(least, most))


def annotation_search(reads: DataFrame, patterns: list[str], most: int | None = None) -> DataFrame:
    """Reads whose description fits any pattern; the first ``most`` by id if asked for."""
    found = reads.where(any_of([F.col("description").rlike(p) for p in patterns]))
    return found if most is None else found.orderBy("id").limit(most)


def v_gene_filter(table: DataFrame, gene: str) -> DataFrame:
    """Rows whose first V call is of the gene, whatever the allele."""
    return table.where(gene_of(F.col("v_call")) == gene)


def statistic_subset(table: DataFrame, subset: str, ids: DataFrame | None = None) -> DataFrame:
    """``all``, ``orf`` (good or unique), ``unique`` (a cluster_count), or the ids of a list."""
    if subset == "list":
        return table.join(ids.select(F.col(ids.columns[0]).alias("_id")).distinct(), F.col("sequence_id") == F.col("_id"), "left_semi")
    keep = {"all": F.lit(True), "orf": F.col("status").isin("good", "unique"), "unique": F.col("cluster_count").isNotNull() if "cluster_count" in table.columns else F.lit(False)}
    return table.where(keep[subset])


def clone_input(table: DataFrame, which: str = "good", single_cell: bool = False) -> DataFrame:
    """Rows that clones are made of: ``all`` (a junction), ``good``, ``unique`` (own centroid) or ``paired`` cells.

    With ``single_cell`` rows of cells whose status speaks of several cells or
    of none (``multi``, ``none`` in it) go first, and so do rows without a cell
    status; ``paired`` asks for a canonical pair instead and for nothing else.
    """
    keep = {"all": F.col("junction") != "", "good": F.col("status") == "good"}
    if which == "paired":
        return table.where(F.col("cell_status") == "canonical_pair")
    rows = table.where(~F.col("cell_status").rlike("multi|none")) if single_cell else table
    return rows.where(F.col("centroid") == F.col("sequence_id")) if which == "unique" else rows.where(keep[which])


def junction_sane(table: DataFrame, least: int = 15) -> DataFrame:
    return table.where((F.length("junction") >= least) & (F.coalesce("v_call", F.lit("")) != "") & (F.coalesce("j_call", F.lit("")) != ""))


def v_remainder(reads: DataFrame, least: int = 30) -> DataFrame:
    """``rest``: what follows the V hit, in the V hit's direction; kept if longer than ``least``."""
    from lymphlake.functions.seq import revcomp

    rest = F.when(F.col("strand") == "plus", F.substr("seq", F.col("qend") + 1)).otherwise(revcomp(F.substr("seq", F.lit(1), F.col("qstart") - 1)))
    return reads.withColumn("rest", rest).where(F.length("rest") > least)


def frameshift_free(aligned: DataFrame, query: str = "query_aln", germline: str = "germ_aln") -> DataFrame:
    """Rows without a gap that is not a whole codon, end gaps aside, in either aligned row."""

    def odd(c):
        return F.regexp_replace(F.regexp_replace(F.col(c), "^-+|-+$", ""), "---", "").contains("-")

    return aligned.where(~odd(query) & ~odd(germline))


def mutated(residues: DataFrame) -> DataFrame:
    """Reads of ``read_id, pos, aa, germ_aa`` with a difference from germline that is neither X nor a gap."""
    hit = ~F.col("aa").isin("X", "-") & (F.col("aa") != F.col("germ_aa"))
    return residues.groupBy("read_id").agg(F.count(F.when(hit, 1)).alias("n_mutations")).where(F.col("n_mutations") > 0)


def in_polygon(points: DataFrame, polygons: DataFrame, x: str = "germ_div", y: str = "identity") -> DataFrame:
    """Points inside the polygon of their referent: ``polygons`` has ``referent, vertices array<struct<x,y>>``.

    One row a polygon, so the side that is joined is as small as the number of
    referents; a ray to the right crosses an odd number of edges.
    """
    edges = F.zip_with("vertices", F.concat(F.slice("vertices", 2, F.size("vertices")), F.slice("vertices", 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    px, py = F.col(x), F.col(y)

    def crosses(e):
        a, b = e["a"], e["b"]
        return ((a["y"] > py) != (b["y"] > py)) & (px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"])

    joined = points.join(polygons.withColumnRenamed("referent", "_referent"), F.col("referent") == F.col("_referent"))
    return joined.where(F.size(F.filter(edges, crosses)) % 2 == 1).select(points.columns)

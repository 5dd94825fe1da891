"""A Merkle manifest of a table: digests of rows, a tree per group, a tree of the groups, and a proof per row.

Nodes of a level are rows with their place in their group. Lag and lead columns
at the fixed offsets 1 to fan - 1, masked by the node's slot in its run and by
the run's length, hold its siblings; the run's first child hashes the parent.
Windows and joins are keyed by (group, run), so no task ever needs more of a
group than what Spark deals to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.llm.common import id_crc32
from lymphlake.operators.order import ranked
from lymphlake.plans.tables import few_files, written

#: Children of a node.
FAN = 8
#: The columns that a row's digest covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values' texts in a row; null counts as empty."""
    return F.sha2(F.concat(*[F.coalesce(v.cast("string"), F.lit("")) for v in values]).cast("binary"), 256)


def framed(value: Column) -> Column:
    """A value so that neighbours cannot run into each other: its UTF-8 byte count, ``:``, its text; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """``nodes`` (group, pos, n, digest, ...) with ``run``, and ``left`` and ``right``: the run's digests before and after."""
    run, slot = F.floor(F.col("pos") / fan), F.col("pos") % fan
    length = F.least(F.lit(fan), F.col("n") - run * fan)
    within = Window.partitionBy("group", "run").orderBy("pos")
    none = F.lit("")
    left = [F.coalesce(F.when(slot >= k, F.lag("digest", k).over(within)), none) for k in range(fan - 1, 0, -1)]
    right = [F.coalesce(F.when(slot + k < length, F.lead("digest", k).over(within)), none) for k in range(1, fan)]
    return nodes.withColumn("run", run).withColumns({"left": F.concat(*left), "right": F.concat(*right)})


def tree(nodes: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """The levels of every group's tree, leaves first: ``group, pos, n, digest`` (``n``: nodes of the group on that level).

    ``nodes`` is such a table of leaves. The last level has one node a group,
    its root. Groups that end earlier keep their root as it is.
    """
    levels = [nodes]
    most, rows, groups = nodes.agg(F.max("n"), F.count(F.lit(1)), F.sum((F.col("pos") == 0).cast("long"))).first()
    most = most or 1
    while most > 1:
        parents = _siblings(levels[-1].select("group", "pos", "n", "digest"), fan).where(F.col("pos") % fan == 0)
        parents = parents.select(
            "group",
            F.col("run").alias("pos"),
            F.ceil(F.col("n") / fan).alias("n"),
            F.when(F.col("n") > 1, digest(F.col("digest"), F.col("right"))).otherwise(F.col("digest")).alias("digest"),
        )
        rows = (rows or 0) // fan + groups  # at most
        levels.append(written(few_files(parents, rows), "merkle-level"))
        most = -(-most // fan)
    return levels


def paths(levels: list[DataFrame], roots: DataFrame, fan: int = FAN) -> DataFrame:
    """The leaves with ``path``, an array of ``(left, right)`` from the leaf upwards, and the columns of ``roots``.

    ``roots`` has ``group``, a ``path`` that goes on above the group's root,
    and further columns.
    """
    more = [c for c in roots.columns if c not in ("group", "path")]
    above = roots.withColumn("pos", F.lit(0).cast("long"))
    for nodes in reversed(levels[:-1]):
        step = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast("array<struct<left:string,right:string>>"))
        up = above.select(F.col("group").alias("_group"), F.col("pos").alias("_pos"), F.col("path").alias("_path"), *more)
        met = _siblings(nodes, fan).join(up, (F.col("group") == F.col("_group")) & (F.col("run") == F.col("_pos")))
        above = met.select(*nodes.columns, F.concat(step, F.col("_path")).alias("path"), *more)
    if len(levels) == 1:
        above = levels[0].join(roots, "group")
    return above


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in its group by ``order``, and ``n``, the group's rows.

    Rows that the order cannot tell apart are spread by their place in the table.
    """
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    placed = ranked(salted, [F.col("group"), *[F.col(c).asc_nulls_first() for c in order], F.col("_salt")], "_rank", 0).drop("_salt")
    starts = placed.groupBy("group").agg(F.min("_rank").alias("_start"), F.count(F.lit(1)).alias("n"))
    return placed.join(starts, "group").withColumn("pos", F.col("_rank") - F.col("_start")).drop("_rank", "_start")


def manifest(leaves: DataFrame, order: list[str], fan: int = FAN) -> DataFrame:
    """``leaves`` (group, digest, further columns) with ``subroot``, ``root`` and ``path``.

    ``group`` must not be null. In a group leaves stand by ``order``, then by
    digest; equal leaves stand in any order. While a group has several nodes,
    each run of ``fan`` consecutive ones (the last one may be shorter, even of
    one) becomes its digest. The groups' roots, by group, make a tree in the
    same way. ``path`` lists from the leaf to the root what stands left and
    right of it in its run. An empty table gives an empty result.
    """
    # written: behind the join by group the windows would take its partitions, and a large group would be one task
    levels = tree(written(_placed(leaves, [*order, "digest"]), "merkle-leaves"), fan)
    groups = levels[-1].select(F.lit("").alias("group"), F.col("group").alias("of"), "digest")
    top = tree(written(_placed(groups, ["of"]), "merkle-groups"), fan)
    end = top[-1].select("group", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    roots = paths(top, end, fan).select(F.col("of").alias("group"), F.col("digest").alias("subroot"), "root", "path")
    return paths(levels, written(roots, "merkle-roots"), fan).select(*leaves.columns, "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]).cast("binary"), 256))


def document_manifest(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """Rows of ``documents`` as leaves, a tree per ``lang``: ``doc_id, leaf, altered, subroot, root, path``.

    A leaf covers :data:`FIELDS`, each framed by its length, ``-`` if null.
    ``altered`` is the digest of the row as it is handed over for the check:
    where 3 divides the CRC-32 of the id's decimal text, with ``text``'s A-Z
    lower-cased. Null lang: a group of its own, first. Null ids come first in
    their group and count as the empty text for the CRC. Repeated rows are
    leaves of their own. Texts are hashed where they are read and never move;
    further columns, whatever their names, are ignored.
    """
    at = {c: F.col(f"`{c}`") for c in FIELDS}
    leaf = digest(*[framed(at[c]) for c in FIELDS])
    changed = digest(*[framed(F.translate(at[c], _UPPER, _LOWER) if c == "text" else at[c]) for c in FIELDS])
    leaves = docs.select(
        at["doc_id"].alias("doc_id"),
        F.when(at["lang"].isNull(), "-").otherwise(F.concat(F.lit("="), at["lang"])).alias("group"),
        leaf.alias("digest"),
        F.when(id_crc32(at["doc_id"]) % 3 == 0, changed).alias("altered"),
    )
    found = manifest(written(leaves, "merkle-digests"), ["doc_id"], fan)
    return found.select("doc_id", F.col("digest").alias("leaf"), F.coalesce("altered", "digest").alias("altered"), "subroot", "root", "path")


def verify(found: DataFrame) -> DataFrame:
    """What :func:`document_manifest` gives, checked: each row's proof as a digest, the root that its path leads to, and whether it is the manifest's."""
    proof = F.concat_ws("", F.transform("path", lambda step: F.concat(step["left"], step["right"])))
    back = folded(F.col("altered"), F.col("path"))
    return found.select("doc_id", "leaf", "subroot", "root", digest(proof).alias("proof_sha256"), back.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))

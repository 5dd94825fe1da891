"""Chat formatting of reply trees: paths by self joins, a reversible template, loss spans."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.llm.common import sha256_hex
from lymphlake.plans.tables import written

# The strings that mean something to a chat template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROL = (OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escaped(text: Column) -> Column:
    r"""Backslashes are doubled and one is put behind the first character of a control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit(f"{s[0]}\\{s[1:]}")), CONTROL, out)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def linear_tree(turns: DataFrame) -> DataFrame:
    """Messages of a table ``conv_id, turn, role, text`` in which every row answers the one before.

    Rows of one conversation stand by turn (null first), then role and text,
    so ties and repeated rows have a fixed order. Gives ``tree, node, parent,
    role, text, score``. A null conv_id is a conversation of its own.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    n = F.row_number().over(order)
    return turns.select(F.col("conv_id").cast("long").alias("tree"), n.cast("long").alias("node"), F.when(n > 1, n - 1).cast("long").alias("parent"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.lit(0.0).alias("score"))


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """Root-to-leaf paths of reply trees: ``tree, leaf, rank, up, node`` with ``up`` 0 at the leaf.

    ``messages`` has ``tree, node, parent, score``, unique in (tree, node). A
    parent that is null or missing makes a root. Self joins double the
    reach of every node's ancestor pointer, so a path of n messages takes
    about log2(n) rounds; in each, the part of a leaf's path that is known is
    joined with the pointers to give the part of the same length above it.
    Branches are ranked by the mean score of their messages (null counts 0),
    then by length and leaf, and the ``best`` of each tree stay. Messages on a
    cycle have no root and leaf; branches that reach a cycle are left out.
    """
    nodes = messages.select(F.struct("tree", "node").alias("at"), F.struct("tree", "parent").alias("above"), F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    nodes = written(nodes, "chat-nodes")
    known = nodes.select(F.col("at").alias("k"))
    jump = nodes.where(F.col("above.parent").isNotNull()).select(F.col("at").alias("from"), F.struct(F.col("above.tree").alias("tree"), F.col("above.parent").alias("node")).alias("to"))
    jump = written(_hop(jump, known, "to", "k", "left_semi"), "chat-jump")
    answered = jump.select(F.col("to").alias("k")).distinct()
    path = _hop(nodes, answered, "at", "k", "left_anti").select(F.col("at").alias("leaf"), F.col("at").alias("at"), F.lit(0).cast("long").alias("up"))
    path, length, n = written(path, "chat-path"), 1, nodes.count()
    while length <= n and jump.take(1):
        step = jump.select(F.col("from").alias("f"), F.col("to").alias("t"))
        above = _hop(path, step, "at", "f", "inner").select("leaf", F.col("t").alias("at"), (F.col("up") + length).alias("up"))
        path = written(path.unionByName(above), "chat-path")
        jump = written(_hop(jump.select("from", "to"), step, "to", "f", "inner").select("from", F.col("t").alias("to")), "chat-jump")
        length *= 2
    scored = _hop(path, nodes.select(F.col("at").alias("k"), "score", F.col("above.parent").isNull().alias("_top")), "at", "k", "inner")
    branch = scored.groupBy("leaf").agg(F.avg("score").alias("mean"), F.count(F.lit(1)).alias("n"), F.max("up").alias("most"), F.countDistinct("at").alias("own"))
    branch = branch.where((F.col("n") == F.col("most") + 1) & (F.col("n") == F.col("own")))
    rank = F.row_number().over(Window.partitionBy("leaf.tree").orderBy(F.desc("mean"), F.desc("n"), F.col("leaf.node")))
    chosen = written(branch.select("leaf", rank.alias("rank")).where(F.col("rank") <= best).select(F.col("leaf").alias("l"), "rank"), "chat-chosen")
    return _hop(path, chosen, "leaf", "l", "inner").select(F.col("at.tree").alias("tree"), F.col("leaf.node").alias("leaf"), "rank", "up", F.col("at.node").alias("node"))


def _hop(left: DataFrame, right: DataFrame, a: str, b: str, how: str) -> DataFrame:
    """Join on (tree, node); trees with a null key are joined as equal."""
    both = F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree")) & (F.col(f"{a}.node") == F.col(f"{b}.node"))
    return left.join(right, both, how).drop(b) if how == "inner" else left.join(right, both, how)


def format_trees(messages: DataFrame, best: int = 1, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per chosen path: ``tree, leaf, rank, formatted, loss``.

    ``messages`` has ``tree, node, parent, role, text, score``. ``formatted``
    marks each turn as ``<|im_start|>role\\ntext<|im_end|>\\n`` with control
    strings and backslashes inside role and text escaped; a line end in a role
    is escaped too. ``loss`` is an array of structs ``start, end`` (code
    points, end exclusive) of the texts of trained roles, also the empty ones.
    Null roles and texts count as empty. A conversation becomes one value, so
    one conversation must fit in a task; that is the format's own bound.
    """
    messages = written(messages.select("tree", "node", "parent", "role", "text", "score"), "chat-messages")
    body = messages.select(F.struct("tree", "node").alias("k"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = _hop(paths(messages, best).select(F.struct("tree", "node").alias("at"), "leaf", "rank", "up"), body, "at", "k", "inner")
    head = F.concat(F.lit(OPEN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    tail = CLOSE + "\n"
    turns = turns.select(F.col("at.tree").alias("tree"), "leaf", "rank", (-F.col("up")).alias("pos"), head.alias("head"), escaped(F.col("text")).alias("text"), F.col("role").isin(*trained).alias("trained"))
    # where a turn's text begins is a running sum over the turns, so spans cost one pass
    size = F.char_length("head") + F.char_length("text") + len(tail)
    before = F.sum(size).over(Window.partitionBy("tree", "leaf", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    begin = F.coalesce(before, F.lit(0)) + F.char_length("head")
    placed = turns.select("tree", "leaf", "rank", F.struct("pos", "head", "text", "trained", begin.cast("long").alias("start"), (begin + F.char_length("text")).cast("long").alias("end")).alias("t"))
    whole = placed.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    formatted = F.concat_ws("", F.transform("ts", lambda t: F.concat(t["head"], t["text"], F.lit(tail))))
    loss = F.transform(F.filter("ts", lambda t: t["trained"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return whole.select("tree", "leaf", "rank", formatted.alias("formatted"), loss.alias("loss"))


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns ``(role, text)`` of a formatted conversation, unescaped."""
    out = []
    for turn in formatted.split(CLOSE + "\n")[:-1]:
        m = re.match(re.escape(OPEN) + r"((?:[^\\\n]|\\.)*)\n", turn, flags=re.DOTALL)
        out.append((unescape(m[1]), unescape(turn[m.end() :])))
    return out


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for tree, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("tree", "formatted", "loss")), strict=True):
            turns = parse(formatted)
            learned = "".join(unescape(formatted[s["start"] : s["end"]]) for s in loss)
            rows.append((tree, len(turns), sha256_hex("".join(f"{r}\n{t}\n" for r, t in turns).encode()), len(learned), sha256_hex(learned.encode()), len(formatted)))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in DIGEST_SCHEMA.split(", ")])


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from ``format_trees``: turns and loss text, as digests."""
    return formatted.select("tree", "formatted", "loss").mapInArrow(_digests, DIGEST_SCHEMA)

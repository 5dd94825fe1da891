"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.llm.common import n_words
from lymphlake.plans.tables import written

#: Weights of the sources in code-point order, repeating; null comes last.
WEIGHTS = (5, 2, 1)
#: The mix holds this share of all words, and a source at most so many passes.
SHARE, PASSES = 1.5, 2


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """One row a source: ``source, source_size, n_docs, target``.

    ``sizes`` has ``source, size``. A budget of ``share`` times all words is
    dealt by weight; a source stops at ``passes`` times its size and what it
    cannot take is dealt again by weight. That fixed point is a water level:
    with sources ordered by cap / weight, the level is the first
    (budget - caps so far) / (weights left) that no later source's ratio is
    below. The windows run over one row per source, not over documents.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    per = (
        sizes.groupBy("source")
        .agg(F.sum("size").cast("double").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(every) - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * passes)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    whole = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    budget = F.sum("source_size").over(whole) * share
    per = per.withColumn("level", (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / left)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("source").isNull().alias("none"), "source", "level"))).over(whole)
    per = per.withColumn("level", first["level"])
    return per.select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        "n_docs",
        F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def fair_mix(docs: DataFrame, size: str | None = None, seed: int = 0, weights: tuple = WEIGHTS, share: float = SHARE, passes: int = PASSES, slot_rows: int = 128, range_rows: int = 1 << 20) -> DataFrame:
    """Take documents until the mix is full; every column of ``docs`` stays.

    ``docs`` needs ``doc_id, text, source``, or ``doc_id, source`` and a
    column of sizes named by ``size``; the results ``size, source_size,
    target, taken`` replace columns of those names. Documents stand in
    the order of ``md5(doc_id:seed)`` within their source. A copy's virtual
    finish time is the source's words up to its end, earlier passes included,
    divided by the source's target. All copies are ordered by that time and
    taken until the budget is reached; the copy that crosses the budget is
    taken if at least half of it fits.

    No task holds a source: its documents are dealt to hash slots of about
    ``max(slot_rows, sqrt(n))`` rows, running sums are taken within slots and
    over the slots' totals. All copies are then range-sorted by finish time
    and the order is cut at the budget; the range of the cut is sorted into
    ranges again until one task's running sum covers at most ``range_rows``
    copies.

    Null text: size 0, nothing taken. Null source: a source of its own, last.
    Null ids are shuffled as the empty text. Repeated rows are separate
    documents. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.col("source").alias("_source"),
        (F.coalesce(F.col(size), F.lit(0)).cast("long") if size else n_words(F.col("text"))).alias("_size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))).alias("_key"),
    )
    return _queued(base, kept, source_targets(base.select(F.col("_source").alias("source"), F.col("_size").alias("size")), weights, share, passes), share, passes, slot_rows, range_rows)


def _queued(base: DataFrame, kept: list[str], targets: DataFrame, share: float, passes: int, slot_rows: int, range_rows: int) -> DataFrame:
    per = written(targets, "mix-sources").select(F.col("source").alias("_of"), *[F.col(c).alias(f"_{c}") for c in ("source_size", "n_docs", "target")])
    slots = F.ceil(F.col("_n_docs") / F.greatest(F.lit(float(slot_rows)), F.sqrt(F.col("_n_docs"))))
    unit = F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / float(2**32)
    placed = base.join(per, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")
    placed = placed.withColumn("_slot", F.floor(unit * slots).cast("long"))
    in_slot = Window.partitionBy("_source", "_slot").orderBy("_key", "_size").rowsBetween(Window.unboundedPreceding, 0)
    summed = written(placed.withColumn("_cum", F.sum("_size").over(in_slot)), "mix-slots")

    totals = summed.groupBy("_source", "_slot").agg(F.sum("_size").alias("_total"))
    earlier = Window.partitionBy("_source").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_source").alias("_s"), F.col("_slot").alias("_t"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    offsets = written(offsets, "mix-offsets")
    run = summed.join(offsets, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_slot") == F.col("_t")), "left")
    end = F.col("_offset") + F.col("_cum")

    def finish(copy: int):
        return F.when(F.col("_target") > 0, (F.col("_source_size") * copy + end).cast("double") / F.col("_target"))

    times = run.select("_source", "_key", "_size", F.explode(F.array(*[F.struct(F.lit(e).alias("copy"), finish(e).alias("finish")) for e in range(passes)])).alias("_c")).where(F.col("_c.finish").isNotNull() & (F.col("_size") > 0))
    times = times.select("_source", "_key", "_size", "_c.copy", "_c.finish")
    edge = _budget_edge(times, summed.agg(F.sum("_size").alias("n")), share, range_rows)
    if edge is None:
        copies = F.lit(0)
    else:
        source = F.struct(F.col("_source").isNull().alias("none"), F.coalesce(F.col("_source").cast("string"), F.lit("")).alias("source"))
        last = F.struct(F.lit(edge["none"]).alias("none"), F.lit(edge["source"]).alias("source"))
        copies = F.lit(0)
        for e in range(passes):
            mine = F.struct(finish(e).alias("f"), F.lit(e).alias("e"), source.alias("s"), F.col("_key").alias("k"), F.col("_size").alias("z"))
            most = F.struct(F.lit(edge["finish"]).alias("f"), F.lit(edge["copy"]).alias("e"), last.alias("s"), F.lit(edge["key"]).alias("k"), F.lit(edge["size"]).cast("long").alias("z"))
            copies = copies + F.when((F.col("_size") > 0) & (mine <= most), 1).otherwise(0)
    return run.select(
        *[F.col(f"_row.`{c}`") for c in kept],
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * copies).cast("long").alias("taken"),
    )


def _budget_edge(times: DataFrame, whole: DataFrame, share: float, range_rows: int):
    """The last copy that is taken: all copies are range-sorted by finish time and cut where their words reach the budget.

    Spark samples the order and deals the copies to ranges; each is sorted by
    itself. The ranges' sums, one row each, tell which ranges are taken whole
    and in which one the budget ends. While that range has more than
    ``range_rows`` copies it is range-sorted again by itself; then it is cut
    at its running sum.
    """
    n = whole.first()["n"]
    if not n:
        return None
    budget = n * share
    order = ("finish", "copy", F.col("_source").asc_nulls_last(), "_key", "_size")
    row = F.struct("finish", "copy", F.col("_source").isNull().alias("none"), F.coalesce(F.col("_source").cast("string"), F.lit("")).alias("source"), F.col("_key").alias("key"), F.col("_size").alias("size"))
    inside, before, rows, earlier = times, 0, None, []
    while rows is None or rows > range_rows:
        ranges = inside.repartitionByRange(*order) if rows is None else inside.repartitionByRange(4 * -(-rows // range_rows), *order)
        queue = written(ranges.sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()), "mix-queue")
        sums = queue.groupBy("_range").agg(F.sum("_size").alias("n"), F.count(F.lit(1)).alias("rows"))
        upto = sums.select("_range", "rows", (F.sum("n").over(Window.orderBy("_range")) - F.col("n") + before).alias("before"))
        cut = upto.where(F.col("before") <= budget).orderBy(F.desc("_range")).first()
        earlier.append(queue.where(F.col("_range") < cut["_range"]))
        inside, before = queue.where(F.col("_range") == cut["_range"]).drop("_range"), cut["before"]
        if rows == cut["rows"]:  # copies that no order tells apart
            break
        rows = cut["rows"]
    upto = F.sum("_size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + before
    last = inside.withColumn("_sum", upto).where(F.col("_sum") - F.col("_size") / 2 <= budget).agg(F.max(row).alias("last")).first()["last"]
    while last is None and earlier:  # the range's first copy does not fit: all earlier ranges are in
        last = earlier.pop().agg(F.max(row).alias("last")).first()["last"]
    return last

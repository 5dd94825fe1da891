"""Histograms, densities, summaries and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.operators.order import ranked


def histogram(table: DataFrame, value: Column, width: float) -> DataFrame:
    """``bin, n``: counts in bins of ``width``, empty bins between the first and last kept.

    The spine is made of the counted bins, so the values are read once.
    """
    counts = table.select(F.floor(value / width).cast("long").alias("b")).where(F.col("b").isNotNull()).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    spine = counts.agg(F.min("b").alias("lo"), F.max("b").alias("hi")).where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("s"))
    return spine.join(counts, F.col("s") == F.col("b"), "left").select((F.col("s") * width).cast("double").alias("bin"), F.coalesce("n", F.lit(0)).alias("n"))


def log_histogram(table: DataFrame, value: Column, step: float = 0.2) -> DataFrame:
    return histogram(table, F.when(value > 0, F.log10(value) + 1e-9), step)


def category_counts(table: DataFrame, column: Column) -> DataFrame:
    return table.groupBy(column.alias("category")).agg(F.count(F.lit(1)).alias("n"))


def custom_order(counts: DataFrame, first: list[str]) -> DataFrame:
    """Adds ``place``: listed categories first, then numbers by value, then text. One row a category."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in first]), F.col("category")), F.lit(0))
    number = F.expr("try_cast(category as double)")
    order = Window.orderBy(F.when(rank > 0, rank).otherwise(len(first) + 1), number.asc_nulls_last(), "category")
    return counts.withColumn("place", F.row_number().over(order))


def series(tables: dict[str, DataFrame]) -> DataFrame:
    """Several results one under the other, with their names in ``series``."""
    out = None
    for name, table in tables.items():
        mine = table.withColumn("series", F.lit(name))
        out = mine if out is None else out.unionByName(mine)
    return out


def percent_within(counts: DataFrame, by: str = "series") -> DataFrame:
    return counts.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(by)))


def _cell(value: Column, low: float, high: float, bins: int) -> Column:
    """Right-closed bin from 1, the lowest value in the first; null outside."""
    at = F.greatest(F.ceil((value - low) / ((high - low) / bins)), F.lit(1))
    return F.when((value >= low) & (value <= high), F.least(at, F.lit(bins))).cast("int")


def grid_histogram(points: DataFrame, *by: str, bins: int = 99) -> DataFrame:
    """``bx, by, n`` over divergence 0 to 60 and identity 40 to 100 (per key of ``by``), empty cells kept."""
    cells = points.select(*by, _cell(F.col("germ_div"), 0, 60, bins).alias("bx"), _cell(F.col("identity"), 40, 100, bins).alias("by")).where(F.col("bx").isNotNull() & F.col("by").isNotNull())
    counts = cells.groupBy(*by, "bx", "by").agg(F.count(F.lit(1)).alias("n"))
    keys = points.select(*by).distinct() if by else points.sparkSession.range(1).select()
    side = F.sequence(F.lit(1), F.lit(bins))
    spine = keys.withColumn("_x", F.explode(side)).withColumn("_y", F.explode(side)).withColumnsRenamed({b: f"_{b}" for b in by})
    same = [F.col(f"_{b}").eqNullSafe(F.col(b)) for b in by] + [F.col("_x") == F.col("bx"), F.col("_y") == F.col("by")]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return spine.join(counts, on, "left").select(*[F.col(f"_{b}").alias(b) for b in by], F.col("_x").alias("bx"), F.col("_y").alias("by"), F.coalesce("n", F.lit(0)).alias("n"))


def kernel_density(points: DataFrame, *by: str, grid: int = 100, h: float = 1.0) -> DataFrame:
    """``gx, gy, density`` (per key of ``by``): Gaussian kernel density on a grid over the same limits.

    Equal points are summed first. A point meets only grid nodes within four
    bandwidths, which bounds its fan-out by the grid and not by the data.
    """
    counted = points.where(F.col("germ_div").between(0, 60) & F.col("identity").between(40, 100)).groupBy(*by, "germ_div", "identity").agg(F.count(F.lit(1)).alias("w"))
    step = 60.0 / (grid - 1)
    sd = h / 4.0

    def near(c, low):
        a, b = F.ceil((c - low - 4 * h) / step), F.floor((c - low + 4 * h) / step)
        return F.sequence(F.greatest(a, F.lit(0)), F.least(b, F.lit(grid - 1)))

    rows = counted.withColumn("gx", F.explode(near(F.col("germ_div"), 0))).withColumn("gy", F.explode(near(F.col("identity"), 40)))
    zx, zy = (F.col("germ_div") - F.col("gx") * step) / sd, (F.col("identity") - 40 - F.col("gy") * step) / sd
    sums = rows.groupBy(*by, "gx", "gy").agg(F.sum(F.col("w") * F.exp(-(zx * zx + zy * zy) / 2)).alias("s"))
    total = counted.groupBy(*[F.col(b).alias(f"_{b}") for b in by]).agg(F.sum("w").alias("total"))
    both = sums.join(total, reduce(lambda x, y: x & y, [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by])) if by else sums.join(total, how="cross")
    return both.select(*by, F.col("gx").cast("int").alias("gx"), F.col("gy").cast("int").alias("gy"), (F.col("s") / (F.col("total") * 2 * 3.141592653589793 * sd * sd)).alias("density"))


def flagged_points(points: DataFrame, listed: DataFrame, flag: str) -> DataFrame:
    """Points with a flag whether their id is in a list: the overlay of a sieve."""
    ids = listed.select(F.col(listed.columns[0]).alias("_id")).distinct().withColumn(flag, F.lit(True))
    return points.join(ids, F.col("sequence_id") == F.col("_id"), "left").drop("_id").withColumn(flag, F.coalesce(flag, F.lit(False)))


def quality_by_position(reads: DataFrame) -> DataFrame:
    """``pos, n, mean, median`` of phred values; counts per (place, value) come first, so a place never gathers all reads."""
    from lymphlake.functions.seq import phred

    values = reads.select(F.posexplode(phred(F.col("qual"))).alias("pos", "q")).groupBy("pos", "q").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("pos").orderBy("q"))
    total = F.sum("n").over(Window.partitionBy("pos"))
    marked = values.withColumn("_half", F.when(upto * 2 >= total, F.col("q")))
    return marked.groupBy("pos").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("q")) / F.sum("n")).alias("mean"), F.min("_half").alias("median"))


def posterior_summary(log: DataFrame, burn_in: float = 10.0, mass: float = 0.95) -> DataFrame:
    """``n, mean, median, se, hpd_low, hpd_high`` of a rate after dropping the first ``burn_in`` percent of samples.

    The shortest interval that holds ``mass`` of the sorted values. Samples
    and rates are ranked by ranges; an interval is a join of ranks.
    """
    n = log.count()
    skip = int(n * burn_in / 100)
    rows = ranked(log, [F.asc("sample"), F.asc("rate")], "_n").where(F.col("_n") > skip).drop("_n")
    left = n - skip
    k = max(1, int(left * mass + 0.5))
    by_rate = ranked(rows, [F.asc("rate"), F.asc("sample")], "_r").select("rate", "_r")
    ends = by_rate.select(F.col("rate").alias("_end"), (F.col("_r") - (k - 1)).alias("_e"))
    spans = by_rate.join(ends, F.col("_r") == F.col("_e"))
    best = spans.agg(F.min(F.struct(F.round(F.col("_end") - F.col("rate"), 12).alias("w"), F.col("rate").alias("lo"), F.col("_end").alias("hi"))).alias("s"))
    middle = F.col("_r").isin((left + 1) // 2, left // 2 + 1)
    agg = by_rate.agg(F.count(F.lit(1)).alias("n"), F.avg("rate").alias("mean"), F.avg(F.when(middle, F.col("rate"))).alias("median"), (F.stddev_samp("rate") / F.sqrt(F.count(F.lit(1)))).alias("se"))
    return agg.join(best, how="cross").select("n", "mean", "median", "se", F.col("s.lo").alias("hpd_low"), F.col("s.hi").alias("hpd_high"))


def per_timepoint(table: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows of each time point in the order of an md5 of id and seed, all if there are fewer."""
    order = F.md5(F.concat_ws(":", "sequence_id", F.lit(str(seed))))
    rank = F.row_number().over(Window.partitionBy("timepoint").orderBy(order, "sequence_id"))
    return table.withColumn("_n", rank).where(F.col("_n") <= n).drop("_n")


def shuffled_batches(table: DataFrame, size: int = 250, seed: int = 0) -> DataFrame:
    """Adds ``batch``: rows in the order of an md5 of id and seed, dealt to batches of exactly ``size``; no task sees all rows."""
    key = F.md5(F.concat_ws(":", F.col("sequence_id").cast("string"), F.lit(str(seed))))
    rows = ranked(table.withColumn("_key", key), [F.asc("_key"), F.asc("sequence_id")], "_place", 0)
    return rows.withColumn("batch", F.floor(F.col("_place") / size).cast("int")).drop("_key", "_place")

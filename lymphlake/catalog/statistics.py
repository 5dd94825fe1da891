"""Histogram, density and sampling queries."""

from pyspark.sql import functions as F

from lymphlake.catalog.registry import query
from lymphlake.functions.seq import gene_of
from lymphlake.operators import stats as T
from lymphlake.operators.rules import statistic_subset
from lymphlake.plans.views import view


@query(
    "rearrangements", ctes_more="b AS (SELECT CAST(floor((100 * (1 - v_identity) + 1e-9) / 5) AS BIGINT) AS b, count(*) AS n FROM rearrangements WHERE duplicate_count > 7 GROUP BY 1)",
    sql="SELECT CAST(s * 5 AS DOUBLE) AS bin, coalesce(n, 0) AS n FROM (SELECT unnest(range((SELECT min(b) FROM b), (SELECT max(b) + 1 FROM b))) AS s) LEFT JOIN b ON b = s",
)
def divergence_histogram(spark, d):
    return T.histogram(view(spark, d, "rearrangements").where("duplicate_count > 7"), 100 * (1 - F.col("v_identity")) + 1e-9, 5.0)


@query(
    "rearrangements", ctes_more="b AS (SELECT CAST(floor((log10(t) + 1e-9) / 0.2) AS BIGINT) AS b, count(*) AS n FROM (SELECT sum(duplicate_count) AS t FROM rearrangements GROUP BY junction) GROUP BY 1)",
    sql="SELECT CAST(s * 0.2 AS DOUBLE) AS bin, coalesce(n, 0) AS n FROM (SELECT unnest(range((SELECT min(b) FROM b), (SELECT max(b) + 1 FROM b))) AS s) LEFT JOIN b ON b = s", rounded=("bin",))
def log_size_histogram(spark, d):
    sizes = view(spark, d, "rearrangements").groupBy("junction").agg(F.sum("duplicate_count").alias("t"))
    return T.log_histogram(sizes, F.col("t"))


@query("rearrangements", sql="SELECT split_part(v_call, '*', 1) AS category, count(*) AS n FROM rearrangements GROUP BY 1")
def category_counts(spark, d):
    return T.category_counts(view(spark, d, "rearrangements"), gene_of(F.col("v_call")))


@query("rearrangements", sql="SELECT category, n, row_number() OVER (ORDER BY coalesce(list_position(['good', 'indel', 'stop'], category), 4), TRY_CAST(category AS DOUBLE) NULLS LAST, category) AS place FROM (SELECT status AS category, count(*) AS n FROM rearrangements GROUP BY 1 UNION ALL SELECT CAST(duplicate_count AS VARCHAR), count(*) FROM rearrangements GROUP BY 1)")
def custom_category_order(spark, d):
    t = view(spark, d, "rearrangements")
    both = T.category_counts(t, F.col("status")).unionByName(T.category_counts(t, F.col("duplicate_count").cast("string")))
    return T.custom_order(both, ["good", "indel", "stop"])


@query(
    "rearrangements",
    sql="""SELECT series, category, n, n * 100.0 / sum(n) OVER (PARTITION BY series) AS percent FROM (SELECT 'all' AS series, locus AS category, count(*) AS n FROM rearrangements GROUP BY ALL
      UNION ALL SELECT 'orf', locus, count(*) FROM rearrangements WHERE status = 'good' GROUP BY ALL)""",
)
def series_percent(spark, d):
    t = view(spark, d, "rearrangements")
    return T.percent_within(T.series({s: T.category_counts(statistic_subset(t, s), F.col("locus")) for s in ("all", "orf")}))


_GRID = "g AS (SELECT *, least(99, greatest(1, ceil(germ_div / (60.0 / 99)))) AS bx, least(99, greatest(1, ceil((identity - 40) / (60.0 / 99)))) AS by FROM iddiv WHERE germ_div BETWEEN 0 AND 60 AND identity BETWEEN 40 AND 100)"


@query("iddiv", ctes_more=_GRID, sql="SELECT x.i AS bx, y.i AS by, count(g.bx) AS n FROM (SELECT unnest(range(1, 100)) AS i) x CROSS JOIN (SELECT unnest(range(1, 100)) AS i) y LEFT JOIN g ON g.bx = x.i AND g.by = y.i GROUP BY ALL")
def identity_divergence_grid(spark, d):
    return T.grid_histogram(view(spark, d, "iddiv"))


@query(
    "iddiv", ctes_more=_GRID,
    sql="""SELECT k.timepoint, k.referent, k.sieved, x.i AS bx, y.i AS by, count(g.bx) AS n FROM (SELECT DISTINCT timepoint, referent, sequence_id % 5 = 0 AS sieved FROM iddiv) k CROSS JOIN (SELECT unnest(range(1, 100)) AS i) x CROSS JOIN (SELECT unnest(range(1, 100)) AS i) y
      LEFT JOIN g ON g.timepoint = k.timepoint AND g.referent = k.referent AND (g.sequence_id % 5 = 0) = k.sieved AND g.bx = x.i AND g.by = y.i GROUP BY ALL""",
)
def longitudinal_facets(spark, d):
    t = view(spark, d, "iddiv")
    flagged = T.flagged_points(t, t.where("sequence_id % 5 = 0").select("sequence_id"), "sieved")
    return T.grid_histogram(flagged, "timepoint", "referent", "sieved")


@query(
    "iddiv", ctes_more="w AS (SELECT germ_div AS x, identity AS y, count(*) AS w FROM iddiv WHERE germ_div BETWEEN 0 AND 60 AND identity BETWEEN 40 AND 100 GROUP BY ALL)",
    sql="""SELECT gx.i AS gx, gy.i AS gy, sum(w * exp(-(pow((x - gx.i * 60 / 99.0) / 0.25, 2) + pow((y - 40 - gy.i * 60 / 99.0) / 0.25, 2)) / 2)) / ((SELECT sum(w) FROM w) * 2 * pi() * 0.0625) AS density
      FROM w JOIN (SELECT unnest(range(0, 100)) AS i) gx ON abs(x - gx.i * 60 / 99.0) <= 4 JOIN (SELECT unnest(range(0, 100)) AS i) gy ON abs(y - 40 - gy.i * 60 / 99.0) <= 4 GROUP BY ALL""", rounded=("density",))
def kernel_density(spark, d):
    return T.kernel_density(view(spark, d, "iddiv"))


@query(
    "iddiv", ctes_more="w AS (SELECT timepoint, referent, germ_div AS x, identity AS y, count(*) AS w FROM iddiv WHERE germ_div BETWEEN 0 AND 60 AND identity BETWEEN 40 AND 100 GROUP BY ALL), t AS (SELECT timepoint, referent, sum(w) AS total FROM w GROUP BY ALL)",
    sql="""SELECT w.timepoint, w.referent, gx.i AS gx, gy.i AS gy, sum(w * exp(-(pow((x - gx.i * 60 / 99.0) / 0.25, 2) + pow((y - 40 - gy.i * 60 / 99.0) / 0.25, 2)) / 2)) / (any_value(t.total) * 2 * pi() * 0.0625) AS density
      FROM w JOIN t ON t.timepoint = w.timepoint AND t.referent = w.referent JOIN (SELECT unnest(range(0, 100)) AS i) gx ON abs(x - gx.i * 60 / 99.0) <= 4 JOIN (SELECT unnest(range(0, 100)) AS i) gy ON abs(y - 40 - gy.i * 60 / 99.0) <= 4 GROUP BY ALL""", rounded=("density",))
def longitudinal_density(spark, d):
    """Densities per time point and antibody."""
    return T.kernel_density(view(spark, d, "iddiv"), "timepoint", "referent")


@query("mcmc_log", ctes_more="o AS (SELECT rate, sample FROM (SELECT *, row_number() OVER (ORDER BY sample) AS i, count(*) OVER () AS n FROM mcmc_log) WHERE i > CAST(floor(n * 0.1) AS BIGINT)), s AS (SELECT rate AS lo, lead(rate, CAST(round((SELECT count(*) FROM o) * 0.95) AS INT) - 1) OVER (ORDER BY rate, sample) AS hi FROM o)",
    sql="SELECT (SELECT count(*) FROM o) AS n, (SELECT avg(rate) FROM o) AS mean, (SELECT median(rate) FROM o) AS median, (SELECT stddev_samp(rate) / sqrt(count(*)) FROM o) AS se, lo AS hpd_low, hi AS hpd_high FROM s WHERE hi IS NOT NULL ORDER BY round(hi - lo, 12), lo LIMIT 1", rounded=("mean", "median", "se", "hpd_low", "hpd_high"))
def posterior_summary(spark, d):
    return T.posterior_summary(view(spark, d, "mcmc_log"))


@query("umi_reads", ctes_more="q AS (SELECT i AS pos, 2 + (event_id + i) % 38 AS q FROM (SELECT *, unnest(range(0, 10)) AS i FROM umi_reads))", sql="SELECT pos, count(*) AS n, avg(q) AS mean, quantile_disc(q, 0.5) AS median FROM q GROUP BY pos")
def quality_by_position(spark, d):
    qual = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.char(35 + (F.col("event_id") + i) % 38)), "")
    return T.quality_by_position(view(spark, d, "umi_reads").select(qual.alias("qual")))


@query("rearrangements", sql="SELECT sequence_id, timepoint FROM rearrangements QUALIFY row_number() OVER (PARTITION BY timepoint ORDER BY md5(sequence_id || ':0'), sequence_id) <= 20")
def n_per_timepoint(spark, d):
    return T.per_timepoint(view(spark, d, "rearrangements"), 20).select("sequence_id", "timepoint")


@query("rearrangements", sql="SELECT sequence_id, CAST(floor((row_number() OVER (ORDER BY md5(sequence_id || ':0'), sequence_id) - 1) / 250) AS INT) AS batch FROM rearrangements")
def shuffled_batches(spark, d):
    return T.shuffled_batches(view(spark, d, "rearrangements")).select("sequence_id", "batch")

"""Benchmark decontamination: a prefix-filtered set join of item windows with documents, in DataFrame functions only.

A window of an item occurs in a document only if all of its shingles do, so
its rarest shingle alone is a necessary prefix. Documents are read once: places
of item shingles are found by a broadcast join inside the scan, counts over all
of them give the order of rarity, and every window is looked up at the places of
its rarest shingle, where position and length bounds and then its words decide.
Texts are never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.plans.tables import written

#: What stands between words, after A-Z are lower-cased.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window, and of a shingle (windows of fewer words are one shingle).
WINDOW, SHINGLE = 10, 5
#: Shingles that are broadcast at once (a hash table of some 32 MB); more are looked up in several scans.
BROADCAST = 1 << 20


def words(text: Column) -> Column:
    """Lower-cased words; null text has none. ASCII texts take the shorter way to the same letters."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), NOT_WORD), "")


def _shingles(of: str, k: int) -> Column:
    """Hashes of the runs of ``k`` words, in order; empty if there are fewer words."""
    at = F.sequence(F.lit(0), F.size(of) - k)
    return F.when(F.size(of) >= k, F.transform(at, lambda i: F.xxhash64(F.lit(k), *[F.get(of, i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, window, size``: every run of ``window`` words of an item, or all words of one that has fewer."""
    some = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - window, F.lit(0))
    runs = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.slice("w", i, window))
    return some.select("item_id", F.explode_outer(runs).alias("window")).select("item_id", "window", F.size("window").alias("size")).distinct()


def occurrences(docs: DataFrame, tokens: DataFrame, sizes: list[int], window: int = WINDOW, shingle: int = SHINGLE, broadcast: int = BROADCAST) -> DataFrame:
    """A row per document (``at`` 0) and per place of one of ``tokens`` (token, size): ``key, doc_id, n_words, at, token, start, near``.

    ``near`` has the words from ``start`` on that any window over that place
    can hold. The tokens are broadcast in parts of at most ``broadcast``, each
    with a scan of its own.
    """
    text = F.col("text").cast("string")
    read = docs.select(F.col("doc_id"), F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary")).alias("key"), words(text).alias("w"))
    hashes = F.concat(F.array(F.lit(None).cast("long")), *[_shingles("w", k) for k in sizes])
    # the outer form: from the inner one Spark infers a filter that evaluates all of this once more for each element
    places = read.withColumn("h", hashes).select("key", "doc_id", "w", F.posexplode_outer("h").alias("i", "h"))
    n, base = F.size("w"), F.lit(0)
    bases = F.lit(0)
    for k in sizes:
        bases = F.when(F.col("size") == k, base).otherwise(bases)
        base = base + F.greatest(n - k + 1, F.lit(0))
    at = F.coalesce(F.col("i") - bases, F.lit(0))
    start = F.greatest(at - (window - F.col("size")), F.lit(1))
    parts = max(1, -(-tokens.count() // broadcast))
    found = []
    for p in range(parts):
        some = tokens if parts == 1 else tokens.where(F.pmod(F.xxhash64("token"), F.lit(parts)) == p)
        met = places.join(F.broadcast(some), F.col("h") == F.col("token"), "left").where(F.col("token").isNotNull() | (F.col("i") == 0) if p == 0 else F.col("token").isNotNull())
        near = F.when(F.col("token").isNotNull(), F.slice("w", start, at - start + window))
        found.append(met.select("key", "doc_id", n.alias("n_words"), at.alias("at"), "token", start.alias("start"), near.alias("near")))
    return reduce(DataFrame.unionAll, found)


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, broadcast: int = BROADCAST) -> dict[str, DataFrame]:
    """``documents`` (key, doc_id, n_words), ``hits`` (key, window_id, first, last) and ``windows`` (window_id, item_id).

    ``key`` digests id and text, so repeated rows share their hits. A window's
    ``first`` and ``last`` are places of words, counted from 1.
    """
    of_items = written(item_windows(items, window), "leak-items")
    texts = written(of_items.select("window", "size").distinct().withColumn("window_id", F.monotonically_increasing_id()), "leak-windows")
    sizes = sorted(r[0] for r in texts.select(F.least(F.col("size"), F.lit(shingle))).distinct().collect())  # at most `shingle` values
    per_size = [texts.where(F.least(F.col("size"), F.lit(shingle)) == k).select("window_id", F.lit(k).alias("size"), F.posexplode_outer(_shingles("window", k)).alias("offset", "token")) for k in sizes]
    none = docs.sparkSession.createDataFrame([], "window_id long, size int, offset int, token long")
    grams = written(reduce(DataFrame.unionAll, per_size, none), "leak-shingles")
    seen = written(occurrences(docs, grams.select("token", "size").distinct(), sizes or [shingle], window, shingle, broadcast), "leak-places")
    places = seen.where(F.col("at") > 0)
    rarity = places.groupBy("token").agg(F.count(F.lit(1)).alias("places"))
    ordered = grams.join(rarity, "token", "left")  # a window with a shingle that no document has is not looked up
    prefix = ordered.groupBy("window_id").agg(F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "token", "offset")).alias("rarest"))
    prefix = prefix.where(F.col("rarest.places") > 0).select("window_id", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"))
    wanted = written(prefix.join(texts, "window_id"), "leak-prefixes")
    first = F.col("at") - F.col("offset")
    bounds = (first >= 1) & (first + F.col("size") - 1 <= F.col("n_words"))
    exact = F.slice("near", first - F.col("start") + 1, F.col("size")) == F.col("window")
    hits = places.join(wanted, "token").where(bounds).where(exact).select("key", "window_id", first.alias("first"), (first + F.col("size") - 1).alias("last"))
    return {"documents": seen.where(F.col("at") == 0).select("key", "doc_id", "n_words"), "hits": written(hits, "leak-hits"), "windows": of_items.join(texts, ["window", "size"]).select("window_id", "item_id")}


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, broadcast: int = BROADCAST) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``docs`` has ``doc_id, text``, ``items`` ``item_id, text``; further columns,
    whatever their names, are ignored. A word is hit if it lies in an occurrence
    of a window. Null and empty texts have no words; an item without words
    occurs nowhere. Repeated rows each get their result; ids that several items
    share count once, and a null item id counts as the empty text. A document
    that repeats one window throughout is one group of at most its length.
    Without items, or with empty tables, nothing is hit.
    """
    found = find(docs.select("doc_id", "text"), items.select("item_id", "text"), window, shingle, broadcast)
    places = found["hits"].select("key", "first", "last").distinct()
    before = F.max("last").over(Window.partitionBy("key").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.col("last") - F.greatest(F.col("first") - 1, F.coalesce(F.col("before"), F.lit(0))), F.lit(0))
    covered = places.withColumn("before", before).groupBy("key").agg(F.sum(new).alias("n_hit"))
    # documents that hold the same windows share one list of items
    held = found["hits"].select("key", "window_id").distinct().groupBy("key").agg(F.array_sort(F.collect_list("window_id")).alias("ids"))
    held = written(held.withColumn("set", F.md5(F.concat_ws(",", "ids").cast("binary"))), "leak-sets")
    lists = held.groupBy("set").agg(F.first("ids").alias("ids")).select("set", F.explode("ids").alias("window_id"))
    lists = lists.join(found["windows"], "window_id").select("set", F.coalesce("item_id", F.lit("")).alias("item_id")).distinct()
    lists = lists.groupBy("set").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    lists = lists.select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"))
    results = written(covered.join(held.select("key", "set"), "key").join(lists, "set"), "leak-results")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return (
        found["documents"]
        .join(results, "key", "left")
        .select(
            "doc_id",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", empty).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )

"""Ranked lexical search: item bundles travel through the owners of their terms.

Postings of the items' terms lie with owners, rarest terms first, cut into
shards of documents. A bundle (one shard, one block of items) carries the
scores so far of the documents that can still be among the best, passes one
owner after the other by cogroup, and adds integer contributions there. After
each owner the items' counts of scores, summed over all shards, give a floor
that the last place has at least; what cannot reach it is left behind.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lymphlake.llm.common import pieces
from lymphlake.llm.decontaminate import words
from lymphlake.plans.tables import few_files, written

#: A term in the bytes of a text whose A-Z are lower-cased; the same as a word of ``decontaminate.words``.
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Share of all postings that the first owners hold together, rarest terms first.
OWNERS = (0.02, 0.1, 0.35, 1.0)
#: Documents of a shard and items of a block, about; a bundle is at most their product of scores.
SHARD, BLOCK = 2048, 256
#: Rows of terms or items that are broadcast (some tens of MB); beyond, they are shuffled.
SMALL = 1 << 20
#: Bytes of a text that are cut into terms at a time.
CHUNK = 1 << 22

_BUNDLE = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64())]
    + [(c, pa.list_(pa.int32() if c in ("term_of", "owners", "held_by") else pa.int64())) for c in ("items", "term_of", "terms", "owners", "most", "held_by", "docs", "doc_ids", "scores")]
    + [("levels", pa.list_(pa.struct([("item", pa.int64()), ("level", pa.int32()), ("n", pa.int64())])))]
)


def count_terms(text: bytes) -> Counter:
    """How often each term occurs; long texts are counted in chunks that end between terms."""
    counts: Counter = Counter()
    start = 0
    while start < len(text):
        stop = start + CHUNK
        if stop < len(text):
            end = _BREAK.search(text, stop)
            stop = end.start() if end else len(text)
        counts.update(_TERM.findall(text[start:stop].lower()))
        start = stop
    return counts


def _counted(docs: DataFrame) -> DataFrame:
    """``row, doc_id, n, term, tf``: a row per document and term, and one with the empty term per document (``tf``: ``n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            totals, terms, counts = [], [], []
            for text in batch.column("text").to_pylist():
                found = count_terms(text or b"")
                totals.append(found.total())
                terms.append([b"", *found])
                counts.append([totals[-1], *found.values()])
            columns = [batch.column("row"), batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n", "terms", "counts"])

    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    found = read.mapInArrow(run, "row long, doc_id long, n long, terms array<string>, counts array<long>")
    return found.select("row", "doc_id", "n", F.inline_outer(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("tf"))).alias("term", "tf"))


def _few(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast what is known to be small."""
    return F.broadcast(table) if rows <= SMALL else table


def level_of(scores: np.ndarray) -> np.ndarray:
    """Sixteenths of octaves below a score, as an integer that grows with it."""
    octave = np.frexp(scores.astype(np.float64))[1].astype(np.int64)
    octave -= (scores >> np.maximum(octave - 1, 0)) == 0  # a score that the float rounded up
    return octave * 16 + ((scores >> np.maximum(octave - 5, 0)) & 15) * (octave > 4)


def level_floor(level: Column) -> Column:
    """The least score of a level (0 for the lowest levels)."""
    octave = F.floor(level / 16).cast("int")
    return F.when(octave > 4, F.expr("shiftleft(16L + pmod(level, 16), cast(floor(level / 16) AS int) - 5)")).otherwise(F.lit(0))


def _visit(owner: int, last: bool, k: int, key, bundle: pa.Table, postings: pa.Table) -> pa.Table:
    """A bundle after the owner's postings were added."""
    if not bundle.num_rows:
        return _BUNDLE.empty_table()

    def part(name: str, dtype=np.int64) -> np.ndarray:
        return np.asarray(bundle.column(name).combine_chunks().values.to_numpy(zero_copy_only=False), dtype)

    items, floors = part("items"), part("floors")
    docs, ids = part("docs"), bundle.column("doc_ids").combine_chunks().values
    row, term, more = (postings.column(c).to_numpy() for c in ("row", "term_id", "more"))
    by_term = np.argsort(term, kind="stable")
    row, term, more = row[by_term], term[by_term], more[by_term]
    every, first = np.unique(np.concatenate([docs, row]), return_index=True)
    every_id = pa.chunked_array([ids, postings.column("doc_id").combine_chunks().take(pa.array(by_term))]).combine_chunks().take(pa.array(first))
    place = np.searchsorted(every, row)
    scores = np.zeros((len(items), len(every)), np.int64)
    scores[part("held_by"), np.searchsorted(every, docs)] = part("scores")
    term_of, terms, owners, most = part("term_of"), part("terms"), part("owners"), part("most")
    here = np.flatnonzero(owners == owner)
    lo, hi = np.searchsorted(term, terms[here], "left"), np.searchsorted(term, terms[here], "right")
    for i, a, b in zip(term_of[here], lo, hi, strict=True):
        if a < b:
            scores[i, place[a:b]] += more[a:b]
    later = owners > owner
    rest = np.zeros(len(items), np.int64)
    np.add.at(rest, term_of[later], most[later])
    order = np.argsort(np.where(np.asarray(every_id.is_null()), np.iinfo(np.int64).max, every_id.fill_null(0).to_numpy()), kind="stable")
    keep = np.zeros(scores.shape, bool)
    for i in range(len(items)):
        can = (scores[i] > 0) & (scores[i] + rest[i] >= floors[i])
        if can.sum() > k:
            if last:  # the best of this shard, ties by id
                best = order[can[order]]
                best = best[np.argsort(-scores[i, best], kind="stable")[:k]]
                can = np.zeros(len(every), bool)
                can[best] = True
            else:
                can &= scores[i] + rest[i] >= np.partition(scores[i], -k)[-k]
        keep[i] = can
    held_by, at = np.nonzero(keep)
    kept = scores[held_by, at]
    code, n = np.unique(held_by * 2048 + level_of(kept), return_counts=True)
    levels = [{"item": int(items[c // 2048]), "level": int(c % 2048), "n": int(m)} for c, m in zip(code, n, strict=True)]
    now = {
        **{c: bundle.column(c)[0].as_py() for c in ("shard", "block")},
        **{c: v for c, v in (("items", items), ("term_of", term_of[later]), ("terms", terms[later]), ("owners", owners[later]), ("most", most[later]))},
        **{"held_by": held_by, "docs": every[at], "doc_ids": every_id.take(pa.array(at)).to_pylist(), "scores": kept, "levels": levels},
    }
    return pa.Table.from_arrays([pa.array([now[f.name]], f.type) for f in _BUNDLE], schema=_BUNDLE)


def search(docs: DataFrame, items: DataFrame, k: int = 50, owners: tuple = OWNERS, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``.

    ``docs`` has ``doc_id, text``, ``items`` ``item_id, text``; further columns,
    whatever their names, are ignored. A term's weight w is
    floor(1000 ln((2N + 2) / (2 df + 1))), a document's contribution for it
    w * ((10^9 tf) div (1000 tf + 20 m)) with m = 50 + ((50 n N) div L).
    Only scores above 0 count; equal ones stand by id, null ids last. Null
    and empty texts have no terms. Rows of ``docs`` are documents of their
    own even if their ids repeat; rows of ``items`` that share an id are one
    item with the terms of all. Whole texts are counted, long ones in chunks.

    Exactness: a floor is a score that at least ``k`` documents already have,
    and a document stays while its score and the largest contributions of the
    owners to come reach it. One that was left behind and met again has less
    than it deserves, and what it deserves is below the last place.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col("item_id"), F.explode_outer(words(F.col("text").cast("string"))).alias("term")).where(F.col("term").isNotNull()).distinct()
    wanted = written(wanted, "search-wanted")
    terms = written(few_files(wanted.select("term").distinct(), wanted.count()).withColumn("term_id", F.monotonically_increasing_id()), "search-terms")
    n_terms = terms.count()
    ends = spark.createDataFrame([("", -1)], "term string, term_id long")
    counted = _counted(docs.select("doc_id", "text"))
    postings = written(counted.join(_few(terms.unionAll(ends), n_terms), "term").select("row", "doc_id", "n", "term_id", "tf"), "search-postings")
    whole = postings.where(F.col("term_id") == -1).agg(F.count(F.lit(1)).alias("rows"), F.sum((F.col("n") > 0).cast("long")).alias("n"), F.sum("n").alias("l")).first()
    n_docs, length = whole["n"] or 0, max(whole["l"] or 0, 1)

    share = postings.where(F.col("term_id") >= 0).select("row", "doc_id", "term_id", F.expr(f"(1000000000L * tf) div (1000L * tf + 20L * (50L + ((50L * n * {n_docs}L) div {length}L)))").alias("share"))
    stats = share.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"), F.max("share").alias("best"))
    stats = stats.withColumn("w", F.floor(1000.0 * F.log((F.lit(2 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("long")).where(F.col("w") > 0)
    stats = written(few_files(stats.select("term_id", "df", "w", (F.col("w") * F.col("best")).alias("most")), n_terms), "search-stats")
    # weights are integers of a narrow range, so their running sum is one small table
    heavier = F.sum("df").over(Window.orderBy(F.desc("w")).rowsBetween(Window.unboundedPreceding, Window.currentRow)) / F.sum("df").over(Window.partitionBy())
    own = stats.groupBy("w").agg(F.sum("df").alias("df")).withColumn("upto", heavier)
    owner = sum([(F.col("upto") > s).cast("int") for s in owners[:-1]], F.lit(0))
    stats = written(few_files(stats.join(own.select("w", owner.alias("owner")), "w"), n_terms), "search-owned")

    listed = wanted.join(terms, "term").join(stats, "term_id").groupBy("item_id").agg(F.collect_list(F.struct("term_id", "owner", "most")).alias("terms"))
    listed = written(few_files(listed, n_terms).withColumn("item", F.monotonically_increasing_id()), "search-items")
    n_items = listed.count()
    blocks = -(-n_items // block) or 1
    listed = listed.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    routes = listed.select("block", F.explode("terms").alias("t")).select("block", "t.term_id").distinct().join(stats.select("term_id", "owner", "w"), "term_id")
    shards = -(-whole["rows"] // shard) or 1
    routed = share.where(F.col("share") > 0).join(_few(routes, n_terms * blocks), "term_id")
    routed = routed.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), "block", "row", "doc_id", "term_id", (F.col("w") * F.col("share")).alias("more"), "owner")
    # each file has an owner's postings together, so that the visits to the others skip them
    routed = written(routed.sortWithinPartitions("owner"), "search-routed")

    own_items = listed.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("item", "terms"))).alias("i"))
    flat = F.flatten(F.transform("i", lambda x, at: F.transform(x["terms"], lambda t: F.struct(at.cast("int").alias("of"), t["term_id"].alias("term_id"), t["owner"].alias("owner"), t["most"].alias("most")))))
    own_items = own_items.select("block", F.col("i.item").alias("items"), flat.alias("t"))
    own_items = own_items.select("block", "items", F.col("t.of").alias("term_of"), F.col("t.term_id").alias("terms"), F.col("t.owner").alias("owners"), F.col("t.most").alias("most"))
    none = [F.array().cast(kind).alias(c) for c, kind in (("held_by", "array<int>"), ("docs", "array<long>"), ("doc_ids", "array<long>"), ("scores", "array<long>"), ("levels", "array<struct<item:long,level:int,n:long>>"))]
    pairs = written(few_files(routed.select("shard", "block").distinct(), shards * blocks), "search-pairs")
    bundles = pairs.join(_few(own_items, n_terms * blocks + n_items), "block").select("shard", "block", "items", "term_of", "terms", "owners", "most", *none)
    floors = listed.select("item", "block", F.lit(0).cast("long").alias("floor"))
    for p in range(len(owners)):
        by_block = floors.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("item", "floor"))).alias("f")).select("block", F.col("f.floor").alias("floors"))
        left = bundles.join(_few(by_block, n_items), "block").select(*bundles.columns, "floors")
        right = routed.where(F.col("owner") == p).drop("owner")
        visit = partial(_visit, p, p == len(owners) - 1, k)
        bundles = written(left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(visit, from_arrow_schema(_BUNDLE)), f"search-owner-{p}")
        if p < len(owners) - 1:
            reached = bundles.select(F.explode_outer("levels").alias("v")).select("v.*").groupBy("item", "level").agg(F.sum("n").alias("n"))
            upto = reached.withColumn("n", F.sum("n").over(Window.partitionBy("item").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)))
            level = upto.where(F.col("n") >= k).groupBy("item").agg(F.max("level").alias("level"))
            found = level.select("item", level_floor(F.col("level")).alias("floor"))
            floors = written(few_files(listed.select("item", "block").join(found, "item", "left").select("item", "block", F.coalesce("floor", F.lit(0)).cast("long").alias("floor")), n_items), "search-floors")
    best = bundles.select("items", F.inline_outer(F.arrays_zip("held_by", "docs", "doc_ids", "scores"))).where(F.col("docs").isNotNull())
    best = best.select(F.element_at("items", F.col("held_by") + 1).alias("item"), "docs", F.col("doc_ids").alias("doc_id"), F.col("scores").alias("score"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "docs"))
    best = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(_few(listed.select("item", "item_id"), n_items), "item").select("item_id", "rank", "doc_id", "score")

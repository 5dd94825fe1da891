"""op11, op12, op13: brute force, odd rows."""

import hashlib
import re
import time
import zlib
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from lymphlake.llm import decontaminate, merkle, search

DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, group string, key string, w int, row int"


def table(spark, rows):
    return spark.createDataFrame([(*r, *(None,) * (5 - len(r)), "x", "y", "z", 1, 2) for r in rows], DOCS)


# -- op11 -------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes, fan=8):
    """Root and, per leaf, the (before, after) lists of its run on each level."""
    proofs, owned = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(a, min(a + fan, len(nodes))) for a in range(0, len(nodes), fan)]
        for run in runs:
            for k in run:
                for leaf in owned[k]:
                    proofs[leaf].append((nodes[run[0] : k], nodes[k + 1 : run[-1] + 1]))
        nodes, owned = [H(*nodes[r[0] : r[-1] + 1]) for r in runs], [sum((owned[k] for k in r), []) for r in runs]
    return nodes[0], proofs


def proved(rows):
    def frame(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return H(*[frame(v) for v in (r[0], r[3], r[2], r[4], text)])

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = [climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order]
    root, above = climb([t[0] for t in trees])
    out = []
    for g, (sub, proofs), more in zip(order, trees, above, strict=True):
        for (_, _, digest, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), proofs, strict=True):
            node = leaf(r, r[1].translate(lower)) if r[1] is not None and zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 == 0 else digest
            for before, after in path + more:
                node = H(*before, node, *after)
            out.append((r[0], digest, sub, root, H(*[x for b, a in path + more for x in b + a]), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("case", ["odd", "one", "one_lang", "many_langs"])
def test_manifest_equals_plain_trees(spark, case):
    rows = {
        "odd": [(i, f"Text {i} ÄÉ ß" * (i % 3), ("en", "de", None, "Ä")[i % 4 if i % 5 else 0], None if i % 7 == 0 else f"s{i}", i if i % 2 else None) for i in range(150)]
        + [(None, "A", "en", "s", 1), (None, None, None, None, None), (None, "A", "en", "s", 1), (3, "Dup", "fr", "s", 1), (3, "Dup", "fr", "s", 1), (3, "Other", "fr", "s", 1), (9, "Z" * 200_000, "fr", "s", 1)],
        "one": [(1, "A", None, None, None)],
        "one_lang": [(i, "Ab", "en", "s", 2) for i in range(73)],
        "many_langs": [(i, "Ab", f"l{i % 67}", "s", 2) for i in range(70)],
    }[case]
    got = merkle.verify(merkle.document_manifest(table(spark, rows))).collect()
    assert sorted((tuple(r) for r in got), key=str) == proved(rows)


def test_manifest_of_nothing(spark):
    assert merkle.verify(merkle.document_manifest(table(spark, []))).count() == 0


# -- op12 -------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return WORDS.findall((text or "").translate(LOWER))


def plain_leaks(docs, items, window=10):
    where = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(len(w) - window, 0) + 1):
            if w:
                where.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in {len(k) for k in where}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in where:
                    hit |= set(range(i, i + n))
                    found |= where[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def leak_rows():
    deal = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Éa", "él", "Straße", "\U0001f600x"]
    text = lambda n: " ".join(deal.choice(vocabulary, n))
    items = [(i, text(int(n))) for i, n in enumerate([10, 25, 3, 1, 9, 10, 40, 4])] + [(8, None), (9, " .,"), (10, "same " * 30), (11, "same " * 30), (None, text(12)), (3, text(11))]
    docs = [(i, text(60) + ". " + (items[i % 8][1] or "").upper() + "-" + text(5)) for i in range(40)]
    docs += [(40, None), (41, ""), (42, "same " * 500), (43, items[1][1]), (43, items[1][1]), (None, items[0][1]), (44, " ".join(plain_words(items[6][1])[:9])), (45, text(30_000)), (46, " ".join(t for _, t in items if t))]
    return docs, items


@pytest.mark.parametrize("shingle", [5, 2])
@pytest.mark.parametrize("broadcast", [1 << 20, 7])
def test_leaks_equal_brute_force(spark, shingle, broadcast):
    docs, items = leak_rows()
    got = decontaminate.judge(table(spark, docs), spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, window string"), shingle=shingle, broadcast=broadcast)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_leaks(docs, items)


def test_leaks_of_nothing(spark):
    docs, items = leak_rows()
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.judge(table(spark, docs), none).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_leaks(docs, [])
    assert decontaminate.judge(table(spark, []), spark.createDataFrame(items, none.schema)).count() == 0


def test_leaks_in_one_scan_without_shuffling_texts(spark):
    docs, items = leak_rows()
    tokens = spark.range(10).select(F.col("id").alias("token"), F.lit(5).alias("size"))
    plan = decontaminate.occurrences(table(spark, docs), tokens, [5])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hash" not in plan and "SortMergeJoin" not in plan and plan.count("Scan") <= 2
    # the words of a long text are not copied for each of its places
    long = spark.range(1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(400_000)), lambda i: i.cast("string"))).alias("text"))
    began = time.time()
    assert decontaminate.judge(long, spark.createDataFrame([(1, "399990 399991 399992")], "item_id long, text string")).first()["n_hit"] == 3
    assert time.time() - began < 60


# -- op13 -------------------------------------------------------------------


def plain_search(docs, items, k):
    counted = [(d, plain_words(t)) for d, t in docs]
    n_docs, length = sum(bool(w) for _, w in counted), sum(len(w) for _, w in counted)
    df = {}
    for _, w in counted:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(plain_words(text))
    out = []
    for item, wanted in terms.items():
        scores = []
        for d, w in counted:
            m, score = 50 + (50 * len(w) * n_docs) // max(length, 1), 0
            for t in wanted & set(w):
                tf = w.count(t)
                score += floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"k": 3, "shard": 7, "block": 2}, {"k": 5, "shard": 16, "owners": (0.3, 1.0)}, {"k": 2, "owners": (1.0,)}])
def test_search_equals_brute_force(spark, sizes):
    docs, items = leak_rows()
    deal = np.random.default_rng(1)
    docs = docs + [(100 + i, " ".join(f"w{j}" for j in deal.geometric(0.02, int(deal.integers(1, 60))))) for i in range(200)] + [(500, "rare w3 w3"), (500, "rare w3 w3"), (499, "rare w3 w3")]
    items = items + [(20, "rare w3 w40 w90"), (21, "absent"), (22, "w1 w2 w3 W40 w80 w120")]
    got = search.search(table(spark, docs), spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, score int"), **sizes)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_search(docs, items, sizes.get("k", 50))


def test_search_of_nothing(spark):
    docs, items = leak_rows()
    none = spark.createDataFrame([], "item_id long, text string")
    assert search.search(table(spark, docs), none).count() == 0
    assert search.search(table(spark, []), spark.createDataFrame(items, none.schema)).count() == 0
    assert search.search(table(spark, [(1, None), (2, "")]), spark.createDataFrame(items, none.schema)).count() == 0


def test_score_levels_are_monotone_and_hold_their_floor(spark):
    scores = np.unique(np.concatenate([np.arange(1, 5000), np.random.default_rng(0).integers(1, 2**62, 5000), [2**53 - 1, 2**53 + 1, 2**61 - 1]]))
    levels = search.level_of(scores)
    assert (np.diff(levels) >= 0).all() and levels.min() >= 0 and levels.max() < 2048
    floors = spark.createDataFrame([(int(x),) for x in levels], "level int").select(search.level_floor(F.col("level"))).toPandas().iloc[:, 0].to_numpy()
    assert (floors <= scores).all() and (floors[scores >= 16] * 1.07 >= scores[scores >= 16]).all()


def test_long_texts_are_counted_in_chunks(monkeypatch):
    text = ("Ab c-d1 é " * 500).encode()
    whole = search.count_terms(text)
    monkeypatch.setattr(search, "CHUNK", 37)
    assert search.count_terms(text) == whole and whole[b"ab"] == 500 and whole["é".encode()] == 500

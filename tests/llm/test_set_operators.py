"""op2, op3, op4, op6, op7, op10 and the pipeline: brute force, round trips, odd rows."""

import hashlib
import json
import zlib

import numpy as np
import pytest
from compare import same
from pyspark.sql import functions as F
from test_text_operators import ODD, documents, odd

import corpus_pipeline
from lymphlake.llm import ann, chat, media, minhash, mixing, queries, urlfilter


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, sf, name):
    same(queries.QUERIES[name](spark, sf).toPandas(), duck.execute(queries.ORACLES[name]).df())


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{i}_" for i in range(1, 11)} <= {n[: n.index("_") + 1] for n in names if n.startswith("op")}
    assert "pipeline" in names


# -- op2 --------------------------------------------------------------------


def test_rules_by_hand(spark):
    urls = {"https://A.Example.com/en/71?x": ("a.example.com", "/en/71", "example.com/en/7", "allow"), "http://x.com/en/2": ("x.com", "/en/2", "com/en/", "block"), "http://example.net/de/8#t": ("example.net", "/de/8", "example.net/de/8", "block"), "http://q.net/de/8": ("q.net", "/de/8", "net/de/", "allow"), "http://notcom/en/": ("notcom", "/en/", None, "allow"), "x/y": ("", "", None, "allow"), "http://a.org?q=/es/": ("a.org", "", None, None), None: ("", "", None, "allow")}
    rows = [(i, u, None if i % 2 else "<a href='/x'>") for i, u in enumerate(urls)]
    got = {r["page_id"]: r for r in urlfilter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, want in enumerate(urls.values()):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == want[:3]
        assert want[3] is None or got[i]["verdict"] == want[3]
    assert urlfilter.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_rank_equals_power_iteration(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 1.0), ("c", "d", 3.0)]
    got = {r["host"]: r["rank"] for r in urlfilter.propagate(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame([("a", 1.0), ("d", 1.0)], "host string, mass double")).collect()}
    nodes = "abcd"
    step = np.zeros((4, 4))
    for s, d, w in edges:
        step[nodes.index(s), nodes.index(d)] = w
    step = np.divide(step, step.sum(axis=1, keepdims=True), out=np.zeros_like(step), where=step.sum(axis=1, keepdims=True) > 0)
    seed = np.array([0.5, 0, 0, 0.5])
    walks = seed
    for _ in range(urlfilter.ITERATIONS):
        walks = seed + urlfilter.DAMPING * walks @ step
    assert [got[n] for n in nodes] == pytest.approx(list(walks / walks.sum()))
    # the fixed point of the surfer who returns to the seeds, lost mass included
    r = seed
    for _ in range(500):
        moved = urlfilter.DAMPING * r @ step
        r = moved + seed * (1 - moved.sum())
    assert np.abs(np.array([got[n] for n in nodes]) - r).sum() <= urlfilter.DAMPING**urlfilter.ITERATIONS


def test_distrust_runs_against_links(spark):
    pages = [(1, "http://bad.org/es/1", ""), (2, "http://friend.net/x", "<a href='http://bad.org/z'>"), (3, "http://good.net/de/1", "<a href=//liked.net/>"), (4, "http://liked.net/x", ""), (5, "http://bad.org/en/1", "")]
    got = {r["page_id"]: (r["verdict"], r["trust"] > 0, r["distrust"] > 0) for r in urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: ("block", False, True), 2: ("block", False, True), 3: ("allow", True, False), 4: ("allow", True, False), 5: ("block", False, True)}


def test_distrust_leaves_hosts_with_many_relative_links(spark):
    inner = "".join(f"<a href='/p{i}'>" for i in range(10)) + "<a href=#top>"
    pages = [(f"http://b0.org/es/{i}", inner) for i in range(20)] + [(f"http://b{i}.org/es/1", inner) for i in range(1, 50)]
    pages += [("http://spam.info/1", inner + "<a href='http://b0.org/es/1'>")] + [(f"http://n{i}.info/1", "<a href='/x'>") for i in range(949)]
    got = urlfilter.judge(spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")).collect()
    verdicts = {r["host"]: r["verdict"] for r in got}
    assert verdicts["spam.info"] == "block" and verdicts["n1.info"] == "allow"


def test_host_edges_are_between_hosts(spark):
    rows = [("a.net", "<a href='/x'><img src=//B.net/1><a href='http://b.net/2'><a href='http://a.net/'><a href='mailto:x@c.net'>"), ("a.net", "<a href=//b.net>"), ("blog.d.com", None), ("e.co.uk", ""), ("10.0.0.1", "")]
    got = {(r["src"], r["dst"], r["weight"]) for r in urlfilter.host_edges(spark.createDataFrame(rows, "host string, html string")).collect()}
    assert got == {("a.net", "b.net", 2.0), ("blog.d.com", "d.com", 1.0), ("d.com", "blog.d.com", 1.0)}


def brute_judge(pages):
    """op2 in plain Python: rules, edges, walks, thresholds."""
    import re
    from collections import Counter

    def split(url):
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        host = re.match(r"[^/?#]*", rest)[0]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]

    def rule(host, path):
        fits = [r for r in urlfilter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        return max(fits, key=lambda r: len(r[1] + r[2]), default=None)

    found = [(i, *split(u), html or "") for i, u, html in pages]
    edges, n, allowed, blocked = Counter(), Counter(), Counter(), Counter()
    for _, host, path, html in found:
        if not host:
            continue
        n[host] += 1
        r = rule(host, path)
        allowed[host] += r is not None and r[0] == "allow"
        blocked[host] += r is not None and r[0] == "block"
        targets = set()
        for link in re.findall(r"""(?i)\b(?:href|src)\s*=\s*["']?([^"'\s>]+)""", html):
            m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", link)
            if m and m[1] and m[1].lower() != host:
                targets.add(m[1].lower())
        for t in targets:
            edges[host, t] += 1
        labels = host.split(".")
        above = ".".join(labels[1:])
        if len(labels) >= 3 and all(labels) and "a" <= labels[-1][0] <= "z" and not re.search(urlfilter.SHARED, above):
            edges[host, above] += 1
            edges[above, host] += 1

    def walk(links, seeds):
        whole = sum(seeds.values())
        out = Counter()
        for (s, _), w in links.items():
            out[s] += w
        start = {h: m / whole for h, m in seeds.items()}
        rank = dict(start)
        for _ in range(urlfilter.ITERATIONS):
            moved = Counter(start)
            for (s, d), w in links.items():
                if s in rank:
                    moved[d] += rank[s] * urlfilter.DAMPING * w / out[s]
            rank = moved
        total = sum(rank.values())
        return {h: x / total for h, x in rank.items()} if whole else {}

    trust = walk(edges, {h: allowed[h] / n[h] for h in n if allowed[h]})
    distrust = walk({(d, s): w for (s, d), w in edges.items()}, {h: blocked[h] / n[h] for h in n if blocked[h]})
    out = []
    for i, host, path, _ in found:
        r = rule(host, path)
        a, b = trust.get(host, 0.0), distrust.get(host, 0.0)
        by_host = "block" if b > urlfilter.RATIO * a and b > urlfilter.LEAST / max(1, len(n)) else "allow"
        out.append((i, host, path, r and r[1] + r[2], r[0] if r else by_host, round(a, 9), round(b, 9)))
    return sorted(out, key=str)


def test_judge_equals_brute_force(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in pages.collect()]
    rows += rows[:5] + [(None, None, None), (-1, "no scheme", "<a href=//x.org/>"), (-2, "http://a.b.org/q", "<a href='http://news.example.com/en/1'><img src=//cdn.net/x>"), (-3, "http://News.Example.com/en/2", ""), (-4, "ftp://10.0.0.1/x", "<a href='http://a.b.org/es/1'>")]
    mine = spark.createDataFrame([(*r, "t", 1.0, "h") for r in rows], "page_id long, url string, html string, trust string, rank double, host string")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], round(r["trust"], 9), round(r["distrust"], 9)) for r in urlfilter.judge(mine).collect()]
    assert sorted(got, key=str) == brute_judge(rows)


# -- op3 --------------------------------------------------------------------


def test_media_round_trip(spark):
    got = media.media_features(odd(spark)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    for doc, text, *_ in ODD:
        data = (text or "").encode()
        payload = data + bytes(-len(data) % 64 if data else 64)
        r = by[doc]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        wav = media.to_wav(payload, len(data))
        assert (r["media_bytes"], r["media_sha256"], r["feature"]) == (len(wav), hashlib.sha256(wav).hexdigest(), media.feature(payload))
    assert media.media_features(odd(spark).limit(0)).count() == 0


def test_archives_split_and_damaged_member(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit("text "), F.col("id").cast("int") * 50).alias("text"))
    manifest = media.write_archives(docs.coalesce(1), archive_bytes=1000)
    archives = [r["archive"] for r in spark.read.parquet(manifest).collect()]
    assert len(archives) > 1
    for size in (50, 1 << 20):
        rows = media.read_archives(spark, manifest, rangeBytes=size).collect()
        assert sorted(r["member"].rpartition("/")[2] for r in rows) == sorted(f"{i}.wav" for i in range(40))
        assert all(r["error"] is None for r in rows)
    with open(archives[0], "rb") as f:
        members = media.directory(f, len(f.read()))
    offset, name, _, stored, _ = members[0]
    with open(archives[0], "r+b") as f:
        f.seek(offset + 30 + len(name) + stored // 2)
        old = f.read(4)
        f.seek(-4, 1)
        f.write(bytes(b ^ 255 for b in old))
    rows = media.read_archives(spark, manifest).collect()
    assert [r["member"] for r in rows if r["error"]] == [name] and len(rows) == 40


# -- op4 --------------------------------------------------------------------


def exact(ids, v, k, every=20):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = np.zeros(len(ids))
        for c in range(v.shape[1]):
            score += v[i, c] * v[:, c]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[ids[i]] = [(ids[j], score[j]) for j in order]
    return out


def test_recall_and_scores(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pdf = t.toPandas()
    want = exact(pdf.vec_id.to_numpy(), np.stack(pdf.embedding).astype(np.float64), 20)
    index = ann.build_index(t, "vec_id", "embedding", shard_rows=200)
    got = ann.search(index, t.where("vec_id % 20 = 0"), "vec_id", "embedding").toPandas()
    hits = total = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 21))
        scores = dict(want[q])
        hits += len(set(g.vec_id) & set(scores))
        total += 20
        assert all(s == pytest.approx(scores[i], abs=1e-12) for i, s in zip(g.vec_id, g.score, strict=True) if i in scores)
    assert hits / total >= 0.9


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, []), (6, [0.0, 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    t = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(t, "vec_id", "embedding").orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 1.0), (0, 2, 40, 1.0), (0, 3, 6, 0.0), (20, 1, 0, 1.0), (20, 2, 40, 1.0), (20, 3, 6, 0.0), (40, 1, 0, 1.0), (40, 2, 20, 1.0), (40, 3, 6, 0.0)]
    assert ann.nearest(t.limit(0), "vec_id", "embedding").count() == 0


def test_repeated_queries_and_ragged_lengths(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((300, 6))
    rows = [(i, v[i].tolist()) for i in range(300)]
    want = exact(np.arange(300), v, 20)
    odd_rows = [(0, v[0].tolist()), (20, v[20].tolist()), (20, v[20].tolist()), (7, v[7].tolist()), (40, [1.0]), (1001, [1.0, 2.0]), (1020, [3.0] * 9)]
    got = ann.nearest(spark.createDataFrame(rows + odd_rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").toPandas()
    assert sorted(set(got.query_id)) == sorted(want)
    for q, g in got.groupby("query_id"):
        assert g.sort_values("rank").vec_id.tolist() == [i for i, _ in want[q]]
    # an id with several vectors is one candidate, at its best score, and one query
    both = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [2.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 1.0]), (20, [1.0, 0.0])]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(spark.createDataFrame(both, "vec_id long, embedding array<double>"), "vec_id", "embedding").orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 1.0), (0, 3, 20, 1.0), (20, 1, 1, 2.0), (20, 2, 0, 1.0), (20, 3, 2, 1.0)]


def test_many_copies_of_a_vector(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((60, 8))
    rows = [(i, v[i % 60 if i % 3 else 0].tolist()) for i in range(600)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = exact(np.arange(600), np.array([r[1] for r in rows]), 20)
    got = ann.nearest(t, "vec_id", "embedding").toPandas()
    for q, g in got.groupby("query_id"):
        assert g.sort_values("rank").vec_id.tolist() == [i for i, _ in want[q]]


# -- op6 --------------------------------------------------------------------


def brute_components(texts):
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset() for w in ((t or "").encode().lower().split() for t in texts)]
    label = list(range(len(sets)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))], [len(s) for s in sets]


def near_copies(seed, n, length):
    """A text, many near copies of it at different distances, chains, and clean texts."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(500)]
    base = list(rng.choice(words, length))
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.integers(0, max(2, length // 12))):
            copy[rng.integers(0, length)] = rng.choice(words)
        out.append(" ".join(copy))
    chain = list(rng.choice(words, length))
    for i in range(10):
        chain[(i * 7) % length] = f"c{i}"
        out.append(" ".join(chain))
    return out + [" ".join(rng.choice(words, length)) for _ in range(20)] + ["A b  C", "a B c", "one", "", None]


@pytest.mark.parametrize(("seed", "n", "length", "chunk"), [(1, 150, 60, 16), (2, 80, 150, 1024)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, seed, n, length, chunk):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    texts = near_copies(seed, n, length)
    got = minhash.link(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toPandas().sort_values("doc_id")
    label, size = brute_components(texts)
    assert got.n_shingles.tolist() == size
    assert got.component_id.tolist() == label
    assert got.kept.tolist() == [i == c for i, c in enumerate(label)]


def test_posterior_bounds():
    least = minhash.fewest_matches()
    assert list(least) == sorted(least)
    # a pair at the threshold is dropped at a step with about the chosen probability
    rng = np.random.default_rng(0)
    same_ = rng.random((200_000, minhash.HASHES)) < 0.75
    kept = np.ones(len(same_), bool)
    for i, m in enumerate(least):
        kept &= same_[:, : (i + 1) * minhash.STEP].sum(axis=1) >= m
    assert kept.mean() > 0.9999


def test_near_duplicates_odd_rows(spark):
    got = minhash.link(odd(spark)).collect()
    assert len(got) == len(ODD)
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in got)
    assert {r["n_shingles"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert minhash.link(odd(spark).limit(0)).count() == 0
    none = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "A B C D E F")], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.link(none).collect()} == {(None, 3, False), (3, 3, True)}
    assert minhash.keep_first(odd(spark)).count() == len(ODD)


def test_keep_first_judges_rows(spark):
    """Null and repeated ids: a row goes only for a copy of its own text."""
    copied, other, lone, near = "a b c d e f g h", "one two three four five six", "this text has no copy at all", " ".join(map(str, range(40)))
    rows = [
        (3, copied, "first"), (None, copied, "null copy"), (None, lone, "null unique"), (None, " ", "no words"), (None, " ", "no words"),
        (7, copied, "copy"), (7, "the seventh text is its own", "unique"),
        (None, other, "x"), (None, other.upper(), "x"), (None, other, "x"),
        (9, near, "9"), (9, near + " 40", "9"),
    ]
    got = [(r["doc_id"], r["note"]) for r in minhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, note string")).collect()]
    assert sorted(got, key=str) == sorted([(3, "first"), (None, "null unique"), (None, "no words"), (None, "no words"), (7, "unique"), (None, "x"), (9, "9")], key=str)


def test_keep_first_once_keeps_one_row_of_a_group(spark):
    copied, near = "a b c d e f g h", " ".join(map(str, range(40)))
    rows = [(5, copied, "x"), (5, copied, "x"), (3, copied, "z"), (3, copied, "y"), (5, "other text of its own", "o"), (None, "no id here at all", "n"), (None, "no id here at all", "n"), (8, near, "8"), (9, near + " 40", "9"), (None, None, "e"), (None, None, "e"), (4, "", "e")]
    got = [tuple(r) for r in minhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, note string"), once=True).collect()]
    assert len([r for r in got if r[:2] == (3, copied)]) == 1
    rest = [r for r in got if r[1] != copied]
    assert sorted(rest, key=str) == sorted([(5, "other text of its own", "o"), (None, "no id here at all", "n"), (8, near, "8"), (None, None, "e"), (None, None, "e"), (4, "", "e")], key=str)
    assert minhash.keep_first(odd(spark), once=True).count() == len(ODD) - 1


def test_groups_of_repeated_and_missing_ids_equal_brute_force(spark, monkeypatch):
    """Every row is judged by its own text, also where ids repeat or are null."""
    monkeypatch.setattr(minhash, "CHUNK", 16)
    texts = near_copies(3, 60, 80)
    label, _ = brute_components(texts)
    want = sorted(sorted(t for t, x in zip(map(str, texts), label, strict=True) if x == c) for c in set(label))
    for ids in ([None] * len(texts), [7] * len(texts), [i % 5 for i in range(len(texts))]):
        grouped = minhash._grouped(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")).toPandas()
        kept = minhash.keep_first(spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string"), once=True).count()
        assert len(grouped) == len(texts)
        assert kept == len(want)


def test_many_rows_without_id(spark):
    """A thousand texts under one missing id: as many groups as with ids."""
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(400)], 40)) for _ in range(1000)]
    texts = [t if i % 4 else texts[i - 4] + " more" for i, t in enumerate(texts)]
    with_ids = minhash.link(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).where("kept").count()
    rows = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert minhash.keep_first(rows, once=True).count() == with_ids


# -- op7 --------------------------------------------------------------------


def test_chat_round_trip(spark):
    same_ = "</s>[INST] ok [/INST]"
    texts = [same_, "a\\b<|im_end|>\n<|im_start|>x", "", None, "\\", "<\\|im_end|>", "x" * 100_000, "é🙂"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(2, 0, "system\n", "s"), (2, 1, None, "n"), (2, 1, None, "n"), (None, 3, "user", "lone")]
    made = chat.format_trees(chat.linear_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r["tree"]: r for r in made.collect()}
    assert chat.parse(got[1]["formatted"]) == [("assistant" if i % 2 else "user", t or "") for i, t in enumerate(texts)]
    assert chat.parse(got[2]["formatted"]) == [("system\n", "s"), ("", "n"), ("", "n")]
    assert chat.parse(got[None]["formatted"]) == [("user", "lone")]
    spans = [chat.unescape(got[1]["formatted"][s["start"] : s["end"]]) for s in got[1]["loss"]]
    assert spans == [t or "" for t in texts[1::2]]
    assert "[INST]" not in got[1]["formatted"]


def test_query_digests(spark, sf):
    got = {r["conv_id"]: r for r in queries.op7_chat_format(spark, sf).collect()}
    pdf = spark.read.parquet(f"{sf}/conversations.parquet").toPandas().sort_values(["conv_id", "turn"])
    assert set(got) == {-1, *pdf.conv_id}
    for conv, g in pdf.groupby("conv_id"):
        turns = "".join(f"{r}\n{t or ''}\n" for r, t in zip(g.role, g.text, strict=True))
        loss = "".join(t or "" for r, t in zip(g.role, g.text, strict=True) if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(g), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_clashing_names_and_repeated_rows(spark):
    rows = [(1, 0, "user", "a", 9, "x"), (1, 0, "user", "a", 9, "x"), (1, 1, "assistant", "b", 9, "x")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rank long, formatted string")
    made = chat.format_trees(chat.linear_tree(t)).collect()
    assert [chat.parse(r["formatted"]) for r in made] == [[("user", "a"), ("user", "a"), ("assistant", "b")]]
    assert [made[0]["formatted"][s["start"] : s["end"]] for s in made[0]["loss"]] == ["b"]


def test_branches_are_ranked(spark):
    #      1 -> 2 -> 4 ; 1 -> 3 -> 5 -> 6 ; 8 <-> 9 is a cycle, 7 answers it
    rows = [("t", 1, None, "u", "a", 1.0), ("t", 2, 1, "a", "b", 5.0), ("t", 4, 2, "u", "c", None), ("t", 3, 1, "a", "d", 2.0), ("t", 5, 3, "u", "e", 2.0), ("t", 6, 5, "a", "f", 9.0), ("t", 8, 9, "u", "x", 0.0), ("t", 9, 8, "u", "x", 0.0), ("t", 7, 8, "u", "x", 0.0), ("s", 1, 77, "u", "only", 0.0)]
    m = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r["tree"], r["rank"]): [t for _, t in chat.parse(r["formatted"])] for r in chat.format_trees(m, best=2).collect()}
    assert got == {("t", 1): ["a", "d", "e", "f"], ("t", 2): ["a", "b", "c"], ("s", 1): ["only"]}
    assert chat.format_trees(m.limit(0)).count() == 0


def test_long_chain(spark):
    m = spark.range(1000).select(F.lit("t").alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"), F.lit(0.0).alias("score"))
    assert [t for _, t in chat.parse(chat.format_trees(m).first()["formatted"])] == [str(i) for i in range(1000)]


# -- op10 -------------------------------------------------------------------


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 90)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    # 450 words; a stops at 20; b, c, null share 430 by 2:1:5, null stops at 180; b, c share 250 by 2:1
    assert got["a"] == pytest.approx(20) and got[None] == pytest.approx(180)
    assert got["b"] == pytest.approx(250 * 2 / 3) and got["c"] == pytest.approx(250 / 3)


def test_mix_comes_near_its_targets(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    once = mixing.fair_mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken").toPandas()
    again = mixing.fair_mix(docs.repartition(3)).select("doc_id", "taken").toPandas()
    assert dict(zip(once.doc_id, once.taken, strict=True)) == dict(zip(again.doc_id, again.taken, strict=True))
    assert (once.taken <= 2 * once["size"]).all()
    per = once.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert ((per.taken - per.target).abs() <= 1.5 * per.most).all()
    assert abs(once.taken.sum() - 1.5 * once["size"].sum()) <= once["size"].max()


def test_mix_cut_in_ranges_of_ranges(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    whole, fine = (mixing.fair_mix(docs, range_rows=n).select("doc_id", "taken").toPandas() for n in (1 << 20, 5))
    assert dict(zip(whole.doc_id, whole.taken, strict=True)) == dict(zip(fine.doc_id, fine.taken, strict=True))


def test_mix_odd_rows(spark):
    got = mixing.fair_mix(odd(spark))
    rows = got.collect()
    assert len(rows) == len(ODD) and all(r["taken"] <= 2 * r["size"] for r in rows)
    assert {r["taken"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.fair_mix(odd(spark).limit(0)).count() == 0
    assert [r["taken"] for r in mixing.fair_mix(odd(spark).where("doc_id = 1")).collect()] == [0]


# -- pipeline ---------------------------------------------------------------


def test_pipeline_stages(spark, sf):
    docs = documents(spark, sf)
    seen = {}
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, sf)
        seen[name] = kept.toPandas()
        kept = spark.createDataFrame(seen[name], kept.schema)
        if name != "tokens":
            assert kept.columns == docs.columns
    label, _ = brute_components(seen["language"].sort_values("doc_id").text)
    assert sorted(seen["near_duplicates"].doc_id) == [d for i, d in enumerate(sorted(seen["language"].doc_id)) if label[i] == i]
    assert len(seen["language"]) >= 0.99 * docs.count()
    assert not seen["personal_data"].text.str.contains(r"@mail\d").any()
    counts = seen["mix"].doc_id.value_counts()
    assert counts.max() <= 2 and set(counts.index) <= set(seen["personal_data"].doc_id)
    assert len(seen["tokens"]) == len(seen["mix"]) and (seen["tokens"].n_tokens > 0).all()
    assert json.dumps([n for n, _ in corpus_pipeline.STAGES])


def test_stages_keep_odd_rows_and_clashing_columns(spark, sf):
    names = ("size", "taken", "target", "source_size", "_copy", "_id", "_key", "_row", "row", "key", "id", "a.b")
    rows = [*ODD, (20, "word " * 100_000, "en", "s"), (21, None, None, None)]
    wide = spark.createDataFrame([(*r, 7, *[f"{n}-{i}" for n in names]) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    given = {tuple(r[5:]) for r in wide.collect()}
    for docs in (wide, wide.limit(0), wide.where("text IS NULL")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == wide.columns and [t for _, t in out.dtypes] == [t for _, t in wide.dtypes], name
            assert {tuple(r[5:]) for r in out.collect()} <= given, name
        assert corpus_pipeline.tokens(spark, docs, sf).count() == docs.count()
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.personal_data):
        assert len({r[5] for r in stage(spark, wide, sf).collect()}) >= 8
    assert {r["size"] for r in corpus_pipeline.mix(spark, wide, sf).collect()} <= {f"size-{i}" for i in range(len(rows))}

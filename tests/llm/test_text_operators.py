"""op1, op5, op8, op9: whole texts, odd rows, and brute force or held-out accuracy."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lymphlake.llm import bpe, kneser_ney, langid, pii

ODD = [
    (1, None, "en", "s"),
    (2, "", "en", "s"),
    (3, " \t\n", None, None),
    (4, "word " * 3000 + "end", "en", "s"),
    (5, "same text here", "fr", "s"),
    (5, "same text here", "fr", "s"),
    (None, "no id at all", "fr", None),
    (7, "12345 !!!   \U0001f642", "de", "s"),
    (8, "x" * 5000, "de", "s"),
]
SCHEMA = "doc_id long, text string, lang string, source string, score double, ids string, held_out string, size string, target string, component_id string"


def odd(spark):
    """Odd rows with further columns whose names clash with results."""
    return spark.createDataFrame([(*r, 0.5, "i", "h", "z", "t", "c") for r in ODD], SCHEMA)


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# -- op1 --------------------------------------------------------------------


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = langid.train([bytes(rng.integers(0, 256, 7, dtype=np.uint8)) for _ in range(6)], ["a", "b"] * 3, hidden=3, steps=1)
    net = langid.Network(net.languages, *[p.astype(np.float64) for p in net.parameters()])
    rows, y = rng.integers(0, 256, (4, 7)), np.array([0, 1, 1, 0])
    _, gradients = langid._loss_and_gradients(net, rows, y)
    for p, g in zip(net.parameters(), gradients, strict=True):
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in p.shape) if p.shape[1:2] != (256,) else (rng.integers(0, 2), rows[0, 0], rng.integers(0, p.shape[2]))
            old = p[at]
            p[at] = old + 1e-3
            up, _ = langid._loss_and_gradients(net, rows, y)
            p[at] = old - 1e-3
            down, _ = langid._loss_and_gradients(net, rows, y)
            p[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-3, abs=2e-4)


def test_inference_matches_a_plain_loop():
    rng = np.random.default_rng(3)
    net = langid.train([bytes(rng.integers(0, 256, 9, dtype=np.uint8)) for _ in range(6)], ["a", "b", "c"] * 2, hidden=4, steps=2)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (1, 5, 0, 300, 256)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got, counted = langid.identify_texts(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    h = 4

    def run(segment, d):
        out, s = [], np.zeros(h)
        for b in segment if d == 0 else segment[::-1]:
            inner = s @ net.inner[d]
            gate = lambda x: 1 / (1 + np.exp(-x))
            z, r = gate(net.table[d][b][:h] + inner[:h]), gate(net.table[d][b][h : 2 * h] + inner[h : 2 * h])
            c = np.tanh(net.table[d][b][2 * h :] + r * inner[2 * h :])
            s = z * s + (1 - z) * c
            out.append(s)
        return out if d == 0 else out[::-1]

    for text, p in zip(texts, got, strict=True):
        want = np.zeros(3)
        for i in range(0, len(text), langid.SEGMENT):
            seg = text[i : i + langid.SEGMENT]
            for a, b in zip(run(seg, 0), run(seg, 1), strict=True):
                x = np.exp(np.concatenate([a, b]) @ net.out + net.bias)
                want += x / x.sum()
        assert p == pytest.approx(want / max(1, len(text)), abs=2e-4)
    assert counted.sum(axis=1).tolist() == [len(t) for t in texts]


def test_language_accuracy_on_held_out(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = langid.identify(docs, langid.learned(docs)).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) > 250
    assert (got.lang_pred == got.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_odd_rows(spark):
    rows = odd(spark)
    got = langid.identify(rows, langid.learned(rows, windows=10, steps=3)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 7))
    assert by[4]["n_positions"] == 15003
    assert by[5]["held_out"] == (zlib.crc32(b"5") % 3 == 1)
    assert langid.learned(rows.limit(0)) is None
    # rows without an id, or with one id, are picked by their texts
    learns = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1)
    for doc_id in (F.lit(None), F.lit(learns)):
        found = langid.learned(rows.withColumn("doc_id", doc_id.cast("long")).withColumn("lang", F.lit("en")), windows=10, steps=1)
        assert found is not None and found.languages == ["en"]
    assert langid.identify(rows.limit(0), None).count() == 0
    assert {r["lang_pred"] for r in langid.identify(rows, None).collect()} == {"und"}
    kept = langid.keep_identified(rows)
    assert kept.columns == rows.columns and kept.where("doc_id in (1, 2, 3, 7)").count() == 0
    assert langid.keep_identified(rows.limit(0)).count() == 0


def test_rows_stay_where_nothing_is_labelled(spark):
    rows = odd(spark).withColumn("lang", F.lit(None).cast("string"))
    assert langid.keep_identified(rows).count() == len(ODD)


def test_rare_labels_are_not_learned(spark):
    rows = odd(spark)
    assert langid.learned(rows, windows=10, languages=1, steps=2).languages in (["de"], ["en"], ["fr"])


# -- op5 --------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_equals_tiktoken(vocabulary):
    import tiktoken

    own = bpe.Codec(*vocabulary)
    theirs = tiktoken.Encoding("own", pat_str=vocabulary[1], mergeable_ranks=own.vocabulary, special_tokens={})
    rng = np.random.default_rng(5)
    letters = list("ab \n'sé日🙂1-_") + ["the", "ing", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 200))) for _ in range(300)]
    texts += ["", "a" * 3000, "ab" * 2000, "é" * 400, " " * 700, "\n" * 65, "日本" * 300, "The quick brown fox's 12345 jumps!"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids == theirs.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_matrix_and_heap_agree(vocabulary):
    own = bpe.Codec(*vocabulary)
    rng = np.random.default_rng(6)
    rows = [bytes(rng.choice(list(b"abcdeting "), 60).astype(np.uint8)) for _ in range(200)]
    assert own._matrix(rows, 64) == [own._heap(r) for r in rows]


def test_long_rows_and_heap_agree(vocabulary):
    own = bpe.Codec(*vocabulary)
    rng = np.random.default_rng(8)
    alphabets = (b"a", b"ab", b"abcdeting ", bytes(range(256)), "日本語の文字列éß".encode(), b"0123456789", b" ", b"=-")
    rows = [bytes(rng.choice(list(a), n).astype(np.uint8)) for a in alphabets for n in (1, 2, 3, 129, 500, 3001)]
    rows += ["".join(rng.choice(["the", "ing", "tion", "er", "q", "Zz"], 800)).encode() for _ in range(20)]
    assert own._rows(rows) == [own._heap(r) for r in rows]
    assert own._rows([b"a" * 1_000_000])[0] == own._heap(b"a" * 1_000_000)


def test_bpe_query_odd_rows(spark, vocabulary):
    got = {r["doc_id"]: r for r in bpe.digests(odd(spark), *vocabulary).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[1]["n_tokens"], got[1]["ids_sha256"], got[1]["decoded_sha256"]) == (0, empty, empty)
    for doc, text, *_ in ODD:
        assert got[doc]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    rows = bpe.encode(odd(spark), *vocabulary).collect()
    assert len(rows) == len(ODD) and all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in rows)
    few = bpe.encode(odd(spark), *vocabulary, columns=["doc_id"], decoded=False)
    assert few.columns == ["doc_id", "ids"] and sorted(map(str, (r["ids"] for r in few.collect()))) == sorted(map(str, (r["ids"] for r in rows)))
    assert bpe.digests(odd(spark).limit(0), *vocabulary).count() == 0


# -- op8 --------------------------------------------------------------------


def brute_force(texts, train):
    def tokens(text):
        return [w for w in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w] + ["\0"]

    toks = [tokens(t) for t in texts]
    c = Counter(w for t, k in zip(toks, train, strict=True) if k for w in t)
    b = Counter(x for t, k in zip(toks, train, strict=True) if k for x in zip([None] + t[:-1], t, strict=True))
    total, kinds, follows = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (v, w), n in b.items():
        total[v] += n
        kinds[v][min(n, 3) - 1] += 1
        follows[w] += 1
    discounts = [(0.0, *kneser_ney._discounts([sum(n == k for n in x.values()) for k in (1, 2, 3, 4)])) for x in (b, follows)]
    left = sum(discounts[1][min(n, 3)] for n in follows.values()) / max(1, len(b))
    n_all, v_all = sum(c.values()), len(c)

    def p(v, w):
        word = (follows[w] - discounts[1][min(follows[w], 3)]) / len(b) + left / (v_all + 1)
        if v not in total:
            return word
        n = b[v, w]
        return (n - discounts[0][min(n, 3)]) / total[v] + sum(discounts[0][i + 1] * kinds[v][i] for i in range(3)) / total[v] * word

    out = []
    for t in toks:
        out.append((len(t), sum(c[w] > 0 for w in t), n_all, sum(math.log10((c[w] + 1) / (n_all + v_all + 1)) for w in t), sum(math.log10(p(v, w)) for v, w in zip([None] + t[:-1], t, strict=True))))
    return out, p, c


def test_kneser_ney_equals_brute_force(spark, sf):
    docs = documents(spark, sf)
    pdf = docs.toPandas()
    want, p, c = brute_force(pdf.text, [zlib.crc32(str(i).encode()) % 7 != 2 for i in pdf.doc_id])
    got = kneser_ney.score_held_out(docs).toPandas().set_index("doc_id")
    for doc, w in zip(pdf.doc_id, want, strict=True):
        r = got.loc[doc]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3]
        assert r.base_score == pytest.approx(w[3]) and r.score == pytest.approx(w[4])
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert sum(p("the", w) for w in c) == pytest.approx(1, abs=0.05)


def test_kneser_ney_odd_rows(spark):
    got = kneser_ney.score_held_out(odd(spark)).collect()
    assert len(got) == len(ODD)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert kneser_ney.score_held_out(odd(spark).limit(0)).count() == 0
    none = odd(spark).where("doc_id = 1")
    assert kneser_ney.score_held_out(none).first()["n_tokens"] == 1


# -- op9 --------------------------------------------------------------------


def reference_spans(text):
    """The contract's patterns by plain regular expressions."""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return out


def test_plain_spans_equal_the_patterns(spark, sf):
    rng = np.random.default_rng(4)
    parts = ["a", "b.c", "@", ".", "x@y.z", "1", "22", "+", "-", " ", "(", ")", "255", "256", "4111111111111111", "+1 (988) 555-2485", "é", "007"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 40))) for _ in range(3000)] + [r["text"] for r in documents(spark, sf).collect()]
    for t in texts:
        assert pii.listed(pii.find(t)) == pii.listed(reference_spans(t)), t


@pytest.mark.parametrize(
    ("text", "hidden"),
    [
        ("mail john at example dot com now", "john at example dot com"),
        ("ann dot lee at mail dot example dot org.", "ann dot lee at mail dot example dot org"),
        ("from 42 dot 144 dot 35 dot 254 again", "42 dot 144 dot 35 dot 254"),
        ("bei 10[.]2(.)3[dot]4 x", "10[.]2(.)3[dot]4"),
        ("plus eins neun acht acht fünf fünf fünf zwei vier null", "plus eins neun acht acht fünf fünf fünf zwei vier null"),
        ("joe (at) mail [dot] example.com hi", "joe (at) mail [dot] example.com"),
        ("call + one two three four five six seven eight nine zero ok", "+ one two three four five six seven eight nine zero"),
        ("jоhn@exаmple.com x", "jоhn@exаmple.com"),
        ("４" + "１" * 15 + " card", "４" + "１" * 15),
        ("a​b@c​d.e!", "a​b@c​d.e"),
    ],
)
def test_disguises(text, hidden):
    found = pii.added(text, pii.find(text))
    assert [text[s:e] for s, e, _ in found] == [hidden]
    assert hidden not in pii.redact_text(text)


def test_clean_text_stays():
    for text in ("look at this dot here", "one two buckle my shoe", "at home at work", "résumé naïve", "Москва 2024", ""):
        assert pii.redact_text(text) == text


@pytest.mark.parametrize(
    "hidden",
    [
        "jane@mail dot com", "jane (at) mail dot com", "jane at mail (dot) com", "jane at mail dot app", "jane at mail dot me", "jane at uni dot ac dot nz", "jane at mail.com",
        "jane [  at  ] mail [   dot ] com", "jane dot doe@mail dot museum", "jane.doe at mail dot photos", "j\u0430ne at mail dot gallery", "jane AT mail DOT co.uk", "jane {at} mail.example dot org", "jane42 at mail.com",
    ],
)
def test_mixed_disguises(hidden):
    text = f"ask: {hidden}, soon"
    assert [text[s:e] for s, e, k in pii.added(text, pii.find(text)) if k == "email"] == [hidden]
    assert pii.redact_text(text) == "ask: [EMAIL], soon"


def test_clean_prose_around_at_and_dot():
    for text in ("they looked at polka dot dresses", "look at the dot by the door", "available at example.com now", "see us at www.example.org", "we met at 10.30 there", "stare at that dot until it moves", "an error at main.py", "9am at school.Please come", "end at last. Then go", "list [ a ] (at best)"):
        assert pii.redact_text(text) == text


def test_brackets_and_signs_are_linear():
    for text in (" " * 300_000 + "[at", "[ " * 100_000, "[" + " " * 300_000, " at a" * 60_000, "a dot " * 60_000 + "at", "@a dot " * 50_000, "a (dot) " * 40_000):
        pii.redact_text(text)


def test_runs_of_spaces_are_linear():
    import time

    began = time.time()
    for text in ("one two three" + " " * 1_000_000, "one" + " " * 1_000_000 + "[", "[ at" + " " * 1_000_000, " " * 1_000_000 + "[at]" + " " * 1_000_000, "one " * 200_000, ("[" + " " * 1000) * 1000):
        pii.redact_text(text)
    assert time.time() - began < 60


def test_transducers_compose_on_the_tape():
    text = "write j\u0430ne (\u0430t) \u200b m\u200bail [d\u03bft] com or call + \u043ene tw\u043e three four five six seven eight nine"
    tape = pii.deobfuscate(text)
    assert tape.text == "write jane@mail.com or call +123456789"
    for kind, plain in (("email", "jane@mail.com"), ("phone", "+123456789")):
        s = tape.text.index(plain)
        start, end = tape.span(s, s + len(plain))
        assert (start, end, kind) in pii.added(text, pii.find(text))
        assert text[start:end].startswith("j\u0430ne" if kind == "email" else "+ ")
    assert pii.SPELLED_DIGITS.edits("one two x") == [] and [e[2] for e in pii.SPELLED_DIGITS.edits("one, TWO-three 4 x")] == list("1234")


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 100_000, "a." * 100_000 + " dot x", "+1" * 100_000):
        pii.redact_text(text)


def test_long_domains_and_locals_are_linear():
    began = time.time()
    pii.redact_text("a" * 1_000_000 + " at x." + "de." * 300_000)
    assert time.time() - began < 6


def test_prose_hosts_are_no_addresses():
    for text in ("call me at home dot com today", "meet at home dot com"):
        assert pii.added(text, pii.find(text)) == []
    assert pii.added("write jane at mailer dot com", [])


def test_pii_odd_rows(spark):
    got = pii.find_pii(odd(spark)).collect()
    assert len(got) == len(ODD) and all(r["spans"] == "" for r in got if r["doc_id"] in (1, 2, 3))
    assert got[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(odd(spark).limit(0)).count() == 0
    red = pii.redact(odd(spark))
    assert red.columns == odd(spark).columns and red.where(F.col("text").isNull()).count() == 1

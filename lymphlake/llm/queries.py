"""The queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lymphlake.llm import ann, bpe, chat, decontaminate, kneser_ney, langid, media, merkle, minhash, mixing, pii, search, urlfilter
from lymphlake.plans.tables import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_byte_rnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs, langid.learned(docs))


def op2_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.link(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    same = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", same), (-1, 1, "assistant", same)], given.schema)
    return chat.digests(chat.format_trees(chat.linear_tree(given.unionByName(extra))))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_held_out(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words(F.col("text")).alias("_n"))
    return mixing.fair_mix(docs, size="_n").select("doc_id", "size", "source_size", "target", "taken")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.document_manifest(table(spark, sf_dir, "documents")))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_term_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_byte_rnn, op2_host_trust, op3_media_columns, op4_graph_search, op5_byte_bpe, op6_near_duplicates, op7_chat_format, op8_kneser_ney, op9_pii, op10_fair_mix, op11_merkle_manifest, op12_decontaminate, op13_term_pipeline)}

ORACLES = {
    # all pairs that share a shingle, exact set sizes, then smallest reachable ids
    "op6_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] END) AS sh FROM w),
u AS MATERIALIZED (SELECT DISTINCT doc_id, hash(sh) AS sh FROM s),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM u GROUP BY doc_id),
e AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM u x JOIN u y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL) p
      JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reach)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
""",
    "op10_fair_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0') AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 2 * source_size AS cap,
        CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight FROM s),
lv AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
       FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM lv WHERE level <= cap / weight ORDER BY cap / weight, source NULLS LAST LIMIT 1)) AS target FROM lv),
c AS (SELECT d.*, t.source_size, t.target, sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size ROWS UNBOUNDED PRECEDING) AS cum
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT c.*, copy, (source_size * copy + cum) / target AS finish FROM c, (VALUES (0), (1)) v(copy) WHERE target > 0 AND size > 0),
f AS (SELECT *, sum(size) OVER (ORDER BY finish, copy, source NULLS LAST, k, size ROWS UNBOUNDED PRECEDING) AS upto FROM e),
g AS (SELECT doc_id, source, k, size, cum, count(*) AS copies FROM f
      WHERE upto - size / 2.0 <= (SELECT 1.5 * sum(size) FROM d) GROUP BY ALL)
SELECT c.doc_id, c.size, CAST(c.source_size AS BIGINT) AS source_size, c.target, CAST(c.size * coalesce(g.copies, 0) AS BIGINT) AS taken
FROM c LEFT JOIN g ON c.doc_id IS NOT DISTINCT FROM g.doc_id AND c.source IS NOT DISTINCT FROM g.source AND c.cum = g.cum AND c.size = g.size
""",
    # the tree level by level, then each leaf's siblings of all levels
    "op11_merkle_manifest": r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
d AS (
  SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents),
f AS (
  SELECT doc_id, lang, low, k, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
         coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail, coalesce(strlen(low) || ':' || low, '-') AS low_tail FROM d),
l AS MATERIALIZED (
  SELECT doc_id, lang, sha256(head || tail) AS leaf, CASE WHEN xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) % 3 = 0
                                                          THEN sha256(head || low_tail) ELSE sha256(head || tail) END AS altered
  FROM (SELECT f.*, t, CASE WHEN k = '' THEN [] ELSE list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT)) END AS bytes FROM f, crc)),
p AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM l),
up AS (
  SELECT 0 AS level, g, pos, n, leaf AS digest FROM p UNION ALL
  SELECT level + 1, g, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY level, g, pos // 8, n),
subs AS (SELECT g, digest, g AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, n, digest FROM subs UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 8, n),
steps AS (
  SELECT p.doc_id, p.g, p.pos AS leaf_pos, up.level, coalesce(string_agg(up.digest, '' ORDER BY up.pos) FILTER (up.pos < p.pos // CAST(8 ** up.level AS BIGINT)), '') AS l,
         coalesce(string_agg(up.digest, '' ORDER BY up.pos) FILTER (up.pos > p.pos // CAST(8 ** up.level AS BIGINT)), '') AS r
  FROM p JOIN up ON up.g = p.g AND up.n > 1 AND up.pos // 8 = p.pos // CAST(8 ** (up.level + 1) AS BIGINT) GROUP BY p.doc_id, p.g, p.pos, up.level
  UNION ALL
  SELECT p.doc_id, p.g, p.pos, 100 + top.level, coalesce(string_agg(top.digest, '' ORDER BY top.pos) FILTER (top.pos < p.g // CAST(8 ** top.level AS BIGINT)), ''),
         coalesce(string_agg(top.digest, '' ORDER BY top.pos) FILTER (top.pos > p.g // CAST(8 ** top.level AS BIGINT)), '')
  FROM p JOIN top ON top.n > 1 AND top.pos // 8 = p.g // CAST(8 ** (top.level + 1) AS BIGINT) GROUP BY p.doc_id, p.g, p.pos, top.level),
way AS MATERIALIZED (SELECT g, leaf_pos, list([l, r] ORDER BY level) AS path, sha256(string_agg(l || r, '' ORDER BY level)) AS proof FROM steps GROUP BY g, leaf_pos),
fold AS (
  SELECT p.g, p.pos, 1 AS i, p.altered AS node, way.path FROM p LEFT JOIN way ON way.g = p.g AND way.leaf_pos = p.pos UNION ALL
  SELECT g, pos, i + 1, sha256(path[i][1] || node || path[i][2]), path FROM fold WHERE i <= coalesce(len(path), 0))
SELECT p.doc_id, p.leaf, subs.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root, coalesce(way.proof, sha256('')) AS proof_sha256,
       fold.node AS folded_root, fold.node = (SELECT digest FROM top WHERE n = 1) AS verified
FROM p JOIN subs ON subs.g = p.g LEFT JOIN way ON way.g = p.g AND way.leaf_pos = p.pos
JOIN fold ON fold.g = p.g AND fold.pos = p.pos AND fold.i = coalesce(len(fold.path), 0) + 1
""",
    # all document windows of the lengths that item windows have, looked up among them
    "op12_decontaminate": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
v AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
o AS (SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)),
h AS MATERIALIZED (SELECT o.row, o.n, o.i, v.item_id FROM o JOIN v ON v.t = o.t AND v.n = o.n),
c AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT row, i, n FROM h)) GROUP BY row),
s AS (SELECT row, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256 FROM (SELECT DISTINCT row, item_id FROM h) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (row) LEFT JOIN s USING (row)
""",
    # every item with every document that shares a term
    "op13_term_pipeline": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM benchmark),
t AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
p AS MATERIALIZED (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
i AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, t GROUP BY term, n_docs),
s AS (SELECT q.item_id, p.row, p.doc_id, CAST(sum(i.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * n_docs) // l))))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN i USING (term), t GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, row) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
""",
}

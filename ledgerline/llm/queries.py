"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.common import table

BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.decontamination import contamination
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), span=13, share=20).drop("items")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), limit=512)


#: (verdict, host, path)
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.url_filter import url_verdicts
    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op4_topk_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from ledgerline.llm.topk_products import top_k_products
    return top_k_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.piece_codec import piece_digests
    return piece_digests(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.substring_dedup import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"), span=50)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.secret_scan import secret_spans
    return secret_spans(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.token_files import token_file_digests
    return token_file_digests(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), end_id=0)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.langid import language_id
    return language_id(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.lsh_forest import jaccard_classes
    return jaccard_classes(table(spark, sf_dir, "documents"), size=5, threshold=0.8)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.conversation_repair import conversation_repairs, damaged
    return conversation_repairs(damaged(table(spark, sf_dir, "conversations")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.divergence import source_divergence
    return source_divergence(table(spark, sf_dir, "documents"), min_docs=3, top=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_counts": op2_token_counts,
    "op3_url_filter": op3_url_filter,
    "op4_topk_products": op4_topk_products,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_secrets": op7_secrets,
    "op8_token_files": op8_token_files,
    "op9_language_id": op9_language_id,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_toxicity": op11_toxicity,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_source_divergence": op13_source_divergence,
}

# word by word: every 13-word (or shorter whole) window of an item against every
# window of the same length of every document
OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM (SELECT *, least(13, len(w)) AS n FROM b WHERE len(w) > 0))),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw USING (n, g)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# every product of a query with every other row
OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 20
"""

# the least document of every 50-byte string, on hex digits
OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, k, substring(h, CAST(512 * k + 1 AS BIGINT), 610) AS part
      FROM (SELECT doc_id, h, unnest(range(0, CAST((len(h) // 2 - 49 + 255) // 256 AS BIGINT))) AS k FROM d WHERE len(h) >= 100)),
w AS (SELECT doc_id, 256 * k + q AS p, substring(part, CAST(2 * q + 1 AS BIGINT), 100) AS g
      FROM (SELECT doc_id, k, part, unnest(range(0, CAST(least(256, len(part) // 2 - 49) AS BIGINT))) AS q FROM c)),
m AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g),
f AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS after
      FROM w JOIN m USING (g) WHERE doc_id > least),
s AS (SELECT doc_id, sum(least(50, coalesce(after - p, 50))) AS n_removed, count(*) FILTER (before IS NULL OR p > before + 50) AS n_spans
      FROM f GROUP BY doc_id),
spans AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from
  FROM (SELECT doc_id, min(p) AS a, max(p) + 50 AS b
        FROM (SELECT *, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM f)
        GROUP BY doc_id, run)),
kept AS (SELECT doc_id, string_agg(substring(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS front, max(b) AS last
         FROM spans JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substring(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# every edit script of a conversation by prefixes: the least (cost, audit) of each state after
# each row; crc32 is spelt out bit by bit
OP12_SQL = """
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS k
  FROM conversations),
crc AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, CAST(octet_length(k) AS BIGINT) + 1), lambda i: CAST(ascii(substring(decode(k), i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, j: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind
  FROM src),
rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM crc WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM rows),
marked AS (
  SELECT *, CASE WHEN body = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) || left(lead(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS initials
  FROM numbered),
inserts(state, here, script, lines) AS (VALUES
  (0, 0, '', CAST([] AS VARCHAR[])), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']),
  (1, 1, '', []), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
  (2, 2, '', []), (2, 3, 'I', ['assistant:']), (3, 3, '', []), (3, 2, 'I', ['user:'])),
moves(here, edit, initial, after, cost, role) AS (VALUES
  (0, 'D', NULL, 0, 3, NULL), (1, 'D', NULL, 1, 3, NULL), (2, 'D', NULL, 2, 3, NULL), (3, 'D', NULL, 3, 3, NULL),
  (0, 'R', NULL, 2, 2, 'user'), (1, 'R', NULL, 2, 2, 'user'), (3, 'R', NULL, 2, 2, 'user'), (2, 'R', NULL, 3, 2, 'assistant'),
  (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL)),
best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS found FROM marked
  UNION ALL
  SELECT conv_id, i, state, min(found) FROM (
    SELECT b.conv_id, r.i, m.after AS state,
           {'cost': b.found.cost + 2 * len(s.script) + m.cost + CASE WHEN m.edit <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END,
            'audit': b.found.audit || s.script || m.edit,
            'lines': list_concat(b.found.lines, s.lines, CASE WHEN m.edit = 'D' THEN [] ELSE [coalesce(m.role, r.role) || ':' || r.text] END)} AS found
    FROM best AS b JOIN marked AS r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
    JOIN inserts AS s ON s.state = b.state JOIN moves AS m ON m.here = s.here
    WHERE m.edit = 'D' OR (r.fault IN ('', 'truncated') AND (m.edit = 'R' OR m.initial = left(r.role, 1))))
  GROUP BY conv_id, i, state),
closing(state, script, lines) AS (VALUES
  (0, '', CAST([] AS VARCHAR[])), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', [])),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i < last AND coalesce(initials, '') NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS last FROM marked) GROUP BY conv_id),
done AS (
  SELECT b.conv_id, min({'cost': b.found.cost + 2 * len(z.script), 'audit': b.found.audit || z.script, 'lines': list_concat(b.found.lines, z.lines)}) AS found
  FROM best AS b JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i JOIN closing AS z ON z.state = b.state GROUP BY b.conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(found.cost, 0) AS BIGINT) AS cost,
       coalesce(found.audit, '') AS audit, sha256(coalesce(array_to_string(found.lines, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

# every kept term of every group, and every pair of groups of a language
OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS doc_id, text, lang, source FROM documents)),
t AS (SELECT doc_id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n
      FROM groups AS g JOIN kept AS k ON g.lang = k.lang
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
p AS (SELECT lang, source, term, n,
             1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p
      FROM c JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS o, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS f
             FROM p AS x JOIN p AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
             GROUP BY ALL) AS z ON z.lang = a.lang AND z.s = a.source AND z.o = b.source),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op4_topk_products": OP4_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}

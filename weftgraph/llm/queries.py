"""The dealt operators as queries over whole tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import codebooks, jaccard, language, licenses, lines, mixing, packing, pii, quality, substrings, topk, trie, warc
from weftgraph.llm.common import stage, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = language.held_out(table(spark, sf_dir, "documents"))
    prototypes = language.learn(docs.where("not held_out"))
    # lang and source go no further: a prediction has the text only.
    return language.predict(docs.select("doc_id", "held_out", "text"), prototypes).drop("text")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.encode("kept_text", "utf-8"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_dropped", digest)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), payloads=False).drop("payload")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents"), texts=False).drop("kept_text")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = codebooks.compress(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("arcs_to_end")


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language, op2_mixing, op3_lines, op4_quality, op5_warc, op6_substrings, op7_jaccard,
        op8_pii, op9_topk, op10_packing, op11_codebooks, op12_trie, op13_licenses,
    )
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL: dict[str, str] = {
    "op3_lines": f"""
WITH l AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), k AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM l
), t AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM k
), r AS (
  SELECT key, max(doc_id) AS keeps FROM t WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), d AS (
  SELECT t.*, r.keeps IS NOT NULL AND r.keeps <> t.doc_id AS dropped FROM t LEFT JOIN r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id""",
    "op5_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), d AS (
  SELECT *, sha256(h) AS payload_digest FROM p
), m AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND f <> page_id THEN f END AS refers_to
FROM m""",
    "op6_substrings": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS i FROM w
), h AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 19], ' ')) AS k FROM s
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS later FROM h
), g AS (
  SELECT doc_id, list(i) FILTER (WHERE later) AS places FROM f GROUP BY doc_id
), c AS (
  SELECT DISTINCT doc_id, unnest(range(a, a + 20)) AS i FROM (SELECT doc_id, unnest(places) AS a FROM g)
), x AS (
  SELECT w.doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), y AS (
  SELECT x.doc_id, count(c.i) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE c.i IS NULL), '') AS kept
  FROM x LEFT JOIN c ON c.doc_id = x.doc_id AND c.i = x.i GROUP BY x.doc_id
)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN y USING (doc_id)""",
    "op9_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(range(1, len(v.e) + 1), lambda i: v.e[i] * q.e[i])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
}


def _codebooks_sql(rounds: int = codebooks.ROUNDS) -> str:
    """The rounds one after the other; sums are divided downwards."""
    steps = ""
    for k in range(rounds + 1):
        steps += f""", a{k} AS MATERIALIZED (
  SELECT id, part, min(ROW(d, entry)) AS best FROM (
    SELECT p.id, p.part, b.entry, CAST(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM p JOIN b{k} b USING (part)) GROUP BY id, part
)"""
        if k < rounds:
            steps += f""", n{k} AS MATERIALIZED (
  SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS x FROM (
    SELECT part, best[2] AS entry, place, sum(v) AS s, count(*) AS n FROM (
      SELECT a.part, best, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM a{k} a JOIN p USING (id, part)) GROUP BY ALL)
  GROUP BY part, entry
), b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(n.x, b.x) AS x FROM b{k} b LEFT JOIN n{k} n USING (part, entry)
)"""
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), p AS MATERIALIZED (
  SELECT id, part, e[part * (len(e) // 8) + 1 : (part + 1) * (len(e) // 8)] AS x
  FROM (SELECT *, unnest(range(8)) AS part FROM v)
), b0 AS MATERIALIZED (
  SELECT part, id - 1 AS entry, x FROM p WHERE id <= 16
){steps}, h AS (
  SELECT sha256(string_agg(v, ',' ORDER BY part, entry, place)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM b{rounds})
), c AS (
  SELECT id, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, CAST(sum(best[1]) AS BIGINT) AS error
  FROM a{rounds} GROUP BY id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN c USING (id), h"""


SQL["op11_codebooks"] = _codebooks_sql()

# crc32 of a decimal number, bit by bit over the bytes of its text.
_CRC32 = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ord(x)::UBIGINT)),
    lambda r, x: list_reduce(list_prepend(xor(r, x), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
      lambda y, z: xor(y >> 1, (y & 1) * 3988292384::UBIGINT)))"""

SQL["op12_trie"] = f"""
WITH o AS MATERIALIZED (
  SELECT conv_id AS c, coalesce(text, '') AS text, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), c AS MATERIALIZED (
  SELECT c, CAST(xor({_CRC32}, 4294967295::UBIGINT) % 9 AS BIGINT) AS h, c - c % 5 AS base FROM (SELECT DISTINCT c FROM o)
), r AS (
  SELECT c.c, 0 AS own, o.p, o.text, o.t FROM c JOIN o ON o.c = c.base AND o.p <= c.h
  UNION ALL
  SELECT c.c, 1, o.p, o.text, o.t FROM c JOIN o ON o.c = c.c AND o.p > c.h
), s AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY own, p) AS depth FROM r
), x AS MATERIALIZED (
  SELECT c, depth, strlen(text) AS bytes, md5(string_agg(t, ',') OVER (PARTITION BY c ORDER BY depth)) AS node FROM s
  UNION ALL
  SELECT c, 0, 0, '' FROM c
), n AS MATERIALIZED (
  SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM x GROUP BY depth, node
), k AS MATERIALIZED (
  SELECT n.*, u.node AS parent, u.conv_id AS parent_conv_id
  FROM n LEFT JOIN x ON x.c = n.conv_id AND x.depth = n.depth - 1 LEFT JOIN n u ON u.depth = x.depth AND u.node = x.node
), f AS MATERIALIZED (
  SELECT k.*, coalesce(n_children, 0) AS n_children
  FROM k LEFT JOIN (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM k GROUP BY ALL) USING (depth, node)
), b AS (
  SELECT x.depth, x.node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * f.bytes) AS saved_tokens
  FROM f JOIN x ON x.c = f.conv_id AND x.depth <= f.depth GROUP BY x.depth, x.node
), e AS (
  SELECT depth, node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT c, max(depth) AS depth, arg_max(node, depth) AS node FROM x GROUP BY c) GROUP BY depth, node
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM f JOIN b USING (depth, node) LEFT JOIN e USING (depth, node)"""

_BASE_WORDS = [(label, len(p.split()), w, i) for p, label in licenses.BASE for i, w in enumerate(p.split())]
_LABELS = [(t, label, len(keys)) for t, (label, _, keys) in enumerate(licenses.TEMPLATES)]

SQL["op13_licenses"] = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.BETWEEN}'),
    lambda w: w <> '') AS words FROM documents
), post(template, word, place) AS (VALUES {licenses.values_list(licenses.POSTINGS)}
), phr(template, phrase, length, word, place) AS (VALUES {licenses.values_list(licenses.key_phrases())}
), base(label, length, word, place) AS (VALUES {licenses.values_list(_BASE_WORDS)}
), labels(template, label, keys) AS (VALUES {licenses.values_list(_LABELS)}
), l AS MATERIALIZED (
  SELECT * FROM (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM d)
  WHERE word IN (SELECT word FROM post UNION SELECT word FROM base)
), own AS MATERIALIZED (
  SELECT DISTINCT row, word FROM l
), df AS (
  SELECT word, count(*) AS n FROM own GROUP BY word
), b AS MATERIALIZED (
  SELECT row, label, pos - place AS start FROM l JOIN base USING (word) GROUP BY row, label, start, length HAVING count(*) = length
), w AS (
  SELECT DISTINCT template, word FROM phr
), fit AS (
  SELECT row, template FROM own JOIN w USING (word) GROUP BY row, template
  HAVING count(*) = (SELECT count(*) FROM w u WHERE u.template = w.template)
), t AS (
  SELECT DISTINCT template, word FROM post
), rare AS (
  SELECT row, template, word FROM (
    SELECT row, template, word, row_number() OVER (PARTITION BY row, template ORDER BY n, word) AS k
    FROM fit JOIN t USING (template) JOIN own USING (row, word) JOIN df USING (word)) WHERE k <= {licenses.LOOKUPS}
), g(g) AS (VALUES (0), (1)
), m AS (
  SELECT DISTINCT row, template, g, floor((pos - place + g * {licenses.WINDOW // 2}) / {licenses.WINDOW}.0) AS cell, word
  FROM rare JOIN l USING (row, word) JOIN post USING (template, word), g
), a AS (
  SELECT row, template, g, cell, count(*) / any_value(least({licenses.LOOKUPS}, z.n)) AS share
  FROM m JOIN (SELECT template, count(*) AS n FROM t GROUP BY template) z USING (template)
  GROUP BY row, template, g, cell HAVING share >= {licenses.MIN_SHARE}
), s AS (
  SELECT row, template, phrase, pos - place AS shift FROM fit JOIN phr USING (template) JOIN l USING (row, word)
  GROUP BY row, template, phrase, shift, length HAVING count(*) = length
), c AS (
  SELECT row, template, g, floor((shift + g * {licenses.WINDOW // 2}) / {licenses.WINDOW}.0) AS cell, count(DISTINCT phrase) AS n
  FROM s, g GROUP BY ALL
), f AS (
  SELECT row, label, max(share) AS share FROM a JOIN c USING (row, template, g, cell) JOIN labels USING (template)
  WHERE n = keys GROUP BY row, label
), y AS (
  SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list_sort(list(DISTINCT label)) AS bases FROM b GROUP BY row
), z AS (
  SELECT row, list(label) AS added, max(share) AS best FROM f GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(coalesce(bases, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(bases, []), coalesce(added, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM d LEFT JOIN y USING (row) LEFT JOIN z USING (row)"""

"""The registered queries of the training-data operators, thin over their modules, and the SQL of those that SQL expresses."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, extract, lsa, merkle, minhash, pii, quality, suffixes, token_orc, toolcalls, topk, warc
from .common import fresh_path, map_batches, small_batches, stored, table


#: Documents with a lower score are junk.
KEEP = 0.7


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scores = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))
    return scores.select("doc_id", F.coalesce(quality.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages say, read back."""
    small_batches(spark)
    path = fresh_path(spark, "warc")
    manifest = warc.write_warc(warc.with_record_types(table(spark, sf_dir, "pages", "page_id", "url", "html")), path)
    found = warc.resolve_revisits(stored(warc.read_warc(spark, path, manifest), "warc-records"))
    return found.withColumnRenamed("key", "page_id")


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and CRC-32 of each document's ids, from the ORC files."""
    small_batches(spark)
    path = fresh_path(spark, "token-orc")
    token_orc.write_token_orc(table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_orc.token_starts(token_orc.read_token_orc(spark, path))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linked, ordered and checked tool calls of every conversation."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return toolcalls.link_tool_calls(*toolcalls.from_conversations(turns), toolcalls.own_tools(spark))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the personal data in every document."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s.base)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    of_kind = lambda kind: F.filter("spans", lambda s: s.base & (s.kind == kind))
    counts = [F.size(of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, on two-word shingles."""
    small_batches(spark)
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), words=2)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items found in every document."""
    small_batches(spark)
    return lsa.contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector against all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 400-byte strings that occur twice."""
    return suffixes.without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), digests=True)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the text they decode to, both from one pass of the codec."""
    small_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")

    def make():
        coder = bpe.codec(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, rows = batch.column(1).to_pylist(), []
            for a, b in bpe.text_groups(texts):
                for ids in coder.encode(texts[a:b]):
                    decoded = coder.decode(ids)
                    rows.append((len(ids), hashlib.sha256(ids.astype("<u4")).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            n, first, second = zip(*rows, strict=True)
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(n), pa.int64()), pa.array(first), pa.array(second)], names)

        return work

    return map_batches(table(spark, sf_dir, "documents", "doc_id", "text"), make, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaf, proof and tampering check of every document in the tree over all sources."""
    return merkle.audit(table(spark, sf_dir, "documents", *merkle.FIELDS))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers align in every document, and how common the linked pairs of ids are."""
    small_batches(spark)
    return align.align(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    small_batches(spark)
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return extract.extract(pages, extract.fit(pages))


#: Records of equal payloads of at least 100 bytes: the smallest page_id is the response.
OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM f
"""

#: Calls and results derived from the turns, linked by identifier, levelled by recursion, checked and written as JSON.
OP4_SQL = """
WITH RECURSIVE u AS (
  SELECT conv_id, turn, conv_id || '-' || turn AS call_id, ['search', 'lookup', 'report'][CAST(turn % 3 AS INTEGER) + 1] AS name, coalesce(text, '') AS query,
    CASE WHEN turn >= 2 THEN conv_id || '-' || CAST(CAST(floor((turn - 2) / 4) AS BIGINT) * 2 + turn % 2 AS BIGINT) END AS needs
  FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, min(turn) AS turn, count(*) AS n, arg_min(text, turn) AS content FROM conversations WHERE role = 'assistant' GROUP BY 1, 2),
l AS (
  SELECT u.call_id, u.conv_id, 0 AS level FROM u LEFT JOIN u p ON p.conv_id = u.conv_id AND p.call_id = u.needs WHERE p.call_id IS NULL
  UNION ALL SELECT u.call_id, u.conv_id, l.level + 1 FROM u JOIN l ON u.conv_id = l.conv_id AND u.needs = l.call_id),
e AS (
  SELECT u.conv_id, u.turn, u.call_id, u.name, u.query, a.content, coalesce(a.n, 0) AS n, l.level,
    list_filter(list_sort(list_filter([
      CASE WHEN u.conv_id % 13 = 0 AND u.name <> 'report' THEN 'missing query' END,
      CASE WHEN u.conv_id % 11 = 0 THEN 'wrong type limit' END,
      CASE WHEN u.conv_id % 17 = 0 AND u.name <> 'report' THEN 'unexpected debug' END], lambda x: x IS NOT NULL)) ||
      [CASE WHEN u.needs IS NOT NULL AND p.call_id IS NULL THEN 'no call ' || u.needs END], lambda x: x IS NOT NULL) AS errors
  FROM u JOIN l USING (conv_id, call_id) LEFT JOIN a USING (conv_id, call_id) LEFT JOIN u p ON p.conv_id = u.conv_id AND p.call_id = u.needs)
SELECT conv_id, call_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY level, turn, call_id) - 1 AS BIGINT) AS position, CAST(level AS INTEGER) AS level,
  CASE WHEN n > 1 THEN 'ambiguous' WHEN n = 0 THEN 'missing_result' WHEN len(errors) > 0 THEN 'invalid' ELSE 'ok' END AS status,
  array_to_string(errors, '; ') AS errors,
  '{"arguments":{' || CASE WHEN conv_id % 17 = 0 THEN '"debug":true,' ELSE '' END || '"limit":' || CASE WHEN conv_id % 11 = 0 THEN '"' || turn || '"' ELSE CAST(turn AS VARCHAR) END ||
    CASE WHEN conv_id % 13 <> 0 THEN ',"query":' || to_json(query) ELSE '' END || '},"call_id":"' || call_id || '","name":"' || name || '"' ||
    CASE WHEN content IS NOT NULL THEN ',"result":' || to_json(content) ELSE '' END || '}' AS json
FROM e
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
    ELSE list_distinct(list_transform(generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1])) END AS grams FROM w),
g AS (SELECT doc_id, CAST(len(grams) AS BIGINT) AS n, unnest(grams) AS gram FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o WHERE 100 * c >= 80 * (na + nb - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s JOIN c USING (doc_id)
"""

OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

#: Leaves by source, levels by recursion over runs of three, siblings by joins, the fold by recursion; CRC-32 from its polynomial.
OP11_SQL = """
WITH RECURSIVE k AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, source, lang, n_chars, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) & 1 = 0 AS even
  FROM documents, k),
h AS (
  SELECT doc_id, source, head || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-') AS whole, head || coalesce(CAST(strlen(cut) AS VARCHAR) || ':' || cut, '-') AS changed
  FROM (SELECT *, CASE WHEN even THEN replace(text, chr(10), '') ELSE text END AS cut,
    coalesce(CAST(strlen(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ':' || doc_id, '-') || coalesce(CAST(strlen(source) AS VARCHAR) || ':' || source, '-') ||
    coalesce(CAST(strlen(lang) AS VARCHAR) || ':' || lang, '-') || coalesce(CAST(strlen(CAST(n_chars AS VARCHAR)) AS VARCHAR) || ':' || n_chars, '-') AS head FROM d)),
s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS src FROM (SELECT DISTINCT source FROM documents)),
l AS (
  SELECT doc_id, src, row_number() OVER (PARTITION BY src ORDER BY doc_id) - 1 AS pos, sha256(whole) AS leaf, sha256(changed) AS tampered
  FROM h JOIN s ON h.source IS NOT DISTINCT FROM s.source),
n AS (
  SELECT src, 0 AS lvl, pos, leaf AS h FROM l
  UNION ALL SELECT src, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY src) AS c FROM n) WHERE c > 1 GROUP BY src, lvl, pos // 3),
b AS (SELECT src, max(lvl) AS top FROM n GROUP BY src),
r AS (SELECT n.src, n.h, b.top FROM n JOIN b ON n.src = b.src AND n.lvl = b.top),
m AS (
  SELECT 0 AS lvl, src AS pos, h FROM r
  UNION ALL SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS c FROM m) WHERE c > 1 GROUP BY lvl, pos // 3),
q AS (SELECT max(lvl) AS top FROM m),
w AS (
  SELECT l.src, l.pos, n.lvl AS step, n.pos AS at, n.pos // 3 AS run FROM l JOIN b ON l.src = b.src JOIN n ON n.src = l.src AND n.lvl < b.top AND n.pos = CAST(floor(l.pos / pow(3, n.lvl)) AS BIGINT)),
v AS (SELECT r.src, m.lvl AS step, m.pos AS at, m.pos // 3 AS run FROM r, q JOIN m ON m.lvl < q.top WHERE m.pos = CAST(floor(r.src / pow(3, m.lvl)) AS BIGINT)),
x AS (
  SELECT w.src, w.pos, w.step, coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos < w.at), '') AS a, coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos > w.at), '') AS z
  FROM w JOIN n ON n.src = w.src AND n.lvl = w.step AND n.pos // 3 = w.run GROUP BY w.src, w.pos, w.step),
y AS (
  SELECT v.src, v.step, coalesce(string_agg(m.h, '' ORDER BY m.pos) FILTER (m.pos < v.at), '') AS a, coalesce(string_agg(m.h, '' ORDER BY m.pos) FILTER (m.pos > v.at), '') AS z
  FROM v JOIN m ON m.lvl = v.step AND m.pos // 3 = v.run GROUP BY v.src, v.step),
p AS (
  SELECT src, pos, step, a, z FROM x
  UNION ALL SELECT l.src, l.pos, r.top + y.step, y.a, y.z FROM l JOIN r ON l.src = r.src JOIN y ON y.src = l.src),
f AS (
  SELECT src, pos, 0 AS step, tampered AS h FROM l
  UNION ALL SELECT f.src, f.pos, f.step + 1, sha256(p.a || f.h || p.z) FROM f JOIN p ON p.src = f.src AND p.pos = f.pos AND p.step = f.step),
g AS (SELECT src, pos, arg_max(h, step) AS folded_root FROM f GROUP BY src, pos),
o AS (SELECT src, pos, sha256(string_agg(a || z, '' ORDER BY step)) AS proof_sha256 FROM p GROUP BY src, pos)
SELECT l.doc_id, l.leaf, r.h AS subroot, m.h AS root, coalesce(o.proof_sha256, sha256('')) AS proof_sha256, g.folded_root, g.folded_root = m.h AS verified
FROM l JOIN r ON l.src = r.src JOIN g ON g.src = l.src AND g.pos = l.pos LEFT JOIN o ON o.src = l.src AND o.pos = l.pos, q JOIN m ON m.lvl = q.top
"""

#: What the pages of this table mark as their article, without a cut: its block tags end blocks, other tags go, two references are decoded.
OP13_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
b AS (
  SELECT page_id, url, list_transform(string_split(regexp_replace(regexp_replace(replace(body, '<br>', ' '), '(?s)</?(p|h[1-6]|div|ul|ol|li|blockquote|pre|section)(\s[^>]*)?>', chr(1), 'g'), '(?s)<!--.*?-->|<[a-zA-Z/][^>]*>', '', 'g'), chr(1)),
    lambda x: trim(regexp_replace(regexp_replace(replace(x, '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM a)
SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)) AS text, CAST(length(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10))) AS BIGINT) AS n_chars FROM b
"""


def queries() -> dict:
    return {
        "op1_quality": op1_quality,
        "op2_warc": op2_warc,
        "op3_token_orc": op3_token_orc,
        "op4_tool_calls": op4_tool_calls,
        "op5_pii": op5_pii,
        "op6_minhash": op6_minhash,
        "op7_decontamination": op7_decontamination,
        "op8_topk": op8_topk,
        "op9_suffixes": op9_suffixes,
        "op10_bpe": op10_bpe,
        "op11_merkle": op11_merkle,
        "op12_alignment": op12_alignment,
        "op13_html": op13_html,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op4_tool_calls": OP4_SQL, "op6_minhash": OP6_SQL, "op8_topk": OP8_SQL, "op11_merkle": OP11_SQL, "op13_html": OP13_SQL}

"""SQL counterparts of the queries that SQL can express, written out on their own."""

from __future__ import annotations

import corpus_pipeline

_BACK = "'\\'"


def _escaped(text: str) -> str:
    out = f"replace({text}, {_BACK}, {_BACK} || {_BACK})"
    controls = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
    for c in controls:
        out = f"replace({out}, '{c}', '{c[0]}' || {_BACK} || '{c[1:]}')"
    return out


CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), marked AS (
  SELECT *, CASE WHEN lag(role) OVER w IS DISTINCT FROM role THEN 1 ELSE 0 END AS opens FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (sum(length({_escaped('text')})) + sum(opens * (24 + length(replace({_escaped('role')}, chr(10), '[' || {_BACK} || 'NL]'))))
    + 10 * sum(1 - opens))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

_DATE = "strftime({}, '%Y-%m-%d %H:%M:%S')"
REVISITS = f"""
WITH parts AS (
  SELECT page_id, html, regexp_replace(trim(url), '#.*$', '') AS bare FROM pages
), split AS (
  SELECT page_id, html, bare,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      lower(regexp_extract(bare, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?]*)', 1)), '^.*@', ''), '^www\\d*\\.', ''), ':(80|443)$', ''), '\\.$', '') AS host,
    regexp_replace(bare, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*', '') AS rest
  FROM parts
), named AS (
  SELECT page_id, html, host || regexp_replace(split_part(rest, '?', 1), '/+$', '') AS base,
    array_to_string(list_sort(list_filter(string_split(CASE WHEN rest LIKE '%?%' THEN regexp_replace(rest, '^[^?]*\\?', '') ELSE '' END, '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|msclkid|mc_[ce]id)(=|$)', 'i'))), '&') AS query
  FROM split
), page AS (
  SELECT page_id, base || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url,
    to_timestamp(1700000000 + page_id * 60)::TIMESTAMP AS seen, '"' || substr(md5(coalesce(html, '')), 1, 12) || '"' AS tag, length(html) AS size
  FROM named
), revisit AS (
  SELECT page_id * 2 + 1 AS record_id, page_id, url, seen, tag,
    CASE WHEN page_id % 13 = 0 THEN seen - INTERVAL 1 DAY ELSE seen + INTERVAL 1 DAY END AS captured FROM page
), ranked AS (
  SELECT r.record_id, r.page_id, r.url, r.seen, r.captured, r.tag AS own_tag, f.page_id * 2 AS full_id, f.tag, f.seen AS full_seen, f.size,
    row_number() OVER (PARTITION BY r.record_id ORDER BY f.seen DESC NULLS LAST, f.page_id DESC) AS n
  FROM revisit r LEFT JOIN page f ON f.url = r.url AND (f.seen < r.captured OR (f.seen = r.captured AND f.page_id * 2 < r.record_id))
), judged AS (
  SELECT *, CASE WHEN full_id IS NULL THEN 'missing'
    WHEN page_id % 11 = 0 THEN 'unvalidated'
    WHEN page_id % 7 = 0 THEN CASE WHEN seen = full_seen THEN 'resolved' ELSE 'mismatch' END
    WHEN page_id % 5 <> 0 AND own_tag = tag THEN 'resolved' ELSE 'mismatch' END AS resolution
  FROM ranked WHERE n = 1
)
SELECT record_id, url AS canonical_url, resolution,
  CASE WHEN resolution IN ('resolved', 'unvalidated') THEN full_id END AS refers_to,
  CASE WHEN resolution IN ('resolved', 'unvalidated') THEN
    CASE WHEN page_id % 11 = 0 THEN 'age: 1' || chr(10) ELSE '' END
    || 'content-length' || coalesce(': ' || size, '') || chr(10) || 'date: ' || {_DATE.format('captured')} || chr(10)
    || 'etag: ' || CASE WHEN page_id % 11 = 0 OR page_id % 7 = 0 THEN tag ELSE 'W/' || own_tag END || chr(10) || 'expires: 0' || chr(10)
    || 'last-modified: ' || {_DATE.format("(CASE WHEN page_id % 11 <> 0 AND page_id % 7 = 0 THEN seen ELSE full_seen END) - INTERVAL 3 DAY")} || chr(10) || 'server: a' END AS headers
FROM judged
"""

TOP_K = """
WITH parts AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM parts q JOIN parts d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_BYTES = "list_transform(generate_series(1, octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i - 1 AS INTEGER), 2) AS BIGINT))"
_BIT = "xor(x >> 1, 3988292384 * (x & 1))"
_CRC = (
    f"xor(4294967295, list_reduce(list_prepend(4294967295, {_BYTES}), "
    f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: {_BIT})))"
)
_SPLIT = "unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"
RESAMPLING = f"""
WITH said AS (SELECT doc_id, {_SPLIT} AS w FROM documents), aim AS (SELECT {_SPLIT} AS w FROM benchmark),
vocabulary AS (SELECT w, {_CRC} % 10000 AS bucket FROM (SELECT w FROM said UNION SELECT w FROM aim)),
s AS (SELECT bucket, count(*) AS n FROM said JOIN vocabulary USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aim JOIN vocabulary USING (w) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM said) + 10000)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM aim) + 10000)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
), weight AS (
  SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM said JOIN vocabulary USING (w) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weight USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= (SELECT floor(10 * count(*) / 100) FROM scored WHERE n_features >= 20) THEN place END AS rank
FROM placed
"""

LLM_ORACLE: dict[str, str] = {
    "op2_top_k": TOP_K,
    "op4_warc_revisits": REVISITS,
    "op7_chat_format": CHAT,
    "op13_resampling": RESAMPLING,
}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

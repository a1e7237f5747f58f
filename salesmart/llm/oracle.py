"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

EXACT_DEDUP = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256
FROM d JOIN g USING (h)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
b AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, h,
    array_to_string(list_transform(range(8), lambda k: array_to_string(list_transform([15, 10, 5, 0], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(h, CAST(5 * k + 1 AS BIGINT), 5))::INTEGER >> s) & 31) + 1, 1)), '')), '') AS payload_digest
  FROM p),
r AS (SELECT h, max(page_id) AS first FROM b GROUP BY h),
n AS (SELECT *, row_number() OVER (PARTITION BY h, page_id) AS k FROM b JOIN r USING (h))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first AND k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN NOT (page_id IS NOT DISTINCT FROM first AND k = 1) THEN first END AS refers_to
FROM n
"""

ORACLE: dict[str, str] = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op5_warc": WARC,
}

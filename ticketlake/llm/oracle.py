"""DuckDB counterparts of the corpus queries that SQL can express."""

from __future__ import annotations

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = f"""
WITH d AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

OP10 = """
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
keyed AS (
  SELECT doc_id, n, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM raw),
held AS (
  SELECT *, length(line_key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY line_key) AS dropped FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM held GROUP BY doc_id
"""

LLM_ORACLE: dict[str, str] = {"op8_exact_dedup": OP8, "op10_line_dedup": OP10}

"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x20\x09-\x0D]+"

LINE_DEDUP = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
pos AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs),
held AS (SELECT doc_id, i, lines[i] AS line,
                translate(trim(lines[i], {_SPACES}), '{_UPPER}', '{_LOWER}') AS k FROM pos),
common AS (SELECT k, max(doc_id) AS keeper FROM held WHERE length(k) >= 20
           GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, i, line, keeper IS NOT NULL AND doc_id <> keeper AS gone
           FROM held LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w
  FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM pos),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
          JOIN n nx ON nx.doc_id = a.doc_id JOIN n ny ON ny.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 75 * (nx.n + ny.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
          UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach r ON r.x = d.doc_id
GROUP BY d.doc_id, n.n
"""

DECONTAMINATION = f"""
WITH w AS (
  SELECT 0 AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w
  FROM documents
  UNION ALL
  SELECT 1, item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') FROM benchmark),
pos AS (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0),
sh AS (SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s FROM pos),
n AS (SELECT id, count(*) AS n FROM sh WHERE kind = 1 GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, n.n AS n_item, count(*) AS n_shared
FROM sh d JOIN sh b ON d.s = b.s AND d.kind = 0 AND b.kind = 1 JOIN n ON n.id = b.id
GROUP BY d.id, b.id, n.n HAVING 100 * count(*) >= 75 * n.n
"""

SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM pos),
hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS lo FROM win) WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM hit),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w WHERE len(w) > 0),
left_ AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) AS kept, count(*) AS n
          FROM word LEFT JOIN gone USING (doc_id, i) WHERE gone.i IS NULL GROUP BY word.doc_id)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(left_.n, 0) AS n_removed,
       sha256(coalesce(left_.kept, '')) AS kept_sha256
FROM w LEFT JOIN left_ ON left_.doc_id = w.doc_id
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
             max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to,
       true AS verified
FROM s
"""

_GROUP = "CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), {0}, 8) AS BIGINT)"
FILL_IN_MIDDLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
                  {_GROUP.format(1)} AS h1, {_GROUP.format(9)} AS h2, {_GROUP.format(17)} AS h3, {_GROUP.format(25)} AS h4
           FROM documents),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
             greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM d),
p AS (SELECT *, coalesce(array_to_string(u[:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
             coalesce(array_to_string(u[b + 1:], ''), '') AS suf,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
                  THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": JACCARD, "op2_decontamination": DECONTAMINATION, "op3_substring_dedup": SUBSTRING_DEDUP, "op6_line_dedup": LINE_DEDUP, "op8_warc": WARC,
            "op11_fill_in_middle": FILL_IN_MIDDLE}

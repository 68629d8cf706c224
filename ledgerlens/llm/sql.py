"""DuckDB SQL for the queries that SQL can express on whole tables."""

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
g AS (
  SELECT doc_id, h,
         first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY h) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256
FROM g
"""

ORACLE["op3_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (CAST(concat('0x', substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE)
           / 4503599627370496.0::DOUBLE AS u
  FROM documents),
a AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
b AS (SELECT source, source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM a),
w AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
         CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS total
  FROM b),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own
  FROM w),
m AS (SELECT *, max(CASE WHEN own <= cap / weight THEN own END) OVER () AS level FROM l),
t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM m),
e AS (
  SELECT source, source_size, target, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS whole,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each_
  FROM t),
r AS (
  SELECT d.doc_id, d.size, e.source, e.source_size, e.target, e.whole, each_ - whole AS p,
         (each_ - whole) * e.source_size AS need,
         CASE WHEN each_ - whole > 0 THEN (u / (1 - u)) / ((each_ - whole) / (1 - (each_ - whole))) END AS q
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
s AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM r)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN p > 0 AND upto - size / 2.0 <= need THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM s
"""

ORACLE["op8_preferences"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
a AS (SELECT conv_id, max(turn) AS last_turn FROM c WHERE role = 'assistant' GROUP BY conv_id),
b AS (SELECT c.conv_id, a.last_turn, max(c.text) AS answer
      FROM c JOIN a ON c.conv_id = a.conv_id AND c.turn = a.last_turn WHERE c.role = 'assistant'
      GROUP BY c.conv_id, a.last_turn),
n AS (SELECT conv_id, last_turn, coalesce(lag(answer) OVER (ORDER BY conv_id),
             first_value(answer) OVER (ORDER BY conv_id DESC)) AS other FROM b),
s AS (
  SELECT c.conv_id, turn, role, text, 'chosen' AS side FROM c JOIN n ON c.conv_id = n.conv_id
  UNION ALL
  SELECT c.conv_id, turn, role,
         CASE WHEN role = 'assistant' AND turn = last_turn THEN other ELSE text END, 'rejected'
  FROM c JOIN n ON c.conv_id = n.conv_id),
e AS (
  SELECT conv_id, turn FROM s GROUP BY conv_id, turn, role, text
  HAVING sum(CASE WHEN side = 'chosen' THEN 1 ELSE 0 END) <> sum(CASE WHEN side = 'rejected' THEN 1 ELSE 0 END)),
f AS (SELECT conv_id, min(turn) AS first_turn FROM e GROUP BY conv_id),
p AS (
  SELECT s.conv_id AS pair_id, s.turn, s.role, s.side,
         CASE WHEN first_turn IS NULL OR s.turn < first_turn THEN 'prompt' ELSE side END AS part,
         '<|im_start|>' || replace(replace(role, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')
           || chr(10) AS head,
         replace(replace(text, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') || '<|im_end|>' AS body
  FROM s LEFT JOIN f ON s.conv_id = f.conv_id)
SELECT pair_id, part, turn, role, head || body || chr(10) AS rendered,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(head) ELSE 0 END AS train_from,
       CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(head) + length(body) ELSE 0 END AS train_to
FROM p WHERE part <> 'prompt' OR side = 'chosen'
"""

ORACLE["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
k AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM k)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

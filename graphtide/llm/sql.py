"""Reference SQL of the operators that SQL can express."""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS win
  FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM items),
places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win
  FROM d, lens WHERE len(w) >= n),
hits AS (SELECT doc_id, i, items.n, item_id FROM places JOIN items USING (win)),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

MIXING = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
         row_number() OVER (PARTITION BY source ORDER BY md5('0:' || doc_id), doc_id) - 1 AS mix_rank
  FROM documents),
n AS (SELECT key, count(*) AS n FROM d GROUP BY key),
s AS (SELECT key, n, row_number() OVER (ORDER BY key) AS i, sqrt(n) AS w, (n + 31) // 32 AS blocks FROM n),
g AS (SELECT list(w ORDER BY i) AS ws, list(blocks ORDER BY i) AS bs, sum(w) AS total FROM s),
-- A quotient that should be whole may miss it by rounding.
run AS (
  SELECT -1::BIGINT AS t, list_transform(ws, lambda x: 0::BIGINT) AS c, 0::BIGINT AS pick FROM g
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(ws) + 1), lambda i: c[i] + CASE WHEN i = best THEN 1 ELSE 0 END), best
  FROM (
    SELECT t, c, ws, bs, list_min(list_filter(list_transform(range(1, len(ws) + 1), lambda i:
             CASE WHEN floor(c[i] * total / ws[i] + 1e-9) <= t + 1 THEN CAST(ceil((c[i] + 1) * total / ws[i] - 1e-9) AS BIGINT) * 1000000 + i END),
             lambda v: v IS NOT NULL)) % 1000000 AS best
    FROM run, g)
  WHERE c[best] < bs[best]),
mixed AS (SELECT pick AS i, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS j, t AS slot, true AS in_mix FROM run WHERE t >= 0),
placed AS (SELECT s.i, blocks, w, count(mixed.i) AS done FROM s LEFT JOIN mixed ON mixed.i = s.i GROUP BY ALL),
left_over AS (SELECT i, w, unnest(range(done, blocks)) AS j FROM placed),
slots AS (
  SELECT * FROM mixed
  UNION ALL
  SELECT i, j, (SELECT count(*) FROM mixed) + row_number() OVER (ORDER BY ceil((j + 1) * total / w - 1e-9), i, j) - 1, false FROM left_over, g)
SELECT doc_id, source, CAST(slot AS BIGINT) AS mix_slot, CAST(mix_rank // 32 AS BIGINT) AS mix_block, CAST(mix_rank AS BIGINT) AS mix_rank, in_mix
FROM d JOIN s USING (key) JOIN slots ON slots.i = s.i AND slots.j = mix_rank // 32
"""

_ESCAPED = "replace(replace(replace({0}, '\\', '\\b'), '#', '\\h'), '<', '\\l')"

CHAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('### ' || replace({_ESCAPED.format('role')}, ':', '\\c') || ': ' || {_ESCAPED.format('text')} || '</turn>' || chr(10))) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""

FILL_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
r AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y,
         CAST('0x' || h[17:24] AS BIGINT) % 100 AS rate, CAST('0x' || h[25:32] AS BIGINT) % 100 AS turn
  FROM d),
f AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(u[greatest(x, y) + 1:n], '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR rate >= 50 THEN 'plain'
              WHEN turn < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM r)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
       CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""

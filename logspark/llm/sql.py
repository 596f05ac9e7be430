"""The queries that SQL can express, as SQL for another engine."""

URL_FILTER = r"""
WITH p AS (
  SELECT page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*[?]([^#]*)', 1), ''), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS asked
  FROM pages
), c AS (
  SELECT *, CASE WHEN host <> '' THEN
      regexp_replace(regexp_replace(host, '^www[.]', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END END AS canonical
  FROM p
), listed AS (
  SELECT DISTINCT canonical FROM c
  WHERE canonical IS NOT NULL AND 20 * (length(html) - length(translate(html, '#$%*', ''))) > length(html)
), r AS (
  SELECT page_id, host, path, canonical,
    CASE
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
    END AS rule
  FROM c
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN r.canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict,
  canonical, coalesce(canonical IN (SELECT canonical FROM listed), false) AS listed
FROM r
"""

CHATS = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations
), c AS (
  SELECT conv_id, list(struct_pack(a := turn, b := role, c := text) ORDER BY turn, role, text) AS turns FROM t GROUP BY conv_id
), kept AS (
  SELECT conv_id FROM c WHERE NOT EXISTS (
    SELECT 1 FROM c AS d WHERE d.turns[1] = c.turns[1] AND d.conv_id <> c.conv_id AND d.turns[1:len(c.turns)] = c.turns
      AND (len(d.turns) > len(c.turns) OR d.conv_id < c.conv_id))
)
SELECT conv_id, turn // 1024 AS part, count(*) AS n_turns,
  string_agg('<|im_start|>'
    || translate(regexp_replace(coalesce(role, 'unknown'), '<\|(im_start|im_end)\|>', '<\1>', 'g'), chr(13) || chr(10), '  ') || chr(10)
    || regexp_replace(coalesce(text, ''), '<\|(im_start|im_end)\|>', '<\1>', 'g') || '<|im_end|>', chr(10) ORDER BY turn, role, text) AS text
FROM t SEMI JOIN kept USING (conv_id) GROUP BY conv_id, turn // 1024
"""

FILL_IN_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
    sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS digest
  FROM documents
), h AS (
  SELECT *, len(t) AS n, cast('0x' || digest[1:8] AS bigint) AS h1, cast('0x' || digest[9:16] AS bigint) AS h2,
    cast('0x' || digest[17:24] AS bigint) AS h3, cast('0x' || digest[25:32] AS bigint) AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
         THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, array_to_string(t[1:a], '') AS x, array_to_string(t[a + 1:b], '') AS y, array_to_string(t[b + 1:], '') AS z FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
    ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

"""DuckDB form of the chat formatting query."""

FORMATTED = r"""
WITH RECURSIVE rows_ AS (SELECT conv_id, turn, role, text, conv_id + turn AS mark,
    substr(regexp_replace(text, '[\x00-\x1f"\\]', ' ', 'g'), 1, 24) AS q,
    length(text) - length(replace(text, ' ', '')) + 1 AS words FROM conversations),
calls AS (SELECT conv_id, turn, 'call_' || CASE WHEN mark % 17 = 0 THEN turn - 2 ELSE turn END AS call_id,
    CASE mark % 3 WHEN 0 THEN 'count' WHEN 1 THEN 'search' ELSE 'note' END AS name,
    CASE WHEN mark % 11 = 0 THEN '{}'
         WHEN mark % 13 = 0 THEN '{"text":true,"words":"' || words || '"}'
         WHEN mark % 3 = 0 THEN '{"words":' || words || '}'
         WHEN mark % 3 = 1 THEN '{"limit":' || words % 20 || ',"query":"' || q || '"}'
         ELSE '{"pinned":true,"text":"' || q || '"}' END AS arguments,
    mark % 11 = 0 OR mark % 13 = 0 AS bad,
    CASE WHEN mark % 2 = 0 THEN 'call_' || (turn - 2) END AS need
  FROM rows_ WHERE role = 'assistant'),
results AS (SELECT conv_id, turn, 'call_' || CASE WHEN mark % 19 = 0 THEN turn + 100 ELSE turn - 1 END AS call_id, text
  FROM rows_ WHERE role = 'user' AND turn > 0),
first_call AS (SELECT conv_id, call_id, turn, need FROM calls
  QUALIFY row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn) = 1),
first_result AS (SELECT conv_id, call_id, min(turn) AS turn FROM results GROUP BY ALL),
needs AS (SELECT f.conv_id, f.call_id, f.need FROM first_call f
  JOIN first_call g ON f.conv_id = g.conv_id AND f.need = g.call_id),
walk(conv_id, call_id, level) AS (
  SELECT conv_id, call_id, 0 FROM first_call f
  WHERE NOT EXISTS (SELECT 1 FROM needs n WHERE n.conv_id = f.conv_id AND n.call_id = f.call_id)
  UNION ALL
  SELECT n.conv_id, n.call_id, w.level + 1 FROM walk w JOIN needs n ON n.conv_id = w.conv_id AND n.need = w.call_id)
SELECT conv_id, turn, 'message' AS kind, NULL::VARCHAR AS call_id, NULL::INTEGER AS level, NULL::BIGINT AS linked_turn,
  'ok' AS status, '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' AS json FROM rows_
UNION ALL
SELECT c.conv_id, c.turn, 'call', c.call_id, w.level, r.turn,
  CASE WHEN c.turn <> f.turn THEN 'repeated id' WHEN w.level IS NULL THEN 'cycle' WHEN c.bad THEN 'invalid arguments'
       WHEN r.turn IS NULL THEN 'no result' ELSE 'ok' END,
  '{"role":"assistant","tool_calls":[{"arguments":' || c.arguments || ',"id":"' || c.call_id || '","name":"' || c.name || '"}]}'
FROM calls c JOIN first_call f USING (conv_id, call_id) LEFT JOIN walk w USING (conv_id, call_id)
LEFT JOIN first_result r USING (conv_id, call_id)
UNION ALL
SELECT r.conv_id, r.turn, 'result', r.call_id, w.level, f.turn,
  CASE WHEN f.turn IS NULL THEN 'no call' WHEN r.turn <> a.turn THEN 'repeated result'
       WHEN r.turn < f.turn THEN 'before call' ELSE 'ok' END,
  '{"content":' || to_json(r.text) || ',"role":"tool","tool_call_id":"' || r.call_id || '"}'
FROM results r LEFT JOIN first_call f USING (conv_id, call_id) LEFT JOIN walk w USING (conv_id, call_id)
LEFT JOIN first_result a USING (conv_id, call_id)
"""

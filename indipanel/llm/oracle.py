"""DuckDB SQL for the registered queries, where SQL can express them."""

from __future__ import annotations

from .chat import CONTROL, END, TEXT, TURN


def _escaped(text: str) -> str:
    rest = "|".join(x.replace("|", r"\|").replace("]", r"\]") for x in CONTROL)
    return rf"regexp_replace({text}, '([<\[])(\\*)((?:{rest}))', '\1\\\2\3', 'g')"


OP1 = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT conv_id, turn, text, CASE role WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant'
    WHEN 'model' THEN 'assistant' ELSE role END AS role FROM said
), made AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS spoken,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    string_agg('{TURN}' || {_escaped("role")} || '{TEXT}' || {_escaped("text")} || '{END}', ''
               ORDER BY turn NULLS FIRST, role, text) AS formatted
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(spoken) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  length(formatted) AS formatted_chars, formatted
FROM made
"""

OP11 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), said AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(words) < 200,
    'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)} AS f
  FROM docs LEFT JOIN said USING (doc_id)
), fails AS (
  SELECT part, good, toxic, concat(if(f.A, 'A', ''), if(f.B, 'B', ''), if(f.C, 'C', ''), if(f.D, 'D', ''), if(f.E, 'E', '')) AS f,
    count(*) AS n FROM failing GROUP BY ALL
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step::INT AS step, filter_order[step] AS own, left(filter_order, step - 1) AS earlier
  FROM orders, range(1, 6) t(step)
), counted AS (
  SELECT part, filter_order, step, own, good, toxic, n, f, contains(f, own) AS has,
    length(translate(f, earlier, '')) < length(f) AS gone FROM fails, steps
), made AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (NOT has AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (has AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (has AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (f = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (has AND NOT gone AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (has AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM counted GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM made
"""

ORACLE = {"op1_chat_format": OP1, "op11_filter_audit": OP11}

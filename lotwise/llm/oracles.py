"""DuckDB SQL for the queries that SQL can express."""

ORACLE = {}

ORACLE["op6_chat_formatting"] = """
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
opening AS (SELECT conv_id, role, text FROM ordered WHERE pos = 1),
said AS (
  SELECT conv_id, sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS n
  FROM ordered GROUP BY conv_id),
ranked AS (
  SELECT o.conv_id, row_number() OVER w AS rank, first_value(o.conv_id) OVER w AS chosen_id,
         count(*) OVER (PARTITION BY o.role, o.text) AS members
  FROM opening o JOIN said s USING (conv_id)
  WINDOW w AS (PARTITION BY o.role, o.text ORDER BY s.n DESC, o.conv_id)),
pairs AS (
  SELECT chosen_id, CASE WHEN members > 1 THEN conv_id END AS rejected_id
  FROM ranked WHERE members = 1 OR rank > 1),
first_difference AS (
  SELECT p.chosen_id, p.rejected_id, min(a.pos) AS pos
  FROM pairs p JOIN ordered a ON a.conv_id = p.chosen_id
  LEFT JOIN ordered b ON b.conv_id = p.rejected_id AND b.pos = a.pos
                     AND b.role = a.role AND b.text = a.text
  WHERE p.rejected_id IS NOT NULL AND b.conv_id IS NULL
  GROUP BY ALL),
first_reply AS (
  SELECT conv_id, min(pos) AS pos FROM ordered WHERE role = 'assistant' GROUP BY conv_id),
sizes AS (SELECT conv_id, count(*) AS n FROM ordered GROUP BY conv_id),
cut AS (
  SELECT p.chosen_id, p.rejected_id,
         CAST(CASE WHEN p.rejected_id IS NULL THEN coalesce(r.pos - 1, s.n)
                   ELSE coalesce(d.pos - 1, s.n) END AS INTEGER) AS n_prompt_turns
  FROM pairs p JOIN sizes s ON s.conv_id = p.chosen_id
  LEFT JOIN first_reply r ON r.conv_id = p.chosen_id
  LEFT JOIN first_difference d ON d.chosen_id = p.chosen_id AND d.rejected_id = p.rejected_id),
segments AS (
  SELECT conv_id, pos, '<|' || role || '|>' || chr(10) || text || chr(10) AS segment,
         CASE WHEN role = 'assistant' THEN '1' ELSE '0' END AS train FROM ordered),
chosen AS (
  SELECT c.chosen_id, c.rejected_id, c.n_prompt_turns,
         coalesce(string_agg(segment, '' ORDER BY pos) FILTER (pos <= n_prompt_turns), '') AS prompt,
         coalesce(string_agg(segment, '' ORDER BY pos) FILTER (pos > n_prompt_turns), '') AS chosen_text,
         coalesce(string_agg(train, '' ORDER BY pos) FILTER (pos > n_prompt_turns), '') AS chosen_mask
  FROM cut c JOIN segments s ON s.conv_id = c.chosen_id GROUP BY ALL),
rejected AS (
  SELECT c.chosen_id, c.rejected_id,
         coalesce(string_agg(segment, '' ORDER BY pos) FILTER (pos > n_prompt_turns), '') AS rejected_text,
         coalesce(string_agg(train, '' ORDER BY pos) FILTER (pos > n_prompt_turns), '') AS rejected_mask
  FROM cut c JOIN segments s ON s.conv_id = c.rejected_id GROUP BY ALL)
SELECT h.chosen_id, h.rejected_id, h.n_prompt_turns, h.prompt, h.chosen_text, h.chosen_mask,
       r.rejected_text, r.rejected_mask
FROM chosen h LEFT JOIN rejected r ON r.chosen_id = h.chosen_id AND r.rejected_id = h.rejected_id
"""

ORACLE["op8_exact_dedup"] = """
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
"""

ORACLE["op5_decontamination"] = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
spans AS (
  SELECT item_id, words, least(13, len(words)) AS size FROM item_words WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[p:p + size - 1], ' ') AS w
  FROM (SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS p FROM spans)),
doc_windows AS (
  SELECT doc_id, size, p, array_to_string(words[p:p + size - 1], ' ') AS w
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS p
        FROM doc_words CROSS JOIN (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
hits AS (SELECT doc_id, item_id, p, d.size AS size FROM doc_windows d JOIN windows USING (size, w)),
hit_words AS (
  SELECT doc_id, count(DISTINCT position) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS position FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a SQL expression, bit by bit."""
    code = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::UBIGINT)"
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, {code}), lambda c, byte:
      list_reduce([xor(c, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda r, step:
        CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)),
    4294967295::UBIGINT)::BIGINT"""


ORACLE["op4_sharding"] = f"""
WITH sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size,
         {_crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
placed AS (
  SELECT *, row_number() OVER w AS nth, sum(size) OVER w - size AS bytes_before, sum(size) OVER () AS all_bytes
  FROM sized WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32 ROWS UNBOUNDED PRECEDING)),
cut AS (
  SELECT *, least(23, (2 * bytes_before + size) * 24 // (2 * all_bytes))::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY nth) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _edited(state: str, cost: str, letter: str, line: str | None) -> str:
    """A state (cost, letters, lines) after an edit."""
    lines = f"{state}.l" if line is None else f"list_append({state}.l, {line})"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'l': {lines}}}"


def _unless(condition: str, option: str) -> str:
    return f"CASE WHEN {condition} THEN {option} ELSE {{'c': 1000000000, 'a': '', 'l': []::VARCHAR[]}} END"


def _row_options(state: str, initial: str, role: str) -> list[str]:
    """Keep and Rerole of a row from a state that expects ``role``."""
    return [_unless(f"NOT gone AND initial = '{initial}'", _edited(state, "cut", "K", "role || ':' || text")),
            _unless("NOT gone", _edited(state, "2 + cut", "R", f"'{role}:' || text"))]


# A forward dynamic programme, one row per recursion: states are the least (cost, letters) that lead there.
ORACLE["op12_conversation_repair"] = f"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM plain, range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) copies(n)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS nth,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
told AS (
  SELECT *, left(role, 1) AS initial, body = '' AS blank,
         body != '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nth) > 1 AS repeats
  FROM ordered),
faults AS (
  SELECT *, blank OR repeats AS gone,
         (NOT blank AND NOT repeats AND right(body, 1) NOT IN ('.', '!', '?'))::INTEGER AS cut,
         coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY nth) || initial NOT IN ('su', 'ua', 'au'), false)
           AS illegal
  FROM told),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         sum(blank::INTEGER) AS blank, sum(repeats::INTEGER) AS duplicate, sum(cut) AS truncated,
         sum(illegal::INTEGER) AS illegal, max(nth) AS last FROM faults GROUP BY conv_id),
edits AS (
  SELECT conv_id, 0::BIGINT AS nth, {{'c': 0, 'a': '', 'l': []::VARCHAR[]}} AS s0,
         {{'c': 1000000000, 'a': '', 'l': []::VARCHAR[]}} AS s1, {{'c': 2, 'a': 'I', 'l': ['user:']}} AS s2,
         {{'c': 4, 'a': 'II', 'l': ['user:', 'assistant:']}} AS s3 FROM counted
  UNION ALL
  SELECT conv_id, nth, s0, s1, t2,
         {_least("s3", _edited("t2", "2", "I", "'assistant:'"))} FROM (
    SELECT conv_id, nth, s0, s1, s3, {_least("s2", *(_edited(s, "2", "I", "'user:'") for s in ("s0", "s1", "s3")))} AS t2
    FROM (
      SELECT e.conv_id, f.nth, {_edited("s0", "3", "D", None)} AS s0,
             {_least(_edited("s1", "3", "D", None), _unless("NOT gone AND initial = 's'", _edited("s0", "cut", "K", "role || ':' || text")))} AS s1,
             {_least(_edited("s2", "3", "D", None), *(o for s in ("s0", "s1", "s3") for o in _row_options(s, "u", "user")))} AS s2,
             {_least(_edited("s3", "3", "D", None), *_row_options("s2", "a", "assistant"))} AS s3
      FROM edits e JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.nth = e.nth + 1))),
done AS (
  SELECT c.*, {_least("s0", "s3")} AS best
  FROM edits e JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND c.last = e.nth)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(array_to_string(best.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM k.conv_id
"""

"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

DEDUP = f"""
WITH d AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def _placed(kind: str, number: int, pattern: str, context: tuple[int, int] = (40, 24)) -> str:
    """Matches of a pattern in table ``d`` with their places, from the lengths of what lies between."""
    return f"""
SELECT *, substr(text, greatest(s - {context[0]}, 0) + 1, least(s, {context[0]})) || ' '
         || substr(text, s + length(hit) + 1, {context[1]}) AS near FROM (
SELECT doc_id, text, {number} AS kind, '{kind}' AS name, hits[i] AS hit,
       (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))::BIGINT AS s,
       right(gaps[i], 1) || ' ' || left(gaps[i + 1], 1) AS beside
FROM (SELECT doc_id, text, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
      FROM (SELECT doc_id, text, regexp_extract_all(text, {pattern}) AS hits, string_split_regex(text, {pattern}) AS gaps FROM d)))
"""


def _words(words: str) -> str:
    """The words as whole ones in a lower-cased text."""
    return f"'(?:^|[^a-z])(?:{words})s?(?:[^a-z]|$)'"


_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_LUHN = """
list_sum(list_transform(range(1, length(digits) + 1), lambda i:
  CASE WHEN i % 2 = 1 THEN digits[length(digits) - i + 1]::INT
       ELSE 2 * digits[length(digits) - i + 1]::INT - CASE WHEN digits[length(digits) - i + 1]::INT > 4 THEN 9 ELSE 0 END
  END)) % 10 = 0
"""
_MOD97 = """
list_reduce(list_prepend(0, list_transform(string_split(account[5:] || account[1:4], ''), lambda c:
  CASE WHEN c BETWEEN '0' AND '9' THEN ord(c) - 48 ELSE ord(c) - 55 END)),
  lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1
"""

PII = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (
{_placed("email", 0, "'[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+'")} UNION ALL
{_placed("ip", 1, "'[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+'")} UNION ALL
{_placed("card", 2, "'[0-9](?:[ -]?[0-9])+'")} UNION ALL
{_placed("phone", 3, "'[+][0-9][ ().0-9-]+[0-9]'")} UNION ALL
{_placed("iban", 4, "'[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)'")} UNION ALL
{_placed("ssn", 5, "'[0-9]{3}-[0-9]{2}-[0-9]{4}'")}),
told AS (
SELECT *, {_DIGITS} AS digits, replace(hit, ' ', '') AS account, lower(near) AS context FROM found),
scored AS (
SELECT doc_id, kind, name, s, s + length(hit) AS e, least(100,
  CASE kind WHEN 0 THEN 80 WHEN 1 THEN 50 WHEN 2 THEN 80 WHEN 3 THEN 60 WHEN 4 THEN 80 ELSE 40 END
  + CASE WHEN regexp_matches(context, CASE kind WHEN 0 THEN {_words("e?mail|contact|write to")} WHEN 1 THEN {_words("ip|host|server|address|login")}
      WHEN 2 THEN {_words("card|visa|credit|payment")} WHEN 3 THEN {_words("phone|tel|call|mobile|fax")}
      WHEN 4 THEN {_words("iban|bank|account")} ELSE {_words("ssn|social security|tax id")} END) THEN 20 ELSE 0 END
  - CASE WHEN regexp_matches(context, {_words("version|example|order no|isbn|serial")}) THEN 20 ELSE 0 END) AS score
FROM told WHERE CASE kind WHEN 0 THEN true
  WHEN 1 THEN regexp_full_match(hit, '0*{_OCTET}([.]0*{_OCTET}){{3}}')
  WHEN 2 THEN length(digits) BETWEEN 14 AND 19 AND {_LUHN}
  WHEN 3 THEN length(digits) BETWEEN 10 AND 15
  WHEN 4 THEN {_MOD97}
  ELSE NOT regexp_matches(hit, '^(000|666|9)|-00-|-0000$')
    AND NOT regexp_matches(beside, '[0-9-]') END),
listed AS (SELECT * FROM scored WHERE kind < 4 OR score >= 60)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_email, count(*) FILTER (kind = 1) AS n_ip,
  count(*) FILTER (kind = 2) AS n_card, count(*) FILTER (kind = 3) AS n_phone,
  sha256(coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 4), '')) AS base_sha256,
  coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind), '') AS spans,
  coalesce(string_agg(score::VARCHAR, ',' ORDER BY s, kind), '') AS scores
FROM d LEFT JOIN listed USING (doc_id) GROUP BY d.doc_id
"""

#: CRC-32 by its table of 256 remainders, byte by byte over the hexadecimal digits of the text.
SHARDING = """
WITH crc_table AS (
SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
  CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
d AS (
SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size,
  xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
    lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
FROM documents, crc_table),
region AS (
SELECT *, list_transform(range(4), lambda i: -ln((('0x' || md5(doc_id || '/' || i)[1:13])::BIGINT + 1) / 4503599627370496.0)
  / CASE WHEN i = 3 THEN 1 ELSE 8 END) AS draws FROM d),
rack AS (
SELECT *, list_position(draws[1:3], list_min(draws[1:3])) - 1 AS r, draws[4] < list_min(draws[1:3]) AS moves FROM region),
drawn AS (
SELECT *, list_transform(range(2), lambda i:
  -ln((('0x' || md5(doc_id || '/' || r || '/' || i)[1:13])::BIGINT + 1) / 4503599627370496.0) / 4) AS racks FROM rack),
chosen AS (
SELECT *, list_position(racks, list_min(racks)) - 1 AS k FROM drawn),
leaf AS (
SELECT *, list_transform(range(4), lambda i:
  -ln((('0x' || md5(doc_id || '/' || r || '/' || k || '/' || i)[1:13])::BIGINT + 1) / 4503599627370496.0)) AS leaves FROM chosen),
placed AS (
SELECT doc_id, size, text_crc32, moves, (8 * r + 4 * k + list_position(leaves, list_min(leaves)) - 1)::INT AS shard FROM leaf)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
  CASE WHEN moves THEN 24 ELSE shard END::INT AS grown_shard, 'key' AS law
FROM placed
"""

CHAT = r"""
WITH t AS (
SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL
SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL
SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<s>[INST:[/INST]</s>') + length(role) + length(text)
      + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

URLS = r"""
WITH p AS (
SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)', 1),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
       regexp_extract(coalesce(url, ''), '^[\s\S]*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
SELECT p.page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
  arg_max(verdict, length(rule_host || rule_path)) AS verdict
FROM p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY p.page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict,
  CASE WHEN regexp_matches(host, 'casino|pills|poker|spam|torrent|warez|xxx')
      OR regexp_matches(path, '/(ads|banner|cgi-bin|phpmyadmin|wp-admin)/|/wp-login[.]php$')
      OR regexp_matches(host || path, '[.](apk|exe)$') THEN 'block' ELSE 'allow' END) AS verdict FROM fits
"""

DECONTAM = r"""
WITH w AS (
SELECT id, doc, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words FROM (
  SELECT doc_id AS id, true AS doc, coalesce(text, '') AS text FROM documents UNION ALL
  SELECT item_id, false, coalesce(text, '') FROM benchmark)),
s AS (
SELECT DISTINCT id, doc, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
  ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
sizes AS (SELECT id, count(*) AS n FROM s WHERE NOT doc GROUP BY id)
SELECT a.id AS doc_id, b.id AS item_id, count(*) AS common, any_value(n) AS item_shingles, count(*) / any_value(n) AS containment
FROM s a JOIN s b ON a.doc AND NOT b.doc AND a.shingle = b.shingle JOIN sizes ON sizes.id = b.id
GROUP BY a.id, b.id HAVING count(*) / any_value(n) >= 0.8
"""

#: All pairs of distinct sets that share a shingle, and what is reachable over links.
MINHASH = rf"""
WITH RECURSIVE w AS (
SELECT doc_id, list_filter(string_split_regex({LOWERED}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
sets AS (
SELECT doc_id, list_sort(list_distinct(list_transform(
  range(1, greatest(len(words) - 1, least(len(words) + 1, 2))), lambda i: array_to_string(words[i:i + 2], ' ')))) AS set FROM w),
classes AS (SELECT min(doc_id) AS cls, set FROM sets WHERE len(set) > 0 GROUP BY set),
s AS (SELECT cls, len(set) AS n, unnest(set) AS shingle FROM classes),
links AS (
SELECT a.cls AS a, b.cls AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.cls < b.cls
GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT cls AS node, cls AS other FROM classes UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)
SELECT doc_id, len(set)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id, doc_id = coalesce(root, doc_id) AS kept
FROM sets LEFT JOIN classes USING (set) LEFT JOIN roots ON node = cls
"""

ORACLE_SQL: dict[str, str] = {
    "op1_pii": PII, "op2_exact_dedup": DEDUP, "op5_sharding": SHARDING, "op7_chat": CHAT, "op8_urls": URLS,
    "op10_decontam": DECONTAM, "op11_minhash": MINHASH}

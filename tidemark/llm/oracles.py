"""DuckDB statements for the queries of this package that SQL can express.

The others need CRC-32, a tokenizer, a trained model or an iterative method that
DuckDB lacks; ``tests/llm`` compares them with brute force.
"""

from __future__ import annotations

from tidemark.llm.licenses import ANCHORS, RULES, SENTENCES, STOP, rules_by_length, wordings

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(col: str) -> str:
    return f"translate({col}, '{_UPPER}', '{_LOWER}')"


_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATION = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lowered("coalesce(text, '')")}, {_WORDS}) AS w FROM documents),
item AS (
  SELECT DISTINCT item_id::VARCHAR AS item, regexp_extract_all({_lowered("coalesce(text, '')")}, {_WORDS}) AS w FROM benchmark WHERE item_id IS NOT NULL),
wanted AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS body
  FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM wanted),
place AS (
  SELECT r, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS body
  FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)),
hit AS (SELECT r, i, p.size, item FROM place p JOIN wanted q ON p.size = q.size AND p.body = q.body),
words AS (SELECT r, count(DISTINCT place) AS n_hit FROM hit, unnest(range(i, i + size)) AS u(place) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

# A mark (end of a sentence or line) stands twice, so that one match can take the first and the next match the second.
_KNOWN = "MAP {" + ", ".join(f"'{words.replace(STOP, '~')}': '{letter}'" for words, letter in wordings(SENTENCES).items()) + "}"
_BODIES = "|".join(words.replace(" ", "(?: |\\n\\n)").replace(STOP, "\\x01\\x01") for words in wordings(SENTENCES))
_NAMES = "MAP {" + ", ".join(f"'{seq}': '{name}'" for name, seq in RULES) + "}"
_HINTED = " OR ".join(f"contains({_lowered('t')}, '{a}')" for a in ANCHORS)
LICENSES = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
line AS (
  SELECT doc_id, CASE WHEN {_HINTED} THEN string_split(regexp_replace(regexp_replace(regexp_replace(replace(t, chr(1), ' ') || chr(10),
         '(SPDX-License-Identifier:[^\\n]*)\\n', '\\1' || chr(1) || chr(10), 'g'), '\\n[ \\t]*([a-z("])', ' \\1', 'g'),
         '[.!?;:]+[ \\t\\n\\x0B\\f\\r]', chr(1), 'g'), chr(10)) ELSE [] END AS l FROM doc),
words AS (
  SELECT doc_id, chr(1) || array_to_string(list_transform(l, lambda s: CASE WHEN regexp_matches(s, '[A-Za-z0-9]')
         THEN regexp_replace({_lowered("s")}, '[^a-z0-9\\x01]+', ' ', 'g') ELSE chr(1) END), chr(10)) || chr(1) AS w FROM line),
mark AS (
  SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(w, '[ \\n]*\\x01[ \\n\\x01]*', chr(1), 'g'), ' ?\\n[ \\n]*', chr(10), 'g'),
         '([\\n\\x01])', '\\1\\1', 'g') AS w FROM words),
letter AS (
  SELECT doc_id, coalesce(array_to_string(list_transform(regexp_extract_all(w, '[\\n\\x01](?:{_BODIES})[\\n\\x01]'), lambda s:
         ({_KNOWN})[replace(replace(s[2:-2], chr(10) || chr(10), ' '), chr(1) || chr(1), '~')]), ''), '') AS sentence_ids FROM mark),
rule AS (SELECT *, regexp_extract_all(sentence_ids, '({"|".join(seq for _, seq in rules_by_length())})') AS m FROM letter)
SELECT doc_id, sentence_ids, array_to_string(m, ',') AS rule_matches,
       array_to_string(list_sort(list_distinct(list_transform(m, lambda x: ({_NAMES})[x]))), ',') AS licenses FROM rule
"""


def _digits(col: str, at: int) -> str:
    return f"('0x' || substr(md5({col}), {at}, 4))::INTEGER"


_HOST = r"regexp_extract(" + _lowered("url") + r", '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)"
_SEGMENT = r"regexp_extract(" + _lowered("url") + r", '^[a-z][a-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1)"
URLS = f"""
WITH page AS (
  SELECT row_number() OVER () AS r, page_id, (DATE '2024-01-01' + ((page_id % 366) + 366) % 366 * INTERVAL 1 DAY)::DATE AS day,
         {_HOST} AS host, CASE WHEN {_SEGMENT} = '' THEN '' ELSE {_HOST} || '/' || {_SEGMENT} END AS section FROM pages),
name AS (SELECT DISTINCT pattern FROM (SELECT unnest([host, section, regexp_extract(host, '([^.]+\\.[^.]+)$', 1)]) AS pattern FROM page) WHERE pattern <> ''),
log AS (
  SELECT pattern, CASE WHEN {_digits("pattern", 13)} % 3 = 0 THEN 'allow' ELSE 'block' END AS action, ['add', 'remove', 'add', 'add'][k + 1] AS op,
         (DATE '2024-01-01' + ({_digits("pattern", 1)} % 250 + ({_digits("pattern", 5)} % 60 + 1) * k) * INTERVAL 1 DAY)::DATE AS dated
  FROM name, unnest([0, 1, 2, 3]) AS u(k) WHERE k <= {_digits("pattern", 9)} % 4),
last AS (
  SELECT r, pattern, arg_max(op, dated) AS op, arg_max(action, dated) AS action, max(dated) AS dated
  FROM page JOIN log ON dated <= day AND (pattern = host OR pattern = section OR ends_with(host, '.' || pattern)) GROUP BY r, pattern),
best AS (
  SELECT r, count(*) AS n, arg_max({{'p': pattern, 'a': action, 'd': dated}}, [contains(pattern, '/')::INTEGER, length(pattern)]) AS b
  FROM last WHERE op = 'add' GROUP BY r)
SELECT page_id, day, host, coalesce(b.a = 'block', false) AS blocked, b.p AS decided_by, b.d AS listed_on, coalesce(n, 0)::BIGINT AS n_active
FROM page LEFT JOIN best USING (r)
"""


def _draw(at: int) -> str:
    return f"('0x' || substr(h, {at}, 8))::BIGINT"


INFILL = f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS w,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cut AS (
  SELECT *, len(w) AS n, {_draw(1)} % (len(w) + 1) AS x, {_draw(9)} % (len(w) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_draw(17)} % 100 >= 100 THEN 'plain'
              WHEN {_draw(25)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM doc),
part AS (
  SELECT *, coalesce(array_to_string(list_slice(w, 1, least(x, y)), ''), '') AS p,
         coalesce(array_to_string(list_slice(w, least(x, y) + 1, greatest(x, y)), ''), '') AS m,
         coalesce(array_to_string(list_slice(w, greatest(x, y) + 1, n), ''), '') AS s FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM part
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
line AS (SELECT r, doc_id, unnest(w) AS l, generate_subscripts(w, 1) AS i FROM doc),
keyed AS (SELECT *, {_lowered(f"trim(l, {_BLANKS})")} AS k FROM line),
gone AS (SELECT k AS g FROM (SELECT DISTINCT r, k FROM keyed WHERE k <> '') GROUP BY k HAVING count(*) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(g)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE g IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN gone ON k = g GROUP BY r, doc_id
"""

ORACLES: dict[str, str] = {"op3_urls": URLS, "op5_licenses": LICENSES, "op9_decontamination": DECONTAMINATION, "op12_lines": LINES,
                           "op13_infill": INFILL}

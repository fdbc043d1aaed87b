"""SQL that must agree with the queries, written for DuckDB over the same tables."""

from __future__ import annotations

from . import chat, quality

WORD = r"[^\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def either(texts: tuple[str, ...]) -> str:
    return quoted("|".join(texts))


LINE_CLEANING = f"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos FROM split),
worded AS (SELECT *, regexp_extract_all(line, '{WORD}') AS lw, ROW_NUMBER() OVER (PARTITION BY doc_id, line ORDER BY pos) AS times FROM lines WHERE regexp_matches(line, '{WORD}')),
judged AS (SELECT doc_id, times, strlen(array_to_string(lw, '')) AS bytes, times = 1
    AND regexp_matches(lw[-1], {quoted(f'[{quality.ENDS}][{quality.CLOSERS}]*$')})
    AND 100 * len(list_filter(lw, lambda x: regexp_matches(x, {quoted(f'^[{quality.SEPARATORS}]+$')}))) <= {quality.MOST_SEPARATORS} * len(lw)
    AND 100 * len(list_filter(lw, lambda x: regexp_matches(x, {quoted(f'[{quality.MARKS}][{quality.MARKS}]$')}))) <= {quality.MOST_MARKED} * len(lw)
    AND NOT regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {either(quality.BOILERPLATE)}) AS passes FROM worded),
by_line AS (SELECT doc_id, COUNT(*) FILTER (times > 1) AS n_dup_lines, COUNT(*) FILTER (NOT passes) AS n_failed_lines,
    COALESCE(SUM(bytes) FILTER (passes), 0) AS kept_bytes, SUM(bytes) AS all_bytes FROM judged GROUP BY doc_id),
placed AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS pos, len(w) AS n FROM split),
runs AS (SELECT doc_id, pos, n, x || ' ' || LEAD(x, 1) OVER o || ' ' || LEAD(x, 2) OVER o || ' ' || LEAD(x, 3) OVER o || ' ' || LEAD(x, 4) OVER o AS run
    FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
counted AS (SELECT doc_id, pos, CASE WHEN run IS NOT NULL AND COUNT(*) OVER (PARTITION BY doc_id, run) > 1 THEN 1 ELSE 0 END AS again FROM runs),
covered AS (SELECT doc_id, MAX(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM counted),
by_run AS (SELECT doc_id, CAST(SUM(inside) AS BIGINT) AS n_repeat_words FROM covered GROUP BY doc_id),
figures AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(COALESCE(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    COALESCE(n_repeat_words, 0) AS n_repeat_words, CAST(COALESCE(n_failed_lines, 0) AS BIGINT) AS n_failed_lines, COALESCE(kept_bytes, 0) AS kept_bytes, COALESCE(all_bytes, 0) AS all_bytes
    FROM split LEFT JOIN by_line USING (doc_id) LEFT JOIN by_run USING (doc_id)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines, base_failed, NOT base_failed AND 100 * kept_bytes >= 50 * all_bytes AS kept FROM base"""

_SAID = quoted("\\### Assistant: </turn> ok")
_MARKS = len(chat.NEW) + len(chat.TEXT) + len(chat.END)


def _escaped(column: str) -> str:
    return f"replace(replace({column}, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')"


CHAT_WINDOWS = f"""
WITH RECURSIVE rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', {_SAID} UNION ALL SELECT -7, 1, 'assistant', {_SAID}),
sized AS (SELECT *, len(regexp_extract_all(text, '{WORD}')) AS tok, length({_escaped('role')}) + length({_escaped('text')}) + {_MARKS} AS chars,
    ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i FROM rows),
summed AS (SELECT *, SUM(tok) OVER o - tok AS pre, SUM(chars) OVER o - chars AS at FROM sized WINDOW o AS (PARTITION BY conv_id ORDER BY i)),
convs AS (SELECT conv_id, COUNT(*) AS n, bool_or(i = 0 AND role = 'system') AS sys, SUM(chars) FILTER (i = 0) AS first_chars,
    greatest({512 - 128} - CASE WHEN bool_or(i = 0 AND role = 'system') THEN SUM(tok) FILTER (i = 0) ELSE 0 END, 1) AS own, SUM(chars) AS chars FROM summed GROUP BY conv_id),
starts AS (SELECT conv_id, CAST(0 AS BIGINT) AS s FROM convs UNION ALL
    SELECT a.conv_id, MIN(x.i) FROM starts a JOIN summed b ON b.conv_id = a.conv_id AND b.i = a.s JOIN convs c ON c.conv_id = a.conv_id
    JOIN summed x ON x.conv_id = a.conv_id AND x.i > a.s AND x.pre + x.tok - b.pre > c.own GROUP BY a.conv_id),
repeated AS (SELECT a.conv_id, a.s, CASE WHEN c.sys AND a.s > 0 THEN c.first_chars ELSE 0 END + COALESCE(SUM(x.chars), 0) AS chars
    FROM starts a JOIN convs c ON c.conv_id = a.conv_id JOIN summed b ON b.conv_id = a.conv_id AND b.i = a.s
    LEFT JOIN summed x ON x.conv_id = a.conv_id AND x.i < a.s AND x.i >= greatest(a.s - 4, CASE WHEN c.sys THEN 1 ELSE 0 END) AND b.pre - x.pre <= 128
    GROUP BY a.conv_id, a.s, c.sys, c.first_chars)
SELECT c.conv_id, c.n AS n_turns, sha256(d.said) AS turns_sha256, CAST(length(d.target) AS BIGINT) AS loss_chars, sha256(d.target) AS loss_sha256,
    CAST(c.chars + r.chars AS BIGINT) AS formatted_chars FROM convs c
JOIN (SELECT conv_id, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS said, COALESCE(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS target
      FROM summed GROUP BY conv_id) d ON d.conv_id = c.conv_id
JOIN (SELECT conv_id, SUM(chars) AS chars FROM repeated GROUP BY conv_id) r ON r.conv_id = c.conv_id"""

FILL_IN_MIDDLE = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
    FROM documents),
drawn AS (
    SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM units),
parted AS (
    SELECT doc_id, t, n,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
        coalesce(array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], ''), '') AS p,
        coalesce(array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], ''), '') AS m,
        coalesce(array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], ''), '') AS s
    FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parted
"""

# crc32 is taken bit by bit: each byte is followed by eight shifts, marked -1
PREFIX_TRIE = """
WITH own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said, strlen(coalesce(text, '')) AS bytes
    FROM conversations WHERE conv_id IS NOT NULL),
steps AS (
    SELECT conv_id, count(*) AS n, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS s
    FROM own GROUP BY conv_id),
heads AS (
    SELECT conv_id, n, xor(list_reduce(list_prepend(4294967295, s), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 9 AS h,
        conv_id - conv_id % 5 AS base
    FROM steps),
rebuilt AS (
    SELECT h.conv_id, o.i AS place, said, bytes FROM heads h JOIN own o ON o.conv_id = h.base AND o.i <= h.h
    UNION ALL
    SELECT h.conv_id, least(h.h, coalesce(b.n, 0)) + o.i - h.h, said, bytes FROM heads h LEFT JOIN heads b ON b.conv_id = h.base JOIN own o ON o.conv_id = h.conv_id AND o.i > h.h),
prefixes AS (
    SELECT conv_id, place AS depth, bytes, string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY place) AS path FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM heads),
lengths AS (SELECT conv_id, max(depth) AS length FROM prefixes GROUP BY conv_id),
nodes AS (
    SELECT path, depth, min(p.conv_id) AS conv, count(*) AS n_convs, max(bytes) AS bytes,
        coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (WHERE depth = length), '') AS ends
    FROM prefixes p JOIN lengths USING (conv_id) GROUP BY path, depth),
tree AS (SELECT c.*, p.conv AS parent FROM nodes c LEFT JOIN nodes p ON c.depth > 0 AND p.path = c.path[1:64 * (c.depth - 1)]),
children AS (SELECT parent AS conv, depth - 1 AS depth, count(*) AS n FROM tree WHERE depth > 0 GROUP BY ALL),
above AS (SELECT path, unnest(range(0, depth + 1)) AS up FROM nodes),
sums AS (
    SELECT a.path[1:64 * a.up] AS top, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved
    FROM above a JOIN nodes n ON n.path = a.path LEFT JOIN children k ON k.conv = n.conv AND k.depth = n.depth GROUP BY ALL)
SELECT CAST(t.conv AS BIGINT) AS conv_id, CAST(t.depth AS BIGINT) AS depth, CAST(parent AS BIGINT) AS parent_conv_id, CAST(n_convs AS BIGINT) AS n_convs,
    CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM tree t JOIN sums s ON s.top = t.path LEFT JOIN children k ON k.conv = t.conv AND k.depth = t.depth
"""

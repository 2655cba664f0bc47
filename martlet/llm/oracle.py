"""SQL of the corpus queries that SQL can express, for DuckDB over the same tables.

Written from the contracts and the operators' docstrings, without their code.
"""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM t, unnest(range(1, len(w) - 1)) r(i)),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, (VALUES (0), (1), (2)) v(o) GROUP BY doc_id),
m AS (SELECT t.doc_id, text, w, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
             CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
      FROM t LEFT JOIN cov ON t.doc_id = cov.doc_id),
b AS (SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words)
       AND NOT (2 * length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) > length(regexp_replace(text, '[^\p{{L}}]', '', 'g')))
       AND NOT (2 * n_dup_lines > len(string_split(text, chr(10))))
       AND NOT (10 * len([x FOR x IN w IF regexp_matches(x, '\p{{L}}')]) < 7 * n_words) AS kept
FROM b"""

SUBSTRINGS = rf"""
WITH t AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM t, unnest(range(1, len(w) - 48)) r(i)),
least_id AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + o AS i
         FROM win JOIN least_id USING (k), unnest(range(0, 50)) v(o) WHERE least < doc_id),
word AS (SELECT doc_id, i, w[i] AS word FROM t, unnest(range(1, len(w) + 1)) r(i)),
kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) AS words, count(*) AS n
         FROM word LEFT JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i
         WHERE gone.doc_id IS NULL GROUP BY word.doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id"""

_TERMS = (rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# the exact windows, and for near ones the two rarest terms of each window
DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
item_win AS (SELECT item_id, w[i:i + 12] AS win FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) r(i)
             WHERE len(w) > 0),
wins AS (SELECT win, list(DISTINCT item_id) AS items FROM item_win GROUP BY win),
sizes AS (SELECT DISTINCT len(win) AS n FROM wins),
doc_win AS (SELECT doc_id, i, n, w[i:i + n - 1] AS win FROM d, sizes, unnest(range(1, len(w) - n + 2)) r(i)),
hit AS (SELECT doc_id, i, n, items FROM doc_win JOIN wins USING (win)),
words_hit AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hit, unnest(range(0, n)) v(o) GROUP BY doc_id),
ids AS (SELECT DISTINCT doc_id, CAST(id AS VARCHAR) AS id FROM hit, unnest(items) u(id)),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS names FROM ids GROUP BY doc_id),
post AS (SELECT doc_id, i - 1 AS pos, w[i] AS term FROM d, unnest(range(1, len(w) + 1)) r(i)
         WHERE w[i] IN (SELECT unnest(win) FROM wins)),
freq AS (SELECT term, count(*) AS n FROM post GROUP BY term),
first_at AS (SELECT win, items, win[i] AS term, min(i) - 1 AS off FROM wins, unnest(range(1, len(win) + 1)) r(i)
             GROUP BY win, items, win[i]),
ranked AS (SELECT f.*, row_number() OVER (PARTITION BY win ORDER BY n, f.term, off) AS rank,
                  count(*) OVER (PARTITION BY win) AS terms, count(n) OVER (PARTITION BY win) AS known
           FROM first_at f LEFT JOIN freq ON f.term = freq.term),
places AS (SELECT doc_id, win, items, rank, terms, pos - off AS start FROM ranked JOIN post USING (term)
           WHERE rank <= 2 AND known = terms),
met AS (SELECT DISTINCT x.doc_id, x.win, x.items, x.start FROM places x
        LEFT JOIN places y ON x.doc_id = y.doc_id AND x.win = y.win AND y.rank = 2 AND abs(x.start - y.start) <= 2
        WHERE x.rank = 1 AND (x.terms = 1 OR y.doc_id IS NOT NULL)),
near AS (SELECT DISTINCT met.doc_id, CAST(id AS VARCHAR) AS id
         FROM met JOIN d ON met.doc_id = d.doc_id, unnest(items) u(id)
         WHERE NOT (start >= 0 AND w[greatest(start, 0) + 1:greatest(start, 0) + len(win)] = win)
           AND list_has_all(w[greatest(start - 1, 1):start + len(win) + 2], win)),
n_near AS (SELECT near.doc_id, count(*) AS n FROM near LEFT JOIN ids ON near.doc_id = ids.doc_id AND near.id = ids.id
           WHERE ids.id IS NULL GROUP BY near.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       CAST(coalesce(n_near.n, 0) AS BIGINT) AS n_near,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words_hit ON d.doc_id = words_hit.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
       LEFT JOIN n_near ON d.doc_id = n_near.doc_id"""


def url_filter(rules: list[tuple[str, str]], margin: float = 2.0, damping: float = 0.85, rounds: int = 16) -> str:
    """The URL query: each round of the propagation is a table of its own."""
    listed = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in rules)
    steps = "".join(f""",
moved{k} AS MATERIALIZED (
  SELECT kind, dst AS host, sum({damping}::DOUBLE * rank * share) AS rank
  FROM rank{k} JOIN arcs USING (kind, host) GROUP BY kind, dst),
rank{k + 1} AS MATERIALIZED (
  SELECT kind, host, sum(rank) AS rank FROM (
    SELECT kind, host, rank FROM moved{k}
    UNION ALL
    SELECT s.kind, s.host, coalesce(back, 1.0) * s.rank FROM rank0 s
    LEFT JOIN (SELECT kind, 1 - sum(rank) AS back FROM moved{k} GROUP BY kind) l ON s.kind = l.kind) u
  GROUP BY kind, host)""" for k in range(rounds))
    return rf"""
WITH cut AS (SELECT page_id, html, CASE WHEN instr(coalesce(url, ''), '://') > 0
                    THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
r AS (SELECT verdict, rule, split_part(rule, '/', 1) AS domain, substr(rule, instr(rule, '/')) AS start
      FROM (VALUES {listed}) v(verdict, rule)),
fit AS (SELECT page_id, rule, verdict FROM p JOIN r
        ON (host = domain OR ends_with(host, '.' || domain)) AND starts_with(path, start)
        QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule DESC, verdict DESC) = 1),
judged AS MATERIALIZED (SELECT p.page_id, host, path, html, rule, verdict FROM p LEFT JOIN fit ON p.page_id = fit.page_id),
own AS (SELECT host, count(*) AS n FROM p WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, translate(dst, '{_UPPER}', '{_LOWER}') AS dst FROM p,
          unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1)) u(dst)
          WHERE host <> ''),
site AS (SELECT a.host AS low, b.host AS up, a.n FROM own a
         JOIN own b ON b.host = substr(a.host, instr(a.host, '.') + 1) AND a.host <> b.host),
edge AS (SELECT src, dst, CAST(sum(n) AS DOUBLE) AS weight FROM (
           SELECT src, dst, 1 AS n FROM links WHERE src <> dst
           UNION ALL SELECT low, up, n FROM site UNION ALL SELECT up, low, n FROM site) e GROUP BY src, dst),
both_ways AS (SELECT 'trust' AS kind, src AS host, dst, weight FROM edge
              UNION ALL SELECT 'distrust', dst, src, weight FROM edge),
arcs AS MATERIALIZED (SELECT kind, host, dst, weight / sum(weight) OVER (PARTITION BY kind, host) AS share FROM both_ways),
seeds AS (SELECT CASE verdict WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, CAST(count(*) AS DOUBLE) AS mass
          FROM judged WHERE verdict IS NOT NULL GROUP BY 1, 2),
rank0 AS MATERIALIZED (SELECT kind, host, mass / sum(mass) OVER (PARTITION BY kind) AS rank FROM seeds){steps},
known AS (SELECT host, coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0.0::DOUBLE) AS trust,
                 coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0.0::DOUBLE) AS distrust
          FROM rank{rounds} GROUP BY host)
SELECT page_id, judged.host, path, rule,
       coalesce(verdict, CASE WHEN distrust > {margin}::DOUBLE * trust THEN 'block' ELSE 'allow' END) AS verdict,
       round(coalesce(trust, 0.0::DOUBLE), 9) AS trust, round(coalesce(distrust, 0.0::DOUBLE), 9) AS distrust
FROM judged LEFT JOIN known ON judged.host = known.host"""


def chat(control: str) -> str:
    """The chat query: turns in order, and the length of their text form."""
    return rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '{control}'), (-1, 1, 'assistant', '{control}')),
f AS (SELECT *, 12 + length(replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '|', '%7C')) + 1
                + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 11 AS n FROM t),
c AS (SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss,
             sum(n) AS n FROM f GROUP BY conv_id)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256,
       CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM c"""


# crc32 by its table; near words share a form with one code point deleted or left open
SPELLING = rf"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END,
                                               CAST(b AS BIGINT)) ORDER BY b) AS t FROM range(256) r(b)),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
      FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run),
x AS (SELECT run, n, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS bytes FROM d),
h AS (SELECT run, n, xor(4294967295, list_reduce(
        [CAST('0x' || substr(bytes, 2 * k - 1, 2) AS BIGINT) FOR k IN range(1, length(bytes) // 2 + 1)],
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295)) AS h FROM x, crc),
m AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM m GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
gap AS MATERIALIZED (SELECT DISTINCT word, n, substr(word, 1, i - 1) || mark || substr(word, i + 1) AS k, mark
                     FROM v, unnest(range(1, length(word) + 1)) u(i), (VALUES (''), ('*')) o(mark)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gap a JOIN gap b ON a.k = b.k AND a.word <> b.word AND a.mark = '*' AND b.mark = '*'
         UNION SELECT a.word, a.n, b.word, b.n FROM v a JOIN gap b ON a.word = b.k AND b.mark = ''
         UNION SELECT b.word, b.n, a.word, a.n FROM v a JOIN gap b ON a.word = b.k AND b.mark = ''),
best AS (SELECT word, count(*) AS n_near, max(n) AS n, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
         FROM near GROUP BY word),
f AS MATERIALIZED (SELECT word, form, form_n FROM best WHERE form_n >= 2 * n),
chain AS (SELECT word, word AS root FROM v UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON chain.root = f.word)
SELECT v.word, f.form, chain.root, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM v LEFT JOIN best ON v.word = best.word LEFT JOIN f ON v.word = f.word
       JOIN chain ON v.word = chain.word LEFT JOIN f more ON chain.root = more.word WHERE more.word IS NULL"""

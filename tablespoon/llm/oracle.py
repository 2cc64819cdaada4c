"""DuckDB statements of the operators that SQL can express; they count on the stated definitions alone."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

LINE_CLEANING = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS body, {_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM doc WHERE len(words) >= 8)),
again AS (SELECT doc_id, w FROM win GROUP BY ALL HAVING count(*) > 1),
hit AS (
  SELECT doc_id, count(*) AS n
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS place FROM win JOIN again USING (doc_id, w)) GROUP BY ALL),
line AS (
  SELECT doc_id, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, unnest(lines) AS l FROM doc)),
stutter AS (
  SELECT doc_id, l, bool_or(same) AS stuck FROM (
    SELECT doc_id, l, len(list_distinct(w[i : i + 4])) = 1 AS same
    FROM (SELECT doc_id, l, w, unnest(range(1, len(w) - 3)) AS i
          FROM (SELECT DISTINCT doc_id, l, list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
                FROM line WHERE n >= 5))) GROUP BY ALL),
judged AS (
  SELECT line.*,
    len(regexp_extract_all(l, '[#*$%&|<>]')) * 100 > length(l) * 10
    OR (n < 5 AND NOT regexp_matches(l, '[.!?:;\x{{2026}}"''\x{{201D}}\x{{2019}}\x{{BB}})\]][\x20\x09-\x0D]*$'))
    OR (n >= 5 AND upper(l) = l AND lower(l) <> l)
    OR (n > 5 AND 4 * len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'),
          lambda x: x IN ('|', chr(187), chr(8250), '>', chr(183), chr(8226)))) >= n)
    OR regexp_matches(lower(l), '^\W*(home|menu|search|login|log in|sign in|sign up|next|previous|back to top|read more|share|share this|contact us|about us|site map|sitemap|skip to content)\W*$')
    OR regexp_matches(lower(l), 'cookie policy|uses cookies|accept cookies|privacy policy|terms of use|terms of service|all rights reserved|enable javascript|lorem ipsum|subscribe to our newsletter|click here to')
    OR coalesce(stuck, false) AS fails
  FROM line LEFT JOIN stutter USING (doc_id, l)),
lost AS (
  SELECT doc_id, count(*) FILTER (fails) AS bad, coalesce(sum(n) FILTER (fails), 0) AS n FROM judged GROUP BY ALL),
base AS (
  SELECT doc.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(hit.n, 0) AS n_repeat_words, coalesce(lost.bad, 0) AS n_bad_lines, coalesce(lost.n, 0) AS n_words_lost
  FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       CAST(n_bad_lines AS BIGINT) AS n_bad_lines, CAST(n_words_lost AS BIGINT) AS n_words_lost,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words_lost * 100 <= n_words * 50 AS kept
FROM base
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
bw AS (
  SELECT item, least(len(words), 13) AS k, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i, words FROM b WHERE len(words) > 0),
win AS (SELECT DISTINCT item, i, k, array_to_string(words[i : i + k - 1], ' ') AS w FROM bw),
dw AS (
  SELECT doc_id, p, k, array_to_string(words[p : p + k - 1], ' ') AS w
  FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM win) WHERE len(words) >= k)),
hits AS (SELECT doc_id, p, k, item, i FROM dw JOIN win USING (k, w)),
covered AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS x FROM hits) GROUP BY ALL),
runs AS (
  SELECT doc_id, item, p - i AS diagonal, k, p, p - row_number() OVER (PARTITION BY doc_id, item, p - i, k ORDER BY p) AS run FROM hits),
longest AS (
  SELECT doc_id, max(n) AS n FROM (SELECT doc_id, count(*) + k - 1 AS n FROM runs GROUP BY doc_id, item, diagonal, k, run) GROUP BY ALL),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY ALL)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(words) AS contaminated,
       CAST(coalesce(longest.n, 0) AS BIGINT) AS longest_match
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

COLLOCATIONS = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS words FROM piece),
total AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
freq AS (
  SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, k, words, unnest(range(1, len(words) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS v(k)
        WHERE len(words) >= k)
  GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM freq WHERE k > 1),
cut AS (
  SELECT c.lang, c.phrase, c.f AS a, c.j, l.f AS l, r.f AS r,
         CAST(CAST(c.f AS HUGEINT) * 2000000 // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN freq l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : c.j], ' ')
  JOIN freq r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.j + 1 : c.k], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS rn FROM cut) WHERE rn = 1),
inside AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(f) AS most
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand)) GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE 100 * coalesce(most, 0) < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000
"""


def url_verdicts(rules, blocked_hosts, blocked_names) -> str:
    values = [f"('{text}', '{verdict}', 1)" for text, verdict in rules] + [f"('{h}/', 'block', 0)" for h in blocked_hosts]
    return rf"""
WITH part AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '(?s)^[^?#]*') ELSE '' END AS rest
  FROM pages),
page AS (
  SELECT page_id, translate(regexp_extract(rest, '(?s)^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(regexp_extract(rest, '(?s)^[^/]*')) + 1) AS path FROM part),
named AS (SELECT DISTINCT regexp_extract(host, '(?s)^(?:.*\.)?((?:{'|'.join(blocked_names)})\..+)$', 1) AS h FROM page),
entry AS (
  SELECT entry, verdict, is_rule, string_split(entry, '/')[1] AS h, substr(entry, instr(entry, '/')) AS p
  FROM (SELECT * FROM (VALUES {', '.join(values)}) AS v(entry, verdict, is_rule)
        UNION SELECT h || '/', 'block', 0 FROM named WHERE h <> '')),
best AS (
  SELECT page_id, arg_max(struct_pack(e := entry, v := verdict, r := is_rule), is_rule * 10000000 + length(entry)) AS b
  FROM page JOIN entry ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, CASE WHEN b.r = 1 THEN b.e END AS rule, coalesce(b.v, 'allow') AS verdict, b.e AS entry
FROM page LEFT JOIN best USING (page_id)
"""


def license_scan(templates, cue: str, word: str, least_cosine: float, file_share: float) -> str:
    values = ", ".join(f"('{name}', '{body}')" for name, body in templates)
    n = len(templates)
    return rf"""
WITH f AS (
  SELECT doc_id, text, coalesce(source, '-') || '/' || coalesce(lang, '-') || '/'
         || regexp_replace(substr(d, 1, length(d) - 1), '(.)', '\1/', 'g') || d AS path
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS d FROM documents)),
cue AS (
  SELECT * FROM (SELECT path, unnest(string_split(coalesce(text, ''), chr(10))) AS body FROM f)
  WHERE regexp_matches(lower(body), '{cue}')),
tt AS (
  SELECT licence, term, count(*) AS n FROM (
    SELECT licence, unnest(regexp_extract_all(body, '{word}')) AS term FROM (VALUES {values}) AS t(licence, body)) GROUP BY ALL),
idf AS (SELECT term, ln(1 + {n}.0 / count(*)) AS idf FROM tt GROUP BY term),
tw AS (SELECT licence, term, n * idf AS w FROM tt JOIN idf USING (term)),
share AS (
  SELECT licence, term, w / norm AS s FROM tw JOIN (SELECT licence, sqrt(sum(w * w)) AS norm FROM tw GROUP BY 1) USING (licence)),
terms AS (
  SELECT body, term, count(*) AS tf FROM (
    SELECT body, unnest(regexp_extract_all(lower(body), '{word}')) AS term FROM (SELECT DISTINCT body FROM cue)) GROUP BY ALL),
lw AS (SELECT body, term, tf * coalesce(idf, ln(1 + {n}.0)) AS w FROM terms LEFT JOIN idf USING (term)),
norm AS (SELECT body, sqrt(CAST(sum(CAST(w * w AS DECIMAL(38,12))) AS DOUBLE)) AS norm FROM lw GROUP BY 1),
cosine AS (
  SELECT body, licence, round(CAST(sum(CAST(w * s AS DECIMAL(38,12))) AS DOUBLE) / norm, 6) AS cosine
  FROM lw JOIN share USING (term) JOIN norm USING (body) GROUP BY body, licence, norm),
best AS (
  SELECT body, licence, cosine FROM (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY cosine DESC, licence) AS rn FROM cosine WHERE cosine >= {least_cosine})
  WHERE rn = 1),
own AS (
  SELECT path, licence, cosine, licence_words FROM (
    SELECT path, licence, cosine, row_number() OVER (PARTITION BY path ORDER BY cosine DESC, licence) AS rn,
           sum(len(regexp_extract_all(lower(body), '{word}'))) OVER (PARTITION BY path) AS licence_words
    FROM cue JOIN best USING (body)) WHERE rn = 1),
dir AS (
  SELECT directory, licence, cosine, path FROM (
    SELECT *, row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, path) AS rn FROM (
      SELECT own.*, regexp_extract(path, '^(.*)/[^/]*$', 1) AS directory
      FROM own JOIN (SELECT path, sum(len(regexp_extract_all(lower(coalesce(text, '')), '{word}'))) AS words FROM f GROUP BY 1) USING (path)
      WHERE licence_words >= words * {file_share})) WHERE rn = 1),
near AS (
  SELECT path, licence, cosine, origin_path FROM (
    SELECT f.path, dir.licence, dir.cosine, dir.path AS origin_path,
           row_number() OVER (PARTITION BY f.path ORDER BY length(directory) DESC) AS rn
    FROM f JOIN dir ON directory = '' OR starts_with(f.path, directory || '/')
    WHERE f.path NOT IN (SELECT path FROM own)) WHERE rn = 1)
SELECT doc_id, f.path, coalesce(own.licence, near.licence) AS licence, coalesce(own.cosine, near.cosine) AS cosine,
       CASE WHEN own.path IS NOT NULL THEN 'own' WHEN near.path IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       coalesce(own.path, near.origin_path) AS source_path
FROM f LEFT JOIN own ON f.path = own.path LEFT JOIN near ON f.path = near.path
"""

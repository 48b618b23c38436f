"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from wordloom.llm import line_dedup as site
from wordloom.llm import quality_rules as rules
from wordloom.llm.decontaminate import SLOP, TOLERANT

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

DECONTAMINATION = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {ALNUM_WORDS} AS words FROM documents),
b AS (SELECT item_id, {ALNUM_WORDS} AS words FROM benchmark),
w AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(words), 10) AS l, array_to_string(words[s:s + least(len(words), 10) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM b WHERE len(words) > 0)
),
grams AS (
  SELECT doc_id, l, s, array_to_string(words[s:s + l - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, l, unnest(range(1, len(words) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM w) WHERE len(words) >= l)
),
m AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, s, l FROM grams JOIN w USING (l, phrase)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM m) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id
),
tok AS MATERIALIZED (SELECT r, doc_id, unnest(words) AS term, generate_subscripts(words, 1) AS pos FROM d),
t AS MATERIALIZED (
  SELECT phrase, term, row_number() OVER (PARTITION BY phrase ORDER BY coalesce(n, 0), term) AS rank,
         count(*) OVER (PARTITION BY phrase) AS terms
  FROM (SELECT DISTINCT phrase, unnest(string_split(phrase, ' ')) AS term FROM w)
  LEFT JOIN (SELECT term, count(*) AS n FROM tok GROUP BY term) USING (term)
),
place AS (
  SELECT phrase, terms, r, doc_id, pos FROM tok JOIN t USING (term)
  WHERE doc_id IS NOT NULL AND rank <= CASE WHEN terms >= {TOLERANT} THEN 2 ELSE 1 END
),
around AS (SELECT phrase, terms, r, doc_id, pos AS middle, unnest(range(pos - {SLOP}, pos + {SLOP} + 1)) AS pos FROM place),
near AS (
  SELECT DISTINCT doc_id, phrase FROM (
    SELECT around.doc_id, phrase, around.terms, middle, count(DISTINCT term) AS met
    FROM around JOIN tok USING (r, pos) JOIN t USING (phrase, term) GROUP BY ALL
  ) WHERE met >= CASE WHEN terms >= {TOLERANT} THEN terms - 1 ELSE terms END
),
near_items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS close
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM near JOIN w USING (phrase)) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated,
       coalesce(near_items.n, 0)::BIGINT AS n_near, coalesce(close, '') AS near_items
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near_items USING (doc_id)
"""

_STOP = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
_KEPT = " AND ".join(f"{r.measure} BETWEEN {r.low!r} AND {r.high!r}" for r in rules.RULES)

QUALITY_RULES = rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS body, {SPACE_WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos, len(words) AS n FROM d),
grams AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS times
  FROM (SELECT doc_id, pos, array_to_string(words[pos:pos + 7], ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS pos FROM d WHERE len(words) >= 8))
),
again AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS p FROM grams WHERE times > 1) GROUP BY doc_id
),
c AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(again.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines,
         len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
         len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter,
         len(list_filter(words, lambda x: length(x) > 2 AND x = upper(x) AND x <> lower(x))) AS n_shouted,
         len(list_filter(lines, lambda x: regexp_matches(x, '^ *[-*•]'))) AS n_bullet,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS n_ellipsis
  FROM d LEFT JOIN again USING (doc_id)
),
r AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbols_per_word,
         CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0.0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_ratio,
         CASE WHEN n_lines > 0 THEN n_bullet / n_lines ELSE 0.0 END AS bullet_line_ratio,
         CASE WHEN n_lines > 0 THEN n_ellipsis / n_lines ELSE 0.0 END AS ellipsis_line_ratio,
         CASE WHEN n_words > 0 THEN n_letter / n_words ELSE 0.0 END AS letter_word_ratio,
         CASE WHEN n_words > 0 THEN n_shouted / n_words ELSE 0.0 END AS shouted_word_ratio,
         n_words < {rules.BASE_WORDS} OR 100 * n_repeat_words > {rules.REPEAT_PERCENT} * n_words AS base_failed
  FROM c
)
SELECT *, NOT base_failed AND {_KEPT} AS kept FROM r
"""

# Digests stand for the units; offsets are counted from 0.  Places order by start, lines before paragraphs.
_BREAK = r"'\n[ \t\r]*\n[ \t\r\n]*'"

SUBSTRING_DEDUP = rf"""
WITH t AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL),
l AS MATERIALIZED (
  SELECT doc_id, line, i, start::BIGINT AS start, (start + length(line))::BIGINT AS stop,
         array_to_string(regexp_extract_all({LOWER.replace("text", "line")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), ' ') AS words
  FROM (
    SELECT doc_id, line, i, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(line) - 1 AS start
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM t)
  )
),
b AS (
  SELECT doc_id, part, i, start::BIGINT AS start, (start + length(part))::BIGINT AS stop
  FROM (
    SELECT *, sum(length(part) + length(gap)) OVER (PARTITION BY doc_id ORDER BY i) - length(part) - length(gap) AS start
    FROM (
      SELECT doc_id, unnest(parts) AS part, unnest(list_append(gaps, '')) AS gap, generate_subscripts(parts, 1) AS i
      FROM (SELECT doc_id, regexp_split_to_array(text, {_BREAK}) AS parts, regexp_extract_all(text, {_BREAK}) AS gaps FROM t)
    )
  )
),
p AS (
  SELECT b.doc_id, b.start, b.stop, string_agg(l.words, ' ' ORDER BY l.start) AS words
  FROM b JOIN l ON l.doc_id = b.doc_id AND l.start < b.stop AND l.stop > b.start
  WHERE l.words <> '' GROUP BY b.doc_id, b.start, b.stop HAVING count(*) > 1
),
u AS (
  SELECT doc_id, start, stop, words, 2 * start AS place FROM l WHERE words <> ''
  UNION ALL SELECT doc_id, start, stop, words, 2 * start + 1 FROM p
),
again AS MATERIALIZED (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, place) > 1),
m AS (
  SELECT *, max(i) OVER (PARTITION BY doc_id) AS last,
         EXISTS (SELECT 1 FROM again a WHERE a.doc_id = l.doc_id AND a.start < l.stop AND l.start < a.stop AND l.start < l.stop) AS gone
  FROM l
),
g AS (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(start || ':' || stop, ',' ORDER BY start) FILTER (gone), '') AS removed,
         coalesce(string_agg(start || ':' || stop, ',' ORDER BY start) FILTER (NOT gone), '') AS kept,
         coalesce(string_agg(line || CASE WHEN i < last THEN chr(10) ELSE '' END, '' ORDER BY start) FILTER (NOT gone), '') AS text
  FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed,
       coalesce(kept, '') AS kept, g.text
FROM documents d LEFT JOIN g USING (doc_id)
"""

JACCARD_JOIN = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(array_to_string(words[i:i + 2], ' ')) AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM d WHERE len(words) > 0)
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b USING (gram) JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id AND 100 * least(na.n, nb.n) >= 90 * greatest(na.n, nb.n)
  GROUP BY a.doc_id, b.doc_id
),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 90 * (na.n + nb.n - shared)
),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node WHERE r.root < l.b
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.root AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) r ON r.node = d.doc_id
"""

LINE_DEDUP = rf"""
WITH l AS MATERIALIZED (
  SELECT doc_id, source, line, trim(line, E' \t\n\v\f\r') AS body, i
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
),
pages AS (
  SELECT source, count(*) AS pages, count(DISTINCT coalesce(text, '')) > 1 AS differ FROM documents WHERE source IS NOT NULL GROUP BY source
),
bad AS (
  SELECT source, body FROM (SELECT source, body, count(DISTINCT doc_id) AS n FROM l WHERE body <> '' GROUP BY source, body) JOIN pages USING (source)
  WHERE n > {site.RATIO!r}::DOUBLE * pages
    AND (n >= {site.MIN_PAGES} OR pages < {site.MIN_PAGES} AND n = pages AND n >= 2 AND differ)
),
g AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad.body IS NOT NULL) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (bad.body IS NULL), '') AS text
  FROM l LEFT JOIN bad USING (source, body) GROUP BY doc_id
)
SELECT d.doc_id, d.source, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, g.text
FROM documents d LEFT JOIN g USING (doc_id)
"""

COLLOCATIONS = rf"""
WITH t AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(body, '[^\x20\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS body FROM documents)
),
total AS (SELECT lang, sum(len(words))::BIGINT AS n FROM t GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(words[s:s + k - 1], ' ') AS phrase
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS s FROM t, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k)
),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100),
cand AS (SELECT lang, k, phrase, f AS a FROM f WHERE k > 1),
kept AS (
  SELECT * FROM cand x WHERE NOT EXISTS (
    SELECT 1 FROM cand y WHERE y.lang = x.lang AND y.k > x.k AND 100 * y.a >= 100 * x.a AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))
),
cuts AS (
  SELECT lang, phrase, a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS left_part, array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS right_part
  FROM (SELECT *, unnest(range(1, k)) AS c FROM kept)
),
scored AS (
  SELECT x.lang, x.phrase, a, c, p.f AS l, q.f AS r, n, ((1000::HUGEINT * a * n) // (p.f::HUGEINT * q.f))::BIGINT AS score
  FROM cuts x JOIN f p ON p.lang = x.lang AND p.phrase = left_part JOIN f q ON q.lang = x.lang AND q.phrase = right_part JOIN total ON total.lang = x.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

ORACLES = {
    "op1_decontamination": DECONTAMINATION,
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op5_jaccard_join": JACCARD_JOIN,
    "op7_line_dedup": LINE_DEDUP,
    "op9_quality_rules": QUALITY_RULES,
    "op11_collocations": COLLOCATIONS,
}

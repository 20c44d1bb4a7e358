"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from corpusloom.llm.quality import CLASSES, SYMBOLS, Divergence
from corpusloom.llm.registry import ORACLES

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op10_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWERED)} AS w FROM documents
), s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (SELECT doc_id, doc_id AS r FROM s UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.r)
SELECT s.doc_id, len(s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""

SAFE = r"replace(replace(replace({0}, '\', '\\'), '###', '\h'), '</turn>', '\t')"
TRAP = r"'\### Assistant: </turn> ok'"

ORACLES["op9_prefix_tree"] = f"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {TRAP} UNION ALL SELECT -7, 1, 'assistant', {TRAP})
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || replace({SAFE.format('role')}, ':', '\\c') || ': ' || {SAFE.format('text')} || ' </turn>' || chr(10)))::BIGINT
    AS formatted_chars
FROM said GROUP BY conv_id"""

HOW = Divergence()


def pattern_count(pattern: str) -> str:
    return f"len(regexp_extract_all(text, '{pattern.replace(chr(39), chr(39) * 2)}'))"


def js(p: str, q: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    x, y = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"

    def term(a: str) -> str:
        return f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({x} + {y}) / 2)) ELSE 0 END"

    total = f"list_sum(list_transform(range(1, len({p}) + 1), lambda i: ({term(x)} + {term(y)}) / 2))"
    return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest({total}, 0)) END"


ORACLES["op5_distribution_divergence"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '(none)') AS lang FROM documents
), w AS (SELECT *, {WORDS.format('text')} AS w FROM d
), top AS (SELECT lang, list(word ORDER BY n DESC, word) AS common FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM (
      SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(w) AS word FROM w) GROUP BY lang, word))
  WHERE place <= {HOW.common} GROUP BY lang
), runs AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w))
), rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM runs, (VALUES (0), (1), (2)) t(k) WHERE n > 1 GROUP BY doc_id
), m AS (SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    {pattern_count(SYMBOLS)}::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    [{', '.join(pattern_count(c) for c in CLASSES.values())}] AS classes,
    list_transform(coalesce(common, []), lambda c: len(list_filter(w, lambda x: x = c))) AS hits
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM w)
  LEFT JOIN top USING (lang) LEFT JOIN rep USING (doc_id)
), f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    list_prepend(word_chars - list_sum(classes), classes) AS chars, list_append(hits, n_words - coalesce(list_sum(hits), 0)) AS common FROM m
), ref AS (SELECT lang, list(c ORDER BY i) AS all_chars FROM (SELECT lang, i, sum(chars[i]) AS c FROM f, range(1, {len(CLASSES) + 2}) r(i)
    WHERE NOT base_failed GROUP BY ALL) GROUP BY lang
), wref AS (SELECT lang, list(c ORDER BY i) AS all_common FROM (SELECT lang, i, sum(common[i]) AS c FROM f, range(1, {HOW.common + 2}) r(i)
    WHERE NOT base_failed AND i <= len(common) GROUP BY ALL) GROUP BY lang
), j AS (SELECT *, {js('chars', 'all_chars')} AS cd, {js('common', 'all_common')} AS wd FROM f LEFT JOIN ref USING (lang) LEFT JOIN wref USING (lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(word_chars >= {HOW.min_chars} AND cd > {HOW.max_chars_distance}, false)
    OR coalesce(n_words >= {HOW.min_words} AND wd > {HOW.max_words_distance}, false)) AS kept FROM j"""

LETTER_TERMS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
SHARE = "1 + (1000000000::HUGEINT * ({0} + 5)) // ({1} + 5 * v)"

ORACLES["op12_divergence_audit"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {LETTER_TERMS} AS w FROM documents
), t AS (SELECT r, lang, source, unnest(w) AS term FROM d
), kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), g AS (SELECT DISTINCT lang, source FROM d
), c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, {SHARE.format('coalesce(n, 0)', 'total')} AS p
  FROM g JOIN kept USING (lang) JOIN v USING (lang) JOIN totals USING (lang, source) LEFT JOIN c USING (lang, source, term)
), q AS (SELECT lang, term, {SHARE.format('n', 'total')} AS q FROM (SELECT lang, term, sum(n) AS n FROM p GROUP BY ALL)
  JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) JOIN v USING (lang)
), found AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
WHERE part = 'pair' OR rank <= 50"""

WORD_TERMS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op13_best_position"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORD_TERMS} AS w FROM documents
), s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0
), t AS (SELECT r, doc_id, term, count(*) AS tf, any_value(m) AS m FROM (
    SELECT r, doc_id, 50 + (50 * len(w) * n_docs) // n_words AS m, unnest(w) AS term FROM d, s WHERE len(w) > 0) GROUP BY ALL
), i AS (SELECT DISTINCT item_id, unnest({WORD_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL
), wt AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM t, s GROUP BY term
), scored AS (SELECT item_id, doc_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN wt USING (term) WHERE doc_id IS NOT NULL GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 50"""

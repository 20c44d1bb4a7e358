"""SQL shared by the equivalents of several queries."""

from corpusloom.functions.words import ENGLISH_WORDS

ENGLISH = ", ".join(f"'{w}'" for w in ENGLISH_WORDS)

STRIPPED = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
COLLAPSED = r"regexp_replace(regexp_replace({0}, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')"
WORDS = r"regexp_extract_all({0}, '\S+')"

CLEANED = f"""
cleaned AS (
  SELECT doc_id, lang, source,
         {COLLAPSED.format("regexp_replace(text, '<[^>]+>', '', 'g')")} AS content
  FROM documents
  WHERE length({STRIPPED.format('text')}) >= 50
)"""

UNIQUE = """
uniq AS (
  SELECT c.* FROM cleaned c
  JOIN (SELECT min(doc_id) AS doc_id FROM cleaned GROUP BY md5(content)) f USING (doc_id)
)"""

SCORED = f"""
counted AS (
  SELECT *, {WORDS.format('content')} AS ws,
         length(regexp_replace(content, '[^.!?]', '', 'g')) AS stops
  FROM {{src}}
), parts AS (
  SELECT *,
    CASE WHEN len(ws) = 0 THEN 0.0::DOUBLE ELSE least(
      len(list_filter(ws, lambda w: lower(w) IN ({ENGLISH})))::DOUBLE / len(ws)::DOUBLE * 4,
      1.0::DOUBLE) END AS english,
    CASE WHEN length(content) < 100 THEN 0.3::DOUBLE WHEN length(content) < 500
         THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END AS relevance,
    CASE WHEN stops = 0 OR len(ws) = 0 THEN 0.0::DOUBLE
         WHEN len(ws)::DOUBLE / stops BETWEEN 10 AND 25 THEN 1.0::DOUBLE
         WHEN len(ws)::DOUBLE / stops >= 5 AND len(ws)::DOUBLE / stops <= 40 THEN 0.7::DOUBLE
         ELSE 0.4::DOUBLE END AS readability
  FROM counted
), scored AS (
  SELECT * EXCLUDE (ws, stops), (english + relevance + readability) / 3 AS quality_score FROM parts
)"""

CHUNKED = r"""
walk AS (
  SELECT doc_id, content, length(content) AS n, 0::BIGINT AS step, 0::BIGINT AS start,
         least({max}, length(content))::BIGINT AS stop,
         CASE WHEN length(content) <= {max} THEN 1 ELSE 0 END AS single
  FROM {src} WHERE length(content) >= 100 AND length(content) <= {max}
  UNION ALL
  SELECT doc_id, content, length(content), 0, 0,
         CASE WHEN instr(reverse(substring(content, {max} - {tail} + 2, {tail} - 1)), '.') > 0
              THEN {max} - instr(reverse(substring(content, {max} - {tail} + 2, {tail} - 1)), '.') + 1
              ELSE {max} END, 0
  FROM {src} WHERE length(content) > {max}
  UNION ALL
  SELECT doc_id, content, n, step + 1, stop - {overlap},
         CASE WHEN stop - {overlap} + {max} < n
               AND instr(reverse(substring(content, stop - {overlap} + {max} - {tail} + 2, {tail} - 1)), '.') > 0
              THEN stop - {overlap} + {max}
                   - instr(reverse(substring(content, stop - {overlap} + {max} - {tail} + 2, {tail} - 1)), '.') + 1
              ELSE stop - {overlap} + {max} END, 0
  FROM walk WHERE single = 0 AND stop - {overlap} < n
), pieces AS (
  SELECT doc_id, content AS whole, step,
         CASE WHEN single = 1 THEN content
              ELSE regexp_replace(substring(content, start + 1, stop - start), '^\s+|\s+$', '', 'g') END AS piece
  FROM walk
), chunks AS (
  SELECT doc_id, whole, piece AS content,
         row_number() OVER (PARTITION BY doc_id ORDER BY step) - 1 AS chunk_index,
         count(*) OVER (PARTITION BY doc_id) AS total_chunks
  FROM pieces WHERE piece <> ''
)"""


def chunked(src: str, size: int = 2048, overlap: int = 64) -> str:
    return CHUNKED.format(src=src, max=size, tail=int(size * 0.2), overlap=overlap)


# A page's main text: its articles, tags replaced by blanks, entities decoded.
UNESCAPED = (
    "regexp_replace(replace(replace(replace({0}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'),"
    r" '&amp;|&amp\b', '&', 'g')"
)
ARTICLE = r"regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<[^>]+>', ' ', 'g')"
TIDIED = (
    "regexp_replace(regexp_replace("
    + COLLAPSED
    + r", '[.]{{3,}}', '...', 'g'), '[-]{{3,}}', '---', 'g')"
)
PAGE_CONTENT = f"""
page_content AS (
  SELECT page_id, url, html, {TIDIED.format(UNESCAPED.format(ARTICLE))} AS content,
         {STRIPPED.format(UNESCAPED.format(r"regexp_extract(html, '<title>(.*?)</title>', 1, 's')"))} AS title,
         regexp_extract(html, '<html lang="([^"]*)"', 1) AS language,
         regexp_extract(url, '//([^/?#]*)', 1) AS host
  FROM pages
), valid_pages AS (
  SELECT * FROM page_content
  WHERE length(content) BETWEEN 100 AND 1000000
    AND len(list_filter({WORDS.format('content')}, lambda w: regexp_full_match(w, '\\p{{L}}+'))) >= 10
)"""

TURN_PAIRS = """
turn_pairs AS (
  SELECT q.conv_id, q.turn, q.conv_id * 100000 + q.turn AS id, q.text AS question, a.text AS answer
  FROM conversations q JOIN conversations a
    ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
  WHERE q.role = 'user'
)"""

# Model a repeats the question, model b the question and the answer.
PAIRS = TURN_PAIRS + """, pairs AS (
  SELECT id, 'a' AS model, question AS prediction, answer AS reference FROM turn_pairs
  UNION ALL
  SELECT id, 'b', question || ' ' || answer, answer FROM turn_pairs
)"""

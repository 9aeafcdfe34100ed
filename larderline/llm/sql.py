"""What the queries have to return, as SQL for another engine."""

from __future__ import annotations

BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _judged(documents: str) -> str:
    """CTEs up to ``judged``: measures, failures and verdicts of the documents."""
    return f"""
w AS (
  SELECT *, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM {documents}
),
tokens AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
grams AS (
  SELECT doc_id, pos, concat_ws(' ', word, lead(word, 1) OVER following,
    lead(word, 2) OVER following, lead(word, 3) OVER following, lead(word, 4) OVER following)
    AS gram, lead(word, 4) OVER following IS NOT NULL AS whole
  FROM tokens WINDOW following AS (PARTITION BY doc_id ORDER BY pos)
),
repeats AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS found FROM grams WHERE whole
),
covered AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n
  FROM (SELECT doc_id, pos, unnest(range(5)) AS k FROM repeats WHERE found > 1)
  GROUP BY doc_id
),
full_lines AS (
  SELECT doc_id, line
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
  WHERE trim(line, {BLANKS}) <> ''
),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id),
measured AS (
  SELECT w.doc_id, w.source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(translate(t, {BLANKS}, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dups.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    length(t) - length(translate(t, chr(10), '')) + 1 AS n_lines
  FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id)
),
failing AS (
  SELECT *,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
      + (100 * n_symbols > 10 * n_words)::INT + (100 * n_dup_lines > 30 * n_lines)::INT
      AS minor_failures
  FROM measured
),
hosts AS (
  SELECT source, count(*)::DOUBLE AS n,
    sum((base_failed OR minor_failures > 0)::INT)::DOUBLE AS x
  FROM failing GROUP BY source
),
totals AS (
  SELECT sum(n) AS n, sum(x) / sum(n) AS mean, sum(x * x / n) AS xx, sum(n * n) AS nn,
    count(*) AS hosts
  FROM hosts
),
moments AS (
  SELECT mean, mean * (1 - mean) AS chance,
    xx - n * mean * mean - (hosts - 1) * mean * (1 - mean) AS spread,
    n - nn / n - (hosts - 1) AS room
  FROM totals
),
prior AS (
  SELECT mean, CASE WHEN spread <= 0 OR room <= 0 OR chance = 0 THEN 1000
    ELSE least(1000, greatest(1, chance * room / spread - 1)) END AS strength
  FROM moments
),
rated AS (SELECT source, (x + mean * strength) / (n + strength) AS rate FROM hosts, prior),
judged AS (
  SELECT failing.*,
    NOT base_failed AND minor_failures <= CASE WHEN rate > 0.05 THEN 0 ELSE 1 END AS kept
  FROM failing JOIN rated ON failing.source IS NOT DISTINCT FROM rated.source
)"""


HOST_QUALITY = f"""
WITH {_judged("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM judged
"""


def _cleaned(documents: str) -> str:
    """CTEs up to ``cleaned``: the documents without repeated lines."""
    return f"""
line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM {documents} WHERE text IS NOT NULL
),
numbered AS (
  SELECT *, trim(line, {BLANKS}) <> '' AS filled,
    CAST(sum((trim(line, {BLANKS}) <> '')::INT) OVER (PARTITION BY doc_id ORDER BY n) AS BIGINT)
      AS place
  FROM line
),
own AS (
  SELECT doc_id, place, string_agg(line, chr(10) ORDER BY n) AS whole,
    arg_min(line, n) AS bare, bool_or(filled) AS filled
  FROM numbered GROUP BY doc_id, place
),
windows AS (
  SELECT doc_id, place, 2 AS span, whole || chr(10) || lead(bare) OVER (PARTITION BY doc_id
    ORDER BY place) AS content, filled
  FROM own
  UNION ALL
  SELECT doc_id, place, 1, bare, length(bare) - length(replace(bare, ' ', '')) >= 49 FROM own
),
ranked AS (
  SELECT doc_id, place, span, row_number() OVER (PARTITION BY span, content
    ORDER BY doc_id, place) > 1 AS gone
  FROM windows WHERE content IS NOT NULL AND filled
),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + span)) AS place FROM ranked WHERE gone
),
cleaned AS (
  SELECT own.doc_id, count(*) AS n_chunks, count(covered.place) AS n_removed,
    coalesce(string_agg(whole, chr(10) ORDER BY own.place) FILTER (covered.place IS NULL), '')
      AS cleaned
  FROM own LEFT JOIN covered ON own.doc_id = covered.doc_id AND own.place = covered.place
  GROUP BY own.doc_id
)"""


LINE_DEDUP = f"""
WITH {_cleaned("documents")}
SELECT documents.doc_id, cleaned AS text, coalesce(n_chunks, 0) AS n_chunks,
  coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN cleaned USING (doc_id)
"""


# Thai, Lao, Myanmar, Khmer, kana, Han: scripts where a character is a word.
UNSPACED = "".join(
    f"\\x{{{first}}}-\\x{{{last}}}"
    for first, last in (
        ("0e01", "0e4e"), ("0e81", "0ece"), ("1000", "109f"), ("1780", "17d3"),
        ("3005", "3005"), ("3007", "3007"), ("3041", "3096"), ("30a1", "30fa"),
        ("30fc", "30fc"), ("3400", "4dbf"), ("4e00", "9fff"), ("f900", "faff"),
        ("ff66", "ff9f"), ("20000", "2fa1f"), ("30000", "3ffff"),
    )
)


def _words(rows: str, key: str) -> str:
    """The words of each row, in order, as a list."""
    apart = f"regexp_replace(lower(text), '([{UNSPACED}])', ' \\1 ', 'g')"
    return f"""SELECT {key}, regexp_extract_all({apart}, '[{UNSPACED}]|[\\p{{L}}\\p{{N}}_]+') AS ws
  FROM {rows}"""


def _shingles(name: str, rows: str, key: str) -> str:
    return f"""
{name}_words AS (
  {_words(rows, key)}
),
{name}_tokens AS (
  SELECT {key}, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM {name}_words
),
{name} AS (
  SELECT DISTINCT {key}, gram FROM (
    SELECT {key}, lead(word, 4) OVER following IS NOT NULL AS whole,
      concat_ws(' ', word, lead(word, 1) OVER following, lead(word, 2) OVER following,
        lead(word, 3) OVER following, lead(word, 4) OVER following) AS gram
    FROM {name}_tokens WINDOW following AS (PARTITION BY {key} ORDER BY pos)
  ) WHERE whole
)"""


def _contained(documents: str) -> str:
    """CTEs up to ``contained``: documents with the items they contain."""
    return f"""{_shingles("item_gram", "(SELECT DISTINCT item_id, text FROM benchmark)", "item_id")},
{_shingles("doc_gram", documents, "doc_id")},
item_size AS (SELECT item_id, count(*) AS n_shingles FROM item_gram GROUP BY item_id),
short AS (
  SELECT item_id, len(ws) AS n, array_to_string(ws, ' ') AS gram
  FROM item_gram_words WHERE len(ws) BETWEEN 1 AND 4
),
doc_short AS (
  SELECT DISTINCT doc_id, n, array_to_string(ws[pos : pos + n - 1], ' ') AS gram
  FROM (
    SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos
    FROM doc_gram_words CROSS JOIN (SELECT DISTINCT n FROM short)
  )
),
contained AS (
  SELECT doc_id, item_id, any_value(n_shingles) AS n_shingles, count(*) AS n_shared
  FROM doc_gram JOIN item_gram USING (gram) JOIN item_size USING (item_id)
  GROUP BY doc_id, item_id
  HAVING count(*) >= 0.8 * any_value(n_shingles)
  UNION ALL
  SELECT doc_id, item_id, 1, 1 FROM doc_short JOIN short USING (n, gram)
)"""


DECONTAMINATION = f"""
WITH {_contained("documents")}
SELECT doc_id, item_id, n_shingles, n_shared FROM contained
"""

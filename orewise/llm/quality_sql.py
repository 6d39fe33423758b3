"""DuckDB SQL for the rows of the quality query."""

from .quality import BASE_PERCENT, BASE_WINDOW, LINE_PERCENT, MIN_WORDS, NGRAM_PERCENT, SYMBOLS


def quality_sql() -> str:
    sizes = (BASE_WINDOW, *NGRAM_PERCENT)
    windows = ", ".join(
        f"CASE WHEN count(*) OVER w{n} = {n} THEN string_agg(word, ' ') OVER w{n} END AS key{n}" for n in sizes
    )
    frames = ", ".join(f"w{n} AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)" for n in sizes)
    twice = ", ".join(f"key{n} IS NOT NULL AND count(*) OVER (PARTITION BY r, key{n}) > 1 AS twice{n}" for n in sizes)
    below = ", ".join(f"bool_or(twice{n}) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS below{n}" for n in sizes)
    sums = ", ".join(f"coalesce(sum(length(word)) FILTER (below{n}), 0)::BIGINT AS dup{n}_chars" for n in NGRAM_PERCENT)
    names = ", ".join(f"coalesce(dup{n}_chars, 0) AS dup{n}_chars" for n in NGRAM_PERCENT)
    over = " OR ".join(
        [f"dup_line_chars * 100 > word_chars * {LINE_PERCENT}", *(f"dup{n}_chars * 100 > word_chars * {p}" for n, p in NGRAM_PERCENT.items())]
    )
    coverages = ", ".join(f"dup{n}_chars" for n in NGRAM_PERCENT)
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT r, regexp_extract_all(text, '{word}') AS ws, string_split(text, chr(10)) AS ls FROM d),
words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM parts),
keyed AS (SELECT r, p, word, {windows} FROM words WINDOW {frames}),
twice AS (SELECT r, p, word, {twice} FROM keyed),
covered AS (SELECT r, p, word, {below} FROM twice),
counts AS (
  SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
    count(*) FILTER (below{BASE_WINDOW}) AS n_repeat_words, {sums}
  FROM covered GROUP BY r),
lines AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM parts),
worded AS (SELECT r, p, line, length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS n FROM lines WHERE regexp_matches(line, '{word}')),
ranked AS (SELECT r, n, row_number() OVER (PARTITION BY r, line ORDER BY p) AS k FROM worded),
repeats AS (SELECT r, count(*) AS n_dup_lines, sum(n)::BIGINT AS dup_line_chars FROM ranked WHERE k > 1 GROUP BY r),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(dup_line_chars, 0) AS dup_line_chars, {names}
  FROM d LEFT JOIN counts USING (r) LEFT JOIN repeats USING (r)),
base AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {BASE_PERCENT} AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR {over}) AS kept, dup_line_chars, {coverages} FROM base"""

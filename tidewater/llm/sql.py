"""DuckDB oracle SQL of the queries of this package (where SQL can state the result)."""

QUALITY_MEASURES = r"""
q_docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS body FROM {docs}
), q_words AS (
  SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(body, chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM q_docs
), q_pos AS (
  SELECT rid, unnest(generate_series(1, len(words) - 4)) AS i, words FROM q_words WHERE len(words) >= 5
), q_win AS (
  SELECT rid, i, words[i:i + 4] AS win FROM q_pos
), q_rep AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS times FROM q_win
), q_cover AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM (SELECT rid, i FROM q_rep WHERE times > 1) AS a, generate_series(0, 4) AS g(k) GROUP BY rid
), q_measured AS (
  SELECT w.rid, doc_id, source, len(words) AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM q_words w LEFT JOIN q_cover c ON c.rid = w.rid
), q_failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CAST(n_words < 10 AS INT) AS f1,
         CAST(100 * n_repeat_words > 20 * n_words AS INT) AS f2,
         CAST(n_symbols > 0.3 * n_words AS INT) AS f3,
         CAST(n_dup_lines > 0.3 * n_lines AS INT) AS f4,
         CAST(n_words > 0 AND NOT word_chars / greatest(n_words, 1) BETWEEN 2.0 AND 15.0 AS INT) AS f5
  FROM q_measured
), q_long AS (
  SELECT source, unnest([1, 2, 3, 4, 5]) AS rule, unnest([f1, f2, f3, f4, f5]) AS f
  FROM q_failed WHERE source IS NOT NULL
), q_hosts AS (
  SELECT source, rule, count(*) AS n, CAST(sum(f) AS DOUBLE) AS f FROM q_long GROUP BY 1, 2
), q_sums AS (
  SELECT rule, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n))
         - (sum(f) / sum(n)) * (1 - sum(f) / sum(n)) * (count(*) - 1) / sum(n) AS between_hosts
  FROM q_hosts GROUP BY rule
), q_prior AS (
  SELECT rule, m, CASE WHEN between_hosts <= m * (1 - m) / 1e6 THEN 1e6
                       ELSE greatest(m * (1 - m) / between_hosts - 1, 1.0) END AS s FROM q_sums
), q_verdicts AS (
  SELECT source, max((f + m * s) / (n + s)) <= 0.5 AS host_ok
  FROM q_hosts JOIN q_prior USING (rule) GROUP BY source
), q_judged AS (
  SELECT q.*, NOT base_failed AND coalesce(host_ok, true) AS kept
  FROM q_failed q LEFT JOIN q_verdicts v ON v.source = q.source
)"""

QUALITY = f"""
WITH {QUALITY_MEASURES.replace('{docs}', 'documents')}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, kept
FROM q_judged"""

EXACT_DEDUP = r"""
WITH bodies AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM bodies WINDOW same AS (PARTITION BY body)"""

def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


#: crc32 of the decimal identifier, bit by bit (0xEDB88320 is the reversed polynomial).
_CRC32 = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
      lambda x, bit: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))))"""

MERKLE = f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, lang, {_leaf('n_chars')} AS leaf, {_leaf('CAST(n_chars AS HUGEINT) + 1')} AS other,
         coalesce({_CRC32} % 7 = 0, false) AS tampered FROM documents
), leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS size FROM rows_
), tree AS (
  SELECT lang, 0 AS level, pos, leaf AS h, size FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (size + 1) // 2
  FROM tree WHERE size > 1 GROUP BY lang, level + 1, pos // 2, (size + 1) // 2
), nodes AS MATERIALIZED (SELECT * FROM tree
), tops AS MATERIALIZED (
  SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
         count(*) OVER () AS size FROM nodes WHERE size = 1
), upper_tree AS (
  SELECT 0 AS level, pos, subroot AS h, size FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (size + 1) // 2
  FROM upper_tree WHERE size > 1 GROUP BY level + 1, pos // 2, (size + 1) // 2
), upper_nodes AS MATERIALIZED (SELECT * FROM upper_tree
), below AS (
  SELECT l.doc_id, l.lang, l.pos, g.level, CASE WHEN s.h IS NULL THEN '.' WHEN s.pos & 1 = 0 THEN '<' || s.h ELSE '>' || s.h END AS step
  FROM leaves l JOIN tops t ON t.lang IS NOT DISTINCT FROM l.lang
  JOIN (SELECT unnest(range(64)) AS level) g ON g.level < t.height
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = g.level AND s.pos = xor(l.pos >> g.level, 1)
), above AS (
  SELECT t.lang, g.level, CASE WHEN s.h IS NULL THEN '.' WHEN s.pos & 1 = 0 THEN '<' || s.h ELSE '>' || s.h END AS step
  FROM tops t JOIN (SELECT unnest(range(64)) AS level) g ON g.level < (SELECT max(level) FROM upper_nodes)
  LEFT JOIN upper_nodes s ON s.level = g.level AND s.pos = xor(t.pos >> g.level, 1)
), paths AS (
  SELECT lang, pos, list(step ORDER BY level) AS steps FROM below GROUP BY lang, pos
), upper_paths AS (
  SELECT lang, list(step ORDER BY level) AS steps FROM above GROUP BY lang
), joined AS (
  SELECT l.*, t.subroot, (SELECT h FROM upper_nodes WHERE size = 1) AS root,
         list_concat(coalesce(p.steps, []), coalesce(u.steps, [])) AS steps
  FROM leaves l JOIN tops t ON t.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM l.lang AND p.pos = l.pos
  LEFT JOIN upper_paths u ON u.lang IS NOT DISTINCT FROM l.lang
), folded AS (
  SELECT *, list_reduce(list_prepend(CASE WHEN tampered THEN other ELSE leaf END, steps), lambda own, step:
    sha256(CASE step[1] WHEN '<' THEN step[2:] || own ELSE own || step[2:] END)) AS folded_root FROM joined
)
SELECT doc_id, leaf, subroot, root,
       sha256(coalesce(array_to_string(list_transform(steps, lambda step: step[2:]), ''), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded"""

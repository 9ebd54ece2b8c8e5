"""DuckDB SQL for the results of those registered queries that SQL can express.

Not expressible: op1 and op3 (tokenizer), op5 (XXH64), op7 (hash keys of the sample), op9 (training). Tests compare them with
plain versions.
"""

from __future__ import annotations

from haulage.llm import line_dedup, secrets


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def secret_hits(kind_no: int, pattern: str, group: int) -> str:
    """Every match of one kind with its text before, length and value."""
    p = text(pattern)
    return f"""SELECT doc_id, owner, {kind_no} AS kind_no, i, m[i] AS found, v[i] AS value,
length(g[i]) + length(m[i]) AS used FROM (
  SELECT doc_id, owner, regexp_extract_all(body, {p}) AS m, regexp_extract_all(body, {p}, {group}) AS v,
  string_split_regex(body, {p}) AS g FROM docs), unnest(range(1, len(m) + 1)) AS u(i)"""


HITS = " UNION ALL ".join(
    [
        secret_hits(0, secrets.ASSIGN, 2),
        secret_hits(1, rf"AKIA[A-Z0-9]{{{secrets.ACCESS_LEAST - 4},}}", 0),
        secret_hits(2, rf"[0-9a-f]{{{secrets.HEX_LEAST},}}", 0),
        secret_hits(3, secrets.OWNED_RUN, 0),
    ]
)

SECRETS = f"""WITH docs AS (SELECT doc_id, source AS owner, coalesce(text, '') AS body FROM documents),
hits AS ({HITS}),
ended AS (SELECT *, CAST(sum(used) OVER (PARTITION BY doc_id, kind_no ORDER BY i) AS BIGINT) AS ends FROM hits),
spans AS (SELECT doc_id, owner, kind_no, ends - length(found) AS starts, ends, value FROM ended
  WHERE CASE kind_no WHEN 0 THEN length(value) >= {secrets.ASSIGN_LEAST}
    WHEN 3 THEN regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') ELSE true END),
free AS (SELECT * FROM spans s WHERE kind_no <> 3 OR NOT EXISTS (
  SELECT 1 FROM spans b WHERE b.doc_id = s.doc_id AND b.kind_no <> 3 AND b.starts < s.ends AND s.starts < b.ends)),
spread AS (SELECT value, count(DISTINCT coalesce(owner, chr(0))) AS n_owners,
  count(DISTINCT {{'o': coalesce(owner, chr(0)), 'r': doc_id}}) AS n_repositories FROM free GROUP BY value),
kept AS (SELECT free.*, n_owners, n_repositories, n_owners < 3 AND n_repositories < 10 AS live, starts || ':' || ends AS place,
  list_extract(['assign', 'access', 'hex', 'owned'], kind_no + 1) AS kind
  FROM free JOIN spread USING (value) WHERE kind_no <> 3 OR (n_owners < 3 AND n_repositories < 10)),
rows_ AS (SELECT doc_id, count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access,
  count(*) FILTER (kind_no = 2) AS n_hex, count(*) FILTER (kind_no = 3) AS n_owned,
  string_agg(kind || ':' || place, ',' ORDER BY starts, kind_no) FILTER (kind_no <> 3) AS base,
  string_agg(kind || ':' || place, ',' ORDER BY starts, kind_no) AS spans,
  string_agg(n_owners || '/' || n_repositories || CASE WHEN live THEN '/live' ELSE '/example' END, ',' ORDER BY starts, kind_no) AS ownership,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned,
coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(ownership, '') AS ownership FROM docs d LEFT JOIN rows_ USING (doc_id)"""

REJECTED = """10 * n_symbols > n_words OR word_chars > 25 * n_words OR 2 * (len(text) - len(replace(text, '!', ''))) > n_words
OR (n_words >= 20 AND 5 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 4 * len(regexp_replace(text, '[^A-Za-z]', '', 'g')))
OR 10 * n_dup_lines > 6 * n_lines OR (n_words >= 20 AND 3 * n_echoes > n_words)"""

QUALITY = f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM docs),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g FROM split, unnest(range(1, len(w) - 6)) AS u(i)),
twice AS (SELECT doc_id, g FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows JOIN twice USING (doc_id, g), range(8) AS r(k) GROUP BY doc_id),
measured AS (SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echoes FROM split LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
NOT base_failed AND NOT ({REJECTED}) AS kept FROM judged"""

TOP_K = """WITH vectors AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores) WHERE place <= 10"""

LINES = f"""WITH shown AS (SELECT page_id, url, regexp_replace(html, {text(line_dedup.HIDDEN)}, chr(10), 'g') AS body FROM pages),
cut AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
  trim(regexp_replace(regexp_replace(regexp_replace(body, {text(line_dedup.LINE_TAGS)}, chr(10), 'g'), '<[^>]*>', '', 'g'),
  '\\n{{2,}}', chr(10), 'g'), chr(10)) AS whole FROM shown),
lines AS (SELECT page_id, host, i, l[i] AS line, trim(l[i], ' ' || chr(9) || chr(13)) AS bare FROM (
  SELECT page_id, host, string_split(whole, chr(10)) AS l FROM cut), unnest(range(1, len(l) + 1)) AS u(i)),
totals AS (SELECT host, count(*) AS n_pages FROM cut GROUP BY host),
frequent AS (SELECT host, bare, count(DISTINCT page_id) AS n FROM lines WHERE bare <> '' GROUP BY host, bare),
dropped AS (SELECT host, bare FROM frequent JOIN totals USING (host) WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.RATIO} * n_pages),
kept AS (SELECT page_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM lines ANTI JOIN dropped USING (host, bare)
  GROUP BY page_id),
counted AS (SELECT page_id, count(*) AS n_lines FROM lines GROUP BY page_id)
SELECT page_id, host, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines, 0) - coalesce(n, 0) AS n_dropped,
CASE WHEN whole IS NULL THEN NULL ELSE coalesce(text, '') END AS text
FROM cut LEFT JOIN counted USING (page_id) LEFT JOIN kept USING (page_id)"""

CHAT = """WITH named AS (SELECT conv_id, CAST(floor(turn / 256) AS BIGINT) AS section, turn, coalesce(role, 'unknown') AS speaker,
  coalesce(text, '') AS body FROM conversations),
said AS (SELECT *, row_number() OVER (PARTITION BY conv_id, section ORDER BY turn NULLS LAST, speaker, body) AS n FROM named),
who AS (SELECT DISTINCT conv_id AS c, speaker AS assistant FROM named WHERE speaker <> 'system'),
parts AS (SELECT said.*, assistant, speaker = assistant AS own,
  '<|im_start|>' || CASE WHEN speaker = assistant THEN 'assistant' WHEN speaker = 'system' THEN 'system'
  ELSE 'user name=' || regexp_replace(speaker, '[\\s<>|]', '_', 'g') END || chr(10) AS head,
  regexp_replace(body, '<(\\|im_(?:start|end)\\|>)', '< \\1', 'g') || '<|im_end|>' AS told
  FROM said JOIN who ON conv_id IS NOT DISTINCT FROM c),
placed AS (SELECT *, CAST(sum(length(head) + length(told) + 1) OVER (PARTITION BY conv_id, section, assistant ORDER BY n) AS BIGINT)
  - length(told) - 1 AS starts FROM parts)
SELECT conv_id, section, assistant, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
coalesce(string_agg(starts || '-' || (starts + length(told)), ',' ORDER BY n) FILTER (own), '') AS mask,
string_agg(head || told || chr(10), '' ORDER BY n) AS text FROM placed GROUP BY conv_id, section, assistant"""

COLLOCATIONS = """WITH pieces AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS (SELECT lang, k, w[i : i + k - 1] AS ws FROM pieces, range(1, 6) AS s(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS u(i)),
counts AS (SELECT lang, k, array_to_string(ws, ' ') AS phrase, ws, count(*) AS f FROM grams GROUP BY lang, k, ws),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE k > 1 AND f >= 100),
alone AS (SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM candidates b WHERE b.lang = c.lang AND b.k > c.k
  AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ') AND 100 * b.f >= 100 * c.f)),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n, cut,
  CAST((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM alone c JOIN range(1, 5) AS s(cut) ON cut < c.k JOIN totals t ON t.lang = c.lang
  JOIN counts l ON l.lang = c.lang AND l.ws = c.ws[1 : cut] JOIN counts r ON r.lang = c.lang AND r.ws = c.ws[cut + 1 : c.k]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) WHERE rank <= 2000"""

SUBSTRINGS = """WITH docs AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS g FROM docs, unnest(range(1, greatest(len(w) - 18, 1))) AS u(i)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS place FROM windows) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM later, range(20) AS r(j)),
words AS (SELECT doc_id, p, w[p] AS word FROM docs, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

NEGATIVES = """WITH vectors AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE place <= 5"""

CHECKS: dict[str, str] = {
    "op2_secret_scan": SECRETS,
    "op4_quality_rules": QUALITY,
    "op6_exact_top_k": TOP_K,
    "op8_line_dedup": LINES,
    "op10_chat_perspectives": CHAT,
    "op11_phrase_collocations": COLLOCATIONS,
    "op12_substring_dedup": SUBSTRINGS,
    "op13_hard_negatives": NEGATIVES,
}

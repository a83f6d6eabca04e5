"""DuckDB SQL for the queries that SQL can express, written on its own terms."""

from __future__ import annotations

from ledgerloom.llm import license_scan

WORDS = r"[w FOR w IN regexp_split_to_array(coalesce({}, ''), '[\x20\x09-\x0D]+') IF w <> '']"

HOST_QUALITY = rf"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text, {WORDS.format("text")} AS words,
    [x FOR x IN string_split(coalesce(text, ''), chr(10))
     IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 7), ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM texts)),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS place FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS times FROM windows)
    WHERE times > 1)
  GROUP BY doc_id),
counts AS (
  SELECT t.doc_id, t.source, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN repeated r ON r.doc_id IS NOT DISTINCT FROM t.doc_id),
rules AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * word_chars
      OR 100 * n_dup_lines > 30 * n_lines OR word_chars > 25 * n_words AS any_failed
  FROM counts),
hosts AS (
  SELECT source, count(*) AS docs, count(*) FILTER (any_failed) AS failed FROM rules GROUP BY source),
totals AS (
  SELECT sum(failed) / sum(docs) AS mean, sum(docs) AS docs, count(*) AS hosts,
    sum(docs * (failed / docs) * (failed / docs)) AS squares
  FROM hosts),
spread AS (
  SELECT mean, mean * (1 - mean) AS one,
    squares / docs - mean * mean - mean * (1 - mean) * hosts / docs AS variance
  FROM totals),
prior AS (
  SELECT mean, CASE WHEN variance * 1001 > one THEN greatest(1.0, one / variance - 1)
                    ELSE 1000.0 END AS strength
  FROM spread),
shrunk AS (
  SELECT source, mean, docs, strength, (failed + mean * strength) / (docs + strength) AS host_rate FROM hosts, prior),
verdicts AS (
  SELECT source, host_rate,
    host_rate - 2 * sqrt(host_rate * (1 - host_rate) / (docs + strength + 1)) > 2 * mean AS host_rejected
  FROM shrunk)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  base_failed, any_failed, round(host_rate, 6) AS host_rate, host_rejected,
  NOT base_failed AND NOT host_rejected AS kept
FROM rules JOIN verdicts ON rules.source IS NOT DISTINCT FROM verdicts.source
"""

WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS size FROM pages),
owners AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS owner FROM payloads)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN size >= 1000 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND page_id <> owner THEN owner END AS refers_to
FROM owners
"""

REPEATED_SPANS = f"""
WITH texts AS (SELECT doc_id, {WORDS.format("text")} AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 19), ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM texts)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS n FROM windows)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM later),
places AS (
  SELECT doc_id, place, words[place] AS word
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS place FROM texts)),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.place) AS text, count(*) AS n
  FROM places p ANTI JOIN gone g ON g.doc_id = p.doc_id AND g.place = p.place
  GROUP BY p.doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""

# The texts under the mask are taken from the source: what is read back must equal them.
CHAT_FORMAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, bool_or(regexp_matches(role || chr(10) || text, '<\\*/?s>|\[\\*/?INST\]'))
    OVER (PARTITION BY conv_id) AS escaped FROM rows),
turns AS (
  SELECT *, CASE WHEN escaped THEN
      length(regexp_replace(regexp_replace(role, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g'))
      + length(regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g'))
    ELSE length(role) + length(text) END + length('<s>[INST][/INST]</s>') AS chars
  FROM marked)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

CONVERSATION_REPAIR = r"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
-- CRC-32, a bit at a time: the next byte comes in every eight steps
crc AS (
  SELECT row, key, 0 AS step, 4294967295 AS value FROM rows
  UNION ALL
  SELECT row, key, step + 1, CASE WHEN mixed % 2 = 1 THEN xor(mixed // 2, 3988292384) ELSE mixed // 2 END
  FROM (SELECT row, key, step,
          CASE WHEN step % 8 = 0 THEN xor(value, CAST(ascii(substr(key, step // 8 + 1, 1)) AS BIGINT)) ELSE value END AS mixed
        FROM crc WHERE step < 8 * length(key))),
fates AS (SELECT row, xor(value, 4294967295) % 20 AS fate FROM crc WHERE step = 8 * length(key)),
damaged AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM rows JOIN fates USING (row), range(1, 3) AS copies(copy)
  WHERE fate <> 0 AND (copy = 1 OR fate = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS said
  FROM damaged),
faulty AS (
  SELECT conv_id, turn, role, text, place, substr(role, 1, 1) AS initial,
    CASE WHEN said = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
      WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault,
    place > 1 AND lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) || substr(role, 1, 1)
      NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed),
reports AS (
  SELECT conv_id, max(place) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faulty GROUP BY conv_id),
-- what was said last (n nothing, s, u, a), up to two inserted rows, what was said last then
inserted(state, more, then_state, lines) AS (
  VALUES ('n', '', 'n', ''), ('n', 'I', 'u', chr(10) || 'user:'), ('n', 'II', 'a', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('s', '', 's', ''), ('s', 'I', 'u', chr(10) || 'user:'), ('s', 'II', 'a', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('u', '', 'u', ''), ('u', 'I', 'a', chr(10) || 'assistant:'),
    ('a', '', 'a', ''), ('a', 'I', 'u', chr(10) || 'user:')),
edits(state, edit, initial, then_state, cost, as_role) AS (
  VALUES ('n', 'D', NULL, 'n', 4, NULL), ('s', 'D', NULL, 's', 4, NULL), ('u', 'D', NULL, 'u', 4, NULL), ('a', 'D', NULL, 'a', 4, NULL),
    ('n', 'K', 's', 's', 0, NULL), ('n', 'K', 'u', 'u', 0, NULL), ('s', 'K', 'u', 'u', 0, NULL), ('u', 'K', 'a', 'a', 0, NULL), ('a', 'K', 'u', 'u', 0, NULL),
    ('n', 'R', NULL, 'u', 3, 'user'), ('s', 'R', NULL, 'u', 3, 'user'), ('u', 'R', NULL, 'a', 3, 'assistant'), ('a', 'R', NULL, 'u', 3, 'user')),
-- the cheapest way to every place and state
ways AS (
  SELECT conv_id, 0::BIGINT AS place, 'n' AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} AS best FROM reports
  UNION ALL
  SELECT conv_id, place, state, min(way) FROM (
    SELECT w.conv_id, f.place, e.then_state AS state, {
      'cost': w.best.cost + 3 * length(i.more) + e.cost + CASE WHEN f.fault = 'truncated' AND e.edit <> 'D' THEN 3 ELSE 0 END,
      'audit': w.best.audit || i.more || e.edit,
      'lines': w.best.lines || i.lines || CASE WHEN e.edit = 'D' THEN '' ELSE chr(10) || coalesce(e.as_role, f.role) || ':' || f.text END
    } AS way
    FROM ways w
    JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place + 1
    JOIN inserted i ON i.state = w.state
    JOIN edits e ON e.state = i.then_state AND (e.initial IS NULL OR e.initial = f.initial)
      AND (e.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate')))
  GROUP BY conv_id, place, state),
repaired AS (
  SELECT r.conv_id, min({'cost': w.best.cost + 3 * length(i.more), 'audit': w.best.audit || i.more, 'lines': w.best.lines || i.lines}) AS best
  FROM reports r
  JOIN ways w ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND w.place = r.n
  JOIN inserted i ON i.state = w.state AND i.then_state IN ('n', 'a')
  GROUP BY r.conv_id)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(p.best.cost, 0) AS cost,
  coalesce(p.best.audit, '') AS audit, sha256(substr(coalesce(p.best.lines, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN reports r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM c.conv_id
"""

_POINTS = """
WITH numbered AS (SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings WHERE len(embedding) = 64),
components AS (
  SELECT row, vec_id, unnest(range(1, 65)) AS dim, unnest(embedding) AS x FROM numbered),
kept AS (
  SELECT row FROM components GROUP BY row HAVING bool_and(x IS NOT NULL AND isfinite(x))),
points AS (
  SELECT row, vec_id, dim, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM components SEMI JOIN kept USING (row)),
ranked AS (
  SELECT row, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, list(x ORDER BY dim)) - 1 AS cluster
  FROM points GROUP BY row, vec_id),
centroids0 AS (SELECT cluster, dim, x AS c FROM ranked JOIN points USING (row) WHERE cluster < 16)"""
_NEAREST = """,
gaps{i} AS (
  SELECT row, cluster, CAST(sum((x - c) * (x - c)) AS BIGINT) AS distance
  FROM points JOIN centroids{i} USING (dim) GROUP BY row, cluster),
nearest{i} AS (
  SELECT row, cluster, distance FROM gaps{i}
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)"""
_MOVED = """,
sums{i} AS (
  SELECT cluster, dim, sum(x) AS s, count(*) AS n FROM nearest{i} JOIN points USING (row) GROUP BY cluster, dim),
centroids{j} AS (
  SELECT cluster, dim, coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), c) AS c
  FROM centroids{i} LEFT JOIN sums{i} USING (cluster, dim))"""
_CLUSTERS = """,
totals AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM nearest3 GROUP BY cluster),
digests AS (
  SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256
  FROM centroids3 GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, cluster_inertia,
  CAST((SELECT sum(cluster_inertia) FROM totals) AS BIGINT) AS inertia, centroid_sha256
FROM nearest3 JOIN numbered USING (row) JOIN totals USING (cluster) JOIN digests USING (cluster)
"""
CENTROID_CLUSTERS = (
    _POINTS
    + "".join(_NEAREST.format(i=i) + _MOVED.format(i=i, j=i + 1) for i in range(3))
    + _NEAREST.format(i=3)
    + _CLUSTERS
)


def _values(pairs: tuple[tuple[str, str], ...]) -> str:
    quoted = ((a.replace("'", "''"), b.replace("'", "''")) for a, b in pairs)
    return ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(quoted))


# Every word of a block that a notice has is counted; no order, prefix or filter is used.
LICENSE_SCAN = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id,
    [w FOR w IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> ''] AS words
  FROM documents),
places AS (
  SELECT row, unnest(range(len(words))) AS place, unnest(words) AS word FROM texts),
phrases(phrase, text, label) AS (VALUES {_values(license_scan.PHRASES)}),
phrase_words AS (
  SELECT phrase, label, unnest(range(len(words))) AS k, unnest(words) AS word, len(words) AS n
  FROM (SELECT phrase, label, string_split(text, ' ') AS words FROM phrases)),
base AS (
  SELECT row, label, place - k AS start FROM places JOIN phrase_words USING (word)
  GROUP BY row, phrase, label, place - k, n HAVING count(*) = n),
by_base AS (
  SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY row),
notices(notice, label, text) AS (VALUES {_values(license_scan.NOTICES)}),
notice_texts AS (
  SELECT notice, label,
    [w FOR w IN regexp_split_to_array(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> ''] AS words
  FROM notices),
notice_words AS (
  SELECT DISTINCT notice, label, unnest(words) AS word, len(list_distinct(words)) AS n,
    CAST(greatest(16, pow(2, ceil(log2(2 * len(words))))) AS BIGINT) // 2 AS half
  FROM notice_texts),
blocks AS (
  SELECT row, notice, label, n, place // half - back AS block, count(DISTINCT word) AS common
  FROM places JOIN notice_words USING (word), range(2) AS halves(back)
  WHERE place // half - back >= 0
  GROUP BY ALL HAVING 100 * count(DISTINCT word) >= 85 * n),
by_notice AS (SELECT row, max(common / n) AS best FROM blocks GROUP BY row),
labels AS (
  SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT row, label FROM base UNION ALL SELECT row, label FROM blocks) GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(best, 0) END AS DOUBLE) AS score
FROM texts LEFT JOIN by_base USING (row) LEFT JOIN by_notice USING (row) LEFT JOIN labels USING (row)
"""

ORACLES = {
    "op3_host_quality": HOST_QUALITY,
    "op8_warc": WARC,
    "op9_repeated_spans": REPEATED_SPANS,
    "op10_chat_format": CHAT_FORMAT,
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op12_centroid_clusters": CENTROID_CLUSTERS,
    "op13_license_scan": LICENSE_SCAN,
}

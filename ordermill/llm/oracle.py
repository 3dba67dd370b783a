"""SQL for the corpus queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op5_quality_cascade"] = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
),
runs AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM worded))
),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM runs WHERE n > 1) GROUP BY doc_id
),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
  FROM worded LEFT JOIN covered USING (doc_id)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
         OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 2 * n_upper > n_letters) AS kept
FROM judged
"""

ORACLE["op4_seekable_archive"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS keeper FROM payloads)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (('0x' || substr(digest, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM grouped
"""

ORACLE["op10_snapshot_collapse"] = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM conversations
),
rolled AS (
  SELECT conv_id, position, n_turns,
         string_agg(sha256(concat_ws('-', role IS NULL, coalesce(role, ''), text IS NULL, coalesce(text, ''))), '')
           OVER (PARTITION BY conv_id ORDER BY position) AS prefix
  FROM turns
),
proper AS (SELECT DISTINCT sha256(prefix) AS p FROM rolled WHERE position < n_turns),
whole AS (SELECT sha256(prefix) AS p, min(conv_id) AS conv_id, count(*) AS n_copies FROM rolled WHERE position = n_turns GROUP BY 1),
kept AS (SELECT conv_id, n_copies FROM whole WHERE p NOT IN (SELECT p FROM proper))
SELECT conv_id, ((position - 1) // 256)::INTEGER AS part, max(n_turns)::BIGINT AS n_turns, max(n_copies)::BIGINT AS n_copies,
       string_agg('<|' || replace(coalesce(role, 'unknown'), '<|', '< |') || '|>' || chr(10) || replace(coalesce(text, ''), '<|', '< |')
         || chr(10) || '<|end|>' || chr(10), '' ORDER BY position) AS rendered
FROM turns JOIN kept USING (conv_id) GROUP BY conv_id, part
"""

ORACLE["op6_line_runs"] = r"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS said FROM documents),
every AS (SELECT doc_id, unnest(range(1, len(said) + 1)) AS line, unnest(said) AS said FROM texts),
worded AS (
  SELECT doc_id, line, said, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS nr
  FROM every WHERE regexp_matches(said, '[^\x20\x09-\x0D]')
),
windows AS (
  SELECT doc_id, nr, said AS a, lead(said, 1) OVER w AS b, lead(said, 2) OVER w AS c
  FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY nr)
),
repeats AS (
  SELECT p.doc_id, p.nr, q.doc_id AS first_doc, p.nr - q.nr AS shift
  FROM windows p JOIN windows q ON p.a = q.a AND p.b = q.b AND p.c = q.c AND (q.doc_id, q.nr) < (p.doc_id, p.nr)
  WHERE p.c IS NOT NULL
),
later AS (SELECT DISTINCT doc_id, nr FROM repeats),
longest AS (
  SELECT doc_id, max(n) AS longest_run FROM (
    SELECT doc_id, count(*) + 2 AS n
    FROM (SELECT *, nr - row_number() OVER (PARTITION BY doc_id, first_doc, shift ORDER BY nr) AS run FROM repeats)
    GROUP BY doc_id, first_doc, shift, run)
  GROUP BY doc_id
),
gone AS (
  SELECT DISTINCT w.doc_id, w.line FROM worded w
  JOIN (SELECT doc_id, unnest([nr, nr + 1, nr + 2]) AS nr FROM later) USING (doc_id, nr)
),
kept AS (
  SELECT e.doc_id, count(g.line) AS n_removed,
         coalesce(string_agg(e.said, chr(10) ORDER BY e.line) FILTER (g.line IS NULL), '') AS text
  FROM every e LEFT JOIN gone g USING (doc_id, line) GROUP BY e.doc_id
)
SELECT doc_id, count(nr)::BIGINT AS n_lines, any_value(n_removed)::BIGINT AS n_removed,
       coalesce(any_value(longest_run), 0)::BIGINT AS longest_run, sha256(any_value(kept.text)) AS kept_sha256
FROM kept LEFT JOIN worded USING (doc_id) LEFT JOIN longest USING (doc_id) GROUP BY doc_id
"""

ORACLE["op11_periodic_runs"] = r"""
WITH said AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
drawn AS (
  SELECT *, len(w) AS n, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INTEGER, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda i: 0::BIGINT)),
      lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) AS h
  FROM said
),
cut AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM drawn),
cycled AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
    list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w
  FROM cut
),
places AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM cycled),
five AS (
  SELECT doc_id, n, i, [word, lead(word, 1) OVER own, lead(word, 2) OVER own, lead(word, 3) OVER own, lead(word, 4) OVER own] AS said
  FROM places WINDOW own AS (PARTITION BY doc_id ORDER BY i)
),
again AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM five a JOIN five b ON a.doc_id = b.doc_id AND a.said = b.said AND a.i < b.i
  WHERE 4 * (b.i - a.i) <= a.n AND a.i + 5 <= a.n AND b.i + 5 <= b.n
),
stretches AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 5 + q - min(i) AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM again) GROUP BY doc_id, q, island
),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY doc_id, s, l),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l::DOUBLE / q DESC, s, q) AS nth FROM runs) WHERE nth = 1
),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS text FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period,
       (1000 * l // q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLE["op12_ranked_search"] = r"""
WITH said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
terms AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY 1, 2),
whole AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM said WHERE len(w) > 0),
counted AS (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM said),
tfs AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM counted SEMI JOIN terms USING (term) GROUP BY 1, 2),
weighted AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, whole GROUP BY 1),
shares AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS share FROM tfs JOIN weighted USING (term), whole
),
scored AS (SELECT item_id, doc_id, sum(times * share)::BIGINT AS score FROM terms JOIN shares USING (term) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# What the contract asks of pages whose article is an <article> of headings and paragraphs, as all of these are.
ORACLE["op13_main_text"] = r"""
WITH cut AS (
  SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(?:p|h[1-6])>|<br>') AS parts FROM pages
),
plain AS (
  SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    x, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM cut
),
joined AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), ' ') AS text FROM plain)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined
"""

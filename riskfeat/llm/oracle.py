"""DuckDB SQL that gives the same rows as the queries."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: ``\``, ``#`` and ``<`` (and ``:`` in roles) get a backslash, so each adds a character.
CHATS = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
sized AS (
    SELECT *,
        length('### : </turn>' || chr(10)) + length(role) + length(text)
        + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars,
    false AS rewrites_history
FROM sized GROUP BY conv_id
"""

LINES = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents
),
runs AS (
    SELECT doc_id, i, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c, lead(i, 2) OVER w AS whole
    FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)
),
later AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) > 1 AS again
    FROM runs WHERE whole IS NOT NULL
),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, (VALUES (0), (1), (2)) AS s(k) WHERE again),
left_over AS (
    SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS text,
        count(*) AS n_lines, count(g.i) AS n_removed
    FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(o.text, '') END AS text,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN left_over o ON d.doc_id = o.doc_id
"""

URLS = f"""
WITH split AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), '{UPPER}', '{LOWER}') AS host,
        coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
    FROM pages
),
rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
best AS (
    SELECT host, path, max({{'n': length(rule_host || rule_path), 'r': rule_host || rule_path, 'v': verdict}}) AS b
    FROM (SELECT DISTINCT host, path FROM split) s
    JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path
)
SELECT page_id, host, path, b.r AS rule, coalesce(b.v, 'allow') AS verdict FROM split LEFT JOIN best USING (host, path)
"""

MIX = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size,
        md5(concat_ws(chr(10), CAST(doc_id AS VARCHAR), text)) AS h
    FROM documents
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS s,
        CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w
    FROM sized GROUP BY source
),
ranked AS (
    SELECT *, sum(s) OVER () AS total, row_number() OVER r AS k,
        coalesce(sum(3 * s) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
        sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM sources WINDOW r AS (ORDER BY 3 * s / w, source)
),
level AS (
    SELECT min(k) AS first_open FROM ranked
    WHERE (CAST(total AS DOUBLE) - CAST(capped AS DOUBLE)) * w / open <= CAST(3 * s AS DOUBLE)
),
targets AS (
    SELECT r.source, r.s, CASE WHEN r.k < l.first_open THEN CAST(3 * r.s AS DOUBLE)
        ELSE (CAST(f.total AS DOUBLE) - CAST(f.capped AS DOUBLE)) * r.w / f.open END AS target
    FROM ranked r, level l JOIN ranked f ON f.k = l.first_open
),
placed AS (
    SELECT d.doc_id, d.size, t.s AS source_size, t.target, CAST(floor(t.target) AS BIGINT) AS wanted,
        CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS begins
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    greatest(0, least(size, wanted - begins)) + greatest(0, least(size, wanted - begins - source_size))
    + greatest(0, least(size, wanted - begins - 2 * source_size)) AS taken
FROM placed
"""

RULES = f"""
WITH listed AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
worded AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM listed),
runs AS (
    SELECT doc_id, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
    FROM worded WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM runs WHERE c IS NOT NULL)
    WHERE n > 1
),
repeated AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id
),
counted AS (
    SELECT doc_id, text, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
    FROM listed
),
features AS (
    SELECT c.doc_id, c.text, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM counted c LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 5 * n_symbols > n_words
        OR word_chars < 2 * n_words OR word_chars > 20 * n_words
        OR 2 * n_dup_lines > len(string_split(text, chr(10)))
        OR 2 * len(regexp_extract_all(text, '\\p{{Lu}}')) > len(regexp_extract_all(text, '\\p{{L}}'))
        OR 3 * len(regexp_extract_all(text, '!!')) > n_words) AS kept
FROM features
"""

GROUPS = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * shared >= 80 * (p.n + q.n - shared)
),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x
)
SELECT r.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

LEAKS = f"""
WITH texts AS (
    SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents
    UNION ALL
    SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') FROM benchmark
),
widths AS (SELECT DISTINCT least(5, len(w)) AS k FROM texts WHERE kind = 'i' AND len(w) > 0),
shingles AS (
    SELECT DISTINCT kind, id, k, array_to_string(w[i : i + k - 1], ' ') AS s
    FROM (
        SELECT kind, id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i
        FROM texts, widths WHERE kind = 'd' OR k = least(5, len(w))
    )
),
items AS (SELECT id, k, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 'i')
SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS n_item, count(*) AS n_shared, count(*) / any_value(n) AS containment
FROM shingles d JOIN items i ON d.kind = 'd' AND d.k = i.k AND d.s = i.s
GROUP BY d.id, i.id HAVING 100 * count(*) >= 80 * any_value(n)
"""

SUBSTRINGS = f"""
WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
runs AS (
    SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS i FROM listed)
),
later AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM runs) WHERE k > 1
),
worded AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM listed),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM later, range(20) AS s(k)),
left_over AS (
    SELECT p.doc_id, count(*) AS n_words, count(g.i) AS n_removed, string_agg(word, ' ' ORDER BY p.i) FILTER (g.i IS NULL) AS kept
    FROM worded p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN left_over USING (doc_id)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SEARCH = f"""
WITH listed AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS w FROM documents
),
sized AS (SELECT doc_id, len(w) AS n FROM listed WHERE len(w) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
counted AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM listed) GROUP BY doc_id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counted, whole GROUP BY term, docs
),
wanted AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark)
    GROUP BY item_id, term
),
scored AS (
    SELECT i.item_id, c.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
    FROM wanted i JOIN counted c USING (term) JOIN weights USING (term) JOIN sized s ON s.doc_id = c.doc_id, whole
    GROUP BY i.item_id, c.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

#: f(phrase) of every length, then the cuts of each candidate.
PHRASES = f"""
WITH pieces AS (
    SELECT doc_id, coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM listed GROUP BY lang),
occurring AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i FROM listed, (VALUES (1), (2), (3), (4)) AS s(k))
),
frequent AS (SELECT lang, k, phrase, count(*) AS f FROM occurring GROUP BY lang, k, phrase HAVING count(*) >= 30),
cuts AS (
    SELECT c.lang, c.k, c.phrase, c.f AS a, j, x.f AS l, y.f AS r,
        CAST((2000000::HUGEINT * c.f) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM frequent WHERE k > 1) c
    JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(string_split(c.phrase, ' ')[1 : j], ' ')
    JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(string_split(c.phrase, ' ')[j + 1 :], ' ')
),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_phrases AS (
    SELECT f.lang, array_to_string(string_split(f.phrase, ' ')[i : i + m - 1], ' ') AS phrase, max(f.f) AS most
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM frequent, (VALUES (2), (3)) AS s(m) WHERE m < k) f
    GROUP BY ALL
)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase, a, l, r, n, score
FROM weakest w JOIN totals t ON t.lang = w.lang
LEFT JOIN inner_phrases i ON i.lang = w.lang AND i.phrase = w.phrase
WHERE most IS NULL OR 100 * most < 80 * a
QUALIFY rank <= 2000
"""

ORACLE = {
    "op1_chat_formatting": CHATS,
    "op2_line_dedup": LINES,
    "op3_url_filters": URLS,
    "op5_mixing": MIX,
    "op6_quality_rules": RULES,
    "op7_ngram_join": GROUPS,
    "op9_decontamination": LEAKS,
    "op10_substring_dedup": SUBSTRINGS,
    "op11_lexical_search": SEARCH,
    "op12_collocations": PHRASES,
}

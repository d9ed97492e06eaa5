"""SQL that gives the rows of the queries that SQL can express."""

_CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
moved AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
        '<|im_start|>' || role || chr(10)
        || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')
        || '<|im_end|>' || chr(10) AS written
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
        FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(written)) AS BIGINT) AS formatted_chars,
    bool_and((before IS NULL AND role IN ('system', 'user'))
        OR (coalesce(before, '') IN ('system', 'assistant') AND role = 'user')
        OR (coalesce(before, '') = 'user' AND role = 'assistant')) AS valid
FROM moved GROUP BY conv_id
"""

_URLS = r"""
WITH rest AS (
    SELECT page_id, CASE WHEN url IS NULL OR position('://' IN url) = 0 THEN ''
        ELSE substr(url, position('://' IN url) + 3) END AS rest
    FROM pages),
parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest),
rules(rule, verdict, rule_host, rule_path) AS (VALUES
    ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
    ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
fitting AS (
    SELECT page_id, rule, verdict FROM (
        SELECT page_id, rule, verdict,
            row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule) AS place
        FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
            AND starts_with(path, rule_path))
    WHERE place = 1),
patterns(pattern) AS (VALUES
    ('^([^/]*\.)?ads\.'), ('^([^/]*\.)?tracker\.'), ('^([^/]*[.-])?casino[.-][^/]*'),
    ('^([^/]*[.-])?porn[.-][^/]*'), ('/login(/|\.[a-z]+|$)'), ('/signup(/|\.[a-z]+|$)'),
    ('/cart(/|\.[a-z]+|$)'), ('/checkout(/|\.[a-z]+|$)'), ('/wp-admin(/|$)'),
    ('/tag/[^/]+/page/[0-9]+(/|$)'), (';jsessionid=[A-Za-z0-9]+')),
blocked AS (
    SELECT DISTINCT page_id FROM parts JOIN patterns ON regexp_matches(host || path, pattern))
SELECT page_id, host, path, rule,
    coalesce(verdict, CASE WHEN blocked.page_id IS NOT NULL THEN 'block' ELSE 'allow' END)
        AS verdict
FROM parts LEFT JOIN fitting USING (page_id) LEFT JOIN blocked USING (page_id)
"""

_EMBEDDINGS = r"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v))
        / sqrt(list_dot_product(b.v, b.v)) >= 0.95),
reach(a, b) AS (
    SELECT vec_id, vec_id FROM vectors
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
    (SELECT min(b) FROM reach WHERE a = vec_id) AS component_id,
    vec_id = (SELECT min(b) FROM reach WHERE a = vec_id) AS kept
FROM vectors
"""

# CRC-32 bit by bit for its table, byte by byte for the runs; near words share what is left without
# one code point, or are left when the other lacks one.
_SPELLING = r"""
WITH RECURSIVE crc(t) AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i)
    FROM range(256) AS _(i)),
found AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]{6,}')) AS run
    FROM documents),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, run, count(*) AS n
    FROM found GROUP BY ALL),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
        string_split(doc || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128
            THEN [CAST(unicode(c) AS BIGINT)]
            ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
    FROM runs, crc),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT n, CASE WHEN h % 199 > 0 THEN run
            ELSE left(run, h % length(run)) || substr(run, h % length(run) + 2) END AS word
        FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (
    SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
    FROM words, unnest(range(1, length(word) + 1)) AS _(i)),
longer AS (SELECT l.word AS a, w.word AS b FROM less l JOIN words w ON l.rest = w.word),
near AS (
    SELECT a, b FROM longer UNION SELECT b, a FROM longer
    UNION SELECT x.word, y.word FROM less x JOIN less y
        ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word),
ranked AS (
    SELECT a, b, n AS b_n, count(*) OVER (PARTITION BY a) AS n_near,
        row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS place
    FROM near JOIN words ON b = word),
judged AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN b_n >= 5 * n THEN b END AS form, CASE WHEN b_n >= 5 * n THEN b_n END AS form_n
    FROM words LEFT JOIN (FROM ranked WHERE place = 1) ON a = word),
steps(word, top) AS (
    SELECT word, word FROM judged
    UNION ALL SELECT s.word, j.form FROM steps s JOIN judged j ON s.top = j.word
    WHERE j.form IS NOT NULL)
SELECT j.word, j.form, s.top AS root, j.n, j.n_near, j.form_n
FROM judged j JOIN steps s USING (word) JOIN judged r ON s.top = r.word WHERE r.form IS NULL
"""

# Exact, as the operator is on tables where MIN_CANDIDATES takes in every leaf.
_NEIGHBOURS = """
WITH vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
    SELECT a.vec_id AS query_id, b.vec_id, sqrt(list_reduce(list_prepend(CAST(0 AS DOUBLE),
        list_transform(list_zip(a.v, b.v), lambda p: (p[2] - p[1]) * (p[2] - p[1]))),
        lambda s, x: s + x)) AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT)
        AS rank, vec_id, score
    FROM pairs)
FROM ranked WHERE rank <= 10
"""

_PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM (
        SELECT lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\f\r]')) AS piece
        FROM documents)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
frequent AS (
    SELECT lang, k, phrase, count(*) AS f FROM (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
        FROM pieces, range(1, 6) AS _(k), unnest(range(1, len(w) - k + 2)) AS __(i))
    GROUP BY ALL HAVING count(*) >= 100),
candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE k > 1),
held AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS most
    FROM candidates, range(2, 5) AS _(size), unnest(range(1, k - size + 2)) AS __(i)
    WHERE size < k GROUP BY ALL),
cuts AS (
    SELECT c.lang, c.phrase, a, n, cut, x.f AS l, y.f AS r,
        CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM candidates c JOIN totals USING (lang), unnest(range(1, k)) AS _(cut)
        JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
        JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')
    WHERE NOT EXISTS (FROM held h WHERE h.lang = c.lang AND h.phrase = c.phrase
        AND 100 * h.most >= 100 * a)),
least AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place
    FROM cuts),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
        AS rank, phrase, a, l, r, n, score
    FROM least WHERE place = 1)
FROM ranked WHERE rank <= 2000
"""

SQL = {"op5_chat": _CHAT, "op6_urls": _URLS, "op10_embeddings": _EMBEDDINGS,
       "op11_spelling": _SPELLING, "op12_neighbours": _NEIGHBOURS, "op13_phrases": _PHRASES}

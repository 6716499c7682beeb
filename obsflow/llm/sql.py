"""DuckDB SQL for the operators that SQL can express, over whole tables."""

_SPACES = r"[\x20\x09-\x0D]+"

OP1 = rf"""
    WITH docs AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}'), lambda w: w <> '') AS words
        FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS content
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS i FROM docs WHERE len(words) >= 20)
    ), repeated AS (
        SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, i) > 1
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM repeated
    ), words AS (
        SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs
    ), kept AS (
        SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS content, count(*) AS n
        FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id
    )
    SELECT d.doc_id, len(d.words)::BIGINT AS n_words, (len(d.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
           sha256(coalesce(k.content, '')) AS kept_sha256
    FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

OP3 = rf"""
    WITH lines AS (
        SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
    ), sets AS (
        SELECT doc_id, i, line,
               list_sort(list_distinct(list_filter(regexp_split_to_array(line, '{_SPACES}'), lambda w: w <> ''))) AS words
        FROM lines
    ), names AS (
        SELECT words, min((doc_id, i)) AS place, row_number() OVER (ORDER BY min((doc_id, i))) AS nth, len(words) AS n
        FROM sets WHERE len(words) > 0 GROUP BY words
    ), tokens AS (
        SELECT nth, n, unnest(words) AS word FROM names
    ), alike AS (
        SELECT y.nth FROM tokens x JOIN tokens y ON x.word = y.word AND x.nth < y.nth AND x.n * 100 >= 80 * y.n AND y.n * 100 >= 80 * x.n
        GROUP BY x.nth, y.nth, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
    ), kept AS (
        SELECT s.doc_id, s.i, s.line, len(s.words) = 0 OR (n.place = (s.doc_id, s.i) AND n.nth NOT IN (SELECT nth FROM alike)) AS stays
        FROM sets s LEFT JOIN names n ON s.words = n.words
    )
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
    FROM kept GROUP BY doc_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = rf"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACES}'),
                                   lambda w: w <> '') AS words
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
            ELSE list_distinct(list_transform(generate_series(1, len(words) - 2), lambda i: array_to_string(words[i : i + 2], ' '))) END AS shingles
        FROM docs
    ), flat AS (
        SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
    ), links AS (
        SELECT x.doc_id AS a, y.doc_id AS b
        FROM flat x JOIN flat y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
        GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
    ), both_ways AS (
        SELECT a, b FROM links UNION SELECT b, a FROM links
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a
    ), classes AS (
        SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(shingles)) AS class_id FROM sets WHERE len(shingles) > 0
    )
    SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(c.class_id, s.doc_id) AS class_id, min(r.b) AS component_id
    FROM sets s JOIN reach r ON s.doc_id = r.a LEFT JOIN classes c ON s.doc_id = c.doc_id
    GROUP BY s.doc_id, len(s.shingles), c.class_id
"""

OP6 = """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
    )
    SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

OP11 = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
    ), terms AS (
        SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
    ), kept AS (
        SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 10
    ), langs AS (
        SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
    ), counted AS (
        SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term
    ), groups AS (
        SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
        FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counted c ON g.lang = c.lang AND g.source = c.source
        GROUP BY g.lang, g.source
    ), shares AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
               1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
               1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (l.lang_total + 2 * l.v) AS q
        FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
        LEFT JOIN counted c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term
    ), summed AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
    ), found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found
    )
    SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS rank FROM ranked
    WHERE part = 'pair' OR place <= 10
"""

OP13 = """
    WITH RECURSIVE whole AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
        WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM whole x JOIN whole y ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
        WHERE list_cosine_similarity(x.v, y.v) >= 0.93
    ), reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    )
    SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, min(r.b) AS component_id, e.vec_id = min(r.b) AS kept
    FROM embeddings e JOIN reach r ON e.vec_id = r.a GROUP BY e.vec_id
"""

OP12 = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
    ), pieces AS (
        SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
        FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs)
    ), totals AS (
        SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
    ), grams AS (
        SELECT lang, array_to_string(words[i : i + k - 1], ' ') AS phrase, words[i : i + k - 1] AS list
        FROM (SELECT lang, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i
              FROM (SELECT lang, words, unnest([1, 2, 3, 4, 5]) AS k FROM pieces) WHERE len(words) >= k)
    ), counted AS (
        SELECT lang, phrase, any_value(list) AS list, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 100
    ), cuts AS (
        SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, t.n, c.k, (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
        FROM (SELECT *, unnest(generate_series(1, len(list) - 1)) AS k FROM counted WHERE len(list) > 1) c
        JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.list[: c.k], ' ')
        JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.list[c.k + 1 :], ' ')
        JOIN totals t ON t.lang = c.lang
    ), inner_parts AS (
        SELECT lang, f, list, i, unnest(generate_series(i + 1, len(list))) AS j
        FROM (SELECT lang, f, list, unnest(generate_series(1, len(list) - 1)) AS i FROM counted)
    ), covered AS (
        SELECT DISTINCT c.lang, c.phrase FROM counted c
        JOIN inner_parts p ON p.lang = c.lang AND array_to_string(p.list[p.i : p.j], ' ') = c.phrase AND p.j - p.i + 1 < len(p.list)
        WHERE 100 * p.f >= 100 * c.f
    ), lowest AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
    ), ranked AS (
        SELECT l.*, row_number() OVER (PARTITION BY l.lang ORDER BY score DESC, a DESC, l.phrase) AS place
        FROM lowest l ANTI JOIN covered c ON l.lang = c.lang AND l.phrase = c.phrase
    )
    SELECT lang, place AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE place <= 2000
"""

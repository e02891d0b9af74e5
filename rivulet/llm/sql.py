"""The same results as plain SQL, where SQL can express them."""

_FOLDED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK_WORD = r"[^\x20\x09-\x0D]+"

OP1 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '{_PLAIN_WORD}') AS ws FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_FOLDED}, '{_PLAIN_WORD}') AS ws FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n,
         array_to_string(list_slice(ws, s, s + least(len(ws), 10) - 1), ' ') AS w
  FROM (SELECT item_id, ws, unnest(generate_series(1, len(ws) - least(len(ws), 10) + 1)) AS s
        FROM i WHERE len(ws) > 0)
), lengths AS (
  SELECT DISTINCT n FROM iw
), dw AS (
  SELECT doc_id, n, s, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS s
        FROM d, lengths WHERE len(ws) >= n)
), found AS (
  SELECT doc_id, item_id, s, n FROM dw JOIN iw USING (n, w)
), hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS pos FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_BLANK_WORD}') AS ws FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 19), ' ') AS w
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS s FROM d WHERE len(ws) >= 20)
), later AS (
  SELECT doc_id, s FROM windows
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(s, s + 19)) AS pos FROM later
), words AS (
  SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS pos FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""

OP8 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '{_BLANK_WORD}') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, pos, pos + 4), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS pos
        FROM d WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), both_in AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM both_in JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

# Phrases of two to four words: f holds the count of every phrase, cut the lowest cut.
OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({_FOLDED}, '[^.,;:!?\\x0A-\\x0D]+')) AS p
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS ws FROM pieces
), grams AS (
  SELECT lang, m, ws[s:s + m - 1] AS g
  FROM (SELECT lang, ws, m, unnest(generate_series(1, len(ws) - m + 1)) AS s
        FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m)
), f AS (
  SELECT lang, m, g, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), total AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
), cuts AS (
  SELECT c.lang, c.m, c.g, c.a, c.k, x.a AS l, y.a AS r,
         CAST((CAST(2000000 AS HUGEINT) * c.a) // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM f WHERE m > 1) c
  JOIN f x ON x.lang = c.lang AND x.m = c.k AND x.g = c.g[1:c.k]
  JOIN f y ON y.lang = c.lang AND y.m = c.m - c.k AND y.g = c.g[c.k + 1:c.m]
), cut AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, g[s:s + j - 1] AS g, a
  FROM (SELECT *, unnest(generate_series(1, m - j + 1)) AS s
        FROM (SELECT *, unnest(generate_series(2, m - 1)) AS j FROM f WHERE m > 2))
), covers AS (
  SELECT lang, g, max(a) AS cover FROM inner_parts GROUP BY ALL
), kept AS (
  SELECT cut.*, array_to_string(cut.g, ' ') AS phrase
  FROM cut LEFT JOIN covers ON covers.lang = cut.lang AND covers.g = cut.g
  WHERE cover IS NULL OR 100 * cover < 80 * a
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN total USING (lang) WHERE rank <= 2000
"""

# URLs: the listed rules, then rules of up to three tokens mined from what those judge.
OP12 = r"""
WITH listed(said, name, start) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
         ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), cut AS (
  SELECT row_number() OVER () AS row, page_id, url,
         CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1) AS asked
  FROM cut
), fitting AS (
  SELECT row, said, name || start AS rule FROM parts JOIN listed
  ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(name || start) DESC, name DESC, start DESC) = 1
), folded AS (
  SELECT row, url, rest,
         regexp_replace(host, '[0-9]+', '#', 'g') AS h,
         list_filter(string_split(regexp_replace(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '#', 'g'), '/'), lambda x: x <> '') AS steps,
         regexp_replace(translate(asked, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '#', 'g') AS asked,
         regexp_replace(translate(split_part(url, '://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '#', 'g') AS scheme
  FROM parts
), token_rows AS (
  SELECT row, 'name:' || unnest(string_split_regex(array_to_string(
           string_split(h, '.')[1:len(string_split(h, '.')) - 1], '.'), '[.-]')) AS token FROM folded
  UNION SELECT row, 'scheme:' || scheme FROM folded WHERE rest <> ''
  UNION SELECT row, 'top:' || string_split(h, '.')[-1] FROM folded
  UNION SELECT row, 'dir:' || steps[1] FROM folded WHERE len(steps) > 1
  UNION SELECT row, 'mid:' || array_to_string(steps[2:len(steps) - 1], '/') FROM folded WHERE len(steps) > 2
  UNION SELECT row, 'page:' || regexp_extract(steps[-1], '(?s)^(.*?)([.][^.]*)?\z', 1) FROM folded WHERE len(steps) > 0
  UNION SELECT row, 'ext:' || regexp_extract(steps[-1], '[.]([^.]*)\z', 1) FROM folded WHERE len(steps) > 0
  UNION SELECT row, 'query:' || array_to_string(list_sort(list_distinct(list_transform(
           string_split(asked, '&'), lambda x: split_part(x, '=', 1)))), '&') FROM folded
  UNION SELECT row, 'fragment' FROM folded WHERE contains(rest, '#')
), token AS (
  SELECT row, token FROM token_rows
  WHERE token NOT IN ('name:', 'scheme:', 'top:', 'mid:', 'page:', 'ext:', 'query:')
), labelled AS (
  SELECT t.row, token, said FROM token t JOIN fitting USING (row)
), sized AS (
  SELECT count(*) AS n FROM fitting
), itemsets AS (
  SELECT [token] AS items, said, count(*) AS n FROM labelled GROUP BY ALL
  UNION ALL
  SELECT [a.token, b.token], a.said, count(*) FROM labelled a
  JOIN labelled b ON a.row = b.row AND a.token < b.token GROUP BY ALL
  UNION ALL
  SELECT [a.token, b.token, c.token], a.said, count(*) FROM labelled a
  JOIN labelled b ON a.row = b.row AND a.token < b.token
  JOIN labelled c ON a.row = c.row AND b.token < c.token GROUP BY ALL
), alone AS (
  SELECT items, sum(n) AS alone FROM itemsets GROUP BY items
), sure AS (
  SELECT items, said, i.n AS together, alone, CAST(i.n AS DOUBLE) / alone AS confidence
  FROM itemsets i JOIN alone USING (items), sized
  WHERE i.n >= ceil(CAST(0.01 AS DOUBLE) * sized.n) AND 100 * i.n >= 90 * alone
), rules AS (
  SELECT * FROM sure r WHERE NOT EXISTS (
    SELECT 1 FROM sure s WHERE s.said = r.said AND len(s.items) < len(r.items)
      AND list_has_all(r.items, s.items) AND s.confidence >= r.confidence)
), sets AS (
  SELECT row, list(token) AS own FROM token ANTI JOIN fitting USING (row) GROUP BY row
), mined AS (
  SELECT row, said, array_to_string(items, ' ') AS mined_rule FROM sets JOIN rules
  ON list_has_all(own, items)
  QUALIFY row_number() OVER (PARTITION BY row
    ORDER BY confidence DESC, together DESC, len(items), array_to_string(items, ' '), said) = 1
)
SELECT page_id, host, path, rule, coalesce(f.said, m.said, 'allow') AS verdict, mined_rule
FROM parts LEFT JOIN fitting f USING (row) LEFT JOIN mined m USING (row)
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

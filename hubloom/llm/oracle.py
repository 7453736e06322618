"""SQL that gives the same rows as the registered queries, where SQL can.

Left out: token counts (a tokenizer), mixing (raking to convergence), page text (a
markup parser), personal data (patterns that look around), quality (a fitted model)
and the pipeline. `tests/llm` holds these against plain versions.
"""

WORDS = r"[^\x20\x09-\x0D]+"

TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# class_id is a digest that SQL does not have; here it would be any name of the set.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{WORDS}') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
        ELSE array_to_string(w[i:i + 4], ' ') END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
          FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reached AS (
    SELECT DISTINCT a AS doc_id, a AS other FROM links
    UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles,
    coalesce(l.component_id, d.doc_id) AS component_id,
    d.doc_id = coalesce(l.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l USING (doc_id)
"""

SHARDS = """
WITH RECURSIVE crc_table AS (
    SELECT list(value ORDER BY i) AS codes FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
            THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS value
        FROM range(256) r(i))),
hexed AS (
    SELECT doc_id, source, strlen(coalesce(text, ''))::BIGINT + 8 AS size,
        hex(encode(coalesce(text, ''))) AS h
    FROM documents),
summed AS (
    SELECT doc_id, source, size, xor(list_reduce(
        list_transform(range(length(h) // 2),
                       lambda k: ('0x' || substr(h, (2 * k + 1)::BIGINT, 2))::BIGINT),
        lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1]), 4294967295),
        4294967295) AS text_crc32
    FROM hexed, crc_table),
drawn AS (
    SELECT *, md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32 || ':' || size) AS draw
    FROM summed),
sources AS (
    SELECT source AS of, n, (row_number() OVER (PARTITION BY n ORDER BY name) - 0.5::DOUBLE)
        / count(*) OVER (PARTITION BY n) AS u
    FROM (SELECT source, count(*) AS n, md5('17:' || coalesce('s' || source, 'n')) AS name
          FROM drawn GROUP BY source)),
ranked AS (
    SELECT d.*, (row_number() OVER (PARTITION BY source ORDER BY draw) - u) / n AS fraction
    FROM drawn d JOIN sources ON source IS NOT DISTINCT FROM of),
placed AS (
    SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, draw) AS place,
        count(*) OVER () AS n
    FROM ranked),
cut AS (SELECT *, (place * 24 - 1) // n AS s FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, s::INTEGER AS shard,
    (place - 1 - (s * n) // 24)::BIGINT AS slot, NULL::INTEGER AS grown_shard, source
FROM cut
"""

REPEATS = rf"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '{WORDS}'), []) AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
later AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM windows)
    WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
kept AS (
    SELECT t.doc_id, string_agg(t.word, ' ' ORDER BY t.i) AS k, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) t
    ANTI JOIN gone g ON t.doc_id = g.doc_id AND t.i = g.i
    GROUP BY t.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
    sha256(coalesce(k.k, '')) AS kept_sha256
FROM words w LEFT JOIN kept k USING (doc_id)
"""

TEST_WORDS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = f"""
WITH words AS (SELECT doc_id, coalesce({TEST_WORDS}, []) AS w FROM documents),
items AS (
    SELECT row_number() OVER () AS number, coalesce(item_id::VARCHAR, '') AS item,
        {TEST_WORDS} AS w FROM benchmark),
item_windows AS (
    SELECT number, item, i AS k, least(len(w), 10) AS n,
        array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
    FROM (SELECT number, item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
windows AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM words, lengths WHERE len(w) >= n)),
met AS (
    SELECT d.doc_id, d.i, d.n, t.number, t.item, d.i - t.k AS diagonal
    FROM windows d JOIN item_windows t ON d.n = t.n AND d.s = t.s),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS i FROM met),
runs AS (
    SELECT doc_id, min(i) AS first, count(*) + any_value(width) - 1 AS n FROM (
        SELECT doc_id, number, diagonal, i, n AS width, i - row_number() OVER (
            PARTITION BY doc_id, number, diagonal ORDER BY i) AS run FROM met)
    GROUP BY doc_id, number, diagonal, run),
longest AS (
    SELECT doc_id, max(n) AS longest_match, arg_max(first, n * 10000000 - first) - 1 AS match_word
    FROM runs GROUP BY doc_id),
hits AS (SELECT doc_id, count(*) AS n_hit FROM hit GROUP BY doc_id),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest_match, 0)::BIGINT AS longest_match,
    coalesce(match_word, -1)::BIGINT AS match_word
FROM words w LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
    LEFT JOIN longest USING (doc_id)
"""

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        list_inner_product(a.v, c.v)::BIGINT AS score
    FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id AND a.vec_id % 100 = 0),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id, same ORDER BY score DESC, vec_id) AS place
    FROM scores),
ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score,
        n.vec_id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id
                           ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
    FROM ordered p JOIN ordered n ON p.anchor_id = n.anchor_id AND p.same AND NOT n.same
        AND p.place <= 5 AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""

PREFIX_TRIE = """
WITH RECURSIVE crc_table AS (
    SELECT list(value ORDER BY i) AS codes FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
            THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS value
        FROM range(256) r(i))),
turns AS (
    SELECT conv_id, {'role': role, 'text': text} AS t, row_number() OVER (
        PARTITION BY conv_id
        ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || text)) AS place
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
          FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
    SELECT conv_id, list(t ORDER BY place) AS t, conv_id::VARCHAR AS s FROM turns GROUP BY conv_id),
cut AS (
    SELECT conv_id, t, xor(list_reduce(
        list_transform(range(length(s)), lambda k: ascii(substr(s, (k + 1)::BIGINT, 1))::BIGINT),
        lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 9 AS h
    FROM convs, crc_table),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) AS t
    FROM cut c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (
    SELECT conv_id, depth, t[1:depth] AS p, depth = len(t) AS ends
    FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS depth FROM rebuilt)),
nodes AS (
    SELECT min(conv_id) AS conv_id, depth, p, count(*) AS n_convs, sha256(coalesce(
        string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, p),
owners AS (
    SELECT x.conv_id, x.depth, n.conv_id AS owner
    FROM prefixes x JOIN nodes n ON x.depth = n.depth AND x.p = n.p),
linked AS (
    SELECT n.*, o.owner AS parent_conv_id
    FROM nodes n LEFT JOIN owners o ON o.conv_id = n.conv_id AND o.depth = n.depth - 1),
children AS (
    SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children
    FROM linked WHERE depth > 0 GROUP BY ALL),
own AS (
    SELECT l.* EXCLUDE (p), coalesce(n_children, 0) AS n_children,
        (n_children IS NULL)::BIGINT AS leaf,
        coalesce((n_convs - 1) * strlen(p[depth].text), 0) AS saved
    FROM linked l LEFT JOIN children USING (conv_id, depth)),
sums AS (
    SELECT o.owner AS conv_id, o.depth, sum(leaf)::BIGINT AS n_leaves,
        sum(saved)::BIGINT AS saved_tokens
    FROM own u JOIN owners o ON o.conv_id = u.conv_id AND o.depth <= u.depth GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM own JOIN sums USING (conv_id, depth)
"""

ORACLE_SQL: dict[str, str] = {
    "op4_top_k": TOP_K,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op8_shards": SHARDS,
    "op9_repeats": REPEATS,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_prefix_trie": PREFIX_TRIE,
    "op10_decontamination": DECONTAMINATION,
}

"""Reference SQL (DuckDB) of the queries that SQL can express over whole tables."""

from __future__ import annotations

from twinfold.llm import licenses

# control strings that get a backslash after their first character, one for each place
_CONTROL = [a + b for a in "<[" for b in ("|", "s>", "/s>", "INST]", "/INST]", "SYS>>", "/SYS>>", "<SYS>>", "</SYS>>")]


def _escaped_length(x: str) -> str:
    marks = ["\\", *_CONTROL]
    found = " + ".join(f"(length({x}) - length(replace({x}, '{m}', ''))) // {len(m)}" for m in marks)
    return f"(length({x}) + {found})"


CHAT_EXAMPLES = f"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    placed AS (
        SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
            length('<|im_start|>') + {_escaped_length('role')} + length('<|im_sep|>') + {_escaped_length('text')}
                + length('<|im_end|>') AS chars
        FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    summed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM placed),
    told AS (
        SELECT conv_id, count(*) AS n_turns, string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY place) AS turns,
            coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss,
            sum(upto) FILTER (role = 'assistant' OR place = n) AS formatted_chars
        FROM summed GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
        formatted_chars::BIGINT AS formatted_chars FROM told"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DOCUMENTS = f"""
    WITH RECURSIVE worded AS (
        SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
        FROM documents),
    sets AS MATERIALIZED (
        SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE [array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)] END) AS s
        FROM worded),
    items AS MATERIALIZED (SELECT r, unnest(s) AS x FROM sets),
    common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.r < b.r GROUP BY a.r, b.r),
    links AS MATERIALIZED (
        SELECT a, b FROM common JOIN sets p ON p.r = a JOIN sets q ON q.r = b
        WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
    both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (
        SELECT r AS a, r AS b FROM sets
        UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON l.a = reach.b),
    grouped AS (SELECT reach.a AS r, min(s.doc_id) AS component_id FROM reach JOIN sets s ON s.r = reach.b GROUP BY reach.a)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN grouped USING (r)"""

NEAR_VECTORS = """
    WITH RECURSIVE rows AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    usable AS MATERIALIZED (
        SELECT r, v, sqrt(list_dot_product(v, v)) AS size FROM rows
        WHERE v IS NOT NULL AND len(v) > 0 AND len([c for c in v if c IS NULL OR NOT isfinite(c)]) = 0
            AND list_dot_product(v, v) > 0),
    links AS MATERIALIZED (
        SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.r <> b.r AND len(a.v) = len(b.v)
        WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9),
    reach AS (SELECT r AS a, r AS b FROM rows UNION SELECT reach.a, l.b FROM reach JOIN links l ON l.a = reach.b),
    grouped AS (SELECT reach.a AS r, min(s.vec_id) AS component_id FROM reach JOIN rows s ON s.r = reach.b GROUP BY reach.a),
    counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM rows JOIN grouped USING (r) LEFT JOIN counted USING (r)"""


def _centroid_clusters(k: int = 8, rounds: int = 10, size: int = 64) -> str:
    """Plain k-means, every vector against every centroid in each round."""
    ctes = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS q
            FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, q) - 1 AS c, q FROM kept
            ORDER BY sha256('3:' || vec_id) NULLS LAST, q LIMIT {k})""",
    ]
    for t in range(rounds + 1):
        ctes.append(
            f"""a{t} AS MATERIALIZED (
            SELECT r, min(row(d, c)) AS best FROM (
                SELECT k.r, c.c, list_sum(list_transform(range(1, {size + 1}),
                    lambda i: (k.q[i] - c.q[i]) * (k.q[i] - c.q[i]))) AS d FROM kept k, c{t} c)
            GROUP BY r)"""
        )
        if t < rounds:
            ctes.append(
                f"""c{t + 1} AS MATERIALIZED (
            SELECT o.c, coalesce(n.q, o.q) AS q FROM c{t} o LEFT JOIN (
                SELECT c, list((s - (s % n + n) % n) // n ORDER BY i) AS q FROM (
                    SELECT best[2] AS c, i, sum(q[i])::HUGEINT AS s, count(*)::HUGEINT AS n
                    FROM a{t} JOIN kept USING (r), range(1, {size + 1}) AS t(i) GROUP BY ALL)
                GROUP BY c) n USING (c))"""
            )
    return f"""WITH {", ".join(ctes)}
    SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
        (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(z.q, ',')) AS centroid_sha256
    FROM (SELECT vec_id, best[2] AS c, best[1] AS d FROM a{rounds} JOIN kept USING (r)) JOIN c{rounds} z USING (c)"""


CENTROID_CLUSTERS = _centroid_clusters()

PHRASES = f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(list_transform(
            string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]'),
            lambda p: list_filter(string_split_regex(p, '[\\x20\\x09]+'), lambda x: x <> ''))) AS w
        FROM documents),
    total AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
    found AS MATERIALIZED (
        SELECT lang, g, count(*) AS f FROM (
            SELECT lang, w[i:i + m - 1] AS g FROM pieces, range(1, 6) AS ms(m), range(1, len(w) - m + 2) AS places(i))
        GROUP BY ALL HAVING f >= 100),
    counted AS MATERIALIZED (SELECT lang, len(g) AS m, g, array_to_string(g, ' ') AS phrase, f FROM found),
    cuts AS (
        SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n,
            (1000::HUGEINT * c.f * n::HUGEINT) // (l.f::HUGEINT * r.f) AS score
        FROM counted c JOIN total USING (lang), range(1, c.m) AS ks(k)
        JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.g[1:k], ' ')
        JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.g[k + 1:], ' ')
        WHERE NOT EXISTS (
            SELECT 1 FROM counted x WHERE x.lang = c.lang AND x.m > c.m AND x.f >= c.f
                AND contains(concat(' ', x.phrase, ' '), concat(' ', c.phrase, ' '))))
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
        l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    QUALIFY rank <= 2000"""


def _licences() -> str:
    """Every template at every word of every text."""
    rows = []
    for number, t in enumerate(licenses.TEMPLATES):
        for place, word in enumerate(t.words):
            rows.append(f"('{word}', {number}, {place}, {place in t.key_places()}, {len(t.key_places())}, '{t.label}', {t.base})")
    return f"""
    WITH postings(word, template, place, is_key, n_keys, label, base) AS (VALUES {", ".join(rows)}),
    worded AS MATERIALIZED (
        SELECT row_number() OVER () AS r, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM documents),
    hits AS MATERIALIZED (
        SELECT r, i, w[i + 1] AS word FROM worded, range(0, len(w)) AS places(i)
        WHERE w[i + 1] IN (SELECT word FROM postings)),
    held AS (SELECT word, count(DISTINCT r) AS n FROM hits GROUP BY word),
    weighed AS (
        SELECT p.*, 1 + len(list_filter(range(1, {licenses.HEAVIEST + 1}),
            lambda k: coalesce(n, 0)::HUGEINT * (1::HUGEINT << k) <= texts)) AS weight
        FROM postings p LEFT JOIN held USING (word), (SELECT count(*) AS texts FROM documents)),
    total AS (SELECT template, sum(weight) AS total FROM weighed GROUP BY template),
    begins AS (
        SELECT r, template, i - place AS start, sum(weight) AS agree, count(*) FILTER (is_key) AS keys,
            any_value(n_keys) AS n_keys, any_value(label) AS label, any_value(base) AS base
        FROM hits JOIN weighed USING (word) WHERE i >= place GROUP BY ALL),
    found AS (
        SELECT *, agree::DOUBLE / total::DOUBLE AS share FROM begins JOIN total USING (template)
        WHERE keys = n_keys AND 100 * agree >= {licenses.LEAST} * total),
    of_text AS (
        SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
            max(start) FILTER (base) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
            string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
        FROM found GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
        last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
        coalesce(score, 0.0)::DOUBLE AS score
    FROM worded LEFT JOIN of_text USING (r)"""


LICENCES = _licences()

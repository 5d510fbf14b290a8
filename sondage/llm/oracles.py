"""SQL that checks the queries which SQL can express, on small tables."""

from __future__ import annotations

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# Components by following links from every node; for small tables only.
_REACH = """reach(node, root) AS (SELECT node, node FROM nodes UNION SELECT l.b, r.root FROM reach AS r JOIN links AS l ON l.a = r.node),
    roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)"""

EMBEDDINGS = f"""WITH RECURSIVE nodes AS (SELECT vec_id AS node, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    fine AS (SELECT *, sqrt(list_dot_product(e, e)) AS size FROM nodes WHERE label IS NOT NULL AND len(e) > 0
        AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND list_dot_product(e, e) > 0),
    links AS MATERIALIZED (SELECT a.node AS a, b.node AS b FROM fine AS a JOIN fine AS b ON a.label = b.label AND a.node <> b.node
        WHERE len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98), {_REACH}
    SELECT n.node AS vec_id, (SELECT count(*) FROM links WHERE a = n.node) AS n_links, component_id, n.node = component_id AS kept
    FROM nodes AS n JOIN roots USING (node)"""

MINHASH = f"""WITH RECURSIVE nodes AS MATERIALIZED (SELECT doc_id AS node,
        regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^ \\t-\\r]+') AS w FROM documents),
    shingles AS MATERIALIZED (SELECT node, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS x FROM nodes),
    sizes AS MATERIALIZED (SELECT node, count(*) AS n FROM shingles GROUP BY node),
    shared AS MATERIALIZED (SELECT a.node AS a, b.node AS b, count(*) AS n FROM shingles AS a JOIN shingles AS b ON a.x = b.x AND a.node <> b.node
        GROUP BY a.node, b.node),
    links AS MATERIALIZED (SELECT a, b FROM shared AS s JOIN sizes AS p ON p.node = a JOIN sizes AS q ON q.node = b
        WHERE 100 * s.n >= 85 * (p.n + q.n - s.n)), {_REACH}
    SELECT r.node AS doc_id, coalesce(n, 0) AS n_shingles, component_id, r.node = component_id AS kept
    FROM roots AS r LEFT JOIN sizes USING (node)"""


def urls(rules) -> str:
    listed = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in rules)
    return f"""WITH rules(h, p, v) AS (VALUES {listed}),
    cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), {LETTERS}) AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
    SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict FROM (
        SELECT page_id, host, path, max({{'n': length(h || p), 'r': h || p, 'v': v}}) AS best
        FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id, host, path)"""


def resample(words: int, percent: int, buckets: int, seed: int) -> str:
    """CRC-32 is worked out bit by bit, once for each distinct word."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    digit = "instr('0123456789ABCDEF', substr(hex(encode(w)), {}, 1)) - 1"
    byte = f"16 * ({digit.format('2 * i - 1')}) + {digit.format('2 * i')}"
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    crc = f"xor(list_reduce(list_concat([4294967295], [CAST({byte} AS BIGINT) FOR i IN range(1, octet_length(encode(w)) + 1)]), lambda a, b: {step}), 4294967295)"
    return f"""WITH given AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), {LETTERS}) AS t FROM documents),
    own AS MATERIALIZED (SELECT r, unnest(regexp_extract_all(t, '{word}')) AS w FROM given),
    target AS MATERIALIZED (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{word}')) AS w FROM benchmark),
    hashed AS MATERIALIZED (SELECT w, {crc} % {buckets} AS bucket FROM (SELECT w FROM own UNION SELECT w FROM target)),
    s AS (SELECT bucket, count(*) AS n FROM own JOIN hashed USING (w) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS n FROM target JOIN hashed USING (w) GROUP BY bucket),
    gains AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM own) + {buckets})
        / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM target) + {buckets})))) AS gain FROM s FULL JOIN t USING (bucket)),
    sums AS (SELECT r, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM own JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY r),
    hex AS (SELECT r, substr(sha256('{seed}:' || doc_id), 1, 8) AS h FROM given),
    noise AS (SELECT r, list_sum([(instr('0123456789abcdef', substr(h, i, 1)) - 1) * (16 ** (8 - i)) FOR i IN range(1, 9)]) AS h FROM hex),
    scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM given JOIN noise USING (r) LEFT JOIN sums USING (r)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {words} ORDER BY score DESC, doc_id) AS place,
        {percent} * (count(*) FILTER (n_features >= {words}) OVER ()) // 100 AS drawn FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {words} AND place <= drawn THEN place END AS rank FROM placed"""


def divergence(least: int, places: int) -> str:
    apart = "(p - q) * (p - q) // (p + q)"
    return f"""WITH given AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), {LETTERS}) AS t FROM documents),
    own AS MATERIALIZED (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM given),
    kept AS (SELECT lang, term FROM own GROUP BY lang, term HAVING count(DISTINCT r) >= {least}),
    groups AS (SELECT DISTINCT lang, source FROM given),
    found AS (SELECT lang, source, term, count(*) AS n FROM own GROUP BY lang, source, term),
    counts AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)),
    shares AS MATERIALIZED (SELECT lang, source, term, n, 1 + CAST(1000000000 AS HUGEINT) * (n + 2)
        // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM counts),
    totals AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term),
    in_all AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM totals),
    differ AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
    far AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN differ AS d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
    over AS (SELECT lang, source, 'term' AS part, term AS item, {apart} AS value FROM shares JOIN in_all USING (lang, term) WHERE n > 0 AND p > q),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM far UNION ALL SELECT * FROM over))
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, rank FROM ranked WHERE part = 'pair' OR rank <= {places}"""

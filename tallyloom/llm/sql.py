"""SQL of the registered queries that SQL can express."""

SHINGLES = """
    SELECT id, unnest(list_distinct(CASE
        WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        ELSE [array_to_string(w, ' ')] END)) AS shingle
    FROM (SELECT id, list_filter(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
          FROM {source}) WHERE len(w) > 0"""

ORACLES = {
    "op6_decontamination": f"""
        WITH d AS ({SHINGLES.format(source="(SELECT doc_id AS id, text FROM documents)")}),
             b AS ({SHINGLES.format(source="(SELECT item_id AS id, text FROM benchmark)")}),
             n AS (SELECT id, count(*) AS n_item FROM b GROUP BY id)
        SELECT d.id AS doc_id, b.id AS item_id, any_value(n_item) AS n_item, count(*) AS n_found
        FROM d JOIN b USING (shingle) JOIN n ON n.id = b.id
        GROUP BY 1, 2 HAVING count(*) * 100 >= any_value(n_item) * 75""",
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             q AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM p),
             r AS (SELECT payload_digest, max(page_id) AS response_id FROM q
                   WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, q.payload_digest,
               CASE WHEN response_id > page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN response_id > page_id THEN response_id END AS refers_to
        FROM q LEFT JOIN r ON q.payload_digest = r.payload_digest AND payload_bytes >= 1000""",
    "op2_topk_search": """
        WITH w AS (SELECT doc_id, unnest(list_filter(string_split_regex(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS term FROM documents),
             t AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2),
             l AS (SELECT d.doc_id, coalesce(sum(tf), 0) AS len FROM documents d LEFT JOIN t USING (doc_id) GROUP BY 1),
             c AS (SELECT count(*) AS n, avg(len) AS mean FROM l),
             f AS (SELECT term, ln(1 + ((SELECT n FROM c) - count(*) + 0.5) / (count(*) + 0.5)) AS idf
                   FROM t GROUP BY 1),
             s AS (SELECT q.doc_id AS query_id, t.doc_id,
                          round(sum(idf * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * len / mean))), 4) AS score
                   FROM t q JOIN t USING (term) JOIN f USING (term) JOIN l ON l.doc_id = t.doc_id, c
                   WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10""",
    "op12_source_divergence": """
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
                   FROM documents),
             w AS (SELECT row, lang, source,
                          unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
             t AS (SELECT lang, term, count(*) AS total FROM w GROUP BY 1, 2 HAVING count(DISTINCT row) >= 10),
             c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY 1, 2, 3),
             g AS (SELECT DISTINCT lang, source FROM d),
             x AS (SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n, t.total
                   FROM g JOIN t USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
             s AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 2)
                             // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p,
                          1 + 1000000000::HUGEINT * (total + 2)
                             // (sum(total) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS q
                   FROM x),
             v AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                   FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
             pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
                       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                       LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source),
             terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
                       FROM s WHERE n > 0 AND p > q),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
                   FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT * FROM r WHERE part = 'pair' OR rank <= 10""",
    "op13_collocations": """
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
             w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
             g AS (SELECT lang, 1 AS size, unnest(w) AS phrase FROM w
                   UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')))
                   FROM w WHERE len(w) >= 2
                   UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
                   FROM w WHERE len(w) >= 3),
             f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY 1, 2, 3 HAVING count(*) >= 10),
             n AS (SELECT lang, count(*) AS n FROM g WHERE size = 1 GROUP BY 1),
             c AS (SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
                   FROM f WHERE size > 1),
             s AS (SELECT c.lang, c.phrase, c.a, c.size, k, x.f AS l, y.f AS r,
                          1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS score
                   FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
                          JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
             b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
             i AS (SELECT lang, part, max(a) AS a FROM (
                       SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part
                       FROM c WHERE size = 3) GROUP BY 1, 2),
             d AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.part = b.phrase
                   WHERE i.a IS NULL OR 100 * i.a < 50 * b.a),
             o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
        SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM o JOIN n USING (lang) WHERE rank <= 2000""",
}

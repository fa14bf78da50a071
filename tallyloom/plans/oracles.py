"""The registered queries as DuckDB SQL over the test tables."""

from __future__ import annotations

import re

from tallyloom.plans.fixtures import NEGATIVE, POSITIVE, RUN_AT, TICKERS, VIEWS

RUN_KEY, RUN_TIME = f"{RUN_AT:%Y%m%dT%H%M%S.%fZ}-", f"{RUN_AT:%Y-%m-%d %H:%M:%S}"

SPACE = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WORD = r"\p{L}\p{N}_"

CLEANING = (
    (rf"(?:http|www)[^{SPACE}]+", ""),
    (r"<[^>\n]*>", ""),
    (r"\$", " dollar "), ("€", " euro "), ("£", " pound "),
    (r"\b(\d+)%", r"\1 percent"),
    (r"\b(\d+)k\b", r"\1 thousand"), (r"\b(\d+)m\b", r"\1 million"),
    (r"\b(\d+)b\b", r"\1 billion"),
    (rf"[^{WORD}.,!?$%\-]+", " "),
)


def clean(column: str) -> str:
    out = f"lower(coalesce({column}, ''))"
    for pattern, replacement in CLEANING:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return f"trim({out})"


ISO_DATE = (r"^\d{4}-\d{2}-\d{2}"
            r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?)?([+-]\d{2}:\d{2})?)?$")


def iso_timestamp(column: str) -> str:
    spelled = f"replace({column}, 'Z', '+00:00')"
    return (f"CASE WHEN regexp_matches({spelled}, '{ISO_DATE}') THEN "
            f"CAST(timezone('UTC', try_cast({spelled} AS TIMESTAMPTZ)) AS TIMESTAMP) END")


def hash_score(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967295.0::DOUBLE)"


def lexicon_score(text: str) -> str:
    good, bad = (f"len(list_filter(string_split_regex({text}, '[\\t-\\r ]+'), lambda w: w IN {some}))"
                 for some in (POSITIVE, NEGATIVE))
    return f"coalesce(CAST({good} AS DOUBLE) / nullif({good} + {bad}, 0), 0.5)"


def markup_text(html: str) -> str:
    """Text of a fragment: no comments, scripts, styles or tags; entities decoded."""
    out = html
    for pattern in ("<!--.*?-->", "<script.*?</script>", "<style.*?</style>", "<[^>]*>"):
        out = f"regexp_replace({out}, '{pattern}', '', 'gs')"
    for entity, character in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"),
                              ("gt", ">"), ("nbsp", " "), ("#39", "''"), ("amp", "&")):
        out = f"regexp_replace({out}, '&{entity};?', '{character}', 'g')"
    return rf"regexp_replace({out}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def page_title(html: str) -> str:
    return (f"CASE WHEN {html} LIKE '%<h1>%' THEN "
            + markup_text(f"regexp_extract({html}, '<h1>(.*?)</h1>', 1, 's')")
            + " ELSE 'No title found' END")


def page_text(html: str) -> str:
    return (f"CASE WHEN {html} LIKE '%<article>%' THEN "
            + markup_text(f"regexp_extract({html}, '<article>(.*?)</article>', 1, 's')")
            + " ELSE 'No content found' END")


DERIVED = VIEWS | {
    "page_articles": f"""
        SELECT {page_title('html')} AS title, {page_text('html')} AS text,
               '2024-03-01T00:00:00+00:00' AS published, url, 'captured' AS source
        FROM pages""",
    "grouped_users": """
        SELECT *, CASE WHEN age >= 20 AND age < 25 THEN '20-25'
                       WHEN age >= 25 AND age < 35 THEN '25-35'
                       WHEN age >= 35 AND age < 45 THEN '35-45'
                       ELSE '45 and older' END AS age_group
        FROM users WHERE age IS NOT NULL""",
    "genre_means": """
        SELECT occupation, age_group, genre, avg(rating) AS avg_rating, count(*) AS rating_count
        FROM ratings r JOIN item_genres g ON r.item_id = g.movie_id
                       JOIN grouped_users u ON r.user_id = u.user_id
        GROUP BY 1, 2, 3""",
    "ranked_genres": """
        SELECT *, row_number() OVER (PARTITION BY occupation, age_group
                  ORDER BY avg_rating DESC, rating_count DESC, genre) AS rank
        FROM genre_means""",
    "top_items": """
        SELECT title, avg_rating, rating_count, item_id
        FROM (SELECT item_id, count(*) AS rating_count, avg(rating) AS avg_rating
              FROM ratings GROUP BY item_id HAVING count(*) >= 35)
        JOIN items ON item_id = movie_id
        ORDER BY avg_rating DESC, rating_count DESC, item_id LIMIT 20""",
    "dated": f"""
        SELECT title, text, {iso_timestamp('published')} AS published, url, source
        FROM articles""",
    "distinct_articles": """
        SELECT * EXCLUDE (copy) FROM (
            SELECT *, row_number() OVER (PARTITION BY title, text
                      ORDER BY published NULLS LAST, url, source) AS copy FROM dated)
        WHERE copy = 1""",
    "processed": f"""
        SELECT * FROM (SELECT *, {clean('title')} AS title_processed,
                              {clean('text')} AS text_processed FROM distinct_articles)
        WHERE length(title_processed) > 0 AND length(text_processed) > 0""",
    "scored": f"""
        SELECT source, title,
               {hash_score("concat_ws(' ', title_processed, text_processed)")} AS sentiment_score,
               'HDFC' AS ticker, md5(concat_ws(' ', title_processed, text_processed)) AS digest
        FROM processed""",
    "stored": f"""
        SELECT concat('{RUN_KEY}', lpad(CAST(row_number() OVER (
                   ORDER BY source NULLS FIRST, ticker, title NULLS FIRST, sentiment_score)
                   AS VARCHAR), 12, '0')) AS id,
               source, ticker, title, sentiment_score, TIMESTAMP '{RUN_TIME}' AS created_at
        FROM scored""",
    "stored_neutral": f"""
        SELECT concat('{RUN_KEY}', lpad(CAST(row_number() OVER (
                   ORDER BY source NULLS FIRST, title NULLS FIRST) AS VARCHAR), 12, '0')) AS id,
               source, 'HDFC' AS ticker, title, 0.5::DOUBLE AS sentiment_score,
               TIMESTAMP '{RUN_TIME}' AS created_at
        FROM articles""",
    "two_runs": f"""
        SELECT * FROM stored
        UNION ALL SELECT replace(id, '20240302', '20240301'), source, ticker, title, sentiment_score,
                         created_at - INTERVAL 1 DAY FROM stored""",
    "page_records": f"""
        SELECT {page_title("coalesce(html, '')")} AS title, {page_text("coalesce(html, '')")} AS text, url,
               CASE WHEN html IS NULL THEN 'failed'
                    WHEN html LIKE '%<h1>%' OR html LIKE '%<article>%' THEN 'ok' ELSE 'no_content' END AS status
        FROM pages_damaged""",
    "clean_records": f"""
        SELECT * FROM (SELECT *, {clean('title')} AS title_processed, {clean('text')} AS text_processed
                       FROM page_records WHERE status <> 'failed')
        WHERE length(title_processed) > 0 AND length(text_processed) > 0""",
    "tagged": """
        SELECT a.*, ticker FROM articles a JOIN tickers ON contains(a.text, ticker)""",
    "newest": f"""
        SELECT ticker, url, published, CAST(row_number() OVER (PARTITION BY ticker
                   ORDER BY published DESC NULLS LAST, url, title, text) AS INT) AS position
        FROM (SELECT title, text, url, ticker, {iso_timestamp('published')} AS published
              FROM tagged)""",
}


def pairs_of(ratings: str, item: int | str) -> str:
    return f"""
        SELECT t.user_id, t.rating AS target_rating, o.item_id AS other_item_id,
               o.rating AS other_rating
        FROM {ratings} t JOIN {ratings} o ON t.user_id = o.user_id
        WHERE t.item_id = {item} AND o.item_id <> {item}"""


PEARSON = ("CASE WHEN isnan(corr(target_rating, other_rating)) THEN NULL "
           "ELSE corr(target_rating, other_rating) END")
COSINE = ("sum(target_rating * other_rating) / "
          "(sqrt(sum(target_rating * target_rating)) * sqrt(sum(other_rating * other_rating)))")


def metrics_of(ratings: str, item: int | str, score: str) -> str:
    return f"""
        SELECT other_item_id, {score} AS score, count(*) AS strength
        FROM ({pairs_of(ratings, item)}) GROUP BY other_item_id"""


def similar_to(ratings: str, items: str, item: int | str, score: str, min_common: int,
               threshold: float, top_n: int = 10) -> str:
    return f"""
        SELECT title, round(score, 9) AS score, strength
        FROM ({metrics_of(ratings, item, score)}) JOIN {items} ON other_item_id = movie_id
        WHERE strength >= {min_common} AND score >= {threshold}
        ORDER BY round(score, 9) DESC, strength DESC, other_item_id LIMIT {top_n}"""


def all_pairs(score: str, threshold: float, ratings: str = "ratings_dense", min_common: int = 10) -> str:
    return f"""
        SELECT item_a, item_b, round(score, 9) AS score, strength FROM (
            SELECT a.item_id AS item_a, b.item_id AS item_b, {score} AS score,
                   count(*) AS strength
            FROM {ratings} a JOIN {ratings} b
              ON a.user_id = b.user_id AND a.item_id < b.item_id
            GROUP BY 1, 2)
        WHERE strength >= {min_common} AND score >= {threshold}"""


PAIR_COSINE = "sum(a.rating * b.rating) / (sqrt(sum(a.rating ^ 2)) * sqrt(sum(b.rating ^ 2)))"
PAIR_PEARSON = "CASE WHEN isnan(corr(a.rating, b.rating)) THEN NULL ELSE corr(a.rating, b.rating) END"
TOP_PAIRS = "ORDER BY round(score, 9) DESC, strength DESC, item_a, item_b LIMIT 50"

LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def wide_profile() -> str:
    return " UNION ALL ".join(f"""
        SELECT '{name}' AS column_name, count(*) AS row_count, count(*) - count({name}) AS null_count,
               count(DISTINCT {name}) + (count(*) > count({name}))::BIGINT AS distinct_count,
               count(*) - count(DISTINCT {name}) - (count(*) > count({name}))::BIGINT AS duplicates
        FROM lineitem""" for name in LINE_COLUMNS)


GENRE_COLUMNS = "occupation, age_group, genre, avg_rating, rating_count, rank"

QUERIES = {
    # ratings
    "scan_ratings": """
        SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS item_id, rating,
               CAST(epoch(o_orderdate) AS INT) AS timestamp FROM order_lines""",
    "scan_items": "SELECT CAST(movie_id AS INT) AS movie_id, title, "
                  "'01-Jan-1995' AS release_date, CAST(NULL AS VARCHAR) AS video_release_date, "
                  "concat('https://example.org/', p_brand) AS imdb_url, 0 AS unknown, {flags} "
                  "FROM items JOIN part ON movie_id = p_partkey",
    "scan_users": """
        SELECT CAST(user_id AS INT) AS user_id, age, gender, occupation,
               lpad(CAST(user_id AS VARCHAR), 8, '0') AS zip_code FROM users""",
    "occupation_mean_age": """
        SELECT occupation, avg(age) AS mean_age FROM users GROUP BY occupation""",
    "occupation_mean_age_fmt": """
        SELECT occupation, printf('%s: %.1f', occupation, avg(age)) AS line
        FROM users GROUP BY occupation""",
    "item_rating_stats": """
        SELECT item_id, count(*) AS rating_count, avg(rating) AS avg_rating
        FROM ratings GROUP BY item_id""",
    "top_rated_items": "SELECT title, avg_rating, rating_count FROM top_items",
    "top_rated_items_fmt": """
        SELECT printf('%s: %.2f (%d ratings)', title, avg_rating, rating_count) AS line
        FROM top_items""",
    "age_group": "SELECT user_id, age, gender, occupation, age_group FROM grouped_users",
    "age_group_strict": """
        SELECT user_id, age, gender, occupation,
               CASE WHEN age < 20 THEN 'under 20' ELSE age_group END AS age_group
        FROM grouped_users""",
    "genre_melt": "SELECT movie_id, genre FROM item_genres",
    "genre_stats": "SELECT * FROM genre_means",
    "genre_by_demographic": f"SELECT {GENRE_COLUMNS} FROM ranked_genres WHERE rank = 1",
    "genre_topk": f"SELECT {GENRE_COLUMNS} FROM ranked_genres WHERE rank <= 3",
    "genre_by_demographic_fmt": """
        SELECT occupation, printf('  Age Group %-12s : %-12s (Avg Rating: %.2f, Count: %d)',
                                  age_group, genre, avg_rating, rating_count) AS line
        FROM ranked_genres WHERE rank = 1""",
    # similarity
    "title_search": """
        SELECT movie_id, title FROM items WHERE contains(lower(title), 'ring')""",
    "title_search_like": """
        SELECT movie_id, title FROM items WHERE lower(title) LIKE '%r_d%'""",
    "title_lookup": """
        SELECT min(movie_id) AS movie_id, title FROM items
        WHERE title = 'small ring' GROUP BY title""",
    "paired_ratings": f"""
        SELECT user_id, round(target_rating, 9) AS target_rating, other_item_id,
               round(other_rating, 9) AS other_rating
        FROM ({pairs_of('ratings_dense', 1)})""",
    "pair_metrics": f"""
        SELECT other_item_id, round(score, 9) AS score, strength
        FROM ({metrics_of('ratings_dense', 1, PEARSON)})""",
    "pair_metrics_repeated": f"""
        SELECT other_item_id, round(score, 9) AS score, strength
        FROM ({metrics_of('ratings_repeated', 1, PEARSON)})""",
    "similarity_stats": f"""
        SELECT CAST(sum(strength) AS BIGINT) AS total_pairs, count(*) AS total_compared,
               count(score) AS valid_comparisons, round(avg(score), 9) AS avg_similarity,
               min(strength) AS min_common_users, max(strength) AS max_common_users
        FROM ({metrics_of('ratings_dense', 1, PEARSON)})""",
    "item_similarity": similar_to("ratings_dense", "items_dense", 1, PEARSON, 10, 0.05),
    "item_similarity_fmt": "SELECT printf('%-50s score: %-50s strength: %d', title, "
                           "CAST(score AS VARCHAR), strength) AS line FROM ("
                           + similar_to("ratings_dense", "items_dense", 1, PEARSON, 10, 0.05) + ")",
    "item_similarity_cosine": similar_to("ratings_dense", "items_dense", 1, COSINE, 10, 0.8),
    "item_similarity_deduped": similar_to("ratings_dense", "items_dense", 1, PEARSON, 10, 0.05),
    "all_pairs_similarity": f"{all_pairs(PAIR_COSINE, 0.8)} {TOP_PAIRS}",
    "all_pairs_similarity_split": f"{all_pairs(PAIR_COSINE, 0.8)} {TOP_PAIRS}",
    "all_pairs_similarity_blocks": f"{all_pairs(PAIR_COSINE, 0.8)} {TOP_PAIRS}",
    "all_pairs_similarity_prefix": f"{all_pairs(PAIR_COSINE, 0.8)} {TOP_PAIRS}",
    "all_pairs_similarity_any": f"{all_pairs(PAIR_COSINE, 0.9, 'ratings_single', 0)} {TOP_PAIRS}",
    "all_pairs_similarity_sparse": all_pairs(PAIR_COSINE, 0.5, "ratings_single", 3),
    "all_pairs_similarity_strict": f"{all_pairs(PAIR_COSINE, 0.8, min_common=50)} {TOP_PAIRS}",
    "all_pairs_pearson": all_pairs(PAIR_PEARSON, 0.0512345),
    # articles
    "article_title": f"SELECT url, {page_title('html')} AS title FROM pages",
    "article_preview": "SELECT url, substr(title, 1, 50) AS title FROM page_articles",
    "article_sites": """
        SELECT a.title, a.text, a.url,
               CASE page_id % 3 WHEN 0 THEN 'yourstory' WHEN 1 THEN 'finshots' ELSE 'other' END AS source,
               CASE page_id % 4 WHEN 0 THEN '2024-01-02T03:04:05+00:00' WHEN 1 THEN '2024-01-05T00:00:00'
                                ELSE a.published END AS published
        FROM pages p JOIN page_articles a ON a.url = p.url""",
    "article_extract": "SELECT * FROM page_articles",
    "article_quarantine": """
        SELECT url, 'captured' AS source,
               CASE WHEN html IS NULL THEN 'failed' ELSE 'no_content' END AS status
        FROM pages_damaged
        WHERE html IS NULL OR NOT (html LIKE '%<h1>%' OR html LIKE '%<article>%')""",
    "article_published": f"""
        SELECT url, coalesce({iso_timestamp('published')},
                             TIMESTAMP '2024-03-01 00:00:00') AS published FROM articles""",
    "article_union": "SELECT title, text, published, url, source FROM articles "
                     "UNION ALL SELECT title, text, published, url, source FROM page_articles",
    "text_clean": f"SELECT doc_id, {clean('text')} AS text_processed FROM documents",
    "text_clean_pages": f"SELECT page_id, {clean('html')} AS text_processed FROM pages",
    "article_nonempty": f"""
        SELECT url, title_processed, text_processed FROM (
            SELECT url, {clean('title')} AS title_processed, {clean('text')} AS text_processed
            FROM articles)
        WHERE length(title_processed) > 0 AND length(text_processed) > 0""",
    "article_dedup": """
        SELECT title, text, published, url, source FROM (
            SELECT *, row_number() OVER (PARTITION BY title, text
                      ORDER BY published NULLS LAST, url, source) AS copy FROM articles)
        WHERE copy = 1""",
    "article_process": """
        SELECT title, text, strftime(published, '%Y-%m-%dT%H:%M:%S') AS published, url, source,
               title_processed, text_processed, title AS title_original, text AS text_original
        FROM processed""",
    "ticker_tag_table": "SELECT a.url, k.ticker FROM articles a JOIN keywords k ON contains(a.text, k.ticker)",
    "ticker_tag": "SELECT url, ticker FROM tagged",
    "latest_per_ticker": "SELECT * FROM newest WHERE position <= 5",
    "latest_per_ticker_5000": "SELECT * FROM newest WHERE position <= 5000",
    "article_dedup_by_ticker": """
        SELECT url, ticker FROM (
            SELECT *, row_number() OVER (PARTITION BY title, text, ticker
                      ORDER BY published NULLS LAST, url, source) AS copy FROM tagged)
        WHERE copy = 1""",
    "article_dedup_dated": "SELECT url, published FROM distinct_articles",
    "article_dedup_by_ticker_dated": """
        SELECT url, ticker, published FROM (
            SELECT d.*, ticker, row_number() OVER (PARTITION BY d.title, d.text, ticker
                      ORDER BY d.published NULLS LAST, d.url, d.source) AS copy
            FROM dated d JOIN tickers ON contains(d.text, ticker))
        WHERE copy = 1""",
    # sentiment
    "sentiment_score": "SELECT source, title, sentiment_score, ticker FROM scored",
    "sentiment_lexicon": f"""
        SELECT source, title, {lexicon_score("concat_ws(' ', title_processed, text_processed)")}
               AS sentiment_score, 'HDFC' AS ticker FROM processed""",
    "article_pipeline": f"""
        SELECT 'captured' AS source, title, 'HDFC' AS ticker,
               {lexicon_score("concat_ws(' ', title_processed, text_processed)")} AS sentiment_score
        FROM (SELECT DISTINCT title, text, title_processed, text_processed FROM clean_records)""",
    "article_pipeline_by_ticker": f"""
        SELECT 'captured' AS source, title, ticker,
               {lexicon_score("concat_ws(' ', title_processed, text_processed)")} AS sentiment_score
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY url, title, text) AS position
              FROM (SELECT title, text, title_processed, text_processed, ticker, min(url) AS url
                    FROM clean_records JOIN tickers ON contains(text, ticker) GROUP BY ALL))
        WHERE position <= 5""",
    "article_pipeline_pages": """
        SELECT s.status, count(r.status) AS pages
        FROM (VALUES ('ok'), ('no_content'), ('failed')) s(status) LEFT JOIN page_records r USING (status)
        GROUP BY 1""",
    "sentiment_fallback": """
        SELECT source, title, CASE WHEN digest LIKE '00%' THEN 0.5::DOUBLE
                                   ELSE sentiment_score END AS sentiment_score, ticker
        FROM scored""",
    "sentiment_store": "SELECT * FROM stored",
    "sentiment_page": """
        SELECT source, ticker, title, sentiment_score, created_at FROM stored
        ORDER BY created_at DESC, id LIMIT 100 OFFSET 50""",
    "sentiment_store_neutral": "SELECT * FROM stored_neutral",
    "sentiment_store_day": f"""
        SELECT *, strftime(created_at, '%Y-%m-%d') AS run_date FROM two_runs
        WHERE created_at < TIMESTAMP '{RUN_TIME}'""",
    "sentiment_page_deep": """
        SELECT * FROM two_runs
        ORDER BY created_at DESC, id LIMIT 40 OFFSET (SELECT count(*) - 20 FROM stored)""",
    "sentiment_page_after": """
        SELECT * FROM two_runs
        WHERE created_at < (SELECT max(created_at) FROM two_runs) OR id > (
            SELECT id FROM stored ORDER BY id LIMIT 1 OFFSET 99)
        ORDER BY created_at DESC, id LIMIT 30""",
    # checks
    "dq_rules": """
        SELECT false AS all_ok, count(*) = count(item_id + rating) AS null_check,
               count(*) FILTER (rating < 0 OR rating > 5) = 0 AS rating_range,
               count(DISTINCT item_id) = count(*) AS unique_movies
        FROM ratings""",
    "dq_rules_stats": """
        SELECT ok AND ranged AND single AS all_ok, ok AS null_check, ranged AS rating_range,
               single AS unique_movies
        FROM (SELECT count(*) = count(item_id + rating) AS ok,
                     count(*) FILTER (rating < 0 OR rating > 5) = 0 AS ranged,
                     count(DISTINCT item_id) = count(*) AS single
              FROM (SELECT item_id, avg(rating) AS rating FROM ratings GROUP BY item_id))""",
    "dq_profile": """
        SELECT 'user_id' AS column_name, count(*) AS row_count,
               count(*) - count(user_id) AS null_count,
               count(DISTINCT user_id) AS distinct_count,
               count(*) - count(DISTINCT user_id) AS duplicates FROM users
        UNION ALL
        SELECT 'age', count(*), count(*) - count(age), count(DISTINCT age) + 1,
               count(*) - count(DISTINCT age) - 1 FROM users
        UNION ALL
        SELECT 'gender', count(*), count(*) - count(gender), NULL, NULL FROM users
        UNION ALL
        SELECT 'occupation', count(*), count(*) - count(occupation), NULL, NULL FROM users""",
    "dq_rules_nan": """
        SELECT false AS all_ok, count(*) FILTER (item_id % 10 = 0) = 0 AS null_check, true AS rating_range,
               count(DISTINCT item_id) = count(*) AS unique_movies
        FROM ratings""",
    "dq_profile_wide": wide_profile(),
    "run_metrics_store": """
        SELECT * FROM (VALUES ('items', 'success', (SELECT count(*) FROM items), true, false),
                              ('ratings', 'success', (SELECT count(*) FROM ratings), true, false),
                              ('again', 'failed', NULL, true, true))
                      r(task_id, status, rows, timed, explained)""",
    "run_metrics": """
        SELECT task_id, start_time, end_time,
               date_diff('microsecond', start_time, end_time) / 1e6 AS duration,
               'success' AS status, CAST(NULL AS VARCHAR) AS error FROM run_log""",
}


def bundle_sql() -> str:
    target = "(SELECT min(movie_id) FROM items WHERE title = 'small ring')"
    similar = similar_to("ratings", "items", target, COSINE, 2, 0.5)
    return f"""
        SELECT CAST(json_object(
            'top_movies', (SELECT to_json(list({{'title': title, 'avg_rating': round(avg_rating, 9),
                    'rating_count': rating_count}}
                    ORDER BY avg_rating DESC, rating_count DESC, title)) FROM top_items),
            'genre_analysis', (SELECT to_json(list({{'occupation': occupation,
                    'age_group': age_group, 'genre': genre, 'avg_rating': round(avg_rating, 9),
                    'rating_count': rating_count, 'rank': rank}}
                    ORDER BY occupation, age_group)) FROM ranked_genres WHERE rank = 1),
            'occupation_age_analysis', json_object('occupation_stats', (
                SELECT to_json(list({{'occupation': occupation, 'mean_age': round(mean_age, 9)}}
                    ORDER BY occupation))
                FROM (SELECT occupation, avg(age) AS mean_age FROM users GROUP BY occupation))),
            'movie_similarity', (SELECT to_json(coalesce(list({{'title': title, 'score': score,
                    'strength': strength}} ORDER BY score DESC, strength DESC, title), []))
                    FROM ({similar}))
        ) AS VARCHAR) AS document"""


def with_views(sql: str) -> str:
    """Put the views the statement uses, directly or through others, in front of it."""
    needed, open_texts = set(), [sql]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in words & DERIVED.keys() - needed:
            needed.add(name)
            open_texts.append(DERIVED[name])
    views = [f"{name} AS ({text})" for name, text in DERIVED.items() if name in needed]
    return f"WITH {', '.join(views)} {sql}" if views else sql


def oracle_sql() -> dict[str, str]:
    from tallyloom import schemas
    from tallyloom.plans.fixtures import ITEM_WORDS

    flags = [f"{word} AS {genre}" for word, genre in zip(ITEM_WORDS, schemas.GENRES)]
    flags += [f"CAST(p_type = '{kind}' AS INT) AS {genre}"
              for kind, genre in zip(("ECONOMY", "SMALL"), schemas.GENRES[len(ITEM_WORDS):])]
    small_ring = similar_to("ratings", "items", "(SELECT min(movie_id) FROM items WHERE title = 'small ring')",
                            COSINE, 2, 0.5)
    statements = QUERIES | {
        "result_bundle": bundle_sql(), "result_bundle_written": bundle_sql(),
        "report_genre_analysis": QUERIES["genre_by_demographic"], "report_movie_similarity": small_ring,
        "report_tables": f"""
            SELECT 'top_movies' AS report, count(*) AS rows FROM top_items
            UNION ALL SELECT 'genre_analysis', count(*) FROM ranked_genres WHERE rank = 1
            UNION ALL SELECT 'occupation_age_analysis', count(DISTINCT coalesce(occupation, '')) FROM users
            UNION ALL SELECT 'movie_similarity', count(*) FROM ({small_ring})"""}
    statements["scan_items"] = QUERIES["scan_items"].replace("{flags}", ", ".join(flags))
    return {name: with_views(sql) for name, sql in statements.items()}

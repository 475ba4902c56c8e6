"""The same results as plain SQL over the given tables, for DuckDB."""

from postmill.checks import spark_queries
from postmill.operators.search import enough_sides

BASE = r"""
base AS (
  SELECT 'p' || CAST(e.event_id AS STRING) AS post_id,
         e.event_type AS subreddit,
         '  ' || e.event_type || chr(9) || ' post ' || CAST(e.event_id AS STRING) || ' ' AS title,
         CASE WHEN e.event_id % 11 = 0 THEN '[removed]'
              WHEN e.event_id % 11 = 1 THEN ''
              WHEN e.event_id % 11 = 2 THEN ' [deleted] '
              ELSE d.text END AS selftext,
         CASE WHEN e.user_id % 10 = 0 THEN '[deleted]'
              ELSE 'u' || CAST(e.user_id AS STRING) END AS author,
         CAST(FLOOR(e.value) AS BIGINT) AS score,
         CAST(e.event_id % 129 AS DOUBLE) / 128 AS upvote_ratio,
         CAST(regexp_extract(e.props, '[0-9]+', 0) AS BIGINT) AS num_comments,
         e.ts AS created_utc,
         'https://example.org/' || CAST(e.event_id AS STRING) AS url,
         'https://example.org/c/' || CAST(e.event_id AS STRING) AS permalink,
         CASE WHEN d.doc_id IS NULL THEN 'False' ELSE 'True' END AS is_self,
         CASE WHEN e.event_id % 3 = 0 THEN NULL
              ELSE ' ' || upper(d.lang) || ' ' END AS link_flair_text,
         CASE WHEN l.toxic = 1 THEN 'True' ELSE 'False' END AS over_18,
         CASE WHEN e.event_id % 13 = 0 THEN 'None'
              WHEN e.event_id % 5 = 0 THEN 'True' ELSE 'False' END AS spoiler,
         CAST(e.event_id % 4 AS BIGINT) AS awards_received,
         e.event_id
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id
  LEFT JOIN labels l ON l.doc_id = e.event_id)"""

BRONZE = BASE + r""",
bronze AS (
  SELECT * EXCLUDE (event_id), TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp FROM base
  UNION ALL
  SELECT * EXCLUDE (event_id) REPLACE (score + 1 AS score), TIMESTAMP '2024-02-02 00:00:00'
  FROM base WHERE event_id % 7 = 0)"""

LATEST = BRONZE + r""",
latest AS (
  SELECT * FROM bronze
  QUALIFY row_number() OVER (
    PARTITION BY post_id
    ORDER BY ingestion_timestamp DESC NULLS LAST, score DESC NULLS LAST, num_comments DESC NULLS LAST,
             upvote_ratio DESC NULLS LAST, title ASC NULLS FIRST) = 1)"""


def _cleaned(source: str) -> str:
    return rf""",
tidied AS (
  SELECT * REPLACE (
    trim(regexp_replace(title, '[\x00-\x1f\x7f]', '', 'g')) AS title,
    trim(regexp_replace(selftext, '[\x00-\x1f\x7f]', '', 'g')) AS selftext)
  FROM {source}),
cleaned AS (
  SELECT * REPLACE (
    CASE WHEN selftext IN ('', '[removed]', '[deleted]') THEN NULL ELSE selftext END AS selftext,
    CASE WHEN author = '[deleted]' THEN NULL ELSE author END AS author,
    CASE WHEN link_flair_text IS NULL THEN 'unflaired' ELSE lower(trim(link_flair_text)) END AS link_flair_text)
  FROM tidied),
typed AS (
  SELECT * REPLACE (
    TRY_CAST(is_self AS BOOLEAN) AS is_self,
    TRY_CAST(over_18 AS BOOLEAN) AS over_18,
    TRY_CAST(spoiler AS BOOLEAN) AS spoiler)
  FROM cleaned),
silver AS (
  SELECT *,
    CAST(length(title) AS INT) AS title_length,
    CAST(CASE WHEN selftext IS NULL THEN 0 ELSE length(selftext) END AS INT) AS selftext_length,
    selftext IS NOT NULL AS has_selftext,
    CASE WHEN selftext IS NULL THEN title ELSE concat_ws(' ', title, selftext) END AS content,
    CAST(created_utc AS DATE) AS created_date,
    CAST(hour(created_utc) AS INT) AS created_hour,
    CAST(dayofweek(created_utc) + 1 AS INT) AS day_of_week
  FROM typed)"""


# The steps over all bronze rows, and over the latest copies only.
STEPS = BRONZE + _cleaned("bronze")
SILVER = LATEST + _cleaned("latest")

SUMMARY = """
  SELECT subreddit, count(post_id) AS total_posts, avg(score) AS avg_score,
         round(stddev_samp(score), 6) AS stddev_score, max(score) AS max_score,
         avg(num_comments) AS avg_comments, max(num_comments) AS max_comments,
         avg(upvote_ratio) AS avg_upvote_ratio, count(DISTINCT author) AS unique_authors,
         avg(title_length) AS avg_title_length,
         CAST(sum(CASE WHEN over_18 THEN 1 ELSE 0 END) AS BIGINT) AS nsfw_count
  FROM silver GROUP BY subreddit"""

DAILY = """
  SELECT subreddit, created_date, count(post_id) AS post_count, avg(score) AS avg_score,
         avg(num_comments) AS avg_comments, avg(upvote_ratio) AS avg_upvote_ratio,
         CAST(sum(score) AS BIGINT) AS total_score, CAST(sum(num_comments) AS BIGINT) AS total_comments,
         avg(title_length) AS avg_title_length, avg(selftext_length) AS avg_selftext_length,
         CAST(sum(CASE WHEN has_selftext THEN 1 ELSE 0 END) AS BIGINT) AS text_posts,
         CAST(sum(CASE WHEN NOT has_selftext THEN 1 ELSE 0 END) AS BIGINT) AS link_posts
  FROM silver GROUP BY subreddit, created_date"""

HOURLY = """
  SELECT subreddit, created_hour, day_of_week, count(post_id) AS post_count,
         avg(score) AS avg_score, avg(num_comments) AS avg_comments
  FROM silver GROUP BY subreddit, created_hour, day_of_week"""

AUTHORS = """
  SELECT subreddit, author, count(post_id) AS post_count, avg(score) AS avg_score,
         CAST(sum(score) AS BIGINT) AS total_score, avg(num_comments) AS avg_comments
  FROM silver WHERE author IS NOT NULL GROUP BY subreddit, author"""

RANKED = SILVER + """,
ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY subreddit ORDER BY score DESC NULLS LAST, post_id) AS INT) AS rank
  FROM silver)"""

TOP_POSTS = """
  SELECT subreddit, rank, post_id, title, author, score, num_comments, upvote_ratio,
         created_utc, permalink, content
  FROM ranked WHERE rank <= 50"""

PAGED = BASE + """,
paged AS (
  SELECT *, CAST(floor(event_id / 100) AS BIGINT) AS page_no FROM base),
flat AS (
  SELECT * EXCLUDE (event_id) REPLACE (nullif(selftext, '') AS selftext),
         TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp,
         CAST(row_number() OVER (PARTITION BY subreddit, page_no ORDER BY event_id) - 1 AS INT) AS position
  FROM paged),
capped AS (
  SELECT * FROM flat
  QUALIFY row_number() OVER (PARTITION BY subreddit ORDER BY page_no, position) <= 500)"""


# Pages that are no JSON or no listing, and posts without a title.
REJECTED = """
  SELECT DISTINCT subreddit, page_no, CASE WHEN page_no % 3 = 0 THEN 'page' ELSE 'listing' END AS reason, 1::BIGINT AS rejected
  FROM paged WHERE page_no % 3 = 0 OR page_no % 7 IN (1, 2, 3)
  UNION ALL
  SELECT subreddit, page_no, 'incomplete', count(*) FROM paged
  WHERE page_no % 3 <> 0 AND page_no % 7 NOT IN (1, 2, 3) AND selftext IS NULL GROUP BY subreddit, page_no"""


def _weights(name: str, source: str, key: str, text: str) -> str:
    """CTEs of the hashing encoder: one row per text and non-empty bucket."""
    return f""",
{name}_tokens AS (
  SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^a-z0-9]+')) AS token FROM {source}),
{name}_counts AS (
  SELECT {key}, CAST(CAST('0x' || substring(md5(token), 1, 7) AS BIGINT) % 64 AS INT) AS dim,
         count(*) AS times
  FROM {name}_tokens WHERE token <> '' GROUP BY ALL),
{name} AS (
  SELECT {key}, dim, CAST(CAST(times / sqrt(CAST(sum(times * times) OVER (PARTITION BY {key}) AS DOUBLE))
         AS FLOAT) AS DOUBLE) AS weight
  FROM {name}_counts)"""


CANDIDATES = (
    RANKED
    + """,
candidates AS (
  SELECT post_id, subreddit, title, rank AS place, content AS document
  FROM ranked WHERE rank <= 100)"""
    + _weights("doc", "candidates", "post_id", "document")
)

SEARCHED = (
    CANDIDATES
    + """,
question AS (SELECT 0 AS id, '{text}' AS words)""".format(text=spark_queries.QUERY_TEXT)
    + _weights("ask", "question", "id", "words")
    + """,
scored AS (
  SELECT d.post_id,
         sum(d.weight * coalesce(a.weight, 0))
         / (sqrt(sum(d.weight * d.weight)) * (SELECT sqrt(sum(weight * weight)) FROM ask)) AS similarity
  FROM doc d LEFT JOIN ask a ON a.dim = d.dim GROUP BY d.post_id),
found AS (
  SELECT c.*, s.similarity,
         CAST(row_number() OVER (ORDER BY round(s.similarity, 9) DESC, c.post_id) AS INT) AS rank
  FROM scored s JOIN candidates c ON c.post_id = s.post_id)"""
)

# The best post of each group as query.
SEARCHED_BY_POST = (
    CANDIDATES
    + """,
sizes AS (SELECT post_id, sqrt(sum(weight * weight)) AS size FROM doc GROUP BY post_id),
pairs AS (
  SELECT q.post_id AS query_id, d.post_id, sum(d.weight * coalesce(a.weight, 0)) AS product
  FROM candidates q CROSS JOIN doc d LEFT JOIN doc a ON a.post_id = q.post_id AND a.dim = d.dim
  WHERE q.place = 1 GROUP BY q.post_id, d.post_id),
scored AS (
  SELECT p.query_id, p.post_id, p.product / (d.size * a.size) AS similarity
  FROM pairs p JOIN sizes d ON d.post_id = p.post_id JOIN sizes a ON a.post_id = p.query_id),
found AS (
  SELECT s.query_id, c.*, s.similarity, CAST(row_number() OVER (
    PARTITION BY s.query_id ORDER BY round(s.similarity, 9) DESC, c.post_id) AS INT) AS rank
  FROM scored s JOIN candidates c ON c.post_id = s.post_id)"""
)

FIRST = """
first AS (SELECT CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS target FROM embeddings),
pool AS (
  SELECT e.*, list_cosine_similarity(CAST(embedding AS DOUBLE[]), target) AS raw FROM embeddings e, first)"""


def _nearest(where: str = "true") -> str:
    return f"""
  SELECT vec_id, label, round(raw, 6) AS similarity, round(1 - least(raw, 1), 6) AS distance,
         CAST(row_number() OVER (ORDER BY round(raw, 9) DESC, vec_id) AS INT) AS rank
  FROM pool WHERE {where} ORDER BY rank LIMIT 5"""


PLANES = """,
coordinates AS (
  SELECT vec_id, unnest(embedding) AS value, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
sides AS (
  SELECT vec_id, b, sum(CAST(value AS DOUBLE)
           * CASE WHEN CAST('0x' || substring(md5(b || ':' || dim), 1, 1) AS INT) % 2 = 0 THEN 1 ELSE -1 END) >= 0
         AS side
  FROM coordinates, range({bits}) AS r(b) GROUP BY vec_id, b),
away AS (
  SELECT s.vec_id, count_if(s.side <> home.side) AS sides FROM sides s
  JOIN sides home ON home.b = s.b AND home.vec_id = (SELECT min(vec_id) FROM embeddings)
  GROUP BY s.vec_id),
near AS (SELECT vec_id FROM away WHERE sides <= {radius})""".format(
    bits=spark_queries.BUCKET_BITS, radius=enough_sides(spark_queries.BUCKET_BITS)
)

CENTROIDS = """
coordinates AS (
  SELECT label, unnest(embedding) AS value, generate_subscripts(embedding, 1) AS dim FROM embeddings),
means AS (SELECT label, dim, avg(CAST(value AS DOUBLE)) AS value FROM coordinates GROUP BY label, dim),
centroids AS (SELECT label AS query_id, list(value ORDER BY dim) AS target FROM means GROUP BY label),
scored AS (
  SELECT query_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), target) AS raw
  FROM centroids, embeddings)"""

UPSERTED = """
batch AS (SELECT vec_id * 2 AS vec_id, embedding, label + 100 AS label FROM embeddings),
merged AS (
  SELECT vec_id, embedding, label FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM batch)
  UNION ALL SELECT vec_id, embedding, label FROM batch),
parts AS (
  SELECT vec_id, CAST(label AS INT) AS label, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS dim,
         CAST(unnest(embedding) AS DOUBLE) AS weight
  FROM merged)"""

COUNTED = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql}) t"
    for name, sql in {
        "bronze": "SELECT * FROM bronze",
        "silver": "SELECT * FROM silver",
        "subreddit_daily_stats": DAILY,
        "subreddit_summary": SUMMARY,
        "hourly_activity": HOURLY,
        "top_posts": TOP_POSTS,
        "author_activity": AUTHORS,
    }.items()
)

WORDS = "words AS (SELECT doc_id AS post_id, text FROM documents)"
DOCUMENTS = """,
records AS (SELECT post_id, substring(content, 1, 2000) AS document FROM silver)"""

ORACLE = {
    "listing_flatten": f"WITH {PAGED} SELECT * FROM flat",
    "listing_rejects": f"""WITH {BASE} SELECT subreddit, count(*) AS rejected FROM base WHERE selftext IS NULL
        GROUP BY subreddit""",
    "listing_rejects_by_reason": f"""WITH {PAGED}
        SELECT subreddit, reason, CAST(sum(rejected) AS BIGINT) AS rejected FROM ({REJECTED}) r GROUP BY subreddit, reason""",
    "rejects_from_job_and_stream": f"WITH {PAGED} SELECT *, rejected AS with_source FROM ({REJECTED}) r",
    "bronze_from_job_and_stream": f"WITH {PAGED} SELECT * EXCLUDE (page_no, position, ingestion_timestamp) REPLACE ('https://reddit.com/c/' || substring(post_id, 2) AS permalink) FROM flat",
    "numeric_group_names": f"""WITH {LATEST} SELECT lpad(CAST(score % 20 AS STRING), 3, '0') AS subreddit,
        count(post_id) AS total_posts, max(score) AS max_score FROM latest GROUP BY ALL""",
    "channel_cap": f"WITH {PAGED} SELECT subreddit, post_id, page_no, position FROM capped",
    "listing_stream_ingest": f"WITH {PAGED} SELECT subreddit, post_id, title, created_utc FROM flat",
    "json_lines_scan": f"WITH {BRONZE} SELECT * FROM bronze",
    "bronze_append_merge": f"""WITH {BRONZE} SELECT *, CASE WHEN ingestion_timestamp = TIMESTAMP '2024-02-02 00:00:00'
        THEN 'seen again: ' || url END AS note FROM bronze""",
    "silver_partitioned_scan": f"WITH {SILVER} SELECT * FROM silver",
    "job_row_counts": f"WITH {RANKED} {COUNTED}",
    "dedup_removed": f"WITH {LATEST} SELECT (SELECT count(*) FROM bronze) - (SELECT count(*) FROM latest) AS removed",
    "project_columns": f"WITH {BRONZE} SELECT * FROM bronze",
    "dedup_latest": f"WITH {LATEST} SELECT * FROM latest",
    "clean_text": f"WITH {STEPS} SELECT post_id, ingestion_timestamp, title, selftext FROM cleaned",
    "nullify_sentinels": f"WITH {STEPS} SELECT post_id, ingestion_timestamp, selftext, author FROM cleaned",
    "normalize_flair": f"WITH {STEPS} SELECT post_id, ingestion_timestamp, link_flair_text FROM cleaned",
    "normalize_booleans": f"WITH {STEPS} SELECT post_id, ingestion_timestamp, is_self, over_18, spoiler FROM typed",
    "derive_columns": f"""WITH {STEPS} SELECT post_id, ingestion_timestamp, title_length, selftext_length,
        has_selftext, content, created_date, created_hour, day_of_week FROM silver""",
    "silver_posts": f"WITH {SILVER} SELECT * FROM silver",
    "silver_from_batches": f"WITH {SILVER} SELECT * FROM silver",
    "daily_stats_of_states": f"WITH {SILVER} {DAILY}",
    "summary_of_states": f"WITH {SILVER} {SUMMARY}",
    "author_activity_of_states": f"WITH {SILVER} {AUTHORS}",
    "subreddit_daily_stats": f"WITH {SILVER} {DAILY}",
    "subreddit_summary": f"WITH {SILVER} {SUMMARY}",
    "hourly_activity": f"WITH {SILVER} {HOURLY}",
    "author_activity": f"WITH {SILVER} {AUTHORS}",
    "top_posts": f"WITH {RANKED} {TOP_POSTS}",
    "top_posts_stored": f"WITH {RANKED} {TOP_POSTS}",
    "bronze_profile": f"""WITH {BRONZE} SELECT subreddit, count(*) AS count FROM bronze GROUP BY subreddit
        ORDER BY count DESC, subreddit LIMIT 20""",
    "silver_profile": f"""WITH {SILVER} SELECT subreddit, count(post_id) AS posts, round(avg(score), 1) AS avg_score,
        round(avg(title_length), 0) AS avg_title_len,
        CAST(sum(CASE WHEN has_selftext THEN 1 ELSE 0 END) AS BIGINT) AS text_posts
        FROM silver GROUP BY subreddit ORDER BY posts DESC, subreddit LIMIT 20""",
    "summary_report": f"WITH {SILVER} {SUMMARY} ORDER BY total_posts DESC, subreddit LIMIT 20",
    "embedding_candidates": f"WITH {RANKED} SELECT post_id, subreddit, title, content FROM ranked WHERE rank <= 100",
    "embed_text": f"""WITH {SILVER}{DOCUMENTS}{_weights("doc", "records", "post_id", "document")}
        SELECT doc.post_id, CAST(length(document) AS INT) AS document_length, dim, weight
        FROM doc JOIN records ON records.post_id = doc.post_id""",
    "embed_whole_text": f"WITH {WORDS}{_weights('doc', 'words', 'post_id', 'text')} SELECT post_id, dim, weight FROM doc",
    "vector_search": f"WITH {FIRST}{_nearest()}",
    "vector_search_filtered": f"WITH {FIRST}{_nearest(f'label = {spark_queries.SEARCHED_LABEL}')}",
    "vector_search_batch": f"""WITH {CENTROIDS}
        SELECT query_id, vec_id, round(raw, 6) AS similarity,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(raw, 9) DESC, vec_id) AS INT) AS rank
        FROM scored QUALIFY rank <= 5""",
    "vector_search_lsh": f"WITH {FIRST}{PLANES}{_nearest('vec_id IN (SELECT vec_id FROM near)')}",
    "vector_search_recall": f"""WITH {FIRST}{PLANES},
        best AS (SELECT vec_id FROM pool ORDER BY round(raw, 9) DESC, vec_id LIMIT 20)
        SELECT CAST(r.radius AS INT) AS radius, count(*) / 20 AS recall
        FROM range({spark_queries.BUCKET_BITS + 1}) AS r(radius) JOIN away ON away.sides <= r.radius
        JOIN best ON best.vec_id = away.vec_id GROUP BY r.radius""",
    "vector_search_index": f"WITH {FIRST}{_nearest()}",
    "vector_index_recall": """SELECT count(*) FILTER (vec_id % 100 = 0) AS queries, true AS recall_reached, true AS quarter_read
        FROM embeddings""",
    "vector_search_every_vector": """SELECT q.vec_id AS query_id, v.vec_id,
               round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS similarity,
               CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(
                   CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9) DESC, v.vec_id) AS INT) AS rank
        FROM embeddings q, embeddings v QUALIFY rank <= 3""",
    "vector_upsert": f"WITH {UPSERTED} SELECT vec_id, label, dim, weight FROM parts WHERE weight <> 0",
    "semantic_search": f"""WITH {SEARCHED} SELECT rank, post_id, document AS content, subreddit, title,
        round(similarity, 6) AS similarity, round(1 - least(similarity, 1), 6) AS distance FROM found WHERE rank <= 5""",
    "semantic_search_stored": f"""WITH {SEARCHED} SELECT rank, post_id, document AS content, subreddit, title,
        round(similarity, 6) AS similarity, round(1 - least(similarity, 1), 6) AS distance FROM found WHERE rank <= 20""",
    "semantic_search_batch": f"""WITH {SEARCHED_BY_POST} SELECT query_id, rank, post_id, document AS content, subreddit,
        title, round(similarity, 6) AS similarity, round(1 - least(similarity, 1), 6) AS distance FROM found WHERE rank <= 5""",
    "search_presentation": f"""WITH {SEARCHED} SELECT rank AS position, subreddit, title,
        round(similarity * 100, 1) AS match_percent, substring(document, 1, 1500) AS preview,
        'https://example.org/comments/' || post_id AS link FROM found WHERE rank <= 20""",
}

"""The registered queries as SQL over the plain test tables, for checking."""

from __future__ import annotations

from ..functions.lexicon import NEGATIVE_TERMS, POSITIVE_TERMS, STOP_WORDS
from .registry import FREQUENT_NEGATIVE, FREQUENT_POSITIVE, VECTOR_COSINE, VECTOR_DISTANCE


def _words(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


RAW = """
raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS show_id,
         nullif(o_orderstatus, 'P') AS type,
         c_name AS title,
         CASE c_mktsegment WHEN 'BUILDING' THEN n_name || ', ' || r_name
                           WHEN 'MACHINERY' THEN ''
                           WHEN 'FURNITURE' THEN NULL
                           WHEN 'AUTOMOBILE' THEN ' , ' || n_name
                           ELSE '  ' || n_name END AS country,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
              ELSE CAST(year(o_orderdate) + 19 AS VARCHAR) END AS release_year,
         nullif(o_orderpriority, '5-LOW') AS rating,
         CASE WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE ' ' || strftime(o_orderdate, '%B %-d, %Y') || ' ' END AS date_added,
         CASE o_orderstatus WHEN 'F' THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || ' min'
                            WHEN 'O' THEN 'about ' || CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || ' of 9'
                            ELSE 'unknown' END AS duration,
         c_mktsegment AS listed_in,
         o_orderpriority || ' order of ' || c_name AS description
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

PARSED = (
    RAW
    + """,
parsed AS (
  SELECT show_id AS content_id, title, type AS content_type,
         trim(string_split(country, ',')[1]) AS country,
         TRY_CAST(release_year AS INTEGER) AS release_year,
         rating,
         CAST(CAST(try_strptime(trim(date_added), '%B %d, %Y') AS DATE) AS VARCHAR) AS date_added,
         TRY_CAST(nullif(regexp_extract(duration, '([0-9]+)', 1), '') AS INTEGER) AS duration_value,
         listed_in, description
  FROM raw
)"""
)

CLEANED = (
    PARSED
    + """,
cleaned AS (
  SELECT *, CAST(substr(date_added, 1, 4) AS INTEGER) AS added_year, release_year >= 2020 AS is_recent
  FROM parsed
  WHERE country IS NOT NULL AND country <> '' AND release_year IS NOT NULL AND release_year >= 2015
)"""
)

AGG = (
    CLEANED
    + """,
agg AS (
  SELECT content_type, country, count(*) AS title_count, round(avg(release_year), 2) AS avg_release_year,
         min(release_year) AS min_release_year, max(release_year) AS max_release_year
  FROM cleaned GROUP BY content_type, country
)"""
)

DOCS = """
docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS content_id, lang AS content_type, source AS country,
         CASE WHEN source <> 'src0' THEN source || ' ' || CAST(doc_id AS VARCHAR) ELSE '' END AS title,
         CASE WHEN source <> 'src0' THEN source || ' ' || CAST(doc_id AS VARCHAR) || ' ' ELSE '' END
           || CASE WHEN lang <> 'en' THEN lang || ' ' ELSE '' END || text AS text
  FROM documents
)"""

NORMAL = (
    DOCS
    + """,
normal AS (
  SELECT content_id, content_type, country, title,
         trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS text
  FROM docs
),
tokenised AS (
  SELECT content_id, content_type, country, title, string_split(text, ' ') AS tokens
  FROM normal WHERE text <> ''
)"""
)

CONTENT = (
    NORMAL
    + f""",
kept AS (
  SELECT content_id, content_type, country, title,
         list_filter(tokens, lambda t: length(t) >= 3 AND NOT regexp_full_match(t, '[0-9]+')
                     AND t NOT IN ({_words(STOP_WORDS)})) AS tokens
  FROM tokenised
),
content AS (SELECT * FROM kept WHERE len(tokens) > 0)"""
)


def _scored(positive, negative) -> str:
    return (
        CONTENT
        + f""",
hits AS (
  SELECT *, CAST(len(list_filter(tokens, lambda t: t IN ({_words(positive)}))) AS BIGINT) AS positive_hits,
            CAST(len(list_filter(tokens, lambda t: t IN ({_words(negative)}))) AS BIGINT) AS negative_hits
  FROM content
),
points AS (
  SELECT *, CAST(sign(positive_hits - negative_hits) * floor(abs(positive_hits - negative_hits) / len(tokens) * 10000 + 0.5) AS BIGINT) / 10000 AS sentiment_score FROM hits
),
scored AS (
  SELECT *, CASE WHEN sentiment_score > 0.03 THEN 'positive' WHEN sentiment_score < -0.03 THEN 'negative'
                 ELSE 'neutral' END AS sentiment_label
  FROM points
)"""
    )


SCORED = _scored(POSITIVE_TERMS, NEGATIVE_TERMS)
FREQUENT = _scored(FREQUENT_POSITIVE, FREQUENT_NEGATIVE)

_TERM_TABLES = """,
occurrences AS (
  SELECT content_id, content_type, country, title, len(tokens) AS token_count,
         unnest(tokens) AS term, unnest(range(0, len(tokens))) AS position
  FROM content
),
tf AS (
  SELECT content_id, content_type, country, title, term, count(*) AS term_count, token_count,
         min(position) AS first_position
  FROM occurrences GROUP BY content_id, content_type, country, title, term, token_count
),
df AS (SELECT term, count(*) AS document_frequency FROM tf GROUP BY term),
tfidf AS (
  SELECT content_id, content_type, country, title, term, term_count, token_count, document_frequency, first_position,
         floor(CAST(term_count AS DOUBLE) / token_count
               * (ln(CAST((SELECT count(*) FROM content) + 1 AS DOUBLE) / (document_frequency + 1)) + 1)
               * 10000 + 0.5) / 10000 AS tfidf_score
  FROM tf JOIN df USING (term)
),
top_term AS (
  SELECT content_id, term AS top_tfidf_term, tfidf_score AS top_tfidf_score FROM tfidf
  QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY tfidf_score DESC, term) = 1
),
keyword AS (SELECT content_type, term AS keyword, count(*) AS title_mentions FROM tf GROUP BY content_type, term),
pairs AS (
  SELECT DISTINCT content_id, content_type, term || ' ' || follower AS bigram
  FROM (SELECT content_id, content_type, term,
               lead(term) OVER (PARTITION BY content_id ORDER BY position) AS follower FROM occurrences)
  WHERE follower IS NOT NULL
),
bigram AS (SELECT content_type, bigram, count(*) AS title_mentions FROM pairs GROUP BY content_type, bigram),
summary AS (
  SELECT content_type, term,
         floor(sum(CAST(floor(tfidf_score * 10000 + 0.5) AS BIGINT)) / count(*) + 0.5) / 10000 AS avg_tfidf,
         max(tfidf_score) AS max_tfidf, count(*) AS document_count
  FROM tfidf GROUP BY content_type, term
)"""

TERMS = CONTENT + _TERM_TABLES

PROFILE = (
    SCORED
    + _TERM_TABLES
    + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY term_count DESC, first_position) AS place FROM tf
),
profile AS (
  SELECT r.content_id, r.content_type, r.country, r.title, r.token_count, count(*) AS unique_token_count,
         floor(CAST(sum(r.term_count * length(r.term)) AS DOUBLE) / r.token_count * 100 + 0.5) / 100
           AS avg_token_length,
         max(CASE WHEN place = 1 THEN term END) AS dominant_term,
         string_agg(CASE WHEN place <= 5 THEN term END, ', ' ORDER BY place) AS term_preview,
         any_value(s.positive_hits) AS positive_hits, any_value(s.negative_hits) AS negative_hits,
         any_value(s.sentiment_score) AS sentiment_score, any_value(s.sentiment_label) AS sentiment_label
  FROM ranked r JOIN scored s USING (content_id)
  GROUP BY r.content_id, r.content_type, r.country, r.title, r.token_count
),
features AS (SELECT * FROM profile LEFT JOIN top_term USING (content_id)),
topic_rows AS (
  SELECT content_id, content_type, country, title, quality * 2 + toxic AS topic_cluster, dominant_term,
         top_tfidf_term, top_tfidf_score, sentiment_label, sentiment_score
  FROM features JOIN labels ON content_id = CAST(doc_id AS VARCHAR)
)"""
)

VECTORS = f"""
raw_vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, label, CAST(embedding AS DOUBLE[]) AS e,
         sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
  FROM embeddings
),
vectors AS (SELECT id, label, list_transform(e, lambda x: x / norm) AS u FROM raw_vectors WHERE norm > 0),
distances AS (
  SELECT a.id AS left_content_id, b.id AS right_content_id, a.label AS left_label, b.label AS right_label,
         list_distance(a.u, b.u) AS d
  FROM vectors a JOIN vectors b ON a.id < b.id
),
near_pairs AS (
  SELECT left_content_id, right_content_id, left_label, right_label,
         floor((1 - d * d / 2) * 10000 + 0.5) / 10000 AS cosine_similarity,
         floor(d * 10000 + 0.5) / 10000 AS embedding_distance
  FROM distances WHERE d < {VECTOR_DISTANCE}
),
all_pairs AS (SELECT * FROM near_pairs WHERE cosine_similarity >= {VECTOR_COSINE}),
nearest AS (
  SELECT * FROM all_pairs
  QUALIFY row_number() OVER (PARTITION BY left_content_id ORDER BY cosine_similarity DESC, right_content_id) <= 3
),
described AS (
  SELECT left_content_id, 'vector ' || left_content_id AS left_title, 'group ' || left_label AS left_content_type,
         left_label AS left_topic_cluster,
         right_content_id, 'vector ' || right_content_id AS right_title, 'group ' || right_label AS right_content_type,
         right_label AS right_topic_cluster, cosine_similarity, embedding_distance
  FROM nearest
)"""


def _column_profile(source: str, columns: list[str], numeric: tuple[str, ...], whole: tuple[str, ...] | None = None) -> str:
    """Profile of each column; with ``whole`` also the exact range of the columns named there."""
    parts = []
    for name in columns:
        low, high, mean = (
            (f"CAST(min({name}) AS DOUBLE)", f"CAST(max({name}) AS DOUBLE)", f"round(avg({name}), 4)")
            if name in numeric
            else ("CAST(NULL AS DOUBLE)",) * 3
        )
        exact = ""
        if whole is not None:
            least, largest = (f"CAST({way}({name}) AS VARCHAR)" if name in whole else "CAST(NULL AS VARCHAR)" for way in ("min", "max"))
            exact = f", {least} AS min_exact, {largest} AS max_exact"
        parts.append(
            f"""SELECT '{name}' AS "column",
  count(*) FILTER (WHERE {name} IS NULL OR trim(CAST({name} AS VARCHAR)) = '') AS null_count,
  floor(CAST(null_count AS DOUBLE) / count(*) * 100 * 100 + 0.5) / 100 AS null_pct,
  count(DISTINCT {name}) + CAST(count(*) > count({name}) AS BIGINT) AS distinct_count,
  {low} AS min, {high} AS max, {mean} AS mean{exact} FROM {source}"""
        )
    return "\nUNION ALL\n".join(parts)


PARSED_COLUMNS = [
    "content_id", "title", "content_type", "country", "release_year", "rating", "date_added", "duration_value",
    "listed_in", "description",
]
LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_PARSED_STATS = _column_profile("parsed", PARSED_COLUMNS, ("release_year", "duration_value"))
QUALITY = (
    PARSED
    + f""",
column_profile AS ({_PARSED_STATS}),
keys AS (SELECT count(*) AS total_rows, count(DISTINCT title) AS distinct_rows FROM parsed),
report AS (
  SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_rows,
         floor(CAST(total_rows - distinct_rows AS DOUBLE) / total_rows * 100 * 100 + 0.5) / 100 AS duplicate_pct
  FROM keys
),
quality AS (
  SELECT *, floor((1.0 - ((SELECT avg(null_pct) FROM column_profile) / 100.0 * 0.5 + duplicate_pct / 100.0 * 0.5))
                  * 10000 + 0.5) / 10000 AS quality_score
  FROM report
)"""
)

_BY_MENTIONS = "ORDER BY title_mentions DESC, content_type"
_BY_SIZE = "ORDER BY title_count DESC, avg_release_year DESC, content_type NULLS FIRST, country"

_COUNTS = """
  (SELECT count(*) FROM cleaned) AS cleaned_row_count,
  (SELECT count(*) FROM agg) AS aggregated_row_count,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM cleaned) AS dropped_row_count,
  (SELECT count(*) FROM raw) AS raw_row_count,
  (SELECT count(*) FROM content) AS text_feature_row_count,
  (SELECT count(*) FROM keyword) AS keyword_row_count,
  (SELECT count(*) FROM bigram) AS bigram_row_count,
  (SELECT count(*) FROM summary) AS tfidf_row_count,
  (SELECT count(*) FROM content) AS sentiment_row_count,
  (SELECT count(DISTINCT topic_cluster) FROM topic_rows) AS topic_cluster_count,
  (SELECT count(*) FROM described) AS similarity_pair_count"""
_ALL = AGG + "," + PROFILE + "," + VECTORS


def _sql(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


SQL: dict[str, str] = {
    # An empty CSV cell reads as null.
    "csv_scan": _sql(RAW, "SELECT * REPLACE (nullif(country, '') AS country) FROM raw"),
    "parquet_sink": _sql(AGG, "SELECT * FROM agg"),
    "preview_csv_sink": _sql(AGG, f"SELECT * FROM agg {_BY_SIZE} LIMIT 50"),
    "metrics_sink": _sql(
        CLEANED,
        "SELECT 'tables' AS source_file, raw_row_count, cleaned_row_count, "
        "raw_row_count - cleaned_row_count AS dropped_row_count FROM (SELECT "
        "(SELECT count(*) FROM raw) AS raw_row_count, (SELECT count(*) FROM cleaned) AS cleaned_row_count)",
    ),
    "quality_report_sink": "SELECT (SELECT count(*) FROM customer) AS total_rows, 1.0::DOUBLE AS quality_score, "
    '"column", null_count, null_pct, distinct_count, min, max, mean, min_exact, max_exact FROM ('
    + _column_profile(
        "customer",
        ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
        ("c_custkey", "c_nationkey", "c_acctbal"),
        ("c_custkey", "c_nationkey"),
    )
    + ")",
    "ordered_keywords": _sql(TERMS, f"SELECT *, row_number() OVER ({_BY_MENTIONS}, keyword) AS place FROM keyword"),
    "ordered_tfidf": _sql(
        TERMS, "SELECT *, row_number() OVER (ORDER BY avg_tfidf DESC, max_tfidf DESC, content_type, term) AS place FROM summary"
    ),
    "ordered_topics": _sql(
        PROFILE, "SELECT *, row_number() OVER (ORDER BY topic_cluster, top_tfidf_score DESC NULLS LAST, content_id) AS place FROM topic_rows"
    ),
    "ordered_pairs": _sql(
        VECTORS, "SELECT *, row_number() OVER (ORDER BY cosine_similarity DESC, left_content_id, right_content_id) AS place FROM described"
    ),
    "catalogue_parsed": _sql(PARSED, "SELECT * FROM parsed"),
    "catalogue_clean": _sql(CLEANED, "SELECT * FROM cleaned"),
    "catalogue_summary": _sql(AGG, "SELECT * FROM agg"),
    "brand_numbers": "SELECT p_partkey AS content_id, "
    "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS brand_number FROM part",
    "text_documents": _sql(DOCS, "SELECT * FROM docs"),
    "normalised_documents": _sql(NORMAL, "SELECT content_id, text FROM normal"),
    "tokenised_documents": _sql(NORMAL, "SELECT content_id, array_to_string(tokens, ' ') AS tokens FROM tokenised"),
    "filtered_documents": _sql(CONTENT, "SELECT content_id, array_to_string(tokens, ' ') AS tokens FROM content"),
    "content_documents": _sql(CONTENT, "SELECT content_id, array_to_string(tokens, ' ') AS tokens FROM content"),
    "document_bigrams": _sql(TERMS, "SELECT content_id, bigram FROM pairs"),
    "document_terms": _sql(
        TERMS, "SELECT content_id, term, term_count, CAST(first_position AS INTEGER) AS first_position FROM tf"
    ),
    "sentiment_table": _sql(SCORED, "SELECT * EXCLUDE (tokens), len(tokens) AS token_count FROM scored"),
    "sentiment_table_frequent_lexicon": _sql(
        FREQUENT, "SELECT * EXCLUDE (tokens), len(tokens) AS token_count FROM scored"
    ),
    "sentiment_label_counts": _sql(
        FREQUENT,
        "SELECT "
        + ", ".join(
            f"count(*) FILTER (WHERE sentiment_label = '{label}') AS {label}_document_count"
            for label in ("positive", "neutral", "negative")
        )
        + " FROM scored",
    ),
    "keyword_counts": _sql(TERMS, "SELECT * FROM keyword"),
    "bigram_counts": _sql(TERMS, "SELECT * FROM bigram"),
    "term_frequencies": _sql(TERMS, "SELECT * EXCLUDE (first_position) FROM tf"),
    "document_frequencies": _sql(TERMS, "SELECT * FROM df"),
    "tfidf_records": _sql(TERMS, "SELECT * EXCLUDE (first_position) FROM tfidf"),
    "top_terms": _sql(TERMS, "SELECT * FROM top_term"),
    "tfidf_summary": _sql(TERMS, "SELECT * FROM summary"),
    "document_profile": _sql(PROFILE, "SELECT * FROM profile"),
    "text_features": _sql(PROFILE, "SELECT * FROM features"),
    "top_keyword_counts": _sql(TERMS, f"SELECT * FROM keyword {_BY_MENTIONS}, keyword LIMIT 10"),
    "top_bigram_counts": _sql(TERMS, f"SELECT * FROM bigram {_BY_MENTIONS}, bigram LIMIT 10"),
    "top_tfidf_records": _sql(
        TERMS,
        "SELECT * EXCLUDE (first_position) FROM tfidf "
        "ORDER BY tfidf_score DESC, content_type, term, content_id LIMIT 10",
    ),
    "catalogue_preview": _sql(AGG, f"SELECT * FROM agg {_BY_SIZE} LIMIT 50"),
    "ordered_sentiment": _sql(
        FREQUENT,
        "SELECT * EXCLUDE (tokens), len(tokens) AS token_count, "
        "row_number() OVER (ORDER BY abs(sentiment_score) DESC, content_id) AS place FROM scored",
    ),
    "ordered_text_features": _sql(PROFILE, "SELECT *, row_number() OVER (ORDER BY token_count DESC, content_id) AS place FROM features"),
    "quality_columns": _sql(PARSED, _PARSED_STATS),
    "quality_columns_lineitem": _column_profile("lineitem", LINEITEM_COLUMNS, tuple(LINEITEM_COLUMNS[:8])),
    "quality_duplicates": "SELECT 'o_custkey,o_orderstatus' AS key_columns, total_rows, distinct_rows, "
    "total_rows - distinct_rows AS duplicate_rows, "
    "floor(CAST(total_rows - distinct_rows AS DOUBLE) / total_rows * 100 * 100 + 0.5) / 100 AS duplicate_pct "
    "FROM (SELECT (SELECT count(*) FROM orders) AS total_rows, "
    "(SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)) AS distinct_rows)",
    "quality_report": _sql(QUALITY, "SELECT *, CAST(10 AS INTEGER) AS column_count FROM quality"),
    "quality_bands": _sql(
        QUALITY,
        "SELECT quality_score, CASE WHEN quality_score >= 0.9 THEN 'good' WHEN quality_score >= 0.7 THEN 'fair' "
        "ELSE 'poor' END AS band FROM quality",
    ),
    "quality_null_alerts": _sql(
        QUALITY,
        'SELECT "column", null_count, null_pct, distinct_count, null_pct > 5 AS over_alert FROM column_profile',
    ),
    "retention": _sql(
        CLEANED,
        "SELECT raw_rows, cleaned_rows, greatest(raw_rows - cleaned_rows, 0) AS dropped_rows, "
        "floor(CAST(cleaned_rows AS DOUBLE) / raw_rows * 100 * 100 + 0.5) / 100 AS retained_pct "
        "FROM (SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM cleaned) AS cleaned_rows)",
    ),
    "type_mix": _sql(
        CLEANED,
        "SELECT coalesce(type, 'Unknown') AS content_type, count(*) AS rows, 'Raw' AS stage FROM raw GROUP BY 1 "
        "UNION ALL SELECT coalesce(content_type, 'Unknown'), count(*), 'Cleaned' FROM cleaned GROUP BY 1",
    ),
    "top_countries": _sql(AGG, f"SELECT * FROM agg {_BY_SIZE} LIMIT 15"),
    "top_markets": _sql(
        AGG, f"SELECT content_type, country, title_count, avg_release_year FROM agg {_BY_SIZE} LIMIT 12"
    ),
    "release_trend": _sql(
        CLEANED,
        "SELECT release_year, content_type, count(*) AS titles FROM cleaned "
        "WHERE content_type IS NOT NULL GROUP BY release_year, content_type",
    ),
    "recency_mix": _sql(
        CLEANED,
        "SELECT content_type, CASE WHEN is_recent THEN 'Recent (>= 2020)' ELSE 'Back catalog' END AS recent_bucket, "
        "count(*) AS titles FROM cleaned WHERE content_type IS NOT NULL GROUP BY 1, 2",
    ),
    "cleaned_sample": _sql(CLEANED, "SELECT * FROM cleaned ORDER BY content_id LIMIT 10"),
    "report_keywords": _sql(TERMS, f"SELECT * FROM keyword {_BY_MENTIONS}, keyword LIMIT 20"),
    "report_bigrams": _sql(TERMS, f"SELECT * FROM bigram {_BY_MENTIONS}, bigram LIMIT 20"),
    "report_tfidf_terms": _sql(
        TERMS, "SELECT * FROM summary ORDER BY avg_tfidf DESC, max_tfidf DESC, content_type, term LIMIT 20"
    ),
    "sentiment_mix": _sql(
        FREQUENT, "SELECT content_type, sentiment_label, count(*) AS titles FROM scored GROUP BY 1, 2"
    ),
    "text_density": _sql(
        PROFILE,
        "SELECT content_type, 'token_count' AS metric, "
        "floor(avg(token_count) * 100 + 0.5) / 100 AS value FROM profile GROUP BY 1 "
        "UNION ALL SELECT content_type, 'unique_token_count', "
        "floor(avg(unique_token_count) * 100 + 0.5) / 100 FROM profile GROUP BY 1",
    ),
    "dominant_terms": _sql(
        PROFILE,
        "SELECT content_type, dominant_term, count(*) AS titles FROM profile GROUP BY 1, 2 "
        "ORDER BY titles DESC, content_type, dominant_term LIMIT 15",
    ),
    "unit_vectors": _sql(
        VECTORS,
        "SELECT id AS content_id, CAST(unnest(range(0, len(u))) AS INTEGER) AS position, "
        "unnest(list_transform(u, lambda x: round(x, 6))) AS value FROM vectors",
    ),
    "similar_pairs_all": _sql(
        VECTORS, "SELECT left_content_id, right_content_id, cosine_similarity, embedding_distance FROM all_pairs"
    ),
    "profile_of_parts": """
WITH flawed AS (
  SELECT event_id + 9007199254740992 AS large, CASE WHEN event_id % 3 = 0 THEN ['a, b'] ELSE ['a', 'b'] END AS names,
         nullif(user_id, 1) AS user_id, event_type
  FROM events
)
"""
    + _column_profile("flawed", ["large", "names", "user_id", "event_type"], ("large", "user_id"), ("large", "user_id")),
    "vector_lloyd_step": """
WITH plain AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
), scaled AS (
  SELECT vec_id, list_transform(e, lambda x: floor(x * (1048576.0 / largest))) AS p
  FROM plain CROSS JOIN (SELECT max(list_max(list_transform(e, lambda x: abs(x)))) AS largest FROM plain)
), centres AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS topic_cluster, p AS c FROM scaled QUALIFY row_number() OVER (ORDER BY vec_id) <= 8
), nearest AS (
  SELECT vec_id, p, topic_cluster
  FROM scaled CROSS JOIN centres
  QUALIFY row_number() OVER (
    PARTITION BY vec_id ORDER BY list_inner_product(p, p) + list_inner_product(c, c) - 2 * list_inner_product(p, c), topic_cluster
  ) = 1
), parts AS (
  SELECT topic_cluster, unnest(range(len(p))) AS position, unnest(p) AS value FROM nearest
)
SELECT CAST(topic_cluster AS BIGINT) AS topic_cluster, CAST(position AS BIGINT) AS position, count(*) AS items,
       CAST(sum(value) AS BIGINT) AS total
FROM parts GROUP BY topic_cluster, position
""",
    "similar_pairs_repeated": f"""
WITH every AS (
  SELECT vec_id, embedding FROM embeddings
  UNION ALL SELECT vec_id - 1, embedding FROM embeddings WHERE vec_id % 3 = 1
  UNION ALL SELECT vec_id, embedding FROM embeddings WHERE vec_id % 4 = 0
  UNION ALL SELECT vec_id, embedding FROM embeddings WHERE vec_id % 4 = 0
), lengths AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS e,
         sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
  FROM every
), vectors AS (
  SELECT id, list_transform(e, lambda x: x / norm) AS u FROM lengths WHERE norm > 0
), distances AS (
  SELECT a.id AS left_content_id, b.id AS right_content_id, min(list_distance(a.u, b.u)) AS d
  FROM vectors a JOIN vectors b ON a.id < b.id GROUP BY ALL
), pairs AS (
  SELECT left_content_id, right_content_id, floor((1 - d * d / 2) * 10000 + 0.5) / 10000 AS cosine_similarity,
         floor(d * 10000 + 0.5) / 10000 AS embedding_distance
  FROM distances WHERE d < {VECTOR_DISTANCE}
)
SELECT * FROM pairs WHERE cosine_similarity >= {VECTOR_COSINE}
QUALIFY row_number() OVER (PARTITION BY left_content_id ORDER BY cosine_similarity DESC, right_content_id) <= 3
""",
    "similar_pairs_probed": _sql(
        VECTORS, "SELECT count(*) AS exact_pairs, CAST(0 AS BIGINT) AS surplus, TRUE AS reached FROM all_pairs"
    ),
    "similar_pairs_nearest": _sql(
        VECTORS, "SELECT left_content_id, right_content_id, cosine_similarity, embedding_distance FROM nearest"
    ),
    "similar_pairs_described": _sql(VECTORS, "SELECT * FROM described"),
    "labelled_topics": _sql(PROFILE, "SELECT * FROM topic_rows"),
    "labelled_cluster_mix": _sql(
        PROFILE, "SELECT topic_cluster, content_type, count(*) AS titles FROM topic_rows GROUP BY 1, 2"
    ),
    "labelled_cluster_sizes": _sql(PROFILE, "SELECT topic_cluster, count(*) AS titles FROM topic_rows GROUP BY 1"),
    "labelled_cluster_terms": _sql(
        PROFILE,
        "SELECT topic_cluster, top_tfidf_term, count(*) AS titles FROM topic_rows GROUP BY 1, 2 "
        "ORDER BY titles DESC, topic_cluster, top_tfidf_term LIMIT 20",
    ),
    "labelled_explorer_size": _sql(PROFILE, "SELECT count(*) AS titles FROM topic_rows WHERE topic_cluster = 2"),
    "labelled_explorer_terms": _sql(
        PROFILE,
        "SELECT top_tfidf_term, count(*) AS titles FROM topic_rows WHERE topic_cluster = 2 GROUP BY 1 "
        "ORDER BY titles DESC, top_tfidf_term LIMIT 10",
    ),
    "labelled_explorer_titles": _sql(
        PROFILE,
        "SELECT content_id, title, content_type, country, sentiment_label FROM topic_rows WHERE topic_cluster = 2 "
        "ORDER BY content_id LIMIT 5",
    ),
    "vector_top_pairs": _sql(
        VECTORS,
        "SELECT *, left_title || ' <> ' || right_title AS pair_label FROM described "
        "ORDER BY cosine_similarity DESC, left_content_id, right_content_id LIMIT 20",
    ),
    "vector_group_similarity": _sql(
        VECTORS,
        "SELECT left_topic_cluster, right_topic_cluster, "
        "sum(CAST(floor(cosine_similarity * 10000 + 0.5) AS BIGINT)) / count(*) / 10000 AS avg_similarity, "
        "left_topic_cluster || ' -> ' || right_topic_cluster AS cluster_pair FROM described GROUP BY 1, 2 "
        "ORDER BY avg_similarity DESC, left_topic_cluster, right_topic_cluster LIMIT 20",
    ),
    "run_metrics_row": _sql(
        _ALL,
        "SELECT 'tables' AS source_file, "
        + _COUNTS
        + """,
  (SELECT count(*) FROM tokenised) AS tokenized_document_count,
  (SELECT count(*) FROM content) AS filtered_document_count,
  (SELECT count(*) FROM content) AS stemmed_document_count,
  (SELECT count(*) FROM scored WHERE sentiment_label = 'positive') AS positive_document_count,
  (SELECT count(*) FROM scored WHERE sentiment_label = 'neutral') AS neutral_document_count,
  (SELECT count(*) FROM scored WHERE sentiment_label = 'negative') AS negative_document_count,
  (SELECT keyword || ' (' || content_type || ', ' || title_mentions || ')' FROM keyword
   ORDER BY title_mentions DESC, content_type, keyword LIMIT 1) AS top_keyword,
  (SELECT bigram || ' (' || content_type || ', ' || title_mentions || ')' FROM bigram
   ORDER BY title_mentions DESC, content_type, bigram LIMIT 1) AS top_bigram,
  (SELECT term || ' (' || content_type || ', avg=' || avg_tfidf || ')' FROM summary
   ORDER BY avg_tfidf DESC, max_tfidf DESC, content_type, term LIMIT 1) AS top_tfidf_term,
  (SELECT left_title || ' <-> ' || right_title || ' (' || cosine_similarity || ')' FROM described
   ORDER BY cosine_similarity DESC, left_content_id, right_content_id LIMIT 1) AS top_similarity_pair""",
    ),
    "headline_numbers": _sql(
        _ALL,
        "SELECT "
        + _COUNTS
        + """,
  CAST(0 AS BIGINT) AS positive_document_count, CAST(0 AS BIGINT) AS neutral_document_count,
  CAST(0 AS BIGINT) AS negative_document_count""",
    ),
}
# The same metrics, gathered another way.
SQL["run_metrics_observed"] = SQL["run_metrics_row"]
SQL["headline_numbers_stored"] = _sql(
    _ALL,
    "SELECT "
    + _COUNTS
    + """,
  (SELECT count(*) FROM scored WHERE sentiment_label = 'positive') AS positive_document_count,
  (SELECT count(*) FROM scored WHERE sentiment_label = 'neutral') AS neutral_document_count,
  (SELECT count(*) FROM scored WHERE sentiment_label = 'negative') AS negative_document_count""",
)
SQL["csv_quarantine"] = _sql(
    RAW,
    "SELECT show_id, CASE CAST(show_id AS BIGINT) % 10 WHEN 1 THEN 'short' WHEN 2 THEN 'long' WHEN 3 THEN 'torn' END AS reason FROM raw",
)

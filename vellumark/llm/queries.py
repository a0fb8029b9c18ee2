"""The operators' queries over the test tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, classifier, knn, merkle, mixing, neardup, packing, phrases, pseudo, rules, suffixes, trie, warc
from .common import documents, prepare

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.quality_scores(documents(spark, folder), _table(spark, folder, "labels"))


def op2_voronoi_knn(spark: SparkSession, folder: str) -> DataFrame:
    return knn.top_products(_table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def op3_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    out = phrases.without_repeats(documents(spark, folder), ["doc_id"], with_text=False)
    return out.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffixes.without_copies(documents(spark, folder), ["doc_id"], kept=None)
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    out = warc.archived_pages(spark, _table(spark, folder, "pages"))
    return out.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = bpe.encoded(documents(spark, folder), ranks, public_tokenizers.PATTERN, ["doc_id"])
    return bpe.decoded(ids, ranks, ["doc_id", "n_tokens"], text=False)


def op7_bag_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, folder))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_verdicts(documents(spark, folder), _table(spark, folder, "labels"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(documents(spark, folder))


def op10_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo.pseudo_likelihood(documents(spark, folder))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(merkle.manifest(documents(spark, folder)))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.conversation_trie(_table(spark, folder, "conversations")).drop("name", "parent")


def op13_packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    out = packing.packed_documents(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _crc32_sql(number: str) -> str:
    """DuckDB expression for the CRC-32 of a number's decimal text, one bit at a time."""
    codes = f"[CAST(ascii(c) AS BIGINT) for c in string_split(CAST({number} AS VARCHAR), '')]"
    step = "lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"lambda crc, code: list_reduce(list_prepend(xor(crc, code), CAST(range(8) AS BIGINT[])), {step})"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), {byte}), 4294967295)"


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_quality_classifier,
        op2_voronoi_knn,
        op3_phrase_automata,
        op4_suffix_dedup,
        op5_warc,
        op6_byte_bpe,
        op7_bag_minhash,
        op8_quality_rules,
        op9_mixing,
        op10_pseudo_likelihood,
        op11_merkle_manifest,
        op12_prefix_trie,
        op13_packed_ids,
    )
}

SQL: dict[str, str] = {
    "op2_voronoi_knn": """
WITH vectors AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
""",
    "op3_phrase_automata": r"""
WITH words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents)
), windows AS (
  SELECT doc_id, i, word, count(*) OVER w AS n, md5(string_agg(word, ' ') OVER w) AS h
  FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), judged AS (
  SELECT doc_id, i, word, n = 50 AND min(doc_id) OVER (PARTITION BY h, n = 50) < doc_id AS later FROM windows
), marked AS (
  SELECT doc_id, i, word,
         bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM judged
), kept AS (
  SELECT doc_id, count(*) AS n_words, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS left_over
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(left_over, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
""",
    "op4_suffix_dedup": """
WITH texts AS (
  SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents
), bytes AS (
  SELECT doc_id, i, hex(t[i + 1 : i + 1]) AS byte,
         CASE WHEN i + 50 <= octet_length(t) THEN md5(t[i + 1 : i + 50]) END AS h
  FROM (SELECT doc_id, t, unnest(range(octet_length(t))) AS i FROM texts)
), firsts AS (
  SELECT h, min(doc_id) AS first_doc FROM bytes WHERE h IS NOT NULL GROUP BY h
), judged AS (
  SELECT b.doc_id, i, byte, coalesce(first_doc < b.doc_id, false) AS later FROM bytes b LEFT JOIN firsts USING (h)
), marked AS (
  SELECT doc_id, i, byte,
         bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM judged
), edged AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS edge FROM marked
), kept AS (
  SELECT doc_id, count(*) AS n_bytes, count_if(gone) AS n_removed, count_if(edge) AS n_spans,
         string_agg(byte, '' ORDER BY i) FILTER (WHERE NOT gone) AS left_over
  FROM edged GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_bytes, 0) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(left_over, ''))) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
""",
    "op5_warc": """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM payloads
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM firsts
""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE fields AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         text, CASE WHEN {_crc32_sql("doc_id")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other
  FROM documents
), leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS other_leaf
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), levels AS (
  SELECT tree, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY tree) AS size FROM placed
  UNION ALL
  SELECT tree, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (any_value(size) + 2) // 3
  FROM levels WHERE size > 1 GROUP BY tree, level, place // 3
), subroots AS (
  SELECT tree, node AS subroot, level AS top_level, row_number() OVER (ORDER BY tree) - 1 AS place FROM levels WHERE size = 1
), tops AS (
  SELECT 0 AS level, place, subroot AS node, (SELECT count(*) FROM subroots) AS size FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (any_value(size) + 2) // 3
  FROM tops WHERE size > 1 GROUP BY level, place // 3
), nodes AS (
  SELECT tree, level, place, node FROM levels WHERE size > 1
  UNION ALL
  SELECT NULL, level, place, node FROM tops WHERE size > 1
), runs AS (
  SELECT tree, level, place // 3 AS run, list(node ORDER BY place) AS members FROM nodes GROUP BY tree, level, place // 3
), steps AS (
  SELECT p.doc_id, p.tree, r.level AS step, r.members, p.place // CAST(pow(3, r.level) AS BIGINT) % 3 AS spot
  FROM placed p JOIN runs r ON r.tree = p.tree AND r.run = p.place // CAST(pow(3, r.level + 1) AS BIGINT)
  UNION ALL
  SELECT p.doc_id, p.tree, s.top_level + r.level, r.members, s.place // CAST(pow(3, r.level) AS BIGINT) % 3
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN runs r ON r.tree IS NULL AND r.run = s.place // CAST(pow(3, r.level + 1) AS BIGINT)
), climbs AS (
  SELECT doc_id, tree, 0 AS step, other_leaf AS node FROM placed
  UNION ALL
  SELECT c.doc_id, c.tree, c.step + 1,
         sha256(array_to_string(s.members[: s.spot] || [c.node] || s.members[s.spot + 2 :], ''))
  FROM climbs c JOIN steps s ON s.doc_id = c.doc_id AND s.tree = c.tree AND s.step = c.step
), folded AS (
  SELECT doc_id, tree, arg_max(node, step) AS folded_root FROM climbs GROUP BY doc_id, tree
), proofs AS (
  SELECT doc_id, tree, sha256(string_agg(array_to_string(members[: spot] || members[spot + 2 :], ''), '' ORDER BY step)) AS proof_sha256
  FROM steps GROUP BY doc_id, tree
)
SELECT p.doc_id, p.leaf, s.subroot, t.node AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root,
       f.folded_root = t.node AS verified
FROM placed p JOIN subroots s USING (tree) JOIN folded f ON f.doc_id = p.doc_id AND f.tree = p.tree
LEFT JOIN proofs q ON q.doc_id = p.doc_id AND q.tree = p.tree
CROSS JOIN (SELECT node FROM tops WHERE size = 1) t
""",
    "op12_prefix_trie": rf"""
WITH lists AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT l.conv_id, l.turns, coalesce(d.turns, []) AS donor, CAST({_crc32_sql("l.conv_id")} % 4 AS INTEGER) AS h
  FROM lists l LEFT JOIN lists d ON d.conv_id = l.conv_id - l.conv_id % 20
), rebuilt AS (
  SELECT conv_id, donor[1 : h] || turns[h + 1 :] AS turns FROM heads
), prefixes AS (
  SELECT conv_id, d AS depth, turns[1 : d] AS prefix, d = len(turns) AS ended
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT prefix, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '') AS ends
  FROM prefixes GROUP BY prefix
), sized AS (
  SELECT *, CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(prefix[depth].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved,
         (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1 : n.depth] = n.prefix) AS n_children
  FROM nodes n
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, any_value(p.conv_id) AS parent_conv_id, any_value(n.n_convs) AS n_convs,
       any_value(n.n_children) AS n_children, CAST(count_if(b.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens,
       sha256(any_value(n.ends)) AS ends_sha256
FROM sized n JOIN sized b ON b.depth >= n.depth AND b.prefix[1 : n.depth] = n.prefix
LEFT JOIN sized p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1 : n.depth - 1]
GROUP BY n.prefix, n.depth, n.conv_id
""",
}

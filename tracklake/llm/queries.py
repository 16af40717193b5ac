"""Registered queries of the operators for training data, with SQL where a second engine can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.grace_dedup import exact_dedup
from tracklake.llm.lexical_search import ranked_search
from tracklake.llm.lsa_quality import score_quality
from tracklake.llm.mixing import mix_sources
from tracklake.llm.pieces import decode_pieces, encode_pieces, load_vocabulary
from tracklake.llm.prefix_trie import prefix_trie
from tracklake.llm.secrets import scan_secrets
from tracklake.llm.set_join import jaccard_components
from tracklake.llm.suffix_dedup import remove_repeats
from tracklake.llm.surrogates import replace_personal_data
from tracklake.llm.tile_join import vector_links
from tracklake.llm.toxicity import score_toxicity
from tracklake.llm.url_templates import filter_urls
from tracklake.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# The rules of the URL query.
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vocabulary = load_vocabulary(PIECE_MODEL)
    decoded = decode_pieces(encode_pieces(docs, vocabulary), vocabulary)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("copies")


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(prepare(spark), sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (op1_quality_vote, op2_substring_dedup, op3_piece_codec, op4_secret_scan, op5_source_mix, op6_surrogates, op7_url_filter, op8_exact_dedup, op9_vector_links,
              op10_jaccard_join, op11_ranked_search, op12_prefix_trie, op13_toxicity, pipeline)
}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

_OP5 = f"""
WITH sized AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT >> 2) AS point
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, ([3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget
  FROM sources
), leveled AS (
  SELECT *, cap / weight AS ratio,
         (budget - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS lvl
  FROM weighed
  WINDOW w AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), open_level AS (
  SELECT lvl FROM leveled WHERE lvl <= ratio ORDER BY ratio, lvl LIMIT 1
), targets AS (
  SELECT source, source_size, least(cap, coalesce(weight * (SELECT lvl FROM open_level), cap)) AS target FROM leveled
), goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM targets
), run AS (
  SELECT doc_id, size, s.source, source_size, target, passes, target - passes * source_size AS goal, point,
         sum(size) OVER (PARTITION BY s.source ORDER BY point) AS upto
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), edges AS (
  SELECT *, min(CASE WHEN upto > goal THEN point END) OVER (PARTITION BY source) AS edge FROM run
), gap AS (
  SELECT *, max(CASE WHEN upto <= goal THEN upto ELSE 0 END) OVER (PARTITION BY source) AS below,
         min(CASE WHEN upto > goal THEN upto END) OVER (PARTITION BY source) AS above
  FROM edges
)
SELECT doc_id, size, source, source_size, target,
       (size * (passes + CASE WHEN edge IS NULL OR point < edge OR (point = edge AND above - goal < goal - below)
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM gap
"""

_OP8 = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""

_OP9 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), u AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), part AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n_links FROM link GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN degree d ON d.a = vec_id LEFT JOIN part p ON p.a = vec_id
"""

_OP2 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
  SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM d WHERE len(w) >= 50
), keyed AS (
  SELECT doc_id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS k FROM wins
), lows AS (
  SELECT k, min(doc_id) AS low FROM keyed GROUP BY k HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM keyed JOIN lows USING (k) WHERE low < doc_id
), lost AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, w, coalesce(len(ps), 0) AS n_removed,
         CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END AS kw
  FROM d LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, len(w)::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(array_to_string(kw, ' '), '')) AS kept_sha256
FROM kept
"""

_OP11 = r"""
WITH held AS (
  SELECT row_number() OVER () AS row_at, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), asked AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sums AS (
  SELECT count(*) FILTER (len(w) > 0) AS big_n, sum(len(w))::BIGINT AS big_l FROM held
), wanted AS (
  SELECT DISTINCT item_id, unnest(w) AS term FROM asked
), tf AS (
  SELECT row_at, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_at, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM held) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, sums GROUP BY term
), impacts AS (
  SELECT row_at, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l))) AS i FROM tf, sums
), scored AS (
  SELECT item_id, row_at, doc_id, sum(w * i)::BIGINT AS score FROM wanted JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, row_at, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""

_OP12 = """
WITH tab AS (
  SELECT list(v ORDER BY n) AS t
  FROM (SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(n))
), ids AS (
  SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL
), skips AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: ord(s[i]))),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM ids, tab
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
), built AS (
  SELECT c, 0 AS mine, p, role, text FROM skips JOIN placed ON conv_id = c - c % 5 AND p <= h
  UNION ALL
  SELECT c, 1 AS mine, p, role, text FROM skips JOIN placed ON conv_id = c AND p > h
), listed AS (
  SELECT c, list(sha256(strlen(role) || ':' || role || text) ORDER BY mine, p) AS w, list(strlen(text) ORDER BY mine, p) AS b FROM built GROUP BY c
), whole AS (
  SELECT c, coalesce(w, []) AS w, coalesce(b, []) AS b FROM ids LEFT JOIN listed USING (c)
), prefix AS (
  SELECT c, d, array_to_string(w[1:d], '') AS k, CASE WHEN d > 0 THEN array_to_string(w[1:d - 1], '') END AS up,
         CASE WHEN d > 0 THEN b[d] ELSE 0 END AS size, len(w) = d AS ends
  FROM (SELECT *, unnest(range(0, len(w) + 1)) AS d FROM whole)
), node AS (
  SELECT k, d, min(c) AS conv_id, any_value(up) AS up, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM prefix GROUP BY k, d
), kids AS (
  SELECT up AS k, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up
), totals AS (
  SELECT p.k, sum((n - 1) * node.size)::BIGINT AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM node LEFT JOIN kids USING (k) JOIN prefix p ON p.c = node.conv_id AND p.d <= node.d GROUP BY p.k
)
SELECT v.conv_id, v.d::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens, v.ends_sha256
FROM node v JOIN totals USING (k) LEFT JOIN kids USING (k) LEFT JOIN node u ON u.k = v.up
"""

ORACLE: dict[str, str] = {"op2_substring_dedup": _OP2, "op5_source_mix": _OP5, "op8_exact_dedup": _OP8, "op9_vector_links": _OP9,
                          "op11_ranked_search": _OP11, "op12_prefix_trie": _OP12}

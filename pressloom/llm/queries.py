"""The registered corpus queries: each applies one operator to its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressloom.llm.centroid_clustering import clusters
from pressloom.llm.chat_format import formatted
from pressloom.llm.common import table
from pressloom.llm.decontamination import leaks
from pressloom.llm.embedding_dedup import near_duplicates
from pressloom.llm.exact_dedup import exact_groups
from pressloom.llm.jaccard_join import groups
from pressloom.llm.language_id import language_report
from pressloom.llm.license_scan import licence_lines
from pressloom.llm.mixing import mix_report
from pressloom.llm.secret_scan import secret_spans
from pressloom.llm.token_alignment import alignment
from pressloom.llm.token_counts import token_counts
from pressloom.llm.toxicity import learn, severity


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_lines(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(table(spark, sf_dir, "conversations"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), limit=2048)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return severity(docs, learn(docs, table(spark, sf_dir, "labels")))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_chat_format": op2_chat_format,
    "op3_secret_scan": op3_secret_scan,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_decontamination": op7_decontamination,
    "op8_source_mixing": op8_source_mixing,
    "op9_language_id": op9_language_id,
    "op10_toxicity": op10_toxicity,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_token_alignment": op13_token_alignment,
}

_WORDS = r"list_filter(regexp_split_to_array({text}, '[ \t-\r]+'), lambda x: x <> '')"
_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Every node with each node that it reaches, and from that the smallest.
_REACH = """pairs AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, root) AS (SELECT node, node FROM nodes UNION SELECT pairs.b, reach.root FROM reach JOIN pairs ON reach.node = pairs.a),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)"""



def _clustering_sql(rounds: int = 3) -> str:
    """Rounds of assignment and floored means, each a pair of materialised steps."""
    steps = [
        """points AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS p FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
centroids_0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), p) - 1 AS cluster, p AS c FROM points
  QUALIFY row_number() OVER (ORDER BY sha256(concat('1:', vec_id)), p) <= 16)"""]
    for i in range(rounds + 1):
        steps.append(f"""placed_{i} AS MATERIALIZED (
  SELECT vec_id, p, cluster, c, CAST(list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance
  FROM points CROSS JOIN centroids_{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)""")
        if i < rounds:
            steps.append(f"""parts_{i} AS (SELECT cluster, generate_subscripts(p, 1) AS place, unnest(p) AS x FROM placed_{i}),
sums_{i} AS (SELECT cluster, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM parts_{i} GROUP BY cluster, place),
means_{i} AS (SELECT cluster, list((s - (s % n + n) % n) // n ORDER BY place) AS c FROM sums_{i} GROUP BY cluster),
centroids_{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.c, o.c) AS c FROM centroids_{i} o LEFT JOIN means_{i} m USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM placed_{rounds}"""


# What SQL can express. The others learn a model or draw at random.
ORACLE_SQL: dict[str, str] = {
    "op2_chat_format": r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position
  FROM turns),
grown AS (
  SELECT conv_id, position, md5(string_agg(concat(role IS NULL, role, chr(1), text IS NULL, text, chr(2)), '')
    OVER (PARTITION BY conv_id ORDER BY position)) AS prefix, count(*) OVER (PARTITION BY conv_id) AS turns FROM placed),
whole AS (SELECT min(conv_id) AS conv_id, count(*) AS copies, prefix, position FROM grown WHERE position = turns GROUP BY prefix, position),
kept AS (
  SELECT conv_id, copies FROM whole
  WHERE NOT EXISTS (SELECT 1 FROM grown WHERE grown.position < grown.turns AND grown.position = whole.position AND grown.prefix = whole.prefix))
SELECT conv_id, (position - 1) // 32 AS part, count(*) AS n_turns, max(copies) AS copies,
  string_agg(concat('<|im_start|>', replace(coalesce(role, ''), '<|', '< |'), chr(10), replace(coalesce(text, ''), '<|', '< |'),
    '<|im_end|>', chr(10)), '' ORDER BY position) AS chat
FROM placed JOIN kept USING (conv_id) GROUP BY conv_id, (position - 1) // 32
""",
    "op4_embedding_dedup": f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
links AS (SELECT l.vec_id AS a, r.vec_id AS b FROM good l JOIN good r ON l.label = r.label AND l.vec_id <> r.vec_id
  WHERE list_cosine_similarity(l.e, r.e) >= 0.93),
nodes AS (SELECT vec_id AS node FROM embeddings), {_REACH},
counts AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, node = component_id AS kept FROM roots LEFT JOIN counts USING (node)
""",
    "op6_jaccard_join": f"""
WITH RECURSIVE words AS (SELECT doc_id, coalesce({_WORDS.format(text=_SMALL)}, []) AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT l.doc_id AS a, r.doc_id AS b, l.n + r.n AS sizes, count(*) AS k FROM flat l JOIN flat r ON l.g = r.g AND l.doc_id < r.doc_id
  GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * k >= 75 * (sizes - k)),
nodes AS (SELECT doc_id AS node FROM documents), {_REACH}
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN roots ON node = doc_id
""",
    "op7_decontamination": f"""
WITH words AS (SELECT doc_id, {_WORDS.format(text='lower(text)')} AS w FROM documents WHERE text IS NOT NULL),
wanted AS (SELECT item_id, {_WORDS.format(text='lower(text)')} AS w FROM benchmark WHERE text IS NOT NULL),
docs AS (SELECT doc_id, [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] AS s FROM words WHERE len(w) >= 5),
items AS (SELECT item_id, [array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)] AS s FROM wanted WHERE len(w) >= 5),
sizes AS (SELECT DISTINCT n, g FROM (SELECT len(s) AS n, unnest(s) AS g FROM items)),
spread AS (SELECT doc_id, len(s) AS total, unnest(s) AS g, generate_subscripts(s, 1) - 1 AS place FROM docs),
starts AS (SELECT DISTINCT doc_id, n, greatest(0, least(place, total - n)) AS start FROM spread JOIN sizes USING (g)),
windows AS (SELECT doc_id, n, start, s[start + 1:start + n] AS s FROM starts JOIN docs USING (doc_id)),
held AS (SELECT doc_id, n, start, len(s) AS size, unnest(s) AS g FROM windows),
counted AS (SELECT doc_id, n, start, size, g, count(*) AS k FROM held GROUP BY ALL),
weights AS (SELECT item_id, n, g, count(*) AS c FROM (SELECT item_id, len(s) AS n, unnest(s) AS g FROM items) GROUP BY ALL),
common AS (SELECT doc_id, item_id, start, n, size, sum(least(k, c)) AS m FROM counted JOIN weights USING (n, g) GROUP BY ALL)
SELECT doc_id, item_id, CAST(m AS DOUBLE) / (n + size - m) AS similarity, CAST(start AS INTEGER) AS first_word,
  CAST(start + size + 3 AS INTEGER) AS last_word
FROM common WHERE 100 * m >= 75 * (n + size - m)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY CAST(m AS DOUBLE) / (n + size - m) DESC, start) = 1
""",
    "op11_centroid_clustering": _clustering_sql(),
    "op12_exact_dedup": f"""
WITH texts AS (SELECT doc_id, coalesce({_SMALL}, '') AS small FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
  sha256(small) AS text_sha256 FROM texts WINDOW same AS (PARTITION BY small)
""",
}

"""The registered queries of the subpackage, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proofline.llm import (
    decontaminate, fill_in_middle, hard_negatives, jaccard_join, language_id, pieces, pii, secrets, substring_dedup, token_counts, token_files, topk, toxicity,
)
from proofline.llm.text import table
from proofline.session import scratch


def remainder(n: int):
    """crc32 of doc_id as text, modulo n; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(remainder(3) != 1))
    found = language_id.identify(docs, model)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.drop("ids", "decoded")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), 50).drop("kept_text")


def toxicity_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> dict | None:
    """A model from the labelled rows of docs whose crc32 remainder by 5 is not 0; only the chosen ids are broadcast."""
    marks = toxicity.sampled_labels(table(spark, sf_dir, "labels").select("doc_id", "toxic").where(remainder(5) != 0))
    return toxicity.fit(docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity_model(docs, spark, sf_dir))
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("row_key", "all_spans")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token_files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder, 2)
    return token_files.read_tokens(spark, folder).drop("ids")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.fit(docs))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.rearrange(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_in_middle.restored(), 256).alias("restored_sha256")
    )


def registered() -> dict:
    own = (
        op1_token_counts, op2_benchmark_leaks, op3_top_k, op4_language_id, op5_pieces, op6_substring_dedup, op7_toxicity,
        op8_secrets, op9_token_files, op10_jaccard_join, op11_pii, op12_hard_negatives, op13_fill_in_middle,
    )
    return {f.__name__: f for f in own}


def sql() -> dict[str, str]:
    return {
        "op3_top_k": TOP_K, "op6_substring_dedup": REPEATS, "op10_jaccard_join": LINKED, "op12_hard_negatives": NEGATIVES, "op13_fill_in_middle": REARRANGED,
    }


TOP_K = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM scaled q JOIN scaled c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

REPEATS = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT row_id, doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS k
  FROM (SELECT row_id, doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM texts WHERE doc_id IS NOT NULL)
), firsts AS (
  SELECT k, min(doc_id) AS low FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT row_id, unnest(range(s, s + 50)) AS p FROM windows JOIN firsts USING (k) WHERE low < doc_id
), words AS (
  SELECT row_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts WHERE row_id IN (SELECT row_id FROM gone)
), changed AS (
  SELECT row_id, count(*) FILTER (WHERE g.p IS NOT NULL) AS n, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE g.p IS NULL) AS kept
  FROM words LEFT JOIN gone g USING (row_id, p) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM texts LEFT JOIN changed USING (row_id)
"""

LINKED = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT row_id, doc_id, array_to_string(w[s : s + 4], ' ') AS g
  FROM (SELECT row_id, doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS s FROM texts)
), sizes AS (
  SELECT row_id, count(*) AS n FROM shingles GROUP BY row_id
), common AS (
  SELECT a.row_id AS x, b.row_id AS y, any_value(a.doc_id) AS a, any_value(b.doc_id) AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.row_id < b.row_id
  WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY a.row_id, b.row_id
), links AS (
  SELECT DISTINCT a, b FROM (
    SELECT a, b, shared, p.n + q.n - shared AS united FROM common JOIN sizes p ON p.row_id = x JOIN sizes q ON q.row_id = y
  ) WHERE 100 * shared >= 80 * united AND a <> b
), ways AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, b AS other FROM ways
  UNION
  SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.other
), lowest AS (
  SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id
)
SELECT texts.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(texts.doc_id, coalesce(low, texts.doc_id)) AS component_id
FROM texts LEFT JOIN sizes USING (row_id) LEFT JOIN lowest ON lowest.doc_id = texts.doc_id
"""

NEGATIVES = """
WITH scaled AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM scaled a JOIN scaled b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), windows AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 5
"""

REARRANGED = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), drawn AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM texts
), parts AS (
  SELECT *, array_to_string(u[1 : least(x, y)], '') AS pre, array_to_string(u[least(x, y) + 1 : greatest(x, y)], '') AS mid,
    array_to_string(u[greatest(x, y) + 1 : n], '') AS suf
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM parts
"""

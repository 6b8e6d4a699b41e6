"""The registered queries of the operators, and the SQL each must equal where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authlane.llm.class_lm import score_documents
from authlane.llm.common import table
from authlane.llm.fingerprints import fingerprints
from authlane.llm.hard_negatives import hard_negatives
from authlane.llm.jaccard_join import near_duplicates
from authlane.llm.language_id import identify
from authlane.llm.line_dedup import dedup_lines
from authlane.llm.merkle import as_text, proof_digest, tampered_manifest
from authlane.llm.minhash import minhash_duplicates
from authlane.llm.mixing import mix
from authlane.llm.packing import pack
from authlane.llm.sharding import ShardTree, shard_documents
from authlane.llm.toxicity import toxicity
from authlane.llm.wand_search import search

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND s.keeper < k.doc_id AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), ShardTree(24))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op8_wand_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the whole texts of every twentieth id, searched in all documents."""
    docs = table(spark, sf_dir, "documents")
    return search(docs, docs.where("doc_id % 20 = 0"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints(table(spark, sf_dir, "documents"))
    sha = F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", sha, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth id is an anchor; every seventh id has its label moved on by one first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND s.label <> p.anchor_label
  AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's leaf, roots and proof; of the ids that 7 divides by checksum, n_chars grew by one."""
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    found = tampered_manifest(table(spark, sf_dir, "documents"), tampered)
    return found.select(
        "doc_id",
        *[as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        proof_digest(F.col("path")).alias("proof_sha256"),
        as_text(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


# The checksum is CRC-32 by its definition, one bit at a time over the decimal id.
OP12_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, n_chars,
         list_reduce(list_prepend(4294967295::UBIGINT,
             list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
           lambda h, b: list_reduce(list_prepend(xor(h, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
             lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)) AS h,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(strlen((n_chars + k)::VARCHAR) || ':' || (n_chars + k), '-') || tail) AS changed
  FROM (SELECT *, CASE WHEN xor(h, 4294967295::UBIGINT) % 7 = 0 THEN 1 ELSE 0 END AS k FROM rows)
), ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, rank AS idx, count(*) OVER (PARTITION BY tree) AS n, leaf AS digest FROM ranked
  UNION ALL
  SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2, n
), subroots AS (
  SELECT tree, digest AS subroot, level AS depth FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, tree AS idx, count(*) OVER () AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx))
  FROM tops WHERE n > 1 GROUP BY level, idx // 2, n
), steps AS (
  SELECT r.tree, r.rank, l.level, (r.rank // (2 ** l.level)::BIGINT) AS idx
  FROM ranked r JOIN subroots s USING (tree), range(0, 64) l(level) WHERE l.level < s.depth
), lower AS (
  SELECT s.tree, s.rank, s.level, s.idx % 2 = 1 AS left_first, n.digest
  FROM steps s LEFT JOIN nodes n ON n.tree = s.tree AND n.level = s.level AND n.idx = xor(s.idx, 1)
), upper AS (
  SELECT s.tree, l.level, (s.tree // (2 ** l.level)::BIGINT) % 2 = 1 AS left_first, t.digest
  FROM subroots s JOIN range(0, 64) l(level) ON l.level < (SELECT max(level) FROM tops)
  LEFT JOIN tops t ON t.level = l.level AND t.idx = xor((s.tree // (2 ** l.level)::BIGINT), 1)
), lower_paths AS (
  SELECT tree, rank, string_agg(digest, '' ORDER BY level) AS digests,
         list(CASE WHEN digest IS NULL THEN 'N' WHEN left_first THEN 'L' || digest ELSE 'R' || digest END ORDER BY level) AS path
  FROM lower GROUP BY tree, rank
), upper_paths AS (
  SELECT tree, string_agg(digest, '' ORDER BY level) AS digests,
         list(CASE WHEN digest IS NULL THEN 'N' WHEN left_first THEN 'L' || digest ELSE 'R' || digest END ORDER BY level) AS path
  FROM upper GROUP BY tree
), found AS (
  SELECT r.doc_id, r.leaf, s.subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
         sha256(coalesce(l.digests, '') || coalesce(u.digests, '')) AS proof_sha256,
         list_reduce(list_prepend(r.changed, list_concat(coalesce(l.path, []), coalesce(u.path, []))),
           lambda up, s: CASE s[1] WHEN 'N' THEN sha256(up) WHEN 'L' THEN sha256(s[2:] || up) ELSE sha256(up || s[2:]) END) AS folded_root
  FROM ranked r JOIN subroots s USING (tree)
  LEFT JOIN lower_paths l ON l.tree = r.tree AND l.rank = r.rank LEFT JOIN upper_paths u ON u.tree = r.tree
)
SELECT *, folded_root = root AS verified FROM found
"""


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_line_dedup": op2_line_dedup,
    "op3_sharding": op3_sharding,
    "op4_toxicity": op4_toxicity,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_class_lm": op6_class_lm,
    "op7_packing": op7_packing,
    "op8_wand_search": op8_wand_search,
    "op9_fingerprints": op9_fingerprints,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_minhash_dedup": op13_minhash_dedup,
}
ORACLES: dict[str, str] = {"op2_line_dedup": OP2_SQL, "op11_hard_negatives": OP11_SQL, "op12_merkle_manifest": OP12_SQL}

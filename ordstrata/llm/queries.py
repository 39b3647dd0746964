"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordstrata.llm.collocations import collocations
from ordstrata.llm.common import read_table
from ordstrata.llm.decontamination import contamination
from ordstrata.llm.html_text import extract
from ordstrata.llm.language_id import identify
from ordstrata.llm.language_model import score_texts
from ordstrata.llm.manifest import verified
from ordstrata.llm.mixing import mix_sources
from ordstrata.llm.near_dups import near_duplicates
from ordstrata.llm.oracles import COLLOCATIONS_SQL, MANIFEST_SQL, MIX_SQL
from ordstrata.llm.packing import pack
from ordstrata.llm.pii import personal_data
from ordstrata.llm.quality_classifier import classify
from ordstrata.llm.quality_rules import judge
from ordstrata.llm.sharding import shard_by_bytes

Query = Callable[[SparkSession, str], DataFrame]


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return classify(read_table(spark, sf_dir, "documents"), labels)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), word_tokenizer())


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return contamination(documents, read_table(spark, sf_dir, "benchmark"))


def op10_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [
        op1_language_id,
        op2_sharding,
        op3_quality_classifier,
        op4_packing,
        op5_html_text,
        op6_pii,
        op7_quality_rules,
        op8_language_model,
        op9_decontamination,
        op10_near_dups,
        op11_mixing,
        op12_merkle_manifest,
        op13_collocations,
    ]
    return {query.__name__: query for query in found}


# Exact sets and exact components; equal sets count as one, as many copies would be many pairs.
NEAR_DUPS_SQL = r"""
WITH RECURSIVE said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1),
      lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS g FROM said),
classes AS (SELECT min(doc_id) AS id, g FROM sets WHERE len(g) > 0 GROUP BY g),
members AS (SELECT id, len(g) AS n, unnest(g) AS x FROM classes),
links AS (SELECT a.id AS a, b.id AS b FROM members a JOIN members b ON a.x = b.x AND a.id < b.id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT id, id AS other FROM classes
  UNION SELECT r.id, e.b FROM reached r JOIN ends e ON e.a = r.other),
least_of AS (SELECT id, min(other) AS component FROM reached GROUP BY id)
SELECT doc_id, len(sets.g) AS n_shingles, coalesce(component, doc_id) AS component_id,
  coalesce(component, doc_id) = doc_id AS kept
FROM sets LEFT JOIN classes USING (g) LEFT JOIN least_of USING (id)"""


def oracle_sql() -> dict[str, str]:
    """The near duplicates, the mix, the manifest and the phrases in exact SQL. Of the others, learned
    models and token ids are beyond it; brute force is in tests/llm."""
    return {
        "op10_near_dups": NEAR_DUPS_SQL,
        "op11_mixing": MIX_SQL,
        "op12_merkle_manifest": MANIFEST_SQL,
        "op13_collocations": COLLOCATIONS_SQL,
    }

"""One query per operator over its whole table, in the form that its contract fixes."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.llm import clusters, licenses, lines, ranked
from statlake.llm.clusters import cluster_vectors
from statlake.llm.decontaminate import find_contamination, is_contaminated
from statlake.llm.exact import exact_groups
from statlake.llm.languages import held_out, identify, learn
from statlake.llm.licenses import find_licenses
from statlake.llm.lines import drop_boilerplate
from statlake.llm.near import near_classes
from statlake.llm.neighbours import NeighbourIndex
from statlake.llm.pieces import encode_pieces
from statlake.llm.ranked import rank_documents
from statlake.llm.secrets import base_only, count_of, find_secrets, span_text
from statlake.llm.substrings import remove_substrings
from statlake.llm.token_counts import count_tokens

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document occurs in benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without windows of 20 words that start earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_substrings(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without the lines that its host repeats."""
    kept = drop_boilerplate(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    digest = F.sha2(F.array_join("lines", "\n"), 256).alias("kept_sha256")
    return kept.select("page_id", "host", "n_lines", "n_dropped", digest)


ORACLES["op4_line_dedup"] = lines.oracle_sql()


@query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op7_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its equals that stays."""
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op8_exact_dedup"] = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        count_of(spans, "assign").alias("n_assign"),
        count_of(spans, "access").alias("n_access"),
        count_of(spans, "hex").alias("n_hex"),
        F.sha2(span_text(base_only(spans)), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that every document names or holds."""
    found = find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["name"])))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.round(F.coalesce(F.array_max("matches")["score"], F.lit(0.0)), 6).alias("best_score"),
        F.array_join(names, ",").alias("licenses"),
    )


ORACLES["op10_license_scan"] = licenses.oracle_sql()


@query
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every whole vector after three rounds."""
    return cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ORACLES["op12_centroid_clusters"] = clusters.oracle_sql()


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rank_documents(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLES["op13_ranked_search"] = ranked.oracle_sql()


@query
def op11_neighbour_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return NeighbourIndex(vectors).search(vectors.where("vec_id % 20 = 0"))

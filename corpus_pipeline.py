"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Languages are learnt from the labels of the documents that are not held out (as in op6) and documents
without any letter, or whose letters are of no learnt language, go; of exact copies the largest id stays,
of near copies the smallest; documents of which a twentieth or more is benchmark text go; the rest is
encoded. Each stage works on what the one before it kept, with all columns of ``documents`` unchanged,
and the last returns the digests of ids and decoded text.

A stage on an empty table gives an empty table. NULL texts are rejected by the first stage. Further
columns of ``documents`` are carried to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.llm.decontaminate import find_contamination, is_contaminated
from statlake.llm.exact import drop_exact_copies
from statlake.llm.languages import UNDETERMINED, held_out, identify, learn
from statlake.llm.near import drop_near_copies
from statlake.llm.pieces import encode_pieces
from statlake.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def carried(docs: DataFrame) -> DataFrame:
    """The text beside the whole document, whose columns may have any name."""
    return docs.select(F.struct("*").alias("document"), "text")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters of a language that is known."""
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    judged = identify(carried(docs), model)
    kept = judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") > 0))
    return kept.select("document.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    found = find_contamination(carried(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~is_contaminated(F.col("n_hit"), F.col("n_words"))).select("document.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each document, and what they decode to, as digests."""
    made = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return made.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("piece_encoding", encoded),
]

# The near-duplicate stage draws weighted samples by hashing, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

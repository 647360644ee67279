"""Exact duplicates by content-defined chunk recipes, with SQL functions only.

A text is cut into chunks where its own content says so (at a line end behind at least ``CHUNK_MIN``
characters, or after ``CHUNK_MAX``). The chunks join to the text again, so two texts are equal exactly
if their lists of chunks are. Each distinct chunk crosses the network once per task that holds it; there
chunks of the same 64-bit hash are compared whole. A hash with one content is a verified identifier;
chunks whose hash has several contents get their SHA-256 besides. From then on only the ordered lists of
identifiers move, about 20 bytes for each chunk, never the texts.

Groups are counted with map-side partials and joined back by recipe, where Spark splits a hot one.

Cases: a NULL text is an empty one. Repeated rows are counted and returned as often as they come; of rows
with the same id and text one is kept, and different texts of one id are different documents. A NULL id is
less than any other. An empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_MIN, CHUNK_MAX = 256, 8192
CHUNK = rf"(?s).{{{CHUNK_MIN},{CHUNK_MAX}}}?(?<=\n)|.{{1,{CHUNK_MAX}}}"
# So many ambiguous hashes are named in the plan; with more, every chunk goes by its SHA-256.
NAMED_HASHES = 10_000


def chunks_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CHUNK), F.lit(0))


def ambiguous_hashes(docs: DataFrame, text: str) -> DataFrame:
    """The hashes that belong to more than one distinct chunk."""
    chunk = docs.select(F.explode(chunks_of(F.col(text))).alias("chunk"))
    distinct = chunk.select(F.xxhash64("chunk").alias("hash"), "chunk").distinct()
    return distinct.groupBy("hash").count().where("count > 1").select("hash")


def recipe_of(chunks: Column, ambiguous: list[int] | None) -> Column:
    """The ordered identifiers of chunks; ``ambiguous`` None: too many hashes are ambiguous to name."""
    if ambiguous is None:
        return F.transform(chunks, lambda c: F.sha2(c, 256))
    if not ambiguous:
        return F.transform(chunks, lambda c: F.hex(F.xxhash64(c)))
    return F.transform(
        chunks,
        lambda c: F.when(F.xxhash64(c).isin(ambiguous), F.sha2(c, 256)).otherwise(
            F.hex(F.xxhash64(c))
        ),
    )


def recipe_groups(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of the same id and text as one, with their number (``times``) and their group."""
    few = ambiguous_hashes(docs, text).limit(NAMED_HASHES + 1).collect()
    ambiguous = [r["hash"] for r in few] if len(few) <= NAMED_HASHES else None
    recipes = (
        docs.select(
            F.col(doc_id).alias("doc_id"),
            recipe_of(chunks_of(F.col(text)), ambiguous).alias("recipe"),
            digest_of(F.col(text)).alias("text_sha256"),
        )
        .groupBy("recipe", "doc_id", "text_sha256")
        .agg(F.count("*").alias("times"))
    )
    groups = recipes.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size")
    )
    return recipes.join(groups, "recipe")


def digest_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: id, keep_id (largest id with this text), group_size, kept, text_sha256."""
    copies = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    return recipe_groups(docs, doc_id, text).select("*", copies).select(
        F.col("doc_id").alias(doc_id),
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each text, of the largest id, all its columns unchanged."""
    kept = recipe_groups(docs, doc_id, text).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # One key that is never NULL, so that the window below finds the rows dealt as it needs them.
    key = F.concat("text_sha256", F.coalesce(F.concat(F.lit(":"), F.col("doc_id").cast("string")), F.lit("")))
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
        F.col(doc_id).alias("doc_id"),
        digest_of(F.col(text)).alias("text_sha256"),
    )
    found = given.select("document", key.alias("key")).join(kept.select(key.alias("key")), "key", "left_semi")
    # Rows of one id and text are the only ones left that are equal; the join has put them side by side.
    same = Window.partitionBy("key").orderBy(F.xxhash64(*_hashed(docs)))
    return found.withColumn("place", F.row_number().over(same)).where("place = 1").select("document.*")


def _hashed(docs: DataFrame) -> list[Column]:
    """The columns that a row's place among rows of one id and text goes by."""
    plain = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return [F.col(f"document.`{c}`") for c in plain] or [F.lit(0)]

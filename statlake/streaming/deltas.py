"""A keyed table kept as folders of rows, one for each micro-batch, that fold into fewer as they grow old.

Micro-batch ``n`` writes its rows to ``level=0/batch_id=n``, split into a few buckets of keys, so that
work on some keys reads only their buckets. When ``FAN`` folders of a level are there they are merged
into one of the next level, named after its last batch. Which folders these are follows from the number
of the batch alone, so a replayed batch writes the same folders again and adds nothing twice. After
``n`` batches a reader finds the table in some ``FAN * log(n)`` folders.

Folders that a fold of an earlier batch has taken in are removed; those of the last batch stay until the
next one, since that batch may be replayed. A folder counts when its ``_SUCCESS`` is there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statlake.session import list_paths, path_exists, read_text, remove_path, write_text

LEVEL, BATCH, BUCKET = "level", "batch_id", "bucket"
FAN, BUCKETS = 4, 4
BASE = 63  # the level of a folder that holds all batches up to its own
SCHEMA_FILE = "schema.json"

Merge = Callable[[DataFrame], DataFrame]
Folder = tuple[int, int]  # (level, last batch)


def folder_path(path: str, folder: Folder) -> str:
    return f"{path}/{LEVEL}={folder[0]}/{BATCH}={folder[1]}"


def whole_folders(spark: SparkSession, path: str) -> set[Folder]:
    """The folders that are written to their end."""
    found = list_paths(spark, f"{path}/{LEVEL}=*/{BATCH}=*/_SUCCESS")
    names = [p.split("/")[-3:-1] for p in found]
    return {(int(level.split("=")[1]), int(batch.split("=")[1])) for level, batch in names}


def first_batch(folder: Folder) -> int:
    """The first batch that a folder holds, as far as no base holds it."""
    level, last = folder
    return 0 if level == BASE else last + 1 - FAN**level


def covering(have: set[Folder], before: int, start: int = 0) -> list[Folder]:
    """The fewest folders that hold the batches from ``start`` to before ``before``, each batch once."""
    base = max((last for level, last in have if level == BASE and last < before), default=-1)
    out = [(BASE, base)] if base >= start else []
    place = max(start, base + 1)
    while place < before:
        fits = [f for f in have if f[0] != BASE and place <= f[1] < before and _begins(f, place, base)]
        if not fits:
            raise FileNotFoundError(f"no folder of batch {place}")
        out.append(max(fits))
        place = out[-1][1] + 1
    return out


def _begins(folder: Folder, place: int, base: int) -> bool:
    # What a base holds is in no other folder, so the first one behind it may be short.
    return first_batch(folder) == place or (place == base + 1 and first_batch(folder) < place)


def bucket_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _write(df: DataFrame, path: str, folder: Folder, keys: Sequence[str]) -> None:
    split = df.withColumn(BUCKET, bucket_of(keys)).hint("rebalance", BUCKET)
    split.write.mode("overwrite").partitionBy(BUCKET).parquet(folder_path(path, folder))


def write_delta(df: DataFrame, path: str, batch_id: int, keys: Sequence[str], merge: Merge) -> None:
    """Write the rows of a batch, and the folds that end with it.

    ``merge`` makes one row of the rows of a key, which come with their ``batch_id``.
    """
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/{SCHEMA_FILE}"):
        write_text(spark, path, SCHEMA_FILE, df.schema.json())
    remove_folded(spark, path, batch_id)
    _write(df, path, (0, batch_id), keys)
    level = 1
    while (batch_id + 1) % FAN**level == 0:
        lower = {f for f in whole_folders(spark, path) if f[0] < level or f[0] == BASE}
        start = batch_id + 1 - FAN**level
        parts = [f for f in covering(lower, batch_id + 1, start) if f[0] != BASE]
        if parts:
            _write(merge(_read(spark, path, parts)).select(*df.columns), path, (level, batch_id), keys)
        level += 1


def write_base(df: DataFrame, path: str, batch_id: int, keys: Sequence[str]) -> None:
    """The whole table up to a batch as the first folder of a new path."""
    write_text(df.sparkSession, path, SCHEMA_FILE, df.schema.json())
    _write(df, path, (BASE, batch_id), keys)


def remove_folded(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove folders that a fold of a batch before this one holds."""
    have = whole_folders(spark, path)
    folds = [f for f in have if 0 < f[0] < BASE and f[1] < batch_id]
    for level, last in have:
        if any(level < f[0] and first_batch(f) <= last <= f[1] for f in folds):
            remove_path(spark, folder_path(path, (level, last)))


def _read(spark: SparkSession, path: str, folders: list[Folder], buckets: Sequence[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(read_text(spark, f"{path}/{SCHEMA_FILE}")))
    places = StructType().add(LEVEL, "integer").add(BATCH, "long").add(BUCKET, "integer")
    reader = spark.read.schema(StructType(schema.fields + places.fields)).option("basePath", path)
    df = reader.parquet(*[folder_path(path, f) for f in folders])
    df = df if buckets is None else df.where(F.col(BUCKET).isin(list(buckets)))
    return df.drop(LEVEL, BUCKET)


def last_batch(spark: SparkSession, path: str) -> int:
    """The last batch of a table."""
    have = whole_folders(spark, path)
    if not have:
        raise FileNotFoundError(f"no folder of a batch: {path}")
    return max(last for _, last in have)


def read_deltas(
    spark: SparkSession, path: str, before: int | None = None, buckets: Sequence[int] | None = None
) -> DataFrame | None:
    """The rows of all batches, or of those before one, with their ``batch_id``; of some buckets.

    None where there are none because none can be yet. A stream past its first batch whose earlier
    folders are gone would forget what they hold: that is an error.
    """
    if before == 0:
        return None
    end = last_batch(spark, path) + 1 if before is None else before
    return _read(spark, path, covering(whole_folders(spark, path), end), buckets)

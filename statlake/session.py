"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that the operators rely on. Sizes are left to the cluster: AQE coalesces and splits
# shuffle partitions from the real sizes, and broadcasts only what it has measured to be small.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Shuffle files of a query go when it ends. Else they stay until the driver's garbage collector finds
# them unused, and a job of several outputs holds the files of all of them.
RELEASED_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(cores: int | str = 8, app: str = "statlake", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for what runs inside; what was set before is set again."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Where it is unset, a run on one machine (tests) gets a new local folder. On a cluster executors
    would each write to their own disk there, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="statlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created until a job writes there."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged_rows(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written below the shared folder, for what runs inside; kept if that fails, else removed."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    yield spark.read.parquet(path)
    remove_path(spark, path)


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a path, which may hold wildcards, in its own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match, which may be none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def read_text(spark: SparkSession, name: str) -> str:
    """All of a small file."""
    return spark.read.text(name, wholetext=True).first()[0]


def remove_path(spark: SparkSession, name: str) -> None:
    """Remove a folder with all that is in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def move_path(spark: SparkSession, name: str, to: str) -> None:
    """Put a folder in the place of another, which is removed."""
    remove_path(spark, to)
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (name, to))
    if not old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"could not rename {name} to {to}")


def write_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small file, whole or not at all: it gets its name when all of it is written."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    new, final = path(f"{folder}/_{name}"), path(f"{folder}/{name}")
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(new, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files.delete(final, False)
    if not files.rename(new, final):
        raise OSError(f"could not rename {new} to {final}")


def next_state(path: str) -> str:
    """Where a state document is written before it takes its place."""
    return f"{path.rstrip('/')}.next"

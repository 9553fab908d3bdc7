"""Cutting lineage through the cluster's shared checkpoint folder.

Reliable checkpoints are written to ``spark.checkpoint.dir`` (a folder every
executor and the driver can reach), so a materialised frame survives the loss
of the executors that computed it. A folder of our own is chosen only when the
session has none and Spark runs in local mode, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Scratch folders of this process that have not been deleted yet.
_FOLDERS: set[str] = set()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder shared by the cluster"
        )
    folder = tempfile.mkdtemp(prefix="basketry-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used where a plan reads the same derived data in several passes (the two
    passes of PCY read the baskets twice, as the reference reads its basket
    file twice). One job writes it; later reads are column-pruned scans with
    exact size statistics, and the data outlives any executor.
    """
    return materialize_with_folder(df)[0]


def scratch_folder(spark: SparkSession) -> str:
    """A new, unique folder name under the shared checkpoint folder.

    Every folder is remembered until ``remove_folder`` or ``release_scratch``
    deletes it, so intermediate data never outlives its last use unnoticed.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/basketry-{uuid.uuid4().hex}"
    _FOLDERS.add(folder)
    return folder


def materialize_with_folder(df: DataFrame) -> tuple[DataFrame, str]:
    """``materialize`` that also returns the folder written, for ``remove_folder``."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.mode("errorifexists").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def remove_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder written by ``materialize_with_folder`` (any Hadoop file system)."""
    _FOLDERS.discard(folder)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def scratch_mark() -> frozenset[str]:
    """The scratch folders that exist now; see ``release_scratch``."""
    return frozenset(_FOLDERS)


def release_scratch(spark: SparkSession, since: frozenset[str] = frozenset()) -> int:
    """Delete the scratch folders made after ``since = scratch_mark()`` (all by
    default). Call it when every result that reads them has been written."""
    folders = _FOLDERS - since
    for folder in folders:
        remove_folder(spark, folder)
    return len(folders)

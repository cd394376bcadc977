"""Session factory and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def create_session(
    app_name: str = "cardlens",
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC timestamps and adaptive execution.

    The master and the memory sizes belong to the deployment (``spark-submit``
    or ``spark-defaults``), so they are never set here. Without
    ``shuffle_partitions`` the cluster's own setting applies, which the jobs raise
    to fit their input and adaptive execution lowers again where a shuffle is small.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: list[str] = []
_scratch: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine, which goes when the
    process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _local_scratch:
        _local_scratch.append(tempfile.mkdtemp(prefix="cardlens-"))
        atexit.register(shutil.rmtree, _local_scratch[0], ignore_errors=True)
    return _local_scratch[0]


def scratch_folder(spark: SparkSession, name: str) -> str:
    """New path under the shared folder."""
    root = f"{shared_folder(spark)}/cardlens-{uuid.uuid4().hex}"
    _scratch.add(root)
    return f"{root}/{name}"


@contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch folders made inside the block, which has to finish its actions."""
    before = set(_scratch)
    try:
        yield
    finally:
        for root in _scratch - before:
            _delete(spark, root)


def _delete(spark: SparkSession, root: str) -> None:
    if urlparse(root).scheme in ("", "file"):
        shutil.rmtree(urlparse(root).path, ignore_errors=True)
    else:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _scratch.discard(root)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder, as Parquet.

    For a small result of a large scan that several branches read: a lost executor costs a
    re-read of its files, and readers get statistics and only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

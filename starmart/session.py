"""Sessions for local runs, and the shared scratch folder of the session in use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, app: str = "starmart", warehouse: str | None = None
) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's shared checkpoint folder; removed when the application ends.

    Only where the session names none (a local run) is a local temporary folder used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="starmart-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(folder)
    return path


@contextmanager
def database(spark: SparkSession, name: str) -> Iterator[tuple[str, str]]:
    """A schema for a while, and the scratch folder for its tables; what was read from these stays readable."""
    path = scratch_path(spark, name)
    schema = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{path}/catalog'")
    try:
        yield schema, path
    finally:
        spark.sql(f"DROP DATABASE {schema} CASCADE")

"""Session helpers: a default local session and the shared staging folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def get_session(app: str = "newsloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    A temporary folder stands in for it only on a local master with the setting absent.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="newsloom-")
    return _local_roots[context.applicationId]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the staging folder."""
    return f"{staging_root(spark)}/newsloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session, for drivers that did not pass it as a py-file."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        source = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        base = os.path.join(tempfile.mkdtemp(prefix="newsloom-code-"), "newsloom")
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", source, "newsloom"))
        _shipped.add(app)


def unstage(spark: SparkSession) -> None:
    """Delete what this session has staged; call it after the last reader of its results."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/newsloom/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet and read it back.

    Used where several later steps read one costly result: the work is done once, the lineage
    ends at a table that outlives lost executors, and each reader prunes columns at the scan.
    """
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

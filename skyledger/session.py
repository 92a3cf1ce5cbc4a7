"""Session settings the expressions rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings that change results, so every entry point applies them.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to an existing session."""
    for key, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "skyledger", **options: str) -> SparkSession:
    """Build (or reuse) a session with the required settings applied."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in options.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


@contextmanager
def with_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting for the actions inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Scratch folders made since the innermost open :func:`scratch_scope`.
_made: ContextVar[list[str] | None] = ContextVar("scratch folders", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only on a local master, where driver and executors are one process, is a folder made
    if none is named, once per application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise RuntimeError(
                f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share"
            )
        folder = tempfile.mkdtemp(prefix="skyledger-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/skyledger/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside, also when the work in between fails."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in made:
            target = jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(conf).delete(target, True)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage in a way that outlives a lost executor, and gives the
    planner the true size of the result when it picks a join strategy.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

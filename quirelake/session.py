"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "quirelake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session defaults to a session somebody else created."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder path below the cluster's shared checkpoint folder.

    A session on one machine without that setting gets a folder of its own for
    it, which is removed when the program ends; a cluster must have the setting.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or _own_folder(spark)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Folders made here, by application.
_own: dict[str, str] = {}


def _own_folder(spark: SparkSession) -> str:
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own:
        _own[application] = tempfile.mkdtemp(prefix="quirelake-")
        atexit.register(shutil.rmtree, _own[application], ignore_errors=True)
    return _own[application]


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of all folders directly below a path, in order; an absent path has none."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target) if status.isDirectory())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete tables below a path: folders whose write has been committed."""
    return [name for name in subfolders(spark, path) if exists(spark, f"{path}/{name}/_SUCCESS")]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder the program wrote for itself and has no more use for."""
    files, target = _file_system(spark, path)
    files.delete(target, True)

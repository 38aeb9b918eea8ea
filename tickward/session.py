"""Session settings and the shared folder for intermediate data."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Wall-clock text on the wire carries no zone and means UTC, so days and casts are UTC too.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "tickward", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    ``conf`` keys use ``__`` for ``.``: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process may run without the setting; it
    then gets a folder of its own, removed when the process ends.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        made = tempfile.mkdtemp(prefix="tickward-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _LOCAL_ROOTS[context.applicationId] = made
    return _LOCAL_ROOTS[context.applicationId]


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"

"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and benches; on a cluster, pass the session you already have."""
    builder = (
        SparkSession.builder.master(master)
        .appName("topicloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none, as in local tests, one is made and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="topicloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path not used before, under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless they find it installed.

    Workers get the path in their environment; on a cluster it must exist on every
    machine, or the package be installed or sent with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])

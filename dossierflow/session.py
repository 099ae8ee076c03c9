"""Session settings for local runs, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster use the session
    that the cluster gives; nothing in the library depends on these settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("dossierflow")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        # plain Java case mapping: same results here, and much cheaper per string
        .config("spark.sql.icu.caseMappings.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A folder all executors can read, private to this application.

    Taken from ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="dossierflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def new_scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

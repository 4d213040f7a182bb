"""Session helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def pin_utc(spark: SparkSession) -> SparkSession:
    """Read and write every instant as UTC, whatever zone the machine is in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def is_utc(spark: SparkSession | None = None) -> bool:
    """Whether the session reads wall clocks as UTC."""
    spark = spark or SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in UTC_NAMES


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs run inside the block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def local_session(cores: str = "8", app: str = "loadpanel", **conf: str) -> SparkSession:
    """A session for tests and the local benchmark; clusters bring their own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return pin_utc(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers, unless their path names its folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known and context.applicationId not in _SHIPPED:
        folder = tempfile.mkdtemp(prefix="loadpanel-")
        context.addPyFile(shutil.make_archive(f"{folder}/loadpanel", "zip", root, "loadpanel"))
        _SHIPPED.add(context.applicationId)
    return spark

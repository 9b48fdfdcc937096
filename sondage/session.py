"""Session settings shared by the tests, the bench and interactive use."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that hold at any size. Shuffle width, memory and the checkpoint
# folder belong to the cluster and are left to it.
PORTABLE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, name: str = "sondage") -> SparkSession:
    """A small session for tests and the bench on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in PORTABLE.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers import it by name.

    Not needed where it is installed on them or passed with ``--py-files``.
    """
    top = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="sondage-package-")
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{top.name}", "zip", top.parent, top.name))


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    run = spark.sparkContext.applicationId
    if run not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[run] = tempfile.mkdtemp(prefix="sondage-")
    return _LOCAL_FOLDERS[run]

"""Sessions, and the way of this package to the executors."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(app: str = "textmill", **conf: str) -> SparkSession:
    """A session with the settings that results rely on; conf adds to them."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> None:
    """Sees to a folder for checkpoints that executors share: spark.checkpoint.dir, a temporary one in a local session where that is unset; any other session is refused."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    shared, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not shared and not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir is not set: with master {master} it must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once a context: Python functions in plans refer to its modules by name."""
    sc = spark.sparkContext
    if getattr(sc, "_textmill_shipped", False):
        return
    root = Path(__file__).parent
    out = os.path.join(tempfile.mkdtemp(prefix="ship-"), "textmill.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(out)
    sc._textmill_shipped = True

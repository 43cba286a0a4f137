"""Sessions with the settings that the library is tuned for."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "foliate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; conf overrides (dots as double underscores)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return b.config(map=base | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for clusters where it isn't installed."""
    sc = spark.sparkContext
    if getattr(sc, "_foliate_sent", False):
        return
    root = Path(__file__).resolve().parent
    out = os.path.join(tempfile.mkdtemp(prefix="foliate"), "foliate_package.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(out)
    sc._foliate_sent = True


def materialised(df: DataFrame) -> DataFrame:
    """Run df once and cut its lineage with a reliable checkpoint in the folder that the cluster names in spark.checkpoint.dir.

    For tables that a plan reads several times. Where the setting is missing, a folder of the machine will do only if everything
    runs there (a local master).
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        found = sc.getConf().get("spark.checkpoint.dir", None) or df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not found and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(found or "file://" + tempfile.mkdtemp(prefix="foliate-checkpoints"))
    return df.checkpoint()

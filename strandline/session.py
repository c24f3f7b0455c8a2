"""Session helpers: ship this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch of rows on its way to a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20
_ROOT = Path(__file__).resolve().parent


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: a no-op where PYTHONPATH already does, else addPyFile of its sources.

    Batches for them are bounded by bytes, as texts may be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    on_path = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    sc = spark.sparkContext
    if os.path.realpath(_ROOT.parent) in on_path or getattr(sc, "_strandline_shipped", False):
        return
    name = os.path.join(tempfile.mkdtemp(), f"{_ROOT.name}.zip")
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(_ROOT.rglob("*.py")):
            z.write(p, p.relative_to(_ROOT.parent))
    sc.addPyFile(name)
    sc._strandline_shipped = True


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once, in the cluster's shared checkpoint folder; a temporary one only under a local master."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint(eager=True)

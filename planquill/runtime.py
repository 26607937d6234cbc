"""Making this package importable where Spark runs its Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the workers, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_planquill_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="planquill-")) / "planquill.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._planquill_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; a temporary one only where there is none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        named = "file://" + tempfile.mkdtemp(prefix="planquill-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named

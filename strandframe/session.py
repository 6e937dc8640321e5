"""What a session needs before it runs this package's Python code on executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once for each application, so that they can import it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="strandframe-")) / "strandframe_package.zip"
        with zipfile.ZipFile(target, "w") as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, path.relative_to(root.parent))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, below the folder that all machines share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only where the setting is missing (on one machine, as in
    tests) a temporary folder is made.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-stage-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back; compression: Parquet's, if not the session's.

    It cuts the lineage: what follows survives the loss of any executor without running df again, and several
    consumers don't each run it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)

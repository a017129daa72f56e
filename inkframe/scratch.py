"""Lineage cuts that survive the loss of executors.

Iterative operators write their state as Parquet tables below the folder that the session names in
``spark.checkpoint.dir`` (shared by all executors) and read them back. A written table is computed
once, is columnar and compressed, and gives Catalyst true sizes for its join choices.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only on a local master where none is set."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="inkframe-checkpoints-")
    sc.setCheckpointDir(root)
    return root


_OPEN: dict[str, SparkSession] = {}


def _delete(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def close_all() -> None:
    """Delete the folders of all runs of this driver: their results can be read until it ends."""
    for path, spark in list(_OPEN.items()):
        try:
            if path.startswith(("/", "file:")):
                shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)
            else:
                _delete(spark, path)
        except Exception:  # the session is gone already: its own cleaner has the folder
            continue
        _OPEN.pop(path, None)


class Scratch:
    """Tables of one run of an operator, in one folder of their own. `close` deletes them once the results
    have been written; what is left goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.dir = f"{checkpoint_root(spark).rstrip('/')}/inkframe/{name}-{uuid.uuid4().hex}"
        self.count = 0
        _OPEN[self.dir] = spark

    def close(self) -> None:
        _OPEN.pop(self.dir, None)
        _delete(self.spark, self.dir)

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.dir}/{self.count:04d}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._inkframe_path = path
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        """Delete tables that no later step reads."""
        for df in frames:
            if path := getattr(df, "_inkframe_path", None):
                _delete(self.spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

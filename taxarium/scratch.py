"""Written tables in the shared folder that the session names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files of a written table go when it is written.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir.  Where it is unset, a temporary one on local masters and an error on clusters."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="taxarium-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Scratch:
    """Tables of one operation.  They cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/taxarium-{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.held: set[str] = set()

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:03d}"
        held = self.spark.conf.get(_CLEAN, None)
        self.spark.conf.set(_CLEAN, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEAN, held) if held is not None else self.spark.conf.unset(_CLEAN)
        self.held.add(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that no later step reads."""
        self._delete(df.scratch_path)

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all tables but these: what is returned reads no others."""
        for path in self.held - {t.scratch_path for t in tables}:
            self._delete(path)

    def _delete(self, name: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.held.discard(name)

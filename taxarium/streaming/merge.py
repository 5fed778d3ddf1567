"""Release tables that arrive as files: each batch is merged into the snapshot, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.compare import upsert


def latest(batch: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key in a batch."""
    rest = [c for c in batch.columns if c != key]
    return batch.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def merge_files(spark: SparkSession, source: str, schema: StructType, target: str, key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Merges all new files of a folder into versions of a snapshot under ``target``, then stops.

    A batch writes version ``batch + 1`` from the version before it, so a batch that is run again
    after a failure writes the same version.  ``current`` reads the last one.
    """
    columns = [f.name for f in schema.fields if f.name != key]

    def merge(batch: DataFrame, number: int) -> None:
        new = latest(batch, key, order)
        old = batch.sparkSession.read.parquet(f"{target}/{number:06d}") if number else new.limit(0)
        upsert(old, new, key, columns).write.mode("overwrite").parquet(f"{target}/{number + 1:06d}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str) -> DataFrame:
    """The last version of the snapshot."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    names = [f.getPath().getName() for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
    return spark.read.parquet(f"{target}/{max(n for n in names if n.isdigit())}")

"""Small helpers shared by the operators: Arrow row mapping, word rules, keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch, scratch_root  # noqa: F401

#: ASCII white space; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
#: Stands for a null id inside an operator; it sorts before every real id.
NULL_ID = -(2**63)


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """All columns of docs as one struct ``row``, so that no name of theirs can clash; ``row.*`` gives them back."""
    return docs.select(F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("row"), *more)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_key(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def id_back(name: str) -> Column:
    return F.when(F.col(name) != NULL_ID, F.col(name))


def words(text: Column) -> Column:
    """Array of the runs of non-white-space characters (ASCII white space), in order."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0)).cast("long")


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str, flush_bytes: int = 8 << 20) -> DataFrame:
    """mapInArrow with tuples on both sides.  Strings come in as UTF-8 bytes; output leaves in small batches."""
    out_schema = _arrow_schema(df.sparkSession, schema)
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for low in range(0, batch.num_rows, 512):
                    part = batch.slice(low, 512)
                    cols = [c.cast(pa.binary()) if pa.types.is_string(c.type) else c for c in part.columns]
                    yield from zip(*(c.to_pylist() for c in cols))

        held: list[tuple] = []
        size = 0
        try:
            for row in fn(rows()):
                held.append(row)
                size += 64 + sum(len(v) for v in row if isinstance(v, (bytes, str)))
                if size >= flush_bytes or len(held) >= 8192:
                    yield to_batch(held)
                    held, size = [], 0
            if held:
                yield to_batch(held)
        finally:
            held.clear()
            give_back()

    def to_batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), out_schema)], schema=out_schema)

    return df.mapInArrow(run, schema)


#: Rows and bytes of an Arrow batch, where the session has Spark's defaults: rows here are whole texts.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b")}


def ship_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it, and send them small batches."""
    for name, (default, ours) in _BATCHES.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, ours)
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH", ""), root]))


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Python workers wait for later stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))

"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

#: Rows, and bytes of text beyond a first row, that a task turns into Python
#: objects at a time.
ROWS_AT_A_TIME = 256
BYTES_AT_A_TIME = 16 << 20


def quoted(name: str) -> str:
    """A column's name as an expression, whatever signs are in it."""
    return "`" + name.replace("`", "``") + "`"


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` whatever signs are in the columns' names: ``run`` finds
    and gives columns by their place."""
    plain = [f"c{k}" for k in range(len(schema))]

    def by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.rename_columns(plain)

    numbered = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    out = T.StructType([T.StructField(c, f.dataType) for c, f in zip(plain, schema)])
    return numbered.mapInArrow(by_place, out).toDF(*schema.fieldNames())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders made within each ``passing_copies`` that is open, innermost last.
_passing: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared one."""
    return noted(scratch_dir(spark, name))


def noted(path: str) -> str:
    """``path``, on the list of the innermost ``passing_copies``."""
    if _passing:
        _passing[-1].append(path)
    return path


@contextmanager
def passing_copies(spark: SparkSession) -> Iterator[list[str]]:
    """Removes at its end the folders made within it, but those taken off
    the list it gives: for copies that nothing reads any more."""
    paths: list[str] = []
    _passing.append(paths)
    try:
        yield paths
    finally:
        _passing.pop()
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the cluster's shared folder and read it back: cuts
    the lineage with files every executor can reach."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, column: str | int) -> Iterator[tuple[int, list[str]]]:
    """``(first row, texts)`` over a batch, a bounded number of rows and bytes
    at a time; null texts come as empty strings."""
    values = batch.column(column if isinstance(column, int) else batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + BYTES_AT_A_TIME, "right"))
        stop = min(max(stop, start + 1), start + ROWS_AT_A_TIME, batch.num_rows)
        yield start, [t or "" for t in values.slice(start, stop - start).to_pylist()]
        start = stop


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's decimal text is divisible by 5 (a null
    id counts as the empty text, whose crc32 is 0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0

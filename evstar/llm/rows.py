"""Choosing rows of stored documents without moving their texts.

A row of a file is known by the file's path and its place in it. A choice of
rows is written as lists of places, one folder for each file and run of
places; a task that scans a file reads the lists of what it scans, and no
other, so no text is exchanged and no list has to fit anywhere at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, scratch, stored

#: Places of one list: what a task holds of a choice at a time.
ROWS_IN_A_LIST = 1 << 22


def as_files(docs: DataFrame) -> DataFrame:
    """``docs`` where it is a plain read of Parquet files, else a copy."""
    if docs._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            docs.select("_metadata.row_index")
            return docs
        except AnalysisException:  # a table that is not in Parquet files
            pass
    return stored(docs, "rows")


def with_place(docs: DataFrame, file: str, place: str) -> DataFrame:
    """``docs`` (read from files) with each row's file and place in it."""
    return docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))


def _list_of(folder: str, part: str, run: int) -> np.ndarray:
    store, path = fs.FileSystem.from_uri(f"{folder}/part={part}/run={run}")
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    files = [f.path for f in found if f.base_name.endswith(".parquet")]
    parts = [pq.read_table(f, columns=["place"], filesystem=store, partitioning=None)["place"].to_numpy() for f in files]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def keep_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` (read from files) that ``chosen`` names by
    ``file`` and ``place``; all columns as they are."""
    folder = scratch(docs.sparkSession, "chosen-rows")
    lists = chosen.select(
        F.md5("file").alias("part"), F.expr(f"place div {ROWS_IN_A_LIST}").alias("run"), "place"
    )
    lists.repartition("part", "run").sortWithinPartitions("part", "run").write.partitionBy("part", "run").parquet(folder)
    n = len(docs.columns)
    rows = docs.select("*", F.md5("_metadata.file_path"), "_metadata.row_index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept = None, np.empty(0, np.int64)
        for batch in batches:
            parts, places = batch.column(n), batch.column(n + 1).to_numpy()
            runs = places // ROWS_IN_A_LIST
            coded = parts.dictionary_encode()
            codes = coded.indices.to_numpy()
            flags = np.zeros(len(places), bool)
            for code, number in sorted(set(zip(codes.tolist(), runs.tolist()))):
                of = (coded.dictionary[code].as_py(), number)
                if of != held:
                    held, kept = of, _list_of(folder, *of)
                mine = (codes == code) & (runs == number)
                flags[mine] = np.isin(places[mine], kept)
            yield batch.select(list(range(n))).filter(pa.array(flags))

    return map_batches(rows, run, docs.schema)

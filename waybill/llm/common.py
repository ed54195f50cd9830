"""Helpers shared by the operators: Arrow text buffers, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill import session

#: Bytes of text that a task works on at once; one longer document is a piece of its own.
CHUNK_BYTES = 4 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows by way of Parquet in the shared folder: lineage ends, lost executors repeat nothing."""
    path = session.work_dir(df.sparkSession, name)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.written_path = path
    return made


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``written`` whose last reader is written itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in a row, and each row's offset in them; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of ``size`` bytes of text each, or of one longer row."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
            step = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64) // size
            cuts = np.flatnonzero(np.diff(step)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                yield batch.slice(a, b - a)


def with_arrow(df: DataFrame, work: Callable, schema: str, keep: list[str], text: str = "text") -> DataFrame:
    """``work`` gets batches of the columns ``keep`` and the text, and yields batches of ``schema``."""
    names = [*dict.fromkeys([*keep, text])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(chunks(batches, text))

    return df.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(run, schema)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of ``start .. start + count - 1``, range after range."""
    ends = np.cumsum(counts)
    if not len(ends):
        return np.zeros(0, dtype=np.int64)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1])

"""Reading and handing over tables; shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.session import scratch_path

# words are runs of anything but these bytes
WORD_SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, so a
    lost executor costs no recomputation, and later readers scan columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str):
    return F.coalesce(F.col(column), F.lit(""))


def whole_row(df: DataFrame):
    """All columns as one struct, so that none clashes with an operator's own."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def sliced(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose text column holds about ``max_bytes``
    (one longer text makes a slice of its own): bounds a worker's memory."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = [n or 0 for n in pa.compute.binary_length(col).to_pylist()]
        at = total = 0
        for i, n in enumerate(sizes):
            if i > at and total + n > max_bytes:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += n
        if len(sizes) > at:
            yield batch.slice(at)

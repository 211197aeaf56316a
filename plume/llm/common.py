"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.session import ensure_checkpoint_dir

#: ASCII white space \x20 \x09-\x0D is what ``bytes.split()`` splits on
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: write to the shared checkpoint folder and read back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_fold(col: str, folds: int) -> Column:
    """crc32 of a column's text modulo ``folds`` (null: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(folds)


def whole_row(df: DataFrame) -> Column:
    """All columns of a table as one struct, whatever their names."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in df.columns]
    return F.struct(*[F.col(q).alias(c) for q, c in zip(quoted, df.columns)])


def columns_of(row: str, names: list[str]) -> list[Column]:
    """The columns back from a struct made by ``whole_row``."""
    return [F.col(row).getField(c).alias(c) for c in names]


def with_types(df: DataFrame, **types: str) -> DataFrame:
    """Cast the named columns, so batches have one known Arrow type."""
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    return df.select(*[col.cast(types[c]).alias(c) if c in types else col.alias(c) for c, col in quoted.items()])


def slices(batches: Iterator[pa.RecordBatch], text: str,
           max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows with about ``max_bytes`` of text.

    A single longer text is a slice of its own: texts are never cut.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.binary_length(col).fill_null(0)).astype(np.int64)
        run = (np.cumsum(sizes) - sizes) // max_bytes
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [x or b"" for x in col.to_pylist()]


def ints_of(batch: pa.RecordBatch, name: str, null: int = -1) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(name))
    return np.asarray(col.fill_null(null)).astype(np.int64)


def splitmix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over uint64 arrays (counter-based random bits)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

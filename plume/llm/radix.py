"""Distributed least-significant-digit radix sort: exact positions of all rows.

A pass looks at one digit of the composite key.  Every slice of the present
order counts its rows per digit value; prefix sums over (digit value, slice)
are the global offsets, and a row's destination is its offset plus its place
among the equal digits of its slice, so a pass is stable.  After the passes of
all digits, from the last key's lowest to the first key's highest, a row's
position is its rank.  Rows travel once a pass, dealt by slice; a task sorts whole
slices, which are equally long whatever the keys are.

Each pass is written to the shared checkpoint folder: positions stay as they are
when an executor is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plume.llm.common import cut

#: bits of a digit: 4,096 counters a slice
DIGIT_BITS = 12


@dataclass(frozen=True)
class Key:
    """A bigint sort key without nulls."""

    name: str
    descending: bool = False


def _digits(key: Key, low: int, high: int, bits: int) -> list[Column]:
    """The digits of a key, lowest first, whose order is that of the key; none
    if all rows agree on it."""
    col = F.col(key.name)
    if high - low < 1 << 63:
        value = F.lit(high) - col if key.descending else col - F.lit(low)
        width = (high - low).bit_length()
    else:  # the sign bit turned: unsigned order
        value = col.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))
        value = F.bitwise_not(value) if key.descending else value
        width = 64
    mask = F.lit((1 << bits) - 1).cast("bigint")
    return [F.shiftrightunsigned(value, at).bitwiseAND(mask) for at in range(0, width, bits)]


def _place(rows: pa.Table, offsets: pa.Table) -> pa.Table:
    """A stable counting sort of one slice: each row's destination."""
    rows = rows.drop_columns(["_slice"]).sort_by("_at")
    digit = np.asarray(rows["_digit"])
    order = np.argsort(digit, kind="stable")
    equal = digit[order]
    place = np.empty(len(digit), np.int64)
    place[order] = np.arange(len(digit)) - np.searchsorted(equal, equal)
    first = np.zeros(int(digit.max()) + 1, np.int64)
    first[np.asarray(offsets["_value"])] = np.asarray(offsets["_offset"])
    to = pa.array(first[digit] + place)
    return rows.drop_columns(["_digit", "_at"]).append_column("_at", to)


def _pass(rows: DataFrame, digit: Column, slice_rows: int) -> DataFrame:
    """One stable counting-sort pass; ``_at`` becomes the destination."""
    schema = rows.schema
    rows = rows.withColumn("_slice", F.floor(F.col("_at") / F.lit(slice_rows))).withColumn("_digit", digit)
    counts = rows.groupBy("_slice", "_digit").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_digit").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # the offsets of the digit values: at most one row a value
    values = counts.groupBy("_digit").agg(F.sum("_n").alias("_all"))
    lower = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    values = values.select("_digit", F.coalesce(F.sum("_all").over(lower), F.lit(0)).alias("_base"))
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))) \
        .join(F.broadcast(values), "_digit") \
        .select(F.col("_slice").alias("_of"), F.col("_digit").alias("_value"), (F.col("_base") + F.col("_before")).alias("_offset"))
    return rows.groupBy("_slice").cogroup(offsets.groupBy("_of")).applyInArrow(_place, schema)


def positions(rows: DataFrame, keys: list[Key], out: str, bits: int = DIGIT_BITS,
              slice_rows: int | None = None) -> DataFrame:
    """``rows`` with ``out``: 0-based position in the order of ``keys``.

    Keys are bigint columns without nulls; rows equal in all keys get
    neighbouring positions in some order.  A slice holds ``slice_rows`` rows (by
    default the rows of a shuffle partition, 256 to 131,072).  An empty table
    gives an empty result.  Column names starting with ``_`` are the sort's own.
    """
    names = rows.columns
    rows = cut(rows.withColumn("_at", F.monotonically_increasing_id()))
    bounds = rows.agg(F.count(F.lit(1)).alias("n"), *[f(k.name).alias(f"{f.__name__}{i}") for i, k in enumerate(keys)
                                                     for f in (F.min, F.max)]).first()
    if not bounds["n"]:
        return rows.withColumnRenamed("_at", out)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slice_rows = slice_rows or min(1 << 17, max(256, -(-bounds["n"] // parts)))
    plan = [(k, bounds[f"min{i}"], bounds[f"max{i}"]) for i, k in enumerate(keys)]
    digits = [d for k, low, high in reversed(plan) for d in _digits(k, low, high, bits)]
    for digit in digits or [F.lit(0).cast("bigint")]:  # one pass numbers rows that are all equal
        rows = cut(_pass(rows, digit, slice_rows))
    return rows.select(*names, F.col("_at").alias(out))

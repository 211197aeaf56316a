"""CSV with inferred column types.

A type fits a column if it fits every value; the narrowest fitting type wins.
Each value is turned into the set of types it fits (a bit mask) and the column's
set is the bitwise AND of these, so the whole inference is one aggregate with one
expression per column, over all rows and all files.

Numbers with leading zeros (``01001``) are codes and stay text.  Blank fields and
``NA`` are missing and fit every type; a column without values is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: from the narrowest to the widest (fixed values: name, pattern)
TYPES = [
    ("boolean", r"^(TRUE|FALSE|T|F)$"),
    ("bigint", r"^[+-]?(0|[1-9][0-9]*)$"),
    ("double", r"^[+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"),
    ("string", ""),
]


def _field(c: str) -> Column:
    """The trimmed text of a field; missing is null."""
    text = F.trim(F.col("`" + c.replace("`", "``") + "`"))
    return F.when(~text.isin("", "NA"), text)


def _typed(text: Column, name: str) -> Column:
    if name == "string":
        return text
    if name == "boolean":
        return F.when(text.isin("TRUE", "T"), True).when(text.isin("FALSE", "F"), False)
    return text.try_cast(name)


def _fits(text: Column) -> Column:
    """Bit k is set if type k fits the text."""
    mask = F.lit(0)
    for k, (name, pattern) in enumerate(TYPES):
        ok = F.lit(True) if name == "string" else text.rlike(pattern) & _typed(text, name).isNotNull()
        mask = mask + F.when(ok, F.lit(1 << k)).otherwise(F.lit(0))
    return F.when(text.isNotNull(), mask)


def infer_types(text: DataFrame) -> dict[str, str]:
    """Column -> type of a table of text columns, in one pass."""
    row = text.agg(*[F.bit_and(_fits(_field(c))).alias(f"m{i}") for i, c in enumerate(text.columns)]).first()
    out = {}
    for i, c in enumerate(text.columns):
        mask = row[f"m{i}"]
        out[c] = "string" if mask is None else next(n for k, (n, _) in enumerate(TYPES) if mask >> k & 1)
    return out


def read_inferred(spark: SparkSession, path: str | list[str], types: dict[str, str] | None = None,
                  **options) -> DataFrame:
    """CSV with a header, its columns typed by ``infer_types``; ``types`` fixes
    some of them.  ``options`` go to the CSV reader."""
    text = spark.read.options(header=True, **options).csv(path)  # without inference: all text
    found = {**infer_types(text), **(types or {})}
    return text.select(*[_typed(_field(c), found[c]).alias(c) for c in text.columns])

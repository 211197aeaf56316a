"""Scans and sinks.

CSV is read with explicit schemas here (``infer`` finds types where there is
none).  Gzip files are not splittable, so a gz scan is
one task per file; callers repartition after the scan (or convert once to
parquet with ``to_parquet``) before any wide work.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str,
             date_format: str | None = None, recursive: bool = False,
             glob: str | None = None) -> DataFrame:
    """Typed CSV scan (plain or .gz), optionally a whole directory
    tree filtered by file-name glob; blanks around fields are trimmed (N15)."""
    r = (spark.read.schema(schema)
         .option("header", True)
         .option("ignoreLeadingWhiteSpace", True)
         .option("ignoreTrailingWhiteSpace", True)
         .option("mode", "PERMISSIVE"))
    if date_format:
        r = r.option("dateFormat", date_format)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.csv(path)


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: StructType | str,
                     **options) -> DataFrame:
    """S2/S3 with the lines that do not fit kept: ``_reject`` holds the raw line
    of such a row (else null) and ``_file`` the file it comes from."""
    typed = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    whole = StructType([*typed.fields, StructField("_reject", StringType())])
    r = spark.read.schema(whole).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord="_reject", ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True, **options)
    return r.csv(path).withColumn("_file", F.col("_metadata.file_name"))


def split_rejects(checked: DataFrame, base: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(good rows, rejects, counts) of a checked scan, written in one pass.

    Both parts go to ``base`` in one job, by a partition column; the counts are
    observed in the same job.  Rejects are (line, file).
    """
    seen = Observation("scan")
    counted = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("_reject").alias("rejected"))
    counted.withColumn("_bad", F.col("_reject").isNotNull()).write.mode("overwrite").partitionBy("_bad").parquet(base)
    back = checked.sparkSession.read.schema(
        StructType([*checked.schema.fields, StructField("_bad", BooleanType())])).parquet(base)
    good = back.filter(~F.col("_bad")).drop("_reject", "_file", "_bad")
    rejects = back.filter("_bad").select(F.col("_reject").alias("line"), F.col("_file").alias("file"))
    return good, rejects, dict(seen.get)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None) -> DataFrame:
    """A long table or packaged table delivered as a file."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    return r.load(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small inline table (``tibble(...)``)."""
    return spark.createDataFrame(rows, schema)


def to_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
               mode: str = "overwrite") -> None:
    """Columnar sink; panels are partitioned by period for pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def to_csv(df: DataFrame, path: str, mode: str = "overwrite",
           order_by: list[str] | None = None, compression: str | None = None) -> None:
    """S9 (CSV form); ``order_by`` sorts at the sink (O1, NA last), the only
    place row order is kept.  ``compression="gzip"`` gives .csv.gz parts."""
    if order_by:
        df = df.orderBy(*[F.col(k).asc_nulls_last() for k in order_by])
    w = df.write.mode(mode).option("header", True)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


_POINTER = "seq bigint, as_of string, version string"


def _versions(spark: SparkSession, base: str) -> list:
    """The versions that were written whole, the newest first (a row a write)."""
    try:
        rows = spark.read.schema(_POINTER).parquet(f"{base}/pointer").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(rows, key=lambda r: (-r["seq"], r["version"]))


def write_snapshot(df: DataFrame, base: str, as_of: str) -> None:
    """A dated version, which becomes ``latest`` once it is whole.

    Each write has a folder of its own; the last step adds a row to the pointer
    table, which readers follow.  A reader therefore always sees a whole version,
    and a write that fails half-way leaves the version before it in place.
    ``as_of`` is an argument, never the wall clock (T5); writing a date again
    adds a version that replaces the earlier one of that date for readers.
    """
    spark = df.sparkSession
    version = f"{as_of}-{uuid.uuid4().hex}"
    df.withColumn("snapshot_date", F.to_date(F.lit(as_of))).write.parquet(f"{base}/versions/{version}")
    seq = max((r["seq"] for r in _versions(spark, base)), default=0) + 1
    spark.createDataFrame([(seq, as_of, version)], _POINTER).coalesce(1) \
        .write.mode("append").parquet(f"{base}/pointer")


def _follow(spark: SparkSession, base: str, rows: list, what: str) -> DataFrame:
    if not rows:
        raise FileNotFoundError(f"no {what} under {base}")
    return spark.read.parquet(f"{base}/versions/{rows[0]['version']}")


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """The version that was written last."""
    return _follow(spark, base, _versions(spark, base), "snapshot")


def read_snapshot(spark: SparkSession, base: str, as_of: str) -> DataFrame:
    """The last version written for a date; no other version is read."""
    return _follow(spark, base, [r for r in _versions(spark, base) if r["as_of"] == as_of],
                   f"snapshot of {as_of}")


def multi_output(frames: dict[str, DataFrame], base: str,
                 partition_by: dict[str, list[str]] | None = None) -> None:
    """Several outputs, each written to ``base/name`` by a job of its own
    (``write_stacked`` writes outputs of one parse in one job)."""
    partition_by = partition_by or {}
    for name, df in frames.items():
        to_parquet(df, f"{base}/{name}", partition_by.get(name))


def write_stacked(stacked: DataFrame, base: str, by: str = "output") -> None:
    """Outputs of one parse, stacked with their names in ``by``, written by
    one job into a folder each."""
    stacked.write.mode("overwrite").partitionBy(by).parquet(base)


def read_stacked(spark: SparkSession, base: str, name: str, columns: list[str], by: str = "output") -> DataFrame:
    """One output of ``write_stacked``; only its folder is read."""
    return spark.read.parquet(base).filter(F.col(by) == name).select(*columns)

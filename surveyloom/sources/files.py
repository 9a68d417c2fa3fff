"""Table scans, sinks and inventories. Schemas are given, not guessed: a code
such as ``040101`` stays text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import null_if_nan
from ..operators.projection import nested_to_json, storage_safe


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def read_table(spark: SparkSession, path: str, nan_as_null: bool = True) -> DataFrame:
    """Parquet scan; NaN becomes null so that the rest sees one kind of missing."""
    df = spark.read.parquet(path)
    floating = [n for n, t in df.dtypes if t in ("double", "float")] if nan_as_null else []
    return df.withColumns({n: null_if_nan(n) for n in floating}) if floating else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """CSV scan with header; a leading byte-order mark is dropped by the reader.
    Files with line breaks inside quotes need ``multi_line``, which reads each
    file in one task."""
    return spark.read.csv(path, header=True, schema=schema, multiLine=multi_line, escape='"')


def read_first(spark: SparkSession, csv_path: str, parquet_path: str, schema: StructType | str) -> DataFrame:
    """The CSV copy when it exists, otherwise the Parquet copy."""
    if _exists(spark, csv_path):
        return read_csv(spark, csv_path, schema)
    return read_table(spark, parquet_path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """JSON records; a missing path gives an empty table of the same schema."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Sink of a final table as Parquet or CSV with header."""
    writer = (storage_safe(df) if fmt == "parquet" else nested_to_json(df)).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "parquet":
        writer.parquet(path)
    elif fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_audit(df: DataFrame, path: str) -> None:
    """Sink of audit records as JSON lines."""
    df.write.mode("overwrite").json(path)


def file_inventory(spark: SparkSession, folder: str, expected: DataFrame, name: str = "file_name") -> DataFrame:
    """Expected files next to the files found: size, status ``ok`` or ``missing``."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias(name), F.col("length").alias("size_bytes")))
    return expected.join(found, name, "left").withColumn(
        "status", F.when(F.col("size_bytes").isNotNull(), "ok").otherwise("missing"))


def expected_manifest(modules: DataFrame, codes: Mapping[str, str], suffix: str = ".zip") -> DataFrame:
    """One row per module with the first format that has a code, and the file it
    should arrive in; ``codes`` maps format name to code column, in order."""
    from ..operators.nested import prefer

    picked = prefer(modules, codes, "download_code", "download_format")
    return picked.withColumn("file_name", F.concat(F.col("download_code"), F.lit(suffix)))


def schema_summary(tables: Mapping[str, DataFrame], grain_rules: Sequence[tuple[set, str, str]],
                   default: tuple[str, str]) -> DataFrame:
    """One row per table: rows, columns, grain and merge strategy. The grain is
    decided by the columns present; the first rule whose columns all exist wins."""
    def grain(columns: set) -> tuple[str, str]:
        return next(((g, m) for need, g, m in grain_rules if need <= columns), default)

    def one(name: str, df: DataFrame) -> DataFrame:
        level, merge = grain(set(df.columns))
        extra: list[Column] = [F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("columns"),
                               F.lit(level).alias("grain"), F.lit(merge).alias("merge_strategy")]
        return df.agg(F.count(F.lit(1)).alias("rows")).select(*extra, "rows")

    return reduce(DataFrame.unionByName, [one(n, d) for n, d in tables.items()])

"""Scans of the raw tables and of stored models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tatemono.sources import schemas, versions

# Physical address of a raw row. It tells exact copies of a listing apart, so
# that a sort can spread them over many tasks.
ROW_ADDRESS = ("_src_file", "_src_row")


def read_raw(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Scan a landing folder, or a table loaded from one, with a declared
    schema, never an inferred one."""
    return spark.read.schema(schema).format(fmt).options(**options).load(versions.current(spark, path))


def read_train(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return read_raw(spark, path, schemas.TRAIN, fmt, **options)


def read_test(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return read_raw(spark, path, schemas.TEST, fmt, **options)


def read_stations(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return read_raw(spark, path, schemas.STATIONS, fmt, **options)


def read_land_points(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return read_raw(spark, path, schemas.LAND_POINTS, fmt, **options)


def read_land_series(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return read_raw(spark, path, schemas.LAND_SERIES, fmt, **options)


def with_row_address(scan: DataFrame) -> DataFrame:
    """Add the file and row number of each row of a parquet scan."""
    return scan.withColumns(
        dict(zip(ROW_ADDRESS, [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")], strict=True))
    )


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """Scan the last whole version of a stored model, such as the mart, or a
    folder of plain parquet files."""
    return spark.read.parquet(versions.current(spark, path))


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """Scan a written submission."""
    return spark.read.schema("id STRING, price BIGINT").csv(path)


def upper_names(df: DataFrame) -> DataFrame:
    """All column names in upper case."""
    return df.toDF(*[name.upper() for name in df.columns])

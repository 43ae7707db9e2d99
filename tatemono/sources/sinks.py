"""Stored models, views and the submission file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tatemono.sources import versions


def write_model(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Replace a stored model by ``df`` and return a scan of it.

    The rows become a new version below ``path``, which readers see only once
    it is whole (:mod:`tatemono.sources.versions`). So ``df`` may read the
    model it replaces, and a write that fails changes nothing. ``keep``
    versions stay.
    """
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(versions.add(spark, path, df.write.parquet, keep))


def save_model_table(df: DataFrame, table: str, keep: int = 2) -> DataFrame:
    """Replace a catalog table by ``df`` and return a scan of it.

    The rows are a new version below the warehouse folder, and the catalog's
    entry is pointed to it when it is whole. Only a change of columns needs a
    new entry, between whose removal and creation the table has no name.
    """
    spark = df.sparkSession
    catalog = spark.catalog
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/model-versions/{table.replace('`', '')}"
    stored = write_model(df, folder, keep)
    known = catalog.tableExists(table)
    if known and spark.table(table).dtypes != stored.dtypes:
        spark.sql(f"DROP TABLE {table}")
        known = False
    if known:
        location = versions.current(spark, folder).replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        catalog.refreshTable(table)
    else:
        catalog.createTable(table, path=versions.current(spark, folder), source="parquet", schema=stored.schema)
    return spark.table(table)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a model as a view; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def load_table(landing: DataFrame, path: str) -> DataFrame:
    """Turn a landing folder's rows into a parquet table with their schema."""
    return write_model(landing, path)


def write_submission(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV without header or index, uncompressed, replacing an older one.

    ``single_file`` puts all rows through one task and suits a submission of
    a few thousand rows; leave it off for large tables.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", False).option("compression", "none").csv(path)

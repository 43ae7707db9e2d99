"""Whole runs from paths to paths: build the models, score, submit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tatemono.plans import mart as mart_plan
from tatemono.plans import score as score_plan
from tatemono.plans import staging
from tatemono.sources import checked, readers, schemas, scratch, sinks

_SCHEMAS = {
    "train": schemas.TRAIN,
    "test": schemas.TEST,
    "stations": schemas.STATIONS,
    "land_points": schemas.LAND_POINTS,
    "land_series": schemas.LAND_SERIES,
}


def land(
    spark: SparkSession,
    inputs: Mapping[str, str | DataFrame],
    fmt: str = "parquet",
    rejects: str | None = None,
    lenient: bool = False,
    **options: str,
) -> dict[str, DataFrame]:
    """The five raw tables, each from a landing folder with its declared schema
    or, given a DataFrame such as a catalog table, as it is. The rows of
    ``train`` get an address; what is no parquet folder is stored for that.

    With ``rejects``, a folder, every value of the landing folders is checked.
    The bad ones are listed below it, by table, and their rows go; with
    ``lenient`` the rows stay, without these values.
    """
    raw = {}
    for name, schema in _SCHEMAS.items():
        source = inputs[name]
        named = isinstance(source, str)
        if named and rejects:
            found = checked.read_checked(spark, source, schema, fmt, **options)
            sinks.write_model(found.rejects, f"{rejects}/{name}")
            rows = found.rows if lenient else found.good
            raw[name] = rows if name == "train" else rows.drop(*readers.ROW_ADDRESS)
            continue
        rows = readers.read_raw(spark, source, schema, fmt, **options) if named else source
        if name == "train":
            rows = readers.with_row_address(rows if named and fmt == "parquet" else scratch.store(rows, "landed"))
        raw[name] = rows
    return raw


def build_mart(
    spark: SparkSession,
    inputs: Mapping[str, str | DataFrame],
    out: str,
    radius_m: float = mart_plan.RADIUS_M,
    years: Sequence[int] = staging.YEARS,
    land_class: str = staging.RESIDENTIAL,
    lenient: bool = False,
    fmt: str = "parquet",
    rejects: str | None = None,
    **options: str,
) -> DataFrame:
    """Read the five raw tables and write the three stored models.

    ``inputs`` names the landing folders (of format ``fmt``) or holds the
    DataFrames of ``train``, ``test``, ``stations``, ``land_points`` and
    ``land_series``. Below ``out`` appear the nearest stations, the nearest
    land prices and the mart, which is returned. ``rejects`` names a folder for
    the list of bad values (see :func:`land`). The run's scratch tables are
    removed.
    """
    with scratch.scope(spark):
        raw = land(spark, inputs, fmt, rejects, lenient, **options)
        train, test = staging.stage_train(raw["train"], lenient), staging.stage_test(raw["test"], lenient)
        land_prices = staging.stage_land_prices(raw["land_points"], raw["land_series"], years, land_class)
        mart = mart_plan.mart(
            train, test, staging.stage_stations(raw["stations"]), land_prices, radius_m, years,
            write=lambda df, name: sinks.write_model(df, f"{out}/{name}"),
        )
        return sinks.write_model(mart, f"{out}/mart")


def score_mart(
    spark: SparkSession, mart: str, out: str, single_file: bool = False, errors: str | None = None, **settings
) -> DataFrame:
    """Read a stored mart, train, and write the submission as CSV; the result
    scans that file. With ``errors``, a folder, the rounds and the held-out
    error of each fold are written there.

    ``settings`` go to :func:`tatemono.plans.score.fit_and_score`.
    """
    with scratch.scope(spark):
        scored = score_plan.fit_and_score(readers.read_model(spark, mart), **settings)
        sinks.write_submission(scored.prices, out, single_file)
        if errors:
            scored.errors.write.mode("overwrite").parquet(errors)
    return readers.read_submission(spark, out)

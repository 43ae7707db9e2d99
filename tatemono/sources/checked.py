"""Dirty feeds: typed rows, and a list of every value that did not fit its type.

One scan gives both. The rows are stored with the complaints about them, and
good rows and rejects are read from there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tatemono.sources import scratch, versions
from tatemono.sources.readers import ROW_ADDRESS

NOT_A_NUMBER = "not a number"
NOT_A_TIME = "not a date or time"
NOT_OF_TYPE = "not of the declared type"
OUT_OF_RANGE = "out of range"
LOSES_DIGITS = "loses digits"
MALFORMED = "malformed record"

_PATH, _BAD, _RECORD = "_src_path", "_bad", "_corrupt_record"
_COMPLAINT = "array<struct<column string, text string, reason string>>"


@dataclass(frozen=True)
class Checked:
    """``rows`` are all rows with bad values as NULL, ``good`` those without a
    bad value. Both have the declared columns and the row's address.

    ``rejects`` has one row per bad value: ``file``, ``row``, ``column``,
    ``text`` and ``reason``. ``row`` is the row number in a parquet file; in other formats it
    only tells the rows apart. A record with too few or too many fields is one
    reject without a column, and has no values.
    """

    rows: DataFrame
    good: DataFrame
    rejects: DataFrame


def _loses_digits(text: Column, kind: T.DataType) -> Column | None:
    """Whether a number has more digits than its type keeps; None where any fit."""
    if not isinstance(kind, (T.DecimalType, T.IntegralType)):
        return None
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    # the plain test for a point spares most texts the pattern
    return text.contains(".") & text.rlike(rf"^[^eE]*\.\d{{{scale}}}\d*[1-9]")


def _reason(text: Column, typed: Column, kind: T.DataType) -> Column:
    """Why a text does not fit, NULL if it does."""
    lost = typed.isNull()
    loses = _loses_digits(text, kind)
    if isinstance(kind, T.NumericType):
        why = F.when(lost & text.try_cast("double").isNull(), NOT_A_NUMBER)
        if loses is not None:
            why = why.when(loses, LOSES_DIGITS)
        return why.when(lost, OUT_OF_RANGE)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.when(lost, NOT_A_TIME)
    return F.when(lost, NOT_OF_TYPE)


def check(raw: DataFrame, schema: str, file: Column, row: Column, record: Column | None = None) -> Checked:
    """The rows of ``raw``, of whatever types, in the declared ones; a column
    that ``raw`` lacks is NULL. ``file`` and ``row`` are a row's address.

    A NULL fits every type. A number with more digits behind the point than
    the type keeps is bad, since a cast would round it. ``record`` is a
    column with the text of a malformed record, else NULL.
    """
    spark = raw.sparkSession
    declared = spark.createDataFrame([], schema).schema
    given = {f.name.lower(): f for f in raw.schema}
    whole = F.lit(True) if record is None else record.isNull()
    typed, complaints = [], []
    if record is not None:
        complaints.append((~whole, F.lit(None), record, F.lit(MALFORMED)))
    for field in declared:
        source = given.get(field.name.lower())
        if source is None:
            typed.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        column = F.col(f"`{source.name}`")
        if source.dataType == field.dataType:
            typed.append(F.when(whole, column).alias(field.name))
            continue
        text = column.cast("string")
        if isinstance(field.dataType, T.StringType):
            typed.append(F.when(whole, text).alias(field.name))
            continue
        value = text.try_cast(field.dataType)
        if isinstance(field.dataType, T.DecimalType):
            # a text that is no number costs an exception; most such have no digit
            value = F.when(text.rlike(r"\p{Nd}"), value)
        loses = _loses_digits(text, field.dataType)
        unfit = value.isNull() if loses is None else value.isNull() | loses
        complaints.append((text.isNotNull() & unfit & whole, F.lit(field.name), text, _reason(text, value, field.dataType)))
        fits = text.isNotNull() & whole if loses is None else text.isNotNull() & ~loses & whole
        typed.append(F.when(fits, value).alias(field.name))
    found = [
        F.when(bad, F.struct(name.cast("string").alias("column"), text.alias("text"), why.alias("reason")))
        for bad, name, text, why in complaints
    ]
    # most rows have no complaint, and only the others need the list of all columns
    nothing = F.array().cast(_COMPLAINT)
    bad = F.when(reduce(or_, [c[0] for c in complaints]), F.array_compact(F.array(*found))).otherwise(nothing) if found else nothing
    stored = scratch.store(
        raw.select(
            *typed, file.alias(_PATH), F.xxhash64(file).alias(ROW_ADDRESS[0]), row.alias(ROW_ADDRESS[1]),
            bad.cast(_COMPLAINT).alias(_BAD),
        ),
        "checked",
    )
    rows = stored.drop(_PATH, _BAD)
    good = stored.where(F.size(_BAD) == 0).drop(_PATH, _BAD)
    rejects = (
        stored.where(F.size(_BAD) > 0)
        .select(F.col(_PATH).alias("file"), F.col(ROW_ADDRESS[1]).alias("row"), F.explode(_BAD).alias(_BAD))
        .select("file", "row", f"{_BAD}.column", f"{_BAD}.text", f"{_BAD}.reason")
    )
    return Checked(rows, good, rejects)


def read_checked(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options: str) -> Checked:
    """Scan a landing folder and check every value against the declared
    schema. Parquet columns may have other types than declared, such as text;
    other formats are read as text."""
    path = versions.current(spark, path)
    if fmt == "parquet":
        raw = spark.read.options(**options).parquet(path)
        return check(raw, schema, F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    names = spark.createDataFrame([], schema).columns
    texts = T.StructType([T.StructField(name, T.StringType()) for name in [*names, _RECORD]])
    reader = spark.read.schema(texts).options(**options)
    raw = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).format(fmt).load(path)
    return check(raw, schema, F.col("_metadata.file_path"), F.monotonically_increasing_id(), F.col(_RECORD))

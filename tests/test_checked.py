"""Dirty feeds: typed rows, rejects with address, column, text and reason."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tatemono.plans import jobs
from tatemono.sources import checked, fixtures, readers, schemas, scratch

SCHEMA = "name STRING, n INT, price DECIMAL(5,2), at DATE, seen TIMESTAMP_NTZ, x DOUBLE, ok BOOLEAN"


def test_reasons(spark, tmp_path):
    lines = {
        "good,1,2.50,2024-01-31,2024-01-31 10:00:00,1e3,true": [],
        "empty,,,,,,": [],
        "zeros,7,2.5000,2024-01-31,2024-01-31,NaN,false": [],
        "word,one,2,2024-01-31,2024-01-31,1,true": [("n", "one", checked.NOT_A_NUMBER)],
        "half,1.5,2,2024-01-31,2024-01-31,1,true": [("n", "1.5", checked.LOSES_DIGITS)],
        "wide,3000000000,1000,2024-01-31,2024-01-31,1,true": [
            ("n", "3000000000", checked.OUT_OF_RANGE), ("price", "1000", checked.OUT_OF_RANGE)
        ],
        "fine,1,2.505,2024-02-30,25:00,much,maybe": [
            ("price", "2.505", checked.LOSES_DIGITS), ("at", "2024-02-30", checked.NOT_A_TIME), ("seen", "25:00", checked.NOT_A_TIME),
            ("x", "much", checked.NOT_A_NUMBER), ("ok", "maybe", checked.NOT_OF_TYPE),
        ],
        "short,1": [(None, "short,1", checked.MALFORMED)],
        "long,1,2,2024-01-31,2024-01-31,1,true,more": [(None, "long,1,2,2024-01-31,2024-01-31,1,true,more", checked.MALFORMED)],
    }
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.csv").write_text("\n".join(lines) + "\n")
    found = checked.read_checked(spark, str(tmp_path / "feed"), SCHEMA, "csv")
    got = found.rejects.collect()
    assert sorted(map(str, ((r["column"], r["text"], r["reason"]) for r in got))) == sorted(str(b) for bad in lines.values() for b in bad)
    assert all(r["file"].endswith("feed/a.csv") for r in got)
    assert len({(r["file"], r["row"]) for r in got}) + found.good.count() == found.rows.count() == len(lines)
    good = {r["name"]: r for r in found.good.collect()}
    assert set(good) == {"good", "empty", "zeros"}
    assert (good["good"]["n"], good["good"]["price"], good["good"]["x"]) == (1, Decimal("2.50"), 1000.0)
    assert [c for c in found.good.columns if c not in readers.ROW_ADDRESS] == ["name", "n", "price", "at", "seen", "x", "ok"]
    half = found.rows.where("name = 'half'").first()
    assert half["n"] is None and half["price"] == Decimal("2.00")


def test_parquet_text_keeps_file_and_row_number(spark, tmp_path):
    path = str(tmp_path / "feed")
    raw = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None)], "NAME string, n string").withColumn("other", F.lit(1))
    raw.coalesce(1).write.parquet(path)
    found = checked.read_checked(spark, path, "name STRING, n INT, missing DOUBLE")
    reject = found.rejects.first()
    assert (reject["row"], reject["column"], reject["text"]) == (1, "n", "x") and found.rejects.count() == 1
    assert [(r["name"], r["n"], r["missing"]) for r in found.good.orderBy("name").collect()] == [("a", 1, None), ("c", None, None)]
    assert found.good.where("_src_row in (0, 2)").count() == 2


def test_empty_feed_and_declared_types(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.createDataFrame([], "n string").write.parquet(path)
    found = checked.read_checked(spark, path, "n INT")
    assert found.rows.count() == found.rejects.count() == 0
    typed = str(tmp_path / "typed")
    spark.range(3).write.parquet(typed)
    same = checked.read_checked(spark, typed, "id BIGINT")
    assert same.good.count() == 3 and same.rejects.count() == 0


def test_one_scan_gives_both(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "feed")
    spark.range(5).select(F.col("id").cast("string").alias("n")).write.csv(path)
    plans = []
    real = scratch.store
    monkeypatch.setattr(
        scratch, "store", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name)
    )
    found = checked.read_checked(spark, path, "n INT", "csv")
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1
    for df in (found.good, found.rejects, found.rows):
        assert "csv" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("lenient", [False, True])
def test_a_run_lists_rejects(spark, tmp_path, lenient):
    raw = fixtures.raw_tables(spark, "/root/testdata/sf0.001")
    inputs = {"test": raw.test, "land_points": raw.land_points, "land_series": raw.land_series, "train": raw.train.drop(*readers.ROW_ADDRESS)}
    lines = [r["station_name"] + f",city,{139.1 + i / 1000},{'north' if i == 1 else 35.5}" for i, r in enumerate(raw.stations.limit(4).collect())]
    (tmp_path / "stations").mkdir()
    (tmp_path / "stations" / "a.csv").write_text("\n".join(lines))
    landed = jobs.land(spark, {**inputs, "stations": str(tmp_path / "stations")}, "csv", str(tmp_path / "rejects"), lenient)
    assert landed["stations"].count() == (4 if lenient else 3)
    assert landed["stations"].columns == spark.createDataFrame([], schemas.STATIONS).columns
    listed = readers.read_model(spark, str(tmp_path / "rejects" / "stations")).collect()
    assert [(r["column"], r["text"], r["reason"]) for r in listed] == [("latitude", "north", checked.NOT_A_NUMBER)]


def test_rows_without_a_complaint_skip_the_list_of_all_columns(spark, monkeypatch):
    plans, real = [], scratch.store
    monkeypatch.setattr(scratch, "store", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, name))
    raw = spark.createDataFrame([("1", "2"), (None, None), ("1.5", "two"), ("9e9", "1e1")], "n string, m string")
    found = checked.check(raw, "n INT, m INT", F.lit("f"), F.lit(0))
    assert re.search(r"THEN (\w+\()*filter\(", plans[0])
    assert {tuple(r)[2:] for r in found.rejects.collect()} == {
        ("n", "1.5", checked.LOSES_DIGITS), ("m", "two", checked.NOT_A_NUMBER), ("n", "9e9", checked.OUT_OF_RANGE), ("m", "1e1", checked.OUT_OF_RANGE),
    }
    assert [tuple(r)[:2] for r in found.good.orderBy("n").collect()] == [(None, None), (1, 2)]

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from conftest import rows
from fleetquill.functions import dates, nested, text

D = dt.date


def column(spark, values, expression, type_="string"):
    """Values of an expression over a single column ``v``, in input order."""
    df = spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)], f"i int, v {type_}"
    )
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_retention_moves_months_then_days(spark):
    days = [D(2024, 2, 29), D(2024, 1, 31), D(2023, 12, 15)]
    fifteen = dates.Retention(years=15).deletion_date(F.col("v"))
    assert column(spark, days, fifteen, "date") == [
        D(2039, 2, 28),
        D(2039, 1, 31),
        D(2038, 12, 15),
    ]
    mixed = dates.Retention(years=0, months=1, days=3).deletion_date(F.col("v"))
    assert column(spark, days, mixed, "date") == [
        D(2024, 4, 1),
        D(2024, 3, 3),
        D(2024, 1, 18),
    ]


@pytest.mark.parametrize(
    "complaint, delivery, months, label",
    [
        ("2024-05-15", "2024-04-15", 1, "MIS 1"),
        ("2024-05-14", "2024-04-15", 0, "MIS 0"),
        ("2024-02-29", "2024-01-31", 1, "MIS 1"),
        ("2025-02-28", "2024-02-29", 12, "MIS 12"),
        ("2024-04-01", "2020-04-01", 48, "MIS 48"),
        ("2024-05-01", "2020-04-01", 49, None),
        ("2024-03-31", "2024-05-01", -2, "MIS -2"),
        (None, "2024-05-01", None, None),
    ],
)
def test_months_in_service(spark, complaint, delivery, months, label):
    df = spark.createDataFrame([(complaint, delivery)], "c string, d string")
    m = dates.months_in_service(F.col("c").cast("date"), F.col("d").cast("date"))
    got = df.select(m.alias("m"), dates.mis_label(m).alias("l")).first()
    assert (got.m, got.l) == (months, label)


def test_folder_dates(spark):
    paths = ["core/2024-01-05/x", "core/2024-1-5/x", "core/core_duplicates/x", "core"]
    got = column(spark, paths, dates.folder_date(F.col("v")))
    assert got == [D(2024, 1, 5), D(2024, 1, 5), None, None]


def test_newer_is_strict(spark):
    newer = dates.is_newer(F.col("v").cast("date"), dates.as_date("2022-01-01"))
    assert column(spark, ["1600-01-01", "2022-01-01", "2022-01-02"], newer) == [
        False,
        False,
        True,
    ]
    back = dates.is_newer(F.col("v").cast("date"), dates.as_date("1600-01-01"))
    assert column(spark, ["2022-01-01"], back) == [True]


def test_ecu_name_and_hex(spark):
    df = spark.createDataFrame([("1", "a"), (None, "a"), ("1", None)], "x string, y string")
    got = df.select(text.ecu_name(F.col("x"), F.col("y"))).collect()
    assert [r[0] for r in got] == ["1 - a", None, None]
    assert column(spark, ["255", "-1", "x", None], text.dfcc_hex(F.col("v"))) == [
        "FF",
        "FFFFFFFFFFFFFFFF",
        None,
        None,
    ]


def test_model_years(spark):
    df = spark.createDataFrame(
        [(1, 2015, 2018), (2, 2015, None), (3, 2015, 2015), (4, 2022, 2021), (5, None, 2020)],
        "i int, a int, b int",
    )
    got = df.orderBy("i").select(text.model_years(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [[2015, 2016, 2017], [2015], [], [], []]


def test_is_json_takes_one_whole_value(spark):
    good = ['{"a": 1}', "[1, 2]", "null", "1", '"x"', " true "]
    bad = ["", "  ", '{"a": 1} junk', "1, 2", "[1]]", '1, "b": 2', "1], [2", '1}, {"x": 1']
    bad += ['{"a": 1}}', "<html>", "{a: 1}", None]
    assert all(column(spark, good, nested.is_json(F.col("v"))))
    assert not any(column(spark, bad, nested.is_json(F.col("v"))))


def test_optional_path(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 'x')) AS a")
    out = nested.optional_path(df, "found", "a.b.c")
    out = nested.optional_path(out, "absent", "a.z.c")
    assert rows(out.select("found", "absent")) == [("x", None)]
    assert dict(out.dtypes)["absent"] == "string"
    with pytest.raises(AnalysisException):
        df.select("a.z.c")


def test_keys_and_urls(spark):
    v = F.col("v")
    assert column(spark, ["a", "a.csv", "a.txt"], text.with_suffix(v, ".csv")) == [
        "a.csv",
        "a.csv",
        "a.txt.csv",
    ]
    key = text.raw_object_key("base/", F.lit("2024-03-01"), F.lit("P1"), v)
    assert column(spark, ["u"], key) == ["base/2024-03-01/P1_2024-03-01_u"]
    url = text.fill_template("h/{id}/b/{version}?{id}", id=v, version=F.lit("v9"))
    assert column(spark, ["X"], url) == ["h/X/b/v9?X"]

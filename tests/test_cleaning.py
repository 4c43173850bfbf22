import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriema.operators import cleaning as c
from tests.conftest import rows

D = dt.date


def test_mixed_dates_are_parsed_value_by_value(spark):
    texts = ["2023-01-01", "2023-02-01 10:20:30", "2023-03-01T00:00:00", "13/02/2023", "04/2023",
             "31/02/2023", "2023-13-01", "01/02/23", "2023-02-01 25:00:00", "", "x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, data string")
    got = [r[1] for r in rows(c.standardize_date(df), "i")]
    assert got == [D(2023, 1, 1), D(2023, 2, 1), D(2023, 3, 1), D(2023, 2, 13), D(2023, 4, 1),
                   None, None, None, None, None, None, None]


def test_date_columns_that_are_dates_or_absent(spark):
    df = spark.range(1).select(F.lit("2023-01-01 05:06:07").cast("timestamp").alias("date"))
    assert c.standardize_date(df).first()[0] == D(2023, 1, 1)
    other = spark.range(1)
    assert c.standardize_date(other).columns == ["id"]
    assert c.normalize_date(other, "last_date").columns == ["id"]


def test_formatter_is_used_for_other_formats(spark):
    df = spark.createDataFrame([("5 Jan 2023",), ("99 Foo",)], "date string")
    got = {r[0] for r in c.normalize_date(df, "date", ["d MMM yyyy"]).collect()}
    assert got == {D(2023, 1, 5), None}


def test_ensure_numeric(spark):
    texts = ["1.5", " 2 ", "n/d", "", "NaN", "1d", "2.5F", "1e3", "inf", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = [r[1] for r in rows(c.ensure_numeric(df, "v", "absent"), "i")]
    assert got == [1.5, 2.0, None, None, None, None, None, 1000.0, float("inf"), None]
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert {r[0] for r in c.ensure_numeric(df, "v").collect()} == {None, 1.0}


def test_decimal_comma(spark):
    df = spark.createDataFrame([("0,53",), ("-1,5",), ("...",)], "v string")
    assert {r[0] for r in c.comma_to_number(df, "v").collect()} == {0.53, -1.5, None}


@pytest.fixture
def repeated(spark):
    data = [("a", 1, 1), ("a", 1, 2), ("a", 2, 3), (None, 1, 4), (None, 1, 5), ("b", None, 6)]
    return spark.createDataFrame(data, "k string, g int, t int")


@pytest.mark.parametrize("keep,times", [
    ("first", [1, 3, 4, 6]), ("last", [2, 3, 5, 6]), (False, [3, 6]),
])
def test_remove_duplicates(repeated, keep, times):
    got = c.remove_duplicates(repeated, ["t"], ["k", "g"], keep)
    assert [r.t for r in got.orderBy("t").collect()] == times
    assert got.columns == ["k", "g", "t"]


def test_remove_duplicates_over_all_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x")], "a int, b string")
    assert rows(c.remove_duplicates(df, ["a"]), "a") == [(1, "x"), (2, "x")]
    with pytest.raises(ValueError):
        c.remove_duplicates(df, ["a"], keep="middle")


def test_fill_missing(spark):
    df = spark.createDataFrame([(None, None, None), (float("nan"), "x", D(2023, 1, 1))],
                               "v double, s string, d date")
    got = c.fill_missing(df, {"v": 0, "s": "?", "d": "2020-01-01", "absent": 1}).collect()
    assert {tuple(r) for r in got} == {(0.0, "?", D(2020, 1, 1)), (0.0, "x", D(2023, 1, 1))}
    assert c.fill_missing(df) is df


def test_names(spark):
    df = spark.createDataFrame([(D(2023, 1, 1), 1.0)], "data date, ipca double")
    assert c.value_column(df) == "ipca"
    assert c.rename_present(df, {"ipca": "value", "nope": "x"}).columns == ["data", "value"]
    with pytest.raises(ValueError):
        c.value_column(df.select("data"))
    picked = c.select_present(df, "data", ("v", ["nope", "ipca"]), ("w", ["nope"]))
    assert picked.columns == ["data", "v"]


def test_bounds_are_inclusive_and_optional(spark):
    df = spark.createDataFrame([(D(2023, m, 1),) for m in range(1, 7)], "date date")
    assert c.between_dates(df, start=D(2023, 2, 1), end=D(2023, 4, 1)).count() == 3
    assert c.between_dates(df, start=D(2023, 2, 1)).count() == 5
    assert c.between_dates(df).count() == 6
    assert c.lookback(df, D(2023, 6, 1), months=2).count() == 3  # 61 days back is 1 April
    assert c.lookback(df, D(2023, 5, 1), days=30).count() == 2
    with pytest.raises(ValueError):
        c.lookback(df, D(2023, 6, 1))


def test_metadata_modes(spark):
    df = spark.createDataFrame([("old",)], "unit string")
    assert c.with_metadata(df, unit="new").first()[0] == "new"
    assert c.with_metadata(df, "if_missing", unit="new", source="s").first() == ("old", "s")


def test_registry(spark):
    df = spark.createDataFrame(
        [("bcb", "selic", "kept"), ("bcb", "unknown", "kept"), ("ibge", "selic", None)],
        "source string, indicator string, unit string",
    )
    got = {(r.source, r.indicator): r for r in c.attach_registry(
        df, dt.datetime(2024, 1, 2, 3, 4, 5)).collect()}
    assert got["bcb", "selic"].frequency == "daily" and got["bcb", "selic"].unit == "%"
    assert got["bcb", "unknown"].unit == "kept" and got["bcb", "unknown"].indicator_name is None
    assert got["ibge", "selic"].frequency is None
    assert all(r.collected_at == dt.datetime(2024, 1, 2, 3, 4, 5) for r in got.values())

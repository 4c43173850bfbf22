import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriema.operators import quality as q


def results(df):
    return {(r["check"], r["column"]): (r["metric"], r["passed"]) for r in df.collect()}


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [(dt.date(2023, 1, 1), 1.0, "a"), (dt.date(2023, 1, 1), 1.0, "a"), (None, 200.0, None),
         (dt.date(2023, 1, 3), float("nan"), None)],
        "date date, value double, indicator string")


def test_checks(data):
    assert results(q.check_columns(data, ["date", "gone"])) == {
        ("presence", "date"): (1.0, True), ("presence", "gone"): (0.0, False)}
    assert results(q.check_types(data, {"date": "datetime", "value": "string", "indicator": "string",
                                        "gone": "numeric"})) == {
        ("type", "date"): (1.0, True), ("type", "value"): (0.0, False), ("type", "indicator"): (1.0, True)}
    assert results(q.check_ranges(data, {"value": (0, 100), "indicator": (0, 1), "gone": (0, 1)})) == {
        ("range", "value"): (1.0, False)}
    assert results(q.check_nulls(data, 25.0)) == {
        ("null_share", "date"): (25.0, True), ("null_share", "value"): (25.0, True),
        ("null_share", "indicator"): (50.0, False)}
    assert results(q.check_duplicates(data)) == {("duplicates", None): (1.0, False)}
    assert results(q.check_duplicates(data, ["indicator"])) == {("duplicates", None): (2.0, False)}


def test_empty_frame_fails_everything_but_duplicates(data):
    got = results(q.validate(data.filter("false"), ["date"], {"date": "datetime"}, {"value": (0, 1)}))
    assert not any(ok for key, (_, ok) in got.items() if key[0] != "duplicates")
    assert got["duplicates", None] == (0.0, True)
    assert results(q.check_not_empty(data.filter("false"))) == {("rows", None): (0.0, False)}


def test_validate_verdict(data):
    good = data.filter(F.col("date").isNotNull() & (F.col("value") < 100)).distinct()
    assert results(q.validate(good, ["date", "value"]))["dataset", None] == (0.0, True)
    assert results(q.validate(data))["dataset", None][1] is False
    assert ("duplicates", None) not in results(q.validate(good, duplicates=False))


def test_contract(spark, data):
    got = {(r["check"], r["column"]): (r["passed"], r["severity"])
           for r in q.check_contract(data, "silver").collect()}
    assert got["presence", "unit"] == (False, "error")
    assert got["null_share", "date"] == (False, "warn")
    assert got["rows", None] == (True, "warn")
    macro = spark.createDataFrame([("ipca", 1.0, dt.date(2023, 1, 1))],
                                  "indicator string, last_value double, last_date date")
    got = {(r["check"], r["column"]): r["passed"] for r in q.check_contract(macro, "macro_dashboard").collect()}
    assert got["expected_indicator", "ipca"] and not got["expected_indicator", "economic_health"]
    assert got["rows", None] is False


def test_profile(data):
    got = {r["column"]: r for r in q.profile(data).collect()}
    assert got["*"]["nulls"] == 4 and got["value"]["nulls"] == 1
    assert got["indicator"]["null_pct"] == 50.0 and got["date"]["dtype"] == "date"


def test_wide_frames_are_planned_in_no_time(spark):
    df = spark.range(5).select(*((F.col("id") + i).alias(f"c{i}") for i in range(120)))
    ranges = {f"c{i}": (0, 50) for i in range(120)}
    got = results(q.validate(df.filter("c0 >= 0"), df.columns, {}, ranges))
    assert got["range", "c10"] == (0.0, True) and got["range", "c119"] == (5.0, False)
    assert q.profile(df).count() == 121


def test_duplicates_by_fingerprint(spark, monkeypatch):
    rows = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), ("b", "c", 0.0), ("b", "c", -0.0), ("b", "c", float("nan")), ("x", "y", None)]
    df = spark.createDataFrame(rows, "p string, q string, v double")
    assert q.check_duplicates(df).first()["metric"] == 2.0 and q.check_duplicates(df, ["p"]).first()["metric"] == 3.0
    # Rows whose fingerprints are equal by chance are told apart.
    monkeypatch.setattr(q, "fingerprint", lambda columns: F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")))
    assert q.check_duplicates(df).first()["metric"] == 2.0 and q.check_duplicates(df.limit(0)).first()["passed"]


def test_only_fingerprints_are_moved(spark):
    df = spark.range(10).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("wide"))
    text = q.check_duplicates(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in text
    first = text[text.index("Join LeftSemi"):]
    assert "wide" not in [line for line in first.splitlines() if "Aggregate" in line][0]
